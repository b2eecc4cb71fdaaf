"""Serving table: the latest features per customer, and batch lookups in it."""

from __future__ import annotations

import hashlib
import json
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType

from lapsewise.functions import order_value
from lapsewise.operators import latest_per_key
from lapsewise.sources.tables import replace_bucketed_table
from lapsewise.sources.versions import CommitConflict, Folder, Version, VersionedTable, sequence_of

LOG_SCHEMA = (
    "sync_id string, state string, row_synced bigint, start_time timestamp, "
    "end_time timestamp, message string"
)
#: Rows of deltas that may be broadcast; more are merged by a shuffle.
SMALL = 250_000
#: Deltas that an entity's rows can come from, in the bits below the time.
_POSITIONS = 64
#: Syncs that the log remembers.
_REMEMBERED = 100


@dataclass(frozen=True)
class FeatureSpec:
    """A feature group: entity key, time column and registered feature names."""

    name: str
    entity_key: str
    time_column: str
    features: tuple[str, ...]

    def validate(self, df: DataFrame) -> None:
        wanted = [self.entity_key, self.time_column, *self.features]
        missing = [c for c in wanted if c not in df.columns]
        if missing:
            raise ValueError(f"{self.name}: source lacks {missing}")

    def view(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """Key, time and the chosen features of the source."""
        chosen = self.features if names is None else tuple(names)
        unknown = [c for c in chosen if c not in self.features]
        if unknown:
            raise ValueError(f"{self.name}: features not registered: {unknown}")
        self.validate(df)
        return df.select(self.entity_key, self.time_column, *chosen)

    def profile(self, df: DataFrame) -> DataFrame:
        """``(group_name, entity_key, feature, data_type, values)`` per registered feature."""
        self.validate(df)
        counts = df.agg(*(F.count(c).alias(c) for c in self.features))
        entries = F.array(
            *(
                F.struct(
                    F.lit(self.name).alias("group_name"),
                    F.lit(self.entity_key).alias("entity_key"),
                    F.lit(c).alias("feature"),
                    F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                    F.col(c).alias("values"),
                )
                for c in self.features
            )
        )
        return counts.select(F.inline(entries))


@dataclass
class FeatureRegistry:
    """Feature groups by name; registering a name or feature again changes nothing."""

    groups: dict[str, FeatureSpec] = field(default_factory=dict)

    def register(self, spec: FeatureSpec) -> FeatureSpec:
        return self.groups.setdefault(spec.name, spec)

    def add_features(self, name: str, features: Sequence[str]) -> FeatureSpec:
        spec = self.groups[name]
        new = tuple(dict.fromkeys((*spec.features, *features)))
        self.groups[name] = FeatureSpec(spec.name, spec.entity_key, spec.time_column, new)
        return self.groups[name]


class ServingTable:
    """The latest row per entity: a base cut into key ranges, and deltas of later batches on top.

    A batch is written as a delta, reduced to its latest row per entity and cut at the
    base's key ranges, so what it writes follows the batch and not the table.  Reading
    merges: of an entity's rows the one with the latest time counts, of rows with the same
    time the one that was written later.  Deltas that are small beside their ranges are
    folded into one when there are ``max_deltas`` of them; a range whose deltas have grown to
    ``share`` of it is rewritten, alone.  Every change is one commit of a
    ``VersionedTable``: readers never see half of one, a failed sync leaves the previous
    table in place, and versions that neither a pin nor ``keep`` holds are removed.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: FeatureSpec,
        ranges: int = 8,
        max_deltas: int = 8,
        share: float = 0.25,
        keep: int = 4,
    ):
        if not 1 <= max_deltas < _POSITIONS:
            raise ValueError(f"max_deltas must lie in [1, {_POSITIONS})")
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self.ranges, self.max_deltas, self.share, self.keep = ranges, max_deltas, share, keep
        self.table = VersionedTable(spark, self.path)
        self._syncs = Folder(spark, f"{self.path}/_syncs")

    # -- log ---------------------------------------------------------------

    def log(self) -> DataFrame:
        """The syncs that are remembered, each by its last state."""
        return self.spark.createDataFrame([self._entry(name) for name, _ in self._syncs.names()], LOG_SCHEMA)

    def _entry(self, name: str) -> tuple:
        held = json.loads(self._syncs.read(name))
        times = (datetime.fromisoformat(held[c]) if held[c] else None for c in ("start", "end"))
        return (held["sync_id"], held["state"], held["rows"], *times, held["message"])

    def _append(self, sync_id, state, rows=None, start=None, end=None, message=None) -> None:
        """One small file a sync; its closing state takes the place of the opening one."""
        row = {"sync_id": sync_id, "state": state, "rows": rows, "message": message}
        row |= {"start": start.isoformat(), "end": end.isoformat() if end else None}
        name = f"{int(start.timestamp() * 1e6):020d}-{hashlib.sha256(sync_id.encode()).hexdigest()[:12]}.json"
        self._syncs.write(name, json.dumps(row))

    def sync_status(self) -> DataFrame:
        """One row on the newest sync: COMPLETED, IN_PROGRESS, ERROR, or NO_SYNC when none ran."""
        names = sorted(name for name, _ in self._syncs.names())
        last = self._entry(names[-1]) if names else (None, "NO_SYNC", 0, None, None, None)
        newest = self.spark.createDataFrame([last], LOG_SCHEMA)
        return newest.select(
            F.col("state").alias("status"),
            F.col("sync_id").alias("name"),
            F.coalesce("row_synced", F.lit(0)).alias("row_synced"),
            "start_time",
            "end_time",
            "message",
        )

    # -- reading -------------------------------------------------------------

    def read(self) -> DataFrame:
        """The current serving table."""
        return self._merged(self._current())

    @contextmanager
    def pinned(self) -> Iterator[DataFrame]:
        """The current serving table, whose files stay while the context lasts."""
        version = self._current()
        with self.table.pinned(version.number):
            yield self._merged(version)

    def _current(self) -> Version:
        version = self.table.version()
        if version is None:
            raise LookupError(f"no completed sync under {self.path}")
        return version

    def latest(self, features: DataFrame) -> DataFrame:
        """The latest registered features per entity."""
        view = self.spec.view(features)
        time = self.spec.time_column
        return latest_per_key(view, [self.spec.entity_key], [time, *self.spec.features], time)

    def _order(self, df: DataFrame) -> Column:
        time = self.spec.time_column
        return order_value(F.col(time), df.schema[time].dataType)

    def _folded(self, version: Version, deltas: list[dict]) -> DataFrame:
        """The latest row per entity of the deltas; of rows with the same time the later written."""
        key, time = self.spec.entity_key, self.spec.time_column
        numbers = sorted({p["seq"] for p in deltas})
        frames = [
            self.table.frame(version, [p for p in deltas if p["seq"] == n]).withColumn("_position", F.lit(i))
            for i, n in enumerate(numbers)
        ]
        if len(frames) == 1:  # one batch has one row per entity
            return frames[0].drop("_position")
        rows = reduce(DataFrame.unionByName, frames)
        # One bigint carries time and position, which keeps this a hash aggregate.
        order = self._order(rows) * _POSITIONS + F.col("_position")
        return latest_per_key(rows, [key], [time, *self.spec.features], order)

    def _merged(self, version: Version, parts: Sequence[dict] | None = None) -> DataFrame:
        """Base and deltas as one row per entity."""
        parts = version.parts if parts is None else parts
        base, deltas = ([p for p in parts if bool(p["seq"]) == later] for later in (False, True))
        rows = self.table.frame(version, base)
        if not deltas:
            return rows
        key, time = self.spec.entity_key, self.spec.time_column
        folded = self._folded(version, deltas)
        if not base:
            return folded
        if sum(p["rows"] for p in deltas) > SMALL:
            both = rows.withColumn("_new", F.lit(0)).unionByName(folded.withColumn("_new", F.lit(1)))
            return latest_per_key(both, [key], [time, *self.spec.features], self._order(both) * 2 + F.col("_new"))
        # The commits have counted the deltas, so they may be broadcast and the base stays in
        # its files: rows that lose to a delta are passed over, as are deltas that came late.
        met = F.broadcast(folded.select(F.col(key).alias("_key"), self._order(folded).alias("_time")))
        wins = F.coalesce(self._order(rows) > F.col("_time"), F.col("_time").isNull() & F.col(time).isNotNull())
        same = rows[key].eqNullSafe(F.col("_key"))
        late = rows.join(met, same).where(wins).select(F.col("_key").alias("_late"))
        stay = rows.join(met.withColumn("_met", F.lit(True)), same, "left").where(F.col("_met").isNull() | wins)
        new = folded.join(F.broadcast(late), folded[key].eqNullSafe(F.col("_late")), "left_anti")
        return stay.select(*rows.columns).unionByName(new)

    # -- writing -------------------------------------------------------------

    def sync(self, features: DataFrame) -> None:
        """Rebuild the serving table from the whole feature table."""

        def publish() -> int:
            rows = self.latest(features)
            parts, bounds = self._write_base(rows)
            while True:
                before = self.table.version()
                notes = {**(before.notes if before else {"streams": {}, "next": 1}), "bounds": bounds}
                try:
                    self.table.commit(before, parts, rows.schema, notes)
                except CommitConflict:
                    continue
                return sum(p["rows"] for p in parts)

        self._logged(f"full-{uuid.uuid4().hex}", publish)
        self._clean()

    def merge(self, sync_id: str, batch: DataFrame) -> None:
        """Fold new feature rows in; older rows never replace newer ones.

        On equal times the batch wins.  ``sync_id`` is a stream's name and a number that
        grows (``name-7``); a number that completed before is skipped, so replays are harmless.
        """
        stream, number = sequence_of(sync_id)
        before = self.table.version()
        if before is not None and before.notes["streams"].get(stream, -1) >= number:
            return

        def append() -> int:
            rows = self.latest(batch)
            while True:
                before = self.table.version()
                if before is None:
                    parts, bounds = self._write_base(rows)
                    made, notes = parts, {"bounds": bounds, "streams": {}, "next": 1}
                else:
                    notes = dict(before.notes)
                    made = self._write_ranges(rows, notes["bounds"], notes["next"])
                    parts = [*before.parts, *made]
                    notes["next"] += 1
                notes["streams"] = {**notes["streams"], stream: number}
                try:
                    self.table.commit(before, parts, rows.schema, notes)
                except CommitConflict:
                    continue  # the ranges may have changed
                return sum(p["rows"] for p in made)

        self._logged(sync_id, append)
        self.compact()

    def _logged(self, sync_id: str, work: Callable[[], int]) -> None:
        start = _now()
        self._append(sync_id, "IN_PROGRESS", start=start)
        try:
            rows = work()
        except Exception as error:
            self._append(sync_id, "ERROR", start=start, end=_now(), message=str(error)[:500])
            raise
        self._append(sync_id, "COMPLETED", rows=rows, start=start, end=_now())

    def _write_base(self, rows: DataFrame) -> tuple[list[dict], list[str]]:
        """A base with new ranges: its parts, and the least keys of all ranges but the first."""
        key = self.spec.entity_key
        cut = rows.repartitionByRange(self.ranges, key).withColumn("_range", F.spark_partition_id())
        path = self.table.write(cut.sortWithinPartitions("_range", key), ["_range"])
        held = self._held(path, F.min(key).cast("string").alias("low"))
        parts = [
            {"path": f"{path}/_range={r['_range']}", "range": i, "seq": 0, "rows": r["rows"]} for i, r in enumerate(held)
        ]
        return parts, [r["low"] for r in held[1:]]

    def _held(self, path: str, *more: Column) -> list[Row]:
        """Rows by range of a directory just written, in the order of the ranges."""
        if not any(name.startswith("_range=") for name, _ in self.table.folder.names(path)):
            return []
        found = self.spark.read.parquet(f"{self.path}/{path}").groupBy("_range")
        return sorted(found.agg(F.count(F.lit(1)).alias("rows"), *more).collect(), key=lambda r: r["_range"])

    def _range(self, rows: DataFrame, bounds: Sequence[str]) -> Column:
        key = self.spec.entity_key
        if not bounds:
            return F.lit(0)
        lows = F.array(*(F.lit(b) for b in bounds)).cast(ArrayType(rows.schema[key].dataType))
        return F.size(F.filter(lows, lambda low: low <= F.col(key)))

    def _write_ranges(self, rows: DataFrame, bounds: Sequence[str], seq: int) -> list[dict]:
        """Rows by the ranges that there are: the parts written, none for no rows."""
        key = self.spec.entity_key
        cut = rows.withColumn("_range", self._range(rows, bounds)).repartition("_range")
        path = self.table.write(cut.sortWithinPartitions("_range", key), ["_range"])
        return [
            {"path": f"{path}/_range={r['_range']}", "range": r["_range"], "seq": seq, "rows": r["rows"]}
            for r in self._held(path)
        ]

    # -- compaction ------------------------------------------------------------

    def compact(self, everything: bool = False) -> bool:
        """Rewrites ranges with many deltas and folds the rest if they are many; True if it did.

        A sync that commits meanwhile wins, and the work is left for the next time.
        """
        version = self.table.version()
        if version is None:
            return False
        base, later = Counter(), Counter()
        for p in version.parts:
            (later if p["seq"] else base)[p["range"]] += p["rows"]
        full = {r for r, n in later.items() if everything or n > self.share * base[r]}
        rest = [p for p in version.parts if p["seq"] and p["range"] not in full]
        fold = len({p["seq"] for p in rest}) > self.max_deltas
        if not full and not fold:
            return False
        bounds, parts = version.notes["bounds"], [p for p in version.parts if p["range"] not in full]
        sizes = base + later
        if full and max(sizes.values()) > 4 * sum(sizes.values()) / self.ranges and sum(sizes.values()) > SMALL:
            # Keys have outgrown the ranges: cut them anew.
            parts, bounds = self._write_base(self._merged(version))
        elif full:
            merged = self._merged(version, [p for p in version.parts if p["range"] in full])
            parts = [*parts, *self._write_ranges(merged, bounds, 0)]
        if fold and bounds is version.notes["bounds"]:
            seq = max(p["seq"] for p in rest)
            parts = [p for p in parts if not p["seq"]]
            parts += self._write_ranges(self._folded(version, rest), bounds, seq)
        try:
            self.table.commit(version, parts, version.schema, {**version.notes, "bounds": bounds})
        except CommitConflict:
            return False
        self._clean()
        return True

    def _clean(self) -> None:
        self.table.expire(keep=self.keep)
        for name in sorted(name for name, _ in self._syncs.names())[:-_REMEMBERED]:
            self._syncs.delete(name)

    # -- lookups -----------------------------------------------------------

    def fetch(self, key, names: Sequence[str] | None = None) -> DataFrame:
        """Features of one entity, from the files of its key range; no row when it is unknown."""
        chosen = self.spec.features if names is None else names
        version = self._current()
        bounds, parts = version.notes["bounds"], version.parts
        if isinstance(version.schema[self.spec.entity_key].dataType, IntegralType):
            held = bisect_right([int(b) for b in bounds], key)
            parts = [p for p in parts if p["range"] == held]
        found = self._merged(version, parts).where(F.col(self.spec.entity_key) == F.lit(key))
        return found.select(self.spec.entity_key, *(c for c in self.spec.features if c in chosen))

    def fetch_many(self, keys: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        return fetch_many(self.read(), keys, self.spec, names)

    def bucketed(self, name: str, buckets: int | None = None) -> DataFrame:
        """The current table as a catalog table bucketed by the key, for ``fetch_many`` of many keys.

        Requests of any number then join it with one shuffle, of the requests.  It is as
        of the version it was made from, and each version has a table of its own.
        """
        version = self._current()
        if buckets is None:
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = f"{self.path}/bucketed/{version.number:012d}-{buckets}"
        return replace_bucketed_table(
            self._merged(version), f"{name}_{version.number}", buckets, self.spec.entity_key, path=path
        )


def fetch_many(
    table: DataFrame, keys: DataFrame, spec: FeatureSpec, names: Sequence[str] | None = None
) -> DataFrame:
    """A record per requested key; an unknown key gets an error, the rest succeed."""
    chosen = spec.features if names is None else tuple(names)
    served = table.select(spec.entity_key, *chosen, F.lit(True).alias("_found"))
    found = F.col("_found").isNotNull()
    return keys.join(served, spec.entity_key, "left").select(
        *keys.columns,
        *chosen,
        F.when(found, "success").otherwise("error").alias("status"),
        F.when(~found, "no features for this key").alias("error"),
    )


def _now() -> datetime:
    return datetime.now(timezone.utc)
