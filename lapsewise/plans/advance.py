"""Feature snapshots carried on from day to day, without the lookback being read again.

A build sums signed changes: a fact counts from its day on and stops counting when it
leaves a window.  So what a build knows at the end of a day is small: each customer's running
values, and the changes that are still to come.  New facts only add to both, and the next days'
snapshots follow from the running values and the changes that fall due.  Distinct counts
are not sums; they change as the new facts' own products and categories do, so those are
counted with and without the new facts, and the difference is added.

What is stored, as parts of one ``VersionedTable``, so that a day is there whole or not at all:

* ``facts``: what has arrived, by customer, day and product, as long as it can matter;
* ``running``: the running values at the end of the last day;
* ``pending``: changes of later days, as they were made;
* ``snapshots``: feature rows of the days, and ``corrections``: rows that take the place of
  earlier ones, for customers with facts that arrived late.

Only customers with late facts are recomputed, from their stored facts, from the day of the
first late fact on.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapsewise.config import BuildConfig
from lapsewise.functions import midnight, to_cents
from lapsewise.operators.trailing import (
    FACTS,
    RUNNING,
    daily_changes,
    entering_and_leaving,
    snapshots_between,
)
from lapsewise.sources import stage
from lapsewise.sources.versions import Version, VersionedTable, sequence_of

#: Rows of corrections that may be broadcast.
SMALL = 250_000
#: Parts of one kind beyond which they are written anew as one.
MOST_PARTS = 32
#: Columns of arrived facts beside the customer's key.
_ARRIVED = "day date, product_id bigint, category string, n_orders bigint, n_items bigint, cents bigint"


def arrived_facts(orders_view: DataFrame, items_view: DataFrame, products: DataFrame) -> DataFrame:
    """New orders and items by customer, day and product; orders stand without a product."""
    known = "customer_id IS NOT NULL AND order_date IS NOT NULL"
    nothing = F.lit(0).cast("bigint")
    orders = (
        orders_view.where(known)
        .groupBy("customer_id", F.col("order_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .withColumns(
            {
                "product_id": F.lit(None).cast("bigint"),
                "category": F.lit(None).cast("string"),
                "n_items": nothing,
                "cents": nothing,
            }
        )
    )
    items = (
        items_view.where(known)
        .groupBy("customer_id", F.col("order_date").alias("day"), "product_id")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.coalesce(F.sum(to_cents(F.col("sale_price"))), F.lit(0)).alias("cents"),
        )
        .join(products.select(F.col("id").alias("product_id"), "category"), "product_id", "left")
        .withColumn("n_orders", nothing)
    )
    return orders.unionByName(items).select(
        "customer_id", "day", "product_id", "category", "n_orders", "n_items", "cents"
    )


def _held(facts: DataFrame, name: str, key: str, cfg: BuildConfig) -> DataFrame:
    """(customer, day, <name>_in, <name>_out) of the items among the facts."""
    days = facts.where(f"n_items > 0 AND {key} IS NOT NULL").select("customer_id", key, "day").distinct()
    return entering_and_leaving(days, name, key, cfg).select("customer_id", "day", f"{name}_in", f"{name}_out")


def _as_facts(df: DataFrame) -> DataFrame:
    return df.select("customer_id", "day", *(F.col(c) if c in df.columns else F.lit(0).cast("bigint").alias(c) for c in FACTS))


def all_changes(facts: DataFrame, cfg: BuildConfig) -> DataFrame:
    """The changes of whole customers' facts."""
    parts = [facts, _held(facts, "products", "product_id", cfg), _held(facts, "categories", "category", cfg)]
    return daily_changes(reduce(DataFrame.unionByName, map(_as_facts, parts)), cfg)


def added_changes(new: DataFrame, known: DataFrame, cfg: BuildConfig) -> DataFrame:
    """The changes that ``new`` facts make to those of the ``known`` ones.

    ``known`` may leave out facts more than a window before the first new one.
    """
    parts = [new]
    for name, key in (("products", "product_id"), ("categories", "category")):
        touched = new.where(f"n_items > 0 AND {key} IS NOT NULL").select("customer_id", key).distinct()
        before = known.join(touched, ["customer_id", key], "left_semi")
        with_new = before.unionByName(new, allowMissingColumns=True)
        less = _held(before, name, key, cfg).selectExpr(
            "customer_id", "day", f"-{name}_in AS {name}_in", f"-{name}_out AS {name}_out"
        )
        parts += [_held(with_new, name, key, cfg), less]
    return daily_changes(reduce(DataFrame.unionByName, map(_as_facts, parts)), cfg)


class SnapshotHistory:
    """Feature snapshots from the day ``first`` on, brought up to date by ``advance``.

    The rows of a day are those that a build with ``as_of`` on that day gives for it, of
    all facts that have arrived, not older than the lookback of the first day added at their
    arrival.  Their products' categories are those at the arrival.
    """

    def __init__(self, spark: SparkSession, path: str, cfg: BuildConfig, first: date):
        if cfg.fanout != "corrected" or cfg.step_days != 1:
            raise ValueError("only daily snapshots of true counts can be carried on")
        if cfg.long_days > 28 * cfg.lookback_months:
            raise ValueError("the lookback must hold the longest window")
        self.spark, self.cfg, self.first = spark, cfg, first
        self.table = VersionedTable(spark, path)

    # -- reading -------------------------------------------------------------

    def last(self) -> date | None:
        """The last day that has snapshots."""
        version = self.table.version()
        return None if version is None else date.fromisoformat(version.notes["last"])

    def read(self) -> DataFrame:
        """All snapshots, each customer and day once."""
        version = self.table.version()
        if version is None:
            raise LookupError(f"no snapshots under {self.table.path}")
        rows = self._frame(version, "snapshots", version.schema)
        late = [p for p in version.parts if p["kind"] == "corrections"]
        key = ["customer_id", "feature_timestamp"]
        # The newest correction of a row stands, in the order of the commits.
        for part in late:
            better = self.table.frame(version, [part])
            gone = better.select(*key)
            rows = rows.join(F.broadcast(gone) if part["rows"] <= SMALL else gone, key, "left_anti").unionByName(better)
        return rows

    def _frame(self, version: Version | None, kind: str, schema: str | StructType) -> DataFrame:
        parts = [] if version is None else [p for p in version.parts if p["kind"] == kind]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.table.frame(version, parts, schema)

    # -- advancing -------------------------------------------------------------

    def advance(self, batch: str, orders_view: DataFrame, items_view: DataFrame, products: DataFrame, as_of: date) -> None:
        """Takes in what has arrived and adds the days up to ``as_of``.

        ``batch`` is a name and a number that grows (``daily-7``); a number that was taken in
        before is skipped, so replays are harmless.
        """
        stream, number = sequence_of(batch)
        version = self.table.version()
        streams = version.notes["streams"] if version else {}
        if streams.get(stream, -1) >= number:
            return
        last = date.fromisoformat(version.notes["last"]) if version else self.first - timedelta(days=1)
        if as_of < last:
            raise ValueError(f"snapshots reach {last} already")
        cfg = self.cfg.with_(as_of=as_of)
        oldest = f"add_months(DATE '{as_of}', {-cfg.lookback_months})"
        key_type = orders_view.schema["customer_id"].dataType.simpleString()
        facts_schema = f"customer_id {key_type}, {_ARRIVED}"
        changes_schema = f"customer_id {key_type}, day date, {', '.join(f'{c} bigint' for c in RUNNING)}, order_day date"

        # The first of the new days looks back farthest.
        looked = f"add_months(DATE '{min(as_of, last + timedelta(days=1))}', {-cfg.lookback_months})"
        new = stage(arrived_facts(orders_view, items_view, products).where(f"day >= {looked}"), "arrived")
        low, high = new.agg(F.min("day"), F.max("day")).first()
        known = self._frame(version, "facts", facts_schema)
        near = known.where(F.col("day") >= F.lit(low) - F.expr(f"INTERVAL {cfg.long_days} DAY")) if low else known
        changes = stage(added_changes(new, near, cfg), "changes").select("customer_id", "day", *RUNNING, "order_day")

        # Running values stand as changes of the last day, and so does what is late.
        day = F.lit(last)
        running = self._frame(version, "running", changes_schema)
        due = self._frame(version, "pending", changes_schema).where((F.col("day") > day) & (F.col("day") <= F.lit(as_of)))
        moved = running.unionByName(due).unionByName(
            changes.where(F.col("day") <= F.lit(as_of)).withColumn("day", F.greatest("day", day))
        )
        sums = [*(F.sum(c).alias(c) for c in RUNNING), F.max("order_day").alias("order_day")]
        moved = moved.repartition("customer_id").groupBy("customer_id", "day").agg(*sums)

        parts = []
        if as_of > last:
            made = snapshots_between(moved, cfg, f"DATE '{last + timedelta(days=1)}'", f"DATE '{as_of}'")
            schema = made.schema
            parts.append(self._part("snapshots", self._recent(made, cfg)))
        else:
            schema = version.schema if version else snapshots_between(moved, cfg, "NULL", "NULL").schema
        if low is not None and low <= last and last >= self.first:
            parts.append(self._part("corrections", self._corrected(new, known, last, cfg)))
        if low is not None:
            parts.append({**self._part("facts", new, sort_by=["day"]), "high": high.isoformat()})
            later = changes.where(F.col("day") > F.lit(as_of))
            due_last = high + timedelta(days=cfg.long_days)
            parts.append({**self._part("pending", later, sort_by=["day"]), "high": due_last.isoformat()})
        kept = F.col("order_day") >= F.expr(oldest)
        now = moved.groupBy("customer_id").agg(*sums).withColumn("day", F.lit(as_of))
        moving = reduce(lambda a, b: a | b, (F.col(c) != 0 for c in RUNNING))
        parts.append(self._part("running", now.where(kept | moving).select("customer_id", "day", *RUNNING, "order_day")))

        # Facts matter for two lookbacks: a late one is corrected by those before it.
        reach = self.spark.range(1).select(F.add_months(F.lit(as_of), -2 * cfg.lookback_months)).first()[0]
        bounds = {"facts": reach, "pending": as_of}
        before = [
            p
            for p in (version.parts if version else ())
            if p["kind"] != "running" and (p["kind"] not in bounds or p["high"] > bounds[p["kind"]].isoformat())
        ]
        before = self._gathered(version, before, {"facts": facts_schema, "pending": changes_schema}, bounds)
        notes = {"last": as_of.isoformat(), "streams": {**streams, stream: number}}
        self.table.commit(version, [*before, *parts], schema, notes)
        self.table.expire(keep=4)

    def _part(self, kind: str, rows: DataFrame, sort_by: Sequence[str] = ()) -> dict:
        if sort_by:
            rows = rows.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        path = self.table.write(rows)
        return {"kind": kind, "path": path, "rows": self.spark.read.schema(rows.schema).parquet(f"{self.table.path}/{path}").count()}

    def _gathered(self, version: Version | None, parts: list[dict], schemas: dict[str, str], bounds: dict[str, date]) -> list[dict]:
        """Parts of a kind that have become many, as one."""
        for kind, schema in schemas.items():
            many = [p for p in parts if p["kind"] == kind]
            if len(many) > MOST_PARTS:
                rows = self.table.frame(version, many, schema).where(F.col("day") > F.lit(bounds[kind]))
                one = {**self._part(kind, rows, ["day"]), "high": max(p["high"] for p in many)}
                parts = [*(p for p in parts if p["kind"] != kind), one]
        return parts

    def _recent(self, rows: DataFrame, cfg: BuildConfig) -> DataFrame:
        """Rows whose last order lies within the lookback of their own day."""
        snapshot = F.to_date("feature_timestamp")
        ordered = F.date_sub(snapshot, F.col("days_since_last_order").cast("int"))
        return rows.where(ordered >= F.add_months(snapshot, -cfg.lookback_months))

    def _corrected(self, new: DataFrame, known: DataFrame, last: date, cfg: BuildConfig) -> DataFrame:
        """Snapshots up to ``last`` of the customers with late facts, each from its first late day on."""
        late = new.where(F.col("day") <= F.lit(last)).groupBy("customer_id").agg(F.min("day").alias("since"))
        facts = known.unionByName(new).join(late.select("customer_id"), "customer_id", "left_semi")
        rows = snapshots_between(all_changes(facts, cfg), cfg, f"DATE '{self.first}'", f"DATE '{last}'")
        changed = rows.join(late, "customer_id").where(F.col("feature_timestamp") >= midnight(F.col("since")))
        return self._recent(changed.drop("since"), cfg)
