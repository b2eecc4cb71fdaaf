"""Tables whose every change is a new version: immutable data under a commit pointer.

``path/data`` holds directories of Parquet files, each written once by one job;
``path/_versions`` holds one small JSON file a version that names the directories the
version consists of.  The newest file is the pointer.  It is made by renaming a finished
file to a name that must not exist yet, so a version appears whole or not at all:

* a write that fails, or a driver that dies, leaves the newest version as it was;
* a reader that has opened a version goes on reading its files while others commit;
* of two writers that prepare the same version one is refused.

Directories that no kept version names, those of failed writes too, go with ``expire``.
The rename must refuse an existing target, as it does on HDFS and local disks; on a store
without such a rename the writers of one table have to take turns.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_VERSION = re.compile(r"(\d{12})\.json")


class CommitConflict(RuntimeError):
    """Another writer has committed the version that this one prepared."""


class Folder:
    """The few file operations of a commit, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, name: str = ""):
        return self._hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _files(self):
        return self._at().getFileSystem(self._conf)

    def names(self, name: str = "") -> list[tuple[str, float]]:
        """(name, time of change in seconds) of what lies in a folder; nothing if it is missing."""
        at, files = self._at(name), self._files()
        if not files.exists(at):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in files.listStatus(at)]

    def size(self, name: str) -> int:
        return self._files().getContentSummary(self._at(name)).getLength()

    def read(self, name: str) -> str:
        stream = self._files().open(self._at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Writes or replaces a file."""
        stream = self._files().create(self._at(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Writes a file that does not exist yet, whole or not at all; False if it exists."""
        draft = f"_draft-{uuid.uuid4().hex}"
        self.write(draft, text)
        target, files = self._at(name), self._files()
        files.mkdirs(target.getParent())
        context = self._hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(
            getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0
        )
        try:
            context.rename(files.makeQualified(self._at(draft)), files.makeQualified(target), options)
        except Py4JJavaError as error:
            self.delete(draft)
            if files.exists(target):
                return False
            raise error
        return True

    def delete(self, name: str = "") -> None:
        self._files().delete(self._at(name), True)


@dataclass(frozen=True)
class Version:
    """What one commit says: its parts (each with a ``path`` below the table), schema and notes."""

    number: int
    parts: tuple[dict, ...]
    schema: StructType
    notes: dict = field(default_factory=dict)

    def dump(self) -> str:
        return json.dumps(
            {"number": self.number, "parts": self.parts, "schema": self.schema.jsonValue(), "notes": self.notes}
        )

    @staticmethod
    def load(text: str) -> "Version":
        held = json.loads(text)
        return Version(held["number"], tuple(held["parts"]), StructType.fromJson(held["schema"]), held["notes"])


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = Folder(spark, self.path)

    # -- versions -----------------------------------------------------------

    def numbers(self) -> list[int]:
        """The versions that can be read, oldest first."""
        found = (_VERSION.fullmatch(name) for name, _ in self.folder.names("_versions"))
        return sorted(int(m[1]) for m in found if m)

    def version(self, number: int | None = None) -> Version | None:
        """One version, the newest by default; None if the table has none."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return None
            number = numbers[-1]
        try:
            return Version.load(self.folder.read(f"_versions/{number:012d}.json"))
        except Py4JJavaError as error:
            raise LookupError(f"{self.path} has no version {number}") from error

    def commit(self, after: Version | None, parts: Sequence[dict], schema: StructType, notes: dict | None = None) -> Version:
        """Makes the version that follows ``after``; raises ``CommitConflict`` if there is one already."""
        made = Version((after.number if after else 0) + 1, tuple(parts), schema, notes or {})
        if not self.folder.write_new(f"_versions/{made.number:012d}.json", made.dump()):
            raise CommitConflict(f"{self.path}: version {made.number} exists")
        return made

    # -- data ---------------------------------------------------------------

    def write(self, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Writes a new data directory, which belongs to no version yet; its path below the table."""
        name = f"data/{uuid.uuid4().hex}"
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/{name}")
        return name

    def frame(self, version: Version, parts: Sequence[dict] | None = None, schema: StructType | str | None = None) -> DataFrame:
        """The rows of some of a version's parts, of all by default."""
        paths = [f"{self.path}/{p['path']}" for p in (version.parts if parts is None else parts)]
        schema = version.schema if schema is None else schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, number: int | None = None) -> DataFrame:
        """The table as of a version; later commits do not change what this frame reads."""
        version = self.version(number)
        if version is None:
            raise LookupError(f"no version of {self.path}")
        return self.frame(version)

    def replace(
        self,
        df: DataFrame,
        order_by: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        notes: dict | None = None,
        measures: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """The table anew; ``df`` may read the present version.  Of two that replace, the later one stays.

        ``order_by`` range-partitions and sorts, so that files hold disjoint key
        ranges and their statistics prune later reads.  ``measures`` are aggregates of
        all rows, taken while these are written; ``measured`` returns them.
        """
        if order_by:
            keys = [*partition_by, *order_by]
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        schema, notes, seen = df.schema, dict(notes or {}), None
        if measures:
            # Last before the write, in the tasks whose results count once, however often they run.
            seen = Observation()
            df = df.observe(seen, *(m.cast("string").alias(name) for name, m in measures.items()))
        part = {"path": self.write(df, partition_by)}
        if seen is not None:
            notes["measured"] = seen.get
        while True:
            try:
                return self.frame(self.commit(self.version(), [part], schema, notes))
            except CommitConflict:
                continue

    def measured(self, types: Mapping[str, str], number: int | None = None) -> DataFrame:
        """One row of the measures taken when a version was written, by name and type."""
        version = self.version(number)
        held = version.notes.get("measured") if version else None
        if held is None or not set(types) <= set(held):
            raise LookupError(f"{self.path}: {sorted(types)} were not measured")
        return self.spark.range(1).select(*(F.lit(held[name]).cast(kind).alias(name) for name, kind in types.items()))

    # -- removal ------------------------------------------------------------

    @contextmanager
    def pinned(self, number: int | None = None) -> Iterator[DataFrame]:
        """The table as of a version, which ``expire`` leaves alone meanwhile."""
        version = self.version(number)
        if version is None:
            raise LookupError(f"no version of {self.path}")
        pin = f"_pins/{version.number}-{uuid.uuid4().hex}"
        self.folder.write(pin, "")
        try:
            yield self.frame(version)
        finally:
            self.folder.delete(pin)

    def expire(self, keep: int = 2, unnamed_seconds: float = 86_400, pin_seconds: float = 86_400) -> list[str]:
        """Removes all but the newest ``keep`` and the pinned versions; returns the data directories removed.

        Directories that no version left names go if they have not changed for
        ``unnamed_seconds``, longer than any write lasts.  Pins of readers that died count for
        ``pin_seconds``.
        """
        now = time.time()
        pins = {int(n.split("-")[0]) for n, at in self.folder.names("_pins") if now - at <= pin_seconds}
        numbers = self.numbers()
        kept = set(numbers[-max(1, keep) :]) | pins.intersection(numbers)
        named, gone = set(), set()
        for number in numbers:
            paths = {p["path"].split("/")[1] for p in self.version(number).parts}
            (named if number in kept else gone).update(paths)
        for number in set(numbers) - kept:
            self.folder.delete(f"_versions/{number:012d}.json")
        removed = []
        for name, at in self.folder.names("data"):
            if name not in named and (name in gone or now - at >= unnamed_seconds):
                self.folder.delete(f"data/{name}")
                removed.append(f"data/{name}")
        return removed


def sequence_of(name: str) -> tuple[str, int]:
    """A stream and a number of it, from ``stream-7``; a name without a number is a stream of its own."""
    stream, _, number = name.rpartition("-")
    return (stream, int(number)) if stream and number.isdecimal() else (name, 0)


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(VersionedTable(spark, path).numbers())


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the table at ``path``, or the Parquet files there if it has none."""
    table = VersionedTable(spark, path)
    version = table.version()
    return spark.read.parquet(path) if version is None else table.frame(version)
