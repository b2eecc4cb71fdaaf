"""Reading and writing of the build's tables."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterable, Mapping, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.sources.versions import VersionedTable, is_versioned, open_table

SPLITS = ("train", "valid", "test")


@cache
def _local_stage_dir() -> str:
    """Stand-in for single-machine runs, where no shared folder is configured."""
    return tempfile.mkdtemp(prefix="lapsewise-stage-")


_made: set[str] = set()


def _application_dir(spark: SparkSession, base: str) -> str:
    """One folder an application, removed when its JVM ends."""
    folder = f"{base.rstrip('/')}/lapsewise/{spark.sparkContext.applicationId}"
    if folder not in _made:
        location = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = location.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(location)
        files.deleteOnExit(location)
        _made.add(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on this machine alone may do without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("executors on other machines need a shared folder: set spark.checkpoint.dir")
        base = _local_stage_dir()
    return f"{_application_dir(spark, base)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared checkpoint folder and read it back.

    Used where a result feeds several jobs.  Unlike a cached frame the copy
    outlives lost executors, and unlike an RDD checkpoint it keeps column
    pruning and filter pushdown for its readers.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    _staged[staged] = path
    return staged


_staged: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def unstage(*frames: DataFrame) -> None:
    """Removes the copies that ``stage`` wrote of ``frames``, and which nothing will read again.

    What was made from them must be staged itself or done with.  Other frames are left alone.
    """
    for df in frames:
        path = _staged.pop(df, None)
        if path is not None:
            location = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(location, True)


def read_table(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """The whole table at ``path``; raises when required columns are missing."""
    df = open_table(spark, path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns in {path}: {missing}")
    return df


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace the session view ``name``."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def replace_table(
    df: DataFrame,
    path: str,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Rebuild the table at ``path`` in one step: see ``VersionedTable.replace``."""
    return VersionedTable(df.sparkSession, path).replace(df, order_by, partition_by)


def replace_bucketed_table(
    df: DataFrame, name: str, buckets: int, key: str, sort_by: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Rebuild the catalog table ``name`` bucketed by ``key``, below ``path`` or in the warehouse.

    Tables with the same key and bucket count join on it without a shuffle, and any other
    joins on it with a shuffle of its own rows alone.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(key, *sort_by).saveAsTable(name)
    return df.sparkSession.table(name)


def write_splits(df: DataFrame, path: str) -> None:
    """Write the train, valid and test parts, told apart by the ``split`` column, in one step."""
    VersionedTable(df.sparkSession, path).replace(df, partition_by=["split"])


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One part of a written split; raises ``FileNotFoundError`` when it is missing."""
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}")
    table = VersionedTable(spark, path)
    version = table.version()
    part = None if version is None else f"{table.path}/{version.parts[0]['path']}/split={split}"
    if part is None or not path_exists(spark, part):
        raise FileNotFoundError(f"no {split} data under {path}")
    return spark.read.parquet(part)


def write_sidecar(row: DataFrame, path: str) -> None:
    """Write a one-row frame (metadata, metrics) as JSON next to the data."""
    row.coalesce(1).write.mode("overwrite").json(path)


def build_report(spark: SparkSession, tables: Mapping[str, DataFrame | str | None]) -> DataFrame:
    """Row count of each table, by frame or path; an absent table is flagged, not an error."""
    parts = []
    for name, table in tables.items():
        if isinstance(table, str):
            known = is_versioned(spark, table) or path_exists(spark, table)
            table = open_table(spark, table) if known else None
        if table is None:
            part = spark.range(1).select(
                F.lit(name).alias("table_name"),
                F.lit(None).cast("bigint").alias("num_rows"),
                F.lit("absent").alias("status"),
            )
        else:
            part = table.agg(F.count(F.lit(1)).alias("num_rows")).select(
                F.lit(name).alias("table_name"), "num_rows", F.lit("present").alias("status")
            )
        parts.append(part)
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
