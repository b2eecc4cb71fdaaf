from datetime import datetime, timedelta

import pytest
from local import frame

from lapsewise.plans.store import FeatureRegistry, FeatureSpec, ServingTable
from lapsewise.streaming import incremental_sync

SPEC = FeatureSpec("group", "customer_id", "feature_timestamp", ("a", "b"))
DDL = "customer_id bigint, feature_timestamp timestamp_ntz, a bigint, b double"
T0 = datetime(2024, 1, 1)


def day(n):
    return T0 + timedelta(days=n)


def served(table):
    return {r["customer_id"]: (r["feature_timestamp"], r["a"], r["b"]) for r in table.read().collect()}


def test_status_sync_and_lookups(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC)
    assert table.sync_status().first()["status"] == "NO_SYNC"
    with pytest.raises(LookupError):
        table.read()

    table.sync(frame(spark, [(1, day(0), 1, 1.0), (1, day(2), 2, None), (2, day(1), 3, 3.0)], DDL))
    assert served(table) == {1: (day(2), 2, None), 2: (day(1), 3, 3.0)}
    status = table.sync_status().first()
    assert (status["status"], status["row_synced"]) == ("COMPLETED", 2)
    assert status["end_time"] >= status["start_time"]

    assert table.fetch(2).first().asDict() == {"customer_id": 2, "a": 3, "b": 3.0}
    assert table.fetch(2, ["b"]).columns == ["customer_id", "b"]
    assert table.fetch(99).isEmpty()
    many = table.fetch_many(frame(spark, [(1,), (99,)], "customer_id bigint"))
    got = {r["customer_id"]: (r["a"], r["status"], r["error"] is None) for r in many.collect()}
    assert got == {1: (2, "success", True), 99: (None, "error", False)}

    # A full sync replaces everything, also with fewer entities.
    table.sync(frame(spark, [(5, day(0), 9, 9.0)], DDL))
    assert set(served(table)) == {5}


def test_failed_and_running_syncs_keep_the_previous_table(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC)
    table.sync(frame(spark, [(1, day(0), 1, 1.0)], DDL))
    with pytest.raises(Exception):
        bad = frame(spark, [(2, day(0), 1, 1.0)], DDL).selectExpr(
            "customer_id", "feature_timestamp", "bigint(raise_error('broken')) AS a", "b"
        )
        table.sync(bad)
    assert table.sync_status().first()["status"] == "ERROR"
    assert set(served(table)) == {1}
    table._append("later", "IN_PROGRESS", start=datetime.now() + timedelta(days=1))
    assert table.sync_status().first()["status"] == "IN_PROGRESS"
    assert set(served(table)) == {1}


def test_merge_late_equal_and_replayed_rows(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC)
    table.merge("s-0", frame(spark, [(1, day(5), 5, 5.0), (2, day(5), 5, 5.0)], DDL))
    table.merge("s-1", frame(spark, [(1, day(4), 4, 4.0), (2, day(5), 6, None), (3, day(0), 1, 1.0)], DDL))
    want = {1: (day(5), 5, 5.0), 2: (day(5), 6, None), 3: (day(0), 1, 1.0)}
    assert served(table) == want
    table.merge("s-1", frame(spark, [(1, day(9), 9, 9.0)], DDL))  # replay of a done batch
    assert served(table) == want


def test_stream_ends_where_a_full_sync_does(spark, tmp_path):
    files, where = str(tmp_path / "in"), str(tmp_path / "progress")
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC)
    rows = [(c, day(d), 10 * c + d, float(d)) for c in range(20) for d in range(c % 3, 9)]
    everything = frame(spark, rows, DDL)
    for part in ("day(feature_timestamp) BETWEEN 4 AND 6", "day(feature_timestamp) > 6", "day(feature_timestamp) < 4"):
        everything.where(part).coalesce(1).write.mode("append").parquet(files)
        incremental_sync(table, files, everything.schema, where)
    full = {r["customer_id"]: (r["feature_timestamp"], r["a"], r["b"]) for r in table.latest(everything).collect()}
    assert served(table) == full
    incremental_sync(table, files, everything.schema, where)  # nothing new
    assert served(table) == full
    # Another stream counts its batches from zero again and is not mistaken for this one.
    incremental_sync(table, files, everything.schema, str(tmp_path / "other"), files_per_batch=1)
    assert served(table) == full


def test_registry_and_views(spark):
    registry = FeatureRegistry()
    assert registry.register(SPEC) is registry.register(FeatureSpec("group", "x", "y", ()))
    assert registry.add_features("group", ["b", "c"]).features == ("a", "b", "c")
    source = frame(spark, [(1, day(0), 1, None)], DDL)
    assert SPEC.view(source, ["b"]).columns == ["customer_id", "feature_timestamp", "b"]
    with pytest.raises(ValueError):
        SPEC.view(source, ["nope"])
    with pytest.raises(ValueError):
        SPEC.validate(source.drop("a"))
    profile = {r["feature"]: (r["data_type"], r["values"]) for r in SPEC.profile(source).collect()}
    assert profile == {"a": ("bigint", 1), "b": ("double", 0)}
