"""The serving table as base and deltas, against a plain dictionary."""

import random
import threading
from datetime import datetime, timedelta

import pytest
from local import frame

from lapsewise.plans import store
from lapsewise.plans.store import FeatureSpec, ServingTable
from lapsewise.streaming import incremental_sync

SPEC = FeatureSpec("group", "customer_id", "feature_timestamp", ("a", "b"))
DDL = "customer_id bigint, feature_timestamp timestamp_ntz, a bigint, b double"
T0 = datetime(2024, 1, 1)


def day(n):
    return T0 + timedelta(days=n)


def served(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def fold(state, rows):
    """The plain table: the batch's latest row an entity replaces what is not newer."""
    newest = {}
    for key, when, *values in rows:
        if key not in newest or when > newest[key][0]:
            newest[key] = (when, *values)
    for key, row in newest.items():
        if key not in state or row[0] >= state[key][0]:
            state[key] = row


def batch(draw, step, keys, size):
    """Rows of one batch; an entity has one row a day, so that no two of a batch tie."""
    days = {(draw.choice(keys), draw.randint(0, 12)) for _ in range(size)}
    return [(k, day(d), 1000 * step + d, draw.choice([None, d / 2])) for k, d in days]


@pytest.mark.parametrize(
    "settings, small",
    [
        ({}, None),
        ({"share": 1e9, "max_deltas": 63}, None),  # nothing is ever rewritten
        ({"share": 1e9, "max_deltas": 2, "ranges": 3}, None),  # deltas are folded
        ({"share": 0.0}, None),  # every delta is rewritten at once
        ({"share": 1e9, "max_deltas": 63}, 0),  # deltas too large to be broadcast
        ({"share": 0.5, "ranges": 1}, 5),  # ranges are cut anew
    ],
)
def test_any_order_of_batches(spark, tmp_path, monkeypatch, settings, small):
    if small is not None:
        monkeypatch.setattr(store, "SMALL", small)
    draw = random.Random(3)
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC, **settings)
    state = {}
    for step in range(6):
        keys = [None, *range(-5, 40 + 30 * step)] if step % 2 else list(range(10))
        rows = batch(draw, step, keys, draw.choice([1, 5, 60]) if step else 40)
        table.merge(f"s-{step}", frame(spark, rows, DDL))
        fold(state, rows)
        assert served(table.read()) == state
    for key in (0, 7, 39, -5, 10**6):
        found = [tuple(r) for r in table.fetch(key).collect()]
        assert found == ([(key, *state[key][1:])] if key in state else [])
    table.merge("s-3", frame(spark, [(1, day(90), 0, 0.0)], DDL))  # a replay
    table.merge("t-0", frame(spark, [], DDL))
    assert served(table.read()) == state
    table.compact(everything=True)
    assert served(table.read()) == state and not [p for p in table.table.version().parts if p["seq"]]
    table.sync(frame(spark, [(1, day(0), 1, 1.0)], DDL))
    assert served(table.read()) == {1: (day(0), 1, 1.0)}


def test_string_keys(spark, tmp_path):
    spec = FeatureSpec("group", "name", "t", ("v",))
    ddl = "name string, t timestamp_ntz, v bigint"
    table = ServingTable(spark, str(tmp_path / "serving"), spec, share=1e9)
    names = ["", "Zoë", "a", "ab", "b", "é", "z", "10", "9", "名"]
    table.merge("s-0", frame(spark, [(n, day(1), i) for i, n in enumerate(names)], ddl))
    table.merge("s-1", frame(spark, [("ab", day(0), 50), ("é", day(2), 60), ("aa", day(0), 70)], ddl))
    want = {n: i for i, n in enumerate(names)} | {"é": 60, "aa": 70}
    assert {r["name"]: r["v"] for r in table.read().collect()} == want
    assert table.fetch("é").first()["v"] == 60 and table.fetch("x").isEmpty()
    table.compact(everything=True)
    assert {r["name"]: r["v"] for r in table.read().collect()} == want


def written(table):
    """Bytes of each data directory."""
    return {n: table.table.folder.size(f"data/{n}") for n, _ in table.table.folder.names("data")}


def test_bytes_written_follow_the_batch(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC)
    columns = "id AS customer_id, TIMESTAMP_NTZ'2024-01-01' AS feature_timestamp, hash(id) * 7L AS a, rand(1) AS b"
    table.sync(spark.range(200_000).selectExpr(*columns.split(", ")))
    base = written(table)
    before = sum(base.values())
    for step in range(3):
        late = spark.range(step * 1000, step * 1000 + 50).selectExpr(*columns.replace("2024-01-01", f"2024-01-0{2 + step}").split(", "))
        table.merge(f"s-{step}", late)
    new = {n: size for n, size in written(table).items() if n not in base}
    assert len(new) == 3 and sum(new.values()) < before / 100
    assert set(base) <= set(written(table))
    # A batch that outgrows its share of one range has that range rewritten, and no other.
    many = spark.range(10_000).selectExpr(*columns.replace("2024-01-01", "2024-02-01").split(", "))
    kept = {p["path"] for p in table.table.version().parts if not p["seq"]}
    table.merge("s-9", many)
    parts = table.table.version().parts
    assert len(kept - {p["path"] for p in parts}) == 1
    assert table.read().count() == 200_000
    assert table.read().where("feature_timestamp = TIMESTAMP_NTZ'2024-02-01'").count() == 10_000


def test_the_base_is_not_shuffled_to_be_read(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC, share=1e9)
    table.sync(frame(spark, [(i, day(0), i, 1.0) for i in range(50)], DDL))
    table.merge("s-0", frame(spark, [(3, day(1), 0, 0.0)], DDL))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "BroadcastNestedLoop" not in plan
    files = table.fetch(3).inputFiles()
    assert 0 < len(files) < len(table.read().inputFiles())


def test_requests_alone_are_shuffled_to_a_bucketed_table(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC, share=1e9)
    table.sync(frame(spark, [(i, day(0), i, 1.0) for i in range(0, 400, 2)], DDL))
    table.merge("s-0", frame(spark, [(4, day(1), -4, 0.5), (401, day(1), 7, 0.0)], DDL))
    served_by = table.bucketed("serving_for_requests", 4)
    keys = frame(spark, [(i,) for i in range(403)], "customer_id bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = store.fetch_many(served_by, keys, SPEC)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert rows == sorted(map(tuple, table.fetch_many(keys).collect()))
    assert rows[4] == (4, -4, 0.5, "success", None) and rows[5][3] == "error"
    spark.sql(f"DROP TABLE serving_for_requests_{table.table.version().number}")


def test_versions_that_no_reader_needs_go(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC, share=0.0, keep=2)
    table.merge("s-0", frame(spark, [(1, day(0), 1, 1.0)], DDL))
    with table.pinned() as held:
        for step in range(1, 5):
            table.merge(f"s-{step}", frame(spark, [(1, day(step), step, 1.0)], DDL))
        assert served(held) == {1: (day(0), 1, 1.0)}
        assert len(table.table.numbers()) == 3
    table.merge("s-5", frame(spark, [(1, day(9), 9, 1.0)], DDL))
    assert len(table.table.numbers()) == 2 and len(written(table)) <= 3
    assert served(table.read()) == {1: (day(9), 9, 1.0)}


def test_writers_at_once(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC, share=0.3)
    table.sync(frame(spark, [(i, day(0), 0, 0.0) for i in range(30)], DDL))

    def work(name):
        own = ServingTable(spark, table.path, SPEC, share=0.3)
        for step in range(3):
            own.merge(f"{name}-{step}", frame(spark, [(i, day(step + 1), name, 0.0) for i in range(10 * name, 10 * name + 5)], DDL))

    threads = [threading.Thread(target=work, args=(n,)) for n in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    want = {i: (day(3), i // 10, 0.0) if i % 10 < 5 else (day(0), 0, 0.0) for i in range(30)}
    assert served(table.read()) == want
    assert table.table.version().notes["streams"] == {"0": 2, "1": 2, "2": 2}


def test_failed_merge_leaves_the_table(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC)
    table.merge("s-0", frame(spark, [(1, day(0), 1, 1.0)], DDL))
    bad = frame(spark, [(2, day(0), 1, 1.0)], DDL).selectExpr(
        "customer_id", "feature_timestamp", "bigint(raise_error('broken')) AS a", "b"
    )
    with pytest.raises(Exception):
        table.merge("s-1", bad)
    assert table.sync_status().first()["status"] == "ERROR"
    assert served(table.read()) == {1: (day(0), 1, 1.0)}
    table.merge("s-1", frame(spark, [(2, day(0), 2, 2.0)], DDL))  # not taken for done
    assert set(served(table.read())) == {1, 2}
    assert [r["state"] for r in table.log().orderBy("start_time").collect()] == ["COMPLETED", "ERROR", "COMPLETED"]


def test_stream_into_ranges(spark, tmp_path):
    files, where = str(tmp_path / "in"), str(tmp_path / "progress")
    table = ServingTable(spark, str(tmp_path / "serving"), SPEC, max_deltas=1, share=0.6)
    rows = [(c, day(d), 10 * c + d, float(d)) for c in range(40) for d in range(c % 3, 6)]
    everything = frame(spark, rows, DDL)
    for part in ("customer_id % 4 = 0", "customer_id < 9", "day(feature_timestamp) > 3", "true"):
        everything.where(part).coalesce(1).write.mode("append").parquet(files)
        incremental_sync(table, files, everything.schema, where)
    assert served(table.read()) == served(table.latest(everything))
