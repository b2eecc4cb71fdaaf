import threading

import pytest
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType, TimestampNTZType

from lapsewise.plans.registry import SpecConflict, StoredRegistry
from lapsewise.plans.store import FeatureSpec


def schema(**types):
    made = StructType()
    for name, kind in {"customer_id": LongType(), "at": TimestampNTZType(), **types}.items():
        made.add(name, kind)
    return made


SOURCE = schema(a=LongType(), b=DoubleType(), c=StringType(), d=IntegerType())
SPEC = FeatureSpec("group", "customer_id", "at", ("a",))


def test_registering_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "registry")
    first = StoredRegistry(spark, path)
    assert first.names() == [] and first.history().isEmpty()
    with pytest.raises(LookupError):
        first.get("group")
    assert first.register(SPEC, SOURCE) == SPEC
    second = StoredRegistry(spark.newSession(), path)  # another session finds it
    assert second.register(FeatureSpec("group", "customer_id", "at", ("b",)), SOURCE) == SPEC
    assert second.table.numbers() == [1]
    assert second.add_features("group", ["a", "b"], SOURCE).features == ("a", "b")
    assert first.add_features("group", ["b"], SOURCE).features == ("a", "b")
    assert first.get("group").features == ("a", "b") and first.table.numbers() == [1, 2]
    rows = [tuple(r) for r in first.history().orderBy("version", "feature").collect()]
    assert rows == [
        (1, "group", "customer_id", "at", "a", "bigint"),
        (2, "group", "customer_id", "at", "a", "bigint"),
        (2, "group", "customer_id", "at", "b", "double"),
    ]


def test_changed_types_and_keys_are_refused(spark, tmp_path):
    registry = StoredRegistry(spark, str(tmp_path / "registry"))
    registry.register(SPEC, SOURCE)
    other = schema(a=DoubleType(), b=DoubleType())
    with pytest.raises(SpecConflict, match="bigint, not double"):
        registry.add_features("group", ["b", "a"], other)
    with pytest.raises(SpecConflict):
        registry.register(FeatureSpec("group", "c", "at", ()), SOURCE)
    with pytest.raises(SpecConflict):
        registry.register(SPEC, schema(customer_id=StringType(), a=LongType()))
    with pytest.raises(ValueError, match="lacks 'z'"):
        registry.add_features("group", ["z"], SOURCE)
    with pytest.raises(LookupError):
        registry.add_features("none", ["a"], SOURCE)
    assert registry.get("group") == SPEC and registry.table.numbers() == [1]


def test_groups_without_features(spark, tmp_path):
    registry = StoredRegistry(spark, str(tmp_path / "registry"))
    registry.register(FeatureSpec("empty", "customer_id", "at", ()), SOURCE)
    assert [tuple(r) for r in registry.history().collect()] == [(1, "empty", "customer_id", "at", None, None)]


def test_sessions_that_register_at_once(spark, tmp_path):
    path = str(tmp_path / "registry")
    StoredRegistry(spark, path).register(SPEC, SOURCE)

    def work(feature):
        StoredRegistry(spark, path).add_features("group", [feature], SOURCE)
        StoredRegistry(spark, path).register(FeatureSpec(feature, "customer_id", "at", (feature,)), SOURCE)

    threads = [threading.Thread(target=work, args=(f,)) for f in "abcd"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    registry = StoredRegistry(spark, path)
    assert set(registry.get("group").features) == set("abcd") and registry.names() == ["a", "b", "c", "d", "group"]
    assert registry.table.numbers() == list(range(1, 9))
