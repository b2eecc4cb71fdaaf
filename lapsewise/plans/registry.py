"""A registry of feature groups that outlives its session.

Every change is a version of a ``VersionedTable`` that has notes and no data: the groups
with their keys, features and data types.  Versions are kept, so the registry tells what
was registered when; two sessions that change it at once take turns, the later one on top
of what the earlier one made.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lapsewise.plans.store import FeatureSpec
from lapsewise.sources.versions import CommitConflict, Version, VersionedTable

HISTORY_SCHEMA = (
    "version bigint, group_name string, entity_key string, time_column string, feature string, data_type string"
)


class SpecConflict(ValueError):
    """A group or feature that is registered already, otherwise."""


class StoredRegistry:
    """Feature groups by name; registering a name or feature again changes nothing.

    ``source`` is the schema of the group's table: names must be in it, and a feature
    keeps the data type it was registered with.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path)

    def _groups(self, version: Version | None) -> dict[str, dict]:
        return dict(version.notes["groups"]) if version else {}

    def _change(self, change: Callable[[dict[str, dict]], dict | None], name: str) -> FeatureSpec:
        """Commits what ``change`` makes of the group ``name``; nothing if that is what it is."""
        while True:
            version = self.table.version()
            groups = self._groups(version)
            group = change(groups)
            if group is not None and group != groups.get(name):
                try:
                    self.table.commit(version, [], StructType(), {"groups": {**groups, name: group}})
                except CommitConflict:
                    continue
            return self.get(name)

    def get(self, name: str) -> FeatureSpec:
        group = self._groups(self.table.version()).get(name)
        if group is None:
            raise LookupError(f"no feature group {name!r}")
        return FeatureSpec(name, group["entity_key"], group["time_column"], tuple(group["features"]))

    def names(self) -> list[str]:
        return sorted(self._groups(self.table.version()))

    def register(self, spec: FeatureSpec, source: StructType) -> FeatureSpec:
        """The group as it is registered; other keys than the registered ones are refused."""
        types = {c: _type_in(source, c, spec.name) for c in (spec.entity_key, spec.time_column, *spec.features)}
        keys = {c: types[c] for c in (spec.entity_key, spec.time_column)}

        def change(groups: dict[str, dict]) -> dict | None:
            known = groups.get(spec.name)
            if known is None:
                features = {c: types[c] for c in spec.features}
                return {"entity_key": spec.entity_key, "time_column": spec.time_column, "keys": keys, "features": features}
            if known["keys"] != keys:
                raise SpecConflict(f"{spec.name} is registered with {known['keys']}, not {keys}")
            return None

        return self._change(change, spec.name)

    def add_features(self, name: str, features: Sequence[str], source: StructType) -> FeatureSpec:
        """Adds features to a group; one that is there must have its type."""
        types = {c: _type_in(source, c, name) for c in features}

        def change(groups: dict[str, dict]) -> dict:
            if name not in groups:
                raise LookupError(f"no feature group {name!r}")
            known = groups[name]["features"]
            changed = [f"{c}: {known[c]}, not {t}" for c, t in types.items() if known.get(c, t) != t]
            if changed:
                raise SpecConflict(f"{name} has features of other types: {'; '.join(changed)}")
            return {**groups[name], "features": {**known, **types}}

        return self._change(change, name)

    def history(self) -> DataFrame:
        """A row for each feature of each group (null without any) as of every version."""
        rows = []
        for number in self.table.numbers():
            for name, group in sorted(self._groups(self.table.version(number)).items()):
                for feature, data_type in group["features"].items() or [(None, None)]:
                    rows.append((number, name, group["entity_key"], group["time_column"], feature, data_type))
        return self.spark.createDataFrame(rows, HISTORY_SCHEMA)


def _type_in(source: StructType, column: str, name: str) -> str:
    if column not in source.fieldNames():
        raise ValueError(f"{name}: source lacks {column!r}")
    return source[column].dataType.simpleString()
