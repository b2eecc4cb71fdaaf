"""Exact order statistics without sorting the data.

A positional cut needs one value only: the key of the last row before the cut.
It is found by counting rows in ever narrower bins, each pass one map-side
aggregation whose result has at most ``bins`` rows.  Rows are then placed by
comparing with that key, in a plain projection with no shuffle.

Many cuts at once, of many groups, cost no more passes than one: a mergeable quantile
sketch brackets every cut, and one grouped count makes all of them exact.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nth_smallest(df: DataFrame, column: str, rank: int, bins: int = 4096) -> tuple[int, int]:
    """The ``rank``-th smallest (from 1) of a bigint column, and the rows below it.

    Values must not be null and must span less than 2^63.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    below = 0
    while low is not None and low < high:
        width = (high - low) // bins + 1
        histogram = (
            df.where(F.col(column).between(low, high))
            .groupBy(F.call_function("div", F.col(column) - low, F.lit(width)).alias("bin"))
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.min(column).alias("low"),
                F.max(column).alias("high"),
            )
            .orderBy("bin")
            .collect()
        )
        for entry in histogram:
            if below + entry["rows"] >= rank:
                low, high = entry["low"], entry["high"]
                break
            below += entry["rows"]
        else:
            raise ValueError(f"rank {rank} exceeds the number of rows")
    if low is None:
        raise ValueError("no rows to select from")
    return low, below


@dataclass(frozen=True)
class CutPoint:
    """Key of the last row before a cut, by the columns that order the rows."""

    columns: tuple[str, ...]
    values: tuple[int, ...]

    def includes(self) -> Column:
        """True for rows before the cut."""
        if not self.values:
            return F.lit(False)
        name, value = self.columns[-1], self.values[-1]
        inside = F.col(name) <= value
        for name, value in reversed(list(zip(self.columns[:-1], self.values[:-1]))):
            inside = (F.col(name) < value) | ((F.col(name) == value) & inside)
        return inside


def cut_after(df: DataFrame, columns: Sequence[str], rank: int) -> CutPoint:
    """Where the first ``rank`` rows by ``columns`` (bigints, most significant first) end.

    Only the rows sharing the boundary value of one column are looked at for the
    next, so tied times, however many, cost one more filtered count.
    """
    if rank <= 0:
        return CutPoint(tuple(columns), ())
    values: list[int] = []
    for column in columns:
        value, below = nth_smallest(df, column, rank)
        values.append(value)
        df = df.where(F.col(column) == value)
        rank -= below
    if df.count() != rank:
        raise ValueError(f"rows tie on {list(columns)} across the cut; add a column to tell them apart")
    return CutPoint(tuple(columns), tuple(values))


@dataclass
class _Cut:
    """A cut being found: the rows it is among share ``values`` and number ``rows``."""

    group: int
    rank: int
    rows: int
    values: tuple[int, ...] = ()
    bracket: tuple[int, int] = (0, 0)
    inside: int = 0  # about how many rows lie in the bracket
    found: bool = field(default=False)


def cuts_after(
    df: DataFrame,
    columns: Sequence[str],
    groups: Sequence[tuple[Column, int, Sequence[int]]],
    accuracy: int = 10_000,
    most: int = 100_000,
    bins: int = 4096,
) -> list[list[CutPoint]]:
    """Where the first rows of each group end, by ``columns`` (bigints, most significant first).

    A group is a condition, the number of its rows, and the ranks to cut after.  A column
    takes two passes over the rows for all cuts: a sketch that is off by a share of
    1 / ``accuracy`` brackets each, and a count of the values within the brackets, at most
    about ``most``, is exact.  Fuller brackets are counted in ``bins`` and narrowed by more passes.
    """
    cuts = [[_Cut(g, rank, n) for rank in ranks] for g, (_, n, ranks) in enumerate(groups)]
    for depth, column in enumerate(columns):
        wanted = [c for of_group in cuts for c in of_group if len(c.values) == depth and 0 < c.rank and not c.found]
        if wanted:
            _place(df, columns[:depth], column, [condition for condition, _, _ in groups], wanted, accuracy, most, bins)
    for c in (c for of_group in cuts for c in of_group):
        if c.rank > 0 and not c.found:
            raise ValueError(f"rows tie on {list(columns)} across the cut; add a column to tell them apart")
    return [
        [CutPoint(tuple(columns[: len(c.values)]) if c.values else tuple(columns), c.values) for c in of_group]
        for of_group in cuts
    ]


def _place(df, before, column, conditions, wanted, accuracy, most, bins) -> None:
    """Adds each cut's value in ``column``, and leaves its rank among the rows that share it."""

    def among(cuts: list[_Cut]) -> tuple[dict, DataFrame]:
        cells = {key: i for i, key in enumerate(dict.fromkeys((c.group, c.values) for c in cuts))}
        cell = F.lit(None).cast("int")
        for (group, values), i in cells.items():
            held = conditions[group]
            for name, value in zip(before, values):
                held = held & (F.col(name) == value)
            cell = F.coalesce(F.when(held, F.lit(i)), cell)
        return cells, df.select(cell.alias("cell"), F.col(column).alias("v")).where("cell IS NOT NULL")

    cells, held = among(wanted)

    def around(c: _Cut) -> tuple[float, float]:
        margin = max(2 / accuracy, 2 / c.rows)
        return max(0.0, c.rank / c.rows - margin), min(1.0, c.rank / c.rows + margin)

    shares = sorted({share for c in wanted for share in around(c)})
    sketched = any(c.rows > most for c in wanted)
    if sketched:
        sketch = F.percentile_approx("v", shares, accuracy).alias("at")
        bounds = {r["cell"]: r for r in held.groupBy("cell").agg(sketch).collect()}
    for c in wanted:
        if not sketched:
            # So few rows that all their values may be counted.
            c.bracket, c.inside = (-(1 << 63), (1 << 63) - 1), c.rows
            continue
        row = bounds.get(cells[c.group, c.values])
        if row is None:
            raise ValueError(f"rank {c.rank} exceeds the number of rows")
        first, last = around(c)
        c.bracket = (row["at"][shares.index(first)], row["at"][shares.index(last)])
        c.inside = math.ceil(c.rows * (last - first))
    while wanted:
        cells, held = among(wanted)
        segment, key = F.lit(0), F.lit(None).cast("bigint")
        for cell, brackets in _disjoint(wanted, cells).items():
            here, v = F.col("cell") == cell, F.col("v")
            for low, high, inside in brackets:
                segment = segment + F.when(here, (v >= low).cast("int") + (v > high).cast("int")).otherwise(0)
                width = 1 if inside <= most else (high - low) // bins + 1
                value = v if width == 1 else F.call_function("div", v - low, F.lit(width))
                key = F.when(here & v.between(low, high), value).otherwise(key)
        rows = held.select("cell", "v", segment.alias("segment"), key.alias("key")).groupBy("cell", "segment", "key")
        counted = defaultdict(list)
        for r in rows.agg(F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")).collect():
            counted[r["cell"]].append((r["low"], r["high"], r["rows"]))
        for c in wanted:
            below = 0
            for low, high, n in sorted(counted[cells[c.group, c.values]]):
                if below + n >= c.rank:
                    break
                below += n
            else:
                raise ValueError(f"rank {c.rank} exceeds the number of rows")
            c.bracket, c.inside = (low, high), n
            if low == high:
                c.values, c.rank, c.rows, c.found = (*c.values, low), c.rank - below, n, c.rank - below == n
        wanted = [c for c in wanted if len(c.values) == len(before)]


def _disjoint(cuts: list[_Cut], cells: dict) -> dict[int, list[tuple[int, int, int]]]:
    """The brackets of each cell, those that overlap as one."""
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for c in sorted(cuts, key=lambda c: c.bracket):
        kept = out[cells[c.group, c.values]]
        if kept and c.bracket[0] <= kept[-1][1]:
            low, high, inside = kept.pop()
            same = c.bracket == (low, high)
            kept.append((low, max(high, c.bracket[1]), max(inside, c.inside) if same else inside + c.inside))
        else:
            kept.append((*c.bracket, c.inside))
    return out
