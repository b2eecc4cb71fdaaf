"""Line dedup by a deletion-neighbourhood join, in DataFrame functions alone.

A line goes if an earlier line of the corpus equals it or lies within one edit (a
character inserted, deleted or replaced).  Order is by doc_id, then by line; the
earliest of its like stays.  Equal lines of any length go; only lines of ``min_chars``
or more are compared by edits.  Blank lines (the six ASCII spaces at most) stay and drop nothing.

Equal lines are found by 128 bits of hash, combined before the shuffle, so that a line
with a third of all rows is one row a task.  Of the distinct lines only those are
compared that can have a partner at all: with one edit between two lines, the half of
the shorter that the edit spares is shared, so a line whose halves no other line has is
alone.  The others emit the line itself and every variant with one character deleted,
as hashed keys with the place of the deletion.  Lines that share a variant with the same
place differ in that character alone, so each needs only the earliest of them; a line
that equals another's variant meets it directly.  No key lists the pairs of its group.
Each pair found is verified by edit distance.

Of a line of n > ``WHOLE`` characters, only a piece of about n^(2/3) is varied, once for
each piece whose surroundings some other line has: all before and after the piece with the
edit is shared.  Every variant is a row of its own.  So a long line costs n^(4/3) characters
for each such piece, not n^2, and no row is longer than a line.

A side that is joined by broadcast is written and has its rows counted first (at most
``small``); beyond that it is an ordinary join, which adaptive execution splits where it is skewed.

Defined results: a null text has no lines, an empty one a single empty line; null doc_ids
come last; rows that share doc_id and text are one document seen twice and decided alike;
the same line at the same place of rows that share a doc_id is not earlier; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import row_key, text_hash
from lapsewise.sources import stage

SMALL = 250_000
#: Lines with a partner of at most so many characters are varied as a whole.
WHOLE = 1000


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n")


def _two(value: Column, *more: Column) -> list[Column]:
    """128 bits of hash as two numbers."""
    return [F.xxhash64(value, *more), F.xxhash64(F.lit("second"), value, *more)]


def _place() -> Column:
    """One number that orders lines: doc_id (null last), then the line's number."""
    doc = F.coalesce(F.col("doc_id").cast("decimal(38,0)"), F.lit(Decimal(2**63)).cast("decimal(38,0)"))
    return (doc * F.lit(Decimal(2**31)).cast("decimal(10,0)") + F.col("line_no")).cast("decimal(38,0)")


def _halves(line: Column) -> Column:
    """Keys of the halves that a line shares with any line one edit away.

    The shorter of two such lines has length n or n - 1; half of that, from the front
    or from the back, is in both.
    """
    n = F.length(line)
    keys = []
    for shorter in (n, n - 1):
        half = F.floor(shorter / 2).cast("int")
        keys.append(F.xxhash64(F.lit("front"), shorter, F.substr(line, F.lit(1), half)))
        keys.append(F.xxhash64(F.lit("back"), shorter, F.substr(line, (n - half + 1).cast("int"), half)))
    return F.array(*keys)


def _exploded(documents: DataFrame) -> DataFrame:
    lines = documents.select("doc_id", text_hash(), F.posexplode(_lines()).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str, small: int) -> DataFrame:
    """Joins a staged ``right``, by broadcast if it is known to be small."""
    return left.join(F.broadcast(right) if right.count() <= small else right, on, how)


def occurrences(documents: DataFrame, min_chars: int) -> DataFrame:
    lines = _exploded(documents)
    first, second = _two(F.col("line"))
    halves = F.when(F.length("line") >= min_chars, _halves(F.col("line")))
    return lines.select(
        "doc_id", "text_hash", "line_no", first.alias("h1"), second.alias("h2"), halves.alias("halves")
    )


def _distinct(found: DataFrame) -> DataFrame:
    halves = [F.min(F.col("halves")[i]).alias(f"half{i}") for i in range(4)]
    return found.withColumn("place", _place()).groupBy("h1", "h2").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), *halves
    )


def _shared(keyed: DataFrame, on: list[str], small: int) -> DataFrame:
    """The rows whose key some other line has, too."""
    lines = (F.min("h1").alias("low"), F.max("h1").alias("high"))
    shared = stage(keyed.groupBy(*on).agg(*lines).where("low < high").select(*on), "shared-keys")
    return _joined(keyed, shared, on, "left_semi", small)


def _paired(distinct: DataFrame, small: int) -> DataFrame:
    """(h1): lines that share a half with another line."""
    keyed = distinct.where("half0 is not null").select("h1", F.explode(F.array(*(f"half{i}" for i in range(4)))).alias("half"))
    return _shared(keyed, ["half"], small).select("h1").distinct()


def _pieces(lines: DataFrame, small: int) -> DataFrame:
    """(h1, c1, c2, front, back, line): the piece to vary, and how much before and after it is shared.

    ``c1`` and ``c2`` stand for what is shared; they are 0 for a whole line.
    """
    n, shorter = F.length("line"), F.col("shorter")
    whole = lines.where(n <= WHOLE + 1).select(
        "h1", *(F.lit(0).cast("long").alias(c) for c in ("c1", "c2")), F.lit(0).alias("front"), F.lit(0).alias("back"), "line"
    )
    # Cut by the shorter of two lines, like the halves.
    long = lines.where(n > WHOLE)
    cut = (
        long.select("h1", "line", F.explode(F.array(n, n - 1)).alias("shorter"))
        .where(shorter > WHOLE)
        .withColumn("size", F.ceil(F.pow(shorter, F.lit(2 / 3))).cast("int"))
        .withColumn("front", F.explode(F.sequence(F.lit(0), shorter - 1, F.col("size"))))
        .withColumn("back", F.greatest(F.lit(0), shorter - F.col("front") - F.col("size")))
    )
    around = [
        F.substr("line", F.lit(1), F.col("front")),
        F.substr("line", n - F.col("back") + 1, F.col("back")),
    ]
    first, second = _two(shorter, F.col("front"), *around)
    keyed = cut.select("h1", first.alias("c1"), second.alias("c2"), "front", "back")
    keyed = stage(keyed, "pieces")
    shared = stage(_shared(keyed, ["c1", "c2"], small), "shared-pieces").join(long.select("h1", "line"), "h1")
    return whole.union(shared.select("h1", "c1", "c2", "front", "back", _between().alias("line")))


def _between(line: str = "line") -> Column:
    """What lies between the ``front`` and the ``back`` characters of a line."""
    return F.substr(line, F.col("front") + 1, F.length(line) - F.col("front") - F.col("back"))


def _outside(line: str) -> Column:
    """The ``front`` first and the ``back`` last characters of a line."""
    last = F.substr(line, F.length(line) - F.col("back") + 1, F.col("back"))
    return F.concat(F.substr(line, F.lit(1), F.col("front")), last)


def variants(pieces: DataFrame) -> DataFrame:
    """(v1, v2, at, h1, front, back): each piece itself at 0, and without its character ``at``."""
    line, at = F.col("line"), F.col("at")
    spread = pieces.withColumn("at", F.explode(F.sequence(F.lit(0), F.length("line"))))
    without = F.when(at == 0, line).otherwise(F.concat(F.substr(line, F.lit(1), at - 1), F.substr(line, at + 1)))
    first, second = _two(without, F.col("c1"), F.col("c2"))
    return spread.select(first.alias("v1"), second.alias("v2"), "at", "h1", "front", "back")


def _near(lines: DataFrame, small: int) -> DataFrame:
    """(first): lines that have an earlier line within one edit, by their first places."""
    key = ["v1", "v2"]
    made = _shared(stage(variants(_pieces(lines, small)), "variants"), key, small)
    made = stage(made.join(lines.select("h1", "first"), "h1").drop("h1"), "shared-variants")
    deleted, whole = made.where("at > 0"), made.where("at = 0")
    # Equal but for the character at one place: the earliest stands for all.
    earliest = deleted.groupBy(*key, "at").agg(F.min("first").alias("other"))
    replaced = deleted.join(earliest, [*key, "at"]).select("first", "other", "front", "back")
    # A line that is another's variant: at most one line to a variant.
    center = whole.select(*key, F.col("first").alias("center"))
    inserted = deleted.join(center, key).select(
        F.greatest("first", "center").alias("first"), F.least("first", "center").alias("other"), "front", "back"
    )
    pairs = replaced.union(inserted).where("other < first").distinct()
    text = lines.select("first", "line")
    other = text.select(F.col("first").alias("other"), F.col("line").alias("other_line"))
    return (
        pairs.join(text, "first")
        .join(other, "other")
        .where(_outside("line") == _outside("other_line"))
        .where(F.levenshtein(_between("line"), _between("other_line"), 1).between(0, 1))
        .select("first")
        .distinct()
    )


def dropped_lines(
    documents: DataFrame, min_chars: int = 20, max_edits: int = 1, small: int = SMALL
) -> DataFrame:
    """(doc_id, text_hash, dropped): the numbers, from 0, of each document's dropped lines, in order."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    found = stage(occurrences(documents, min_chars), "lines")
    distinct = stage(_distinct(found), "distinct-lines")
    again = distinct.where("n > 1").select("h1", "h2", "first")
    if max_edits:
        paired = stage(_paired(distinct, small), "paired-lines")
        first, second = _two(F.col("line"))
        lines = _exploded(documents).where(F.length("line") >= min_chars).select("line", first.alias("h1"), second.alias("h2"))
        lines = _joined(lines, paired, ["h1"], "left_semi", small).groupBy("h1", "h2").agg(F.min("line").alias("line"))
        lines = stage(lines.join(distinct.select("h1", "h2", "first"), ["h1", "h2"]), "compared-lines")
        near = distinct.join(_near(lines, small), "first", "left_semi")
        # No place is before these lines: each of their occurrences goes.
        again = near.select("h1", "h2", F.lit(-1).cast("decimal(38,0)").alias("first")).union(again)
        again = again.groupBy("h1", "h2").agg(F.min("first").alias("first"))
    again = stage(again, "repeated-lines")
    places = found.select("doc_id", "text_hash", "line_no", "h1", "h2")
    return (
        _joined(places, again, ["h1", "h2"], "inner", small)
        .where(_place() > F.col("first"))
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))
    )


def _with_dropped(documents: DataFrame, keep: list[Column], dropped: DataFrame) -> DataFrame:
    """``keep`` of every row, and ``dropped`` (null where no line goes)."""
    gone = dropped.select(*row_key(hashed="text_hash"), "dropped")
    return documents.select(*keep, *row_key()).join(gone, ["_id", "_hash"], "left")


def line_report(documents: DataFrame, min_chars: int = 20, max_edits: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped and the dropped lines' numbers, comma-separated, of every row."""
    n = F.coalesce(F.size(_lines()), F.lit(0)).cast("long")
    count = F.when(F.col("text").isNull(), F.lit(0)).otherwise(n).cast("long").alias("_n")
    kept = [F.col("doc_id").alias("_doc"), count]
    rows = _with_dropped(documents, kept, dropped_lines(documents, min_chars, max_edits))
    return rows.select(
        F.col("_doc").alias("doc_id"),
        F.col("_n").alias("n_lines"),
        F.coalesce(F.size(F.col("dropped")), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join(F.col("dropped").cast("array<string>"), ","), F.lit("")).alias("dropped"),
    )


def dedup_lines(documents: DataFrame, min_chars: int = 20, max_edits: int = 1) -> DataFrame:
    """The whole rows with ``text`` left to its kept lines; those that lose every line they had go."""
    dropped = dropped_lines(documents, min_chars, max_edits)
    rows = _with_dropped(documents, [F.struct("*").alias("row")], dropped)
    lines = _lines("row.text")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(numbers, F.col("dropped")), lambda i: F.get(lines, i))
    text = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    gone = F.col("dropped").isNotNull() & (F.size("dropped") == F.size(lines))
    return rows.where(~gone).select(F.col("row").withField("text", text).alias("row")).select("row.*")
