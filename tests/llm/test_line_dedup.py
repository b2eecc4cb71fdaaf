import random

import corpus
import pytest
from local import frame

from lapsewise.llm import line_dedup


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows, min_chars, max_edits):
    """{(doc_id, text): dropped} by comparing every line with every earlier one."""
    lines = {}
    for doc_id, text in rows:
        for number, line in enumerate([] if text is None else text.split("\n")):
            if line.strip(" \t\n\v\f\r"):
                lines[(2**63 if doc_id is None else doc_id, number, text)] = line
    gone = {}
    for (d, n, t), line in lines.items():
        for (d2, n2, _), other in lines.items():
            if (d2, n2) < (d, n) and (
                line == other or max_edits and min(len(line), len(other)) >= min_chars and within_one(line, other)
            ):
                gone.setdefault((d, t), set()).add(n)
    return {(d, t): sorted(gone.get((2**63 if d is None else d, t), ())) for d, t in rows}


def check(df, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = plain(rows, options["min_chars"], options["max_edits"])
    got = line_dedup.line_report(df, **options).collect()
    lines = lambda t: 0 if t is None else len(t.split("\n"))
    expected = [(d, lines(t), len(want[d, t]), ",".join(map(str, want[d, t]))) for d, t in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("max_edits", [0, 1])
def test_short_alphabet(spark, max_edits):
    """Few letters: most lines have neighbours by each kind of edit, and runs of equal letters."""
    draw = random.Random(9)
    line = lambda: "".join(draw.choices("aabé", k=draw.randint(0, 9)))
    texts = ["\n".join(line() for _ in range(draw.randint(1, 6))) for _ in range(60)]
    check(frame(spark, corpus.rows(texts), corpus.DDL), min_chars=3, max_edits=max_edits)


def test_one_edit_anywhere(spark):
    base = "The quick brown fox jumps over the lazy dog"
    edits = [base[:i] + c + base[j:] for i in (0, 1, 20, 21, 22, 42, 43) for c, j in (("#", i), ("#", i + 1), ("", i + 1))]
    check(frame(spark, corpus.rows([base, *edits, base[2:], base + "!!"]), corpus.DDL), min_chars=20, max_edits=1)


def test_the_earliest_stays_though_its_row_comes_last(spark):
    df = frame(spark, corpus.rows(["a line that is long enough", "a line that is long enouch"])[::-1], corpus.DDL)
    got = {r["doc_id"]: r["dropped"] for r in line_dedup.line_report(df).collect()}
    assert got == {0: "", 1: "0"}


def test_awkward_rows(spark):
    check(corpus.awkward(spark), min_chars=4, max_edits=1)


def test_without_broadcast(spark):
    texts = ["\n".join(["same line in many texts", f"line of text number {i}", "x"]) for i in range(30)]
    df = frame(spark, corpus.rows(texts), corpus.DDL)
    few = line_dedup.dropped_lines(df, small=-1).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, line_dedup.dropped_lines(df).collect()))


def test_empty_table(spark):
    assert line_dedup.line_report(corpus.empty(spark)).count() == 0
    assert line_dedup.dedup_lines(corpus.empty(spark)).count() == 0


def test_whole_rows(spark):
    texts = ["first line, long enough\nx\nsecond line, long enough", "second line, long enough\ny", "first line, long enough", "", None]
    df = frame(spark, corpus.rows(texts), corpus.DDL)
    kept = line_dedup.dedup_lines(df)
    assert kept.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {0: texts[0], 1: "y", 3: "", 4: None}


def test_other_bounds_are_refused(spark):
    with pytest.raises(ValueError):
        line_dedup.dropped_lines(corpus.empty(spark), max_edits=2)


def test_main_path_has_no_python(spark):
    df = spark.read.parquet(f"{corpus.SMALL}/documents.parquet")
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_short_lines_are_dropped_where_equal(spark):
    """Below ``min_chars``, equal lines go, near ones stay, blank ones stay."""
    long = "a line that is long enough"
    texts = [f"Les.\n\n  \n{long}\nNt onor. The of it.", f"Les.\n\n  \n{long}!\nNt onor. The of it.", "Les!\nx", "x\nLes.\nx"]
    df = frame(spark, corpus.rows(texts), corpus.DDL)
    got = {r["doc_id"]: r["dropped"] for r in line_dedup.line_report(df).collect()}
    assert got == {0: "", 1: "0,3,4", 2: "", 3: "0,1,2"}
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert kept == {0: texts[0], 1: "\n  ", 2: texts[2]}


def test_long_lines_one_edit_apart(spark):
    """Each kind of edit at each end and inside, in lines around and far past the cut into pieces."""
    draw = random.Random(4)
    texts, want = [], {}
    for n in (line_dedup.WHOLE - 1, line_dedup.WHOLE, line_dedup.WHOLE + 1, 5000, 60_000):
        base = "".join(draw.choices("abcdé ", k=n))
        edits = [base[:i] + c + base[j:] for i in (0, n // 3, n - 1) for c, j in (("#", i), ("#", i + 1), ("", i + 1))]
        spoilt = base[: n // 4] + "##" + base[n // 4 + 2 :]
        for text, dropped in [(base, ""), *((e, "0") for e in edits[: 2 if n > 5000 else 9]), (spoilt[::-1], ""), (spoilt + "zz", "")]:
            want[len(texts)] = dropped
            texts.append(text)
    df = frame(spark, corpus.rows(texts), corpus.DDL)
    assert {r["doc_id"]: r["dropped"] for r in line_dedup.line_report(df).collect()} == want
