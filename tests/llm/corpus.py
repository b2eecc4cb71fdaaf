"""Small corpora for the operators: rows with every awkward case, and the given tables."""

import random

from local import frame

SMALL = "/root/testdata/sf0.001"
#: Columns that clash with names the operators use inside.
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string, _id bigint, size bigint"
LONG = "the cat sat on the mat and then it went away again " * 4000


def rows(texts, langs=None, sources=None, first=0):
    langs = langs or ["en"] * len(texts)
    sources = sources or ["a"] * len(texts)
    return [
        (first + i, t, la, s, None if t is None else len(t), 0.5, "r", 7, 3)
        for i, (t, la, s) in enumerate(zip(texts, langs, sources))
    ]


AWKWARD = [
    None,
    "",
    " \n\t ",
    "Words",
    "12 34 !!",
    LONG,
    LONG,
    "Ünïcödé 中文字 😀 text́ here",
    "a\x00b \x1c c\x85d",
    "one two three four five six seven eight nine ten " * 3,
    "one two three four five six seven eight nine ten " * 3,
]


def awkward(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, clashing extra columns."""
    made = rows(AWKWARD, ["en", None, "de"] * 4, [None, "a", "b"] * 4)
    made.append((None, "a text without an id that is long enough", None, None, None, None, None, None, None))
    made.append(made[3])
    return frame(spark, made, DDL)


def empty(spark):
    return frame(spark, [], DDL)


def shaken(seed, words, n):
    """``n`` texts of words drawn at random."""
    draw = random.Random(seed)
    return [" ".join(draw.choices(words, k=draw.randint(0, 40))) for _ in range(n)]
