import random
import re
from collections import Counter
from zlib import crc32

import corpus
import numpy as np
import pytest
from local import frame

from lapsewise.llm import spelling

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def plain_words(rows, min_length=6, min_count=5, every=199):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_length and n >= min_count}


def edits(word, letters):
    made = {word[:i] + word[i + 1 :] for i in range(len(word))}
    made |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    made |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return made - {word}


def plain_groups(words, factor=5):
    letters = set("".join(words))
    form, out = {}, []
    for word, n in words.items():
        near = sorted((-words[w], w) for w in edits(word, letters) if w in words)
        form[word] = near[0][1] if near and -near[0][0] >= factor * n else None
        out.append((word, form[word], n, len(near), words[form[word]] if form[word] else None))
    rows = []
    for word, to, n, n_near, form_n in out:
        root = word
        while form[root]:
            root = form[root]
        rows.append((word, to, root, n, n_near, form_n))
    return sorted(rows)


def check(df, **settings):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    counts = {k: v for k, v in settings.items() if k in ("min_length", "min_count", "every")}
    want = plain_groups(plain_words(rows, **counts), settings.get("factor", 5))
    found = spelling.variant_groups(df, **settings)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in found.collect()) == want
    return want


def test_given_documents(spark):
    rows = check(spark.read.parquet(f"{corpus.SMALL}/documents.parquet"))
    assert any(r[1] for r in rows)


def test_awkward_rows(spark):
    check(corpus.awkward(spark), min_length=3, min_count=1, factor=1000)
    check(corpus.awkward(spark))


def test_empty_table(spark):
    assert spelling.variant_groups(corpus.empty(spark)).count() == 0


def scribbled(seed, n, length=(6, 9), letters="abcß"):
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.randint(*length))) for _ in range(n)]
    return [" ".join(draw.choices(words, weights=[1 / (i + 1) for i in range(n)], k=400)) for _ in range(20)]


@pytest.mark.parametrize("block", [64, 4096])
def test_crowded_neighbourhoods(spark, block):
    """Buckets far over the block, words near to many others, chains of forms, slips in a third of the words."""
    texts = scribbled(1, 500, letters="ab") + scribbled(2, 300, (3, 12)) + scribbled(3, 300, (1, 7), "aXé÷")
    df = frame(spark, corpus.rows(texts), corpus.DDL).repartition(5)
    if block == 64:
        check(df, block=block, min_length=2, min_count=1, factor=2, every=3)
    rows = check(df, block=block, min_count=2, factor=2, every=7)
    assert any(r[1] and r[1] != r[2] for r in rows)


def test_ties_go_to_the_smallest_word(spark):
    texts = ["planes planet planed planée " * 10, "plane " * 20, "plants " * 2, "planex " * 1]
    df = frame(spark, corpus.rows(texts), corpus.DDL)
    rows = {r[0]: r for r in check(df, min_count=1, min_length=5, every=1 << 40)}
    assert rows["planex"][1] == "plane" and rows["plants"][1] == "planes"


def test_long_words(spark):
    word = "".join(random.Random(4).choices("abcdefgh", k=30_000))
    others = [word[:9] + "x" + word[9:], word[:-1] + "z", word[:15000] + "y" + word[15001:], word + "q"]
    texts = [f"{word} {others[0]} " * 5, f"{others[1]} " * 40, f"{others[2]} {others[3]} " * 7]
    df = frame(spark, corpus.rows(texts), corpus.DDL)
    found = {r["word"]: r for r in spelling.variant_groups(df, every=1 << 40).collect()}
    assert {w: r["n_near"] for w, r in found.items()} == {word: 4, **dict.fromkeys(others, 1)}
    assert (found[word]["form"], found[word]["form_n"], found[word]["n"]) == (others[1], 40, 5)


def test_block_against_all_edits():
    draw = random.Random(7)
    for length in (1, 2, 3, 8):
        words = sorted({"".join(draw.choices("abç", k=length + draw.randint(0, 1))) for _ in range(150)})
        coded = [w.encode("latin-1") for w in words]
        cells = np.array([draw.randint(0, 1) for _ in words])
        sides = np.where(cells == 0, -1, np.array([draw.randint(0, 1) for _ in words]))
        got = {tuple(p) for p in spelling.near_in_block(coded, length, cells, sides, step=40).tolist()}
        want = {
            (i, j)
            for i, a in enumerate(words)
            for j, b in enumerate(words)
            if len(a) == length and b in edits(a, "abç") and len(b) >= length
            and cells[i] == cells[j] and (sides[i] < 0 or sides[i] != sides[j])
        }
        assert got == want
