import random
import re
from pathlib import Path

import corpus
import numpy as np
import pytest
from local import frame
from pyspark.sql import functions as F

from lapsewise.llm import chosen_path
from lapsewise.sources import scratch_path


def plain_set(text, size=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} or ({" ".join(words)} if words else set())


def plain_report(rows, percent=85):
    """Everything compared with everything."""
    sets = [plain_set(text) for _, text in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and group[i] != group[j] and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    group = [group[j] if g == group[i] else g for g in group]
    ids = {g: [d for (d, _), x in zip(rows, group) if x == g and d is not None] for g in set(group)}
    named = [min(ids[g], default=None) if s else d for (d, _), g, s in zip(rows, group, sets)]
    return sorted(((d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, named)), key=str)


def check(df, **settings):
    want = plain_report([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    found = chosen_path.near_duplicates(df, **settings)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    return want


def test_awkward_rows(spark):
    check(corpus.awkward(spark))


def test_empty_table(spark):
    assert chosen_path.near_duplicates(corpus.empty(spark)).count() == 0
    wordless = frame(spark, corpus.rows([None, "", " \n"]), corpus.DDL)
    check(wordless)


def test_given_documents(spark):
    rows = check(spark.read.parquet(f"{corpus.SMALL}/documents.parquet"))
    assert any(d != c for d, _, c, _ in rows)


def edited(draw, words, changes):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def groups(seed):
    """Groups of copies from near to far, chains, and common passages in otherwise unlike texts."""
    draw = random.Random(seed)
    texts = []
    for size, changes in ((60, 1), (40, 3), (40, 6), (12, 2)):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.randint(60, 300))]
        texts += [edited(draw, base, changes) for _ in range(size)]
    chain = [f"c{i}" for i in range(80)]
    for i in range(30):
        texts.append(" ".join(chain))
        chain[(i * 3) % 80] = f"d{i}"
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"w{draw.randrange(3000)}" for _ in range(draw.randint(0, 60))) for _ in range(80)]
    texts += texts[:20]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("few, settings", [(128, {}), (0, {"leaf": 8}), (0, {"leaf": 4, "depth": 2}), (2, {"leaf": 6})])
def test_groups_of_copies(spark, monkeypatch, few, settings):
    """Also with nodes so small that nearly all are branched, and at last cut into chunks."""
    monkeypatch.setattr(chosen_path, "FEW", few)
    df = frame(spark, corpus.rows(groups(5)), corpus.DDL).repartition(5)
    rows = check(df, **settings)
    assert len({c for _, _, c, _ in rows}) < len(rows)


def test_similarity_is_exact():
    draw = random.Random(1)
    for _ in range(300):
        a = {draw.randrange(60) for _ in range(draw.randint(1, 60))}
        b = {x for x in a if draw.random() < 0.95} | {draw.randrange(60) for _ in range(draw.randint(0, 4))}
        arrays = [np.array(sorted(x), np.uint64) for x in (a, b)]
        assert chosen_path.similar(*arrays, 85) == (100 * len(a & b) >= 85 * len(a | b))


def test_sketch_agreement_follows_similarity():
    draw = np.random.default_rng(3)
    floor = chosen_path.fewest_equal(0.85)
    for share in (0.85, 0.9, 0.95, 1.0):
        agreed = []
        for _ in range(60):
            union = draw.integers(0, 1 << 63, 400, np.uint64)
            both = int(share * 400)
            rest = (400 - both) // 2
            a = np.unique(union[: both + rest])
            b = np.unique(np.concatenate([union[:both], union[both + rest :]]))
            agreed.append((chosen_path.minima(a, 8)[0] == chosen_path.minima(b, 8)[0]).sum())
        assert min(agreed) >= floor
        assert abs(np.mean(agreed) / 256 - share - (1 - share) / 256) < 0.02


def test_trees_reach_the_recall():
    """A pair of the threshold's similarity, branched to the full depth, is missed as seldom as computed."""
    draw = np.random.default_rng(5)
    threshold, depth = 0.85, 4
    meets, trials = 0, 400
    for trial in range(trials):
        alike = draw.random(chosen_path.HASHES) < threshold
        one = draw.integers(0, 256, chosen_path.HASHES).astype(np.uint8)
        other = np.where(alike, one, one + np.uint8(1))
        nodes = [np.array([trial], np.uint64)] * 2
        for _ in range(depth):
            made = [chosen_path.branched(n, np.tile(s, (len(n), 1)), threshold)[1] for n, s in zip(nodes, (one, other))]
            both = np.intersect1d(*made)
            nodes = [both, both]
        meets += len(both) > 0
    assert abs(1 - meets / trials - chosen_path.lost(threshold, depth)) < 0.08
    assert chosen_path.lost(threshold, 6) ** chosen_path.trees_for(threshold, 1 - 1e-6, 6) <= 1e-6


def test_large_groups_are_linked_without_their_pairs(spark):
    """Sets of one node meet its first set only; one component has no cell."""
    members = spark.range(1000).select(F.lit(7).cast("long").alias("node"), F.col("id").alias("s"), F.lit(50).cast("long").alias("n"))
    assert chosen_path.first_pairs(members, 85).count() == 999
    one = members.select("node", "s", F.lit(0).cast("long").alias("component"))
    assert chosen_path._open_nodes(one, 64).count() == 0
    mixed = one.withColumn("component", F.when(F.col("s") < 990, 0).otherwise(F.col("s")))
    cells = chosen_path._chunked(mixed, 64).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("component").alias("c"))
    rows = cells.collect()
    # 16 chunks of the large component, each against the one common chunk, and that with itself.
    assert len(rows) == 17 and all(r["n"] <= 128 and r["c"] > 1 for r in rows)


@pytest.mark.parametrize("two_sides", [False, True])
def test_cells_link_by_full_sets(two_sides):
    """The forest connects what all links connect, and nothing that a component had linked before."""
    draw = random.Random(11)
    base = [draw.sample(range(10**6), draw.randint(20, 60)) for _ in range(4)]
    sets = [set(draw.choice(base)) for _ in range(40)]
    sets = [{x for x in s if draw.random() < 0.97} | {draw.randrange(10**6) for _ in range(draw.randint(0, 3))} for s in sets]
    sides = np.array([draw.randint(0, 1) for _ in sets]) if two_sides else np.full(len(sets), -1)
    components = np.array([draw.choice([i, 3]) if i % 5 == 0 else i for i in range(len(sets))])

    def joined(links):
        group = components.copy()
        for i, j in links:
            group[group == group[j]] = group[i]
        return [tuple(np.flatnonzero(group == g)) for g in sorted(set(group.tolist()))]

    every = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets)
        if i < j and (not two_sides or sides[i] != sides[j]) and 100 * len(a & b) >= 85 * len(a | b)
    ]
    tokens = [np.array(sorted(s), np.uint64) for s in sets]
    links = chosen_path.links_in_cell(sides, components, tokens, 85, width=64)
    assert sorted(joined(links)) == sorted(joined(every))
    assert len(links) == len(set(components.tolist())) - len(joined(every)) > 0


def test_what_cells_hand_on_grows_with_their_members(spark):
    """300 sets whose pairs all look alike and none of which is linked: members are handed on, not pairs."""
    sketch = bytes(range(256))
    sets = spark.range(300).select(F.col("id").alias("s"), F.lit(100).cast("long").alias("n"), F.lit(bytearray(sketch)).alias("sketch"))
    dealt = sets.select(F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("cell"), F.lit(-1).alias("side"), "s", F.col("s").alias("component"))
    held = chosen_path.sketched_cells(dealt, sets, 85, 200)
    assert held.count() == 300  # the two cells are the same
    full = sets.select("s", F.unhex(F.lpad(F.hex("s"), 16, "0")).alias("tokens"))
    assert chosen_path.linked_cells(held, full, 85).count() == 0


def test_staged_copies_go_once_nothing_reads_them(spark):
    folder = Path(scratch_path(spark, "any").removeprefix("file:")).parent
    before = set(folder.iterdir())
    check(corpus.awkward(spark))
    left = {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before}
    large = {"prints", "first-nodes", "members", "near-pairs", "full-sets", "open-members", "open-cells"}
    assert "sets" in left and not left & large
