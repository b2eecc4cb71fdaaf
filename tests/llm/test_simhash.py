import random
import re

import corpus
import numpy as np
import pytest
import xxhash
from local import frame

from lapsewise.llm import simhash


def plain_fingerprint(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    """{row: smallest known doc_id reachable} by comparing everything with everything."""
    group = list(range(len(prints)))
    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if bin(a ^ b).count("1") <= radius and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    ids = {g: [d for (d, _), x in zip(prints, group) if x == g and d is not None] for g in set(group)}
    return [min(ids[g], default=None) for g in group]


def check(df):
    held = [(r["doc_id"], plain_fingerprint(r["text"])) for r in df.collect()]
    want = sorted(((d, f"{p:016x}", c) for (d, p), c in zip(held, plain_components(held))), key=str)
    got = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_awkward_rows(spark):
    check(corpus.awkward(spark))


def test_empty_table(spark):
    assert simhash.near_duplicates(corpus.empty(spark)).count() == 0
    assert simhash.keep_one(corpus.empty(spark)).count() == 0


def test_given_documents(spark):
    check(spark.read.parquet(f"{corpus.SMALL}/documents.parquet"))


@pytest.mark.parametrize("words", [1, 2, 3, 4, 200_000])
def test_fingerprint(words):
    text = " ".join(random.Random(words).choices(["Aa", "b", "ç", "D"], k=words))
    if words > 4:
        words = 500
        text = " ".join(text.split()[:words])
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_half_the_shingles_are_not_over_half():
    # Two words: one shingle; four words: two shingles, whose bits must both be set.
    text = b"p q r s"
    a, b = (xxhash.xxh64_intdigest(s, 42) for s in (b"p q r", b"q r s"))
    assert simhash.fingerprint(text) == a & b


def near(values, radius):
    """Values with many near ones: some random, some with a few bits flipped."""
    draw = random.Random(radius)
    out = [draw.getrandbits(64) for _ in range(values)]
    for _ in range(values * 2):
        value = draw.choice(out)
        for bit in draw.sample(range(64), draw.randint(0, radius + 2)):
            value ^= 1 << bit
        out.append(value)
    return sorted(set(out))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_counts(radius):
    values = np.array(near(150, radius), dtype=np.uint64)
    i, j = np.triu_indices(len(values), 1)
    want = np.bitwise_count(values[i] ^ values[j]) <= radius
    assert (simhash.links_in_pairs(values[i], values[j], radius) == want).all()


@pytest.mark.parametrize("radius", [0, 2, 3])
def test_block_links_span_the_components(radius):
    values = np.array(near(80, radius), dtype=np.uint64)
    half = len(values) // 2
    for left, right in ((values, None), (values[:half], values[half:])):
        other = left if right is None else right
        links = simhash.links_in_block(left, right, radius)
        want = {(a, b) for a in left.tolist() for b in other.tolist() if bin(a ^ b).count("1") <= radius and a != b}
        assert set(links) <= want
        assert partition(links, values.tolist()) == partition(want, values.tolist())


def partition(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("chunk", [7, 4096])
def test_no_link_is_lost_between_chunks(spark, chunk):
    """All values share most bits: one hot bucket, split or whole."""
    draw = random.Random(chunk)
    values = {sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))) for _ in range(120)}
    signed = [simhash._signed(v) for v in values]
    links = simhash.near_links(frame(spark, [(v,) for v in signed], "fp bigint"), 3, chunk).collect()
    got = partition([(r["a"], r["b"]) for r in links], signed)
    mask = (1 << 64) - 1
    want = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & mask).count("1") <= 3]
    assert got == partition(want, signed)


def test_components_of_long_chains_and_cycles(spark):
    draw = random.Random(4)
    nodes = list(range(400))
    draw.shuffle(nodes)
    links = list(zip(nodes[:200], nodes[1:200])) + [(nodes[250], nodes[251]), (nodes[251], nodes[252]), (nodes[252], nodes[250])]
    links += [(5, 5)]
    got = {r["node"]: r["root"] for r in simhash.connected(frame(spark, links, "a bigint, b bigint")).collect()}
    for group in partition([x for x in links if x[0] != x[1]], nodes):
        for node in group[1:]:
            assert got[node] == group[0]


def test_one_whole_row_of_each_component_stays(spark):
    df = corpus.awkward(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    found = simhash.near_duplicates(df)
    assert kept.count() == found.select("component").distinct().count()
    assert {r["doc_id"] for r in kept.collect()} == {r["component_id"] for r in found.collect()}
