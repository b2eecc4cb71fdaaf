import corpus
import pytest
import test_byte_bpe
import test_line_dedup
import test_mixing
import test_simhash

import corpus_pipeline
from lapsewise.llm import byte_bpe, language_id
from lapsewise.sources import stage


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage over the given documents."""
    docs, out = spark.read.parquet(f"{corpus.SMALL}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        made = stage(function(spark, docs, corpus.SMALL), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_order_and_columns(stages):
    names = ["language_id", "line_dedup", "simhash_near_dedup", "mix_sources", "byte_bpe"]
    assert list(stages) == names
    for name in names[:-1]:
        before, after = stages[name]
        assert after.schema == before.schema


def test_run_is_the_stages(spark, stages):
    assert rows_of(corpus_pipeline.run(spark, corpus.SMALL)) == rows_of(stages["byte_bpe"][1])


def test_language_stage_keeps_all_with_letters(stages):
    before, after = stages["language_id"]
    assert rows_of(after) == [r for r in rows_of(before) if any(c.isalpha() for c in r[1])]


def test_line_stage_against_every_pair_of_lines(stages):
    before, after = stages["line_dedup"]
    rows = rows_of(before)
    dropped = test_line_dedup.plain([r[:2] for r in rows], 20, 1)
    want = []
    for doc_id, text, lang, source, _ in rows:
        lines = text.split("\n")
        kept = [line for i, line in enumerate(lines) if i not in dropped[doc_id, text]]
        if kept:
            want.append((doc_id, "\n".join(kept), lang, source, len("\n".join(kept))))
    assert rows_of(after) == sorted(want, key=str)
    assert len(want) < len(rows)


def test_near_duplicate_stage_against_every_pair_of_documents(stages):
    before, after = stages["simhash_near_dedup"]
    rows = rows_of(before)
    held = [(r[0], test_simhash.plain_fingerprint(r[1])) for r in rows]
    components = test_simhash.plain_components(held)
    assert rows_of(after) == [r for r, c in zip(rows, components) if r[0] == c]


def test_mix_stage_takes_what_the_operator_says(stages):
    before, after = stages["mix_sources"]
    mixed = test_mixing.check(before)
    copies = {r["doc_id"]: r["copies"] for r in mixed}
    assert rows_of(after) == sorted((r for r in rows_of(before) for _ in range(copies[r[0]])), key=str)


def test_token_stage_as_the_library(stages):
    before, after = stages["byte_bpe"]
    want = [(r[0], *test_byte_bpe.expected(r[1])) for r in rows_of(before)]
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(len(r["ids"]) == r["n_tokens"] for r in after.collect())


@pytest.mark.parametrize("make", [corpus.awkward, corpus.empty])
def test_awkward_rows_pass_through(spark, make):
    docs = make(spark)
    for name, function in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(function(spark, docs, corpus.SMALL), name)
        if name != "byte_bpe":
            assert docs.columns == columns
    assert docs.isEmpty() == (make is corpus.empty)


def test_language_stage_uses_one_model_for_all(spark):
    docs = corpus.awkward(spark)
    kept = corpus_pipeline.identify_language(spark, docs, corpus.SMALL)
    model = language_id.fit(docs)
    assert rows_of(kept) == rows_of(language_id.keep_known(docs, model))


def test_token_stage_decodes(spark):
    docs = corpus.awkward(spark)
    decoded = byte_bpe.round_trip(docs).collect()
    texts = sorted((r["text"] or "" for r in docs.collect()))
    assert sorted(bytes(r["decoded"]).decode() for r in decoded) == texts
