import corpus
import numpy as np
from local import frame
from pyspark.sql import functions as F

from lapsewise.llm import language_id

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_languages(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = language_id.fit(documents)
    rows = language_id.predict_language(documents, model).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == documents.count()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_teach_nothing(spark):
    documents = spark.read.parquet(f"{corpus.SMALL}/documents.parquet")
    from lapsewise.llm.common import held_out

    lied = documents.withColumn("lang", F.when(held_out(), "xx").otherwise(F.col("lang")))
    model = language_id.fit(lied)
    assert "xx" not in model.languages and len(model.languages) == 4


def test_kernel_counts_shared_ngrams():
    texts = ["abc abd", "abd xyz", "zzz"]
    grams = [{t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    held = [language_id.presence(t) for t in texts]
    for a, g in zip(held, grams):
        assert np.count_nonzero(a) == len(g)
        for b, h in zip(held, grams):
            assert np.count_nonzero(a & b) == len(g & h)


def test_letters_alone_count():
    same = [language_id.presence(t) for t in ("Straße ab", "straße\nAB", "STRAßE1AB")]
    assert (same[0] == same[1]).all() and (same[0] == same[2]).all()
    assert language_id.presence("12 !? \n") is None and language_id.presence("") is None
    assert language_id.presence("é") is not None


def test_awkward_rows(spark):
    model = language_id.fit(spark.read.parquet(f"{corpus.SMALL}/documents.parquet"))
    df = corpus.awkward(spark)
    rows = language_id.predict_language(df, model).collect()
    assert len(rows) == df.count()
    for r in rows:
        if r["doc_id"] in (0, 1, 2, 4):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.languages
    kept = language_id.keep_known(df, model)
    assert kept.schema == df.schema
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["lang_pred"] != "und"}
    assert language_id.predict_language(corpus.empty(spark), model).count() == 0
    assert language_id.keep_known(corpus.empty(spark), model).count() == 0


def test_nothing_to_learn_from(spark):
    for df in (corpus.empty(spark), frame(spark, corpus.rows(["some text"] * 9, [None] * 9), corpus.DDL)):
        model = language_id.fit(df)
        names = {r["lang_pred"] for r in language_id.predict_language(corpus.awkward(spark), model).collect()}
        assert names == {"und"}


def test_one_language(spark):
    model = language_id.fit(frame(spark, corpus.rows(["some text"] * 9, ["en"] * 9), corpus.DDL))
    assert model.languages == ("en",)
    assert model.predict(["other words", "1"])[0] == ["en", "und"]


def test_languages_of_long_texts_are_learned(spark):
    """Texts past ``sample_chars``, rows without letters and rare languages cost no language its place."""
    texts = ["good words here " * 1000] * 9 + [None, "", "12 3"] * 99 + [" " * 20_000 + "wörter sind das"] * 9 + ["kratka rec"] * 9
    langs = ["en"] * 9 + ["en"] * 297 + ["de"] * 9 + ["sl"] * 9
    model = language_id.fit(frame(spark, corpus.rows(texts, langs), corpus.DDL), per_language=5)
    assert model.languages == ("de", "en", "sl")
    assert model.predict(["good words", "wörter sind", "kratka"])[0] == ["en", "de", "sl"]


def test_more_languages_than_texts(spark):
    draw = np.random.default_rng(5)
    made = ["".join(draw.choice(list("abcdefghij"), 12)) for _ in range(230)]
    df = frame(spark, corpus.rows(made * 9, [f"l{i:03}" for i in range(230)] * 9), corpus.DDL)
    model = language_id.fit(df, max_texts=100)
    assert len(model.languages) == 230


def test_texts_with_letters_stay_when_nothing_is_learned(spark):
    df = corpus.awkward(spark)
    kept = language_id.keep_known(df, language_id.NOTHING).collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in df.collect() if any(c.isalpha() for c in r["text"] or ""))


def test_no_ngram_in_common(spark):
    texts = ["abc abd " * 3, "xyz xyw " * 3] * 20
    df = frame(spark, corpus.rows(texts + ["ддд"], ["zu", "fr"] * 20 + [None]), corpus.DDL)
    model = language_id.fit(df)
    rows = {r["doc_id"]: r for r in language_id.predict_language(df, model).collect()}
    assert (rows[40]["lang_pred"], rows[40]["score"]) == ("fr", 0.0)
    assert rows[0]["lang_pred"] == "zu" and rows[1]["lang_pred"] == "fr"


def test_every_language_has_a_landmark(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANDMARKS", 3)
    names = [f"l{i}" for i in range(8)]
    texts = [f"{chr(97 + 3 * i)}{chr(98 + 3 * i)} " * 9 for i in range(8)]
    df = frame(spark, corpus.rows(texts * 30, names * 30), corpus.DDL)
    model = language_id.fit(df)
    assert model.landmarks.shape[1] == 8
    assert [n for n, _ in zip(model.predict(texts)[0], texts)] == names
