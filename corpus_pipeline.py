"""A corpus pipeline over ``documents``: language, line dedup, near dedup, mixing, tokens.

Each stage calls one operator of ``lapsewise.llm`` on all that the stage before it kept.
All but the last return the columns of their input; the last returns what training
reads.  Rows that share doc_id and text are one document seen twice; columns beside
doc_id, text, lang and source are carried along, and ``n_chars``, where there is one,
follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import byte_bpe, language_id, line_dedup, mixing, simhash
from lapsewise.sources import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no language: null texts and texts without letters go."""
    return language_id.keep_known(docs, language_id.fit(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves each text its lines that no earlier one equals or nearly equals; emptied documents go."""
    kept = line_dedup.dedup_lines(docs, min_chars=20, max_edits=1)
    if "n_chars" not in kept.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked within 3 bits."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.take(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number and digest, and the digest of what they decode to."""
    coded = byte_bpe.round_trip(docs)
    return coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode_tokens),
]
#: Learned models, subset sums and merges have no SQL form; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
