"""One query per operator, with production parameters, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import byte_bpe, chosen_path, language_id, line_dedup, mixing, nearest, quality_compression, quality_rules, simhash, spelling, token_files, url_filters, whitening
from lapsewise.sources import scratch_path


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"), shingle=3, radius=3)


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    model = quality_compression.fit(documents, _table(spark, sf, "labels"))
    return quality_compression.score_quality(documents, model, threshold=0.3)


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return language_id.predict_language(documents, language_id.fit(documents))


def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf, "documents"), min_chars=20, max_edits=1)


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return byte_bpe.digests(byte_bpe.round_trip(_table(spark, sf, "documents")))


def op6_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)


def op7_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    return url_filters.judge(url_filters.captures_of(pages), url_filters.lists_of(pages), "page_id")


def op8_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    embeddings = _table(spark, sf, "embeddings")
    return nearest.search(embeddings, F.col("vec_id") % 100 == 0, k=10, vector="embedding")


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(_table(spark, sf, "documents"), path, end_id=2)
    return token_files.read_digests(spark, path)


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    trees = quality_rules.fit(documents, _table(spark, sf, "labels"))
    return quality_rules.judge(documents, trees)


def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitening_report(_table(spark, sf, "embeddings"), k=16)


def op12_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return chosen_path.near_duplicates(documents, shingle=3, threshold=0.85, recall=1 - 1e-6)


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return spelling.variant_groups(documents, min_length=6, min_count=5, factor=5, every=199)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_quality_classifier,
        op3_language_id,
        op4_line_dedup,
        op5_byte_bpe,
        op6_mix_sources,
        op7_url_filters,
        op8_nearest_neighbours,
        op9_token_files,
        op10_quality_rules,
        op11_embedding_whitening,
        op12_minhash_near_dedup,
        op13_spelling_variants,
    )
}

#: Lines by place; a line goes if an earlier one equals it or, from 20 characters on, differs in
#: one character at the same place, or is it with one character more or less.
_LINES_SQL = r"""
WITH texts AS (SELECT doc_id, hash(text) AS text_hash, text, string_split(text, chr(10)) AS lines FROM documents),
places AS (
  SELECT doc_id, text_hash, unnest(lines) AS line, unnest(range(len(lines))) AS line_no FROM texts),
held AS (
  SELECT *, coalesce(CAST(doc_id AS HUGEINT), CAST(9223372036854775808 AS HUGEINT)) * 2147483648 + line_no AS place
  FROM places WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
kinds AS (SELECT line, min(place) AS first FROM held GROUP BY line),
compared AS (SELECT * FROM kinds WHERE length(line) >= 20),
variants AS (
  SELECT first, 0 AS spot, md5_number(line) AS v FROM compared
  UNION ALL
  SELECT first, spot, md5_number(substr(line, 1, spot - 1) || substr(line, spot + 1)) FROM (
    SELECT first, line, unnest(range(1, length(line) + 1)) AS spot FROM compared)),
near AS (
  SELECT DISTINCT b.first FROM variants a JOIN variants b ON a.v = b.v AND a.first < b.first
  WHERE a.spot = b.spot OR a.spot = 0 OR b.spot = 0),
gone AS (
  SELECT DISTINCT l.doc_id, l.text_hash, l.line_no FROM held l JOIN kinds k ON l.line = k.line
  WHERE l.place > k.first OR k.first IN (SELECT first FROM near)),
listed AS (
  SELECT doc_id, text_hash, count(*) AS n, string_agg(line_no, ',' ORDER BY line_no) AS dropped
  FROM gone GROUP BY doc_id, text_hash)
SELECT t.doc_id, CAST(coalesce(len(t.lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(g.n, 0) AS BIGINT) AS n_dropped, coalesce(g.dropped, '') AS dropped
FROM texts t LEFT JOIN listed g ON t.doc_id IS NOT DISTINCT FROM g.doc_id AND t.text_hash = g.text_hash
"""

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def _number(value: str) -> str:
    return f"CAST('0x' || substr(md5({value}), 1, 8) AS BIGINT)"


_MONTHLY = ", ".join(
    f"(1, n % 30 + {30 * m + shift}), (0, n % 30 + {30 * m + 10 + shift})" for m in range(12) for shift in (0, 5)
)

#: Every capture against every entry: the last entry of a list and pattern at or before the
#: fetch decides, and a removal is later than an addition of the same second.
_URLS_SQL = f"""
WITH captures AS (
  SELECT page_id, url, 1704067200 + {_number('url')} % (366 * 86400) AS fetched_at,
         nullif(regexp_replace(lower(regexp_extract(url, '{_HOST}', 1)), '\\.$', ''), '') AS host,
         regexp_extract(url, '{_PATH}', 1) AS path
  FROM pages),
hosts AS (SELECT DISTINCT host AS h, {_number('host')} AS n FROM captures WHERE host IS NOT NULL),
domains AS (
  SELECT DISTINCT h, {_number('h')} AS n FROM (
    SELECT regexp_extract(h, '([^.]+\\.[^.]+)$', 1) AS h FROM hosts
    UNION ALL SELECT regexp_extract(h, '([^.]+\\.[^.]+\\.[^.]+)$', 1) FROM hosts)
  WHERE h <> ''),
steps AS (
  SELECT DISTINCT host || regexp_extract(path, '^(/[^/]+/)', 1) AS h FROM captures
  WHERE host IS NOT NULL AND regexp_extract(path, '^(/[^/]+/)', 1) <> ''),
dated AS (
  SELECT 'ads' AS list_name, 'block' AS verdict, 'host' AS kind, h, unnest([
    (1, n % 300), (0, n % 300 + 30 + n % 50), (1, n % 300 + 120 + n % 9)]) AS e FROM hosts WHERE n % 5 = 0
  UNION ALL SELECT 'trusted', 'allow', 'host', h, unnest([(1, n % 100), (0, n % 100 + 150)])
  FROM hosts WHERE n % 11 = 0
  UNION ALL SELECT 'outbreaks', 'block', 'domain', h, unnest([{_MONTHLY}]) FROM domains WHERE n % 3 <> 0
  UNION ALL SELECT 'sections', 'block', 'prefix', h, unnest([(1, n % 200)])
  FROM (SELECT h, {_number('h')} AS n FROM steps) WHERE n % 7 = 0),
entries AS (
  SELECT list_name, verdict, kind, h, e[1] AS state, 1704067200 + 86400 * e[2] AS effective_at FROM dated),
met AS (
  SELECT c.page_id, c.url, c.fetched_at, e.list_name, e.verdict, e.kind, e.h,
         arg_max(e.state, e.effective_at * 2 + 1 - e.state) AS state
  FROM captures c JOIN entries e ON e.effective_at <= c.fetched_at AND (
    (e.kind = 'host' AND c.host = e.h)
    OR (e.kind = 'domain' AND (c.host = e.h OR ends_with(c.host, '.' || e.h)))
    OR (e.kind = 'prefix' AND starts_with(c.host || c.path, e.h)))
  GROUP BY ALL),
active AS (
  SELECT page_id, url, fetched_at, string_agg(DISTINCT list_name || '|' || kind || ':' || h, ';'
           ORDER BY list_name || '|' || kind || ':' || h) AS matches,
         bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow') AS blocked
  FROM met WHERE state = 1 GROUP BY page_id, url, fetched_at)
SELECT c.page_id, c.host, c.fetched_at, coalesce(a.blocked, false) AS blocked, coalesce(a.matches, '') AS matches
FROM captures c LEFT JOIN active a
  ON c.page_id IS NOT DISTINCT FROM a.page_id AND c.url IS NOT DISTINCT FROM a.url
"""

#: Shared shingles counted for every two sets that have one, and what each set reaches.
_SIMILAR_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, hash(text) AS text_hash, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM docs),
keyed AS (SELECT doc_id, len(s) AS n, s, CASE WHEN len(s) > 0 THEN md5(array_to_string(s, chr(10))) END AS k FROM sets),
kinds AS (SELECT k, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS first FROM keyed WHERE n > 0 GROUP BY k),
tokens AS (SELECT k, n, unnest(s) AS t FROM kinds),
links AS (
  SELECT a.k AS a, b.k AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.k < b.k
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT k AS a, k AS b FROM kinds UNION SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a),
named AS (SELECT r.a AS k, min(d.first) AS component_id FROM reached r JOIN kinds d ON d.k = r.b GROUP BY r.a)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles, CASE WHEN d.n > 0 THEN c.component_id ELSE d.doc_id END AS component_id,
       d.doc_id IS NOT DISTINCT FROM (CASE WHEN d.n > 0 THEN c.component_id ELSE d.doc_id END) AS kept
FROM keyed d LEFT JOIN named c ON d.k = c.k
"""

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": _LINES_SQL,
    "op7_url_filters": _URLS_SQL,
    "op12_minhash_near_dedup": _SIMILAR_SQL,
}
