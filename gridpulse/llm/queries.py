"""One query for each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridpulse.llm.common import table
from gridpulse.llm.curriculum import mixture
from gridpulse.llm.decontaminate import leaks
from gridpulse.llm.filter_audit import filter_audit
from gridpulse.llm.language import page_languages
from gridpulse.llm.lattice_lm import lattice_scores
from gridpulse.llm.licenses import scan_licenses
from gridpulse.llm.line_dedup import line_dedup
from gridpulse.llm.mtree import top_k
from gridpulse.llm.packing import pack
from gridpulse.llm.repeats import without_repeats
from gridpulse.llm.simhash import simhash_components
from gridpulse.llm.toxicity import toxicity_scores
from gridpulse.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


ORACLES["op1_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), judged AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("rid")


@query
def op10_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op10_mtree"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


@query
def op11_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).drop("rid", "copies")


ORACLES["op11_curriculum"] = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size) AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(place % 3 AS INTEGER) AS turn, [3.0, 1.0, 2.0][place % 3 + 1]::DOUBLE AS weight FROM sources
), levels AS (
  -- The level if this source and all of smaller words for a weight gave all they have.
  SELECT *, words / weight AS reach,
         (1.5::DOUBLE * sum(words) OVER () - 2 * sum(words) OVER before) / (sum(weight) OVER () - sum(weight) OVER before) AS level
  FROM weighed
  WINDOW before AS (ORDER BY words / weight ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), level AS (
  SELECT arg_min(l, after) AS level FROM (
    SELECT 1.5::DOUBLE * sum(words) / sum(weight) AS l, -1.0::DOUBLE AS after FROM weighed
    UNION ALL SELECT level, reach FROM levels WHERE isfinite(level)  -- 0 / 0 or x / 0 where all are full
  ) AS c
  WHERE NOT EXISTS (SELECT 1 FROM weighed AS w WHERE 2 * w.words < w.weight * c.l AND w.words / w.weight > c.after)
), targets AS (
  SELECT source, CAST(words AS BIGINT) AS words, turn, least(2.0::DOUBLE * words, weight * level) AS target FROM weighed, level
), placed AS (
  SELECT d.*, t.words AS source_size, t.target, t.turn,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM sized AS d JOIN targets AS t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, greatest(0, least(size, floor(target + 0.5) - first)) AS one,
         greatest(0, least(size, floor(target + 0.5) - first - source_size)) AS two,
         first / target AS share
  FROM placed
)
SELECT doc_id, size, source_size, source, target, CAST(one + two AS BIGINT) AS taken,
       CASE WHEN one <= 0 THEN NULL
            WHEN share <= 0 THEN 0.0
            WHEN turn = 0 THEN least(1.0::DOUBLE, 2 * (share * 3) / (4 + sqrt(16 - 4 * (share * 3))))
            WHEN turn = 1 THEN least(1.0::DOUBLE, 2 * share / 2)
            WHEN share * 2 < 0.75 THEN least(1.0::DOUBLE, 2 * (share * 2) / (1 + sqrt(1 + 4 * (share * 2))))
            WHEN share * 2 = 0.75 THEN 0.5
            ELSE least(1.0::DOUBLE, 0.5 + 2 * (share * 2 - 0.75) / (2 + sqrt(4 + 4 * (share * 2 - 0.75)))) END AS position
FROM taken
"""


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), judged AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), failed AS (
  SELECT t.part, coalesce(j.good, 0) AS good, coalesce(j.toxic, 0) AS toxic,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_extract_all(t.t, '[A-Z]')) > 3 * length(t.t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t.t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY t.t) THEN 16 ELSE 0 END AS bits
  FROM texts AS t LEFT JOIN judged AS j ON t.doc_id = j.doc_id
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM orders, range(1, 6) AS s(step)
)
SELECT part, filter_order, step,
       count(*) FILTER (bits & (bit | before) = 0) AS kept,
       count(*) FILTER (bits & bit <> 0 AND bits & before = 0) AS removed,
       count(*) FILTER (bits & bit <> 0 AND bits & before <> 0) AS redundant,
       count(*) FILTER (bits = bit) AS unique_fails,
       count(*) FILTER (bits & bit <> 0 AND bits & before = 0 AND good = 1) AS good_lost,
       count(*) FILTER (bits & bit <> 0 AND bits & before = 0 AND toxic = 1) AS toxic_lost,
       CAST(sum(CASE WHEN bits & bit <> 0 THEN 120 // bit_count(bits) ELSE 0 END) AS BIGINT) AS shapley
FROM failed, steps GROUP BY part, filter_order, step
"""
