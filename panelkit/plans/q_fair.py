"""Fairness (FAIR), fuzzy matching (MAT) and trade-text extraction (TXT)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import fairness as fr
from panelkit.operators import match as mt
from panelkit.plans.common import rounded, sig_sql
from panelkit.plans.registry import register, with_ctes
from panelkit.sources import testdata as td


def credit(spark: SparkSession, d: str) -> DataFrame:
    return fr.protected_flag(td.credit(spark, d), F.col("lang") == "en")


PRIV_SQL = """cr AS (SELECT doc_id, favourable, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS privileged FROM credit)"""


@register("fair1_protected_flag", with_ctes(td.CREDIT_SQL, PRIV_SQL, body="SELECT doc_id, privileged FROM cr"))
def fair1_protected_flag(spark: SparkSession, d: str) -> DataFrame:
    return credit(spark, d).select("doc_id", "privileged")


@register("fair2_mean_difference", with_ctes(td.CREDIT_SQL, PRIV_SQL, body=f"""
SELECT {sig_sql('avg(favourable) FILTER (WHERE privileged = 0) - avg(favourable) FILTER (WHERE privileged = 1)')}
  AS mean_difference FROM cr"""))
def fair2_mean_difference(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fr.mean_difference(credit(spark, d), "privileged", "favourable"), sig_cols=["mean_difference"])


@register("fair3_reweigh", with_ctes(td.CREDIT_SQL, PRIV_SQL, """c AS (
  SELECT privileged, favourable, count(*) AS n_gy FROM cr GROUP BY 1, 2)""", body=f"""
SELECT privileged, favourable, n_gy,
  {sig_sql('(sum(n_gy) OVER (PARTITION BY privileged)) * (sum(n_gy) OVER (PARTITION BY favourable)) / ((sum(n_gy) OVER ()) * n_gy)')}
  AS weight FROM c"""))
def fair3_reweigh(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fr.reweigh_weights(credit(spark, d), "privileged", "favourable"), sig_cols=["weight"])


@register("fair3_weighted_difference", with_ctes(td.CREDIT_SQL, PRIV_SQL, body="""
SELECT round(1.0 * count(*) FILTER (WHERE favourable = 1 AND privileged = 0) / count(*) FILTER (WHERE privileged = 0)
  - 1.0 * count(*) FILTER (WHERE favourable = 1 AND privileged = 1) / count(*) FILTER (WHERE privileged = 1), 4)
  AS mean_difference, CAST(0.0 AS DOUBLE) AS weighted_mean_difference FROM cr"""))
def fair3_weighted_difference(spark: SparkSession, d: str) -> DataFrame:
    """Reweighing drives the weighted mean difference to 0 (checked to 1e-9, reported rounded)."""
    c = fr.reweigh(credit(spark, d), "privileged", "favourable")
    a = fr.mean_difference(c, "privileged", "favourable")
    b = fr.mean_difference(c, "privileged", "favourable", weight="weight").select(
        F.col("mean_difference").alias("weighted_mean_difference"))
    out = a.crossJoin(b)
    return rounded(out).withColumn("weighted_mean_difference", F.col("weighted_mean_difference") + F.lit(0.0))


# ---------------------------------------------------------------- matching
WORDS_SQL = """words AS (
  SELECT DISTINCT lower(w) AS token FROM (SELECT unnest(regexp_split_to_array(text, '[^\\p{L}]+')) AS w FROM documents)
  WHERE length(w) >= 1)"""


def words(spark: SparkSession, d: str) -> DataFrame:
    """Words (runs of letters of any script) of every document, lower-cased."""
    docs = td.table(spark, d, "documents").select(F.explode(F.split("text", r"[^\p{L}]+")).alias("w"))
    return docs.filter(F.length("w") >= 1).select(F.lower("w").alias("token"))


def part_names(spark: SparkSession, d: str) -> DataFrame:
    """The reference list: distinct part names."""
    return td.table(spark, d, "part").select(F.lower("p_name").alias("name")).distinct()


# DuckDB's levenshtein counts bytes: letters beyond ASCII occur in no part name, so one sign stands for each.
@register("mat2_best_match", with_ctes(WORDS_SQL, body="""
SELECT token, best_match, score, CAST(score AS VARCHAR) || '%' AS score_text FROM (
  SELECT w.token, n.name AS best_match,
    CAST(round(100.0 * (1.0 - levenshtein(regexp_replace(w.token, '[^\\x00-\\x7F]', '#', 'g'), n.name) / greatest(length(w.token), length(n.name)))) AS INTEGER) AS score,
    row_number() OVER (PARTITION BY w.token ORDER BY
      round(100.0 * (1.0 - levenshtein(regexp_replace(w.token, '[^\\x00-\\x7F]', '#', 'g'), n.name) / greatest(length(w.token), length(n.name)))) DESC, n.name) AS rn
  FROM words w JOIN (SELECT DISTINCT lower(p_name) AS name FROM part) n ON substr(w.token, 1, 3) = substr(n.name, 1, 3))
WHERE rn = 1"""))
def mat2_best_match(spark: SparkSession, d: str) -> DataFrame:
    """Every document word matched to the closest part name sharing its first 3 letters."""
    return mt.best_match(words(spark, d), part_names(spark, d), "token", "name", block=3)


# One row of the longest-common-subsequence table per letter of the token.
LCS_SQL = [WORDS_SQL, """pairs AS (SELECT w.token, n.name FROM words w JOIN (SELECT DISTINCT lower(p_name) AS name FROM part) n
  ON substr(w.token, 1, 3) = substr(n.name, 1, 3))""", """lcs(token, name, i, line) AS (
  SELECT token, name, 0, list_transform(range(length(name) + 1), lambda x: 0) FROM pairs
  UNION ALL SELECT token, name, i + 1, list_transform(range(1, length(name) + 2), lambda j: list_max(list_transform(range(1, j + 1),
    lambda k: greatest(line[k], CASE WHEN k > 1 AND substr(name, k - 1, 1) = substr(token, i + 1, 1) THEN line[k - 1] + 1 ELSE 0 END))))
  FROM lcs WHERE i < length(token))""", """scored AS (SELECT token, name, CAST(CASE WHEN length(token) + length(name) = 0 THEN 100 ELSE
    round_even(200.0 * line[length(name) + 1] / (length(token) + length(name)), 0) END AS INTEGER) AS score
  FROM lcs WHERE i = length(token))"""]


@register("mat1_similarity_ratio", with_ctes(*LCS_SQL, body="""
SELECT token, name AS best_match, score, CAST(score AS VARCHAR) || '%' AS score_text FROM (
  SELECT *, row_number() OVER (PARTITION BY token ORDER BY score DESC, name) AS rn FROM scored) WHERE rn = 1""").replace(
    "WITH", "WITH RECURSIVE", 1))
def mat1_similarity_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Same blocked candidates scored by the ratio of the longest common subsequence."""
    return mt.best_match(words(spark, d), part_names(spark, d), "token", "name", block=3, score="ratio")


@register("mat3_contains_match", with_ctes(WORDS_SQL, body="""
SELECT w.token, p.p_partkey FROM words w JOIN part p ON contains(lower(p.p_name), w.token)"""))
def mat3_contains_match(spark: SparkSession, d: str) -> DataFrame:
    """Document words found inside part names (case-insensitive), trigram-blocked."""
    parts = td.table(spark, d, "part").select("p_partkey", "p_name")
    return mt.contains_match(words(spark, d), parts, "token", "p_name", ["p_partkey"])


# The oracle's own statement of the contract's fixed values.
FR_SQL = "['½', '⅓', '¼', '⅕', '⅙', '⅐', '⅛', '⅑', '⅔', '⅖', '²⁄₇', '²⁄₉']"


DATED_SQL = """t AS (SELECT doc_id, string_split(text || ' ' || strftime(DATE '2000-01-01' + CAST(doc_id % 9000 AS INTEGER), '%m/%d/%y')
    || ' 13/01/20 ' || CASE doc_id % 3 WHEN 0 THEN '5usd' WHEN 1 THEN '€7' ELSE '' END || ' 1.5% ½', ' ') AS toks FROM documents)"""


def dated(spark: SparkSession, d: str) -> DataFrame:
    """The documents' texts, each with a date, currency and rate tokens that follow from its doc_id."""
    day = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (F.col("doc_id") % 9000).cast("int")), "MM/dd/yy")
    cur = F.when(F.col("doc_id") % 3 == 0, "5usd").when(F.col("doc_id") % 3 == 1, "€7").otherwise("")
    return td.table(spark, d, "documents").select("doc_id", F.concat(
        F.col("text"), F.lit(" "), day, F.lit(" 13/01/20 "), cur, F.lit(" 1.5% ½")).alias("text"))


@register("txt1_extract_trade_fields", with_ctes(DATED_SQL, body=f"""
SELECT doc_id,
  list_filter(list_transform(toks, lambda x: CASE WHEN contains(x, '$') OR contains(x, 'usd') THEN 'dollar'
    WHEN contains(x, '€') OR contains(x, 'eur') THEN 'euro'
    WHEN contains(x, '¥') OR contains(x, 'yen') THEN 'yen' END), lambda y: y IS NOT NULL)[1] AS currency,
  CAST(list_filter(list_transform(toks, lambda x: try_strptime(substr(x, 1, 8), '%m/%d/%y')),
    lambda z: z IS NOT NULL)[1] AS DATE) AS trade_date,
  array_to_string(list_filter(toks, lambda x: (length(x) - length(replace(x, '.', '')) <= 1
    AND length(x) - length(replace(x, '%', '')) <= 1
    AND regexp_full_match(replace(replace(x, '.', ''), '%', ''), '[0-9]+')) OR list_contains({FR_SQL}, x)), ' ') AS rates
FROM t"""))
def txt1_extract_trade_fields(spark: SparkSession, d: str) -> DataFrame:
    """Currency, first MM/dd/yy date and rate tokens of every document (whole texts)."""
    return mt.extract_trade_fields(dated(spark, d), "text").drop("text")
