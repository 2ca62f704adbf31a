"""Stand-ins for queries on tables that hold no real records: a lexicon of common words, titles and keys of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexicon import Lexicon
from ..operators.bands import BandRules
from ..operators.records import record_key

LEXICON = Lexicon(strong=("it and", "for and", "nicht", "para"), moderate=("of the", "les", "los"), structural=("and the", "was the", "this the"), adversarial=("der", "is the", "license"))
RULES = BandRules(domain=(("que la", "des les", "is of"), ("la", "und")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as records: key, the first line as title, the rest as body."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    title = F.substring_index("text", "\n", 1)
    return d.withColumn("key", record_key("source", F.col("doc_id").cast("string"))).withColumn("title", title).withColumn("body", F.expr("substring(text, length(title) + 2)"))


# ---------------------------------------------------------------- the same in SQL


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', ' ', 'g'))"


BASE = f"""
b AS (SELECT doc_id, source, lang, text, source || ':' || doc_id AS key, split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS body FROM documents),
n AS (SELECT *, ' ' || {norm('title')} || ' ' AS nt, ' ' || {norm('body')} || ' ' AS nb, ' ' || {norm('text')} || ' ' AS nx FROM b)"""


def _hit(col: str, t: str) -> str:
    return f"contains({col}, ' {t} ')"


def _count(col: str, terms) -> str:
    return "(" + " + ".join(f"{_hit(col, t)}::INTEGER" for t in terms) + ")"


def _any(col: str, terms) -> str:
    return "(" + " OR ".join(_hit(col, t) for t in terms) + ")"


def scored(lex: Lexicon = LEXICON) -> str:
    """CTEs b, n and s; s has score, flags and tier."""
    both = "(" + " + ".join(f"({_hit('nt', t)} OR {_hit('nb', t)})::INTEGER" for t in lex.structural) + ")"
    matched = ", ".join(f"CASE WHEN {_hit('nt', t)} OR {_hit('nb', t)} THEN '{t}' END" for t in sorted({*lex.strong, *lex.moderate, *lex.structural}))
    return f"""{BASE},
c AS (SELECT *, (10 * {_count('nt', lex.strong)} + 3 * {_count('nb', lex.strong)} + 2 * {_count('nt', lex.moderate)} + 0.5 * {_count('nb', lex.moderate)} + 4 * {both}
  - 6 * {_count('nt', lex.adversarial)} - 1.5 * {_count('nb', lex.adversarial)})::DOUBLE AS lexicon_score,
  {_any('nt', lex.strong)} AS strong_in_title, {_any('nt', lex.adversarial)} AS adversarial_in_title, {both} AS structural_hits,
  list_filter([{matched}], lambda x: x IS NOT NULL) AS matched FROM n),
s AS (SELECT *, CASE WHEN strong_in_title AND NOT adversarial_in_title THEN 'strong' WHEN lexicon_score >= 10 AND NOT adversarial_in_title THEN 'strong'
  WHEN lexicon_score >= 2.5 THEN 'weak' ELSE 'negative_sample' END AS tier FROM c)"""


def occurrences(col: str, t: str) -> str:
    p = f" {t} "
    return f"((length({col}) - length(replace({col}, '{p}', ''))) // {len(p)})"
