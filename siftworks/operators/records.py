"""Candidate records: keys, the scoring of discovery, its funnel, content deduplication with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import unused

#: Columns of a record and their types.
RECORD = dict(c.split(" ", 1) for c in (
    "source string, source_id string, title string, landing_url string, candidate_urls array<string>, abstract string, authors array<string>, organization string, pub_date string, doc_type string, "
    "subject_terms array<string>, rights string, export_control boolean, export_control_reason string, lexicon_score double, tier string, matched_terms array<string>, retrieved_at timestamp, raw_metadata string").split(", "))


def record_key(source: Column | str = "source", source_id: Column | str = "source_id") -> Column:
    return F.concat_ws(":", source, source_id)


def conform(df: DataFrame) -> DataFrame:
    """df with exactly the columns of a record; what it lacks is null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in RECORD.items()])


def split_export_control(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(free, controlled): controlled records are set aside before any scoring, with a reason."""
    flag = F.coalesce(F.col("export_control"), F.lit(False))
    return records.where(~flag), records.where(flag).withColumns({"status": F.lit("export_control"), "reason": F.coalesce("export_control_reason", F.lit("export control"))})


def queued(scored: DataFrame, negative: str = "negative_sample") -> DataFrame:
    return scored.where(F.col("tier") != negative)


def add_if_absent(known: DataFrame, new: DataFrame, key: str = "key", seq: str | None = None) -> DataFrame:
    """Rows of `new` whose key isn't known, each key once (the first by seq). Known rows are never touched."""
    fresh = new.join(known.select(key).distinct(), key, "left_anti")
    if seq is None:
        return fresh.dropDuplicates([key])
    nth = unused(fresh, "nth")
    return fresh.withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(seq))).where(F.col(nth) == 1).drop(nth)


def discovery_funnel(scored: DataFrame, known: DataFrame | None = None, by: list[str] | None = None, negative: str = "negative_sample") -> DataFrame:
    """seen, export-controlled, dropped, new and known records and records by tier, in one pass."""
    flag = F.coalesce(F.col("export_control"), F.lit(False)) if "export_control" in scored.columns else F.lit(False)
    held, known_to = unused(scored, "held"), unused(scored, "known_to")
    df = scored.withColumn(held, flag)
    if known is not None:
        df = df.join(known.select("key").distinct().withColumn(known_to, F.lit(True)), "key", "left")
    else:
        df = df.withColumn(known_to, F.lit(None).cast("boolean"))
    kept = ~F.col(held) & (F.col("tier") != negative)
    count = lambda c: F.count_if(c)
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("seen"), count(F.col(held)).alias("export_controlled"), count(~F.col(held) & (F.col("tier") == negative)).alias("dropped"),
        count(kept & F.col(known_to).isNull()).alias("new"), count(kept & F.col(known_to).isNotNull()).alias("known"),
        count(kept & (F.col("tier") == "strong")).alias("strong"), count(kept & (F.col("tier") == "weak")).alias("weak"))


def provenance(stored: DataFrame, sha: str = "sha256", key: str = "key", seq: str = "seq") -> DataFrame:
    """(sha, key, seq): every key of every content with its first arrival, one row each however many keys a content has."""
    return stored.groupBy(sha, key).agg(F.min(seq).alias(seq))


def content_table(stored: DataFrame, sha: str = "sha256", key: str = "key", seq: str = "seq", carry: tuple[str, ...] = (), listed: int | None = None) -> DataFrame:
    """One row a content: provenance (distinct keys in order of arrival), the number of keys, the first key and seq, and the first row's other columns.

    `listed` makes provenance a view of that many first keys, for listings: the whole of it is then the table that
    `provenance` gives, which no common content gathers in one row.
    """
    first = unused(stored, "first")
    per = stored.groupBy(sha, key).agg(F.min(seq).alias(first), *[F.min_by(c, seq).alias(c) for c in carry])
    shown = per
    if listed is not None:
        # of each part of a content's keys the first `listed`, then of those: no window holds all keys of a content
        part, nth = unused(per, "part"), unused(per, "nth")
        some = per.withColumn(part, F.pmod(F.xxhash64(key), F.lit(64)))
        some = some.withColumn(nth, F.row_number().over(Window.partitionBy(sha, part).orderBy(first, key))).where(F.col(nth) <= listed)
        shown = some.withColumn(nth, F.row_number().over(Window.partitionBy(sha).orderBy(first, key))).where(F.col(nth) <= listed)
    keys = shown.groupBy(sha).agg(F.transform(F.array_sort(F.collect_list(F.struct(first, key))), lambda x: x[key]).alias("provenance"))
    facts = per.groupBy(sha).agg(F.count(F.lit(1)).alias("n_keys"), F.min(first).alias("first_seq"), F.min_by(key, first).alias("first_key"), *[F.min_by(c, first).alias(c) for c in carry])
    return keys.join(facts, sha)


def first_writer(rows: DataFrame, sha: str = "sha256", seq: str = "seq") -> DataFrame:
    """rows with status: the first of a content is stored, the others are duplicates. Minima per content, so no window holds a hot one."""
    first = unused(rows, "first")
    firsts = rows.groupBy(sha).agg(F.min(seq).alias(first))
    return rows.join(firsts, sha).withColumn("status", F.when(F.col(seq) == F.col(first), "stored").otherwise("duplicate")).drop(first)


def overlap_pairs(keys: DataFrame, sha: str = "sha256", source: str = "source") -> DataFrame:
    """(sources "a x b", n): contents that stand in more than one source, by their sorted sources."""
    sets = keys.select(sha, source).distinct().groupBy(sha).agg(F.array_sort(F.collect_list(source)).alias("s")).where(F.size("s") > 1)
    return sets.groupBy(F.array_join("s", " x ").alias("sources")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_stats(keys: DataFrame, sha: str = "sha256", key: str = "key") -> DataFrame:
    """unique_contents and multi_contents: contents with more than one key, of one source or of several."""
    per = keys.select(sha, key).distinct().groupBy(sha).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("unique_contents"), F.count_if(F.col("n") > 1).alias("multi_contents"))


def pdf_only(records: DataFrame, urls: str = "candidate_urls") -> DataFrame:
    """Records with at least one url whose path ends in .pdf, other urls removed."""
    path = lambda u: F.lower(F.regexp_replace(u, r"[?#].*$", ""))
    return records.withColumn(urls, F.filter(urls, lambda u: path(u).endswith(".pdf"))).where(F.size(urls) > 0)
