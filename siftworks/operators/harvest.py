"""Harvest: attempts in order of preference, their outcome, and the stored contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.content import sniff_kind, storage_path
from ..functions.text import unused
from .records import first_writer

DOCUMENT_KINDS = ("pdf", "zip", "ole")


def outcomes(pending: DataFrame, fetched: DataFrame, largest: int = 200 << 20, kinds: tuple[str, ...] = DOCUMENT_KINDS) -> DataFrame:
    """One row a record: the first url, in its order, that gave a document (or is unchanged), else why there is none.

    pending: key, candidate_urls. fetched: url, http_status, content_type, body binary, error.
    A text is taken only from a url that ends in .txt; a body that isn't what was asked for, or is too large, is rejected.
    """
    tries = pending.select("key", F.posexplode_outer("candidate_urls").alias("attempt", "url")).join(fetched, "url", "left")
    kind = sniff_kind(F.col("body"), F.col("content_type"))
    tries = tries.withColumn("content_kind", F.when(F.col("body").isNotNull(), kind)).withColumn("size_bytes", F.length("body"))
    wanted = F.col("content_kind").isin(*kinds) | (F.lower("url").endswith(".txt") & F.col("content_kind").isin("text", "html", "xml"))
    outcome = (F.when(F.col("http_status") == 304, "unchanged").when(F.col("url").isNull(), "no_url").when(F.col("http_status").isNull() | (F.col("http_status") >= 400), "failed")
               .when(F.col("size_bytes") > largest, "too_large").when(F.coalesce(wanted, F.lit(False)), "fetched").otherwise("not_a_document"))
    tries = tries.withColumn("outcome", outcome).withColumn("good", F.col("outcome").isin("fetched", "unchanged"))
    best = F.min_by(F.struct("url", "http_status", "content_kind", "size_bytes", "outcome", "error", "body"), F.struct((~F.col("good")).alias("g"), F.col("attempt")))
    return tries.groupBy("key").agg(best.alias("b"), F.count("url").alias("attempts")).select("key", "attempts", "b.*")


def stored(outcome: DataFrame, seq: DataFrame | None = None, base: str = "raw") -> DataFrame:
    """Outcomes with sha256, stored_path and status: the first record of a content stores it, later ones are duplicates."""
    rows = outcome.where("outcome = 'fetched'").withColumn("sha256", F.sha2("body", 256)).withColumn("seq", F.col("key")).drop("body")
    rows = first_writer(rows).withColumn("stored_path", storage_path(F.col("sha256"), F.col("content_kind"), base))
    rest = outcome.where("outcome <> 'fetched'").drop("body").withColumn("status", F.when(F.col("outcome") == "unchanged", "unchanged").otherwise("failed"))
    return rows.drop("seq").unionByName(rest, allowMissingColumns=True)


def funnel(done: DataFrame) -> DataFrame:
    c = F.col
    return done.agg(F.count(F.lit(1)).alias("attempted"), F.count_if(c("status") == "stored").alias("stored"), F.count_if(c("status") == "duplicate").alias("duplicates"),
                    F.count_if(c("status") == "unchanged").alias("unchanged"), F.count_if(c("status") == "failed").alias("failed"), F.count_if(c("outcome") == "not_a_document").alias("not_documents"),
                    F.count_if(c("outcome") == "too_large").alias("too_large"), F.coalesce(F.sum(F.when(c("status") == "stored", c("size_bytes"))), F.lit(0)).alias("bytes"))


def conditional(pending: DataFrame, docs: DataFrame) -> DataFrame:
    """pending with the etag and last_modified to ask with."""
    return pending.join(docs.select("key", "etag", "last_modified"), "key", "left")


def withdraw(docs: DataFrame, redistributions: DataFrame) -> DataFrame:
    """docs with the status withdrawn for keys that aren't available any more. redistributions: key, available string."""
    flag = unused(docs, "gone")
    gone = redistributions.where(F.lower(F.col("available")).isin("false", "none")).select("key").distinct().withColumn(flag, F.lit(True))
    return docs.join(gone, "key", "left").withColumn("status", F.when(F.col(flag), "withdrawn").otherwise(F.col("status"))).drop(flag)


def capped_by_term(hits: DataFrame, cap: int = 500, term: str = "term", order: str = "pos") -> DataFrame:
    nth = unused(hits, "nth")
    return hits.withColumn(nth, F.row_number().over(Window.partitionBy(term).orderBy(order))).where(F.col(nth) <= cap).drop(nth)
