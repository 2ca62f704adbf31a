"""Links of pages: priorities from a lexicon, and which page describes which document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import Lexicon, score_columns
from ..functions.text import normalize_text, padded, unused
from ..functions.urls import canonicalize, is_noise, url_text


@dataclass(frozen=True)
class LinkWeights:
    url: float = 1.0
    anchor: float = 0.7
    context: float = 0.25
    document: float = 3.0
    depth: float = 0.8
    noise: float = 4.0
    seed: float = 1000.0
    declared: float = 5.0


def with_priority(links: DataFrame, lex: Lexicon, w: LinkWeights = LinkWeights(), enabled: bool = True) -> DataFrame:
    """links (url, anchor, context, depth, is_document) with from_url, from_anchor, from_context, noise and priority; 0 throughout if not enabled."""
    if not enabled:
        return links.withColumns({c: F.lit(0.0) for c in ("from_url", "from_anchor", "from_context", "priority")} | {"noise": F.lit(False)})
    t = unused(links, "texts")
    texts = F.struct(padded(normalize_text(url_text(F.col("url")))).alias("url"), padded(normalize_text(F.col("anchor"))).alias("anchor"), padded(normalize_text(F.col("context"))).alias("context"))
    df = links.withColumn(t, F.explode_outer(F.array(texts))).withColumn("noise", is_noise(F.col("url")))
    none = F.lit("  ")
    df = df.withColumns({"from_url": score_columns(lex, F.col(f"{t}.url"), none)["lexicon_score"], "from_anchor": score_columns(lex, F.col(f"{t}.anchor"), none)["lexicon_score"],
                         "from_context": score_columns(lex, none, F.col(f"{t}.context"))["lexicon_score"]})
    priority = (F.col("from_url") * w.url + F.col("from_anchor") * w.anchor + F.col("from_context") * w.context
                + F.coalesce(F.col("is_document"), F.lit(False)).cast("int") * w.document - F.col("depth") * w.depth - F.col("noise").cast("int") * w.noise)
    return df.withColumn("priority", priority).drop(t)


def exploded(pages: DataFrame, *keep: str) -> DataFrame:
    """One row a link of pages that went through extraction."""
    return pages.select(*keep, F.explode("links").alias("l")).select(*keep, "l.*")


def documents_per_page(links: DataFrame, page: str = "page_id") -> DataFrame:
    return links.groupBy(page).agg(F.count_if("is_document").alias("documents"), F.count(F.lit(1)).alias("links"))


def describes(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """documents (url, parent) with the parent page's meta where that page is the document's own: it names it, or has no other document.

    pages: url, meta, documents. A parent that isn't known counts as a listing.
    """
    n = unused(documents, "siblings")
    p = pages.select(F.col("url").alias("parent"), "meta", F.col("documents").alias(n))
    joined = documents.join(p, "parent", "left")
    own = F.coalesce(canonicalize(F.col("meta.pdf_url")) == canonicalize(F.col("url")), F.lit(False)) | (F.coalesce(n, F.lit(99)) == 1)
    return joined.withColumn("meta", F.when(own, F.col("meta"))).withColumn("is_landing", F.col("meta").isNotNull()).drop(n)
