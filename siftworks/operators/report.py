"""Counts, cross-tabulations, totals, deltas and listings over the state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import unused
from .records import duplicate_stats, overlap_pairs

COUNTABLE = ("status", "tier", "source")


def counts_by(docs: DataFrame, column: str) -> DataFrame:
    if column not in COUNTABLE:
        raise ValueError(f"counts are kept by {', '.join(COUNTABLE)}, not {column}")
    return docs.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def cross_tab(docs: DataFrame, rows: str = "source", cols: str = "status") -> DataFrame:
    return docs.groupBy(rows, cols).agg(F.count(F.lit(1)).alias("n"))


def pending_by_source(docs: DataFrame, tiers: list[str] | None = None) -> DataFrame:
    """Pending documents of the tiers (all if none) by source, and their total in the row of source null."""
    out = docs.where(F.col("status") == "discovered")
    if tiers:
        out = out.where(F.col("tier").isin(*tiers))
    return out.rollup("source").agg(F.count(F.lit(1)).alias("n"))


def totals(docs: DataFrame, content: DataFrame) -> DataFrame:
    """One row: documents, bytes, unique contents and contents of several keys. content: sha256, key, size_bytes."""
    sizes = content.groupBy("sha256").agg(F.min("size_bytes").alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"))
    return docs.agg(F.count(F.lit(1)).alias("documents")).crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(duplicate_stats(content)))  # one row each


def totals_json(docs: DataFrame, content: DataFrame) -> DataFrame:
    """The totals, counts and overlaps as one JSON document."""
    parts = [counts_by(docs, c).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(c, F.lit("")), "n")))).alias(f"by_{c}")) for c in COUNTABLE]
    pairs = overlap_pairs(content).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sources", "n")))).alias("overlap"))
    out = totals(docs, content)
    for p in [*parts, pairs]:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out.select(F.to_json(F.struct(*out.columns)).alias("report"))


def deltas(before: DataFrame, now: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """now minus before for every key of either; keys that didn't change are left out."""
    was, is_ = unused(before, "was"), unused(now, "is")
    b, a = before.select(*keys, F.col(n).alias(was)), now.select(*keys, F.col(n).alias(is_))
    return a.join(b, keys, "full_outer").withColumn("delta", F.coalesce(is_, F.lit(0)) - F.coalesce(was, F.lit(0))).where("delta <> 0").select(*keys, "delta")


def browse(docs: DataFrame, content: DataFrame, limit: int | None = None, abstract: str = "abstract") -> DataFrame:
    """Stored documents with what is known of their content, best first, as listed cards."""
    joined = docs.where(F.col("stored_path").isNotNull()).join(content, "sha256", "left")
    out = joined.withColumns({"search_text": F.lower(F.concat_ws(" ", "title", "source", abstract)), "first_terms": F.slice("matched_terms", 1, 5)})
    out = out.orderBy(F.desc("lexicon_score"), "title", "key")
    return out if limit is None else out.limit(limit)


def corpus_html(cards: DataFrame, path: str, title: str = "Corpus", per_page: int = 2000) -> None:
    """All cards as HTML pages of per_page rows under path, each with a search field, and facets of source and tier.

    Pages are rows of a text table that executors write; the driver holds none of them.
    """
    cell = lambda c: F.concat(F.lit("<td>"), _escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))))
    facet = lambda c: F.concat(F.lit(f' data-{c}="'), _escaped(F.coalesce(F.col(c), F.lit(""))), F.lit('"'))
    row = F.concat(F.lit("<tr"), facet("source"), facet("tier"), F.lit(">"), *[cell(c) for c in ("title", "source", "tier", "lexicon_score", "stored_path")])
    n = cards.count()
    pages = max(1, -(-n // per_page))
    placed = cards.repartitionByRange(pages, F.desc("lexicon_score"), "title", "key").sortWithinPartitions(F.desc("lexicon_score"), "title", "key")

    def paged(batches):
        import pyarrow as pa

        head = _PAGE.replace("@title", _plain(title))
        rows = [r for b in batches for r in b.column(0).to_pylist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([head + "\n".join(rows) + "</table>"])], names=["value"])

    placed.select(row.alias("value")).mapInArrow(paged, "value string").write.mode("overwrite").text(path)


def _plain(text: str) -> str:
    import html

    return html.escape(text)


def _escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


_PAGE = """<!doctype html><meta charset="utf-8"><title>@title</title><input id="words" placeholder="search"><input id="source" placeholder="source"><input id="tier" placeholder="tier">
<script>addEventListener("input", () => { const of = (k) => document.getElementById(k).value.toLowerCase(); for (const r of document.querySelectorAll("tr[data-source]"))
r.hidden = !r.textContent.toLowerCase().includes(of("words")) || !r.dataset.source.toLowerCase().includes(of("source")) || !r.dataset.tier.toLowerCase().includes(of("tier")) })</script>
<table><tr><th>title<th>source<th>tier<th>score<th>file
"""


def stored_document(docs: DataFrame, sha256: str) -> DataFrame:
    """The stored document of a hash: 64 hex digits, and a path that stays below the corpus."""
    import re

    if not re.fullmatch("[0-9a-f]{64}", sha256):
        return docs.limit(0)
    return docs.where((F.col("sha256") == sha256) & F.col("stored_path").isNotNull() & ~F.col("stored_path").rlike(r"(^|/)\.\.(/|$)|^/")).limit(1)


def harvest_rate(visits: DataFrame, by: str = "source") -> DataFrame:
    """pages, documents, relevant documents and relevant for each page."""
    out = visits.groupBy(by).agg(F.count(F.lit(1)).alias("pages"), F.sum("documents").alias("documents"), F.sum("relevant").alias("relevant"))
    return out.withColumn("harvest_rate", F.col("relevant") / F.greatest(F.col("pages"), F.lit(1)))


def gain(focused: DataFrame, breadth: DataFrame, by: str = "source") -> DataFrame:
    """The focused rate over the breadth-first one; null where that is 0."""
    f, b = focused.select(by, F.col("harvest_rate").alias("focused")), breadth.select(by, F.col("harvest_rate").alias("breadth"))
    return f.join(b, by).withColumn("gain", F.try_divide("focused", "breadth"))


def origin_counts(index: DataFrame, eligible: DataFrame | None = None, key: str = "sha256") -> DataFrame:
    """Texts and illegible texts by origin; with the eligible documents also, in a row of origin missing, how many have no text."""
    out = index.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("legible")).alias("illegible"))
    if eligible is None:
        return out
    without = eligible.select(key).distinct().join(index.select(key).distinct(), key, "left_anti")
    return out.unionByName(without.agg(F.lit("missing").alias("origin"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("illegible")))


def describe_sources(specs: DataFrame, docs: DataFrame) -> DataFrame:
    """specs (source, kind, name, address) as cards: a title (the name, else the source in words), a host, and documents, stored and first seen.

    Sources that only the documents know get a card of their own, of the kind unknown.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("status") == "stored").alias("stored"))
    cards = specs.select("source", "kind", "name", "address").join(counts, "source", "full_outer")
    words = F.initcap(F.regexp_replace("source", "[_-]+", " "))
    host = F.nullif(F.regexp_extract(F.lower(F.coalesce("address", F.lit(""))), "^[a-z]+://([^/:?#]+)", 1), F.lit(""))
    return cards.select("source", F.coalesce("kind", F.lit("unknown")).alias("kind"), F.coalesce(F.nullif(F.trim("name"), F.lit("")), words).alias("title"), host.alias("host"),
                        F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("stored", F.lit(0)).alias("stored"))
