"""Best-first crawling over a table of pages, in rounds.

A round claims the best `batch` pending urls (1 gives exact best-first order), joins them with the pages, extracts and
scores their links, and merges them into the queue. The queue is checkpointed each round; the driver sees counters only.
"""

from __future__ import annotations

import re
import tempfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.html import extract, metadata
from ..functions.lexicon import NEGATIVE, Lexicon, with_score
from ..functions.urls import DOCUMENT_EXTENSIONS, best_title, canonical_url, in_scope, is_document, trap_reason
from ..operators.frontier import PENDING, VISITED, merge_found, set_state, url_head
from ..operators.links import LinkWeights, describes, exploded, with_priority


@dataclass(frozen=True)
class CrawlRules:
    seeds: tuple[str, ...]
    source: str = "crawl"
    allow_hosts: tuple[str, ...] = ()
    block_hosts: tuple[str, ...] = ()
    allow_paths: tuple[str, ...] = ()
    deny_paths: tuple[str, ...] = ()
    most_pages: int = 100
    most_documents: int = 1_000_000
    most_depth: int = 5
    batch: int = 1
    focused: bool = True
    document_extensions: tuple[str, ...] = tuple(DOCUMENT_EXTENSIONS)
    document_patterns: tuple[str, ...] = ()


_URLS = "source string, url string, depth int, priority double, state string, kind string, anchor string, parent string, seq bigint"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder the session names; one of our own only on a single machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="siftworks-checkpoint-"))


def crawl(pages: DataFrame, lex: Lexicon, rules: CrawlRules, weights: LinkWeights = LinkWeights(), urls: DataFrame | None = None) -> DataFrame:
    """The queue after the crawl: every url found, pages visited in `seq` order, documents with kind document. pages: url, html."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    known = pages.select(canonical_url(F.col("url")).alias("url"), "html")
    if urls is None:
        seeds = spark.createDataFrame([(rules.source, s, 0, weights.seed, PENDING, "page", None, None, i) for i, s in enumerate(rules.seeds)], _URLS)
        urls = seeds.withColumn("url", canonical_url(F.col("url")))
    urls = urls.checkpoint(True)
    visited = documents = 0
    number = len(rules.seeds)
    while visited < rules.most_pages and documents < rules.most_documents:
        head = url_head(urls, min(rules.batch, rules.most_pages - visited)).checkpoint(True)
        n = head.count()
        if not n:
            break
        visited += n
        # a round's pages in the order in which they would be visited one by one, which orders what they lead to
        rank = F.row_number().over(Window.orderBy(F.desc("priority"), "depth", "seq")) - 1  # at most `batch` rows
        got = metadata(extract(head.select("source", "url", "depth", F.col("anchor").alias("led"), rank.alias("rank")).join(known, "url"), extensions=rules.document_extensions))
        got = got.select("source", "url", "depth", "rank", "led", "links", F.col("meta.title").alias("title"), F.col("meta.pdf_url").alias("pdf_url")).checkpoint(True)
        links = exploded(got.withColumnsRenamed({"url": "parent", "depth": "d"}), "source", "parent", "d", "rank").withColumn("url", canonical_url(F.col("url")))
        kept = links.where((F.col("d") < rules.most_depth) & in_scope(F.col("url"), rules.allow_hosts, rules.block_hosts, rules.allow_paths, rules.deny_paths) & trap_reason(F.col("url")).isNull())
        kept = kept.withColumn("is_document", F.col("is_document") | is_document(F.col("url"), rules.document_extensions, rules.document_patterns)).withColumn("depth", F.col("d") + 1)
        scored = with_priority(kept, lex, weights, rules.focused).unionByName(_declared(got, lex, weights, rules.focused), allowMissingColumns=True)
        found = scored.select("source", "url", F.col("depth").cast("int").alias("depth"), "priority", F.when(F.col("is_document"), "document").otherwise("page").alias("kind"), "anchor", "parent",
                              (F.lit(number).cast("bigint") + F.col("rank").cast("bigint") * 1_000_000 + F.col("pos")).alias("seq"))
        number += 1_000_000 * n
        urls = set_state(merge_found(urls, found), head.withColumn("state", F.lit(VISITED))).checkpoint(True)
        documents = urls.where("kind = 'document'").count()
    return urls


def _declared(got: DataFrame, lex: Lexicon, weights: LinkWeights, focused: bool) -> DataFrame:
    """The documents that pages name in their heads or wrapper scripts, at the page's own depth and after its links; scope and traps don't apply."""
    anchor = F.coalesce(F.nullif("title", F.lit("")), F.nullif("led", F.lit("")), F.lit("(citation_pdf_url)"))
    named = got.where(F.col("pdf_url").isNotNull()).select(
        "source", F.col("url").alias("parent"), canonical_url(F.col("pdf_url")).alias("url"), "depth", "rank", F.size("links").alias("pos"), anchor.alias("anchor"), F.lit("").alias("context"), F.lit(True).alias("is_document"))
    return with_priority(named, lex, weights, focused).withColumn("priority", F.col("priority") + weights.declared)


def _landings(urls: DataFrame, pages: DataFrame, rules: CrawlRules) -> DataFrame:
    """(url, meta, documents) of the pages that documents were found on; a page at the last depth has no count, as its links aren't followed."""
    parents = urls.where("kind = 'document' AND parent IS NOT NULL").select(F.col("parent").alias("url")).distinct()
    depths = urls.where("kind = 'page'").groupBy("url").agg(F.min("depth").alias("depth"))
    known = pages.select(canonical_url(F.col("url")).alias("url"), "html").dropDuplicates(["url"])
    got = metadata(extract(known.join(parents, "url", "left_semi").join(depths, "url"), extensions=rules.document_extensions))
    named = F.filter("links", lambda l: l["is_document"] | is_document(l["url"], rules.document_extensions, rules.document_patterns))
    return got.select("url", "meta", F.when(F.col("depth") < rules.most_depth, F.size(named)).alias("documents"))


def relevant_documents(urls: DataFrame, lex: Lexicon, pages: DataFrame, rules: CrawlRules = CrawlRules(())) -> DataFrame:
    """Documents of a crawl with title, score, tier and relevant, judged with title and abstract of the page where it is the document's own."""
    docs = describes(urls.where("kind = 'document'"), _landings(urls, pages, rules))
    docs = docs.withColumns({"title": best_title(F.col("meta.title"), F.col("anchor"), F.col("url")), "abstract": F.col("meta.abstract")}).drop("meta")
    return with_score(docs, lex, F.col("title"), F.col("abstract")).withColumn("relevant", F.col("tier") != NEGATIVE)


def crawl_stats(urls: DataFrame, lex: Lexicon, pages: DataFrame, rules: CrawlRules = CrawlRules(())) -> DataFrame:
    """One row a source: pages, documents, relevant, harvest_rate."""
    visited = urls.groupBy("source").agg(F.count_if((F.col("state") == VISITED) & (F.col("kind") == "page")).alias("pages"))
    docs = relevant_documents(urls, lex, pages, rules).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if("relevant").alias("relevant"))
    out = visited.join(docs, "source", "left").na.fill(0)
    return out.withColumn("harvest_rate", F.col("relevant") / F.greatest(F.col("pages"), F.lit(1)))
