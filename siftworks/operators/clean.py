"""Cleaning of extracted texts: image marks, page numbers and running headers go, blank runs are collapsed.

A text is an array of lines inside its row: no line is ever shuffled, and line frequencies are counted per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import legible, let, lines, unused, word_count

PAGE_NUMBER = r"(?i)^\s*(page\s*)?\d{1,4}\s*$"


def kept_lines(text: Column, least_length: int = 15, header_count: int = 10) -> Column:
    """Lines without image marks, page numbers and running headers.

    A header is a line of at least least_length characters that stands header_count times or more among the lines left
    by the first two rules, unless it begins with | or #. Sorting the long lines once gives all frequencies: a line is
    frequent if the one header_count - 1 places on, among its sorted equals, is still itself.
    """
    rows = F.filter(F.transform(lines(text), lambda x: F.regexp_replace(x, r"\s+$", "")), lambda x: (F.trim(x) != "<!-- image -->") & ~x.rlike(PAGE_NUMBER))
    long = lambda r: F.array_sort(F.filter(F.transform(r, _bare), lambda x: F.length(x) >= least_length))
    often = lambda s: F.array_distinct(F.filter(s, lambda x, i: F.get(s, i + (header_count - 1)) == x))
    keep = lambda r, o: F.filter(r, lambda x: (F.length(_bare(x)) < least_length) | F.ltrim(x).rlike(r"^[|#]") | ~F.array_contains(o, _bare(x)))
    return let(rows, lambda r: let(long(r), lambda s: let(often(s), lambda o: F.when(F.size(o) == 0, r).otherwise(keep(r, o)))))


def _bare(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def clean_text(text: Column, **rules) -> Column:
    """Kept lines joined, three or more line breaks made two, trimmed, one break at the end."""
    joined = F.regexp_replace(F.array_join(kept_lines(text, **rules), "\n"), "\n{3,}", "\n\n")
    return F.concat(_bare(joined), F.lit("\n"))


def text_index(docs: DataFrame, text: str = "text", origin: Column | None = None, **rules) -> DataFrame:
    """docs with clean_text, chars_before, chars, words, legible and origin; null text counts as empty."""
    out = docs.withColumn("clean_text", clean_text(F.col(text), **rules))
    return out.withColumns({"chars_before": F.length(F.coalesce(F.col(text), F.lit(""))), "chars": F.length("clean_text"), "words": word_count(F.col("clean_text")),
                            "legible": legible(F.col("clean_text")), "origin": origin if origin is not None else F.lit("delivered")})


def line_frequencies(docs: DataFrame, key: str, text: str = "text", least_length: int = 15, least_count: int = 2) -> DataFrame:
    """(key, line, n) of lines that repeat inside a document."""
    rows = docs.select(key, F.explode(lines(F.col(text))).alias("line")).select(key, F.trim("line").alias("line")).where(F.length("line") >= least_length)
    return rows.groupBy(key, "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def eligible(docs: DataFrame, skip_source: str = "ntrs") -> DataFrame:
    """Stored documents of a textual kind, without the PDFs of one source."""
    return docs.where(F.col("status").eqNullSafe("stored") & F.col("content_kind").isin("pdf", "text", "html") & ~((F.col("source") == skip_source) & (F.col("content_kind") == "pdf")))


def to_extract(docs: DataFrame, done: DataFrame, skip_source: str = "ntrs") -> DataFrame:
    """Stored PDFs of the other sources that aren't extracted yet."""
    return docs.where(F.col("status").eqNullSafe("stored") & (F.col("content_kind") == "pdf") & (F.col("source") != skip_source)).join(done.select("sha256").distinct(), "sha256", "left_anti")


def union_texts(extracted: DataFrame, delivered: DataFrame, ocr: DataFrame | None = None) -> DataFrame:
    """Both kinds of texts with their origin; extracted ones are marked if they went through character recognition."""
    marked = extracted.withColumn("origin", F.lit("extracted"))
    if ocr is not None:
        flag = unused(marked, "by_ocr")
        flags = ocr.where("ocr").select("sha256").distinct().withColumn(flag, F.lit(True))
        marked = marked.join(flags, "sha256", "left").withColumn("origin", F.when(F.col(flag), "extracted_ocr").otherwise("extracted")).drop(flag)
    return marked.unionByName(delivered.withColumn("origin", F.lit("delivered")), allowMissingColumns=True)


def with_fallback(extracted: DataFrame, recognised: DataFrame, text: str = "text") -> DataFrame:
    """extracted (sha256, text, ...) with text, ocr, legible and pages: a text that isn't legible gives way to the recognised one.

    recognised: sha256, text, from whatever reads page images; only illegible documents need to be in it. What neither
    can read stays as it is, marked illegible. A form feed ends a page, and a last page needs none.
    """
    other = unused(extracted, "other")
    joined = extracted.join(recognised.select("sha256", F.col(text).alias(other)), "sha256", "left")
    poor = ~legible(F.col(text), 0) & F.col(other).isNotNull()
    out = joined.withColumn("ocr", poor).withColumn(text, F.when(F.col("ocr"), F.col(other)).otherwise(F.col(text))).drop(other)
    body = F.coalesce(F.col(text), F.lit(""))
    pages = F.regexp_count(body, F.lit("\f")) + (~body.endswith("\f") & (body != "")).cast("int")
    return out.withColumns({"legible": legible(F.col(text), 0), "pages": pages})
