"""Bands of full texts: term counts, canonical sections, notes by density, and the band they give."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import Lexicon
from ..functions.text import count_phrase, fold, has_phrase, let, normalize_text, padded, section_titles, unused

BANDS = ("both", "concept", "domain", "none")


@dataclass(frozen=True)
class BandRules:
    strong: float = 3.0
    moderate: float = 1.0
    structural: float = 4.0
    title: float = 10.0
    concept_least: float = 10.0
    domain_least: float = 20.0
    domain_strong_least: int = 3
    top: int = 8
    domain: tuple[tuple[str, ...], tuple[str, ...]] = field(default=((), ()))


def term_counts(padded_text: Column, terms) -> Column:
    """array<struct<term, n>> in the terms' order, terms that don't occur left out."""
    if not terms:
        return F.array().cast("array<struct<term:string,n:int>>")
    return F.filter(F.array(*[F.struct(F.lit(t).alias("term"), count_phrase(padded_text, t).alias("n")) for t in terms]), lambda x: x["n"] > 0)


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0), lambda a, x: a + x["n"])


def top_terms(counts: Column, k: int = 8) -> Column:
    """The k most frequent terms; of equals the earlier in the lexicon."""
    keyed = F.transform(counts, lambda x, i: F.struct((-x["n"]).alias("n"), i.alias("i"), x["term"].alias("t")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda x: x["t"])


def canonical_sections(titles: Column, signatures, slack: int = 25) -> Column:
    """Signatures that a heading holds, if the heading is at most `slack` longer."""
    if not signatures:
        return F.array().cast("array<string>")
    one = lambda ts, s: F.when(F.exists(ts, lambda t: t.contains(s) & (F.length(t) <= len(s) + slack)), F.lit(s))
    return let(titles, lambda ts: F.array_compact(F.array(*[one(ts, s) for s in signatures])))


def note(strong: Column, moderate: Column, words: Column, rules: BandRules) -> Column:
    """Weighted occurrences in ten thousand words."""
    return (total(strong) * rules.strong + total(moderate) * rules.moderate) * 10000 / F.greatest(words, F.lit(1))


def with_band(docs: DataFrame, lex: Lexicon, rules: BandRules, title: str = "title", text: str = "text") -> DataFrame:
    """docs with words, sections, both notes, band and the strongest terms.

    The normalised text and the headings come out of a one-row generator, and the counts out of a second, so that each is
    computed once whatever is asked or filtered above.
    """
    d_strong, d_moderate = (tuple(dict.fromkeys(fold(t) for t in ts)) for ts in rules.domain)
    texts = unused(docs, "texts")
    df = docs.withColumn(texts, F.explode_outer(F.array(F.struct(padded(normalize_text(F.col(text))).alias("body"), padded(normalize_text(F.col(title))).alias("title"), section_titles(F.col(text)).alias("heads")))))
    x, t = F.col(f"{texts}.body"), F.col(f"{texts}.title")
    found = unused(df, "found")
    df = df.withColumn(found, F.explode_outer(F.array(F.struct(
        F.when(F.trim(x) == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) - 1).alias("words"), term_counts(x, lex.strong).alias("cs"), term_counts(x, lex.moderate).alias("cm"),
        term_counts(x, d_strong).alias("ds"), term_counts(x, d_moderate).alias("dm"), canonical_sections(F.col(f"{texts}.heads"), lex.structural).alias("sections")))))
    cs, cm, ds, dm = (F.col(f"{found}.{c}") for c in ("cs", "cm", "ds", "dm"))
    in_title = reduce(lambda a, b: a | b, [has_phrase(t, s) for s in lex.strong], F.lit(False))
    df = df.withColumns({"words": F.col(f"{found}.words"), "sections": F.col(f"{found}.sections")})
    df = df.withColumns({
        "concept_note": note(cs, cm, F.col("words"), rules) + F.size("sections") * rules.structural + in_title.cast("int") * rules.title,
        "domain_note": note(ds, dm, F.col("words"), rules), "domain_strong": total(ds),
        "concept_terms": top_terms(F.concat(cs, cm), rules.top), "domain_terms": top_terms(F.concat(ds, dm), rules.top)})
    concept = F.col("concept_note") >= rules.concept_least
    domain = (F.col("domain_note") >= rules.domain_least) & (F.col("domain_strong") >= rules.domain_strong_least)
    return df.withColumn("band", F.when(concept & domain, BANDS[0]).when(concept, BANDS[1]).when(domain, BANDS[2]).otherwise(BANDS[3])).drop(texts, found)


def band_order(banded: DataFrame, band: str, key: str = "sha256") -> DataFrame:
    """The list of a band: greatest note first (in the domain's list the domain's, else the concept's), then by key."""
    by = "domain_note" if band == BANDS[2] else "concept_note"
    return banded.where(F.col("band") == band).orderBy(F.desc(by), key)


def band_matrix(banded: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Bands by source, zero-filled, all bands, in their order; sources may be given to spare a pass. The total is that of all sources."""
    spark = banded.sparkSession
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(BANDS)], "position int, band string")
    if sources is None:
        counts = banded.groupBy("band").pivot("source").count()
        counts = counts.withColumn("total", reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in counts.columns[1:]], F.lit(0)))
    else:
        counts = banded.groupBy("band").agg(*[F.count_if(F.col("source") == s).alias(s) for s in sources], F.count(F.lit(1)).alias("total"))
    return frame.join(counts, "band", "left").na.fill(0)
