"""A weighted phrase lexicon as columns: hits, score, tier and matched terms of a title and a body."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import fold, has_phrase, normalize_text, padded, unused

STRONG, WEAK, NEGATIVE = "strong", "weak", "negative_sample"


@dataclass(frozen=True)
class Weights:
    strong_title: float = 10.0
    strong_body: float = 3.0
    moderate_title: float = 2.0
    moderate_body: float = 0.5
    structural: float = 4.0
    adversarial_title: float = -6.0
    adversarial_body: float = -1.5
    strong_least: float = 10.0
    weak_least: float = 2.5


def _folded(terms) -> tuple[str, ...]:
    return tuple(dict.fromkeys(f for t in terms if (f := fold(t))))


@dataclass(frozen=True)
class Lexicon:
    """Terms are normalised once, here; in a plan they are literals."""

    strong: tuple[str, ...] = ()
    moderate: tuple[str, ...] = ()
    structural: tuple[str, ...] = ()
    adversarial: tuple[str, ...] = ()
    search: tuple[str, ...] = ()
    weights: Weights = field(default_factory=Weights)

    def __post_init__(self):
        for name in ("strong", "moderate", "structural", "adversarial", "search"):
            object.__setattr__(self, name, _folded(getattr(self, name)))

    @classmethod
    def from_dict(cls, d: dict) -> Lexicon:
        """From the layout of a lexicon file: *_terms lists, structural_signature, adversarial_markers, scoring, thresholds."""
        s, t = d.get("scoring", {}), d.get("thresholds", {})
        named = {"weight_strong_title": "strong_title", "weight_strong_body": "strong_body", "weight_moderate_title": "moderate_title", "weight_moderate_body": "moderate_body",
                 "weight_structural": "structural", "penalty_adversarial_title": "adversarial_title", "penalty_adversarial_body": "adversarial_body"}
        w = {named[k]: float(v) for k, v in s.items() if k in named} | {k2: float(t[k]) for k, k2 in (("strong_min_score", "strong_least"), ("weak_min_score", "weak_least")) if k in t}
        return cls(tuple(d.get("strong_terms", ())), tuple(d.get("moderate_terms", ())), tuple(d.get("structural_signature", ())), tuple(d.get("adversarial_markers", ())), tuple(d.get("search_terms", ())), Weights(**w))

    @classmethod
    def from_yaml(cls, path: str) -> Lexicon:
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f))


def domain_terms(domains: dict, strong: str = "fortes", moderate: str = "moderados", active: str = "ativo") -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Terms of all active domains in order, each once."""
    on = [d for d in domains.values() if d.get(active, True)]
    return _folded(t for d in on for t in d.get(strong, ())), _folded(t for d in on for t in d.get(moderate, ()))


def _sum(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [t.cast("int") for t in tests], F.lit(0))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def score_columns(lex: Lexicon, title: Column, body: Column) -> dict[str, Column]:
    """Score parts of padded, normalised title and body columns, as sums of literal tests."""
    w = lex.weights
    hits = lambda col, terms: [has_phrase(col, t) for t in terms]
    strong_t, adv_t = hits(title, lex.strong), hits(title, lex.adversarial)
    structural = [has_phrase(title, t) | has_phrase(body, t) for t in lex.structural]
    score = (_sum(strong_t) * w.strong_title + _sum(hits(body, lex.strong)) * w.strong_body + _sum(hits(title, lex.moderate)) * w.moderate_title
             + _sum(hits(body, lex.moderate)) * w.moderate_body + _sum(structural) * w.structural
             + _sum(adv_t) * w.adversarial_title + _sum(hits(body, lex.adversarial)) * w.adversarial_body)
    return {"lexicon_score": score.cast("double"), "strong_in_title": _any(strong_t), "adversarial_in_title": _any(adv_t), "structural_hits": _sum(structural)}


def tier(score: Column, strong_in_title: Column, adversarial_in_title: Column, w: Weights = Weights()) -> Column:
    return (F.when(strong_in_title & ~adversarial_in_title, STRONG).when((score >= w.strong_least) & ~adversarial_in_title, STRONG)
            .when(score >= w.weak_least, WEAK).otherwise(NEGATIVE))


def matched_terms(lex: Lexicon, title: Column, body: Column) -> Column:
    """Sorted distinct terms found, adversarial ones aside."""
    found = [F.when(has_phrase(title, t) | has_phrase(body, t), F.lit(t)) for t in sorted({*lex.strong, *lex.moderate, *lex.structural})]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def scoring_body(abstract: Column, subjects: Column) -> Column:
    """Abstract and joined subject terms on lines of their own, what is missing left out."""
    return F.concat_ws("\n", abstract, F.nullif(F.array_join(subjects, " "), F.lit("")))


def with_score(df: DataFrame, lex: Lexicon, title: Column, body: Column, terms: bool = True) -> DataFrame:
    """df with lexicon_score, strong_in_title, adversarial_in_title, structural_hits, tier and matched_terms.

    The normalised texts come out of a one-row generator: a filter on tier or score then stays above it, where Catalyst
    would write the normalisation into every test of a filter that it pushes below a plain projection.
    """
    t = unused(df, "texts")
    texts = F.struct(padded(normalize_text(title)).alias("title"), padded(normalize_text(body)).alias("body"))
    base = df.withColumn(t, F.explode_outer(F.array(texts)))
    titles, bodies = F.col(f"{t}.title"), F.col(f"{t}.body")
    out = base.withColumns(score_columns(lex, titles, bodies))
    out = out.withColumn("tier", tier(F.col("lexicon_score"), F.col("strong_in_title"), F.col("adversarial_in_title"), lex.weights))
    if terms:
        out = out.withColumn("matched_terms", matched_terms(lex, titles, bodies))
    return out.drop(t)
