"""One discovery run over several sources, each on its own: what fails in one source is written down and leaves the others alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexicon import NEGATIVE, Lexicon, scoring_body, with_score
from ..operators.records import add_if_absent, conform, discovery_funnel, queued, record_key, split_export_control

RUN = "source string, outcome string, error string, started_at timestamp, ended_at timestamp, seen bigint, export_controlled bigint, dropped bigint, new bigint, known bigint, strong bigint, weak bigint"
_COUNTS = ("seen", "export_controlled", "dropped", "new", "known", "strong", "weak")


@dataclass(frozen=True)
class Discovery:
    """new: records that enter the queue; controlled: those set aside; runs: a row a source with outcome, error and counts."""

    new: DataFrame
    controlled: DataFrame
    runs: DataFrame


def discover(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], lex: Lexicon, known: DataFrame, only: list[str] | None = None, skip: list[str] | None = None) -> Discovery:
    """Score every source's records and tell new ones from those known (key). A source is a function that gives its records.

    A source is read and scored once, into a checkpoint, so that an error in its data shows here and not in a later query.
    """
    from datetime import UTC, datetime

    from ..sources.records import select_sources
    from .crawl import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    runs, found, held = [], [], []
    for name in select_sources(list(sources), only, skip):
        began, counts, error = datetime.now(UTC), dict.fromkeys(_COUNTS, 0), None
        try:
            rows = conform(sources[name]()).drop("lexicon_score", "tier", "matched_terms").withColumn("key", record_key())
            scored = with_score(rows, lex, F.col("title"), scoring_body(F.col("abstract"), F.col("subject_terms"))).checkpoint(True)
            counts = discovery_funnel(scored, known).first().asDict()
            free, controlled = split_export_control(scored)
            found.append(queued(free, NEGATIVE))
            held.append(controlled)
        except Exception as e:  # whatever a source raises is its own outcome
            error = f"{type(e).__name__}: {e}".splitlines()[0]
        runs.append((name, "failed" if error else "done", error, began, datetime.now(UTC), *[counts[c] for c in _COUNTS]))
    new = _union(spark, found)
    return Discovery(add_if_absent(known, new, "key", "source_id"), _union(spark, held), spark.createDataFrame(runs, RUN))


def _union(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    out = conform(spark.createDataFrame([], "source string, source_id string")).withColumn("key", record_key()) if not parts else parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
