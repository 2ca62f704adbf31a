"""Operator 8: mixing sources to target weights by Sainte-Laguë apportionment.

Sources in code point order, null last, have repeating weights and share a multiple of all words; a source's target
stops at a multiple of its size and what is left over is shared again by weight. The targets are apportioned in blocks
of equally many words: seats go to the highest quotients target / (2 j + 1), first to sources (one row each), then within a
source to its shards, in proportion to their words. A shard holds about `shard_words` words of documents in a seeded order, so the
largest source is many shards and no group outgrows a task. Of a shard's ring of blocks the quota is a run that starts
at a seeded block (twice round for a quota beyond the ring), so all but the documents at its ends are taken whole.

Null text has size 0; a document of size 0 is taken 0 times and changes nothing. A null source is a source of its own.
Rows that repeat are rows of their own. Null doc_ids share one place in the seeded order. Empty table: no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_place, documents, materialize, small_batches

WEIGHTS = (3, 1, 2)
SHARE, MOST, BLOCK, SHARD_WORDS, SEED = 1.5, 2, 16, 1 << 20, 17
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Shards that seats are dealt to at once.
TREE = 1 << 16


def apportion(weights: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Laguë seats: the highest quotients w / (2 j + 1) win, ties go to the earlier."""
    w = np.asarray(weights, np.float64)
    if not len(w) or not w.sum() or seats <= 0:
        return np.zeros(len(w), np.int64)
    # rounding is the method's own result for its sum; then the last few seats are given or taken back one by one
    out = np.floor(w * seats / w.sum() + 0.5).astype(np.int64)
    while (left := seats - int(out.sum())) > 0:
        q = w / (2 * out + 1)
        out[np.lexsort((np.arange(len(w)), -q))[:max(1, min(left, len(w)) // 2) if left > len(w) else 1]] += 1
    while int(out.sum()) > seats:
        q = np.where(out > 0, w / np.maximum(2 * out - 1, 1), np.inf)
        out[np.lexsort((-np.arange(len(w)), q))[0]] -= 1
    return out


def number(key: Column, what: str, seed: int) -> Column:
    """A seeded number below 2^32 that any SQL engine can make as well."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{what}-{seed}-"), key)), 1, 8), 16, 10).cast("bigint")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(source, source_size, target, seats), one row a source."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("rank", rank).withColumn("weight", weight)
    every = Window.partitionBy(F.lit(0))
    up = Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("weight"), "rank")
    # caps bind in the order of size / weight: a source is capped if, with all before it capped, its share is beyond its cap
    filled = (ranked.withColumn("total", F.sum("source_size").over(every))
              .withColumn("capped_before", F.coalesce(F.sum("source_size").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("weight_from", F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))))
    open_ = F.col("weight") * (share * F.col("total") - most * F.col("capped_before")) <= most * F.col("source_size") * F.col("weight_from")
    judged = filled.withColumn("open", open_)
    rest = share * F.col("total") - most * F.sum(F.when(~F.col("open"), F.col("source_size")).otherwise(0)).over(every)
    weight_open = F.sum(F.when(F.col("open"), F.col("weight")).otherwise(0)).over(every)
    target = F.when(F.col("open"), F.col("weight") * rest / weight_open).otherwise((most * F.col("source_size")).cast("double"))
    shared = judged.select("source", "source_size", "rank", F.coalesce(target, F.lit(0.0)).alias("target"), (share * F.col("total")).alias("sum"), F.lit(0).alias("one"))

    def seated(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        return pdf.assign(seats=apportion(pdf["target"].to_numpy(), int(np.floor(pdf["sum"].iloc[0] / block + 0.5))))[["source", "source_size", "target", "seats"]]

    return shared.groupBy("one").applyInPandas(seated, "source string, source_size bigint, target double, seats bigint")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST,
        block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of docs: id_col, size, source_size, target, taken, and how: `whole` passes, then words [from, to) and [0, again)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = documents(docs, id_col, text_col, source_col).toDF("id", "text", "source").select("id", "source", F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("size"))
    sized = materialize(sized.withColumn("row", F.monotonically_increasing_id()))
    shared = materialize(targets(sized, weights, share, most, block))
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    placed = (sized.join(shared.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
              .withColumn("shard", F.pmod(number(key, "shard", seed), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)))))
    sizes = placed.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("seats").alias("seats"))

    # seats go to groups of TREE shards first, then to their shards: whatever a source's size, no task holds more than TREE of them
    sizes = materialize(sizes.withColumn("group", F.expr(f"shard div {TREE}")))
    groups = sizes.groupBy("source", "group").agg(F.sum("words").alias("words"), F.first("seats").alias("seats"))

    def seated(by: str):
        def given(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(by)
            return pdf.assign(quota=apportion(pdf["words"].to_numpy(), int(pdf["seats"].iloc[0])))[["source", by, "words", "quota"]]

        return given

    given = materialize(groups.groupBy("source").applyInPandas(seated("group"), "source string, group bigint, words bigint, quota bigint")).toDF("gs", "gn", "gw", "given")
    sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("gs")) & (F.col("group") == F.col("gn"))).withColumn("seats", F.col("given"))
    quotas = sizes.select("source", "group", "shard", "words", "seats").groupBy("source", "group").applyInPandas(seated("shard"), "source string, shard bigint, words bigint, quota bigint")
    quotas = materialize(quotas)  # also so that no task runs two Python workers
    ring = F.ceil(F.col("words") / block)
    first = F.pmod(number(F.concat_ws("/", F.coalesce("qs", F.lit("")), F.col("qn").cast("string")), "first", seed), F.greatest(F.lit(1), F.col("ring")))
    quotas = (quotas.toDF("qs", "qn", "words", "quota").withColumn("ring", ring).withColumn("quota", F.least("quota", most * F.col("ring")))
              .withColumn("whole", F.coalesce(F.expr("quota div nullif(ring, 0)"), F.lit(0))).withColumn("run", F.col("quota") - F.col("whole") * F.col("ring")).withColumn("first", first))
    order = Window.partitionBy("source", "shard").orderBy(number(key, "order", seed), "id", "size", "row")
    laid = placed.withColumn("end", F.sum("size").over(order)).withColumn("at", F.col("end") - F.col("size"))
    joined = laid.join(quotas, F.col("source").eqNullSafe(F.col("qs")) & (F.col("shard") == F.col("qn")))
    # the run is [first, first + run) blocks of the ring, its part beyond the ring's end begins anew at 0
    clip = lambda x: F.greatest(F.col("at"), F.least(F.col("end"), x)) - F.col("at")
    low, high = F.col("first") * block, (F.col("first") + F.col("run")) * block
    parts = (joined.withColumn("from", clip(low)).withColumn("to", clip(high))
             .withColumn("again", clip((F.col("first") + F.col("run") - F.col("ring")) * block)))
    taken = F.col("whole") * F.col("size") + F.col("to") - F.col("from") + F.col("again")
    return parts.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", taken.alias("taken"), "whole", "from", "to", "again")


def cut_words(text: str, start: int, stop: int) -> str:
    """Words start to stop of a text with the white space between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    return text[at[start][0]:at[stop - 1][1]] if start < stop else ""


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str = "n_chars", **options) -> DataFrame:
    """docs after the mix, in docs' own columns: a row for every whole pass over a document and one for each part of it.

    A document of which nothing is taken has no row; its parts are runs of its words with the white space between them.
    Rows that share id, source and size get the plans of those rows, in the order of their texts' hashes.
    """
    # one text for id, source and size, nulls told apart, by which rows are numbered and joined in one shuffle
    same = lambda i, source, size: F.to_json(F.struct(i.alias("i"), source.alias("s"), size.alias("n")))
    nth = lambda *order: F.row_number().over(Window.partitionBy("same").orderBy(*order))
    plan = mix(docs, id_col, text_col, source_col, **options)
    plan = plan.select(same(F.col(id_col), F.col("source"), F.col("size")).alias("same"), "size", "taken", "whole", "from", "to", "again")
    plan = plan.withColumn("pnth", nth("whole", "from", "to", "again")).where("taken > 0")
    rows, names = by_place(docs)
    key, text, source = (rows[names.index(c)] for c in (id_col, text_col, source_col))
    size = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    rows = rows.withColumn("same", same(key, source, size)).withColumn("nth", nth(F.xxhash64(text)))
    joined = rows.join(plan, "same").where(F.col("nth") - F.col("pnth") == 0)
    n, at, length = len(names), names.index(text_col), names.index(length_col) if length_col in names else None

    def pieces(batches):
        for b in batches:
            which, made = [], []
            for i, (t, size, whole, low, high, again) in enumerate(zip(b.column(at).to_pylist(), *[b.column(n + j).to_pylist() for j in range(5)])):
                out = [t] * whole
                # a run round the ring's end that meets in one document stays in order: its start, then its end
                out += [t if y - x == size else cut_words(t, x, y) for x, y in ((0, again), (low, high)) if x < y]
                which += [i] * len(out)
                made += out
            rows = b.select(list(range(n))).take(pa.array(which, pa.int64()))
            columns = list(rows.columns)
            columns[at] = pa.array(made, rows.schema.field(at).type)
            if length is not None:
                columns[length] = pa.array([len(t) for t in made]).cast(rows.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names)

    small_batches(docs.sparkSession)
    columns = [f"column{i}" for i in range(n)]
    schema = ", ".join(f"{c} {kind}" for c, (_, kind) in zip(columns, docs.dtypes))
    return joined.select(*columns, "size", "whole", "from", "to", "again").mapInArrow(pieces, schema).toDF(*names)


def query(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s),
w AS (SELECT *, [3, 1, 2][(rank % 3) + 1] AS weight, sum(source_size) OVER ()::BIGINT AS total FROM r),
f AS (SELECT *,
  coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
  sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weight_from FROM w),
o AS (SELECT *, weight * (1.5::DOUBLE * total - 2 * before) <= 2 * source_size * weight_from AS open FROM f),
t AS (SELECT source, source_size, rank, total, CASE WHEN open
    THEN weight * (1.5::DOUBLE * total - 2 * sum(CASE WHEN open THEN 0 ELSE source_size END) OVER ()::BIGINT) / sum(CASE WHEN open THEN weight ELSE 0 END) OVER ()::BIGINT
    ELSE (2 * source_size)::DOUBLE END AS target FROM o),
q AS (SELECT source, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, rank) AS place, floor(1.5::DOUBLE * total / {BLOCK} + 0.5) AS seats
  FROM (SELECT *, unnest(range(0, (target / {BLOCK})::BIGINT + 10)) AS j FROM t)),
seats AS (SELECT source, count(*) AS seats FROM q WHERE place <= seats GROUP BY source),
p AS (SELECT d.*, t.source_size, t.target, ('0x' || substr(md5('shard-{SEED}-' || d.doc_id), 1, 8))::BIGINT % greatest(1, ceil(t.source_size / {SHARD_WORDS}))::BIGINT AS shard,
    ('0x' || substr(md5('order-{SEED}-' || d.doc_id), 1, 8))::BIGINT AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
sh AS (SELECT source, shard, sum(size)::BIGINT AS words FROM p GROUP BY source, shard),
sq AS (SELECT source, shard, seats, row_number() OVER (PARTITION BY source ORDER BY words / (2 * j + 1) DESC, shard) AS place
  FROM (SELECT sh.*, coalesce(seats, 0) AS seats, unnest(range(0, 2 * (words / {BLOCK})::BIGINT + 10)) AS j FROM sh LEFT JOIN seats ON sh.source IS NOT DISTINCT FROM seats.source)),
g AS (SELECT sh.source, sh.shard, sh.words, ceil(sh.words / {BLOCK})::BIGINT AS ring, least(2 * ceil(sh.words / {BLOCK})::BIGINT, coalesce(n, 0)) AS quota
  FROM sh LEFT JOIN (SELECT source, shard, count(*) AS n FROM sq WHERE place <= seats GROUP BY source, shard) c ON sh.source IS NOT DISTINCT FROM c.source AND sh.shard = c.shard),
h AS (SELECT *, CASE WHEN ring = 0 THEN 0 ELSE quota // ring END AS whole,
    ('0x' || substr(md5('first-{SEED}-' || coalesce(source, '') || '/' || shard), 1, 8))::BIGINT % greatest(1, ring) AS first FROM g),
l AS (SELECT p.*, sum(size) OVER (PARTITION BY source, shard ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM p),
x AS (SELECT l.*, h.whole, l.stop - l.size AS pos, h.first * {BLOCK} AS low, (h.first + h.quota - h.whole * h.ring) * {BLOCK} AS high,
    (h.first + h.quota - h.whole * h.ring - h.ring) * {BLOCK} AS again
  FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source AND l.shard = h.shard)
SELECT doc_id, size, source_size, target, (whole * size + greatest(pos, least(stop, high)) - greatest(pos, least(stop, low)) + greatest(pos, least(stop, again)) - pos)::BIGINT AS taken FROM x
"""
