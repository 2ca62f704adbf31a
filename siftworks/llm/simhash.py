"""Operator 1: SimHash near-dedup with bit-sliced comparison.

A document's fingerprint has bit b set if more than half of its shingles' XXH64 values have. Distinct fingerprints (one
row for all documents that share one) are compared; copies never meet. The 64 bits are cut into 5 fields; two
fingerprints at 3 or fewer differing bits agree on at least 2 whole fields, so 10 tables keyed by 2 fields each
(25 or 26 bits) hold every such pair in some bucket. Buckets are compared on vertical bit planes (`bit_slices`). Buckets
above `block` rows are cut into blocks and each pair of blocks is a group of its own, so none outgrows a task; a
fingerprint of very many documents is joined with them by a broadcast.

With `similarity=0.8` links are those of sets of shingles instead (`near_sets`): fingerprints propose, sets decide, and
what fingerprints don't propose is compared as well.

Nulls and empty texts have no words: their fingerprint is zero, linked like any other. Fewer words than a shingle: the
whole sequence is the one shingle. Rows that repeat get equal rows. A null doc_id is never the least of a component
unless all are null. Empty table: no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_sets
from .bit_slices import BITS, forest
from .common import by_place, documents, join_hot, materialize, text_bytes, without
from .components import components
FIELDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
TABLES = list(combinations(range(len(FIELDS)), 2))


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of width words, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: ASCII letters and the six ASCII spaces only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    return np.fromiter((xxh64_intdigest(s, 42) for s in shingles), np.uint64)


def fingerprint(text: bytes, width: int = 3) -> int:
    h = shingle_hashes(text, width)
    if not len(h):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, fp): fp holds the 64 bits as a signed long."""

    def hashed(batches):
        for b in batches:
            fps = np.array([fingerprint(t, width) for t in text_bytes(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return documents(docs, id_col, text_col).mapInArrow(hashed, f"id {dict(docs.dtypes)[id_col]}, fp bigint")


def links(distinct: DataFrame, radius: int, block: int) -> DataFrame:
    """(child, parent) links between distinct fingerprints: a spanning forest of every bucket."""
    field = [F.shiftrightunsigned("fp", at).bitwiseAND((1 << n) - 1) for at, n in FIELDS]
    keys = F.array(*[F.lit(t).cast("bigint") * (1 << 32) + field[i] * (1 << 13) + field[j] for t, (i, j) in enumerate(TABLES)])
    rows = distinct.select("fp", F.explode(keys).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, "key").withColumn("cuts", F.ceil(F.col("n") / block))
    own = F.pmod(F.xxhash64("fp"), F.col("cuts"))
    pairs = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1), lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")))
    rows = rows.withColumn("own", own).withColumn("pair", F.explode(pairs)).select("key", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "fp")

    def compared(batches):
        held: list[np.ndarray] = []

        def found(part: np.ndarray):
            bucket = np.cumsum(np.append(0, (part[1:, :3] != part[:-1, :3]).any(axis=1)))
            fps = part[:, 3].copy()
            a, b = forest(fps.view(np.uint64), bucket, radius)
            x, y = fps[a], fps[b]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["child", "parent"])

        for batch in batches:
            part = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            if not len(part):
                continue
            part = np.concatenate([*held, part]) if held else part
            last = np.flatnonzero((part[:, :3] != part[-1, :3]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [part[cut:]]  # the last bucket may go on
            if cut:
                yield found(part[:cut])
        if held:
            yield found(held[0])

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(compared, "child bigint, parent bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, block: int = 4096, similarity: float | None = None) -> DataFrame:
    """One row per row of docs: id_col, fingerprint (16 hex digits), component_id (least id reachable by links of at most radius bits).

    With a similarity there is no fingerprint column, and links are those of sets of runs of width words.
    """
    if similarity is not None:
        if similarity * near_sets.DEN != near_sets.NUM:
            raise ValueError("sets are compared at a similarity of 0.8")
        return near_sets.similar_groups(docs, id_col, text_col, width)
    if radius != 3:
        raise ValueError("the tables hold every pair up to radius 3; other radii need other fields")
    prints = materialize(fingerprints(docs, id_col, text_col, width))
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")))
    reached = components(links(distinct.select("fp"), radius, block))
    root = distinct.join(reached.withColumnRenamed("child", "fp"), "fp", "left").withColumn("root", F.coalesce("parent", "fp"))
    least = root.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"))
    classes = materialize(join_hot(materialize(root.select("fp", "root", "n")), least, ["root"], "m").select("fp", "component_id", "n"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return join_hot(prints, classes, ["fp"], "n").select(F.col("id").alias(id_col), digits.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows whose component has a smaller id; rows without an id, and rows that repeat one, all stay."""
    classes = near_duplicates(docs, id_col, text_col, **options)
    dropped = classes.where(F.col(id_col) > F.col("component_id")).select(id_col)
    rows, names = by_place(docs)
    return without(rows, rows[docs.columns.index(id_col)], dropped).toDF(*names)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = None
