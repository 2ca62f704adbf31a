"""Operator 3: exact dedup by composable polynomial fingerprints.

A text's fingerprint is the value of its bytes (each plus one) as a polynomial modulo 2^31-1 at two points. Fixed-size
chunks are hashed side by side in one exact float64 matrix product (all sums stay below 2^53) and combined by
length-shifted arithmetic, H(ab) = H(a) r^|b| + H(b), so pieces of one huge document may be hashed anywhere and joined
later (`combine`, `fingerprint_pieces`). Texts with one fingerprint and length are then compared chunk by chunk: each
chunk position keeps its smallest and largest content, which pre-aggregates on the map side however large the group is.
The groups of most copies are joined with their rows by a broadcast, so that no task gets all rows of one.

Nulls and empty texts: null text is empty; all empty texts are equal to each other. A null doc_id loses ties to any
other. Rows that repeat (same doc_id and text) are rows of one group, of which exactly one stays; of rows that have an
id, a text's letters and its length in common the one with the least hash of all columns does. Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, FEW_IDS, by_place, documents, join_hot, materialize, text_bytes, without

PRIME = (1 << 31) - 1
POINTS = (1_482_907_561, 931_084_627)
CHUNK = 4096
COMPARE_CHUNK = 1 << 16
#: Bits of the map of repeated fingerprints: 16 MB.
MOST_BITS = 1 << 27
_POWERS: dict[tuple, np.ndarray] = {}


def _powers(points: tuple[int, ...], prime: int) -> np.ndarray:
    key = (points, prime)
    if key not in _POWERS:
        out = np.empty((CHUNK, len(points)))
        for j, r in enumerate(points):
            v = 1
            for i in range(CHUNK - 1, -1, -1):
                out[i, j] = v
                v = v * r % prime
        _POWERS[key] = out
    return _POWERS[key]


def combine(a: tuple[int, ...], b: tuple[int, ...], length_b: int, points=POINTS, prime: int = PRIME) -> tuple[int, ...]:
    """The fingerprint of a text from those of its two parts."""
    return tuple((x * pow(r, length_b, prime) + y) % prime for x, y, r in zip(a, b, points))


def fingerprint(data: bytes, points=POINTS, prime: int = PRIME) -> tuple[int, ...]:
    """Chunk hashes by one matrix product, then combined from left to right. Leading zeros add nothing, so the first chunk is padded."""
    if not data:
        return (0,) * len(points)
    symbols = np.zeros(-(-len(data) // CHUNK) * CHUNK)
    symbols[-len(data):] = np.frombuffer(data, np.uint8)
    symbols[-len(data):] += 1
    hashes = (symbols.reshape(-1, CHUNK) @ _powers(points, prime)).astype(np.int64) % prime
    whole = tuple(int(x) for x in hashes[0])
    for row in hashes[1:].tolist():
        whole = combine(whole, tuple(row), CHUNK, points, prime)
    return whole


def packed(fp: tuple[int, ...]) -> int:
    return (fp[0] << 31) | fp[1]


def normalised(data: bytes) -> bytes:
    return data.translate(None, ASCII_SPACE)


def fingerprint_pieces(pieces: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """(key, fingerprint, n_bytes) of documents stored as several rows; only hashes and lengths of pieces are shuffled."""

    def hashed(batches):
        for b in batches:
            out = [normalised(t) for t in text_bytes(b.column(2))]
            fps = [fingerprint(t) for t in out]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([f[0] for f in fps], pa.int64()), pa.array([f[1] for f in fps], pa.int64()), pa.array([len(t) for t in out], pa.int64())], names=["key", "no", "a", "b", "n"])

    kinds = dict(pieces.dtypes)
    rows = documents(pieces, key, order, text).mapInArrow(hashed, f"key {kinds[key]}, no {kinds[order]}, a bigint, b bigint, n bigint")

    def joined(batches):
        for batch in batches:
            out = []
            for parts in batch.column(1).to_pylist():
                fp, n = (0, 0), 0
                for p in parts:
                    fp, n = combine(fp, (p["a"], p["b"]), p["n"]), n + p["n"]
                out.append((packed(fp), n))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([o[i] for o in out], pa.int64()) for i in range(2)]], names=["key", "fingerprint", "n_bytes"])

    parts = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("no", "a", "b", "n"))).alias("parts"))
    return parts.mapInArrow(joined, f"key {kinds[key]}, fingerprint bigint, n_bytes bigint").withColumnRenamed("key", key)


def _keyed(docs: DataFrame, id_col: str, text_col: str, points, prime) -> DataFrame:
    def hashed(batches):
        for b in batches:
            raw = text_bytes(b.column(1))
            out = [normalised(t) for t in raw]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([packed(fingerprint(t, points, prime)) for t in out], pa.int64()), pa.array([len(t) for t in out], pa.int64()),
                 pa.array([len(t.decode("utf-8", "replace")) for t in raw], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in out], pa.string())],
                names=["id", "fp", "n", "points", "sha"])

    kind = dict(docs.dtypes)[id_col]
    return documents(docs, id_col, text_col).mapInArrow(hashed, f"id {kind}, fp bigint, n bigint, points bigint, sha string")


def _bitmap(groups: DataFrame, bits: int) -> np.ndarray:
    """A map of the fingerprints that occur more than once, of bits / 8 bytes."""
    words = groups.select(F.pmod("fp", F.lit(bits)).alias("at")).groupBy((F.col("at") / 32).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(at, 32) as int))")).alias("bits"))
    found = words.toPandas()
    out = np.zeros(bits // 32, np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out


def _unequal(docs: DataFrame, text_col: str, bitmap: np.ndarray, bits: int, points, prime) -> DataFrame:
    """(fp, n) under which chunkwise comparison finds different texts. Rows with a fingerprint of their own leave before the shuffle."""

    def chunks(batches):
        for b in batches:
            seen = set()
            for t in text_bytes(b.column(0)):
                t = normalised(t)
                fp = packed(fingerprint(t, points, prime))
                if bitmap[fp % bits // 32] >> (fp % bits % 32) & 1:
                    seen.add((fp, t))
            rows = [(fp, len(t), i, t[i * COMPARE_CHUNK:(i + 1) * COMPARE_CHUNK]) for fp, t in seen for i in range(-(-len(t) // COMPARE_CHUNK))]
            for at in range(0, len(rows), 256):
                part = rows[at:at + 256]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["fp", "n", "no", "chunk"])

    rows = documents(docs, text_col).mapInArrow(chunks, "fp bigint, n bigint, no bigint, chunk binary")
    same = rows.groupBy("fp", "n", "no").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return same.where("low <> high").select("fp", "n").distinct()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = MOST_BITS, points=POINTS, prime: int = PRIME) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256, and the fingerprint.

    Of equal texts (white space deleted) the one with the most code points stays, then the smallest id. The map of
    repeated fingerprints that executors get has 16 bits a group and filter_bits at most; as it fills up beyond that, more
    rows are compared, none fewer.
    """
    keyed = materialize(_keyed(docs, id_col, text_col, points, prime).withColumn("row", F.monotonically_increasing_id()))
    repeated = materialize(keyed.groupBy("fp", "n").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    bits = min(filter_bits, 1 << max(20, (16 * repeated.count()).bit_length()))
    unequal = materialize(_unequal(docs, text_col, _bitmap(repeated, bits), bits, points, prime))
    # next to no fingerprint stands for unequal texts; rows of those that do are told apart by their SHA-256
    unequal = F.broadcast(unequal) if unequal.count() <= FEW_IDS else unequal
    split = keyed.join(unequal.withColumn("split", F.lit(True)), ["fp", "n"], "left").withColumn("split", F.when(F.col("split"), F.col("sha")).otherwise(F.lit("")))
    first = F.min(F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("z"), "id", "row"))
    groups = split.groupBy("fp", "n", "split").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
    return join_hot(split, materialize(groups), ["fp", "n", "split"], "group_size").select(
        F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("sha").alias("text_sha256"), F.col("fp").alias("fingerprint"), "row")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with docs' own columns."""
    judged = materialize(exact_dedup(docs, id_col, text_col).select(F.col(id_col).alias("id"), "kept", F.col("text_sha256").alias("own_sha")))
    rows, names = by_place(docs)
    key, text = rows[docs.columns.index(id_col)], rows[docs.columns.index(text_col)]
    twice = materialize(judged.groupBy("id").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("id"))
    # an id of one row says which row goes
    single = without(rows, key, judged.where("not kept").select("id").unionByName(twice))
    # rows that share an id are told apart by their text, and of those that share that as well one stays
    clean = F.sha2(F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", ""), 256)
    kept = judged.where("kept").join(twice, judged["id"].eqNullSafe(twice["id"]), "left_semi").select("id", "own_sha").distinct()
    some = rows.join(F.broadcast(twice) if twice.count() <= FEW_IDS else twice, key.eqNullSafe(F.col("id")), "left_semi")
    found = some.withColumn("sha", clean).join(kept, key.eqNullSafe(F.col("id")) & (F.col("sha") == F.col("own_sha")), "left_semi")
    hashed = [c for c, kind in rows.dtypes if "map<" not in kind and kind != "variant"]
    best = F.min_by(F.struct(*rows.columns), F.struct(-F.length(F.coalesce(text, F.lit(""))), F.xxhash64(*hashed))).alias("r")
    several = found.groupBy(key.alias("k"), "sha").agg(best).select("r.*")
    return single.unionByName(several).toDF(*names)


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, length(t) AS p, regexp_replace(t, '[\x20\x09-\x0D]', '', 'g') AS k FROM d),
r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY k ORDER BY p DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY k) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256 FROM r
"""
