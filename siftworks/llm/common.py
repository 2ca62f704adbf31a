"""Helpers shared by the corpus operators: inputs, checkpoints, Arrow batches."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space bytes, [\x20\x09-\x0D].
ASCII_SPACE = b" \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints; one of our own only on a single machine whose session names none."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="siftworks-checkpoint-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and go on from there, so a lost executor costs no rerun of what made it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(True)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of df (file sizes for a scan). Where there is none, as for local rows, strings are measured."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < 1 << 56:
        return size
    lengths = [F.coalesce(F.length(F.col(f"`{c}`")), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    return df.select(sum(lengths, F.lit(16)).alias("n")).agg(F.sum("n")).first()[0] or 0


def buckets_for(df: DataFrame, bytes_each: int, least: int = 32) -> int:
    """Buckets of about bytes_each of df's files; many more buckets than tasks is fine."""
    return max(least, -(-input_bytes(df) // bytes_each))


def partitions_for(df: DataFrame, bytes_each: int = 128 << 20) -> int:
    """Partitions to deal df's rows to: the session's number, or more if one would hold above bytes_each of df's files."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // bytes_each))


#: Keys that are joined apart, by a broadcast, and the rows from which on a key may be one of them.
MOST_HOT, HOT_ROWS = 4096, 256


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """rows joined (inner) with table, which has one row a key and in `count` the number of rows of that key.

    The at most MOST_HOT most frequent keys are joined by a broadcast, so no task gets all rows of one; any other key has
    less than one in MOST_HOT of the rows.
    """
    hot = materialize(table.where(F.col(count) > HOT_ROWS).orderBy(F.desc(count), *keys).limit(MOST_HOT))
    if hot.isEmpty():
        return rows.join(table, keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(table, keys))


#: Ids that are broadcast; more are joined.
FEW_IDS = 1 << 20


def without(rows: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """rows whose key isn't in gone's one column. Ids that go are few beside the rows, so up to FEW_IDS of them travel instead of the rows."""
    gone = materialize(gone.toDF("gone").distinct())
    return rows.join(F.broadcast(gone) if gone.count() <= FEW_IDS else gone, key.eqNullSafe(F.col("gone")), "left_anti")


#: Rows of an Arrow batch: whole documents are long, so Spark's 10,000 could be a gigabyte.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS, unless they are that small already."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the columns an operator reads, so whatever else the table holds can't clash."""
    small_batches(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def by_place(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with its columns named by their place, so that no name of ours can clash, and the names to give back."""
    return docs.toDF(*[f"column{i}" for i in range(len(docs.columns))]), docs.columns


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def by_size(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of at most `most` bytes together; one longer text is a range of its own."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > most:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def regrouped(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches of about `most` bytes in column `text`, in the same order; one longer text is with what is next to it."""
    held, size = [], 0
    for b in batches:
        sizes = pc.binary_length(b.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            to = min(len(sizes), int(np.searchsorted(ends, most - size + (ends[at - 1] if at else 0))) + 1)
            held.append(b.slice(at, to - at))
            size += int(sizes[at:to].sum())
            at = to
            if size >= most:
                yield from _one(held)
                held, size = [], 0
    if held:
        yield from _one(held)


def _one(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()


class Recent(dict):
    """A bounded cache in two generations: when the young one is full it becomes the old one."""

    def __init__(self, make, most: int = 200_000):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
        self[key] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed string of bytes."""
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(b"".join([np.array([a.nbytes for a in arrays], np.int64).tobytes(), *[np.ascontiguousarray(a).tobytes() for a in arrays]]))


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    """The arrays of `pack`, which were of these kinds."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    ends = np.cumsum(sizes) + 8 * len(kinds)
    return [np.frombuffer(raw, k, s // np.dtype(k).itemsize, e - s) for k, s, e in zip(kinds, sizes.tolist(), ends.tolist())]
