"""Operator 10: token-id files with a minimal perfect hash index.

Documents are range-partitioned by key, encoded with the tokenizers library, and written in ascending key order. A row
of a file is a segment: the raw ids of neighbouring documents as one unsigned 16- or 32-bit payload, each document's
offset, and an index, a minimal perfect hash from the document keys to slots that hold a 32-bit fingerprint of the key
and the number of its first document in the segment. Segments carry their key range and row groups their statistics, so
a lookup reads the segments its keys can be in and then needs a few hashes a key. Files are written through Spark's
commit protocol, so a task that is lost and run again leaves nothing behind.

Null and empty texts are one end token. Documents without a key come first, in the order of their text's hash, and are
found by scans only. A key on several rows has its documents side by side, in the order of their text's hash. Empty
table: no files with rows, no result.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import LATIN, byte_symbols, tokenizer_path
from .common import Recent, buckets_for, checkpoint_dir, documents, materialize, regrouped
from .perfect_hash import PerfectHash, mix

SEGMENT_TOKENS = 1 << 18
SHARD_BYTES = 64 << 20
#: Text that is encoded at once.
BATCH_BYTES = 8 << 20
#: Unicode white space, for a character class.
SPACES = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Shards whose starts are broadcast (16 MB); more are joined.
MOST_BROADCAST = 1 << 20
SCHEMA = "shard int, segment int, low bigint, high bigint, at bigint, n_docs int, n_tokens bigint, width int, keys binary, null_keys int, offsets binary, index binary, prints binary, firsts binary, counts binary, payload binary"


class LibraryEncoder:
    """Encodes with the tokenizers library, each distinct stretch of text once while it is remembered.

    Text is cut at single spaces between two other characters: there, and only there is this safe, the byte-level
    pre-split always starts a new word, so the stretches' ids join to the ids of the whole. Stretches are looked up all
    at once, as Arrow arrays; what is remembered are their ids in one array. Of stretches that aren't known, those of
    Latin letters, or of ASCII without apostrophes, are cut as the pre-split cuts them and the library's model takes each
    word as it is; the others are encoded as one text, whose ids are dealt out again by the tokens' lengths.
    """

    def __init__(self, path: str, most: int = 1 << 19):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        # a byte-level token has one character for each byte; a special token stands for its own bytes
        vocab = self.library.get_vocab()
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for t, i in vocab.items():
            self.lengths[i] = len(t.encode()) if t in special else len(t)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.model = BPE(model["vocab"], merges, cache_capacity=0)  # what is remembered is remembered here
        self.symbols = dict(enumerate(byte_symbols()))
        self.of_word = Recent(lambda w: [t.id for t in self.model.tokenize(w)], 20_000)
        # ASCII without apostrophes and with single line breaks inside, which the pre-split cuts between kinds of characters
        self.plain = re.compile(r"(?:[!-&(-~]|(?<=[!-~])\n(?=[!-~]))+")
        self.pieces = re.compile(r"[A-Za-z]+|[0-9]+|\n|[^A-Za-z0-9\n]+")
        self.special = re.compile("|".join(map(re.escape, sorted(special))) or r"(?!)")
        self.cut = re.compile(r"(?<=\S) (?=\S)")
        self.most = most
        self._remember(pa.array([], pa.large_string()), np.zeros(0, np.int32), np.zeros(0, self.kind))
        self.hits = np.zeros(0, np.int64)

    def _remember(self, words: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        self.words, self.counts, self.ids = words, counts, ids
        self.first = (np.cumsum(counts) - counts).astype(np.int32)

    def _alone(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind)

    def _learn(self, new: list[str]) -> np.ndarray:
        """Remember the ids of " " + each of new; where they are."""
        tokenize, words, symbols = self.model.tokenize, self.of_word, self.symbols
        whole, counts, ids, rest = [], [], [], []
        for i, p in enumerate(new):
            before = len(ids)
            if p.isascii():
                if p.isalpha():
                    ids += [t.id for t in tokenize("Ġ" + p)]
                elif self.plain.fullmatch(p) and not self.special.search(p):
                    first, *more = self.pieces.findall(p)
                    ids += words["Ġ" + first]
                    for m in more:
                        ids += words["Ċ" if m == "\n" else m]
                else:
                    rest.append(i)
                    continue
            elif p.isalpha() and max(p) <= LATIN:
                ids += [t.id for t in tokenize("Ġ" + p.encode().decode("latin-1").translate(symbols))]
            else:
                rest.append(i)
                continue
            whole.append(i)
            counts.append(len(ids) - before)
        all_counts, all_ids = [self.counts, np.array(counts, np.int32)], [self.ids, np.array(ids, self.kind)]
        for at in range(0, len(rest), 8192):
            part = [" " + new[i] for i in rest[at:at + 8192]]
            got = np.array(self.library.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.cumsum(self.lengths[got])
            cuts = np.searchsorted(ends, np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in part]), "left") + 1
            all_counts.append(np.diff(cuts, prepend=0).astype(np.int32))
            all_ids.append(got)
        order = np.array(whole + rest, np.int64)
        places = np.empty(len(new), np.int64)
        places[order] = len(self.words) + np.arange(len(new))
        self._remember(pa.concat_arrays([self.words, pa.array([new[i] for i in order.tolist()], pa.large_string())]), np.concatenate(all_counts), np.concatenate(all_ids))
        self.hits = np.append(self.hits, np.zeros(len(new), np.int64))
        return places

    def _forget(self) -> None:
        """Keep the more used half of what is remembered."""
        kept = np.flatnonzero(self.hits > np.median(self.hits))
        size = self.counts[kept]
        ids = self.ids[np.repeat(self.first[kept] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        self._remember(self.words.take(pa.array(kept)), size, ids)
        self.hits = np.zeros(len(kept), np.int64)

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Where each of the distinct stretches is remembered; what isn't yet is learnt."""
        if len(self.words) > self.most:
            self._forget()
        if not len(self.words):
            return self._learn(distinct.to_pylist())
        found = pc.index_in(distinct, value_set=self.words)
        out = found.fill_null(-1).to_numpy().astype(np.int64)
        new = out < 0
        if new.any():
            out[new] = self._learn(distinct.filter(pa.array(new)).to_pylist())
        return out

    def _joined(self, values: pa.Array, starts: np.ndarray) -> list[bytes]:
        """Ids of texts whose stretches stand in values, each text's from its start on."""
        coded = values.dictionary_encode()
        places = self._places(coded.dictionary)[coded.indices.to_numpy()]
        self.hits += np.bincount(places, minlength=len(self.hits))
        size = self.counts[places]
        size[starts] = 0  # a text's first stretch has no space before it
        first = [self._alone(t).tobytes() for t in values.take(pa.array(starts)).to_pylist()]
        ends = np.cumsum(size, dtype=np.int32)
        data = self.ids[np.repeat(self.first[places] - (ends - size), size) + np.arange(ends[-1], dtype=np.int32)].tobytes()
        width = np.dtype(self.kind).itemsize
        cuts = (np.append(ends[starts], ends[-1]) * width).tolist()
        return [f + data[a:b] for f, a, b in zip(first, cuts, cuts[1:])]

    def encode_batch(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids as little-endian bytes of self.kind."""
        texts = (pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())).fill_null("")
        out = [b""] * len(texts)
        filled = pc.not_equal(texts, "")
        odd = pc.match_substring_regex(texts, f" [{SPACES}]|[{SPACES}] ")
        for mask, split in ((pc.and_(filled, pc.invert(odd)), lambda x: pc.split_pattern(x, " ")), (pc.and_(filled, odd), lambda x: pa.array(map(self.cut.split, x.to_pylist()), pa.large_list(pa.large_string())))):
            if len(which := np.flatnonzero(mask.to_numpy(zero_copy_only=False))):
                parts = split(texts.filter(mask))
                starts = parts.offsets.to_numpy()[:-1].astype(np.int64)
                for i, x in zip(which.tolist(), self._joined(parts.flatten(), starts - starts[0])):
                    out[i] = x
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _segment(shard: int, number: int, at: int, keys: list, ids: list[bytes], kind) -> tuple:
    """One row of a file: keys ascend, the ones without a key first."""
    width = np.dtype(kind).itemsize
    lengths = np.array([len(x) // width for x in ids], np.int64)
    nulls = sum(k is None for k in keys)
    own = np.array(keys[nulls:], np.int64)
    distinct, first, count = np.unique(own, return_index=True, return_counts=True)
    hashed = PerfectHash.build(distinct.view(np.uint64))
    slot = hashed.slots(distinct.view(np.uint64))
    prints, firsts, counts = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.uint32)
    prints[slot], firsts[slot], counts[slot] = mix(distinct.view(np.uint64), 99).astype(np.uint32), first + nulls, count
    return (shard, number, int(own[0]) if len(own) else None, int(own[-1]) if len(own) else None, at, len(keys), int(lengths.sum()), width, own.tobytes(), nulls,
            np.append(0, np.cumsum(lengths)).tobytes(), hashed.dump(), prints.tobytes(), firsts.tobytes(), counts.tobytes(), b"".join(ids))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode docs and write them to path; one shard a range partition, about SHARD_BYTES of input each."""
    rows = documents(docs, id_col, text_col).toDF("id", "text").withColumn("h", F.xxhash64("text"))
    spark = docs.sparkSession
    shards = max(buckets_for(docs, SHARD_BYTES, 1), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(shards, "id", "h")
    names = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    types = [kinds[x.strip().split(" ")[1]] for x in SCHEMA.split(",")]

    def written(batches):
        from pyspark import TaskContext

        shard, number, at = TaskContext.get().partitionId(), 0, 0
        e = encoder(tokenizer)
        end = np.array([end_id], e.kind).tobytes()
        keys, ids, held = [], [], 0

        def row():
            r = _segment(shard, number, at, keys, ids, e.kind)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(r, types)], names=names), r[6]

        for b in regrouped(batches, 1, BATCH_BYTES):
            for k, x in zip(b.column(0).to_pylist(), e.encode_batch(b.column(1))):
                keys.append(k)
                ids.append(x + end)
                held += len(ids[-1])
                if held >= SEGMENT_TOKENS * len(end):
                    batch, n = row()
                    yield batch
                    number, at, keys, ids, held = number + 1, at + n, [], [], 0
        if keys:
            yield row()[0]

    dealt.sortWithinPartitions("id", "h").select("id", "text").mapInArrow(written, SCHEMA).write.option("compression", "none").parquet(path)


class Segment:
    """A segment read back."""

    def __init__(self, row: dict):
        self.kind = np.uint16 if row["width"] == 2 else np.uint32
        self.ids = np.frombuffer(row["payload"], self.kind)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.keys = np.frombuffer(row["keys"], np.int64)
        self.nulls, self.at, self.row = row["null_keys"], row["at"], row
        self.prints, self.firsts, self.counts = (np.frombuffer(row[c], np.uint32) for c in ("prints", "firsts", "counts"))
        self.hash = PerfectHash.load(row["index"])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of each key; 0 documents if the key isn't here."""
        k = keys.view(np.uint64)
        slot = self.hash.slots(k)
        safe = np.maximum(slot, 0)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        there = (slot >= 0) & (self.prints[safe] == mix(k, 99).astype(np.uint32))
        first = np.where(there, self.firsts[safe], 0).astype(np.int64)
        # a 32-bit fingerprint may agree by chance: the key that is stored decides
        there &= self.keys[np.maximum(first - self.nulls, 0)] == keys
        return first, np.where(there, self.counts[safe], 0).astype(np.int64)

    def crc(self, i: int) -> int:
        return zlib.crc32(self.ids[self.offsets[i]:self.offsets[i + 1]].astype("<u4").tobytes())


_READ = ["start0", "at", "width", "keys", "null_keys", "offsets", "index", "prints", "firsts", "counts", "payload"]


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of every document, each looked up by its key in its segment's index."""
    files = spark.read.parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # one row a shard of 16 bytes; without a hint the join would deal out the payloads before it knows how small this is
    starts = materialize(shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("start0")))
    if starts.count() <= MOST_BROADCAST:
        starts = F.broadcast(starts)

    def read(batches):
        for b in batches:
            for row in b.to_pylist():
                s = Segment(row)
                n = len(s.offsets) - 1
                keys = np.unique(s.keys)
                first, count = s.find(keys)
                assert int(count.sum()) == n - s.nulls, "the index doesn't cover its segment"
                at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                order = np.concatenate([np.arange(s.nulls), at])
                ids = pa.array([None] * s.nulls + np.repeat(keys, count).tolist(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(row["start0"] + s.at + s.offsets[order]), pa.array(np.diff(s.offsets)[order]), pa.array([s.crc(int(i)) for i in order], pa.int64())],
                    names=["id", "start", "n_tokens", "ids_crc32"])

    rows = files.join(starts, "shard").select(*_READ).mapInArrow(read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.withColumnRenamed("id", id_col)


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """(key, ids array<bigint>) of the documents under a few keys: only segments whose key range meets theirs are read."""
    asked = np.unique(np.array(keys, np.int64))
    low, high = (int(asked[0]), int(asked[-1])) if len(asked) else (0, -1)
    files = spark.read.parquet(path).where((F.col("low") <= high) & (F.col("high") >= low)).withColumn("start0", F.lit(0).cast("bigint"))

    def read(batches):
        for b in batches:
            for row in b.to_pylist():
                s = Segment(row)
                first, count = s.find(asked)
                found = [(int(k), s.ids[s.offsets[i]:s.offsets[i + 1]].tolist()) for k, f, c in zip(asked, first, count) for i in range(f, f + c)]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64()))], names=["key", "ids"])

    return files.select(*_READ).mapInArrow(read, "key bigint, ids array<bigint>")


def query(spark, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_path("byte_bpe_50k.json"))
    return read_token_files(spark, path)


SQL = None
