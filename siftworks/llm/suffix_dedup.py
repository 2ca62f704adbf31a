"""Operator 9: removal of repeated byte windows by a depth-limited most-significant-digit radix sort of suffixes.

Suffixes are ordered by their first `width` bytes only. A suffix that stands alone after a digit is never looked at
again; the groups left after the last digit are exactly the repeated windows, and all of a group but the earliest are
removed. One row a suffix would shuffle more than ten times the input, so neighbours travel together:

1. The first digit is a suffix's anchor: of the 16-byte grams of its window the lightest (leftmost of equals). Equal
   windows have equal anchors at equal places. Neighbouring suffixes with one anchor are a bundle, about 40 of them,
   which travels once, with its bytes. Bundles are dealt to buckets by the anchor, `FAN` at a time: where there are
   more buckets, they are dealt in two or more passes, most significant part of the bucket's number first.
2. In a bucket, of bundles with equal bytes the earliest stands for all; every window of the others is repeated. The
   same is done in each task before it deals its bundles out, so a passage of a third of all documents reaches a bucket
   once from each part of the input, not once from each document. A bundle alone under its anchor leaves.
3. The suffixes of the bundles left are sorted by the anchor's place and then by eight bytes at a time. Grams that
   many different contexts of a sample share weigh more than all others, so that a common line is the anchor of those
   windows alone that hold nothing else; the sample moves work between buckets and can't change a result.

Equal hashes never decide: bundles are compared byte by byte and suffixes by their digits. Spans to remove meet their
documents in a last shuffle, sorted, so that a document's bytes are held one at a time.

Documents are ordered by id, of one id by the text's hash; a null id comes before all others. Null and empty texts have
no bytes: nothing is removed, the hash is that of no bytes. Very long texts are cut into pieces whose windows overlap.
Rows that repeat an id and text are one document and get equal rows. Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, by_size, documents, input_bytes, materialize, mix, pack, partitions_for, text_bytes, unpack

GRAM = 16
PIECE = 1 << 18
FLUSH = 1 << 18
#: Of the compression of bundles: what they are made of moves once, so time is spent on size.
LEVEL = 6
#: Suffixes that a bucket sorts at once, unless one anchor has more.
AT_ONCE = 1 << 18
#: Buckets that one pass deals to.
FAN = 8192
NULL_KEY = -(1 << 63)
#: The sample from which heavy grams are taken: one text in SAMPLE, or more of a small input; a gram is heavy from CONTEXTS contexts on.
SAMPLE, SAMPLE_BYTES, CONTEXTS, MOST_HEAVY, TABLE = 64, 8 << 20, 32, 1 << 18, 1 << 22
BUNDLES = "bucket int, kind int, data binary"
SPANS = "key bigint, h bigint, start bigint, stop bigint"
_PLACE = np.uint64((1 << 24) - 1)
_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64) | 1 for i in range(64)], np.uint64)


def _words(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The eight bytes from every place on, as numbers. data ends with eight bytes to spare."""
    return np.ndarray((max(len(data) - 7, 0),), f"{order}u8", data, 0, (1,))


def _steps(width: int) -> list[int]:
    """Where the digits of `width` bytes begin; the last may overlap the one before."""
    return [*range(0, width - 8, 8), max(width - 8, 0)]


def _hash_at(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    out = np.full(len(at), width, np.uint64)
    for i, step in enumerate(_steps(width)):
        out += words[at + step] * _ODD[i % 64]
        if i % 64 == 63:
            out = mix(out)
    return mix(out)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the gram at each place. data ends with eight bytes to spare."""
    words, n = _words(data), len(data) - 8 - gram + 1
    out = np.full(n, gram, np.uint64)
    for i, step in enumerate(_steps(gram)):
        out += words[step:step + n] * _ODD[i]
    return mix(out)


def anchors(grams: np.ndarray, span: int, heavy: np.ndarray | None) -> np.ndarray:
    """For each run of span grams the place of the lightest, leftmost of equals; hashes are compared by 39 bits, after heaviness."""
    n = len(grams)
    size = -(-n // span) * span
    key = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    key[:n] = (grams >> np.uint64(1)) & ~_PLACE | np.arange(n, dtype=np.uint64)
    if heavy is not None:
        key[:n] |= heavy[grams & np.uint64(len(heavy) - 1)].astype(np.uint64) << np.uint64(63)
    blocks = key.reshape(-1, span)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:n - span + 1], left[span - 1:n]) & _PLACE).astype(np.int64)


def _cuts(changed: np.ndarray) -> np.ndarray:
    """Starts of runs; changed: whether each row but the first differs from the one before."""
    return np.flatnonzero(np.append(True, changed))


class Bundles:
    """Bundles with their bytes: document (key, h), start in it, number of suffixes, the anchor's place, and where their bytes are."""

    def __init__(self, width: int, key, h, start, count, anchor, at, data: bytes):
        self.width, self.key, self.h, self.start, self.count, self.anchor, self.at, self.data = width, key, h, start, count, anchor, at, data

    def __len__(self) -> int:
        return len(self.key)

    @property
    def sizes(self) -> np.ndarray:
        return self.count + (self.width - 1)

    def take(self, i: np.ndarray) -> Bundles:
        return Bundles(self.width, self.key[i], self.h[i], self.start[i], self.count[i], self.anchor[i], self.at[i], self.data)

    @classmethod
    def joined(cls, width: int, parts: list[Bundles]) -> Bundles:
        if not parts:
            none = np.empty(0, np.int64)
            return cls(width, none, none, none, none, none, none, b"")
        first = np.cumsum([0, *[len(p.data) for p in parts]])
        columns = [np.concatenate([getattr(p, c) for p in parts]) for c in ("key", "h", "start", "count", "anchor")]
        return cls(width, *columns, np.concatenate([p.at + f for p, f in zip(parts, first.tolist())]), b"".join([p.data for p in parts]))

    def in_order(self) -> Bundles:
        """Earliest first: by key, h, start."""
        order = np.lexsort((self.start, self.h))
        return self.take(order[np.argsort(self.key[order], kind="stable")])

    def buffer(self) -> np.ndarray:
        return np.frombuffer(self.data + bytes(8), np.uint8)

    def anchor_hashes(self) -> np.ndarray:
        return _hash_at(_words(self.buffer()), self.at + self.anchor, gram_of(self.width))

    def distinct(self) -> tuple[Bundles, Bundles]:
        """(earliest of equal bytes, the others). self is in order; a bundle of a row that repeats wholly is in neither."""
        words = _words(self.buffer())
        # the first and the last suffix cover a bundle, as it has fewer suffixes than their width
        content = _hash_at(words, self.at, self.width) * _ODD[1] + _hash_at(words, self.at + (self.count - 1), self.width) * _ODD[2] + self.count.astype(np.uint64)
        order = np.argsort(content, kind="stable")
        same = content[order]
        first = np.append(True, same[1:] != same[:-1]) if len(order) else np.empty(0, bool)
        lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        later, lead = order[~first], lead[~first]
        data, own, other = self.data, self.at[later].tolist(), self.at[lead].tolist()
        equal = np.array([data[a:a + n] == data[b:b + n] for a, b, n in zip(own, other, self.sizes[later].tolist())], bool) & (self.count[later] == self.count[lead])
        twice = equal & (self.key[later] == self.key[lead]) & (self.h[later] == self.h[lead]) & (self.start[later] == self.start[lead])
        # what only hashes alike stays, as do bundles equal to one that hashes alike: their suffixes are sorted
        stays = np.sort(np.concatenate([order[first], later[~equal]]))
        return self.take(stays), self.take(later[equal & ~twice])

    def dump(self) -> bytes:
        data, at = self.data, self.at.tolist()
        raw = b"".join([data[a:a + n] for a, n in zip(at, self.sizes.tolist())])
        return pack(np.diff(self.key, prepend=np.int64(0)), self.h, self.start, self.count.astype(np.int32), self.anchor.astype(np.int32), np.frombuffer(raw, np.uint8), level=LEVEL)

    @classmethod
    def load(cls, width: int, dumped: bytes) -> Bundles:
        key, h, start, count, anchor, raw = unpack(dumped, np.int64, np.int64, np.int64, np.int32, np.int32, np.uint8)
        count = count.astype(np.int64)
        sizes = count + (width - 1)
        return cls(width, np.cumsum(key), h, start, count, anchor.astype(np.int64), np.cumsum(sizes) - sizes, raw.tobytes())


def gram_of(width: int) -> int:
    return max(1, min(GRAM, width // 3))


def bundled(texts: list[bytes], keys: np.ndarray, hs: np.ndarray, width: int, heavy: np.ndarray | None) -> list[Bundles]:
    """The bundles of the texts' suffixes of width bytes or more."""
    out, gram = [], gram_of(width)
    pieces = [(i, at, t[at:at + PIECE + width - 1]) for i, t in enumerate(texts) for at in range(0, max(len(t) - width + 1, 0), PIECE)]
    for a, b in by_size([p[2] for p in pieces], PIECE):
        part = pieces[a:b]
        data = b"".join([p[2] for p in part])
        sizes = np.array([len(p[2]) for p in part])
        first = np.cumsum(sizes) - sizes
        own = anchors(gram_hashes(np.frombuffer(data + bytes(8), np.uint8), gram), width - gram + 1, heavy)
        windows = sizes - width + 1
        start = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        own = own[start]
        cut = _cuts((own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1))
        at, count = start[cut], np.diff(np.append(cut, len(start)))
        piece = np.searchsorted(first, at, "right") - 1
        doc = np.array([p[0] for p in part])[piece]
        out.append(Bundles(width, keys[doc], hs[doc], at - first[piece] + np.array([p[1] for p in part])[piece], count, own[cut] - at, at, data))
    return out


def merged(key: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans sorted by key and start, those of a key that meet or overlap made one."""
    if not len(key):
        return key, start, stop
    # stops are lifted above all of earlier keys, so that one running maximum serves for all keys
    lift = (np.cumsum(np.append(True, key[1:] != key[:-1])) - 1) * (int(stop.max()) + 2)
    reach = np.maximum.accumulate(stop + lift)
    cut = _cuts((start + lift)[1:] > reach[:-1])
    return key[cut], start[cut], (reach - lift)[np.append(cut[1:], len(key)) - 1]


def _spans(parts: list[tuple]) -> list[np.ndarray]:
    """(key, h, start, stop) in order, those that meet made one."""
    key, h, start, stop = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 4
    if not len(key):
        return [key, h, start, stop]
    order = np.lexsort((start, h, key))
    key, h, start, stop = key[order], h[order], start[order], stop[order]
    new = np.append(True, (key[1:] != key[:-1]) | (h[1:] != h[:-1]))
    doc, start, stop = merged(np.cumsum(new) - 1, start, stop)
    lead = np.flatnonzero(new)[doc]
    return [key[lead], h[lead], start, stop]


def _whole(b: Bundles) -> tuple:
    return b.key, b.h, b.start, b.start + b.sizes


def repeated(group: np.ndarray, at: np.ndarray, digits: np.ndarray, width: int) -> np.ndarray:
    """Which rows have an equal `width` bytes row before them in their group: most significant digits first, rows alone after a digit leave.

    Rows of a group stand in order; digits holds the eight bytes from every place on, the first the most significant.
    """
    row = np.argsort(group, kind="stable")
    for step in [None, *_steps(width)]:
        own = group[row]
        if step is not None:
            digit = digits[at[row] + step]
            order = np.lexsort((digit, own))
            row, own, digit = row[order], own[order], digit[order]
            changed = (own[1:] != own[:-1]) | (digit[1:] != digit[:-1])
        else:
            changed = own[1:] != own[:-1]
        cut = _cuts(changed) if len(row) else np.empty(0, np.int64)
        size = np.diff(np.append(cut, len(row)))
        number = np.repeat(np.arange(len(cut)), size)
        many = np.repeat(size > 1, size)
        row, number = row[many], number[many]
        group = group.copy() if step is None else group
        group[row] = number
        if not len(row):
            return row
    return row[np.append(False, group[row][1:] == group[row][:-1])]


def sort_bucket(bundles: Bundles) -> list[tuple]:
    """Spans (key, h, start, stop) of the repeated windows of a bucket."""
    width = bundles.width
    left, gone = bundles.in_order().distinct()
    out = [_whole(gone)]
    anchor = left.anchor_hashes()
    order = np.argsort(anchor, kind="stable")
    cut = _cuts(anchor[order][1:] != anchor[order][:-1]) if len(order) else np.empty(0, np.int64)
    size = np.diff(np.append(cut, len(order)))
    shared = order[np.repeat(size > 1, size)]
    size = size[size > 1]
    if not len(shared):
        return out
    total = np.cumsum(np.add.reduceat(left.count[shared], np.cumsum(size) - size))
    # anchors are sorted some at a time, so that as many suffixes as fit are held as rows
    turns = np.repeat(total // AT_ONCE, size)
    number = np.repeat(np.arange(len(size)), size)
    digits = _words(left.buffer(), ">")
    for i in np.split(np.arange(len(shared)), _cuts(turns[1:] != turns[:-1])[1:]):
        own = left.take(shared[i])
        which = np.repeat(np.arange(len(own)), own.count)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(own.count) - own.count, own.count)
        group = number[i][which] * width + own.anchor[which] - nth
        again = np.sort(repeated(group, own.at[which] + nth, digits, width))
        start = own.start[which[again]] + nth[again]
        out.append((own.key[which[again]], own.h[which[again]], start, start + width))
    return out


def _dealt(bundles: Bundles, number: np.ndarray, spans: list[tuple]) -> pa.RecordBatch:
    """A row of bundles for each number that has some, and the spans found on the way, which go along with any."""
    order = np.argsort(number, kind="stable")
    cut = _cuts(number[order][1:] != number[order][:-1]) if len(order) else np.empty(0, np.int64)
    rows = [(int(number[order[a]]), 0, bundles.take(order[a:b]).dump()) for a, b in zip(cut.tolist(), np.append(cut[1:], len(order)).tolist())]
    key, h, start, stop = _spans(spans)
    if len(key):
        rows.append((rows[int(h[0] % len(rows))][0] if rows else 0, 1, pack(np.diff(key, prepend=np.int64(0)), h, start, stop)))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "kind", "data"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, h, id, text): key and h order documents."""
    rows = documents(docs, id_col, text_col).toDF("id", "text")
    return rows.select(F.coalesce(F.col("id").cast("bigint"), F.lit(NULL_KEY)).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.col("id").cast("bigint").alias("id"), "text")


def _read(width: int, heavy):
    """Bundles of batches (key, h, text), some at a time, in order."""

    def parts(batches):
        held = []
        for b in batches:
            keys, hs, texts = b.column(0).to_numpy(), b.column(1).to_numpy(), text_bytes(b.column(2))
            for x, y in by_size(texts, 4 * PIECE):
                held += bundled(texts[x:y], keys[x:y], hs[x:y], width, heavy)
                if sum(map(len, held)) >= FLUSH:
                    yield Bundles.joined(width, held).in_order()
                    held = []
        if held:
            yield Bundles.joined(width, held).in_order()

    return parts


def heavy_grams(rows: DataFrame, width: int, total: int) -> np.ndarray | None:
    """A table that tells grams with many contexts by their hash's low bits; others may share their places, which does no harm."""
    some = rows.where(F.pmod("h", F.lit(max(1, min(SAMPLE, total // SAMPLE_BYTES)))) == 0).select("key", "h", "text")

    def counted(batches):
        for b in _read(width, None)(batches):
            left, _ = b.distinct()
            gram, n = np.unique(left.anchor_hashes().view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "n"])

    top = some.mapInArrow(counted, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= CONTEXTS)
    found = top.orderBy(F.desc("n"), "gram").limit(MOST_HEAVY).select("gram").toPandas()
    if not len(found):
        return None
    table = np.zeros(TABLE, bool)
    table[found["gram"].to_numpy(np.int64) & (TABLE - 1)] = True
    return table


def repeated_spans(rows: DataFrame, width: int, n: int, total: int) -> DataFrame:
    """(key, h, start, stop): spans to remove, some of which may meet. rows: key, h, text."""
    shared = rows.sparkSession.sparkContext.broadcast(heavy_grams(rows, width, total))  # TABLE bytes
    # divisors of a bucket's number that leave its digits, the most significant first
    digits = next(p for p in range(1, 64) if FAN ** p >= n)
    size = next(x for x in range(max(1, int(n ** (1 / digits))), n + 2) if x ** digits >= n)
    passes = [size ** i for i in range(digits - 1, -1, -1)]

    def deal(parts, divisor: int):
        for bundles in parts:
            left, gone = bundles.distinct()
            bucket = (left.anchor_hashes() >> np.uint64(32)) % np.uint64(n)
            yield _dealt(left, bucket.astype(np.int64) // divisor, [_whole(gone)])

    def first(batches):
        yield from deal(_read(width, shared.value)(batches), passes[0])

    def again(divisor: int):
        def dealt(batches):
            held = []
            for b in batches:
                spans = np.array(b.column(1).to_pylist()) == 1
                yield b.filter(pa.array(spans))
                for d in b.filter(pa.array(~spans)).column(2).to_pylist():
                    held.append(Bundles.load(width, d))
                    if sum(map(len, held)) >= FLUSH:
                        yield from deal([Bundles.joined(width, held).in_order()], divisor)
                        held = []
            if held:
                yield from deal([Bundles.joined(width, held).in_order()], divisor)

        return dealt

    def sort(table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("kind").to_pylist(), table.column("data").to_pylist()))
        bundles = Bundles.joined(width, [Bundles.load(width, d) for k, d in rows if not k])
        found = _spans([_load_spans(d) for k, d in rows if k] + sort_bucket(bundles))
        return pa.Table.from_arrays([pa.array(x) for x in found], names=["key", "h", "start", "stop"])

    dealt = rows.select("key", "h", "text").mapInArrow(first, BUNDLES)
    for divisor in passes[1:]:
        dealt = dealt.repartition("bucket").mapInArrow(again(divisor), BUNDLES)
    return dealt.groupBy("bucket").applyInArrow(lambda t: sort(t), SPANS)


def _load_spans(data: bytes) -> tuple:
    key, h, start, stop = unpack(data, np.int64, np.int64, np.int64, np.int64)
    return np.cumsum(key), h, start, stop


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 100, bucket_bytes: int = 4 << 20) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, spans array<struct<start, stop>>), one row per row of docs."""
    if width < 8:
        raise ValueError("windows have 8 bytes at least")
    rows = _keyed(docs, id_col, text_col)
    spans = materialize(repeated_spans(rows, width, buckets_for(docs, bucket_bytes), input_bytes(docs)))

    def packed(batches):
        import zstandard

        small = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(map(small.compress, text_bytes(b.column(3))), pa.binary())], names=["key", "h", "id", "text"])

    def cut(batches):
        import zstandard

        waiting = None  # spans of the document whose text is still to come
        for b in batches:
            kind, start, stop = (b.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4))
            key, h = b.column(0).to_numpy(), b.column(1).to_numpy()
            if waiting is not None:
                key, h, kind, start, stop = (np.concatenate(x) for x in zip(waiting, (key, h, kind, start, stop)))
            new = np.append(True, (key[1:] != key[:-1]) | (h[1:] != h[:-1]))
            doc = np.cumsum(new) - 1
            at = np.flatnonzero(kind == 1)
            span = np.flatnonzero(kind == 0)
            of, low, high = merged(doc[span], start[span], stop[span])
            unpacked = zstandard.ZstdDecompressor()
            texts = [unpacked.decompress(t) for t in b.column(6).filter(pa.array(b.column(2).to_numpy() == 1)).to_pylist()]
            ids = b.column(5).filter(pa.array(b.column(2).to_numpy() == 1))
            out: list[list] = [[] for _ in range(5)]
            ends = np.searchsorted(of, doc[at], "left").tolist(), np.searchsorted(of, doc[at], "right").tolist()
            low, high = low.tolist(), high.tolist()
            for t, x, y in zip(texts, *ends):
                kept, last, view = hashlib.sha256(), 0, memoryview(t)
                for p, q in zip(low[x:y], high[x:y]):
                    kept.update(view[last:p])
                    last = q
                kept.update(view[last:])
                for c, v in zip(out, (len(t), sum(high[x:y]) - sum(low[x:y]), y - x, kept.hexdigest(), [{"start": p, "stop": q} for p, q in zip(low[x:y], high[x:y])])):
                    c.append(v)
            # the last document's spans wait, for its text or for rows that repeat it
            rest = (doc == doc[-1]) & (kind == 0) if len(doc) else np.empty(0, bool)
            waiting = tuple(x[rest] for x in (key, h, kind, start, stop)) if rest.any() else None
            if len(texts):
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, f.type) for c, f in zip(out, list(_RESULT)[1:])]], schema=_RESULT)

    null = lambda kind: F.lit(None).cast(kind)
    texts = rows.mapInArrow(packed, "key bigint, h bigint, id bigint, text binary").select("key", "h", F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("stop"), "id", "text")
    both = spans.select("key", "h", F.lit(0).alias("kind"), "start", "stop", null("bigint").alias("id"), null("binary").alias("text")).unionByName(texts)
    dealt = both.repartition(partitions_for(docs), "key", "h").sortWithinPartitions("key", "h", "kind", "start")
    done = dealt.mapInArrow(cut, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,stop:bigint>>")
    return done.withColumnRenamed("id", id_col)


_RESULT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


SQL = """
WITH x AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM x WHERE n >= 100)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM w) WHERE nth > 1),
i AS (SELECT doc_id, p, sum(start) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (SELECT *, (p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000) + 100)::INTEGER AS start FROM r)),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, run),
g AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
c AS (SELECT g.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM g JOIN x USING (doc_id) GROUP BY g.doc_id)
SELECT x.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM x LEFT JOIN c USING (doc_id)
"""
