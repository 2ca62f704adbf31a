"""Operator 1 at a similarity of word shingles: SimHash proposes, whole sets decide, and nothing is approximated.

A text is the set of its runs of five words (a shorter text is one run), as 64-bit hashes; equal hashes count as equal
runs, and equal 64-bit hashes of texts as equal texts. Two sets are linked at Jaccard similarity 0.8 or more;
components of links are the groups.

1. Buckets: runs are ordered, those common in a sample of documents last. Two sets of n runs that are similar share a
   run among the first n - ceil(0.8 n) + 1 of each (prefix filter), so those runs are the buckets' keys. The sample
   changes the cost only: any order gives the same links. The key of very many texts is cut into parts.
2. SimHash: in every bucket the fingerprints of the runs are compared on bit planes with carry-save counters. Of the
   texts within 15 bits a text's partner is the one with most such texts of its own, and each text is compared with its
   partner on whole sets: one link a text and bucket, which joins copies with what they were made from.
3. The rest: for a bucket whose texts aren't all joined by now, every pair of texts of different components that sizes
   and places allow is compared, first on parity sketches (a bit that an odd number of runs fall on; the bits in which
   two sketches differ are never more than the runs in which the sets differ), then on whole sets. So the links leave
   out no pair that could join two components. In a bucket of more than `SMALL` texts sketches are compared where the
   bucket is, and only pairs that pass leave it.

Pairs are dealt by pairs of blocks of texts: a sketch or set travels once a block, not once a pair, and pairs that a
block's links have joined already are passed over.

Nulls and texts without words equal each other and nothing else. Ids behave as in operator 1: a null id is never the least of
a component unless all are null. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bit_slices import partners
from .common import Recent, documents, join_hot, materialize, partitions_for, text_bytes
from .components import components

#: Similarity of at least NUM / DEN.
NUM, DEN = 4, 5
RADIUS = 15
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
SAMPLE, COMMON = 1 << 14, 1 << 18
NO_WORDS = np.zeros(1, np.uint64)
#: Texts of a block of pairs, and rows of a bucket's part.
BLOCK, PART = 512, 4096
#: Texts of a bucket up to which its pairs leave it to be compared: as many as the texts times half of this at most.
SMALL = 8
#: Rows that may be broadcast, of three numbers each.
FEW = 1 << 18
KEYS = "key bigint, part int, th bigint, fp bigint, n int, pos int"


def word_hashes() -> Recent:
    from xxhash import xxh64_intdigest

    return Recent(lambda w: xxh64_intdigest(w, 42), 20_000)


def shingle_set(text: bytes, hashes: Recent, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of width words, split and lowered as in operator 1; without words a set of its own."""
    words = text.lower().split()
    if not words:
        return NO_WORDS
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(width, len(h))
    runs = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        runs += h[j:len(h) - k + 1 + j] * _ODD[j % 5] + np.uint64(j // 5)
    runs ^= runs >> np.uint64(32)
    runs *= np.uint64(0xD6E8FEB86659FD93)
    runs ^= runs >> np.uint64(32)
    return np.unique(runs)


def fingerprint(runs: np.ndarray) -> int:
    """SimHash of a set, as a signed number."""
    if not len(runs):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(runs), 1 << 14):
        counts += np.unpackbits(runs[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(runs), bitorder="little").view(np.int64)[0])


def sketch(runs: np.ndarray) -> bytes:
    """The number of runs, and two to four bits a run: whether an odd number of runs fall on each."""
    bits = 64
    while bits < 2 * len(runs):
        bits *= 2
    odd = np.bincount((runs & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.int64(len(runs)).tobytes() + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_be_similar(a: bytes, b: bytes) -> bool:
    """False only for sketches of sets that aren't similar: in d runs at most (a + b) (DEN - NUM) / (DEN + NUM) do similar sets differ."""
    n, m = (int(np.frombuffer(s, np.int64, 1)[0]) for s in (a, b))
    x, y = (np.frombuffer(s, np.uint64, offset=8) for s in (a, b))
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum()) * (DEN + NUM) <= (n + m) * (DEN - NUM)


def prefix(runs: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The runs that are keys, in the order of all runs: by hash, common ones after all others by rank."""
    if len(common):
        at = np.minimum(np.searchsorted(common, runs), len(common) - 1)
        runs = runs[np.lexsort((runs, np.where(common[at] == runs, rank[at] + 1, 0)))]
    return runs[:len(runs) + 1 - (NUM * len(runs) + DEN - 1) // DEN]


def similar(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return DEN * both >= NUM * (len(x) + len(y) - both)


def possible(n: np.ndarray, pos: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of rows of a key could be similar if it is the first run that they share."""
    most = np.minimum(n[x] - pos[x], n[y] - pos[y])
    return (DEN + NUM) * most >= NUM * (n[x] + n[y])


def _mapped(texts: DataFrame, width: int, make, schema: str) -> DataFrame:
    """make(th, sets) gives the columns for a batch of texts (th, text); a task reads a text that repeats once."""

    def run(batches):
        hashes, seen = word_hashes(), Recent(lambda th: False)
        for b in batches:
            th = b.column(0).to_numpy()
            new = np.zeros(len(th), bool)
            for i, t in enumerate(th.tolist()):
                new[i] = not seen[t]
                seen[t] = True
            yield pa.RecordBatch.from_arrays(*make(th[new], [shingle_set(t, hashes, width) for t in text_bytes(b.column(1).filter(pa.array(new)))]))

    return texts.mapInArrow(run, schema)


def common_runs(texts: DataFrame, width: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, rank, parts) of at most COMMON runs that several texts of a sample have, sorted by run; rarer ones rank first."""
    share = max(1, rows // SAMPLE)
    some = texts.where(F.pmod("th", F.lit(share)) == 0)
    runs = _mapped(some, width, lambda th, sets: ([pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64))], ["run"]), "run bigint")
    top = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 2").orderBy(F.desc("n"), "run").limit(COMMON).toPandas()
    run = top["run"].to_numpy(np.int64).view(np.uint64)
    by = np.argsort(run)
    return run[by], (len(run) - 1 - np.arange(len(run)))[by], (top["n"].to_numpy(np.int64)[by] * share // PART + 1)


def read_texts(texts: DataFrame, width: int, rows: int) -> DataFrame:
    """(th, n, fp, sketch, keys array, parts array), one row a text and task."""
    shared = texts.sparkSession.sparkContext.broadcast(common_runs(texts, width, rows))  # at most COMMON rows of three numbers

    def make(th, sets):
        common, rank, parts = shared.value
        own = [prefix(s, common, rank) for s in sets]
        every = np.concatenate([*own, np.empty(0, np.uint64)])
        cuts = np.ones(len(every), np.int32)
        if len(common):
            at = np.minimum(np.searchsorted(common, every), len(common) - 1)
            cuts = np.where(common[at] == every, parts[at], 1).astype(np.int32)
        ends = pa.array(np.cumsum([0, *map(len, own)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (every.view(np.int64), cuts)]
        return [pa.array(th), pa.array([len(s) for s in sets], pa.int32()), pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary()), *lists], ["th", "n", "fp", "sketch", "keys", "parts"]

    return _mapped(texts, width, make, "th bigint, n int, fp bigint, sketch binary, keys array<bigint>, parts array<int>")


def _groups(batches, columns: int):
    """Arrays of whole groups: rows are sorted, the first two columns are a group's."""
    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(columns)], axis=1)
        last = np.flatnonzero((part[:, :2] != part[-1, :2]).any(axis=1))
        if not len(last) and held and (held[-1][-1, :2] == part[-1, :2]).all():
            held.append(part)  # one group so far
            continue
        cut = int(last[-1]) + 1 if len(last) else 0
        if len(whole := np.concatenate([*held, part[:cut]]) if held else part[:cut]):
            yield whole
        held = [part[cut:]]
    if held:
        yield np.concatenate(held)


def shared_keys(read: DataFrame) -> DataFrame:
    """Rows of keys that two texts or more have, in order of key and part; a key in one part alone with one text leaves."""
    rows = read.select("th", "fp", "n", F.posexplode(F.arrays_zip("keys", "parts")).alias("pos", "k"))
    rows = rows.select(F.col("k.keys").alias("key"), F.pmod("th", F.col("k.parts")).cast("int").alias("part"), "th", "fp", "n", "pos", F.col("k.parts").alias("parts"))

    def kept(batches):
        last = np.zeros((0, 7), np.int64)
        for batch in batches:
            part = np.concatenate([last, np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(7)], axis=1)])
            if not len(part):
                continue
            new = np.append(True, (part[1:, :3] != part[:-1, :3]).any(axis=1))
            part = part[new]  # a text that several tasks have read
            edge = np.append(True, (part[1:, :2] != part[:-1, :2]).any(axis=1))
            single = edge & np.append(edge[1:], False) & (part[:, 6] == 1)
            # the last row waits: the next batch tells if it stands alone; if it doesn't, it is marked by its parts
            if not edge[-1]:
                part[-1, 6] = 2
            yield _rows(part[:-1][~single[:-1]])
            last = part[-1:]
        yield _rows(last[last[:, 6] > 1])

    def _rows(x):
        return pa.RecordBatch.from_arrays([pa.array(x[:, i].astype(k)) for i, k in enumerate((np.int64, np.int32, np.int64, np.int64, np.int32, np.int32))], names=[c.strip().split(" ")[0] for c in KEYS.split(",")])

    dealt = rows.repartition(partitions_for(read, 64 << 20), "key", "part").sortWithinPartitions("key", "part", "th")
    return dealt.mapInArrow(kept, KEYS)


def proposed(rows: DataFrame) -> DataFrame:
    """(a, b), a < b: links of the bit-sliced comparison of every bucket's fingerprints. rows stand in order of key and part."""

    def found(batches):
        for part in _groups(batches, 4):
            bucket = np.cumsum(np.append(0, (part[1:, :2] != part[:-1, :2]).any(axis=1)))
            a, b = partners(part[:, 3].copy().view(np.uint64), bucket, RADIUS)
            yield _pairs(part[a, 2], part[b, 2])

    return rows.select("key", "part", "th", "fp").mapInArrow(found, "a bigint, b bigint").distinct()


def _pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0) if len(x) else np.empty((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])


def left_over(rows: DataFrame, sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs of small buckets to compare on sketches, pairs of others that have passed): (a, b), a < b, of different roots.

    rows: key, th, n, pos, root. sketches: th, data. A key of more than PART texts is cut into parts, and each pair of
    parts is a group of its own.
    """
    mixed = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    rows = materialize(join_hot(rows, mixed.select("key", "m"), ["key"], "m"))
    small, large = rows.where(F.col("m") <= SMALL), rows.where(F.col("m") > SMALL)

    def few(batches):
        for part in _groups(batches, 6):
            ends = np.flatnonzero(np.append(part[1:, 0] != part[:-1, 0], True)) + 1
            sizes = np.diff(np.append(0, ends))
            start = np.repeat(ends - sizes, sizes)
            out = [np.empty((0, 2), np.int64)]
            for step in range(1, SMALL):  # each row with the one `step` places on
                x = np.arange(len(part) - step)
                x = x[start[x] == start[x + step]]
                y = x + step
                _, _, th, n, pos, root = part.T
                on = (root[x] != root[y]) & possible(n, pos, x, y)
                out.append(np.stack([th[x[on]], th[y[on]]], axis=1))
            yield _pairs(*np.concatenate(out).T)

    cuts = F.ceil(F.col("m") / PART)
    own = F.pmod(F.xxhash64("th"), F.col("cuts"))
    every = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1), lambda j: F.least(F.col("own"), j) * F.col("cuts") + F.greatest(F.col("own"), j))
    large = large.withColumn("cuts", cuts).withColumn("own", own).withColumn("pair", F.explode(every)).withColumn("pair", F.when(F.col("cuts") == 1, 0).otherwise(F.col("pair")))
    # whoever is in several buckets is sent a sketch for each; only those that are in one are
    wanted = large.select("th").distinct()
    large = large.join(sketches.join(wanted, "th", "left_semi").dropDuplicates(["th"]), "th").select("key", "pair", "th", "n", "pos", "root", "data")

    def passed(batches):
        now, held = None, []
        for batch in batches:
            numbers = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)], axis=1)
            for row, data in zip(numbers, batch.column(6).to_pylist()):
                if (row[0], row[1]) != now:
                    if held:
                        yield _pairs(*similar_sketches(held))
                    now, held = (row[0], row[1]), []
                held.append((row[2:], data))
        if held:
            yield _pairs(*similar_sketches(held))

    dealt = small.withColumn("pair", F.lit(0)).select("key", "pair", "th", "n", "pos", "root").repartition("key").sortWithinPartitions("key", "th")
    sent = large.repartition("key", "pair").sortWithinPartitions("key", "pair", "th")
    return dealt.mapInArrow(few, "a bigint, b bigint").distinct(), sent.mapInArrow(passed, "a bigint, b bigint").distinct()


def similar_sketches(group: list[tuple[np.ndarray, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) of a group's rows (th, n, pos, root) of different roots that places and sketches allow.

    Sizes of similar sets differ by a quarter at most, hence their sketches by one halving.
    """
    th, n, pos, root = np.array([g[0] for g in group]).T
    words = [np.frombuffer(g[1], np.uint64, offset=8) for g in group]
    bits = np.array([len(w) for w in words])
    out = [np.empty((0, 2), np.int64)]
    for size in np.unique(bits):
        own, next_up = np.flatnonzero(bits == size), np.flatnonzero(bits == 2 * size)
        rows = np.concatenate([own, next_up])
        table = np.array([words[i] for i in own] + [words[i][:size] ^ words[i][size:] for i in next_up])
        for k in range(len(own)):
            y = np.arange(k + 1, len(rows))
            y = y[(root[rows[y]] != root[own[k]]) & possible(n, pos, np.full(len(y), own[k]), rows[y])]
            if len(y):
                apart = np.bitwise_count(table[y] ^ table[k]).sum(axis=1, dtype=np.int64)
                y = rows[y[apart * (DEN + NUM) <= (n[own[k]] + n[rows[y]]) * (DEN - NUM)]]
                out.append(np.stack([np.full(len(y), th[own[k]]), th[y]], axis=1))
    return tuple(np.concatenate(out).T)


def checked(pairs: DataFrame, payload: DataFrame, test, tree: bool) -> DataFrame:
    """The pairs (a, b) whose payloads pass; tree: leave out those that join what a block's pairs have joined already. payload: th, data."""
    n = pairs.select(F.explode(F.array("a", "b")).alias("th")).distinct().count()
    blocks = F.lit(max(1, -(-n // BLOCK)))
    pairs = pairs.select(F.pmod("a", blocks).alias("i"), F.pmod("b", blocks).alias("j"), "a", "b")
    wanted = pairs.select("i", "j", F.explode(F.array("a", "b")).alias("th")).distinct()
    wanted = F.broadcast(wanted) if n <= FEW and wanted.count() <= FEW else wanted
    null = lambda kind: F.lit(None).cast(kind)
    rows = payload.join(wanted, "th").select("i", "j", F.col("th").alias("a"), null("bigint").alias("b"), "data").unionByName(pairs.withColumn("data", null("binary")))

    def compared(batches):
        now, held, up = None, {}, {}

        def find(x):
            while (y := up.get(x, x)) != x:
                up[x] = x = up.get(y, y)
            return x

        for batch in batches:
            out_a, out_b = [], []
            for i, j, a, b, data in zip(*[c.to_pylist() for c in batch.columns]):
                if (i, j) != now:
                    now, held, up = (i, j), {}, {}
                if data is not None:
                    held[a] = data
                    continue
                x, y = (find(a), find(b)) if tree else (a, b)
                if x != y and test(held[a], held[b]):
                    up[max(x, y)] = min(x, y)
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    dealt = rows.repartition("i", "j").sortWithinPartitions("i", "j", F.asc_nulls_first("b"), "a")
    return dealt.mapInArrow(compared, "a bigint, b bigint")


def verified(texts: DataFrame, width: int, pairs: DataFrame) -> DataFrame:
    """(child, parent), child > parent: links that join all texts which similar pairs join."""
    pairs = materialize(pairs)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("th")).distinct()
    some = texts.join(F.broadcast(wanted) if pairs.count() <= FEW // 2 else wanted, "th", "left_semi")
    whole = _mapped(some.select("th", "text"), width, lambda th, sets: ([pa.array(th), pa.array([s.tobytes() for s in sets], pa.binary())], ["th", "data"]), "th bigint, data binary")
    return checked(pairs, whole, similar, True).select(F.col("b").alias("child"), F.col("a").alias("parent"))


def similar_groups(docs: DataFrame, id_col: str, text_col: str, width: int = 5) -> DataFrame:
    """One row per row of docs: id_col, component_id (least id reachable by links of similarity 0.8 or more)."""
    texts = documents(docs, id_col, text_col).toDF("id", "text").select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    counts = materialize(texts.groupBy("th").agg(F.count(F.lit(1)).alias("m")))
    n = counts.count()
    words = texts.select("th", "text")
    read = materialize(read_texts(words, width, n))
    rows = materialize(shared_keys(read))
    links = materialize(verified(words, width, proposed(rows)))
    near = components(links).toDF("th", "up")
    rest = materialize(rows.join(near, "th", "left").select("key", "th", "n", "pos", F.coalesce("up", "th").alias("root")))
    sketches = read.select("th", F.col("sketch").alias("data"))
    few, passed = left_over(rest, sketches)
    more = verified(words, width, checked(materialize(few), sketches, may_be_similar, False).unionByName(passed).distinct())
    reached = components(links.unionByName(more)).toDF("th", "up")
    classes = counts.join(reached, "th", "left").select("th", "m", F.coalesce("up", "th").alias("root"))
    root = join_hot(texts.select("id", "th"), classes, ["th"], "m").select("id", "root")
    root = materialize(root)
    least = root.groupBy("root").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("m"))
    return join_hot(root, least, ["root"], "m").select(F.col("id").alias(id_col), "component_id")
