"""Operator 6: exact top-k search by BM25 over an inverted index with block-max pruning, after block-max WAND.

The index is built in shards, each a row: postings in term order. Shard statistics add up to the global ones (documents,
mean length, document frequencies of the asked terms), with which every shard scores, so the merge of the shards' top k
is exact. In a shard frequent lists (a sixteenth of the documents or more) keep the greatest impact of every block of 128
neighbouring documents. For a query:

1. the rare lists are its essential ones: their postings are scored, and a block's bound is the best such sum in it plus
   the frequent lists' block maxima times their weights;
2. a query has a threshold, a score that k documents reach: that of the shards of earlier rounds (a few, then some, then
   all others), and what its task found so far; in the first shards the blocks of the greatest bounds are scored for one;
3. blocks whose bound is below the threshold are skipped with all their postings in frequent lists. The others are scored
   as matrix products in 32 bits, and what may reach the threshold within their rounding is scored again in 64 bits.

Many queries are pruned at once, and a block is scored for all that want it. A pivot that moves with every posting of
every list was built too, and costs seven times as much for queries as long as these (see the README).

Words are runs of letters and digits, lower-cased. A word's weight in a query counts its repeats. Scores are compared at
six decimals, so that the order of summing can't decide; ties go to the smaller id.

Queries are taken in blocks of bounded size (rows and bytes), one pass over the index each; the documents of a pass are
never moved. Null and empty texts match nothing and as queries have no result; null ids are no results and no queries.
Repeated rows are results of their own; queries that repeat wholly are asked once, those of one id and several texts give
the k best of all. Ids are whole numbers. Empty table: no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize, pack, unpack

K1, B = 1.2, 0.75
SHARD_DOCS, SHARD_WORDS, BLOCK = 8192, 8 << 20, 128
#: Words that are Python strings at once.
FRESH_WORDS = 1 << 18
#: Terms in one of so many documents of a shard are dense, up to so many cells.
DENSE, CELLS = 16, 1 << 24
#: Half of the last decimal that is compared, and more than sums in another order differ by.
SLACK = 1e-6
QUERY_ROWS, QUERY_CHARS = 16384, 64 << 20
#: Queries of a matrix product, and of a record batch of results.
PART, SENT = 512, 1024
#: Shards that are searched first, for thresholds: one of so many, but about so many at least; and how many times as many are searched by the end of each further round.
SEED_SHARE, SEEDS, ROUND = 32, 8, 6
_WORDS = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(n_docs bigint, n_words bigint, data binary), one row a shard."""

    def indexed(batches):
        ids: list[int] = []
        lengths: list[int] = []
        terms: list[pa.Array] = []
        fresh: list[str] = []
        held = 0

        def shard():
            code = pa.chunked_array([*terms, pa.array(fresh, pa.large_string())]).dictionary_encode()
            term = np.concatenate([c.indices.to_numpy() for c in code.chunks]).astype(np.int64)
            vocab = code.chunk(code.num_chunks - 1).dictionary.to_pylist()
            n = len(ids)
            key, tf = np.unique(term * n + np.repeat(np.arange(n), lengths), return_counts=True)
            df = np.bincount(key // n, minlength=len(vocab)) if len(key) else np.empty(0, np.int64)
            data = pack(np.array(ids, np.int64), np.array(lengths, np.int64), np.frombuffer("\n".join(vocab).encode(), np.uint8), df.astype(np.int32), (key % n if n else key).astype(np.uint16), tf.astype(np.uint32))
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([len(term)], pa.int64()), pa.array([data], pa.binary())], names=["n_docs", "n_words", "data"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = words(t)
                ids.append(i)
                lengths.append(len(own))
                fresh += own
                held += len(own)
                if len(fresh) >= FRESH_WORDS:
                    terms.append(pa.array(fresh, pa.large_string()))
                    fresh.clear()
                if len(ids) >= SHARD_DOCS or held >= SHARD_WORDS:
                    yield shard()
                    ids, lengths, terms, fresh, held = [], [], [], [], 0
        if ids:
            yield shard()

    rows = documents(docs, id_col, text_col).toDF("id", "text").where("id IS NOT NULL")
    return rows.mapInArrow(indexed, "n_docs bigint, n_words bigint, data binary")


class Shard:
    """A shard read for scoring; without a mean length, for its document frequencies alone.

    Terms in at least a sixteenth of the documents have a dense row of impacts (the most frequent of them, if there are
    more than CELLS allow); all others keep their postings. Documents are put in the order of their strongest dense term
    and their length, so that a block holds documents of one kind and its bounds are tight.
    """

    def __init__(self, data: bytes, mean_length: float | None = None):
        self.ids, lengths, vocab, df, doc, tf = unpack(data, np.int64, np.int64, np.uint8, np.int32, np.uint16, np.uint32)
        self.vocab = pc.split_pattern(pa.array([vocab.tobytes().decode()] if len(vocab) else [], pa.large_string()), "\n").flatten()
        self.df = df.astype(np.int64)
        #: Postings scored, and postings of the lists asked for, since the shard was read.
        self.scored = self.asked = 0
        if mean_length is None or not len(df):
            return
        n = len(self.ids)
        norm = K1 * (1 - B + B * lengths / mean_length)
        impact = tf * (K1 + 1) / (tf + norm[doc])
        self.n_blocks = -(-n // BLOCK)
        frequent = self.df >= max(8, n // DENSE)
        if frequent.sum() > (most := max(1, CELLS // (self.n_blocks * BLOCK))):
            frequent = np.zeros(len(df), bool)
            frequent[np.argsort(-self.df, kind="stable")[:most]] = True
        self.row = np.where(frequent, np.cumsum(frequent) - 1, -1)
        dense = np.zeros((int(frequent.sum()), self.n_blocks * BLOCK))
        on = np.repeat(frequent, self.df)
        dense[np.repeat(self.row[frequent], self.df[frequent]), doc[on]] = impact[on]
        order = np.lexsort((lengths, dense[:, :n].argmax(axis=0) if len(dense) else lengths))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids = self.ids[order]
        dense[:, :n] = dense[:, order]
        self.dense, self.dense_short = dense, dense.astype(np.float32)
        self.dense_most = self.dense_short.reshape(len(dense), self.n_blocks, BLOCK).max(axis=2)
        #: What a sum in 32 bits may be off by, as a share of it: a rounding for every term, and a few for its factors and the two parts.
        self.off = (len(dense) + 8) * 2.0 ** -24
        self.doc, self.impact = place[doc[~on]], impact[~on]
        #: A posting in 64 bits, so that a short list costs one miss of the cache: document, and impact in 32 bits.
        self.short = self.doc << 32 | self.impact.astype(np.float32).view(np.int32)
        self.count = np.where(frequent, 0, self.df)
        self.first = np.cumsum(self.count) - self.count

    def places(self, names: pa.Array) -> np.ndarray:
        """The terms that these words are here, -1 for none."""
        return pc.index_in(names, value_set=self.vocab).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def top(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, least: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (terms, weights): places and scores of all documents that may be among its k best and score at least `least`.

        All is scored in 32 bits, blocks for all queries that want one at once, and what may reach the threshold then is
        scored again in 64. A query without a threshold gets one in waves: from its best blocks, then from eight times as
        many. All blocks are passed over whose bound is below it.
        """
        nq, width = len(queries), self.n_blocks * BLOCK
        who, terms, weights = np.repeat(np.arange(nq), [len(t) for t, _ in queries]), np.concatenate([t for t, _ in queries]), np.concatenate([w for _, w in queries])
        row, scores, dense_weight = self.row[terms], np.empty((nq, width), np.float32), np.zeros((nq, len(self.dense)))
        dense_weight[who[row >= 0], row[row >= 0]] = weights[row >= 0]
        short = dense_weight.astype(np.float32)
        t, w, ends = terms[row < 0], weights[row < 0], np.cumsum([0, *np.bincount(who[row < 0], minlength=nq)])
        size, first = self.count[t], self.first[t]

        def postings(q):
            own, start = size[ends[q]:ends[q + 1]], first[ends[q]:ends[q + 1]]
            post = np.repeat(start - (np.cumsum(own) - own), own)
            post += np.arange(len(post))
            return post, np.repeat(w[ends[q]:ends[q + 1]], own)

        for q in range(nq):
            post, weight = postings(q)
            post = self.short.take(post)
            weight *= post.view(np.float32)[::2]
            scores[q] = np.bincount(post.view(np.int32)[1::2], weight, width)
        self.scored += int(size.sum())
        self.asked += int(self.df[terms].sum())
        most, lift = scores.reshape(nq, self.n_blocks, BLOCK).max(axis=2), short @ self.dense_most
        some, lists = (most > 0) | (lift > 0), (dense_weight > 0).sum(axis=1)
        bound, start = (lift.astype(np.float64) + most) * (1 + 2 * self.off) + SLACK, max(1, -(-2 * k // BLOCK))
        rank = np.argsort(np.argsort(-bound, axis=1, kind="stable"), axis=1)
        rank[least > 0] += self.n_blocks
        best, found = np.zeros((nq, k)), [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for low, high in ((0, start), (start, 9 * start), (9 * start, 2 * self.n_blocks)):
            wave, last = some & (rank >= low) & (rank < high) & (bound >= least[:, None]), high >= self.n_blocks
            made = None if last or not wave.any() else np.zeros((nq, (high - low) * BLOCK))
            enough = np.maximum(least * (1 - 2 * self.off) - SLACK, np.finfo(np.float32).tiny).astype(np.float32)
            for b in np.flatnonzero(wave.any(axis=0)):
                q, at = np.flatnonzero(wave[:, b]), b * BLOCK
                part, docs = scores[q, at:at + BLOCK], np.arange(BLOCK)
                if len(q) <= 16:
                    may = part + lift[q, b][:, None] >= enough[q][:, None]
                    docs = np.flatnonzero(may.any(axis=0))
                    self.scored += int(lists[q] @ may.sum(axis=1))
                else:
                    self.scored += int(lists[q].sum()) * BLOCK
                part = part[:, docs] + short[q] @ self.dense_short[:, at + docs] if len(docs) < BLOCK else part + short[q] @ self.dense_short[:, at:at + BLOCK]
                i, j = np.nonzero(part >= enough[q][:, None])
                found.append((q[i], at + docs[j], part[i, j]))
                if made is not None:
                    made[q[i], (rank[q[i], b] - low) * BLOCK + docs[j]] = part[i, j]
            if made is not None:
                best = np.partition(np.concatenate([best, made], axis=1), -k, axis=1)[:, -k:]
                least = np.maximum(least, best.min(axis=1) * (1 - 2 * self.off) - SLACK)
        who, place, near = (np.concatenate(x) for x in zip(*found))
        least = np.maximum(least, _kth(who, near, nq, k) * (1 - 2 * self.off) - SLACK)
        keep = np.flatnonzero(near >= least[who] * (1 - 2 * self.off) - SLACK)
        keep = keep[np.argsort(place[keep] // BLOCK, kind="stable")]
        who, place, score = who[keep], place[keep], np.empty(len(keep))
        for at, to in _runs(place // BLOCK):
            q, i = np.unique(who[at:to], return_inverse=True)
            docs, j = np.unique(place[at:to], return_inverse=True)
            score[at:to] = (dense_weight[q] @ self.dense[:, docs])[i, j]
        order = np.argsort(who, kind="stable")
        who, place, score, out = who[order], place[order], score[order], [(np.empty(0, np.int64), np.empty(0))] * nq
        for at, to in _runs(who):
            post, weight = postings(who[at])
            rare = np.bincount(self.doc[post], weight * self.impact[post], width)
            out[who[at]] = place[at:to], np.round(score[at:to] + rare[place[at:to]], 6)
        return out


def _kth(group: np.ndarray, score: np.ndarray, groups: int, k: int) -> np.ndarray:
    """The k-th greatest score of every group, 0 where there are fewer."""
    order, size = np.lexsort((-score, group)), np.bincount(group, minlength=groups)
    at, out = np.cumsum(size) - size + k - 1, np.zeros(groups)
    out[size >= k] = score[order[at[size >= k]]]
    return out


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Where equal neighbours begin and end."""
    cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    return list(zip(cuts[:-1], cuts[1:])) if len(keys) else []


class Best:
    """The k best of one query so far: score descending, then id."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.empty(0, np.int64), np.empty(0)

    @property
    def least(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else 0.0

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.append(self.ids, ids), np.append(self.scores, scores)
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]


class Queries:
    """A block of queries as arrays: ids, and for each its words (by their number in the block) and how often it has them."""

    def __init__(self):
        self.vocab: dict[str, int] = {}
        self.ids, self.terms, self.counts, self.chars = [], [], [], 0

    def add(self, id_: int, text: str) -> None:
        if own := Counter(words(text)):
            self.ids.append(id_)
            self.terms.append(np.array([self.vocab.setdefault(w, len(self.vocab)) for w in own], np.int32))
            self.counts.append(np.array(list(own.values()), np.int32))
            self.chars += len(text)


def _block_frequencies(index: DataFrame, names: pa.Array) -> np.ndarray:
    """Document frequencies of a block's words over all shards; a task adds up its shards before it sends."""
    shared = index.sparkSession.sparkContext.broadcast(names)

    def counted(batches):
        total = np.zeros(len(shared.value), np.int64)
        for b in batches:
            for data in b.column(0).to_pylist():
                s = Shard(data)
                here = s.places(shared.value)
                total[here >= 0] += s.df[here[here >= 0]]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["t", "n"])

    rows = index.select("data").mapInArrow(counted, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(names), np.int64)
    out[rows["t"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    shared.unpersist()
    return out


def _search_block(index: DataFrame, block: Queries, rounds: list[float], n_docs: int, mean_length: float, k: int) -> list[DataFrame]:
    """(query_id, doc_id, score): each task's k best for every query of the block, without those below the k-th best of the rounds before."""
    names = pa.array(list(block.vocab), pa.large_string())
    df = _block_frequencies(index, names)
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    ids = np.array(block.ids, np.int64)
    context = index.sparkSession.sparkContext
    # bounded by QUERY_ROWS and QUERY_CHARS
    shared = context.broadcast((names, idf, ids, np.concatenate(block.terms), np.concatenate(block.counts), np.cumsum([0, *map(len, block.terms)])))

    def searched_from(floors):
        def searched(batches):
            best: dict[int, Best] = {}
            for b in batches:
                for data in b.column(0).to_pylist():
                    s = Shard(data, mean_length)
                    if not len(s.df):
                        continue
                    names, idf, ids, terms, counts, ends = shared.value
                    least, here = floors.value if floors else np.zeros(len(ids)), s.places(names)
                    for at in range(0, len(ids), PART):
                        asked, part = [], range(at, min(at + PART, len(ids)))
                        for j in part:
                            t, c = terms[ends[j]:ends[j + 1]], counts[ends[j]:ends[j + 1]]
                            own = here[t]
                            there = own >= 0
                            asked.append((own[there], c[there] * idf[t[there]]))
                        for j, (doc, score) in zip(part, s.top(asked, k, np.array([max(least[j], best[j].least if j in best else 0.0) for j in part]))):
                            if len(doc):
                                best.setdefault(j, Best(k)).add(s.ids[doc], score)
            found = sorted(best)
            for at in range(0, len(found), SENT):
                part = [best[j] for j in found[at:at + SENT]]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(shared.value[2][found[at:at + SENT]], [len(t.ids) for t in part])),
                                                  pa.array(np.concatenate([t.ids for t in part])), pa.array(np.concatenate([t.scores for t in part]))], names=["query_id", "doc_id", "score"])

        return searched

    def found_in(shards: DataFrame, floors=None) -> DataFrame:
        return materialize(shards.select("data").mapInArrow(searched_from(floors), "query_id bigint, doc_id bigint, score double"))

    found: list[DataFrame] = []
    for low, high in zip([0.0, *rounds[:-1]], rounds):
        shards = index.where((F.col("place") >= low) & (F.col("place") < high))
        found.append(found_in(shards, context.broadcast(_floors(_union(found), ids, k)) if found else None))
    shared.unpersist()
    return found


def _union(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows


def _floors(found: DataFrame, ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score found for every query, 0 for fewer."""
    ranked = found.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
    rows = ranked.where(F.col("r") == k).select("query_id", "score").orderBy("query_id").toPandas()
    known, score = rows["query_id"].to_numpy(np.int64), rows["score"].to_numpy(np.float64)
    if not len(known):
        return np.zeros(len(ids))
    at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    return np.where(known[at] == ids, score[at], 0.0)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_rows: int = QUERY_ROWS, query_chars: int = QUERY_CHARS) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best rows of docs for every row of queries (same columns)."""
    spark = docs.sparkSession
    index = materialize(build_index(docs, id_col, text_col).withColumn("place", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)) / (1 << 20)))
    n_docs, n_words, n_shards = index.agg(F.sum("n_docs"), F.sum("n_words"), F.count("*")).first()
    rounds = [max(1 / SEED_SHARE, min(1.0, SEEDS / max(n_shards, 1)))]
    while rounds[-1] < 1:
        rounds.append(min(1.0, rounds[-1] * ROUND))
    asked = materialize(documents(queries, id_col, text_col).toDF("id", "text").where("id IS NOT NULL AND text IS NOT NULL").distinct())
    found, block = [], Queries()
    for row in asked.coalesce(max(1, asked.rdd.getNumPartitions() // 64)).toLocalIterator():
        if block.ids and (len(block.ids) >= query_rows or block.chars + len(row["text"]) > query_chars):
            found += _search_block(index, block, rounds, n_docs, n_words / max(n_docs, 1) or 1.0, k)
            block = Queries()
        block.add(row["id"], row["text"])
    if block.ids:
        found += _search_block(index, block, rounds, n_docs, n_words / max(n_docs, 1) or 1.0, k)
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, doc_id bigint, score double")
    rows = _union(found)
    order = [F.desc("score"), "doc_id"]
    # tasks' lists are merged in two steps, so that no group is as long as there are tasks
    some = Window.partitionBy("query_id", "part").orderBy(*order)
    rows = rows.withColumn("part", F.spark_partition_id() % 64).withColumn("r", F.row_number().over(some)).where(F.col("r") <= k)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 100, whole, asked of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return search(docs, docs.where("doc_id % 100 = 0"))


SQL = r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM documents WHERE doc_id IS NOT NULL),
tf AS (SELECT doc_id, w, count(*) AS n FROM w GROUP BY doc_id, w),
len AS (SELECT doc_id, sum(n) AS l FROM tf GROUP BY doc_id),
s AS (SELECT (SELECT count(*) FROM documents WHERE doc_id IS NOT NULL)::DOUBLE AS n, (SELECT sum(l) FROM len)::DOUBLE / (SELECT count(*) FROM documents WHERE doc_id IS NOT NULL) AS mean),
idf AS (SELECT w, ln(1 + ((SELECT n FROM s) - count(*) + 0.5) / (count(*) + 0.5)) AS i FROM tf GROUP BY w),
sc AS (
  SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.n * i * d.n * 2.2 / (d.n + 1.2 * (0.25 + 0.75 * l / (SELECT mean FROM s)))), 6) AS score
  FROM tf q JOIN idf USING (w) JOIN tf d USING (w) JOIN len ON len.doc_id = d.doc_id WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM sc)
SELECT query_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
