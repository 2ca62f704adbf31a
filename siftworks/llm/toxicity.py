"""Operator 7: toxicity by noisy-channel deobfuscation.

A character model (trigrams over the whole corpus) and a channel (digits and signs for letters, letters apart, letters
repeated) make a lattice of every suspicious stretch, however long; Viterbi decoding gives the likeliest plain words. A
stretch without such characters has one path and is its own decoding. Doubled letters and words joined by marks are
common in plain text: they are decoded where their letters, each run of one letter taken as one, begin like a word with
evidence, as no other reading of them could count. The restored words and their first four to six letters are then
scored: evidence is the lower bound of a feature's log odds among labelled rows, a document's score a logistic function
of its strongest words, fitted with each row left out of its own counts.

What is fitted comes from a bounded sample of labelled rows (`sample` rows, the least crc32 of the id first), all their
features that three toxic rows have; the character model counts all rows. Labels, language, source and id are never
inputs of a score.

Null and empty texts have no words and get the score of a text without evidence. Repeated rows get equal rows. Rows with
a null doc_id are never learnt from and count as held out. Labels with nulls are left aside, of labels that repeat the
highest counts. With no labelled row of either kind every score is 0. Empty table: no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, materialize, small_batches, text_bytes

SAMPLE = 20_000
FOLDS = 5
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou"}
SEPARATORS = set(" .-_~/'\"^=:,\t\n")
SYMBOLS = 28
OTHER = 27
_LETTERS = re.compile(r"[^\W\d_]+")
_SPLIT = re.compile(r"\s+")
_INNER = re.compile(r"[^\W\d_][0-9@$!|+(€*]+(?:[^\W_]|$)|[0-9@$!|+(€*][^\W\d_]|([^\W\d_])\1\1")
_DOTTED = re.compile(r"(?:[^\W_]{1,2}[.\-_~/'\"^=:,]){2,}[^\W_]{1,2}(?![^\W_])")
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_RUN = re.compile(r"([^\W\d_])\1+")
_HIDING = re.compile(r"([^\W\d_])\1|[^\W\d_][^\w\s]+[^\W\d_]")


def _symbol_table() -> np.ndarray:
    out = np.full(256, SYMBOLS, np.uint8)  # beyond the model: digits and signs
    for b in range(26):
        out[97 + b] = out[65 + b] = b + 1
    out[128:] = OTHER
    for b in b" \t\n\x0b\x0c\r.,;:!?()\"'-":
        out[b] = 0
    return out


def symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else OTHER


@dataclass
class CharModel:
    """log P(c | a, b), interpolated with log P(c | b)."""

    counts: np.ndarray
    logp: np.ndarray = field(init=False)

    def __post_init__(self):
        n = self.counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        two = n.sum(axis=0) + 0.1
        one = two / two.sum(axis=1, keepdims=True)
        self.logp = np.log((n + 5 * one[None]) / (n.sum(axis=2, keepdims=True) + 5))

    def decode(self, text: str) -> str:
        """The likeliest plain reading of a stretch of noisy text."""
        logp, text = self.logp, text.lower()
        # of each state the best score and its reading, as (reading before, character)
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i, c in enumerate(text):
            options = self.options(text, i, c)
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, out) in best.items():
                for s, ch, cost in options:
                    if s is None or (s == 0 and b == 0):
                        state, value = (a, b), score + cost
                        ch = "" if s is None else ch
                    else:
                        state, value = (b, s), score + cost + logp[a, b, s]
                    if state not in after or value > after[state][0]:
                        after[state] = (value, (out, ch) if ch else out)
            best = after
        out, made = max(((v + (logp[a, b, 0] if b else 0.0), out) for (a, b), (v, out) in best.items()), key=lambda x: x[0])[1], []
        while out:
            out, ch = out
            made.append(ch)
        return "".join(reversed(made)).strip()

    @staticmethod
    def options(text: str, i: int, c: str) -> list[tuple[int | None, str, float]]:
        """(symbol or None, character, cost): what the i-th character c may stand for; None stands for nothing."""
        options: list[tuple[int | None, str, float]] = []
        if c.isalpha():
            options.append((symbol(c), c, 0.0))
            if i and text[i - 1] == c:
                long = (i > 1 and text[i - 2] == c) or text[i + 1:i + 2] == c
                options[0] = (symbol(c), c, -1.5 if long else 0.0)
                options.append((None, "", -0.2 if long else -4.0))
        elif c in LEET:
            options += [(symbol(x), x, -1.0 if len(LEET[c]) < 3 else -2.0) for x in LEET[c]]
            options.append((0, " ", -9.0))
        elif c in SEPARATORS:
            options += [(None, "", -0.3), (0, " ", -1.0)]
        else:
            options.append((0, " ", 0.0))
        return options


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Trigram counts of all texts: a task sends a row for each trigram it has seen."""

    def counted(batches):
        table, total = _symbol_table(), np.zeros(29 ** 3, np.int64)
        for b in batches:
            texts = text_bytes(b.column(0))
            for at in range(0, len(texts), 512):
                s = table[np.frombuffer(b"  ".join([b"", *texts[at:at + 512], b""]), np.uint8)].astype(np.int32)
                total += np.bincount((s[:-2] * 29 + s[1:-1]) * 29 + s[2:], minlength=29 ** 3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["at", "n"])

    rows = documents(docs, text_col).mapInArrow(counted, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    cube = np.zeros(29 ** 3, np.int64)
    cube[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return CharModel(cube.reshape(29, 29, 29)[:SYMBOLS, :SYMBOLS, :SYMBOLS].copy())


class Reader:
    """Words of a text after deobfuscation; what a stretch between spaces reads as is worked out once while it is remembered."""

    def __init__(self, model: CharModel, evidence: frozenset[str] = frozenset()):
        """evidence: starts of words that count, each run of one letter taken as one."""
        self.model, self.evidence, self.sizes = model, evidence, sorted({len(e) for e in evidence})

    def words(self, piece: str) -> list[str]:
        """Restored words of a stretch, next to the words as they stand."""
        out = []
        for token in _SPLIT.split(piece):
            plain = _LETTERS.findall(token.lower())
            out += plain
            if _INNER.search(token) or _DOTTED.search(token) or self.hides(token, plain):
                out += _LETTERS.findall(self.model.decode(token.strip(".,;:?\"'()%&*#")))
        return out

    def hides(self, token: str, plain: list[str]) -> bool:
        """Whether doubled letters or marks between letters may hide a word that counts."""
        if not self.evidence or not _HIDING.search(token):
            return False
        most = self.sizes[-1]
        for i in range(len(plain)):
            letters = ""
            for p in plain[i:]:  # from each part on, as many as a start may take
                letters = _RUN.sub(r"\1", letters + p)
                if len(letters) >= most:
                    break
            if any(letters[:n] in self.evidence for n in self.sizes if n <= len(letters)):
                return True
        return False

    def spaced(self, text: str) -> list[str]:
        """Words spelt with white space after every letter."""
        return [w for m in _SPACED.finditer(text) for w in _LETTERS.findall(self.model.decode(_SPLIT.sub(" ", m.group())))]

    def all(self, text: str) -> set[str]:
        words = set(self.spaced(text))
        for piece in set(text.split(" ")):
            words.update(self.words(piece))
        return words


def features(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n]] if len(word) > 2 else []


def weight(pos: float, neg: float, n_pos: int, n_neg: int) -> float:
    """A lower bound of the log odds that a feature's presence gives."""
    low = pos + 0.5 - 1.64 * np.sqrt(pos + 0.25)
    return float(np.log(max(low, 1e-3) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1)))


@dataclass
class Model:
    chars: CharModel
    counts: dict[str, tuple[int, int]]
    n_pos: int
    n_neg: int
    least: float = 1.0
    coefficients: tuple[float, ...] = (-30.0, 0.0, 0.0, 0.0)

    def reader(self) -> Reader:
        """A reader that knows which words count."""
        known = (_RUN.sub(r"\1", f.rstrip("*")) for f, (pos, neg) in self.counts.items() if weight(pos, neg, self.n_pos, self.n_neg) >= self.least)
        return Reader(self.chars, frozenset(known))

    def word_weight(self, word: str, own: int | None = None) -> float:
        """own: the label of the row the word stands in, if that row is to be left out of the counts."""
        best = 0.0
        for f in features(word):
            if c := self.counts.get(f):
                pos, neg = c[0] - (own == 1), c[1] - (own == 0)
                best = max(best, weight(pos, neg, self.n_pos - (own == 1), self.n_neg - (own == 0)))
        return best if best >= self.least else 0.0

    def inputs(self, weights: list[float]) -> tuple[float, float, float]:
        """The strongest word's weight, and how far the two strongest are beyond what chance gives a long text."""
        a, b = (sorted(weights, reverse=True)[:2] + [0.0, 0.0])[:2]
        return a, min(1.0, max(0.0, (a - 3) / 2)), min(1.0, max(0.0, (b - 3) / 2))

    def score(self, weights: list[float]) -> float:
        z = float(np.dot(self.coefficients, (1.0, *self.inputs(weights))))
        return float(1 / (1 + np.exp(-z))) if z > -700 else 0.0


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; 0 is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled rows outside fold 0."""
    chars = char_model(docs, text_col)
    known = documents(labels, id_col, label_col).toDF("id", "y").dropna().groupBy("id").agg(F.max("y").alias("y")).where(fold(F.col("id")) != 0)
    chosen = known.orderBy(F.crc32(F.col("id").cast("string").cast("binary")), "id").limit(sample)
    rows = documents(docs, id_col, text_col).toDF("id", "text").join(F.broadcast(chosen), "id")  # at most `sample` rows of two numbers
    rows = materialize(rows.select((F.col("y") > 0).cast("int").alias("y"), F.coalesce("text", F.lit("")).alias("text")).distinct())
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return Model(chars, {}, n_pos, n_neg, coefficients=(-1000.0, 0.0, 0.0, 0.0))

    def count(part: DataFrame, only: dict | None):
        def counted(batches):
            reader, seen = Reader(chars), {}
            for b in batches:
                for t in b.column(0).to_pylist():
                    for f in {f for w in reader.all(t) for f in features(w)}:
                        if only is None or f in only:
                            seen[f] = seen.get(f, 0) + 1
            names = list(seen)
            for at in range(0, len(names), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(names[at:at + 50_000], pa.string()), pa.array([seen[f] for f in names[at:at + 50_000]], pa.int64())], names=["f", "n"])

        return part.select("text").mapInArrow(counted, "f string, n bigint").groupBy("f").agg(F.sum("n").alias("n"))

    # features of toxic rows first: what only clean rows have is no evidence
    pos = {r["f"]: r["n"] for r in count(rows.where("y = 1"), None).where("n >= 3").collect()}
    neg = {r["f"]: r["n"] for r in count(rows.where("y = 0"), pos).collect()}
    model = Model(chars, {f: (p, neg.get(f, 0)) for f, p in pos.items() if weight(p, neg.get(f, 0), n_pos, n_neg) > 0.5}, n_pos, n_neg)

    def left_out(batches):
        reader = model.reader()
        for b in batches:
            ys = b.column(0).to_pylist()
            x = [model.inputs([v for w in reader.all(t) if (v := model.word_weight(w, y))]) for y, t in zip(ys, b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in x], pa.float64()) for i in range(3)]], names=["y", "a", "b", "c"])

    seen = rows.select("y", "text").mapInArrow(left_out, "y int, a double, b double, c double").toPandas()  # at most `sample` rows
    seen = seen.sort_values(["y", "a", "b", "c"])  # the sums of the fit don't depend on which task came first
    model.coefficients = tuple(float(v) for v in _logistic(seen[["a", "b", "c"]].to_numpy(), seen["y"].to_numpy(np.float64)))
    return model


class Scorer:
    """Scores texts. Of the stretches it has met it remembers, up to a bound, which have words with evidence."""

    def __init__(self, model: Model, most: int = 250_000):
        self.model, self.reader, self.most = model, model.reader(), most
        self.seen: set[str] = set()
        self.found: dict[str, list[tuple[str, float]]] = {}

    def batch(self, texts: list[str]) -> list[float]:
        if len(self.seen) > self.most:
            self.seen.clear()
            self.found.clear()
        parts = [set(t.split(" ")) for t in texts]
        for new in parts:
            new = new - self.seen
            for piece in new:
                if hits := [(w, v) for w in self.reader.words(piece) if (v := self.model.word_weight(w))]:
                    self.found[piece] = hits
            self.seen |= new
        keys = self.found.keys()
        out = []
        for t, own in zip(texts, parts):
            words = {w: v for piece in own & keys for w, v in self.found[piece]}
            if _SPACED.search(t):
                words |= {w: v for w in self.reader.spaced(t) if (v := self.model.word_weight(w))}
            out.append(self.model.score(list(words.values())))
        return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score), one row per row of docs; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # starts of words of at most `sample` rows, and two numbers each

    def scored(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            made = [s for at in range(0, len(texts), 512) for s in scorer.batch(texts[at:at + 512])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.float64())], names=["id", "score"])

    return documents(docs, id_col, text_col).mapInArrow(scored, f"id {dict(docs.dtypes)[id_col]}, score double").withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id_col, held_out, score, predicted), one row per row of docs."""
    scores = score(docs, train(docs, labels, id_col, text_col, **options), id_col, text_col)
    return scores.select(id_col, (fold(F.col(id_col)) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows whose score is 0.5 or more, filtered where they are read."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, **options))
    at = docs.columns.index(text_col)

    def kept(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            made = [s < 0.5 for i in range(0, len(texts), 512) for s in scorer.batch(texts[i:i + 512])]
            yield b.filter(pa.array(made, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = None
