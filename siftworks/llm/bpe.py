"""Operator 5: BPE encoding and decoding with a compiled tokenization automaton.

Reads a public tokenizer file (vocabulary, merges, normaliser NFC + lower case, pre-split words, end-of-word suffix) and
gives what the tokenizers library gives with add_special_tokens=False. Text is cut at spaces, which no word spans; what
stands between two spaces is normalised, pre-split and run through the automaton once and then kept in a bounded cache.
Decoding without a decoder joins the labels of the arcs by spaces.

Null and empty texts have no tokens: both hashes are those of no bytes. Very long texts are walked word by word.
Repeated rows give repeated rows; a null doc_id is passed on. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_automaton import Automaton
from .common import Recent, documents

#: White space of the pattern's engine: Unicode White_Space, without the separators \x1c-\x1f.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
#: Letters up to here are the same in every Unicode version; beyond, the library's own pre-split is asked.
LATIN = "ɏ"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], more = chr(more), more + 1
    return out


class WordCodec:
    """encode(text) gives (ids as little-endian uint32 bytes, labels joined by spaces)."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.library = Tokenizer.from_file(path)  # its normaliser and pre-split, for text beyond Latin letters
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
        self.beyond = re.compile(f"[^\0-{LATIN}]")
        self.symbols = byte_symbols()
        self.of_word = Recent(self._word, 60_000)
        self.of_piece = Recent(self._piece, 100_000)

    def _word(self, word: str) -> tuple[bytes, str]:
        return self._spelt(word if word.isascii() and word.isalnum() else "".join([self.symbols[b] for b in word.encode()]))

    def _spelt(self, symbols: str) -> tuple[bytes, str]:
        ids = self.automaton.encode(symbols)
        return array("I", ids).tobytes(), " ".join(self.automaton.decode(ids))

    def _piece(self, piece: str) -> tuple[bytes, str]:
        """A lower-case piece between two spaces, of Latin letters at most."""
        words = self.words.findall(piece)
        if len(words) == 1:
            return self.of_word[words[0]]
        made = [self.of_word[w] for w in words]
        return b"".join([m[0] for m in made]), " ".join([m[1] for m in made])

    def encode(self, text: str) -> tuple[bytes, str]:
        if "<|" in text and self.cut_special.search(text):
            made = []
            for part in self.cut_special.split(text):
                if part in self.special:
                    made.append((np.array([self.special[part]], "<u4").tobytes(), part))
                elif part:
                    made.append(self._plain(part))
            return b"".join([m[0] for m in made]), " ".join([m[1] for m in made if m[0]])
        return self._plain(text)

    def _plain(self, text: str) -> tuple[bytes, str]:
        if text.isascii() or not self.beyond.search(text):
            of = self.of_piece
            made = [of[p] for p in text.lower().split(" ")]  # such letters are composed already
        else:
            words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            made = [self._spelt(w) for w, _ in words]
        return b"".join([m[0] for m in made]), " ".join([m[1] for m in made if m[1]])


@lru_cache(maxsize=8)
def check_proper(path: str) -> None:
    """Refuse merge lists for which the automaton isn't what merging gives; once a path, on the driver."""
    if bad := codec(path).automaton.improper():
        raise ValueError(f"{len(bad)} tokens of {path} are not what their own spelling encodes to, such as {bad[:3]}")


@lru_cache(maxsize=2)
def codec(path: str) -> WordCodec:
    return WordCodec(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids binary little-endian uint32, decoded string), one row per row of docs; no shuffle."""
    check_proper(path)

    def coded(batches):
        c = codec(path)
        for b in batches:
            made = [c.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.string())], names=["id", "ids", "decoded"])

    rows = documents(docs, id_col, text_col).mapInArrow(coded, f"id {dict(docs.dtypes)[id_col]}, ids binary, decoded string")
    return rows.withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256), hashed where the ids are made so that they need not leave the worker."""
    check_proper(path)

    def coded(batches):
        c = codec(path)
        for b in batches:
            n, ids, texts = [], [], []
            for t in b.column(1).to_pylist():
                x, d = c.encode(t or "")
                n.append(len(x) // 4)
                ids.append(hashlib.sha256(x).hexdigest())
                texts.append(hashlib.sha256(d.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = documents(docs, id_col, text_col).mapInArrow(coded, f"id {dict(docs.dtypes)[id_col]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return rows.select(F.col("id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())


SQL = None
