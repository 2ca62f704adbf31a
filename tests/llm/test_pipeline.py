"""The pipeline, each stage recomputed by brute force from what it was given."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siftworks.llm import bpe, mixing, toxicity

from .test_near_sets import brute
from .test_operators import DATA, brute_dedup, hard_rows

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_rows(spark):
    """Nulls in any column, empty and long texts, ids that repeat."""
    rows = [(i, t, None if n % 5 == 0 else "en", s, None if t is None else len(t)) for n, (i, t, s, *_) in enumerate(hard_rows())]
    return spark.createDataFrame(rows, COLUMNS)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def check_toxicity(spark, before, after, folder):
    model = toxicity.train(spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in before], COLUMNS), spark.read.parquet(f"{folder}/labels.parquet"))
    scores = toxicity.Scorer(model).batch([r["text"] or "" for r in before])
    assert Counter(map(str, after)) == Counter(str(r) for r, s in zip(before, scores) if s < 0.5)


def check_exact(spark, before, after, folder):
    want = brute_dedup([(r["doc_id"], r["text"]) for r in before])
    assert sorted(str(r["doc_id"]) for r in after) == sorted(w[0] for w in want if w[3])
    assert not Counter(map(str, after)) - Counter(map(str, before))


def check_near(spark, before, after, folder):
    least = Counter(brute([(r["doc_id"], r["text"]) for r in before]))
    # rows without an id stay, as do rows that repeat the least id
    want = Counter({i: n for (i, c), n in least.items() if c in (i, "None") or i == "None"})
    assert Counter(str(r["doc_id"]) for r in after) == want
    assert not Counter(map(str, after)) - Counter(map(str, before))


def check_mixing(spark, before, after, folder):
    words = lambda t: len((t or "").encode().split())
    plan, made, text = Counter(), Counter(), {}
    for r in mixing.mix(spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in before], COLUMNS)).collect():
        plan[r["doc_id"]] += r["taken"]
    for r in before:
        text.setdefault(r["doc_id"], []).append(r["text"] or "")
    for r in after:
        made[r["doc_id"]] += words(r["text"])
        assert r["n_chars"] == len(r["text"]) and any(r["text"] in t for t in text[r["doc_id"]])
    assert made == +plan


def check_bpe(spark, before, after, folder):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_path())
    want = Counter()
    for r in before:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after) == want


CHECKS = {"toxicity": check_toxicity, "exact_dedup": check_exact, "simhash": check_near, "mixing": check_mixing, "bpe": check_bpe}


@pytest.mark.parametrize("odd", [False, True])
def test_every_stage(spark, tmp_path, odd):
    docs = odd_rows(spark) if odd else spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == list(CHECKS)
    for name, stage in corpus_pipeline.STAGES:
        before, out = rows_of(docs), stage(spark, docs, DATA)
        assert name == "bpe" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        CHECKS[name](spark, before, rows_of(docs), DATA)
        assert before and docs.count()


def test_run_gives_what_the_stages_give(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert Counter(map(str, docs.collect())) == Counter(map(str, corpus_pipeline.run(spark, DATA).collect()))


def test_an_empty_table_goes_through(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.count() == 0
