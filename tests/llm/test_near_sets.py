"""The pipeline's near-duplicate stage against brute force over all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from siftworks.llm import common, near_sets, simhash

from .test_operators import empty, hard, hard_rows  # noqa: F401


def brute(rows):
    def runs(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [runs(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), k) if x is not None), default=None)
    return sorted((str(k), str(least[find(i)])) for i, (k, _) in enumerate(rows))


def edited_rows():
    """Families of texts with 0 to 12 words changed (similarity on either side of 0.8), chains, a shared passage and short texts."""
    rng = random.Random(5)
    make = lambda n: [rng.choice("abcdefghijklmnop") * rng.randrange(1, 9) for _ in range(n)]
    passage, rows = make(30), []
    for _ in range(12):
        base = make(rng.randrange(20, 160)) + passage
        for _ in range(rng.randrange(2, 9)):
            other = list(base)
            for _ in range(rng.randrange(0, 13)):
                other[rng.randrange(len(other))] = rng.choice(["new", "other"])
            rows.append(" ".join(other))
            if rng.random() < 0.4:
                base = other
    rows += [" ".join(make(k)) for k in (1, 2, 4, 5, 5, 6, 9)] * 2
    rng.shuffle(rows)
    return list(enumerate(rows))


def got(df):
    return sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(df, width=5, similarity=0.8).collect())


@pytest.mark.parametrize("settings", [{}, {"BLOCK": 4, "FEW": 0, "SAMPLE": 20}, {"PART": 3, "SMALL": 2}, {"RADIUS": 1, "SMALL": 3}, {"RADIUS": 1, "SMALL": 100}])
def test_near_sets(spark, monkeypatch, settings):
    """Also with small blocks, with joins in place of broadcasts, with buckets in many parts and with fingerprints that propose next to nothing."""
    for k, v in settings.items():
        monkeypatch.setattr(near_sets, k, v)
    monkeypatch.setattr(common, "HOT_ROWS", 5 if "PART" in settings else 1 << 13)
    rows = edited_rows()
    want = brute(rows)
    assert 10 < sum(a != b for a, b in want) < len(rows) - 10
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == want


def test_sketches_never_refuse_similar_sets():
    rng = np.random.default_rng(3)
    refused = 0
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.5, 1)], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)]))
        may = near_sets.may_be_similar(near_sets.sketch(a), near_sets.sketch(b))
        assert may or not near_sets.similar(a.tobytes(), b.tobytes())
        refused += not may
    assert refused > 50


def test_near_sets_hard_rows(hard, empty):  # noqa: F811
    assert got(hard) == brute([(r[0], r[1]) for r in hard_rows()])
    assert simhash.near_duplicates(empty, width=5, similarity=0.8).count() == 0


def test_pipeline_drops_copies_at_four_fifths(spark):
    base = [f"word{i}" for i in range(120)]
    near, far = list(base), list(base)
    for i in (20, 60):
        near[i] = "changed"  # 10 of 116 runs: 106 / 126
    for i in (20, 60, 100):
        far[i] = "altered"  # 101 / 131
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near(spark, docs, "").collect()} == {1, 3}
