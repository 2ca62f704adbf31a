"""Each operator against brute force on small rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftworks.llm import bit_slices, bpe, common, exact_dedup, mixing, search, sharding, simhash, suffix_dedup, token_files, toxicity, url_filter
from siftworks.llm.bpe_automaton import Automaton
from siftworks.llm.perfect_hash import PerfectHash

from ..compare import assert_same

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, id string, key string, `__id` string"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "Tide", "table", "moon,", "sea.", "harbour", "x" * 30, "é", "ß"]) for _ in range(n))


def hard_rows():
    rng = random.Random(3)
    base = words(rng, 200)
    long = words(rng, 9000)
    rows = [(1, base), (2, base), (3, base.replace(" ", "\n")), (4, base + " one more"), (5, None), (6, ""), (7, " \t\n"), (8, long), (9, long + " end"), (10, base.upper()), (10, base.upper()), (11, "a"), (None, base), (None, None),
            (12, "z" * 300), (13, "z" * 250), (14, "one two"), (15, "<|endoftext|> <|startoftext|>x  y \n z")]
    return [(i, t, None if i == 4 else f"s{(i or 0) % 3}", "clash", "clash", "clash") for i, t in rows]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -------------------------------------------------------------- 1


def brute_fingerprint(text):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, radius=3):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {r: min((x for x in m if x is not None), default=None) for r, m in groups.items()}
    return [least[find(i)] for i in range(len(fps))]


def test_simhash(spark, hard, empty):
    rows = [(r[0], r[1]) for r in hard_rows()]
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted((str(i), f"{f:016x}", str(c)) for (i, _), f, c in zip(rows, fps, brute_components(fps, [i for i, _ in rows])))
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash.near_duplicates(hard).collect())
    assert got == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [4096, 16])
def test_links_find_every_close_pair_in_hot_buckets(spark, block):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(s,) for s in signed], "fp long")
    reached = {r["child"]: r["parent"] for r in simhash.components(simhash.links(distinct, 3, block)).collect()}
    got = [reached.get(s, s) for s in signed]
    want = brute_components(fps, signed)
    pairs = lambda labels: {tuple(sorted(s for s, x in zip(signed, labels) if x == l)) for l in set(labels)}
    assert pairs(got) == pairs(want)


def test_partners_are_near_and_central():
    """A centre is the partner of all that were made from it, whatever its place; rows of other buckets are never partners."""
    rng = np.random.default_rng(7)
    fps, bucket, centre = [], [], {}
    for b in range(6):
        c = int(rng.integers(0, 1 << 63))
        own = [c]
        for _ in range(int(rng.integers(1, 150))):
            x = c
            for bit in rng.choice(64, 6, replace=False):
                x ^= 1 << int(bit)
            own.append(x)
        at = int(rng.integers(len(own)))
        own[0], own[at] = own[at], own[0]
        centre[b] = len(fps) + at
        fps += own
        bucket += [b] * len(own)
    rows, partner = bit_slices.partners(np.array(fps, np.uint64), np.array(bucket), 7)
    assert len(rows) == len(set(rows.tolist())) and set(rows.tolist()) >= set(range(len(fps))) - set(centre.values()) - {i for i in range(len(fps)) if bucket.count(bucket[i]) == 2}
    for r, p in zip(rows.tolist(), partner.tolist()):
        assert bucket[r] == bucket[p] and (fps[r] ^ fps[p]).bit_count() <= 7
        assert p == centre[bucket[r]] or bucket.count(bucket[r]) == 2
    none = np.empty(0, np.uint64)
    assert len(bit_slices.partners(none, none.astype(np.int64), 7)[0]) == len(bit_slices.forest(none, none.astype(np.int64), 7)[0]) == 0


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_rows_without_ids_and_hot_joins(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_IDS", few)
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = spark.createDataFrame([(i % 7 if i % 7 else None, i) for i in range(140)] + [(i, i) for i in range(200, 210)], "k long, i long")
    gone = spark.createDataFrame([(1,), (None,), (205,), (1,)], "x long")
    assert {r["k"] for r in common.without(rows, rows["k"], gone).collect()} == {2, 3, 4, 5, 6, *range(200, 210)} - {205}
    table = rows.where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("m"), F.max("i").alias("top"))
    got = sorted((r["k"], r["i"], r["top"]) for r in common.join_hot(rows, table, ["k"], "m").collect())
    top = {r["k"]: r["top"] for r in table.collect()}
    assert got == sorted((r["k"], r["i"], top[r["k"]]) for r in rows.collect() if r["k"] is not None)


# -------------------------------------------------------------- 2


def test_url_filter_sql(spark):
    assert_same(spark, url_filter.query, url_filter.SQL, DATA)


def test_url_filter_cases(spark):
    urls = [None, "", "no scheme", "https://A.net/x?q", "http://example.net/en/", "http://example.net/e", "x://sub.example.net/en/a#f", "http://notexample.com/de/", "http://w.example.com/de/x", "http://net", "http://a.org/fr/b", "http://a.org/frx"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df).collect()}
    rule = [None, None, None, "net/", "example.net/en/", "net/", "example.net/en/", None, "example.com/de/", None, "org/fr/", None]
    assert [got[i][2] for i in range(len(urls))] == rule
    assert [got[i][3] for i in range(len(urls))] == ["block" if r in ("net/", "example.com/de/") else "allow" for r in rule]
    assert got[3][:2] == ("a.net", "/x") and got[0][:2] == ("", "")
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("pmod(xxhash64(key), 50) = 0")
    c = url_filter.build_cascade(universe, listed, 20_000)
    assert len(c.levels) > 2
    wrong = universe.where(c.member(F.col("key")) != F.expr("pmod(xxhash64(key), 50) = 0"))
    assert wrong.count() == 0


def test_long_lists_stay_a_cascade(spark):
    """Thousands of rules, judged as by looking each key up; no join in the plan that judges."""
    rng = random.Random(6)
    names = [f"h{i}.{rng.choice(['net', 'org'])}" for i in range(3000)]
    rules = sorted({(rng.choice(["block", "allow"]), f"{n}/{rng.choice(['', 'en/', 'de/'])}") for n in names})
    rules = list({r: (v, r) for v, r in rules}.values())  # one verdict a rule
    urls = [f"https://{rng.choice(['', 'w.'])}{rng.choice(names + ['no.example'])}/{rng.choice(['en/x', 'de/', 'fr/', ''])}" for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = {r: v for v, r in rules}

    def brute(url):
        host, _, path = url[8:].partition("/")
        keys = [f"{h}/{p}" for h in (host, host.split(".", 1)[1]) for p in ("", "en/", "de/") if f"/{path}".startswith(f"/{p}")]
        best = max((k for k in keys if k in table), key=len, default=None)
        return best, table.get(best, "allow")

    judged = url_filter.judge_urls(df, rules)
    assert "Join" not in judged._jdf.queryExecution().optimizedPlan().toString()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judged.collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)} and len({v for v in got.values()}) > 300


# -------------------------------------------------------------- 3


def test_exact_dedup_sql(spark):
    assert_same(spark, exact_dedup.query, exact_dedup.SQL, DATA)


def brute_dedup(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").encode().translate(None, b" \t\n\x0b\x0c\r"), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for k, m in groups.items():
        m.sort()
        out += [(str(x[3]), str(m[0][3]), len(m), n == 0, hashlib.sha256(k).hexdigest()) for n, x in enumerate(m)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"prime": 13, "points": (3, 5)}, {"filter_bits": 32}])
def test_exact_dedup(spark, hard, empty, options):
    """A tiny modulus makes unequal texts share fingerprints; comparison must part them."""
    df = exact_dedup.exact_dedup(hard, **options)
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect())
    assert got == brute_dedup([(r[0], r[1]) for r in hard_rows()])
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_fingerprints_combine(spark):
    data = bytes(random.Random(1).randrange(256) for _ in range(20_000))
    whole = 0
    for b in data:
        whole = (whole * exact_dedup.POINTS[0] + b + 1) % exact_dedup.PRIME
    fp = exact_dedup.fingerprint(data)
    assert fp[0] == whole
    assert exact_dedup.combine(exact_dedup.fingerprint(data[:7777]), exact_dedup.fingerprint(data[7777:]), len(data) - 7777) == fp
    pieces = spark.createDataFrame([(1, 0, "ab c"), (1, 1, None), (1, 2, " d")], "k int, n int, t string")
    assert exact_dedup.fingerprint_pieces(pieces, "k", "n", "t").first()["fingerprint"] == exact_dedup.packed(exact_dedup.fingerprint(b"abcd"))


def test_drop_duplicates_keeps_columns(spark, hard):
    kept = exact_dedup.drop_duplicates(hard)
    assert kept.columns == hard.columns
    want = brute_dedup([(r[0], r[1]) for r in hard_rows()])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(r[0] for r in want if r[3])


def test_drop_duplicates_with_ids_that_repeat(spark):
    """Rows of one id with several texts, one longer by white space, and wholly repeated rows; ids both broadcast and joined."""
    rows = [(1, "a b", "x"), (1, "a  b", "y"), (1, "c", "x"), (2, "ab", "x"), (2, "d", "x"), (3, "d", "x"), (4, "e", "x"), (4, "e", "x"), (None, "f", "x"), (None, "g", "x"), (5, "g ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, own_sha string")
    assert sorted(map(tuple, exact_dedup.drop_duplicates(df).collect()), key=str) == sorted([(1, "a  b", "y"), (1, "c", "x"), (2, "d", "x"), (4, "e", "x"), (None, "f", "x"), (5, "g ", "x")], key=str)


def test_a_hot_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    rows = [(i, "copy of one text" if i % 3 == 0 else f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(df).collect()}
    assert got == {i: (0, 100) if i % 3 == 0 else (i, 1) for i, _ in rows}
    assert {r["component_id"] for r in simhash.near_duplicates(df).where("doc_id % 3 = 0").collect()} == {0}
    assert exact_dedup.drop_duplicates(df).count() == 201


# -------------------------------------------------------------- 4


def test_sharding(spark, hard, tmp_path):
    assert_same(spark, sharding.query, sharding.SQL, DATA)
    store = sharding.ShardStore(spark, str(tmp_path / "s"), target_bytes=1 << 20, least_runs=3)
    for _ in range(4):
        store.append(hard, rows_per_shard=5)
    before, old = store.manifest(), sorted(map(str, store.read().collect()))
    m = store.compact()
    assert len(m.shards) < len(before.shards) and sum(s.rows for s in m.shards) == 4 * hard.count()
    assert sorted(map(str, store.read().collect())) == old == sorted(map(str, store.read(before.version).collect()))
    store.vacuum()
    assert sorted(map(str, store.read().collect())) == old
    with pytest.raises(sharding.Conflict):
        store._commit(before, [], set(), m.schema)
    none = sharding.ShardStore(spark, str(tmp_path / "e"))
    none.append(hard.limit(0))
    assert none.compact() and none.read().count() == 0 and none.read().columns == hard.columns


def _files(store):
    return {f"data/{f.getPath().getName()}/{s.getPath().getName()}" for f in store._names("data") for s in store._names(f"data/{f.getPath().getName()}") if s.getPath().getName().startswith("part-")}


def test_vacuum_leaves_what_a_writer_is_about_to_commit(spark, hard, tmp_path):
    store = sharding.ShardStore(spark, str(tmp_path / "s"), target_bytes=1 << 20, least_runs=2)
    store.append(hard, rows_per_shard=5)
    written = store._write(hard, 5)  # by another writer, which hasn't committed yet
    store.compact()
    store.vacuum()
    store._added(written, hard.schema.json())
    assert store.read().count() == 2 * hard.count()
    # without a grace only what is live stays
    store.compact()
    store.vacuum(grace_seconds=-60)
    assert _files(store) == {s.path for s in store.manifest().shards}
    assert store.read().count() == 2 * hard.count()


def test_an_append_between_planning_and_commit_is_kept(spark, hard, tmp_path, monkeypatch):
    store = sharding.ShardStore(spark, str(tmp_path / "s"), target_bytes=1 << 20, least_runs=2)
    for _ in range(2):
        store.append(hard, rows_per_shard=5)
    merged, raced = store._merged, []

    def slow(runs, schema):
        out = merged(runs, schema)
        if not raced:
            raced.append(sharding.ShardStore(spark, store.root, 1 << 20, least_runs=2).append(hard, rows_per_shard=100))
        return out

    monkeypatch.setattr(store, "_merged", slow)
    store.compact()
    assert raced and store.read().count() == 3 * hard.count()

    # of two compactions of the same shards one is void
    def late(runs, schema):
        out = merged(runs, schema)
        sharding.ShardStore(spark, store.root, 1 << 20, least_runs=2).compact()
        return out

    for _ in range(3):
        store.append(hard, rows_per_shard=5)
    monkeypatch.setattr(store, "_merged", late)
    store.compact()
    assert store.read().count() == 6 * hard.count()


def test_each_planned_run_becomes_one_shard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "RUNS_A_JOB", 2)
    store = sharding.ShardStore(spark, str(tmp_path / "s"), target_bytes=40_000, least_runs=3)
    rows = spark.range(6000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    store.append(rows.repartition(8), rows_per_shard=150)
    before = store.manifest()
    runs = store.plan(before.shards)
    made = store._merged(runs, rows.schema)
    assert len(runs) > 3 and sorted(s.rows for s in made) == sorted(sum(s.rows for s in r) for r in runs)
    assert all(len({store.tier(s) for s in r}) == 1 for r in runs)
    after = store.compact()
    assert store.read().distinct().count() == 6000 and max(s.size for s in after.shards) < 2 * 40_000


def test_versions_are_read_from_snapshots_and_changes(spark, hard, tmp_path):
    store = sharding.ShardStore(spark, str(tmp_path / "s"), snapshot=3)
    part = hard.limit(2)
    for n in range(1, 8):
        assert store.append(part).version == n
    assert [store.read(v).count() for v in (1, 3, 5, 7)] == [2, 6, 10, 14]
    store.vacuum(grace_seconds=-60)
    assert store._log() == ([7], [6]) and store.read().count() == 14


# -------------------------------------------------------------- 5


def test_bpe_matches_the_library(spark, hard):
    from tokenizers import Tokenizer

    path = bpe.tokenizer_path()
    library = Tokenizer.from_file(path)
    texts = [r[1] for r in hard_rows()] + [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()] + ["I'LL don't 3.14", "漢字かな Ω ΣΑΣ İst ǅ ﬁ", "aaaaaaa", "x\x1cy z", "<|endoftext|"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.encode_documents(df, path).collect()}
    for i, t in enumerate(texts):
        e = library.encode(t or "", add_special_tokens=False)
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == e.ids
        assert got[i]["decoded"] == library.decode(e.ids, skip_special_tokens=False)
    assert bpe.digests(hard, path).count() == hard.count()


def test_automaton_is_deterministic_and_equals_the_merges():
    """All words over two letters up to a length, for merges that overlap themselves."""
    merges = [("a", "a"), ("a", "b"), ("aa", "a"), ("b", "ab"), ("aa", "b"), ("aa", "aa")]
    vocab = {t: i for i, t in enumerate(["a", "b", *[x + y for x, y in merges]])}
    auto = Automaton(vocab, merges)

    def by_merging(w):
        out = list(w)
        for x, y in merges:
            i = 0
            while i < len(out) - 1:
                if (out[i], out[i + 1]) == (x, y):
                    out[i:i + 2] = [x + y]
                i += 1
        return out

    for n in range(1, 10):
        for k in range(1 << n):
            w = "".join("ab"[k >> i & 1] for i in range(n))
            assert auto.decode(auto.encode(w)) == by_merging(w), w


def test_improper_merges_are_named_and_proper_ones_are_exact():
    """Random merge lists: words of proper ones encode as merging gives, others are refused."""
    rng, proper, refused = random.Random(12), 0, 0
    while proper < 40 or refused < 10:
        merges, known = [], ["a", "b", "c"]
        for _ in range(rng.randrange(2, 9)):
            x, y = rng.choice(known), rng.choice(known)
            if x + y not in known:
                merges.append((x, y))
                known.append(x + y)
        auto = Automaton({t: i for i, t in enumerate(known)}, merges)

        def by_merging(w):
            out = list(w)
            for x, y in merges:
                i = 0
                while i < len(out) - 1:
                    if (out[i], out[i + 1]) == (x, y):
                        out[i:i + 2] = [x + y]
                    i += 1
            return out

        bad = auto.improper()
        assert bad == [x + y for x, y in merges if by_merging(x + y) != [x + y]]
        if bad:
            refused += 1
            continue
        proper += 1
        for _ in range(150):
            w = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
            assert auto.decode(auto.encode(w)) == by_merging(w), (merges, w)


# -------------------------------------------------------------- 6


def test_search(spark, hard, empty):
    assert_same(spark, search.query, search.SQL, DATA)
    queries = hard.where("doc_id in (1, 5, 6, 8)")
    got = search.search(hard, queries, k=3, query_rows=1).collect()
    assert {r["query_id"] for r in got} == {1, 8} and max(r["rank"] for r in got) == 3
    one = search.search(hard, queries, k=3).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, got))
    assert search.search(empty, empty).count() == 0 and search.search(hard, empty).count() == 0


def brute_search(rows, queries, k):
    """BM25 of every row for every query."""
    from collections import Counter
    from math import log

    docs = [(i, Counter(search.words(t))) for i, t in rows if i is not None]
    n, mean = len(docs), sum(sum(c.values()) for _, c in docs) / len(docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for q, t in queries:
        asked, scored = Counter(search.words(t)), []
        for i, c in docs:
            l = sum(c.values())
            s = sum(m * log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * l / mean)) for w, m in asked.items() if c[w])
            if s:
                scored.append((-round(s, 6), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_search_matches_brute_force(spark, monkeypatch):
    """Several shards of several blocks, repeated rows, ties, null ids and texts."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefghij") * rng.choice([1, 1, 2, 3]) for _ in range(rng.randrange(1, 60)))) for i in range(300)]
    rows += [rows[0], rows[1], (301, rows[2][1]), (None, rows[3][1]), (302, None), (303, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = df.where("doc_id % 20 = 0")
    asked = {(r["doc_id"], r["text"]) for r in queries.collect()}
    want = brute_search(rows, asked, 5)
    for settings in ({}, {"BLOCK": 8, "SHARD_DOCS": 40}):
        for name, v in settings.items():
            monkeypatch.setattr(search, name, v)
        got = sorted(map(tuple, search.search(df, queries, k=5).collect()))
        assert [g[:3] for g in got] == [w[:3] for w in want] and all(abs(g[3] - w[3]) < 2e-6 for g, w in zip(got, want))


def test_search_sends_little_from_later_shards(spark, monkeypatch):
    """Thresholds from the first shards hold in all others, which send what may be among the k best of all and not k each."""
    rng = random.Random(17)
    rows = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(1, rng.choice([3, 40]))}" for _ in range(rng.randrange(5, 60)))) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    for name, v in {"BLOCK": 8, "SEEDS": 8, "PART": 7, "FRESH_WORDS": 100}.items():
        monkeypatch.setattr(search, name, v, raising=False)
    sent, materialize = [], search.materialize

    def counted(rows):
        out = materialize(rows)
        if "query_id" in out.columns:
            sent.append(out.count())
        return out

    monkeypatch.setattr(search, "materialize", counted)
    queries = df.where("doc_id % 40 = 0")
    got = sorted(map(tuple, search.search(df, queries, k=5).collect()))
    want = brute_search(rows, [r for r in rows if r[0] % 40 == 0], 5)
    assert [g[:3] for g in got] == [w[:3] for w in want] and all(abs(g[3] - w[3]) < 2e-6 for g, w in zip(got, want))
    assert sum(sent) < 0.5 * 40 * 20 * 5, sent


def test_search_passes_over_most_postings(monkeypatch):
    """A query of rare and common words: blocks without the rare ones are skipped, and common lists before the pivot are read for few documents."""
    monkeypatch.setattr(search, "BLOCK", 16)
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "of", "and", "tide", "moon", f"w{rng.randrange(3000)}"]) for _ in range(50)) for _ in range(2000)]
    vocab, post = {}, {}
    for i, t in enumerate(texts):
        for w in search.words(t):
            post.setdefault(vocab.setdefault(w, len(vocab)), {}).setdefault(i, 0)
            post[vocab[w]][i] += 1
    df = np.array([len(post[t]) for t in range(len(vocab))], np.int32)
    doc, tf = np.array([d for t in range(len(vocab)) for d in sorted(post[t])], np.uint16), np.array([post[t][d] for t in range(len(vocab)) for d in sorted(post[t])], np.uint32)
    data = search.pack(np.arange(2000), np.full(2000, 50), np.frombuffer("\n".join(vocab).encode(), np.uint8), df, doc, tf)
    s = search.Shard(data, 50.0)
    rare = [w for w in vocab if df[vocab[w]] == 12][:3]
    terms = np.array([vocab[w] for w in ("the", "of", "and", "tide", *rare)])
    weights = np.log(1 + (2000 - df[terms] + 0.5) / (df[terms] + 0.5))
    (found, scores), = s.top([(terms, weights)], 5, np.zeros(1))
    full = np.zeros(2000)
    for t, w in zip(terms, weights):
        for d, n in post[t].items():
            full[d] += w * n * 2.2 / (n + 1.2)
    best = np.sort(np.round(full, 6))[::-1][:5]
    assert np.allclose(np.sort(scores)[::-1][:5], best, atol=2e-6)
    assert s.asked == df[terms].sum() and s.scored < 0.1 * s.asked, (s.scored, s.asked)


# -------------------------------------------------------------- 7


def test_toxicity(spark, hard, empty):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (1, None, None)], labels.schema))
    assert toxicity.toxicity(hard, odd).count() == hard.count()
    assert {r["score"] for r in toxicity.toxicity(hard, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(empty, labels).count() == 0


def test_toxicity_held_out_accuracy_and_obfuscation(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.train(docs, labels)
    held = labels.where(toxicity.fold(F.col("doc_id")) == 0)
    scored = toxicity.score(docs.join(held, "doc_id", "left_semi"), model).join(held, "doc_id").select("score", "toxic").collect()
    hit = sum(r["score"] >= 0.5 and r["toxic"] == 1 for r in scored)
    assert hit >= 0.85 * sum(r["toxic"] == 1 for r in scored)
    assert sum(r["score"] >= 0.5 and r["toxic"] == 0 for r in scored) <= 0.02 * len(scored)
    for noisy, plain in (("1d10t", "idiot"), ("$tup1d", "stupid"), ("m0r0n", "moron"), ("s t u p i d", "stupid"), ("i-d-i-o-t", "idiot"), ("stuuuupid", "stupid")):
        assert model.chars.decode(noisy) == plain
    scorer = toxicity.Scorer(model)
    clean = "Then thnttionwh thtible of be tiwh erered or or hawh. "
    assert scorer.batch([clean, ""])[0] < 0.1
    assert all(s >= 0.5 for s in scorer.batch([clean + "you 1d10t", clean + "s t u p i d", clean + "w0rthle$$ one"]))


def _small_model():
    """A character model of a few words."""
    table = toxicity._symbol_table()
    cube = np.zeros((29, 29, 29), np.int64)
    for w in ("stupid idiot", "you are a stupid moron", "the moon and the tide", "pass the letter book", "all is well known") * 20:
        s = table[np.frombuffer(f"  {w} ".encode(), np.uint8)]
        for x in zip(s, s[1:], s[2:]):
            cube[x] += 1
    return toxicity.CharModel(cube[:toxicity.SYMBOLS, :toxicity.SYMBOLS, :toxicity.SYMBOLS].copy())


def brute_decode(chars, text):
    """Every path through the lattice."""
    paths = [((0, 0), 0.0, "")]
    for i, c in enumerate(text):
        made = []
        for (a, b), score, out in paths:
            for s, ch, cost in chars.options(text, i, c):
                if s is None or (s == 0 and b == 0):
                    made.append(((a, b), score + cost, out + ("" if s is None else ch)))
                else:
                    made.append(((b, s), score + cost + chars.logp[a, b, s], out + ch))
        paths = made
    return max(score + (chars.logp[a, b, 0] if b else 0.0) for (a, b), score, _ in paths), {out.strip() for (a, b), score, out in paths}, paths


@pytest.mark.parametrize("text", ["1d10t", "$tup1d", "m0r0n", "stuupiid", "s t u p", "i-d-i-o-t", "0*1", "mooo0n", "a.b", "", "tt1de"])
def test_viterbi_is_the_best_path(text):
    chars = _small_model()
    best, _, paths = brute_decode(chars, text)
    got = chars.decode(text)
    assert any(out.strip() == got and abs(score + (chars.logp[a, b, 0] if b else 0.0) - best) < 1e-9 for (a, b), score, out in paths)


def test_long_stretches_are_decoded_whole():
    chars = _small_model()
    assert chars.decode("stuuuupid" * 200) == chars.decode("stuuuupid" * 2)[:6] * 200
    assert len(toxicity.Reader(chars).words("m0r0n-" * 3000)) >= 3000


def _scorer():
    chars = _small_model()
    model = toxicity.Model(chars, {"stupid": (90, 0), "stup*": (95, 0), "idiot": (80, 1)}, 100, 900, coefficients=(-8.0, 3.0, 0.5, 0.5))
    return model, toxicity.Scorer(model)


def test_score_is_the_logistic_of_the_strongest_words():
    model, scorer = _scorer()
    w = toxicity.weight(90, 0, 100, 900)
    assert abs(w - (np.log((90.5 - 1.64 * 90.25 ** 0.5) / 101) - np.log(0.5 / 901))) < 1e-12
    strong = max(w, toxicity.weight(95, 0, 100, 900))
    z = -8 + 3 * strong + 0.5 * min(1, (strong - 3) / 2)
    for text in ("stupid", "a stupid moon", "stupid stupid"):
        assert abs(scorer.batch([text])[0] - 1 / (1 + np.exp(-z))) < 1e-12
    assert scorer.batch(["", "the moon"]) == [1 / (1 + np.exp(8.0))] * 2


@pytest.mark.parametrize("text", ["stuupid", "stu-pid", "s  t  u  p  i  d", "s\tt\nu p i d", "the.stu-pid moon", "st_u.pid", "STUPPID", "s t u p i d " * 400, "id-iott"])
def test_disguises_are_read(text):
    assert _scorer()[1].batch(["the moon " + text + " the tide"])[0] > 0.9


@pytest.mark.parametrize("text", ["the letter book is well-known", "a b c d e f", "all moon.tide passes", "1 2 3 4 5", "stood up in the pool"])
def test_plain_text_stays_plain(text):
    assert _scorer()[1].batch([text])[0] < 0.1


# -------------------------------------------------------------- 8


def test_mixing_sql(spark):
    assert_same(spark, mixing.query, mixing.SQL, DATA)


def test_apportion_is_highest_quotients():
    rng = np.random.default_rng(2)
    for _ in range(200):
        w = rng.integers(0, 50, rng.integers(1, 8)).astype(float)
        seats = int(rng.integers(0, 60))
        q = sorted((-x / (2 * j + 1), i) for i, x in enumerate(w) if x for j in range(seats))[:seats]
        assert mixing.apportion(w, seats).tolist() == [sum(i == k for _, i in q) for k in range(len(w))]


def test_mixing(spark, hard, empty):
    rows = mixing.mix(hard, block=4, shard_words=500).collect()
    assert len(rows) == hard.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(t - n) <= 40 for t, n in by.values())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(hard, block=4, shard_words=500).collect()))
    assert mixing.mix(empty).count() == 0
    for df in (hard.dropDuplicates(["doc_id"]), hard):
        out = mixing.mixed(df.withColumn("n_chars", F.length("text")), block=4)
        plan, made = {}, {}
        for r in mixing.mix(df, block=4).collect():
            plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["taken"]
        for r in out.collect():
            made[r["doc_id"]] = made.get(r["doc_id"], 0) + len(r["text"].encode().split())
            assert r["n_chars"] == len(r["text"])
        assert made == {k: v for k, v in plan.items() if v}


def test_quotas_of_many_shards_add_up(spark, monkeypatch):
    """Seats dealt to groups of shards first."""
    monkeypatch.setattr(mixing, "TREE", 3)
    rng = random.Random(8)
    df = spark.createDataFrame([(i, words(rng, rng.randrange(60)), f"s{i % 2}") for i in range(600)], "doc_id long, text string, source string")
    rows = mixing.mix(df, block=4, shard_words=300).collect()
    for s in ("s0", "s1"):
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 150 and all(r["taken"] <= 2 * r["size"] for r in own)


# -------------------------------------------------------------- 9


def brute_repeats(rows, width):
    """Documents in the order of id (null first), then of the text's 64-bit hash."""
    import xxhash

    hashed = lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).view(np.int64)
    order = sorted({(i is not None, i or 0, hashed(t or ""), t or "") for i, t in rows})
    seen, out = set(), {}
    for there, i, _, t in order:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if b[p:p + width] in seen:
                gone[p:p + width] = b"\1" * width
            seen.add(b[p:p + width])
        out[i if there else None, t] = (len(b), sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def spliced_rows():
    """Texts that share passages, wholly and in part, with ids that repeat, null ids, nulls and repeated rows."""
    rng = random.Random(4)
    rows = [(r[0], r[1]) for r in hard_rows()]
    texts = [t for _, t in rows if t]
    for i in range(20, 70):
        a, other = words(rng, rng.randrange(5, 80)), rng.choice(texts)
        at = rng.randrange(len(other))
        texts.append(a + other[at:at + rng.randrange(500)] + words(rng, rng.randrange(30)))
        rows.append((i if i % 7 else rng.choice([20, None]), texts[-1]))
    return rows + rows[30:34]


@pytest.mark.parametrize("settings", [{}, {"PIECE": 700, "FLUSH": 50, "FAN": 3}, {"SAMPLE": 1, "CONTEXTS": 1, "AT_ONCE": 64}])
@pytest.mark.parametrize("width", [100, 40])
def test_suffix_dedup(spark, empty, monkeypatch, settings, width):
    """In one pass and in several, with pieces that cut documents, and with every shared gram heavy."""
    for k, v in settings.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    rows = spliced_rows()
    want = brute_repeats(rows, width)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r)[:5] for r in suffix_dedup.remove_repeats(df, width=width).collect()]
    assert sorted(map(str, got)) == sorted(str((i, *want[i, t or ""])) for i, t in rows)
    if width == 40 and not settings:
        assert suffix_dedup.remove_repeats(empty).count() == 0


def test_windows_wider_than_a_byte_counts(spark):
    base = "".join(chr(97 + i * i % 26) + str(i) for i in range(400))
    df = spark.createDataFrame([(1, base), (2, "x" + base + "y")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(df, width=600).collect()}
    assert got == {1: 0, 2: len(base)}


def test_unequal_bundles_of_equal_hash_are_kept_apart(monkeypatch):
    """With a hash that tells nothing apart, bytes decide."""
    monkeypatch.setattr(suffix_dedup, "_hash_at", lambda words, at, width: np.zeros(len(at), np.uint64))
    texts = [b"a" * 50 + bytes(range(32, 122)) + b"b" * 50, b"c" * 60 + bytes(range(32, 122)) + b"d" * 40, bytes(range(122, 32, -1)) * 2]
    parts = suffix_dedup.bundled(texts, np.arange(3), np.zeros(3, np.int64), 60, None)
    key, _, start, stop = suffix_dedup._spans(suffix_dedup.sort_bucket(suffix_dedup.Bundles.joined(60, parts)))
    want = brute_repeats([(i, t.decode()) for i, t in enumerate(texts)], 60)
    assert [(int((stop - start)[key == i].sum()), int((key == i).sum())) for i in range(3)] == [want[i, t.decode()][1:3] for i, t in enumerate(texts)]


# -------------------------------------------------------------- 10


def test_token_files(spark, hard, empty, tmp_path):
    from tokenizers import Tokenizer

    path = bpe.tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    token_files.write_token_files(hard, str(tmp_path / "t"), path)
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_token_files(spark, str(tmp_path / "t")).collect()))
    assert len(got) == len(hard_rows())
    starts = sorted(g[2:4] for g in got)
    assert starts[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:]))
    assert [g[0:2] for g in sorted(got, key=lambda g: g[2])] == [g[0:2] for g in got]
    ids = {(i is not None, i or 0): [] for i, *_ in hard_rows()}
    for i, t, *_ in hard_rows():
        ids[i is not None, i or 0].append(zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()))
    for k, crcs in ids.items():
        assert sorted(crcs) == sorted(g[4] for g in got if g[:2] == k)
    found = token_files.lookup(spark, str(tmp_path / "t"), [10, 11, 777]).collect()
    assert sorted(r["key"] for r in found) == [10, 10, 11]
    token_files.write_token_files(empty, str(tmp_path / "e"), path)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    h = PerfectHash.load(PerfectHash.build(keys).dump())
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    assert len(PerfectHash.build(keys[:0]).slots(keys[:0])) == 0
