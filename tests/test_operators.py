import pytest
from pyspark.sql import functions as F

from siftworks.functions.lexicon import Lexicon
from siftworks.operators import bands, clean, frontier, harvest, records, report
from siftworks.plans.crawl import CrawlRules, crawl
from siftworks.plans.fixtures import _SITE, LEXICON
from siftworks.sources import records as sr
from siftworks.sources import sinks
from siftworks.streaming.ingest import ingest


def test_clean_text(spark):
    head = "A running header line"
    body = "\n".join([head, "text", "12", "Page 3", "<!-- image -->", "", "", "", "| table row that is long |"] * 10) + "\nshort"
    got = spark.createDataFrame([(body,), (None,), ("",)], "t string").select(clean.clean_text(F.col("t")).alias("c")).collect()
    assert head not in got[0]["c"] and "12" not in got[0]["c"] and got[0]["c"].count("| table row") == 10 and got[0]["c"].endswith("short\n") and "\n\n\n" not in got[0]["c"]
    assert [r["c"] for r in got[1:]] == ["\n", "\n"]


def test_bands_and_empty_texts(spark):
    lex = Lexicon(strong=("tide table",), moderate=("harbour",), structural=("scope",))
    df = spark.createDataFrame([("Tide table", "# 1. Scope\ntide table harbour"), ("x", ""), (None, None)], "title string, text string")
    got = bands.with_band(df, lex, bands.BandRules(domain=(("moon",), ("sea",)))).collect()
    assert (got[0]["band"], got[0]["sections"], got[0]["concept_terms"]) == ("concept", ["scope"], ["tide table", "harbour"])
    assert [r["band"] for r in got[1:]] == ["none", "none"]


def test_content_and_overlap(spark):
    df = spark.createDataFrame([("s1", "a:1", "a", 1), ("s1", "b:1", "b", 2), ("s1", "a:1", "a", 3), ("s2", "a:2", "a", 4), ("s2", "a:3", "a", 5)], "sha256 string, key string, source string, seq int")
    assert {r["sha256"]: r["provenance"] for r in records.content_table(df).collect()} == {"s1": ["a:1", "b:1"], "s2": ["a:2", "a:3"]}
    assert [tuple(r) for r in records.overlap_pairs(df).collect()] == [("a x b", 1)]
    assert tuple(records.duplicate_stats(df).first()) == (2, 2)
    assert [r["status"] for r in records.first_writer(df).orderBy("seq").collect()] == ["stored", "duplicate", "duplicate", "stored", "duplicate"]


def test_incremental_add_is_idempotent(spark):
    known = spark.createDataFrame([("a",)], "key string")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "key string, n int")
    added = records.add_if_absent(known, new, "key", "n")
    assert [tuple(r) for r in added.collect()] == [("b", 1)]
    assert records.add_if_absent(known.unionByName(added.select("key")), new).count() == 0


def test_export_control_comes_first(spark):
    df = spark.createDataFrame([("a", True, None), ("b", False, None), ("c", None, None)], "key string, export_control boolean, export_control_reason string")
    free, held = records.split_export_control(df)
    assert {r["key"] for r in free.collect()} == {"b", "c"} and held.first()["reason"] == "export control"


def test_frontier_promotion_and_state(spark):
    s = "source string, url string, depth int, priority double, state string, kind string, anchor string, parent string, seq bigint"
    urls = spark.createDataFrame([("s", "u1", 3, 1.0, "pending", "page", "old", "p", 1), ("s", "u2", 3, 1.0, "visited", "page", "old", "p", 2)], s)
    found = spark.createDataFrame([("s", "u1", 1, 0.5, "x", "page", None, "q", 5), ("s", "u2", 1, 9.0, "x", "page", "new", "q", 6), ("s", "u3", 2, 4.0, "x", "document", "n", "q", 7)], s).drop("state")
    got = {r["url"]: r for r in frontier.merge_found(urls, found).collect()}
    assert (got["u1"]["depth"], got["u1"]["priority"], got["u1"]["anchor"]) == (1, 1.0, "old")
    assert (got["u2"]["priority"], got["u2"]["state"]) == (1.0, "visited")
    assert (got["u3"]["state"], got["u3"]["kind"]) == ("pending", "document")


def test_pending_without_tiers_is_everything(spark):
    df = spark.createDataFrame([("a", "discovered", "weak", 1.0), ("b", "discovered", "strong", 2.0), ("c", "stored", "strong", 3.0)], "key string, status string, tier string, lexicon_score double")
    assert [r["key"] for r in frontier.pending(df, []).collect()] == ["b", "a"]
    assert [r["key"] for r in frontier.pending(df, ["weak"], 1).collect()] == ["a"]


def test_throttle_matches_a_loop(spark):
    arrivals = [0.0, 0.1, 5.0, 5.1, 5.2, 30.0]
    df = spark.createDataFrame([("h", a, i) for i, a in enumerate(arrivals)], "host string, arrival double, seq int")
    want, last = [], None
    for a in arrivals:
        last = a if last is None else max(a, last + 2.0)
        want.append(last)
    assert [round(r["start"], 6) for r in frontier.throttle(df, 2.0).orderBy("seq").collect()] == want


def test_focused_crawl_finds_the_relevant_branch_first(spark):
    pages = spark.createDataFrame(list(_SITE.items()), "url string, html string")
    run = lambda focused: crawl(pages, LEXICON, CrawlRules(("https://s.example/",), allow_hosts=("s.example",), most_pages=2, focused=focused))
    docs = lambda u: {r["url"].rsplit("/", 1)[1] for r in u.where("kind = 'document'").collect()}
    assert docs(run(True)) == {"tide_table_1.pdf", "tide_table_2.pdf"}
    assert docs(run(False)) == {"minutes.pdf"}
    assert "elsewhere.example" not in str(run(True).collect())


def test_harvest_prefers_order_and_rejects(spark):
    pending = spark.createDataFrame([("k1", ["u1", "u2"]), ("k2", ["u3"]), ("k3", []), ("k4", ["u2"])], "key string, candidate_urls array<string>")
    fetched = spark.createDataFrame([("u1", 200, "application/pdf", b"<html>sorry", None), ("u2", 200, None, b"%PDF-1", None), ("u3", 404, None, None, "gone")], "url string, http_status int, content_type string, body binary, error string")
    done = harvest.stored(harvest.outcomes(pending, fetched))
    got = {r["key"]: (r["outcome"], r["status"]) for r in done.collect()}
    assert got == {"k1": ("fetched", "stored"), "k4": ("fetched", "duplicate"), "k2": ("failed", "failed"), "k3": ("no_url", "failed")}
    assert harvest.funnel(done).first()["stored"] == 1


def test_reports(spark):
    df = spark.createDataFrame([("a", "discovered", "weak", "k1", "s1", 5)], "source string, status string, tier string, key string, sha256 string, size_bytes long")
    with pytest.raises(ValueError):
        report.counts_by(df, "key")
    assert '"documents":1' in report.totals_json(df, df).first()["report"]
    before, now = spark.createDataFrame([("a", 1), ("b", 2)], "source string, n int"), spark.createDataFrame([("b", 2), ("c", 3)], "source string, n int")
    assert {tuple(r) for r in report.deltas(before, now, ["source"]).collect()} == {("a", -1), ("c", 3)}
    assert report.stored_document(df.withColumn("stored_path", F.lit("../x")), "a" * 64).count() == 0


def test_sitemaps(spark):
    df = spark.createDataFrame([("s", "<urlset><url><loc> https://h/?a=1&amp;b=2 </loc></url></urlset>"), ("s", "not xml")], "source string, xml string")
    assert [r["loc"] for r in sr.sitemap_urls(df, "xml", "source").collect()] == ["https://h/?a=1&b=2"]
    req = spark.createDataFrame([("s", i, 1) for i in range(40)], "source string, seq int, urls int")
    assert sr.sitemap_budget(req).where("used").count() == 8


def test_sinks_and_stream(spark, tmp_path):
    df = spark.createDataFrame([("aa11", b"x"), ("aa11", b"x"), ("bb22", b"y")], "sha256 string, body binary")
    for _ in range(2):
        sinks.put_contents(df, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2
    with pytest.raises(ValueError):
        sinks.relative_path("a/../../b", "/r")
    spark.createDataFrame([("k1", 1), ("k1", 2), ("k2", 3)], "key string, n int").coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        ingest(spark.readStream.schema("key string, n int").parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_adapters_read_what_was_captured(spark, tmp_path):
    import json

    from siftworks.plans.fixtures import _CORE, _NTRS, _OAI
    from siftworks.sources.adapters import ADAPTERS, environment

    for name, text in (("ntrs", json.dumps(_NTRS)), ("core", json.dumps(_CORE)), ("rosap", _OAI)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "answer").write_text(text)
    got = {n: sorted(r["source_id"] for r in a.discover(spark, str(tmp_path / n)).collect()) for n, a in ADAPTERS.items()}
    assert got == {"ntrs": ["11", "12"], "core": ["1", "2"], "rosap": ["dot:92801"]}
    assert environment("# c\nexport A='x y'\nB=1 # one\nC=\nnonsense\n", {"B": "2"}) == {"A": "x y", "B": "2", "C": ""}


def test_a_batch_of_pages_is_ordered_like_single_visits(spark):
    site = {"https://s.example/": '<a href="/a">a</a><a href="/b">b</a>', "https://s.example/a": '<a href="/a1.pdf">x</a><a href="/both.pdf">from a</a>', "https://s.example/b": '<a href="/both.pdf">from b</a><a href="/b1.pdf">y</a>'}
    pages = spark.createDataFrame(list(site.items()), "url string, html string")
    got = []
    for batch in (1, 2):
        urls = crawl(pages, LEXICON, CrawlRules(("https://s.example/",), allow_hosts=("s.example",), most_pages=3, focused=False, batch=batch))
        docs = urls.where("kind = 'document'").orderBy("seq").collect()
        assert len({r["seq"] for r in docs}) == len(docs)
        got.append([(r["url"][18:], r["parent"][18:]) for r in docs])
    assert got[0] == got[1] == [("a1.pdf", "a"), ("both.pdf", "a"), ("b1.pdf", "b")]


def test_robots_verdicts_survive_a_reshuffled_input(spark):
    urls = spark.createDataFrame([("h", f"/p{i}", i) for i in range(200)] + [(None, "/x", 1000), ("h", None, 1001)], "host string, path string, i int").repartition(7, F.rand())
    rules = spark.createDataFrame([("h", "/p1", False), ("h", "/p19", True)], "host string, prefix string, allow boolean")
    got = {r["i"]: r["allowed"] for r in frontier.robots_allowed(urls, rules).collect()}
    assert got == {i: not str(i).startswith("1") or str(i).startswith("19") for i in range(200)} | {1000: True, 1001: True}


def test_throttle_with_delays_matches_a_loop(spark):
    import random

    rng = random.Random(2)
    rows = [("h", i * 10.0 * rng.random(), rng.choice([None, 1.0, 5.0]), rng.choice([None, None, 30.0]), i) for i in range(40)]
    rows = [(h, a, d, p, i) for i, (h, a, d, p, _) in enumerate(sorted(rows, key=lambda r: r[1]))]
    want, last, pause = [], None, 0.0
    for _, a, d, p, _ in rows:
        last = a if last is None else max(a, last + max(2.0, d or 0.0, pause))
        pause = p or 0.0
        want.append(round(last, 6))
    df = spark.createDataFrame(rows, "host string, arrival double, delay double, pause double, seq int")
    assert [round(r["start"], 6) for r in frontier.throttle(df, 2.0, delay="delay", pause="pause").orderBy("seq").collect()] == want


def test_all_cards_are_listed(spark, tmp_path):
    cards = spark.createDataFrame([(f"k{i}", f"Title <{i}>", "s", "weak", float(i), "p") for i in range(25)], "key string, title string, source string, tier string, lexicon_score double, stored_path string")
    report.corpus_html(cards, str(tmp_path / "html"), per_page=10)
    pages = [p.read_text() for p in (tmp_path / "html").glob("part-*") if p.stat().st_size]
    assert sum(p.count("<td>Title &lt;") for p in pages) == 25 and len(pages) > 1 and all(p.startswith("<!doctype html>") for p in pages)


def test_authors_of_linked_data(spark):
    from siftworks.functions import html

    pages = [(f"https://s.org/{i}", f'<script type="application/ld+json">{{"name": "N", "author": {a}}}</script>') for i, a in enumerate(['"A"', '{"name": "B"}', '[{"name": "C"}, "D"]', "[]"])]
    got = [r["a"] for r in html.metadata(html.extract(spark.createDataFrame(pages, "url string, html string"))).orderBy("url").select(F.col("meta.authors").alias("a")).collect()]
    assert got == [["A"], ["B"], ["C", "D"], []]


def test_one_source_that_fails_leaves_the_others(spark):
    from siftworks.plans.run import discover

    rows = lambda: spark.createDataFrame([("a", "1", "tide table"), ("a", "2", "other")], "source string, source_id string, title string")
    late = lambda: rows().withColumn("title", F.raise_error(F.lit("bad row")))
    out = discover(spark, {"late": late, "a": rows, "b": rows}, LEXICON, spark.createDataFrame([], "key string"), skip=["b"])
    assert {r["source"]: r["outcome"] for r in out.runs.collect()} == {"late": "failed", "a": "done"}
    assert [r["key"] for r in out.new.collect()] == ["a:1"] and out.controlled.count() == 0
    assert discover(spark, {}, LEXICON, spark.createDataFrame([], "key string")).new.count() == 0
