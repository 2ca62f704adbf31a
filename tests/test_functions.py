import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftworks.functions import content, html, text, urls
from siftworks.functions.lexicon import Lexicon, domain_terms, with_score
from siftworks.sources.records import expand, select_sources, year_partitions


def values(spark, column, data):
    """column over a one-column frame `x`, in order."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], "i int, x string")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_normalize_matches_plain_python(spark):
    data = [None, "", "  A--b ", "Éçôle ﬁn ½ ß Ω", "İstanbuĺ ² ㎏", "éa", "x" * 50_000]
    assert values(spark, text.normalize_text(F.col("x")), data) == [text.fold(x) for x in data]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=40))
def test_normalize_any_text(spark, data):
    assert values(spark, text.normalize_text(F.col("x")), data) == [text.fold(x) for x in data]


def test_phrases(spark):
    assert values(spark, text.count_phrase(F.col("x"), "a"), [" a a a ", " b ", " a b a "]) == [2, 0, 2]
    assert values(spark, text.has_phrase(F.col("x"), "a b"), [" a b c ", " xa b ", "a b"]) == [True, False, False]


def test_lines_split_like_python(spark):
    data = ["", "a", "a\n", "\n", "a\r\nb\rc d\n\n"]
    assert values(spark, text.lines(F.col("x")), data) == [x.splitlines() for x in data]


def test_section_titles_have_no_space_around_and_keep_their_digits(spark):
    data = ["# 1. Scope.\n(Phase 1)\n\n## 3 Apollo 2!\n" + "x" * 80, "- 0", None]
    assert values(spark, text.section_titles(F.col("x")), data) == [["scope", "phase 1", "apollo 2"], ["0"], []]


@pytest.mark.parametrize("url, want", [
    ("HTTP://Host.Org:80/A/b/?t=1#x", "http://host.org/A/b?t=1"), ("https://h:443/", "https://h/"), ("https://h", "https://h/"), (" https://h/a// ", "https://h/a"), ("//h/x", "https://h/x")])
def test_canonical_url(spark, url, want):
    assert values(spark, urls.canonical_url(F.col("x")), [url]) == [want]


def test_canonicalize(spark):
    data = ["https://H/a/?utm_source=x&b=2&a=1#f", "https://h/a?sort=up&k=v", "https://h/?q=a%20b&empty="]
    assert values(spark, urls.canonicalize(F.col("x")), data) == ["https://h/a?a=1&b=2", "https://h/a?k=v&sort=up", "https://h/?empty=&q=a+b"]
    assert values(spark, urls.canonicalize(F.col("x"), True), data)[1] == "https://h/a?k=v"


@pytest.mark.parametrize("url, want", [
    ("https://h/a/b/c", None), ("https://h/" + "a/" * 4, "repeats"), ("https://h/" + "/".join(map(str, range(13))), "depth"), ("https://h/?" + "&".join(f"p{i}=1" for i in range(7)), "parameters"),
    ("https://h/?sort=a&order=b", "facets"), ("https://h/?month=3", "calendar"), ("https://h/?year=2001", "calendar"), ("https://h/?year=x", None), ("not a url", None)])
def test_traps(spark, url, want):
    assert values(spark, urls.trap_reason(F.col("x")), [url]) == [want]


def test_hosts_noise_documents_and_titles(spark):
    assert values(spark, urls.host_matches(urls.host(F.col("x")), ["b.org"]), ["https://b.org/", "https://a.B.org:8/", "https://xb.org/"]) == [True, True, False]
    assert values(spark, urls.is_noise(F.col("x")), ["https://h/cartography", "https://h/press-release/1", "https://h/report"]) == [True, True, False]
    assert values(spark, urls.is_document(F.col("x")), ["https://h/A.PDF?x=1", "https://h/a.html"]) == [True, False]
    assert values(spark, urls.best_title(F.lit(None).cast("string"), F.lit("Download PDF"), F.col("x")), ["https://h/The%20plan_2-0.pdf"]) == ["The plan 2 0"]
    assert values(spark, urls.best_title(F.lit(None).cast("string"), F.lit("The  plan"), F.col("x")), ["https://h/x.pdf"]) == ["The plan"]
    assert values(spark, urls.suspicious_redirect(F.col("x"), F.lit("https://h/landingpage/maint.html")), ["https://h/a", "https://h/landingpage/maint.html"]) == [True, False]


def test_tiers(spark):
    lex = Lexicon(strong=("tide table",), moderate=("harbour",), structural=("scope",), adversarial=("newsletter",))
    rows = [("Tide table", ""), ("Tide table newsletter", ""), ("Other", "tide table"), ("Harbour scope", "harbour scope"), ("None", None)]
    df = spark.createDataFrame(rows, "t string, b string")
    got = {r["t"]: (r["lexicon_score"], r["tier"]) for r in with_score(df, lex, F.col("t"), F.col("b")).collect()}
    assert got == {"Tide table": (10.0, "strong"), "Tide table newsletter": (4.0, "weak"), "Other": (3.0, "weak"), "Harbour scope": (6.5, "weak"), "None": (0.0, "negative_sample")}


@pytest.mark.parametrize("filtered", [False, True])
def test_a_text_is_normalised_once(spark, filtered):
    """Also under a filter on the tier, which Catalyst would push below a projection together with all that it is made of."""
    lex = Lexicon(strong=("a b", "c d"), moderate=("e", "f"), structural=("g",), adversarial=("h",))
    df = with_score(spark.createDataFrame([("x", "y")], "t string, b string").repartition(2), lex, F.col("t"), F.col("b"))
    df = df.where("tier <> 'negative_sample'").orderBy("lexicon_score") if filtered else df
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^a-z0-9]+") == 2


def test_columns_of_a_caller_are_kept(spark):
    """Names that operators use for themselves elsewhere stay as they are where a caller has them."""
    lex = Lexicon(strong=("a",))
    df = spark.createDataFrame([("a b", "c", 1, 2)], "t string, b string, texts int, nth int")
    row = with_score(df, lex, F.col("t"), F.col("b")).first()
    assert (row["texts"], row["nth"], row["lexicon_score"]) == (1, 2, 10.0)
    assert text.unused(df, "texts") == "texts_0" and text.unused(df, "free") == "free"


def test_references_are_resolved_like_a_browser_does(spark):
    import html as h

    data = ["a &lt;b&gt; &amp;amp; &bogus; &", "&eacute;&#233;&#xE9;&#x1F600;", "&copy 2020 &notit; &ampx", "&#0;&#128;&#x81;&#55296;&#x110000;&#99999999999;&#1;&#13;", "&;&#;&#x;", "", None, "&NotEqualTilde;&lt", "x" * 9000 + "&amp;"]
    assert values(spark, text.unescape(F.col("x")), data) == [None if x is None else h.unescape(x) for x in data]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["&", ";", "#", "x", "X", "amp", "lt", "copy", "not", "in", "eacute", "65", "0", "150", "1F600", "g", " ", "é"]), max_size=8).map("".join), min_size=1, max_size=40))
def test_references_of_any_text(spark, data):
    import html as h

    assert values(spark, text.unescape(F.col("x")), data) == [h.unescape(x) for x in data]


def test_every_name_is_found_in_a_small_map(spark):
    """A map is searched key by key, so the names are dealt to many."""
    import html as h
    import json
    from html.entities import html5

    data = [f"&{k} &{k}x" for k in html5] + [f"&#{i};&#x{i:X}" for i in (9, 10, 31, 127, 128, 0x7FF, 0x800, 0xD7FF, 0xFFFD, 0xFFFF, 0x10000, 0x10FFFD)]
    assert values(spark, text.unescape(F.col("x")), data) == [h.unescape(x) for x in data]
    buckets = json.loads(text._references()[0])
    assert sum(map(len, buckets)) == len(html5) and max(map(len, buckets)) <= 8


def test_kinds(spark):
    data = [(b"%PDF-1.7", "text/html", "pdf"), (b"PK\x03\x04x", None, "zip"), (b"<!DOCTYPE html><p>", "application/pdf", "html"), (b"<?xml?><a/>", None, "xml"), (b'{"a": 1}', None, "json"),
            (b"[Paper Number] x", "text/plain", "text"), (b"\xff\xfe\x00", "application/pdf", "unknown"), (b"plain", None, "text"), (b"", None, "text")]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(data)], "i int, b binary, c string, want string")
    assert [r["k"] for r in df.select("i", content.sniff_kind(F.col("b"), F.col("c")).alias("k")).orderBy("i").collect()] == [w for *_, w in data]


def test_small_columns(spark):
    row = spark.range(1).select(content.backoff(F.lit(2.0), F.lit(3), 10.0).alias("a"), content.crawl_delay(F.lit(1.0), F.lit(2.0), F.lit(10.0)).alias("b"), content.oai_datetime(F.lit("2024-01-02")).alias("c"),
                                content.retry_after(F.lit("12"), F.current_timestamp()).alias("d"), content.retry_after(F.lit("soon"), F.current_timestamp()).alias("e"), content.split_subjects(F.array(F.lit("a; b,,c"))).alias("f")).first()
    assert tuple(row) == (10.0, 5.0, "2024-01-02T00:00:00Z", 12.0, None, ["a", "b", "c"])


def test_links_of_a_page():
    page = html.Page('<base href="https://s.org/x/"><p>see <a href="a b.pdf#f">the <b>file</b></a> now<p><a href="mailto:x">m</a><a href="{{u}}">t</a><a href="http://s.org/x/a%20b.pdf">again</a><a href="/i" title="Icon"></a><a href="http://[bad">z</a>')
    got = html.links_of(page, "https://s.org/")
    assert [(x["url"], x["anchor"], x["is_document"]) for x in got] == [("https://s.org/x/a%20b.pdf", "the file", True), ("https://s.org/i", "Icon", False)]
    assert got[0]["context"] == "see the file now"


def test_metadata_precedence(spark):
    pages = [("https://s.org/a/p", '<title>T</title><meta name="citation_title" content="C"><meta name="dc.title" content="D"><meta name="citation_author" content="A"><meta name="citation_pdf_url" content="/f.pdf"><meta name="citation_keywords" content="x; y">'),
             ("https://s.org/b", '<title> Only   title </title>'), ("https://s.org/documents/downloadPublic?x", "<title>Documents download module</title><script>window.location='/real.pdf'</script>"),
             ("https://s.org/c", '<script type="application/ld+json">{"name": "L", "description": "d"}</script>'), (None, None)]
    df = html.metadata(html.extract(spark.createDataFrame(pages, "url string, html string")))
    got = {r["url"]: r["meta"] for r in df.collect()}
    a = got["https://s.org/a/p"]
    assert (a.title, a.authors, a.pdf_url, a.subjects) == ("C", ["A"], "https://s.org/f.pdf", ["x", "y"])
    assert got["https://s.org/b"].title == "Only title"
    w = got["https://s.org/documents/downloadPublic?x"]
    assert (w.title, w.pdf_url) == (None, "https://s.org/real.pdf")
    assert (got["https://s.org/c"].title, got["https://s.org/c"].abstract) == ("L", "d")


def test_driver_helpers(tmp_path):
    assert year_partitions({y: 4000 for y in range(2000, 2016)}, 2000, 2015) == [(y, y + 1) for y in range(2000, 2016, 2)]
    assert expand({"a": ["${X:-1}", "${Y}"]}, {"Y": "2"}) == {"a": ["1", "2"]}
    with pytest.raises(KeyError):
        expand("${Z}", {})
    assert select_sources(["a", "b", "c"], ["a", "b"], ["b"]) == ["a"]
    assert domain_terms({"x": {"ativo": True, "fortes": ["A b", "c"], "moderados": ["d"]}, "y": {"ativo": False, "fortes": ["z"]}}) == (("a b", "c"), ("d",))
