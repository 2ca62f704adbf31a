"""Queries on small payloads and link graphs written out here, for operators no table has input for."""

from __future__ import annotations

import gzip
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import Lexicon
from ..sources import records as sr
from .crawl import CrawlRules, crawl, crawl_stats

LEXICON = Lexicon(strong=("tide table",), moderate=("harbour",), adversarial=("newsletter",))

_NTRS = {"stats": {"total": 2}, "results": [
    {"id": 11, "title": "Tide tables", "abstract": "a", "stiType": "REPORT", "distribution": "PUBLIC", "submittedDate": "2020", "center": {"name": "Centre"}, "subjectCategories": ["seas"], "keywords": ["tides"],
     "downloads": [{"links": {"pdf": "/api/11.pdf", "fulltext": "/api/11.txt"}}], "exportControl": {"itar": "NO", "ear": "NO", "isExportControl": "NO"},
     "authorAffiliations": [{"meta": {"author": {"name": "A. Author"}}}], "publications": [{"publicationDate": "2019-01-02"}]},
    {"id": 12, "title": "Withheld", "exportControl": {"itar": "YES"}}]}
_CORE = {"totalHits": 3, "results": [
    {"id": 1, "title": "Both", "downloadUrl": "https://a.example/1.pdf", "sourceFulltextUrls": ["https://b.example/1.pdf"], "yearPublished": 2001, "links": [{"type": "display", "url": "https://a.example/1"}], "fullText": "n/a"},
    {"id": 2, "title": "Source only", "sourceFulltextUrls": ["https://b.example/2.pdf"], "authors": [{"name": "B"}]}, {"id": 3, "title": "No file"}]}
_SEARCH = [("tides", {"total": 2, "results": [{"title": "T", "link": "/t"}, {"title": "Speech", "link": "/s"}]}), ("tables", {"total": 1, "results": [{"title": "T again", "link": "/t"}]})]
_CONTENT = [{"base_path": "/t", "content_id": "c1", "title": "Tides", "document_type": "guide", "details": {"attachments": [{"content_type": "application/pdf", "url": "https://c.example/t.pdf"}, {"content_type": "text/csv", "url": "https://c.example/t.csv"}]},
             "links": {"organisations": [{"title": "Office"}]}}, {"base_path": "/s", "content_id": "c2", "details": {"attachments": []}}]
_OAI = """<OAI-PMH><ListRecords><record><header><identifier>oai:dot:92801</identifier><datestamp>2024-05-06</datestamp></header><metadata><oai_dc:dc><dc:title>Tides &amp; tables</dc:title><dc:creator>A</dc:creator>
<dc:subject>sea</dc:subject><dc:subject>moon</dc:subject><dc:date>2003</dc:date></oai_dc:dc></metadata></record>
<record><header status="deleted"><identifier>oai:dot:1</identifier></header></record><resumptionToken>next</resumptionToken></ListRecords></OAI-PMH>"""
_SITE = {
    "https://s.example/": '<a href="/noise">about us</a><a href="/harbour">harbour</a><a href="/login">login</a>',
    "https://s.example/noise": '<p>x <a href="/files/minutes.pdf">minutes</a></p><a href="/more">more</a>',
    "https://s.example/harbour": '<ul><li><a href="/files/tide_table_1.pdf">PDF</a><li><a href="/files/tide_table_2.pdf">Tide table 2</a></ul>',
    "https://s.example/more": '<a href="https://elsewhere.example/x.pdf">away</a>', "https://s.example/login": ""}


def _payload(spark, value, schema: str) -> DataFrame:
    return spark.createDataFrame([(json.dumps(value),)], "j string").select(F.from_json("j", schema).alias("p")).select("p.*")


_SHOWN = ("source", "source_id", "title", "landing_url", "candidate_urls", "abstract", "authors", "organization", "pub_date", "doc_type", "subject_terms", "rights", "export_control", "export_control_reason")


def _flat(records: DataFrame, *more: str) -> DataFrame:
    """What an adapter fills in, arrays as text."""
    kinds = dict(records.dtypes)
    return records.select(*[(F.array_join(c, "|") if kinds[c].startswith("array") else F.col(c)).alias(c) for c in (*_SHOWN, *more)])


def _values(rows: list[tuple], columns: tuple[str, ...], kinds: dict[str, str] = {}) -> str:
    """SQL for literal rows; kinds are of columns that aren't text."""
    said = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    typed = ", ".join(f"{c}::{kinds.get(c, 'VARCHAR')} AS {c}" for c in columns)
    return f"SELECT {typed} FROM (VALUES {', '.join('(' + ', '.join(map(said, r)) + ')' for r in rows)}) v({', '.join(columns)})"


def src_ntrs(spark, d) -> DataFrame:
    return _flat(sr.ntrs_records(sr.hits(_payload(spark, _NTRS, sr.NTRS))))


def src_core(spark, d) -> DataFrame:
    return _flat(sr.core_records(sr.hits(_payload(spark, _CORE, sr.CORE)), "n/a"), "raw_metadata")


def src_govuk(spark, d) -> DataFrame:
    raw = spark.createDataFrame([(t, json.dumps(p)) for t, p in _SEARCH], "term string, j string").select("term", F.from_json("j", sr.GOVUK_SEARCH).alias("p")).select("term", "p.*")
    content = spark.createDataFrame([(json.dumps(c),) for c in _CONTENT], "j string").select(F.from_json("j", sr.GOVUK_CONTENT).alias("p")).select("p.*")
    return _flat(sr.govuk_records(sr.hits(raw, "term"), content))


def src_oai(spark, d) -> DataFrame:
    return _flat(sr.oai_records(sr.oai_payload_records(spark.createDataFrame([(_OAI,)], "xml string"))), "raw_metadata")


def src_resumption(spark, d) -> DataFrame:
    """The token that asks for the rest of a listing, of an answer that ends one, and of one that has none."""
    answers = spark.createDataFrame([("more", _OAI), ("last", "<OAI-PMH><ListRecords><resumptionToken/></ListRecords></OAI-PMH>"), ("error", '<OAI-PMH><error code="badArgument">x</error><record><header/></record></OAI-PMH>')], "name string, xml string")
    found = sr.oai_payload_records(answers.where("name = 'error'")).agg(F.count(F.lit(1)).alias("n"))
    return answers.select("name", sr.resumption_token(F.col("xml")).alias("token")).unionByName(found.select(F.lit("records of an error").alias("name"), F.col("n").cast("string").alias("token")))


_MAP = "<urlset><url><loc> https://h.example/?a=1&amp;b=2 </loc></url><url><loc>https://h.example/b</loc></url></urlset>"
_INDEX = "<sitemapindex><sitemap><loc>https://h.example/a.xml.gz</loc></sitemap><sitemap><loc>https://h.example/sub.xml</loc></sitemap></sitemapindex>"
_SITEMAPS = {"https://h.example/sitemap.xml": _INDEX.encode(), "https://h.example/a.xml.gz": gzip.compress(_MAP.encode(), mtime=0), "https://h.example/sub.xml": _INDEX.replace("a.xml.gz", "deep.xml").replace("sub.xml", "sitemap.xml").encode(),
             "https://h.example/deep.xml": _MAP.replace("/b<", "/c<").encode(), "https://h.example/broken": b"not xml"}


def src_sitemaps(spark, d) -> DataFrame:
    """Pages that an index of sitemaps leads to: one compressed, one an index itself that also names the first, within a depth of two."""
    files = spark.createDataFrame(list(_SITEMAPS.items()), "url string, body binary")
    return sr.walk_sitemaps(files, ["https://h.example/sitemap.xml"], depth=2).select("url", "depth")


def src_redistributions(spark, d) -> DataFrame:
    """Entries under either id, from a date on."""
    items = [{"id": "11", "available": "false", "date": "2024-02-01"}, {"citationId": "12", "available": "true", "distribution": "PUBLIC", "date": "2024-03-01"}, {"id": "13", "available": "None", "date": "2023-01-01"}]
    return sr.redistributions(spark.createDataFrame([(items,)], "items array<map<string,string>>"), "2024-01-01").select("key", "available", "distribution")


def src_requests(spark, d) -> DataFrame:
    """The calls that ask for two phrases, one with more results than a page and one with none."""
    from ..sources.adapters import NTRS

    return NTRS.requests(spark.createDataFrame([("tide table", 150), ("no such", 0)], "term string, total bigint"))


def run_sources(spark, d) -> DataFrame:
    """Four sources of one run, of which one fails: the others' records are in, and the run says what became of each."""
    from .run import discover

    broken = lambda: (_ for _ in ()).throw(ValueError("no answer"))
    sources = {"ntrs": lambda: sr.ntrs_records(sr.hits(_payload(spark, _NTRS, sr.NTRS))), "core": lambda: sr.core_records(sr.hits(_payload(spark, _CORE, sr.CORE)), "n/a"), "broken": broken,
               "rosap": lambda: sr.oai_records(sr.oai_payload_records(spark.createDataFrame([(_OAI,)], "xml string")))}
    known = spark.createDataFrame([("core:1",)], "key string")
    return discover(spark, sources, Lexicon(strong=("tide tables", "both")), known).runs.select("source", "outcome", "error", "seen", "export_controlled", "dropped", "new", "known")


def _crawled(spark, focused: bool) -> DataFrame:
    pages = spark.createDataFrame(list(_SITE.items()), "url string, html string")
    rules = CrawlRules(("https://s.example/",), "focused" if focused else "breadth", allow_hosts=("s.example",), most_pages=3, focused=focused)
    return crawl(pages, LEXICON, rules).withColumn("priority", F.round("priority", 6))


def crawl_focused(spark, d) -> DataFrame:
    return _crawled(spark, True)


def crawl_bfs(spark, d) -> DataFrame:
    return _crawled(spark, False)


def crawl_rates(spark, d) -> DataFrame:
    """Both strategies on one site and one budget."""
    pages = spark.createDataFrame(list(_SITE.items()), "url string, html string")
    return crawl_stats(_crawled(spark, True).unionByName(_crawled(spark, False)), LEXICON, pages)


QUERIES = {f.__name__: f for f in (src_ntrs, src_core, src_govuk, src_oai, src_resumption, src_sitemaps, src_redistributions, src_requests, run_sources, crawl_focused, crawl_bfs, crawl_rates)}

_BOOL = {"export_control": "BOOLEAN"}
_VISITED = ("source", "url", "depth", "priority", "state", "kind", "anchor", "parent", "seq")
_URL_KINDS = {"depth": "INTEGER", "priority": "DOUBLE", "seq": "BIGINT"}
_H, _F = "https://s.example/", "https://s.example/files/"
#: Worked out by hand from the payloads and pages above.
ORACLES = {
    "src_ntrs": _values([
        ("ntrs", "11", "Tide tables", "https://ntrs.nasa.gov/citations/11", "https://ntrs.nasa.gov/api/11.txt|https://ntrs.nasa.gov/api/11.pdf", "a", "A. Author", "Centre", "2019-01-02", "REPORT", "seas|tides", "PUBLIC", False, None),
        ("ntrs", "12", "Withheld", "https://ntrs.nasa.gov/citations/12", "", None, "", None, None, None, "", None, True, "itar=YES ear=None flag=None")], _SHOWN, _BOOL),
    "src_core": _values([
        ("core", "1", "Both", "https://a.example/1", "https://a.example/1.pdf|https://b.example/1.pdf", None, "", None, "2001", None, None, None, False, None, "{}"),
        ("core", "2", "Source only", "https://core.ac.uk/works/2", "https://b.example/2.pdf", None, "B", None, None, None, None, None, False, None, "{}")], (*_SHOWN, "raw_metadata"), _BOOL),
    "src_govuk": _values([("govuk", "c1", "Tides", "https://www.gov.uk/t", "https://c.example/t.pdf", None, None, "Office", None, "guide", None, None, False, None)], _SHOWN, _BOOL),
    "src_oai": _values([("rosap", "dot:92801", "Tides & tables", "https://rosap.ntl.bts.gov/view/dot/92801", "https://rosap.ntl.bts.gov/view/dot/92801/dot_92801_DS1.pdf", None, "A", None, "2003", None, "sea|moon", "Public Domain", False, None,
                         '{"oai_identifier":"oai:dot:92801","datestamp":"2024-05-06T00:00:00Z","dc":{"title":["Tides & tables"],"creator":["A"],"subject":["sea","moon"],"date":["2003"]}}')], (*_SHOWN, "raw_metadata"), _BOOL),
    "src_resumption": _values([("more", "next"), ("last", None), ("error", None), ("records of an error", "0")], ("name", "token")),
    "src_sitemaps": _values([("https://h.example/?a=1&b=2", 1), ("https://h.example/b", 1), ("https://h.example/c", 2)], ("url", "depth"), {"depth": "INTEGER"}),
    "src_redistributions": _values([("ntrs:11", "false", None), ("ntrs:12", "true", "PUBLIC")], ("key", "available", "distribution")),
    "src_requests": _values([("tide table", f"https://ntrs.nasa.gov/api/citations/search?q=%22tide+table%22&page.size=100&page.from={n}") for n in (0, 100)], ("term", "url")),
    # of two records of ntrs one is controlled and the other strong; of core one is known and the other negative, as is rosap's only one
    "run_sources": _values([("ntrs", "done", None, 2, 1, 0, 1, 0), ("core", "done", None, 2, 0, 1, 0, 1), ("broken", "failed", "ValueError: no answer", 0, 0, 0, 0, 0), ("rosap", "done", None, 1, 0, 1, 0, 0)],
                           ("source", "outcome", "error", "seen", "export_controlled", "dropped", "new", "known"), {c: "BIGINT" for c in ("seen", "export_controlled", "dropped", "new", "known")}),
    "crawl_focused": _values([
        ("focused", _H, 0, 1000, "visited", "page", None, None, 0), ("focused", f"{_H}noise", 1, -0.675, "visited", "page", "about us", _H, 1), ("focused", f"{_H}harbour", 1, 2.725, "visited", "page", "harbour", _H, 2),
        ("focused", f"{_H}login", 1, -4.675, "pending", "page", "login", _H, 3), ("focused", f"{_F}tide_table_1.pdf", 2, 11.4, "pending", "document", "PDF", f"{_H}harbour", 1000001),
        ("focused", f"{_F}tide_table_2.pdf", 2, 19.15, "pending", "document", "Tide table 2", f"{_H}harbour", 1000002), ("focused", f"{_F}minutes.pdf", 2, 1.4, "pending", "document", "minutes", f"{_H}noise", 2000001),
        ("focused", f"{_H}more", 2, -1.6, "pending", "page", "more", f"{_H}noise", 2000002)], _VISITED, _URL_KINDS),
    "crawl_bfs": _values([
        ("breadth", _H, 0, 1000, "visited", "page", None, None, 0), ("breadth", f"{_H}noise", 1, 0, "visited", "page", "about us", _H, 1), ("breadth", f"{_H}harbour", 1, 0, "visited", "page", "harbour", _H, 2),
        ("breadth", f"{_H}login", 1, 0, "pending", "page", "login", _H, 3), ("breadth", f"{_F}minutes.pdf", 2, 0, "pending", "document", "minutes", f"{_H}noise", 1000001), ("breadth", f"{_H}more", 2, 0, "pending", "page", "more", f"{_H}noise", 1000002),
        ("breadth", f"{_F}tide_table_1.pdf", 2, 0, "pending", "document", "PDF", f"{_H}harbour", 2000001), ("breadth", f"{_F}tide_table_2.pdf", 2, 0, "pending", "document", "Tide table 2", f"{_H}harbour", 2000002)], _VISITED, _URL_KINDS),
    "crawl_rates": "SELECT source, 3::BIGINT AS pages, 3::BIGINT AS documents, 2::BIGINT AS relevant, 2.0 / 3 AS harvest_rate FROM (VALUES ('focused'), ('breadth')) v(source)",
}
