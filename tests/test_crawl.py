"""Documents that only a page's head, a script or a source's url pattern names."""

import pytest

from siftworks.plans.crawl import CrawlRules, crawl, relevant_documents
from siftworks.plans.fixtures import LEXICON

SITE = {
    "https://s.example/": '<a href="/one">one</a><a href="/stream/7">file</a><a href="/documents/downloadPublic?id=3">wrapped</a>',
    "https://s.example/one": '<head><title>Tide table of the year</title><meta name="citation_pdf_url" content="/dot_1_DS1.pdf"></head>',
    "https://s.example/documents/downloadPublic?id=3": '<script>window.location = "https://files.example/w.pdf"</script>'}


def _crawled(spark, focused=True):
    pages = spark.createDataFrame(list(SITE.items()), "url string, html string")
    return crawl(pages, LEXICON, CrawlRules(("https://s.example/",), allow_hosts=("s.example",), most_pages=3, batch=2, focused=focused, document_patterns=("/stream/[0-9]+$",)))


@pytest.mark.parametrize("focused", [False, True])
def test_declared_documents_and_patterns(spark, focused):
    got = {r["url"]: r for r in _crawled(spark, focused).where("kind = 'document'").collect()}
    assert set(got) == {"https://s.example/stream/7", "https://s.example/dot_1_DS1.pdf", "https://files.example/w.pdf"}
    one = got["https://s.example/dot_1_DS1.pdf"]
    assert (one["depth"], one["anchor"], one["parent"]) == (1, "Tide table of the year", "https://s.example/one")
    assert got["https://files.example/w.pdf"]["anchor"] == "wrapped"
    assert focused or one["priority"] == 5.0


def test_relevance_is_judged_with_the_landing_page(spark):
    heads = {"own": '<title>Tide table of the year</title><a href="/dot_1_DS1.pdf">PDF</a>', "list": '<title>Tide table index</title><a href="/dot_2_DS1.pdf">PDF</a><a href="/dot_3_DS1.pdf">PDF</a>'}
    pages = spark.createDataFrame([(f"https://s.example/{k}", h) for k, h in heads.items()], "url string, html string")
    rows = [("c", f"https://s.example/{k}", 0, "page", None, None) for k in heads]
    rows += [("c", f"https://s.example/dot_{i}_DS1.pdf", 1, "document", "PDF", f"https://s.example/{k}") for i, k in ((1, "own"), (2, "list"), (3, "list"))]
    urls = spark.createDataFrame(rows, "source string, url string, depth int, kind string, anchor string, parent string")
    assert {r["url"][-9:-8]: r["relevant"] for r in relevant_documents(urls, LEXICON, pages).collect()} == {"1": True, "2": False, "3": False}
