import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from siftworks.plans.registry import ORACLES, QUERIES

from .compare import assert_same

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert_same(spark, QUERIES[name], ORACLES[name], DATA)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def documents(folder, texts):
    """A folder with a table of documents."""
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "source": [f"s{i % 2}" for i in range(len(texts))], "lang": ["en"] * len(texts), "text": texts}), f"{folder}/documents.parquet")
    return str(folder)


#: A heading as long as a section's may be, with a mark at its end, before another; with it the note is above 10, without it below 7.
HEADED = ["Was | theainha | erthin | inshing, | Edwh.\n" + "x" * 80 + " of the it and" + " y" * 5988 + "\nEnd", "# 1. And the\n", ""]


@pytest.mark.parametrize("name", ["bd_sections", "bd_bands", "ag_band_matrix", "snk_bands"])
def test_headings_with_marks_at_their_ends(spark, tmp_path, name):
    assert_same(spark, QUERIES[name], ORACLES[name], documents(tmp_path, HEADED))


def test_the_band_matrix_counts_languages_that_have_no_column(spark, tmp_path):
    folder = documents(tmp_path, HEADED)
    table = pq.read_table(f"{folder}/documents.parquet")
    pq.write_table(table.set_column(2, "lang", pa.array(["en", "pt", None])), f"{folder}/documents.parquet")
    assert_same(spark, QUERIES["ag_band_matrix"], ORACLES["ag_band_matrix"], folder)


@pytest.mark.parametrize("name", ["html_metadata", "fn_strip_markup"])
def test_references_that_the_sql_does_not_resolve(spark, tmp_path, name):
    """Cut at a title's end, without a semicolon, escaped themselves, unknown; a page without a title, an empty one, no page."""
    titles = ["a&amp;&amp", "b = &quot;x&quot", "&amp;lt; &lt;i&gt; & &ltx &copy &amp;amp; &amp;&amp;quot;", "&eacute;&#65;&bogus; &ampx"]
    html = [f"<html><head><title>{t}</title></head><body><p>one &amp; two</p></body></html>" for t in titles] + ["<html><p>x</p></html>", "<title></title>", "", None]
    pq.write_table(pa.table({"page_id": list(range(len(html))), "url": ["https://h/x"] * len(html), "html": html}), tmp_path / "pages.parquet")
    assert_same(spark, QUERIES[name], ORACLES[name], str(tmp_path))
