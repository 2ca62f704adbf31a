"""Records from captured payloads of repositories: JSON search results, OAI-PMH, sitemaps, JSON lines.

Payloads are read with explicit schemas; nothing here goes to the network.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.content import oai_datetime
from ..functions.text import unused
from ..functions.urls import canonical_url
from ..operators.records import conform

NTRS = ("results array<struct<id:bigint,title:string,abstract:string,stiType:string,distribution:string,distributionDate:string,submittedDate:string,"
        "downloads:array<struct<links:struct<fulltext:string,pdf:string,original:string>>>,exportControl:struct<itar:string,ear:string,isExportControl:string>,"
        "authorAffiliations:array<struct<meta:struct<author:struct<name:string>>>>,center:struct<name:string>,subjectCategories:array<string>,keywords:array<string>,"
        "publications:array<struct<publicationDate:string,issuePublicationDate:string>>>>, stats struct<total:bigint>")
CORE = ("results array<struct<id:bigint,title:string,abstract:string,authors:array<struct<name:string>>,yearPublished:int,publishedDate:string,documentType:string,fieldOfStudy:string,doi:string,downloadUrl:string,"
        "sourceFulltextUrls:array<string>,fullText:string,dataProviders:array<struct<id:bigint,name:string>>,links:array<struct<type:string,url:string>>>>, totalHits bigint")
GOVUK_SEARCH = "results array<struct<title:string,description:string,format:string,link:string>>, total bigint"
GOVUK_CONTENT = ("base_path string, content_id string, title string, description string, document_type string, first_published_at string, "
                 "details struct<attachments:array<struct<title:string,content_type:string,url:string>>>, links struct<organisations:array<struct<title:string>>>")
_OAI = '/*[local-name()="record"]'


def read_payloads(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def hits(payloads: DataFrame, *keep: str) -> DataFrame:
    """One row a result, with its position."""
    return payloads.select(*keep, F.posexplode("results").alias("pos", "hit")).select(*keep, "pos", "hit.*")


def _present(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull() & (x != ""))


def _or_empty(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<string>"))


def _canonical(values: Column) -> Column:
    return F.transform(values, canonical_url)


def ntrs_records(rows: DataFrame, base: str = "https://ntrs.nasa.gov") -> DataFrame:
    """Links as full text, pdf, original of each download; controlled if any of three flags says so."""
    per = F.flatten(F.transform("downloads", lambda d: _present(F.array(d["links"]["fulltext"], d["links"]["pdf"], d["links"]["original"]))))
    urls = F.transform(_or_empty(per), lambda u: F.when(u.startswith("http"), u).otherwise(F.concat(F.lit(base), u)))
    ec = F.col("exportControl")
    flags = [F.coalesce(F.upper(ec[k]) == "YES", F.lit(False)) for k in ("itar", "ear", "isExportControl")]
    any_flag = flags[0] | flags[1] | flags[2]
    published = F.get(F.filter(F.transform("publications", lambda p: F.coalesce(p["publicationDate"], p["issuePublicationDate"])), lambda x: x.isNotNull()), F.lit(0))
    return conform(rows.select(
        F.lit("ntrs").alias("source"), F.col("id").cast("string").alias("source_id"), F.coalesce("title", F.lit("")).alias("title"), "abstract", F.concat(F.lit(f"{base}/citations/"), F.col("id")).alias("landing_url"),
        _canonical(urls).alias("candidate_urls"), _or_empty(_present(F.transform("authorAffiliations", lambda a: a["meta"]["author"]["name"]))).alias("authors"), F.col("center.name").alias("organization"),
        F.coalesce(published, "distributionDate", "submittedDate").alias("pub_date"), F.col("stiType").alias("doc_type"),
        F.concat(_or_empty(F.col("subjectCategories")), _or_empty(F.col("keywords"))).alias("subject_terms"), F.col("distribution").alias("rights"), any_flag.alias("export_control"),
        F.when(any_flag, F.concat_ws(" ", *[F.concat(F.lit(f"{n}="), F.coalesce(ec[k], F.lit("None"))) for n, k in (("itar", "itar"), ("ear", "ear"), ("flag", "isExportControl"))])).alias("export_control_reason")))


def core_records(rows: DataFrame, missing_text: str = "") -> DataFrame:
    """Only hits with a file; the landing page is the first display link; a sentinel instead of full text is none."""
    urls = _present(F.concat(F.array("downloadUrl"), _or_empty(F.col("sourceFulltextUrls"))))
    display = F.get(F.filter("links", lambda x: x["type"] == "display"), F.lit(0))["url"]
    out = rows.where(F.size(urls) > 0).withColumn("full_text", F.when(F.col("fullText").isin("", missing_text), F.lit(None)).otherwise(F.col("fullText")))
    return conform(out.select(
        F.lit("core").alias("source"), F.col("id").cast("string").alias("source_id"), F.coalesce("title", F.lit("")).alias("title"), "abstract", _canonical(urls).alias("candidate_urls"),
        F.coalesce(display, F.concat(F.lit("https://core.ac.uk/works/"), F.col("id"))).alias("landing_url"), _or_empty(_present(F.transform("authors", lambda a: a["name"]))).alias("authors"),
        F.nullif(F.array_join(_or_empty(_present(F.transform("dataProviders", lambda p: p["name"]))), ", "), F.lit("")).alias("organization"),
        F.coalesce(F.nullif("publishedDate", F.lit("")), F.col("yearPublished").cast("string")).alias("pub_date"), F.coalesce(F.nullif("fieldOfStudy", F.lit("")), F.nullif("documentType", F.lit(""))).alias("doc_type"),
        F.lit(False).alias("export_control"), F.to_json(F.struct("doi", "full_text")).alias("raw_metadata")))


def govuk_records(search: DataFrame, content: DataFrame) -> DataFrame:
    """Search hits, each link once (the first term and place), joined with their content; only those with a PDF attached.

    search: term, pos, title, description, link.
    """
    once = search.groupBy("link").agg(F.min_by(F.struct("title", "description"), F.struct("term", "pos")).alias("hit"))
    rows = once.join(content, once.link == content.base_path)
    urls = _present(F.transform(F.filter("details.attachments", lambda a: a["content_type"] == "application/pdf"), lambda a: a["url"]))
    return conform(rows.where(F.size(_or_empty(urls)) > 0).select(
        F.lit("govuk").alias("source"), F.coalesce("content_id", "link").alias("source_id"), F.coalesce(F.col("title"), F.col("hit.title"), F.lit("")).alias("title"), F.coalesce(F.col("description"), F.col("hit.description")).alias("abstract"),
        F.nullif(F.array_join(_or_empty(_present(F.transform("links.organisations", lambda o: o["title"]))), ", "), F.lit("")).alias("organization"), F.col("first_published_at").alias("pub_date"), F.col("document_type").alias("doc_type"),
        _canonical(urls).alias("candidate_urls"), F.concat(F.lit("https://www.gov.uk"), F.col("link")).alias("landing_url"), F.lit(False).alias("export_control")))


def oai_payload_records(payloads: DataFrame, xml: str = "xml") -> DataFrame:
    """One row a <record> of OAI-PMH answers, as an XML fragment; an answer with an error has none."""
    text = F.when(~F.col(xml).rlike(r"<(\w+:)?error[ >]"), F.col(xml))
    return payloads.select(F.explode(F.regexp_extract_all(text, F.lit(r"(?s)(<record[ >].*?</record>)"))).alias("record"))


def resumption_token(xml: Column) -> Column:
    return F.nullif(F.regexp_extract(xml, r"(?s)<resumptionToken[^>]*>([^<]*)</resumptionToken>", 1), F.lit(""))


def dc_values(record: Column, tag: str) -> Column:
    """Texts of a Dublin Core element, in order; XML's own escapes resolved."""
    raw = F.regexp_extract_all(record, F.lit(rf"(?s)<dc:{tag.replace('.', '[.]')}(?: [^>]*)?>(.*?)</dc:{tag.replace('.', '[.]')}>"))
    plain = lambda x: F.replace(F.replace(F.replace(F.replace(x, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))
    return F.filter(F.transform(raw, lambda x: F.trim(plain(x))), lambda x: x != "")


def dc_map(record: Column, tags: tuple[str, ...] = ("title", "creator", "contributor.creator", "subject", "description", "description.abstract", "publisher", "date", "type", "rights", "rights.accessRights")) -> Column:
    """Elements that are there, each with all its texts."""
    return F.map_filter(F.map_from_arrays(F.array(*[F.lit(t) for t in tags]), F.array(*[dc_values(record, t) for t in tags])), lambda k, v: F.size(v) > 0)


def oai_records(records: DataFrame, base: str = "https://rosap.ntl.bts.gov", source: str = "rosap") -> DataFrame:
    """Records that aren't deleted and have an identifier of the form collection:number; the PDF's address follows from it."""
    r = F.col("record")
    ident = F.trim(F.regexp_extract(r, r"(?s)<identifier[^>]*>([^<]*)</identifier>", 1))
    col, num = F.regexp_extract(ident, r"([A-Za-z]+):(\d+)\s*$", 1), F.regexp_extract(ident, r"([A-Za-z]+):(\d+)\s*$", 2)
    one = lambda *ts: F.coalesce(*[F.get(dc_values(r, t), F.lit(0)) for t in ts])
    many = lambda a, b: F.when(F.size(dc_values(r, a)) > 0, dc_values(r, a)).otherwise(dc_values(r, b))
    landing = F.concat(F.lit(f"{base}/view/"), col, F.lit("/"), num)
    live = records.where(~r.rlike(r"(?i)<header[^>]*status\s*=\s*.deleted.") & (num != "") & r.contains("oai_dc:dc"))
    return conform(live.select(
        F.lit(source).alias("source"), F.concat(col, F.lit(":"), num).alias("source_id"), F.coalesce(one("title"), F.lit("")).alias("title"), one("description.abstract", "description").alias("abstract"), many("contributor.creator", "creator").alias("authors"),
        one("publisher").alias("organization"), one("date").alias("pub_date"), one("type").alias("doc_type"), dc_values(r, "subject").alias("subject_terms"), landing.alias("landing_url"),
        F.array(F.concat(landing, F.lit("/"), col, F.lit("_"), num, F.lit("_DS1.pdf"))).alias("candidate_urls"), F.coalesce(one("rights.accessRights", "rights"), F.lit("Public Domain")).alias("rights"), F.lit(False).alias("export_control"),
        F.to_json(F.struct(ident.alias("oai_identifier"), oai_datetime(F.regexp_extract(r, r"<datestamp>([^<]*)</datestamp>", 1)).alias("datestamp"), dc_map(r).alias("dc"))).alias("raw_metadata")))


def redistributions(payload: DataFrame, since: str | None = None) -> DataFrame:
    """(key, available, distribution) from items that may stand under either name and with either id. payload: items array<map<string,string>>."""
    rows = payload.select(F.explode("items").alias("i")).select(
        F.concat(F.lit("ntrs:"), F.coalesce(F.col("i")["id"], F.col("i")["citationId"])).alias("key"), F.col("i")["available"].alias("available"), F.col("i")["distribution"].alias("distribution"), F.col("i")["date"].alias("date"))
    return rows if since is None else rows.where(F.col("date") >= since)


def year_partitions(totals: dict[int, int], low: int, high: int, cap: int = 10_000) -> list[tuple[int, int]]:
    """Year ranges that a source with a result cap is asked by: halved while they hold too many; a single year stays as it is."""
    n = sum(totals.get(y, 0) for y in range(low, high + 1))
    if not n:
        return []
    if n < cap or low == high:
        return [(low, high)]
    mid = (low + high) // 2
    return year_partitions(totals, low, mid, cap) + year_partitions(totals, mid + 1, high, cap)


def page_offsets(df: DataFrame, total: str = "total", size: int = 100, window: int = 10_000) -> DataFrame:
    """One row a request: offsets from 0 in steps of size, none beyond the window."""
    last = F.least(F.col(total), F.lit(window)) - 1
    return df.where(F.col(total) > 0).withColumn("offset", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), F.lit(size).cast("bigint"))))


def sitemap_urls(payloads: DataFrame, xml: str = "xml", *keep: str) -> DataFrame:
    """(kind, loc) of sitemaps and sitemap indexes; anything else has none."""
    kind = F.when(F.col(xml).rlike("<(\\w+:)?sitemapindex[ >]"), "index").when(F.col(xml).rlike("<(\\w+:)?urlset[ >]"), "urls")
    locs = F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<(?:\w+:)?loc>\s*(.*?)\s*</(?:\w+:)?loc>"))
    return payloads.withColumn("kind", kind).where("kind IS NOT NULL").select(*keep, "kind", F.posexplode(locs).alias("pos", "loc")).withColumn("loc", F.replace("loc", F.lit("&amp;"), F.lit("&")))


def walk_sitemaps(files: DataFrame, roots: list[str], depth: int = 3) -> DataFrame:
    """(url, depth) of the pages that sitemaps name, indexes followed `depth` levels down; each file is read once, at its first level.

    files: url, body binary, gzip or plain; what isn't a sitemap leads nowhere. Levels are joins, the driver sees none of their rows.
    """
    spark = files.sparkSession
    texts = files.select("url", gunzipped(F.col("body")).alias("xml"))
    now = spark.createDataFrame([(r,) for r in dict.fromkeys(roots)], "url string")
    seen, out = now, None
    for level in range(depth + 1):
        locs = sitemap_urls(texts.join(now, "url", "left_semi"), "xml")
        pages = locs.where("kind = 'urls'").select(F.col("loc").alias("url"), F.lit(level).alias("depth"))
        out = pages if out is None else out.unionByName(pages)
        if level < depth:
            now = locs.where("kind = 'index'").select(F.col("loc").alias("url")).distinct().join(seen, "url", "left_anti")
            seen = seen.unionByName(now)
    return out.groupBy("url").agg(F.min("depth").alias("depth"))


def gunzipped(body: Column) -> Column:
    """Text of a body that may be gzip; Spark has no function for that, so those bodies, and no others, go through Arrow batches."""

    @F.pandas_udf("binary")
    def plain(bodies: pd.Series) -> pd.Series:
        import zlib

        def one(b):
            if b is None:
                return None
            try:
                return zlib.decompress(b, 31)
            except zlib.error:
                return None

        return bodies.map(one)

    packed = F.hex(F.substring(body, 1, 2)) == "1F8B"
    return F.coalesce(plain(F.when(packed, body)), F.when(~packed, body)).cast("string")


def sitemap_budget(requests: DataFrame, most: int = 30, probe: int = 8, least_yield: float = 3.0, by: str = "source", order: str = "seq") -> DataFrame:
    """requests (source, seq, urls) with `used`: within the budget, and not after the walk was given up for its low yield."""
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    found = unused(requests, "found")
    df = requests.withColumn("n", F.row_number().over(w)).withColumn(found, F.coalesce(F.sum("urls").over(before), F.lit(0)))
    poor = ((F.col("n") - 1) >= probe) & (F.col(found) < least_yield * (F.col("n") - 1))
    given_up = F.max(poor.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1
    return df.withColumn("used", (F.col("n") <= most) & ~given_up).drop(found)


def load_specs(folder: str) -> list[dict]:
    """All source specifications of a folder, by file name; ${NAME:-default} is taken from the environment."""
    from pathlib import Path

    import yaml

    return [expand(yaml.safe_load(p.read_text(encoding="utf-8"))) for p in sorted(Path(folder).glob("*.yaml"))]


def expand(value, env: dict[str, str] | None = None):
    """${NAME} and ${NAME:-default} in all strings of a nested value; a name without either is an error."""
    import os
    import re

    env = dict(os.environ) if env is None else env
    if isinstance(value, dict):
        return {k: expand(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def one(m):
        name, default = m[1], m[2]
        if env.get(name):
            return env[name]
        if default is None:
            raise KeyError(f"{name} is neither set nor has a default")
        return default

    return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", one, value)


def select_sources(names: list[str], only: list[str] | None = None, skip: list[str] | None = None) -> list[str]:
    kept = [n for n in names if not only or n in only]
    return [n for n in kept if n not in (skip or [])]
