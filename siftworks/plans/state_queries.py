"""Queries over state tables (queues, stored documents, extraction records, head tags), with orders, events and pages standing in for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import content as fc
from ..functions import html as fh
from ..functions import lexicon as fl
from ..functions import text as ft
from ..functions import urls as fu
from ..operators import clean, frontier, harvest, links, records, report
from ..sources import records as sr
from .proxy import table
from .queries import ORACLES as _TABLE_ORACLES
from .queries import QUERIES as _TABLE_QUERIES
from .queries import _found

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def put(f):
        assert name not in _TABLE_QUERIES and name not in _TABLE_ORACLES
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return put


def _when(column, cases: dict, other: str):
    out = None
    for k, v in cases.items():
        out = F.when(column == k, v) if out is None else out.when(column == k, v)
    return out.otherwise(other)


def _docs(spark, d) -> DataFrame:
    """Orders as documents: a hash each, several contents of a customer, kinds and states by key."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return o.select(
        F.concat(F.lit("s"), F.pmod("o_custkey", F.lit(4)).cast("string")).alias("source"), F.col("o_orderkey").cast("string").alias("key"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"),
        _when(F.col("o_orderstatus"), {"F": "stored", "O": "discovered"}, "failed").alias("status"), _when(F.pmod("o_orderkey", F.lit(5)), {0: "pdf", 1: "text", 2: "html", 3: "zip"}, "ole").alias("content_kind"),
        F.col("o_totalprice").alias("lexicon_score"), F.col("o_custkey").alias("customer"))


_DOCS = """
o AS (SELECT 's' || (o_custkey % 4) AS source, o_orderkey::VARCHAR AS key, sha256(o_orderkey::VARCHAR) AS sha256, CASE o_orderstatus WHEN 'F' THEN 'stored' WHEN 'O' THEN 'discovered' ELSE 'failed' END AS status,
  CASE o_orderkey % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'text' WHEN 2 THEN 'html' WHEN 3 THEN 'zip' ELSE 'ole' END AS content_kind, o_totalprice AS lexicon_score, o_custkey AS customer, o_orderkey FROM orders)"""


# ---------------------------------------------------------------- stored documents


@query("fil_eligible", f"WITH {_DOCS} SELECT key FROM o WHERE status = 'stored' AND content_kind IN ('pdf', 'text', 'html') AND NOT (source = 's1' AND content_kind = 'pdf')")
def fil_eligible(spark, d):
    return clean.eligible(_docs(spark, d), "s1").select("key")


@query("fil_to_extract", f"WITH {_DOCS} SELECT key FROM o WHERE status = 'stored' AND content_kind = 'pdf' AND source <> 's1' AND NOT EXISTS (SELECT 1 FROM o x WHERE x.sha256 = o.sha256 AND x.customer % 3 = 0)")
def fil_to_extract(spark, d):
    docs = _docs(spark, d)
    return clean.to_extract(docs, docs.where("customer % 3 = 0"), "s1").select("key")


@query("jn_ocr_flags", f"""
WITH {_DOCS} SELECT key, CASE WHEN content_kind <> 'pdf' THEN 'delivered' WHEN customer % 2 = 0 THEN 'extracted_ocr' ELSE 'extracted' END AS origin FROM o WHERE status = 'stored'""")
def jn_ocr_flags(spark, d):
    """Texts of PDFs, some of them by character recognition, and texts delivered as such, with their origin."""
    stored = _docs(spark, d).where("status = 'stored'")
    flags = stored.select("sha256", (F.col("customer") % 2 == 0).alias("ocr"))
    return clean.union_texts(stored.where("content_kind = 'pdf'"), stored.where("content_kind <> 'pdf'"), flags).select("key", "origin")


@query("fil_ocr_fallback", r"""
WITH t AS (SELECT doc_id, text, doc_id % 3 = 0 AS scanned FROM documents),
a AS (SELECT doc_id, CASE WHEN scanned THEN '* - | 1 2 3' ELSE text END AS got, CASE WHEN scanned AND doc_id % 2 = 0 THEN text END AS other FROM t),
b AS (SELECT *, len(regexp_extract_all(got, '[A-Za-z]{3,}')) * 1000 / greatest(length(regexp_replace(got, '[\s|\-]', '', 'g')), 1) >= 30 AS ok FROM a),
c AS (SELECT doc_id, NOT ok AND other IS NOT NULL AS ocr, CASE WHEN NOT ok AND other IS NOT NULL THEN other ELSE got END AS best FROM b)
SELECT doc_id, ocr, len(regexp_extract_all(best, '[A-Za-z]{3,}')) * 1000 / greatest(length(regexp_replace(best, '[\s|\-]', '', 'g')), 1) >= 30 AS legible, len(best) AS chars, (best <> '')::INTEGER AS pages FROM c""")
def fil_ocr_fallback(spark, d):
    """Every third document as a scan that extraction can't read; recognition has read half of them."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("sha256"), "text")
    scanned = F.col("sha256") % 3 == 0
    extracted = docs.withColumn("text", F.when(scanned, "* - | 1 2 3").otherwise(F.col("text")))
    out = clean.with_fallback(extracted, docs.where(scanned & (F.col("sha256") % 2 == 0)))
    return out.select(F.col("sha256").alias("doc_id"), "ocr", "legible", F.length("text").cast("bigint").alias("chars"), "pages")


@query("jn_withdraw", f"WITH {_DOCS} SELECT key, CASE WHEN o_orderkey % 7 IN (0, 2) THEN 'withdrawn' ELSE status END AS status FROM o")
def jn_withdraw(spark, d):
    """Keys that a redistribution list marks as gone, under either spelling."""
    docs = _docs(spark, d)
    mark = _when(F.col("key").cast("bigint") % 7, {0: "false", 2: "None"}, "true")
    return harvest.withdraw(docs, docs.select("key", mark.alias("available"))).select("key", "status")


@query("jn_conditional", f"WITH {_DOCS} SELECT key, CASE WHEN status = 'stored' THEN 'W/' || sha256 END AS etag FROM o WHERE status <> 'failed'")
def jn_conditional(spark, d):
    """Documents to ask for again, with the tags that those stored before came with."""
    docs = _docs(spark, d)
    known = docs.where("status = 'stored'").select("key", F.concat(F.lit("W/"), "sha256").alias("etag"), F.lit(None).cast("string").alias("last_modified"))
    return harvest.conditional(docs.where("status <> 'failed'"), known).select("key", "etag")


@query("fil_stored_document", f"WITH {_DOCS} SELECT key FROM o WHERE o_orderkey = (SELECT min(o_orderkey) FROM o WHERE status = 'stored')")
def fil_stored_document(spark, d):
    docs = _docs(spark, d).where("status = 'stored'").withColumn("stored_path", fc.storage_path(F.col("sha256"), F.col("content_kind")))
    first = docs.agg(F.min_by("sha256", F.col("key").cast("bigint"))).first()[0]
    return report.stored_document(docs, first).select("key")


@query("ag_origin_missing", f"""
WITH {_DOCS}, e AS (SELECT * FROM o WHERE status = 'stored'), t AS (SELECT * FROM e WHERE customer % 5 > 0)
SELECT source AS origin, count(*) AS n, count_if(lexicon_score < 50000)::BIGINT AS illegible FROM t GROUP BY source UNION ALL SELECT 'missing', count(*), 0 FROM e WHERE customer % 5 = 0""")
def ag_origin_missing(spark, d):
    """Texts by origin, and the eligible documents that have none."""
    stored = _docs(spark, d).where("status = 'stored'")
    index = stored.where("customer % 5 > 0").select("sha256", F.col("source").alias("origin"), (F.col("lexicon_score") >= 50000).alias("legible"))
    return report.origin_counts(index, stored)


@query("prj_sources", f"""
WITH {_DOCS}, c AS (SELECT source, count(*) AS documents, count_if(status = 'stored')::BIGINT AS stored FROM o GROUP BY source),
s AS (SELECT * FROM (VALUES ('s0', 'api', 'Zero', 'https://Zero.example:8/x'), ('s1', 'crawl', ' ', 'http://one.example'), ('tide_tables', 'oai', NULL, NULL)) v(source, kind, name, address))
SELECT coalesce(s.source, c.source) AS source, coalesce(kind, 'unknown') AS kind, CASE coalesce(s.source, c.source) WHEN 's0' THEN 'Zero' WHEN 's1' THEN 'S1' WHEN 's2' THEN 'S2' WHEN 's3' THEN 'S3' ELSE 'Tide Tables' END AS title,
  CASE s.source WHEN 's0' THEN 'zero.example' WHEN 's1' THEN 'one.example' END AS host, coalesce(documents, 0) AS documents, coalesce(stored, 0) AS stored FROM s FULL JOIN c ON s.source = c.source""")
def prj_sources(spark, d):
    specs = spark.createDataFrame([("s0", "api", "Zero", "https://Zero.example:8/x"), ("s1", "crawl", " ", "http://one.example"), ("tide_tables", "oai", None, None)], "source string, kind string, name string, address string")
    return report.describe_sources(specs, _docs(spark, d))


@query("tk_band_order", _TABLE_ORACLES["bd_bands"].split(" SELECT doc_id, words")[0] + " SELECT doc_id, concept_note::DOUBLE AS concept_note FROM z WHERE band = 'concept' ORDER BY concept_note DESC, doc_id LIMIT 40")
def tk_band_order(spark, d):
    from ..operators import bands
    from .queries import _banded

    return bands.band_order(_banded(spark, d), "concept", "doc_id").limit(40).select("doc_id", "concept_note")


@query("fil_export_control", f"""
WITH {_DOCS} SELECT key, status, CASE WHEN o_orderkey % 2 = 0 THEN 'list ' || o_orderkey ELSE 'export control' END AS reason FROM (SELECT key, 'export_control' AS status, o_orderkey FROM o WHERE customer % 6 = 0)""")
def fil_export_control(spark, d):
    docs = _docs(spark, d).withColumn("export_control", F.when(F.col("customer") % 6 == 0, True).when(F.col("customer") % 6 == 1, False))
    docs = docs.withColumn("export_control_reason", F.when(F.col("key").cast("bigint") % 2 == 0, F.concat(F.lit("list "), "key")))
    return records.split_export_control(docs)[1].select("key", "status", "reason")


@query("jn_provenance", f"WITH {_DOCS} SELECT sha256(customer::VARCHAR) AS sha256, key, o_orderkey AS seq FROM o")
def jn_provenance(spark, d):
    """Customers as contents, every order a key of its content."""
    docs = _docs(spark, d).select(F.sha2(F.col("customer").cast("string"), 256).alias("sha256"), "key", F.col("key").cast("bigint").alias("seq"))
    return records.provenance(docs)


@query("ag_listed_provenance", f"""
WITH {_DOCS}, r AS (SELECT *, row_number() OVER (PARTITION BY customer ORDER BY o_orderkey) AS nth, count(*) OVER (PARTITION BY customer) AS n_keys FROM o)
SELECT sha256(customer::VARCHAR) AS sha256, string_agg(key, ',' ORDER BY o_orderkey) AS provenance, max(n_keys) AS n_keys FROM r WHERE nth <= 3 GROUP BY customer""")
def ag_listed_provenance(spark, d):
    """Contents with their first three keys, as a listing shows them, and how many there are."""
    docs = _docs(spark, d).select(F.sha2(F.col("customer").cast("string"), 256).alias("sha256"), "key", F.col("key").cast("bigint").alias("seq"))
    return records.content_table(docs, listed=3).select("sha256", F.array_join("provenance", ",").alias("provenance"), "n_keys")


# ---------------------------------------------------------------- queues


@query("tk_url_queue", _TABLE_ORACLES["fr_promote"].replace("SELECT user_id", "WITH p AS (SELECT user_id", 1) + ") SELECT url, priority, depth, seq FROM p ORDER BY priority DESC, depth, seq LIMIT 30")
def tk_url_queue(spark, d):
    queue = frontier.promote(_found(spark, d)).withColumn("state", F.lit("pending"))
    return frontier.url_head(queue, 30).select("url", "priority", "depth", "seq")


_URLS = """
q AS (SELECT 's' AS source, user_id::VARCHAR || '/' || event_type AS url, event_id, value, hour(ts)::INTEGER AS depth, CASE WHEN event_id % 3 <> 0 THEN event_id::VARCHAR END AS anchor FROM events),
known AS (SELECT url, max(value) AS priority, min(depth) AS depth, arg_max(anchor, event_id) FILTER (WHERE anchor IS NOT NULL) AS anchor, min(event_id) AS seq, CASE WHEN min(event_id) % 4 = 0 THEN 'visited' ELSE 'pending' END AS state FROM q WHERE event_id % 5 = 0 GROUP BY url),
found AS (SELECT url, max(value) AS priority, min(depth) AS depth, arg_max(anchor, event_id) FILTER (WHERE anchor IS NOT NULL) AS anchor, min(event_id) AS seq FROM q WHERE event_id % 5 = 1 GROUP BY url)"""


def _merged(spark, d) -> DataFrame:
    found = _found(spark, d)
    known = frontier.promote(found.where("seq % 5 = 0"))
    known = known.withColumn("state", F.when(F.col("seq") % 4 == 0, "visited").otherwise("pending"))
    return frontier.merge_found(known, found.where("seq % 5 = 1"))


_MERGED = f"""{_URLS},
m AS (SELECT coalesce(k.url, f.url) AS url, coalesce(k.state, 'pending') AS state, k.state IS NULL AS fresh, k.state = 'pending' AND (f.priority > k.priority OR f.depth < k.depth) AS better,
  k.priority AS kp, f.priority AS fp, k.depth AS kd, f.depth AS fd, k.anchor AS ka, f.anchor AS fa, coalesce(k.seq, f.seq) AS seq FROM known k FULL JOIN found f ON k.url = f.url),
merged AS (SELECT url, state, CASE WHEN fresh THEN fp WHEN better THEN greatest(kp, fp) ELSE kp END AS priority, CASE WHEN fresh THEN fd WHEN better THEN least(kd, fd) ELSE kd END AS depth,
  CASE WHEN fresh THEN fa WHEN better THEN coalesce(fa, ka) ELSE ka END AS anchor, seq FROM m)"""


@query("fr_merge", f"WITH {_MERGED} SELECT url, state, priority, depth, anchor, seq FROM merged")
def fr_merge(spark, d):
    """A queue of earlier findings, some visited, after later ones."""
    return _merged(spark, d).select("url", "state", "priority", "depth", "anchor", "seq")


@query("fr_emit", f"WITH {_MERGED} SELECT url, CASE WHEN state = 'pending' AND split_part(url, '/', 2) = 'purchase' THEN 'emitted' ELSE state END AS state FROM merged")
def fr_emit(spark, d):
    """Purchases as documents: those pending are handed on."""
    queue = _merged(spark, d).withColumn("kind", F.when(F.col("url").endswith("/purchase"), "document").otherwise("page"))
    return frontier.emit(queue)[1].select("url", "state")


@query("fr_residual", f"WITH {_MERGED} SELECT url FROM merged WHERE state IN ('pending', 'claimed') AND split_part(url, '/', 2) = 'purchase'")
def fr_residual(spark, d):
    queue = _merged(spark, d).withColumn("kind", F.when(F.col("url").endswith("/purchase"), "document").otherwise("page"))
    return frontier.residual_documents(queue).select("url")


@query("fr_reset", "SELECT event_id FROM events WHERE event_type <> 'click'")
def fr_reset(spark, d):
    queue = table(spark, d, "events").select("event_id", F.col("event_type").alias("source"))
    return frontier.reset(queue, "click").select("event_id")


@query("wn_throttle_delays", """
WITH a AS (SELECT event_id, user_id, epoch_us(ts) / 1000000 AS arrival, CASE event_type WHEN 'error' THEN 7200.0 ELSE 600.0 END AS delay, CASE WHEN event_type = 'purchase' THEN 86400.0 END AS pause FROM events),
g AS (SELECT *, greatest(1800.0, delay, coalesce(lag(pause) OVER (PARTITION BY user_id ORDER BY arrival, event_id), 0.0)) AS gap FROM a),
s AS (SELECT *, sum(gap) OVER (PARTITION BY user_id ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS step FROM g)
SELECT event_id, round(step + max(arrival - step) OVER (PARTITION BY user_id ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) - arrival, 3) AS wait FROM s""")
def wn_throttle_delays(spark, d):
    """Users as hosts that want longer delays for errors and a day's pause after a purchase."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("arrival"))
    e = e.withColumns({"delay": F.when(F.col("event_type") == "error", 7200.0).otherwise(600.0), "pause": F.when(F.col("event_type") == "purchase", 86400.0)})
    out = frontier.throttle(e, 1800.0, "user_id", "arrival", ("arrival", "event_id"), "delay", "pause")
    return out.select("event_id", F.round(F.col("start") - F.col("arrival"), 3).alias("wait"))


@query("ag_workers", "WITH h AS (SELECT user_id, max(event_id % 3)::BIGINT AS c FROM events WHERE user_id < 12 GROUP BY user_id) SELECT least(greatest(coalesce(sum(c), 1), 1), 32)::INTEGER AS workers FROM h")
def ag_workers(spark, d):
    hosts = table(spark, d, "events").where("user_id < 12").select(F.col("user_id").alias("host"), (F.col("event_id") % 3).alias("concurrency"))
    return frontier.worker_count(hosts)


@query("wn_sitemap_budget", """
WITH r AS (SELECT user_id, event_id, (event_id % 6)::BIGINT AS urls, row_number() OVER w AS n, coalesce(sum(event_id % 6) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
p AS (SELECT *, max((n - 1 >= 8 AND before < 3 * (n - 1))::INTEGER) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS given_up FROM r) SELECT event_id, n <= 30 AND given_up = 0 AS used FROM p""")
def wn_sitemap_budget(spark, d):
    """Users as sources, events as requests for sitemaps that give 0 to 5 urls."""
    r = table(spark, d, "events").select("event_id", F.col("user_id").alias("source"), F.col("event_id").alias("seq"), (F.col("event_id") % 6).alias("urls"))
    return sr.sitemap_budget(r).select("event_id", "used")


@query("src_page_offsets", "WITH n AS (SELECT user_id, count(*) AS total FROM events GROUP BY user_id) SELECT user_id, unnest(range(0, least(total, 50), 20)) AS start FROM n")
def src_page_offsets(spark, d):
    """Users as searches: the requests that page through their events, 20 at a time and none beyond 50."""
    n = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))
    return sr.page_offsets(n, size=20, window=50).select("user_id", F.col("offset").alias("start"))


# ---------------------------------------------------------------- columns of urls and texts


_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"


@query("fil_pdf_only", """
WITH p AS (SELECT page_id, [url, CASE WHEN page_id % 3 = 0 THEN 'https://h.example/' || page_id || '.PDF?v=1' END, CASE WHEN page_id % 4 = 0 THEN 'https://h.example/x?file=' || page_id || '.pdf' END] AS u FROM pages),
k AS (SELECT page_id, list_filter(u, lambda x: x IS NOT NULL AND ends_with(lower(regexp_replace(x, '[?#].*$', '')), '.pdf')) AS u FROM p) SELECT page_id, u[1] AS first, len(u) AS n FROM k WHERE len(u) > 0""")
def fil_pdf_only(spark, d):
    """Pages with some addresses that end in .pdf, in the path or in the query alone."""
    key, name = F.col("page_id"), lambda a, b: F.concat(F.lit(a), F.col("page_id").cast("string"), F.lit(b))
    urls = F.array("url", F.when(key % 3 == 0, name("https://h.example/", ".PDF?v=1")), F.when(key % 4 == 0, name("https://h.example/x?file=", ".pdf")))
    pages = table(spark, d, "pages").select("page_id", urls.alias("candidate_urls"))
    return records.pdf_only(pages).select("page_id", F.get("candidate_urls", F.lit(0)).alias("first"), F.size("candidate_urls").cast("bigint").alias("n"))


@query("fn_align_scheme", f"SELECT page_id, CASE WHEN url LIKE 'http://%' AND page_id % 2 = 0 THEN 'https' || substr(url, 5) ELSE url END AS aligned FROM pages")
def fn_align_scheme(spark, d):
    """Addresses found on a page of the same host that came by https (even ids), or on one of another host."""
    base = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://"), F.upper(fu.parts(F.col("url"))["netloc"]), F.lit("/"))).otherwise(F.lit("https://other.example/"))
    return table(spark, d, "pages").select("page_id", fu.align_scheme(F.col("url"), base).alias("aligned"))


@query("fn_best_title", """
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, url FROM pages),
k AS (SELECT *, trim(regexp_replace(split_part(path, '/', -1), '[_\\-]+', ' ', 'g')) AS name FROM p)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'A title' WHEN 1 THEN 'The plan ' || page_id ELSE CASE WHEN name = '' THEN url ELSE name END END AS title FROM k""")
def fn_best_title(spark, d):
    """A title of the page's own, an anchor that says something, one that doesn't, and none."""
    k = F.col("page_id") % 4
    meta = F.when(k == 0, "  A title ").when(k == 1, " ")
    anchor = F.when(k == 1, F.concat(F.lit("The \n plan "), F.col("page_id").cast("string"))).when(k == 2, "Download PDF:")
    return table(spark, d, "pages").select("page_id", fu.best_title(meta, anchor, F.col("url")).alias("title"))


@query("fil_redirect", f"SELECT page_id, page_id % 3 = 0 OR (page_id % 3 = 1 AND false) AS suspicious FROM pages")
def fil_redirect(spark, d):
    """Answers from a maintenance page, from elsewhere, and from the same address."""
    k = F.col("page_id") % 3
    got = F.when(k == 0, F.concat(F.lit("https://"), fu.parts(F.col("url"))["netloc"], F.lit("/under-maintenance?x"))).when(k == 1, F.concat(F.lit("https://h.example/"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", fu.suspicious_redirect(F.col("url"), got).alias("suspicious"))


@query("fn_delays", """
SELECT event_id, least(value * pow(2, event_id % 5), 100.0) AS backoff, greatest(0.0, CASE WHEN event_id % 2 = 0 THEN value ELSE 0 END, CASE WHEN event_id % 3 > 0 THEN 60.0 / (event_id % 3) ELSE 0 END) AS delay FROM events""")
def fn_delays(spark, d):
    k = F.col("event_id")
    declared, requests = F.when(k % 2 == 0, F.col("value")), F.when(k % 3 > 0, (k % 3).cast("double"))
    return table(spark, d, "events").select("event_id", fc.backoff(F.col("value"), k % 5, 100.0).alias("backoff"), fc.crawl_delay(declared, requests, F.lit(60.0)).alias("delay"))


@query("fn_retry_after", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN (event_id % 90)::DOUBLE WHEN 1 THEN greatest(0.0, (epoch(date_trunc('second', ts)) - 1704067200)::DOUBLE) END AS wait FROM events""")
def fn_retry_after(spark, d):
    """Seconds, a date in the header's format as seen on 1 January 2024, and words."""
    ts = F.col("ts").cast("timestamp")
    k = F.col("event_id") % 3
    value = F.when(k == 0, (F.col("event_id") % 90).cast("string")).when(k == 1, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).otherwise("soon")
    return table(spark, d, "events").select("event_id", fc.retry_after(value, F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("wait"))


@query("fn_stamps", """
SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') || 'T00:00:00Z' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS oai FROM events""")
def fn_stamps(spark, d):
    ts, k = F.col("ts").cast("timestamp"), F.col("event_id") % 3
    date = F.when(k == 0, F.date_format(ts, " yyyy-MM-dd")).when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, d, "events").select("event_id", fc.utc_stamp(ts).alias("stamp"), fc.oai_datetime(date).alias("oai"))


@query("fn_subjects", """
WITH s AS (SELECT p_partkey, list_filter(list_transform(regexp_split_to_array(p_name || '; ' || p_brand || ',, ' || p_type, '[;,]'), lambda x: trim(x)), lambda x: x <> '') AS s FROM part)
SELECT p_partkey, array_to_string(s[1:60], '|') AS subjects FROM s""")
def fn_subjects(spark, d):
    values = F.array(F.concat_ws("; ", "p_name", "p_brand"), F.lit(","), "p_type")
    return table(spark, d, "part").select("p_partkey", F.array_join(fc.split_subjects(values), "|").alias("subjects"))


@query("fn_squeezed", r"SELECT doc_id, nullif(left(trim(regexp_replace(text, '[\s\x0B\x85\xA0]+', ' ', 'g')), 4000), '') AS squeezed FROM documents")
def fn_squeezed(spark, d):
    return table(spark, d, "documents").select("doc_id", fc.squeezed(F.col("text")).alias("squeezed"))


@query("fn_scoring_body", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || chr(10) || p_brand || ' ' || p_type WHEN 1 THEN p_name ELSE p_brand || ' ' || p_type END AS body FROM part")
def fn_scoring_body(spark, d):
    k = F.col("p_partkey") % 3
    return table(spark, d, "part").select("p_partkey", fl.scoring_body(F.when(k != 2, F.col("p_name")), F.when(k != 1, F.array("p_brand", "p_type"))).alias("body"))


@query("so_domain_terms", "SELECT * FROM (VALUES ('strong', 0, 'tide table'), ('strong', 1, 'sea level'), ('moderate', 0, 'harbour'), ('moderate', 1, 'moon')) v(level, position, term)")
def so_domain_terms(spark, d):
    """Terms of the active domains, normalised, each once."""
    domains = {"a": {"ativo": True, "fortes": ["Tide Table", "tide  table"], "moderados": ["Harbour"]}, "b": {"ativo": False, "fortes": ["whale"]}, "c": {"fortes": ["Sea-level"], "moderados": ["harbour", "Moon"]}}
    rows = [(level, i, t) for level, terms in zip(("strong", "moderate"), fl.domain_terms(domains)) for i, t in enumerate(terms)]
    return spark.createDataFrame(rows, "level string, position int, term string")


@query("fil_sources", "SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT max(source) FROM documents) AND source > (SELECT min(source) FROM documents)")
def fil_sources(spark, d):
    """Sources by name: all but the first asked for, the last skipped."""
    names = [r[0] for r in table(spark, d, "documents").where("source IS NOT NULL").select("source").distinct().orderBy("source").collect()]
    return spark.createDataFrame([(n,) for n in sr.select_sources(names, names[1:], names[-1:])], "source string")


# ---------------------------------------------------------------- heads of pages


def _heads(spark, d) -> DataFrame:
    """Pages with a head of their own: tags of several kinds, links that aren't followed, a wrapper script."""
    k = F.col("page_id").cast("string")
    tag = lambda when, name, value: F.when(when, F.concat(F.lit(f'<meta name="{name}" content="'), value, F.lit('">'))).otherwise("")
    n = F.col("page_id")
    head = F.concat(
        F.lit("<html><head><title>Page "), k, F.lit("</title>"), tag(n % 2 == 0, "citation_title", F.concat(F.lit("Cited "), k)), tag(n % 3 == 0, "DC.title", F.concat(F.lit("Core "), k)), tag(n % 5 == 0, "og:title", F.concat(F.lit("Graph "), k)),
        tag(n % 2 == 0, "citation_author", F.lit("A")), tag(n % 4 == 0, "citation_author", F.lit("B")), tag(n % 3 == 0, "DC.creator", F.lit("C")), tag(n % 7 == 0, "citation_pdf_url", F.concat(F.lit("/f/"), k, F.lit(".pdf"))),
        tag(n % 2 == 1, "citation_keywords", F.lit("tide; table, sea")), tag(n % 2 == 0, "citation_doi", F.concat(F.lit("10.1/"), k)),
        F.when(n % 11 == 0, F.concat(F.lit('<script type="application/ld+json">{"name": "Linked '), k, F.lit('", "datePublished": "2020", "author": [{"name": "L"}, "M"]}</script>'))).otherwise(""), F.lit("</head><body>"),
        F.lit('<a href="mailto:x@y">mail</a><a href="javascript:void(0)">run</a><a href="#top">top</a><a href="{{ u }}">template</a><a href="https://h.example/a b.pdf">A file</a><a href="https://h.example/a%20b.pdf">Again</a>'), F.lit("</body></html>"))
    return table(spark, d, "pages").select("page_id", F.concat(F.lit("https://p.example/d/"), k).alias("url"), head.alias("html"))


@query("html_heads", """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'Cited ' || page_id WHEN page_id % 3 = 0 THEN 'Core ' || page_id WHEN page_id % 5 = 0 THEN 'Graph ' || page_id WHEN page_id % 11 = 0 THEN 'Linked ' || page_id ELSE 'Page ' || page_id END AS title,
  CASE WHEN page_id % 4 = 0 THEN 'A|B' WHEN page_id % 2 = 0 THEN 'A' WHEN page_id % 3 = 0 THEN 'C' WHEN page_id % 11 = 0 THEN 'L|M' ELSE '' END AS authors, CASE WHEN page_id % 7 = 0 THEN 'https://p.example/f/' || page_id || '.pdf' END AS pdf_url,
  CASE WHEN page_id % 2 = 1 THEN 'tide|table|sea' ELSE '' END AS subjects, CASE WHEN page_id % 2 = 0 THEN '10.1/' || page_id END AS doi, CASE WHEN page_id % 11 = 0 THEN '2020' END AS date FROM pages""")
def html_heads(spark, d):
    m = "meta."
    return fh.metadata(fh.extract(_heads(spark, d))).select("page_id", f"{m}title", F.array_join(f"{m}authors", "|").alias("authors"), f"{m}pdf_url", F.array_join(f"{m}subjects", "|").alias("subjects"), f"{m}doi", f"{m}date")


@query("html_followed", "SELECT page_id, 0::INTEGER AS pos, 'https://h.example/a%20b.pdf' AS url, 'A file' AS anchor, true AS is_document FROM pages")
def html_followed(spark, d):
    """Of six anchors one is followed: addresses of other kinds, fragments and templates are not, and a path counts once however it is written."""
    return links.exploded(fh.extract(_heads(spark, d)), "page_id").select("page_id", "pos", "url", "anchor", "is_document")


@query("html_wrapper", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://p.example/files/' || page_id || '.pdf' END AS pdf_url, CASE WHEN page_id % 2 = 1 THEN 'Other' END AS title FROM pages")
def html_wrapper(spark, d):
    """Download pages whose script leads to the file; their title says nothing and is no title."""
    k, even = F.col("page_id").cast("string"), F.col("page_id") % 2 == 0
    url = F.concat(F.when(even, F.lit("https://p.example/documents/downloadPublic?x=")).otherwise("https://p.example/q/"), k)
    page = F.concat(F.lit("<title>"), F.when(even, F.lit("Documents Download  Module")).otherwise("Other"), F.lit("</title><script>window.location = '/files/"), k, F.lit(".pdf'</script>"))
    return fh.metadata(fh.extract(table(spark, d, "pages").select("page_id", url.alias("url"), page.alias("html")))).select("page_id", "meta.pdf_url", "meta.title")


@query("jn_landing", """
WITH p AS (SELECT page_id, page_id % 3 AS documents FROM pages WHERE page_id % 3 > 0)
SELECT page_id * 10 + nth AS doc, CASE WHEN documents = 1 OR (page_id % 7 = 0 AND nth = 0) THEN 'Page ' || page_id END AS title, documents = 1 OR (page_id % 7 = 0 AND nth = 0) AS is_landing FROM p, LATERAL (SELECT unnest(range(documents)) AS nth)""")
def jn_landing(spark, d):
    """Documents with the title of the page they are linked on, where that names them or has no other document."""
    pages = table(spark, d, "pages").where("page_id % 3 > 0").select("page_id", F.concat(F.lit("https://p.example/"), F.col("page_id").cast("string")).alias("url"), (F.col("page_id") % 3).alias("documents"))
    name = lambda nth: F.concat(F.col("url"), F.lit("/"), nth.cast("string"), F.lit(".pdf"))
    meta = F.struct(F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"), F.when(F.col("page_id") % 7 == 0, F.concat(name(F.lit(0)), F.lit("?utm_source=x"))).alias("pdf_url"))
    docs = pages.select("page_id", F.col("url").alias("parent"), "url", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("documents") - 1)).alias("nth"))
    docs = docs.select((F.col("page_id") * 10 + F.col("nth")).alias("doc"), "parent", name(F.col("nth")).alias("url"))
    return links.describes(docs, pages.select("url", meta.alias("meta"), "documents")).select("doc", "meta.title", "is_landing")


@query("fn_unescape", """
SELECT p_partkey, p_name || ' <' || p_brand || '> é€😀 &bogus; & &amp; "' || p_type || '"' AS plain FROM part""")
def fn_unescape(spark, d):
    """Named, decimal and hexadecimal references, one that is none, and one that stands for an ampersand before a name."""
    escaped = F.concat("p_name", F.lit(" &lt;"), "p_brand", F.lit("&gt; &eacute;&#8364;&#x1F600; &bogus; & &amp;amp; &quot;"), "p_type", F.lit("&quot;"))
    return table(spark, d, "part").select("p_partkey", ft.unescape(escaped).alias("plain"))


# ---------------------------------------------------------------- sinks, read back


def _folder(spark) -> str:
    from uuid import uuid4

    from .crawl import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/sinks-{uuid4().hex}"


_INDEX = _TABLE_ORACLES["cl_index"]


@query("snk_index", _INDEX.split("SELECT doc_id, length(text) AS chars_before")[0] + r"""
 SELECT sha256(doc_id::VARCHAR) AS sha256, length(text)::BIGINT AS chars_before, length(clean_text)::BIGINT AS chars, n::BIGINT AS words, n >= 50 AND n * 1000 / greatest(c, 1) >= 30 AS legible, sha256(clean_text) AS text_sha256 FROM w""")
def snk_index(spark, d):
    """Cleaned texts and the lines of their index, written and read back."""
    from ..sources import sinks

    docs = table(spark, d, "documents").select(F.sha2(F.col("doc_id").cast("string"), 256).alias("sha256"), "source", F.col("doc_id").cast("string").alias("source_id"), F.lit("t").alias("title"), "text")
    folder = _folder(spark)
    sinks.write_texts(clean.text_index(docs), folder)
    index = sinks.read_json(spark, f"{folder}/index", sinks.INDEX)
    texts = sinks.read_contents(spark, f"{folder}/texts").select("sha256", F.sha2("clean_text", 256).alias("text_sha256"))
    return index.join(texts, "sha256").select("sha256", "chars_before", "chars", "words", "legible", "text_sha256")


@query("snk_bands", _TABLE_ORACLES["bd_bands"].split(" SELECT doc_id, words")[0] + " SELECT band, source, count(*) AS n FROM z GROUP BY band, source")
def snk_bands(spark, d):
    from ..sources import sinks
    from .queries import _banded

    banded = _banded(spark, d).withColumns({"sha256": F.sha2(F.col("doc_id").cast("string"), 256), "origin": F.lit("delivered")})
    return sinks.write_bands(banded, _folder(spark))


@query("snk_contents", f"WITH {_DOCS} SELECT DISTINCT sha256(customer::VARCHAR) AS sha256, substr(sha256(customer::VARCHAR), 1, 2) AS prefix FROM o")
def snk_contents(spark, d):
    """Customers as contents, put in two runs of which the second brings most of the first again."""
    from ..sources import sinks

    docs, folder = _docs(spark, d).select(F.sha2(F.col("customer").cast("string"), 256).alias("sha256"), "customer"), _folder(spark)
    sinks.put_contents(docs.where("customer % 3 > 0"), folder)
    sinks.put_contents(docs, folder)
    return spark.read.parquet(folder).select("sha256", F.lpad(F.col("prefix").cast("string"), 2, "0").alias("prefix"))


@query("snk_rejects", f"WITH {_DOCS} SELECT key, CASE WHEN customer % 2 = 0 THEN 'even' ELSE 'unknown' END AS reason FROM o WHERE status = 'failed'")
def snk_rejects(spark, d):
    from ..sources import sinks

    folder = _folder(spark)
    sinks.append_rejects(_docs(spark, d).where("status = 'failed'").select("key", F.when(F.col("customer") % 2 == 0, "even").alias("reason")), folder)
    return sinks.read_json(spark, folder, "key string, reason string")


@query("snk_metrics", f"""
WITH {_DOCS} SELECT (SELECT count(*) FROM o) AS documents, (SELECT count(DISTINCT customer) FROM o) AS unique_contents, (SELECT count(*) FROM o WHERE status = 'stored') AS stored, (SELECT count(*) FROM o WHERE source = 's1') AS s1""")
def snk_metrics(spark, d):
    """Numbers out of the report that is one JSON document."""
    docs = _docs(spark, d).withColumns({"tier": F.lit("weak"), "size_bytes": F.lit(1).cast("bigint"), "sha256": F.sha2(F.col("customer").cast("string"), 256)})
    r = report.totals_json(docs, docs).select(F.from_json("report", "documents bigint, unique_contents bigint, by_status map<string,bigint>, by_source map<string,bigint>").alias("r"))
    return r.select("r.documents", "r.unique_contents", F.col("r.by_status")["stored"].alias("stored"), F.col("r.by_source")["s1"].alias("s1"))
