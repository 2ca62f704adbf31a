"""Content columns: kinds by magic bytes, storage paths, delays and backoff, robots rules, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXTENSIONS = {"pdf": ".pdf", "html": ".html", "text": ".txt", "xml": ".xml", "json": ".json", "zip": ".zip", "ole": ".doc"}


def sniff_kind(body: Column, content_type: Column) -> Column:
    """What a body (binary) is: magic bytes, then structure, json only if it parses, then the declared type and valid UTF-8."""
    head = F.hex(F.substring(body, 1, 8))
    sample = F.decode(F.substring(body, 1, 4096), "ISO-8859-1")
    bare = F.regexp_replace(sample, r"^\s+", "")
    low = F.lower(F.substring(bare, 1, 512))
    ct = F.lower(F.coalesce(content_type, F.lit("")))
    # a cut may split the last character, which doesn't make the text another kind
    utf8 = F.coalesce(F.is_valid_utf8(body.cast("string")), F.lit(False))
    json = F.substring(bare, 1, 1).isin("{", "[") & utf8 & F.try_parse_json(body.cast("string")).isNotNull()
    return (F.when(head.startswith("255044462D"), "pdf").when(head.startswith("504B0304"), "zip").when(head.startswith("D0CF11E0A1B11AE1"), "ole")
            .when(low.contains("<html") | low.startswith("<!doctype html"), "html")
            .when(bare.startswith("<?xml") | (bare.startswith("<") & F.substring(bare, 1, 256).contains(">")), "xml")
            .when(json, "json").when(ct.contains("pdf"), "unknown").when(ct.startswith("text/") | utf8, "text").otherwise("unknown"))


def storage_path(sha256: Column, kind: Column, base: str = "raw") -> Column:
    """base/first two digits/sha.extension; .bin for kinds without one."""
    table = F.create_map(*[F.lit(x) for k, v in EXTENSIONS.items() for x in (k, v)])
    return F.concat(F.lit(f"{base}/"), F.substring(sha256, 1, 2), F.lit("/"), sha256, F.coalesce(F.try_element_at(table, kind), F.lit(".bin")))


def backoff(delay: Column, retries: Column, most: float) -> Column:
    """The delay doubled for every retry, up to a limit."""
    return F.least(delay * F.pow(F.lit(2.0), retries), F.lit(float(most)))


def crawl_delay(declared: Column, requests: Column, seconds: Column) -> Column:
    """The longer of a declared delay and the interval a request rate asks for; 0 without either."""
    return F.greatest(F.lit(0.0), F.coalesce(declared, F.lit(0.0)), F.coalesce(F.when(requests > 0, seconds / requests), F.lit(0.0)))


def retry_after(value: Column, now: Column) -> Column:
    """Seconds, or the time until an HTTP date (never below 0); null if neither."""
    date = F.try_to_timestamp(F.regexp_replace(value, "^[A-Za-z]{3}, ", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    return F.coalesce(value.try_cast("double"), F.when(date.isNotNull(), F.greatest(F.lit(0.0), date.cast("double") - now.cast("double"))))


def oai_datetime(date: Column) -> Column:
    """A bare date gets midnight, a time without a zone gets Z."""
    d = F.trim(date)
    return F.when(d.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(d, F.lit("T00:00:00Z"))).when(d.endswith("Z"), d).otherwise(F.concat(d, F.lit("Z")))


def utc_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def split_subjects(values: Column, most: int = 60) -> Column:
    """Subjects that stand in one field, at semicolons and commas."""
    return F.slice(F.filter(F.transform(F.flatten(F.transform(values, lambda v: F.split(v, "[;,]"))), lambda x: F.trim(x)), lambda x: x != ""), 1, most)


def squeezed(text: Column, most: int = 4000) -> Column:
    """White space collapsed, cut; null if nothing is left."""
    return F.nullif(F.left(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(most)), F.lit(""))
