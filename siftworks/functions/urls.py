"""Url algebra as columns: parts, canonical forms, traps, noise, hosts and paths in scope, titles from urls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"

#: Parameters that don't change what a page holds, by what they are for.
TRACKING = frozenset(
    [f"utm_{x}" for x in ("campaign", "content", "medium", "source", "term")] + [f"mc_{x}" for x in ("cid", "eid")]
    + "fbclid gclid msclkid".split() + "jsessionid phpsessid session_id sessionid sid".split() + "redirect ref referrer return_url returnurl".split() + "display output print".split())
#: Parameters of sorting, layout, dates and filters.
FACETS = frozenset("dir order orderby sort sort_by sortby".split() + "layout mode theme view".split() + "calendar date day month week year".split() + "facet filter refine".split())
#: Path words of administrative pages.
NOISE = tuple(sorted("accessibility archive author calendar careers cart category comment contact feed login newsroom press-release print privacy register rss search share signin sitemap tag".split()))
DOCUMENT_EXTENSIONS = (".pdf", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx")
GENERIC_ANCHORS = frozenset("acessar anexo attachment baixar document download fulltext file here link more open pdf view".split()) | {"click here", "download pdf", "full text", "get pdf", "read more", "view pdf"}


def _any(tests) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def parts(url: Column) -> dict[str, Column]:
    """scheme, netloc, path, query of any string; a missing part is empty. Never fails on malformed urls."""
    return {name: F.regexp_extract(url, _URL, i) for i, name in enumerate(("scheme", "netloc", "path", "query"), 1)}


def host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_extract(parts(url)["netloc"], r"^(?:[^@]*@)?([^:]*)", 1))


def canonical_url(url: Column) -> Column:
    """Scheme (https if none) and host in lower case, no default port, no trailing slash but the root's, no fragment; the query stays."""
    p = parts(F.trim(url))
    scheme = F.coalesce(F.nullif(F.lower(p["scheme"]), F.lit("")), F.lit("https"))
    netloc = F.lower(p["netloc"])
    netloc = F.when(scheme == "https", F.regexp_replace(netloc, ":443$", "")).when(scheme == "http", F.regexp_replace(netloc, ":80$", "")).otherwise(netloc)
    path = F.coalesce(F.nullif(F.regexp_replace(p["path"], "/+$", ""), F.lit("")), F.lit("/"))
    return F.concat(scheme, F.lit("://"), netloc, path, F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(F.lit("")))


def query_pairs(url: Column) -> Column:
    """array<struct<k, v>> of the query, decoded; pairs without a name and value are no pairs."""
    decode = lambda c: F.coalesce(F.try_url_decode(c), c)
    raw = F.filter(F.split(parts(url)["query"], "&"), lambda x: x != "")
    return F.transform(raw, lambda x: F.struct(decode(F.split(x, "=", 2)[0]).alias("k"), F.coalesce(decode(F.get(F.split(x, "=", 2), F.lit(1))), F.lit("")).alias("v")))


def canonicalize(url: Column, drop_facets: bool = False) -> Column:
    """For deduplication: tracking (and facet) parameters dropped, the others sorted and encoded anew, no trailing slash, no fragment."""
    p = parts(url)
    dropped = F.array(*[F.lit(x) for x in sorted(TRACKING | (FACETS if drop_facets else frozenset()))])
    kept = F.array_sort(F.filter(query_pairs(url), lambda x: ~F.array_contains(dropped, F.lower(x["k"]))))
    query = F.array_join(F.transform(kept, lambda x: F.concat(F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "&")
    path = F.coalesce(F.nullif(F.regexp_replace(p["path"], "/+$", ""), F.lit("")), F.lit("/"))
    scheme = F.when(p["scheme"] != "", F.concat(F.lower(p["scheme"]), F.lit("://"))).otherwise(F.lit(""))
    return F.concat(scheme, F.lower(p["netloc"]), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def segments(url: Column) -> Column:
    return F.filter(F.split(parts(url)["path"], "/"), lambda x: x != "")


def most_common_segment(segs: Column) -> Column:
    """struct<n, s>: the segment that stands most often, the first of equals."""
    return let(segs, lambda a: F.array_max(F.transform(a, lambda s, i: F.struct(F.size(F.filter(a, lambda x: x == s)).alias("n"), (-i).alias("i"), s.alias("s")))))


def trap_reason(url: Column, most_repeats: int = 3, most_segments: int = 12, most_params: int = 6) -> Column:
    """Why a url looks like a crawler trap: depth, repeats, parameters, facets, calendar, in this order; null if it doesn't."""
    segs, pairs = segments(url), query_pairs(url)
    keys = F.array_distinct(F.transform(pairs, lambda x: F.lower(x["k"])))
    facets = F.array(*[F.lit(x) for x in sorted(FACETS)])
    dated = F.exists(pairs, lambda x: (F.lower(x["k"]).isin("day", "month", "week") & (x["v"] != "")) | ((F.lower(x["k"]) == "year") & x["v"].rlike(r"^(19|20)\d{2}$")))
    return (F.when(F.size(segs) > most_segments, "depth").when(most_common_segment(segs)["n"] > most_repeats, "repeats")
            .when(F.size(pairs) > most_params, "parameters").when(F.size(F.array_intersect(keys, facets)) >= 2, "facets").when(dated, "calendar"))


def url_text(url: Column) -> Column:
    """Path and query as words."""
    p = parts(url)
    decode = lambda c: F.coalesce(F.try_url_decode(c), c)
    return F.trim(F.regexp_replace(F.lower(F.concat_ws(" ", decode(p["path"]), decode(p["query"]))), "[^a-z0-9]+", " "))


def is_noise(url: Column, noise=NOISE) -> Column:
    """Whether the words of the path, in order, hold an administrative word, also inside a longer one."""
    words = F.trim(F.regexp_replace(F.lower(parts(url)["path"]), "[^a-z0-9]+", " "))
    return _any([words.contains(x.replace("-", " ")) for x in noise])


def host_matches(host_col: Column, hosts) -> Column:
    """A host, or any host below it, is in the list."""
    return _any([(host_col == h.lower()) | host_col.endswith("." + h.lower()) for h in hosts])


def path_allowed(path: Column, allow=(), deny=()) -> Column:
    """No deny pattern is found in the path, and an allow pattern is, if there are any; case doesn't matter."""
    found = lambda ps: _any([path.rlike(f"(?i){p}") for p in ps])
    return ~found(deny) & (found(allow) if allow else F.lit(True))


def in_scope(url: Column, allow_hosts=(), block_hosts=(), allow_paths=(), deny_paths=()) -> Column:
    h, p = host(url), parts(url)
    return (F.lower(p["scheme"]).isin("http", "https") & ~host_matches(h, block_hosts) & (host_matches(h, allow_hosts) if allow_hosts else F.lit(True))
            & path_allowed(p["path"], allow_paths, deny_paths))


def is_document(url: Column, extensions=DOCUMENT_EXTENSIONS, patterns=()) -> Column:
    """By the extension of the path, or by a pattern anywhere in the url."""
    path = F.lower(parts(url)["path"])
    return _any([path.endswith(e) for e in extensions] + [url.rlike(f"(?i){p}") for p in patterns])


def suspicious_redirect(asked: Column, got: Column) -> Column:
    """The path or host changed and the final path is a page of maintenance or error."""
    a, g = parts(asked), parts(got)
    bare = lambda p: F.regexp_replace(p["path"], "/+$", "")
    moved = (bare(a) != bare(g)) | (F.lower(a["netloc"]) != F.lower(g["netloc"]))
    return moved & g["path"].rlike(r"(?i)/landingpage/maint|/under-?maintenance|/site-unavailable|/error(page)?\.html?$")


def align_scheme(url: Column, base: Column) -> Column:
    """http becomes https where the page itself came by https from the same host."""
    u, b = parts(url), parts(base)
    same = (u["scheme"] == "http") & (b["scheme"] == "https") & (F.lower(u["netloc"]) == F.lower(b["netloc"]))
    return F.when(same, F.regexp_replace(url, "^http:", "https:")).otherwise(url)


def file_title(url: Column) -> Column:
    """The file's name as a title: decoded, without its extension, marks as spaces."""
    name = F.element_at(F.split(parts(url)["path"], "/"), -1)
    name = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    bare = F.regexp_replace(name, r"(?i)\.(pdf|docx?|pptx?|xlsx?)$", "")
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(bare, r"[_\-]+", " ")), F.lit("")), url)


def best_title(meta_title: Column, anchor: Column, url: Column) -> Column:
    """The page's title, else an anchor that says something, else the file's name."""
    clean = F.trim(F.regexp_replace(anchor, r"\s+", " "))
    bare = F.regexp_replace(F.lower(clean), r"^[ .:\-]+|[ .:\-]+$", "")
    says = ~F.lower(clean).rlike("^(https?://|www\\.)") & ~bare.isin(*sorted(GENERIC_ANCHORS)) & (F.length(clean) > 3)
    return F.coalesce(F.nullif(F.trim(meta_title), F.lit("")), F.when(says, clean), file_title(url))


def sitemap_locations(robots: Column) -> Column:
    """Sitemap lines of a robots.txt, in order."""
    rows = F.filter(F.transform(F.split(F.coalesce(robots, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: F.lower(x).startswith("sitemap:"))
    return F.filter(F.transform(rows, lambda x: F.trim(F.substring(x, 9, 1 << 20))), lambda x: x != "")
