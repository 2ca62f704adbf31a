"""Links and metadata of HTML pages, with the standard parser, in Arrow batches."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser
from urllib.parse import quote, urldefrag, urljoin, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import unused
from .urls import DOCUMENT_EXTENSIONS

_SKIPPED = re.compile(r"^(mailto:|javascript:|tel:|data:|ftp:|#)", re.I)
_TEMPLATE = re.compile(r"\{\{.*?\}\}|\{%.*?%\}|\$\{.*?\}|<%.*?%>|^\[[^\]]+\]$")
_BLOCKS = {"p", "li", "td", "div", "section"}
#: A start tag of the key closes an open element of the values, as browsers do for tags left open.
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "td": {"td", "p"}, "tr": {"td", "tr", "p"}, "div": {"p"}, "section": {"p"}, "ul": {"p"}, "table": {"p"}}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
_WRAPPER_TITLE = "documents download module"
LINKS = "array<struct<pos:int,url:string,anchor:string,context:string,is_document:boolean>>"
META = "map<string,array<string>>"


class Page(HTMLParser):
    """One pass over a page: anchors with their block's text, meta tags, title, scripts, base."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.base: str | None = None
        self.title: str | None = None
        self.metas: dict[str, list[str]] = {}
        self.anchors: list[dict] = []
        self.scripts: list[tuple[str, str]] = []
        self._open: list[tuple[str, dict | None, list[str]]] = []
        self._blocks: list[list[str]] = [[]]
        self._root = self._blocks[0]
        self.feed(html)
        self.close()
        while self._open:
            self._end()

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        while self._open and self._open[-1][0] in _CLOSES.get(tag, ()):
            self._end()
        if tag == "base" and "href" in a and self.base is None:
            self.base = a["href"]
        elif tag == "meta":
            name, content = (a.get("name") or a.get("property") or a.get("http-equiv") or "").strip().lower(), a.get("content", "").strip()
            if name and content:
                self.metas.setdefault(name, []).append(content)
        if tag in _VOID:
            return
        link = None
        if tag == "a" and "href" in a:
            link = {"href": a["href"].strip(), "title": a.get("title", "").strip(), "text": [], "block": self._blocks[-1]}
            self.anchors.append(link)
        if tag == "script":
            self.scripts.append((a.get("type", "").lower(), ""))
        self._open.append((tag, link, []))
        if tag in _BLOCKS:
            self._blocks.append([])
            for _, above, _ in self._open[:-1]:
                if above:
                    above["inner"] = True

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _end(self):
        tag, link, text = self._open.pop()
        if tag == "title" and self.title is None:
            self.title = "".join(text)
        if tag in _BLOCKS and len(self._blocks) > 1:
            own = self._blocks.pop()
            self._blocks[-1].extend(own)  # an outer block's text holds the inner's

    def handle_endtag(self, tag):
        if any(t == tag for t, _, _ in self._open):
            while self._open[-1][0] != tag:
                self._end()
            self._end()

    def handle_data(self, data):
        if self._open and self._open[-1][0] in ("script", "style"):
            if self._open[-1][0] == "script":
                kind, text = self.scripts[-1]
                self.scripts[-1] = (kind, text + data)
            return
        if self._open:
            self._open[-1][2].append(data)
        self._blocks[-1].append(data)
        for _, link, _ in self._open:
            if link:
                link["text"].append(data)


def _squeeze(parts) -> str:
    return " ".join(" ".join(parts).split())


def _aligned(url: str, base: str) -> str:
    u, b = urlsplit(url), urlsplit(base)
    return urlunsplit(("https", *u[1:])) if (u.scheme, b.scheme) == ("http", "https") and u.netloc.lower() == b.netloc.lower() else url


def quoted_path(url: str) -> str:
    """The path percent-encoded where needed; what is encoded already stays."""
    u = urlsplit(url)
    return f"{u.scheme}://{u.netloc}{quote(u.path, safe='/%:@&=+$,~()[]!*' + chr(39))}" + (f"?{u.query}" if u.query else "")


def _key(url: str) -> tuple:
    u = urlsplit(url)
    port = {"http": ":80", "https": ":443"}.get(u.scheme.lower(), "")
    netloc = u.netloc.lower()
    return u.scheme.lower(), netloc[: -len(port)] if port and netloc.endswith(port) else netloc, u.path.rstrip("/") or "/", u.query


def links_of(page: Page, url: str, extensions=DOCUMENT_EXTENSIONS) -> list[dict]:
    """Followable links in order, each canonical address once, with anchor text (or title) and the text around."""
    base = urljoin(url, page.base) if page.base else url
    seen, out = set(), []
    for a in page.anchors:
        href = a["href"]
        if not href or _SKIPPED.match(href) or _TEMPLATE.search(href):
            continue
        try:
            to = urldefrag(urljoin(base, href))[0]
            if not to.lower().startswith(("http://", "https://")):
                continue
            to = quoted_path(_aligned(to, base))
            key = _key(to)
            document = urlsplit(to).path.lower().endswith(tuple(extensions))
        except ValueError:
            continue  # a malformed address is no link
        if key not in seen:
            seen.add(key)
            out.append({"pos": len(out), "url": to, "anchor": (_squeeze(a["text"]) or a["title"])[:300], "context": _squeeze(a["block"])[:400], "is_document": document})
    return out


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", extensions=DOCUMENT_EXTENSIONS) -> DataFrame:
    """pages with `links`, `metas`, `page_title`, `json_ld` (array) and `js_target`; one parse a page, no shuffle. Null html is an empty page."""
    cols = pages.columns
    u, h = cols.index(url_col), cols.index(html_col)

    def parsed(batches):
        for b in batches:
            made = []
            for url, html in zip(b.column(u).to_pylist(), b.column(h).to_pylist()):
                page, url = Page(html or ""), url or ""
                target = None
                if "/documents/downloadpublic" in url.lower().split("?")[0]:
                    for _, text in page.scripts:
                        if m := re.search(r"window\.location\s*=\s*(['\"])([^'\"]+)\1", text):
                            target = urljoin(url, m[2])
                            break
                try:
                    links = links_of(page, url, extensions)
                except ValueError:
                    links = []
                made.append((links, list(page.metas.items()), page.title, [t for k, t in page.scripts if k == "application/ld+json"], target))
            kinds = (pa.list_(pa.struct([("pos", pa.int32()), ("url", pa.string()), ("anchor", pa.string()), ("context", pa.string()), ("is_document", pa.bool_())])),
                     pa.map_(pa.string(), pa.list_(pa.string())), pa.string(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)]], names=[*cols, "links", "metas", "page_title", "json_ld", "js_target"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema] + [f"links {LINKS}", f"metas {META}", "page_title string", "json_ld array<string>", "js_target string"])
    return pages.mapInArrow(parsed, schema)


def _first(metas: Column, *keys: str) -> Column:
    return F.coalesce(*[F.try_element_at(F.try_element_at(metas, F.lit(k)), F.lit(1)) for k in keys])


def _all(metas: Column, *keys: str) -> Column:
    empty = F.array().cast("array<string>")
    return F.flatten(F.array(*[F.coalesce(F.try_element_at(metas, F.lit(k)), empty) for k in keys]))


def _or_all(a: Column, b: Column) -> Column:
    return F.when(F.size(a) > 0, a).otherwise(b)


def metadata(parsed: DataFrame, url_col: str = "url") -> DataFrame:
    """parsed (from `extract`) with a struct `meta`: title, authors, abstract, date, publisher, doi, subjects, pdf_url.

    In the order of citation tags, Dublin Core, Open Graph, JSON-LD and the page's title.
    """
    from .content import split_subjects

    m, nodes = F.col("metas"), unused(parsed, "nodes")
    node = F.expr("filter(transform(flatten(transform(json_ld, x -> coalesce(from_json(if(ltrim(x) like '{%', concat('[', x, ']'), x), 'array<struct<name:string,headline:string,description:string,abstract:string,datePublished:string,dateCreated:string,author:string>>'), array()))), x -> x), x -> x is not null)")
    present = lambda k: F.filter(F.transform(F.col(nodes), lambda n: F.nullif(F.trim(F.regexp_replace(n[k], r"\s+", " ")), F.lit(""))), lambda x: x.isNotNull())
    ld = lambda *ks: F.coalesce(*[F.try_element_at(present(k), F.lit(1)) for k in ks])
    df = parsed.withColumn(nodes, node)
    title = F.coalesce(_first(m, "citation_title"), _first(m, "dc.title", "dcterms.title"), _first(m, "og:title"))
    abstract = F.coalesce(_first(m, "citation_abstract"), _first(m, "dcterms.abstract", "dc.description"), _first(m, "og:description", "description"), ld("description", "abstract"))
    bare = F.trim(F.regexp_replace(F.col("page_title"), r"\s+", " "))
    last = F.when(F.lower(bare) != _WRAPPER_TITLE, F.nullif(F.left(bare, F.lit(400)), F.lit("")))
    pdf = _first(m, "citation_pdf_url", "citation_fulltext_html_url")
    base = F.regexp_extract(F.col(url_col), r"^([A-Za-z]+://[^/?#]*)", 1)
    folder = F.regexp_extract(F.col(url_col), r"^([A-Za-z]+://[^?#]*/)", 1)
    whole = F.when(pdf.rlike("^[A-Za-z]+://"), pdf).when(pdf.startswith("//"), F.concat(F.lit("https:"), pdf)).when(pdf.startswith("/"), F.concat(base, pdf)).otherwise(F.concat(folder, pdf))
    authors = _or_all(_all(m, "citation_author"), _all(m, "dc.creator", "dc.contributor"))
    # one author or several, each a name or an object with one
    listed = lambda a: F.when(a.startswith("["), F.from_json(a, "array<string>")).otherwise(F.array(a))
    author_ld = F.filter(F.transform(listed(ld("author")), lambda a: F.when(a.startswith("{"), F.get_json_object(a, "$.name")).otherwise(a)), lambda a: a.isNotNull())
    authors = F.when(F.size(authors) > 0, authors).otherwise(F.coalesce(author_ld, F.array().cast("array<string>")))
    meta = F.struct(
        F.coalesce(title, ld("name", "headline"), last).alias("title"),
        F.slice(F.filter(F.transform(authors, lambda x: F.trim(x)), lambda x: x != ""), 1, 60).alias("authors"),
        F.left(abstract, F.lit(4000)).alias("abstract"),
        F.coalesce(_first(m, "citation_publication_date", "citation_date", "citation_online_date"), _first(m, "dc.date", "dcterms.issued", "dcterms.created"), ld("datePublished", "dateCreated")).alias("date"),
        F.coalesce(_first(m, "citation_publisher", "citation_journal_title"), _first(m, "dc.publisher")).alias("publisher"),
        F.coalesce(_first(m, "citation_doi"), _first(m, "dc.identifier.doi")).alias("doi"),
        split_subjects(_or_all(_all(m, "citation_keywords"), _all(m, "dc.subject"))).alias("subjects"),
        F.coalesce(whole, F.col("js_target")).alias("pdf_url"))
    return df.withColumn("meta", meta).drop(nodes)
