"""Text columns: normalisation, phrase tests and counts, word counts, legibility, titles of sections."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What ends a line: \n, \r\n, \r and the other breaks of Unicode-aware line splitting.
LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"


def fold(text: str | None) -> str:
    """The plain-Python statement of `normalize_text`, for terms and for tests."""
    flat = "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c)).lower()
    return re.sub("[^a-z0-9]+", " ", flat).strip()


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, str, dict[str, str]]:
    """Characters that fold to one character (from, to), to none, and to several."""
    one, to, none, several = [], [], [], {}
    for i in range(128, 0x10000):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        flat = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
        kept = re.sub("[^a-z0-9]", " ", flat)
        if not flat:
            none.append(c)
        elif kept.strip():
            if len(kept) == 1:
                one.append(c)
                to.append(kept)
            else:
                several[c] = kept
    return "".join(one), "".join(to), "".join(none), several


def _ranges(chars) -> list[tuple[int, int]]:
    """A few ranges that cover all chars; a long class of single characters would be searched one by one for every character."""
    out: list[list[int]] = []
    for i in sorted(map(ord, chars)):
        if out and i - out[-1][1] < (4 if i < 0x500 else 0x1000):
            out[-1][1] = i
        else:
            out.append([i, i])
    return [(a, b) for a, b in out]


def normalize_text(text: Column, keep: str = "") -> Column:
    """Compatibility-decomposed, without accents, lower case, each run of other characters one space; null is empty.

    `keep` (written for a character class) names further characters that stay, such as a line break between lines.

    ASCII text, the bulk, skips the folding; characters that fold to several are looked up only where there are any.
    """
    text = F.coalesce(text, F.lit(""))
    one, to, none, several = _folds()
    single = F.translate(text, one + none, to)
    class_ = "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _ranges(several)) + "]"
    table = lookup(several)
    many = F.array_join(F.transform(F.split(single, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")
    flat = F.when(text.rlike("^[\\x00-\\x7f]*$"), text).otherwise(F.when(text.rlike(class_), many).otherwise(single))
    return F.trim(F.regexp_replace(F.lower(flat), f"[^a-z0-9{keep}]+", " "))


def lookup(table: dict[str, str]) -> Column:
    """A map column of constants: one literal, which is parsed when the plan is made, in place of one for each key and value."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def let(value: Column, use) -> Column:
    """use(value), with value computed once a row: inside a lambda a derived column would be computed anew for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unused(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have, for a column of ours beside a caller's."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (stem, *(f"{stem}_{i}" for i in range(len(taken) + 1))) if n.lower() not in taken)


def padded(normalized: Column) -> Column:
    return F.concat(F.lit(" "), normalized, F.lit(" "))


def has_phrase(padded_text: Column, term: str) -> Column:
    """Whether a normalised text holds a phrase as whole words. A plain literal test: it stays in generated code."""
    return padded_text.contains(f" {term} ")


def count_phrase(padded_text: Column, term: str) -> Column:
    """Occurrences that don't overlap; neighbours share a space, so of "a a a" two count."""
    p = f" {term} "
    return ((F.length(padded_text) - F.length(F.replace(padded_text, F.lit(p), F.lit("")))) / len(p)).cast("int")


def word_count(text: Column) -> Column:
    """Runs of three or more ASCII letters."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[A-Za-z]{3,}"))


def density(text: Column) -> Column:
    """Words for every thousand characters of content: white space, bars and hyphens aside."""
    content = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s|\-]", ""))
    return word_count(text) * 1000 / F.greatest(content, F.lit(1))


def legible(text: Column, least_words: int = 50, least_density: float = 30.0) -> Column:
    """Enough words, dense enough. least_words=0 is the rule right after extraction."""
    return (word_count(text) >= least_words) & (density(text) >= least_density)


def lines(text: Column) -> Column:
    """Lines as Unicode-aware splitting gives them: a break at the end adds no empty line."""
    parts = F.split(F.coalesce(text, F.lit("")), LINE_BREAK)
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def section_titles(text: Column) -> Column:
    """Normalised headings: lines that start with # or are shorter than 80, without marks and numbering."""
    heads = F.filter(lines(text), lambda x: x.startswith("#") | (F.length(x) < 80))
    bare = F.transform(heads, lambda x: F.regexp_replace(F.regexp_replace(x, "^#+", ""), r"^[\s\d.]+", ""))
    # all headings as one text: inside a lambda the normalisation would be written, and run, once for each of its branches
    # (F.trim by itself would take the element's position for the characters to trim)
    return F.filter(F.transform(F.split(normalize_text(F.array_join(bare, "\n"), "\\n"), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def strip_markup(html: Column) -> Column:
    """Tags become line breaks, character references what they stand for."""
    return unescape(F.regexp_replace(html, "<[^>]+>", "\n"))


def only_references(text: Column, *names: str) -> Column:
    """Ampersands that begin none of the named references (`lt;`, or `amp` for one with or without its semicolon) escaped, so that no others are resolved after."""
    return F.regexp_replace(text, f"&(?!{'|'.join(names)})", "&amp;")


#: Names of references are dealt to so many small maps by their CRC-32: looking one up in a map is a walk along its keys.
_BUCKETS = 4096


@lru_cache(maxsize=1)
def _references() -> tuple[str, str]:
    """References by name as a JSON array of maps, one a bucket; and a pattern of the old names, which need no semicolon, longest first."""
    from html.entities import html5

    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for k, v in html5.items():
        buckets[zlib.crc32(k.encode()) % _BUCKETS][k] = v
    return json.dumps(buckets), "|".join(sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True))


def unescape(text: Column) -> Column:
    """Named, decimal and hexadecimal character references resolved as browsers do, once and from left to right; what is none stays.

    Text without an ampersand, the bulk, is passed on. Else it is cut at its ampersands, and each part is looked up alone.
    """
    buckets, old = _references()
    table = F.from_json(F.lit(buckets), "array<map<string,string>>")

    def named(name: Column) -> Column:
        return F.try_element_at(F.get(table, F.crc32(name.cast("binary")) % _BUCKETS), name)

    def numbered(name: Column) -> Column:
        digits = F.regexp_replace(name, "^#[xX]?|;$", "")
        code = F.when(F.length(F.ltrim(F.lit("0"), digits)) > 8, F.lit(0x110000)).when(name.rlike("^#[xX]"), F.conv(digits, 16, 10).cast("bigint")).otherwise(digits.cast("bigint"))
        return let(F.least(code, F.lit(0x110000)).cast("int"), lambda c: _character(c))

    def one(part: Column) -> Column:
        after = lambda name: F.substring(part, F.length(name) + 1, F.length(part))
        unended = let(F.regexp_extract(part, f"^({old})", 1), lambda name: F.when(name == "", F.concat(F.lit("&"), part)).otherwise(F.concat(named(name), after(name))))
        resolved = lambda name: F.when(name == "", unended).when(name.startswith("#"), F.concat(numbered(name), after(name))).otherwise(F.coalesce(F.concat(named(name), after(name)), unended))
        return let(F.regexp_extract(part, r"^(#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]{0,30};)", 1), resolved)

    whole = let(F.split(text, "&"), lambda p: F.concat(F.get(p, F.lit(0)), F.array_join(F.transform(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda x: one(x)), "")))
    return F.when(text.contains("&"), whole).otherwise(text)


def _character(code: Column) -> Column:
    """The character of a numeric reference: of Windows' code page from 128 to 159, none for controls and non-characters, U+FFFD for what is no character at all."""
    byte = lambda at: F.shiftright(code, at).bitwiseAND(0x3F) + 0x80
    utf8 = (F.when(code < 0x80, code).when(code < 0x800, (F.shiftright(code, 6) + 0xC0) * 0x100 + byte(0)).when(code < 0x10000, (F.shiftright(code, 12) + 0xE0) * 0x10000 + byte(6) * 0x100 + byte(0))
            .otherwise((F.shiftright(code, 18) + 0xF0).cast("bigint") * 0x1000000 + byte(12) * 0x10000 + byte(6) * 0x100 + byte(0)))
    windows = F.array(*[F.lit(bytes([i]).decode("cp1252", "replace").replace("\ufffd", chr(i))) for i in range(128, 160)])
    none = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    broken = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    return F.when(broken, F.lit("\ufffd")).when(code.between(128, 159), F.get(windows, code - 128)).when(none, F.lit("")).otherwise(F.decode(F.unhex(F.hex(utf8)), "UTF-8"))
