"""Operator 2: URL filters by a Bloom filter cascade, DataFrame functions only.

A rule is a host (with all its subdomains) and a path prefix. Every url gives the keys it could be listed under: each
label suffix of its host joined with each prefix of its path that is as long as some rule's path. The distinct keys of
the whole corpus are the cascade's universe. Level 1 encodes the listed keys; level 2 the keys of the universe that
level 1 lets through though they aren't listed; level 3 the listed keys that level 2 lets through; and so on until a
level lets nothing wrong through. A key of the universe is listed if the first level that refuses it is an even one,
exactly. One cascade holds the blocking rules, one the allowing; a url takes the verdict of its longest listed key, and
`otherwise` if it has none. Judging needs no join: the levels are arrays of 64-bit words inside the plan, about 1.5 bits
a listed key for each halving of the universe. Rules are given as a list on the driver, and a level's words are far
smaller than the list that they stand for, so whatever list the driver can hold the plan can hold.

Null urls, and urls without ://, have an empty host and path and get `otherwise`. Only A-Z of the host are lower-cased.
Repeated rows and a null page_id are passed on. Empty table: no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, documents, materialize

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
WORD = 64


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: after the first ://, up to / ? # or the end; then up to ? or #."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER), path


@dataclass
class Rules:
    """Rules as (verdict, host/path) pairs, normalised: a host without a leading dot, a path with its slash."""

    pairs: tuple[tuple[str, str], ...]
    labels: list[int] = field(init=False)
    lengths: list[int] = field(init=False)

    def __post_init__(self):
        split = [r.partition("/") for _, r in self.pairs]
        self.labels = sorted({h.count(".") + 1 for h, _, _ in split})
        self.lengths = sorted({len(s + p) for _, s, p in split})

    def listed(self, verdict: str) -> list[str]:
        return sorted({r for v, r in self.pairs if v == verdict})

    def keys(self, host: Column, path: Column) -> Column:
        """All keys a url could be listed under: array<string>."""
        parts = F.split(host, r"\.")
        hosts = [F.when(F.size(parts) >= n, F.concat_ws(".", F.slice(parts, -n, n)) if n > 1 else F.element_at(parts, -1)) for n in self.labels]
        paths = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in self.lengths]
        return F.array_compact(F.array(*[F.concat(h, p) for h in hosts for p in paths]))


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


@dataclass
class Level:
    bits: int
    hashes: int
    words: list[int]

    def holds(self, key: Column, number: int) -> Column:
        # one literal text, which Catalyst folds into an array once, in place of a literal for each word
        words = F.from_json(F.lit(str(self.words)), "array<bigint>")
        return F.expr("true") if not self.bits else _all([F.getbit(F.element_at(words, (at / WORD).cast("int") + 1), F.pmod(at, F.lit(WORD)).cast("int")) == 1 for at in _positions(key, number, self.bits, self.hashes)])


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """A filter of keys.key with about `rate` false positives, built where the keys are; only its words come to the driver."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(WORD, -(-int(count * hashes / math.log(2)) // WORD) * WORD)
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("at"))
    found = at.groupBy((F.col("at") / WORD).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(at, 64) as int))")).alias("w")).collect()
    words = [0] * (bits // WORD)
    for r in found:
        words[r["word"]] = r["w"]
    return Level(bits, hashes, words)


@dataclass
class Cascade:
    levels: list[Level]

    def member(self, key: Column) -> Column:
        """Exact for keys of the universe it was built over."""
        out = F.lit(len(self.levels) % 2 == 1)
        for number, x in reversed(list(enumerate(self.levels, 1))):
            out = F.when(~x.holds(key, number), F.lit(number % 2 == 0)).otherwise(out)
        return out


def build_cascade(universe: DataFrame, listed: DataFrame, n_universe: int) -> Cascade:
    """A cascade over universe.key that encodes listed.key; keys listed but absent from the universe take part as well."""
    listed = materialize(listed.select("key").distinct())
    n = listed.count()
    if not n:
        return Cascade([])
    levels = [_level(listed, 1, n, min(0.5, n / math.sqrt(2) / max(n_universe, 1)))]
    # the only pass over the universe; what is wrong after it is about as small as the list
    wrong = materialize(universe.where(levels[0].holds(F.col("key"), 1)).join(listed, "key", "left_anti"))
    right, left = listed, wrong.count()
    while left:
        levels.append(_level(wrong, len(levels) + 1, left, 0.5))
        right, wrong = wrong, materialize(right.where(levels[-1].holds(F.col("key"), len(levels))))
        left = wrong.count()
        if len(levels) > 200:
            raise RuntimeError("the cascade doesn't end; two keys collide at every level")
    return Cascade(levels)


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """(id_col, host, path, rule, verdict), one row per row of pages."""
    ruled = Rules(tuple(rules))
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    split = documents(pages, id_col, url_col).toDF("id", "url").select("id", host.alias("host"), path.alias("path"))
    keys = ruled.keys(F.col("host"), F.col("path"))
    universe = materialize(split.select(F.explode(keys).alias("key")).distinct())
    n = universe.count()
    lists = {v: spark.createDataFrame([(r,) for r in ruled.listed(v)], "key string") for v in ("block", "allow")}
    cascades = {v: build_cascade(universe, k, n) for v, k in lists.items()}
    judged = split
    for v in ("block", "allow"):
        judged = judged.withColumn(v, F.filter(keys, cascades[v].member))
    # of two listed keys the longer is the narrower rule; ties can't be: both would be the same host suffix and path
    best = lambda name: F.array_max(F.transform(F.col(name), lambda k: F.struct(F.length(k).alias("n"), k.alias("k"), F.lit(name).alias("v"))))
    judged = judged.withColumn("best", F.greatest(best("block"), best("allow")))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("best.k").alias("rule"), F.coalesce("best.v", F.lit(otherwise)).alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, rule, h, pre) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
m AS (
  SELECT s.page_id, s.host, s.path, r.rule, r.verdict, row_number() OVER (PARTITION BY s.page_id, s.host, s.path ORDER BY length(r.rule) DESC) AS k
  FROM s LEFT JOIN r ON (s.host = r.h OR s.host LIKE '%.' || r.h) AND starts_with(s.path, r.pre))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
