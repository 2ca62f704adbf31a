"""The adapters' contract: what to ask a source for, how its captured answers are read, and which records they hold.

An adapter gives records and nothing else: it doesn't download, score or decide. Answers are captured by whatever talks
to the network, as files below one folder a source; reading them back is an ordinary scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import records as sr


@dataclass(frozen=True)
class Adapter:
    """name; requests(terms) to (term, url), one row a call; read(spark, path) of captured answers; records(answers)."""

    name: str
    requests: Callable[[DataFrame], DataFrame]
    read: Callable[[SparkSession, str], DataFrame]
    records: Callable[[DataFrame], DataFrame]

    def discover(self, spark: SparkSession, path: str) -> DataFrame:
        """The records of the answers captured under path."""
        return self.records(self.read(spark, path))


def _paged(url: str, size: int, window: int = 10_000, first: int = 0) -> Callable[[DataFrame], DataFrame]:
    """Calls of a search with a total (term, total): `url` with the quoted phrase, the size and the offset put in."""

    def requests(terms: DataFrame) -> DataFrame:
        phrase = F.url_encode(F.concat(F.lit('"'), "term", F.lit('"')))
        at = F.replace(F.replace(F.lit(url), F.lit("@phrase"), phrase), F.lit("@from"), (F.col("offset") + first).cast("string"))
        return sr.page_offsets(terms, size=size, window=window).select("term", at.alias("url"))

    return requests


def _xml(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "xml")


NTRS = Adapter("ntrs", _paged("https://ntrs.nasa.gov/api/citations/search?q=@phrase&page.size=100&page.from=@from", 100), lambda spark, path: sr.read_payloads(spark, path, sr.NTRS), lambda answers: sr.ntrs_records(sr.hits(answers)))
CORE = Adapter("core", _paged("https://api.core.ac.uk/v3/search/works?q=@phrase&limit=100&offset=@from", 100), lambda spark, path: sr.read_payloads(spark, path, sr.CORE), lambda answers: sr.core_records(sr.hits(answers)))
ROSAP = Adapter("rosap", lambda terms: terms.select("term", F.lit("https://rosap.ntl.bts.gov/oai?verb=ListRecords&metadataPrefix=oai_dc").alias("url")).limit(1), _xml, lambda answers: sr.oai_records(sr.oai_payload_records(answers)))
ADAPTERS = {a.name: a for a in (NTRS, CORE, ROSAP)}


def parse_env(text: str) -> dict[str, str]:
    """NAME=value lines of a .env file: comments and blank lines aside, `export` and a pair of quotes dropped."""
    out = {}
    for line in text.splitlines():
        name, eq, value = line.strip().removeprefix("export ").partition("=")
        if not eq or name.strip().startswith("#") or not name.strip():
            continue
        value = value.strip()
        if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
            value = value[1:-1]
        else:
            value = value.split(" #")[0].rstrip()
        out[name.strip()] = value
    return out


def environment(text: str, process: dict[str, str]) -> dict[str, str]:
    """What ${NAME} is taken from: the process' own values win over those of the file."""
    return parse_env(text) | process
