"""Sinks: manifests, reject logs, cleaned texts and bands as JSON lines, contents by their hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX = "sha256 string, source string, source_id string, title string, origin string, chars_before bigint, chars bigint, words bigint, legible boolean"
BAND = "sha256 string, source string, title string, origin string, words bigint, band string, concept_note double, domain_note double, concept_terms array<string>, sections array<string>, domain_terms array<string>"
EXTRACTION = "sha256 string, source string, source_id string, ocr boolean, pages bigint, chars bigint, legible boolean, error string, seconds double"


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_rejects(df: DataFrame, path: str, reason: str = "reason") -> None:
    df.withColumn(reason, F.coalesce(reason, F.lit("unknown"))).write.mode("append").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def put_contents(df: DataFrame, path: str, sha: str = "sha256") -> None:
    """Contents under path by the first two digits of their hash, each once; what is there already is left out.

    Two runs at once may both write a content that neither found; `read_contents` gives it once.
    """
    spark = df.sparkSession
    once = df.dropDuplicates([sha]).withColumn("prefix", F.substring(sha, 1, 2))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        once = once.join(spark.read.parquet(path).select(sha), sha, "left_anti")
    once.write.mode("append").partitionBy("prefix").parquet(path)


def read_contents(spark: SparkSession, path: str, sha: str = "sha256") -> DataFrame:
    return spark.read.parquet(path).drop("prefix").dropDuplicates([sha])


def _columns(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.split(", ")]


def write_texts(texts: DataFrame, root: str) -> None:
    """Cleaned texts by their hash under root/texts, and a line for each in root/index. texts: the columns of INDEX and clean_text."""
    put_contents(texts.select("sha256", "clean_text"), f"{root}/texts")
    texts.select(*_columns(INDEX)).write.mode("overwrite").json(f"{root}/index")


def write_bands(banded: DataFrame, root: str) -> DataFrame:
    """A line for each text in root/bands, by band; gives the numbers of texts by band and source."""
    banded.select(*_columns(BAND)).write.mode("overwrite").partitionBy("band").json(f"{root}/bands")
    return read_json(banded.sparkSession, f"{root}/bands", BAND).groupBy("band", "source").agg(F.count(F.lit(1)).alias("n"))


def relative_path(path: str, root: str) -> str:
    """path below root, with forward slashes; an absolute path elsewhere is refused."""
    from pathlib import PurePosixPath

    p = PurePosixPath(path.replace("\\", "/"))
    out = p.relative_to(root) if p.is_absolute() else p
    if ".." in out.parts:
        raise ValueError(f"{path} leaves {root}")
    return str(out)
