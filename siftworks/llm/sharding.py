"""Operator 4: sharding by size-tiered compaction under a versioned manifest.

Arrivals are written as small immutable Parquet shards. Compaction looks at the sizes of the live shards: runs of one
size tier (each tier `fanout` times the one below) are merged, as many together as make a target-sized file, without a
shuffle: a run is one task, which reads that run's files alone and writes one file.

The manifest is a log. A version is a small file that names the shards added and those removed since the version before,
and every `snapshot` versions also a file of all live shards, so that a commit writes what has changed and a reader
reads one snapshot and the few versions after it. A version is written beside its place and moved there by a rename that
fails if the place is taken, so readers see either the old or the new set, and of two writers one starts again from what
the other left. Lost tasks are run again by Spark; files of failed jobs are never listed.

Shards no version lists any more are removed by `vacuum`, if they are older than its grace: a writer that has written
but not committed yet has that long to do so, and a reader that long to finish.

Rows are stored as they are: nulls, empty and very long texts, repeated rows and whatever columns there are come back
unchanged. An empty table is a version without shards, which reads as an empty table of the same schema.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import checkpoint_dir

#: Runs that one job merges; each is a scan and a task of its own.
RUNS_A_JOB = 128
GRACE_SECONDS = 24 * 3600


class Conflict(RuntimeError):
    """Another writer has committed the version that was to be committed."""


@dataclass(frozen=True)
class Shard:
    path: str
    size: int
    rows: int


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: str
    shards: tuple[Shard, ...]


class ShardStore:
    """Shards under `root`, a folder that driver and executors share, on any file system Spark writes to."""

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fanout: int = 4, least_runs: int = 4, snapshot: int = 16):
        self.spark, self.root, self.target, self.fanout, self.least, self.every = spark, root.rstrip("/"), target_bytes, fanout, least_runs, snapshot
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str) -> list:
        p = self._path(folder)
        return list(self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _log(self) -> tuple[list[int], list[int]]:
        """(versions, snapshots) that are there."""
        names = [s.getPath().getName() for s in self._names("manifest")]
        return tuple(sorted(int(n[1:-5]) for n in names if n.startswith(k)) for k in "vs")

    def version(self) -> int:
        """The newest version, 0 before the first."""
        return max([0, *self._log()[0]])

    def _read(self, name: str) -> dict:
        stream = self._fs.open(self._path(f"manifest/{name}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> Manifest:
        """The live shards of a version, by default the newest: the last snapshot up to it and the changes after that."""
        versions, snapshots = self._log()
        version = max([0, *versions]) if version is None else version
        base = max([0, *(s for s in snapshots if s <= version)])
        raw = self._read(f"s{base:010d}.json") if base else {"schema": "", "shards": []}
        live, schema = {s["path"]: Shard(**s) for s in raw["shards"]}, raw["schema"]
        for v in range(base + 1, version + 1):
            change = self._read(f"v{v:010d}.json")
            schema = change["schema"]
            for p in change["removed"]:
                del live[p]
            live |= {s["path"]: Shard(**s) for s in change["added"]}
        return Manifest(version, schema, tuple(live.values()))

    def _put(self, name: str, value: dict) -> None:
        """Write a file of the manifest whole or not at all; Conflict if its place is taken."""
        draft, place = self._path(f"manifest/.{uuid.uuid4().hex}.json"), self._path(f"manifest/{name}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(options, 1)
        how[0] = options.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self._conf).rename(draft, place, how)
        except Exception as e:
            self._fs.delete(draft, False)
            if self._fs.exists(place):
                raise Conflict(f"{name} is taken") from e
            raise

    def _commit(self, now: Manifest, added: list[Shard], removed: set[str], schema: str) -> Manifest:
        """The version after `now`; Conflict if another writer has made it."""
        new = Manifest(now.version + 1, schema, (*(s for s in now.shards if s.path not in removed), *added))
        self._put(f"v{new.version:010d}.json", {"version": new.version, "schema": schema, "added": [asdict(s) for s in added], "removed": sorted(removed)})
        if new.version % self.every == 0:
            try:
                self._put(f"s{new.version:010d}.json", {"version": new.version, "schema": schema, "shards": [asdict(s) for s in new.shards]})
            except Conflict:
                pass  # another reader of the same version has put the same there
        return new

    def _write(self, df: DataFrame, rows_per_shard: int = 0) -> list[Shard]:
        """New shards of df's rows, listed nowhere yet. Rows are counted from the files' footers."""
        name = f"data/{uuid.uuid4().hex}"
        df.write.option("maxRecordsPerFile", rows_per_shard).parquet(f"{self.root}/{name}")
        sizes = {s.getPath().getName(): s.getLen() for s in self._names(name) if s.getPath().getName().startswith("part-")}
        files = self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")
        counts = files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("f")).groupBy("f").count().collect()
        return [Shard(f"{name}/{r['f']}", sizes[r["f"]], r["count"]) for r in sorted(counts, key=lambda r: r["f"])]

    def append(self, df: DataFrame, rows_per_shard: int = 4096, tries: int = 20) -> Manifest:
        """Add df as small shards of at most rows_per_shard rows."""
        return self._added(self._write(df, rows_per_shard), df.schema.json(), tries)

    def _added(self, new: list[Shard], schema: str, tries: int = 20) -> Manifest:
        for _ in range(tries):
            now = self.manifest()
            try:
                return self._commit(now, new, set(), now.schema or schema)
            except Conflict:
                continue
        raise Conflict(f"lost {tries} races")

    def tier(self, shard: Shard) -> int:
        """The tier of a size: 0 for target-sized files, which are never merged again, then 1 for the next smaller."""
        return max(0, math.floor(math.log(max(1.0, self.target / max(1, shard.size)), self.fanout) + 0.5))

    def plan(self, shards: tuple[Shard, ...]) -> list[list[Shard]]:
        """Runs to merge, of the shards of one tier each: of every tier that has enough, as many together as make about a target file."""
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            tiers.setdefault(self.tier(s), []).append(s)
        out = []
        for t in sorted(set(tiers) - {0}):
            own = sorted(tiers[t], key=lambda s: (s.size, s.path))
            if len(own) < self.least:
                continue
            files = max(1, round(sum(s.size for s in own) / self.target))
            # dealt out in the order of size, so that runs weigh about the same
            out += [run for i in range(files) if len(run := own[i::files]) > 1]
        return out

    def _merged(self, runs: list[list[Shard]], schema: StructType) -> list[Shard]:
        """One new shard for each run."""
        # a union of one-partition tables would be one partition by default, that is, one file for all runs of a job
        name, out = "spark.sql.unionOutputPartitioning", []
        before = self.spark.conf.get(name, "true")
        self.spark.conf.set(name, "false")
        try:
            for at in range(0, len(runs), RUNS_A_JOB):
                parts = [self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.path}" for s in run]).coalesce(1) for run in runs[at:at + RUNS_A_JOB]]
                out += self._write(reduce(DataFrame.union, parts))
        finally:
            self.spark.conf.set(name, before)
        return out

    def compact(self, tries: int = 20) -> Manifest:
        """Merge until no tier has enough runs."""
        now = self.manifest()
        while tries and (runs := self.plan(now.shards)):
            merged = {s.path for run in runs for s in run}
            new = self._merged(runs, StructType.fromJson(json.loads(now.schema)))
            # an append may come between, which leaves the merged shards live; a compaction that has removed some makes this one void
            while tries and merged <= {s.path for s in now.shards}:
                try:
                    now = self._commit(now, new, merged, now.schema)
                    break
                except Conflict:
                    tries -= 1
                    now = self.manifest()
        return now

    def vacuum(self, keep_versions: int = 1, grace_seconds: float = GRACE_SECONDS) -> None:
        """Delete versions before the last snapshot that the kept ones need, and the shards that none of the kept lists, if older than the grace.

        What is live is read after the files are listed: a shard committed meanwhile is either listed as live or young.
        """
        files = [(f"data/{folder.getPath().getName()}/{s.getPath().getName()}", s.getPath(), s.getModificationTime())
                 for folder in self._names("data") for s in self._names(f"data/{folder.getPath().getName()}") if s.getPath().getName().startswith("part-")]
        latest = time.time() * 1000 - grace_seconds * 1000
        newest = self.version()
        kept = range(max(1, newest - keep_versions + 1), newest + 1)
        live = {s.path for v in kept for s in self.manifest(v).shards}
        for name, path, changed in files:
            if name not in live and changed <= latest:
                self._fs.delete(path, False)
        base = max([0, *(s for s in self._log()[1] if kept and s <= kept[0])])
        for s in self._names("manifest"):
            name = s.getPath().getName()
            if name[0] in "vs" and int(name[1:-5]) < base + (name[0] == "v") and s.getModificationTime() <= latest:
                self._fs.delete(s.getPath(), False)

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        if not m.schema:
            raise ValueError("nothing was ever appended")
        schema = StructType.fromJson(json.loads(m.schema))
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.path}" for s in m.shards]) if m.shards else self.spark.createDataFrame([], schema)


def query(spark, sf_dir: str) -> DataFrame:
    """documents, arrived in four parts with compaction between and after, and read back by the manifest: doc_id, the text's code points and SHA-256."""
    store = ShardStore(spark, f"{checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for arrival in range(4):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == arrival))
        if arrival % 2:
            store.compact()
    store.vacuum()
    text = F.coalesce("text", F.lit(""))
    return store.read().select("doc_id", F.length(text).cast("bigint").alias("n_points"), F.sha2(text, 256).alias("text_sha256"))


SQL = "SELECT doc_id, length(coalesce(text, ''))::BIGINT AS n_points, sha256(coalesce(text, '')) AS text_sha256 FROM documents"
