"""Queues as tables: pending heads, promotion, state changes, requeues, budgets and pacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import unused

PENDING, CLAIMED, VISITED, SKIPPED, FAILED, EMITTED = "pending", "claimed", "visited", "skipped", "failed", "emitted"


def pending(docs: DataFrame, tiers: list[str] | None = None, limit: int | None = None, key: str = "key") -> DataFrame:
    """Discovered documents, best score first, ties by key; no tiers (or an empty list) means all."""
    out = docs.where(F.col("status") == "discovered")
    if tiers:
        out = out.where(F.col("tier").isin(*tiers))
    out = out.orderBy(F.desc("lexicon_score"), key)
    return out if limit is None else out.limit(limit)


def requeue_failed(docs: DataFrame, source: str | None = None) -> DataFrame:
    """Failed documents become discovered again, their error cleared."""
    hit = (F.col("status") == FAILED) & (F.lit(True) if source is None else F.col("source") == source)
    hit = F.coalesce(hit, F.lit(False))
    return docs.withColumns({"status": F.when(hit, "discovered").otherwise(F.col("status")), "error": F.when(hit, F.lit(None)).otherwise(F.col("error"))})


def promote(found: DataFrame, keys: tuple[str, ...] = ("source", "url"), seq: str = "seq") -> DataFrame:
    """One row a url: greatest priority, least depth, first parent and kind, the latest anchor that is there.

    Maxima and minima only: everything combines on the map side.
    """
    return found.groupBy(*keys).agg(
        F.max("priority").alias("priority"), F.min("depth").alias("depth"), F.max_by("anchor", F.when(F.col("anchor").isNotNull(), F.col(seq))).alias("anchor"),
        F.min_by("parent", seq).alias("parent"), F.min_by("kind", seq).alias("kind"), F.min(seq).alias(seq))


def merge_found(urls: DataFrame, found: DataFrame) -> DataFrame:
    """The queue after new findings: unknown urls are added as pending; of known ones only the pending are promoted."""
    new = promote(found).withColumnsRenamed({"priority": "np", "depth": "nd", "anchor": "na", "parent": "npar", "kind": "nk", "seq": "ns"})
    both = urls.join(new, ["source", "url"], "full_outer")
    fresh, better = F.col("state").isNull(), (F.col("state") == PENDING) & ((F.col("np") > F.col("priority")) | (F.col("nd") < F.col("depth")))
    pick = lambda a, b, up: F.when(fresh, b).when(better, up).otherwise(a)
    c = F.col
    return both.select(
        "source", "url", pick(c("depth"), c("nd"), F.least(c("depth"), c("nd"))).alias("depth"), pick(c("priority"), c("np"), F.greatest(c("priority"), c("np"))).alias("priority"),
        F.coalesce(c("state"), F.lit(PENDING)).alias("state"), F.coalesce(c("kind"), c("nk")).alias("kind"),
        pick(c("anchor"), c("na"), F.coalesce(c("na"), c("anchor"))).alias("anchor"), F.coalesce(c("parent"), c("npar")).alias("parent"), F.coalesce(c("seq"), c("ns")).alias("seq"))


def url_head(urls: DataFrame, n: int, kind: str = "page") -> DataFrame:
    """The next n pending urls: priority, then depth, then order of discovery."""
    return urls.where((F.col("state") == PENDING) & (F.col("kind") == kind)).orderBy(F.desc("priority"), "depth", "seq").limit(n)


def set_state(urls: DataFrame, done: DataFrame) -> DataFrame:
    """urls with the states of done (source, url, state) where it has them."""
    new = unused(urls, "new_state")
    return urls.join(done.select("source", "url", F.col("state").alias(new)), ["source", "url"], "left").withColumn("state", F.coalesce(new, "state")).drop(new)


def reset(urls: DataFrame, source: str | None = None) -> DataFrame:
    """The queue without a source's urls, or empty."""
    return urls.limit(0) if source is None else urls.where(~F.col("source").eqNullSafe(source))


def emit(urls: DataFrame, seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents to hand on, queue in which they are emitted): pending documents, those that `seen` (source, url) has set aside."""
    waiting = urls.where((F.col("state") == PENDING) & (F.col("kind") == "document"))
    if seen is not None:
        waiting = waiting.join(seen.select("source", "url").distinct(), ["source", "url"], "left_anti")
    state = F.when((F.col("state") == PENDING) & (F.col("kind") == "document"), EMITTED).otherwise(F.col("state"))
    return waiting, urls.withColumn("state", state)


def residual_documents(urls: DataFrame) -> DataFrame:
    """Documents that a stopped crawl has found but not handed on, best first."""
    return urls.where((F.col("kind") == "document") & F.col("state").isin(PENDING, CLAIMED)).orderBy(F.desc("priority"), "depth", "seq")


def reopen(urls: DataFrame, from_state: str = CLAIMED, kind: str | None = None) -> DataFrame:
    """Claimed (or failed) urls back to pending."""
    hit = F.coalesce((F.col("state") == from_state) & (F.lit(True) if kind is None else F.col("kind") == kind), F.lit(False))
    return urls.withColumn("state", F.when(hit, PENDING).otherwise(F.col("state")))


def state_counts(urls: DataFrame) -> DataFrame:
    return urls.groupBy("source", "state").agg(F.count(F.lit(1)).alias("n"))


def visited_pages(urls: DataFrame) -> DataFrame:
    return urls.groupBy("source").agg(F.count_if((F.col("state") == VISITED) & (F.col("kind") == "page")).alias("visited"))


def host_budget(visits: DataFrame, cap: int, host: str = "host", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """visits with nth and allowed: a host's first `cap` visits."""
    return visits.withColumn("nth", F.row_number().over(Window.partitionBy(host).orderBy(*order))).withColumn("allowed", F.col("nth") <= cap)


def throttle(requests: DataFrame, rate: float, host: str = "host", arrival: str = "arrival", order: tuple[str, ...] = ("seq",), delay: str | None = None, pause: str | None = None) -> DataFrame:
    """requests with `start`: the later of its arrival and one interval after the host's previous start, without a loop.

    The interval is `rate`, or the request's `delay` column (a host's crawl delay) where that is longer; `pause` is a
    column of seconds that a host asks to be left alone after that request. A request may start once all intervals and
    pauses since any earlier arrival are over: start_n = s_n + max over k <= n of (arrival_k - s_k), s the running sum of
    what lies between. The window holds one host, as exact order needs; a host's requests are paced, so it has no more
    rows than seconds have passed.
    """
    own = Window.partitionBy(host).orderBy(*order)
    running = own.rowsBetween(Window.unboundedPreceding, 0)
    step, most = unused(requests, "step"), unused(requests, "most")
    gap = F.greatest(F.lit(float(rate)), F.coalesce(F.col(delay), F.lit(0.0))) if delay else F.lit(float(rate))
    if pause:
        gap = F.greatest(gap, F.coalesce(F.lag(pause).over(own), F.lit(0.0)))
    out = requests.withColumn(step, gap).withColumn(step, F.sum(step).over(running))
    out = out.withColumn(most, F.max(F.col(arrival) - F.col(step)).over(running))
    return out.withColumn("start", F.col(step) + F.col(most)).drop(step, most)


def discovery_curve(visits: DataFrame, found: str = "documents", by: str = "source", order: str = "seq") -> DataFrame:
    """visits with the running number of pages and of documents found, for each source."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return visits.withColumns({"pages": F.count(F.lit(1)).over(w), "found": F.sum(found).over(w)})


def with_policy(rows: DataFrame, policies: DataFrame, defaults: dict[str, Column], host: str = "host") -> DataFrame:
    """rows with each policy column of their host, or its default."""
    p = policies.select(F.col(host), F.struct(*defaults).alias(policy := unused(rows, "policy")))
    return rows.join(p, host, "left").withColumns({c: F.coalesce(F.col(f"{policy}.{c}"), d) for c, d in defaults.items()}).drop(policy)


def robots_allowed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (host, path) with `allowed`: the longest matching rule of the host decides, allow wins ties, none allows.

    rules: host, prefix, allow. Judged once for each (host, path), by which the verdict is joined back.
    """
    cases = urls.select("host", "path").where("host IS NOT NULL AND path IS NOT NULL").distinct()
    best = cases.join(rules.select("host", "prefix", "allow"), "host").where(F.col("path").startswith(F.col("prefix")))
    verdict = best.groupBy("host", "path").agg(F.max(F.struct(F.length("prefix").alias("n"), F.col("allow").alias("a"))).alias(v := unused(urls, "verdict")))
    return urls.join(verdict, ["host", "path"], "left").withColumn("allowed", F.coalesce(F.col(f"{v}.a"), F.lit(True))).drop(v)


def worker_count(hosts: DataFrame, concurrency: str = "concurrency", most: int = 32) -> DataFrame:
    """One row: the distinct hosts' concurrencies together, between 1 and most."""
    return hosts.groupBy("host").agg(F.max(concurrency).alias("c")).agg(F.least(F.greatest(F.coalesce(F.sum("c"), F.lit(1)), F.lit(1)), F.lit(most)).cast("int").alias("workers"))
