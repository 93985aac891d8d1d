"""Reports over request logs and histories: latencies, counters, runs of failures, sampling and backfills."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from converge.operators.projection import DELETED, PUBLISHED, TERMINAL


#: Bins for each factor of e in a latency: a bin spans 0.1 % of its values.
BINS = 1000


def _percentiles(rows: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Exact percentiles, interpolated between the two nearest ranks: `by` and a column for each point.

    Values are counted; counts of narrow bins, few rows, tell in which bins the two ranks of each point lie; and only the
    distinct values of these bins are put in order.
    """
    bin_ = F.signum(value) * F.floor(F.log1p(F.abs(F.col(value))) * BINS)
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"), F.first(bin_).alias("_bin"))
    order = Window.partitionBy(*by).orderBy("_bin")
    bins = counts.groupBy(*by, "_bin").agg(F.sum("_n").alias("_in")).withColumn("_before", F.sum("_in").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in")).withColumn("_all", F.sum("_in").over(Window.partitionBy(*by)))
    at = F.array(*[F.lit(p) * (F.col("_all") - 1) for p in points.values()])
    ranks = F.array_distinct(F.concat(F.transform(at, lambda x: F.floor(x)), F.transform(at, lambda x: F.ceil(x))))
    wanted = bins.withColumn("_ranks", F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_in")))).where(F.size("_ranks") > 0)
    within = Window.partitionBy(*by, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    found = counts.join(wanted, [*by, "_bin"]).withColumn("_to", F.col("_before") + F.sum("_n").over(within)).withColumn("_rank", F.explode(F.filter("_ranks", lambda r: (r >= F.col("_to") - F.col("_n")) & (r < F.col("_to")))))
    values = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_values"), F.first("_all").alias("_all"))
    place = lambda p: F.lit(p) * (F.col("_all") - 1)
    low, high = (lambda p: F.col("_values")[F.floor(place(p))]), (lambda p: F.col("_values")[F.ceil(place(p))])
    return values.select(*by, *[(low(p) + (high(p) - low(p)) * (place(p) - F.floor(place(p)))).alias(name) for name, p in points.items()])


def latency(requests: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts, and exact interpolated percentiles of latency_ms, of requests with latency_ms, ok and result_count.

    Without `by` there is one row, of zeros for no requests; a group all of whose latencies are null has percentiles of 0.
    """
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    found = requests.groupBy(*(by or [])).agg(
        F.count("*").alias("total_requests"), F.count_if("ok").alias("successful_requests"), F.count_if(~F.col("ok")).alias("failed_requests"),
        mean("latency_ms").alias("average_latency_ms"), F.coalesce(F.min("latency_ms"), F.lit(0.0)).alias("min_latency_ms"), F.coalesce(F.max("latency_ms"), F.lit(0.0)).alias("max_latency_ms"),
        mean(F.when(F.col("ok"), F.col("result_count"))).alias("average_result_count"),
    )
    points = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}
    # One key that is never null, so that a null group finds its percentiles.
    of = lambda df: df.withColumn("_key", F.struct(*by) if by else F.lit(0))
    both = of(found).join(_percentiles(of(requests), ["_key"], "latency_ms", points), "_key", "left").drop("_key")
    return both.withColumns({name: F.coalesce(name, F.lit(0.0)) for name in points})


def error_samples(requests: DataFrame, most: int = 5) -> DataFrame:
    """The first failed requests in their order."""
    return requests.where("not ok").orderBy("seq").limit(most).select("seq", "case_name", "error_type")


def expanded(cases: DataFrame, iterations: int) -> DataFrame:
    """Each case weight times an iteration; none for a weight or number of iterations below one."""
    times = F.greatest(F.col("weight") * iterations, F.lit(0))
    return cases.withColumn("_n", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>")))).withColumn("request", F.col("_n")).drop("_n")


def counters(events: DataFrame) -> DataFrame:
    """name, tags (sorted), value: the sum of each counter."""
    tags = F.array_join(F.array_sort(F.transform(F.map_entries("tags"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return events.groupBy("name", tags.alias("tags")).agg(F.sum("amount").alias("value"))


def counter_deltas(after: DataFrame, before: DataFrame) -> DataFrame:
    """Counters of `after` that are not as before."""
    joined = after.join(before.withColumnRenamed("value", "_before"), ["name", "tags"], "left")
    return joined.select("name", "tags", (F.col("value") - F.coalesce("_before", F.lit(0))).alias("delta")).where("delta <> 0")


#: Values of seq that one task orders.
SPAN = 1_000_000


def failure_runs(requests: DataFrame, by: str, threshold: int = 5, span: int = SPAN) -> DataFrame:
    """Runs of consecutive failures: `by`, first_seq, last_seq, failures, opened (whether a circuit breaker would open).

    Each stretch of `span` values of seq finds its own runs. Stretches, a few rows each, are then put in order for each
    `by`: a run that ends one and one that begins the next are the same if no success lies between them.
    """
    log = requests.select(by, "seq", "ok", F.floor(F.col("seq") / span).alias("_span"))
    order = Window.partitionBy(by, "_span").orderBy("seq")
    run = F.sum(F.col("ok").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = log.withColumn("_run", run).groupBy(by, "_span", "_run").agg(F.min(F.when(~F.col("ok"), F.col("seq"))).alias("first_seq"), F.max(F.when(~F.col("ok"), F.col("seq"))).alias("last_seq"), F.count_if(~F.col("ok")).alias("failures"), F.min("seq").alias("_from"), F.min("ok").alias("_broken"))
    # Only what touches a seam can go on: the first run of a stretch, if nothing succeeded before it, and the last.
    last = F.max("_run").over(Window.partitionBy(by, "_span"))
    edge = runs.withColumn("_last", last)
    inner = edge.where("_run > 0 and _run < _last and failures > 0").select(by, "first_seq", "last_seq", "failures")
    seams = edge.where("_run = 0 or _run = _last").withColumn("_starts", (F.col("_run") > 0).cast("int"))
    joined = seams.withColumn("_chain", F.sum("_starts").over(Window.partitionBy(by).orderBy("_from").rowsBetween(Window.unboundedPreceding, 0)))
    outer = joined.groupBy(by, "_chain").agg(F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"), F.sum("failures").alias("failures")).where("failures > 0")
    return inner.unionByName(outer.drop("_chain")).withColumn("opened", F.col("failures") >= threshold)


def write_report(report: DataFrame, path: str) -> None:
    """A report, a few rows, as one JSON file below path."""
    report.coalesce(1).write.mode("overwrite").json(path)


def backfill(history: DataFrame, events: DataFrame, start: int = 0) -> DataFrame:
    """One row of counters over the events from `start` on; last_event_time_utc is that of the last one, not the latest.

    The history, a row for each event, is read once: entities count what they published and which state is their last.
    """
    since, published = F.col("seq") >= start, F.col("publish")
    each = history.groupBy("tenant_id", "domain_name", "entity_type", "logical_entity_id").agg(F.count_if(since & published & (F.col("status") == PUBLISHED)).alias("published"), F.count_if(since & published & (F.col("status") == DELETED)).alias("deleted"), F.max_by("status", "seq").alias("status"))
    counts = each.agg(F.coalesce(F.sum("published"), F.lit(0)).alias("published_documents"), F.coalesce(F.sum("deleted"), F.lit(0)).alias("deleted_documents"), F.count_if(~F.col("status").isin(*TERMINAL)).alias("pending_documents"))
    ingested = events.where(since).agg(F.count("*").alias("ingested_events"), F.max_by("event_time_utc", "seq").alias("last_event_time_utc"))
    # Two rows of one each.
    return ingested.join(F.broadcast(counts))


def watermarks(events: DataFrame, by: list[str]) -> DataFrame:
    """The last seq of each source that a backfill has read: `by`, watermark."""
    return events.groupBy(*by).agg(F.max("seq").alias("watermark"))


def after_watermarks(events: DataFrame, marks: DataFrame, by: list[str]) -> DataFrame:
    """The events that a stream takes over: those after their source's watermark, and all of a source that has none."""
    return events.join(marks, by, "left").where("watermark is null or seq > watermark")


def save_position(spark: SparkSession, path: str, position: int) -> None:
    """The number of events that a backfill is done with; replaces what the folder held."""
    spark.range(position, position + 1).toDF("position").write.mode("overwrite").parquet(path)


def load_position(spark: SparkSession, path: str) -> int:
    """The saved position, 0 if none was saved."""
    try:
        return spark.read.parquet(path).agg(F.max("position")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


#: Events between two savings of a backfill's position.
INTERVAL = 50_000


def resumed(events: DataFrame, path: str, apply: Callable[[DataFrame, int], None], interval: int = INTERVAL) -> int:
    """Hand the events from the saved position on to `apply`, as stretches of `interval` values of seq and their numbers.

    The position, the seq that comes next, is saved after each stretch, so a backfill that stopped goes on with the stretch
    that it was in. Returns the position at the end.
    """
    spark = events.sparkSession
    position, end = load_position(spark, path), events.agg(F.max("seq")).first()[0]
    while end is not None and position <= end:
        upto = (position // interval + 1) * interval
        apply(events.where((F.col("seq") >= position) & (F.col("seq") < upto)), position // interval)
        position = min(upto, end + 1)
        save_position(spark, path, position)
    return position


def admission(events: DataFrame, states: DataFrame, pending: int, most_pending: int = 100_000) -> DataFrame:
    """Events with accepted and reason_code, for one micro-batch whose number of pending entities is known at its start.

    At the threshold, repairs and refreshes pass, and so do events of entities that wait for something.
    """
    waiting = ("pending_required_fragment", "pending_rehydration", "stale", "quarantined", "ready_to_build")
    key = ["tenant_id", "domain_name", "entity_type", "logical_entity_id"]
    joined = events.join(states.select(*key, F.col("status").alias("_status")), key, "left")
    reason = F.when(F.lit(pending < most_pending), "accepted").when(F.col("change_type").isin("repair", "refresh"), "priority_change_type").when(F.col("_status").isin(*waiting), "pending_entity_completion").otherwise("pending_threshold_exceeded")
    return joined.withColumn("reason_code", reason).withColumn("accepted", F.col("reason_code") != "pending_threshold_exceeded").drop("_status")
