"""Analytics of a pipeline's events: counters, durations, queues, streaks and throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarn.operators.catalog import beside


def flush_decision(files: DataFrame, by: list[str], now: Column, threshold_bytes: int, threshold_seconds: int, testing: str | None = None) -> DataFrame:
    """What has gathered for each dataset, and whether and why to flush.

    The rule: flush when testing, or when bytes reach their threshold, or when
    the oldest file is as old as the time threshold; the first holds.
    """
    seconds = lambda c: F.unix_seconds(c.cast("timestamp"))
    rows = files.groupBy(*by).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n_files"), F.min("modified").alias("oldest"), F.max("modified").alias("newest"),
        F.max(F.lit(False) if testing is None else F.coalesce(F.col(testing), F.lit(False))).alias("testing"),
    )
    old = seconds(now) - seconds(F.col("oldest")) >= threshold_seconds
    reason = F.when(F.col("testing"), "testing").when(F.col("bytes") >= threshold_bytes, "size").when(old, "time")
    return rows.withColumns({"progress": F.least(F.lit(100.0), F.col("bytes") * 100.0 / threshold_bytes), "should_flush": reason.isNotNull(), "reason": F.coalesce(reason, F.lit("waiting"))})


def totals(results: DataFrame, by: list[str]) -> DataFrame:
    """Results of each pair and of all at every level: processed, skipped, failed, bytes."""
    return results.rollup(*by).agg(F.count_if("processed").alias("processed"), F.count_if("skipped").alias("skipped"), F.count_if("failed").alias("failed"), F.sum("bytes").alias("bytes"))


def counters(events: DataFrame, dimensions: list[str]) -> DataFrame:
    """Counts, failures and bytes over every combination of dimensions (null: all)."""
    marks = [F.grouping(d).alias(f"all_{d}") for d in dimensions]
    return events.cube(*dimensions).agg(*marks, F.count("*").alias("n"), F.count_if(~F.col("success")).alias("failures"), F.sum("bytes").alias("bytes"))


def durations(events: DataFrame, by: list[str], value: str, buckets: int, low: float, high: float) -> tuple[DataFrame, DataFrame]:
    """Percentiles of a value by group, and its histogram of equal buckets (0 and buckets + 1 lie outside)."""
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    spread = events.groupBy(*by).agg(*[F.percentile(value, F.lit(p)).alias(n) for n, p in shares.items()], F.count(value).alias("n"))
    bucket = F.width_bucket(F.col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets)).alias("bucket")
    return spread, events.groupBy(*by, bucket).agg(F.count("*").alias("n"))


def queue_statistics(jobs: DataFrame, by: list[str], now: Column) -> DataFrame:
    """Jobs by state, and retries that are ready."""
    states = [F.count_if(F.col("state") == s).alias(s) for s in ("queue", "retry", "dlq")]
    return jobs.groupBy(*by).agg(*states, F.count_if((F.col("state") == "retry") & (F.col("retry_after") < now)).alias("ready_retries"))


def throughput(metrics: DataFrame, by: list[str], target_bytes: int) -> DataFrame:
    """Bytes in and out, lines and errors by group, the compression ratio and the output that the target gives."""
    rows = metrics.groupBy(*by).agg(F.sum("input_bytes").alias("input_bytes"), F.sum("output_bytes").alias("output_bytes"), F.sum("lines").alias("lines"), F.sum("errors").alias("errors"))
    ratio = F.try_divide("output_bytes", "input_bytes")
    return rows.withColumn("ratio", ratio).withColumn("estimated_output", ratio * target_bytes)


def upload_statistics(uploads: DataFrame, by: list[str]) -> DataFrame:
    return uploads.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"),
        F.count_if(F.col("attempts") > 1).alias("retried"), F.sum(F.when(F.col("success"), F.col("bytes")).otherwise(0)).alias("bytes"),
    )


def progress(updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The latest state of each operation, its errors in all, and its percentage."""
    at = F.struct(*order)
    rows = updates.groupBy(key).agg(F.max_by("status", at).alias("status"), F.max_by("current", at).alias("current"), F.max_by("total", at).alias("total"), F.sum("errors").alias("errors"))
    return rows.withColumn("percent", F.try_divide(F.col("current") * 100.0, F.col("total")))


def error_roll_up(errors: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Errors by group with the latest message as a sample; no severity means error."""
    rows = errors.withColumn("severity", F.coalesce("severity", F.lit("error")))
    return rows.groupBy(*by, "severity").agg(F.count("*").alias("n"), F.max_by("message", F.struct(*order)).alias("sample"))


def streaks(
    events: DataFrame, by: list[str], order: list[str], limit: int = 3, reset_hours: int | None = None, time: str | None = None, bucket: Column | None = None
) -> DataFrame:
    """``events`` with streak (failures since the last success, or since a pause of ``reset_hours``) and open_circuit (at the limit or beyond).

    ``bucket`` follows the order (such as its day): streaks are counted within
    buckets and carried from one to the next, so no task holds more of a hot
    group than a bucket. Rows that lack a place in the order come last, and an
    event that isn't known to be a success is a failure.
    """
    keys, last = [*by, "_bucket"], F.asc_nulls_last("_bucket")
    inside, across = W.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order]), W.partitionBy(*by).orderBy(last)
    so_far = inside.rowsBetween(W.unboundedPreceding, 0)
    rows = events.withColumn("_bucket", F.lit(0) if bucket is None else bucket)
    seconds = F.unix_seconds(F.col(time).cast("timestamp")) if time else F.lit(None).cast("long")
    failure = 1 - F.coalesce(F.col("success").cast("long"), F.lit(0))
    rows = rows.withColumn("_failures", F.sum(failure).over(inside)).withColumn("_rows", F.sum(failure).over(so_far))  # rows that tie count together
    begin = F.when(F.col("success"), F.col("_rows"))  # failures that no longer count from here on
    if reset_hours is not None:
        rows = rows.withColumn("_gap", seconds - F.lag(seconds).over(inside))
        begin = begin.when(F.col("_gap") >= reset_hours * 3600, F.col("_rows") - failure)
    rows = rows.withColumn("_begin", F.max(begin).over(so_far))
    ends = rows.groupBy(*keys).agg(F.max("_failures").alias("_all"), F.max("_begin").alias("_last"), F.min(seconds).alias("_low"), F.max(seconds).alias("_high"))
    fresh = F.lit(False) if reset_hours is None else F.coalesce(F.col("_low") - F.lag("_high").over(across) >= reset_hours * 3600, F.lit(False))
    ends = ends.withColumn("_fresh", fresh).withColumn("_era", F.sum((F.col("_last").isNotNull() | F.col("_fresh")).cast("long")).over(across))
    era = W.partitionBy(*by, "_era").orderBy(last)  # a bucket with a success or after a pause, and those after it that have none
    ends = ends.withColumn("_open", F.sum(F.col("_all") - F.coalesce("_last", F.lit(0))).over(era))
    carried = ends.select(*keys, F.when(~F.col("_fresh"), F.coalesce(F.lag("_open").over(across), F.lit(0))).otherwise(0).alias("_carry"))
    rows = beside(rows, carried, keys)
    streak = F.when(F.col("success"), 0).otherwise(F.col("_failures") - F.coalesce("_begin", -F.col("_carry")))
    rows = rows.withColumn("streak", streak.cast("long")).withColumn("open_circuit", F.col("streak") >= limit)
    return rows.drop("_bucket", "_failures", "_rows", "_gap", "_begin", "_carry")


def circuits(events: DataFrame, by: list[str], order: list[str], limit: int = 3, bucket: Column | None = None) -> DataFrame:
    """Each destination's state after its last event: failures in a row, whether it is active, the last error."""
    at = F.struct(*order)
    rows = streaks(events, by, order, limit, bucket=bucket).groupBy(*by).agg(F.max_by("streak", at).alias("failures"), F.max_by("error", F.when(~F.col("success"), at)).alias("last_error"))
    return rows.withColumn("active", F.col("failures") < limit)


def alerts(events: DataFrame, by: list[str], order: list[str], every: int = 3, bucket: Column | None = None) -> DataFrame:
    """The failures at which an alert fires: every third in a row."""
    return streaks(events, by, order, every, bucket=bucket).where((F.col("streak") >= every) & (F.col("streak") % every == 0))


def placed(rows: DataFrame, by: list[str], order: list[Column | str], bucket: Column | None = None) -> DataFrame:
    """``rows`` with their place in the order of each group, from 1; places go on from ``bucket`` to bucket, which follows the order."""
    keys, across = [*by, "_bucket"], W.partitionBy(*by).orderBy("_bucket")
    rows = rows.withColumn("_bucket", F.lit(0) if bucket is None else bucket)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(across) - F.col("_n")).drop("_n")
    rows = beside(rows.withColumn("_own", F.row_number().over(W.partitionBy(*keys).orderBy(*order))), counts, keys)
    return rows.withColumn("place", F.col("_own") + F.col("_before")).drop("_bucket", "_own", "_before")


def ranked_queue(jobs: DataFrame, by: list[str]) -> DataFrame:
    """Queued jobs with their place: higher priority first, then older."""
    bucket = F.struct(F.col("priority").isNull().alias("none"), (-F.col("priority")).alias("priority"), F.date_trunc("DAY", "created").alias("day"))
    return placed(jobs.where(F.col("state") == "queue"), by, [F.desc("priority"), "created", "job_id"], bucket)


#: Values further back than this weigh nothing: a double has no such halves.
HALVES = 1100


def smoothed(events: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """The moving average that halves the past with each new value, after the last event of each group."""
    back = F.row_number().over(W.partitionBy(*by).orderBy(*[F.desc(c) for c in order]))  # the last value weighs a half, the one before a quarter
    rows = events.withColumn("_back", back).where(F.col("_back") <= HALVES)
    rows = beside(rows, events.groupBy(*by).agg(F.count("*").alias("_all")), by)
    weight = F.pow(F.lit(2.0), -F.least(F.col("_back"), F.col("_all") - 1))  # the first weighs as much as the second
    return rows.groupBy(*by).agg(F.sum(F.col(value).cast("double") * weight).alias("average"), F.max("_all").alias("n"))


def recent(events: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The newest events of each group, ``most`` at most."""
    return events.withColumn("_place", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_place") <= most).drop("_place")


def throttled(events: DataFrame, by: list[str], order: list[str], every: int, seconds: int, time: str, bucket: Column | None = None) -> DataFrame:
    """Events at which a report is due: every so many, or after a pause of so many seconds; ``bucket`` as for ``streaks``."""
    keys, rows = [*by, "_due"], placed(events, by, order, bucket).withColumn("_due", F.lit(0) if bucket is None else bucket)
    ends = rows.groupBy(*keys).agg(F.max_by(time, F.struct(*order)).alias("_end")).withColumn("_end", F.lag("_end").over(W.partitionBy(*by).orderBy("_due")))
    last = F.coalesce(F.lag(time).over(W.partitionBy(*keys).orderBy(*order)), F.col("_end"))
    gap = F.unix_seconds(F.col(time).cast("timestamp")) - F.unix_seconds(last.cast("timestamp"))
    return beside(rows, ends, keys).withColumn("_gap", gap).where((F.col("place") % every == 0) | (F.col("_gap") > seconds)).drop("_gap", "_due", "_end")
