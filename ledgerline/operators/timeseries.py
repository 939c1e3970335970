"""Runs over time: rates, deltas, stalls, stages, trailing windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY, STALL_DAYS, ETA_DAYS, AS_OF_HOURS = 86400.0, 3, 3650, 20


def with_previous(runs: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(ts)
    return runs.withColumn("prev_ts", F.lag(ts).over(w)).withColumn("prev_value", F.lag(value).over(w))


def rate(value: Column, previous: Column, seconds: Column) -> Column:
    """Units a day; null without a previous run or with no time between."""
    return F.when(previous.isNotNull() & (seconds > 0), (value - previous) * DAY / seconds)


def days_left(remaining: Column, per_day: Column) -> Column:
    days = F.try_divide(remaining.cast("double"), per_day)
    return F.when((per_day > 0) & (days <= ETA_DAYS), days)


def as_of_delta(runs: DataFrame, key: str, ts: str, value: str, hours: int = AS_OF_HOURS) -> DataFrame:
    """Latest value less that of the newest run at least `hours` older; without one, of the oldest run. A single run has none."""
    last = runs.groupBy(key).agg(F.max(F.struct(ts, value)).alias("last"), F.min(F.struct(ts, value)).alias("first"), F.count("*").alias("n"))
    old = runs.join(last.select(key, "last"), key).where(F.unix_timestamp(F.col(f"last.{ts}")) - F.unix_timestamp(ts) >= hours * 3600).groupBy(key).agg(F.max(F.struct(ts, value)).alias("old"))
    out = last.join(old, key, "left")
    return out.select(key, F.when(F.col("n") > 1, F.col(f"last.{value}") - F.coalesce(F.col(f"old.{value}"), F.col(f"first.{value}"))).alias("delta"))


def changes(runs: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Each run with when its value last grew, and the whole days since."""
    w = Window.partitionBy(key).orderBy(ts)
    grew = F.lag(value).over(w).isNull() | (F.col(value) > F.lag(value).over(w))
    out = runs.withColumn("grew", grew).withColumn("last_change", F.last(F.when(F.col("grew"), F.col(ts)), True).over(w))
    flat = F.floor((F.unix_timestamp(ts) - F.unix_timestamp("last_change")) / DAY)
    return out.withColumn("flat_days", flat.cast("long"))


def stage(complete: Column, flat_days: Column) -> Column:
    return F.when(~complete & (flat_days >= STALL_DAYS), "stalled").otherwise("pushing")


def trailing_rate(jobs: DataFrame, now: Column, minutes: int = 30, pending: Column | None = None, workers: int = 1) -> DataFrame:
    """Files a second over jobs that ended in the last minutes; the span starts where the first of them started.

    With a number of pending jobs also the hours that they take at the recent jobs' mean duration.
    """
    recent = jobs.where(F.col("end_s") >= now - minutes * 60)
    mean = F.avg("seconds") * pending / workers / 3600 if pending is not None else None
    more = [] if mean is None else [mean.alias("eta_hours")]
    out = recent.agg(F.sum("files").alias("files"), (F.max(now) - F.min(F.col("end_s") - F.col("seconds"))).alias("span"), *more)
    return out.select("files", "span", F.try_divide(F.col("files").cast("double"), F.col("span")).alias("per_second"), *(["eta_hours"] if more else []))


def skip_reason(metric: Column, previous: Column, has_totals: Column, forced: bool = False) -> Column:
    if forced:
        return F.lit("launch")
    return F.when(metric.isNotNull() & (metric == previous) & has_totals, "skip").otherwise("launch")


def month_windows(df: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar months clipped to [start, end], both included."""
    firsts = F.explode(F.sequence(F.trunc(start, "MM"), F.col(end), F.expr("interval 1 month")))
    return df.withColumn("first", firsts).select("*", F.greatest("first", start).alias("from_day"), F.least(F.last_day("first"), end).alias("to_day")).drop("first")
