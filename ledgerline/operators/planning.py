"""Work splitting and estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import saved

#: Calls a minute of the first rate tier by plan, and the share of it that is used.
PLAN_LIMITS, SAFETY = {"starter": 10, "pro": 15, "org": 20, "enterprise": 20}, 0.9


def runtime_seconds(objects: Column, seconds_each: Column, workers: int, ceiling: float) -> Column:
    by_latency = F.when(seconds_each > 0, F.lit(float(workers)) / seconds_each)
    speed = F.when(by_latency > 0, F.least(by_latency, F.lit(ceiling))).otherwise(F.lit(ceiling))
    return F.coalesce(F.try_divide(objects.cast("double"), speed), F.lit(0.0))


def scaled(n: Column, total: Column, taken: Column) -> Column:
    return F.bround(F.coalesce(n * F.try_divide(total.cast("double"), taken), F.lit(0.0))).cast("long")


def tier_hours(calls: Column) -> list[Column]:
    return [F.bround(calls / (limit * SAFETY) / 60.0, 1).alias(f"hours_{plan}") for plan, limit in PLAN_LIMITS.items()]


def blocks(df: DataFrame, size: str, block: int) -> DataFrame:
    """Ranges [start, end] that cover each size; a size of more than 50,000 blocks is one row without a range, refused."""
    refused = F.col(size) > 50_000 * block
    starts = F.when(~refused, F.sequence(F.lit(0).cast("long"), F.greatest(F.col(size) - 1, F.lit(0)), F.lit(block).cast("long")))
    rows = df.where(F.col(size) > 0).select("*", refused.alias("refused"), F.posexplode_outer(starts).alias("block", "start"))
    return rows.withColumn("end", F.least(F.col("start") + block, F.when(~F.col("refused"), F.col(size))) - 1).withColumn("end", F.when(~F.col("refused"), F.col("end")))


def chunks(keys: DataFrame, key: str, per_chunk: int, safe: str = "^[0-9A-Za-z._/-]+$") -> DataFrame:
    """Safe keys in chunk-NNNNN, the others in quarantine-NNNNN, each in key order.

    Ranks come from range partitions and their sizes, not from one window over all keys.
    """
    kind = F.when(F.rlike(F.col(key), F.lit(safe)), "chunk").otherwise("quarantine")
    n = max(2, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = saved(keys.select(key, kind.alias("kind")).repartitionByRange(n, "kind", key).withColumn("part", F.spark_partition_id()), "dealt")
    sizes = dealt.groupBy("kind", "part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("kind").orderBy("part")) - F.col("n")).drop("n")
    ranked = dealt.withColumn("at", F.row_number().over(Window.partitionBy("kind", "part").orderBy(key)) - 1).join(before, ["kind", "part"])
    number = F.floor((F.col("at") + F.col("before")) / per_chunk).cast("long")
    return ranked.select(key, F.format_string("%s-%05d", "kind", number).alias("chunk"))


def range_bounds(n: int) -> list[tuple[str, str]]:
    """n ranges (start, end] of hexadecimal keys; the first start and the last end are open ('')."""
    edges = [format(i * 65536 // n, "04x") for i in range(1, n)]
    edges = list(dict.fromkeys(edges))
    return list(zip(["", *edges], [*edges, ""], strict=True))


def shard(key: Column, n: int) -> Column:
    """The index of the range that a hexadecimal key falls in, by arithmetic on its head."""
    edges = [e for _, e in range_bounds(n)[:-1]]
    return F.aggregate(F.array(*map(F.lit, edges)), F.lit(0), lambda a, e: a + F.when(key > e, 1).otherwise(0))


def job_plan(keys: DataFrame, key: str, few: int, many: int) -> DataFrame:
    """A recursive job per prefix at depth 1, or 2 where depth 1 gives too few prefixes and depth 2 not too many."""
    s = F.split(F.col(key), "/")
    d1 = F.when(F.size(s) > 1, F.concat(s[0], F.lit("/"))).otherwise("")
    d2 = F.when(F.size(s) > 2, F.concat_ws("/", s[0], s[1], F.lit(""))).otherwise(d1)
    counted = keys.select(d1.alias("d1"), d2.alias("d2")).groupBy("d1", "d2").agg(F.count("*").alias("n"))
    size = counted.agg(F.countDistinct(F.nullif("d1", F.lit(""))).alias("n1"), F.countDistinct(F.nullif("d2", F.lit(""))).alias("n2"))
    deep = (F.col("n1") < few) & (F.col("n2") <= many)
    prefix = F.when(deep, F.col("d2")).otherwise(F.col("d1"))
    return counted.crossJoin(F.broadcast(size)).groupBy(prefix.alias("prefix")).agg(F.sum("n").alias("objects"), F.first(F.when(deep, 2).otherwise(1)).alias("depth")).withColumn("type", F.when((F.col("prefix") == "") | ((F.col("depth") == 2) & (F.length(F.regexp_replace("prefix", "[^/]", "")) == 1)), "S").otherwise("R"))


def placed(units: DataFrame, *order: str) -> DataFrame:
    """Units of a run with their place in it: a run's units are a short list, whose order is one."""
    return units.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))
