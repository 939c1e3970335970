"""Inventory sums, incremental sizing and service attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decisions import coverage_class
from ..functions.paths import blob_kind, second_level, top
from ..sources.writers import saved


def measures(comp: str = "clen", unc: str = "uncomp") -> list[Column]:
    return [F.count("*").alias("blobs"), F.sum(comp).cast("long").alias("comp"), F.sum(unc).cast("long").alias("unc"), F.count_if(F.col(unc) == 0).alias("zero")]


def by(df: DataFrame, *keys: str, comp: str = "clen", unc: str = "uncomp") -> DataFrame:
    return df.groupBy(*keys).agg(*measures(comp, unc))


def inventory(blobs: DataFrame) -> DataFrame:
    """All groupings of blobs (name, clen, uncomp, method) in one pass: by top prefix, second level, kind and coverage."""
    rows = blobs.withColumn("kind", blob_kind(F.col("name")))  # by itself, as coverage asks for it often
    rows = rows.select(top(F.col("name")).alias("source"), second_level(F.col("name")).alias("l2"), "kind", coverage_class(F.col("kind"), F.col("method"), F.col("name")).alias("coverage"), "clen", "uncomp")
    sets = rows.groupingSets([["source"], ["l2"], ["kind"], ["coverage"], []], "source", "l2", "kind", "coverage")
    level = F.grouping_id("source", "l2", "kind", "coverage")
    grouped = sets.agg(level.alias("level"), *measures())
    names = {7: "source", 11: "l2", 13: "kind", 14: "coverage", 15: "total"}
    label = F.lit(None).cast("string")
    for k, v in names.items():
        label = F.when(F.col("level") == k, v).otherwise(label)
    return grouped.select(label.alias("grouping"), F.coalesce("source", "l2", "kind", "coverage", F.lit("")).alias("key"), "blobs", "comp", "unc", "zero")


def capped(groups: DataFrame, key: str, measure: str, n: int, rest: str = "(other)") -> DataFrame:
    """The n largest groups and the rest's sum. Groups are already aggregated; only the n-th value is looked up, no group is gathered."""
    edge = groups.orderBy(F.desc(measure), key).limit(n).select(F.col(key).alias("kept"))
    marked = groups.join(edge, groups[key] == F.col("kept"), "left")
    sums = [F.sum(c).alias(c) for c, t in groups.dtypes if c != key and t in ("bigint", "int", "double")]
    return marked.groupBy(F.coalesce("kept", F.lit(rest)).alias(key)).agg(*sums)


def cached(listing: DataFrame, cache: DataFrame) -> DataFrame:
    """The listing with what a cache knows of the same (name, etag, clen); hit says so. Empty etags never meet."""
    known = cache.where(F.coalesce("etag", F.lit("")) != "").select("name", "etag", "clen", F.col("uncomp").alias("known"), F.lit(True).alias("hit"))
    return listing.join(known, ["name", "etag", "clen"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def detected(blobs: DataFrame) -> DataFrame:
    """Bytes and blobs by service, from path matches (name, uncomp, service) and archive entries (entries map<service, bytes>).

    The path's service gets what entries of other services leave; the entries' other services get theirs.
    """
    entries = F.coalesce("entries", F.create_map().cast("map<string,bigint>"))
    other = F.aggregate(F.map_values(F.map_filter(entries, lambda k, v: k != F.coalesce("service", F.lit("")))), F.lit(0).cast("long"), lambda a, x: a + x)
    path = blobs.where("service is not null").select("service", F.greatest(F.col("uncomp") - other, F.lit(0)).alias("bytes"))
    inner = blobs.select(F.col("service").alias("own"), F.explode(entries).alias("service", "bytes")).where("own is null or own <> service").select("service", "bytes")
    return path.union(inner).groupBy("service").agg(F.sum("bytes").cast("long").alias("bytes"), F.count("*").alias("blobs"))


def carried_forward(run: DataFrame, skipped: DataFrame, previous: DataFrame) -> DataFrame:
    """Sources of a run plus those of the previous one that the run was told to skip; a skipped source without a past is a gap."""
    past = skipped.join(previous, "source", "left").select("source", "blobs", "comp", "unc", F.when(F.col("unc").isNull(), "gap").otherwise("carried").alias("state"))
    return run.select("source", "blobs", "comp", "unc", F.lit("measured").alias("state")).unionByName(past)


def admitted(items: DataFrame, limit: int, order: str, size: str) -> DataFrame:
    """Greedy admission under a budget in a fixed, unique order: what doesn't fit is refused, later smaller items may still fit.

    Rounds over range partitions, dealt once, instead of one fold: running sums find the first item that doesn't fit, all before it
    are taken, and the next round looks behind it for items no larger than what is left. The refused sizes fall from
    round to round, so there are at most as many rounds as distinct sizes, and few in practice. Each round brings two
    numbers to the driver; the result is a filter of the items.
    """
    n = max(2, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pool = items.select(F.col(order).alias("o"), F.col(size).cast("long").alias("s")).where(F.col("o").isNotNull() & (F.col("s") > 0))
    left, after, taken = limit, None, F.lit(False)
    ranges = saved(pool.where(F.col("s") <= limit).repartitionByRange(n, "o").withColumn("part", F.spark_partition_id()), "ranges")
    while left > 0:
        behind = F.lit(True) if after is None else F.col("o") > F.lit(after)
        dealt = ranges.where(behind & (F.col("s") <= left))
        sums = dealt.groupBy("part").agg(F.sum("s").alias("s"))
        before = sums.withColumn("before", F.sum("s").over(Window.orderBy("part")) - F.col("s")).drop("s")
        total = F.sum("s").over(Window.partitionBy("part").orderBy("o")) + F.col("before")
        run = dealt.join(F.broadcast(before), "part").withColumn("total", total)
        refused, spent = run.agg(F.min(F.when(F.col("total") > left, F.col("o"))), F.max(F.when(F.col("total") <= left, F.col("total")))).first()
        mine = (F.col(size) > 0) & (F.col(size) <= left)
        if after is not None:
            mine = mine & (F.col(order) > F.lit(after))
        if refused is not None:
            mine = mine & (F.col(order) < F.lit(refused))
        taken = taken | mine
        if refused is None:
            break
        left, after = left - (spent or 0), refused
    return items.where(F.coalesce(taken, F.lit(False)))


def latest(rows: DataFrame, keys: list[str], order: str, n: int = 1) -> DataFrame:
    """The last n rows of each key by an explicit order."""
    if n == 1:
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), order).alias("row")).select("row.*")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where(F.col("_n") <= n).drop("_n")
