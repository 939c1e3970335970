"""What became of the units of a run: resumes, tallies, gates, breakers and archives of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BREAKER_UNITS, GATE_SAMPLE, NEIGHBOURS = 5, 20, 2


def resumed(work: DataFrame, landed: DataFrame, key: str, size: str) -> DataFrame:
    """Work items with their outcome: skipped-existing where they landed, short where they did with fewer bytes, no-file without a size, else to-copy."""
    there = landed.groupBy(key).agg(F.max(size).alias("have"))
    state = F.when(F.col(size).isNull(), "no-file").when(F.col("have").isNull(), "to-copy").when(F.col("have") < F.col(size), "short").otherwise("skipped-existing")
    return work.join(there, key, "left").withColumn("outcome", state).drop("have")


def tallied(outcomes: DataFrame, *keys: str, size: str) -> DataFrame:
    """Units and bytes by outcome."""
    return outcomes.groupBy(*keys, "outcome").agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("bytes"))


def broken(results: DataFrame, run: str, order: str, first: int = BREAKER_UNITS) -> DataFrame:
    """Runs (run, order, status) that failed `first` times before any unit succeeded: the fault is systemic. Two aggregations, no window."""
    good = results.where(F.col("status").isin("ok", "skipped-complete")).groupBy(run).agg(F.min(order).alias("_good"))
    early = (F.col("status") == "failed") & (F.col("_good").isNull() | (F.col(order) < F.col("_good")))
    return results.join(good, run, "left").groupBy(run).agg((F.count_if(early) >= first).alias("broken"))


def gate_samples(expected: DataFrame, landed: DataFrame, group: str, key: str, n: int = GATE_SAMPLE, near: int = NEIGHBOURS) -> DataFrame:
    """The first n missing keys (a report), each with its number of landed neighbours in its group, `near` at most."""
    missing = expected.join(landed.select(key), key, "left_anti").orderBy(key).limit(n)
    here = landed.join(F.broadcast(missing.select(group).distinct()), group, "left_semi").groupBy(group).agg(F.count("*").alias("here"))
    return missing.join(here, group, "left").select(group, key, F.least(F.coalesce("here", F.lit(0)), F.lit(near)).cast("long").alias("neighbours"))


def gate_neighbours(expected: DataFrame, landed: DataFrame, group: str, key: str, n: int = GATE_SAMPLE, near: int = NEIGHBOURS) -> DataFrame:
    """The first n missing keys (a report) with the first `near` landed keys of their group, or none."""
    missing = expected.join(landed.select(key), key, "left_anti").orderBy(key).limit(n)
    here = landed.join(F.broadcast(missing.select(group).distinct()), group, "left_semi")
    taken = None
    for _ in range(near):  # the next key of each group, by one aggregation each
        left = here if taken is None else here.join(taken.groupBy(group).agg(F.max("neighbour").alias("last")), group).where(F.col(key) > F.col("last"))
        one = left.groupBy(group).agg(F.min(key).alias("neighbour"))
        taken = one if taken is None else taken.union(one)
    return missing.join(taken, group, "left").select(group, key, "neighbour")


def rolled_up(jobs: DataFrame, source: DataFrame, destination: DataFrame, key: str, deep: bool = False) -> DataFrame:
    """Count and bytes of each job at both ends: ok, MISMATCH, or LIST-ERROR where an end could not be listed; deep: DEEP-DIFF where only bytes differ."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.count("*").alias(f"{name}_n"), F.sum("size").cast("long").alias(f"{name}_bytes"))

    j = jobs.join(side(source, "src"), key, "left").join(side(destination, "dst"), key, "left")
    same = (F.col("src_n") == F.col("dst_n")) & (F.col("src_bytes") == F.col("dst_bytes"))
    state = F.when(F.col("src_n").isNull() | F.col("dst_n").isNull(), "LIST-ERROR").when(same, "ok")
    state = state.when(F.col("src_n") == F.col("dst_n"), "DEEP-DIFF") if deep else state
    return j.withColumn("status", state.otherwise("MISMATCH"))


def batched(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Numbered batches of at most `size` rows of each group."""
    at = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    return rows.withColumn("batch", F.floor(at / size).cast("long"))


def unique_times(runs: DataFrame, key: str, seconds: str, order: str) -> DataFrame:
    """Run times made unique: a run that would not be later than the one before takes the next second.

    t'(k) = max(t(k), t'(k-1) + 1) has the closed form k + max over j <= k of (t(j) - j), one running maximum.
    """
    w = Window.partitionBy(key).orderBy(order)
    k = F.row_number().over(w)
    lead = F.max(F.col(seconds) - F.col("_k")).over(w)
    return runs.withColumn("_k", k).withColumn("unique_s", F.col("_k") + lead).drop("_k")


def committed(lines: DataFrame, log: str, order: str, size: str, offset: Column) -> DataFrame:
    """Lines of each log that end at or before its committed byte offset; what follows is written again."""
    end = F.sum(size).over(Window.partitionBy(log).orderBy(order))
    return lines.withColumn("end", end).where(F.col("end") <= offset)


def complete(kept: Column, at_source: Column, both_ways: Column) -> Column:
    """A walk is complete with at least the source's count; one that hit the page cap must have come from both ends."""
    return F.when(at_source.isNull(), "unknown").when(kept >= at_source, "complete").when(both_ways, "gap-in-the-middle").otherwise("partial")


def archived(entities: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """Entities with their archive state: the last of (key, seq, action) decides; entities in flight refuse to go."""
    last = flags.groupBy(key).agg(F.max_by("action", "seq").alias("action"))
    gone = (F.col("action") == "offboard") & ~F.coalesce("in_flight", F.lit(False))
    return entities.join(last, key, "left").withColumn("archived", F.coalesce(gone, F.lit(False))).withColumn("refused", F.coalesce((F.col("action") == "offboard") & F.col("in_flight"), F.lit(False))).drop("action")
