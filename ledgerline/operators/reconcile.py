"""Declared against received: matching, deductions, flags, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import leaf, norm

TOLERANCE = 0.98


def sources_of(services: DataFrame, sources: DataFrame) -> DataFrame:
    """(service, source) by the full name or the last segment, normalised; a `prefix` pin replaces the name. Once per pair; not exclusive."""
    wanted = services.select("service", F.explode(F.coalesce("prefix", F.array("service"))).alias("name")).select("service", norm(F.col("name")).alias("k"))
    names = sources.select("source", F.explode(F.array_distinct(F.array(norm(F.col("source")), norm(leaf(F.col("source")))))).alias("k"))
    return wanted.where("k <> ''").join(names, "k").select("service", "source").distinct()


def split_sources(sources: DataFrame, children: DataFrame, parents: DataFrame) -> DataFrame:
    """Split parents are replaced by their children (source, parent, blobs, comp, unc) and what these leave of them."""
    cols = ["blobs", "comp", "unc"]
    parted = children.join(parents.select(F.col("source").alias("parent")), "parent", "left_semi").join(sources.select(F.col("source").alias("parent")), "parent", "left_semi")
    sums = parted.groupBy("parent").agg(*(F.sum(c).alias(f"sum_{c}") for c in cols))
    rest = sources.join(sums, sources["source"] == sums["parent"]).select(F.concat("source", F.lit("/(unaccounted)")).alias("source"), *(F.greatest(F.col(c) - F.col(f"sum_{c}"), F.lit(0)).alias(c) for c in cols))
    kept = sources.join(sums.select(F.col("parent").alias("source")), "source", "left_anti").select("source", *cols)
    return kept.unionByName(parted.select("source", *cols)).unionByName(rest.where("blobs > 0 or comp > 0 or unc > 0"))


def deducted(sources: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Sources without wholly redundant ones; partly redundant ones lose their redundant bytes. duplicates: (source, redundant), null = all."""
    d = sources.join(duplicates, "source", "left").withColumn("redundant", F.when(F.col("redundant").isNull() & F.col("listed").isNotNull(), F.col("unc")).when(F.col("redundant").isNotNull(), F.least("redundant", "unc")))
    return d.where("redundant is null or redundant < unc").select("source", "blobs", "comp", (F.col("unc") - F.coalesce("redundant", F.lit(0))).alias("unc"), F.coalesce("redundant", F.lit(0)).alias("deduplicated"))


def duplicate_rollup(blobs: DataFrame) -> DataFrame:
    """Per top prefix the copies beyond the first of (top, basename, clen, uncomp)."""
    from ..functions.paths import top

    groups = blobs.groupBy(top(F.col("name")).alias("source"), leaf(F.col("name")).alias("base"), "clen", "uncomp").agg(F.count("*").alias("n")).where("n > 1")
    return groups.groupBy("source").agg(F.sum(F.col("n") - 1).cast("long").alias("files"), F.sum((F.col("n") - 1) * F.col("uncomp")).cast("long").alias("bytes"))


def flags(declared: Column, records: Column, actual: Column, found: Column, equivalent: Column, deduplicated: Column) -> tuple[Column, Column]:
    """(flags in order, percentage) of a service row."""
    eq = F.nullif(equivalent, F.lit(0))
    pct = F.when(declared > 0, F.when((actual == 0) & (found > 0), F.try_divide(found, declared) * 100).when(eq.isNotNull() & (actual > 0), F.try_divide(eq, declared) * 100).otherwise(F.try_divide(actual, declared) * 100))
    pct = F.when(records.isNull(), pct)
    embedded = (actual == 0) & (F.coalesce(found, F.lit(0)) > 0)

    def flag(condition: Column, name: str) -> Column:
        return F.when(condition, name)

    by_bytes = records.isNull() & (declared > 0)
    out = F.array(
        flag(F.coalesce(deduplicated, F.lit(0)) > 0, "deduplicated"),
        flag(records.isNotNull(), "record-count"),
        flag(records.isNull() & (declared == 0) & (actual > 0), "zero-declared-has-data"),
        flag(by_bytes & eq.isNotNull() & (actual > 0), "unit-adjusted"),
        flag((records.isNotNull() | by_bytes) & embedded, "found-embedded"),
        flag(by_bytes & (actual == 0) & ~embedded, "declared-empty"),
        flag(by_bytes & (pct > 100) & ~(eq.isNotNull() & (actual > 0)), "overshoot"),
    )
    return F.array_compact(out), pct


def service_rows(services: DataFrame, sources: DataFrame, found: DataFrame) -> DataFrame:
    """Each declared service (service, declared, records, prefix, equivalent) with what was received and flags; found: (service key, bytes)."""
    pairs = sources_of(services, sources)
    got = pairs.join(sources, "source").groupBy("service").agg(F.sum("unc").alias("actual"), F.sum("blobs").alias("blobs"), F.sum("deduplicated").alias("dedup"))
    one = found.groupBy(norm(F.col("service")).alias("fk")).agg(F.min_by("bytes", "service").alias("found"))  # of several spellings the first by name
    rows = services.join(got, "service", "left").join(one, norm(services["service"]) == F.col("fk"), "left")
    rows = rows.withColumn("actual", F.coalesce("actual", F.lit(0))).withColumn("blobs", F.coalesce("blobs", F.lit(0)))
    fl, pct = flags(F.col("declared"), F.col("records"), F.col("actual"), F.col("found"), F.col("equivalent"), F.col("dedup"))
    return rows.select("service", "declared", "records", "actual", "blobs", F.coalesce("found", F.lit(0)).alias("found"), fl.alias("flags"), pct.alias("pct"))


def unexpected(services: DataFrame, sources: DataFrame) -> DataFrame:
    return sources.join(sources_of(services, sources), "source", "left_anti")


def headline(raw: Column, duplicates: Column, excluded: Column, manifest: Column) -> dict[str, Column]:
    unc = raw - F.coalesce(duplicates, F.lit(0)) - F.coalesce(excluded, F.lit(0))
    return {"unc": unc, "pct": F.when(manifest > 0, F.try_divide(unc * 100.0, manifest)), "remaining": F.greatest(manifest - unc, F.lit(0))}


def verdict(confirmed: Column, has_run: Column, headline_ok: Column, services_ok: Column, zero_bytes: Column, no_unexpected: Column) -> Column:
    ok = headline_ok & services_ok & F.coalesce(zero_bytes, F.lit(True)) & no_unexpected
    return F.when(~F.coalesce(confirmed & has_run, F.lit(False)), "cannot-verify").when(F.coalesce(ok, F.lit(False)), "complete").otherwise("incomplete")
