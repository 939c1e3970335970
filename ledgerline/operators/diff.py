"""Differences of manifests, folders, ledgers and catalogues with what landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import dotless

#: Sorted samples of mismatches that a report shows; totals always count all.
SAMPLE = 1000


def manifest_diff(manifest: DataFrame, destination: DataFrame) -> DataFrame:
    """Full outer comparison of (key, size): ok, MISSING-DEST, EXTRA-DEST or SIZE-DIFF, by one sort-merge join."""
    m, d = manifest.select("key", F.col("size").alias("src_bytes")).hint("merge"), destination.select("key", F.col("size").alias("dst_bytes"))
    state = F.when(F.col("dst_bytes").isNull(), "MISSING-DEST").when(F.col("src_bytes").isNull(), "EXTRA-DEST").when(F.col("src_bytes") != F.col("dst_bytes"), "SIZE-DIFF").otherwise("ok")
    return m.join(d, "key", "full_outer").select("key", "src_bytes", "dst_bytes", state.alias("status"))


def not_ascending(keys: DataFrame) -> DataFrame:
    """Keys that appear more than once, which a diff must not get."""
    return keys.groupBy("key").count().where("count > 1")


def repair_list(diff: DataFrame) -> DataFrame:
    return diff.where("status = 'MISSING-DEST'").select("key", F.col("src_bytes").alias("size"))


def mismatch_sample(diff: DataFrame, n: int = SAMPLE) -> DataFrame:
    return diff.where("status <> 'ok'").orderBy("key").limit(n)


def diff_totals(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count("*").alias("n"), F.sum(F.coalesce("src_bytes", F.lit(0))).cast("long").alias("src_bytes"), F.sum(F.coalesce("dst_bytes", F.lit(0))).cast("long").alias("dst_bytes"))


def folder_diff(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Per folder, on names without trailing dots: missing, mismatched, matched, dest_only and side files (.meta.json)."""
    e = expected.select("folder", dotless(F.col("rel")).alias("rel"), F.col("size").alias("want"))
    d = landed.select("folder", dotless(F.col("rel")).alias("rel"), F.col("size").alias("have"))
    j = e.join(d, ["folder", "rel"], "full_outer")
    side = F.col("want").isNull() & F.endswith("rel", F.lit(".meta.json"))
    return j.groupBy("folder").agg(
        F.count_if(F.col("have").isNull()).alias("missing"),
        F.count_if(F.col("want") != F.col("have")).alias("mismatched"),
        F.count_if(F.col("want") == F.col("have")).alias("matched"),
        F.coalesce(F.sum(F.when(F.col("want") == F.col("have"), F.col("want"))), F.lit(0)).cast("long").alias("matched_bytes"),
        F.count_if(F.col("want").isNull() & ~side).alias("dest_only"),
        F.count_if(side).alias("sidecars"),
    )


def unit_check(units: DataFrame, blobs: DataFrame) -> DataFrame:
    """Units (unit, status, staged) against blobs (unit, is_marker, size): the unit key is derived from the path before, so this is an equi-join."""
    landed = blobs.groupBy("unit").agg(F.sum("size").cast("long").alias("landed"), F.bool_or("is_marker").alias("marker"))
    u = units.join(landed, "unit", "left").withColumn("landed", F.coalesce("landed", F.lit(0))).withColumn("marker", F.coalesce("marker", F.lit(False)))
    done = F.col("status").isin("ok", "skipped-complete", "partial")
    result = (
        F.when(F.col("status") == "failed", "failed")
        .when(~done, "unchecked")
        .when(~F.col("marker"), "missing-marker")
        .when((F.col("staged") > 0) & (F.col("landed") < F.col("staged")), "short")
        .when((F.col("staged") > 0) & (F.col("landed") > F.col("staged")), "stale-extra")
        .otherwise("ok")
    )
    return u.select("unit", "status", "staged", "landed", result.alias("result"))


def catalogue_check(catalogue: DataFrame, landed: DataFrame) -> DataFrame:
    """Catalogue (id, sizes array) against landed (id, size): the landed size must be one of the declared ones."""
    j = catalogue.join(landed, "id", "full_outer")
    state = F.when(F.col("sizes").isNull(), "extra").when(F.col("size").isNull(), "missing").when((F.size("sizes") > 0) & ~F.array_contains("sizes", F.col("size")), "size-mismatch").otherwise("ok")
    return j.select("id", "size", state.alias("state"))


def ledger_check(ledger: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected ledger rows (blob, size, status) against landed (blob, bytes)."""
    want = ledger.where(F.col("status").isin("copied", "present"))
    j = want.join(landed, "blob", "full_outer")
    state = F.when(F.col("status").isNull(), "unexpected").when(F.col("bytes").isNull(), "missing").when((F.col("size") > 0) & (F.col("size") != F.col("bytes")), "mismatch").when((F.coalesce("size", F.lit(0)) == 0) & (F.col("bytes") == 0), "zero-length").otherwise("ok")
    return j.select("blob", "size", "bytes", state.alias("state"))


def distinct_versions(versions: DataFrame) -> DataFrame:
    """Non-latest versions whose etag differs from the current one and from those kept before, in order (key, seq, version, etag, is_latest)."""
    current = versions.where("is_latest").groupBy("key").agg(F.min_by("etag", "seq").alias("current"))
    first = versions.where(~F.col("is_latest")).groupBy("key", "etag").agg(F.min_by(F.struct(*versions.columns), "seq").alias("v")).select("v.*")
    return first.join(current, "key", "left").where(~F.coalesce(F.col("etag") == F.col("current"), F.lit(False))).select(versions.columns)


def merged_columns(chunks: DataFrame, key: str, order: str) -> DataFrame:
    """Column chunks merged by key; a later chunk's present value wins, null included where it is marked present (column name: value struct)."""
    values = [c for c in chunks.columns if c not in (key, order)]
    return chunks.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in values))
