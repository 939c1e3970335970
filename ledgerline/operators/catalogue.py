"""Catalogues of units: matching, work orders, best candidates, trees, first sightings, totals of a fleet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matched(rows: DataFrame, key: str, by: dict[str, DataFrame]) -> DataFrame:
    """rows with the match of the first of several relations (key, match columns...) that has their key; `confidence` names it, else ambiguous."""
    state, found = F.lit("ambiguous"), F.lit(False)
    for name, other in by.items():
        hit = f"_{name}"
        rows = rows.join(other.withColumn(hit, F.lit(True)), (~found if name != next(iter(by)) else F.lit(True)) & (rows[key] == other[key]), "left").drop(other[key])
        found = found | F.coalesce(F.col(hit), F.lit(False))
    for name in reversed(by):
        state = F.when(F.col(f"_{name}"), name).otherwise(state)
    return rows.withColumn("confidence", state).drop(*(f"_{name}" for name in by))


def calibration(rows: DataFrame, size: str, least: int, n: int, *ties: str) -> DataFrame:
    """The n largest rows of at least a size, with which a run is calibrated (a top-k report)."""
    return rows.where(F.col(size) >= least).orderBy(F.desc(size), *ties).limit(n)


def work_order(rows: DataFrame, calibrates: str, limit: int, *order: Column | str) -> DataFrame:
    """rows in the order of work, as `rn`; a run's limit never drops rows that calibrate it (the limit is what a run asks for)."""
    w = Window.partitionBy(calibrates).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w).cast("long")).where(F.col(calibrates) | (F.col("rn") <= limit))


def best(candidates: DataFrame, unit: str, value: str, *order: Column | str) -> DataFrame:
    """Each unit's best candidate, by one aggregation without a window."""
    return candidates.groupBy(unit).agg(F.min_by(value, F.struct(*order)).alias(value))


def flattened(edges: DataFrame, depth: int = 20) -> DataFrame:
    """(id, path, depth) of a tree (id, parent, name), to a depth, by a recursive query."""
    edges.createOrReplaceTempView("ledgerline_tree")
    return edges.sparkSession.sql(
        f"WITH RECURSIVE w(id, path, depth) AS (SELECT id, name, 0 FROM ledgerline_tree WHERE parent IS NULL UNION ALL SELECT e.id, concat(w.path, '/', e.name), w.depth + 1 FROM ledgerline_tree e JOIN w ON e.parent = w.id WHERE w.depth < {depth}) SELECT id, path, CAST(depth AS BIGINT) AS depth FROM w"
    )


def first_sightings(rows: DataFrame, file: str, order: str) -> DataFrame:
    """rows with `part`: the first sighting of a file is its object, later ones are shares."""
    owner = rows.groupBy(file).agg(F.min(order).alias("_owner"))
    return rows.join(owner, file).withColumn("part", F.when(F.col(order) == F.col("_owner"), "object").otherwise("share")).drop("_owner")


def fleet_totals(entities: DataFrame) -> DataFrame:
    """Totals over entities (received, declared); received bytes count only where something was declared."""
    mine = F.sum(F.when(F.col("declared").isNotNull(), F.col("received")))
    return entities.agg(F.count("*").alias("entities"), F.sum(F.coalesce("declared", F.lit(0))).alias("declared"), mine.alias("received"), F.try_divide(mine.cast("double") * 100, F.sum("declared").cast("double")).alias("pct"))
