"""Writers: counted JSON lines, and publishing where units are created once and a run's metadata is replaced."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CLASS = "class"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (local mode may have one of its own), deleted when the application ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    top = f"{(folder or tempfile.gettempdir()).rstrip('/')}/ledgerline-scratch/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(top)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written and read again: what two branches of a plan must see alike, whatever is recomputed."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_lines(rows: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Writes JSON lines, all or none (the job's commit), and returns how many."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).json(path)
    return seen.get["n"]


def publish(files: DataFrame, path: str) -> None:
    """files (path, content): units under their path are created only where absent; those under _meta/ replace what was there."""
    spark = files.sparkSession
    classed = files.withColumn(CLASS, F.when(F.startswith("path", F.lit("_meta/")), "run-metadata").otherwise("unit"))
    units = classed.where(f"{CLASS} = 'unit'")
    if exists(spark, f"{path}/{CLASS}=unit"):
        units = units.join(spark.read.parquet(f"{path}/{CLASS}=unit").select("path"), "path", "left_anti")
    units.drop(CLASS).write.mode("append").parquet(f"{path}/{CLASS}=unit")
    classed.where(f"{CLASS} = 'run-metadata'").drop(CLASS).write.mode("overwrite").parquet(f"{path}/{CLASS}=run-metadata")


def published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/{CLASS}=unit", f"{path}/{CLASS}=run-metadata")
