"""What the operators of this subpackage share: tables, checkpoints, batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
_made: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_limits(spark: SparkSession) -> None:
    """Batches that Python gets are bounded in rows and bytes, so that long texts can't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is named, local mode takes a folder of its own; a cluster is refused."""
    jsc = spark.sparkContext._jsc.sc()
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if jsc.getCheckpointDir().isDefined():
            return jsc.getCheckpointDir().get()
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        folder = f"{tempfile.gettempdir()}/ledgerline-checkpoints"
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _run_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; it's deleted when the application ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/ledgerline/{spark.sparkContext.applicationId}"
    if folder not in _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _made.add(folder)
    return folder


def saved(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{_run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Queries that run within delete their shuffle files as they end, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def dropped(*tables: DataFrame | None) -> None:
    """Deletes the files behind tables that saved() returned and nothing reads again."""
    for df in tables:
        if df is not None:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                if "/ledgerline/" in folder:
                    path = jvm.org.apache.hadoop.fs.Path(folder)
                    path.getFileSystem(conf).delete(path, True)


def release() -> None:
    """Arrow's pool gives back what it holds unused, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()


def over_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """f over Arrow batches of df."""
    arrow_limits(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = f(batch)
            if out is not None and out.num_rows:
                yield out
        release()

    return df.mapInArrow(run, schema)


def crc32_mod(column: str, n: int) -> F.Column:
    """crc32 of a column's text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n
