"""Structured Streaming forms of the incremental operators.

Cursors and resume files become checkpoints; every query can run to the end of
what is there (AvailableNow) and be run again for what came since.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def landed(spark: SparkSession, path: str, schema: str, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def throughput(log: DataFrame, width: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Rows and sums by trailing window and type; late rows count until the watermark passes."""
    return log.withWatermark("at", late).groupBy(F.window("at", width), "event_type").agg(F.count("*").alias("n"), F.sum("size").alias("size")).select(F.col("window.start").alias("start"), "event_type", "n", "size")


def deduplicated(rows: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """First rows by key while the watermark remembers them; a restart from a coarse cursor repeats none."""
    return rows.withWatermark("at", late).dropDuplicatesWithinWatermark(keys)


class Pace(StatefulProcessor):
    """Additive increase, multiplicative decrease: a throttle halves the rate at most once in 20 s, a clean minute adds a half."""

    least, most, step, cool, clean = 2.0, 20.0, 0.5, 20.0, 60.0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("pace", "rate double, throttled double, bumped double")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        rate, throttled, bumped = self.state.get() if self.state.exists() else (self.most, -1e9, None)
        for df in rows:
            for at, bad in sorted(zip(df["second"], df["throttle"], strict=True)):
                rate, throttled, bumped = paced(rate, throttled, at if bumped is None else bumped, at, bad, self)
        self.state.update((rate, throttled, bumped))
        yield pd.DataFrame({"key": [key[0]], "rate": [rate]})

    def close(self) -> None:
        pass


def paced(rate: float, throttled: float, bumped: float, at: float, bad: bool, p: type[Pace] | Pace = Pace) -> tuple[float, float, float]:
    if bad:
        return (rate if at - throttled < p.cool else max(p.least, rate / 2)), at, at
    if at - bumped >= p.clean and at - throttled >= p.clean and rate < p.most:
        return min(p.most, rate + p.step), throttled, at
    return rate, throttled, bumped


def pace(events: DataFrame) -> DataFrame:
    """(key, rate) after events (key, second, throttle); batch or stream. A key's events are folded in order."""
    if events.isStreaming:
        return events.groupBy("key").transformWithStateInPandas(Pace(), "key long, rate double", "Update", "none")

    def fold(df: pd.DataFrame) -> pd.DataFrame:
        rate, throttled, bumped = Pace.most, -1e9, None
        for at, bad in sorted(zip(df["second"], df["throttle"], strict=True)):
            rate, throttled, bumped = paced(rate, throttled, at if bumped is None else bumped, at, bad)
        return pd.DataFrame({"key": [df["key"].iloc[0]], "rate": [rate]})

    return events.groupBy("key").applyInPandas(fold, "key long, rate double")


def run_once(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """What has landed, to Parquet; exactly once across restarts."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
