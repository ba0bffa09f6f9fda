"""Streaming form of the same-day queue: signals arrive as files.

A lead has one row a day in the queue: its first signal of the day (ties by type), and how many there
were. The row is held in state and leaves when the watermark passes the end of the day, so it does not
depend on how the signals were cut into batches; signals behind the watermark are dropped, and state
lives no longer than a day and the allowed lateness. Rows are appended to a table by day: a batch that
runs again after a failure reads only the days that it writes, and adds nothing that is there.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

QUEUE = "day date, lead_no bigint, trigger_type string, first_ts timestamp, n bigint"
_DAY_MS = 86_400_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class FirstSignal(StatefulProcessor):
    """State of a (day, lead): first signal and count; a timer at the end of the day lets it go."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "ts timestamp, trigger_type string, n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.first.exists()
        ts, kind, n = self.first.get() if known else (None, None, 0)
        for f in rows:
            best = f.sort_values(["ts", "trigger_type"]).iloc[0]
            mine = (pd.Timestamp(best["ts"]), best["trigger_type"])
            if ts is None or mine < (pd.Timestamp(ts), kind):
                ts, kind = mine
            n += len(f)
        self.first.update((pd.Timestamp(ts).to_pydatetime(), kind, int(n)))
        if not known:
            day = pd.Timestamp(key[0]).tz_localize("UTC")
            self.handle.registerTimer(day.value // 1_000_000 + _DAY_MS)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ts, kind, n = self.first.get()
        self.first.clear()
        yield pd.DataFrame({"day": [key[0]], "lead_no": [key[1]], "trigger_type": [kind], "first_ts": [ts], "n": [n]})

    def close(self) -> None:
        pass


def queue_stream(signals: DataFrame, late: str = "1 day") -> DataFrame:
    """(day, lead_no, trigger_type, first_ts, n) of each lead and day, once the watermark has passed the
    day. signals: (lead_no, trigger_type, ts), session zone UTC; rows without lead or time are left out."""
    timed = signals.select(F.col("lead_no").cast("bigint").alias("lead_no"), "trigger_type", F.col("ts").cast("timestamp").alias("ts")).filter("lead_no is not null and ts is not null")
    keyed = timed.withWatermark("ts", late).withColumn("day", F.to_date("ts"))
    return keyed.groupBy("day", "lead_no").transformWithStateInPandas(FirstSignal(), QUEUE, "Append", "EventTime")


def deduplicated_stream(signals: DataFrame, within: str = "7 days") -> DataFrame:
    timed = signals.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", within).dropDuplicatesWithinWatermark(["lead_no", "trigger_type"])


def append_batch(target: str, keys: list[str], by: str = "day"):
    """A foreachBatch function that adds only keys that the target table does not hold yet. The table is
    partitioned by a key column, and only the partitions of the batch are read."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(keys).persist()
        try:
            values = [r[0] for r in new.select(by).distinct().collect()]  # days of a batch
            if not values:
                return
            try:
                old = spark.read.schema(batch.schema).parquet(target).filter(F.col(by).isin(values)).select(*keys)
            except Exception as e:  # no table yet
                if "PATH_NOT_FOUND" not in str(e):
                    raise
            else:
                new = new.join(old, keys, "left_anti")
            new.write.mode("append").partitionBy(by).parquet(target)
        finally:
            new.unpersist()

    return write


@contextmanager
def _timers(spark: SparkSession):
    """Custom state with timers needs the RocksDB store; the session's own setting comes back after."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def drain(spark: SparkSession, signals: DataFrame, folder: str, late: str = "1 day") -> DataFrame:
    """Run the queue over the signals that have landed and give the table of all closed days so far. A
    later call goes on from the checkpoint in the folder."""
    target = f"{folder}/queue"
    with _timers(spark):
        writer = queue_stream(signals, late).writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        writer.foreachBatch(append_batch(target, ["day", "lead_no"])).start().awaitTermination()
    return spark.read.schema(QUEUE).parquet(target)


def run_once(spark: SparkSession, source_folder: str, schema, folder: str, files_per_batch: int = 1, late: str = "1 day") -> DataFrame:
    """Drain landed Parquet files through the queue, so many files a batch."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_folder)
    return drain(spark, raw, folder, late)
