"""Structured Streaming forms of the batch operators over events, and a run of one over what is there now."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.storage import run_dir


def events(spark: SparkSession, folder: str, name: str, per_trigger: int = 1) -> DataFrame:
    """A table's files as a stream; the time is read as a timestamp, which watermarks need."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", per_trigger).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(stream: DataFrame, width: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(stream: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n"))


def without_repeats(stream: DataFrame, key: list[str], late: str = "1 hour") -> DataFrame:
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)


def running_top(stream: DataFrame) -> DataFrame:
    """Per user the largest value so far and how many rows came, kept as state across triggers."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        top, n = state.get if state.exists else (float("-inf"), 0)
        for f in frames:
            n += len(f)
            top = max(top, float(f["value"].max())) if len(f) and f["value"].notna().any() else top
        state.update((top, n))
        yield pd.DataFrame({"user_id": [key[0]], "top": pd.Series([top if top > float("-inf") else None], dtype="Float64"), "n": [n]})

    return stream.groupBy("user_id").applyInPandasWithState(step, "user_id long, top double, n long", "top double, n long", "update", GroupStateTimeout.NoTimeout)


def run_now(result: DataFrame, mode: str) -> DataFrame:
    """Runs a stream over all that is there now, to a table in the shared folder; complete results replace, others add up."""
    spark = result.sparkSession
    path = f"{run_dir(spark)}/stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, number: int) -> None:
        # A batch that runs again after a failure replaces what it wrote before.
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    query = result.writeStream.outputMode(mode).option("checkpointLocation", f"{path}-state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(path if mode == "complete" else f"{path}/batch=*")


def arrivals(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """Parquet files of a folder as they come in."""
    return spark.readStream.schema(like.schema).parquet(folder)


def carry_on(result: DataFrame, path: str) -> DataFrame:
    """Appends to the table at `path` what has come since the last run of the same stream, each row once, then stops.

    Progress lies beside the table in `path`-state: a run that is lost, or that is followed by another, goes on from there.
    The table has a log of the files that count, so what a lost run left behind is not read.
    """
    query = result.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start(path)
    query.awaitTermination()
    return result.sparkSession.read.schema(result.schema).parquet(path)
