"""Where records go: JSON lines, folders by bucket, and shards whose column is rewritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str, bucket: str | None = None) -> None:
    """A JSON object a line, nulls written, characters as they are. bucket: a column whose values become folders, and which leaves the lines; nulls go to Spark's folder for them."""
    kept = [c for c in df.columns if c != bucket]
    line = F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("value")
    if bucket is None:
        df.select(line).write.text(path)
    else:
        df.select(line, bucket).write.partitionBy(bucket).text(path)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds the marker that Spark writes last, once all tasks have committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(marker)


def rewrite_column(spark: SparkSession, old: str, new: str, column: str, value: Column) -> bool:
    """Shards of Parquet under `old` written to `new` with one column by another expression; whether it had to be done: a finished `new` stays, an unfinished one is replaced.

    The old shards are never touched, so a run that is lost loses nothing, and readers change over once `new` is finished.
    """
    if finished(spark, new):
        return False
    spark.read.parquet(old).withColumn(column, value).write.mode("overwrite").parquet(new)
    return True
