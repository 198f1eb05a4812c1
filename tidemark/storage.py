"""The folder that driver and executors share, and what a run has written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset: a folder of our own on a single machine, as in tests, and an error on a cluster, whose executors wouldn't see it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """Where this application writes its intermediate tables."""
    return f"{shared_dir(spark)}/tidemark/{spark.conf.get('spark.app.id', 'app')}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: cuts the lineage, survives lost executors."""
    path = f"{run_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> bool:
    """Deletes the intermediate tables of this application, once the results that read them have been written; whether there were any."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
