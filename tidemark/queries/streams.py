"""Streams over the events table, run over all that is there; their batch SQL gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.queries.registry import Tables, query
from tidemark.queries.series import SESSIONS
from tidemark.storage import materialize, run_dir
from tidemark.streaming import closing, twins


def _stream(t: Tables) -> DataFrame:
    return twins.events(t.spark, t.sf_dir, "events.parquet")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def stream_tumbling(t: Tables) -> DataFrame:
    out = twins.run_now(twins.tumbling(_stream(t), "1 hour"), "complete")
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 4).alias("total"))


@query(SESSIONS + " SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM s GROUP BY user_id, session")
def stream_session(t: Tables) -> DataFrame:
    out = twins.run_now(twins.sessions(_stream(t), "30 minutes 1 microsecond"), "complete")
    return out.select("user_id", F.col("first_ts").cast("timestamp_ntz").alias("first_ts"), F.col("last_ts").cast("timestamp_ntz").alias("last_ts"), "n")


@query("SELECT DISTINCT event_id, user_id FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    twice = _stream(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return twins.run_now(twins.without_repeats(twice, ["event_id"]), "append").select("event_id", "user_id")


@query("SELECT user_id, max(value) AS top, count(*) AS n FROM events GROUP BY 1")
def stream_running_top(t: Tables) -> DataFrame:
    """Every trigger gives what changed; the last state of a user has the most rows."""
    out = twins.run_now(twins.running_top(_stream(t)), "update")
    return out.groupBy("user_id").agg(F.max_by("top", "n").alias("top"), F.max("n").alias("n"))


@query("SELECT event_id, 1 AS times, event_id % 2 = 0 AS in_first FROM events")
def stream_carried_on(t: Tables) -> DataFrame:
    """Half of the events come, then a run; the rest come, then two runs: every event is there once."""
    at = f"{run_dir(t.spark)}/arrivals-{uuid.uuid4().hex}"
    rows = t.events.select("event_id")
    rows.where("event_id % 2 = 0").write.parquet(at)
    stream = twins.arrivals(t.spark, at, rows)
    first = materialize(twins.carry_on(stream, f"{at}-out"), "first").withColumn("in_first", F.lit(True))
    rows.where("event_id % 2 <> 0").write.mode("append").parquet(at)
    twins.carry_on(stream, f"{at}-out")
    all_rows = twins.carry_on(stream, f"{at}-out").groupBy("event_id").agg(F.count("*").alias("times"))
    return all_rows.join(first, "event_id", "left").select("event_id", "times", F.coalesce("in_first", F.lit(False)).alias("in_first"))


#: Four deliveries by event_id; every tenth event comes with the last one. Windows are of a day, and closed when an event comes that is six hours past their end.
DELIVERED = """m AS (SELECT max(event_id) + 1 AS most FROM events), d AS (SELECT user_id, ts, value, CASE WHEN event_id % 10 = 3 THEN 3 ELSE event_id * 4 // most END AS part FROM events, m),
b AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM d GROUP BY part),
x AS (SELECT user_id, date_trunc('day', ts) AS day, value, coalesce(date_trunc('day', ts) + INTERVAL 30 HOUR <= seen, FALSE) AS late FROM d JOIN b USING (part))"""


@query(f"""WITH {DELIVERED}, e AS (SELECT max(ts) AS last FROM events)
SELECT user_id, day AS start, 'sum' AS kind, count(*) AS n, round(sum(value), 4) AS total FROM x, e WHERE NOT late AND day + INTERVAL 30 HOUR <= last GROUP BY user_id, day
UNION ALL SELECT user_id, NULL, 'late', count(*), NULL FROM x WHERE late GROUP BY user_id""")
def stream_late_rows(t: Tables) -> DataFrame:
    """Sums of users and days, each flushed once, over four runs of one stream whose state lives on between them; late rows are counted instead."""
    at = f"{run_dir(t.spark)}/deliveries-{uuid.uuid4().hex}"
    most = (t.events.agg(F.max("event_id")).first()[0] or 0) + 1
    part = F.when(F.col("event_id") % 10 == 3, 3).otherwise(F.floor(F.col("event_id") * 4 / most))
    rows = materialize(t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value", part.cast("int").alias("part")), "deliveries")
    store = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(store, None)
    t.spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for k in range(4):
            rows.where(F.col("part") == k).drop("part").write.mode("append").parquet(at)
            stream = twins.arrivals(t.spark, at, rows.drop("part"))
            out = twins.carry_on(closing.closing_windows(stream, "user_id", "ts", "value", 86_400, 21_600, 400 * 86_400), f"{at}-out")
    finally:
        t.spark.conf.set(store, before) if before else t.spark.conf.unset(store)
    by = out.groupBy("key", "start", "kind").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))
    return by.select(F.col("key").alias("user_id"), F.col("start").cast("timestamp_ntz").alias("start"), "kind", "n", "total")
