"""Registered streaming queries: events from files, run over what is there, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.plans.registered import query, shared_path
from fathomline.streaming import streams


def events(table, spark):
    """The events table as a stream; its timestamps get the session's zone."""
    batch = table("events")
    import os.path

    folder, name = os.path.split(batch.inputFiles()[0].rpartition("?")[2])
    files = spark.readStream.schema(batch.schema)
    stream = files.parquet(folder) if folder.endswith(".parquet") else files.option("pathGlobFilter", name).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(stream, spark):
    folder = shared_path(spark, "stream")
    return streams.finished(stream, f"{folder}/out", f"{folder}/checkpoint")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(table, spark):
    """A watermark longer than the data: each key once."""
    return _run(streams.deduplicated(events(table, spark), ["user_id", "event_type"], late="3650 days").select("user_id", "event_type"), spark)


# A window is written once the watermark (latest event less one hour) has passed its end.
CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query(f"WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, event_type, value FROM events) SELECT epoch(s)::BIGINT AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w WHERE s + INTERVAL 1 HOUR <= {CLOSED} GROUP BY s, event_type")
def stream_tumbling(table, spark):
    out = _run(streams.tumbling(events(table, spark), ["event_type"]), spark)
    return out.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(f"""WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, epoch_us(min(ts)) AS start, count(*) AS n FROM s GROUP BY user_id, sid HAVING max(ts) + INTERVAL 30 MINUTE <= {CLOSED}""")
def stream_session(table, spark):
    return _run(streams.sessions(events(table, spark), ["user_id"]), spark).select("user_id", F.unix_micros("start").alias("start"), "n")
