"""Queries of the streaming extension: whole tables read as streams until they are through."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.queries import query
from corpusmill.session import scratch, table
from corpusmill.streaming import monitor as M


def _stream(spark, d, name, *cols):
    """A table's columns as a stream of files."""
    path, rows = scratch(spark, f"stream-{name}"), table(spark, d, name).select(*cols)
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


@query("select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as observed, round(avg(floor(value * 100 + 0.5)::bigint), 6)::double as mean_hundredths from events group by 1, 2")
def stream_windows(spark, d):
    """Hourly means of each kind of event, kept up to date while the stream runs."""
    e = _stream(spark, d, "events", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.floor(F.col("value") * 100 + 0.5).cast("bigint").alias("v"))
    path = scratch(spark, "stream-means")
    means = M.windowed_means(e, "ts", "v", "event_type", "1 hour")
    means.writeStream.outputMode("complete").option("checkpointLocation", scratch(spark, "stream-state")).trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).start().awaitTermination()
    return spark.read.parquet(path).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "observed", F.round("mean", 6).alias("mean_hundredths"))


@query("select event_id, user_id from events")
def stream_append(spark, d):
    """Events appended batch by batch, each once, though the stream is run twice."""
    path, e = scratch(spark, "stream-target"), _stream(spark, d, "events", "event_id", "user_id")
    for _ in range(2):
        M.append_once(e, path, "event_id", scratch(spark, "stream-offsets")).awaitTermination()
    return spark.read.parquet(path)
