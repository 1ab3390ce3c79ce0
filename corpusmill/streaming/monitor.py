"""Streams: windowed averages of scores with late data, alarms, and once-only appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_means(events: DataFrame, ts: str, value: str, by: str, window: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Per window and series: observations and mean; events later than the watermark are left out."""
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    out = events.withWatermark(ts, late).groupBy(span, by).agg(F.count("*").alias("observed"), F.avg(value).alias("mean"))
    return out.select(F.col("window.start").alias("start"), by, "observed", "mean")


def session_counts(events: DataFrame, ts: str, by: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Events per session: runs of a series without a pause longer than the gap."""
    s = F.session_window(ts, gap)
    return events.withWatermark(ts, late).groupBy(s, by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def first_only(events: DataFrame, ts: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def append_once(stream: DataFrame, path: str, key: str, checkpoint: str) -> StreamingQuery:
    """Appends rows whose key isn't in the table yet, batch by batch, so a restart repeats nothing."""
    from corpusmill.plans.export import append_new

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: append_new(df.dropDuplicates([key]), path, key)).start()
