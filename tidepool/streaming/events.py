"""Streaming forms of two batch operators: latest state per key, and sessions by gap. An extension, not parity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, *, key: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of a key, closed when the watermark passes their gap; works on batch frames too."""
    return (
        events.withWatermark(ts, late)
        .groupBy(F.session_window(ts, gap).alias("w"), F.col(key))
        .agg(F.count("*").alias("n"))
        .select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
    )


def hourly_counts(events: DataFrame, *, ts: str = "ts", kind: str = "event_type", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, "1 hour").alias("w"), F.col(kind)).agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), kind, "n")


def keep_latest(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]):
    """Fold each micro-batch into a table of the latest row per key; versions are written side by side, so a batch that is run again gives the same table."""
    from ..operators.merge import latest_wins

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = latest_wins(batch, keys, order)
        if batch_id > 0:
            new = latest_wins(spark.read.parquet(f"{path}/v={batch_id - 1}").unionByName(new), keys, order)
        new.write.mode("overwrite").parquet(f"{path}/v={batch_id}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
