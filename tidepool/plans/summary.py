"""Counts of a run: events by state, sources by status, productions; one table of (what, key, n) each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, what: str, by: Column) -> DataFrame:
    return df.groupBy(by.cast("string").alias("key")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "key", "n")


def run_counts(sources: DataFrame, raw: DataFrame, events: DataFrame) -> DataFrame:
    """Sources by status and route, raw events by channel, events by relevance and verdict (null: "(pending)"), totals."""
    parts = [
        counted(sources, "source status", F.coalesce("status", F.lit("(unknown)"))),
        counted(sources, "route", F.coalesce("route", F.lit("none"))),
        counted(raw, "channel", F.col("channel")),
        counted(events, "relevance", F.col("relevance")),
        counted(events, "verdict", F.coalesce("verdict", F.lit("(pending)"))),
        counted(raw, "total", F.lit("raw events")),
        counted(events, "total", F.lit("events")),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("what", F.desc("n"), "key")


def pull_summary(pulls: DataFrame) -> DataFrame:
    """pulls(source_id, status, n) by status, and the events of those that count (ok, or empty with old rows kept)."""
    return pulls.groupBy("status").agg(F.count("*").alias("sources"), F.sum(F.when(F.col("status").isin("ok", "empty-kept"), F.col("n")).otherwise(0)).alias("events"))


def export_counts(rows: DataFrame) -> DataFrame:
    """Rows, productions and flagged productions of an export."""
    head = ~F.col("continuation")
    return rows.agg(F.count("*").alias("rows"), F.count_if(head).alias("productions"), F.count_if(head & (F.size("flags") > 0)).alias("flagged"), F.count_if(F.size("problems") > 0).alias("with_problems"))


def totals_by_origin(listings: DataFrame) -> DataFrame:
    return listings.groupBy("origin").agg(F.count("*").alias("n")).orderBy("origin")
