"""Listing snapshots: a table of what is published already, folded, and joined with fresh sightings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators.ingest import upload_duplicates
from ..operators.merge import insert_new

SNAPSHOT = ["title", "venue", "start", "end"]


def read_snapshot(df: DataFrame) -> DataFrame:
    """(title, venue, start_date, end_date, origin) of a snapshot's rows; other headers than SNAPSHOT raise, rows without a title go.

    Days may be ISO or MM/dd/yyyy; a missing venue is "", so that equal rows are equal.
    """
    if [c.strip().lower() for c in df.columns] != SNAPSHOT:
        raise ValueError(f"expected the columns {SNAPSHOT}, got {df.columns}")
    df = df.toDF(*SNAPSHOT)
    day = lambda c: F.coalesce(D.as_date(c), D.iso_of_us_date(c).try_cast("date"))
    rows = df.select(T.nz(F.trim("title")).alias("title"), F.coalesce(F.trim("venue"), F.lit("")).alias("venue"), day("start").alias("start_date"), day("end").alias("end_date"))
    return rows.filter("title is not null").withColumn("origin", F.lit("snapshot"))


def fold_snapshot(rows: DataFrame) -> DataFrame:
    """rows(row_id, title, venue, start_date, end_date, ...) without those that repeat an earlier one."""
    kept = upload_duplicates(rows.select("row_id", "title", "venue", "start_date", "end_date")).filter("repeats is null").select("row_id")
    return rows.join(kept, "row_id", "left_semi")


def with_sightings(snapshot: DataFrame, sightings: DataFrame) -> DataFrame:
    """All listings: the snapshot's, and sighted ones whose title, venue and first day it hasn't."""
    new = sightings.withColumn("venue", F.coalesce("venue", F.lit(""))).withColumn("origin", F.lit("sighted"))
    return insert_new(snapshot, new, ["title", "venue", "start_date"], ["listing_id"])


def venue_names(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """(venue_id, name): the directory's, or the snapshot's where the directory has none."""
    return primary.select("venue_id", "name").unionByName(fallback.select("venue_id", "name").join(primary, "venue_id", "left_anti"))
