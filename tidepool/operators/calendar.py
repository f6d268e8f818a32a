"""Calendar views: days of a run, month pages, events that clash, top entries of a day, family counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import taxonomy as C
from ..functions import text as T


def days_of(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """A row per day of each run; an end that is missing or too early counts as the start."""
    last = F.greatest(F.coalesce(end, start), F.col(start))
    return df.withColumn(out, F.explode(F.sequence(F.col(start), last)))


def month_page(months: DataFrame, month: str = "month") -> DataFrame:
    """42 cells per month: cell, day, in_month."""
    cells = months.select(month, F.posexplode(D.month_cells(month)).alias("cell", "day"))
    return cells.withColumn("in_month", F.trunc("day", "month") == F.trunc(F.col(month), "month"))


def clash_slots(df: DataFrame, keys: list[str], minute: str, tie: list[str], width: int = 45) -> DataFrame:
    """clash_n: events of the key less than `width` minutes away, itself included; clash_idx: its place among them."""
    w = Window.partitionBy(*keys).orderBy(minute)
    near = width - 1
    same = Window.partitionBy(*keys, minute).orderBy(*tie)
    before = F.count("*").over(w.rangeBetween(-near, -1)) if near > 0 else F.lit(0)
    return df.withColumns({"clash_n": F.count("*").over(w.rangeBetween(-near, near)), "clash_idx": before + F.row_number().over(same) - 1})


def top_of_day(df: DataFrame, day: str, order: list, top: int = 3) -> DataFrame:
    """The first `top` rows of each day, and how many more it has."""
    w = Window.partitionBy(day)
    ranked = df.withColumns({"place": F.row_number().over(w.orderBy(*order)), "more": F.greatest(F.count("*").over(w) - top, F.lit(0))})
    return ranked.filter(F.col("place") <= top)


def family_counts(df: DataFrame, ids: str) -> DataFrame:
    """Events per display family, in the order of categories; families without events are left out."""
    order = F.create_map(*(F.lit(x) for i, n in enumerate(C.FAMILIES.values()) for x in (n, i)))
    counts = df.groupBy(C.family_of(F.col(ids)).alias("family")).agg(F.count("*").alias("n"))
    return counts.withColumn("position", F.coalesce(F.try_element_at(order, F.col("family")), F.lit(len(C.FAMILIES))))


def entries(listings: DataFrame, names: DataFrame) -> DataFrame:
    """Calendar entries of listings(listing_id, venue_id, venue_name, title, categories, price, start_date, start_time, end_date; all text).

    A missing venue name is looked up in names(venue_id, name). Times sort before entries with a time.
    """
    ids = C.sanitize(F.split("categories", ","))
    looked = listings.join(names.select("venue_id", F.col("name").alias("_looked")), "venue_id", "left")
    iso = D.iso_of_us_date("start_date")
    return looked.select(
        "listing_id", "title", F.coalesce(T.nz("venue_name"), "_looked", F.lit("")).alias("venue"), iso.alias("day"),
        F.coalesce(D.iso_of_us_date("end_date"), iso).alias("last_day"), D.minutes("start_time").alias("minute"),
        C.names_of(ids).alias("categories"), C.family_of(ids).alias("family"), D.pretty_date(D.as_date(iso)).alias("shown_day"), "price",
    )


def calendar_order(late: bool = False) -> list[Column]:
    """By day and time; entries without a time first, or last if `late`."""
    return [F.col("day"), F.asc_nulls_last("minute") if late else F.asc_nulls_first("minute"), F.col("listing_id")]


def in_calendar_order(df: DataFrame, late: bool = False) -> DataFrame:
    return df.orderBy(*calendar_order(late))


def search(df: DataFrame, words: str, columns: list[str]) -> DataFrame:
    """Rows of which a column holds the words as they stand, in either case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(F.col(c)).contains(words.lower()), F.lit(False))
    return df.filter(hit)
