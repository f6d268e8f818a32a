"""Uploads: cells as text in one shape, continuation rows, duplicates of the calendar and within the upload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions.similarity import blended
from .chains import cut_lineage, refused_in_order
from .matching import RUN, SAME, SAME_BY_TITLE, alike_runs, distinct_runs, with_run
from .productions import HEADERS, inherit_full_rows, problems


def coerce_cell(key: str, c: Column) -> Column:
    """A cell as a submission has it: dates MM/dd/yyyy, times h:mm a.m., FREE, whole numbers; other text trimmed."""
    t = T.nz(F.trim(c))
    if key in ("start date", "end date"):
        return F.coalesce(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), D.fmt_date(D.as_date(t))), t)
    if key == "start time":
        part = lambda k: F.regexp_extract(t, r"(?i)^(\d{1,2}):(\d{2})\s*([ap])\.?\s*m\.?$", k)
        written = F.concat(part(1).try_cast("int").cast("string"), F.lit(":"), part(2), F.lit(" "), F.lower(part(3)), F.lit(".m."))
        clock = F.regexp_extract(t, r"^(?:\d{4}-\d{2}-\d{2}[T ])?(\d{2}:\d{2})(?::\d{2})?$", 1)
        return F.coalesce(written, D.fmt_time(T.nz(clock)), t)
    if key in ("low price", "high price"):
        number = t.try_cast("double")
        return F.when(F.upper(t) == "FREE", "FREE").when(number == F.floor(number), number.cast("long").cast("string")).otherwise(t)
    return t


def checked_rows(upload: DataFrame) -> DataFrame:
    """upload(upload_id, line, HEADERS) with cells coerced, continuation rows filled from their header row, problems and is_orphan.

    A continuation row has a date but no title; it is one performance, so it has no end date.
    """
    cells = upload.select("upload_id", "line", *(coerce_cell(h, F.col(f"`{h}`")).alias(f"c{i}") for i, h in enumerate(HEADERS)))
    at = {h: f"c{i}" for i, h in enumerate(HEADERS)}
    title, start, ticket, end = (at[h] for h in ("title of program", "start date", "ticket URL", "end date"))
    as_row = lambda k: F.col(at[k])
    cells = cells.withColumns({"_own": F.col(ticket), "_p": problems(as_row), "_is_full": F.col(title).isNotNull() | F.col(start).isNull()})
    inherited = [at[h] for h in HEADERS if h not in ("start date", "start time", "end date")]
    rows = inherit_full_rows(cells, ["upload_id"], ["line"], F.col("_is_full"), F.size("_p") == 0, inherited)
    rows = rows.withColumn(ticket, F.coalesce("_own", ticket)).withColumn(end, F.when(F.col("_is_full"), F.col(end)))
    checked = rows.withColumn("problems", problems(as_row))
    return checked.select("upload_id", "line", "is_orphan", "problems", *(F.col(c).alias(h) for h, c in at.items()))


def calendar_duplicates(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """rows(row_id, title, venue, start_date, end_date) with duplicate_of: the best listing(listing_id, ...) on the same days that is alike enough.

    Equal listings are one, of the smallest id, and equal rows are looked up once.
    """
    pairs = alike_runs(distinct_runs(rows, "row_id"), distinct_runs(calendar, "listing_id"))
    runs = [f"a{c}" for c in RUN]
    best = pairs.groupBy(*runs).agg(F.max_by(F.struct("b_id", "score", "used_venue"), F.struct("score", (-F.col("b_id")).alias("first"))).alias("b"))
    found = best.filter(F.col("b.score") >= _bar(F.col("b.used_venue"))).select(*(F.col(f"a{c}").alias(c) for c in RUN), F.col("b.b_id").alias("duplicate_of"))
    return with_run(rows).join(found, RUN, "left").select(*(c for c in rows.columns), "duplicate_of")


def _bar(used_venue: Column) -> Column:
    return F.when(used_venue, SAME).otherwise(SAME_BY_TITLE)


def upload_duplicates(rows: DataFrame) -> DataFrame:
    """rows(row_id, title, venue, start_date, end_date) with repeats: the earlier accepted row of the upload that a row repeats.

    Rows are taken in order of row_id; one that is alike an accepted row before it repeats the likest of these (the
    first of equal ones) and is not accepted itself, so outcomes depend on each other. Of equal rows only the first
    can be accepted, and it stands for all of them; pairs of these are scored once, and who is accepted is settled in
    rounds of joins. A row behind its first may repeat a row between the two, so each looks for its own.
    """
    firsts = distinct_runs(rows, "row_id")
    pairs = alike_runs(firsts, firsts).filter("b_id < a_id").filter(F.col("score") >= _bar(F.col("used_venue")))
    alike = cut_lineage(pairs.select("a_id", "b_id", "score"))
    refused = refused_in_order(alike.select(F.col("a_id").alias("later"), F.col("b_id").alias("earlier")))
    itself = blended(F.lit(100.0), F.when(F.col("_v") != "", F.lit(100.0))).alias("score")
    both = alike.union(alike.select("b_id", "a_id", "score")).union(firsts.select("id", "id", itself)).toDF("id", "earlier", "score")
    accepted = both.join(refused.withColumnRenamed("node", "earlier"), "earlier", "left_anti")
    own = with_run(rows.select("row_id", "title", "venue", "start_date", "end_date")).join(firsts, RUN).select("row_id", "id")
    best = own.join(accepted, "id").filter("earlier < row_id").groupBy("row_id").agg(F.max_by("earlier", F.struct("score", -F.col("earlier"))).alias("repeats"))
    return rows.join(best, "row_id", "left")


def without_own_repeats(rows: DataFrame) -> DataFrame:
    """A seed or upload's accepted rows only, as they came."""
    return upload_duplicates(rows).filter("repeats is null").select(*rows.columns)
