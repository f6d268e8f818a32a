"""From events to publishable rows: runs, header rows and their repeats, representatives, validation, flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import taxonomy as C
from ..functions import text as T

GAP_DAYS = 30
#: The columns of a submission.
HEADERS = [
    "venue ID", "presenter ID (if different)", "title of program", "categories", "URL", "box office phone", "low price", "high price",
    "start date", "start time", "end date", "ticket URL", "description",
]
#: Confidence under which a directory match is flagged, and under which there is none.
SURE, TAKEN = 92.0, 84.0


def gap_runs(df: DataFrame, keys: list[str], start: str, end: str | None, order: list[str], *, gap_days: int = GAP_DAYS, out: str = "run") -> DataFrame:
    """df with a run number per key: a new one where a start lies over gap_days after the row before has ended."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ended = F.lag(F.coalesce(F.col(end), F.col(start)) if end else F.col(start)).over(w)
    new = F.coalesce((F.datediff(F.col(start), ended) > gap_days).cast("int"), F.lit(0))
    return df.withColumn("_new", new).withColumn(out, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def header_rows(df: DataFrame, keys: list[str], order: list[str], full_only: list[str]) -> DataFrame:
    """df with continuation; the columns full_only are null on all rows of a group but its first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("continuation", F.row_number().over(w) > 1)
    return df.withColumns({c: F.when(~F.col("continuation"), F.col(c)) for c in full_only})


def representatives(df: DataFrame, keys: list[str], preferred: Column, text: str, tie: list[str]) -> DataFrame:
    """df with is_representative: preferred rows first, then the longest text, then `tie`, which tells a group's rows apart.

    The best place of a group is a partial minimum, so a hot group is never sorted in one task.
    """
    place = F.struct(F.when(preferred, 0).otherwise(1).alias("a"), (-F.length(F.coalesce(text, F.lit("")))).alias("b"), *tie)
    rows = df.withColumn("_place", place)
    best = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min("_place").alias("_best"))
    same = [rows[k].eqNullSafe(best[f"_{k}"]) for k in keys]
    return rows.join(best, same).select(*(rows[c] for c in df.columns), (F.col("_place") == F.col("_best")).alias("is_representative"))


def inherit_full_rows(df: DataFrame, keys: list[str], order: list[str], is_full: Column, is_valid: Column, columns: list[str]) -> DataFrame:
    """Rows that aren't full take `columns` from the last full row before them; those under an invalid one, or none, are orphans."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"_full": is_full, "_valid": is_full & is_valid})
    parent = F.last(F.when(F.col("_full"), F.struct("_valid", *columns)), True).over(w)
    df = df.withColumn("_parent", parent)
    orphan = ~F.col("_full") & ~F.coalesce(F.col("_parent._valid"), F.lit(False))
    return df.withColumns({"is_orphan": orphan, **{c: F.when(F.col("_full"), F.col(c)).otherwise(F.col(f"_parent.{c}")) for c in columns}}).drop("_full", "_valid", "_parent")


def problems(row=F.col) -> Column:
    """What is wrong with a submission row (all columns text), as an array of messages; row gives a column by header."""
    c = row
    filled = lambda k: F.coalesce(c(k), F.lit("")) != ""
    us_date = r"^\d{2}/\d{2}/\d{4}$"
    tokens = F.filter(F.transform(F.split(F.coalesce(c("categories"), F.lit("")), ","), lambda p: F.trim(p)), lambda t: t != "")
    bad = F.filter(tokens, lambda t: ~t.rlike(r"^\d+$"))
    ids = F.transform(F.filter(tokens, lambda t: t.rlike(r"^\d{1,9}$")), lambda t: t.cast("int"))
    pair = F.lit(False)
    for parent, (lo, hi) in C.CHILDREN.items():
        pair = pair | (F.array_contains(ids, parent) & F.exists(ids, lambda x: x.between(lo, hi)))
    checks = [
        (~filled("title of program"), F.lit("missing title")),
        (~filled("start date"), F.lit("missing start date")),
        (filled("start date") & ~c("start date").rlike(us_date), F.concat(F.lit("bad date format "), c("start date"))),
        (filled("end date") & ~c("end date").rlike(us_date), F.concat(F.lit("bad end date format "), c("end date"))),
        (filled("start time") & ~c("start time").rlike(r"^\d{1,2}:\d{2} [ap]\.m\.$"), F.concat(F.lit("bad time format "), c("start time"))),
        (filled("box office phone") & ~c("box office phone").rlike(r"^\d{3}-\d{3}-\d{4}$"), F.lit("bad phone format")),
        *((filled(k) & ~c(k).rlike("^https?://"), F.lit(f"{k} missing scheme")) for k in ("URL", "ticket URL")),
        (F.size(bad) > 0, F.concat(F.lit("non-numeric category token(s): "), F.array_join(bad, ", "))),
        (F.size(ids) > 3, F.lit("more than 3 categories")),
        (pair, F.lit("parent+child category pair")),
        (F.exists(ids, lambda x: ~x.between(1, len(C.CATEGORIES))), F.lit("unknown category id")),
        *((filled(k) & ~c(k).rlike(r"^(-?\d+|FREE)$"), F.lit(f"{k} not whole number or FREE")) for k in ("low price", "high price")),
        (F.size(F.filter(F.split(F.coalesce(c("description"), F.lit("")), r"(?U)\s+"), lambda w: w != "")) > 200, F.lit("description over 200 words")),
    ]
    return F.array_compact(F.array(*(F.when(test, message) for test, message in checks)))


def live_events(events: DataFrame, as_of: Column) -> DataFrame:
    """New events in scope whose run isn't over."""
    return events.filter((F.col("verdict") == "new") & (F.col("relevance") == "in") & ((F.col("start_date") >= as_of) | (F.col("end_date") >= as_of)))


def expired_events(events: DataFrame, as_of: Column) -> DataFrame:
    """The other new events in scope."""
    over = (F.col("start_date") < as_of) & F.coalesce(F.col("end_date") < as_of, F.lit(True))
    return events.filter((F.col("verdict") == "new") & (F.col("relevance") == "in") & over)


def export_rows(events: DataFrame, venues: DataFrame, presenters: DataFrame) -> DataFrame:
    """Submission rows with production, position, flags, problems and continuation.

    events has event_id, title, venue_name, presenter, category_ids array<int>, url, ticket_url, phone, description,
    price_low, price_high, is_free, start_date, start_time, end_date; venues and presenters have name, entry_id,
    entry_name, confidence. Performances of one title at one venue within GAP_DAYS make a production; its first
    performance has all fields, the others only date, time and ticket address.
    """
    venue_key = T.norm_venue("venue_name")
    keyed = events.withColumns({"_title": T.norm_title("title"), "_venue": F.when(venue_key != "", venue_key).otherwise(F.concat(F.lit("#"), F.col("event_id").cast("string")))})
    order = ["start_date", F.coalesce("start_time", F.lit("")), "event_id"]
    runs = gap_runs(keyed, ["_title", "_venue"], "start_date", "end_date", order)
    group = ["_title", "_venue", "run"]
    whole = Window.partitionBy(*group)
    runs = runs.withColumns(
        {
            "position": F.row_number().over(whole.orderBy(*order)),
            "_n": F.count("*").over(whole),
            "_urls": F.size(F.collect_set(T.nz("url")).over(whole)),
            "production_start": F.min("start_date").over(whole),
            "production": F.min("event_id").over(whole),
        }
    )
    v = venues.select(F.col("name").alias("venue_name"), F.col("entry_id").alias("v_id"), F.col("entry_name").alias("v_name"), F.col("confidence").alias("v_conf")).distinct()
    p = presenters.select(F.col("name").alias("presenter"), F.col("entry_id").alias("p_id"), F.col("entry_name").alias("p_name"), F.col("confidence").alias("p_conf")).distinct()
    runs = runs.join(v, "venue_name", "left").join(p, "presenter", "left")
    other = F.coalesce("presenter", F.lit("")) != ""
    other &= T.norm_venue("presenter") != T.norm_venue("venue_name")
    found = other & F.col("p_id").isNotNull()
    pres_id = F.when(found & ~F.col("p_id").eqNullSafe(F.col("v_id")), F.col("p_id"))
    flags = [
        (F.col("v_id").isNull(), F.format_string("NEEDS-DIRECTORY-ENTRY: venue '%s' not in directory", F.coalesce("venue_name", F.lit("None")))),
        (F.col("v_id").isNotNull() & (F.col("v_conf") < SURE), F.format_string("CHECK-VENUE: matched '%s' at %.0f%%", "v_name", F.bround("v_conf"))),
        (pres_id.isNotNull() & (F.col("p_conf") < SURE), F.format_string("CHECK-PRESENTER: matched '%s' at %.0f%%", "p_name", F.bround("p_conf"))),
        (pres_id.isNull() & other & (F.col("p_conf") > 0) & (F.col("p_conf") < TAKEN), F.format_string("PRESENTER-NOT-IN-DIRECTORY: '%s'", "presenter")),
        (F.coalesce(F.size("category_ids"), F.lit(0)) <= 0, F.lit("NEEDS-CATEGORY: no category could be assigned")),
        (T.nz("url").isNotNull() & T.clean_url("url").isNull(), F.format_string("UNUSABLE-URL: source had '%s'", "url")),
        ((F.col("_n") > 1) & (F.col("_urls") > 1), F.format_string("CHECK-GROUPING: %d performances with %d different detail URLs", "_n", "_urls")),
    ]
    free = F.col("is_free") == 1
    high = F.when(free | F.col("price_high").eqNullSafe(F.col("price_low")), None).otherwise(F.col("price_high"))
    full = {
        "venue ID": F.col("v_id").cast("string"),
        "presenter ID (if different)": pres_id.cast("string"),
        "title of program": F.col("title"),
        "categories": T.nz(F.array_join("category_ids", ",")),
        "URL": T.clean_url("url"),
        "box office phone": F.col("phone"),
        "low price": F.when(free, "FREE").otherwise(F.col("price_low").cast("string")),
        "high price": high.cast("string"),
        "start date": D.fmt_date("start_date"),
        "start time": D.fmt_time("start_time"),
        "end date": D.fmt_date("end_date"),
        "ticket URL": T.clean_url("ticket_url"),
        "description": T.words_cap("description"),
    }
    first = F.col("position") == 1
    on_all = {"start date", "start time", "ticket URL"}
    shaped = runs.select(
        "production", "production_start", "position", "event_id", (~first).alias("continuation"),
        *((c if k in on_all else F.when(first, c)).alias(k) for k, c in full.items()),
        F.when(first, F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(False)), m) for t, m in flags)))).otherwise(F.array()).alias("flags"),
    )
    return shaped.withColumn("problems", F.when(F.col("continuation"), F.array().cast("array<string>")).otherwise(problems(lambda k: F.col(f"`{k}`"))))


def rejected_by_place(raw: DataFrame, region=None) -> DataFrame:
    """(title, city, evidence) of raw events outside the region, one per title (60 characters) and city, the first by raw_id."""
    from ..functions import geo

    judged = raw.withColumn("_g", geo.verdict("venue_city", "venue_address", "venue_name", region or geo.DELAWARE)).filter("_g.verdict = 'out'")
    key = judged.withColumn("title", F.substring(T.clean_text("title"), 1, 60)).withColumn("city", F.coalesce("venue_city", F.lit("")))
    return key.groupBy("title", "city").agg(F.min_by("_g.evidence", "raw_id").alias("evidence"), F.min("raw_id").alias("raw_id"))
