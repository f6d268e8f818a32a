"""From raw events to submission rows: normalise, settle scope, find repeats, match a calendar, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import taxonomy as C
from ..functions import text as T
from ..operators import matching as M
from ..operators import policy
from ..operators.productions import export_rows, live_events, representatives


def normalise(raw: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(canonical events, rejected rows) of raw(raw_id, feeds.EVENT) and sources(source_id, name, tier, route, screened).

    Every raw row is in one of both. An event's venue falls back to its source's name for tiers 1 and 2 only; its
    identity uses the venue as it was given.
    """
    texts = ["title", "description", "venue_name", "presenter", "venue_address"]
    clean = raw.withColumns({c: T.nz(T.clean_text(c)) for c in texts})
    src = sources.select("source_id", F.col("name").alias("source_name"), "tier", "route", "screened")
    joined = clean.join(src, "source_id", "left")
    joined = joined.withColumns({"_s": D.parse_dt("start"), "_e": D.parse_dt("end"), "_p": T.parse_price("cost_text")})
    dated = F.col("title").isNotNull() & F.col("_s.date").isNotNull()
    skipped = joined.filter(~dated).select("raw_id", "source_id", "title", F.lit("no title or date").alias("reason"))
    events = policy.relevance(
        joined.filter(dated).select(
            "*", F.col("_s.date").alias("start_date"), F.col("_s.time").alias("start_time"),
            F.when(F.col("_e.date") != F.col("_s.date"), F.col("_e.date")).alias("end_date"), F.col("_e.time").alias("end_time"),
            F.col("_p.low").alias("price_low"), F.col("_p.high").alias("price_high"), F.col("_p.is_free").alias("is_free"),
        )
    )
    hashed = events.withColumn("content_hash", T.content_hash("source_id", "title", "start_date", "start_time", "venue_name"))
    hashed = hashed.withColumn("category_ids", C.with_free(F.col("category_ids"), F.col("is_free")))
    hashed = hashed.withColumn("venue_name", F.coalesce("venue_name", F.when(F.col("tier").isin(1, 2), F.col("source_name"))))
    hashed = hashed.withColumns({"presenter": F.coalesce("presenter", "source_name"), "phone": T.parse_phone("phone")})
    w = Window.partitionBy("content_hash").orderBy(F.desc("source_id"), F.desc("raw_id"))
    last = hashed.withColumn("_r", F.row_number().over(w))
    repeated = last.filter("_r > 1").select("raw_id", "source_id", "title", F.lit("replaced by a later row of the same event").alias("reason"))
    out = last.filter("_r = 1 and relevance = 'out'").select("raw_id", "source_id", "title", "reason")
    kept = last.filter("_r = 1 and relevance <> 'out'").drop("_r", "source_name", "tier", "route", "screened", "start", "end", "cost_text", "source_categories", "wants_model")
    return kept.withColumn("event_id", F.col("raw_id")), skipped.union(repeated).union(out)


def find_repeats(events: DataFrame) -> DataFrame:
    """events with cluster_id and is_representative."""
    slim = events.select("event_id", "title", F.col("venue_name").alias("venue"), "start_date")
    clusters = M.cluster_greedily(slim).select("event_id", "cluster_id")
    joined = events.join(clusters, "event_id")
    return representatives(joined, ["cluster_id"], F.col("relevance") == "in", "description", ["start_date", "event_id"])


def match_calendar(events: DataFrame, listings: DataFrame, pad_days: int = 1) -> DataFrame:
    """events with verdict, listing_id, score and verdict_reason against listings(listing_id, title, venue, start_date, end_date, dates, is_range)."""
    a = events.filter("is_representative").select("event_id", F.col("title").alias("title_a"), F.col("venue_name").alias("venue_a"), F.col("start_date").alias("l_start"), F.col("end_date").alias("l_end"))
    days = F.when(~F.coalesce("is_range", F.lit(False)) & (F.size("dates") > 0), F.col("dates"))
    b = listings.select("listing_id", F.col("title").alias("title_b"), F.col("venue").alias("venue_b"), F.explode(F.coalesce(F.transform(days, lambda d: F.struct(d.alias("s"), d.alias("e"))), F.array(F.struct(F.col("start_date").alias("s"), F.col("end_date").alias("e"))))).alias("d"))
    b = b.select("listing_id", "title_b", "venue_b", F.col("d.s").alias("r_start"), F.col("d.e").alias("r_end")).filter("r_start is not null")
    pairs = M.overlap_join(a, b, pad_days=pad_days).select("event_id", "listing_id", "title_a", "venue_a", "title_b", "venue_b").distinct()
    matched = M.best_match(events.filter("is_representative"), M.scored(pairs))
    repeats = events.filter("not is_representative").withColumns({"listing_id": F.lit(None).cast("long"), "score": F.lit(None).cast("double"), "used_venue": F.lit(None).cast("boolean"), "verdict": F.lit("same")})
    why = F.when(~F.col("is_representative"), F.format_string("repeats cluster %d", "cluster_id")).when(F.col("verdict") != "new", F.format_string("score %.0f against listing %d", "score", "listing_id"))
    return matched.unionByName(repeats).withColumn("verdict_reason", why)


def export(events: DataFrame, directory: DataFrame, as_of: Column) -> DataFrame:
    """Submission rows of the live new events; directory(entry_id, entry_name)."""
    live = live_events(events, as_of)
    names = M.resolve_names(live.select(F.explode(F.array_distinct(F.array("venue_name", "presenter"))).alias("name")).filter("name is not null").distinct(), directory)
    return export_rows(live, names, names)


def run(raw: DataFrame, sources: DataFrame, listings: DataFrame, directory: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """All stages: events, rejected, rows."""
    events, rejected = normalise(raw, sources)
    matched = match_calendar(find_repeats(events), listings)
    return {"events": matched, "rejected": rejected, "rows": export(matched, directory, as_of)}
