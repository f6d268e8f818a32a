"""Upserts as pure functions of old and new rows. Ties are always broken by a named order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key by `order` (ascending)."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc(c) if isinstance(c, str) else c.desc() for c in order))
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def insert_new(old: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """old, and the first new row of each key that old hasn't."""
    return old.unionByName(first_wins(new, keys, order).join(old.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def upsert_tiers(df: DataFrame, key: str, order: str, keep_first: list[str]) -> DataFrame:
    """One row per key: the columns keep_first from its first row, all others from its last."""
    rest = [c for c in df.columns if c not in (key, *keep_first)]
    return df.groupBy(key).agg(*(F.min_by(c, order).alias(c) for c in keep_first), *(F.max_by(c, order).alias(c) for c in rest))


def update_filled(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides; where both have a key, new values but for nulls."""
    rest = [c for c in old.columns if c not in keys]
    joined = old.alias("o").join(new.alias("n"), keys, "full")
    return joined.select(*keys, *(F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in rest))


def merge_events(old: DataFrame, batch: DataFrame, as_of, *, order: list, dropped: str = "relevance = 'out'") -> DataFrame:
    """Old events and a batch, by content_hash.

    A known event keeps event_id and first_seen, takes all else and last_seen from the batch's last row for it;
    if that row is out of scope the event goes. Events that the batch hasn't stay. New ones get first_seen = as_of.
    """
    last = latest_wins(batch, ["content_hash"], order)
    kept = [c for c in old.columns if c not in ("content_hash", "event_id", "first_seen", "last_seen")]
    joined = old.withColumn("_old", F.lit(True)).alias("o").join(last.withColumn("_gone", F.expr(dropped)).withColumn("_new", F.lit(True)).alias("n"), "content_hash", "full")
    joined = joined.filter(~F.coalesce("_gone", F.lit(False)))
    fresh = F.col("_new")
    return joined.select(
        F.when(F.col("_old"), F.col("o.event_id")).otherwise(F.col("n.event_id")).alias("event_id"),
        *(F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in kept),
        "content_hash",
        F.coalesce("o.first_seen", as_of).alias("first_seen"),
        F.when(fresh, as_of).otherwise(F.col("o.last_seen")).alias("last_seen"),
    )


def keep_unless_pulled(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """new's rows for the keys that it has, old's for all others: a source that gave nothing loses nothing."""
    return new.unionByName(old.join(new.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def with_columns_of(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """df with each missing column added as null of its type."""
    return reduce(lambda d, item: d if item[0] in d.columns else d.withColumn(item[0], F.lit(None).cast(item[1])), wanted.items(), df)


def exact_dedup(df: DataFrame, columns: list[str], order: list) -> DataFrame:
    """The first row of each value of `columns`, null among them, by `order`."""
    return first_wins(df, columns, order)
