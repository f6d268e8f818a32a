"""The registry of sources: a CSV list with tiers by position, addresses to read, politeness, page cache."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions import text as T
from ..operators.merge import latest_wins, upsert_tiers


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, name, home, sitemap, events) of a registry CSV with a header; a byte order mark is dropped, blank names too.

    A registry is one small file, so it is read in one task and its rows keep the file's order.
    """
    df = spark.read.option("header", True).option("multiLine", True).csv(path)
    clean = {c: c.lstrip("﻿").strip() for c in df.columns}
    df = df.select(F.monotonically_increasing_id().alias("ordinal"), *(F.col(f"`{c}`").alias(n) for c, n in clean.items()))
    wanted = {"Organization Name": "name", "Organization URL": "home", "Site Map": "sitemap", "Events": "events"}
    return df.select("ordinal", *(F.trim(F.col(f"`{c}`")).alias(n) for c, n in wanted.items())).filter(F.coalesce("name", F.lit("")) != "")


def with_tiers(registry: DataFrame, tier1_last: str, tier3_name: str) -> DataFrame:
    """registry with tier by place in the list: 1 up to the marker, then 2; tier3_name is 3 and what follows it 4."""
    everything = Window.partitionBy(F.lit(0))
    end1 = F.min(F.when(F.col("name") == tier1_last, F.col("ordinal"))).over(everything)
    third = F.min(F.when((F.lower("name") == tier3_name.lower()) & (F.col("ordinal") > F.col("_end1")), F.col("ordinal"))).over(everything)
    df = registry.withColumn("_end1", end1).withColumn("_third", third)
    tier = F.when(F.col("_end1").isNull() | (F.col("ordinal") <= F.col("_end1")), 1).when(F.col("ordinal") > F.col("_third"), 4).when(F.col("ordinal") == F.col("_third"), 3).otherwise(2)
    return df.withColumn("tier", tier).drop("_end1", "_third")


def sources(registry: DataFrame) -> DataFrame:
    """One row per name: its first tier, its last addresses; the events cell split at ; into events_url and extra_urls."""
    urls = F.filter(F.transform(F.split(F.coalesce("events", F.lit("")), ";"), lambda p: F.trim(p)), lambda u: u != "")
    df = registry.select(
        "ordinal", "name", "tier", T.norm_url("home").alias("home_url"),
        F.when(~F.lower(F.coalesce("sitemap", F.lit(""))).isin("", "nks"), F.col("sitemap")).alias("sitemap_url"),
        T.norm_url(F.try_element_at(urls, F.lit(1))).alias("events_url"), F.when(F.size(urls) > 1, F.slice(urls, 2, 1000)).alias("extra_urls"),
    )
    return upsert_tiers(df, "name", "ordinal", ["tier"]).drop("ordinal")


def page_urls(probed: Column, events: Column, home: Column, extra: Column) -> Column:
    """Addresses to read, best first, each once."""
    found = F.concat(F.array(probed, events, home), F.coalesce(extra, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(found, lambda u: F.coalesce(u, F.lit("")) != ""))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Hosts of a list of sites: a line each, # begins a comment line, addresses give their host."""
    line = F.trim("value")
    lines = spark.read.text(path).filter((line != "") & ~line.startswith("#"))
    return lines.select(F.coalesce(T.host(line), F.lower(line)).alias("site")).distinct()


def selected(sources: DataFrame, *, routes: list[str] | None = None, names: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Working sources, by route prefix and name; a limit takes the first by name."""
    df = sources.filter("status = 'ok'")
    if routes:
        hit = F.lit(False)
        for r in routes:
            hit = hit | F.col("route").startswith(r)
        df = df.filter(hit)
    if names:
        df = df.filter(F.col("name").isin(names))
    return df.orderBy("name").limit(limit) if limit else df


# ---- fetching


def fresh_pages(cache: DataFrame, as_of: Column, hours: Column) -> DataFrame:
    """The last successful page of each url that is young enough."""
    young = cache.filter((F.col("status") == 200) & (F.col("fetched_at") >= as_of - F.make_interval(hours=hours)))
    return latest_wins(young, ["url"], ["fetched_at"])


def to_fetch(wanted: DataFrame, cache: DataFrame, as_of: Column, hours: Column) -> DataFrame:
    return wanted.join(fresh_pages(cache, as_of, hours).select("url"), "url", "left_anti")


def store_pages(cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """The cache with successful fetches in place of older pages."""
    return latest_wins(cache.unionByName(fetched, allowMissingColumns=True).filter("status = 200"), ["url"], ["fetched_at"])


def request_slots(urls: DataFrame, seconds: float = 1.0) -> DataFrame:
    """urls with slot and not_before: seconds from the start at which a host may be asked again; in order of url."""
    hosts = urls.withColumn("host", T.host("url"))
    w = Window.partitionBy("host").orderBy("url")
    return hosts.withColumn("slot", F.row_number().over(w) - 1).withColumn("not_before", F.col("slot") * F.lit(seconds))


def robots_allowed(urls: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """urls(url) with allowed, by robots(host, body) of their hosts; hosts without a robots.txt allow all."""

    @F.pandas_udf(BooleanType())
    def allowed(url: pd.Series, body: pd.Series) -> pd.Series:
        parsers: dict[str, RobotFileParser] = {}
        out = []
        for u, b in zip(url, body):
            if b is None:
                out.append(True)
                continue
            if b not in parsers:
                parsers[b] = RobotFileParser()
                parsers[b].parse(b.splitlines())
            out.append(parsers[b].can_fetch(agent, u or ""))
        return pd.Series(out, dtype=bool)

    asked = urls.withColumn("host", T.host("url"))
    return asked.join(robots.select("host", F.col("body").alias("_robots")), "host", "left").withColumn("allowed", allowed("url", "_robots")).drop("_robots", "host")


def fetch(urls: DataFrame, get, *, tries: int = 2) -> DataFrame:
    """urls(url) with status and body; get(url) gives (status, body). An error is status 0 and never fails the task.

    Urls are dealt by host, so one task has all of a host's and can space them; hosts with a third of all urls are
    bound by that spacing anyway.
    """

    def run(frames):
        for frame in frames:
            rows = []
            for url in frame["url"]:
                status, body = 0, None
                for _ in range(tries):
                    try:
                        status, body = get(url)
                        break
                    except Exception as e:  # noqa: BLE001 - one bad page must not end the job
                        body = str(e).encode()
                rows.append((url, status, body))
            yield pd.DataFrame(rows, columns=["url", "status", "body"])

    return urls.select("url").withColumn("_h", T.host("url")).repartition("_h").select("url").mapInPandas(run, "url string, status int, body binary")
