"""Finding a source's new address among search results, and the best way to read a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import partial_udf
from .chains import cut_lineage

#: Hosts that are never an organisation's own; the hosts of a run's own listings are given besides.
FOREIGN_HOSTS = "facebook. instagram. twitter. x.com linkedin. yelp. tripadvisor. eventbrite. youtube. wikipedia. mapquest. yellowpages. bbb.org guidestar. charitynavigator.".split()
#: Words that don't tell organisations apart.
PLAIN_WORDS = "the of and inc ltd association society center centre company delaware de arts art".split()
#: Signs of the region on a page: area code, ZIP, state with ZIP, the state's own host.
REGION_SIGNS = r"\(?302\)?[\s.-]?\d{3}[\s.-]?\d{4}|\b19[789]\d{2}\b|,\s*de\s+19\d{3}|delaware\.gov"
#: Ways to read a source, best first.
ROUTES = ["libcal", "civic_ics", "tribe", "wpv2", "ics", "squarespace", "rss", "jsonld", "html", "headless", "none"]


def foreign_host(url, more: tuple[str, ...] = ()) -> Column:
    """Hosts of which a part is on the list."""
    pattern = "|".join(h.replace(".", r"\.") for h in [*FOREIGN_HOSTS, *more])
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))).rlike(pattern), F.lit(False))


def host_score(df: DataFrame, name: str = "name", url: str = "url", foreign: tuple[str, ...] = ()) -> DataFrame:
    """df with host_score: likeness of the host's first label to the name's letters, 5 more for .org, 100 at most, 0 for foreign hosts."""
    letters = lambda c: F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}]", "")
    host = T.host(url)
    df = df.withColumns({"_n": letters(F.col(name)), "_h": letters(F.substring_index(host, ".", 1))})
    df = df.withColumn("_p", partial_udf("_h", "_n"))
    score = F.least(F.col("_p") + F.when(host.endswith(".org"), 5.0).otherwise(0.0), F.lit(100.0))
    return df.withColumn("host_score", F.when(foreign_host(F.col(url), foreign) | host.isNull(), 0.0).otherwise(score)).drop("_n", "_h", "_p")


def page_confirms(name: Column, page: Column, signs: str = REGION_SIGNS) -> Column:
    """Half of the name's own words (one at least) are on the page, and so is a sign of the region."""
    own = F.filter(F.split(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "), " "), lambda w: (F.length(w) > 2) & ~w.isin(PLAIN_WORDS))
    low = F.lower(page)
    hits = F.size(F.filter(own, lambda w: F.contains(low, w)))
    return F.coalesce((F.size(own) > 0) & (hits >= F.greatest(F.floor(F.size(own) / 2), F.lit(1))) & low.rlike(signs), F.lit(False))


def rank_candidates(df: DataFrame, top: int = 5) -> DataFrame:
    """The best candidates(name, url, confirmed, reachable, host_score) per name: rank 1 to top."""
    w = Window.partitionBy("name").orderBy(F.desc("confirmed"), F.desc("reachable"), F.desc("host_score"), "url")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def to_apply(df: DataFrame, least: float = 85.0) -> DataFrame:
    """Confirmed candidates, close in name, at a host that the source hasn't: one per name."""
    new_host = ~T.host("url").eqNullSafe(T.host("old_url"))
    return df.filter(F.col("confirmed") & (F.col("host_score") >= least) & new_host & F.col("claimed_by").isNull() & (F.col("rank") == 1))


def best_route(probes: DataFrame) -> DataFrame:
    """probes(source_id, route, works, detail): the best route that works for each source, else none."""
    place = F.create_map(*(F.lit(x) for i, r in enumerate(ROUTES) for x in (r, i)))
    w = Window.partitionBy("source_id").orderBy(F.coalesce(F.try_element_at(place, F.col("route")), F.lit(99)), "route")
    working = probes.filter("works").withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("source_id", "route", "detail")
    return probes.select("source_id").distinct().join(working, "source_id", "left").select("source_id", F.coalesce("route", F.lit("none")).alias("route"), "detail")


def site_queries(sites: DataFrame, queries: DataFrame) -> DataFrame:
    """Every query for every site, as search text; both lists are short settings, held by the caller."""
    each = sites.withColumn("_k", F.lit(1)).join(queries.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return each.withColumn("search", F.format_string("site:%s %s", "site", "query"))


def distinct_results(results: DataFrame) -> DataFrame:
    return results.select("url").filter("url is not null").distinct().orderBy("url")


def running_totals(df: DataFrame, keys: list[str], order: list[str], size: Column) -> DataFrame:
    """df with _place (from 0), _size and _total (sum of sizes up to and with the row) per key, in order; order tells rows of a key apart.

    Rows are dealt by ranges of key and order, so a key may fill many tasks: tasks number and sum their own rows, and
    the sums of the parts of a key before are added.
    """
    names = [f.name for f in df.schema]
    rows = df.withColumn("_n", size.cast("long")).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, before, place, total = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            places, totals = [], []
            for *key, n in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in [*keys, "_n"])):
                if key != before:
                    before, place, total = key, 0, 0
                total += n
                places.append(place)
                totals.append(total)
                place += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(places, pa.int64()), pa.array(totals, pa.int64())], [*batch.schema.names, "_part", "_place", "_total"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    own = cut_lineage(rows.mapInArrow(run, f"{kinds}, _part int, _place long, _total long"))
    parts = own.groupBy(*keys, "_part").agg(F.count("*").alias("_rows"), F.max("_total").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum"))
    same = [own["_part"] == offsets["_p"], *(own[k].eqNullSafe(offsets[f"_k{i}"]) for i, k in enumerate(keys))]
    return own.join(offsets, same).select(*(own[c] for c in names), (F.col("_place") + F.col("_rows")).alias("_place"), (F.col("_total") + F.col("_sum")).alias("_total"), F.col("_n").alias("_size"))


def char_batches(df: DataFrame, keys: list[str], order: list[str], text: str, most: int = 24_000) -> DataFrame:
    """df with batch per key: a new one where the next text would bring the running one over `most` characters.

    Where a batch begins depends on the batch before, but where it would end can be told for every row from running
    totals: at the first row whose total goes beyond `most` more than the total before it (an opening text over the
    budget stays, the row behind it begins the next). These jumps are found in stretches of `most` characters, each
    a bounded group, and doubled until the first row's chain is known, so a key of any size spreads over tasks.
    """
    rows = cut_lineage(running_totals(df, keys, order, F.length(F.coalesce(text, F.lit("")))))
    at = {k: f"_k{i}" for i, k in enumerate(keys)}
    slim = rows.select(*(F.col(k).alias(v) for k, v in at.items()), F.col("_place").alias("_i"), F.col("_total").alias("_t"), F.col("_size").alias("_s"))
    ks = list(at.values())
    stretch = lambda c: F.floor(c / most)
    # the row that first goes beyond x ends at more than x and begins at x or less: it touches the stretch of x
    ends = slim.filter("_s > 0").select(*ks, F.explode(F.sequence(stretch(F.col("_t") - F.col("_s")), stretch(F.col("_t")))).alias("_b"), F.col("_t").alias("_v"), F.col("_i").alias("_at"), F.lit(0).alias("_o"))
    goal = (F.col("_t") - F.col("_s") + most).alias("_v")
    asked = slim.select(*ks, goal).distinct().select(*ks, stretch(F.col("_v")).alias("_b"), "_v", F.lit(None).cast("long").alias("_at"), F.lit(1).alias("_o"))
    after = Window.partitionBy(*ks, "_b").orderBy("_v", "_o").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    beyond = ends.union(asked).withColumn("_next", F.first("_at", ignorenulls=True).over(after)).filter("_o = 1 and _next is not null").select(*ks, "_v", "_next")
    same = lambda a, b: [a[k].eqNullSafe(b[f"{k}_"]) for k in ks]
    named = lambda d: d.select(*(F.col(k).alias(f"{k}_") for k in ks), *(c for c in d.columns if c not in ks))
    b = named(beyond)
    with_goal = slim.withColumn("_goal", F.col("_t") - F.col("_s") + most)
    jumps = with_goal.join(b, [*same(with_goal, b), with_goal["_goal"] == b["_v"]]).select(*ks, "_i", F.col("_t") - F.col("_s"), "_next")
    jumps = jumps.toDF(*ks, "_i", "_base", "_next")
    # behind an opening text over the budget, zeros before it included, the next row begins a batch
    full = named(slim.select(*ks, F.col("_i").alias("_at"), (F.col("_t") - F.col("_s")).alias("_before")))
    jumps = jumps.join(full, [*same(jumps, full), jumps["_next"] == full["_at"]]).select(*ks, "_i", (F.col("_next") + F.when(F.col("_before") == F.col("_base"), 1).otherwise(0)).alias("_next"))
    last = named(slim.groupBy(*ks).agg(F.max("_i").alias("_last")))
    jumps = cut_lineage(jumps.join(last, same(jumps, last)).filter("_next <= _last").select(*ks, "_i", "_next"))

    starts, step = slim.filter("_i = 0").select(*ks, "_i", F.lit(0).alias("_n")), 1
    while True:
        j = named(jumps)
        reached = starts.join(j.withColumnRenamed("_i", "_j"), [*same(starts, j), starts["_i"] == F.col("_j")]).select(*ks, F.col("_next").alias("_i"), (F.col("_n") + step).alias("_n"))
        reached = cut_lineage(reached)
        if reached.isEmpty():
            break
        starts, step = starts.union(reached), step * 2
        further = named(jumps.withColumnsRenamed({"_i": "_from", "_next": "_to"}))
        jumps = cut_lineage(jumps.join(further, [*same(jumps, further), jumps["_next"] == further["_from"]]).select(*ks, "_i", F.col("_to").alias("_next")))

    # a batch holds the rows from its start to the next: met again in the stretches where they begin
    started = named(starts)
    begun = slim.join(started.withColumnRenamed("_i", "_j"), [*same(slim, started), slim["_i"] == F.col("_j")]).select(*ks, "_n", "_i", (F.col("_t") - F.col("_s")).alias("_from"))
    following = named(begun.select(*ks, (F.col("_n") - 1).alias("_before"), F.col("_i").alias("_end"), F.col("_from").alias("_to")))
    spans = begun.join(following, [*same(begun, following), begun["_n"] == following["_before"]], "left").select(*ks, "_n", "_i", "_end", "_from", "_to")
    ends_of = named(slim.groupBy(*ks).agg(F.max("_t").alias("_all")))
    spans = spans.join(ends_of, same(spans, ends_of)).select(*ks, "_n", "_i", "_end", F.explode(F.sequence(stretch(F.col("_from")), stretch(F.coalesce("_to", "_all")))).alias("_b"))
    spans = named(spans.withColumnsRenamed({"_i": "_start", "_b": "_in"}))
    placed = rows.withColumn("_b", stretch(F.col("_total") - F.col("_size")))
    within = (placed["_place"] >= F.col("_start")) & (F.col("_end").isNull() | (placed["_place"] < F.col("_end")))
    joined = placed.join(spans, [*(placed[k].eqNullSafe(spans[f"{v}_"]) for k, v in at.items()), placed["_b"] == spans["_in"], within])
    return joined.select(*(placed[c] for c in df.columns), F.col("_n").cast("int").alias("batch"))


def rediscover(lost: DataFrame, results: DataFrame, pages: DataFrame, sources: DataFrame, foreign: tuple[str, ...] = ()) -> DataFrame:
    """Ranked candidates for lost(name, old_url) from results(name, url) and what was fetched of them, pages(url, status, body).

    A candidate is confirmed if its page was read, names the organisation and the region, and its host isn't another
    source's. `apply` marks the ones that may replace the old address.
    """
    from .matching import claimed_hosts

    found = results.join(lost, "name").dropDuplicates(["name", "url"])
    seen = host_score(found, foreign=foreign).filter("host_score > 0").join(pages.select("url", "status", "body"), "url", "left")
    read = F.coalesce(F.col("status") == 200, F.lit(False))
    seen = seen.withColumn("reachable", read).withColumn("named", page_confirms(F.col("name"), F.col("body").cast("string")))
    owned = claimed_hosts(seen, sources).withColumn("confirmed", F.col("reachable") & F.col("named") & F.col("claimed_by").isNull())
    ranked = rank_candidates(owned)
    chosen = to_apply(ranked).select("name", "url").withColumn("apply", F.lit(True))
    return ranked.join(chosen, ["name", "url"], "left").withColumn("apply", F.coalesce("apply", F.lit(False))).drop("body", "named")
