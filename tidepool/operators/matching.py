"""Joins and matching: overlapping runs, occurrences, best matches, names to directory entries, greedy clusters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import TITLE_SHARE, blended, token_set, token_set_udf, token_sort_udf
from .chains import cut_lineage

#: Scores from which a pair is the same event, needs a look, or is the same although a venue is missing.
SAME, UNSURE, SAME_BY_TITLE = 87.0, 72.0, 96.0
#: Confidence from which a directory match is taken.
TAKEN = 84.0


def overlap_join(left: DataFrame, right: DataFrame, *, pad_days: int = 0, bucket_days: int = 7, on: list[str] | None = None, spread: bool = False) -> DataFrame:
    """Pairs whose runs [start, end] overlap when left's are padded by pad_days on both sides.

    left has l_start, l_end and right r_start, r_end (dates). A run is copied to each bucket of days it touches,
    buckets are joined by equality, and a pair is taken in the first bucket both have, so no distinct is needed.
    A null or too early end counts as the start. `on` names further columns that must be equal. spread: as many
    partitions as the session has, however small the sides are, for pairs that are many more than rows.
    """
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    bucket = lambda c: F.floor(day(c) / bucket_days)
    l_end, r_end = F.greatest(F.coalesce("l_end", "l_start"), "l_start"), F.greatest(F.coalesce("r_end", "r_start"), "r_start")
    a = left.withColumns({"_la": F.date_sub("l_start", pad_days), "_lb": F.date_add(l_end, pad_days)})
    a = a.withColumn("_b", F.explode(F.sequence(bucket(F.col("_la")), bucket(F.col("_lb")))))
    b = right.withColumns({"_ra": F.col("r_start"), "_rb": r_end}).withColumn("_b", F.explode(F.sequence(bucket(F.col("r_start")), bucket(r_end))))
    keys = ["_b", *(on or [])]
    if spread:
        n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        a, b = a.repartition(n, *keys), b.repartition(n, *keys)
    joined = a.join(b, keys)
    hit = (F.col("_la") <= F.col("_rb")) & (F.col("_ra") <= F.col("_lb")) & (F.col("_b") == F.greatest(bucket(F.col("_la")), bucket(F.col("_ra"))))
    return joined.filter(hit).drop("_b", "_la", "_lb", "_ra", "_rb")


def dates_match(start: Column, end: Column, listing_start: Column, listing_end: Column, dates: Column, is_range: Column, pad_days: int = 1) -> Column:
    """A listing of separate days matches by one of them only; a continuous one by overlap."""
    e = F.coalesce(end, start)
    lo, hi = F.date_sub(start, pad_days), F.date_add(e, pad_days)
    single = F.exists(F.coalesce(dates, F.array().cast("array<date>")), lambda d: d.between(lo, hi))
    run = (lo <= F.coalesce(listing_end, listing_start)) & (listing_start <= hi)
    return F.coalesce(F.when(~F.coalesce(is_range, F.lit(False)) & (F.size(dates) > 0), single).otherwise(run), F.lit(False))


def scored(pairs: DataFrame) -> DataFrame:
    """pairs(title_a, venue_a, title_b, venue_b) with score and used_venue; titles and venues are normalised here."""
    keyed = pairs.withColumns({"_ta": T.norm_title("title_a"), "_tb": T.norm_title("title_b"), "_va": T.norm_venue("venue_a"), "_vb": T.norm_venue("venue_b")})
    both = (F.col("_va") != "") & (F.col("_vb") != "")
    # a Python function inside when() would run for all rows: it gets empty strings where it isn't needed
    keyed = keyed.withColumn("used_venue", both)
    keyed = keyed.withColumns({"_t": token_set_udf("_ta", "_tb"), "_v": token_set_udf(F.when(both, F.col("_va")), F.when(both, F.col("_vb")))})
    return keyed.withColumn("score", blended(F.col("_t"), F.when(both, F.col("_v")))).drop("_ta", "_tb", "_va", "_vb", "_t", "_v")


def best_match(events: DataFrame, candidates: DataFrame) -> DataFrame:
    """events with their best candidate and a verdict: same, unsure or new.

    candidates has event_id, listing_id, score, used_venue. The first listing wins ties. Events without any
    candidate are new.
    """
    first = Window.partitionBy("event_id").orderBy(F.desc("score"), "listing_id")
    best = candidates.filter("score > 0").withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")
    bar = F.when(F.col("used_venue"), SAME).otherwise(SAME_BY_TITLE)
    verdict = F.when(F.col("score") >= bar, "same").when(F.col("score") >= UNSURE, "unsure").otherwise("new")
    return events.join(best.select("event_id", "listing_id", "score", "used_venue"), "event_id", "left").withColumn("verdict", verdict)


def _terms(keys: DataFrame, others: DataFrame, pieces: Column) -> DataFrame:
    """keys(key) with its distinct pieces, the corpus's rarest first: ranked, an array of (n, term)."""
    parts = lambda df: df.select("key", F.explode(pieces).alias("term"))
    counts = parts(keys.union(others)).groupBy("term").agg(F.count("*").alias("n"))
    return parts(keys).join(counts, "term").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "term"))).alias("ranked"))


def pieces_of(column: str) -> Column:
    """The distinct two-letter pieces of a key's words, a space on either side of each."""
    return F.expr(f"array_distinct(flatten(transform(split({column}, ' '), w -> transform(sequence(1, length(w) + 1), i -> substring(concat(' ', w, ' '), i, 2)))))")


def near_names(asked: DataFrame, known: DataFrame, *, least: float = TAKEN) -> DataFrame:
    """Pairs (key, candidate) of asked(key) and known(key), among them all whose set or sort likeness reaches `least`.

    Likeness c = least / 200 of texts of m and n letters asks for c(m + n) letters in common, in order. The others, m - L
    and n - L, spoil at most 2(m - L) + (n - L) <= (2 - 3c)m + (1 - 3c)n of the two-letter pieces of the first, words
    with a space on either side. So the rarest piece in common is no later than this among the rarest pieces of each,
    and only these are indexed; where it stands, the lengths and how many pieces are shared are asked of a pair too. Words that are the
    greater part of one side's letters make it alike whatever else the other has: the rarest words of a side, up to one
    beyond the letters that it may lose, are looked for among all words of the other.
    """
    c, words, pieces = least / 200, F.array_distinct(F.split("key", " ")), pieces_of("key")
    spare = lambda m, n: (2 - 3 * c) * m + (1 - 3 * c) * n + 1e-9
    sizes = {"m": F.length("key"), "d": F.length(F.array_join(words, " "))}
    asked, known = asked.select("key").distinct(), known.select("key").distinct()

    def indexed(keys: DataFrame, others: DataFrame, p: str) -> DataFrame:
        first = F.floor(spare(F.col("m"), F.col("m") * c / (1 - c))).cast("int") + 1
        rows = _terms(keys, others, pieces).withColumns(sizes).withColumn("all", F.col("ranked.term"))
        return rows.select(*(F.col(k).alias(f"{p}_{k}") for k in ("key", "m", "d", "all")), F.posexplode(F.slice("ranked.term", 1, first)).alias(f"{p}_at", "term"))

    def reached(size: str) -> Column:
        m, n = F.col(f"a_{size}"), F.col(f"b_{size}")
        shared = F.size(F.array_intersect("a_all", "b_all"))
        enough = (shared >= F.size("a_all") - spare(m, n)) & (shared >= F.size("b_all") - spare(n, m))
        return (F.least(m, n) + 1e-9 >= c * (m + n)) & (F.col("a_at") <= spare(m, n)) & (F.col("b_at") <= spare(n, m)) & enough

    pair = [F.col("a_key").alias("key"), F.col("b_key").alias("candidate")]
    by_pieces = indexed(asked, known, "a").join(indexed(known, asked, "b"), "term").filter(reached("m") | reached("d")).select(*pair)

    def rarest(keys: DataFrame, others: DataFrame, p: str) -> DataFrame:
        rows = _terms(keys, others, words).withColumns(sizes).select("key", "d", "ranked", F.posexplode("ranked").alias("at", "t"))
        before = F.aggregate(F.slice("ranked", 1, F.col("at")), F.lit(0), lambda n, x: n + F.length(x["term"]) + 1)
        return rows.filter(before <= F.col("d") * (1 - c / (1 - c)) + 1e-9).select(F.col("key").alias(f"{p}_key"), F.col("t.term").alias("term"))

    all_words = lambda keys, p: keys.select(F.col("key").alias(f"{p}_key"), F.explode(words).alias("term"))
    by_words = rarest(asked, known, "a").join(all_words(known, "b"), "term").select(*pair)
    by_words = by_words.union(all_words(asked, "a").join(rarest(known, asked, "b"), "term").select(*pair))
    return by_pieces.union(by_words).distinct()


#: What a run's score with another depends on: its title's and venue's keys, its first and last day.
RUN = ["_t", "_v", "_s", "_e"]


def with_run(rows: DataFrame) -> DataFrame:
    """rows(title, venue, start_date, end_date, ...) with RUN."""
    end = F.greatest(F.coalesce("end_date", "start_date"), "start_date")
    return rows.withColumns({"_t": T.norm_title("title"), "_v": T.norm_venue("venue"), "_s": F.col("start_date"), "_e": end})


def distinct_runs(rows: DataFrame, id_col: str) -> DataFrame:
    """RUN and id, the smallest of the rows that are equal there, stored; rows without a day or a title can't be alike and go."""
    texts = rows.groupBy("title", "venue", "start_date", "end_date").agg(F.min(id_col).alias("id"))
    return cut_lineage(with_run(texts).filter("_s is not null and _t <> ''").groupBy(*RUN).agg(F.min("id").alias("id")))


def alike_runs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of two distinct_runs on the same days that score SAME or more: a_id, a_t to a_e, b_id, b_t to b_e, score, used_venue.

    Whatever the venues are, titles of such a pair are alike too. So distinct titles meet first, by their pieces, and
    runs by day and title: pairs of other titles are never made.
    """
    least = (SAME - 100 * (1 - TITLE_SHARE)) / TITLE_SHARE - 1e-6
    titles = lambda runs: cut_lineage(runs.select(F.col("_t").alias("key")).distinct())
    near = near_names(titles(left), titles(right), least=least).withColumn("_score", token_set_udf("key", "candidate"))
    near = cut_lineage(near).filter(F.col("_score") >= least).select(F.col("key").alias("a_t"), F.col("candidate").alias("b_t"), "_score")
    side = lambda runs, p, q: runs.select(*(F.col(c).alias(f"{p}{c}" if c in RUN else f"{p}_{c}") for c in runs.columns), F.col("_s").alias(f"{q}_start"), F.col("_e").alias(f"{q}_end"))
    pairs = overlap_join(side(left, "a", "l").join(near, "a_t"), side(right, "b", "r"), on=["b_t"], spread=True)
    both = (F.col("a_v") != "") & (F.col("b_v") != "")
    pairs = pairs.withColumn("used_venue", both).withColumn("_venues", token_set_udf(F.when(both, F.col("a_v")), F.when(both, F.col("b_v"))))
    pairs = pairs.withColumn("score", blended(F.col("_score"), F.when(both, F.col("_venues")))).filter(F.col("score") >= SAME)
    return pairs.drop("_score", "_venues", "l_start", "l_end", "r_start", "r_end")


def resolve_names(names: DataFrame, directory: DataFrame) -> DataFrame:
    """names(name) with entry_id, entry_name, confidence from directory(entry_id, entry_name).

    An equal key is taken at 100, or at TAKEN if several entries have it (the lowest id is given). Other names get
    the entry whose tokens fit best, if the mean of set and sort likeness reaches TAKEN; then one of both does, so
    `near_names` has the pair, and every pair of a better set likeness if the entry's own reaches TAKEN. The few names
    for which it doesn't, but the mean does, meet all entries that share a piece with them, as a better one must.
    A name below TAKEN has no entry and the confidence of the best pair seen, 0 if none was.
    """
    keyed = directory.withColumn("key", F.coalesce(T.nz(T.norm_venue("entry_name")), F.lower("entry_name")))
    entries = keyed.groupBy("key").agg(F.min_by(F.struct("entry_id", "entry_name"), "entry_id").alias("e"), F.count("*").alias("n"))
    asked = names.select("name").distinct().withColumn("key", T.norm_venue("name"))
    exact = asked.filter("key <> ''").join(entries, "key").select("name", "e.entry_id", "e.entry_name", F.when(F.col("n") == 1, 100.0).otherwise(TAKEN).alias("confidence"))
    rest = asked.filter("key <> ''").join(entries.select("key"), "key", "left_anti")
    rest, known = cut_lineage(rest), cut_lineage(entries.select(F.col("key").alias("candidate"), "e"))

    def best(pairs: DataFrame) -> DataFrame:
        scores = pairs.withColumns({"s": token_set_udf("key", "candidate"), "o": token_sort_udf("key", "candidate")})
        place = F.struct(-F.col("s"), F.col("e.entry_id"))
        top = scores.join(known, "candidate").groupBy("key").agg(F.min_by(F.struct("s", "o", "e"), place).alias("top"))
        return top.select("key", "top.*").withColumn("confidence", (F.col("s") + F.col("o")) / 2)

    found = cut_lineage(best(near_names(rest, known.select(F.col("candidate").alias("key")))))
    open_ = (F.col("confidence") >= TAKEN) & (F.col("s") < TAKEN)
    wider = found.filter(open_).select("key", F.explode(pieces_of("key")).alias("term")).join(known.select("candidate", F.explode(pieces_of("candidate")).alias("term")), "term").select("key", "candidate").distinct()
    fits = found.filter(~open_).union(best(wider))
    taken = F.col("confidence") >= TAKEN
    fuzzy = rest.join(fits, "key").select("name", F.when(taken, F.col("e.entry_id")).alias("entry_id"), F.when(taken, F.col("e.entry_name")).alias("entry_name"), "confidence")
    return names.join(exact.union(fuzzy), "name", "left").fillna({"confidence": 0.0})


#: Open venues of a title and day that a round of cluster_greedily looks at as possible heads, and parts that the others are dealt into.
HEADS_AT_ONCE, PARTS = 64, 16


def cluster_greedily(events: DataFrame, *, least: float = 75.0) -> DataFrame:
    """events(event_id, title, venue, start_date) with cluster_id: the id of the first event of its cluster.

    Within equal titles and days, in order of id, an event joins the first cluster whose head's venue is alike;
    without a venue it stays alone. This is not transitive. Equal venues always go together, so each is one row with
    its first id. A round takes the first HEADS_AT_ONCE open venues of every title and day, finds the heads among
    them, and sends each open venue, dealt over PARTS parts of its title and day, past these heads: alike ones leave.
    So a title of one day may fill many tasks, and a row never meets more than HEADS_AT_ONCE others at a time.
    """
    keyed = events.withColumns({"_title": T.norm_title("title"), "_venue": T.norm_venue("venue")})
    firsts = keyed.filter("_venue <> ''").groupBy("_title", "start_date", "_venue").agg(F.min("event_id").alias("first_id"))
    kinds = dict(firsts.dtypes)
    head_list = f"array<struct<id:{kinds['first_id']},venue:string>>"

    @F.pandas_udf(head_list)
    def heads_of(lists: pd.Series) -> pd.Series:
        out = []
        for first in lists:
            heads: list[dict] = []
            for x in sorted(first, key=lambda x: x["id"]):
                if not any(token_set(x["venue"], h["venue"]) >= least for h in heads):
                    heads.append({"id": x["id"], "venue": x["venue"]})
            out.append(heads)
        return pd.Series(out)

    @F.pandas_udf(kinds["first_id"])
    def head_for(venues: pd.Series, lists: pd.Series) -> pd.Series:
        found = [next((h["id"] for h in sorted(heads, key=lambda h: h["id"]) if token_set(v, h["venue"]) >= least), None) for v, heads in zip(venues, lists)]
        return pd.Series(found, dtype="object")

    group = ["_title", "start_date"]
    part = F.pmod(F.xxhash64("_venue"), F.lit(PARTS))
    open_, placed = cut_lineage(firsts.withColumn("_part", part)), None
    while not open_.isEmpty():
        place = F.row_number().over(Window.partitionBy(*group).orderBy("first_id"))
        first = open_.withColumn("_r", place).filter(F.col("_r") <= HEADS_AT_ONCE)
        heads = first.groupBy(*group).agg(F.collect_list(F.struct(F.col("first_id").alias("id"), F.col("_venue").alias("venue"))).alias("heads"))
        heads = heads.select(F.col("_title").alias("_ht"), F.col("start_date").alias("_hd"), heads_of("heads").alias("heads"), F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_hp"))
        same = [open_["_title"] == heads["_ht"], open_["start_date"].eqNullSafe(heads["_hd"]), open_["_part"] == heads["_hp"]]
        met = open_.join(heads, same).select(*(open_[c] for c in open_.columns), "heads").withColumn("cluster_id", head_for("_venue", "heads"))
        met = cut_lineage(met.drop("heads"))
        settled = met.filter("cluster_id is not null").select(*group, "_venue", "cluster_id")
        placed = settled if placed is None else placed.union(settled)
        open_ = met.filter("cluster_id is null").drop("cluster_id")
    if placed is None:
        return events.withColumn("cluster_id", F.col("event_id"))
    placed = placed.toDF("_pt", "_pd", "_pv", "cluster_id")
    same = [keyed["_title"] == placed["_pt"], keyed["start_date"].eqNullSafe(placed["_pd"]), keyed["_venue"] == placed["_pv"]]
    joined = keyed.join(placed, same, "left")
    return joined.select(*(keyed[c] for c in events.columns), F.coalesce("cluster_id", keyed["event_id"]).alias("cluster_id"))


def claimed_hosts(candidates: DataFrame, sources: DataFrame) -> DataFrame:
    """candidates(name, url, ...) with claimed_by: the first other source (name, url) that has the host already."""
    hosts = sources.select(T.host("url").alias("host"), F.col("name").alias("owner")).filter("host is not null").distinct()
    asked = candidates.withColumn("host", T.host("url")).withColumn("_id", F.struct("name", "url"))
    owned = asked.select("_id", "host", "name").distinct().join(hosts, "host").filter("owner <> name").groupBy("_id").agg(F.min("owner").alias("claimed_by"))
    return asked.join(owned, "_id", "left").drop("_id", "host")
