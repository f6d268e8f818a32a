"""Queries of the registry, the policy, the export, duplicates and reports, over the driver's tables; the SQL computes the same from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators import calendar as Cal
from ..operators import discovery, ingest, matching, policy, productions
from ..sources import feeds, listings, registry, sinks
from . import summary
from .queries import _SCORES, query, sql_norm_title, sql_norm_venue, t, values

# ---- registry and page cache


@query(
    """WITH r AS (SELECT p_partkey AS o, p_name || ' ' || p_size AS name, p_brand AS b, p_size AS z FROM part),
    e AS (SELECT min(o) AS e FROM r WHERE name = (SELECT name FROM r WHERE o = 50)), h AS (SELECT min(o) AS h FROM r, e WHERE o > e.e AND name = (SELECT name FROM r WHERE o = 120)),
    k AS (SELECT r.*, CASE WHEN o <= e.e THEN 1 WHEN o > h.h THEN 4 WHEN o = h.h THEN 3 ELSE 2 END AS tier FROM r, e, h)
    SELECT name, min_by(tier, o)::INT AS tier, max_by(CASE WHEN o % 2 = 0 THEN 'https://' || lower(replace(b, '#', '')) || '.org' ELSE 'http://h' || z || '.org' END, o) AS home_url,
    max_by(CASE WHEN o % 4 < 2 THEN 'map' || o END, o) AS _map, max_by('https://a' || o, o) AS events_url, max_by(CASE WHEN o % 3 = 0 THEN 'b' || o || ',c' ELSE '' END, o) AS extra FROM k GROUP BY name""".replace("max_by(CASE WHEN o % 4 < 2 THEN 'map' || o END, o) AS _map", "list(CASE WHEN o % 4 < 2 THEN 'map' || o END ORDER BY o)[-1] AS sitemap_url")
)
def registry_sources(spark, sf_dir):
    """Parts as a list of sources: tiers by place, one row per name with its first tier and last addresses."""
    p = F.col("p_partkey")
    part = t(spark, sf_dir, "part")
    rows = part.select(
        p.alias("ordinal"), F.concat("p_name", F.lit(" "), F.col("p_size").cast("string")).alias("name"),
        F.when(p % 2 == 0, F.concat(F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit(".org"))).otherwise(F.format_string("http://h%d.org", "p_size")).alias("home"),
        F.when(p % 4 < 2, F.format_string("map%d", p)).when(p % 4 == 2, "NKS").otherwise("").alias("sitemap"),
        F.when(p % 3 == 0, F.format_string("a%d; b%d ;c;", p, p)).otherwise(F.format_string("a%d", p)).alias("events"),
    )
    marks = {r["ordinal"]: r["name"] for r in rows.filter("ordinal in (50, 120)").collect()}
    found = registry.sources(registry.with_tiers(rows, marks[50], marks[120]))
    return found.select("name", "tier", "home_url", "sitemap_url", "events_url", F.coalesce(F.array_join("extra_urls", ","), F.lit("")).alias("extra"))


@query(
    """WITH f AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-30' - INTERVAL 30 HOUR)
    SELECT DISTINCT user_id::VARCHAR AS url FROM events WHERE user_id NOT IN (SELECT user_id FROM f)"""
)
def pages_to_fetch(spark, sf_dir):
    """Addresses without a good page of the last 30 hours."""
    e = t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("url"), F.col("ts").alias("fetched_at"), F.when(F.col("event_type") == "view", 200).otherwise(500).alias("status"))
    return registry.to_fetch(e.select("url").distinct(), e, F.lit("2024-01-30").cast("timestamp"), F.lit(30)).select("url")


@query("SELECT user_id::VARCHAR AS url, max_by(event_id, ts) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1")
def stored_pages(spark, sf_dir):
    """The cache after fetches: the last good page of each address."""
    e = t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("url"), F.col("ts").alias("fetched_at"), F.when(F.col("event_type") == "view", 200).otherwise(500).alias("status"), "event_id")
    cut = F.col("fetched_at") < F.lit("2024-01-15").cast("timestamp")
    return registry.store_pages(e.filter(cut), e.filter(~cut)).select("url", "event_id")


@query(
    """SELECT page_id, 'p' || page_id || CASE WHEN page_id % 2 = 0 THEN ',e' || page_id ELSE '' END || ',h' || CASE WHEN page_id % 3 = 0 THEN ',x,y' ELSE '' END AS urls FROM pages"""
)
def urls_to_read(spark, sf_dir):
    k = F.col("page_id")
    pages = t(spark, sf_dir, "pages")
    extra = F.when(k % 3 == 0, F.array(F.lit("x"), F.lit("h"), F.lit(""), F.lit("y")))
    urls = registry.page_urls(F.format_string("p%d", k), F.when(k % 2 == 0, F.format_string("e%d", k)), F.lit("h"), extra)
    return pages.select("page_id", F.array_join(urls, ",").alias("urls"))


@query(
    """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'unreachable' WHEN page_id % 5 = 1 THEN 'unreadable' ELSE 'ok' END AS status FROM pages"""
)
def feed_status(spark, sf_dir):
    """What could not be fetched or read is told apart from what has no events."""
    k = F.col("page_id")
    body = F.when(k % 5 == 0, None).when(k % 5 == 1, F.concat(F.lit(' {"html": '), "html")).when(k % 5 == 2, F.to_json(F.struct("html"))).otherwise(F.col("html"))
    return feeds.status(t(spark, sf_dir, "pages").select("page_id", body.alias("body"))).select("page_id", "status")


# ---- policy

_PLACES = [("Philadelphia, PA", "out"), ("Newark", "home"), ("", "unknown"), ("Rahway, NJ", "out"), ("Dover", "home")]
_TITLES = [("Symphony Gala Concert", "in"), ("Video Studio Reservation", "no"), ("Plain gathering", "none"), ("Library Closed for Thanksgiving", "no"), ("Fine Arts Festival", "in"), ("Budget hearing", "none"), ("Sunday at the farm", "none")]
_TAGS = [["Book Discussions"], ["Story Time"], ["Community and Culture"], [], ["Story Time", "Arts and Crafts"]]
#: The tags are part of the text that keywords are looked for in, so those with one (book, arts, crafts) count as worded.
_WHERE = f"""c AS (SELECT o_orderkey AS k, pv, tv, gs, o_orderkey % 6 = 0 AS library, CASE WHEN o_orderkey % 4 < 2 AND o_orderkey % 9 > 0 THEN true ELSE false END AS trusted, (list_contains(gs, 'Book Discussions') OR list_contains(gs, 'Arts and Crafts')) AS worded, list_contains(gs, 'Community and Culture') AS hinted FROM orders
    JOIN {values([(i, r[1]) for i, r in enumerate(_PLACES)])} AS p(i, pv) ON o_orderkey % {len(_PLACES)} = p.i JOIN {values([(i, r[1]) for i, r in enumerate(_TITLES)])} AS y(j, tv) ON o_orderkey % {len(_TITLES)} = y.j
    JOIN {values([(i, ",".join(r)) for i, r in enumerate(_TAGS)])} AS g0(m, gt) ON o_orderkey // 7 % {len(_TAGS)} = g0.m, LATERAL (SELECT string_split(gt, ',') AS gs)),
  a AS (SELECT k, CASE WHEN pv = 'out' THEN 'out:place' WHEN tv = 'no' THEN 'out:title' WHEN library AND worded THEN 'in:library'
    WHEN library AND list_contains(gs, 'Story Time') THEN 'out:library' WHEN trusted AND (tv = 'in' OR worded) THEN 'in:trusted' WHEN trusted THEN 'in:uncategorized' WHEN tv = 'in' THEN 'in:title' WHEN worded OR hinted THEN 'review:hint' ELSE 'out:none' END AS v FROM c)"""


def _judged(spark, sf_dir):
    k = F.col("o_orderkey")
    pick = lambda rows, at: F.element_at(F.array(*rows), (at % len(rows) + 1).cast("int"))
    tags = [F.array(*map(F.lit, g)) if g else F.array().cast("array<string>") for g in _TAGS]
    df = t(spark, sf_dir, "orders").select(
        k.alias("event_id"), pick([F.lit(r[0]) for r in _TITLES], k).alias("title"), F.lit("").alias("description"), F.lit(None).cast("string").alias("venue_name"), F.lit(None).cast("string").alias("venue_address"),
        pick([F.lit(r[0]) for r in _PLACES], k).alias("venue_city"), F.lit(None).cast("string").alias("presenter"), pick(tags, F.floor(k / 7)).alias("source_categories"),
        (k % 4 + 1).cast("int").alias("tier"), (k % 9 == 0).alias("screened"), F.when(k % 6 == 0, "libcal").otherwise("tribe").alias("route"),
    )
    return policy.relevance(df)


@query(f"WITH {_WHERE} SELECT k AS event_id, split_part(v, ':', 1) AS relevance, v IN ('in:uncategorized', 'review:hint', 'out:none') AS wants_model FROM a")
def policy_relevance(spark, sf_dir):
    """The ordered policy: place, excluded titles, library tags, trusted sources, title keywords, hints."""
    return _judged(spark, sf_dir).select("event_id", "relevance", "wants_model")


@query(
    f"""WITH {_WHERE}, n AS (SELECT count(*) AS rows, count(*) FILTER (v LIKE 'in:%') AS in_scope, count(*) FILTER (v LIKE 'out:%') AS out_of_scope, count(*) FILTER (v = 'out:place') AS outside_region,
    count(*) FILTER (v LIKE 'review:%') AS review, count(*) FILTER (v = 'out:none') AS unclassified FROM a) SELECT 'policy' AS stage, key, value::BIGINT AS value FROM (UNPIVOT n ON COLUMNS(*) INTO NAME key VALUE value)"""
)
def policy_tally(spark, sf_dir):
    return policy.tally(_judged(spark, sf_dir))


@query(f"WITH {_WHERE}, w AS (SELECT *, row_number() OVER (PARTITION BY v IN ('in:uncategorized', 'review:hint', 'out:none') ORDER BY k) AS r FROM a) SELECT k AS event_id, CASE WHEN v IN ('in:uncategorized', 'review:hint', 'out:none') AND r <= 60 AND k % 3 < 2 THEN CASE WHEN k % 3 = 0 THEN 'in' ELSE 'out' END ELSE split_part(v, ':', 1) END AS relevance FROM w")
def model_verdicts(spark, sf_dir):
    """A model that says yes, refuses or fails, by id: the first 60 rows that want it are asked, failures keep their default."""

    def ask(row):
        if row["event_id"] % 3 == 2:
            raise TimeoutError
        return {"relevant": True, "reason": "asked"} if row["event_id"] % 3 == 0 else None

    return policy.apply_model(_judged(spark, sf_dir), policy.asking(ask), order=["event_id"], budget=60).select("event_id", "relevance")


# ---- export

_SHOWS = """s AS (SELECT o_orderkey AS event_id, 'show ' || (o_custkey % 7) AS title, CASE WHEN o_custkey % 5 > 0 THEN 'Hall ' || o_custkey END AS venue, o_orderdate::DATE AS d, (o_orderkey % 24) AS h FROM orders),
  g AS (SELECT *, title AS kt, coalesce(venue, '#' || event_id) AS kv FROM s),
  n AS (SELECT *, CASE WHEN date_diff('day', lag(d) OVER w, d) > 30 THEN 1 ELSE 0 END AS fresh FROM g WINDOW w AS (PARTITION BY kt, kv ORDER BY d, h, event_id)),
  r AS (SELECT *, sum(fresh) OVER (PARTITION BY kt, kv ORDER BY d, h, event_id) AS run FROM n),
  x AS (SELECT *, row_number() OVER (PARTITION BY kt, kv, run ORDER BY d, h, event_id) AS position, min(event_id) OVER (PARTITION BY kt, kv, run) AS production, count(*) OVER (PARTITION BY kt, kv, run) AS n FROM r)"""
_FLAGS = "CASE WHEN position > 1 THEN '' ELSE concat_ws(';', CASE WHEN venue IS NULL THEN 'NEEDS-DIRECTORY-ENTRY: venue ''None'' not in directory' END, CASE WHEN venue IS NOT NULL AND regexp_extract(venue, '\\d+')::BIGINT % 3 = 0 THEN 'CHECK-VENUE: matched ''' || venue || ''' at 88%' END, CASE WHEN event_id % 4 = 0 THEN 'NEEDS-CATEGORY: no category could be assigned' END, CASE WHEN event_id % 10 = 1 THEN 'UNUSABLE-URL: source had ''no address''' END, CASE WHEN n > 1 THEN 'X' END) END"


def _exported(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    orders, none = t(spark, sf_dir, "orders"), F.lit(None).cast("string")
    hall = F.format_string("Hall %d", c)
    events = orders.select(
        k.alias("event_id"), F.format_string("show %d", c % 7).alias("title"), F.when(c % 5 > 0, hall).alias("venue_name"), none.alias("presenter"),
        F.when(k % 4 == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(4))).alias("category_ids"), F.when(k % 10 == 1, "no address").otherwise("https://x.example.org").alias("url"), none.alias("ticket_url"), none.alias("phone"),
        F.lit("A show.").alias("description"), (k % 50).cast("int").alias("price_low"), (k % 50 + k % 2 * 5).cast("int").alias("price_high"), (k % 8 == 0).cast("int").alias("is_free"),
        F.col("o_orderdate").cast("date").alias("start_date"), F.format_string("%02d:00", k % 24).alias("start_time"), F.lit(None).cast("date").alias("end_date"),
    )
    venues = orders.select(hall.alias("name"), c.alias("entry_id"), hall.alias("entry_name"), F.when(c % 3 == 0, 88.0).otherwise(100.0).alias("confidence"))
    return productions.export_rows(events, venues, venues.limit(0))


@query(
    f"""WITH {_SHOWS} SELECT production, position::INT AS position, event_id, position > 1 AS continuation, CASE WHEN position = 1 THEN regexp_extract(venue, '\\d+') END AS venue_id, CASE WHEN position = 1 THEN title END AS title, strftime(d, '%m/%d/%Y') AS start_date,
    (CASE WHEN h % 12 = 0 THEN 12 ELSE h % 12 END)::VARCHAR || ':00' || CASE WHEN h < 12 THEN ' a.m.' ELSE ' p.m.' END AS start_time, CASE WHEN position = 1 THEN CASE WHEN event_id % 8 = 0 THEN 'FREE' ELSE (event_id % 50)::VARCHAR END END AS low_price,
    CASE WHEN position = 1 AND event_id % 8 <> 0 AND event_id % 2 = 1 THEN (event_id % 50 + 5)::VARCHAR END AS high_price FROM x"""
)
def export_rows(spark, sf_dir):
    """Productions by gaps over 30 days: the first row has all fields, the others date and time only."""
    rows = _exported(spark, sf_dir)
    return rows.select("production", "position", "event_id", "continuation", F.col("`venue ID`").alias("venue_id"), F.col("`title of program`").alias("title"), F.col("`start date`").alias("start_date"), F.col("`start time`").alias("start_time"), F.col("`low price`").alias("low_price"), F.col("`high price`").alias("high_price"))


@query(
    f"""WITH {_SHOWS}, u AS (SELECT kt, kv, run, count(DISTINCT event_id % 10 = 1) AS urls FROM x GROUP BY 1, 2, 3)
    SELECT event_id, replace({_FLAGS}, 'X', 'CHECK-GROUPING: ' || n || ' performances with ' || urls || ' different detail URLs') AS flags FROM x JOIN u USING (kt, kv, run)""".replace("CASE WHEN n > 1 THEN 'X' END", "CASE WHEN n > 1 AND urls > 1 THEN 'X' END")
)
def export_flags(spark, sf_dir):
    return _exported(spark, sf_dir).select("event_id", F.array_join("flags", ";").alias("flags"))


@query(
    f"""WITH {_SHOWS}, u AS (SELECT kt, kv, run, count(DISTINCT event_id % 10 = 1) AS urls FROM x GROUP BY 1, 2, 3), f AS (SELECT position, {_FLAGS} AS f FROM x JOIN u USING (kt, kv, run))
    SELECT count(*)::BIGINT AS rows, count(*) FILTER (position = 1)::BIGINT AS productions, count(*) FILTER (position = 1 AND f <> '')::BIGINT AS flagged, 0::BIGINT AS with_problems FROM f""".replace("CASE WHEN n > 1 THEN 'X' END", "CASE WHEN n > 1 AND urls > 1 THEN 'X' END")
)
def export_counts(spark, sf_dir):
    return summary.export_counts(_exported(spark, sf_dir))


@query("SELECT section, n FROM (SELECT 'borderline' AS section, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'uncertain', count(*)::BIGINT FROM orders WHERE o_orderpriority = '5-LOW' UNION ALL SELECT 'outside region', count(*)::BIGINT FROM customer WHERE c_nationkey < 5 UNION ALL SELECT 'duplicates', count(*)::BIGINT FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'past', count(*)::BIGINT FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1998-01-01') WHERE n > 0")
def review_counts(spark, sf_dir):
    """Sections of the review report, counted."""
    verdict = F.when(F.col("o_orderstatus") == "P", "unsure").when(F.col("o_orderstatus") == "F", "same").otherwise("new")
    scope = F.when(F.col("o_orderpriority") == "5-LOW", "review").when(F.col("o_orderpriority") == "1-URGENT", "in").otherwise("out")
    text = F.lit("x")
    events = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), text.alias("title"), verdict.alias("verdict"), text.alias("verdict_reason"), scope.alias("relevance"), text.alias("reason"), F.col("o_orderdate").cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    rejected = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("event_id"), F.col("c_name").alias("title"), F.when(F.col("c_nationkey") < 5, "outside region: x").otherwise("other").alias("reason"))
    rows = events.select("event_id", F.col("title").alias("title of program"), F.array().cast("array<string>").alias("flags"), F.array().cast("array<string>").alias("problems"))
    return sinks.section_counts(sinks.review_sections(events, rows, rejected, F.lit("1998-01-01").cast("date")))


@query(
    """SELECT 'source status' AS what, coalesce(CASE WHEN c_nationkey < 20 THEN c_mktsegment END, '(unknown)') AS key, count(*)::BIGINT AS n FROM customer GROUP BY 2 UNION ALL SELECT 'route', coalesce(CASE WHEN c_nationkey > 4 THEN c_mktsegment END, 'none'), count(*)::BIGINT FROM customer GROUP BY 2
    UNION ALL SELECT 'channel', l_returnflag, count(*)::BIGINT FROM lineitem GROUP BY 2 UNION ALL SELECT 'relevance', o_orderpriority, count(*)::BIGINT FROM orders GROUP BY 2 UNION ALL SELECT 'verdict', CASE WHEN o_orderkey % 3 = 0 THEN '(pending)' ELSE o_orderstatus END, count(*)::BIGINT FROM orders GROUP BY 2
    UNION ALL SELECT 'total', 'raw events', count(*)::BIGINT FROM lineitem UNION ALL SELECT 'total', 'events', count(*)::BIGINT FROM orders"""
)
def run_counts(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(F.when(F.col("c_nationkey") < 20, F.col("c_mktsegment")).alias("status"), F.when(F.col("c_nationkey") > 4, F.col("c_mktsegment")).alias("route"))
    events = t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("relevance"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("verdict"))
    return summary.run_counts(c, t(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("channel")), events)


# ---- duplicates, directory, listings

_DUP_TITLE = "substr(p_name, 1 + p_partkey % 2)"


@query(
    f"""WITH a AS (SELECT s_suppkey AS row_id, p_name AS title, DATE '2024-01-01' + (s_suppkey % 400)::INT AS d FROM supplier JOIN part ON p_partkey = s_suppkey),
    b AS (SELECT p_partkey AS listing_id, {_DUP_TITLE} AS title, DATE '2024-01-01' + (p_partkey * 7 % 400)::INT AS d, DATE '2024-01-01' + (p_partkey * 7 % 400 + 2)::INT AS e FROM part),
    left_t AS (SELECT DISTINCT {sql_norm_title('title')} AS t FROM a), right_t AS (SELECT DISTINCT {sql_norm_title('title')} AS t FROM b), {_SCORES},
    m AS (SELECT row_id, listing_id, score, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, listing_id) AS r FROM a JOIN b ON a.d BETWEEN b.d AND b.e JOIN scores s ON s.a = {sql_norm_title('a.title')} AND s.b = {sql_norm_title('b.title')})
    SELECT a.row_id, m.listing_id AS duplicate_of FROM a LEFT JOIN m ON m.row_id = a.row_id AND m.r = 1 AND m.score >= 96"""
)
def calendar_duplicates(spark, sf_dir):
    """Uploaded rows, one day each, against listings of three days with their first letter cut off half of the time."""
    day = lambda n: F.expr(f"date_add(date'2024-01-01', cast({n} as int))")
    part, none = t(spark, sf_dir, "part"), F.lit(None).cast("string")
    rows = t(spark, sf_dir, "supplier").join(part, F.col("p_partkey") == F.col("s_suppkey")).select(F.col("s_suppkey").alias("row_id"), F.col("p_name").alias("title"), none.alias("venue"), day("s_suppkey % 400").alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    listed = part.select(F.col("p_partkey").alias("listing_id"), F.expr("substring(p_name, cast(1 + p_partkey % 2 as int))").alias("title"), none.alias("venue"), day("p_partkey * 7 % 400").alias("start_date"), day("p_partkey * 7 % 400 + 2").alias("end_date"))
    return ingest.calendar_duplicates(rows, listed).select("row_id", "duplicate_of")


@query(
    f"""WITH e AS (SELECT p_name AS name, min(p_partkey) AS id FROM part GROUP BY 1), left_t AS (SELECT id, name, {sql_norm_venue("substr(name, 2)")} AS t FROM e), right_t AS (SELECT id, name, {sql_norm_venue('name')} AS t FROM e), {_SCORES},
    pick AS (SELECT l.id AS name_id, l.t AS lt, r.t AS rt, r.id AS entry_id, s.score, row_number() OVER (PARTITION BY l.id ORDER BY s.score DESC, r.id) AS k FROM left_t l JOIN scores s ON s.a = l.t JOIN right_t r ON r.t = s.b WHERE l.t NOT IN (SELECT t FROM right_t)),
    sorted AS (SELECT *, array_to_string(list_sort(string_split(lt, ' ')), ' ') AS x, array_to_string(list_sort(string_split(rt, ' ')), ' ') AS y FROM pick WHERE k = 1),
    lp AS (WITH RECURSIVE d(x, y, n, row) AS (SELECT DISTINCT x, y, 0, list_transform(range(0, length(y) + 1), lambda z: 0) FROM sorted UNION ALL
      SELECT x, y, n + 1, list_transform(range(1, length(y) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(row[k], CASE WHEN k > 1 AND x[n + 1] = y[k - 1] THEN row[k - 1] + 1 ELSE 0 END)))) FROM d WHERE n < length(x))
      SELECT x, y, 200.0 * row[-1] / (length(x) + length(y)) AS v FROM d WHERE n = length(x))
    SELECT name_id, CASE WHEN (score + v) / 2 >= 84 THEN entry_id END AS entry_id, round((score + v) / 2, 4)::DOUBLE AS confidence FROM sorted JOIN lp USING (x, y)
    UNION ALL SELECT l.id, min(r.id), CASE WHEN count(*) = 1 THEN 100.0 ELSE 84.0 END::DOUBLE FROM left_t l JOIN right_t r ON l.t = r.t GROUP BY l.id"""
)
def venue_fuzzy(spark, sf_dir):
    """Part names without their first letter against the directory of all names, by likeness."""
    part = t(spark, sf_dir, "part").groupBy(F.col("p_name").alias("entry_name")).agg(F.min("p_partkey").alias("entry_id"))
    names = part.select(F.col("entry_id").alias("name_id"), F.expr("substring(entry_name, 2)").alias("name"))
    found = matching.resolve_names(names.select("name"), part)
    return names.join(found, "name").select("name_id", "entry_id", F.round("confidence", 4).alias("confidence"))


@query(
    """WITH s AS (SELECT p_partkey AS listing_id, p_name AS title, CASE WHEN p_partkey % 3 > 0 THEN p_brand ELSE '' END AS venue, DATE '2024-01-01' + (p_partkey % 50)::INT AS d FROM part),
    o AS (SELECT DISTINCT title, venue, d FROM s WHERE listing_id % 2 = 0), f AS (SELECT title, venue, d, min(listing_id) AS id FROM s WHERE listing_id % 2 = 1 GROUP BY 1, 2, 3)
    SELECT origin, count(*)::BIGINT AS n FROM (SELECT 'snapshot' AS origin FROM s WHERE listing_id % 2 = 0 UNION ALL SELECT 'sighted' FROM f WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.title = f.title AND o.venue = f.venue AND o.d = f.d)) GROUP BY 1"""
)
def listing_origins(spark, sf_dir):
    """A snapshot in two date forms and fresh sightings, each new title, venue and day once."""
    k = F.col("p_partkey")
    day = F.expr("date_add(date'2024-01-01', cast(p_partkey % 50 as int))")
    part = t(spark, sf_dir, "part")
    venue = F.when(k % 3 > 0, F.col("p_brand"))
    snapshot = listings.read_snapshot(part.filter(k % 2 == 0).select(F.concat(F.lit(" "), "p_name").alias("Title"), venue.alias("venue"), F.when(k % 4 == 0, D.fmt_date(day)).otherwise(day.cast("string")).alias("Start "), F.lit(None).cast("string").alias("end")))
    seen = part.filter(k % 2 == 1).select(k.alias("listing_id"), F.col("p_name").alias("title"), venue.alias("venue"), day.alias("start_date"), day.alias("end_date"))
    return summary.totals_by_origin(listings.with_sightings(snapshot, seen))


@query(
    """SELECT p_partkey::VARCHAR AS listing_id, CASE WHEN p_partkey % 3 > 0 THEN p_brand ELSE coalesce(n_name, '') END AS venue, strftime(DATE '2024-01-01' + (p_partkey % 300)::INT, '%Y-%m-%d') AS day,
    strftime(DATE '2024-01-01' + (p_partkey % 300)::INT, '%a %b ') || day(DATE '2024-01-01' + (p_partkey % 300)::INT) || ', 2024' AS shown_day, CASE WHEN p_partkey % 4 > 0 THEN (p_partkey % 12 * 60 + 720 + 15)::INT END AS minute FROM part LEFT JOIN nation ON n_nationkey = p_size"""
)
def calendar_entries(spark, sf_dir):
    """Listings as calendar entries: venue names looked up where missing, days and minutes from texts."""
    k = F.col("p_partkey")
    day = F.expr("date_add(date'2024-01-01', cast(p_partkey % 300 as int))")
    hour = F.when(k % 12 == 0, 12).otherwise(k % 12)
    rows = t(spark, sf_dir, "part").select(
        k.cast("string").alias("listing_id"), F.col("p_size").cast("string").alias("venue_id"), F.when(k % 3 > 0, F.col("p_brand")).otherwise("").alias("venue_name"), F.col("p_name").alias("title"), F.lit("4,17").alias("categories"), F.lit("$5").alias("price"),
        D.fmt_date(day).alias("start_date"), F.when(k % 4 > 0, F.format_string("%d:15 p.m.", hour)).alias("start_time"), F.lit(None).cast("string").alias("end_date"),
    )
    names = t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("venue_id"), F.col("n_name").alias("name"))
    return Cal.entries(rows, names).select("listing_id", "venue", "day", "shown_day", "minute")


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'red w') OR contains(lower(p_brand), 'red w')")
def calendar_search(spark, sf_dir):
    return Cal.search(t(spark, sf_dir, "part"), "Red W", ["p_name", "p_brand"]).select("p_partkey")


@query(
    """WITH c AS (SELECT l_orderkey::VARCHAR AS name, 'https://' || l_linenumber || '-' || l_suppkey || '.org' AS url, l_quantity > 25 AS confirmed, l_discount < 0.05 AS reachable, l_partkey % 101 AS s FROM lineitem),
    r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY confirmed DESC, reachable DESC, s DESC, url) AS rank FROM c)
    SELECT name, url, rank::INT AS rank, confirmed AND s >= 85 AND rank = 1 AS apply FROM r WHERE rank <= 3"""
)
def candidate_ranks(spark, sf_dir):
    """Lines as candidates of their order: the best three, and which may replace the old address."""
    rows = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("name"), F.format_string("https://%d-%d.org", "l_linenumber", "l_suppkey").alias("url"), (F.col("l_quantity") > 25).alias("confirmed"), (F.col("l_discount") < 0.05).alias("reachable"), (F.col("l_partkey") % 101).cast("double").alias("host_score"))
    ranked = discovery.rank_candidates(rows, top=3).withColumns({"old_url": F.lit("https://old.org"), "claimed_by": F.lit(None).cast("string")})
    chosen = discovery.to_apply(ranked).select("name", "url", "rank", F.lit(True).alias("apply"))
    return ranked.select("name", "url", "rank").join(chosen, ["name", "url", "rank"], "left").withColumn("apply", F.coalesce("apply", F.lit(False)))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'FREE' WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '$' || (o_orderkey % 40) ELSE '$' || (o_orderkey % 40) || '–$' || (o_orderkey % 40 + 5) END AS label,
    o_orderdate::DATE + (o_orderkey % 40)::INT >= DATE '1998-06-01' - 1 AND o_orderdate::DATE <= DATE '1998-06-01' + 540 AS near FROM orders"""
)
def labels_and_horizon(spark, sf_dir):
    """Price labels, and which runs are within the horizon of a day."""
    k = F.col("o_orderkey")
    low = F.when(k % 5 != 0, (k % 40).cast("int"))
    label = T.price_label(low, F.when(k % 3 == 0, low).otherwise(low + 5), (k % 7 == 0).cast("int"))
    start = F.col("o_orderdate").cast("date")
    near = D.in_horizon(start.cast("string"), F.date_add(start, (k % 40).cast("int")).cast("string"), F.lit("1998-06-01").cast("date"))
    return t(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"), near.alias("near"))
