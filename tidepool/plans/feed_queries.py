"""Queries of the readers: feed bodies are made from the driver's tables and read back; the SQL computes the events from the rows themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import feeds
from .queries import query, sql_visible, t


def _docs(spark, sf_dir) -> DataFrame:
    """Documents as events of feeds with 50 each, with a day for each."""
    rows = t(spark, sf_dir, "documents").select(F.expr("doc_id div 50").alias("source_id"), F.col("doc_id").alias("k"), "text", "lang", "source")
    return rows.withColumn("day", F.date_format(F.expr("date_add(date'2024-01-01', cast(k % 300 as int))"), "yyyy-MM-dd"))


_DOCS = "d AS (SELECT doc_id // 50 AS source_id, doc_id AS k, text, lang, source, strftime(DATE '2024-01-01' + (doc_id % 300)::INT, '%Y-%m-%d') AS day FROM documents)"


def _bodies(df: DataFrame, item: Column, shape: Column, between: str = ",") -> DataFrame:
    """pages(source_id, url, body): the items of each source in order of k, put into `shape` where it says {}."""
    made = df.select("source_id", F.struct("k", item.alias("j")).alias("r")).groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["j"]), between).alias("all"))
    return made.select("source_id", F.format_string("https://s%d.example.org/feed", "source_id").alias("url"), F.replace(shape, F.lit("{}"), F.col("all")).alias("body"))


def _text(*parts) -> Column:
    return F.concat(*(F.col(p).cast("string") if p in ("k", "day", "source_id") else F.lit(p) for p in parts))


def _shown(events: DataFrame, *columns: str) -> DataFrame:
    """The named columns; long texts as digests, tags in one text."""
    change = {"description": F.sha1("description"), "source_categories": F.array_join("source_categories", ","), "summary": F.sha1("summary"), "content": F.sha1("content")}
    return events.select(*(change.get(c, F.col(c)).alias(c) for c in columns))


@query(
    f"""WITH {_DOCS} SELECT source_id, 'Show ' || k AS title, sha1(substr(text, 1, 2000)) AS description, day || ' 19:00:00' AS start, k % 2 = 0 AS all_day,
    CASE WHEN k % 3 < 2 THEN source END AS venue_name, CASE WHEN k % 3 < 2 THEN k || ' Main St' END AS venue_address, CASE WHEN k % 3 < 2 THEN lang END AS venue_city,
    CASE WHEN k % 3 < 2 THEN 'Group ' || k ELSE 'Plain ' || k END AS presenter, 'https://x.example.org/' || k AS url, concat_ws(',', lang, 'show') AS source_categories, '$' || k AS cost_text FROM d"""
)
def rest_calendar_events(spark, sf_dir):
    """Venue and organizer as objects, as lists and as plain text."""
    place = F.struct(F.col("source").alias("venue"), _text("k", " Main St").alias("address"), F.col("lang").alias("city"))
    group = F.struct(_text("Group ", "k").alias("organizer"))
    common = [
        _text("Show ", "k").alias("title"), F.col("text").alias("description"), _text("day", " 19:00:00").alias("start_date"), (F.col("k") % 2 == 0).alias("all_day"),
        _text("https://x.example.org/", "k").alias("url"), _text("$", "k").alias("cost"), F.array(F.struct(F.col("lang").alias("name")), F.struct(F.lit("show").alias("name"))).alias("categories"),
    ]
    objects = F.to_json(F.struct(*common, place.alias("venue"), group.alias("organizer")))
    lists = F.to_json(F.struct(*common, F.array(place).alias("venue"), F.array(group, F.struct(F.lit("Other").alias("organizer"))).alias("organizer")))
    plain = F.to_json(F.struct(*common, F.lit("Hall").alias("venue"), _text("Plain ", "k").alias("organizer")))
    pages = _bodies(_docs(spark, sf_dir), F.when(F.col("k") % 3 == 0, objects).when(F.col("k") % 3 == 1, lists).otherwise(plain), F.lit('{"total":1,"events":[{}]}'))
    return _shown(feeds.rest_calendar(pages), "source_id", "title", "description", "start", "all_day", "venue_name", "venue_address", "venue_city", "presenter", "url", "source_categories", "cost_text")


@query(
    f"""WITH {_DOCS} SELECT source_id, 'Talk ' || k AS title, sha1(substr(text, 1, 2000)) AS description, day || 'T10:00:00' AS start, day || 'T11:30:00' AS "end",
    CASE WHEN k % 2 = 0 AND source <> '' THEN source ELSE 'Calendar ' || k END AS venue_name, 'Host ' || k AS presenter, CASE WHEN k % 4 = 0 THEN '5' ELSE 'Free' END AS cost_text,
    concat_ws(',', 'Book Discussions', lang, 'Adults') AS source_categories FROM d"""
)
def library_calendar_events(spark, sf_dir):
    item = F.to_json(
        F.struct(
            _text("Talk ", "k").alias("title"), F.col("text").alias("description"), _text("day", " 10:00:00").alias("startdt"), _text("day", " 11:30:00").alias("enddt"),
            F.when(F.col("k") % 2 == 0, F.col("source")).otherwise("").alias("campus"), _text("Calendar ", "k").alias("calendar"), _text("Host ", "k").alias("presenter"),
            F.when(F.col("k") % 4 == 0, "5").otherwise("").alias("registration_cost"), F.lit("Free").alias("cost"),
            F.array(F.struct(F.lit("Book Discussions").alias("name")), F.struct(F.col("lang").alias("name"))).alias("categories_arr"), F.array(F.struct(F.lit("Adults").alias("name"))).alias("audiences"),
        )
    )
    pages = _bodies(_docs(spark, sf_dir), item, F.lit('{"results":[{}]}'))
    return _shown(feeds.library_calendar(pages), "source_id", "title", "description", "start", "end", "venue_name", "presenter", "cost_text", "source_categories")


@query(
    f"""WITH {_DOCS} SELECT source_id, 'Act ' || k AS title, sha1({sql_visible("'<p>' || replace(replace(coalesce(text, 'none'), '&', '&amp;'), '<', '&lt;') || '</p><script>x()</script>'")}) AS description,
    strftime((TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (k * 7 % 40000)) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%dT%H:%M') AS start, 'Hall ' || k AS venue_name,
    CASE WHEN k % 3 = 0 THEN k || ' Oak Ave, Dover' ELSE k || ' Oak Ave' END AS venue_address, 'https://s' || source_id || '.example.org/e/' || k AS url, concat_ws(',', 'a', 'b') AS source_categories FROM d"""
)
def site_builder_events(spark, sf_dir):
    """Items under either name, times in milliseconds, texts as markup."""
    marked = F.concat(F.lit("<p>"), F.replace(F.replace(F.coalesce("text", F.lit("none")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</p><script>x()</script>"))
    where = F.struct(_text("Hall ", "k").alias("addressTitle"), _text("k", " Oak Ave").alias("addressLine1"), F.when(F.col("k") % 3 == 0, "Dover").otherwise("").alias("addressLine2"))
    item = F.to_json(
        F.struct(
            _text("Act ", "k").alias("title"), F.when(F.col("k") % 2 == 0, marked).otherwise("").alias("excerpt"), marked.alias("body"),
            (F.lit(1704067200000) + F.col("k") * 7 % 40000 * 3600000).alias("startDate"), where.alias("location"), _text("/e/", "k").alias("fullUrl"), F.array(F.lit("a"), F.lit("b")).alias("categories"),
        )
    )
    shape = F.when(F.col("source_id") % 2 == 0, '{"upcoming":[{}],"items":[]}').otherwise('{"items":[{}]}')
    return _shown(feeds.site_builder(_bodies(_docs(spark, sf_dir), item, shape)), "source_id", "title", "description", "start", "venue_name", "venue_address", "url", "source_categories")


@query(
    f"""WITH {_DOCS} SELECT source_id, 'Night, part ' || k AS title, sha1('one two; ' || k) AS description, k % 4 = 0 AS all_day,
    CASE WHEN k % 4 = 0 THEN day WHEN k % 4 = 1 THEN day || 'T19:30'
      ELSE strftime((day::TIMESTAMP + INTERVAL 19 HOUR + INTERVAL 30 MINUTE) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%dT%H:%M') END AS start,
    CASE WHEN k % 4 = 0 THEN strftime(day::DATE + 1, '%Y-%m-%d') END AS "end", 'Barn ' || k AS venue_name FROM d WHERE k % 4 <> 3"""
)
def icalendar_events(spark, sf_dir):
    """Folded lines, escapes, all-day, local and UTC times, cancelled events."""
    flat = F.replace("day", F.lit("-"), F.lit(""))
    after = F.date_format(F.date_add(F.col("day").cast("date"), 2), "yyyyMMdd")
    kind = F.col("k") % 4
    start = F.when(kind == 0, F.concat(F.lit("DTSTART;VALUE=DATE:"), flat, F.lit("\r\nDTEND;VALUE=DATE:"), after)).when(kind == 1, F.concat(F.lit("DTSTART;TZID=America/New_York:"), flat, F.lit("T193000"))).otherwise(F.concat(F.lit("DTSTART:"), flat, F.lit("T193000Z")))
    item = F.concat(F.lit("BEGIN:VEVENT\r\nSUMMARY:Night\\, part "), F.col("k").cast("string"), F.lit("\r\nDESCRIPTION:one t\r\n wo\\; "), F.col("k").cast("string"), F.lit("\r\n"), start, F.lit("\r\nLOCATION:Barn "), F.col("k").cast("string"), F.when(kind == 3, "\r\nSTATUS:CANCELLED").otherwise("\r\nSTATUS:CONFIRMED"), F.lit("\r\nEND:VEVENT"))
    pages = _bodies(_docs(spark, sf_dir), item, F.lit("BEGIN:VCALENDAR\r\n{}\r\nEND:VCALENDAR"), "\r\n")
    return _shown(feeds.icalendar(pages), "source_id", "title", "description", "all_day", "start", "end", "venue_name")


@query(
    f"""WITH {_DOCS}, n AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY k) - 1 AS position FROM d)
    SELECT source_id, position::INT AS position, 'News & notes ' || k AS title, 'https://x.example.org/' || k AS link, sha1('Part ' || k || ' & more') AS summary FROM n WHERE position < 25"""
)
def rss_items(spark, sf_dir):
    """RSS items in CDATA and Atom entries with a link attribute; the first 25 of a feed."""
    rss = _text("<item><title>News &amp; notes ", "k", "</title><link>https://x.example.org/", "k", "</link><description><![CDATA[<p>Part <b>", "k", "</b> &amp; more</p>]]></description></item>")
    atom = _text('<entry><title type="text">News &amp; notes ', "k", '</title><link rel="alternate" href="https://x.example.org/', "k", '"/><summary>Part ', "k", " &amp;amp; more</summary></entry>")
    pages = _bodies(_docs(spark, sf_dir), F.when(F.col("source_id") % 2 == 0, rss).otherwise(atom), F.lit("<feed>{}</feed>"), "\n")
    return _shown(feeds.rss_entries(pages), "source_id", "position", "title", "link", "summary")


@query(
    f"""WITH {_DOCS} SELECT source_id, 'https://x.example.org/' || k AS link, 'Post ' || k AS title,
    sha1(CASE WHEN k % 3 = 0 THEN 'Doors open on March 5 at the hall by the river, come early ' || k WHEN k % 2 = 0 THEN 'Whole page ' || k ELSE 'thin ' || k END) AS content FROM d"""
)
def post_contents(spark, sf_dir):
    """Dated contents stay; thin ones come from the post's own page, where there is one."""
    docs = _docs(spark, sf_dir)
    content = F.when(F.col("k") % 3 == 0, _text("<p>Doors open on March 5 at the hall by the river, come early ", "k", "</p>")).otherwise(_text("<p>thin ", "k", "</p>"))
    item = F.to_json(F.struct(_text("https://x.example.org/", "k").alias("link"), F.struct(_text("<i>Post</i> ", "k").alias("rendered")).alias("title"), F.struct(content.alias("rendered")).alias("content")))
    details = docs.select(_text("https://x.example.org/", "k").alias("url"), F.when(F.col("k") % 2 == 0, _text("<html><body>Whole <b>page</b> ", "k", "</body></html>")).alias("body"))
    return _shown(feeds.wp_posts(_bodies(docs, item, F.lit("[{}]")), details), "source_id", "link", "title", "content")


@query(
    f"""WITH {_DOCS} SELECT source_id, 'Play ' || k AS title, day || 'T20:00' AS start, CASE WHEN k % 5 < 3 THEN 'Stage ' || k ELSE 'Plain stage' END AS venue_name,
    CASE WHEN k % 5 < 3 THEN k || ' Elm St' END AS venue_address, CASE WHEN k % 5 < 3 THEN coalesce(lang, 'none') END AS venue_city, 'Troupe ' || k AS presenter,
    CASE WHEN k % 2 = 0 THEN 'https://x.example.org/' || k ELSE 'https://s' || source_id || '.example.org/feed' END AS url, '12' AS cost_text FROM d WHERE k % 7 <> 0 AND k % 5 <> 4"""
)
def json_ld_events(spark, sf_dir):
    """Events alone, in lists and under @graph; cancelled ones and other types go."""
    address = F.struct(_text("k", " Elm St").alias("streetAddress"), F.coalesce("lang", F.lit("none")).alias("addressLocality"))
    place = F.struct(_text("Stage ", "k").alias("name"), address.alias("address"))
    kind = F.when(F.col("k") % 5 == 4, "Organization").otherwise("TheaterEvent").alias("@type")
    common = [
        kind, _text("Play ", "k").alias("name"), _text("day", "T20:00").alias("startDate"), F.when(F.col("k") % 7 == 0, "https://schema.org/EventCancelled").alias("eventStatus"),
        F.when(F.col("k") % 2 == 0, _text("https://x.example.org/", "k")).alias("url"), F.array(F.struct(F.lit("12").alias("price"))).alias("offers"),
    ]
    named = F.to_json(F.struct(*common, place.alias("location"), F.struct(_text("Troupe ", "k").alias("name")).alias("organizer")))
    plain = F.to_json(F.struct(*common, F.lit("Plain stage").alias("location"), F.array(F.struct(_text("Troupe ", "k").alias("name"))).alias("organizer")))
    open_, close = '<script type="application/ld+json">', "</script>"
    shape = F.when(F.col("source_id") % 2 == 0, f"<html>{open_}[{{}}]{close}</html>").otherwise(f'<html>{open_}{{"@context":"https://schema.org","@graph":[{{}}]}}{close}</html>')
    item = F.when(F.col("k") % 5 < 3, named).otherwise(plain)
    docs = _docs(spark, sf_dir)
    alone = _bodies(docs.filter("source_id % 3 = 2"), item, F.lit(f"<html>{open_}{{}}{close}</html>"), f"{close}\n{open_}")
    pages = _bodies(docs.filter("source_id % 3 <> 2"), item, shape).union(alone)
    return _shown(feeds.json_ld(pages), "source_id", "title", "start", "venue_name", "venue_address", "venue_city", "presenter", "url", "cost_text")


@query(
    f"""WITH {_DOCS}, u AS (SELECT source_id, 'https://x.example.org/p?a=1&b=' || k AS loc, CASE WHEN k % 4 > 0 THEN day END AS lastmod FROM d)
    SELECT source_id, loc, lastmod FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY lastmod DESC NULLS LAST, loc) AS r FROM u) WHERE r <= 40"""
)
def sitemap_newest(spark, sf_dir):
    """The 40 pages of each sitemap that changed last."""
    item = F.concat(_text("<url><loc> https://x.example.org/p?a=1&amp;b=", "k", " </loc>"), F.when(F.col("k") % 4 > 0, _text("<lastmod>", "day", "</lastmod>")).otherwise(""), F.lit("</url>"))
    return feeds.sitemap_locs(_bodies(_docs(spark, sf_dir), item, F.lit("<urlset>{}</urlset>"), "\n"), newest=40)


@query(
    f"""WITH {_DOCS}, n AS (SELECT k % 97 AS entry_id, k, row_number() OVER (PARTITION BY k % 97 ORDER BY 'https://s' || source_id || '.example.org/feed', k) AS r FROM d WHERE k % 11 <> 0)
    SELECT entry_id, 'Org & Co ' || k AS entry_name, 'org-' || k AS slug FROM n WHERE r = 1"""
)
def directory_names(spark, sf_dir):
    """Directory anchors, many per organisation; the first name counts, anchors without a text don't."""
    item = F.concat(F.format_string('<li><a class="o" href="/organization/%d/org-%d?x=1">', F.col("k") % 97, F.col("k")), F.when(F.col("k") % 11 == 0, "<img>").otherwise(_text("<b>Org</b> &amp; Co ", "k")), F.lit("</a></li>"))
    return feeds.directory_entries(_bodies(_docs(spark, sf_dir), item, F.lit("<ul>{}</ul>"), "\n"))


@query(
    f"""WITH {_DOCS}, s AS (SELECT k % 60 AS listing_id, DATE '2024-01-01' + (source_id % 200)::INT AS day, k, CASE WHEN k % 60 % 5 = 0 THEN DATE '2024-12-20' END AS through FROM d)
    SELECT listing_id, count(DISTINCT day)::BIGINT AS n_days, bool_or(through IS NOT NULL) AS is_range, min(day) AS start_date, greatest(max(day), max(through)) AS end_date, 'Fair ' || listing_id AS title, 'Barn & yard ' || listing_id AS venue FROM s GROUP BY listing_id"""
)
def listing_sightings(spark, sf_dir):
    """Day pages of a calendar, each with 50 cells, folded to one row per listing."""
    docs = _docs(spark, sf_dir).withColumn("id", F.col("k") % 60)
    item = F.concat(F.format_string('<a class="big event" href="/event/%d"><h3>Fair <i>%d</i></h3><ul><li>Fri, Jan 5</li><li>Barn &amp; yard %d</li>', "id", "id", "id"), F.when(F.col("id") % 5 == 0, "<li>Through December 20</li>").otherwise(""), F.lit("</ul></a>"))
    pages = _bodies(docs, item, F.lit("<div>{}</div>"), "\n").select(F.expr("date_add(date'2024-01-01', cast(source_id % 200 as int))").alias("day"), "body")
    found = feeds.collapse_sightings(feeds.day_page_items(pages))
    return found.select("listing_id", F.size("dates").cast("long").alias("n_days"), "is_range", "start_date", "end_date", "title", "venue")
