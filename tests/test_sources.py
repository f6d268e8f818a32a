"""Readers of feeds on small literal bodies, the registry, page cache, writers, streams."""

import json
import zipfile
from datetime import date, datetime
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from tidepool.operators import productions
from tidepool.sources import feeds, registry, sinks
from tidepool.streaming import events as streaming


def pages(spark, *bodies):
    return spark.createDataFrame([(i, "https://site.org/cal/page", b) for i, b in enumerate(bodies)], "source_id long, url string, body string")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_rest_calendar(spark):
    body = {"events": [
        {"title": "A", "description": "d" * 3000, "start_date": "2026-09-05 19:30:00", "all_day": False, "url": "u", "cost": "$5", "venue": {"venue": "Hall", "address": "1 St", "city": "Dover", "phone": "302-555-1234"}, "organizer": [{"organizer": "Org"}], "categories": [{"name": "Music"}, {"name": "Art"}]},
        {"title": "B", "start_date": "2026-09-06", "venue": [{"venue": "Other"}], "organizer": "Plain"}, {"title": "C", "venue": [], "organizer": []},
    ], "total_pages": 1}
    got = rows(feeds.rest_calendar(pages(spark, json.dumps(body), "not json", None, "{}")))
    assert [(r["title"], r["venue_name"], r["presenter"]) for r in got] == [("A", "Hall", "Org"), ("B", "Other", "Plain"), ("C", None, None)]
    assert got[0]["source_categories"] == ["Music", "Art"] and got[0]["venue_city"] == "Dover" and len(got[0]["description"]) == 2000
    assert [r["status"] for r in feeds.status(pages(spark, "{}", "{bad", None)).orderBy("source_id").collect()] == ["ok", "unreadable", "unreachable"]


def test_library_and_site_builder(spark):
    lib = {"results": [{"title": "L", "startdt": "2026-09-05 10:00:00", "campus": "", "calendar": "Main", "registration_cost": "", "cost": "5", "categories_arr": [{"name": "Arts"}], "audiences": [{"name": "Adults"}]}]}
    r = rows(feeds.library_calendar(pages(spark, json.dumps(lib))))[0]
    assert (r["start"], r["venue_name"], r["cost_text"], r["source_categories"]) == ("2026-09-05T10:00:00", "Main", "5", ["Arts", "Adults"])
    site = {"items": [{"title": "S", "body": "<p>Hi &amp; bye</p>", "startDate": 1788654600000, "location": {"addressLine1": "1 St", "addressLine2": ""}, "fullUrl": "/e/1", "categories": ["x"]}]}
    r = rows(feeds.site_builder(pages(spark, json.dumps(site))))[0]
    assert (r["description"], r["start"], r["venue_address"], r["url"]) == ("Hi & bye", "2026-09-05T20:30", "1 St", "https://site.org/e/1")


def test_icalendar(spark):
    body = "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nSUMMARY:Long\r\n  title\\, yes\r\nDTSTART:20260906T003000Z\r\nLOCATION:Hall\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nSUMMARY:All day\r\nDTSTART;VALUE=DATE:20260905\r\nDTEND;VALUE=DATE:20260907\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nSUMMARY:Gone\r\nSTATUS:CANCELLED\r\nDTSTART:20260905\r\nEND:VEVENT\r\nEND:VCALENDAR"
    got = rows(feeds.icalendar(pages(spark, body)))
    assert [(r["title"], r["start"], r["end"], r["all_day"]) for r in got] == [("Long title, yes", "2026-09-05T20:30", None, False), ("All day", "2026-09-05", "2026-09-06", True)]


def test_rss_posts_and_sitemaps(spark):
    rss = "<rss><channel>" + "".join(f"<item><title><![CDATA[T{i}]]></title><link>http://x/{i}</link><description>&lt;p&gt;S{i}&lt;/p&gt;</description></item>" for i in range(30)) + "</channel></rss>"
    got = rows(feeds.rss_entries(pages(spark, rss)))
    assert len(got) == 25 and got[3]["title"] == "T3" and got[3]["link"] == "http://x/3"
    atom = '<feed><entry><title>A</title><link href="http://y"/><summary>s</summary></entry></feed>'
    assert rows(feeds.rss_entries(pages(spark, atom)))[0]["link"] == "http://y"
    posts = [{"title": {"rendered": "P"}, "content": {"rendered": "short"}, "link": "http://p"}, {"title": {"rendered": "Q"}, "content": {"rendered": "On September 5 we meet at the old hall for a long evening."}, "link": "http://q"}]
    details = spark.createDataFrame([("http://p", "<p>Full page text</p>")], "url string, body string")
    assert {r["title"]: r["content"] for r in rows(feeds.wp_posts(pages(spark, json.dumps(posts)), details))}["P"] == "Full page text"
    sitemap = "<urlset>" + "".join(f"<url><loc>http://x/{i}</loc><lastmod>2026-01-{i:02d}</lastmod></url>" for i in range(1, 12)) + "</urlset>"
    assert [r["loc"] for r in feeds.sitemap_locs(pages(spark, sitemap), newest=2).orderBy("loc").collect()] == ["http://x/10", "http://x/11"]
    assert feeds.sitemap_locs(pages(spark, "broken <loc>http://z</loc>")).count() == 1


def test_json_ld(spark):
    def script(x):
        return f'<script type="application/ld+json">{json.dumps(x)}</script>'

    e = {"@type": "Event", "name": "E", "startDate": "2026-09-05", "location": {"name": "Hall", "address": {"streetAddress": "1 St", "addressLocality": "Dover"}}, "offers": [{"url": "t", "price": "5"}], "organizer": {"name": "O"}}
    body = script(e) + script([{**e, "name": "F", "@type": ["MusicEvent"], "location": "Plain"}]) + script({"@graph": [{**e, "name": "G"}, {"@type": "Person", "name": "X"}]}) + script({**e, "eventStatus": "https://schema.org/EventCancelled"}) + "<script type='application/ld+json'>{bad</script>"
    got = {r["title"]: r for r in rows(feeds.json_ld(pages(spark, body)))}
    assert set(got) == {"E", "F", "G"} and got["E"]["venue_city"] == "Dover" and got["F"]["venue_name"] == "Plain" and got["G"]["cost_text"] == "5" and got["E"]["presenter"] == "O"
    routed = feeds.read_by_route(pages(spark, body), spark.createDataFrame([(0, "jsonld")], "source_id long, route string"))
    assert routed.count() == 3 and routed.columns == feeds.EVENT


def test_directory_and_days(spark):
    body = '<a href="/organization/3/delart">Delaware <b>Art</b> Museum</a><a href="/organization/3/x">Again</a><a href="/organization/27/grand"></a><a href="/organization/27/grand">Grand</a>'
    assert {r["entry_id"]: r["entry_name"] for r in feeds.directory_entries(pages(spark, body)).collect()} == {3: "Delaware Art Museum", 27: "Grand"}
    cell = '<a class="cell event" href="/event/{}/x"><h3>{}</h3><ul class="items">{}</ul></a>'
    day1 = cell.format(1, "Show", "<li>Hall</li><li>Sat, Sep 5</li>") + cell.format(2, "Exhibit", "<li>Museum</li><li>Through December 31</li>")
    days = spark.createDataFrame([(date(2026, 9, 5), day1), (date(2026, 9, 7), cell.format(1, "Show", "<li>Hall</li>"))], "day date, body string")
    got = {r["listing_id"]: r for r in feeds.collapse_sightings(feeds.day_page_items(days)).collect()}
    assert got[1]["dates"] == [date(2026, 9, 5), date(2026, 9, 7)] and not got[1]["is_range"] and got[1]["venue"] == "Hall"
    assert got[2]["is_range"] and got[2]["end_date"] == date(2026, 12, 31)
    links = feeds.page_links(pages(spark, '<a href="/a#x">1</a><a href="https://site.org/a">2</a><a href="https://other.org/">3</a><a href="b.html">4</a><a href="mailto:x@y">5</a>').select("url", "body"))
    assert {r["link"] for r in links.collect()} == {"https://site.org/a", "https://site.org/cal/b.html"}


def test_registry(spark, tmp_path):
    lines = ["﻿Organization Name,Organization URL,Site Map,Events", "First,first.org,NKS,a.org; b.org", ",x,,", "Last One,last.org,http://m,", "Third,third.org,,c.org", "Delaware Libraries,lib.org,,", "After,after.org,,", "First,first2.org,,d.org"]
    (tmp_path / "r.csv").write_text("\n".join(lines), encoding="utf-8")
    tiers = registry.with_tiers(registry.read_registry(spark, str(tmp_path / "r.csv")), "Last One", "delaware libraries")
    got = {r["name"]: r for r in registry.sources(tiers).collect()}
    assert {k: v["tier"] for k, v in got.items()} == {"First": 1, "Last One": 1, "Third": 2, "Delaware Libraries": 3, "After": 4}
    assert got["First"]["home_url"] == "https://first2.org" and got["First"]["events_url"] == "https://d.org" and got["Last One"]["sitemap_url"] == "http://m" and got["First"]["sitemap_url"] is None
    (tmp_path / "sites.txt").write_text("# c\nhttps://www.a.org/x\nb.org\n\n")
    assert {r["site"] for r in registry.read_lines(spark, str(tmp_path / "sites.txt")).collect()} == {"a.org", "b.org"}
    urls = spark.range(1).select(registry.page_urls(F.lit(None).cast("string"), F.lit("e"), F.lit("h"), F.array(F.lit("e"), F.lit("x"))).alias("u")).first()["u"]
    assert urls == ["e", "h", "x"]


def test_pages(spark):
    now = F.lit("2026-01-02 00:00:00").cast("timestamp")
    at = lambda h: datetime(2026, 1, 1, h)
    cache = spark.createDataFrame([("a", at(20), 200, b"1"), ("a", at(22), 200, b"2"), ("b", at(1), 200, b"3"), ("c", at(23), 500, b"4")], "url string, fetched_at timestamp, status int, content binary")
    assert {r["url"]: bytes(r["content"]) for r in registry.fresh_pages(cache, now, F.lit(6)).collect()} == {"a": b"2"}
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "url string")
    assert {r["url"] for r in registry.to_fetch(wanted, cache, now, F.lit(6)).collect()} == {"b", "c", "d"}
    assert registry.store_pages(cache, cache).count() == 2

    def get(url):
        if "bad" in url:
            raise OSError("no route")
        return 200, url.encode()

    urls = spark.createDataFrame([("https://x.org/a",), ("https://bad.org/b",)], "url string")
    assert {r["url"]: r["status"] for r in registry.fetch(urls, get).collect()} == {"https://x.org/a": 200, "https://bad.org/b": 0}
    robots = spark.createDataFrame([("x.org", "User-agent: *\nDisallow: /private")], "host string, body string")
    asked = spark.createDataFrame([("https://x.org/private/1",), ("https://x.org/open",), ("https://y.org/private",)], "url string")
    assert {r["url"]: r["allowed"] for r in registry.robots_allowed(asked, robots, "bot").collect()} == {"https://x.org/private/1": False, "https://x.org/open": True, "https://y.org/private": True}


def test_writers(spark, tmp_path):
    counters = lambda stage, v: spark.createDataFrame([(stage, "k", v)], "stage string, key string, value long")
    path = str(tmp_path / "stats")
    for stage, v in (("a", 1), ("b", 2), ("a", 3)):
        sinks.save_counters(counters(stage, v), path)
    assert {r["stage"]: r["value"] for r in spark.read.parquet(path).collect()} == {"a": 3, "b": 2}
    data = [(date(2026, 1, 1), 1, 1, *("<x>" if h == "title of program" else None for h in productions.HEADERS))]
    df = spark.createDataFrame(data, "production_start date, production long, position int, " + ", ".join(f"`{h}` string" for h in productions.HEADERS))
    book = zipfile.ZipFile(BytesIO(sinks.workbook(df)))
    assert "&lt;x&gt;" in book.read("xl/worksheets/sheet1.xml").decode()
    sinks.write_rows_csv(df, str(tmp_path / "rows"))
    back = spark.read.option("header", True).csv(str(tmp_path / "rows"))
    assert sinks.read_workbook_rows(back).count() == 1
    with pytest.raises(ValueError):
        sinks.read_workbook_rows(back.drop("URL"))
    sections = spark.createDataFrame([("flagged", 1, "<b>", "d")], "section string, event_id long, title string, detail string")
    assert "&lt;b&gt;" in sinks.report_html(sections)


def test_streams(spark, sf_dir, tmp_path):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i in range(3):
        table.filter(f"event_id % 3 = {i}").write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    streaming.keep_latest(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["user_id"], ["ts", "event_id"]).awaitTermination()
    last = max((p for p in (tmp_path / "out").iterdir() if p.name.startswith("v=")), key=lambda p: int(p.name[2:]))
    from tidepool.operators.merge import latest_wins

    key = lambda df: {r["user_id"]: r["event_id"] for r in df.collect()}
    assert key(spark.read.parquet(str(last))) == key(latest_wins(table, ["user_id"], ["ts", "event_id"]))
    assert streaming.hourly_counts(table).agg(F.sum("n")).first()[0] == table.count()


def test_snapshot(spark):
    from tidepool.sources import listings

    df = spark.createDataFrame([("A", None, "2026-01-01", ""), ("B", "Hall", "01/02/2026", "2026-01-05"), (" ", "x", "", "")], "title string, venue string, start string, end string")
    rows_ = listings.read_snapshot(df).orderBy("title").collect()
    assert [(r["title"], r["venue"], r["start_date"]) for r in rows_] == [("A", "", date(2026, 1, 1)), ("B", "Hall", date(2026, 1, 2))]
    with pytest.raises(ValueError):
        listings.read_snapshot(df.drop("end"))
    day = date(2026, 1, 1)
    numbered = spark.createDataFrame([(1, "Hamlet", "Hall", day, None), (2, "Hamlet!", "The Hall", day, None), (3, "Othello", "Hall", day, None)], "row_id long, title string, venue string, start_date date, end_date date")
    assert {r["row_id"] for r in listings.fold_snapshot(numbered).collect()} == {1, 3}
    sighted = spark.createDataFrame([(7, "A", None, day), (8, "New", None, day)], "listing_id long, title string, venue string, start_date date")
    assert {r["title"]: r["origin"] for r in listings.with_sightings(listings.read_snapshot(df), sighted).collect()} == {"A": "snapshot", "B": "snapshot", "New": "sighted"}


def test_probes_and_fallback(spark):
    from tidepool.operators.discovery import best_route

    p = pages(spark, '{"events": []}', "BEGIN:VEVENT", '<html><script>{"@type": "Event"}</script>', "nothing", None)
    assert {r["source_id"]: r["route"] for r in best_route(feeds.probes(p)).collect()} == {0: "tribe", 1: "ics", 2: "jsonld", 3: "none", 4: "none"}
    found = spark.createDataFrame([(0,), (1,)], "source_id long")
    assert {r["source_id"] for r in feeds.page_fallback(found, p).collect()} == {2, 3}
