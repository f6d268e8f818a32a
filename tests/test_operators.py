"""Operators without SQL to compare with: scores, greedy clusters, resolution, exports, uploads, policy, pipeline."""

import random
from datetime import date
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.functions import dates as D
from tidepool.functions import similarity as S
from tidepool.functions import text as T
from tidepool.operators import chains, discovery, ingest, matching, merge, policy, productions
from tidepool.plans import pipeline
from tidepool.sources.feeds import EVENT

WORDS = st.text(alphabet="abcd é", max_size=14)


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[-1], row[j + 1], row[j] + (x == y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_scores(a, b):
    assert S.lcs_length(a, b) == plain_lcs(a, b)
    for f in (S.ratio, S.token_sort, S.token_set, S.partial):
        assert 0 <= f(a, b) <= 100 and f(a, b) == pytest.approx(f(b, a))
    assert S.ratio(a, a) == 100
    assert S.token_set(a, b) == pytest.approx(plain_token_set(a, b))


def plain_token_set(a, b):
    """Shared words first, then each side's own, all sorted."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    text = lambda *sets: " ".join(w for s in sets for w in sorted(s))
    likeness = lambda p, q: 200 * plain_lcs(p, q) / (len(p) + len(q))
    both = x & y
    if both and (x <= y or y <= x):
        return 100.0
    found = [likeness(text(both, x - y), text(both, y - x))]
    return max(found + [likeness(text(both), text(both, own - both)) for own in (x, y)] if both else found)


def test_scores_of_words_that_move():
    """A repeated word counts in the sorted score only, and shared words move to the front of the set's."""
    assert S.token_set("c dbc", "ac b c") == pytest.approx(600 / 11) and S.token_sort("c dbc", "ac b c") == pytest.approx(800 / 11)
    assert S.token_set("aaaa", "aa aa") == pytest.approx(200 / 3) and S.token_sort("aaaa", "aa aa") == pytest.approx(800 / 9)


def test_venues_and_titles(spark):
    names = {"Bootless Stageworks, Inc.": "bootless stageworks", "The Theatre": "theatre", "Lincoln Theatre": "lincoln theatre", None: ""}
    for name, want in names.items():
        assert one(spark, T.norm_venue("n"), n=name) == want
    same = [T.content_hash(F.lit(1), F.lit(t), F.lit("2026-01-01"), F.lit(c), F.lit(None).cast("string")) for t, c in (("3rd Grade Art Show", "14:00"), ("4th Grade Art Show", "14:00"), ("3rd Grade Art Show", "19:30"))]
    assert len({one(spark, h) for h in same}) == 3


def test_formats(spark):
    assert one(spark, T.clean_url("u"), u="example.org/x") == "https://example.org/x"
    assert one(spark, T.clean_url("u"), u="TBA") is None
    for clock, want in (("19:30", "7:30 p.m."), ("09:00", "9:00 a.m."), ("12:15", "12:15 p.m."), ("00:30", "12:30 a.m.")):
        assert one(spark, D.fmt_time("c"), c=clock) == want and one(spark, D.coerce_time("c"), c=want) == clock
    for text, want in (("7pm", "19:00"), ("7:30 PM", "19:30"), ("2026-09-05 19:30", "19:30"), ("noon", None), ("25:00", "25:00"), ("13 pm", None)):
        assert one(spark, D.coerce_time("c"), c=text) == want
    capped = one(spark, T.words_cap("t"), t="word " * 300)
    assert capped.endswith("…") and len(capped.split()) == 200
    assert one(spark, T.words_cap("t"), t=" ") is None
    assert one(spark, T.clean_text("t"), t="A&nbsp;&amp; <b>B</b>\n [&hellip;] \\n x") == "A & B … x"
    assert one(spark, T.price_label(F.lit(10), F.lit(20), F.lit(0))) == "$10–$20" and one(spark, T.price_label(F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1))) == "FREE"
    day = F.lit("2026-09-05").cast("date")
    assert one(spark, D.parse_through("t", day), t="Through June 5") == date(2027, 6, 5) and one(spark, D.parse_through("t", day), t="through Sunday, Sep 6") == date(2026, 9, 6)
    assert one(spark, D.in_horizon("s", "e", day), s="2026-08-01", e="2026-09-04") and not one(spark, D.in_horizon("s", "e", day), s="2026-08-01", e="2026-09-03")
    assert one(spark, D.in_horizon("s", "e", day), s="soon", e=None)


def test_overlaps(spark):
    r = random.Random(1)
    run = lambda i: (i, date.fromordinal(738000 + r.randint(0, 200)), r.choice((None, 0, 3, 40, 400)))
    rows = [[(i, s, None if n is None else date.fromordinal(s.toordinal() + n - 1)) for i, s, n in (run(i) for i in range(60))] for _ in range(2)]
    a = spark.createDataFrame(rows[0], "a int, l_start date, l_end date")
    b = spark.createDataFrame(rows[1], "b int, r_start date, r_end date")
    last = lambda s, e: max(e or s, s).toordinal()
    for pad in (0, 1):
        want = {(i, j) for i, s, e in rows[0] for j, u, v in rows[1] if s.toordinal() - pad <= last(u, v) and u.toordinal() <= last(s, e) + pad}
        got = [tuple(x) for x in matching.overlap_join(a, b, pad_days=pad).select("a", "b").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_listing_days(spark):
    days = F.array(*(F.lit(d).cast("date") for d in ("2026-06-05", "2026-06-12", "2026-08-28")))
    hit = lambda day, d, is_range: one(spark, matching.dates_match(F.lit(day).cast("date"), F.lit(None).cast("date"), F.lit("2026-06-01").cast("date"), F.lit("2026-12-31").cast("date"), d, F.lit(is_range)))
    assert hit("2026-06-12", days, False) and not hit("2026-07-15", days, False) and hit("2026-09-01", days, True)
    assert hit("2026-09-01", F.array().cast("array<date>"), False)


def test_greedy_clusters(spark):
    r = random.Random(3)
    rows = [(i, f"Show {r.randint(1, 4)}", r.choice(("Grand Opera House", "The Grand Opera", "Opera House Grand, Inc.", "City Hall", "Hall of the City", None)), date(2026, 1, r.randint(1, 2))) for i in range(120)]
    got = {x["event_id"]: x["cluster_id"] for x in matching.cluster_greedily(spark.createDataFrame(rows, "event_id long, title string, venue string, start_date date")).collect()}
    norm = {v: one(spark, T.norm_venue("v"), v=v) for v in {x[2] for x in rows}}
    want = {}
    for _, group in groupby(sorted(rows, key=lambda x: (x[1], x[3], x[0])), key=lambda x: (x[1], x[3])):
        heads = []
        for i, _, venue, _ in group:
            v = norm[venue]
            head = next((h for h, w in heads if v and w and S.token_set(v, w) >= 75), None)
            if head is None:
                heads.append((i, v))
            want[i] = i if head is None else head
    assert got == want


def test_greedy_clusters_of_one_title_on_one_day(spark):
    """More heads than a round takes, all of one title and day, with and without a day."""
    r = random.Random(5)
    venues = ["".join(r.choice("abcdefghijkl") for _ in range(7)) + " " + "".join(r.choice("mnopqrstuvwx") for _ in range(7)) for _ in range(150)]
    venues += [v[:-1] for v in venues[::3]] + [f"{v} {v[:2]}" for v in venues[::4]]
    rows = [(i, "Show", v, None if i % 2 else date(2026, 1, 1)) for i, v in enumerate(r.sample(venues, len(venues)))]
    got = {x["event_id"]: x["cluster_id"] for x in matching.cluster_greedily(spark.createDataFrame(rows, "event_id long, title string, venue string, start_date date")).collect()}
    want, heads = {}, {0: [], 1: []}
    for i, _, v, _ in rows:
        want[i] = next((h for h, w in heads[i % 2] if S.token_set(v, w) >= 75), i)
        if want[i] == i:
            heads[i % 2].append((i, v))
    assert len(heads[0]) > matching.HEADS_AT_ONCE and got == want
    assert matching.cluster_greedily(spark.createDataFrame([(1, "a", None, None)], "event_id long, title string, venue string, start_date date")).collect()[0]["cluster_id"] == 1


def test_refused_in_order(spark):
    r = random.Random(9)
    for links in ([(i + 1, i) for i in range(12)], [tuple(sorted((r.randrange(60), r.randrange(60)), reverse=True)) for _ in range(150)], []):
        links = [x for x in links if x[0] != x[1]]
        refused = set()
        for node in sorted({n for x in links for n in x}):
            if any(a == node and b not in refused for a, b in links):
                refused.add(node)
        got = chains.refused_in_order(spark.createDataFrame(links, "later long, earlier long"))
        assert sorted(x["node"] for x in got.collect()) == sorted(refused)


def test_best_match_ties_and_thresholds(spark):
    pairs = [(1, 9, 90.0, True), (1, 3, 90.0, True), (2, 3, 90.0, False), (3, 3, 96.0, False), (4, 3, 72.0, True), (5, 3, 71.9, True), (6, 3, 0.0, True)]
    events = spark.createDataFrame([(i,) for i in range(1, 8)], "event_id long")
    got = {r["event_id"]: (r["listing_id"], r["verdict"]) for r in matching.best_match(events, spark.createDataFrame(pairs, "event_id long, listing_id long, score double, used_venue boolean")).collect()}
    assert got == {1: (3, "same"), 2: (3, "unsure"), 3: (3, "same"), 4: (3, "unsure"), 5: (3, "new"), 6: (None, "new"), 7: (None, "new")}
    scored = matching.scored(spark.createDataFrame([("Hamlet", None, "Hamlet", "Somewhere Else"), ("Hamlet", "Grand Opera House", "Hamlet", "Grand Opera House")], "title_a string, venue_a string, title_b string, venue_b string")).collect()
    assert [(r["used_venue"], r["score"]) for r in scored] == [(False, 100.0), (True, 100.0)]


def test_directory(spark):
    entries = [(3, "Delaware Art Museum"), (27, "The Grand Opera House"), (5, "Mt. Cuba Center"), (6, "Mt.Cuba Center"), (9, "Newark Arts Alliance")]
    names = ["Grand Opera House", "grand opera house, inc.", "Newark", "Mt Cuba Center", "Delaware Art Musuem", "", None, "zzz"]
    got = {r["name"]: (r["entry_id"], round(r["confidence"])) for r in matching.resolve_names(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(entries, "entry_id long, entry_name string")).collect()}
    assert got["Grand Opera House"] == (27, 100) and got["grand opera house, inc."] == (27, 100)
    assert got["Newark"][0] is None and got["Mt Cuba Center"] == (5, 84)
    assert got["Delaware Art Musuem"][0] == 3 and got[""] == (None, 0) and got[None] == (None, 0) and got["zzz"][0] is None


def test_gap_of_thirty_days(spark):
    rows = [(1, date(2026, 1, 1)), (2, date(2026, 1, 31)), (3, date(2026, 3, 3)), (4, date(2026, 3, 3))]
    df = spark.createDataFrame([(i, "k", d) for i, d in rows], "i long, k string, s date")
    assert [r["run"] for r in productions.gap_runs(df, ["k"], "s", None, ["s", "i"]).orderBy("i").collect()] == [0, 0, 1, 1]


def test_merge_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", "in", "h1", 0, 0)], "event_id long, v string, relevance string, content_hash string, first_seen int, last_seen int")
    batch = spark.createDataFrame([(7, "b", "in", "h1", 1), (8, "c", "in", "h2", 2), (9, "d", "out", "h3", 3), (10, "e", "in", "h3", 2)], "event_id long, v string, relevance string, content_hash string, n int")
    once = merge.merge_events(old, batch, F.lit(5), order=["n"])
    rows = sorted(map(tuple, once.collect()))
    assert rows == [(1, "b", "in", "h1", 0, 5), (8, "c", "in", "h2", 5, 5)]
    assert sorted(map(tuple, merge.merge_events(once, batch, F.lit(5), order=["n"]).collect())) == rows
    tiers = spark.createDataFrame([("x", 1, "u1", 1), ("x", 2, "u2", 5)], "name string, tier int, url string, ordinal int")
    assert tuple(merge.upsert_tiers(tiers, "name", "ordinal", ["tier"]).select("name", "tier", "url").first()) == ("x", 1, "u2")
    assert merge.with_columns_of(old, {"z": "date", "v": "string"}).columns[-1] == "z"


def test_char_batches(spark):
    r = random.Random(4)
    rows = [(k, i, "x" * r.randint(0, 900)) for k in (1, 2, None) for i in range(30)]
    rows += [(5, i, "x" * r.choice((0, 0, 1, 999, 1000, 1001, 5000, 2))) for i in range(150)] + [(6, i, r.choice((None, ""))) for i in range(5)] + [(7, 0, "x" * 3000)]
    rows += [(8, i, "x" * n) for i, n in enumerate((0, 0, 4000, 0, 0, 500, 500, 1))]
    got = {(x["k"], x["i"]): x["batch"] for x in discovery.char_batches(spark.createDataFrame(rows, "k int, i int, t string").repartition(3), ["k"], ["i"], "t", 1000).collect()}
    assert len(got) == len(rows)
    for k in {x[0] for x in rows}:
        used = batch = 0
        for key, i, text in rows:
            if key == k:
                n = len(text or "")
                if used and used + n > 1000:
                    used, batch = 0, batch + 1
                used += n
                assert got[(k, i)] == batch, (k, i)
    assert discovery.char_batches(spark.createDataFrame([], "k int, i int, t string"), ["k"], ["i"], "t").count() == 0


def test_discovery(spark):
    rows = [("Delaware Art Museum", "https://www.delart.org/x"), ("Delaware Art Museum", "https://facebook.com/delart"), ("Delaware Art Museum", None)]
    got = [r["host_score"] for r in discovery.host_score(spark.createDataFrame(rows, "name string, url string")).collect()]
    assert got[0] > 50 and got[1] == 0 and got[2] == 0
    page = "The Grand Opera House, Wilmington. Call (302) 555-1234."
    assert one(spark, discovery.page_confirms(F.lit("Grand Opera House"), F.lit(page))) and not one(spark, discovery.page_confirms(F.lit("Grand Opera House"), F.lit("Grand Opera House in Ohio")))
    cands = spark.createDataFrame([("n", f"https://h{i}.org", i % 2 == 0, True, float(i)) for i in range(8)], "name string, url string, confirmed boolean, reachable boolean, host_score double")
    assert [r["url"] for r in discovery.rank_candidates(cands).orderBy("rank").collect()] == [f"https://h{i}.org" for i in (6, 4, 2, 0, 7)]


def test_groups(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r["node"]: r["component"] for r in chains.groups(links).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_policy(spark):
    schema = "id long, title string, description string, venue_name string, venue_address string, venue_city string, presenter string, source_categories array<string>, tier int, screened boolean, route string"
    blank = dict.fromkeys(("description", "venue_name", "venue_address", "venue_city", "presenter", "source_categories", "tier", "screened", "route"))
    cases = [
        ({"title": "Jazz Night", "venue_city": "Philadelphia, PA", "tier": 1}, "out", []),
        ({"title": "Story Time: Plant a Story", "source_categories": ["Arts and Crafts"], "route": "libcal"}, "out", []),
        ({"title": "Adult Craft Bag", "source_categories": ["Arts and Crafts"], "route": "libcal"}, "in", [11]),
        ({"title": "Coding Hour", "source_categories": ["STREAM"], "route": "libcal"}, "out", []),
        ({"title": "An Evening", "description": "jazz", "tier": 1}, "in", [17]),
        ({"title": "An Evening", "tier": 2}, "in", []),
        ({"title": "Jazz Picnic", "tier": 1, "screened": True}, "in", [17]),
        ({"title": "Dinner", "description": "a performance", "tier": 4}, "review", []),
        ({"title": "Passport help", "tier": 4}, "out", []),
    ]
    rows = [(i, *(({**blank, **c})[k] for k in ("title", *blank))) for i, (c, _, _) in enumerate(cases)]
    out = policy.relevance(spark.createDataFrame(rows, schema))
    got = {r["id"]: (r["relevance"], r["category_ids"]) for r in out.collect()}
    assert got == {i: (rel, cats) for i, (_, rel, cats) in enumerate(cases)}
    counts = {r["key"]: r["value"] for r in policy.tally(out).collect()}
    assert counts["rows"] == len(cases) and counts["in_scope"] + counts["out_of_scope"] + counts["review"] == len(cases)

    def model(frames):
        for f in frames:
            yield f.assign(relevance="in", reason="model")

    asked = policy.apply_model(out, model, order=["id"], budget=2).filter("reason = 'model'")
    assert {r["id"] for r in asked.collect()} == {5, 7}
    assert policy.apply_model(out, None, order=["id"]).count() == len(cases)


def test_uploads(spark):
    row = lambda line, **c: ("u", line, *(({h: None for h in productions.HEADERS} | {k.replace("_", " "): v for k, v in c.items()})[h] for h in productions.HEADERS))
    rows = [
        row(2, title_of_program="Hamlet", start_date="2026-09-05", start_time="7:30 PM", low_price="10.0", end_date="09/06/2026"),
        row(3, start_date="09/12/2026", start_time="19:30"),
        row(4, title_of_program="Broken", start_date="someday"),
        row(5, start_date="09/13/2026"),
        row(6, start_time="noon"),
    ]
    got = {r["line"]: r for r in ingest.checked_rows(spark.createDataFrame(rows, "upload_id string, line long, " + ", ".join(f"`{h}` string" for h in productions.HEADERS))).collect()}
    assert got[2]["problems"] == [] and got[2]["low price"] == "10" and got[2]["start time"] == "7:30 p.m."
    assert got[3]["title of program"] == "Hamlet" and got[3]["end date"] is None and got[3]["problems"] == [] and not got[3]["is_orphan"]
    assert got[4]["problems"] and got[5]["is_orphan"] and "missing title" in got[6]["problems"]

    day = date(2026, 9, 5)
    listed = spark.createDataFrame([(70, "Hamlet", "Grand Opera House", day, None)], "listing_id long, title string, venue string, start_date date, end_date date")
    asked = spark.createDataFrame([(1, "Hamlet!", "The Grand Opera House", day, None), (2, "Hamlet", "Elsewhere Hall", day, None), (3, "Hamlet", "Grand Opera House", date(2026, 9, 6), None)], "row_id long, title string, venue string, start_date date, end_date date")
    assert {r["row_id"]: r["duplicate_of"] for r in ingest.calendar_duplicates(asked, listed).collect()} == {1: 70, 2: None, 3: None}
    own = spark.createDataFrame([(i, t, "Hall", day, None) for i, t in enumerate(("Hamlet", "Hamlet", "hamlet!", "Othello"))], "row_id long, title string, venue string, start_date date, end_date date")
    assert {r["row_id"]: r["repeats"] for r in ingest.upload_duplicates(own).collect()} == {0: None, 1: 0, 2: 0, 3: None}


def raw_events(spark):
    base = dict.fromkeys(EVENT)
    rows = [
        {"source_id": 1, "title": "Hamlet", "description": "A play", "start": "2026-09-05 19:30", "venue_name": "Grand Opera House", "cost_text": "$10 - $20", "url": "a.org/1"},
        {"source_id": 1, "title": "Hamlet", "start": "2026-09-12 19:30", "venue_name": "Grand Opera House", "url": "a.org/1"},
        {"source_id": 2, "title": "Hamlet", "description": "A longer text of the play", "start": "2026-09-05", "venue_name": "The Grand Opera House, Inc."},
        {"source_id": 1, "title": "Jazz Concert", "start": "2026-09-07", "venue_city": "Philadelphia, PA"},
        {"source_id": 1, "title": "Choir Evening", "start": "2026-10-01", "cost_text": "free", "venue_name": "Hall"},
        {"source_id": 1, "title": None, "start": "2026-10-01"}, {"source_id": 9, "title": "Undated", "start": "soon"},
        {"source_id": 1, "title": "Choir Evening", "start": "2026-10-01", "description": "later row", "cost_text": "free", "venue_name": "Hall"},
        {"source_id": 1, "title": "Opera Gala", "start": "2026-01-01", "venue_name": "Hall"},
    ]
    schema = "raw_id long, " + ", ".join(f"{c} {dict(source_id='long', all_day='boolean', source_categories='array<string>').get(c, 'string')}" for c in EVENT)
    return spark.createDataFrame([(i, *({**base, **r}[c] for c in EVENT)) for i, r in enumerate(rows)], schema), len(rows)


def test_pipeline_end_to_end(spark):
    raw, n = raw_events(spark)
    sources = spark.createDataFrame([(1, "City Arts", 1, "tribe", False), (2, "Calendar", 4, "ics", False)], "source_id long, name string, tier int, route string, screened boolean")
    listings = spark.createDataFrame([(50, "Choir Evening", "Hall", date(2026, 10, 1), None, None, False)], "listing_id long, title string, venue string, start_date date, end_date date, dates array<date>, is_range boolean")
    directory = spark.createDataFrame([(27, "Grand Opera House")], "entry_id long, entry_name string")
    out = pipeline.run(raw, sources, listings, directory, F.lit("2026-06-01").cast("date"))
    events, rejected = out["events"].collect(), out["rejected"].collect()
    assert len(events) + len(rejected) == n  # every raw row ends in one place
    by = {e["raw_id"]: e for e in events}
    assert {0, 1, 2, 7, 8} == set(by)
    assert [by[i]["verdict"] for i in (0, 1, 2, 7)] == ["new", "new", "same", "same"] or [by[i]["verdict"] for i in (0, 1, 2, 7)] == ["same", "new", "new", "same"]
    assert by[7]["listing_id"] == 50 and by[7]["is_free"] == 1 and 5 in by[7]["category_ids"]
    rows = out["rows"].orderBy("production_start", "production", "position").collect()
    assert [r["continuation"] for r in rows] == [False, True] and rows[0]["venue ID"] == "27" and rows[0]["problems"] == []
    assert rows[1]["title of program"] is None and rows[1]["start date"] == "09/12/2026"


def test_rediscovery(spark):
    lost = spark.createDataFrame([("Delaware Art Museum", "https://old.org")], "name string, old_url string")
    urls = ["https://delawareartmuseum.org/x", "https://facebook.com/dam", "https://taken.org", "https://delawareart.net"]
    results = spark.createDataFrame([("Delaware Art Museum", u) for u in urls] + [("Delaware Art Museum", urls[0])], "name string, url string")
    page = b"The Museum of art, Wilmington. (302) 555-1234"
    pages = spark.createDataFrame([(urls[0], 200, page), (urls[2], 200, page), (urls[3], 500, b"")], "url string, status int, body binary")
    sources = spark.createDataFrame([("Other", "https://taken.org/a")], "name string, url string")
    got = {r["url"]: (r["confirmed"], r["rank"], r["apply"]) for r in discovery.rediscover(lost, results, pages, sources).collect()}
    assert got[urls[0]] == (True, 1, True) and urls[1] not in got and not got.get(urls[2], (False,))[0] and not got[urls[3]][0]


def test_model_answers(spark):
    schema = "id long, title string, relevance string, reason string, category_ids array<int>, wants_model boolean"
    df = spark.createDataFrame([(i, f"t{i}", "review", "hint", [], True) for i in range(4)], schema)

    def ask(row):
        if row["id"] == 1:
            raise OSError("down")
        return None if row["id"] == 2 else {"relevant": True, "reason": "yes", "category_ids": [9]}

    got = {r["id"]: (r["relevance"], r["category_ids"]) for r in policy.apply_model(df, policy.asking(ask), order=["id"], budget=3).collect()}
    assert got == {0: ("in", [9]), 1: ("review", []), 2: ("out", []), 3: ("review", [])}


def test_rejected_and_counts(spark):
    from tidepool.plans import summary

    raw, n = raw_events(spark)
    out = productions.rejected_by_place(raw).collect()
    assert [(r["title"], r["city"]) for r in out] == [("Jazz Concert", "Philadelphia, PA")]
    sources = spark.createDataFrame([("ok", "ics"), (None, None)], "status string, route string")
    events = spark.createDataFrame([("in", None), ("in", "new")], "relevance string, verdict string")
    counts = {(r["what"], r["key"]): r["n"] for r in summary.run_counts(sources, raw.withColumn("channel", F.lit("ics")), events).collect()}
    assert counts[("verdict", "(pending)")] == 1 and counts[("channel", "ics")] == n and counts[("total", "events")] == 2
    pulls = spark.createDataFrame([(1, "ok", 5), (2, "empty-kept", 2), (3, "error", 9)], "source_id long, status string, n long")
    assert summary.pull_summary(pulls).agg(F.sum("events")).first()[0] == 7


def test_representatives_of_clusters(spark):
    """In scope first, then the longest text, then day (null first) and id; null scopes and texts come last; every cluster has one."""
    from tidepool.plans.pipeline import find_repeats

    rows = [
        (1, "Hamlet", "Opera House", "2026-09-05", "out", "a long text about it"), (2, "Hamlet", "Opera House", "2026-09-05", "in", "short"), (3, "Hamlet", "Opera House", "2026-09-05", "in", "longer"),
        (4, "Hamlet", "Opera House", "2026-09-05", "in", "longer"), (5, "Hamlet", None, "2026-09-05", None, None), (6, "Faust", "Barn", None, None, None), (7, "Faust", "Barn", None, None, None),
    ]
    events = spark.createDataFrame(rows, "event_id long, title string, venue_name string, day string, relevance string, description string").selectExpr("*", "cast(day as date) start_date").drop("day")
    got = find_repeats(events).collect()
    assert len(got) == len(rows)
    assert {r["event_id"] for r in got if r["is_representative"]} == {3, 5, 6}


def test_every_reference_of_the_standard(spark):
    """Names with and without semicolon, numbers of all kinds, what only looks like one; each equal to the standard library's."""
    import html

    names = [f"a &{n} b" for n in T.NAMED] + [f"&{n}x9;" for n in T.LEGACY]
    codes = [0, 1, 9, 11, 12, 13, 38, 127, 128, 129, 150, 159, 160, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000, 10**9, 10**20]
    numbers = [f(c) for c in codes for f in ("&#{};".format, "&#{}x".format, "&#x{:x};".format, "&#X000{:X} ".format)]
    odd = ["", "&", "&&amp;amp;", "&#;", "&#x;", "&#xg", "& lt;", "&notit;", "&nope;", "&amp;lt;", "x&lt", "&" + "a" * 40 + ";", "line\n&gt;\n&"]
    texts = names + numbers + odd
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([*texts, None])], "i int, t string").select("i", T.unescape("t").alias("u")).collect()
    got = dict(map(tuple, rows))
    assert got.pop(len(texts)) is None
    assert {texts[i]: u for i, u in got.items()} == {x: html.unescape(x) for x in texts}
