"""Queries against their SQL on rows that the smallest tables don't hold."""

import random
import time
from datetime import date, timedelta

import duckdb
from pyspark.sql import functions as F

from tidepool.functions import similarity as S
from tidepool.functions import text as T
from tidepool.operators import ingest, matching
from tidepool.plans.queries import ORACLE_SQL, QUERIES


def equals_sql(spark, folder, name):
    """The rows of a query over the Parquet files of a folder; the same as those of its SQL."""
    got = QUERIES[name](spark, str(folder))
    con = duckdb.connect()
    for f in folder.iterdir():
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}/*.parquet'").fetchall()
    columns = ", ".join(got.columns)
    want = con.execute(f"SELECT {columns} FROM ({ORACLE_SQL[name]})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    return rows


def cut_pages(spark, folder):
    """Pages of one source whose texts were cut within a reference, each so long that it is a request of its own."""
    body = lambda i: f"<p>{'word ' * (1250 + i)}&amp;&amp;&am</p><p>x &amp &copy; &ampy &#38; &#3 &</p>"
    spark.createDataFrame([(i, f"https://a.example.org/{i}", body(i)) for i in range(12)], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")


def test_page_text_of_cut_pages(spark, tmp_path):
    cut_pages(spark, tmp_path)
    assert len(equals_sql(spark, tmp_path, "page_text")) == 12
    row = spark.createDataFrame([("<i>&amp;amp &amp &copy 1 &amp</i>",)], "t string").select(T.visible_text("t").alias("a"), T.visible_text("t", closed=True).alias("b")).first()
    assert (row.a, row.b) == ("&amp & © 1 &", "&amp &amp &copy 1 &amp")


def test_model_answers_of_cut_pages(spark, tmp_path):
    cut_pages(spark, tmp_path)
    assert {r[2] for r in equals_sql(spark, tmp_path, "model_answers")} == {"ok", "refused", "unavailable", "malformed"}


def test_model_events_of_cut_pages(spark, tmp_path):
    cut_pages(spark, tmp_path)
    assert equals_sql(spark, tmp_path, "model_events")


DAY = date(2026, 3, 1)
RUNS = "row_id long, title string, venue string, start_date date, end_date date"


def test_many_equal_rows(spark):
    """One title on one day, very often: 64 million pairs of rows, one of different runs."""
    rows = spark.range(8_000).select(F.col("id").alias("row_id"), F.lit("The Hot Ring").alias("title"), F.lit("Hall").alias("venue"), F.lit(DAY).alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    began = time.perf_counter()
    assert [tuple(r) for r in ingest.upload_duplicates(rows).groupBy("repeats").count().orderBy("repeats").collect()] == [(None, 1), (0, 7_999)]
    found = ingest.calendar_duplicates(rows, rows.withColumn("listing_id", F.col("row_id") + 5).drop("row_id"))
    assert [tuple(r) for r in found.groupBy("duplicate_of").count().collect()] == [(5, 8_000)]
    assert time.perf_counter() - began < 90


def test_equal_and_alike_rows_in_order(spark):
    """Equal rows far apart, rows alike both, missing venues, titles and days, against one row after another."""
    choose = random.Random(4).choice
    titles = ["hot ring", "the hot ring", "hot rings", "red bolt", "2024", "", None, "blue nut of the north", "blue nut of north"]
    venues = [None, "", "brand 7", "brand 17", "opera house inc", "the opera house"]
    rows = [(i, choose(titles), choose(venues), choose([None, *(DAY + timedelta(k) for k in range(12))]), choose([None, *(DAY + timedelta(k) for k in range(12))])) for i in range(500)]
    keys = spark.createDataFrame([(x,) for x in {*titles, *venues}], "x string").select("x", T.norm_title("x"), T.norm_venue("x")).collect()
    title, venue = {r[0]: r[1] for r in keys}, {r[0]: r[2] for r in keys}

    def likeness(a, b):
        """The score of two rows, and whether it is enough; None on different days."""
        if a[3] is None or b[3] is None or a[3] > max(b[3], b[4] or b[3]) or b[3] > max(a[3], a[4] or a[3]):
            return None
        t, known = S.token_set(title[a[1]], title[b[1]]), bool(venue[a[2]] and venue[b[2]])
        score = S.TITLE_SHARE * t + (1 - S.TITLE_SHARE) * S.token_set(venue[a[2]], venue[b[2]]) if known else t
        return score, score >= (matching.SAME if known else matching.SAME_BY_TITLE)

    accepted, want = [], {}
    for row in rows:
        met = [(*x, -r[0]) for r in accepted if (x := likeness(row, r))]
        alike = [(score, at) for score, enough, at in met if enough]
        want[row[0]] = -max(alike)[1] if alike else None
        if not alike:
            accepted.append(row)
    df = spark.createDataFrame(rows, RUNS)
    assert {r.row_id: r.repeats for r in ingest.upload_duplicates(df).collect()} == want
    assert len(accepted) > 50 and sum(v is not None for v in want.values()) > 50
    listings = rows[250:] + [(-7, *rows[300][1:])]
    listed = {}
    for row in rows[:250]:
        met = [(x[0], -r[0], x[1]) for r in listings if (x := likeness(row, r))]
        listed[row[0]] = -max(met)[1] if met and max(met)[2] else None
    calendar = spark.createDataFrame(listings, RUNS).withColumnRenamed("row_id", "listing_id")
    assert {r.row_id: r.duplicate_of for r in ingest.calendar_duplicates(df.filter("row_id < 250"), calendar).collect()} == listed
