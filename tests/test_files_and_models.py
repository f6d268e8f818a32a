"""Workbooks as a source and sink; events that a model reads out of pages."""

import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tidepool.operators import discovery, extraction
from tidepool.operators.productions import HEADERS
from tidepool.sources import sinks, workbooks

NAMES = ["title", "venue", "start", "end"]
NS = "http://schemas.openxmlformats.org"


def book(rows, shared=(), settings="", extra_sheet=False):
    """A workbook as office programs write it: styles, shared texts, references."""
    sheets = '<sheet name="a" sheetId="1" r:id="r1"/>' + ('<sheet name="b" sheetId="2" r:id="r2"/>' if extra_sheet else "")
    view = '<bookViews><workbookView activeTab="1"/></bookViews>' if extra_sheet else ""
    wrap = lambda x: f'<worksheet xmlns="{NS}/spreadsheetml/2006/main"><sheetData>{x}</sheetData></worksheet>'
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{NS}/spreadsheetml/2006/main" xmlns:r="{NS}/officeDocument/2006/relationships">{settings}{view}<sheets>{sheets}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{NS}/spreadsheetml/2006/main"><numFmts><numFmt numFmtId="170" formatCode="mmm d, yyyy"/><numFmt numFmtId="171" formatCode="0.00&quot; days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="20"/><xf numFmtId="171"/></cellXfs></styleSheet>',
        "xl/sharedStrings.xml": f'<sst xmlns="{NS}/spreadsheetml/2006/main">' + "".join(f"<si>{s}</si>" for s in shared) + "</sst>",
        "xl/worksheets/s1.xml": wrap("" if extra_sheet else rows),
        "xl/worksheets/s2.xml": wrap(rows if extra_sheet else ""),
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


HEAD = '<row r="1"><c t="s" r="A1"><v>0</v></c><c t="inlineStr" r="B1"><is><t>Venue </t></is></c><c t="s" r="C1"><v>1</v></c><c t="s" r="D1"><v>2</v></c></row>'
SHARED = ("<t>TITLE</t>", "<t>Start</t>", "<t>end</t>", "<r><t>Ham</t></r><r><t>let</t></r>")


def test_cells_of_every_kind():
    rows = HEAD + '<row r="2"><c r="A2" t="s"><v>3</v></c><c r="C2" s="1"><v>46270</v></c><c r="D2" s="2"><v>46270.8125</v></c></row>'
    rows += '<row r="4"><c r="B4" t="b"><v>1</v></c><c r="C4" s="3"><v>0.8125</v></c><c r="D4" s="4"><v>12</v></c><c r="F4"><v>9</v></c></row><row r="5"><c r="A5"><v/></c></row>'
    rows += '<row><c t="str"><v>from a formula</v></c><c><v>12.50</v></c><c t="e"><v>#N/A</v></c></row>'
    want = [("f", 2, None, "Hamlet", None, "2026-09-05", "2026-09-05T19:30:00"), ("f", 4, None, None, "TRUE", "19:30:00", "12"), ("f", 6, None, "from a formula", "12.5", None, None)]
    assert list(workbooks.rows_of("f", book(rows, SHARED), NAMES)) == want
    assert list(workbooks.rows_of("f", book(rows, SHARED, extra_sheet=True), NAMES)) == want
    old = list(workbooks.rows_of("f", book(HEAD + '<row><c><v>1</v></c><c/><c s="1"><v>0</v></c></row>', SHARED, '<workbookPr date1904="1"/>'), NAMES))
    assert old == [("f", 2, None, "1", None, "1904-01-01", None)]


def test_workbook_source(spark, tmp_path):
    workbooks.register(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xlsx").write_bytes(book(HEAD + '<row r="2"><c r="A2" t="s"><v>3</v></c></row>', SHARED))
    (tmp_path / "in" / "b.xlsx").write_bytes(book('<row><c t="inlineStr"><is><t>other</t></is></c></row>'))
    (tmp_path / "in" / "c.xlsx").write_bytes(b"no zip file")
    (tmp_path / "in" / "d.xlsx").write_bytes(workbooks.body_of(NAMES, []))
    for df in (spark.read.format("workbook").option("headers", json.dumps(NAMES)).load(f"file://{tmp_path}/in"), workbooks.read_stored(spark, f"{tmp_path}/in", NAMES)):
        got = sorted(map(tuple, df.collect()), key=lambda r: r[0])
        assert got == [("a.xlsx", 2, None, "Hamlet", None, None, None), ("b.xlsx", None, 'header mismatch: ["other", "", "", ""]', *[None] * 4), ("c.xlsx", None, "not a workbook: BadZipFile", *[None] * 4)]
    (tmp_path / "none").mkdir()
    assert spark.read.format("workbook").load(f"{tmp_path}/none").count() == 0


def test_workbook_round_trip(spark, tmp_path):
    workbooks.register(spark)
    rows = [(f"t{i}", None if i % 3 else "a <b> & \"c\" \x07é\n x ", "  padded ", "1") for i in range(40)]
    df = spark.createDataFrame(rows, "title string, venue string, start string, end string").repartition(3)
    out = f"{tmp_path}/out"
    read = lambda: spark.read.format("workbook").option("headers", json.dumps(NAMES)).load(out)
    for mode, times in (("append", 1), ("append", 2), ("overwrite", 1)):
        df.write.format("workbook").mode(mode).save(out)
        want = sorted([(t, v and v.replace("\x07", ""), s, e) for t, v, s, e in rows] * times, key=str)
        assert sorted((tuple(r) for r in read().select(*NAMES).collect()), key=str) == want
    assert not [f for f in os.listdir(out) if f.startswith("_writing")]
    bad = df.withColumn("title", F.when(F.col("title") == "t5", F.raise_error(F.lit("stop"))).otherwise(F.col("title")))
    with pytest.raises(Exception, match="stop"):
        bad.write.format("workbook").mode("overwrite").save(out)
    assert read().count() == 40


def test_small_workbook_of_rows(spark):
    row = {h: None for h in HEADERS} | {"title of program": "Hamlet & Co", "production_start": 1, "production": 1, "position": 1}
    schema = ", ".join(f"`{k}` {'int' if isinstance(v, int) else 'string'}" for k, v in row.items())
    body = sinks.workbook(spark.createDataFrame([tuple(row.values())], schema))
    got = list(workbooks.rows_of("f", body, HEADERS))
    assert len(got) == 1 and got[0][1:3] == (2, None) and "Hamlet & Co" in got[0]


def answer(**changes):
    return dict.fromkeys(extraction.EVENT_FIELDS) | {"title": "Hamlet"} | changes


@pytest.mark.parametrize(
    ("text", "problems"),
    [
        (json.dumps({"events": [answer(), answer(start_date="2026-09-05")], "none_found": False}), []),
        (json.dumps({"events": [], "none_found": True}), []),
        ("no json", ["no JSON"]),
        ("[]", ["answer is no object"]),
        ("null", ["answer is no object"]),
        (json.dumps({"none_found": True}), ["no list of events"]),
        (json.dumps({"events": {"a": 1}, "none_found": True}), ["no list of events"]),
        (json.dumps({"events": [], "none_found": "no"}), ["none_found is no boolean"]),
        (json.dumps({"events": []}), ["none_found is no boolean"]),
        (json.dumps({"events": [], "none_found": True, "note": 1}), ["answer with other fields"]),
        (json.dumps({"events": [1, None], "none_found": False}), ["event is no object"]),
        (json.dumps({"events": [answer(title=7)], "none_found": False}), ["title is no text"]),
        (json.dumps({"events": [answer(price=None)], "none_found": False}), ["event with other fields"]),
        (json.dumps({"events": [{k: v for k, v in answer().items() if k != "url"}], "none_found": False}), ["event without url"]),
    ],
)
def test_answers_are_checked(spark, text, problems):
    got = extraction.read_answers(spark.createDataFrame([("s", 0, text, None)], "source string, batch int, answer string, failure string")).first()
    assert got["problems"] == problems and got["status"] == ("malformed" if problems else "ok")
    assert (got["events"] is None) == bool(problems)


def test_extraction(spark):
    pages = [("a", i, f"u{i}", "x" * 700) for i in range(5)] + [("b", 0, "u", None), ("c", 0, "w", "text"), ("d", 0, "w", "text"), ("e", 0, "w", "")]
    df = spark.createDataFrame(pages, "source string, place int, url string, text string")
    calls = []

    def ask(source, text):
        if source == "c":
            return None
        if source == "d":
            calls.append(1)
            if len(calls) < 3:
                raise OSError("try again")
        return json.dumps({"events": [answer(title=line[6:]) for line in text.split("\n") if line.startswith("PAGE: ")], "none_found": False})

    got = extraction.extract_events(df, ask, most=1_500)
    rows = {(r["source"], r["batch"]): (r["status"], None if r["events"] is None else [e["title"] for e in r["events"]]) for r in got.collect()}
    assert rows == {("a", 0): ("ok", ["u0", "u1"]), ("a", 1): ("ok", ["u2", "u3"]), ("a", 2): ("ok", ["u4"]), ("c", 0): ("refused", None), ("d", 0): ("ok", ["w"]), ("e", 0): ("ok", ["w"])}
    assert [(r["place"], r["title"]) for r in extraction.events_of(got).filter("source = 'a' and batch = 0").orderBy("place").collect()] == [(0, "u0"), (1, "u1")]
    # "could not ask" is not "found none"
    assert {r["status"] for r in extraction.extract_events(df, None).collect()} == {"unavailable"}
    assert extraction.extract_events(df.limit(0), ask).count() == 0


def test_batches_of_rows_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, i, "x" * 600, i) for i in range(4)], "k int, place int, t string, total int")
    assert sorted(r["batch"] for r in discovery.char_batches(df, ["k"], ["place"], "t", 1_000).collect()) == [0, 1, 2, 3]
