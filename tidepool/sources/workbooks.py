"""Workbooks (.xlsx) as a Spark data source: a partition per file, cells as text, headers checked file by file.

    workbooks.register(spark)
    spark.read.format("workbook").option("headers", json.dumps(names)).load("/shared/uploads")
    rows.write.format("workbook").mode("overwrite").save("/shared/out")

Paths are folders or files as all executors see them; `read_stored` reads what only Spark's own readers can open.
A cell is the text that the upload checks take: whole numbers without a point, days as yyyy-MM-dd, with a time of day
as yyyy-MM-ddTHH:mm:ss, times as HH:mm:ss, booleans as TRUE or FALSE; an empty cell is null. Rows without any
cell go. A file with other headers, or one that is no workbook, gives one row with `problem` set and ends nothing.
"""

from __future__ import annotations

import glob
import io
import json
import os
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.productions import HEADERS

#: The file format's own numbers of formats that show a day or a time of day.
DATE_FORMATS, TIME_FORMATS = {14, 15, 16, 17, 22}, {18, 19, 20, 21, 45, 46, 47}
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def schema_of(headers: list[str]) -> StructType:
    own = [StructField("file", StringType()), StructField("line", LongType()), StructField("problem", StringType())]
    return StructType([*own, *(StructField(h, StringType()) for h in headers)])


def _column(reference: str) -> int:
    n = 0
    for letter in re.match(r"[A-Z]*", reference.upper()).group():
        n = n * 26 + ord(letter) - 64
    return n - 1


def _kind_of_format(code: str) -> str | None:
    plain = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code.lower())
    if re.search(r"[yd]", plain):
        return "day"
    return "time" if re.search(r"[hs]", plain) else "day" if re.search(r"m", plain) else None


def _as_text(value: str, kind: str | None, since: datetime) -> str:
    number = float(value)
    if kind is None:
        return str(int(number)) if number == int(number) and abs(number) < 1e15 else repr(number)
    at = since + timedelta(seconds=round(number * 86_400))
    if kind == "time" and number < 1:
        return at.strftime("%H:%M:%S")
    return at.strftime("%Y-%m-%d") if at.time() == datetime.min.time() else at.isoformat()


def cells(body: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """(line, cells) of the rows of a workbook's active sheet, read as a stream."""
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        settings, view = book.find(f"{MAIN}workbookPr"), book.find(f"{MAIN}bookViews/{MAIN}workbookView")
        since = datetime(1904, 1, 1) if settings is not None and settings.get("date1904") in ("1", "true") else datetime(1899, 12, 30)
        sheet = book.findall(f"{MAIN}sheets/{MAIN}sheet")[int(view.get("activeTab", 0)) if view is not None else 0]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets[sheet.get(f"{LINKS}id")]
        path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        text = lambda node: "".join(t.text or "" for t in node.iter(f"{MAIN}t"))
        shared = [text(s) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{MAIN}si")] if "xl/sharedStrings.xml" in z.namelist() else []
        kinds: list[str | None] = []
        if "xl/styles.xml" in z.namelist():
            styles = ElementTree.fromstring(z.read("xl/styles.xml"))
            own = {int(f.get("numFmtId")): _kind_of_format(f.get("formatCode", "")) for f in styles.iter(f"{MAIN}numFmt")}
            fixed = dict.fromkeys(DATE_FORMATS, "day") | dict.fromkeys(TIME_FORMATS, "time")
            kinds = [(fixed | own).get(int(x.get("numFmtId", 0))) for x in styles.findall(f"{MAIN}cellXfs/{MAIN}xf")]
        with z.open(path) as stream:
            line = 0
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{MAIN}row":
                    continue
                line = int(row.get("r", line + 1))
                found: list[str | None] = []
                for c in row.findall(f"{MAIN}c"):
                    at = _column(c.get("r")) if c.get("r") else len(found)
                    found += [None] * (at + 1 - len(found))
                    kind, value = c.get("t", "n"), c.findtext(f"{MAIN}v")
                    if kind == "inlineStr":
                        got = text(c)
                    elif not value:
                        got = None
                    elif kind == "s":
                        got = shared[int(value)]
                    elif kind == "b":
                        got = "TRUE" if value == "1" else "FALSE"
                    elif kind == "n":
                        style = int(c.get("s", 0))
                        got = _as_text(value, kinds[style] if style < len(kinds) else None, since)
                    else:
                        got = None if kind == "e" else value
                    found[at] = got or None
                if any(v is not None for v in found):
                    yield line, found
                row.clear()


def rows_of(name: str, body: bytes, headers: list[str]) -> Iterator[tuple]:
    """(file, line, problem, cells) of a workbook whose first row should be headers, in any case of letters."""
    blank = (None,) * len(headers)
    try:
        found = cells(body)
        first = next(found, (0, []))[1]
        got = [(h or "").strip() for h in [*first, *blank][: len(headers)]]
        if [h.lower() for h in got] != [h.lower() for h in headers]:
            yield (name, None, f"header mismatch: {json.dumps(got)}", *blank)
            return
        for line, values in found:
            kept = [*values, *blank][: len(headers)]
            if any(v is not None for v in kept):
                yield (name, line, None, *kept)
    except (zipfile.BadZipFile, KeyError, IndexError, ValueError, ElementTree.ParseError) as error:
        yield (name, None, f"not a workbook: {type(error).__name__}", *blank)


def body_of(headers: list[str], rows: Iterable) -> bytes:
    """A workbook of text cells with these headers and rows."""
    ns = "http://schemas.openxmlformats.org"
    # characters that XML can't hold are left out
    cell = lambda v: "<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", str(v)))}</t></is></c>'
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{ns}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="rId1" Type="{ns}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{ns}/spreadsheetml/2006/main" xmlns:r="{ns}/officeDocument/2006/relationships"><sheets><sheet name="events" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="rId1" Type="{ns}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    }
    out, start = io.BytesIO(), '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(name, start + body)
        with z.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'{start}<worksheet xmlns="{ns}/spreadsheetml/2006/main"><sheetData>'.encode())
            for i, row in enumerate(_with_first(headers, rows), 1):
                sheet.write(f'<row r="{i}">{"".join(map(cell, row))}</row>'.encode())
            sheet.write(b"</sheetData></worksheet>")
    return out.getvalue()


def _with_first(first, rest: Iterable) -> Iterator:
    yield first
    yield from rest


def _local(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, headers: list[str]):
        self.path, self.headers = _local(path), headers

    def partitions(self) -> list[_File]:
        names = sorted(glob.glob(f"{self.path}/*.xlsx")) if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        return [_File(n) for n in names]

    def read(self, partition: _File) -> Iterator[tuple]:
        if partition is None or partition.path is None:  # no file at all
            return
        with open(partition.path, "rb") as f:
            yield from rows_of(os.path.basename(partition.path), f.read(), self.headers)


class _Written(WriterCommitMessage):
    def __init__(self, path: str | None):
        self.path = path


class WorkbookWriter(DataSourceWriter):
    """A workbook per task that has rows, first beside the folder's files, moved in when all tasks are done."""

    def __init__(self, path: str, headers: list[str], overwrite: bool):
        self.path, self.headers, self.overwrite = _local(path), headers, overwrite
        self.aside = f"{self.path}/_writing-{uuid.uuid4().hex}"

    def write(self, iterator) -> _Written:
        from pyspark import TaskContext

        first = next(iterator, None)
        if first is None:
            return _Written(None)
        os.makedirs(self.aside, exist_ok=True)
        path = f"{self.aside}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.xlsx"
        with open(path, "wb") as f:
            f.write(body_of(self.headers, _with_first(tuple(first), map(tuple, iterator))))
        return _Written(path)

    def commit(self, messages: list) -> None:
        if self.overwrite:
            for old in glob.glob(f"{self.path}/*.xlsx"):
                os.remove(old)
        os.makedirs(self.path, exist_ok=True)
        for m in messages:
            if m is not None and m.path is not None:
                os.rename(m.path, f"{self.path}/{os.path.basename(m.path)}")
        shutil.rmtree(self.aside, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.aside, ignore_errors=True)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _headers(self) -> list[str]:
        return json.loads(self.options["headers"]) if "headers" in self.options else list(HEADERS)

    def schema(self) -> StructType:
        return schema_of(self._headers())

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(self.options["path"], self._headers())

    def writer(self, schema: StructType, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(self.options["path"], schema.names, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)


def read_stored(spark: SparkSession, path: str, headers: list[str] | None = None) -> DataFrame:
    """The same rows from any store that Spark reads."""
    names = list(HEADERS) if headers is None else headers

    def run(frames):
        import pandas as pd

        for frame in frames:
            for file, body in zip(frame["path"], frame["content"]):
                yield pd.DataFrame(rows_of(file.rsplit("/", 1)[-1], body, names), columns=schema_of(names).names).astype({"line": "Int64"})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema_of(names))
