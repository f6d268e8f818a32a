"""Writers: tables with counters and replaced partitions, submission workbooks, a review report, JSON."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.productions import HEADERS, expired_events
from .workbooks import body_of


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Write df so that only the partitions it has rows for are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def save_counters(counters: DataFrame, path: str) -> None:
    """counters(stage, key, value): a stage's old counters are replaced as a whole."""
    replace_partitions(counters.select("stage", "key", F.col("value").cast("long")), path, "stage")


def write_rows_csv(rows: DataFrame, path: str) -> None:
    """Submission rows in publishing order, as CSV parts with a header."""
    rows.orderBy("production_start", "production", "position").select(*(F.col(f"`{h}`") for h in HEADERS)).write.mode("overwrite").option("header", True).csv(path)


def workbook(rows: DataFrame, most: int = 50_000) -> bytes:
    """The same as a small .xlsx for people: at most `most` rows, an error beyond (use write_rows_csv)."""
    data = rows.orderBy("production_start", "production", "position").select(*(F.col(f"`{h}`") for h in HEADERS)).limit(most + 1).collect()
    if len(data) > most:
        raise ValueError(f"more than {most} rows; write them as CSV")
    return body_of(HEADERS, data)


def read_workbook_rows(df: DataFrame) -> DataFrame:
    """Uploaded rows (a frame read from CSV, in columns of HEADERS) with line; wrong headers raise, blank rows go."""
    if [c for c in df.columns if c != "line"] != HEADERS:
        raise ValueError(f"expected the columns {HEADERS}, got {df.columns}")
    filled = F.coalesce(*(F.nullif(F.trim(F.col(f"`{h}`")), F.lit("")) for h in HEADERS))
    return df.filter(filled.isNotNull())


def review_sections(events: DataFrame, rows: DataFrame, rejected: DataFrame, as_of) -> DataFrame:
    """(section, event_id, title, detail) of what people should look at."""
    pick = lambda df, section, detail: df.select(F.lit(section).alias("section"), "event_id", "title", detail.alias("detail"))
    noted = rows.filter("size(flags) > 0 or size(problems) > 0").select("event_id", F.col("`title of program`").alias("title"), F.array_join(F.concat("flags", "problems"), "; ").alias("d"))
    parts = [
        pick(noted, "flagged", F.col("d")),
        pick(events.filter("verdict = 'unsure'"), "borderline", F.col("verdict_reason")),
        pick(events.filter("relevance = 'review'"), "uncertain", F.col("reason")),
        pick(rejected.filter("reason like 'outside region%'"), "outside region", F.col("reason")),
        pick(events.filter("verdict = 'same'"), "duplicates", F.col("verdict_reason")),
        pick(expired_events(events, as_of), "past", F.col("start_date").cast("string")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def section_counts(sections: DataFrame) -> DataFrame:
    return sections.groupBy("section").agg(F.count("*").alias("n"))


def report_html(sections: DataFrame, shown: int = 40) -> str:
    """The review report: counts, then the first rows of each section; only what is shown comes to the driver."""
    from pyspark.sql import Window

    counts = {r["section"]: r["n"] for r in section_counts(sections).collect()}
    first = Window.partitionBy("section").orderBy("title", "event_id")
    rows = sections.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= shown).orderBy("section", "_r").collect()
    out = ["<!DOCTYPE html><title>Review</title><h1>Review</h1>"]
    for section, n in sorted(counts.items()):
        out.append(f"<h2>{escape(section)} ({n})</h2><table>")
        out += [f"<tr><td>{escape(r['title'] or '')}</td><td>{escape(r['detail'] or '')}</td></tr>" for r in rows if r["section"] == section]
        out.append("</table>" + (f"<p>and {n - shown} more</p>" if n > shown else ""))
    return "".join(out)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
