"""Dates and times of day, Column to Column. Today is always a parameter; values without a zone are local as written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/New_York"
#: The written forms that feeds use, besides ISO.
FORMATS = [
    "yyyyMMdd'T'HHmmss", "yyyyMMdd", "M/d/yyyy h:mm a", "M/d/yyyy H:mm", "M/d/yyyy", "MMMM d, yyyy h:mm a", "MMMM d, yyyy",
    "MMM d, yyyy h:mm a", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "d MMM yyyy HH:mm:ss",
]
TIME_OF_DAY = r"\d:\d\d|T\d\d|\d\s*[ap]\.?m"
ZONED = r"\d{2}:?\d{2}(?::?\d{2}(?:\.\d+)?)?\s*(?:Z|[+-]\d{2}:?\d{2})$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_local(ts, zone: str = LOCAL_ZONE) -> Column:
    """The wall clock in `zone` at an instant."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), _col(ts).cast("timestamp_ntz"))


def from_millis(ms, zone: str = LOCAL_ZONE) -> Column:
    """The wall clock in `zone` at milliseconds since 1970."""
    return to_local(F.timestamp_millis(_col(ms)), zone)


def wall_clock(c, zone: str = LOCAL_ZONE) -> Column:
    """A written date or time as a wall clock: values with a zone are moved to `zone`, others stand as they are."""
    raw = F.trim(_col(c))
    s = F.regexp_replace(F.regexp_replace(raw, r"(?i)\b([ap])\.?m\b\.?", "$1M"), r"\s+", " ")
    s = F.regexp_replace(s, r"(\d)([aApP])M", "$1 $2M")
    s = F.regexp_replace(F.regexp_replace(s, r"pM", "PM"), r"aM", "AM")
    s = F.regexp_replace(s, r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+", "")
    known = [F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in FORMATS]
    zoned = to_local(F.coalesce(raw.try_cast("timestamp"), F.try_to_timestamp(raw, F.lit("yyyyMMdd'T'HHmmssX"))), zone)
    iso = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}"), raw.try_cast("timestamp_ntz"))
    return F.when(raw.rlike(ZONED) & raw.rlike(r"^\d{4}"), zoned).otherwise(F.coalesce(iso, *known))


def parse_dt(c, zone: str = LOCAL_ZONE) -> Column:
    """struct(date, time): the day, and HH:mm where a time other than midnight is written."""
    clock = wall_clock(c, zone)
    time = F.date_format(clock, "HH:mm")
    return F.struct(clock.cast("date").alias("date"), F.when(_col(c).rlike(f"(?i){TIME_OF_DAY}") & (time != "00:00"), time).alias("time"))


def coerce_time(c) -> Column:
    """HH:mm of "7:30 pm", "7pm", "19:30", "2026-09-05 19:30" and the like; null for other texts."""
    s = F.trim(_col(c))
    half = r"(?i)(?:^|[T\s])(\d{1,2})(?::(\d{2}))?(?::\d{2})?\s*([ap])\.?\s*m\.?$"
    full = r"(?:^|[T\s])([01]?\d|2[0-3]):([0-5]\d)(?::[0-5]\d(?:\.\d+)?)?$"
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    hour = F.regexp_extract(s, half, 1).try_cast("int")
    minute = F.coalesce(F.regexp_extract(s, half, 2).try_cast("int"), F.lit(0))
    noon = F.when(F.lower(F.regexp_extract(s, half, 3)) == "p", 12).otherwise(0)
    by_half = F.when(s.rlike(half) & hour.between(1, 12) & (minute < 60), F.concat(two(hour % 12 + noon), F.lit(":"), two(minute)))
    by_full = F.when(s.rlike(full), F.concat(two(F.regexp_extract(s, full, 1).try_cast("int")), F.lit(":"), F.regexp_extract(s, full, 2)))
    return F.when(s.rlike(r"^\d{2}:\d{2}$"), s).otherwise(F.coalesce(by_half, by_full))


def as_date(c) -> Column:
    """The day at the start of an ISO text, null where there is none."""
    return F.substring(_col(c).cast("string"), 1, 10).try_cast("date")


def fmt_date(c) -> Column:
    return F.date_format(_col(c).cast("date"), "MM/dd/yyyy")


def iso_of_us_date(c) -> Column:
    """yyyy-MM-dd of MM/dd/yyyy, by its letters alone."""
    part = lambda k: F.regexp_extract(F.trim(_col(c)), r"^(\d{2})/(\d{2})/(\d{4})$", k)
    return F.when(F.trim(_col(c)).rlike(r"^\d{2}/\d{2}/\d{4}$"), F.concat_ws("-", part(3), part(1), part(2)))


def fmt_time(c) -> Column:
    """7:30 p.m. of 19:30."""
    h = F.substring(_col(c), 1, 2).try_cast("int")
    return F.concat(F.when(h % 12 == 0, 12).otherwise(h % 12).cast("string"), F.lit(":"), F.substring(_col(c), 4, 2), F.when(h < 12, " a.m.").otherwise(" p.m."))


def minutes(c) -> Column:
    """Minutes since midnight of 7:30 p.m.; null for other texts."""
    rx = r"^(\d{1,2}):(\d{2}) ([ap])\.m\.$"
    part = lambda k: F.regexp_extract(F.trim(_col(c)), rx, k)
    value = (part(1).cast("int") % 12) * 60 + part(2).cast("int") + F.when(part(3) == "p", 720).otherwise(0)
    return F.when(F.trim(_col(c)).rlike(rx), value)


def pretty_date(c) -> Column:
    return F.date_format(_col(c).cast("date"), "EEE MMM d, yyyy")


def parse_through(c, day) -> Column:
    """The last day of "Through June 5", taken from the year of `day` or, if that is over, the next one."""
    text = F.regexp_extract(_col(c), r"(?i)through\s+(?:\w+day,?\s+)?([A-Za-z]+\s+\d{1,2})", 1)
    found = F.coalesce(*(F.try_to_timestamp(F.concat(text, F.lit(" "), F.year(_col(day)).cast("string")), F.lit(f)).cast("date") for f in ("MMMM d yyyy", "MMM d yyyy")))
    return F.when(found < _col(day), F.add_months(found, 12)).otherwise(found)


def exclusive_end(c) -> Column:
    """The last day of an all-day event whose end names the day after."""
    return F.date_sub(_col(c).cast("date"), 1)


def in_horizon(start, end, as_of, back: int = 1, ahead: int = 540) -> Column:
    """Not over by more than `back` days, not later than `ahead` days; without a readable start the event passes."""
    s = as_date(start)
    e = F.coalesce(as_date(end), s)
    return s.isNull() | ((e >= F.date_sub(_col(as_of), back)) & (s <= F.date_add(_col(as_of), ahead)))


def month_cells(month) -> Column:
    """The 42 days of a month's page, from the Sunday on or before its first."""
    first = F.trunc(_col(month), "month")
    start = F.date_sub(first, F.dayofweek(first) - 1)
    return F.sequence(start, F.date_add(start, 41))
