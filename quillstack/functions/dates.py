"""Date rules as Column expressions; everything is time-zone free."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstack.functions.text import let

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
# Fixed value: month/day/year hour:minute AM or PM.
STAMP = r"(?U)^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2})\s+([AaPp][Mm])\s*$"


def parse_created(diary_date: Column, created_text: Column) -> Column:
    """Diary date plus the time in the created text, whose first word is a date to drop.

    Built from its parts, so neither the session's zone nor its daylight-saving gaps
    move it; anything malformed is NULL.
    """
    time = F.regexp_replace(created_text, r"(?U)^\s*\S+\s+", "")
    stamp = F.concat(diary_date, F.lit(" "), time)
    parts = F.split(F.regexp_replace(stamp, STAMP, "$3|$1|$2|$4|$5|$6"), r"\|")

    def build(p: Column) -> Column:
        part = lambda i: F.get(p, F.lit(i)).try_cast("int")
        hour = part(3) % 12 + F.when(F.lower(F.get(p, F.lit(5))) == "pm", 12).otherwise(0)
        value = F.try_make_timestamp_ntz(part(0), part(1), part(2), hour, part(4), F.lit(0))
        return F.when((F.size(p) == 6) & part(3).between(1, 12), value)

    return let(parts, build)


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a stored time, taken as it stands, from its own parts."""
    text = ts.cast("string")
    part = lambda i: F.substring(text, i, 2).cast("int")
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 86400 + part(12) * 3600 + part(15) * 60 + part(18)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr(EPOCH))


def post_date(ts: Column) -> Column:
    """Date and time as text. Casting keeps the stored time; formatting would go through the
    session's zone and move times that its summer time skips."""
    return F.left(ts.cast("string"), F.lit(19))


def rfc822(ts: Column) -> Column:
    """Publication date; the stored times carry no zone, so the zone part stays empty."""
    day = F.date_format(F.to_date(ts), "EEE, dd MMM yyyy ")
    return F.concat(day, F.substring(ts.cast("string"), 12, 8), F.lit(" "))


def post_date_gmt(ts: Column, time_zone: str | None) -> Column:
    return post_date(F.to_utc_timestamp(ts, time_zone) if time_zone else ts)


def upload_month(ts: Column) -> Column:
    return F.concat(F.replace(F.left(ts.cast("string"), F.lit(7)), F.lit("-"), F.lit("/")), F.lit("/"))
