"""Dates: lenient and strict parts, windows, calendars and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.clean import as_number, col


def date_strict(y: Column | str, m: Column | str, d: Column | str) -> Column:
    """Null if a part is null; a date that doesn't exist is an error."""
    return F.make_date(as_number(y).cast("int"), as_number(m).cast("int"), as_number(d).cast("int"))


def date_lenient(y: Column | str, m: Column | str, d: Column | str) -> Column:
    part = lambda c: as_number(c).cast("int")
    return F.try_make_timestamp(part(y), part(m), part(d), F.lit(0), F.lit(0), F.lit(0)).cast("date")


def date_defaulting(direct: Column | str, y: Column | str, m: Column | str, d: Column | str) -> Column:
    """A direct date first; else parts, month and day 1 where they are missing."""
    one = lambda c: F.coalesce(as_number(c), F.lit(1.0))
    return F.coalesce(F.try_to_date(F.substring(F.trim(col(direct).cast("string")), 1, 10), "yyyy-MM-dd"), date_lenient(y, one(m), one(d)))


def date_known(direct: Column | str, y: Column | str, m: Column | str, d: Column | str) -> Column:
    """A direct value, if there is any, decides alone, also when it can't be read; else the parts."""
    text = F.trim(col(direct).cast("string"))
    return F.when(col(direct).isNotNull() & (text != ""), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")).otherwise(date_lenient(y, m, d))


#: The forms of publication dates that are tried in turn.
PUBLISHED = ("EEE, dd MMM yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "dd MMM yyyy", "MMMM d, yyyy", "yyyy-MM-dd")


def published(c: Column | str) -> Column:
    """A publication time without zone; zones are dropped, not converted. Else a date found in the text."""
    text = F.trim(F.regexp_replace(F.regexp_replace(col(c), r"\s*(?:GMT|UTC|Z|[+-]\d{2}:?\d{2})$", ""), r"(T\d{2}:\d{2}:\d{2})\.\d+", "$1"))
    tried = [F.when(text.rlike(p), F.try_to_timestamp(text, F.lit(f))) for p, f in zip(
        (r"^[A-Za-z]{3}, \d{2} ", r"^\d{4}-\d{2}-\d{2}T", r"^\d{4}-\d{2}-\d{2} ", r"^\d{2} [A-Za-z]{3} \d{4}$", r"^[A-Z][a-z]+ \d{1,2}, \d{4}$", r"^\d{4}-\d{2}-\d{2}$"),
        ("EEE, dd MMM yyyy HH:mm:ss", *PUBLISHED[1:]), strict=True)]
    # A week day can't be parsed with this pattern language, so it is cut off.
    tried[0] = F.when(text.rlike(r"^[A-Za-z]{3}, \d{1,2} "), F.try_to_timestamp(F.regexp_replace(text, "^[A-Za-z]{3}, ", ""), F.lit("d MMM yyyy HH:mm:ss")))
    return F.coalesce(*tried, F.try_to_timestamp(F.nullif(F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), F.lit("yyyy-MM-dd")))


def day_distance(a: Column | str, b: Column | str) -> Column:
    """Absolute whole days, rounded down before the sign goes: half a day earlier is 1."""
    seconds = F.unix_timestamp(col(a).cast("timestamp")) - F.unix_timestamp(col(b).cast("timestamp"))
    return F.abs(F.floor(seconds / 86400))


def window(day: Column | str, before: int, after: int) -> tuple[Column, Column]:
    """First and last day; -1 after ends the day before."""
    return F.date_sub(col(day), before), F.date_add(col(day), after)


def calendar(day: Column | str, before: int = 10, after: int = 10) -> Column:
    first, last = window(day, before, after)
    return F.sequence(first, last)


def calendar_between(first: Column | str, last: Column | str) -> Column:
    """Every day of a span; a span that ends before it begins is an error."""
    return F.when(col(last) >= col(first), F.sequence(col(first), col(last))).otherwise(F.raise_error(F.lit("the span ends before it begins")).cast("array<date>"))


def compact_stamps(day: Column | str, before: int = 10, after: int = 60) -> tuple[Column, Column]:
    first, last = window(day, before, after)
    return F.concat(F.date_format(first, "yyyyMMdd"), F.lit("000000")), F.concat(F.date_format(last, "yyyyMMdd"), F.lit("235959"))


def around(ts: Column | str, seconds: int = 1) -> tuple[Column, Column]:
    return col(ts) - F.make_dt_interval(secs=F.lit(float(seconds))), col(ts) + F.make_dt_interval(secs=F.lit(float(seconds)))


def day_span(ts: Column | str) -> tuple[Column, Column]:
    day = F.date_format(col(ts), "yyyy-MM-dd")
    return F.concat(day, F.lit("T00:00:00Z")), F.concat(day, F.lit("T23:59:59Z"))


def parts(day: Column | str) -> Column:
    """year, month, month name and day of a ``Y-M-D`` text, 01 where a part is missing."""
    p = F.split(F.coalesce(col(day).cast("string"), F.lit("")), "-")
    two = lambda i: F.coalesce(F.nullif(F.get(p, i), F.lit("")), F.lit("01"))
    names = F.array(*map(F.lit, "January February March April May June July August September October November December".split()))
    return F.struct(F.get(p, F.lit(0)).alias("year"), two(F.lit(1)).alias("month"), F.get(names, two(F.lit(1)).try_cast("int") - 1).alias("month_name"), two(F.lit(2)).alias("day"))


def years_in(c: Column | str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1)))


def wrong_year(title: Column | str, url: Column | str, year: Column | str) -> Column:
    """Whether title and address name years, but not this one."""
    found = F.array_union(years_in(title), F.regexp_extract_all(F.coalesce(col(url), F.lit("")), F.lit(r"[/_-]((?:19|20)\d{2})(?=[/_-]|$)"), F.lit(1)))
    return (F.size(found) > 0) & ~F.coalesce(F.array_contains(found, col(year).cast("string")), F.lit(False))
