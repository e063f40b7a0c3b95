"""Daily measurements aligned to a calendar around an event's day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import col, let, measurement
from tidemark.functions.dates import calendar

#: The measurements, and whether they can't be negative.
MEASURES = {"rain_sum": True, "snowfall_sum": True, "temperature_2m_max": False, "temperature_2m_min": False}
DAYS = 21


def aligned(time: Column | str, values: Mapping[str, Column | str], days: Column, nonnegative: Mapping[str, bool] = MEASURES) -> Column:
    """Parallel arrays as an array of structs over the days of a calendar, null where a day has no value.

    Null if the dates repeat, or if an array has another length than the dates. Each value is worked out once a row.
    """


    def series(s: Column) -> Column:
        t = s["_time"]
        ok = F.size(F.array_distinct(t)) == F.size(t)
        for k in values:
            ok = ok & (F.size(s[k]) == F.size(t))
        tidy = lambda least: lambda x: measurement(x, least)
        told = F.struct(*[F.transform(s[k], tidy(nonnegative.get(k, False))).alias(k) for k in values])
        row = lambda v, d, at: F.struct(d.alias("day"), *[F.get(v[k], at).alias(k) for k in values])
        # A day that isn't there has position 0.
        return F.when(ok, let(told, lambda v: F.transform(days, lambda d: let((F.array_position(t, d) - 1).cast("int"), lambda at: row(v, d, at)))))

    return let(F.struct(col(time).alias("_time"), *[col(v).alias(k) for k, v in values.items()]), series)


#: What a service that has no rain or snow of its own calls its measurements.
POWER = {"precipitation_sum": "PRECTOTCORR", "temperature_2m_max": "T2M_MAX", "temperature_2m_min": "T2M_MIN"}
ALL_MEASURES = {**MEASURES, "precipitation_sum": True}


def _if_any(series: Column) -> Column:
    """The series, or null if no day has one of MEASURES (a sum of all precipitation alone isn't enough)."""
    some = lambda s: F.exists(s, lambda x: F.coalesce(*[x[k] for k in MEASURES]).isNotNull())
    return let(series, lambda s: F.when(some(s), s))


def archive_series(body: Column | str, days: Column) -> Column:
    """Days of an answer with parallel arrays under ``daily``; a measure it lacks is null on all days.

    Null for text that isn't such an answer, for repeated dates, for arrays of another length, and if nothing was measured.
    """
    kind = "struct<daily:struct<time:array<string>," + ",".join(f"{k}:array<double>" for k in ALL_MEASURES) + ">>"
    named = F.transform(days, lambda d: d.cast("string"))

    def series(daily: Column) -> Column:
        empty = F.transform(daily["time"], lambda _: F.lit(None).cast("double"))
        return aligned(daily["time"], {k: F.coalesce(daily[k], empty) for k in ALL_MEASURES}, named, ALL_MEASURES)

    return _if_any(let(F.from_json(col(body), kind)["daily"], series))


def power_series(body: Column | str, days: Column) -> Column:
    """Days of an answer with maps from ``yyyyMMdd`` to values under ``properties.parameter``, its own fill value missing.

    Rain and snow are null, as only their sum is given. Null for text that isn't such an answer, and if nothing was measured.
    """
    kind = "struct<header:struct<fill_value:double>,properties:struct<parameter:struct<" + ",".join(f"{v}:map<string,double>" for v in POWER.values()) + ">>>"

    def series(answer: Column) -> Column:
        said, fill = answer["properties"]["parameter"], answer["header"]["fill_value"]
        own = lambda least: lambda _, x: let(measurement(x, least), lambda y: F.when(~y.eqNullSafe(fill), y))
        told = F.struct(*[F.transform_values(said[v], own(ALL_MEASURES[k])).alias(k) for k, v in POWER.items()])
        value = lambda m, k, key: F.try_element_at(m[k], key) if k in POWER else F.lit(None).cast("double")
        row = lambda m, d, key: F.struct(d.cast("string").alias("day"), *[value(m, k, key).alias(k) for k in ALL_MEASURES])
        return let(told, lambda m: F.transform(days, lambda d: let(F.date_format(d, "yyyyMMdd"), lambda key: row(m, d, key))))

    return _if_any(let(F.from_json(col(body), kind), series))


def valid_days(series: Column | str, measures: Sequence[str]) -> Column:
    """How many days have a value, for each measure."""
    return F.struct(*[F.size(_present(series, k)).alias(k) for k in measures])


def _present(series: Column | str, measure: str) -> Column:
    return F.filter(F.transform(col(series), lambda x: x[measure]), lambda v: v.isNotNull())


def before_and_after(series: Column | str, middle: int = 10, rain: str = "rain_sum", temperature: str = "temperature_2m_max") -> Column:
    """Sums and means of the days before and after the event's own day, by position in the series."""

    def one(first: int, n: int) -> Column:
        part = F.slice(col(series), first, n)
        wet, warm = _present(part, rain), _present(part, temperature)
        add = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
        return F.struct(
            F.when(F.size(wet) > 0, F.round(add(wet), 2)).alias("total_rainfall_mm"),
            F.array_max(wet).alias("max_daily_rainfall_mm"),
            F.when(F.size(warm) > 0, F.round(add(warm) / F.size(warm), 1)).alias("avg_max_temperature_c"),
            F.size(wet).alias("rain_days"),
            F.size(warm).alias("temperature_days"),
        )

    return F.struct(one(1, middle).alias("pre"), one(middle + 2, middle).alias("post"))


def period_means(events: DataFrame, daily: DataFrame, key: str, day: str, date: str, values: Sequence[str], before: int = 10, after: int = 10) -> DataFrame:
    """Means of daily rows over the days before, and from the event's day on, for each event; days without a row count as missing.

    The calendar is made per event and joined by (key, day), so that no series is gathered as a whole.
    """
    days = events.select(key, day, F.posexplode(calendar(day, before, after)).alias("index", date))
    joined = days.join(daily.select(key, date, *values), [key, date], "left")
    part = lambda v, early: F.avg(F.when((F.col("index") < before) == early, F.col(v)))
    return joined.groupBy(key, day).agg(
        *[part(v, early).alias(f"{v}_{name}_mean") for v in values for name, early in (("pre", True), ("post", False))],
        *[F.count(v).alias(f"{v}_valid_days") for v in values],
    )


def retrieval_status(counts: Sequence[Column], days: int = DAYS) -> Column:
    full, some = F.lit(True), F.lit(False)
    for c in counts:
        full, some = full & (c == days), some | (c > 0)
    return F.when(full, "fetched").when(some, "partial").otherwise("failed")


def reusable(record: Column | str, version: Column, expected: Column, measures: Sequence[str], partial: bool = True) -> Column:
    """Whether a kept series still serves: version, status, dates and lengths."""
    r = col(record)
    ok = (r["version"] == version) & r["status"].isin("fetched", *(["partial"] if partial else [])) & (r["time"] == expected)
    for m in measures:
        ok = ok & (F.size(r[m]) == F.size(expected))
    return F.coalesce(ok, F.lit(False))


def upsert_best(old: DataFrame, new: DataFrame, key: str, coverage: str) -> DataFrame:
    """The record with more coverage of each key; of equals the new one."""
    tagged = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    columns = [c for c in old.columns if c != key]
    best = tagged.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(F.coalesce(coverage, F.lit(-1)), "_new")).alias("b"))
    return best.select(key, "b.*")
