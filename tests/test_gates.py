from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import publishing, summaries, weather


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_nothing_known(spark):
    none = F.lit(None).cast("string")
    group = publishing.source_group(none, none, F.lit(None).cast("map<string,string>"), F.lit(None).cast("array<struct<name:string,url:string>>"))
    tokens = publishing.token_usage(none, {"input": none, "output": none, "total": none}, none, none, none, none)
    days = dates.calendar(F.to_date(F.lit("2020-01-05")))
    r = one(spark, group=group, tokens=tokens, archive=weather.archive_series(none, days), power=weather.power_series(F.lit("[]"), days), places=summaries.location_terms(none), lands=summaries.country_terms(none), year=summaries.event_year(none, none))
    assert r.group.group is None and r.group.source == ""
    assert all(v is None for v in r.tokens)
    assert r.archive is None and r.power is None and r.places == [] and r.lands == [] and r.year is None


def test_estimates(spark):
    none = F.lit(None).cast("string")
    known = {"input": none, "output": none, "total": none}
    by_news = publishing.token_usage(F.lit("called"), known, none, none, F.lit("12345"), F.lit("9"))
    r = one(spark, a=by_news)
    assert (r.a.estimated_input, r.a.estimated_from, r.a.estimated_output, r.a.total_tokens) == (3, publishing.CONTEXT_SCOPE, 2, None)


def test_answers_out_of_order(spark):
    days = dates.calendar(F.to_date(F.lit("2020-01-05")), 1, 1)
    said = lambda time, rain: F.lit('{"daily":{"time":%s,"rain_sum":%s}}' % (time, rain))
    r = one(
        spark, right=weather.archive_series(said('["2020-01-06","2020-01-04"]', "[1,2]"), days), twice=weather.archive_series(said('["2020-01-04","2020-01-04"]', "[1,2]"), days),
        short=weather.archive_series(said('["2020-01-04","2020-01-05"]', "[1]"), days), nothing=weather.archive_series(said('["2020-01-04"]', "[null]"), days))
    assert [x.rain_sum for x in r.right] == [2.0, None, 1.0]
    assert r.twice is None and r.short is None and r.nothing is None


def test_answers_are_parsed_once_a_row(spark):
    days = dates.calendar(F.col("day"))
    for series in (weather.archive_series("body", days), weather.power_series("body", days)):
        plan = spark.createDataFrame([("{}", None)], "body string, day date").select(series.alias("s"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("from_json(") == 1


def test_answers_with_fills_gaps_and_repeats(spark):
    days = dates.calendar(F.to_date(F.lit("2020-01-05")), 1, 1)
    power = '{"header":{"fill_value":-7},"properties":{"parameter":{"T2M_MAX":{"20200104":-7,"20200105":-999,"20200106":4.5},"PRECTOTCORR":{"20200105":-1,"20200106":2}}}}'
    archive = '{"daily":{"time":["2020-01-05",null,"2020-02-01"],"rain_sum":[-1,5,6],"temperature_2m_min":[-3,5,"NaN"]}}'
    r = one(spark, p=weather.power_series(F.lit(power), days), a=weather.archive_series(F.lit(archive), days), none=weather.power_series(F.lit(power.replace("4.5", "null")), days))
    assert [(x.day, x.temperature_2m_max, x.precipitation_sum, x.rain_sum) for x in r.p] == [("2020-01-04", None, None, None), ("2020-01-05", None, None, None), ("2020-01-06", 4.5, 2.0, None)]
    assert [(x.rain_sum, x.temperature_2m_min, x.snowfall_sum) for x in r.a] == [(None, None, None), (None, -3.0, None), (None, None, None)]
    assert r.none is None
