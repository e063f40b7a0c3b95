"""Queries of article gates, source groups, token counts, diagnoses and weather answers, and their SQL.

As in ``rules``, rows get what the tables don't have by number, in the query and in its SQL alike; cases of the gate and of
place names have results worked out by hand.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import geocoding, publishing, summaries, weather
from tidemark.plans.queries import query, t
from tidemark.plans.rules import _picked, pick

# --- articles that may speak for an event -----------------------------------------------------------------------

#: title, body, url, source, confidence, reason, penalty, year of publication, places of the event, whether it is kept
CASES = [
    ("Flood in Beira 2019", "Rivers rose.", "https://x.org/a", "Local Paper", "medium", None, None, "2019", "Beira", True),
    ("Flood in Beira 2019", "Rivers rose.", "https://x.org/a", "Local Paper", "low", None, None, "2019", "Beira", False),
    ("Flood in Beira 2011", "Rivers rose.", "https://x.org/a", "Local Paper", "high", None, None, "2019", "Beira", False),
    ("Flood in Mozambique", "Rivers rose.", "https://x.org/2019/a", "ReliefWeb", "medium", None, None, "2019", None, True),
    ("Flood in Mozambique", "Rivers rose.", "https://x.org/2019/a", "Local Paper", "medium", None, None, "2019", None, False),
    ("Flood in Mozambique", "Rivers rose.", "https://x.org/2019/a", "Local Paper", "high", None, None, "2019", "Region", True),
    ("Flood in Mozambique", "Rivers rose.", "https://x.org/a", "ReliefWeb", "high", None, None, "2019", "Beira", False),
    ("News from Beira", "Rivers rose.", "https://x.org/a", "Local Paper", "high", None, None, "2019", "Beira", False),
    ("News from Beira", "Rivers rose.", "https://x.org/a", "Local Paper", "high", "local_hazard_in_text", None, "2019", "Beira", True),
    ("Flood in Beira", None, None, "Local Paper", "high", None, None, "2021", "Beira", False),
    ("Flood in Beira", None, None, "Local Paper", "high", None, None, "2020", "Beira", False),
    ("Flood in Beira", None, None, "Local Paper", "high", "event_month_present", None, "2020", "Beira", True),
    ("Flood in Beira", None, None, "Local Paper", "high", None, "generic_title", "2019", "Beira", False),
    (None, None, None, None, None, None, None, None, None, False),
]


@query("summary_gate", f"SELECT doc_id, {_picked('doc_id', [c[-1] for c in CASES])} AS kept FROM documents")
def summary_gate(spark, d):
    k = F.col("doc_id")
    names = ("title", "body", "url", "source", "confidence", "reason", "penalty", "published", "place")
    case = {n: pick(k, [c[i] for c in CASES]) for i, n in enumerate(names)}
    listed = lambda n: F.when(case[n].isNotNull(), F.array(case[n]))
    kept = summaries.may_be_summarised(
        case["title"], case["body"], case["url"], case["source"], case["confidence"], listed("reason"), listed("penalty"), case["published"],
        summaries.event_year(F.lit("14 March 2019"), F.lit(None).cast("string")), F.lit("Flood (general)"), summaries.location_terms(case["place"]), summaries.country_terms(F.lit("Mozambique")))
    return t(spark, d, "documents").select("doc_id", kept.alias("kept"))


PLACES = ["near Sofala province, Beira city", "Lima and Cusco; northern", "Viet Nam (Hue)", "in Oruro / ab", None, "nan"]
PLACE_TERMS = ["Sofala|Beira", "Lima|Cusco|northern", "Viet Nam|Hue", "Oruro", "", ""]
SPECIFIC = ["Sofala|Beira", "Lima|Cusco", "Hue", "Oruro", "", ""]
LANDS = ["Viet Nam", "Bolivia (Plurinational State of)", "", "Peru"]
LAND_TERMS = ["Viet Nam|Vietnam", "Bolivia (Plurinational State of)|Bolivia", "", "Peru"]
TYPES = ["Flood (general)", "Wildfire", "Mass movement (dry)", "Volcanic activity", None]
TYPE_TERMS = ["flood|flooding|inundation|overflow|heavy rain", "fire|blaze|burned", "landslide|mudslide|rockslide|debris flow", "volcanic activity", ""]


@query("event_terms", f"""
SELECT p_partkey, {_picked('p_partkey', PLACE_TERMS)} AS places, {_picked('p_partkey', SPECIFIC)} AS "specific", {_picked('p_partkey', LAND_TERMS)} AS lands, {_picked('p_partkey', TYPE_TERMS)} AS hazards FROM part""")
def event_terms(spark, d):
    k = F.col("p_partkey")
    places, lands = summaries.location_terms(pick(k, PLACES)), summaries.country_terms(pick(k, LANDS))
    own = summaries.specific_terms(places, summaries.country_terms(F.lit("Viet Nam")))
    text = lambda c: F.array_join(c, "|")
    return t(spark, d, "part").select("p_partkey", text(places).alias("places"), text(own).alias("specific"), text(lands).alias("lands"), text(summaries.hazard_terms(pick(k, TYPES))).alias("hazards"))


# --- sources and tokens -----------------------------------------------------------------------------------------


@query("source_groups", """
WITH a AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source WHEN 1 THEN upper(source) || ' (x)' WHEN 2 THEN 'duckduckgo Local' ELSE 'other' END AS s, doc_id % 3 = 0 AS one, doc_id % 5 = 0 AS two FROM documents),
n AS (SELECT *, regexp_replace(lower(coalesce(s, '')), ' \\(x\\)$', '') AS low FROM a)
SELECT doc_id, CASE WHEN low = 'duckduckgo local' THEN 'fallback_sources' WHEN low = 'src1' THEN 'global_sources' WHEN low = 'src2' THEN 'regional_sources' WHEN one AND two THEN NULL WHEN one THEN 'global_sources' WHEN two THEN 'regional_sources' END AS "group",
  CASE WHEN low = 'duckduckgo local' THEN 'DuckDuckGo' WHEN low IN ('src1', 'src2') THEN low WHEN one AND two THEN coalesce(s, '') WHEN one THEN 'src1' WHEN two THEN 'src2' ELSE coalesce(s, '') END AS source FROM n""")
def source_groups(spark, d):
    k = F.col("doc_id")
    source = F.when(k % 4 == 0, F.col("source")).when(k % 4 == 1, F.concat(F.upper("source"), F.lit(" (x)"))).when(k % 4 == 2, "duckduckgo Local").otherwise("other")
    url = F.concat(F.lit("u"), k.cast("string"))
    searched = F.create_map(F.lit("src1"), F.lit("global_sources"), F.lit("src2"), F.lit("regional_sources"))
    at = lambda name, n: F.struct(F.lit(name).alias("name"), F.when(k % n == 0, url).otherwise("elsewhere").alias("url"))
    out = publishing.source_group(source, url, searched, F.array(at("src1", 3), at("src2", 5)))
    return t(spark, d, "documents").select("doc_id", out["group"].alias("group"), out["source"].alias("source"))


@query("token_usage", """
WITH c AS (SELECT conv_id, turn, text, length(text) AS n, CASE turn % 4 WHEN 0 THEN 'dry_run' WHEN 1 THEN 'failed' ELSE 'called' END AS st, CASE WHEN turn % 3 = 0 THEN turn END AS rec, CASE WHEN conv_id % 2 = 0 THEN 7 END AS cnt FROM conversations WHERE lower(trim(text)) NOT IN ('', 'none', 'null', 'nan', 'nat')),
i AS (SELECT *, CASE WHEN st = 'dry_run' THEN 0 WHEN rec IS NOT NULL THEN rec WHEN st = 'called' THEN cnt END AS inp, CASE st WHEN 'dry_run' THEN 0 WHEN 'called' THEN 2 END AS outp FROM c)
SELECT conv_id, turn, inp::BIGINT AS input_tokens, outp::BIGINT AS output_tokens, CASE st WHEN 'dry_run' THEN 0 WHEN 'called' THEN inp + 2 END::BIGINT AS total_tokens,
  CASE WHEN st = 'dry_run' THEN 'not_called' WHEN rec IS NOT NULL THEN 'recorded' WHEN st = 'called' AND cnt IS NOT NULL THEN 'retokenized_saved_prompt' END AS input_method,
  CASE WHEN st = 'called' AND inp IS NULL THEN ceil(length(trim(text)) / 4.0)::BIGINT END AS estimated_input FROM i""")
def token_usage(spark, d):
    c = t(spark, d, "conversations").filter("lower(trim(text)) not in ('', 'none', 'null', 'nan', 'nat')")
    k, none = F.col("turn") % 4, F.lit(None).cast("string")
    status = F.when(k == 0, "dry_run").when(k == 1, "failed").otherwise("called")
    recorded = {"input": F.when(F.col("turn") % 3 == 0, F.col("turn")), "output": none, "total": none}
    counted = {"input": F.when(F.col("conv_id") % 2 == 0, 7), "output": F.lit(2)}
    out = publishing.token_usage(status, recorded, none, "text", "text", none, counted)
    return c.select("conv_id", "turn", *[out[n].alias(n) for n in ("input_tokens", "output_tokens", "total_tokens", "input_method", "estimated_input")])


# --- units without boxes ----------------------------------------------------------------------------------------


@query("unmatched_diagnosis", """
WITH u AS (SELECT o_custkey AS k, o_orderkey, o_orderkey % 4 AS lv, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS id, o_orderstatus AS name, o_orderkey % 3 = 0 AS gadm FROM orders),
a AS (SELECT k, count(*) FILTER (lv = 2) AS source_rows, count(*) FILTER (lv = 2 AND gadm AND id IS NOT NULL) AS id_rows, string_agg(DISTINCT lv::VARCHAR, ' | ' ORDER BY lv::VARCHAR) AS source_levels FROM u GROUP BY k),
f AS (SELECT k, string_agg(id, ' | ' ORDER BY p) AS unit_ids FROM (SELECT k, id, min(o_orderkey) AS p FROM u WHERE lv = 2 AND id IS NOT NULL GROUP BY k, id) GROUP BY k),
g AS (SELECT k, string_agg(name, ' | ' ORDER BY p) AS unit_names FROM (SELECT k, name, min(o_orderkey) AS p FROM u WHERE lv = 2 GROUP BY k, name) GROUP BY k),
m AS (SELECT k, count(*) AS n FROM u WHERE lv = 2 AND o_orderkey % 7 = 0 GROUP BY k)
SELECT c_custkey AS event, 'N' || c_nationkey AS iso, coalesce(source_levels, '') AS source_levels, coalesce(source_rows, 0) AS source_rows, coalesce(id_rows, 0) AS id_rows, coalesce(source_rows - id_rows, 0) AS name_only_rows, coalesce(m.n, 0) AS matched_rows, c_nationkey % 3 > 0 AS has_file,
  coalesce(unit_ids, '') AS unit_ids, coalesce(unit_names, '') AS unit_names,
  CASE WHEN coalesce(source_rows, 0) = 0 THEN 'no_adm2_source_rows' WHEN c_nationkey % 3 = 0 THEN 'missing_gadm_adm2_file' WHEN m.n > 0 THEN 'matched_adm2_not_in_remaining_set' WHEN id_rows > 0 THEN 'unmatched_gadm_ids' ELSE 'unmatched_adm2_names' END AS category
FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN f ON f.k = c_custkey LEFT JOIN g ON g.k = c_custkey LEFT JOIN m ON m.k = c_custkey""")
def unmatched_diagnosis(spark, d):
    k = F.col("o_orderkey")
    units = t(spark, d, "orders").select(
        F.col("o_custkey").alias("event"), k.alias("place"), (k % 4).cast("string").alias("unit_level"), F.when(k % 5 > 0, F.col("o_orderpriority")).alias("unit_id"),
        F.col("o_orderstatus").alias("unit_name"), F.when(k % 3 == 0, "GADM Admin Units").otherwise("Admin Units").alias("source_field"), F.when(k % 7 == 0, "matched").otherwise("unmatched").alias("match_status"))
    events = t(spark, d, "customer").select(F.col("c_custkey").alias("event"), F.concat(F.lit(" n"), F.col("c_nationkey").cast("string")).alias("iso"))
    files = t(spark, d, "nation").filter("n_nationkey % 3 > 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("iso"))
    return geocoding.unmatched_diagnosis(events, units.drop("match_status"), units.select("event", "unit_level", "match_status"), files, "event", "place")


# --- answers of weather services --------------------------------------------------------------------------------


@query("weather_bodies", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 21 END AS archive_days, CASE WHEN event_id % 3 = 0 AND value >= 0 THEN value END AS rain, CASE WHEN event_id % 3 = 0 THEN (event_id % 40)::DOUBLE END AS warm, NULL::DOUBLE AS filled,
  CASE WHEN event_id % 3 = 1 AND event_id % 7 > 0 THEN 21 END AS power_days, CASE WHEN event_id % 3 = 1 AND event_id % 7 > 0 THEN (event_id % 7 - 10)::DOUBLE END AS power_warm, CASE WHEN event_id % 3 = 1 AND event_id % 7 > 0 THEN 3.0::DOUBLE END AS power_sum FROM events""")
def weather_bodies(spark, d):
    k, day = F.col("event_id"), F.to_date("ts")
    near = F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda i: F.date_add(day, i).cast("string"))
    number = lambda c: c.cast("double")
    archive = F.to_json(F.struct(F.struct(near.alias("time"), F.array(number(F.col("value")), F.lit(-1.0), F.lit(2.0)).alias("rain_sum"), F.array(number(k % 40), F.lit(-999.0), F.lit(1.0)).alias("temperature_2m_max")).alias("daily")))
    key = F.date_format(day, "yyyyMMdd")
    values = F.struct(F.create_map(key, F.lit(3.0)).alias("PRECTOTCORR"), F.create_map(key, number(k % 7 - 10)).alias("T2M_MAX"))
    power = F.to_json(F.struct(F.struct(F.lit(-10.0).alias("fill_value")).alias("header"), F.struct(values.alias("parameter")).alias("properties")))
    body = F.when(k % 3 == 0, archive).when(k % 3 == 1, power).otherwise("no answer")
    days = dates.calendar(day)
    # Answers take far more work than the bytes of their rows let Spark's scan expect.
    rows = t(spark, d, "events").select("event_id", "ts", "value").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    got = rows.select("event_id", weather.archive_series(body, days).alias("a"), weather.power_series(body, days).alias("p"))
    at = lambda s, i, n: F.get(F.col(s), F.lit(i))[n]
    return got.select(
        "event_id", F.when(F.col("a").isNotNull(), F.size("a")).alias("archive_days"), at("a", 9, "rain_sum").alias("rain"), at("a", 9, "temperature_2m_max").alias("warm"), at("a", 10, "temperature_2m_max").alias("filled"),
        F.when(F.col("p").isNotNull(), F.size("p")).alias("power_days"), at("p", 10, "temperature_2m_max").alias("power_warm"), at("p", 10, "precipitation_sum").alias("power_sum"))
