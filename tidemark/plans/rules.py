"""Queries that run single rules over the driver's tables, and their SQL.

Where a rule takes texts that the tables don't have, rows get them by number, in the query and in its SQL alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import clean, dates, geo, text
from tidemark.operators import geocoding, news, ordered, reasoning, satellite, searching, weather
from tidemark.plans.queries import query, t
from tidemark.plans.registry import ORACLES


def pick(k: Column, values: list) -> Column:
    """The value whose place is k modulo their number."""
    return F.get(F.array(*map(F.lit, values)), (k % len(values)).cast("int"))


def _sql(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values) + "]"


def _picked(k: str, values: list) -> str:
    return f"{_sql(values)}[{k} % {len(values)} + 1]"


# --- dates ------------------------------------------------------------------------------------------------------

_MADE = "try_cast(printf('%04d-%02d-%02d', y, {m}, {d}) AS DATE)"


@query("date_parts", f"""
WITH p AS (SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 13 ELSE month(o_orderdate) END::INTEGER AS m,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 31 + 1 END::INTEGER AS d, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'soon' ELSE '' END AS direct FROM orders),
q AS (SELECT *, {_MADE.format(m='m', d='d')} AS lenient, {_MADE.format(m='coalesce(m, 1)', d='coalesce(d, 1)')} AS filled FROM p)
SELECT o_orderkey, lenient, coalesce(try_cast(direct AS DATE), filled) AS defaulting, CASE WHEN direct <> '' THEN try_cast(direct AS DATE) ELSE lenient END AS known,
  CASE WHEN m BETWEEN 1 AND 12 AND d <= 28 THEN lenient END AS strict FROM q""")
def date_parts(spark, d):
    k = F.col("o_orderkey")
    o = t(spark, d, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("string").alias("y"), F.when(k % 7 == 0, None).when(k % 11 == 0, "13").otherwise(F.month("o_orderdate").cast("string")).alias("m"),
        F.when(k % 5 != 0, (k % 31 + 1).cast("string")).alias("d"), F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 3 == 1, "soon").otherwise("").alias("direct"))
    real = F.col("m").cast("int").between(1, 12) & (F.col("d").cast("int") <= 28)
    strict = dates.date_strict(F.when(real, F.col("y")), F.when(real, F.col("m")), F.when(real, F.col("d")))
    return o.select("o_orderkey", dates.date_lenient("y", "m", "d").alias("lenient"), dates.date_defaulting("direct", "y", "m", "d").alias("defaulting"), dates.date_known("direct", "y", "m", "d").alias("known"), strict.alias("strict"))


@query("date_windows", """
SELECT o_orderkey, (o_orderdate::DATE - 10) AS first_day, (o_orderdate::DATE + 10) AS last_day, 21 AS days, (o_orderdate::DATE - 10) AS day_1, strftime(o_orderdate::DATE - 10, '%Y%m%d') || '000000' AS stamp_from,
  strftime(o_orderdate::DATE + 60, '%Y%m%d') || '235959' AS stamp_to, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' AS span_from, strftime(o_orderdate, '%Y-%m-%d') || 'T23:59:59Z' AS span_to,
  year(o_orderdate)::VARCHAR AS year, strftime(o_orderdate, '%B') AS month_name, 3 AS between_days FROM orders""")
def date_windows(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    first, last = dates.window("day", 10, 10)
    stamps, span, p = dates.compact_stamps("day"), dates.day_span("day"), dates.parts(F.date_format("day", "yyyy-MM-dd"))
    return o.select(
        "o_orderkey", first.alias("first_day"), last.alias("last_day"), F.size(dates.calendar("day")).alias("days"), F.get(dates.calendar("day"), F.lit(0)).alias("day_1"), stamps[0].alias("stamp_from"), stamps[1].alias("stamp_to"),
        span[0].alias("span_from"), span[1].alias("span_to"), p["year"].alias("year"), p["month_name"].alias("month_name"), F.size(dates.calendar_between("day", F.date_add("day", 2))).alias("between_days"))


@query("publication_dates", """
WITH e AS (SELECT event_id, date_trunc('second', ts) AS ts, event_id % 6 AS form FROM events)
SELECT event_id, CASE WHEN form IN (0, 1, 2) THEN ts WHEN form IN (3, 4) THEN ts::DATE::TIMESTAMP END AS published,
  CASE WHEN form <= 2 THEN abs(floor((epoch(ts)::BIGINT - epoch(TIMESTAMP '2024-01-10 12:00:00')::BIGINT) / 86400.0))::BIGINT WHEN form <= 4 THEN abs(floor((epoch(ts::DATE::TIMESTAMP)::BIGINT - epoch(TIMESTAMP '2024-01-10 12:00:00')::BIGINT) / 86400.0))::BIGINT END AS days_away,
  form = 1 AS wrong FROM e""")
def publication_dates(spark, d):
    e = t(spark, d, "events").select("event_id", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"), (F.col("event_id") % 6).alias("form"))
    day = lambda f: F.date_format("ts", f)
    form = lambda n, v: F.when(F.col("form") == n, v)
    said = F.coalesce(
        form(0, F.concat(day("EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))), form(1, F.concat(day("yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123Z"))), form(2, day("yyyy-MM-dd HH:mm:ss")),
        form(3, day("yyyy-MM-dd")), form(4, day("dd MMM yyyy")), F.lit("some day"))
    p = dates.published(said)
    title = F.when(F.col("form") == 1, "Floods of 2011").otherwise("Floods of 2024")
    wrong = dates.wrong_year(title, F.lit("https://x.org/2011-2012/a"), F.lit("2024"))
    return e.select("event_id", p.cast("timestamp_ntz").alias("published"), dates.day_distance(p, F.lit("2024-01-10 12:00:00").cast("timestamp")).alias("days_away"), wrong.alias("wrong"))


# --- texts ------------------------------------------------------------------------------------------------------

TITLES = ["Floods in the City of Ala - Daily News", "<b>Storm</b> hits island | The Times of Ala", "Rain - up", "", "Quake in A and B areas", "No outlet here", "Too-long - " + "x" * 70]


@query("text_keys", rf"""
WITH r AS (SELECT p_partkey, {_picked('p_partkey', TITLES)} || ' ' || p_name AS v FROM part),
k AS (SELECT *, trim(regexp_replace(lower(v), '[^a-z0-9]+', ' ', 'g')) AS plain FROM r),
s AS (SELECT *, trim(regexp_replace(lower(regexp_replace(trim(regexp_replace(v, '<[^>]+>', '', 'g')), '\s*[-|]\s*[^-|]{{3,60}}$', '')), '[^a-z0-9]+', ' ', 'g')) AS title FROM k)
SELECT p_partkey, plain, title, array_to_string(list_filter(string_split(plain, ' '), lambda w: w NOT IN {tuple(text.ENTITY_STOPS)}), ' ') AS entity, replace(plain, ' ', '') AS compact,
  substr(sha1(v), 1, 12) AS short_hash, contains(' ' || plain || ' ', ' rain ') AS rain FROM s""")
def text_keys(spark, d):
    r = t(spark, d, "part").select("p_partkey", F.concat(pick(F.col("p_partkey"), TITLES), F.lit(" "), "p_name").alias("v"))
    return r.select("p_partkey", text.plain_key("v").alias("plain"), text.title_key("v").alias("title"), text.event_key("v").alias("entity"), text.compact_key("v").alias("compact"), text.hash12("v").alias("short_hash"), text.mentions("v", F.lit("Rain")).alias("rain"))


PLACES = ["Ala province", "The Ala isl. (near Bela)", "near the town of Ola area", "Ala, Bela and Cora provinces", "A in B", "City of Light", "Nationwide", "ab"]
BARE = ["Ala province", "The Ala isl.", "Ola", "Ala, Bela and Cora provinces", "A in B", "City of Light", "Nationwide", "ab"]
NO_UNIT = ["Ala", "The Ala isl. (near Bela)", "near the of Ola area", "Ala, Bela and Cora", "A in B", "of Light", "Nationwide", "ab"]
PARTS = ["", "Bela", "", "Ala province|Bela province|Cora province", "A|B", "", "", ""]


@query("place_rules", f"""
SELECT c_custkey, {_picked('c_custkey', BARE)} AS bare, {_picked('c_custkey', NO_UNIT)} AS no_unit, {_picked('c_custkey', PARTS)} AS parts,
  CASE c_custkey % 8 WHEN 6 THEN 'generic_place' WHEN 7 THEN 'too_short' WHEN 2 THEN 'approximate' WHEN 1 THEN 'approximate' ELSE '' END AS reasons,
  CASE WHEN c_custkey % 8 IN (6, 7) THEN 'review' ELSE 'usable' END AS quality FROM customer""")
def place_rules(spark, d):
    c = t(spark, d, "customer").select("c_custkey", pick(F.col("c_custkey"), PLACES).alias("p"))
    return c.select("c_custkey", text.bare_place("p").alias("bare"), text.without_units("p").alias("no_unit"), F.array_join(text.composite_parts("p"), "|").alias("parts"), text.place_reasons("p").alias("reasons"), text.place_quality("p").alias("quality"))


LANDS = ["Viet Nam", "Italy", "Türkiye"]


@query("query_variants", f"""
WITH r AS (SELECT c_custkey, c_custkey % 4 AS p, {_picked('c_custkey', LANDS)} AS c FROM customer), a AS (SELECT *, CASE c WHEN 'Viet Nam' THEN ['Vietnam'] WHEN 'Türkiye' THEN ['Turkey'] ELSE [] END AS o FROM r)
SELECT c_custkey, array_to_string(CASE p WHEN 0 THEN ['Ala province, ' || c, 'Ala, ' || c] || list_transform(o, lambda x: 'Ala province, ' || x) || list_transform(o, lambda x: 'Ala, ' || x) WHEN 1 THEN list_transform([c] || o, lambda x: 'Bela, ' || x)
  WHEN 2 THEN list_transform([c] || o, lambda x: 'Cora isl., ' || x) || ['Cora Island, ' || c, 'Cora, ' || c] || list_transform(o, lambda x: 'Cora Island, ' || x) || list_transform(o, lambda x: 'Cora, ' || x) ELSE [c] END, '|') AS queries,
  CASE WHEN p = 3 THEN 'original' WHEN p = 1 AND len(o) = 0 THEN 'original' WHEN p = 1 THEN 'place_country' ELSE 'without_admin_qualifier' END AS last_label FROM a""")
def query_variants(spark, d):
    k = F.col("c_custkey")
    c = t(spark, d, "customer").select("c_custkey", pick(k, ["Ala province", "Bela", "Cora isl.", ""]).alias("p"), pick(k, LANDS).alias("c"))
    v = text.with_query_variants(c, "p", "c")
    return v.select("c_custkey", F.array_join(F.transform("variants", lambda x: x["query"]), "|").alias("queries"), F.element_at("variants", -1)["label"].alias("last_label"))


# --- articles ---------------------------------------------------------------------------------------------------

SOURCES = ["Google News (BBC)", "Google News (FloodList)", "Google News Local", "ReliefWeb Africa", "FloodList", "BBC", "Wikipedia", "DuckDuckGo Local", "GDELT DOC 2.0", "GDACS", "", "WMO x"]
FAMILIES = ["BBC", "FloodList", "Google News", "ReliefWeb", "FloodList", "BBC", "Wikipedia", "DuckDuckGo", "GDELT DOC 2.0", "GDACS", "", "WMO"]
RANKS = [30, 30, 30, 95, 100, 50, 70, 20, 65, 86, 50, 84]
LEAST = [6, 6, 6, 4, 5, 4, 7, 6, 6, 4, 4, 4]


@query("news_sources", f"SELECT doc_id, {_picked('doc_id', FAMILIES)} AS family, {_picked('doc_id', RANKS)} AS priority, {_picked('doc_id', LEAST)} AS threshold FROM documents")
def news_sources(spark, d):
    s = t(spark, d, "documents").select("doc_id", pick(F.col("doc_id"), SOURCES).alias("s"))
    return s.select("doc_id", news.source_family("s").alias("family"), news.source_priority("s").alias("priority"), news.source_threshold("s", F.lit("high")).alias("threshold"))


REASONS, PENALTIES = ["event_name_in_title", "local_place_in_title", "hazard_in_title", "event_year_present"], ["generic_title", "missing_hazard_term", "different_year_in_title"]
_SCORED = f"""SELECT doc_id, {_picked('doc_id', SOURCES)} AS s, n_chars % 14 AS score, {_picked('doc_id // 3', REASONS)} AS r, CASE WHEN n_chars % 3 = 0 THEN {_picked('doc_id', PENALTIES)} END AS p, doc_id % 17 = 0 AS listed FROM documents"""


@query("news_confidence", f"""
WITH a AS ({_SCORED}), b AS (SELECT *, r IN ('event_name_in_title', 'local_place_in_title') AS strong, coalesce(p IN ('generic_title', 'different_year_in_title'), false) AS risky FROM a)
SELECT doc_id, CASE WHEN listed THEN 'low' WHEN score >= 9 AND strong AND p IS NULL THEN 'high'
  WHEN regexp_matches(s, '^(ReliefWeb|GDACS|IFRC GO|FloodList)') THEN CASE WHEN score >= 7 AND NOT risky THEN 'high' ELSE 'medium' END
  WHEN risky THEN 'low' WHEN regexp_matches(s, '^(Google News|DuckDuckGo|Wikipedia)') THEN CASE WHEN score >= 8 AND strong THEN 'high' ELSE 'medium' END
  WHEN score >= 8 THEN 'high' ELSE 'medium' END AS confidence, CASE WHEN score < 5 THEN '<5' WHEN score <= 6 THEN '5-6' WHEN score <= 8 THEN '7-8' ELSE '9+' END AS bucket FROM b""")
def news_confidence(spark, d):
    k, n = F.col("doc_id"), F.col("n_chars")
    penalties = F.when(n % 3 == 0, F.array(pick(k, PENALTIES))).otherwise(F.array().cast("array<string>"))
    a = t(spark, d, "documents").select("doc_id", pick(k, SOURCES).alias("s"), (n % 14).alias("score"), F.array(pick(F.floor(k / 3), REASONS)).alias("r"), penalties.alias("p"), (k % 17 == 0).alias("listed"))
    return a.select("doc_id", news.confidence("s", F.col("score"), F.lit(5), F.col("r"), F.col("p"), F.col("listed")).alias("confidence"), news.score_bucket("score").alias("bucket"))


URLS = ["https://x.org/a", "http://x.org/b.PDF", "ftp://x.org", "https://news.google.com/rss/articles/q", "", None]
KINDS = ["text/html; charset=utf-8", "image/png", "Text/Plain", None]


@query("article_text_status", f"""
WITH a AS (SELECT doc_id, text, {_picked('doc_id', URLS)} AS u, {_picked('doc_id // 7', KINDS)} AS kind, doc_id % 13 = 0 AS done, doc_id % 11 = 0 AS lost, doc_id % 19 = 0 AS consent, doc_id % 23 = 0 AS listed FROM documents)
SELECT doc_id, CASE WHEN done THEN 'fetched_full_text' WHEN u = 'https://news.google.com/rss/articles/q' THEN 'skipped_google_news_redirect' WHEN u IS DISTINCT FROM 'https://x.org/a' OR listed THEN 'skipped'
  WHEN lost THEN 'fetch_failed' WHEN consent THEN 'blocked_or_consent_page' WHEN kind IS NULL OR kind = 'image/png' THEN 'unsupported_content_type'
  WHEN coalesce(length(text), 0) < 500 THEN 'kept_original' ELSE 'fetched_full_text' END AS status FROM a""")
def article_text_status(spark, d):
    k = F.col("doc_id")
    a = t(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), pick(k, URLS).alias("u"), pick(F.floor(k / 7), KINDS).alias("kind"), F.when(k % 13 == 0, "fetched_full_text").otherwise("").alias("was"))
    page = F.when(k % 11 != 0, F.when(k % 19 == 0, "Before you continue to the site").otherwise("<p>x</p>"))
    return a.select("doc_id", news.text_status("was", "u", k % 23 == 0, page, "u", "kind", F.col("text"), F.lit("short")).alias("status"))


@query("final_articles", f"""
WITH a AS (SELECT doc_id, {_picked('doc_id', SOURCES)} AS s, {_picked('doc_id // 5', ['List of  floods', 'A flood', 'Timeline of x'])} AS title, ['high', 'medium', 'low'][n_chars % 3 + 1] AS conf, n_chars % 2 = 0 AS lost, n_chars % 5 = 0 AS fetched FROM documents)
SELECT doc_id FROM a WHERE NOT (starts_with(s, 'Google News') AND (conf = 'low' OR (lost AND NOT fetched))) AND NOT (s = 'Wikipedia' AND (title <> 'A flood' OR (conf = 'low' AND lost)))""")
def final_articles(spark, d):
    k, n = F.col("doc_id"), F.col("n_chars")
    a = t(spark, d, "documents").select(
        "doc_id", pick(k, SOURCES).alias("source"), pick(F.floor(k / 5), ["List of  floods", "A flood", "Timeline of x"]).alias("title"), F.lit("https://x.org/a").alias("url"), pick(n, ["high", "medium", "low"]).alias("confidence"),
        F.when(n % 2 == 0, F.array(F.lit("missing_local_or_event_context"))).otherwise(F.array().cast("array<string>")).alias("penalties"), F.when(n % 5 == 0, "fetched_full_text").otherwise("skipped").alias("raw_text_status"))
    return news.kept_after_filter(a).select("doc_id")


@query("fetch_budget", """
SELECT doc_id, coalesce(sum((n_chars % 3 = 0)::INTEGER) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 5 AS fetch_allowed FROM documents""")
def fetch_budget(spark, d):
    a = t(spark, d, "documents").select("doc_id", F.col("source").alias("event"), F.when(F.col("n_chars") % 3 == 0, "fetch_failed").otherwise("skipped").alias("status"))
    return news.counted_fetches(a, "event", "doc_id", "status", ["fetch_failed", "fetched_full_text"]).select("doc_id", "fetch_allowed")


# --- positions --------------------------------------------------------------------------------------------------

TYPES = ["administrative", "university", "city", "river", "historic", "cemetery", "parking", "company", "building", "Village", None]


@query("review_decisions", f"""
WITH a AS (SELECT c_custkey AS k, {_picked('c_custkey', TYPES)} AS ty, {_picked('c_custkey // 11', ['Kindi Province', 'Italy', 'Kindi'])} AS q, (c_custkey % 9) / 100.0::DOUBLE AS w, c_custkey % 29 = 0 AS lost, c_custkey % 4 = 0 AS empty FROM customer),
b AS (SELECT *, q = 'Italy' AND empty AS country_only, q = 'Kindi Province' AND w < 0.05 AS small FROM a)
SELECT k, country_only, small, CASE WHEN lost THEN 'missing_coordinates' WHEN country_only THEN 'country_fallback_empty_location' WHEN ty IN ('university', 'cemetery', 'building') THEN 'poi_or_non_geographic_type'
  WHEN ty = 'administrative' AND small THEN 'small_bbox_for_admin_query' WHEN ty = 'administrative' THEN 'admin_or_area_result' WHEN ty IN ('city', 'Village') THEN 'populated_or_local_place'
  WHEN ty = 'river' THEN 'natural_geographic_feature' WHEN ty = 'historic' THEN 'historic_region_like_result' ELSE 'unsupported_place_type' END AS bucket FROM b""")
def review_decisions(spark, d):
    k = F.col("c_custkey")
    a = t(spark, d, "customer").select(
        k.alias("k"), pick(k, TYPES).alias("ty"), pick(F.floor(k / 11), ["Kindi Province", "Italy", "Kindi"]).alias("q"), ((k % 9) / 100.0).alias("w"), F.when(k % 29 != 0, F.lit(1.0)).alias("lat"), F.when(k % 4 == 0, "nan").otherwise("Rome").alias("location"))
    only, small = geocoding.country_only("q", F.lit("Italy"), "location"), geocoding.small_area_box("q", "w", "w")
    return a.select("k", only.alias("country_only"), small.alias("small"), geocoding.review_decision(F.col("lat"), F.lit(2.0), F.col("ty"), only, small)["bucket"].alias("bucket"))


@query("position_status", """
SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'direct_coordinates' WHEN c_custkey % 3 = 0 THEN 'gadm_or_admin_units' WHEN c_custkey % 5 > 1 THEN 'location_text_only' ELSE 'missing_location' END AS status FROM customer""")
def position_status(spark, d):
    k = F.col("c_custkey")
    lat, place = F.when(k % 4 == 0, "12.5").otherwise("x"), pick(k, ["nan", "[]", "Rome", "Ala", "Ola"])
    return t(spark, d, "customer").select(k.alias("k"), geocoding.status(lat, F.lit("1"), k % 3 == 0, place).alias("status"))


# --- chains and answers -----------------------------------------------------------------------------------------

_STEP = '{"type_event": "heavy rain", "description": "d", "supporting_quote": "q"}'
ANSWERS = ["```json " + '{"causal_chain": [' + _STEP + ", " + _STEP + "]} ```", '{"causal_chain": [1, ' + _STEP + "]}", '{"causal_chain": [{"type_event": ""}]}', '{"a": 1}', "none", '{"causal_chain": "x"}', '{"causal_chain": []}', "{broken"]
STATUSES = ["parsed", "parsed_with_dropped_items", "empty_chain", "missing_causal_chain", "invalid_json", "missing_causal_chain", "empty_chain", "invalid_json"]
STEPS = [2, 1, 0, 0, 0, 0, 0, 0]
SUMMARIES = ["```text Summary: It rained. ```", "It rained.", "nan", "The provided news articles primarily focus on sport", "INSUFFICIENT_INFORMATION"]
SUMMARY_STATUSES = ["accepted", "accepted", "insufficient_information_from_llm", "rejected_unrelated_news_admission", "insufficient_information_from_llm"]


@query("answers", f"""
SELECT conv_id, turn, {_picked('(conv_id + turn)', STATUSES)} AS status, {_picked('(conv_id + turn)', STEPS)} AS steps, CASE WHEN (conv_id + turn) % 8 < 2 THEN 'Extreme Precipitation' END AS first_type,
  {_picked('(conv_id + turn)', SUMMARY_STATUSES)} AS summary_status, CASE WHEN (conv_id + turn) % 5 < 2 THEN 'It rained.' ELSE 'INSUFFICIENT_INFORMATION' END AS summary FROM conversations""")
def answers(spark, d):
    k = F.col("conv_id") + F.col("turn")
    p = reasoning.parsed_chain(pick(k, ANSWERS))
    s = reasoning.summary_status(reasoning.cleaned_summary(pick(k, SUMMARIES)), F.lit("called"), F.lit("pending"))
    return t(spark, d, "conversations").select(
        "conv_id", "turn", p["status"].alias("status"), F.size(p["chain"]).alias("steps"), F.get(p["chain"], F.lit(0))["type_event"].alias("first_type"), s["status"].alias("summary_status"), s["summary"].alias("summary"))


@query("supported_steps", r"""
WITH a AS (SELECT conv_id, turn, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS body, turn % 3 AS kind FROM conversations)
SELECT conv_id, turn, CASE WHEN kind = 0 OR length(body) < 30 THEN 'parsed' WHEN kind = 1 THEN 'parsed_with_dropped_unsupported_quotes' ELSE 'empty_chain_after_quote_validation' END AS status,
  CASE WHEN length(body) < 30 THEN 0 WHEN kind = 2 THEN 0 ELSE 1 END AS steps, CASE WHEN length(body) < 30 THEN 0 WHEN kind = 0 THEN 0 ELSE 1 END AS dropped_quotes, 0 AS fuzzy_quotes FROM a""")
def supported_steps(spark, d):
    body = clean.collapse("text")
    step = lambda q: F.struct(F.lit(1).alias("n_event"), F.lit("Flood").alias("type_event"), F.lit("d").alias("description"), q.alias("supporting_quote"))
    mine, other = step(F.substring(body, 5, 20)), step(F.lit("0123 4567 89ab 0123 4567"))
    none = F.array().cast(reasoning.STEP)
    chain = F.when(F.length(body) < 30, none).when(F.col("turn") % 3 == 0, F.array(mine)).when(F.col("turn") % 3 == 1, F.array(other, mine)).otherwise(F.array(other)).cast(reasoning.STEP)
    rows = t(spark, d, "conversations").select("conv_id", "turn", chain.alias("chain"), F.lit("parsed").alias("status"), F.array(F.coalesce("text", F.lit(""))).alias("texts"))
    return reasoning.with_supported_steps(rows, "chain", "status", "texts").select("conv_id", "turn", "status", F.size("chain").alias("steps"), "dropped_quotes", "fuzzy_quotes")


TERMS = ["flood", "a", "rain 5", "storm storm", "disaster", "наводнение", "flood наводнение", "heeeavy rain", "one two three four five six seven", "x" * 61]
TERM_REASONS = ["", "too_short", "contains_number", "repeated_words", "generic", "", "mixed_scripts", "repeated_letters", "too_many_words", "too_long,repeated_letters"]


@query("term_reasons", f"SELECT p_partkey, {_picked('p_partkey', TERM_REASONS)} AS reasons, p_partkey % 10 NOT IN (5) AS latin, p_partkey % 10 IN (5, 6) AS other FROM part")
def term_reasons(spark, d):
    term = pick(F.col("p_partkey"), TERMS)
    return t(spark, d, "part").select("p_partkey", searching.term_reasons(term).alias("reasons"), text.has_latin(term).alias("latin"), text.has_other_script(term).alias("other"))


# --- weather, scenes, boxes -------------------------------------------------------------------------------------


@query("upsert_best", """
WITH u AS (SELECT event_id % 500 AS k, event_id, CASE WHEN value > 30 THEN value END AS value, 0 AS new FROM events WHERE event_id % 2 = 0 AND event_id < 500 UNION ALL SELECT event_id % 500, event_id, CASE WHEN value > 30 THEN value END, 1 FROM events WHERE event_id >= 500 AND event_id < 800)
SELECT k, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY coalesce(value, -1) DESC, new DESC) AS n FROM u) WHERE n = 1""")
def upsert_best(spark, d):
    e = t(spark, d, "events").select((F.col("event_id") % 500).alias("k"), "event_id", F.when(F.col("value") > 30, F.col("value")).alias("value"))
    return weather.upsert_best(e.filter("event_id % 2 = 0 and event_id < 500"), e.filter("event_id between 500 and 799"), "k", "value")


@query("layers", """
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 AND s_suppkey % 3 = 0 THEN 's1_and_s2_change' WHEN s_suppkey % 3 = 0 THEN 's2_change' WHEN s_suppkey % 2 = 0 THEN 's1_change' WHEN s_suppkey % 5 = 0 THEN 's2_post' ELSE 'manual_review' END AS layer,
  s_suppkey % 200 - s_suppkey % 100 > 35 AND s_suppkey % 100 < 85 AND s_suppkey % 7 > 0 AS dark, CASE WHEN s_suppkey % 40 > 20 THEN 'v200' ELSE 'v100' END AS cover FROM supplier""")
def layers(spark, d):
    k = F.col("s_suppkey")
    cover = geo.cover_release(F.make_date((2000 + k % 40).cast("int"), F.lit(5), F.lit(5)))
    return t(spark, d, "supplier").select("s_suppkey", satellite.layer_recommendation(k % 2 == 0, k % 3 == 0, k % 5 == 0).alias("layer"), satellite.darkening(k % 200, k % 100, k % 7 > 0).alias("dark"), cover["version"].alias("cover"))


#: SQL of queries that stand in ``queries``.
ORACLES["selection_audit"] = r"""
WITH c AS (SELECT c_custkey AS k, c_name, c_mktsegment, DATE '2013-01-01' + (c_custkey % 2000)::INTEGER AS day, (c_custkey * 17 % 200 - 100)::DOUBLE AS lat, (c_custkey * 37 % 360 - 180)::DOUBLE AS lon FROM customer)
SELECT k AS event_id, CASE WHEN trim(c_name) = '' OR regexp_matches(c_name, '[/\\:]') THEN 'invalid_event_id' WHEN lat <= -90 OR lat >= 90 THEN 'invalid_coordinates' WHEN day < DATE '2014-04-03' THEN 'before_start_date' ELSE 'selected' END AS status FROM c"""
ORACLES["rank_groups"] = """
WITH s AS (SELECT s_suppkey, s_suppkey % 11 = 0 AS err, s_suppkey % 2 = 0 AS radar, s_suppkey % 3 = 0 AS change, s_suppkey % 4 > 0 AS water, s_suppkey % 5 = 0 AS post FROM supplier),
g AS (SELECT s_suppkey, CASE WHEN err THEN 'error' WHEN radar AND change AND water THEN 'best_s1_s2_change' WHEN radar AND change THEN 's1_s2_change_no_new_water' WHEN change AND water THEN 's2_change' WHEN change THEN 's2_change_no_new_water' WHEN radar THEN 's1_primary' WHEN post THEN 's2_post_only' ELSE 'manual_review' END AS "group" FROM s)
SELECT s_suppkey, "group", CASE "group" WHEN 'error' THEN 0 WHEN 'best_s1_s2_change' THEN 100 WHEN 's1_s2_change_no_new_water' THEN 90 WHEN 's2_change' THEN 80 WHEN 's2_change_no_new_water' THEN 70 WHEN 's1_primary' THEN 50 WHEN 's2_post_only' THEN 40 ELSE 10 END AS base FROM g"""
ORACLES["two_stage_scene"] = """
WITH e AS (SELECT user_id, event_id, value, event_id % 100 AS local, abs(event_id % 21 - 10) AS away FROM events WHERE value IS NULL OR value <= 80),
s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(value, 100), away, event_id) AS n FROM e)
SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY local, away, coalesce(value, 100), event_id) AS m FROM s WHERE n <= 8) WHERE m = 1"""


@query("ordered_picks", """
SELECT o_custkey, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, (SELECT string_agg(p, ' | ' ORDER BY f) FROM (SELECT o_orderpriority AS p, min(o_orderkey) AS f FROM orders i WHERE i.o_custkey = o.o_custkey GROUP BY 1)) AS priorities FROM orders o GROUP BY o_custkey""")
def ordered_picks(spark, d):
    o = t(spark, d, "orders")
    first = ordered.keep_first(o, ["o_custkey"], F.col("o_orderkey").asc()).select("o_custkey", F.col("o_orderkey").alias("first_key"))
    joined = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_key"), ordered.joined_in_order("o_orderpriority", "o_orderkey").alias("priorities"))
    return first.join(joined, "o_custkey")
