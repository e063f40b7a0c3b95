"""Edge rows of the rules, against values worked out by hand or by plain Python."""

import datetime as dt
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clean, dates, geo, text
from tidemark.operators import geocoding, matching, news, ordered, reasoning, relational, satellite, weather
from tidemark.plans import steps
from tidemark.sources import readers, writers
from tidemark.streaming import events as streams


def one(spark, column, **values):
    kinds = {str: "string", int: "long", float: "double", list: "array<string>", dt.date: "date", dt.datetime: "timestamp", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())] if values else [(1,)], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) or "x int")
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("value,missing", [("", True), (" NaN ", True), ("None", True), ("nat", True), ("0", False), ("[]", False), (None, True)])
def test_missing(spark, value, missing):
    assert one(spark, clean.is_missing("c"), c=value) is missing


@pytest.mark.parametrize("value,want", [("3", 3), ("3.0", 3), ("3.5", None), ("-1", None), ("NaN", None), ("inf", None), ("x", None), (None, None)])
def test_counts(spark, value, want):
    assert one(spark, clean.count_of("c"), c=value) == want


def test_measurements(spark):
    assert [one(spark, clean.measurement("c", True), c=v) for v in (-999.0, -1.0, 0.0, 2.5)] == [None, None, 0.0, 2.5]
    assert one(spark, clean.measurement("c", fill=-1.0), c=-1.0) is None and one(spark, clean.measurement("c"), c=-1.0) == -1.0


def test_keys_differ(spark):
    word = "Türkiye Straße & Co-op"
    got = {f: one(spark, getattr(text, f)("c"), c=word) for f in ("plain_key", "folded_key", "ascii_key", "word_key", "multilingual_key")}
    assert got == {"plain_key": "t rkiye stra e co op", "folded_key": "turkiye stra e co op", "ascii_key": "turkiye strae co op", "word_key": "turkiye straße and co op", "multilingual_key": "türkiye strasse & co-op"}


def test_folding_is_that_of_the_standard(spark):
    rng = random.Random(1)
    words = ["".join(chr(rng.choice([*range(0x41, 0x5B), *range(0xC0, 0x250)])) for _ in range(6)) for _ in range(50)]
    df = spark.createDataFrame([(w,) for w in words], "c string").select("c", text.strip_accents("c").alias("v"))
    assert all(r["v"] == "".join(x for x in unicodedata.normalize("NFKD", r["c"]) if not unicodedata.combining(x)) for r in df.collect())


def test_places(spark):
    assert one(spark, text.split_place("c"), c="A (near B) | C; c ;") == ["A", "near B", "C"]
    assert one(spark, text.composite_parts("c"), c="North, South and East provinces") == ["North province", "South province", "East province"]
    assert one(spark, text.list_parts("c"), c="one thing") == []
    assert one(spark, text.place_reasons("c"), c="ab, c, 9") == "contains_number,multiple_commas"
    assert one(spark, text.place_quality("c"), c="x") == "review"
    v = text.with_query_variants(spark.createDataFrame([("Baku city (Old)", "AZ")], "p string, c string"), "p", "c").first()["variants"]
    assert [x["query"] for x in v] == ["Baku city (Old), AZ", "Baku (Old), AZ", "Baku city, AZ", "Baku, AZ", "Old, AZ"]


def test_text_shapes(spark):
    assert one(spark, text.truncate("c", 10), c="a" * 11) == "aaaaaaa..."
    assert one(spark, text.id_base("c"), c="ABC.1.2_1") == "ABC.1.2" and one(spark, text.safe_part("c"), c="//") == "unknown"
    assert one(spark, text.mentions("c", F.lit("rain")), c="Heavy RAIN!") is True and one(spark, text.mentions("c", F.lit("rain")), c="train") is False
    assert one(spark, text.title_key("c"), c="<b>Flood hits</b> town - Daily News") == "flood hits town"
    assert one(spark, text.redirect_target("c"), c="//d.com/l/?uddg=https%3A%2F%2Fx.org%2Fa&r=1") == "https://x.org/a"
    assert one(spark, text.distinct_terms("c"), c=["Ab", "rain", "RAIN", "wind"]) == ["rain", "wind"]
    assert one(spark, text.list_text("c"), c="['a', \"b\"|c]") == ["a", "b", "c"]
    assert one(spark, news.source_family("c"), c="Google News (FloodList)") == "FloodList"


def test_dates(spark):
    assert one(spark, dates.date_lenient("y", "m", "d"), y=2014, m=2, d=30) is None
    with pytest.raises(Exception, match="(?i)date"):
        one(spark, dates.date_strict("y", "m", "d"), y=2014, m=2, d=30)
    assert one(spark, dates.date_defaulting("c", "y", "m", "d"), c=None, y=2014, m=None, d=None) == dt.date(2014, 1, 1)
    assert one(spark, dates.date_known("c", "y", "m", "d"), c="soon", y=2014, m=1, d=1) is None
    assert one(spark, dates.published("c"), c="Sat, 11 May 2019 10:00:00 GMT") == dt.datetime(2019, 5, 11, 10)
    assert one(spark, dates.published("c"), c="2019-05-11T10:00:00.123Z") == dt.datetime(2019, 5, 11, 10)
    assert one(spark, dates.published("c"), c="seen on 2019-05-11, twice") == dt.datetime(2019, 5, 11)
    a, b = dt.datetime(2019, 5, 4, 0), dt.datetime(2019, 5, 3, 12)
    assert one(spark, dates.day_distance("b", "a"), a=a, b=b) == 1 and one(spark, dates.day_distance("a", "b"), a=a, b=b) == 0
    assert len(one(spark, dates.calendar("c"), c=dt.date(2020, 3, 1))) == 21
    with pytest.raises(Exception, match="span"):
        one(spark, dates.calendar_between("a", "b"), a=dt.date(2020, 1, 2), b=dt.date(2020, 1, 1))
    assert one(spark, dates.wrong_year("t", "u", F.lit("2019")), t="Flood of 2017", u="http://x/2018/a") is True


def test_geo(spark):
    w, s, e, n = one(spark, geo.point_box("a", "o", 111.32), a=0.0, o=10.0)
    assert (w, s, e, n) == (9.0, -1.0, 11.0, 1.0)
    assert one(spark, geo.pixels(F.col("c"), 1000), c=2.5) == 2 and one(spark, geo.pixels(F.col("c"), 1000), c=0.1) == 1
    assert one(spark, geo.geometry_box("c"), c='{"type":"Polygon","coordinates":[[[1,2],[3.5,-4],[0,9]]]}') == [0.0, -4.0, 3.5, 9.0]
    assert one(spark, F.array_join(geo.tile_names(F.lit(-1.0), F.lit(2.0), F.lit(1.0), F.lit(4.0)), ","), c=1) == "N00W003,N00E000,N03W003,N03E000"


def test_first_seen_differs_from_first_row(spark):
    df = spark.createDataFrame([(1, 2, "b", None), (1, 1, None, "x"), (1, 3, "c", "x"), (1, 4, "b", "y")], "k int, o int, v string, t string")
    r = df.groupBy("k").agg(ordered.first_seen("v", "o").alias("a"), ordered.first_row(["v"], "o").alias("b"), ordered.joined_in_order("t", "o").alias("t")).first()
    assert (r["a"], r["b"]["v"], r["t"]) == ("b", None, "x | y")


def test_columns(spark):
    base = spark.createDataFrame([(1, 2, 3)], "`DisNo.` int, country int, Extra int")
    assert relational.novel_columns(base, ["dis_no", "Country"]).columns == ["base_Extra"]
    assert relational.in_order(base, ["Extra"]).columns == ["Extra", "DisNo.", "country"]


def test_best_keeps_ties_in_order(spark):
    df = spark.createDataFrame([(1, "x", 1.0, 2), (1, "m", None, 1), (1, "m", 5.0, 4), (1, "m", 5.0, 3)], "k int, s string, v double, o int")
    assert relational.best_per_group(df, ["k"], "s", ["m", "x"], "v", "o").first()["o"] == 3


def test_canonical_types(spark):
    cases = {"Heavy Rainfall": "Extreme Precipitation", "big flash  floods": "Flash Flood", "house was damaged by": "Property Damage", "some_new (thing)": "Some New Thing", "": "", "!!": "!!"}
    df = spark.createDataFrame([(k,) for k in cases], "c string").select("c", reasoning.canonical_type("c").alias("v"))
    assert {r["c"]: r["v"] for r in df.collect()} == cases


def step(n, **more):
    return {"n_event": n, "type_event": "flood", "description": "d", "supporting_quote": "q"} | more


@pytest.mark.parametrize("chain,want", [
    ([step(1)], "valid"), ([step(1), step(2)], "valid"), ([step("1")], "invalid_structure"), ([step(1.0)], "invalid_structure"), ([step(True)], "invalid_structure"), ([step(2)], "invalid_structure"),
    ([], "empty_chain"), ([step(1, description=" ")], "invalid_structure"), ({"causal_chain": [step(1)]}, "valid"), ({"x": 1}, "invalid_structure"), (None, "invalid_structure"),
])
def test_chain_status(spark, chain, want):
    assert one(spark, reasoning.chain_status(F.lit("parsed"), "c"), c=json.dumps(chain)) == want
    assert one(spark, reasoning.chain_status(F.lit("failed"), "c"), c=json.dumps(chain)) == "unaccepted_parse_status"


def test_parsed_answers(spark):
    full = '```json {"causal_chain": [{"type_event": "flood", "description": "d", "supporting_quote": "q"}, {"type_event": "", "description": "d", "supporting_quote": "q"}]} ```'
    cases = {full: ("parsed_with_dropped_items", 1), "nothing": ("invalid_json", 0), '{"causal_chain": [1, {"type_event": "flood", "description": "d", "supporting_quote": "q"}, "x", null]}': ("parsed_with_dropped_items", 1), '{"causal_chain": {}}': ("missing_causal_chain", 0), "{broken": ("invalid_json", 0), "{broken}": ("invalid_json", 0), '{"a": 1}': ("missing_causal_chain", 0), '{"causal_chain": []}': ("empty_chain", 0)}
    df = spark.createDataFrame([(k,) for k in cases], "c string").select("c", reasoning.parsed_chain("c").alias("v"))
    assert {r["c"]: (r["v"]["status"], len(r["v"]["chain"])) for r in df.collect()} == cases


def test_summary_status(spark):
    f = lambda s, c="called", e="pending": one(spark, reasoning.summary_status("s", "c", "e")["status"], s=s, c=c, e=e)
    assert f("All is well") == "accepted" and f("") == "empty_summary" and f("x", e="kept") == "kept"
    assert f("The provided news articles primarily focus on sport") == "rejected_unrelated_news_admission"
    assert f("INSUFFICIENT_INFORMATION", "skipped_insufficient_news") == "not_called_insufficient_news"


def test_stored_chains(spark):
    step = '{"type_event": "flood", "description": "d", "supporting_quote": "q"}'
    cases = {f"[{step}, 3]": 1, '{"causal_chain": [' + step + "," + step + "]}": 2, "": 0, "[": 0, "{}": 0, None: 0}
    df = spark.createDataFrame([(k,) for k in cases], "c string").select("c", reasoning.lenient_chain("c").alias("v"))
    assert {r["c"]: len(r["v"]) for r in df.collect()} == cases


def test_cleaned_summaries(spark):
    cases = {"```text\nSummary: It rained.\n```": "It rained.", "summary : x": "x", "```": "INSUFFICIENT_INFORMATION", " a  b ": "a b", "nan": "INSUFFICIENT_INFORMATION", None: "INSUFFICIENT_INFORMATION"}
    df = spark.createDataFrame([(k,) for k in cases], "c string").select("c", reasoning.cleaned_summary("c").alias("v"))
    assert {r["c"]: r["v"] for r in df.collect()} == cases


def test_steps_without_support_go(spark):
    news_text = ["Heavy rain fell on the northern hills on Monday. Two bridges collapsed."]
    quotes = {"a": ["Two bridges collapsed", "nothing like it at all here"], "b": ["heavy rains fell on the northern hill"], "c": ["entirely made up words"], "d": []}
    rows = [(k, [(i + 1, "Flood", "d", q) for i, q in enumerate(qs)], "parsed", news_text) for k, qs in quotes.items()]
    df = spark.createDataFrame(rows, "k string, chain array<struct<n_event:int,type_event:string,description:string,supporting_quote:string>>, status string, texts array<string>")
    got = {r["k"]: ([x["n_event"] for x in r["chain"]], r["status"], r["dropped_quotes"], r["fuzzy_quotes"]) for r in reasoning.with_supported_steps(df, "chain", "status", "texts").collect()}
    assert got == {"a": ([1], "parsed_with_dropped_unsupported_quotes", 1, 0), "b": ([1], "parsed", 0, 1), "c": ([], "empty_chain_after_quote_validation", 1, 0), "d": ([], "parsed", 0, 0)}


def test_quotes():
    assert reasoning.quote_ratio("The river rose", ["x The river rose y"]) == 1.0
    assert reasoning.quote_ratio("THE RIVER ROSE!", ["... the river, rose"]) == 1.0
    assert reasoning.quote_ratio("a river", ["b"]) < 0.8 and reasoning.quote_ratio("", ["b"]) == 0.0
    assert reasoning.words_in_order("one two three four five", "one two three four five") == 0.0
    assert reasoning.words_in_order("a b c d e f", "x a b y c d z e f") == 1.0 and reasoning.words_in_order("a b c d e f", "a b c") == 0.5
    assert reasoning.quote_ratio("Flooded!", ["the town was flooded here"]) == 0.0  # a key under ten signs
    assert reasoning.quote_ratio("flooded here", ["flooded  here"]) == 1.0 and reasoning.best_window("abcdefghij", "abcdefghij") == 1.0
    assert reasoning.best_window("heavy rains fell", "heavy") == 2 * 5 / 21
    assert reasoning.quote_ratio("heavy rain fell on the northern hills", ["heavy rains fell on the northern hill"]) >= 0.8


def test_fuzzy_terms():
    assert matching.contains_fuzzy("the town of springfeld flooded", ["springfield"]) and not matching.contains_fuzzy("the town", ["springfield"])
    assert matching.token_similarity("a b c", "c b a") == 1.0


def test_fuzzy_join_needs_a_margin(spark):
    left = spark.createDataFrame([(1, "springfield"), (2, "springfield"), (3, "abc")], "b int, n string")
    right = spark.createDataFrame([(1, "springfeld", 10), (1, "springfiel", 11), (2, "springfeld", 10), (3, "abc", 5)], "b int, k string, u int")
    got = {r["b"]: r["match_id"] for r in matching.fuzzy_join(left, right, ["b"], "n", "k", "u").collect()}
    assert got == {1: None, 2: 10, 3: None}


def test_relevance(spark):
    arr = lambda *v: F.array(*map(F.lit, v)) if v else F.array().cast("array<string>")
    def score(title, body="", places=(), names=(), pub=None):
        return one(spark, news.relevance(F.col("t"), F.col("b"), arr("italy"), news.hazard_words(F.lit("Flood (riverine)")), arr(*places), arr(*names), F.lit("2019-05-04").cast("date"), F.lit(pub).cast("string")), t=title, b=body)
    r = score("Flood in Italy, May 2019", places=["Rome"], body="Rome", pub="2019-05-10")
    assert (r["score"], r["threshold"]) == (2 + 3 + 2 + 2 + 1 + 2, 5) and r["penalties"] == []
    r = score("Something in 2017")
    assert r["score"] == -3 - 4 and r["penalties"] == ["missing_hazard_term", "different_year_in_title"]
    assert score("Fans flood twitter")["score"] == -99
    assert "generic_title" in score("Flood overview")["penalties"]
    assert one(spark, news.source_threshold("s", F.lit("low")), s="DuckDuckGo") == 8 and one(spark, news.source_threshold("s", F.lit("x")), s="ReliefWeb Disasters") == 4


def test_local_hazard_words_and_misspelt_terms(spark):
    arr = lambda *v: F.array(*map(F.lit, v)) if v else F.array().cast("array<string>")
    def reasons(title, body, local):
        r = one(spark, news.relevance(F.col("t"), F.col("b"), arr("Italy"), arr("flood"), arr("Springfield"), arr(), F.lit("2019-05-04").cast("date"), F.lit(None).cast("string"), local=arr(*local)), t=title, b=body)
        return set(r["reasons"]) | set(r["penalties"])
    assert reasons("Alluvione a Roma", "", ["alluvione"]) == {"hazard_in_title", "missing_local_or_event_context"}  # in Latin letters it counts as an ordinary one
    assert reasons("洪水 a Roma", "", ["洪水"]) == {"local_hazard_in_title", "missing_local_or_event_context"}
    assert reasons("In springfeld", "洪 水, floods", ["洪水"]) == {"hazard_in_text", "local_place_in_title"}
    assert reasons("x", "洪 水", ["洪水"]) >= {"local_hazard_in_text"} and "missing_hazard_term" in reasons("x", "y", [])


@pytest.mark.parametrize("source, score, reasons, penalties, listed, want", [
    ("BBC", 9, [], ["missing_hazard_term"], False, "high"), ("BBC", 6, [], [], False, "medium"), ("BBC", 9, [], ["generic_title"], False, "low"),
    ("Wikipedia", 8, [], [], False, "medium"), ("Wikipedia", 8, ["event_name_in_text"], ["missing_hazard_term"], False, "high"), ("DuckDuckGo", 20, ["event_name_in_text"], ["generic_title"], False, "low"),
    ("ReliefWeb Updates", 7, [], ["missing_hazard_term"], False, "high"), ("ReliefWeb", 7, [], ["generic_title"], False, "medium"), ("GDACS", 5, [], [], False, "medium"),
    ("BBC", 9, ["local_place_in_title"], [], False, "high"), ("ReliefWeb", 20, ["local_place_in_title"], [], True, "low"),
])
def test_confidence(spark, source, score, reasons, penalties, listed, want):
    got = news.confidence("s", F.col("n"), F.lit(5), F.col("r"), F.col("p"), F.lit(listed))
    df = spark.createDataFrame([(source, score, reasons, penalties)], "s string, n int, r array<string>, p array<string>")
    assert df.select(got).first()[0] == want


def test_source_priorities(spark):
    cases = {"Google News (BBC)": ("BBC", 30), "Google News (FloodList)": ("FloodList", 30), "ReliefWeb Africa": ("ReliefWeb", 95), "BBC": ("BBC", 50), "Google News Local": ("Google News", 30), "": ("", 50)}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", news.source_family("s").alias("f"), news.source_priority("s").alias("p"))
    assert {r["s"]: (r["f"], r["p"]) for r in df.collect()} == cases


def test_text_status(spark):
    page = "word " * 200
    cases = [
        (("fetched_full_text", "http://a", None, "", "", "", ""), "fetched_full_text"), (("", "ftp://a", None, "", "", "", ""), "skipped"), (("", "http://a.PDF", None, "", "", "", ""), "skipped"),
        (("", "https://news.google.com/rss/articles/x", None, "", "", "", ""), "skipped_google_news_redirect"), (("", "http://a", None, "", "", "", ""), "fetch_failed"),
        (("", "http://a", "<p>Before you Continue", "http://a", "text/html", "", ""), "blocked_or_consent_page"), (("", "http://a", "x", "http://consent.google.com/", "text/html", page, ""), "blocked_or_consent_page"),
        (("", "http://a", "x", "http://a", "image/png", page, ""), "unsupported_content_type"), (("", "http://a", "x", "http://a", "text/html", "short", ""), "kept_original"),
        (("", "http://a", "x", "http://a", "Text/HTML", page, page + page), "kept_original"), (("", "http://a", "x", "http://a", "text/html", page, "old"), "fetched_full_text"),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, s string, u string, f string, fu string, ct string, t string, h string")
    got = news.text_status("s", "u", F.lit(False), F.col("f"), "fu", "ct", F.col("t"), F.col("h"))
    assert [r[0] for r in df.orderBy("i").select(got).collect()] == [w for _, w in cases]


def test_repeats_follow_what_stayed(spark):
    rows = [(1, 1, "u1", "A"), (1, 2, "u1/", "B"), (1, 3, "u2", "b"), (1, 4, "u3", " a "), (1, 5, "", "C"), (1, 6, "", "D"), (2, 7, "u1", "A")]
    df = spark.createDataFrame(rows, "e int, o int, u string, t string")
    assert sorted(r["o"] for r in news.drop_repeats(df, "e", "u", "t", "o").collect()) == [1, 3, 5, 7]


def test_direct_sources_win(spark):
    rows = [(1, 1, "Google News (FloodList)", "x", "g", "low", 1), (1, 2, "FloodList", "y", "f", "low", 1), (1, 3, "Wikipedia", "Y", "w", "high", 9), (1, 4, "Other", "z", "o", "low", 0)]
    df = spark.createDataFrame(rows, "e int, o int, source string, title string, url string, confidence string, relevance_score int")
    assert sorted(r["o"] for r in news.prefer_direct(df, "e", "o").collect()) == [2, 4]
    rows = [(1, 1, "Wikipedia", "Flood in town - BBC", "w", "low", 1), (1, 2, "GDACS", "Flood in TOWN | Times", "g", "low", 1), (1, 3, "Other", "flood in town", "z", "high", 9), (1, 4, "Other", "q", "G/", "low", 0), (1, 5, "Other", "w2", "w", "low", 0)]
    got = {r["o"]: (r["deduplicated_from"], r["deduplicated_sources"]) for r in news.prefer_direct(spark.createDataFrame(rows, df.schema), "e", "o").collect()}
    assert got == {2: ("Wikipedia", ["Other", "Other", "Other"])}


def test_long_chains_of_repeats(spark):
    rows = [(1, i, f"u{i // 2}", f"t{(i + 1) // 2}") for i in range(8)]
    assert sorted(r["o"] for r in news.drop_repeats(spark.createDataFrame(rows, "e int, o int, u string, t string"), "e", "u", "t", "o").collect()) == [0, 2, 4, 6]


PLACES = {
    "Kindi, Bana and Suru provinces": ["Kindi province", "Bana province", "Suru province"], "near the town of Ola area": [], "A in B": ["A", "B"],
    "Ala and Bela islands (Cora province)": ["Ala island", "Bela island", "Cora province", "Cora"], "Ala district, the Bela": ["Ala district", "Ala", "Bela"], "One": [],
}


def test_places_that_are_several(spark):
    df = spark.createDataFrame([(k,) for k in PLACES], "c string").select("c", text.composite_parts("c").alias("v"))
    assert {r["c"]: r["v"] for r in df.collect()} == PLACES


def test_queries_of_a_place(spark):
    df = spark.createDataFrame([("Ala prov. / Bela isl., Viet Nam", "Ala province/ Bela", "Viet Nam")], "q string, p string, c string")
    got = [tuple(x) for x in df.select(text.query_variants("q", "p", "c")).first()[0]]
    assert got[0] == ("original", "Ala prov. / Bela isl., Viet Nam") and got[1:5] == [
        ("place_country", "Ala province/ Bela, Viet Nam"), ("without_admin_qualifier", "Ala / Bela, Viet Nam"), ("place_country", "Ala province/ Bela, Vietnam"), ("without_admin_qualifier", "Ala / Bela, Vietnam"),
    ]
    assert ("place_country", "Bela, Vietnam") in got and len({q for _, q in got}) == len(got)


def test_country_queries_and_small_boxes(spark):
    assert one(spark, geocoding.country_only("c", F.lit("Côte d’Ivoire"), F.lit("nan")), c="côte d'ivoire") is True and one(spark, geocoding.country_only("c", F.lit("Italy"), F.lit("Rome")), c="Italy") is False
    f = lambda q, w, h: one(spark, geocoding.small_area_box("c", F.lit(w), F.lit(h)), c=q)
    assert f("Kindi Province, X", "0.01", "0.04") is True and f("Kindi", "0.01", "0.01") is False and f("Kindi Province", "0.01", "0.05") is False and f("Kindi Province", None, "0.01") is False


def test_texts_of_a_page(spark):
    long = "Long enough text, one of more than fifty characters &amp; so."
    pages = {f"<article>{long}<br>x</article>": [long.replace("&amp;", "&") + " x"], f"<div>{long}</div><p>short</p>": [], f"<div>{long}</div>": [long.replace("&amp;", "&")],
             f"<main>{long}</main><nav><p>{long}</p></nav><article>short</article>": [long.replace("&amp;", "&")], None: []}
    df = spark.createDataFrame([(k,) for k in pages], "c string").select("c", text.main_chunks("c").alias("v"))
    assert {r["c"]: r["v"] for r in df.collect()} == pages

def test_review_rules(spark):
    f = lambda t, small=False, country=False: one(spark, geocoding.review_decision(F.lit(1.0), F.lit(2.0), F.col("t"), F.lit(country), F.lit(small)), t=t)
    assert f("state")["decision"] == "accept" and f("state", small=True)["bucket"] == "small_bbox_for_admin_query" and f("hotel", country=True)["decision"] == "accept" and f("pond")["decision"] == "reject"


def test_units_and_positions(spark):
    items = one(spark, geocoding.deepest_unit(geocoding.json_items("c")), c='[{"gid_1": "A.1", "name_1": "x"}, {"gid_1": "A.1", "gid_2": "A.1.2"}, {"z": "1"}]')
    assert [(u["level"], u["unit_id"]) for u in items] == [(1, "A.1"), (2, "A.1.2")]
    assert one(spark, F.size(geocoding.json_items("c")), c="nope") == 0
    p = one(spark, geocoding.position({"a": (F.lit(95.0), F.lit(0.0)), "b": (F.lit(5.0), F.lit(6.0))}), c=1)
    assert (p["source"], p["latitude"]) == ("b", 5.0)


def test_weather(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(21)]
    df = spark.createDataFrame([(dt.date(2020, 1, 11), days, [1.0] * 10 + [100.0] + [2.0] * 9 + [-999.0]), (dt.date(2020, 1, 11), days[:2], [1.0])], "d date, t array<date>, v array<double>")
    s = weather.aligned("t", {"rain_sum": "v", "temperature_2m_max": "v"}, dates.calendar("d"))
    rows = df.withColumn("s", s).select("s", weather.before_and_after("s").alias("p")).collect()
    assert rows[0]["p"]["pre"]["total_rainfall_mm"] == 10.0 and rows[0]["p"]["post"]["rain_days"] == 9 and rows[1]["s"] is None


def test_best_record_stays(spark):
    old = spark.createDataFrame([("a", 21, "o"), ("b", 3, "o")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 5, "n"), ("b", 3, "n"), ("c", 1, "n")], "k string, n int, v string")
    assert {r["k"]: r["v"] for r in weather.upsert_best(old, new, "k", "n").collect()} == {"a": "o", "b": "n", "c": "n"}


def test_scenes(spark):
    assert one(spark, satellite.apart_in_time(F.array(*[F.lit(x) for x in (5.0, 0.0, 1.0, 2.5, 9.0, 20.0)])), c=1) == [0.0, 2.5, 5.0]
    cloud = spark.createDataFrame([(1, None, 1, 1), (1, 0.0, 2, 2), (1, 5.0, 0, 3)], "k int, c double, t int, o int")
    assert satellite.clearest_scene(cloud, ["k"], "c", "t", "o").first()["o"] == 2
    none = F.lit(None).cast("double")
    assert one(spark, satellite.rank_score(F.lit(80), F.lit(0.5), F.lit(0.0), none, none, F.lit(40.0), none), c=1) == 80 + 10 - 15


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿DisNo.,"Total, x"\n007,"1\n2"\n', encoding="utf-8")
    df = readers.table(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["DisNo.", "Total, x"] and df.first()[0] == "007" and df.first()[1] == "1\n2"
    assert readers.text_table(spark, str(tmp_path / "none.csv"), required=False) is None
    with pytest.raises(FileNotFoundError):
        readers.table(spark, str(tmp_path / "none.csv"))
    (tmp_path / "l.jsonl").write_text('{"event_id": "a"}\n\n{bad\n{"event_id": "b"}\n')
    assert readers.json_lines(spark, str(tmp_path / "l.jsonl"), "event_id string").count() == 2
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "l.jsonl"), "event_id string", strict=True).collect()
    with pytest.raises(ValueError, match="repeated"):
        readers.unique_records(spark.createDataFrame([("a",), ("a",)], "k string"), "k")
    (tmp_path / "d.json").write_text('{"e1": {"x": 1}, "e2": {"x": 2}}')
    assert {r["event_id"] for r in readers.event_documents(spark, str(tmp_path / "d.json")).collect()} == {"e1", "e2"}
    (tmp_path / "r.json").write_text('{"e1": 1, "e1": 2}')
    with pytest.raises(Exception, match="repeated"):
        readers.event_documents(spark, str(tmp_path / "r.json")).collect()
    (tmp_path / "x.png").write_bytes(b"\x89PNG\r\n\x1a\nrest")
    assert readers.files(spark, str(tmp_path), "*.png").select(readers.image_kind().alias("k")).first()["k"] == "png"


def test_public_missing_values(spark):
    df = spark.createDataFrame([("a", None, [None, 1])], "k string, v int, l array<int>")
    assert json.loads(writers.public_records(df, "k").first()["record"]) == {"k": "a", "v": "none", "l": ["none", 1]}


def test_upsert_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), root, "k", 1)
    last = writers.upsert(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), root, "k", 2)
    assert {tuple(r) for r in spark.read.parquet(last).collect()} == {("a", 1), ("b", 2), ("c", 2)}


def test_steps(spark, tmp_path):
    ran = []
    all_steps = [steps.Step("one", lambda s: ran.append(1), group="g"), steps.Step("two", lambda s: ran.append(2), (str(tmp_path / "no"),)), steps.Step("three", lambda s: ran.append(3))]
    assert [s.name for s in steps.chosen(all_steps, ["three,g"])] == ["one", "three"]
    with pytest.raises(ValueError):
        steps.chosen(all_steps, ["four"])
    assert steps.run(spark, all_steps, continue_on_error=True).done == ["one", "three"] and ran == [1, 3]
    with pytest.raises(FileNotFoundError):
        steps.run(spark, all_steps)


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "in"))
    schema = ", ".join(f"{n} {k}" for n, k in table.dtypes)
    live = streams.windowed(streams.stream(spark, str(tmp_path / "in"), schema), late="400 days")
    q = live.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    key = lambda r: (r["window_start"], r["event_type"], r["n"])
    assert sorted(map(key, spark.table("windows").collect())) == sorted(map(key, streams.windowed(table).collect()))


def test_batch_sink_replaces_itself(spark, tmp_path):
    write = streams.latest_by_key(str(tmp_path / "s"), "k", "o")
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, o int")
    write(df, 0)
    write(df, 0)
    assert [tuple(r)[:2] for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [("a", 2)]


def test_connectors(spark):
    from tidemark.sources import connectors

    tries = iter([(503, ""), (429, ""), (200, "ok")])
    assert connectors.with_retries(lambda: next(tries), sleep=lambda s: None) == (200, "ok")
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "r string")
    got = {r["request"]: (r["status"], r["body"]) for r in connectors.fetched(df, "r", lambda: connectors.Landed({"a": "x"})).collect()}
    assert got == {"a": (200, "x"), "b": (404, "")}
    assert sorted(r["answer"] for r in connectors.answered(df, "r", lambda: connectors.Landed({"b": "y"})).collect()) == ["", "", "y"]
    feed = "<rss><item><title><![CDATA[Flood hits town - Daily]]></title><link>http://x</link><pubDate>d</pubDate></item><item><title>short</title></item></rss>"
    assert [tuple(r) for r in one(spark, connectors.search_results("c"), c=feed)] == [("Flood hits town", "http://x", "d")]


def test_searching(spark):
    from tidemark.operators import searching

    arr = lambda *v: F.array(*map(F.lit, v)) if v else F.array().cast("array<string>")
    q = one(spark, searching.event_queries(arr("flood", "rain"), F.lit("Italy"), F.lit("2019-05-04").cast("date"), arr("Ada"), arr("Rome")), c=1)
    assert [x["precision"] for x in q] == ["high", "high", "medium", "medium", "low", "low"] and q[0]["query"] == "Ada Italy flood May 2019" and q[-1]["query"] == "Italy rain May 2019"
    assert one(spark, searching.boolean_queries(arr("flood", "heavy rain"), F.lit("Viet Nam"), arr(), arr("Hue")), c=1) == ['(flood OR "heavy rain") (Hue) "Viet Nam"', '(flood OR "heavy rain") "Viet Nam"']
    for term, reason in {"inondation": "", "news": "generic", "flood flood": "repeated_words", "aaaah": "repeated_letters", "洪水 flood": "mixed_scripts", "a": "too_short"}.items():
        assert one(spark, searching.term_reasons("c"), c=term) == reason, term
    full = '{"local_terms": [{"country": "x", "disaster_type": "y", "terms": ["alluvione", "piena", "esondazione", "news"]}, {"country": "z", "disaster_type": "y", "terms": ["a"]}]}'
    p = one(spark, searching.parsed_terms("c"), c=full)
    assert p["status"] == "parsed_with_dropped_items" and p["terms"][0]["terms"] == ["alluvione", "piena", "esondazione"]


def test_manifests(spark):
    import numpy as np

    from tidemark.operators import manifests

    day = dt.date(2020, 1, 11)
    slot = {"available": True, "status": "available", "outputs": {"rgb": "a.tif"}}
    none = {"available": False, "status": "no_scene", "outputs": {}}
    days = [{"date": str(day + dt.timedelta(i)), "relative_day": i, "sentinel_2": slot, "sentinel_1": none, "sentinel_3_slstr": none} for i in range(-10, 11)]
    full = {"event_id": "e", "start_date": str(day), "latitude": 1.0, "longitude": 2.0, "bbox": [1.5, 0.5, 2.5, 1.5], "days": days}
    df = spark.createDataFrame([("e", json.dumps(full)), ("e", json.dumps(full | {"days": days[1:]})), ("f", json.dumps(full)), ("e", "{")], "id string, m string").withColumn("m", manifests.parsed("m"))
    rows = df.select(manifests.reject_reason(F.col("m"), F.col("id"), F.lit(day), F.lit(1.0), F.lit(2.0)).alias("r"), manifests.complete(F.col("m")).alias("c"), manifests.n_outputs(F.col("m")).alias("n")).collect()
    assert [r["r"] for r in rows][:3] == [None, "other_days", "other_event"] and rows[3]["r"] in ("missing_manifest", "other_event")
    assert rows[0]["c"] and rows[0]["n"] == 21 and manifests.slots(df.limit(1), "m", "id").count() == 63
    mask = np.zeros((9, 9), bool)
    mask[4, 4] = True
    assert manifests.dilate(mask).sum() == 29 and manifests.isolated(mask, ~mask, 0.5) == (100.0, 0.0)
    assert manifests.scaled(np.array([0.5, np.nan, 2]), np.array([True, True, True]), 255).tolist() == [128, 0, 255]
    assert manifests.mosaic([np.array([1, 0, 2]), np.array([0, 0, 3])])[0].tolist() == [1, 0, 3]
