"""Search queries of events, in the order of their precision, and the quality of terms that models propose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.clean import col
from tidemark.functions.text import distinct_terms, has_latin, has_other_script, quoted_or_block, repeated_letters

_NONE = "array<struct<precision:string,query:string>>"


def event_queries(hazards: Column, country: Column | str, day: Column | str, names: Column, places: Column, most: int = 12) -> Column:
    """(precision, query): names, then places, then the country, each with up to three hazard words, year and month."""
    when = F.concat_ws(" ", F.date_format(col(day), "MMMM"), F.date_format(col(day), "yyyy"))
    words = F.slice(hazards, 1, 3)

    def specs(terms: Column, precision: str, k: int) -> Column:
        return F.flatten(F.transform(F.slice(terms, 1, k), lambda t: F.transform(words, lambda w: F.struct(F.lit(precision).alias("precision"), F.concat_ws(" ", t, F.when(F.lower(t) != F.lower(col(country)), col(country)), w, when).alias("query")))))

    full = F.concat(specs(names, "high", 3), specs(places, "medium", 3), specs(F.array(col(country)), "low", 1)).cast(_NONE)
    first = F.filter(full, lambda x, i: F.array_position(F.transform(full, lambda y: F.lower(y["query"])), F.lower(x["query"])) == i + 1)
    return F.slice(first, 1, most)


def boolean_queries(hazards: Column, country: Column | str, names: Column, places: Column, most: int = 8) -> Column:
    """Queries of OR blocks: hazards with each name, then with places, then with the country alone."""
    block = quoted_or_block(distinct_terms(hazards, 3, 5))
    land = F.when(col(country).rlike(r"\s"), F.concat(F.lit('"'), col(country), F.lit('"'))).otherwise(col(country))
    named = F.transform(F.slice(names, 1, 4), lambda n: F.concat_ws(" ", F.concat(F.lit('"'), n, F.lit('"')), block))
    placed = F.when(F.size(places) > 0, F.array(F.concat_ws(" ", block, quoted_or_block(F.slice(places, 1, 4)), land))).otherwise(F.array().cast("array<string>"))
    return F.slice(F.array_distinct(F.concat(named, placed, F.array(F.concat_ws(" ", block, land)))), 1, most)


def repeated_words(c: Column | str) -> Column:
    """Whether a word follows itself, occurs three times, or a pair of words occurs twice."""
    words = F.split(F.lower(F.trim(col(c))), r"\s+")
    pairs = F.zip_with(words, F.slice(words, 2, 10_000), lambda a, b: F.concat_ws(" ", a, b))
    next_to = F.exists(F.zip_with(words, F.slice(words, 2, 10_000), lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False)))
    often = F.exists(words, lambda w: F.size(F.filter(words, lambda x: x == w)) >= 3)
    full = F.filter(pairs, lambda p: p.contains(" "))
    return next_to | often | (F.size(F.array_distinct(full)) < F.size(full))


#: Words that name no hazard alone.
GENERIC_TERMS = ("disaster", "emergency", "news", "weather", "accident", "event", "damage")


def term_reasons(term: Column | str, latin_allowed: Column | bool = True, denied: tuple[str, ...] = ()) -> Column:
    """Comma-joined reasons against a term, in a fixed order; empty for a good one."""
    t = F.trim(F.coalesce(col(term), F.lit("")))
    latin_ok = latin_allowed if isinstance(latin_allowed, Column) else F.lit(latin_allowed)
    bad_words = F.lit(False)
    for w in denied:
        bad_words = bad_words | F.contains(F.lower(t), F.lit(w))
    return F.concat_ws(
        ",",
        F.when(F.length(t) < 2, F.lit("too_short")), F.when(F.length(t) > 60, F.lit("too_long")), F.when(F.size(F.split(t, r"\s+")) > 6, F.lit("too_many_words")),
        F.when(t.rlike(r"\d"), F.lit("contains_number")), F.when(F.lower(t).isin(*GENERIC_TERMS), F.lit("generic")), F.when(has_latin(t) & has_other_script(t), F.lit("mixed_scripts")),
        F.when(has_latin(t) & ~latin_ok, F.lit("latin_not_allowed")), F.when(repeated_words(t), F.lit("repeated_words")), F.when(repeated_letters(t), F.lit("repeated_letters")), F.when(bad_words, F.lit("other_meaning")),
    )


def parsed_terms(answer: Column | str, least: int = 3) -> Column:
    """(terms, status) of a model's answer ``{"local_terms": [{"terms": [...]}, ...]}``."""
    text = F.regexp_extract(F.coalesce(col(answer), F.lit("")), r"(?s)\{.*\}", 0)
    raw = F.get_json_object(text, "$.local_terms")
    items = F.from_json(raw, "array<struct<country:string,disaster_type:string,terms:array<string>>>")
    clean = F.transform(items, lambda i: F.struct(i["country"].alias("country"), i["disaster_type"].alias("disaster_type"), distinct_terms(F.filter(i["terms"], lambda t: term_reasons(t) == ""), 2).alias("terms")))
    kept = F.filter(clean, lambda i: F.size(i["terms"]) >= least)
    status = (
        F.when(F.try_parse_json(text).isNull() | (text == ""), "invalid_json").when(raw.isNull() | ~raw.startswith("["), "missing_local_terms").when(F.coalesce(F.size(kept), F.lit(0)) <= 0, "empty_terms")
        .when(F.size(kept) < F.size(items), "parsed_with_dropped_items").otherwise("parsed")
    )
    return F.struct(kept.alias("terms"), status.alias("status"))
