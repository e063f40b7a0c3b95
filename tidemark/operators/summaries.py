"""Which articles may speak for an event: its places, its country's names, its hazard's words, and the gate on them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.clean import clean_text, col, collapse
from tidemark.functions.dates import wrong_year
from tidemark.functions.text import mentions_any, plain_key

#: Words that speak of a hazard, by a part of its name; the first part that fits decides.
HAZARDS = {
    "air": ("air", "plane", "aircraft", "aviation", "crash"),
    "collapse": ("collapse", "collapsed", "building", "structure"),
    "drought": ("drought", "dry spell", "water shortage"),
    "earthquake": ("earthquake", "quake", "seismic", "tremor"),
    "epidemic": ("epidemic", "outbreak", "disease"),
    "explosion": ("explosion", "blast", "gas leak", "chemical leak"),
    "extreme temperature": ("heatwave", "heat wave", "cold wave", "extreme heat"),
    "fire": ("fire", "blaze", "burned"),
    "flood": ("flood", "flooding", "inundation", "overflow", "heavy rain"),
    "gas leak": ("gas leak", "chlorine", "toxic gas", "chemical leak"),
    "mass movement": ("landslide", "mudslide", "rockslide", "debris flow"),
    "miscellaneous accident": ("accident", "stampede", "incident"),
    "rail": ("rail", "train", "derailment"),
    "road": ("road", "crash", "collision", "traffic accident", "bus"),
    "storm": ("storm", "cyclone", "hurricane", "typhoon", "tropical storm"),
    "water": ("boat", "ship", "ferry", "capsized", "shipwreck", "maritime"),
    "wildfire": ("wildfire", "bushfire", "forest fire", "blaze"),
}
#: Other names of countries, by lower-cased name.
COUNTRIES = {
    "bolivia (plurinational state of)": ("Bolivia",),
    "democratic people's republic of korea": ("North Korea", "DPRK"),
    "democratic republic of the congo": ("DR Congo", "DRC", "Congo-Kinshasa"),
    "iran (islamic republic of)": ("Iran",),
    "lao people's democratic republic": ("Laos",),
    "republic of korea": ("South Korea", "Korea"),
    "russian federation": ("Russia",),
    "syrian arab republic": ("Syria",),
    "taiwan (province of china)": ("Taiwan",),
    "türkiye": ("Turkey",),
    "united republic of tanzania": ("Tanzania",),
    "united states of america": ("United States", "USA", "U.S."),
    "venezuela (bolivarian republic of)": ("Venezuela",),
    "viet nam": ("Vietnam",),
}
#: Keys of places that say nothing about where.
VAGUE = (
    "central", "eastern", "island", "islands", "national", "nationwide", "northern", "province", "provinces", "region", "regions", "several",
    "southern", "state", "states", "western",
)
#: Marks that an article's score left.
HAZARD_MARKS = ("hazard_in_title", "hazard_in_text", "local_hazard_in_title", "local_hazard_in_text")
DATE_MARKS = ("event_year_present", "event_month_present", "publication_date_near_event", "publication_date_same_year")
BARRED_MARKS = ("different_year_in_title", "publication_date_far_from_event", "missing_local_or_event_context", "generic_title", "unrelated_multi_year_range")
#: Sources that a country's name and a medium confidence suffice for.
TRUSTED = ("ReliefWeb", "GDACS", "IFRC GO", "FloodList")
#: What stands before and after a place's name.
_BEFORE = r"(?i)^(?:near|around|between|in|at|outskirts of|villages near|slums of)\s+"
_AFTER = r"(?i)\b(?:city|cities|districts?|provinces?|regions?|states?|municipalities|villages?)$"
_YEAR = r"\b(19\d{2}|20\d{2})\b"


def _texts(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def hazard_terms(hazard: Column | str) -> Column:
    """The words of the first hazard that the type (before a bracket) names, else the type's key; none for an empty type."""
    key = plain_key(F.get(F.split(F.coalesce(col(hazard), F.lit("")), r"\("), F.lit(0)))
    out = F.when(key != "", F.array(key)).otherwise(_texts(()))
    for part, words in reversed(HAZARDS.items()):
        out = F.when(F.contains(key, F.lit(part)), _texts(words)).otherwise(out)
    return out


def location_terms(*fields: Column | str) -> Column:
    """Distinct place names of three characters or more from the fields, in their order, without what stands around a name."""
    split = lambda c: F.split(clean_text(c), r"[,;/()]+|(?i:\b(?:and|et|e)\b)")
    bare = lambda x: clean_text(F.regexp_replace(F.regexp_replace(collapse(x), _BEFORE, ""), _AFTER, ""))
    names = F.transform(F.flatten(F.array(*map(split, fields))), bare)
    return F.array_distinct(F.filter(names, lambda x: F.length(x) >= 3))


def country_terms(country: Column | str) -> Column:
    """A country's name, its other names, and what stands before a bracket in it."""
    name = clean_text(country)
    others = _texts(())
    for key, names in COUNTRIES.items():
        others = F.when(F.lower(name) == key, _texts(names)).otherwise(others)
    short = F.when(F.contains(name, F.lit("(")), F.array(F.trim(F.substring_index(name, "(", 1)))).otherwise(_texts(()))
    return F.array_distinct(F.filter(F.concat(F.array(name), others, short), lambda x: x != ""))


def specific_terms(places: Column, countries: Column) -> Column:
    """The places whose keys are neither empty, nor a country's, nor vague."""
    taken = F.array_union(F.transform(countries, plain_key), _texts(VAGUE))
    return F.filter(places, lambda x: (plain_key(x) != "") & ~F.array_contains(taken, plain_key(x)))


def event_year(start: Column | str, year: Column | str) -> Column:
    """The first year in the start date's text, else the year as it stands; null if there is none."""
    found = F.regexp_extract(clean_text(start), _YEAR, 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.nullif(clean_text(year), F.lit("")))


def may_be_summarised(
    title: Column | str, body: Column | str, url: Column | str, source: Column | str, confidence: Column | str, reasons: Column, penalties: Column,
    published_year: Column, year: Column, hazard: Column | str, places: Column, countries: Column,
) -> Column:
    """Whether an article is about the event itself.

    It must have no barring mark, no other year in title or address, be published within a year of the event, name the hazard
    and the date (by its marks or in its text) and not be of low confidence. Where the event has places of its own, one of them
    must be named; else its country, with high confidence, or medium from a trusted source. Nulls count as absent.
    """
    marks = lambda c: F.coalesce(c, _texts(()))
    level = F.lower(clean_text(confidence))
    said = F.concat_ws(" ", *[F.nullif(clean_text(c), F.lit("")) for c in (title, body)])
    apart = F.abs(published_year.try_cast("int") - year.try_cast("int"))
    barred = F.arrays_overlap(marks(penalties), _texts(BARRED_MARKS)) | (year.isNotNull() & wrong_year(title, url, year)) | F.coalesce(apart > 1, F.lit(False)) | (level == "low")
    hazard_named = F.arrays_overlap(marks(reasons), _texts(HAZARD_MARKS)) | mentions_any(said, hazard_terms(hazard))
    date_named = F.arrays_overlap(marks(reasons), _texts(DATE_MARKS)) | F.coalesce(F.contains(said, year), F.lit(False)) | F.coalesce(apart == 0, F.lit(False))
    own = specific_terms(places, countries)
    trusted = reduce(or_, (F.startswith(clean_text(source), F.lit(s)) for s in TRUSTED))
    by_country = mentions_any(said, countries) & ((level == "high") | (trusted & (level == "medium")))
    return ~barred & hazard_named & date_named & F.when(F.size(own) > 0, mentions_any(said, own)).otherwise(by_country)
