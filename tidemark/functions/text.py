"""Keys and other text functions.

There are five different keys, which are not the same and must not be mixed; those that need Unicode
normalisation are Arrow-batched functions, the rest built-in expressions.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import clean_text, col, collapse


_TEXT, _TEXTS = T.StringType(), T.ArrayType(T.StringType())


def _by_value(f: Callable[[str], object], kind: T.DataType):
    """An Arrow-batched function of one text; null counts as empty. Equal texts of a batch are worked on once."""

    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        known = {v: f(v) for v in s.fillna("").unique()}
        return s.fillna("").map(known)

    return run


# --- keys -------------------------------------------------------------------------------------------------------


def fold(text: str) -> str:
    """Without combining marks (compatibility decomposition)."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _spaced(text: str) -> str:
    return " ".join(re.sub(r"[^a-z0-9]+", " ", text).split())


def _folded_key(text: str) -> str:
    return _spaced(fold(text).lower())


def _ascii_key(text: str) -> str:
    return _spaced(unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower())


def _word_key(text: str) -> str:
    text = fold(text).lower().replace("&", " and ").replace("-", " ")
    return " ".join(re.sub(r"[^\w\s]+", " ", text).split())


#: Words that say what kind of place it is.
PLACE_WORDS = (
    "area", "city", "county", "department", "district", "island", "islands", "municipality", "near", "of", "prefecture",
    "province", "provinces", "region", "regions", "state", "states", "territory", "the", "town", "village", "districts", "counties",
)


def _entity_key(text: str) -> str:
    return " ".join(w for w in _ascii_key(text).split() if w not in PLACE_WORDS)


def multilingual(text: str) -> str:
    """Compatibility forms and cases are one, joiners go."""
    text = unicodedata.normalize("NFKC", text).casefold().replace("‌", "").replace("‍", "")
    return " ".join(text.split())


def _term_key(text: str) -> str:
    text = re.sub(r"[\"'“”‘’«»]", "", unicodedata.normalize("NFKC", text).lower())
    return re.sub(r"^[\W_]+|[\W_]+$", "", " ".join(text.split()))


folded_key = _by_value(_folded_key, _TEXT)
ascii_key = _by_value(_ascii_key, _TEXT)
word_key = _by_value(_word_key, _TEXT)
entity_key = _by_value(_entity_key, _TEXT)
multilingual_key = _by_value(multilingual, _TEXT)
term_key = _by_value(_term_key, _TEXT)
strip_accents = _by_value(fold, _TEXT)


def plain_key(c: Column | str) -> Column:
    """Lower case, runs of other signs than a-z and 0-9 become a space; no folding, so an accented letter is a gap."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", " "))


def compact_key(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", "")


def title_key(c: Column | str) -> Column:
    """A title's key without markup and without a trailing `` - Outlet`` or `` | Outlet`` of 3 to 60 characters."""
    return plain_key(F.regexp_replace(F.trim(strip_tags(c)), r"\s*[-|]\s*[^-|]{3,60}$", ""))


#: Words that an entity's key leaves out.
ENTITY_STOPS = (
    "the", "a", "an", "of", "and", "or", "in", "on", "at", "to", "for", "state", "province", "district", "region", "city", "area", "areas",
    "department", "county", "municipality", "island", "islands",
)


def event_key(c: Column | str) -> Column:
    """Lower-case words of a-z and 0-9 without articles, prepositions and units."""
    words = F.split(plain_key(c), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*ENTITY_STOPS)), " ")


def hash12(c: Column | str) -> Column:
    return F.substring(F.sha1(col(c).cast("binary")), 1, 12)


# --- shapes -----------------------------------------------------------------------------------------------------


def truncate(c: Column | str, most: int) -> Column:
    """At most so many characters; a longer text ends with an ellipsis of three dots."""
    text = F.coalesce(col(c), F.lit(""))
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, most - 3)), F.lit("...")))


def id_base(c: Column | str) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(col(c), F.lit(""))), r"_\d+$", "")


def safe_part(c: Column | str) -> Column:
    part = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(col(c), F.lit(""))), "[^A-Za-z0-9_.-]+", "_"), "^_+|_+$", "")
    return F.when(part == "", "unknown").otherwise(part)


def without_article(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?i)^\s*the\s+", "")


def without_parentheses(c: Column | str) -> Column:
    return collapse(F.regexp_replace(col(c), r"\([^)]*\)", " "))


def in_parentheses(c: Column | str) -> Column:
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(col(c), F.lit(r"\(([^)]*)\)"), F.lit(1)), lambda x: F.trim(x)), lambda x: x != ""))


def tidy_quotes(c: Column | str) -> Column:
    """Curly quotes and long dashes become plain ones."""
    return collapse(F.translate(col(c), "‘’“”–—−", "''\"\"---"))


def mentions(text: Column | str, term: Column | str) -> Column:
    """Whether the term, of three characters at least, occurs as whole words (on plain keys)."""
    key = plain_key(term)
    return (F.length(key) >= 3) & F.contains(F.concat(F.lit(" "), plain_key(text), F.lit(" ")), F.concat(F.lit(" "), key, F.lit(" ")))


def mentions_any(text: Column | str, terms: Column) -> Column:
    padded = F.concat(F.lit(" "), plain_key(text), F.lit(" "))
    return F.exists(terms, lambda t: (F.length(plain_key(t)) >= 3) & F.contains(padded, F.concat(F.lit(" "), plain_key(t), F.lit(" "))))


def list_text(c: Column | str) -> Column:
    """Items of a list written as text: bracketed and quoted, or split at ``|``, ``,`` or ``;``."""
    bare = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"^\s*\[|\]\s*$", "")
    items = F.transform(F.split(bare, r"\s*[|,;]\s*"), lambda x: F.regexp_replace(F.trim(x), "^[\"']|[\"']$", ""))
    return F.filter(items, lambda x: x != "")


def distinct_terms(terms: Column, least: int = 3, most: int | None = None) -> Column:
    """Terms in order, the first spelling of each (case apart), of ``least`` characters at least."""
    tidy = F.filter(F.transform(terms, collapse), lambda x: F.length(x) >= least)
    kept = F.filter(tidy, lambda x, i: F.array_position(F.transform(tidy, lambda y: F.lower(y)), F.lower(x)) == i + 1)
    return F.slice(kept, 1, most) if most else kept


def quoted_or_block(terms: Column) -> Column:
    """``(a OR "b c")``, terms with white space quoted."""
    return F.concat(F.lit("("), F.array_join(F.transform(terms, lambda t: F.when(t.rlike(r"\s"), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t)), " OR "), F.lit(")"))


# --- places -----------------------------------------------------------------------------------------------------

#: Names that say nothing about where.
GENERIC_PLACES = ("country", "nationwide", "several", "various", "many", "unknown", "whole country", "entire country")


def place_reasons(place: Column | str, generic: tuple[str, ...] = GENERIC_PLACES) -> Column:
    """Comma-joined reasons against a place name, in a fixed order."""
    p = collapse(place)
    low = F.lower(p)
    return F.concat_ws(
        ",",
        F.when(F.length(p) < 3, F.lit("too_short")),
        F.when(low.isin(*generic), F.lit("generic_place")),
        F.when(F.length(p) > 140, F.lit("very_long")),
        F.when(p.rlike(r"\d"), F.lit("contains_number")),
        F.when(low.rlike(r"\b(near|around|about|approximately)\b"), F.lit("approximate")),
        F.when(F.length(p) - F.length(F.translate(p, ",", "")) >= 2, F.lit("multiple_commas")),
    )


def place_quality(place: Column | str) -> Column:
    reasons = F.split(place_reasons(place), ",")
    return F.when(F.arrays_overlap(reasons, F.array(F.lit("too_short"), F.lit("generic_place"))), "review").otherwise("usable")


def _split_place(text: str) -> list[str]:
    """Parts at ``|`` and ``;``; a trailing ``(context)`` is a part of its own, split in turn."""
    out: list[str] = []
    for part in re.split(r"[|;]", text):
        part = " ".join(part.split()).strip(" ,")
        m = re.fullmatch(r"(.*\S)\s*\(([^()]*)\)", part)
        if m:
            out += [m[1].strip(" ,"), *_split_place(m[2])]
        elif part:
            out.append(part)
    seen: dict[str, str] = {}
    for p in out:
        seen.setdefault(_folded_key(p), p)
    return [p for p in seen.values() if p]


def _name_variants(text: str) -> list[str]:
    return list(dict.fromkeys(k for k in map(_word_key, [text, *re.split(r"[/|;]", text)]) if k))


#: What is put for a phrase around a place's name, in this order; cases are one.
CONTEXT = (
    (r"^\s*and\s+", ""), (r"^\s*near\s+", ""), (r"^\s*north\s+of\s+(?:the\s+)?", ""), (r"^\s*(?:the\s+)?town\s+of\s+", ""),
    (r"\s+in\s+the\s+(?:north|south|east|west)$", ""), (r"\s+(?:area|areas)$", ""),
)
#: Words for a kind of unit.
UNITS = (
    "autonomous region", "capital city area", "capital city", "city area", "city", "counties", "county", "departments", "department", "districts",
    "district", "governorates", "governorate", "municipalities", "municipality", "muncipalities", "muncipality", "prefecture", "provinces", "province",
    r"prov\.", "regencies", "regency", "regions", "region", "states", "state", "territory", "islands", "island", r"isl\.", "town", "villages", "village",
)
#: Units that a list may share, each with its singular; the last has none.
SHARED_UNITS = {
    "departments": "department", "districts": "district", "governorates": "governorate", "islands": "island", "provinces": "province",
    "regencies": "regency", "regions": "region", "states": "state", "villages": "village", "counties": "",
}
_UNIT = re.compile(rf"\b(?:{'|'.join(UNITS)})\b\.?", re.I)
_SHARED = re.compile(rf"(?P<body>.+?)\s+(?P<unit>{'|'.join(SHARED_UNITS)})", re.I)
_PAIR = re.compile(rf"(?P<left>.+?)\s+and\s+(?P<right>.+?)\s+(?P<unit>{'|'.join(SHARED_UNITS)})", re.I)


def _one_space(text: str) -> str:
    return " ".join(text.split())


def without_context(text: str) -> str:
    text = _one_space(text)
    for pattern, put in CONTEXT:
        text = re.sub(pattern, put, text, flags=re.I)
    return _one_space(text)


def _bare_place(text: str) -> str:
    return without_context(re.sub(r"\s*\([^()]+\)\s*", " ", text))


def _pieces(text: str, at: str) -> list[str]:
    """The parts between separators, without a leading article."""
    parts = (_one_space(re.sub(r"^\s*the\s+", "", x, flags=re.I)) for x in re.split(at, text))
    return [x for x in parts if x]


def _short(parts: list[str], most: int, words: int = 5) -> list[str]:
    return parts if 2 <= len(parts) <= most and all(len(x.split()) <= words for x in parts) else []


_COMMAS = r"\s*,\s*|\s+\band\b\s+"


def _list_parts(text: str) -> list[str]:
    """``A, B and C`` of 2 to 5 parts, else ``A in B``; each part of 5 words at most."""
    bare = _bare_place(text)
    return _short(_pieces(bare, _COMMAS), 5) or _short(_pieces(bare, r"\s+\bin\b\s+"), 2)


def _unique(parts: list[str]) -> list[str]:
    return [x for x in dict.fromkeys(map(without_context, parts)) if x]


def _shared_unit(text: str) -> list[str]:
    """``A, B and C provinces``: 2 to 6 parts, each with the unit in the singular if it has none of its own."""
    m = _SHARED.fullmatch(_bare_place(text))
    unit = SHARED_UNITS[m["unit"].lower()] if m else ""
    parts = _short(_pieces(m["body"], _COMMAS), 6, 6) if unit else []
    return _unique([x if _UNIT.search(x) else f"{x} {unit}" for x in parts])


def _composite_parts(text: str) -> list[str]:
    """All parts of a place that is several: by a shared unit, else by a pair with one and by a list; then those in parentheses."""
    twice = lambda parts: [v for x in parts for v in (x, _UNIT.sub(" ", x))]
    found = _shared_unit(text)
    if not found:
        m = _PAIR.fullmatch(_bare_place(text))
        if m:
            pair = [f"{m[side]} {SHARED_UNITS[m['unit'].lower()]}" for side in ("left", "right")]
            found += pair + [_UNIT.sub(" ", x) for x in pair]
        found += twice(_list_parts(text))
    inner = [x for x in dict.fromkeys(without_context(x) for x in re.findall(r"\(([^()]+)\)", _one_space(text))) if x]
    return _unique(found + twice(inner))


def _place_spellings(text: str) -> list[str]:
    """Ways to write one place: as it is, without parentheses, an island in full, without its unit, and each side of a slash."""
    island = _one_space(re.sub(r"\bisl\.(?=\W|$)", "Island", text, flags=re.I))
    return _unique([text, text, re.sub(r"\s*\([^()]+\)\s*", " ", text), island, _UNIT.sub(" ", text), *re.split(r"\s*/\s*", text)])


def _without_units(text: str) -> str:
    return _one_space(_UNIT.sub(" ", text))


split_place = _by_value(_split_place, _TEXTS)
name_variants = _by_value(_name_variants, _TEXTS)
list_parts = _by_value(_list_parts, _TEXTS)
composite_parts = _by_value(_composite_parts, _TEXTS)
shared_unit_parts = _by_value(_shared_unit, _TEXTS)
place_spellings = _by_value(_place_spellings, _TEXTS)
without_units = _by_value(_without_units, _TEXT)
bare_place = _by_value(_bare_place, _TEXT)


def place_query(place: Column | str, country: Column | str) -> Column:
    return F.concat_ws(", ", F.nullif(collapse(place), F.lit("")), F.nullif(collapse(country), F.lit("")))


#: Short names of countries, by their folded keys.
COUNTRY_NAMES = {
    "bolivia plurinational state of": ("Bolivia",), "cote d ivoire": ("Ivory Coast", "Cote d'Ivoire"), "iran islamic republic of": ("Iran",),
    "tanzania united republic of": ("Tanzania",), "venezuela bolivarian republic of": ("Venezuela",), "viet nam": ("Vietnam",),
    "russian federation": ("Russia",), "state of palestine": ("Palestine",), "taiwan province of china": ("Taiwan",), "turkiye": ("Turkey",),
}


def _query_variants(query: str, place: str, country: str) -> list[tuple[str, str]]:
    place, country = _one_space(place), _one_space(country)
    found = [("original", _one_space(query))]
    if place and country:
        countries = list(dict.fromkeys((country, *COUNTRY_NAMES.get(_folded_key(country), ()))))
        for spelling in _place_spellings(place):
            bare = _without_units(spelling)
            for name in countries:
                found.append(("place_country", f"{spelling}, {name}"))
                if bare and bare != spelling:
                    found.append(("without_admin_qualifier", f"{bare}, {name}"))
        found += [("split_component", f"{part}, {name}") for part in _composite_parts(place) for name in countries]
    first: dict[str, str] = {}
    for label, text in found:
        first.setdefault(_one_space(text), label)
    return [(label, text) for text, label in first.items() if text]


@F.pandas_udf(T.ArrayType(T.StructType().add("label", _TEXT).add("query", _TEXT)))
def query_variants(query: pd.Series, place: pd.Series, country: pd.Series) -> pd.Series:
    """(label, query) in the order in which a geocoder is asked."""
    rows = zip(*(x.fillna("") for x in (query, place, country)), strict=True)
    return pd.Series([[{"label": label, "query": text} for label, text in _query_variants(*row)] for row in rows])


def with_query_variants(df: DataFrame, place: str, country: str) -> DataFrame:
    """Adds ``variants``, (label, query) in order, for the query ``place, country``."""
    return df.withColumn("variants", query_variants(place_query(place, country), F.col(place), F.col(country)))


# --- markup -----------------------------------------------------------------------------------------------------

_RAW = ("script", "style", "noscript", "svg")
_DROPPED = (*_RAW, "nav", "header", "footer", "aside", "form")
#: Signs of a consent or block page.
CONSENT = (
    "consent.google.com", "if you choose to accept all", "if you choose to reject all", "manage your privacy settings", "we use cookies and data",
    "before you continue", "enable javascript and cookies",
)


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), "<[^>]+>", "")


def paragraphs(c: Column | str) -> Column:
    """Texts of the ``<p>`` elements that are closed, without markup, in order."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1))
    return F.filter(F.transform(found, lambda p: collapse(F.regexp_replace(p, "<[^>]+>", " "))), lambda p: p != "")


@F.pandas_udf(_TEXTS)
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda parts: [" ".join(html.unescape(x).split()) for x in parts])


def main_chunks(c: Column | str, least: int = 50) -> Column:
    """Texts, of at least ``least`` characters, of a page's articles and main parts; without any, of its paragraphs; without these, of its divisions."""
    page = F.coalesce(col(c), F.lit(""))
    for tag in _DROPPED:
        page = F.regexp_replace(page, rf"(?is)<{tag}{'' if tag in _RAW else '[^>]*>'}.*?</{tag}>", " ")
    inside = lambda tag: F.regexp_extract_all(page, F.lit(rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1))
    marked, texts = F.concat(inside("article"), inside("main")), inside("p")
    parts = F.when(F.size(marked) > 0, marked).when(F.size(texts) > 0, texts).otherwise(inside("div"))
    spaced = F.transform(parts, lambda x: strip_tags(F.regexp_replace(x, r"(?i)<br\s*/?>|</(?:p|div|h[1-6]|li)>", " ")))
    return F.filter(_unescaped(spaced), lambda x: F.length(x) >= least)


def main_text(c: Column | str, most: int = 6000) -> Column:
    return F.substring(F.array_join(main_chunks(c), " "), 1, most)


def is_consent_page(url: Column | str, text: Column | str) -> Column:
    address, body = F.lower(F.coalesce(col(url), F.lit(""))), F.lower(collapse(text))
    out = F.lit(False)
    for sign in CONSENT:
        out = out | F.contains(address, F.lit(sign)) | F.contains(body, F.lit(sign))
    return out


def redirect_target(url: Column | str) -> Column:
    """The address in a redirect's ``uddg`` parameter, else the address itself, with a scheme."""
    full = F.when(col(url).startswith("//"), F.concat(F.lit("https:"), col(url))).otherwise(col(url))
    return F.coalesce(F.try_url_decode(F.try_parse_url(full, F.lit("QUERY"), F.lit("uddg"))), full)


def repeated_letters(c: Column | str) -> Column:
    return col(c).rlike(r"(\p{L})\1{2,}")


def has_latin(c: Column | str) -> Column:
    return col(c).rlike(r"\p{IsLatin}")


def has_other_script(c: Column | str) -> Column:
    return col(c).rlike(r"[\p{L}&&[^\p{IsLatin}]]")


def blank_normal(c: Column | str) -> Column:
    return clean_text(c)
