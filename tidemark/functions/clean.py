"""Column helpers for missing values, lenient casts and first-present cascades.

All are built-in expressions, so they stay in generated code and can be pushed to scans where Spark allows it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of a missing value.
MISSING = ("", "none", "null", "nan", "nat")
BLANK_TEXT = ("nan", "none", "null", "[]")
#: Codes that measurements use for a missing value.
FILLS = (-999.0, -9999.0)
TRUE_WORDS = ("true", "1", "yes")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once a row, however often f names it, inside functions of array elements, too."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def is_missing(c: Column | str) -> Column:
    """Null, or a spelling of missing once trimmed and lower-cased."""
    return col(c).isNull() | F.lower(F.trim(col(c).cast("string"))).isin(*MISSING)


def collapse(c: Column | str) -> Column:
    """White space runs become one space, ends are trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"\s+", " "))


def clean_text(c: Column | str, blanks: Iterable[str] = BLANK_TEXT) -> Column:
    text = collapse(c)
    return F.when(F.lower(text).isin(*blanks), "").otherwise(text)


def has_text(c: Column | str) -> Column:
    return clean_text(c) != ""


def first_present(*columns: Column | str) -> Column:
    """The first value that isn't missing."""
    return F.coalesce(*[F.when(~is_missing(c), col(c)) for c in columns])


def first_text(*columns: Column | str) -> Column:
    return F.coalesce(*[F.nullif(clean_text(c), F.lit("")) for c in columns], F.lit(""))


def first_column(df: DataFrame, names: Iterable[str]) -> str | None:
    """The first of the names that is a column of the frame."""
    return next((n for n in names if n in df.columns), None)


def as_number(c: Column | str) -> Column:
    """A double; anything that isn't one, and NaN, become null."""
    x = col(c).cast("string").try_cast("double")
    return F.when(~F.isnan(x), x)


def finite(c: Column | str) -> Column:
    x = as_number(c)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def count_of(c: Column | str) -> Column:
    """A whole number of at least 0, else null."""
    x = finite(c)
    return F.when((x >= 0) & (x == F.floor(x)), x.cast("long"))


def measurement(c: Column | str, nonnegative: bool = False, fill: float | None = None) -> Column:
    x = finite(c)
    bad = x.isin(*FILLS) if fill is None else x.isin(*FILLS, float(fill))
    if nonnegative:
        bad = bad | (x < 0)
    return F.when(~bad, x)


def is_true(c: Column | str, words: Iterable[str] = TRUE_WORDS) -> Column:
    return F.coalesce(F.lower(F.trim(col(c).cast("string"))).isin(*words), F.lit(False))


def safe_rate(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(F.try_divide(col(a), col(b)), F.lit(0.0))


def unit_level(c: Column | str) -> Column:
    """A level from text or number; -1 if it is none."""
    return F.coalesce(as_number(c).cast("int"), F.lit(-1))


def level_or_null(c: Column | str, top: int = 5) -> Column:
    x = as_number(c).cast("int")
    return F.when(x.between(0, top), x)


def nested(struct: Column | str, *path: str, default: object = "") -> Column:
    """A value on a path of a JSON text, or the default."""
    return F.coalesce(F.get_json_object(col(struct), "$." + ".".join(path)), F.lit(default))


def drop_blank_entries(m: Column | str) -> Column:
    """A map without its missing values."""
    return F.map_filter(col(m), lambda k, v: ~is_missing(v))


def labelled_lines(pairs: Iterable[tuple[str, Column | str]]) -> Column:
    """``label: value`` lines of the present values; the first value of a label wins."""
    seen: dict[str, Column] = {}
    for label, c in pairs:
        seen[label] = F.coalesce(seen[label], first_present(c)) if label in seen else first_present(c)
    return F.concat_ws("\n", *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in seen.items()])


def scalar_text(c: Column | str, kind: str) -> Column:
    """Arrays as `` | ``-joined text, structs and maps as JSON, others as text."""
    if kind.startswith("array<string"):
        return F.array_join(col(c), " | ")
    return F.to_json(col(c)) if kind.startswith(("array", "struct", "map")) else col(c).cast("string")
