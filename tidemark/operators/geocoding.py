"""Positions: statuses, candidate scores, review rules, cascades and units from JSON."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import as_number, clean_text, col, has_text, unit_level
from tidemark.functions.geo import box_reasons, box_size, valid_point
from tidemark.functions.text import folded_key, without_units
from tidemark.operators.ordered import first_failing, first_row, joined_in_order

#: Kinds of places.
ADMIN_WORDS = r"(?i)\b(?:autonomous region|city|city area|county|department|district|governorate|municipality|prefecture|province|prov\.|regency|region|state|territory)\b"
GOOD_CLASSES = ("boundary", "place")
GOOD_TYPES = ("administrative", "city", "county", "island", "municipality", "province", "region", "state", "town", "village")
BAD_CLASSES = ("amenity", "building", "craft", "historic", "leisure", "office", "shop", "tourism")
AREA_TYPES = ("administrative", "state", "province", "region", "county", "district", "municipality", "territory", "prefecture", "governorate", "department")
LOCAL_TYPES = ("city", "town", "village", "hamlet", "suburb", "neighbourhood", "quarter", "borough", "residential", "locality", "township")
NATURAL_TYPES = ("river", "island", "archipelago", "lake", "bay", "gulf", "strait", "water", "reservoir", "valley", "mountain", "peak", "volcano", "peninsula", "desert")
POI_TYPES = (
    "fuel", "government", "hotel", "bank", "cafe", "restaurant", "school", "university", "hospital", "bus_stop", "station", "cemetery", "attraction",
    "bridge", "office", "retail", "supermarket", "industrial", "commercial", "house", "building",
)
#: Words of a query for an administrative area.
AREA_QUERY_WORDS = ("province", "state", "region", "district", "county", "department", "governorate", "prefecture", "territory", "oblast", "municipality", "kanto", "kanton")
SOURCES = ("em-dat", "ADM/GADM", "llm_nominatim", "llm_nominatim_review_accepted")


def status(lat: Column | str, lon: Column | str, units: Column, location: Column | str) -> Column:
    return (
        F.when(as_number(lat).isNotNull() & as_number(lon).isNotNull(), "direct_coordinates")
        .when(units, "gadm_or_admin_units").when(has_text(location), "location_text_only").otherwise("missing_location")
    )


def candidate_score(place: Column, core: Column, display: Column, kind: Column, type_: Column, query: Column, rank: Column, importance: Column, side: Column) -> Column:
    """(score, quality, reasons) of a geocoder's candidate; ``side`` is its longer box side in degrees."""
    admin = query.rlike(ADMIN_WORDS)
    p, c, d = folded_key(place), folded_key(without_units(core)), folded_key(display)
    by_place = (p != "") & F.contains(d, p)
    small = admin & (side > 0) & (side < 0.75)
    rules = [
        (kind.isin(*GOOD_CLASSES), 3.0, "good_class"),
        (type_.isin(*GOOD_TYPES), 2.0, "good_type"),
        (by_place, 2.0, "place_in_display_name"),
        (~by_place & (c != "") & F.contains(d, c), 2.0, "core_place_in_display_name"),
        (rank == 1, 0.5, "first_result"),
        (kind.isin(*BAD_CLASSES), -4.0, "poi_or_non_admin_class"),
        (admin & (kind != "") & ~kind.isin(*GOOD_CLASSES), -3.0, "admin_query_non_admin_result"),
        (small, -3.0, "small_bbox_for_admin_query"),
    ]
    score = F.least(F.coalesce(as_number(importance), F.lit(0.0)), F.lit(1.0))
    for holds, points, _ in rules:
        score = score + F.when(holds, points).otherwise(0.0)
    return F.struct(score.alias("score"), F.when((score >= 3.0) & ~F.coalesce(small, F.lit(False)), "accepted").otherwise("review").alias("quality"), F.concat_ws(",", *[F.when(h, F.lit(n)) for h, _, n in rules]).alias("reasons"))


def _bare(c: Column | str) -> Column:
    return F.translate(F.lower(clean_text(c)), "'’", "")


def country_only(query: Column | str, country: Column | str, location: Column | str) -> Column:
    """Whether a query is no more than the country of an event without a location."""
    return (_bare(query) != "") & (_bare(query) == _bare(country)) & (clean_text(location) == "")


def small_area_box(query: Column | str, width: Column | str, height: Column | str, least: float = 0.05) -> Column:
    """Whether a query for an administrative area got a box with both sides known and none of ``least`` degrees."""
    area = reduce(or_, [F.contains(_bare(query), F.lit(w)) for w in AREA_QUERY_WORDS])
    w, h = as_number(width), as_number(height)
    return F.coalesce(area & (F.greatest(w, h) < least) & w.isNotNull() & h.isNotNull(), F.lit(False))


def review_decision(lat: Column, lon: Column, type_: Column, country_only: Column, small_box: Column) -> Column:
    """(decision, bucket): the first rule that holds."""
    t = F.lower(clean_text(type_))
    pair = lambda d, b: F.struct(F.lit(d).alias("decision"), F.lit(b).alias("bucket"))
    return (
        F.when(as_number(lat).isNull() | as_number(lon).isNull(), pair("reject", "missing_coordinates"))
        .when(country_only, pair("accept", "country_fallback_empty_location"))
        .when(t.isin(*POI_TYPES), pair("reject", "poi_or_non_geographic_type"))
        .when(t.isin(*AREA_TYPES) & small_box, pair("reject", "small_bbox_for_admin_query"))
        .when(t.isin(*AREA_TYPES), pair("accept", "admin_or_area_result"))
        .when(t.isin(*LOCAL_TYPES), pair("accept", "populated_or_local_place"))
        .when(t.isin(*NATURAL_TYPES), pair("accept", "natural_geographic_feature"))
        .when(t == "historic", pair("accept", "historic_region_like_result"))
        .otherwise(pair("reject", "unsupported_place_type"))
    )


def review_risk(width: Column, height: Column, variant: Column, query: Column, display: Column) -> Column:
    """(bucket, reasons) of a result that needs a look."""
    side = F.coalesce(F.greatest(width, height), F.lit(0.0))
    composite = query.rlike(r"(?i)\b(?:and|including)\b") | (F.length(query) - F.length(F.translate(query, ",", "")) >= 2)
    poi = display.rlike(r"(?i)hotel|school|hospital|station|airport|restaurant|office|museum|church|mosque|temple|bank|shop|mall|stadium|university|college|market|clinic")
    rules = [
        (side <= 0, "missing_bbox", 0), ((side > 0) & (side <= 0.02), "tiny_bbox", 0), ((side > 0.02) & (side <= 0.1), "small_bbox", 0),
        (side >= 15, "very_large_bbox", 1), ((side >= 8) & (side < 15), "large_bbox", 1),
        (variant == "split_component", "split_component_query", 2), (composite, "composite_query", 2), (poi, "possible_poi_result", 0),
    ]
    either = lambda k: reduce(or_, [F.coalesce(h, F.lit(False)) for h, _, g in rules if g == k])
    bucket = F.when(either(0), "high_risk_review").when(either(1), "large_area_review").when(either(2), "composite_review").otherwise("review_candidate")
    return F.struct(bucket.alias("bucket"), F.concat_ws(",", *[F.when(h, F.lit(n)) for h, n, _ in rules]).alias("reasons"))


def position(sources: Mapping[str, tuple[Column, Column]]) -> Column:
    """(source, latitude, longitude) of the first source with a valid point; ``not_recovered`` if there is none."""
    out = F.struct(F.lit("not_recovered").alias("source"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))
    for name, (lat, lon) in reversed(sources.items()):
        out = F.when(valid_point(lat, lon), F.struct(F.lit(name).alias("source"), lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude"))).otherwise(out)
    return out


def deepest_unit(items: Column, levels: int = 3, id_: str = "gid_{}", name: str = "name_{}") -> Column:
    """Of each JSON item (a map) the deepest level that has an id or a name."""
    def unit(item: Column) -> Column:
        return F.coalesce(*[
            F.when(has_text(F.try_element_at(item, F.lit(id_.format(n)))) | has_text(F.try_element_at(item, F.lit(name.format(n)))),
                   F.struct(F.lit(n).alias("level"), F.try_element_at(item, F.lit(id_.format(n))).alias("unit_id"), F.try_element_at(item, F.lit(name.format(n))).alias("unit_name")))
            for n in range(levels, 0, -1)
        ])

    return F.filter(F.transform(items, unit), lambda u: u.isNotNull())


def json_items(text: Column | str) -> Column:
    """A JSON list of objects as maps; anything else is empty."""
    return F.coalesce(F.from_json(col(text), "array<map<string,string>>", {"mode": "PERMISSIVE"}), F.array().cast("array<map<string,string>>"))


def box_union(units: DataFrame, event: str, order: str, keep: list[str], only_level: int = 0) -> DataFrame:
    """For each event the box around its matched units, their number, its size and what speaks against it."""
    rows = units.filter(F.col("west").isNotNull())
    rows = rows.filter(F.col("unit_level") == only_level) if only_level else rows
    one = rows.groupBy(event).agg(
        first_row(keep, order).alias("_f"), F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"), F.count_distinct("unit_id").alias("units"),
    )
    sized = one.select(event, "_f.*", "west", "south", "east", "north", "units").withColumn("size", box_size("west", "south", "east", "north"))
    return sized.withColumn("reasons", box_reasons(F.col("size"), F.col("units"))).withColumn("quality", F.when(F.col("reasons") == "", "usable").otherwise("review"))


def selection_status(id_: Column, kind: Column, day: Column, lat: Column, lon: Column, since: str = "2014-04-03", wanted: str = "", chain: Column | None = None) -> Column:
    """``selected`` or the first check that fails."""
    valid_id = (clean_text(id_) != "") & ~id_.rlike(r"[/\\:]") & ~id_.isin(".", "..")
    checks = [
        ("invalid_event_id", valid_id), ("missing_disaster_type", clean_text(kind) != ""), ("missing_or_invalid_date", day.isNotNull()),
        ("missing_coordinates", lat.isNotNull() & lon.isNotNull()), ("invalid_coordinates", (lat > -90) & (lat < 90) & lon.between(-180, 180)),
    ]
    if wanted:
        checks.append(("type_filter", F.lower(kind) == wanted.lower()))
    if since:
        checks.append(("before_start_date", day >= F.lit(since).cast("date")))
    if chain is not None:
        checks.append(("no_valid_causal_chain", chain == "valid"))
    return first_failing(checks)


def unmatched_diagnosis(events: DataFrame, units: DataFrame, boxes: DataFrame, files: DataFrame, event: str, order: str, level: int = 2) -> DataFrame:
    """Each event with the reason why its units of a level have no boxes, and with their counts, ids and names.

    ``events`` has an ``iso``, ``units`` has unit_level, unit_id, unit_name, source_field and an order, ``boxes`` has unit_level
    and match_status, ``files`` lists the isos that boundaries are at hand for. Both sides are counted by event before they
    are joined; events without units or boxes stay.
    """
    at = unit_level("unit_level")
    here = lambda c: F.when(at == level, col(c))
    with_id = (at == level) & (F.col("source_field") == "GADM Admin Units") & F.col("unit_id").isNotNull()
    own = units.withColumn("_id", here("unit_id")).withColumn("_name", here("unit_name")).groupBy(event).agg(
        F.array_join(F.array_sort(F.collect_set(F.when(at >= 0, at))).cast("array<string>"), " | ").alias("source_levels"),
        F.count(F.when(at == level, 1)).alias("source_rows"), F.count(F.when(with_id, 1)).alias("id_rows"),
        joined_in_order("_id", order).alias("unit_ids"), joined_in_order("_name", order).alias("unit_names"))
    matched = boxes.groupBy(event).agg(F.count(F.when((at == level) & (F.col("match_status") == "matched"), 1)).alias("matched_rows"))
    known = files.select(F.upper(F.trim("iso")).alias("iso"), F.lit(True).alias("has_file")).distinct()
    tidy = events.withColumn("iso", F.upper(F.trim(F.coalesce("iso", F.lit("")))))
    out = tidy.join(own, event, "left").join(matched, event, "left").join(known, "iso", "left")
    out = out.fillna(0, ["source_rows", "id_rows", "matched_rows"]).fillna("", ["source_levels", "unit_ids", "unit_names"]).fillna({"has_file": False})
    category = (
        F.when(F.col("source_rows") == 0, "no_adm2_source_rows").when(~F.col("has_file"), "missing_gadm_adm2_file")
        .when(F.col("matched_rows") > 0, "matched_adm2_not_in_remaining_set").when(F.col("id_rows") > 0, "unmatched_gadm_ids").otherwise("unmatched_adm2_names"))
    return out.withColumn("name_only_rows", F.col("source_rows") - F.col("id_rows")).withColumn("category", category)
