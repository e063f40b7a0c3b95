"""Boxes and distances on longitude and latitude."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.clean import col

#: Fixed value: kilometres in a degree of latitude.
KM = 111.32


def point_box(lat: Column | str, lon: Column | str, half_km: float) -> Column:
    """[west, south, east, north] around a point."""
    dy = F.lit(half_km / KM)
    dx = F.lit(half_km) / (F.lit(KM) * F.greatest(F.cos(F.radians(col(lat))), F.lit(0.01)))
    return F.array(*[F.round(x, 6) for x in (col(lon) - dx, col(lat) - dy, col(lon) + dx, col(lat) + dy)])


def box_size(west: Column | str, south: Column | str, east: Column | str, north: Column | str) -> Column:
    """width_km, height_km, area_km2 at the middle latitude."""
    height = (col(north) - col(south)) * KM
    width = (col(east) - col(west)) * KM * F.cos(F.radians((col(south) + col(north)) / 2))
    return F.struct(width.alias("width_km"), height.alias("height_km"), (width * height).alias("area_km2"))


def box_reasons(size: Column, units: Column, review_area: float = 1e5, large_area: float = 1e6, review_side: float = 500.0, review_units: int = 20) -> Column:
    return F.concat_ws(
        ",",
        F.when(size["area_km2"] >= large_area, F.lit("very_large_area")).when(size["area_km2"] >= review_area, F.lit("large_area")),
        F.when((size["width_km"] >= review_side) | (size["height_km"] >= review_side), F.lit("long_side")),
        F.when(units >= review_units, F.lit("many_units")),
    )


def pixels(size_km: Column, resolution_m: int) -> Column:
    """Pixels along a side: rounded half to even, at least one."""
    return F.greatest(F.lit(1), F.bround(size_km * 1000 / resolution_m).cast("int"))


def tile_names(west: Column, south: Column, east: Column, north: Column, step: int = 3) -> Column:
    """Names like ``N03E012`` of the tiles of a grid that a box touches."""
    down = lambda c: (F.floor(c / step) * step).cast("int")
    up = lambda c: F.greatest((F.ceil(c / step) * step - step).cast("int"), F.lit(-180))
    lats, lons = F.sequence(down(south), F.greatest(up(north), down(south)), F.lit(step)), F.sequence(down(west), F.greatest(up(east), down(west)), F.lit(step))
    name = lambda a, o: F.concat(F.when(a < 0, "S").otherwise("N"), F.lpad(F.abs(a).cast("string"), 2, "0"), F.when(o < 0, "W").otherwise("E"), F.lpad(F.abs(o).cast("string"), 3, "0"))
    return F.flatten(F.transform(lats, lambda a: F.transform(lons, lambda o: name(a, o))))


def cover_release(day: Column | str) -> Column:
    year = F.year(col(day))
    return F.struct(F.when(year <= 2020, 2020).otherwise(2021).alias("year"), F.when(year <= 2020, "v100").otherwise("v200").alias("version"))


def inside(lat: Column | str, lon: Column | str, west: Column, south: Column, east: Column, north: Column) -> Column:
    return col(lat).between(south, north) & col(lon).between(west, east)


def valid_point(lat: Column | str, lon: Column | str) -> Column:
    return F.coalesce(col(lat).between(-90, 90) & col(lon).between(-180, 180), F.lit(False))


def crosses_date_line(west: Column, south: Column, east: Column, north: Column) -> Column:
    return (west < -180) | (east > 180) | (south <= -90) | (north >= 90)


def geometry_box(c: Column | str) -> Column:
    """[west, south, east, north] of any GeoJSON geometry text, from all its positions."""
    pairs = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"\[\s*(-?[\d.eE+-]+\s*,\s*-?[\d.eE+-]+)"), F.lit(1))
    xy = lambda i: F.filter(F.transform(pairs, lambda p: F.get(F.split(p, r"\s*,\s*"), F.lit(i)).try_cast("double")), lambda v: v.isNotNull())
    x, y = xy(0), xy(1)
    return F.when(F.size(x) > 0, F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)))
