"""Choosing scenes, pixel classes, and ranking by image-derived statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import as_number, col, is_true
from tidemark.operators.ordered import keep_first, top_k


def cloud_of(c: Column | str) -> Column:
    """Missing cloud counts as all cloud; 0 stays 0."""
    return F.coalesce(as_number(c), F.lit(100.0))


def nearest_scene(scenes: DataFrame, keys: Sequence[str], time: str, target: str, order: str) -> DataFrame:
    """The scene nearest in whole days (rounded down before the sign goes), ties by order."""
    away = F.abs(F.floor((F.unix_timestamp(time) - F.unix_timestamp(target)) / 86400))
    return keep_first(scenes, keys, away.asc(), F.col(order).asc())


def clearest_scene(scenes: DataFrame, keys: Sequence[str], cloud: str, time: str, order: str) -> DataFrame:
    return keep_first(scenes, keys, cloud_of(cloud).asc(), F.col(time).asc(), F.col(order).asc())


def two_stage_scene(scenes: DataFrame, keys: Sequence[str], cloud: str, local: str, days: str, order: str, most: float, k: int = 8) -> DataFrame:
    """The k best by tile cloud, then of these the best by local cloud."""
    usable = scenes.filter(F.col(cloud).isNull() | (F.col(cloud) <= most))
    short = top_k(usable, keys, k, cloud_of(cloud).asc(), F.abs(days).asc(), F.col(order).asc()).drop("rank")
    return keep_first(short, keys, cloud_of(local).asc(), F.abs(days).asc(), cloud_of(cloud).asc(), F.col(order).asc())


def apart_in_time(times: Column | str, seconds: float = 2.0, most: int = 3) -> Column:
    """Greedy choice from sorted times (seconds): each must be more than so far from all that are chosen."""
    def step(kept: Column, t: Column) -> Column:
        near = F.exists(kept, lambda k: F.abs(k - t) <= seconds)
        return F.when(near | (F.size(kept) >= most), kept).otherwise(F.array_append(kept, t))

    return F.aggregate(F.array_sort(col(times)), F.array().cast("array<double>"), step)


def darkening(pre: Column, post: Column, valid: Column) -> Column:
    """Radar pixels that became dark: a fall of over 35 to under 85."""
    return valid & (pre - post > 35) & (post < 85)


def water_change(pre: Column, post: Column, cloud: Column, valid: Column) -> Column:
    """Class of a pixel from the water masks before and after; cloud, then missing data, come over it."""
    base = F.when(~pre & post, "new_water").when(pre & post, "persistent_water").when(pre & ~post, "lost_water").otherwise("no_water")
    return F.when(~valid, "no_data").when(cloud, "cloud").otherwise(base)


def class_statistics(pixels: DataFrame, keys: Sequence[str], kind: str, pixel_km2: float) -> DataFrame:
    counted = pixels.groupBy(*keys, kind).agg(F.count(F.lit(1)).alias("pixels"))
    total = F.sum("pixels").over(Window.partitionBy(*keys))
    return counted.withColumn("percent", 100.0 * F.col("pixels") / total).withColumn("area_km2", F.col("pixels") * pixel_km2)


def dilated(pixels: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y", radius: int = 3) -> DataFrame:
    """All pixels within a disc around the given ones: each is sent to its neighbours, no self-join."""
    disc = [(dx, dy) for dx in range(-radius, radius + 1) for dy in range(-radius, radius + 1) if dx * dx + dy * dy <= radius * radius]
    moves = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in disc])
    sent = pixels.select(*keys, x, y, F.inline(moves))
    return sent.select(*keys, (F.col(x) + F.col("dx")).alias(x), (F.col(y) + F.col("dy")).alias(y)).distinct()


def layer_recommendation(s1: Column, s2_change: Column, s2_post: Column) -> Column:
    return F.when(s1 & s2_change, "s1_and_s2_change").when(s2_change, "s2_change").when(s1, "s1_change").when(s2_post, "s2_post").otherwise("manual_review")


#: Groups in the order in which they are tried, with their base scores.
GROUPS = (
    ("error", 0), ("best_s1_s2_change", 100), ("s1_s2_change_no_new_water", 90), ("s2_change", 80), ("s2_change_no_new_water", 70),
    ("s1_primary", 50), ("s2_post_only", 40), ("manual_review", 10),
)


def rank_group(status: Column | str, s1: Column | str, s2: Column | str, mask: Column | str, post: Column | str, new_water: Column | str) -> Column:
    radar, change, water = is_true(s1, ("true",)), is_true(s2, ("true",)) & is_true(mask, ("true",)), F.coalesce(as_number(new_water), F.lit(0.0)) > 0
    conditions = (F.coalesce(col(status) == "error", F.lit(False)), radar & change & water, radar & change, change & water, change, radar, is_true(post, ("true",)), F.lit(True))
    out = None
    for (name, score), holds in zip(GROUPS, conditions, strict=True):
        value = F.struct(F.lit(name).alias("group"), F.lit(score).alias("base"))
        out = F.when(holds, value) if out is None else out.when(holds, value)
    return out


def rank_score(base: Column, new_water: Column, isolated: Column, radar_area: Column, cloud: Column, unreliable: Column, near: Column) -> Column:
    """Additive score, to four digits. An isolated area that is missing or 0 falls back to all new water."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    alone = F.when(zero(isolated) != 0, isolated).otherwise(zero(new_water))
    return F.round(
        base.cast("double")
        + F.least(alone * 20.0, F.lit(20.0))
        + F.least(zero(radar_area) * 0.1, F.lit(5.0))
        + zero(F.greatest(F.lit(0.0), 30.0 - cloud) / 3.0 + F.lit(0.0) * cloud)
        - zero(F.least(unreliable / 2.0, F.lit(15.0)) + F.lit(0.0) * unreliable)
        - zero(F.least(near / 12.5, F.lit(8.0)) + F.lit(0.0) * near),
        4,
    )


def ranked(df: DataFrame, score: str, then: str, order: str) -> DataFrame:
    """rank 1 to n by score, then another value. A global order, so the last step of a report."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), F.coalesce(then, F.lit(0.0)).desc(), order)))


def sensor_coverage(days: DataFrame, keys: Sequence[str], sensor: str, status: str) -> DataFrame:
    return days.groupBy(*keys, sensor).agg(*[F.count_if(F.col(status) == s).alias(s) for s in ("available", "missing", "error")])
