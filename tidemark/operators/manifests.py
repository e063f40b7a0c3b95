"""Image manifests: days by sensors, their checks, counts and flat rows; and rasters as arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import calendar

SENSORS = ("sentinel_2", "sentinel_1", "sentinel_3_slstr")
SLOT = "struct<available:boolean,status:string,outputs:map<string,string>>"
DAY = "struct<date:string,relative_day:int," + ",".join(f"{s}:{SLOT}" for s in SENSORS) + ">"
MANIFEST = f"struct<schema_version:string,event_id:string,start_date:string,latitude:double,longitude:double,bbox:array<double>,status:string,days:array<{DAY}>>"


def parsed(text: Column | str) -> Column:
    return F.from_json(F.col(text) if isinstance(text, str) else text, MANIFEST)


def slot_complete(slot: Column) -> Column:
    """A slot is done if it has outputs, or if there was no scene for it."""
    return F.coalesce((slot["available"] & (F.size(slot["outputs"]) > 0)) | (~slot["available"] & slot["status"].isin("no_scene", "missing")), F.lit(False))


def complete(manifest: Column) -> Column:
    return F.coalesce(F.forall(manifest["days"], lambda d: slot_complete(d[SENSORS[0]]) & slot_complete(d[SENSORS[1]]) & slot_complete(d[SENSORS[2]])), F.lit(False))


def reject_reason(manifest: Column, event_id: Column, day: Column, lat: Column, lon: Column, tolerance: float = 1e-6) -> Column:
    """Null, or why a manifest isn't that of an event: the first check that fails."""
    m, box = manifest, manifest["bbox"]
    dates = F.transform(calendar(day), lambda d: d.cast("string"))
    inside = lat.between(F.get(box, F.lit(1)), F.get(box, F.lit(3))) & lon.between(F.get(box, F.lit(0)), F.get(box, F.lit(2)))
    checks = [
        ("missing_manifest", m.isNotNull()), ("other_event", m["event_id"] == event_id), ("other_date", m["start_date"] == day.cast("string")),
        ("other_coordinates", (F.abs(m["latitude"] - lat) <= tolerance) & (F.abs(m["longitude"] - lon) <= tolerance)),
        ("other_days", F.transform(m["days"], lambda d: d["date"]) == dates), ("point_outside_box", (F.size(box) == 4) & inside),
    ]
    out = F.lit(None).cast("string")
    for name, ok in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(out)
    return out


def slots(df: DataFrame, manifest: str, key: str) -> DataFrame:
    """A row for each event, day and sensor."""
    days = df.select(key, F.explode(F.col(manifest)["days"]).alias("d"))
    each = F.array(*[F.struct(F.lit(s).alias("sensor"), F.col("d")[s].alias("slot")) for s in SENSORS])
    return days.select(key, F.col("d.date").alias("date"), F.col("d.relative_day").alias("relative_day"), F.explode(each).alias("x")).select(key, "date", "relative_day", "x.sensor", F.col("x.slot.available").alias("available"), F.col("x.slot.status").alias("status"), F.map_keys(F.col("x.slot.outputs")).alias("products"))


def n_outputs(manifest: Column) -> Column:
    count = lambda slot: F.greatest(F.coalesce(F.size(slot["outputs"]), F.lit(0)), F.lit(0))
    return F.aggregate(manifest["days"], F.lit(0), lambda a, d: a + count(d[SENSORS[0]]) + count(d[SENSORS[1]]) + count(d[SENSORS[2]]))


# --- rasters as arrays, for use inside Arrow batches ------------------------------------------------------------


def dilate(mask: np.ndarray, radius: int = 3) -> np.ndarray:
    """All pixels within a disc around the marked ones."""
    out, (h, w) = np.zeros_like(mask), mask.shape
    for dy in range(-radius, radius + 1):
        for dx in range(-radius, radius + 1):
            if dx * dx + dy * dy <= radius * radius:
                out[max(dy, 0) : h + min(dy, 0), max(dx, 0) : w + min(dx, 0)] |= mask[max(-dy, 0) : h + min(-dy, 0), max(-dx, 0) : w + min(-dx, 0)]
    return out


def isolated(new: np.ndarray, persistent: np.ndarray, pixel_km2: float, radius: int = 3) -> tuple[float, float]:
    """Percent of new water near persistent water, and the area of the rest."""
    near = new & dilate(persistent, radius)
    n = int(new.sum())
    return (100.0 * int(near.sum()) / n if n else 0.0, (n - int(near.sum())) * pixel_km2)


def scaled(values: np.ndarray, valid: np.ndarray, maximum: int) -> np.ndarray:
    """0 to 1 as whole numbers up to ``maximum``, rounded half up; what isn't valid or a number is 0."""
    safe = np.where(valid & np.isfinite(values), values, 0.0)
    return np.floor(np.clip(safe, 0, 1) * maximum + 0.5).astype(np.uint16)


def radar_preview(linear: np.ndarray) -> np.ndarray:
    """Backscatter in decibels, -25 to 0 as 0 to 1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.clip((10 * np.log10(linear) + 25) / 25, 0, 1)


def mosaic(tiles: Sequence[np.ndarray]) -> tuple[np.ndarray, float]:
    """Later tiles over earlier ones wherever they aren't 0, and the percent of pixels that have a value."""
    out = np.zeros_like(tiles[0])
    for tile in tiles:
        out = np.where(tile != 0, tile, out)
    return out, 100.0 * float((out != 0).mean())
