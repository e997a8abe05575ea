"""Crop and tile windows as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gnomon.functions.geometry import clipped, d

#: Fixed values of the sizing rules.
REFERENCE_H, INTERCEPT_M, SLOPE_M, COEFFICIENT, EXPONENT, LEAST_PX, MOST_PX = 6656.0, 19.8054639, 0.01523952, 8725.6, -1.192, 50.0, 1500.0
SCALE, LEAST_FOV, MOST_FOV, ASPECT, STORED_WIDTH = 2.5, 8.0, 90.0, 1.5, 1440
TILE_FOV = 60.0


def distance_m(above: Column) -> Column:
    """Metres to a label by its rows above the horizon, never below 0."""
    return clipped(INTERCEPT_M + SLOPE_M * above, d(0), d(1e12))


def size_by_offset(above: Column) -> Column:
    far = distance_m(above)
    return F.when(far == 0, d(MOST_PX)).otherwise(clipped(COEFFICIENT * F.pow(far, d(EXPONENT)), d(LEAST_PX), d(MOST_PX)))


def size_v1(y: Column, height: Column) -> Column:
    return size_by_offset(height / 2 - y)


def width_v2(y: Column, height: Column) -> Column:
    """Window width: the first rule in the reference frame, widened, within limits of angle."""
    size = size_by_offset((height / 2 - y) * (REFERENCE_H / height)) * (height / REFERENCE_H)
    return clipped(size * SCALE / height * 180.0, d(LEAST_FOV), d(MOST_FOV)) / 180.0 * height


def _window(x: Column, y: Column, w: Column, h: Column, pano_w: Column, pano_h: Column) -> Column:
    top = F.rint(y - h / 2)
    moved = clipped(top, d(0), pano_h - h)
    return F.struct(F.pmod(F.rint(x - w / 2), pano_w).cast("bigint").alias("left"), moved.cast("bigint").alias("top"), w.cast("bigint").alias("width"), h.cast("bigint").alias("height"), (moved != top).alias("shifted"))


def box_v1(x: Column, y: Column, size: Column, pano_w: Column, pano_h: Column) -> Column:
    side = F.least(F.rint(size), pano_w, pano_h)
    return _window(x, y, side, side, pano_w, pano_h)


def box_v2(x: Column, y: Column, width: Column, pano_w: Column, pano_h: Column) -> Column:
    w = F.rint(F.least(width, pano_w, pano_h * ASPECT))
    return _window(x, y, w, F.rint(w / ASPECT), pano_w, pano_h)


def tile_window(x: Column, y: Column, pano_w: Column, pano_h: Column, jitter_x: Column, jitter_y: Column, fov: float = TILE_FOV) -> Column:
    w, h = 2 * F.rint(fov / 360.0 * pano_w / 2), 2 * F.rint(fov / 180.0 * pano_h / 2)
    return _window(x + jitter_x, y + jitter_y, w, h, pano_w, pano_h)


def tile_to_pano(window: Column, x: Column, y: Column, pano_w: Column) -> tuple[Column, Column]:
    """Panorama pixel of a tile's pixel."""
    return F.pmod(window["left"] + x.cast("bigint"), pano_w.cast("bigint")), window["top"] + y.cast("bigint")


def pano_to_tile(window: Column, x: Column, y: Column, pano_w: Column) -> tuple[Column, Column]:
    """Tile pixel of a panorama's pixel, the inverse inside the window, across the seam too."""
    return F.pmod(F.rint(x).cast("bigint") - window["left"], pano_w.cast("bigint")), F.rint(y).cast("bigint") - window["top"]


def inside(window: Column, cx: Column, cy: Column, w: Column, h: Column, pano_w: Column) -> Column:
    """Whether a box lies in a window, across the seam too."""
    from_left, top = F.pmod(cx - w / 2 - window["left"], pano_w), cy - h / 2
    return (from_left + w <= window["width"]) & (window["top"] <= top) & (top + h <= window["top"] + window["height"])


def clamp_onset(height: Column, size: float = MOST_PX) -> Column:
    """Depression at which the first rule reaches a size."""
    return (INTERCEPT_M - (size / COEFFICIENT) ** (1 / EXPONENT)) * 180.0 / (SLOPE_M * height)


def stored_width(width: Column) -> Column:
    return F.least(width, F.lit(STORED_WIDTH))


def margins(fraction: Column) -> tuple[Column, Column, Column]:
    """Of a fraction that an object takes of its crop: the ratio, and the margin over half and full extent."""
    ratio = F.try_divide(d(1), fraction)
    return ratio, ratio - 1, (ratio - 1) / 2


def truncation_onset(height: Column, steps: int = 27) -> Column:
    """Shallowest depression at which the crop of the first rule runs off the bottom, halving the range to 1e-6 of a
    degree; 0 if it does so at the horizon already, null if it never does."""
    y = lambda dep: height / 2 + dep / 90.0 * (height / 2)
    over = lambda dep: y(dep) + size_v1(y(dep), height) / 2 > height
    state = F.struct(d(0).alias("low"), d(90).alias("high"))

    def step(s: Column, _: Column) -> Column:
        mid = (s["low"] + s["high"]) / 2
        return F.when(over(mid), F.struct(s["low"].alias("low"), mid.alias("high"))).otherwise(F.struct(mid.alias("low"), s["high"].alias("high")))

    return F.when(over(d(90)), F.when(over(d(0)), d(0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, step)["high"]))
