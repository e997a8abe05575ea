"""Geometry of clicks, panoramas and tiles as column functions. Null in, null out; angles in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the viewer and of the distance model.
CANVAS_W, CANVAS_H = 720.0, 480.0
CAMERA_HEIGHT_M, BLEND_DEG, DISTANCE_CAP_M = 2.341219672825709, 11.25, 50.0
EARTH_R_M = 6371000.0
TILE = 512


def d(value: float) -> Column:
    return F.lit(float(value))


def clipped(x: Column, low: Column, high: Column) -> Column:
    """x within [low, high]; null stays null, where least and greatest would drop it."""
    return F.when(x < low, low).when(x > high, high).otherwise(x)


def no_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def rounded(x: Column, places: int) -> Column:
    """x to so many places, halves away from zero as the scaled double has them. F.round takes the shortest decimal
    that the double prints as, and so turns others' ties the other way."""
    scale = d(10.0**places)
    size = F.abs(x) * scale
    whole = F.floor(size).cast("double")
    near = F.signum(x) * (whole + F.when(size - whole >= 0.5, 1.0).otherwise(0.0)) / scale
    # Beyond that a double has no more places; NaN and infinity stay.
    return F.when(F.abs(x) < 1e11, near).otherwise(x)


def wrap180(a: Column) -> Column:
    """An angle in [-180, 180)."""
    return F.pmod(a + 180.0, d(360)) - 180.0


def turned(a: Column) -> Column:
    """An angle in (-180, 180]."""
    return 180.0 - F.pmod(180.0 - a, d(360))


def separation(a: Column, b: Column) -> Column:
    """Bearings' difference the short way round."""
    return F.abs(wrap180(a - b))


def viewer_fov(zoom: Column) -> Column:
    return F.when(zoom <= 2, 126.5 - 36.75 * zoom).otherwise(195.93 / F.pow(d(1.92), zoom))


#: What a click's direction is made of, step by step.
CLICK_PARTS = ("_focal", "_right", "_up", "_sin_h", "_cos_h", "_sin_p", "_cos_p")
CLICK_VECTOR = ("_east", "_north", "_above")


def click_parts(x: Column, y: Column, heading: Column, pitch: Column, zoom: Column, width: Column, height: Column) -> dict[str, Column]:
    """Focal length, place from the middle of the canvas, sines and cosines of the view."""
    focal = 0.5 * width / F.tan(0.5 * F.radians(viewer_fov(zoom)))
    made = (focal, x - width / 2, height / 2 - y, F.sin(F.radians(heading)), F.cos(F.radians(heading)), F.sin(F.radians(pitch)), F.cos(F.radians(pitch)))
    return dict(zip(CLICK_PARTS, made, strict=True))


def click_vector(focal: Column, right: Column, up: Column, sin_h: Column, cos_h: Column, sin_p: Column, cos_p: Column) -> dict[str, Column]:
    # Sums stand in the order that the SQL has them in: the pitch of equal clicks does not depend on the heading, but its
    # last bit does, and percentiles between such ties would fall elsewhere.
    side = F.when(cos_p >= 0, 1.0).otherwise(-1.0)
    east = focal * cos_p * sin_h + right * side * cos_h - up * sin_p * sin_h
    north = focal * cos_p * cos_h - right * side * sin_h - up * sin_p * cos_h
    return dict(zip(CLICK_VECTOR, (east, north, focal * sin_p + up * cos_p), strict=True))


def vector_direction(east: Column, north: Column, above: Column) -> tuple[Column, Column]:
    """Heading in (-180, 180], and pitch, NaN where there is none."""
    return F.degrees(F.atan2(east, north)), F.degrees(F.asin(above / F.sqrt(east * east + north * north + above * above)))


def click_direction(x: Column, y: Column, heading: Column, pitch: Column, zoom: Column, width: Column, height: Column) -> tuple[Column, Column]:
    """Heading in (-180, 180] and pitch that a click on a flat canvas looks at: the inverse of a
    gnomonic camera aimed at heading and pitch."""
    parts = click_parts(x, y, heading, pitch, zoom, width, height)
    toward, up = vector_direction(*click_vector(*parts.values()).values())
    return toward, no_nan(up)


def panorama_pixel(heading: Column, pitch: Column, camera: Column, width: Column, height: Column) -> tuple[Column, Column]:
    """Pixel of a direction in a frame centred on the camera's heading, halves rounded to even."""
    turn = F.pmod(heading + 360, d(360)) - F.pmod(camera + 180, d(360))
    return F.pmod(width + F.rint(width * turn / 360), width), height / 2 - F.rint(height / 2 * (pitch / 90))


def wrapped_offset(stored: Column, replayed: Column, width: Column) -> Column:
    """stored - replayed on a ring of the given width, in (-width/2, width/2]."""
    off = F.pmod(stored - replayed + width / 2, width) - width / 2
    return F.when(off == -width / 2, width / 2).otherwise(off)


def panorama_angles(x: Column, y: Column, width: Column, height: Column) -> tuple[Column, Column]:
    """Azimuth from the frame's left edge in [0, 360), and elevation, of a pixel."""
    return F.pmod(x / width * 360.0, d(360)), (height / 2 - y) * 90.0 / (height / 2)


def depression(y: Column, height: Column) -> Column:
    return (y - height / 2) * 180.0 / height


def blended_distance(dep: Column) -> Column:
    """Metres by the cotangent of the depression, and by its tangent line below BLEND_DEG."""
    from math import pi, radians, sin, tan

    value, slope = CAMERA_HEIGHT_M / tan(radians(BLEND_DEG)), -CAMERA_HEIGHT_M * (pi / 180) / sin(radians(BLEND_DEG)) ** 2
    near = d(CAMERA_HEIGHT_M) / F.tan(F.radians(clipped(dep, d(1e-9), d(1e9))))
    far = value + slope * (clipped(dep, d(0), d(1e9)) - BLEND_DEG)
    return clipped(F.when(dep >= BLEND_DEG, near).otherwise(far), d(0), d(DISTANCE_CAP_M))


def offaxis(heading: Column, pitch: Column, click_heading: Column, click_pitch: Column) -> tuple[Column, Column]:
    """Vertical and great-circle offset of a click from the view's axis."""
    a, b = F.radians(click_pitch), F.radians(pitch)
    cos = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(wrap180(click_heading - heading)))
    return pitch - click_pitch, F.degrees(F.acos(clipped(cos, d(-1), d(1))))


def canvas_degrees(offset_px: Column, zoom: Column, width: float = CANVAS_W) -> Column:
    """Angle that a number of canvas pixels off the axis stands for."""
    return F.degrees(F.atan(offset_px / (0.5 * width / F.tan(F.radians(viewer_fov(zoom)) / 2))))


def delta_bearing(x: Column, width: Column) -> Column:
    return x / width * 360.0 - 180.0


def halved(v: Column, size: Column) -> Column:
    """Half as far from the middle of the canvas."""
    return size / 2 + (v - size / 2) * 0.5


def implied_height(y: Column, click_pitch: Column) -> Column:
    return F.try_divide(2.0 * y, 1.0 - click_pitch / 90.0)


def ground_metres(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance on a plane that touches the sphere at the first point."""
    dy = F.radians(lat2 - lat1) * EARTH_R_M
    dx = F.radians(lng2 - lng1) * EARTH_R_M * F.cos(F.radians(lat1))
    return F.sqrt(dx * dx + dy * dy)


def max_zoom(width: Column) -> Column:
    """The zoom at which a frame is whole; it has to be of positive width."""
    return F.when(width > 0, F.greatest(F.lit(0), F.ceil(F.log2(width / TILE)).cast("int")))


def tile_grid(width: Column, height: Column, zoom: Column) -> tuple[Column, Column]:
    """Columns and rows of tiles at a zoom."""
    scale = F.pow(d(2), F.greatest(F.lit(0), max_zoom(width) - zoom))
    return tuple(F.ceil(F.ceil(v / scale) / TILE).cast("int") for v in (width, height))
