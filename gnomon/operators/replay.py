"""Replay of stored label pixels, and the cascade that classifies those that do not replay."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gnomon.functions import geometry as g
from gnomon.functions.strata import at_pitch_floor, band
from gnomon.operators.tables import once

#: Fixed values of the cascade.
HEIGHTS, ZOOMS, TOLERANCE_PX = (1664.0, 3328.0, 6656.0, 8192.0), (1.0, 1.999, 2.0, 2.999, 3.0), 1.0


def clicked(df: DataFrame, names: tuple[str, str], x: Column, y: Column, heading: Column, pitch: Column, zoom: Column, width: Column, height: Column) -> DataFrame:
    """Adds the direction of a click under two names, as click_direction has it, in steps that each are computed once.
    In one expression they are repeated so often that the method made of it passes the 8,000 bytes beyond which the JVM
    compiles none, and runs it by interpretation."""
    c = F.col
    own = once(df, g.click_parts(x, y, heading, pitch, zoom, width, height))
    own = once(own, g.click_vector(*(c(k) for k in g.CLICK_PARTS)))
    toward, up = g.vector_direction(*(c(k) for k in g.CLICK_VECTOR))
    own = once(own, {names[0]: toward, "_raw": up}).withColumn(names[1], g.no_nan(c("_raw")))
    return own.drop("_raw", *g.CLICK_PARTS, *g.CLICK_VECTOR)


def replay(df: DataFrame) -> DataFrame:
    """Adds the click's direction, the replayed pixel, residuals, and flags for each axis on its own.
    A row without camera heading can still replay its y."""
    c = F.col
    df = clicked(df, ("pov_heading", "pov_pitch"), c("canvas_x"), c("canvas_y"), c("heading"), c("pitch"), c("zoom"), c("canvas_width"), c("canvas_height"))
    x, y = g.panorama_pixel(c("pov_heading"), c("pov_pitch"), c("camera_heading"), c("pano_width"), c("pano_height"))
    clear = c("pov_heading").isNotNull() & c("pov_pitch").isNotNull()
    ok_x = clear & c("camera_heading").isNotNull() & F.coalesce(c("pano_width") > 0, F.lit(False)) & c("pano_x").isNotNull()
    ok_y = clear & F.coalesce(c("pano_height") > 0, F.lit(False)) & c("pano_y").isNotNull()
    df = df.withColumns({"replayable_x": ok_x, "replayable_y": ok_y})
    df = once(df, {"replay_x": F.when(c("replayable_x"), x), "replay_y": F.when(c("replayable_y"), y)})
    df = once(df, {"dx": g.wrapped_offset(c("pano_x"), c("replay_x"), c("pano_width")), "dy": c("pano_y") - c("replay_y")})
    return df.withColumns({
        "dx_deg": c("dx") * 360.0 / c("pano_width"), "dy_deg": c("dy") * 180.0 / c("pano_height"),
        "exact_x": F.coalesce(c("replayable_x") & (c("dx") == 0), F.lit(False)), "exact_y": F.coalesce(c("replayable_y") & (c("dy") == 0), F.lit(False)),
    })


def covariates(replayed: DataFrame) -> DataFrame:
    """Adds off-axis offsets, depression, its band, and which rows a study of them may use."""
    c = F.col
    vertical, radial = g.offaxis(c("heading"), c("pitch"), c("pov_heading"), c("pov_pitch"))
    df = once(replayed, {"offaxis_v": vertical, "offaxis_r": radial, "at_floor": at_pitch_floor(c("pitch")), "depression": g.depression(c("pano_y"), c("pano_height"))})
    df = df.withColumn("band", band(c("depression")))
    return df.withColumn("eligible", c("exact_y") & c("band").isNotNull())


def matches(heading: Column, pitch: Column, width: Column, height: Column) -> Column:
    """Whether a direction reproduces the stored pixel of a frame within tolerance on both axes."""
    c = F.col
    px, py = g.panorama_pixel(heading, pitch, c("camera_heading"), width, height)
    return F.coalesce((F.abs(g.wrapped_offset(c("pano_x"), px, width)) <= TOLERANCE_PX) & (F.abs(c("pano_y") - py) <= TOLERANCE_PX), F.lit(False))


def aimed(df: DataFrame, name: str, x: Column, y: Column, zoom: Column) -> DataFrame:
    """Adds {name}_h and {name}_p, where a click would look with other inputs, of rows that are _open."""
    c = F.col
    asked = lambda v: F.when(c("_open"), v)
    return clicked(df, (f"{name}_h", f"{name}_p"), asked(x), asked(y), c("heading"), c("pitch"), zoom, c("canvas_width"), c("canvas_height"))


def classify(replayed: DataFrame) -> DataFrame:
    """Adds klass, the first explanation that fits, and fitted_zoom for those by another zoom.

    Each hypothesis is a click direction computed once, and only for rows that do not replay as they are."""
    c = F.col
    x, y, zoom, w, h = (c(k) for k in ("canvas_x", "canvas_y", "zoom", "pano_width", "pano_height"))
    adx, ady = F.abs(c("dx")), F.abs(c("dy"))
    good_x, good_y = adx <= TOLERANCE_PX, ady <= TOLERANCE_PX
    both = c("replayable_x") & c("replayable_y")
    df = once(replayed, {"_open": F.coalesce(both & ~(good_x & good_y), F.lit(False)), "_implied": g.implied_height(c("pano_y"), c("pov_pitch"))})
    df = aimed(df, "_half", g.halved(x, c("canvas_width")), g.halved(y, c("canvas_height")), zoom)
    for i, z in enumerate(ZOOMS):
        df = aimed(df, f"_zoom{i}", x, y, g.d(z))
    df = once(df, {"_dpr2": matches(c("_half_h"), c("_half_p"), w, h)})
    for i, height in enumerate(HEIGHTS):
        near = F.coalesce((F.abs(c("_implied") - height) <= 2.0) & (h != height), F.lit(False))
        df = once(df, {f"_frame{i}": near & matches(c("pov_heading"), c("pov_pitch"), g.d(2 * height), g.d(height))})
    for i, z in enumerate(ZOOMS):
        df = once(df, {f"_fits{i}": (F.abs(zoom - z) > 1e-8 + 1e-5 * z) & matches(c(f"_zoom{i}_h"), c(f"_zoom{i}_p"), w, h)})
    frame = reduce(or_, (c(f"_frame{i}") for i in range(len(HEIGHTS))))
    df = once(df, {"_frame": frame, "_fitted": F.coalesce(*(F.when(c(f"_fits{i}"), g.d(z)) for i, z in enumerate(ZOOMS)))})
    klass = (
        F.when(~both, "unreplayable").when(good_x & good_y, "exact").when(c("_dpr2"), "dpr2").when(c("_frame"), "frame_change")
        .when(c("_fitted").isNotNull(), "zoom_desync").when(good_y, "x_only").when(good_x, "y_only")
        .when((adx <= 10) & (ady <= 10), "xy_small").otherwise("multi_field")
    )
    df = once(df, {"klass": klass})
    return df.withColumn("fitted_zoom", F.when(c("klass") == "zoom_desync", c("_fitted"))).drop(*(k for k in df.columns if k.startswith("_")))


def visible_px(dx_deg: Column, dy_deg: Column, zoom: Column) -> Column:
    """How far off a marker stands on the canvas."""
    return F.sqrt(dx_deg * dx_deg + dy_deg * dy_deg) / g.viewer_fov(zoom) * 720.0


def solve_record(classed: DataFrame, steps: int = 25) -> DataFrame:
    """Adds the view, zoom and canvas point of a record that replays to the stored pixel (new_heading, new_pitch,
    new_zoom, new_canvas_x, new_canvas_y), what is then left on either axis in pixels, and repaired.

    dpr2 rows take half the canvas offset, as a whole pixel, and zoom_desync rows their fitted zoom. The view turns
    by what is left until a row is within tolerance, each on its own, so that its answer does not depend on the
    rows beside it. Heading and pitch are rounded to 4 places before the last measurement.
    """
    c, w, h = F.col, F.col("pano_width"), F.col("pano_height")
    dpr2 = c("klass") == "dpr2"
    df = once(classed, {
        "new_zoom": F.coalesce("fitted_zoom", "zoom"),
        "new_canvas_x": F.when(dpr2, F.rint(g.halved(c("canvas_x"), c("canvas_width")))).otherwise(c("canvas_x")),
        "new_canvas_y": F.when(dpr2, F.rint(g.halved(c("canvas_y"), c("canvas_height")))).otherwise(c("canvas_y")),
    })

    def left(heading: Column, pitch: Column) -> Column:
        pov = g.click_direction(c("new_canvas_x"), c("new_canvas_y"), heading, pitch, c("new_zoom"), c("canvas_width"), c("canvas_height"))
        px, py = g.panorama_pixel(pov[0], pov[1], c("camera_heading"), w, h)
        return F.struct(g.wrapped_offset(c("pano_x"), px, w).alias("x"), (c("pano_y") - py).alias("y"))

    def measured(heading: Column, pitch: Column) -> Column:
        return F.struct(heading.alias("heading"), pitch.alias("pitch"), left(heading, pitch).alias("off"))

    def step(state: Column, _: Column) -> Column:
        dx, dy = state["off"]["x"], state["off"]["y"]
        done = (F.abs(dx) <= TOLERANCE_PX) & (F.abs(dy) <= TOLERANCE_PX)
        moved = F.struct(F.pmod(state["heading"] + dx * 360.0 / w, g.d(360)).alias("heading"), g.clipped(state["pitch"] - dy * 180.0 / h, g.d(-90), g.d(90)).alias("pitch"))
        next_ = F.transform(F.array(moved), lambda v: measured(v["heading"], v["pitch"]))[0]
        return F.when(done, state).otherwise(next_)

    df = once(df, {"_view": F.aggregate(F.sequence(F.lit(1), F.lit(steps)), measured(c("heading"), c("pitch")), step)})
    df = once(df, {"new_heading": g.rounded(c("_view.heading"), 4), "new_pitch": g.rounded(c("_view.pitch"), 4)})
    df = once(df, {"_off": left(c("new_heading"), c("new_pitch"))})
    df = df.withColumns({"post_x": F.abs(c("_off.x")), "post_y": F.abs(c("_off.y"))}).drop("_view", "_off")
    return df.withColumn("repaired", F.coalesce((c("post_x") <= TOLERANCE_PX) & (c("post_y") <= TOLERANCE_PX), F.lit(False)))


def zoom_overlap(classed: DataFrame) -> DataFrame:
    """Records of double density, and the share of them that another zoom, the next, explains as well."""
    c = F.col
    df = aimed(classed.where(c("klass") == "dpr2").withColumn("_open", F.lit(True)), "_next", c("canvas_x"), c("canvas_y"), c("zoom") + 1)
    df = once(df, {"_also": matches(c("_next_h"), c("_next_p"), c("pano_width"), c("pano_height"))})
    return df.agg(F.count("*").alias("n_dpr2"), F.round(F.try_divide(100.0 * F.count_if("_also"), F.count("*")), 2).alias("also_next_zoom_pct"))


def repair_summary(solved: DataFrame) -> DataFrame:
    """Rows and repaired share of each class, and of all (klass null)."""
    return solved.rollup("klass").agg(F.count("*").alias("n"), F.round(100.0 * F.count_if("repaired") / F.count("*"), 2).alias("repaired_pct"))


def replay_point(heading: float, pitch: float, zoom: float, canvas_x: float, canvas_y: float, camera_heading: float, pano_width: float, pano_height: float, canvas_width: float = g.CANVAS_W, canvas_height: float = g.CANVAS_H) -> tuple[Column, Column]:
    """The panorama pixel of one click, as columns of constants."""
    d = g.d
    toward, up = g.click_direction(d(canvas_x), d(canvas_y), d(heading), d(pitch), d(zoom), d(canvas_width), d(canvas_height))
    return g.panorama_pixel(toward, up, d(camera_heading), d(pano_width), d(pano_height))


def case_study(classed: DataFrame, city: str, label_id: int) -> DataFrame:
    """All that is known of one label: class, stored view and pixel, what is left of its replay, and how far off its
    marker is seen; no row where there is no such label."""
    c = F.col
    finite = lambda x: F.when(~F.isnan(x), x)
    stored = F.struct("heading", "pitch", "zoom", "canvas_x", "canvas_y", "pano_x", "pano_y")
    left = F.struct(finite(c("dx")).alias("dx"), finite(c("dy")).alias("dy"))
    own = classed.where((c("city") == city) & (c("label_id") == label_id))
    return own.select("label_id", "time_created", "klass", stored.alias("stored"), left.alias("residual_px"), F.round(finite(visible_px(c("dx_deg"), c("dy_deg"), c("zoom"))), 1).alias("marker_px"))
