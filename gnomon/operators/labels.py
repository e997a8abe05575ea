"""Summaries of replayed labels: exactness, drift, off-axis offsets, clamps, frames and bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gnomon.functions import geometry as g
from gnomon.functions import sizing, strata
from gnomon.operators.quantiles import percentiles, several
from gnomon.operators.replay import visible_px
from gnomon.operators.tables import joined, written

c = F.col


def r6(x: Column) -> Column:
    return F.round(x, 6)


def share(flag: Column, of: Column | None = None) -> Column:
    """Percentage of rows with flag, of those with `of`; null if there are none."""
    n = F.count_if(of) if of is not None else F.count("*")
    return r6(F.try_divide(100.0 * F.count_if(flag), n))


def exactness(replayed: DataFrame, *by: str) -> DataFrame:
    """How many labels replay, exactly, and how far the others are off."""
    flags = ("replayable_x", "replayable_y", "exact_x", "exact_y")
    own = written(replayed.select(*by, *flags, F.when(~c("exact_x"), F.abs("dx")).alias("miss_x"), F.when(~c("exact_y"), F.abs("dy")).alias("miss_y")))
    made = own.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if("replayable_x").alias("replayable_x"), F.count_if("replayable_y").alias("replayable_y"),
        share(c("exact_x"), c("replayable_x")).alias("exact_x_pct"), share(c("exact_y"), c("replayable_y")).alias("exact_y_pct"),
    )
    return with_percentiles(made, own, {f"d{k}_p{q}": (f"miss_{k}", q / 100) for k in "xy" for q in (50, 90)}, *by)


def with_percentiles(made: DataFrame, rows: DataFrame, wanted: dict[str, tuple[str, float]], *by: str) -> DataFrame:
    """made (a row a group) with percentiles of the groups' rows, rounded."""
    found = several(rows, wanted, *by)
    return joined(made, found.select(*by, *(r6(c(x)).alias(x) for x in wanted)), list(by))


def monthly(replayed: DataFrame) -> DataFrame:
    px = visible_px(c("dx_deg"), c("dy_deg"), c("zoom"))
    both = c("replayable_x") & c("replayable_y")
    return replayed.groupBy(F.date_format("time_created", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), share(c("exact_x") & c("exact_y"), both).alias("exact_pct"), share(both & (px >= 10), both).alias("ge_10px_pct"))


def drift(replayed: DataFrame) -> DataFrame:
    """Spread of the x misses within panoramas, and of their means between panoramas."""
    missed = replayed.where(~c("exact_x") & c("dx_deg").isNotNull())
    per = missed.groupBy("pano_id").agg(F.count("*").alias("n"), F.stddev_samp("dx_deg").alias("sd"), F.avg("dx_deg").alias("mean")).where("n >= 2")
    # Read in each pass of the percentile, and few.
    per = written(per)
    made = per.agg(F.count("*").alias("n_panos"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_labels"), r6(F.stddev_samp("mean")).alias("sd_across"))
    return made.join(percentiles(per, "sd", {"median_within": 0.5})).withColumn("median_within", r6(c("median_within")))


def offaxis_by_band(study: DataFrame) -> DataFrame:
    """Spread of the off-axis offset in each band; a band without labels has its row too."""
    bands = study.sparkSession.createDataFrame([(b,) for b in strata.BANDS], "band string")
    own = written(study.where("eligible").select("band", "offaxis_v", "offaxis_r", "at_floor"))
    made = own.groupBy("band").agg(F.count("*").alias("n"), r6(F.stddev_samp("offaxis_v")).alias("sd"), share(c("at_floor")).alias("floor_pct"))
    made = with_percentiles(made, own, {**{f"p{q}": ("offaxis_v", q / 100) for q in (5, 50, 95)}, "radial_p95": ("offaxis_r", 0.95)}, "band")
    return F.broadcast(bands).join(made, "band", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def identification(study: DataFrame, *by: str) -> DataFrame:
    """How much of the offset's spread is left within bands, and its correlation with depression."""
    own = study.where("eligible").withColumn("resid", c("offaxis_v") - F.avg("offaxis_v").over(Window.partitionBy(*by, "band")))
    sd, within = F.stddev_samp("offaxis_v"), F.stddev_samp("resid")
    known = F.count("*") > F.count_distinct("band")
    corr = F.try_divide(F.covar_samp("offaxis_v", "depression"), sd * F.stddev_samp("depression"))
    return own.groupBy(*by).agg(F.count("*").alias("n"), r6(sd).alias("sd_overall"), r6(within).alias("sd_within"), r6(F.when(known, F.try_divide(100 * within, sd))).alias("surviving_pct"), r6(corr).alias("corr"))


def eligibility(study: DataFrame, *by: str) -> DataFrame:
    """How many rows an exact y keeps, and how many of them an exact x as well would have lost."""
    both = c("exact_x") & c("exact_y")
    return study.groupBy(*by).agg(F.count("*").alias("n_labels"), F.count_if("replayable_y").alias("replayable_y"), F.count_if("exact_y").alias("exact_y"), F.count_if(both).alias("exact_x_and_y"), F.count_if("eligible").alias("eligible"), F.count_if(c("eligible") & ~both).alias("kept_by_y_only"))


def floor_census(study: DataFrame, *by: str) -> DataFrame:
    """Least pitch of all rows, and of the eligible ones their pitches and share at the floor, also by band."""
    ok = c("eligible")
    names = ("floor_under_5_pct", "floor_5_15_pct", "floor_15_30_pct", "floor_over_30_pct")
    return study.groupBy(*by).agg(
        F.count("*").alias("n_all_labels"), r6(F.min("pitch")).alias("min_pitch_all"), F.count_if(ok).alias("n"), r6(F.min(F.when(ok, c("pitch")))).alias("min_pitch"), r6(F.max(F.when(ok, c("pitch")))).alias("max_pitch"),
        share(ok & c("at_floor"), ok).alias("at_floor_pct"), share(ok & (c("pitch") == strata.PITCH_FLOOR), ok).alias("exactly_floor_pct"),
        *(share(ok & c("at_floor") & (c("band") == b), ok & (c("band") == b)).alias(name) for b, name in zip(strata.BANDS, names, strict=True)),
    )


def city_study(replayed: DataFrame, *by: str) -> DataFrame:
    """Span of time, eras, what is missing, and frames and canvases other than the usual."""
    day = lambda x: F.date_format(x, "yyyy-MM-dd")
    usual = F.coalesce((c("canvas_width") == g.CANVAS_W) & (c("canvas_height") == g.CANVAS_H), F.lit(False))
    missing = {"no_dims": "pano_width", "no_camera_heading": "camera_heading", "no_camera_pitch": "camera_pitch", "no_camera_roll": "camera_roll", "no_pixel": "pano_x"}
    return replayed.groupBy(*by).agg(
        F.count("*").alias("n_labels"), day(F.min("time_created")).alias("first_day"), day(F.max("time_created")).alias("last_day"), *(F.count_if(c("era") == k).alias(f"n_{k}") for k in ("legacy", "mid", "post179")),
        *(F.count_if(c(x).isNull()).alias(name) for name, x in missing.items()), F.count_if((c("pano_width") == 13312) & (c("pano_height") == 6656)).alias("fixed_frame"), F.count_if(~usual).alias("other_canvas"),
    )


def histogram(df: DataFrame, key: Column, name: str, *by: str) -> DataFrame:
    """Rows by key, keys that come out equal together."""
    return df.groupBy(*by, key.alias(name)).agg(F.count("*").alias("n"))


def spread(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Extremes, deviation and the 90th percentile of the size of a value."""
    own = written(df.select(*by, value, F.abs(value).alias("_size")))
    made = own.groupBy(*by).agg(F.count(value).alias("n"), r6(F.min(value)).alias("min"), r6(F.max(value)).alias("max"), r6(F.stddev_samp(value)).alias("sd"))
    return with_percentiles(made, own, {"abs_p90": ("_size", 0.9)}, *by)


def floor_by_type(study: DataFrame) -> DataFrame:
    return study.where("eligible").groupBy("label_type").agg(F.count("*").alias("n"), share(c("at_floor")).alias("at_floor_pct"), share(c("pitch") == strata.PITCH_FLOOR).alias("exactly_floor_pct"), r6(F.min("pitch")).alias("min_pitch"), r6(F.max("pitch")).alias("max_pitch"))


def zoom_ladder(study: DataFrame) -> DataFrame:
    z = F.round("zoom", 4)
    rung = F.when(z.isin(1.0, 2.0, 3.0), z.cast("int").cast("string")).otherwise("other")
    own = study.where("eligible").groupBy(rung.alias("rung")).agg(F.count("*").alias("n"), r6(F.min(g.viewer_fov(c("zoom")))).alias("fov"), r6(F.min(g.canvas_degrees(g.d(5), c("zoom")))).alias("deg_at_5px"))
    return own.withColumn("share_pct", r6(100.0 * c("n") / F.sum("n").over(Window.partitionBy())))


def tail_bands(study: DataFrame) -> DataFrame:
    """Labels outside the 5th to 95th percentile of their band, by band and side."""
    own = written(study.where("eligible").select("band", "offaxis_v"))
    edges = several(own, {"low": ("offaxis_v", 0.05), "high": ("offaxis_v", 0.95)}, "band")
    side = F.when(c("offaxis_v") < c("low"), "low").when(c("offaxis_v") > c("high"), "high")
    return own.join(F.broadcast(edges), "band").select("band", side.alias("side")).where("side IS NOT NULL").groupBy("band", "side").agg(F.count("*").alias("n"))


def tilt(df: DataFrame, sigma: float = 0.59) -> DataFrame:
    """Whether tilt of the camera could be seen: standard errors of its two terms."""
    b = F.radians(g.delta_bearing(c("pano_x"), c("pano_width")))
    own = df.select("*", (c("camera_pitch") * F.cos(b)).alias("tp"), (c("camera_roll") * F.sin(b)).alias("tr"))
    root = F.sqrt(F.count("*"))
    se = lambda x: F.try_divide(F.lit(sigma), F.stddev_samp(x) * root)
    return own.agg(F.count("*").alias("n"), F.count_distinct("pano_id").alias("panos"), r6(F.stddev_samp("tp")).alias("sd_pitch"), r6(F.stddev_samp("tr")).alias("sd_roll"), r6(F.stddev_samp(c("tp") + c("tr"))).alias("sd_both"), r6(se("tp")).alias("se_pitch"), r6(se("tr")).alias("se_roll"), (F.greatest(se("tp"), se("tr")) < 0.3 / 1.96).alias("reachable"))


def tilt_by_pano(df: DataFrame) -> DataFrame:
    """Spread of each panorama's first known pitch and roll of the camera, in order of label, and how many rows have
    them: a row for each of the two."""
    two = F.inline(F.array(*(F.struct(F.lit(k).alias("axis"), c(k).alias("tilt")) for k in ("camera_pitch", "camera_roll"))))
    own = df.select("pano_id", "label_id", two)
    here = own.groupBy("axis").agg(share(c("tilt").isNotNull()).alias("available_pct"))
    first = own.groupBy("axis", "pano_id").agg(F.min_by("tilt", F.when(c("tilt").isNotNull(), c("label_id"))).alias("tilt"))
    return joined(here, spread(first.where("tilt IS NOT NULL"), "tilt", "axis"), ["axis"])


def clamps(df: DataFrame, *by: str) -> DataFrame:
    """How often the first sizing rule clamps or runs off the frame, with depressions and distances."""
    own = df.where("pano_width > 0 AND pano_height > 0 AND pano_y BETWEEN 0 AND pano_height").withColumns({"size": sizing.size_v1(c("pano_y"), c("pano_height")), "dep": g.depression(c("pano_y"), c("pano_height"))})
    gap = F.abs(sizing.distance_m(c("pano_height") / 2 - c("pano_y")) - g.blended_distance(c("dep")))
    own = written(own.select(*by, "size", "dep", gap.alias("gap"), "pano_y", "pano_height"))
    made = own.groupBy(*by).agg(
        F.count("*").alias("n"), share(c("size") == 1500).alias("clamp_high_pct"), share(c("size") == 50).alias("clamp_low_pct"),
        share(c("pano_y") + c("size") / 2 > c("pano_height")).alias("bottom_pct"), share(c("pano_y") - c("size") / 2 < 0).alias("top_pct"),
    )
    return with_percentiles(made, own, {f"{k}_p{q}": (k, q / 100) for k, qs in (("dep", (10, 50, 90, 99)), ("gap", (50, 90))) for q in qs}, *by)


def resolution(df: DataFrame, least: int = 500) -> DataFrame:
    """Crop size against the reference frame's, by frame height with enough labels."""
    own = df.where("pano_height > 0 AND pano_y BETWEEN 0 AND pano_height")
    ratio = F.try_divide(sizing.size_v1(c("pano_y"), c("pano_height")) / c("pano_height"), sizing.size_by_offset((c("pano_height") / 2 - c("pano_y")) * (6656.0 / c("pano_height"))) / 6656.0)
    own = written(own.select("pano_height", ratio.alias("ratio")))
    made = own.groupBy("pano_height").agg(F.count("*").alias("n")).where(c("n") >= least)
    made = with_percentiles(made, own, {"ratio_p50": ("ratio", 0.5), "ratio_p90": ("ratio", 0.9)}, "pano_height")
    return made.withColumns({"share_pct": r6(100.0 * c("n") / F.sum("n").over(Window.partitionBy())), "onset": r6(sizing.clamp_onset(c("pano_height")))})


def geometry_flags(df: DataFrame, *by: str) -> DataFrame:
    """How crops of the first rule meet the frame: across the seam, shifted, capped, outside."""
    x, y, w, h = (c(k) for k in ("pano_x", "pano_y", "pano_width", "pano_height"))
    own = df.where("pano_width > 0 AND pano_height > 0 AND pano_x IS NOT NULL AND pano_y IS NOT NULL").withColumns({"want": F.rint(sizing.size_v1(y, h)), "inner": (y >= 0) & (y < h)})
    own = own.withColumn("size", F.least("want", w, h)).withColumns({"left": F.rint(x - c("size") / 2), "top": F.rint(y - c("size") / 2)})
    own = written(own.select(*by, "want", "inner", "size", "left", "top", "pano_x", "pano_width", "pano_height", F.when(c("inner"), y / h).alias("ratio")))
    made = own.groupBy(*by).agg(
        F.count("*").alias("n"), share((c("left") < 0) | (c("left") + c("size") > w)).alias("wraps_pct"), share((c("top") < 0) | (c("top") > h - c("size"))).alias("shifts_pct"),
        F.count_if(c("want") > F.least(w, h)).alias("capped"), F.count_if((x < 0) | (x >= w)).alias("x_outside"), F.count_if(~c("inner")).alias("y_outside"),
    )
    return with_percentiles(made, own, {f"y_p{q}": ("ratio", q / 100) for q in (0, 1, 50, 99, 100)}, *by)


def dims_per_pano(df: DataFrame, long_days: int = 1460) -> DataFrame:
    """Whether panoramas have one size, over all and over those whose labels span more than so many days."""
    per = df.groupBy("pano_id").agg(F.count_distinct("pano_width").alias("w"), F.count_distinct("pano_height").alias("h"), F.count("*").alias("n"), F.min("time_created").alias("first"), F.max("time_created").alias("last"), F.floor((F.unix_timestamp(F.max("time_created")) - F.unix_timestamp(F.min("time_created"))) / 86400).alias("days"))
    wide = (c("n") > 1) & (c("days") > long_days)
    return per.agg(F.count("*").alias("panos"), F.count_if((c("w") > 1) | (c("h") > 1)).alias("multi"), F.count_if(wide).alias("long_panos"), F.coalesce(F.sum(F.when(wide, c("n"))), F.lit(0)).cast("bigint").alias("long_labels"), F.count_if(wide & (c("h") > 1)).alias("long_multi"), *(F.date_format(f(k), "yyyy-MM-dd").alias(f"{k}_day") for f, k in ((F.min, "first"), (F.max, "last"))))


def visibility(classed: DataFrame, *by: str) -> DataFrame:
    own = written(classed.where("replayable_x AND replayable_y").select(*by, visible_px(c("dx_deg"), c("dy_deg"), c("zoom")).alias("px")))
    made = own.groupBy(*by).agg(F.count("*").alias("n"), *(share(c("px") >= t).alias(f"ge_{t}px_pct") for t in (4, 10, 30)), r6(F.max("px")).alias("max_px"))
    return with_percentiles(made, own, {"p99_px": ("px", 0.99)}, *by)


def stale_groups(classed: DataFrame) -> DataFrame:
    """Groups of misses with one view and several clicks, and whether they share one x miss."""
    own = classed.where(c("klass").isin("x_only", "xy_small", "multi_field"))
    per = own.groupBy("pano_id", "heading", "pitch", "zoom").agg(F.count("*").alias("n"), F.count_distinct("canvas_x").alias("clicks"), (F.max("dx_deg") - F.min("dx_deg")).alias("spread")).where("n >= 2 AND clicks > 1")
    return per.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_labels"), share(c("spread") <= 0.05).alias("shared_pct"))


def stale_panos(classed: DataFrame) -> DataFrame:
    per = classed.where("klass = 'x_only'").groupBy("pano_id").agg(F.count("*").alias("n"), (F.max("dx_deg") - F.min("dx_deg")).alias("spread")).where("n >= 2")
    return per.agg(F.count("*").alias("n_panos"), share(c("spread") <= 0.05).alias("constant_pct"))


def polar_bands(df: DataFrame) -> DataFrame:
    """Labels by zone of the frame; the swept rows of tiles are known for two heights."""
    top = F.when(c("pano_height") == 8192, 5 * 512).when(c("pano_height") == 6656, 4 * 512)
    bottom = F.when(c("pano_height") == 8192, 11 * 512).when(c("pano_height") == 6656, 9 * 512)
    own = df.where("pano_y IS NOT NULL AND pano_height IS NOT NULL AND pano_id IS NOT NULL")
    zone = F.when(top.isNull(), "unswept geometry").when(c("pano_y") >= bottom, "bottom band").when(c("pano_y") < top, "top band").otherwise("full resolution")
    return own.groupBy("label_type", zone.alias("zone")).agg(F.count("*").alias("n"), F.count_distinct("pano_id").alias("panos"), F.max(F.floor((c("pano_y") - bottom) / 512)).cast("bigint").alias("furthest_row"))


def by_city_and_all(df: DataFrame) -> DataFrame:
    """Labels and panoramas by city and over all cities in one pass."""
    return df.groupingSets([["city"], []], "city").agg(F.coalesce("city", F.lit("all")).alias("scope"), F.count("*").alias("n"), F.count_distinct("pano_id").alias("panos")).select("scope", "n", "panos")
