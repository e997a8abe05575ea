"""Annotation tasks: lookups of their labels, subsets, and checks of what comes in and goes out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gnomon.functions import sizing
from gnomon.functions.strata import display_tags, tile_name
from gnomon.operators.jitter import with_jitter
from gnomon.operators.quantiles import ranked

c = F.col
#: Fixed values of the protocol.
FLAGS = ("object-absent", "ambiguous", "occluded", "no-extent")
#: Columns that would tell an annotator where the stored point is.
TELLING = ("pano_x", "pano_y", "left", "top", "jitter_x", "jitter_y", "seed")
ANNOTATOR = r"^[a-z0-9][a-z0-9_-]{0,31}$"


def looked_up(tasks: DataFrame, corpus: DataFrame, *columns: str) -> DataFrame:
    """Tasks with columns of their labels. Each has to be in the corpus: one that is not stops the job when its row
    is read."""
    own = corpus.select("label_uid", *columns, F.lit(True).alias("_there"))
    missing = F.raise_error(F.concat(F.lit("no such label: "), c("label_uid")))
    return tasks.join(own, "label_uid", "left").withColumn("_there", F.coalesce("_there", missing.cast("boolean"))).where("_there").drop("_there")


def with_tags(tasks: DataFrame, corpus: DataFrame) -> DataFrame:
    """Tasks with their labels' tags in order; none where the corpus does not have the label."""
    own = corpus.select("label_uid", display_tags(c("tags")).alias("tags"))
    return tasks.drop("tags").join(own, "label_uid", "left").withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))


def subset(tasks: DataFrame, keep: DataFrame) -> DataFrame:
    """Tasks of the labels in keep, in the order that they had: no column of theirs changes."""
    return tasks.join(keep.select("label_uid").distinct(), "label_uid", "left_semi")


def composition(tasks: DataFrame, corpus: DataFrame, *axes: str) -> DataFrame:
    """Tasks by each axis on its own: (axis, value, n)."""
    own = looked_up(tasks, corpus, *(x for x in axes if x not in tasks.columns))
    pairs = F.explode(F.array(*(F.struct(F.lit(x).alias("axis"), c(x).cast("string").alias("value")) for x in axes))).alias("x")
    return own.select(pairs).select("x.*").groupBy("axis", "value").agg(F.count("*").alias("n"))


def blind(tasks: DataFrame) -> DataFrame:
    """tasks, if no column tells where the stored point is."""
    leaked = sorted(set(tasks.columns) & set(TELLING))
    if leaked:
        raise ValueError(f"tells the annotator: {', '.join(leaked)}")
    return tasks


def allowed(requests: DataFrame, tasks: DataFrame) -> DataFrame:
    """Requests (annotator, tile) by well-formed names for tiles that are tasks."""
    return requests.where(c("annotator").rlike(ANNOTATOR)).join(tasks.select("tile").distinct(), "tile", "left_semi")


def validated(annotations: DataFrame) -> DataFrame:
    """Annotations (flags, point, box, tile_width, tile_height and others) with error, null where there is none. A
    point and a box are needed unless the object is flagged as absent; both have to lie in the tile."""
    unknown = F.size(F.array_except(F.coalesce("flags", F.array().cast("array<string>")), F.array(*map(F.lit, FLAGS)))) > 0
    absent = F.coalesce(F.array_contains("flags", "object-absent"), F.lit(False))
    within = lambda x, y: (x >= 0) & (x <= c("tile_width")) & (y >= 0) & (y <= c("tile_height"))
    point, box = c("point"), c("box")
    outside = ~(within(box["x"], box["y"]) & within(box["x"] + box["w"], box["y"] + box["h"]))
    error = (
        F.when(unknown, "unknown flag").when(~absent & point.isNull(), "no point").when(~absent & box.isNull(), "no box")
        .when(point.isNotNull() & ~within(point["x"], point["y"]), "point outside").when(box.isNotNull() & ((box["w"] <= 0) | (box["h"] <= 0)), "no area").when(box.isNotNull() & outside, "box outside")
    )
    return annotations.withColumn("error", error)


def picked(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """Of each group the values at the ranks n // 6 and n - 1 - n // 8, one low and one high, once if they are one."""
    low, high = F.floor(c("_n") / 6), c("_n") - 1 - F.floor(c("_n") / 8)
    takes = lambda rank: (c("_first") <= rank) & (rank < c("_end"))
    return ranked(rows, value, *by).where(takes(low) | takes(high)).select(*by, c("_v").alias(value))


#: Fixed values of the protocol: what to mark, by type of label.
RUBRIC = {
    "CurbRamp": "Mark the centre of the ramp where it meets the gutter line.",
    "NoCurbRamp": "Mark the centre of the would-be ramp where it would meet the gutter line.",
    "Obstacle": "Mark the centroid of the obstruction at its point of ground contact.",
    "SurfaceProblem": "Mark the centroid of the surface defect.",
    "Crosswalk": "Mark the centre of the marked crosswalk area.",
    "Signal": "Mark the centre of the pedestrian signal head.",
    "NoSidewalk": "Mark the point on the roadway edge where the sidewalk is absent.",
    "Other": "Mark the centroid of the feature at its point of ground contact.",
}


def built(corpus: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Tasks that annotators see, and the geometry that only the analysis does: windows, offsets and stored points.

    Whoever knows a tile's place can work out the stored point, so no column of the geometry is among those of the
    tasks. Tasks stand in an order drawn by the seed (place), not by stratum. A type without rubric stops the job."""
    own = with_jitter(corpus, seed)
    own = own.withColumn("window", sizing.tile_window(c("pano_x"), c("pano_y"), c("pano_width"), c("pano_height"), c("jitter_x"), c("jitter_y")))
    rubric = F.coalesce(*(F.when(c("label_type") == k, F.lit(v)) for k, v in RUBRIC.items()), F.raise_error(F.concat(F.lit("no rubric for "), F.coalesce("label_type", F.lit("null")))).cast("string"))
    place = F.xxhash64("label_uid", F.lit(seed), F.lit("place"))
    tasks = own.select("label_uid", tile_name(c("label_uid")).alias("tile"), c("window.width").alias("tile_width"), c("window.height").alias("tile_height"), "label_type", display_tags(c("tags")).alias("tags"), rubric.alias("rubric"), place.alias("place"))
    wraps = c("window.left") + c("window.width") > c("pano_width")
    geometry = own.select("label_uid", "city", "pano_id", "label_type", "window.left", "window.top", "window.width", "window.height", "window.shifted", wraps.alias("wraps"), "jitter_x", "jitter_y", "pano_width", "pano_height", "pano_x", "pano_y")
    return blind(tasks), geometry
