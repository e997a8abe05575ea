"""Strata of labels as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bounds of eras, label types and tags.
LEGACY_END, LIVE_FROM, FIXED_FROM = "2021-01-01", "2023-03-29", "2024-09-26"
BANDS = ["<5", "5-15", "15-30", ">30"]
NO_REFERENT_TYPES = ["Occlusion", "Crosswalk", "NoSidewalk", "Signal", "Other"]
REGION_TAGS = {
    "SurfaceProblem": ["brick/cobblestone", "bumpy", "construction", "height difference", "narrow sidewalk", "rail/tram track", "sand/gravel", "very broken"],
    "Obstacle": ["construction", "outdoor dining area", "stairs"],
}
EXCLUDED_CITIES = ["kaohsiung-tw", "keelung-tw", "new-taipei-tw", "taipei"]
PITCH_FLOOR, PITCH_FLOOR_TOLERANCE = -35.0, 0.01


def era(ts: Column, legacy_end: str = LEGACY_END, live_from: str = LIVE_FROM) -> Column:
    """An unknown time is in the middle era."""
    return F.when(ts < F.lit(legacy_end).cast("timestamp"), "legacy").when(ts >= F.lit(live_from).cast("timestamp"), "post179").otherwise("mid")


def quality(ts: Column, legacy_end: str = LEGACY_END, live_from: str = LIVE_FROM, fixed_from: str = FIXED_FROM) -> Column:
    """An unknown time has no quality."""
    return F.when(ts < F.lit(legacy_end).cast("timestamp"), "legacy").when(ts < F.lit(live_from).cast("timestamp"), "mid").when(ts < F.lit(fixed_from).cast("timestamp"), "window").when(ts.isNotNull(), "post_fix")


def band(dep: Column) -> Column:
    """Bins that are closed above."""
    return F.when((dep > -90) & (dep <= 5), "<5").when((dep > 5) & (dep <= 15), "5-15").when((dep > 15) & (dep <= 30), "15-30").when((dep > 30) & (dep <= 90), ">30")


def at_pitch_floor(pitch: Column) -> Column:
    return F.coalesce(pitch <= PITCH_FLOOR + PITCH_FLOOR_TOLERANCE, F.lit(False))


def tags(text: Column) -> Column:
    """Distinct tags of `[a,b c]`, which is not JSON; blanks are left out."""
    bare = F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r"^\[(.*)\]$", "$1")
    return F.array_distinct(F.filter(F.transform(F.split(bare, ","), lambda t: F.trim(t)), lambda t: t != ""))


def region_tagged(kind: Column, tag_array: Column) -> Column:
    """Whether a tag says that the label marks a region rather than a point."""
    found = F.lit(False)
    for name, own in REGION_TAGS.items():
        found = found | ((kind == name) & F.arrays_overlap(tag_array, F.array(*map(F.lit, own))))
    return F.coalesce(found, F.lit(False))


def has_referent(kind: Column, tag_array: Column) -> Column:
    return ~F.coalesce(kind.isin(NO_REFERENT_TYPES), F.lit(False)) & ~region_tagged(kind, tag_array)


def in_frame(city: Column) -> Column:
    return ~F.coalesce(city.isin(EXCLUDED_CITIES), F.lit(False))


def id_shape(pano_id: Column) -> Column:
    return F.when(pano_id.rlike("^[0-9]+$"), "mapillary").when(F.length(pano_id) == 22, "gsv").when(pano_id.startswith("CAoS"), "gsv_photosphere").otherwise("unknown")


def frame_key(width: Column, height: Column) -> Column:
    return F.coalesce(F.concat(width.cast("bigint").cast("string"), F.lit("x"), height.cast("bigint").cast("string")), F.lit("unresolved"))


def absent(x: Column) -> Column:
    return x.isNull() | (F.trim(x.cast("string")) == "")


def wide_pair(first_w: Column, first_h: Column, w: Column, h: Column) -> tuple[Column, Column]:
    """Two sizes of a frame as a pair: the first pair if it is usable, else the second, else null."""
    good = lambda a, b: (a > 0) & (b > 0)
    use = F.when(good(first_w, first_h), 1).when(good(w, h), 2)
    return F.when(use == 1, first_w.cast("int")).when(use == 2, w.cast("int")), F.when(use == 1, first_h.cast("int")).when(use == 2, h.cast("int"))


def display_tags(text: Column) -> Column:
    """Tags in order of their names, so that the order says nothing of where a label came from."""
    return F.array_sort(tags(text))


def label_uid(city: Column, label_id: Column) -> Column:
    """A label's identity over all cities: ids start anew in each."""
    return F.concat_ws(":", city, label_id.cast("string"))


def tile_name(uid: Column) -> Column:
    return F.concat(F.translate(uid, ":", "_"), F.lit(".jpg"))


def shard(pano_id: Column) -> Column:
    """Folder of a panorama in the store."""
    return F.substring(pano_id, 1, 2)
