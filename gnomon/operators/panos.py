"""Panoramas, ledgers, tiles, crops, depth: lookups and gates as joins and columns."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gnomon.functions import sizing
from gnomon.functions.geometry import d, tile_grid
from gnomon.functions.strata import absent
from gnomon.operators.quantiles import at_ranks, held, ranked, several
from gnomon.operators.tables import joined, written

#: Tasks that votes for ground planes are dealt to.
GROUND_TASKS = 96
c = F.col


def image_panos(panos: DataFrame, every: bool = False) -> DataFrame:
    """Panoramas with labels; an unknown flag counts as with."""
    return panos if every else panos.where(F.coalesce("has_labels", F.lit(True)))


def supported(panos: DataFrame, sources: tuple[str, ...] = ("gsv", "mapillary")) -> DataFrame:
    return panos.where(c("source").isin(*sources))


def unresolved(panos: DataFrame, ledger: DataFrame) -> DataFrame:
    """Panoramas that the ledger does not name: those still to be tried."""
    return panos.join(ledger.select("pano_id").distinct(), "pano_id", "left_anti")


def missing_dims(panos: DataFrame) -> DataFrame:
    return panos.where("pano_id <> '' AND (coalesce(width, 0) = 0 OR coalesce(height, 0) = 0)")


def coverage(panos: DataFrame, store: DataFrame, *by: str) -> DataFrame:
    """How many panoramas are in the store (pano_id)."""
    held = store.select("pano_id", F.lit(True).alias("held")).distinct()
    own = panos.join(held, "pano_id", "left")
    return own.groupBy(*by).agg(F.count("*").alias("n"), F.count("held").alias("on_store"), F.round(100.0 * F.count("held") / F.count("*"), 6).alias("hit_pct"))


def budget(minutes: Column, reserved: Column, backlog: Column) -> tuple[Column, Column]:
    """Minutes for images and for depth: the reserve is kept only while depth has a backlog."""
    kept = F.when(backlog > 0, F.least(reserved, minutes)).otherwise(d(0))
    return minutes - kept, kept


def tiles(panos: DataFrame, zoom: int) -> DataFrame:
    """One row for each tile of each panorama at a zoom."""
    across, down = tile_grid(c("width"), c("height"), F.lit(zoom))
    own = panos.where("width > 0 AND height > 0").withColumns({"across": across, "down": down})
    return own.select("*", F.explode(F.sequence(F.lit(0), c("across") - 1)).alias("x")).select("*", F.explode(F.sequence(F.lit(0), c("down") - 1)).alias("y"))


def sizing_scores(boxes: DataFrame, *by: str) -> DataFrame:
    """How often windows of either rule hold the drawn box, and how far boxes fill them."""
    x, y, w, h = (c(k) for k in ("x", "y", "pano_w", "pano_h"))
    own = boxes.withColumns({"v1": sizing.box_v1(x, y, sizing.size_v1(y, h), w, h), "v2": sizing.box_v2(x, y, sizing.width_v2(y, h), w, h)})
    own = own.withColumns({f"in_{k}": sizing.inside(c(k), c("box_cx"), c("box_cy"), c("box_w"), c("box_h"), w) for k in ("v1", "v2")})
    return own.groupBy(*by).agg(F.count("*").alias("n"), *(F.round(100.0 * F.count_if(f"in_{k}") / F.count("*"), 6).alias(f"{k}_inside_pct") for k in ("v1", "v2")), *(F.count_if((c("box_w") <= c(k)["width"]) & (c("box_h") <= c(k)["height"])).alias(f"{k}_fits") for k in ("v1", "v2")))


#: The width that the web page stores, and the share of its window that a box may take at most.
PAGE_WIDTH, CLEARING = 1440.0, 0.49


def sizing_spreads(boxes: DataFrame, *by: str) -> DataFrame:
    """Of windows of either rule: order statistics of their angle, of the share that the box takes and of the width
    stored (the first rule stores its window as it is), how many boxes leave room, and how far a page would have to
    blow them up. A row for each rule."""
    x, y, w, h = (c(k) for k in ("x", "y", "pano_w", "pano_h"))
    first, second = sizing.box_v1(x, y, sizing.size_v1(y, h), w, h)["width"], sizing.box_v2(x, y, sizing.width_v2(y, h), w, h)["width"]
    rules = F.inline(F.array(F.struct(F.lit("v1").alias("rule"), first.alias("wide"), first.alias("stored")), F.struct(F.lit("v2").alias("rule"), second.alias("wide"), sizing.stored_width(second).alias("stored"))))
    own = boxes.select(*by, "box_w", "pano_h", rules).select(*by, "rule", (c("wide") / c("pano_h") * 180.0).alias("deg"), (c("box_w") / c("wide")).alias("fill"), c("stored").cast("double").alias("stored"))
    own = written(own.withColumn("up", F.greatest(F.lit(1.0), F.lit(PAGE_WIDTH) / c("stored"))))
    keys = [*by, "rule"]
    made = own.groupBy(*keys).agg(F.count("*").alias("n"), pct(c("fill") <= CLEARING, F.lit(True)).alias("clearing_pct"), pct(c("up") > 2, F.lit(True)).alias("over_2x_pct"))
    rank = lambda q: F.rint(q / 100.0 * (c("_n") - 1))
    wanted = [(k, q) for k in ("deg", "fill", "stored") for q in (10, 50, 90)] + [("up", 50)]
    found = ranked(own, ["deg", "fill", "stored", "up"], *keys).groupBy(*keys).agg(*(F.round(held(rank(q), c("_m") == k), 6).alias(f"{k}_p{q}") for k, q in wanted))
    return joined(made, found, keys)


def invariance(heights: DataFrame) -> DataFrame:
    """Spread of window angles over frame heights at three depressions, for either rule."""
    own = heights.select("height", F.explode(F.array(d(5), d(10), d(20))).alias("dep"))
    y = c("height") / 2 + c("dep") / 180.0 * c("height")
    own = own.withColumns({"v1": sizing.size_v1(y, c("height")) / c("height") * 180, "v2": sizing.width_v2(y, c("height")) / c("height") * 180})
    return own.groupBy("dep").agg(F.count("*").alias("heights"), *(F.round(F.max(k) / F.min(k), 6).alias(f"{k}_spread") for k in ("v1", "v2")))


#: Disjoint outcomes, which add up to the labels.
OUTCOMES = ("success", "skipped_existing", "missing_pano", "dims_mismatch", "out_of_frame", "errors")


def crop_outcomes(labels: DataFrame, store: DataFrame, there: DataFrame, *by: str) -> DataFrame:
    """What becomes of each label's crop, given the store's panoramas (pano_id, readable, width, height) and the
    crops that are there already (label_type, label_id).

    A row without id, label or finite pixel is an error, as is an image that cannot be read; metadata without
    dimensions are not compared. shifted_vertically counts successes whose window had to move."""
    held = store.select(c("pano_id").alias("_id"), "readable", c("width").alias("_w"), c("height").alias("_h"))
    done = there.select(c("label_type").alias("_type"), c("label_id").alias("_label"), F.lit(True).alias("_done")).distinct()
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    sound = ~absent(c("pano_id")) & c("label_type").isNotNull() & c("label_id").isNotNull() & finite(c("pano_x")) & finite(c("pano_y"))
    own = labels.join(held, F.trim("pano_id") == c("_id"), "left").join(done, (c("label_type") == c("_type")) & (c("label_id") == c("_label")), "left")
    known = (c("pano_width") > 0) & (c("pano_height") > 0)
    what = (
        F.when(~sound, "errors").when(c("_id").isNull(), "missing_pano").when(~c("readable"), "errors")
        .when(F.coalesce(known & ((c("pano_width") != c("_w")) | (c("pano_height") != c("_h"))), F.lit(False)), "dims_mismatch")
        .when(~((c("pano_y") >= 0) & (c("pano_y") < c("_h"))), "out_of_frame").when(c("_done"), "skipped_existing").otherwise("success")
    )
    window = sizing.box_v2(c("pano_x"), c("pano_y"), sizing.width_v2(c("pano_y"), c("_h").cast("double")), c("_w").cast("double"), c("_h").cast("double"))
    own = own.withColumns({"_what": what, "_shifted": F.coalesce(window["shifted"], F.lit(False))})
    return own.groupBy(*by).agg(F.count("*").alias("total"), *(F.count_if(c("_what") == k).alias(k) for k in OUTCOMES), F.count_if((c("_what") == "success") & c("_shifted")).alias("shifted_vertically"))


def pct(flag: Column, of: Column) -> Column:
    return F.round(F.try_divide(100.0 * F.count_if(flag), F.count_if(of)), 6)


def by_scopes(df: DataFrame, scopes: dict[str, str], made: list[Column]) -> DataFrame:
    """The measures over all rows and by each scope's column, as (scope, value), in one pass."""
    named = df.select("*", *(c(x).cast("string").alias(f"_{k}") for k, x in scopes.items()))
    keys = [f"_{k}" for k in scopes]
    sets = named.groupingSets([[], *([k] for k in keys)], *keys).agg(F.grouping_id(*keys).alias("_set"), *made)
    full = 2 ** len(keys) - 1
    scope, value = F.when(c("_set") == full, F.lit("all")), F.when(c("_set") == full, F.lit("all"))
    for i, k in enumerate(scopes):
        mine = c("_set") == full - 2 ** (len(keys) - 1 - i)
        scope, value = scope.when(mine, k), value.when(mine, c(f"_{k}"))
    return sets.select(scope.alias("scope"), value.alias("value"), *(x for x in sets.columns if x not in (*keys, "_set")))


def alive_census(records: DataFrame) -> DataFrame:
    """Of sampled panoramas: the share still served, whether dimensions drifted (where both are known), depth and
    errors, over all and by era and city. A request that failed counts as not served."""
    seen, known = c("found") & c("served_width").isNotNull(), c("stored_width").isNotNull() & c("stored_height").isNotNull()
    differ = (c("served_width") != c("stored_width")) | (c("served_height") != c("stored_height"))
    made = [
        F.count("*").alias("n_sampled"), pct(c("found"), F.lit(True)).alias("alive_pct"), F.count_if(seen & known).alias("dims_comparable"), F.count_if(seen & ~known).alias("dims_unknown_stored"),
        pct(seen & known & differ, seen & known).alias("dims_drift_pct"), pct(seen & F.coalesce("has_depth", F.lit(False)), seen).alias("depth_pct"), F.count("error").alias("errors"),
    ]
    return by_scopes(records, {"era": "era", "city": "city"}, made)


def census_tilt(records: DataFrame) -> DataFrame:
    """Percentiles of the tilt of panoramas still served, without sign; 359.9 degrees are a tenth of one."""
    turned = lambda x: F.abs(180.0 - F.pmod(180.0 - c(x), F.lit(360.0)))
    own = records.where(c("found") & c("served_width").isNotNull()).select(turned("pitch_deg").alias("pitch"), turned("roll_deg").alias("roll"))
    found = several(own, {f"abs_{k}_p{q}_deg": (k, q / 100) for k in ("pitch", "roll") for q in (50, 90, 99)})
    return own.agg(F.count("pitch").alias("n")).crossJoin(F.broadcast(found)).select("n", *(F.round(x, 6).alias(x) for x in found.columns))


def store_census(records: DataFrame) -> DataFrame:
    """How many sampled panoramas are in the store, how many headers were read, and whether frames agree with those
    stored and served: over all, by whether the source still serves them, and of those it does not by era and city."""
    read = c("on_store") & (F.coalesce("store_width", F.lit(0)) > 0) & (F.coalesce("store_height", F.lit(0)) > 0)
    agrees = lambda k: F.coalesce(read & (c(f"{k}_width") > 0) & (c("store_width") == c(f"{k}_width")) & (c("store_height") == c(f"{k}_height")), F.lit(False))
    made = [
        F.count("*").alias("n"), F.count_if("on_store").alias("on_store"), pct(c("on_store"), F.lit(True)).alias("on_store_pct"), F.count_if(read).alias("headers_read"), F.count_if(c("on_store") & ~read).alias("headers_unreadable"),
        F.count_if(agrees("stored")).alias("match_stored"), F.count_if(agrees("served")).alias("match_served"),
    ]
    dead = by_scopes(records.where("NOT found"), {"dead_by_era": "era", "dead_by_city": "city"}, made).where("scope <> 'all'")
    return by_scopes(records, {"alive": "found"}, made).union(dead)


def file_sizes(records: DataFrame) -> DataFrame:
    """Megabytes at the ranks n // 10, n // 2 and 9 n // 10 of the stored files."""
    found = at_ranks(records.where("on_store AND file_bytes > 0"), "file_bytes", {"p10_mb": lambda n: F.floor(n / 10), "p50_mb": lambda n: F.floor(n / 2), "p90_mb": lambda n: F.floor(9 * n / 10)})
    return found.select(*(F.round(c(x) / 1048576, 6).alias(x) for x in ("p10_mb", "p50_mb", "p90_mb")))


def depth_planes(payloads: DataFrame) -> DataFrame:
    """pano_id, width, height, indices and planes (nx, ny, nz, d) of base64url depth payloads (pano_id,
    payload), and error for those that are malformed. The header is five little-endian fields: size,
    planes, width, height, offset."""

    def one(text: str | None) -> tuple:
        import base64
        import struct

        try:
            raw = base64.urlsafe_b64decode((text or "") + "=" * (-len(text or "") % 4))
        except ValueError:
            return None, None, None, None, "bad base64"
        if len(raw) < 8:
            return None, None, None, None, "short header"
        size, n, w, h, at = struct.unpack("<BHHHB", raw[:8])
        if size != 8 or at < 8:
            return None, None, None, None, "bad header"
        if w == 0 or h == 0:
            return None, None, None, None, "no area"
        if len(raw) < at + w * h + 16 * n:
            return None, None, None, None, "short body"
        index = np.frombuffer(raw, np.uint8, w * h, at)
        # Index 0 says that there is no plane, and needs none.
        if index.max() and index.max() >= n:
            return None, None, None, None, "unknown plane"
        planes = np.frombuffer(raw, "<f4", 4 * n, at + w * h).reshape(n, 4)
        return w, h, index.tolist(), planes.astype(float).tolist(), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(x) for x in batch.column(1).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.float64())), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(x), t) for x, t in zip(cols, types, strict=True))], ["pano_id", "width", "height", "indices", "planes", "error"])

    return payloads.select("pano_id", "payload").mapInArrow(run, "pano_id string, width int, height int, indices array<int>, planes array<array<double>>, error string")


def depth_cells(planes: DataFrame) -> DataFrame:
    """pano_id, row, column, plane and distance of every cell of decoded rasters; -1 where there is no plane. A cell's
    ray meets its plane at the distance |d / (ray . n)|; one that runs along the plane never does, and has infinity."""
    cells = planes.where("error IS NULL").select("pano_id", "width", "height", "planes", F.posexplode("indices").alias("cell", "plane"))
    own = cells.select("pano_id", F.floor(c("cell") / c("width")).cast("int").alias("row"), (c("cell") % c("width")).cast("int").alias("column"), "width", "height", "plane", F.get("planes", c("plane")).alias("p"))
    theta = (c("height") - c("row") - 0.5) / c("height") * math.pi
    phi = (c("width") - c("column") - 0.5) / c("width") * 2.0 * math.pi + math.pi / 2.0
    along = F.sin(theta) * F.cos(phi) * c("p")[0] + F.sin(theta) * F.sin(phi) * c("p")[1] + F.cos(theta) * c("p")[2]
    distance = F.when(c("plane") == 0, -1.0).when(along == 0, float("inf")).otherwise(F.abs(c("p")[3] / along))
    return own.select("pano_id", "row", "column", "plane", distance.cast("float").alias("distance"))


def depth_at(x: Column, y: Column, pano_w: Column, pano_h: Column, width: Column, height: Column) -> Column:
    """Cell, from 0, of a depth raster under a pixel; columns wrap, rows stop at the edge."""
    col = F.pmod(F.floor(x * width / pano_w), width)
    row = F.least(F.greatest(F.floor(y * height / pano_h), F.lit(0)), height - 1)
    return (row * width + col).cast("bigint")


def below_horizon(planes: DataFrame) -> DataFrame:
    """pano_id, plane, n (cells below the horizon) and x, y, z, d of each plane, index 0 left out, of each decoded raster.
    Cells are counted where they lie, and make no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            index, at = batch.column("indices").flatten().to_numpy(), 0
            for pano_id, w, h, cells, own in zip(*(batch.column(k).to_pylist() for k in ("pano_id", "width", "height")), batch.column("indices").value_lengths().to_pylist(), batch.column("planes").to_pylist(), strict=True):
                n = np.bincount(index[at : at + cells][w * -(-h // 2) :][: w * (h // 2)])
                out += [(pano_id, int(k), int(n[k]), *own[k]) for k in np.flatnonzero(n) if 0 < k < len(own) and own[k]]
                at += cells
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), *[pa.float64()] * 4), strict=True)], ["pano_id", "plane", "n", "x", "y", "z", "d"])

    return planes.select("pano_id", "width", "height", "indices", "planes").mapInArrow(run, "pano_id string, plane int, n bigint, x double, y double, z double, d double")


def ground_plane(planes: DataFrame, least_vertical: float = 0.7) -> DataFrame:
    """The plane, index 0 left out, with most cells below the horizon, and the camera's height over it. A plane has
    to be near level; ties go to the more level one, then the smaller index. The middle row of an odd height lies
    on the horizon and belongs to neither half."""
    # Dealt by panoramas before anything is held, so that no task holds more than its share of them.
    dealt = below_horizon(planes.where("error IS NULL")).repartition(GROUND_TASKS, "pano_id")
    support = dealt.groupBy("pano_id", "plane").agg(F.sum("n").alias("support"), *(F.first(k).alias(k) for k in ("x", "y", "z", "d")))
    long = F.sqrt(c("x") * c("x") + c("y") * c("y") + c("z") * c("z"))
    level = support.withColumn("long", long).where("long > 0").withColumn("vertical", F.abs("z") / c("long")).where(c("vertical") >= least_vertical)
    best = F.max_by(F.struct("plane", (F.abs("d") / c("long")).alias("camera_height")), F.struct("support", "vertical", -c("plane")))
    return level.groupBy("pano_id").agg(best.alias("x")).select("pano_id", "x.plane", "x.camera_height")
