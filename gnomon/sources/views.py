"""Label, run, cluster and box views over the star-schema tables, as expressions that Spark and DuckDB
both read. Only inputs are shared between the engines; what is computed from them is written twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.functions import geometry as g
from gnomon.operators.replay import clicked
from gnomon.operators.tables import once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Inputs of a label from an event. k says what goes wrong with the stored pixel.
LABEL = [
    "event_id AS label_id", "user_id", "event_type AS label_type", "ts AS time_created", "event_id % 23 AS k",
    "concat('c', CAST(event_id % 7 AS VARCHAR(9))) AS city", "CAST(event_id % 997 AS VARCHAR(9)) AS pano_id",
    "CAST((event_id * 7919) % 360000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS heading",
    "CAST((event_id * 104729) % 70000 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(35 AS DOUBLE) AS pitch",
    "CAST(1 + event_id % 3 AS DOUBLE) AS zoom",
    "CASE WHEN event_id % 23 = 9 THEN NULL ELSE CAST((event_id * 31) % 720 AS DOUBLE) END AS canvas_x",
    "CAST((event_id * 17) % 480 AS DOUBLE) AS canvas_y",
    "CAST(720 AS DOUBLE) AS canvas_width", "CAST(480 AS DOUBLE) AS canvas_height",
    "CASE WHEN event_id % 23 = 8 THEN NULL ELSE CAST(((event_id % 997) * 4801) % 360000 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS camera_heading",
    "CAST(CASE WHEN event_id % 997 % 3 = 0 THEN 13312 ELSE 16384 END AS DOUBLE) AS pano_width",
    "CAST(CASE WHEN event_id % 997 % 3 = 0 THEN 6656 ELSE 8192 END AS DOUBLE) AS pano_height",
    "CAST((event_id % 997) * 37 % 1000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(5 AS DOUBLE) AS camera_pitch",
    "CAST((event_id % 997) * 53 % 1000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(5 AS DOUBLE) AS camera_roll",
    "CAST(event_id % 5 AS INT) AS agree_count", "CAST(event_id % 3 AS INT) AS disagree_count",
]
#: What the stored pixel of a label was made with.
MADE = [
    "CASE WHEN k = 1 THEN canvas_width / 2 + (canvas_x - canvas_width / 2) * CAST(0.5 AS DOUBLE) ELSE canvas_x END AS made_x",
    "CASE WHEN k = 1 THEN canvas_height / 2 + (canvas_y - canvas_height / 2) * CAST(0.5 AS DOUBLE) ELSE canvas_y END AS made_y",
    "CASE WHEN k = 2 THEN CAST(CASE WHEN zoom = 1 THEN 3 ELSE 1 END AS DOUBLE) ELSE zoom END AS made_zoom",
    "CASE WHEN k = 3 THEN CAST(CASE WHEN pano_height = 8192 THEN 6656 ELSE 8192 END AS DOUBLE) ELSE pano_height END AS made_h",
    "CAST(CASE WHEN k = 4 THEN 37 WHEN k = 6 THEN 5 WHEN k = 7 THEN 40 WHEN k = 10 THEN 37 ELSE 0 END AS DOUBLE) AS off_x",
    "CAST(CASE WHEN k = 5 THEN 25 WHEN k = 6 THEN 4 WHEN k = 7 THEN 50 ELSE 0 END AS DOUBLE) AS off_y",
]
#: Labels near a few anchors, so that they form clusters.
CLUSTER = [
    "event_id AS label_id", "user_id", "ts AS time_created", "concat('c', CAST(event_id % 5 AS VARCHAR(9))) AS city",
    "CAST(event_id % 53 AS VARCHAR(9)) AS pano_id", "event_type AS label_type",
    "CAST(16384 AS DOUBLE) AS pano_width", "CAST(8192 AS DOUBLE) AS pano_height",
    "floor((CAST((event_id % 53 % 13) * 27 AS DOUBLE) + CAST((event_id * 7919) % 10007 AS DOUBLE) / CAST(900 AS DOUBLE)) * CAST(16384 AS DOUBLE) / CAST(360 AS DOUBLE)) AS pano_x",
    "floor(CAST(4096 AS DOUBLE) + (CAST(10 AS DOUBLE) + CAST((event_id * 104729) % 10007 AS DOUBLE) / CAST(900 AS DOUBLE)) * CAST(8192 AS DOUBLE) / CAST(180 AS DOUBLE)) AS pano_y",
]
COUNTS = ["xml_success", "xml_fail", "xml_skip", "xml_total", "xml_minutes", "image_success", "image_fallback_success", "image_fail", "image_skip", "image_total", "image_minutes", "depth_success", "depth_fail", "depth_skip", "depth_total", "depth_minutes", "total_minutes"]
#: Runs of 50 cities from orders. Some cities stop making progress, some counts are blank.
RUN = [
    "o_orderkey AS run_id", "o_custkey % 50 AS city", "o_orderdate AS start_time",
    *(f"CASE WHEN o_orderkey % 37 = {i} THEN NULL ELSE CAST((o_orderkey * {7 + 2 * i}) % {50 + 13 * i} AS DOUBLE) END AS {name}" for i, name in enumerate(COUNTS) if name not in ("image_success", "image_fallback_success", "total_minutes")),
    "CASE WHEN o_custkey % 50 % 6 = 1 AND o_orderdate >= TIMESTAMP '1996-06-01 00:00:00' THEN CAST(0 AS DOUBLE) ELSE CAST(o_orderkey % 40 AS DOUBLE) END AS image_success",
    "CASE WHEN o_custkey % 50 % 6 = 1 AND o_orderdate >= TIMESTAMP '1996-06-01 00:00:00' THEN CAST(0 AS DOUBLE) ELSE CAST(o_orderkey % 3 AS DOUBLE) END AS image_fallback_success",
    "CASE WHEN o_orderkey % 41 = 5 THEN NULL ELSE CAST(20 + o_orderkey % 60 + (CASE WHEN o_orderkey % 97 = 3 THEN 400 ELSE 0 END) AS DOUBLE) END AS total_minutes",
]
#: Panoramas, and what ledgers say of some of them.
PANO = [
    "concat('p', CAST(c_custkey AS VARCHAR(12))) AS pano_id", "concat('c', CAST(c_custkey % 9 AS VARCHAR(9))) AS city",
    "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(CASE WHEN c_custkey % 3 = 0 THEN 13312 ELSE 16384 END AS INT) END AS width",
    "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(CASE WHEN c_custkey % 3 = 0 THEN 6656 ELSE 8192 END AS INT) END AS height",
    "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 4 <> 1 END AS has_labels", "CASE WHEN c_custkey % 5 = 0 THEN 'mapillary' WHEN c_custkey % 17 = 0 THEN 'other' ELSE 'gsv' END AS source",
    "CAST(c_custkey % 1000 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat", "CAST(c_custkey * 7 % 1000 AS DOUBLE) / CAST(100 AS DOUBLE) AS lng",
]
#: Ledgers name a third of the panoramas.
LEDGER = ["concat('p', CAST(o_custkey - o_custkey % 3 AS VARCHAR(12))) AS pano_id", "CASE WHEN o_orderkey % 4 = 0 THEN 'unavailable' ELSE 'saved' END AS status", "o_orderkey AS entry"]
#: Boxes drawn around objects, in frames of two heights.
BOX = [
    "p_partkey AS box_id", "concat('c', CAST(p_partkey % 9 AS VARCHAR(9))) AS city",
    "CAST(CASE WHEN p_partkey % 3 = 0 THEN 13312 ELSE 16384 END AS DOUBLE) AS pano_w", "CAST(CASE WHEN p_partkey % 3 = 0 THEN 6656 ELSE 8192 END AS DOUBLE) AS pano_h",
    "CAST((p_partkey * 1237) % 13000 AS DOUBLE) AS x", "CAST(3400 + (p_partkey * 911) % 2600 AS DOUBLE) AS y",
    "CAST(80 + (p_partkey * 31) % 900 AS DOUBLE) AS box_w", "CAST(60 + (p_partkey * 17) % 500 AS DOUBLE) AS box_h",
    "CAST((p_partkey * 1237) % 13000 + p_partkey % 41 - 20 AS DOUBLE) AS box_cx", "CAST(3400 + (p_partkey * 911) % 2600 + p_partkey % 31 - 15 AS DOUBLE) AS box_cy",
]
#: Labels with tags: types and tags that the referent rules know, and some that they do not.
TAGGED = [
    "event_id AS label_id", "concat('c', CAST(event_id % 7 AS VARCHAR(9))) AS city",
    "CASE event_id % 6 WHEN 0 THEN 'CurbRamp' WHEN 1 THEN 'SurfaceProblem' WHEN 2 THEN 'Obstacle' WHEN 3 THEN 'Crosswalk' WHEN 4 THEN 'Other' ELSE 'NoCurbRamp' END AS label_type",
    "CASE event_id % 8 WHEN 0 THEN '[]' WHEN 1 THEN '[bumpy,cracks]' WHEN 2 THEN '[stairs]' WHEN 3 THEN ' [steep , narrow sidewalk] ' WHEN 4 THEN '[construction,,construction]' WHEN 5 THEN NULL WHEN 6 THEN '[height difference]' ELSE 'litter' END AS tags",
    "CASE event_id % 9 WHEN 0 THEN CAST(event_id AS VARCHAR(12)) WHEN 1 THEN 'CAoSLEFGMVFpcE1' WHEN 2 THEN 'abc' ELSE 'AbCdEfGhIjKlMnOpQrStUv' END AS pano_id",
    "CASE WHEN event_id % 10 = 0 THEN 'mapillary' ELSE 'gsv' END AS pano_source",
]


def view(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """A view's inputs; Spark does not need the lengths that VARCHAR carries for it."""
    import re

    return table(spark, sf_dir, name).selectExpr(*(re.sub(r"VARCHAR\(\d+\)", "STRING", c) for c in columns))


def stored(inputs: DataFrame) -> DataFrame:
    """Labels with stored pixels: the replay of what they were made with, moved by an offset."""
    c = F.col
    df = inputs.selectExpr("*", *MADE)
    df = clicked(df, ("made_heading", "made_pitch"), c("made_x"), c("made_y"), c("heading"), c("pitch"), c("made_zoom"), c("canvas_width"), c("canvas_height"))
    x, y = g.panorama_pixel(c("made_heading"), c("made_pitch"), c("camera_heading"), c("made_h") * 2, c("made_h"))
    df = once(df, {"pano_x": F.pmod(x + c("off_x"), c("pano_width")), "pano_y": y + c("off_y")})
    return df.drop("made_x", "made_y", "made_zoom", "made_h", "off_x", "off_y", "made_heading", "made_pitch")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(view(spark, sf_dir, "events", LABEL))
