"""Typed readers of label exports, run logs, lists and ledgers. Nothing is inferred: a column of digits
may be ids, and a blank is null, never 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.functions.strata import absent, era
from gnomon.operators.sampling import first_per
from gnomon.sources.views import COUNTS

#: Columns of a label export that studies read, by type.
TEXT = ["user_id", "pano_id", "label_type", "tags", "correct", "image_capture_date"]
WHOLE = ["label_id", "severity", "agree_count", "disagree_count", "unsure_count", "time_created"]
REAL = ["heading", "pitch", "zoom", "canvas_x", "canvas_y", "canvas_width", "canvas_height", "pano_x", "pano_y", "pano_width", "pano_height", "camera_heading", "camera_pitch", "camera_roll", "latitude", "longitude"]
REQUIRED_LABEL = ["pano_id", "pano_x", "pano_y", "label_type_id", "label_id"]
TRUE, FALSE = ["true", "t", "yes", "y", "1"], ["false", "f", "no", "n", "0"]
NOT_A_POPULATION = ["validation-study", "la-piedad-old"]


def raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text: quoted commas, quotes and line ends are kept, a byte order mark is not."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False, encoding="UTF-8")
    return df.toDF(*(name.lstrip("﻿") for name in df.columns))


def need(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [x for x in columns if x not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def number(name: str, kind: str = "double") -> Column:
    """A blank or unreadable number is null, and so is a NaN."""
    x = F.expr(f"try_cast(nullif(trim(`{name}`), '') AS {kind})")
    return (F.when(~F.isnan(x), x) if kind == "double" else x).alias(name)


def label_export(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A label export with its city, which is the stem of its file, and era. pano_source is null where an
    export does not have it. Files are read one schema at a time; pass files of one schema together."""
    df = need(raw_csv(spark, path), [*TEXT, *WHOLE, *REAL])
    source = F.col("pano_source") if "pano_source" in df.columns else F.lit(None).cast("string")
    city = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.csv)?(?:\.gz)?$", 1).alias("city")
    own = df.select(city, *TEXT, *(number(x, "bigint") for x in WHOLE), *(number(x) for x in REAL), source.alias("pano_source"))
    own = own.withColumn("time_created", F.timestamp_millis("time_created"))
    return own.withColumn("era", era(F.col("time_created")))


#: The few columns that a census of crop geometry reads.
NARROW_TEXT, NARROW_REAL = ["pano_id", "label_type"], ["pano_x", "pano_y", "pano_width", "pano_height"]


def narrow_export(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Seven columns of a label export, without era; others need not be there."""
    df = need(raw_csv(spark, path), [*NARROW_TEXT, *NARROW_REAL, "time_created"])
    return df.select(*NARROW_TEXT, *(number(x) for x in NARROW_REAL), F.timestamp_millis(number("time_created", "bigint")).alias("time_created"))


def cities(spark: SparkSession, path: str) -> DataFrame:
    """City ids and the names to show."""
    return need(raw_csv(spark, path), ["city_id", "display_name"]).select(F.trim("city_id").alias("city_id"), "display_name")


def one_rig(labels: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Labels of cities with only the wanted source, and the cities left out with the reason. A city
    with several sources raises when its rows are read."""
    per = labels.groupBy("city").agg(F.collect_set("pano_source").alias("sources"))
    per = per.withColumn("reason", F.when(F.col("city").isin(NOT_A_POPULATION), "not a population").when(F.size("sources") > 1, F.raise_error(F.concat(F.lit("mixed sources in "), F.col("city"))).cast("string")).when(~F.array_contains("sources", source), "other source"))
    return labels.join(per.where("reason IS NULL").select("city"), "city", "left_semi"), per.where("reason IS NOT NULL").select("city", "reason")


def label_intake(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Labels to crop, from CSV or JSON by extension, and how often each repeated label_id came. Of repeated ids the
    first row of the file stays; rows without a readable id are kept, for the crop run to count as errors."""
    if path.endswith(".json"):
        df = spark.read.json(path, multiLine=True, primitivesAsString=True)
    elif path.endswith((".csv", ".csv.gz")):
        df = raw_csv(spark, path)
    else:
        raise ValueError(f"neither CSV nor JSON: {path}")
    optional = [number(x) for x in ("pano_width", "pano_height") if x in df.columns]
    own = need(df, REQUIRED_LABEL).withColumn("_row", F.monotonically_increasing_id())
    own = own.select(number("label_id", "bigint"), "pano_id", number("label_type_id", "int"), number("pano_x"), number("pano_y"), *optional, "_row")
    known = own.where("label_id IS NOT NULL")
    kept = first_per(known, "label_id", order=("_row",)).union(own.where("label_id IS NULL")).drop("_row")
    return kept, known.groupBy("label_id").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def pano_list(spark: SparkSession, path: str) -> DataFrame:
    """Panoramas with flags; an unknown spelling of has_labels raises, a blank means true."""
    df = need(raw_csv(spark, path), ["pano_id"])
    text = lambda k: F.col(k) if k in df.columns else F.lit(None).cast("string")
    flag = F.lower(F.trim(text("has_labels")))
    known = F.when(absent(flag), True).when(flag.isin(TRUE), True).when(flag.isin(FALSE), False).otherwise(F.raise_error(F.concat(F.lit("has_labels: "), flag)).cast("boolean"))
    own = df.select(F.trim("pano_id").alias("pano_id"), *(F.expr(f"try_cast({k} AS int)").alias(k) if k in df.columns else F.lit(None).cast("int").alias(k) for k in ("width", "height")), text("source").alias("source"), known.alias("has_labels"))
    return first_per(own.where(~absent(F.col("pano_id")) & (F.col("pano_id") != "tutorial")), "pano_id", order=("width", "height", "source"))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id a line; what follows # and blank lines do not count."""
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("pano_id")).where("pano_id <> ''").distinct()


def run_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Runs of 18 fields, header or not; rows without a readable time go."""
    fields = ", ".join(["start_time string", *(f"{x} string" for x in COUNTS)])
    df = spark.read.schema(fields).csv(path, header=False)
    city = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.csv)?$", 1).alias("city")
    own = df.select(city, F.expr("try_cast(start_time AS timestamp)").alias("start_time"), *(number(x) for x in COUNTS)).where("start_time IS NOT NULL")
    return own.withColumn("run_id", F.xxhash64("city", "start_time", *COUNTS))


def ledger(spark: SparkSession, path: str, known: tuple[str, ...] = ("0", "1")) -> DataFrame:
    """Entries of two fields with a known status; torn lines are passed over."""
    parts = F.split("value", ",")
    return spark.read.text(path).select(parts.alias("p")).where((F.size("p") == 2) & F.trim(F.col("p")[1]).isin(*known)).select(F.trim(F.col("p")[0]).alias("pano_id"), F.trim(F.col("p")[1]).alias("status"))


def provenance(spark: SparkSession, path: str) -> DataFrame:
    """Name, bytes, SHA-256 and rows of each CSV file; the header is no row."""
    name = F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False).select(name).groupBy("file").agg(F.count("*").alias("rows"))
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return files.join(rows, "file", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))


def bundle(spark: SparkSession, boxes_path: str, records_path: str) -> DataFrame:
    """Drawn boxes with the frames of their panoramas, in pixels; only those boxed at a point."""
    box = "map<string,struct<status:string,point:struct<x:double,y:double>,w:double,h:double,cx:double,cy:double>>"
    boxes = spark.read.text(boxes_path, wholetext=True).select(F.explode(F.from_json("value", box)).alias("pano_id", "b")).where("b.status = 'boxed' AND b.point IS NOT NULL")
    frames = spark.read.schema("pano_id string, width double, height double").json(records_path)
    w, h = F.col("width"), F.col("height")
    return boxes.join(frames, "pano_id").select("pano_id", w.alias("pano_w"), h.alias("pano_h"), (F.col("b.point.x") * w).alias("x"), (F.col("b.point.y") * h).alias("y"), (F.col("b.w") * w).alias("box_w"), (F.col("b.h") * h).alias("box_h"), (F.col("b.cx") * w).alias("box_cx"), (F.col("b.cy") * h).alias("box_cy"))
