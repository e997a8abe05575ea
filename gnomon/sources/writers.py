"""Writers: strict JSON, compressed CSV by city, appended logs, histories of annotations."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gnomon.sources.views import COUNTS


def strict_json(summary: DataFrame, rows: int = 10_000) -> str:
    """A summary of at most `rows` rows as JSON with sorted keys; NaN is an error."""
    found = summary.limit(rows + 1).collect()
    if len(found) > rows:
        raise ValueError("not a summary")
    return json.dumps([r.asDict(recursive=True) for r in found], allow_nan=False, sort_keys=True, default=str, indent=1) + "\n"


def records(df: DataFrame) -> DataFrame:
    """Rows as strict JSON texts with sorted keys; a NaN is null."""
    kind = dict(df.dtypes)
    clean = lambda x: F.when(~F.isnan(x), F.col(x)) if kind[x] in ("double", "float") else F.col(x)
    return df.select(F.to_json(F.struct(*(clean(x).alias(x) for x in sorted(df.columns))), {"ignoreNullFields": "false"}).alias("value"))


def csv_by_city(df: DataFrame, path: str, key: str = "city") -> None:
    """One folder of compressed CSV for each city, or value of another key."""
    df.write.mode("overwrite").partitionBy(key).option("header", True).option("compression", "gzip").csv(path)


def append_runs(runs: DataFrame, path: str) -> None:
    """Runs added to a log; counts that a run does not have are blank, and others than the log's are refused."""
    if more := set(runs.columns) - {"start_time", *COUNTS}:
        raise ValueError(f"not in the log: {', '.join(sorted(more))}")
    more = {x: F.lit(None).cast("double") for x in COUNTS if x not in runs.columns}
    runs.withColumns(more).select("start_time", *COUNTS).write.mode("append").csv(path)


def united(*frames: DataFrame) -> DataFrame:
    """Rows of all frames with the union of their columns, in the order first seen."""
    out = frames[0]
    for one in frames[1:]:
        out = out.unionByName(one, allowMissingColumns=True)
    return out


def with_history(annotations: DataFrame) -> DataFrame:
    """The newest annotation of each label and annotator with its revision and those it superseded."""
    w = Window.partitionBy("annotator", "label_uid").orderBy("saved_at", "entry")
    own = annotations.withColumn("revision", F.row_number().over(w))
    row = F.struct("revision", "saved_at", "point", "box", "flags", "notes")
    per = own.groupBy("annotator", "label_uid").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return per.select("annotator", "label_uid", F.element_at("rows", -1).alias("now"), F.slice("rows", 1, F.size("rows") - 1).alias("superseded")).select("annotator", "label_uid", "now.*", "superseded")
