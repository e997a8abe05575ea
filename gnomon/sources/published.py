"""Several outputs of one run, published together, with the version of the rule that made them.

Each run writes its outputs to a folder of its own. One small marker, replaced as a whole, then says which run counts;
who reads an output goes by the marker, and so sees outputs of one run only, the old one's or the new one's."""

from __future__ import annotations

import json
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gnomon.sources import files

MARKER = "current.json"


def marker(root: str) -> dict | None:
    """What counts now; none where nothing was published or the marker cannot be read."""
    try:
        return json.loads(bytes(files.whole(f"{root}/{MARKER}")))
    except (OSError, ValueError):
        return None


def publish(root: str, outputs: dict[str, DataFrame], version: str, settings: dict | None = None) -> str | None:
    """Write outputs, then let them count. The version that counted before is kept in the marker and given back; where
    it is another one, that is told: what was made under it is not made again by itself."""
    before = (marker(root) or {}).get("version")
    if before is not None and before != version:
        warnings.warn(f"{root} was made by version {before}, this run is version {version}", stacklevel=2)
    run = uuid.uuid4().hex
    for name, df in outputs.items():
        df.write.parquet(f"{root}/{run}/{name}")
    said = {**(settings or {}), "version": version, "previous_version": before, "run": run, "outputs": sorted(outputs)}
    with files.replaced(f"{root}/{MARKER}") as out:
        out.write((json.dumps(said, sort_keys=True, indent=1) + "\n").encode())
    return before


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An output of the run that counts."""
    said = marker(root)
    if not said or name not in said["outputs"]:
        raise FileNotFoundError(f"no {name} was published in {root}")
    return spark.read.parquet(f"{root}/{said['run']}/{name}")


def resummarise(spark: SparkSession, root: str, summarise: Callable[[DataFrame], DataFrame], records: str = "records", summary: str = "summary") -> DataFrame:
    """The summary made anew from the records that are stored, and published with them under the version that they
    have: a mended summary needs no new records."""
    said = marker(root)
    own = published(spark, root, records)
    kept = {k: v for k, v in said.items() if k not in ("version", "previous_version", "run", "outputs")}
    others = {name: published(spark, root, name) for name in said["outputs"] if name not in (records, summary)}
    publish(root, {records: own, summary: summarise(own), **others}, said["version"], kept)
    return published(spark, root, summary)
