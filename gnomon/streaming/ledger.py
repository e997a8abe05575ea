"""The ledger as a stream: outcomes that come in twice are entered once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def new_outcomes(entries: DataFrame, late: str = "1 day") -> DataFrame:
    """First entry of each panorama and status within the lateness, from a stream with `at`."""
    return entries.withWatermark("at", late).dropDuplicatesWithinWatermark(["pano_id", "status"])
