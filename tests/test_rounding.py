"""Rounding by the scaled double."""

import math

from pyspark.sql import functions as F

from gnomon.functions.geometry import rounded


def test_ties_are_those_of_the_scaled_double(spark):
    """-12.94925 and 18.67375 print as ties, but are none or others when scaled: numbers of record_repair."""
    import duckdb

    values = [-11.543 - 64 * 180 / 8192, 20.08 - 64 * 180 / 8192, 28.674999999999997 - 64 * 180 / 8192, -32.73 - 64 * 180 / 8192, 0.00005, -0.00005, 0.0, 359.99995, 1e300, -2.5]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in values], "x double").select(rounded(F.col("x"), 4)).collect()]
    assert got == [duckdb.execute("SELECT round($1::DOUBLE, 4)", [x]).fetchone()[0] for x in values]
    odd = spark.createDataFrame([(math.nan,), (math.inf,), (None,)], "x double").select(rounded(F.col("x"), 4)).collect()
    assert math.isnan(odd[0][0]) and odd[1][0] == math.inf and odd[2][0] is None
    plain = spark.createDataFrame([(x,) for x in values], "x double").select(F.round("x", 4)).collect()
    assert [r[0] for r in plain] != got
