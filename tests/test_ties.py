"""Clicks that look the same way up tie as they do in SQL."""

import random

import duckdb
from pyspark.sql import functions as F

from gnomon.functions.geometry import click_direction
from gnomon.plans import duck


def test_pitches_have_the_last_bits_of_the_sql(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(360000) / 1000, rng.randrange(70000) / 1000 - 35, float(1 + i % 3), float(rng.randrange(720)), float(rng.randrange(480)), 720.0, 480.0) for i in range(3000)]
    names = "id heading pitch zoom canvas_x canvas_y canvas_width canvas_height".split()
    c = F.col
    _, pitch = click_direction(c("canvas_x"), c("canvas_y"), c("heading"), c("pitch"), c("zoom"), c("canvas_width"), c("canvas_height"))
    got = {r["id"]: r["p"] for r in spark.createDataFrame(rows, names).select("id", pitch.alias("p")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE clicks (" + ", ".join(f"{x} {'BIGINT' if x == 'id' else 'DOUBLE'}" for x in names) + ")")
    con.executemany("INSERT INTO clicks VALUES (?, ?, ?, ?, ?, ?, ?, ?)", rows)
    want = dict(con.execute(f"WITH {duck.direction('clicks', 'aimed', 'canvas_x', 'canvas_y', 'zoom', 'o_')} SELECT id, o_p FROM aimed").fetchall())
    # What is left is the last bit of the two engines' arcsine.
    other = sum(got[i] != want[i] for i in want)
    assert other < 300, other
