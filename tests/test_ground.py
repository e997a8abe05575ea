"""A ground plane is voted for by cells that are counted where they lie."""

import numpy as np

from gnomon.operators import panos


def test_cells_below_the_horizon_are_counted_and_make_no_rows(spark):
    level, steep, wall = [0.0, 0.0, 1.0, 2.5], [0.6, 0.0, 0.8, 4.0], [1.0, 0.0, 0.0, 1.0]
    none = [[0.0] * 4]
    rows = [
        ("even", 2, 4, [2, 2, 2, 2, 1, 1, 1, 2], [*none, level, steep], None),
        ("odd", 1, 3, [2, 2, 1], [*none, level, steep], None),
        ("tie", 2, 2, [1, 1, 1, 2], [*none, steep, level], None),
        ("wall", 1, 2, [1, 1], [*none, wall], None),
        ("twice", 1, 4, [0, 0, 1, 2], [*none, level, steep], None),
        ("twice", 1, 2, [0, 2], [*none, level, steep], None),
        ("bad", None, None, None, None, "short body"),
    ]
    planes = spark.createDataFrame(rows, "pano_id string, width int, height int, indices array<int>, planes array<array<double>>, error string").coalesce(1)
    got = {r["pano_id"]: (r["plane"], round(r["camera_height"], 6)) for r in panos.ground_plane(planes).collect()}
    assert got == {"even": (1, 2.5), "odd": (1, 2.5), "tie": (2, 2.5), "twice": (2, 4.0)}
    # A raster of 200 by 100 cells is a row for each of its planes.
    cells = np.random.default_rng(0).integers(0, 3, 20_000).tolist()
    large = spark.createDataFrame([("p", 200, 100, cells, [*none, level, steep], None)], planes.schema)
    assert {(r["plane"], r["n"]) for r in panos.below_horizon(large.where("error IS NULL")).collect()} == {(k, cells[10_000:].count(k)) for k in (1, 2)}
    # Rows are dealt by panoramas before the first aggregate, and one shuffle serves both.
    plan = panos.ground_plane(large)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") + plan.count("Exchange(") == 1 and "Generate" not in plan
