"""Plans that the JVM compiles, and inputs that are read once."""

import itertools

from pyspark.sql import functions as F

from gnomon.operators import labels as lb
from gnomon.operators import sampling as sm
from gnomon.operators.replay import classify, covariates, replay
from gnomon.sources import views

#: The JVM interprets longer methods.
COMPILED = 8000


def longest_method(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = df._jdf.queryExecution().debug().codegenToSeq()
        return max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.length()))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_replay_study_and_cascade_are_short_enough_to_be_compiled(spark):
    replayed = replay(views.labels(spark, "/root/testdata/sf0.001"))
    for made in (replayed, covariates(replayed), classify(replayed)):
        assert longest_method(spark, made) < COMPILED


def counted(spark, df):
    """df, and how many of its rows were made so far."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def test_the_draw_makes_its_corpus_once(spark):
    rows = [(f"u{i}", f"c{i % 2}", f"p{i % 9}", "5-15", "mid", "CurbRamp", 8192.0 if i % 4 else 6656.0, float(i * 37 % 360 - 180), i % 5 == 0) for i in range(200)]
    corpus, seen = counted(spark, spark.createDataFrame(rows, "label_uid string, city string, pano_id string, band string, quality string, label_type string, pano_height double, bearing double, replay_mismatch boolean"))
    assert sm.draw(corpus, 7).count() > 0
    assert seen.value == len(rows)


def test_every_nth_row_and_drift_make_their_input_once(spark):
    own, seen = counted(spark, spark.range(1000).selectExpr("id", "id % 3 AS g"))
    assert sm.decimated(own, ("id",), 10, "g").count() == 30
    assert seen.value == 1000
    own, seen = counted(spark, spark.range(1000).selectExpr("CAST(id % 50 AS STRING) AS pano_id", "CAST(id * id % 97 AS DOUBLE) AS dx_deg", "false AS exact_x"))
    assert lb.drift(own).first()["n_panos"] == 50
    assert seen.value == 1000


def test_contrast_pairs_are_those_of_all_pairs(spark):
    turns = [(i * i * 7 + i * 13) % 3600 / 10 - 180 for i in range(60)] + [0.0, 60.0, 0.0, 59.999999, -180.0, 120.0]
    rows = [("c", f"p{i % 20 if i < 60 else 20 + i // 2}", f"u{i:02}", i * 7919 % 101, x) for i, x in enumerate(turns)]
    wanted = set()
    for pano in {r[1] for r in rows}:
        own = sorted((r[3], r[2], r[4]) for r in rows if r[1] == pano)
        far = [(a, b) for a, b in itertools.permutations(own, 2) if round(abs((a[2] - b[2] + 180) % 360 - 180) * 1e6) >= 60_000_000]
        if far:
            wanted.add((pano, own[0][0], *(x[1] for x in min(far))))
    got = sm.contrast_pairs(spark.createDataFrame(rows, "city string, pano_id string, label_uid string, order bigint, bearing double"))
    assert {(r["pano_id"], r["place"], r["first"], r["second"]) for r in got.collect()} == wanted


def test_labels_without_a_bearing_hide_no_pair(spark):
    rows = [("c", "p", "u1", 1, None), ("c", "p", "u2", 2, None), ("c", "p", "u3", 3, 0.0), ("c", "p", "u4", 4, 90.0)]
    got = sm.contrast_pairs(spark.createDataFrame(rows, "city string, pano_id string, label_uid string, order bigint, bearing double"))
    assert [(r["pano_id"], r["place"], r["first"], r["second"]) for r in got.collect()] == [("p", 1, "u3", "u4")]


def test_no_frame_is_counted_anew_for_each_row(spark):
    pool = spark.createDataFrame([("c", "p", "u", 1, 0.0)], "city string, pano_id string, label_uid string, order bigint, bearing double")
    plan = sm.contrast_pairs(pool).groupBy().agg(F.count("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition" in plan and "specifiedwindowframe(RangeFrame, unboundedpreceding" in plan and "specifiedwindowframe(RangeFrame, 60000000" not in plan
