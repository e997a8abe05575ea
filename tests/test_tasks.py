"""Jitter, built tasks, publication of runs, and fields of messages."""

import hashlib
import json
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from gnomon.functions import message
from gnomon.operators import jitter, tasks
from gnomon.sources import published


def drawn(uid, seed, width, height):
    """The offset as numpy draws it."""
    digest = hashlib.blake2b(uid.encode(), digest_size=8, key=str(seed).encode()).digest()
    rng = np.random.default_rng(int.from_bytes(digest, "big"))
    share, sign = rng.uniform(jitter.LEAST, jitter.MOST, size=2), rng.choice(np.array([-1, 1]), size=2)
    across, down = 2 * round(60 / 360 * width / 2), 2 * round(60 / 180 * height / 2)
    return round(share[0] * sign[0] * across), round(share[1] * sign[1] * down)


def test_jitter_is_that_of_a_generator_for_each_label(spark):
    frames = [(16384.0, 8192.0), (13312.0, 6656.0), (3328.0, 1664.0), (5000.0, 3000.0)]
    rows = [(f"city-{i % 7}:{i}", *frames[i % 4]) for i in range(10_000)] + [("", 16384.0, 8192.0), ("é:1", 16384.0, 8192.0), ("city-0:0", 16384.0, 8192.0)]
    frame = spark.createDataFrame([*rows, (None, 1.0, 1.0), ("x", None, 1.0)], "label_uid string, pano_width double, pano_height double").repartition(3)
    got = sorted((r["label_uid"], r["pano_width"], r["jitter_x"], r["jitter_y"]) for r in jitter.with_jitter(frame, 20260812).collect() if r["label_uid"] is not None and r["pano_width"])
    assert got == sorted((u, w, *drawn(u, 20260812, w, h)) for u, w, h in rows)
    assert jitter.with_jitter(frame, 1).where("label_uid IS NULL OR pano_width IS NULL").where("jitter_x IS NOT NULL").count() == 0
    assert jitter.with_jitter(frame.limit(0), 1).count() == 0
    assert jitter.with_jitter(frame, 20260812).join(jitter.with_jitter(frame, 20260813).withColumnsRenamed({"jitter_x": "x", "jitter_y": "y"}), ["label_uid", "pano_width"]).where("jitter_x = x AND jitter_y = y").count() < 20


def test_words_and_generators_equal_numpy():
    rng = np.random.default_rng(1)
    numbers = np.concatenate([rng.integers(0, 1 << 64, 500, dtype=np.uint64), np.array([0, 1, (1 << 32) - 1, 1 << 32, (1 << 64) - 1], np.uint64)])
    words, own = jitter.seeds(numbers), jitter.Generator(jitter.seeds(numbers))
    first = [own.next() for _ in range(3)]
    for i, n in enumerate(numbers.tolist()):
        assert words[:, i].tolist() == np.random.SeedSequence(n).generate_state(4, np.uint64).tolist()
        assert [int(x[i]) for x in first] == np.random.PCG64(n).random_raw(3).tolist()


CORPUS = "label_uid string, city string, pano_id string, label_type string, tags string, pano_x double, pano_y double, pano_width double, pano_height double"


def test_tasks_do_not_tell_where_the_point_is(spark):
    rows = [(f"c:{i}", "c", f"p{i}", "Obstacle" if i % 2 else "CurbRamp", "[b,a]", 10.0 + 40 * i, 4096.0, 16384.0, 8192.0) for i in range(50)]
    corpus = spark.createDataFrame(rows, CORPUS)
    made, geometry = tasks.built(corpus, 7)
    assert not set(made.columns) & set(tasks.TELLING)
    own, where = {r["label_uid"]: r for r in made.collect()}, {r["label_uid"]: r for r in geometry.collect()}
    for uid, _, _, kind, _, x, y, width, height in rows:
        t, g, (jx, jy) = own[uid], where[uid], drawn(uid, 7, width, height)
        assert (t["tile"], t["tile_width"], t["tile_height"], list(t["tags"]), t["rubric"]) == (uid.replace(":", "_") + ".jpg", 2730, 2730, ["a", "b"], tasks.RUBRIC[kind])
        assert (g["jitter_x"], g["jitter_y"]) == (jx, jy)
        assert g["left"] == (round(x + jx - 1365)) % 16384 and g["top"] == round(y + jy - 1365) and g["wraps"] == (g["left"] + 2730 > 16384)
    order = [r["label_uid"] for r in sorted(own.values(), key=lambda r: r["place"])]
    assert order != sorted(order) and order == [r["label_uid"] for r in sorted(tasks.built(corpus.orderBy(F.desc("label_uid")), 7)[0].collect(), key=lambda r: r["place"])]
    with pytest.raises(Exception, match="no rubric for Occlusion"):
        tasks.built(corpus.limit(1).withColumn("label_type", F.lit("Occlusion")), 7)[0].collect()


def test_outputs_of_one_run_are_seen_together(spark, tmp_path):
    root = str(tmp_path / "runs")
    at = lambda n: {"tasks": spark.range(n), "geometry": spark.range(n)}
    with pytest.raises(FileNotFoundError):
        published.published(spark, root, "tasks")
    assert published.publish(root, at(3), "v1", {"scale": 2.5}) is None
    seen = published.published(spark, root, "tasks")
    # A run that stops between its outputs leaves the old one in place.
    broken = at(5) | {"geometry": spark.range(5).select(F.raise_error(F.lit("stopped")))}
    with pytest.raises(Exception, match="stopped"):
        published.publish(root, broken, "v1")
    assert [published.published(spark, root, k).count() for k in ("tasks", "geometry")] == [3, 3]
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert published.publish(root, at(4), "v2") == "v1"
    assert "version v1" in str(told[0].message)
    said = json.loads((tmp_path / "runs" / published.MARKER).read_text())
    assert (said["version"], said["previous_version"], said["outputs"]) == ("v2", "v1", ["geometry", "tasks"])
    assert seen.count() == 3 and published.published(spark, root, "geometry").count() == 4
    (tmp_path / "runs" / published.MARKER).write_text("{torn")
    assert published.marker(root) is None


def test_a_summary_is_made_anew_from_what_is_stored(spark, tmp_path):
    root = str(tmp_path / "census")
    records = spark.range(10).withColumn("found", F.col("id") % 2 == 0)
    published.publish(root, {"records": records, "summary": spark.range(1), "log": spark.range(2)}, "1", {"source": "s"})
    made = published.resummarise(spark, root, lambda rows: rows.agg(F.count_if("found").alias("found")))
    assert made.first()["found"] == 5
    assert published.published(spark, root, "records").count() == 10 and published.published(spark, root, "log").count() == 2
    assert published.marker(root)["source"] == "s" and published.marker(root)["previous_version"] == "1"


def test_fields_of_messages(spark):
    row = {"a": [1, {"it's": None, "b": "x"}, [2.5, [True]]]}
    hops = {"number": (("a", 0), "bigint", 1), "text": (("a", 1, "b"), "string", "x"), "null": (("a", 1, "it's"), "string", None), "deep": (("a", 2, 1, 0), "boolean", True), "no key": (("z", 0), "string", None), "no place": (("a", 9), "string", None), "into a number": (("a", 0, "b"), "string", None), "key of a list": (("a", "b"), "string", None), "place of a map": ((0,), "string", None), "other kind": (("a", 1, "b"), "bigint", None)}
    own = spark.createDataFrame([(json.dumps(row),), ("{torn",), (None,), ("3",)], "m string").select("m", message.parsed(F.col("m")).alias("v"))
    got = own.select("m", *(message.field(F.col("v"), *at, kind=kind).alias(name) for name, (at, kind, _) in hops.items())).collect()
    assert {name: got[0][name] for name in hops} == {name: want for name, (*_, want) in hops.items()}
    assert all(r[name] is None for r in got[1:] for name in hops)


def test_responses(spark):
    def response(code, angles, payload):
        return json.dumps([None, [[[code], 0, 0, 0, 0, [[0, [0, 0, angles], 0, 0, 0, [0, [0, 0, payload]]]]]]])

    rows = {"ok": response(1, [180, 90, None], "abc"), "also": response(3, [90], ""), "gone": response(2, [1, 2, 3], "abc"), "page": "<html>", "quota": json.dumps({"error": 1}), "short": json.dumps([None, [[[1]]]]), "null": None}
    got = {r["k"]: r for r in message.responses(spark.createDataFrame(list(rows.items()), "k string, response string")).collect()}
    pi = np.pi
    want = {"ok": (True, pi, 0.0, None, "abc", None), "also": (True, pi / 2, None, None, None, None), "gone": (False, None, None, None, None, None), "short": (True, None, None, None, None, None)} | {k: (False, None, None, None, None, "unknown response") for k in ("page", "quota", "null")}
    for k, values in want.items():
        assert tuple(got[k][x] for x in ("found", "heading", "pitch", "roll", "payload", "error")) == values, k
