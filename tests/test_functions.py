"""Value tables and properties of the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from gnomon.functions import geometry as g
from gnomon.functions import sizing, strata
from gnomon.operators import clusters, sampling
from gnomon.operators.runs import trailing_failures


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(("zoom", "fov"), [(1, 89.75), (2, 53.0), (3, 195.93 / 1.92**3)])
def test_fov(spark, zoom, fov):
    assert one(spark, g.viewer_fov(g.d(zoom))) == pytest.approx(fov)


def test_centre_click_looks_where_the_view_looks(spark):
    h, p = g.click_direction(g.d(360), g.d(240), g.d(77), g.d(-12), g.d(2), g.d(720), g.d(480))
    assert one(spark, h) == pytest.approx(77)
    assert one(spark, p) == pytest.approx(-12)


def test_offsets_wrap_at_the_seam(spark):
    assert one(spark, g.wrapped_offset(g.d(2), g.d(16382), g.d(16384))) == 4
    assert one(spark, g.wrapped_offset(g.d(8192), g.d(0), g.d(16384))) == 8192
    assert one(spark, g.separation(g.d(350), g.d(10))) == 20


def test_pixels_round_half_to_even_and_nulls_stay(spark):
    assert one(spark, F.rint(g.d(2.5))) == 2
    assert one(spark, g.clipped(F.lit(None).cast("double"), g.d(0), g.d(1))) is None
    x, y = g.panorama_pixel(g.d(0), g.d(0), g.d(0), g.d(16384), g.d(8192))
    assert (one(spark, x), one(spark, y)) == (8192, 4096)


def test_distance_is_continuous_at_the_blend(spark):
    near, far = (one(spark, g.blended_distance(g.d(11.25 + e))) for e in (1e-7, -1e-7))
    assert near == pytest.approx(far, abs=1e-5)
    assert one(spark, g.blended_distance(g.d(-20))) == pytest.approx(23.85, abs=0.05)


def test_clamp_onset_inverts_the_size(spark):
    dep = one(spark, sizing.clamp_onset(g.d(8192)))
    y = 4096 + dep / 180 * 8192
    assert one(spark, sizing.size_v1(g.d(y), g.d(8192))) == pytest.approx(1500, rel=1e-6)
    assert dep == pytest.approx(22.2, abs=0.1)


def test_second_rule_does_not_depend_on_resolution(spark):
    a, b = (one(spark, sizing.width_v2(g.d(h / 2 + 10 / 180 * h), g.d(h)) / h) for h in (6656, 8192))
    assert a == pytest.approx(b)


def test_bands_are_closed_above_and_eras_below(spark):
    assert [one(spark, strata.band(g.d(x))) for x in (5, 5.0001, 30, 90, 91)] == ["<5", "5-15", "15-30", ">30", None]
    t = lambda s: F.lit(s).cast("timestamp")
    assert [one(spark, strata.era(t(s))) for s in ("2020-12-31", "2021-01-01", "2023-03-29", None)] == ["legacy", "mid", "post179", "mid"]
    assert one(spark, strata.quality(t(None))) is None


def test_tags_and_referents(spark):
    assert one(spark, strata.tags(F.lit(" [a, b c ,,a] "))) == ["a", "b c"]
    assert one(spark, strata.tags(F.lit(None).cast("string"))) == []
    tag = F.array(F.lit("height difference"))
    assert one(spark, strata.has_referent(F.lit("Obstacle"), tag)) is True
    assert one(spark, strata.has_referent(F.lit("SurfaceProblem"), tag)) is False


def test_allocation_adds_up(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3)], "cell string, n bigint")
    got = {r["cell"]: r["allotted"] for r in sampling.largest_remainder(rows, 7).collect()}
    assert sum(got.values()) == 7 and got["a"] == 3


def test_components_join_chains(spark):
    points = spark.createDataFrame([(i, i, "c", "p", "t", 1.0 * i, 0.0) for i in range(6)] + [(9, 9, "c", "p", "t", 200.0, 0.0)], "label_id bigint, user_id bigint, city string, pano_id string, label_type string, az double, el double")
    got = {r["label_id"]: r["cluster_id"] for r in clusters.clusters(points, 1.5).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 9: 9}


def test_noise_is_recovered(spark):
    import random

    rng = random.Random(3)
    rows = [(2 * i + u, u, "c", str(i), "t", i * 7 % 300 + rng.gauss(0, 0.4), -10 + rng.gauss(0, 0.3), i) for i in range(900) for u in (0, 1)]
    points = spark.createDataFrame(rows, "label_id bigint, user_id bigint, city string, pano_id string, label_type string, az double, el double, time_created bigint")
    got = clusters.sigma(clusters.cross_user_pairs(clusters.clusters(points, 4.0))).first()
    assert got["sigma_az"] == pytest.approx(0.4 * math.cos(math.radians(10)), rel=0.15)
    assert got["sigma_el"] == pytest.approx(0.3, rel=0.15)


def test_falling_failures_count_as_none(spark):
    rows = [("c", i, f"2024-01-{i + 1:02d} 00:00:00", v) for i, v in enumerate([0.0, 30.0, 10.0, None, 50.0])]
    runs = spark.createDataFrame(rows, "city string, run_id bigint, start_time string, image_fail double")
    assert trailing_failures(runs).first()["avg_new"] == 15.0


def labels(spark, n=600):
    """Labels as in the views, from numbers instead of a table."""
    import re

    from gnomon.sources import views

    events = spark.range(1, n).selectExpr("id AS event_id", "id % 50 AS user_id", "concat('t', id % 3) AS event_type", "timestamp_seconds(1704067200 + id * 60) AS ts")
    made = events.selectExpr(*(re.sub(r"VARCHAR\(\d+\)", "STRING", x) for x in views.LABEL))
    return views.stored(made)


def test_cascade_finds_what_was_done(spark):
    from gnomon.operators.replay import classify, replay, solve_record

    got = classify(replay(labels(spark)))
    by = {}
    for r in got.select("k", "klass").collect():
        by.setdefault(r["k"], []).append(r["klass"])
    most = {k: max(set(v), key=v.count) for k, v in by.items()}
    assert [most[k] for k in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9)] == ["exact", "dpr2", "zoom_desync", "frame_change", "x_only", "y_only", "xy_small", "multi_field", "unreplayable", "unreplayable"]
    solved = solve_record(got.where("klass NOT IN ('exact', 'unreplayable', 'frame_change')")).select("klass", "zoom", "new_zoom", "canvas_x", "new_canvas_x", "heading", "new_heading", "repaired").collect()
    assert sum(r["repaired"] for r in solved) / len(solved) > 0.95
    halves = [r for r in solved if r["klass"] == "dpr2"]
    assert halves and all(abs(r["new_canvas_x"] - (360 + (r["canvas_x"] - 360) / 2)) <= 0.5 and r["new_canvas_x"] % 1 == 0 for r in halves)
    other = [r for r in solved if r["klass"] == "zoom_desync"]
    assert other and all(r["new_zoom"] != r["zoom"] for r in other) and all(0 <= r["new_heading"] <= 360 for r in solved)


def test_leaders_of_a_whole_city_equal_the_sequential_rule(spark):
    from math import cos, hypot, radians

    from gnomon.plans.catalog import QUERIES, cluster_points

    places = [(r["city"], r["label_id"], r["az"] / 10000, r["el"] / 1000) for r in cluster_points(spark, "/root/testdata/sf0.001").collect()]
    high = [("north", 10 + i * 37 % 101, 60 + i * 37 % 101 % 9 * 0.00004, 5 + i % 12 * 0.00005) for i in range(101)]
    for rows, got in ((places, QUERIES["greedy_leader"](spark, "/root/testdata/sf0.001")), (high, clusters.leaders(spark.createDataFrame(high, "city string, label_id bigint, lat double, lng double")))):
        want, leading = {}, {}
        for city, n, lat, lng in sorted(rows, key=lambda r: r[1]):
            near = [i for i, y, x in leading.get(city, []) if hypot(radians(lng - x) * 6371000.0 * cos(radians(y)), radians(lat - y) * 6371000.0) <= 8]
            want[city, n] = min(near, default=n)
            if not near:
                leading.setdefault(city, []).append((n, lat, lng))
        assert {(r["city"], r["label_id"]): r["leader"] for r in got.collect()} == want


def test_percentiles_of_ranges_are_exact(spark, monkeypatch):
    import numpy as np

    from gnomon.operators import quantiles
    from gnomon.operators.quantiles import at_ranks, percentiles

    rng = np.random.default_rng(2)
    values = {"a": rng.normal(size=3000), "b": np.round(rng.normal(size=500), 1), "c": np.array([4.0])}
    rows = [(k, float(x)) for k, v in values.items() for x in v] + [("a", None), ("d", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r for r in percentiles(df, "x", {"p10": 0.1, "p50": 0.5, "top": 1.0}, "k").collect()}
    assert set(got) == {"a", "b", "c"}
    for k, v in values.items():
        for name, q in (("p10", 0.1), ("p50", 0.5), ("top", 1.0)):
            assert abs(got[k][name] - np.quantile(v, q)) < 1e-12
    # By ranges too, and where the bounds of the sketch are wrong.
    for largest, accuracy, margin in ((1, 10_000, 4), (10**9, 10, 0)):
        monkeypatch.setattr(quantiles, "LARGEST", largest)
        monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
        monkeypatch.setattr(quantiles, "MARGIN", margin)
        again = {r["k"]: r for r in percentiles(df, "x", {"p10": 0.1, "p50": 0.5, "top": 1.0}, "k").collect()}
        assert again == got
    every = np.sort(np.concatenate(list(values.values())))
    ranks = at_ranks(df, "x", {"low": lambda n: F.floor(n / 10), "last": lambda n: n - 1}).first()
    assert (ranks["low"], ranks["last"]) == (every[len(every) // 10], every[-1])
    assert percentiles(df.limit(0), "x", {"p50": 0.5}).first()["p50"] is None


def test_components_of_any_shape(spark, monkeypatch):
    import random

    from gnomon.operators import graph

    rng = random.Random(3)
    nodes = list(range(600))
    rng.shuffle(nodes)
    edges = [(nodes[i], nodes[i + 1]) for i in range(0, 200)] + [(nodes[210], nodes[i]) for i in range(211, 300)] + [(nodes[i], nodes[i + 1]) for i in range(300, 500, 2)]
    root = {x: x for e in edges for x in e}
    for _ in range(600):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    monkeypatch.setattr(graph, "EDGES", 7)
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    assert {r["node"]: r["root"] for r in graph.smallest_reachable(df).collect()} == root


def test_assignment_is_of_least_cost():
    from itertools import permutations

    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 6))
        m = int(rng.integers(n, 7))
        cost = rng.random((n, m)) if rng.random() < 0.7 else rng.integers(0, 3, (n, m)).astype(float)
        to = clusters.assignment(cost)
        assert len(set(to.tolist())) == n
        assert abs(cost[np.arange(n), to].sum() - min(sum(cost[i, p[i]] for i in range(n)) for p in permutations(range(m), n))) < 1e-9


def test_draw_equals_the_sequential_rule(spark, monkeypatch):
    from gnomon.operators import sampling
    from gnomon.plans.studies import corpus

    monkeypatch.setattr(sampling, "CONTRAST_PANOS", 9)
    monkeypatch.setattr(sampling, "OTHER_FRAMES", 25)
    monkeypatch.setattr(sampling, "MISMATCHES", 12)
    monkeypatch.setattr(sampling, "PER_PANO", 2)
    pool = corpus(spark, "/root/testdata/sf0.001").withColumn("pano_id", (F.col("label_id") % 90).cast("string")).withColumn("city", F.lit("c"))
    pool = spark.createDataFrame(pool.select("label_uid", "city", "pano_id", "band", "quality", "label_type", "pano_height", "bearing", "replay_mismatch").where("bearing IS NOT NULL").collect())
    rows = [r.asDict() for r in pool.withColumn("order", F.xxhash64("label_uid", F.lit(5))).collect()]
    rows.sort(key=lambda r: (r["order"], r["label_uid"]))
    roles, per = {}, {}

    def take(r, role):
        if r["label_uid"] not in roles:
            if per.get(r["pano_id"], 0) >= 2:
                return False
            per[r["pano_id"]] = per.get(r["pano_id"], 0) + 1
        roles.setdefault(r["label_uid"], set()).add(role)
        return True

    panos: dict = {}
    for r in rows:
        panos.setdefault(r["pano_id"], []).append(r)
    n = 0
    for own in panos.values():
        far = next(((a, b) for i, a in enumerate(own) for b in own[i + 1 :] if abs((a["bearing"] - b["bearing"] + 180) % 360 - 180) >= 60), None)
        if far and n < 9:
            n += take(far[0], "contrast") and take(far[1], "contrast")
    by = {r["label_uid"]: r for r in rows}
    for flag, role, quota in ((lambda r: r["pano_height"] != 8192, "resolution", 25), (lambda r: r["replay_mismatch"], "mismatch", 12)):
        for r in filter(flag, rows):
            if sum(bool(flag(by[u])) for u in roles) >= quota:
                break
            take(r, role)
    cells: dict = {}
    for r in rows:
        cells.setdefault((r["band"], r["quality"], r["label_type"]), []).append(r)
    for own in cells.values():
        for r in own:
            if sum(x["label_uid"] in roles for x in own) >= 3:
                break
            if r["label_uid"] not in roles:
                take(r, "cell")
    drawn = sampling.draw(pool, 5, 3)
    assert {r["label_uid"]: r["roles"] for r in drawn.collect()} == {k: ",".join(sorted(v)) for k, v in roles.items()}
    short = {r["stratum"]: (r["achieved"], r["shortfall"]) for r in sampling.shortfalls(drawn).collect()}
    assert short["contrast_panos"][0] >= 9 and short["resolution"] == (sum(by[u]["pano_height"] != 8192 for u in roles), 0)


def test_depth_payloads(spark):
    import base64
    import struct

    import numpy as np

    from gnomon.operators import panos

    def payload(w, h, index, planes, size=8, at=8, n=None):
        head = struct.pack("<BHHHB", size, len(planes) if n is None else n, w, h, at)
        return base64.urlsafe_b64encode(head + bytes(index) + b"".join(struct.pack("<4f", *p) for p in planes)).decode().rstrip("=")

    ground, tilted = (0.0, 0.0, -2.0, 5.0), (0.6, 0.0, 0.8, 3.0)
    good = payload(2, 3, [0, 0, 1, 2, 2, 2], [(0, 0, 0, 0), ground, tilted])
    rows = [("ok", good), ("none", payload(2, 1, [0, 0], [])), ("header", payload(1, 1, [0], [], at=3)), ("size", payload(1, 1, [0], [], size=9)), ("area", payload(0, 1, [], [])), ("cut", good[:-8]), ("plane", payload(1, 1, [3], [ground])), ("text", "%%%=%%"), ("null", None)]
    decoded = panos.depth_planes(spark.createDataFrame(rows, "pano_id string, payload string"))
    got = {r["pano_id"]: r for r in decoded.collect()}
    assert [got[k]["error"] for k in ("ok", "none", "header", "size", "area", "cut", "plane", "null")] == [None, None, "bad header", "bad header", "no area", "short body", "unknown plane", "short header"]
    assert got["text"]["error"]
    cells = {(r["row"], r["column"]): r["distance"] for r in panos.depth_cells(decoded.where("pano_id = 'ok'")).collect()}
    for row in range(3):
        for column in range(2):
            theta, phi = (3 - row - 0.5) / 3 * np.pi, (2 - column - 0.5) / 2 * 2 * np.pi + np.pi / 2
            p = [None, ground, tilted][[0, 0, 1, 2, 2, 2][row * 2 + column]]
            want = -1 if p is None else abs(p[3] / np.dot(p[:3], (np.sin(theta) * np.cos(phi), np.sin(theta) * np.sin(phi), np.cos(theta))))
            assert np.isclose(cells[row, column], want, rtol=1e-4) or want > 1e6
    planes = {r["pano_id"]: (r["plane"], round(r["camera_height"], 4)) for r in panos.ground_plane(decoded).collect()}
    assert planes == {"ok": (2, 3.0)}


def test_small_functions(spark):
    from gnomon.functions import geometry, sizing, strata

    one = lambda **k: spark.range(1).select(*(v.alias(x) for x, v in k.items())).first()
    lit = lambda x: F.lit(float(x))
    got = one(a=geometry.turned(lit(180)), b=geometry.turned(lit(-180)), c=geometry.turned(lit(540.5)), d=geometry.turned(lit(-190)))
    assert tuple(got) == (180.0, 180.0, -179.5, 170.0)
    got = one(t=strata.display_tags(F.lit("[steep,bumpy, steep]")), u=strata.label_uid(F.lit("c"), F.lit(7)), n=strata.tile_name(F.lit("c:7")), s=strata.shard(F.lit("AbCd")), k=strata.frame_key(lit(2), lit(1)), e=strata.frame_key(F.lit(None).cast("double"), lit(1)))
    assert (got["t"], got["u"], got["n"], got["s"], got["k"], got["e"]) == (["bumpy", "steep"], "c:7", "c_7.jpg", "Ab", "2x1", "unresolved")
    w, h = strata.wide_pair(lit(0), lit(5), lit(7), lit(8))
    r, full, half = sizing.margins(lit(0.25))
    got = one(w=w, h=h, r=r, full=full, half=half, m=geometry.ground_metres(lit(0), lit(0), lit(0), lit(1)), f=strata.in_frame(F.lit("taipei")), g=strata.in_frame(F.lit(None).cast("string")))
    assert (got["w"], got["h"], got["r"], got["full"], got["half"], got["f"], got["g"]) == (7, 8, 4.0, 3.0, 1.5, False, True)
    assert abs(got["m"] - 111194.93) < 0.01
    window = sizing.tile_window(lit(10), lit(4000), lit(16384), lit(8192), lit(3), lit(-2))
    x, y = sizing.pano_to_tile(window, lit(5), lit(4010), lit(16384))
    back = spark.range(1).select(window.alias("w"), x.alias("x"), y.alias("y")).select(*(v.alias(k) for k, v in zip("ab", sizing.tile_to_pano(F.col("w"), F.col("x"), F.col("y"), lit(16384)), strict=True))).first()
    assert tuple(back) == (5, 4010)
    for height in (2048.0, 6656.0, 8192.0):
        onset = one(x=sizing.truncation_onset(lit(height)))["x"]
        over = lambda dep, height=height: one(x=height / 2 + lit(dep) / 90 * (height / 2) + sizing.size_v1(height / 2 + lit(dep) / 90 * (height / 2), lit(height)) / 2 > height)["x"]
        assert over(onset) and not over(onset - 1e-5)


def test_annotations_are_checked(spark):
    from gnomon.operators import tasks

    rows = [
        ("ok", [], (1.0, 2.0), (0.0, 0.0, 5.0, 5.0)), ("absent", ["object-absent"], None, None), ("flag", ["lost"], (1.0, 2.0), (0.0, 0.0, 5.0, 5.0)), ("no point", ["ambiguous"], None, (0.0, 0.0, 5.0, 5.0)),
        ("no box", None, (1.0, 2.0), None), ("off", [], (11.0, 2.0), (0.0, 0.0, 5.0, 5.0)), ("flat", [], (1.0, 2.0), (0.0, 0.0, 0.0, 5.0)), ("out", [], (1.0, 2.0), (8.0, 0.0, 5.0, 5.0)),
    ]
    df = spark.createDataFrame([(*r, 10, 10) for r in rows], "k string, flags array<string>, point struct<x:double,y:double>, box struct<x:double,y:double,w:double,h:double>, tile_width int, tile_height int")
    assert {r["k"]: r["error"] for r in tasks.validated(df).collect()} == {"ok": None, "absent": None, "flag": "unknown flag", "no point": "no point", "no box": "no box", "off": "point outside", "flat": "no area", "out": "box outside"}
    with pytest.raises(ValueError, match="pano_x"):
        tasks.blind(spark.createDataFrame([(1, 2.0)], "label_uid int, pano_x double"))
    asked = spark.createDataFrame([("me", "a.jpg"), ("../me", "a.jpg"), ("me", "geometry.json")], "annotator string, tile string")
    assert [tuple(r) for r in tasks.allowed(asked, asked.where("tile = 'a.jpg'")).select("annotator", "tile").collect()] == [("me", "a.jpg")]
    own = spark.createDataFrame([("c:1",), ("c:2",)], "label_uid string")
    corpus = spark.createDataFrame([("c:1", "x")], "label_uid string, kind string")
    assert tasks.looked_up(own.limit(1), corpus, "kind").count() == 1
    with pytest.raises(Exception, match="no such label: c:2"):
        tasks.looked_up(own, corpus, "kind").collect()


def test_objects_seen_from_several_panoramas(spark):
    near, far = 0.00002, 0.01
    rows = [("c", 1, "p1", 7, 10.0, 5.0), ("c", 2, "p2", 7, 10.0 + near, 5.0), ("c", 3, "p2", 8, 10.0, 5.0 + near), ("c", 4, "p3", 8, 10.0 + far, 5.0), ("c", 5, "p4", 9, None, 5.0), ("d", 1, "q", 1, 10.0, 5.0)]
    points = spark.createDataFrame(rows, "city string, label_id bigint, pano_id string, user_id bigint, lat double, lng double")
    got = {r["city"]: tuple(r)[1:] for r in clusters.multi_perspective(points).collect()}
    assert got == {"c": (4, 2, 1, 1, 2), "d": (1, 1, 0, 0, 1)}


def test_chosen_labels_get_the_roles_of_later_strata(spark):
    """Five labels of one panorama, none of the usual height: the pair far apart is not among the first three."""
    uids = spark.createDataFrame([(f"c:{i}",) for i in range(5)], "label_uid string").withColumn("o", F.xxhash64("label_uid", F.lit(5))).orderBy("o").collect()
    bearings = [0.0, 1.0, 2.0, -31.0, 31.0]
    rows = [(r["label_uid"], "c", "p", "<5", "mid", "CurbRamp", 6656.0, b, True) for r, b in zip(uids, bearings, strict=True)]
    pool = spark.createDataFrame(rows, "label_uid string, city string, pano_id string, band string, quality string, label_type string, pano_height double, bearing double, replay_mismatch boolean")
    drawn = sampling.draw(pool, 5)
    got = {r["bearing"]: r["roles"] for r in drawn.collect()}
    assert got == {0.0: "mismatch,resolution", -31.0: "contrast,mismatch,resolution", 31.0: "contrast,mismatch,resolution"}
    assert {r["bearing"] for r in sampling.with_role(drawn, "contrast").collect()} == {-31.0, 31.0}
    assert sampling.with_role(drawn, "match").count() == 0


def test_parts_of_an_odd_number_of_groups(spark):
    parts = [r["split"] for r in sampling.split_groups(spark.range(997).withColumn("id", F.col("id").cast("string")), "id", 3).collect()]
    assert (parts.count("tune"), parts.count("eval")) == (498, 499)


def test_running_totals_of_groups_and_ranges(spark):
    import random

    from gnomon.operators.quantiles import running

    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, 0, 1, 2])) for i in range(400)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(map(tuple, running(spark.createDataFrame(rows, "k string, at int, x int").repartition(7), ("k",), ("at",), {"sum": F.col("x"), "n": F.lit(1)}).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, so_far, all_ = [], {}, {}
    for k, _, x in rows:
        all_[k] = (all_.get(k, (0, 0))[0] + (x or 0), all_.get(k, (0, 0))[1] + 1)
    for k, at, x in sorted(rows, key=lambda r: r[1]):
        s, n = so_far.get(k, (0, 0))
        so_far[k] = (s + (x or 0), n + 1)
        want.append((k, at, x, *all_[k], *so_far[k]))
    assert got == sorted(want, key=repr)


def test_one_point_and_one_label(spark):
    from gnomon.operators import replay

    x, y = replay.replay_point(77.0, -12.0, 2.0, 360.0, 240.0, 77.0, 16384.0, 8192.0)
    got = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert (got["x"], got["y"]) == (8192.0, 4096.0 + round(4096 * 12 / 90))
    rows = [("c", 1, "exact", 1.0, 2.0, 0.0, float("nan")), ("c", 2, "x_only", 1.0, 2.0, 37.0, 0.0), ("d", 1, "exact", 9.0, 9.0, 0.0, 0.0)]
    own = spark.createDataFrame(rows, "city string, label_id bigint, klass string, heading double, pitch double, dx double, dy double")
    own = own.withColumns({k: F.lit(1.0) for k in ("zoom", "canvas_x", "canvas_y", "pano_x", "pano_y")} | {"time_created": F.lit("t"), "dx_deg": F.col("dx") / 10, "dy_deg": F.col("dy") / 10})
    got = replay.case_study(own, "c", 2).first()
    assert (got["klass"], got["stored"]["heading"], got["residual_px"]["dx"], got["marker_px"]) == ("x_only", 1.0, 37.0, round(3.7 / 89.75 * 720, 1))
    assert replay.case_study(own, "c", 1).first()["residual_px"]["dy"] is None and replay.case_study(own, "e", 1).count() == 0


def test_counts_as_they_are_shown(spark):
    from gnomon.operators.runs import shown

    got = spark.createDataFrame([(1234567.9,), (12.0,), (None,)], "x double").select(shown(F.col("x")).alias("s")).collect()
    assert [r["s"] for r in got] == ["1,234,567", "12", "?"]
