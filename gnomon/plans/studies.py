"""Named queries of whole studies: eligibility, censuses, crops, depth, matching, objects and the corpus draw."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.functions import strata
from gnomon.functions.geometry import depression
from gnomon.operators import clusters as cl
from gnomon.operators import labels as lb
from gnomon.operators import panos as pn
from gnomon.operators import sampling as sm
from gnomon.operators import tasks as tk
from gnomon.operators.replay import covariates, replay
from gnomon.plans import duck
from gnomon.plans.registry import query
from gnomon.sources import views

c = F.col
#: Bounds of eras for the events, which span one month.
LEGACY_END, LIVE_FROM, FIXED_FROM = "2024-01-08", "2024-01-16", "2024-01-24"


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(views.labels(spark, sf_dir))


def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covariates(replayed(spark, sf_dir))


# Replay and off-axis studies

@query(f"WITH {duck.STUDY} SELECT city, count(*) AS n_labels, count(*) FILTER (replayable_y) AS replayable_y, count(*) FILTER (exact_y) AS exact_y, count(*) FILTER (exact_x AND exact_y) AS exact_x_and_y, count(*) FILTER (eligible) AS eligible, count(*) FILTER (eligible AND NOT (exact_x AND exact_y)) AS kept_by_y_only FROM study GROUP BY city")
def eligibility_counts(spark, sf_dir):
    return lb.eligibility(study(spark, sf_dir), "city")


@query(f"""WITH {duck.STUDY}, g AS (SELECT city, count(*) AS n_all_labels, min(pitch) AS min_pitch_all, count(*) FILTER (eligible) AS n, min(pitch) FILTER (eligible) AS min_pitch, max(pitch) FILTER (eligible) AS max_pitch,
{', '.join(f"round(100.0::DOUBLE * count(*) FILTER (eligible AND at_floor AND band = '{b}') / nullif(count(*) FILTER (eligible AND band = '{b}'), 0), 6) AS {name}" for b, name in zip(strata.BANDS, ('floor_under_5_pct', 'floor_5_15_pct', 'floor_15_30_pct', 'floor_over_30_pct'), strict=True))},
round(100.0::DOUBLE * count(*) FILTER (eligible AND at_floor) / nullif(count(*) FILTER (eligible), 0), 6) AS at_floor_pct, round(100.0::DOUBLE * count(*) FILTER (eligible AND pitch = -35) / nullif(count(*) FILTER (eligible), 0), 6) AS exactly_floor_pct FROM study GROUP BY city)
SELECT * REPLACE (round(min_pitch_all, 6) AS min_pitch_all, round(min_pitch, 6) AS min_pitch, round(max_pitch, 6) AS max_pitch) FROM g""")
def floor_census(spark, sf_dir):
    return lb.floor_census(study(spark, sf_dir), "city")


_ERA = f"CASE WHEN time_created < TIMESTAMP '{LEGACY_END}' THEN 'legacy' WHEN time_created >= TIMESTAMP '{LIVE_FROM}' THEN 'post179' ELSE 'mid' END"


@query(f"""WITH {duck.REPLAY}, e AS (SELECT *, {_ERA} AS era FROM replayed) SELECT city, count(*) AS n_labels, strftime(min(time_created), '%Y-%m-%d') AS first_day, strftime(max(time_created), '%Y-%m-%d') AS last_day, count(*) FILTER (era = 'legacy') AS n_legacy, count(*) FILTER (era = 'mid') AS n_mid, count(*) FILTER (era = 'post179') AS n_post179,
count(*) FILTER (pano_width IS NULL) AS no_dims, count(*) FILTER (camera_heading IS NULL) AS no_camera_heading, count(*) FILTER (camera_pitch IS NULL) AS no_camera_pitch, count(*) FILTER (camera_roll IS NULL) AS no_camera_roll, count(*) FILTER (pano_x IS NULL) AS no_pixel,
count(*) FILTER (pano_width = 13312 AND pano_height = 6656) AS fixed_frame, count(*) FILTER (NOT coalesce(canvas_width = 720 AND canvas_height = 480, false)) AS other_canvas FROM e GROUP BY city""")
def city_study(spark, sf_dir):
    return lb.city_study(replayed(spark, sf_dir).withColumn("era", strata.era(c("time_created"), LEGACY_END, LIVE_FROM)), "city")


@query(f"WITH {duck.LABELS}, k AS (SELECT city, coalesce(CAST(CAST(pano_width AS BIGINT) AS VARCHAR) || 'x' || CAST(CAST(pano_height AS BIGINT) AS VARCHAR), 'unresolved') AS frame FROM labels) SELECT city, frame, count(*) AS n FROM k GROUP BY ALL")
def frame_histogram(spark, sf_dir):
    return lb.histogram(views.labels(spark, sf_dir), strata.frame_key(c("pano_width"), c("pano_height")), "frame", "city")


@query(f"WITH {duck.LABELS} SELECT city, count(camera_pitch) AS n, round(min(camera_pitch), 6) AS min, round(max(camera_pitch), 6) AS max, round(stddev_samp(camera_pitch), 6) AS sd, round(quantile_cont(abs(camera_pitch), 0.9), 6) AS abs_p90 FROM labels GROUP BY city")
def tilt_spread(spark, sf_dir):
    return lb.spread(views.labels(spark, sf_dir), "camera_pitch", "city")


def tagged_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The study's labels with types and tags that the referent rules know."""
    tags = views.view(spark, sf_dir, "events", views.TAGGED).select("label_id", c("label_type").alias("_type"), strata.tags(c("tags")).alias("tags"))
    return study(spark, sf_dir).join(tags, "label_id").withColumn("label_type", c("_type")).drop("_type")


_NONE = ", ".join(repr(x) for x in strata.NO_REFERENT_TYPES)
_REFERENT = f"label_type NOT IN ({_NONE}) AND NOT (" + " OR ".join(f"(label_type = '{k}' AND list_has_any(ts, [{', '.join(repr(x) for x in v)}]))" for k, v in strata.REGION_TAGS.items()) + ")"
#: Every seventh label is in a city that is left out.
_PLACED = "CASE WHEN label_id % 7 = 3 THEN 'taipei' ELSE city END"


@query(f"WITH {duck.STUDY}, {duck.TAGGED} SELECT label_id, label_type, {_PLACED} AS city FROM tagged WHERE eligible AND {_REFERENT} AND {_PLACED} NOT IN {tuple(strata.EXCLUDED_CITIES)}")
def measurable_labels(spark, sf_dir):
    own = tagged_study(spark, sf_dir).where("eligible").withColumn("city", F.expr(_PLACED))
    return own.where(strata.has_referent(c("label_type"), c("tags")) & strata.in_frame(c("city"))).select("label_id", "label_type", "city")


@query(f"WITH {duck.LABELS}, two AS (SELECT pano_id, label_id, 'camera_pitch' AS axis, camera_pitch AS tilt FROM labels UNION ALL SELECT pano_id, label_id, 'camera_roll', camera_roll FROM labels), a AS (SELECT axis, round(100.0::DOUBLE * count(tilt) / count(*), 6) AS available_pct FROM two GROUP BY axis), f AS (SELECT axis, pano_id, arg_min(tilt, label_id) FILTER (tilt IS NOT NULL) AS tilt FROM two GROUP BY ALL HAVING count(tilt) > 0) SELECT axis, any_value(available_pct) AS available_pct, count(*) AS n, round(min(tilt), 6) AS min, round(max(tilt), 6) AS max, round(stddev_samp(tilt), 6) AS sd, round(quantile_cont(abs(tilt), 0.9), 6) AS abs_p90 FROM f JOIN a USING (axis) GROUP BY axis")
def tilt_by_pano(spark, sf_dir):
    return lb.tilt_by_pano(views.labels(spark, sf_dir))


# Crops

_STORE = "store AS (SELECT CAST(c_custkey AS VARCHAR(9)) AS pano_id, c_custkey % 17 <> 0 AS readable, CASE WHEN c_custkey % 10 = 3 THEN 3328 WHEN c_custkey % 3 = 0 THEN 13312 ELSE 16384 END AS width, CASE WHEN c_custkey % 10 = 3 THEN 1664 WHEN c_custkey % 3 = 0 THEN 6656 ELSE 8192 END AS height FROM customer WHERE c_custkey % 13 <> 0)"
_CROP_SIZE = "least(round_even(size_, 0), width, height)"


def crop_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labels to crop, panoramas in the store, and crops that are there already."""
    labels = views.labels(spark, sf_dir).withColumns({"pano_id": F.expr("CASE WHEN label_id % 31 = 4 THEN '  ' ELSE pano_id END"), "pano_y": F.expr("CASE WHEN label_id % 37 = 5 THEN pano_y + 20000 ELSE pano_y END")})
    store = views.table(spark, sf_dir, "customer").where("c_custkey % 13 <> 0").selectExpr("CAST(c_custkey AS STRING) AS pano_id", "c_custkey % 17 <> 0 AS readable", "CASE WHEN c_custkey % 10 = 3 THEN 3328 WHEN c_custkey % 3 = 0 THEN 13312 ELSE 16384 END AS width", "CASE WHEN c_custkey % 10 = 3 THEN 1664 WHEN c_custkey % 3 = 0 THEN 6656 ELSE 8192 END AS height")
    there = labels.where("label_id % 29 = 0").select("label_type", "label_id")
    return labels, store, there


@query(f"""WITH {duck.LABELS}, l AS (SELECT * REPLACE (CASE WHEN label_id % 31 = 4 THEN '  ' ELSE pano_id END AS pano_id, CASE WHEN label_id % 37 = 5 THEN pano_y + 20000 ELSE pano_y END AS pano_y) FROM labels), {_STORE},
o AS (SELECT l.label_type, CASE WHEN trim(coalesce(l.pano_id, '')) = '' OR pano_x IS NULL OR pano_y IS NULL THEN 'errors' WHEN s.pano_id IS NULL THEN 'missing_pano' WHEN NOT readable THEN 'errors' WHEN pano_width <> s.width OR pano_height <> s.height THEN 'dims_mismatch'
  WHEN NOT (pano_y >= 0 AND pano_y < s.height) THEN 'out_of_frame' WHEN label_id % 29 = 0 THEN 'skipped_existing' ELSE 'success' END AS outcome FROM l LEFT JOIN store s ON s.pano_id = trim(l.pano_id))
SELECT label_type, count(*) AS total, {', '.join(f"count(*) FILTER (outcome = '{k}') AS {k}" for k in pn.OUTCOMES)} FROM o GROUP BY label_type""")
def crop_outcomes(spark, sf_dir):
    return pn.crop_outcomes(*crop_inputs(spark, sf_dir), "label_type").drop("shifted_vertically")


# Censuses of the store and of the source

_CENSUS = "cs AS (SELECT concat('c', CAST(c_custkey % 9 AS VARCHAR(9))) AS city, CASE c_custkey % 3 WHEN 0 THEN 'legacy' WHEN 1 THEN 'mid' ELSE 'post179' END AS era, c_custkey % 2 = 0 AS found, CASE WHEN c_custkey % 19 = 0 THEN 'timeout' END AS error, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 14 = 0 THEN 13312 ELSE 16384 END END AS served_width, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 14 = 0 THEN 6656 ELSE 8192 END END AS served_height, CASE WHEN c_custkey % 11 <> 0 THEN 16384 END AS stored_width, CASE WHEN c_custkey % 11 <> 0 THEN 8192 END AS stored_height, CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 8 = 0 END AS has_depth, c_custkey % 23 <> 7 AS on_store, CASE WHEN c_custkey % 23 <> 7 AND c_custkey % 29 <> 1 THEN CASE WHEN c_custkey % 26 = 0 THEN 3328 ELSE 16384 END END AS store_width, CASE WHEN c_custkey % 23 <> 7 AND c_custkey % 29 <> 1 THEN CASE WHEN c_custkey % 26 = 0 THEN 1664 ELSE 8192 END END AS store_height, CASE WHEN c_custkey % 23 <> 7 THEN 1000000 + c_custkey * 7919 % 9000001 END AS file_bytes FROM customer)"


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = _CENSUS.removeprefix("cs AS (SELECT ").removesuffix(" FROM customer)").replace("VARCHAR(9)", "STRING")
    return views.table(spark, sf_dir, "customer").selectExpr(*_split(inner))


def _split(columns: str) -> list[str]:
    """Expressions at the commas outside of parentheses."""
    out, depth, begun = [], 0, 0
    for i, x in enumerate(columns):
        depth += (x == "(") - (x == ")")
        if x == "," and not depth:
            out.append(columns[begun:i])
            begun = i + 1
    return [*out, columns[begun:]]


_ALIVE = """count(*) AS n_sampled, round(100.0::DOUBLE * count(*) FILTER (found) / count(*), 6) AS alive_pct, count(*) FILTER (seen AND known) AS dims_comparable, count(*) FILTER (seen AND NOT known) AS dims_unknown_stored,
  round(100.0::DOUBLE * count(*) FILTER (seen AND known AND (served_width <> stored_width OR served_height <> stored_height)) / nullif(count(*) FILTER (seen AND known), 0), 6) AS dims_drift_pct, round(100.0::DOUBLE * count(*) FILTER (seen AND has_depth) / nullif(count(*) FILTER (seen), 0), 6) AS depth_pct, count(error) AS errors"""


@query(f"WITH {_CENSUS}, a AS (SELECT *, found AND served_width IS NOT NULL AS seen, stored_width IS NOT NULL AND stored_height IS NOT NULL AS known FROM cs) SELECT 'all' AS scope, 'all' AS value, {_ALIVE} FROM a UNION ALL SELECT 'era', era, {_ALIVE} FROM a GROUP BY era UNION ALL SELECT 'city', city, {_ALIVE} FROM a GROUP BY city")
def alive_census(spark, sf_dir):
    return pn.alive_census(census(spark, sf_dir))


_COVER = """count(*) AS n, count(*) FILTER (on_store) AS on_store, round(100.0::DOUBLE * count(*) FILTER (on_store) / count(*), 6) AS on_store_pct, count(*) FILTER (on_store AND read_) AS headers_read, count(*) FILTER (on_store AND NOT read_) AS headers_unreadable,
  count(*) FILTER (read_ AND stored_width > 0 AND store_width = stored_width AND store_height = stored_height) AS match_stored, count(*) FILTER (read_ AND served_width > 0 AND store_width = served_width AND store_height = served_height) AS match_served"""


@query(f"WITH {_CENSUS}, a AS (SELECT *, on_store AND coalesce(store_width, 0) > 0 AND coalesce(store_height, 0) > 0 AS read_ FROM cs) SELECT 'all' AS scope, 'all' AS value, {_COVER} FROM a UNION ALL SELECT 'alive', CAST(found AS VARCHAR), {_COVER} FROM a GROUP BY found UNION ALL SELECT 'dead_by_era', era, {_COVER} FROM a WHERE NOT found GROUP BY era UNION ALL SELECT 'dead_by_city', city, {_COVER} FROM a WHERE NOT found GROUP BY city")
def store_coverage_by_life(spark, sf_dir):
    return pn.store_census(census(spark, sf_dir))


@query(f"WITH {_CENSUS}, r AS (SELECT file_bytes, row_number() OVER (ORDER BY file_bytes) - 1 AS i, count(*) OVER () AS n FROM cs WHERE on_store AND file_bytes > 0) SELECT round(max(file_bytes) FILTER (i = n // 10) / 1048576, 6) AS p10_mb, round(max(file_bytes) FILTER (i = n // 2) / 1048576, 6) AS p50_mb, round(max(file_bytes) FILTER (i = 9 * n // 10) / 1048576, 6) AS p90_mb FROM r")
def store_file_sizes(spark, sf_dir):
    return pn.file_sizes(census(spark, sf_dir))


# Matching and objects

def _kept(where: str = "") -> str:
    """A user's labels in order of time without those near one kept, as a recursion along each user's labels."""
    far = "len(list_filter(kept, lambda k: sqrt(pow(((k.az - q.az + 180) % 360 + 360) % 360 - 180, 2) * pow(cos(radians((k.el + q.el) / 2)), 2) + pow(k.el - q.el, 2)) <= 0.25)) = 0"
    return f"""RECURSIVE {duck.CLUSTERS}, q AS (SELECT *, row_number() OVER (PARTITION BY city, pano_id, label_type, user_id ORDER BY time_created, label_id) AS place FROM pts {where}),
walk AS (SELECT city, pano_id, label_type, user_id, place, [{{'label_id': label_id, 'az': az, 'el': el, 'time_created': time_created}}] AS kept FROM q WHERE place = 1 UNION ALL
  SELECT q.city, q.pano_id, q.label_type, q.user_id, q.place, CASE WHEN {far} THEN list_append(kept, {{'label_id': q.label_id, 'az': q.az, 'el': q.el, 'time_created': q.time_created}}) ELSE kept END FROM walk JOIN q ON q.city = walk.city AND q.pano_id = walk.pano_id AND q.label_type = walk.label_type AND q.user_id = walk.user_id AND q.place = walk.place + 1),
each_ AS (SELECT city, pano_id, label_type, user_id, max_by(kept, place) AS kept FROM walk GROUP BY ALL)"""


_MATCHED = f"""{_kept()}, two AS (SELECT a.city, a.pano_id, a.label_type, a.user_id AS ua, b.user_id AS ub, CASE WHEN len(a.kept) <= len(b.kept) THEN a.kept ELSE b.kept END AS s, CASE WHEN len(a.kept) <= len(b.kept) THEN b.kept ELSE a.kept END AS l, len(a.kept) > len(b.kept) AS turned
  FROM each_ a JOIN each_ b ON a.city = b.city AND a.pano_id = b.pano_id AND a.label_type = b.label_type AND a.user_id < b.user_id),
maps AS (SELECT *, 0 AS k, []::INTEGER[] AS used, 0::DOUBLE AS total FROM two UNION ALL SELECT m.city, m.pano_id, m.label_type, m.ua, m.ub, m.s, m.l, m.turned, k + 1, list_append(used, j::INTEGER), total + sqrt(pow((((s[k + 1].az - l[j].az + 180) % 360 + 360) % 360 - 180) * cos(radians((s[k + 1].el + l[j].el) / 2)), 2) + pow(s[k + 1].el - l[j].el, 2)) FROM maps m, LATERAL (SELECT unnest(range(1, len(m.l) + 1)) AS j) t WHERE k < len(s) AND NOT list_contains(used, j::INTEGER)),
best AS (SELECT city, pano_id, label_type, ua, ub, turned, s, l, used FROM maps WHERE k = len(s) QUALIFY row_number() OVER (PARTITION BY city, pano_id, label_type, ua, ub ORDER BY total, used) = 1),
flat AS (SELECT city, pano_id, label_type, turned, s[i] AS p, l[used[i]] AS r FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM best)),
pairs AS (SELECT city, pano_id, label_type, CASE WHEN turned THEN r.label_id ELSE p.label_id END AS a, CASE WHEN turned THEN p.label_id ELSE r.label_id END AS b, sqrt(pow((((p.az - r.az + 180) % 360 + 360) % 360 - 180) * cos(radians((p.el + r.el) / 2)), 2) + pow(p.el - r.el, 2)) AS d_total FROM flat)"""


def cluster_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.located(views.view(spark, sf_dir, "events", views.CLUSTER))


@query(f"WITH {_kept()} SELECT city, pano_id, label_type, user_id, k.label_id AS label_id, round(k.az, 6) AS az, round(k.el, 6) AS el FROM (SELECT *, unnest(kept) AS k FROM each_)")
def near_duplicate_drop(spark, sf_dir):
    return cl.without_repeats(cluster_points(spark, sf_dir)).select("city", "pano_id", "label_type", "user_id", "label_id", F.round("az", 6).alias("az"), F.round("el", 6).alias("el"))


@query(f"WITH {_MATCHED} SELECT city, pano_id, label_type, a, b, round(d_total, 6) AS d_total FROM pairs WHERE d_total <= 10")
def matched_assignment(spark, sf_dir):
    return cl.matched_pairs(cluster_points(spark, sf_dir)).select("city", "pano_id", "label_type", "a", "b", F.round("d_total", 6).alias("d_total"))


@query(f"WITH {_MATCHED}, e AS (SELECT a, b FROM pairs WHERE d_total <= 10 UNION SELECT b, a FROM pairs WHERE d_total <= 10), reach(node, root) AS (SELECT a, a FROM e UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.node) SELECT node AS label_id, min(root) AS object_id FROM reach GROUP BY node")
def match_objects(spark, sf_dir):
    return cl.match_objects(cluster_points(spark, sf_dir))


@query()
def multi_perspective_objects(spark, sf_dir):
    points = cluster_points(spark, sf_dir).select("city", "label_id", "pano_id", "user_id", (c("az") / 10000).alias("lat"), (c("el") / 1000).alias("lng"))
    return cl.multi_perspective(points)


# The corpus draw

def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible labels with the strata, bearings and marks of the draw."""
    return sm.corpus_frame(tagged_study(spark, sf_dir), LEGACY_END, LIVE_FROM, FIXED_FROM)


_QUALITY = f"CASE WHEN time_created < TIMESTAMP '{LEGACY_END}' THEN 'legacy' WHEN time_created < TIMESTAMP '{LIVE_FROM}' THEN 'mid' WHEN time_created < TIMESTAMP '{FIXED_FROM}' THEN 'window' WHEN time_created IS NOT NULL THEN 'post_fix' END"
_CORPUS = f"{duck.STUDY}, {duck.TAGGED}, corpus AS (SELECT *, city || ':' || CAST(label_id AS VARCHAR) AS label_uid, {_QUALITY} AS quality, exact_y AND NOT exact_x AS replay_mismatch, coalesce(disagree_count, 0) > coalesce(agree_count, 0) AS disputed, {_REFERENT} AS referent FROM tagged WHERE eligible AND {_QUALITY} IS NOT NULL AND pano_id <> 'tutorial' AND label_type <> 'Occlusion')"


@query(f"WITH {_CORPUS} SELECT band, quality, label_type, count(*) AS n, count(DISTINCT city || ':' || pano_id) AS panos, count(*) FILTER (replay_mismatch) AS mismatches, count(*) FILTER (disputed) AS disputed, count(*) FILTER (referent) AS measurable, count(*) FILTER (pano_height <> 8192) AS other_frames FROM corpus GROUP BY ALL")
def corpus_strata(spark, sf_dir):
    return sm.strata_table(corpus(spark, sf_dir))


@query()
def corpus_draw(spark, sf_dir):
    return sm.draw(corpus(spark, sf_dir), seed=20260812)


@query()
def corpus_shortfalls(spark, sf_dir):
    return sm.shortfalls(sm.draw(corpus(spark, sf_dir), seed=20260812))


# Annotation tasks

_TASKS = f"tagged AS (SELECT {', '.join(views.TAGGED)} FROM events), corpus AS (SELECT *, city || ':' || CAST(label_id AS VARCHAR) AS label_uid FROM tagged), tasks AS (SELECT label_uid, replace(label_uid, ':', '_') || '.jpg' AS tile FROM corpus WHERE label_id % 3 = 0)"


def tasks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Tasks, and the labels that they come from."""
    corpus_ = views.view(spark, sf_dir, "events", views.TAGGED).withColumn("label_uid", strata.label_uid(c("city"), c("label_id")))
    return corpus_.where("label_id % 3 = 0").select("label_uid", strata.tile_name(c("label_uid")).alias("tile")), corpus_


@query(f"WITH {_TASKS} SELECT 'label_type' AS axis, label_type AS value, count(*) AS n FROM tasks JOIN corpus USING (label_uid) GROUP BY label_type UNION ALL SELECT 'pano_source', pano_source, count(*) FROM tasks JOIN corpus USING (label_uid) GROUP BY pano_source")
def task_composition(spark, sf_dir):
    return tk.composition(*tasks(spark, sf_dir), "label_type", "pano_source")


@query(f"WITH {_TASKS} SELECT t.label_uid, tile, array_to_string(list_sort(coalesce(list_distinct(list_filter(list_transform(string_split(regexp_replace(trim(coalesce(tags, '')), '^\\[(.*)\\]$', '\\1'), ','), lambda x: trim(x)), lambda x: x <> '')), [])), '|') AS tags FROM tasks t LEFT JOIN (SELECT * FROM corpus WHERE label_id % 2 = 0) c ON c.label_uid = t.label_uid")
def task_tags(spark, sf_dir):
    own, corpus_ = tasks(spark, sf_dir)
    return tk.with_tags(tk.blind(own), corpus_.where("label_id % 2 = 0")).select("label_uid", "tile", F.array_join("tags", "|").alias("tags"))


@query(f"WITH {_TASKS} SELECT label_uid, tile FROM tasks WHERE label_uid IN (SELECT label_uid FROM corpus WHERE label_type = 'CurbRamp')")
def task_subset(spark, sf_dir):
    own, corpus_ = tasks(spark, sf_dir)
    return tk.subset(own, corpus_.where("label_type = 'CurbRamp'"))


@query(f"WITH b AS (SELECT {', '.join(views.BOX)} FROM part), d AS (SELECT city, (y - pano_h / 2) * 180 / pano_h AS depression FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY depression) - 1 AS i, count(*) OVER (PARTITION BY city) AS n FROM d) SELECT DISTINCT city, round(depression, 6) AS depression FROM r WHERE i IN (n // 6, n - 1 - n // 8)")
def example_ranks(spark, sf_dir):
    own = views.view(spark, sf_dir, "part", views.BOX).withColumn("depression", depression(c("y"), c("pano_h")))
    return tk.picked(own, "depression", "city").select("city", F.round("depression", 6).alias("depression"))
