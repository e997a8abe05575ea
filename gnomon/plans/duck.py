"""Pieces of DuckDB SQL for the queries that the tests and the driver compare with."""

from __future__ import annotations

from gnomon.sources import views


def fov(zoom: str) -> str:
    return f"(CASE WHEN {zoom} <= 2 THEN 126.5::DOUBLE - 36.75::DOUBLE * {zoom} ELSE 195.93::DOUBLE / pow(1.92::DOUBLE, {zoom}) END)"


def direction(src: str, name: str, x: str, y: str, zoom: str, prefix: str) -> str:
    """CTEs that add {prefix}h and {prefix}p, the direction of a click, to src."""
    return f"""
{name}_f AS (SELECT *, 0.5::DOUBLE * canvas_width / tan(0.5::DOUBLE * radians({fov(zoom)})) AS f_, {x} - canvas_width / 2 AS u_, canvas_height / 2 - {y} AS v_,
  radians(heading) AS h_, radians(pitch) AS p_ FROM {src}),
{name}_v AS (SELECT *, f_ * cos(p_) * sin(h_) + u_ * CASE WHEN cos(p_) >= 0 THEN 1 ELSE -1 END * cos(h_) - v_ * sin(p_) * sin(h_) AS x_,
  f_ * cos(p_) * cos(h_) - u_ * CASE WHEN cos(p_) >= 0 THEN 1 ELSE -1 END * sin(h_) - v_ * sin(p_) * cos(h_) AS y_, f_ * sin(p_) + v_ * cos(p_) AS z_ FROM {name}_f),
{name} AS (SELECT * EXCLUDE (f_, u_, v_, h_, p_, x_, y_, z_), degrees(atan2(x_, y_)) AS {prefix}h, degrees(asin(z_ / sqrt(x_ * x_ + y_ * y_ + z_ * z_))) AS {prefix}p FROM {name}_v)"""


def mod(a: str, b: str) -> str:
    """The remainder with the divisor's sign."""
    return f"(({a}) - ({b}) * floor(({a}) / ({b})))"


def floored(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) % ({b}) < 0 THEN ({a}) % ({b}) + ({b}) ELSE ({a}) % ({b}) END)"


def pixel_x(h: str, w: str) -> str:
    turn = f"({floored(f'{h} + 360', '360::DOUBLE')} - {floored('camera_heading + 180', '360::DOUBLE')})"
    return floored(f"{w} + round_even({w} * {turn} / 360, 0)", w)


def pixel_y(p: str, h: str) -> str:
    return f"({h} / 2 - round_even({h} / 2 * ({p} / 90), 0))"


def offset(stored: str, got: str, w: str) -> str:
    """On a ring, in (-w/2, w/2]."""
    off = f"({floored(f'{stored} - {got} + {w} / 2', w)} - {w} / 2)"
    return f"(CASE WHEN {off} = -{w} / 2 THEN {w} / 2 ELSE {off} END)"


def seeded(key: str, seed: int) -> str:
    """An order by key and seed, as the sampling operators take it."""
    bits = 1 << 31
    once = f"(({key} % {bits} * 2654435761 + {seed}) % {bits})"
    twice = f"((xor({once}, {once} >> 15) * 2246822519) % {bits})"
    return f"xor({twice}, {twice} >> 13)"


LABELS = f"""raw AS (SELECT {', '.join(views.LABEL)} FROM events), made AS (SELECT *, {', '.join(views.MADE)} FROM raw),
{direction('made', 'aimed', 'made_x', 'made_y', 'made_zoom', 'm')},
labels AS (SELECT * EXCLUDE (made_x, made_y, made_zoom, made_h, off_x, off_y, mh, mp),
  {floored(f"{pixel_x('mh', '(made_h * 2)')} + off_x", 'pano_width')} AS pano_x, {pixel_y('mp', 'made_h')} + off_y AS pano_y FROM aimed)"""

REPLAY = f"""{LABELS}, {direction('labels', 'clicked', 'canvas_x', 'canvas_y', 'zoom', 'pov_')},
flagged AS (SELECT *, pov_h IS NOT NULL AND pov_p IS NOT NULL AND camera_heading IS NOT NULL AND pano_width > 0 AND pano_x IS NOT NULL AS replayable_x,
  pov_h IS NOT NULL AND pov_p IS NOT NULL AND pano_height > 0 AND pano_y IS NOT NULL AS replayable_y FROM clicked),
placed AS (SELECT *, CASE WHEN replayable_x THEN {pixel_x('pov_h', 'pano_width')} END AS replay_x, CASE WHEN replayable_y THEN {pixel_y('pov_p', 'pano_height')} END AS replay_y FROM flagged),
missed AS (SELECT *, {offset('pano_x', 'replay_x', 'pano_width')} AS dx, pano_y - replay_y AS dy FROM placed),
replayed AS (SELECT *, dx * 360 / pano_width AS dx_deg, dy * 180 / pano_height AS dy_deg, replayable_x AND coalesce(dx = 0, false) AS exact_x, replayable_y AND coalesce(dy = 0, false) AS exact_y FROM missed)"""

DEPRESSION = "((pano_y - pano_height / 2) * 180 / pano_height)"
BAND = "(CASE WHEN {0} > -90 AND {0} <= 5 THEN '<5' WHEN {0} > 5 AND {0} <= 15 THEN '5-15' WHEN {0} > 15 AND {0} <= 30 THEN '15-30' WHEN {0} > 30 AND {0} <= 90 THEN '>30' END)"

STUDY = f"""{REPLAY},
tilted AS (SELECT *, pitch - pov_p AS offaxis_v, sin(radians(pov_p)) * sin(radians(pitch)) + cos(radians(pov_p)) * cos(radians(pitch)) * cos(radians({floored('pov_h - heading + 180', '360::DOUBLE')} - 180)) AS cos_,
  coalesce(pitch <= -34.99::DOUBLE, false) AS at_floor, {DEPRESSION} AS depression FROM replayed),
study AS (SELECT * EXCLUDE (cos_), degrees(acos(CASE WHEN cos_ > 1 THEN 1 WHEN cos_ < -1 THEN -1 ELSE cos_ END)) AS offaxis_r, {BAND.format('depression')} AS band,
  exact_y AND {BAND.format('depression')} IS NOT NULL AS eligible FROM tilted)"""


def met(w: str, h: str, ph: str, pp: str) -> str:
    return f"coalesce(abs({offset('pano_x', pixel_x(ph, w), w)}) <= 1 AND abs(pano_y - {pixel_y(pp, h)}) <= 1, false)"


_ZOOMS = ("1", "1.999", "2", "2.999", "3")
CLASSES = (
    REPLAY
    + ", "
    + direction("replayed", "halved", "(canvas_width / 2 + (canvas_x - canvas_width / 2) * 0.5::DOUBLE)", "(canvas_height / 2 + (canvas_y - canvas_height / 2) * 0.5::DOUBLE)", "zoom", "a")
    + "".join(", " + direction("halved" if not i else f"zoomed{i - 1}", f"zoomed{i}", "canvas_x", "canvas_y", f"{z}::DOUBLE", f"z{i}") for i, z in enumerate(_ZOOMS))
    + ", tried AS (SELECT *, 2 * pano_y / (1 - pov_p / 90) AS implied FROM zoomed4), hit AS (SELECT *, "
    + f"{met('pano_width', 'pano_height', 'ah', 'ap')} AS by_half, "
    + " OR ".join(f"(coalesce(abs(implied - {h}) <= 2 AND pano_height <> {h}, false) AND {met(f'{2 * h}::DOUBLE', f'{h}::DOUBLE', 'pov_h', 'pov_p')})" for h in (1664, 3328, 6656, 8192))
    + " AS by_frame, CASE "
    + " ".join(f"WHEN abs(zoom - {z}) > 1e-8 + 1e-5 * {z} AND {met('pano_width', 'pano_height', f'z{i}h', f'z{i}p')} THEN {z}::DOUBLE" for i, z in enumerate(_ZOOMS))
    + """ END AS by_zoom FROM tried),
classed AS (SELECT *, CASE WHEN NOT (replayable_x AND replayable_y) THEN 'unreplayable' WHEN abs(dx) <= 1 AND abs(dy) <= 1 THEN 'exact' WHEN by_half THEN 'dpr2'
  WHEN by_frame THEN 'frame_change' WHEN by_zoom IS NOT NULL THEN 'zoom_desync' WHEN abs(dy) <= 1 THEN 'x_only' WHEN abs(dx) <= 1 THEN 'y_only'
  WHEN abs(dx) <= 10 AND abs(dy) <= 10 THEN 'xy_small' ELSE 'multi_field' END AS klass FROM hit)"""
)

CLUSTERS = f"""pts AS (SELECT *, (pano_x / pano_width * 360) % 360 AS az, (pano_height / 2 - pano_y) * 90 / (pano_height / 2) AS el FROM (SELECT {', '.join(views.CLUSTER)} FROM events))"""
RUNS = f"""runs AS (SELECT {', '.join(views.RUN)} FROM orders)"""
NEWEST = f"{RUNS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY start_time DESC, run_id DESC) AS back FROM runs)"

#: The study's labels with the types and tags that the referent rules know; ts are the tags.
TAGGED = f"""tg AS (SELECT {', '.join(views.TAGGED)} FROM events), tagged AS (SELECT s.* REPLACE (tg.label_type AS label_type), list_filter(list_transform(string_split(regexp_replace(trim(coalesce(tg.tags, '')), '^\\[(.*)\\]$', '\\1'), ','), lambda x: trim(x)), lambda x: x <> '') AS ts FROM study s JOIN tg USING (label_id))"""
