"""Population weights, comparisons of frames, allocation and seeded samples."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gnomon.functions import strata
from gnomon.functions.geometry import delta_bearing, separation
from gnomon.operators.quantiles import at_ranks, running
from gnomon.operators.tables import written

c = F.col
#: Fixed values of the corpus draw.
CELL, PER_PANO, STANDARD_H, OTHER_FRAMES, MISMATCHES, CONTRAST_PANOS, APART_DEG = 6, 3, 8192.0, 60, 30, 80, 60.0


def seeded(key: Column, seed: int) -> Column:
    """An order by key and seed, mixed by products and shifts of 31 bits that any engine can repeat."""
    bits = F.lit(1 << 31)
    x = (F.pmod(key.cast("bigint"), bits) * 2654435761 + seed) % bits
    x = (x.bitwiseXOR(F.shiftright(x, 15)) * 2246822519) % bits
    return x.bitwiseXOR(F.shiftright(x, 13))


def weights(df: DataFrame, *cell: str) -> DataFrame:
    """Rows and share of the population in each cell. The total comes from the cells, not the rows."""
    made = df.groupBy(*cell).agg(F.count("*").alias("n"))
    return made.withColumn("weight", F.round(c("n") / F.sum("n").over(Window.partitionBy()), 9))


def undrawn_share(population: DataFrame, drawn: DataFrame, *cell: str) -> DataFrame:
    """Cells of the population without a drawn row, and their share."""
    share = weights(population, *cell)
    return share.join(drawn.select(*cell).distinct(), list(cell), "left_anti").agg(F.count("*").alias("cells"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("labels"), F.round(F.coalesce(F.sum("weight"), F.lit(0.0)) * 100, 6).alias("share_pct"))


def total_variation(left: DataFrame, right: DataFrame, *cell: str) -> DataFrame:
    """Half the sum of differences of shares, in per cent, over cells of either side."""
    share = lambda df, name: df.groupBy(*cell).agg(F.count("*").alias("n")).withColumn(name, 100.0 * c("n") / F.sum("n").over(Window.partitionBy())).drop("n")
    both = share(left, "p").join(share(right, "q"), list(cell), "full")
    gap = F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))
    return both.agg(F.round(F.sum(gap) / 2, 6).alias("tv_pct"), F.count_if(c("q").isNull()).alias("only_left"), F.count_if(c("p").isNull()).alias("only_right"))


def frame_ratios(reference: DataFrame, frame: DataFrame, *cell: str) -> DataFrame:
    """Shares of each cell in per cent on either side, the frame's over the reference's (null where that has none), and
    which side alone has the cell."""
    share = lambda df, name: df.groupBy(*cell).agg(F.count("*").alias("n")).withColumn(name, 100.0 * c("n") / F.sum("n").over(Window.partitionBy())).drop("n")
    both = share(reference, "p").join(share(frame, "q"), list(cell), "full")
    only = F.when(c("p").isNull(), "frame").when(c("q").isNull(), "reference")
    pct = lambda x: F.round(F.coalesce(x, F.lit(0.0)), 6)
    return both.select(*cell, pct(c("p")).alias("reference_pct"), pct(c("q")).alias("frame_pct"), F.round(F.coalesce(c("q"), F.lit(0.0)) / c("p"), 6).alias("ratio"), only.alias("only_in"))


def with_role(drawn: DataFrame, role: str) -> DataFrame:
    """Drawn labels that have a role, as a whole word of their list."""
    return drawn.where(F.array_contains(F.split("roles", ","), role))


def largest_remainder(counts: DataFrame, n: int) -> DataFrame:
    """Whole numbers that add up to n, in proportion to counts (cell, n). Ties go to the later cell."""
    one = Window.partitionBy()
    own = counts.withColumn("quota", c("n") * n / F.sum("n").over(one)).withColumn("base", F.floor("quota"))
    rank = F.row_number().over(one.orderBy(F.desc(F.round(c("quota") - c("base"), 9)), F.desc("cell")))
    own = own.withColumns({"rank": rank, "left": n - F.sum("base").over(one)})
    return own.select("cell", "n", (c("base") + (c("rank") <= c("left")).cast("bigint")).cast("bigint").alias("allotted"))


def stratified(df: DataFrame, key: str, k: int, seed: int, *strata: str) -> DataFrame:
    """k rows of each stratum in seeded order."""
    w = Window.partitionBy(*strata).orderBy(seeded(c(key), seed), key)
    return df.withColumn("pick", F.row_number().over(w)).where(c("pick") <= k)


def capped(df: DataFrame, key: str, k: int, seed: int, group: str) -> DataFrame:
    """At most k rows of each group in seeded order, as the draw takes them."""
    return stratified(df, key, k, seed, group)


def first_per(df: DataFrame, *keys: str, order: tuple[str, ...]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def split_groups(groups: DataFrame, key: str, seed: int) -> DataFrame:
    """Groups dealt evenly to two parts by seeded order, the odd one to eval, without bringing them together: each
    bucket of the order alternates on its own, going on where the buckets before it stopped."""
    own = groups.select(key).distinct().withColumn("h", F.md5(F.concat(c(key).cast("string"), F.lit(f":{seed}")).cast("binary")))
    own = own.withColumn("bucket", F.substring("h", 1, 3))
    sizes = own.groupBy("bucket").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("bucket", "before")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("h", key)) + c("before")
    return own.join(F.broadcast(before), "bucket").select(key, F.when(place % 2 == 0, "tune").otherwise("eval").alias("split"))


def nearest_rank(df: DataFrame, value: str, *by: str, percents: tuple[int, ...] = (10, 50, 90)) -> DataFrame:
    """Order statistics at rint(q / 100 * (n - 1)), not interpolated, of each group's values by ranges."""
    found = at_ranks(df, value, {f"p{q}": lambda n, q=q: F.rint(q / 100.0 * (n - 1)) for q in percents}, *by)
    return found.select(*by, c("_count").alias("n"), *(f"p{q}" for q in percents))


def decimated(df: DataFrame, order: tuple[str, ...], cap: int, *by: str) -> DataFrame:
    """Every ceil(n / cap)-th row of each group in order, by ranges of the order."""
    own = running(df, by, order, {"_i": F.lit(1)})
    return own.where((c("_i") - 1) % F.ceil(c("_i_all") / cap) == 0).drop("_i", "_i_all")


def round_robin(df: DataFrame, metric: str, key: str, by: str, k: int) -> DataFrame:
    """The k worst rows of each group, the worst of all groups first, then the next of each."""
    turn = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(metric), key))
    return df.withColumn("turn", turn).where(c("turn") <= k)


def corpus_frame(study: DataFrame, legacy_end: str = strata.LEGACY_END, live_from: str = strata.LIVE_FROM, fixed_from: str = strata.FIXED_FROM) -> DataFrame:
    """Labels that a corpus can be drawn from, with their identity over all cities, strata, bearing and marks."""
    own = study.withColumns({
        "label_uid": F.concat_ws(":", "city", c("label_id").cast("string")), "quality": strata.quality(c("time_created"), legacy_end, live_from, fixed_from), "bearing": delta_bearing(c("pano_x"), c("pano_width")),
        "replay_mismatch": c("exact_y") & ~c("exact_x"), "disputed": F.coalesce("disagree_count", F.lit(0)) > F.coalesce("agree_count", F.lit(0)),
        "referent": strata.has_referent(c("label_type"), c("tags") if "tags" in study.columns else F.array().cast("array<string>")),
    })
    return own.where(c("eligible") & c("quality").isNotNull() & (c("pano_id") != "tutorial") & ~c("label_type").isin("Occlusion"))


def strata_table(corpus: DataFrame) -> DataFrame:
    """What each cell of band, quality and type holds."""
    return corpus.groupBy("band", "quality", "label_type").agg(F.count("*").alias("n"), F.count_distinct("city", "pano_id").alias("panos"), F.count_if("replay_mismatch").alias("mismatches"), F.count_if("disputed").alias("disputed"), F.count_if("referent").alias("measurable"), F.count_if(c("pano_height") != STANDARD_H).alias("other_frames"))


def contrast_pairs(pool: DataFrame) -> DataFrame:
    """Of every panorama with two labels at least APART_DEG apart: the first label in order that has another so far
    off, the first such other, and the place of the panorama's first label. The first label with any partner is
    the first of the first pair, as its partner has one too, so sorted bearings do and no pairs are made."""
    turned = pool.select("city", "pano_id", "label_uid", "order", F.pmod("bearing", F.lit(360.0)).alias("at"), F.explode(F.array(F.lit(0), F.lit(360))).alias("turn"))
    micro = F.rint((c("at") + c("turn")) * 1e6).cast("bigint")
    reach = int(APART_DEG * 1e6)
    # Two counts from the start, which go on from row to row; one between both ends is made anew for each row.
    upto = lambda x: F.count("*").over(Window.partitionBy("city", "pano_id").orderBy(micro).rangeBetween(Window.unboundedPreceding, x))
    seen = turned.withColumn("far", upto(360 * 10**6 - reach) - upto(reach - 1)).where("turn = 0")
    one = F.struct("order", "label_uid", "at")
    first = seen.groupBy("city", "pano_id").agg(F.min("order").alias("place"), F.min(F.when(c("far") > 0, one)).alias("one")).where("one IS NOT NULL")
    other = seen.join(first, ["city", "pano_id"]).where(F.rint(separation(c("at"), c("one")["at"]) * 1e6) >= reach)
    return other.groupBy("city", "pano_id", "place", c("one")["label_uid"].alias("first")).agg(F.min(one)["label_uid"].alias("second"))


def draw(corpus: DataFrame, seed: int, cell: int = CELL) -> DataFrame:
    """A stratified draw, with the roles for which each label is in: contrast (two labels of a panorama far apart, for
    CONTRAST_PANOS panoramas), resolution (OTHER_FRAMES of other heights), mismatch (MISMATCHES), and then cells
    of band, quality and type filled up to `cell`. No panorama (city and id) gives more than PER_PANO labels. What an
    earlier stratum took counts in a later one, and has that one's role too where its turn comes before the quota is full.

    Labels stand in a seeded order. A refusal means a full panorama, and only quotas fill panoramas, so the
    first labels of each stratum, PER_PANO of a panorama and as many as its quota and all quotas together, are all
    that the draw can come to, besides the labels that are taken already. These few are what the driver decides over,
    whatever the corpus's size."""
    corpus = written(corpus.select("label_uid", "city", "pano_id", "band", "quality", "label_type", "pano_height", "bearing", "replay_mismatch"))
    pool = corpus.withColumn("order", F.xxhash64("label_uid", F.lit(seed)))
    cells = corpus.select("band", "quality", "label_type").distinct().count()
    quota = 2 * CONTRAST_PANOS + OTHER_FRAMES + MISMATCHES + cell * cells
    pairs = contrast_pairs(pool).orderBy("place", "city", "pano_id").limit(CONTRAST_PANOS)
    keys = ("label_uid", "city", "pano_id", "band", "quality", "label_type", "pano_height", "replay_mismatch", "order")

    def first(rows: DataFrame, n: int, *strata_: str) -> list:
        own = Window.partitionBy(*strata_, "city", "pano_id").orderBy("order", "label_uid")
        few = rows.select(*keys).withColumn("turn", F.row_number().over(own)).where(c("turn") <= PER_PANO).drop("turn")
        if not strata_:
            have = corpus.sparkSession.createDataFrame([(x,) for x in took.roles], "label_uid string")
            few = few.union(rows.select(*keys).join(F.broadcast(have), "label_uid", "left_semi").select(*keys)).distinct()
            return few.orderBy("order", "label_uid").limit(n + len(took.roles)).collect()
        place = F.row_number().over(Window.partitionBy(*strata_).orderBy("order", "label_uid"))
        return few.withColumn("place", place).where(c("place") <= n).orderBy("order", "label_uid").collect()

    chosen = pairs.select("place", F.explode(F.array("first", "second")).alias("label_uid"), F.col("first"))
    contrast = {r["label_uid"]: r for r in pool.select(*keys).join(F.broadcast(chosen.select("label_uid").distinct()), "label_uid").collect()}
    took = Draw()
    for r in pairs.orderBy("place", "city", "pano_id").collect():
        for uid in (r["first"], r["second"]):
            took.take(contrast[uid], "contrast")
    for r in first(pool.where(c("pano_height") != STANDARD_H), OTHER_FRAMES + quota):
        if took.n["resolution"] >= OTHER_FRAMES:
            break
        took.take(r, "resolution")
    for r in first(pool.where("replay_mismatch"), MISMATCHES + quota):
        if took.n["mismatch"] >= MISMATCHES:
            break
        took.take(r, "mismatch")
    by_cell: dict[tuple, list] = {}
    for r in first(pool, cell + quota, "band", "quality", "label_type"):
        by_cell.setdefault((r["band"], r["quality"], r["label_type"]), []).append(r)
    # Cells come in the order of their first labels.
    for key in by_cell:
        have = took.n[key]
        for r in by_cell[key]:
            if have >= cell:
                break
            if r["label_uid"] not in took.roles and took.take(r, "cell"):
                have += 1
    rows = [(uid, ",".join(sorted(x))) for uid, x in took.roles.items()]
    found = corpus.sparkSession.createDataFrame(rows, "label_uid string, roles string")
    return corpus.join(F.broadcast(found), "label_uid").select("label_uid", "city", "pano_id", "band", "quality", "label_type", "pano_height", "bearing", "replay_mismatch", "roles")


class Draw:
    """Labels taken, why, and how many of each panorama, stratum and cell."""

    def __init__(self) -> None:
        self.roles: dict[str, set[str]] = {}
        self.n: Counter = Counter()

    def take(self, row: Row, role: str) -> bool:
        uid, pano = row["label_uid"], ("pano", row["city"], row["pano_id"])
        if uid not in self.roles:
            if self.n[pano] >= PER_PANO:
                return False
            self.roles[uid] = set()
            self.n.update([pano, (row["band"], row["quality"], row["label_type"])] + ["resolution"] * (row["pano_height"] != STANDARD_H) + ["mismatch"] * bool(row["replay_mismatch"]))
        self.roles[uid].add(role)
        return True


def shortfalls(drawn: DataFrame) -> DataFrame:
    """What the frame could not supply, by stratum."""
    pairs = contrast_pairs(drawn.withColumn("order", F.xxhash64("label_uid"))).agg(F.count("*").alias("n"))
    other = drawn.agg(F.count_if(c("pano_height") != STANDARD_H).alias("resolution"), F.count_if("replay_mismatch").alias("mismatch"))
    wanted = {"contrast_panos": CONTRAST_PANOS, "resolution": OTHER_FRAMES, "mismatch": MISMATCHES}
    made = pairs.select(F.lit("contrast_panos").alias("stratum"), c("n").alias("achieved"))
    for k in ("resolution", "mismatch"):
        made = made.union(other.select(F.lit(k), c(k)))
    required = F.coalesce(*(F.when(c("stratum") == k, F.lit(v)) for k, v in wanted.items()))
    return made.select("stratum", "achieved", required.alias("required"), F.greatest(F.lit(0), required - c("achieved")).alias("shortfall"))
