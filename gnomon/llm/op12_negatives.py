"""Hard negatives by one-dimensional distance keys.

An inner product turns into a distance once every vector has one more component, which brings all vectors to the
length M of the longest: of a query q (with 0 there), |x - q|^2 = M^2 + |q|^2 - 2 x.q. A few pivots are chosen; a
vector's key is its distance to the nearest. Rows are stored sorted by (pivot, key) in blocks that know their
interval of keys. By the triangle inequality a row whose key is k and whose pivot lies at distance d from the query is
at least |d - k| away, so all rows within r of a query lie in the annuli of keys [d - r, d + r], one for each pivot.

A query starts from a bound that rows of a sample give (they are rows, so it is a true one), goes to the parts of the
index that the bound leaves open, and scans there: first the intervals around its own keys, then wider ones, twice as
many blocks each time, until what is left lies farther than the rows it needs are already. So the first rows of each
part are certified, and the first of all parts' are the first of all. Scores are exact inner products of whole
numbers; distances only say where not to look, with a margin for rounding.

Queries are a stated part of the rows and travel to the parts in blocks. Parts are equal ranges of the sorted index, so
neither a crowded pivot nor rows that repeat make one large.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from gnomon.llm.common import durable, table

#: Components are multiplied by this and rounded down.
SCALE = 256
#: Positives of an anchor, negatives of each, and the window of their scores in hundredths of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Pivots, the rows that they and the first bounds are taken from (or as many as have SAMPLE_VALUES components).
PIVOTS, SAMPLE, SAMPLE_VALUES = 48, 4096, 4_000_000
#: Rows of a block, rows of a part of the index about, its fewest and most parts, and queries in a block.
BLOCK, PART, PARTS, QUERIES = 256, 200_000, (16, 4096), 512
#: Share of the squared lengths by which a bound may be off. A distance near 0 is the root of a difference of squares,
#: so it is only good to the root of a double's precision.
SLACK = 1e-6
#: Beyond any score.
EDGE = (1 << 63) - 1025
c = F.col


def clean(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and v, whole components, of rows that take part: with label, vector and finite components. Rows
    without vec_id are neither anchors nor partners."""
    own = df.select(c(f"`{vec_id}`").cast("bigint").alias("vec_id"), c(f"`{label}`").cast("bigint").alias("label"), c(f"`{vector}`").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return own.where(c("vec_id").isNotNull() & c("label").isNotNull() & c("v").isNotNull() & sound).select("vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of one width, short ones filled up with 0."""
    values, edges = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (edges == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(edges), width))
    out[np.arange(width) < edges[:, None]] = values
    return out


def products(a: np.ndarray, b: np.ndarray, kind: type) -> np.ndarray:
    """Inner products of all rows of a with all of b, exact: doubles hold whole numbers below 2^53, long doubles those of
    64 bits, to which larger ones are cut."""
    if kind is np.float64:
        return a @ b.T
    return np.clip(a.astype(kind) @ b.T.astype(kind), -EDGE, EDGE)


@dataclass
class Space:
    """What every task knows: the pivots, the longest length, and rows of a sample."""

    width: int
    top: float
    kind: type
    pivots: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray

    def lifted(self, v: np.ndarray) -> np.ndarray:
        """Vectors with the component that brings them to the longest length."""
        return np.column_stack((v, np.sqrt(np.maximum(self.top - (v * v).sum(1), 0))))

    def to_pivots(self, lifted: np.ndarray) -> np.ndarray:
        gap = (lifted * lifted).sum(1)[:, None] + (self.pivots * self.pivots).sum(1) - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(gap, 0))


def space(rows: DataFrame) -> Space:
    """Pivots by a few rounds of means over the sample, which is the first rows in the order of a hash."""
    sizes = rows.agg(F.max(F.size("v")).alias("width"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("top")).first()
    width, top = sizes["width"] or 0, sizes["top"] or 0.0
    # Two keys, so that rows that repeat come in one order.
    few = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(max(1, min(SAMPLE, SAMPLE_VALUES // max(1, width)))).toArrow().combine_chunks()
    v = matrix(few.column("v").combine_chunks(), width) if few.num_rows else np.zeros((0, width))
    made = Space(width, top, np.float64 if top < 2.0**53 else np.longdouble, np.zeros((1, width + 1)), few.column("vec_id").to_numpy(), few.column("label").to_numpy(), v)
    if len(v):
        lifted = made.lifted(v)
        made.pivots = np.unique(lifted[:: max(1, len(lifted) // PIVOTS)][:PIVOTS], axis=0)
        for _ in range(4):
            near = made.to_pivots(lifted).argmin(1)
            made.pivots = np.stack([lifted[near == k].mean(0) if (near == k).any() else p for k, p in enumerate(made.pivots)])
    return made


INDEX = "part int, pivot int, low double, high double, n int, ids binary, labels binary, v binary"


def index(rows: DataFrame, known: Space) -> DataFrame:
    """Blocks of rows sorted by (pivot, key), with the interval of their keys, dealt to parts of about equal size."""
    shared = rows.sparkSession.sparkContext.broadcast(known)
    n = rows.count()
    parts = min(PARTS[1], max(PARTS[0], -(-n // PART)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                far = own.to_pivots(own.lifted(matrix(some.column(2), own.width)))
                pivot = far.argmin(1)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(pivot.astype(np.int32)), pa.array(far[np.arange(len(far)), pivot])], ["vec_id", "label", "v", "pivot", "key"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, held = shared.value, TaskContext.get().partitionId(), None
        for batch in batches:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            at = 0
            while held.num_rows - at >= 2 * BLOCK:
                n = same_pivot(held, at)
                yield block(held.slice(at, n), part, own.width)
                at += n
            held = held.slice(at)
        at = 0
        while held is not None and at < held.num_rows:
            n = same_pivot(held, at)
            yield block(held.slice(at, n), part, own.width)
            at += n

    dealt = rows.mapInArrow(keyed, "vec_id bigint, label bigint, v array<double>, pivot int, key double")
    by = ("pivot", "key", "vec_id", "label")
    return durable(dealt.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(packed, INDEX))


def same_pivot(rows: pa.Table, at: int) -> int:
    """How many rows from one on share its pivot, a block's at most."""
    pivot = rows.column("pivot").slice(at, BLOCK).to_numpy()
    return int(np.searchsorted(pivot, pivot[0], "right"))


def block(rows: pa.Table, part: int, width: int) -> pa.RecordBatch:
    """Rows of one pivot as one row of the index."""
    key = rows.column("key").to_numpy()
    v = matrix(rows.column("v").combine_chunks(), width)
    kind = np.int16 if np.abs(v).max(initial=0) < 1 << 15 else np.float64
    return pa.RecordBatch.from_pylist([{
        "part": part, "pivot": int(rows.column("pivot")[0].as_py()), "low": float(key[0]), "high": float(key[-1]), "n": len(key), "ids": rows.column("vec_id").to_numpy().astype("<i8").tobytes(),
        "labels": rows.column("label").to_numpy().astype("<i8").tobytes(), "v": v.astype(kind).tobytes(),
    }], pa.schema([("part", pa.int32()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("v", pa.binary())]))


class Wanted:
    """What queries look for: `each` windows of scores a query, and in each the first k rows of its own label, or of
    others, in order of score and id. Rows found so far, and the score from which on rows still matter."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, own_label: bool):
        self.ids, self.labels, self.low, self.high, self.k, self.own_label = ids, labels, low, high, k, own_label
        self.floor = low.copy()
        self.found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, low.dtype))

    def offer(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Rows with their scores for the queries `which`."""
        fits = (labels == self.labels[which][:, None]) == self.own_label
        fits &= ids != self.ids[which][:, None]
        each = self.low.shape[1]
        new = [self.found]
        for j in range(each):
            ok = fits & (scores >= self.floor[which, j][:, None]) & (scores <= self.high[which, j][:, None])
            q, r = np.nonzero(ok)
            new.append((which[q] * each + j, ids[r], scores[q, r]))
        slot, ids_, scores_ = (np.concatenate(x) for x in zip(*new, strict=True))
        if len(slot) == len(self.found[0]):
            return
        order = np.lexsort((ids_, -scores_, slot))
        slot, ids_, scores_ = slot[order], ids_[order], scores_[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = place < self.k
        self.found = slot[kept], ids_[kept], scores_[kept]
        full = place == self.k - 1
        floor = self.floor.reshape(-1)
        floor[slot[full]] = np.maximum(floor[slot[full]], scores_[full])

    def least(self) -> np.ndarray:
        """The smallest score that still matters to each query; infinite where none does."""
        return np.where(self.floor <= self.high, self.floor, np.inf).min(1)


def most_score(own: Space, length: np.ndarray, to_pivot: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest score that a row can have whose key lies in an interval: from the least distance to it."""
    least = np.maximum(np.maximum(low - to_pivot, to_pivot - high), 0)
    both = own.top + length
    return (both - least * least) / 2 + SLACK * both + 1e-6


QUERY = "query bigint, vec_id bigint, label bigint, v array<double>, low array<bigint>, high array<bigint>"


def search(blocks: DataFrame, queries: DataFrame, known: Space, k: int, own_label: bool) -> DataFrame:
    """query, slot (of its windows), id and score: the first k rows of each window of scores (low to high, each
    included) of each query, in order of score, then id. A row with the query's own vec_id is none."""
    spark = blocks.sparkSession
    # A row for each pivot of each part: PARTS and PIVOTS bound their number.
    directory = [tuple(r) for r in blocks.groupBy("part", "pivot").agg(F.min("low"), F.max("high")).collect()]
    shared = spark.sparkContext.broadcast((known, np.array(directory, float).reshape(-1, 4)))
    kinds = StructType.fromDDL(QUERY)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each part that a query goes to. Rows of the sample give the first bound."""
        own, areas = shared.value
        part, pivot = areas[:, 0].astype(np.int64), areas[:, 1].astype(np.int64)
        order = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1])) if len(part) else part
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(at, QUERIES)
                v, want = taken(batch, own, k, own_label)
                want.offer(np.arange(len(v)), products(v, own.rows, own.kind), own.ids, own.labels)
                far, length = own.to_pivots(np.column_stack((v, np.zeros(len(v))))), (v * v).sum(1)
                if not len(part):
                    continue
                most = most_score(own, length[:, None], far[:, pivot], areas[:, 2], areas[:, 3])[:, order]
                q, p = np.nonzero(np.maximum.reduceat(most, starts, axis=1) >= want.least()[:, None])
                floors = pa.array(list(want.floor.astype(np.int64)), pa.list_(pa.int64()))
                picked = [x.take(pa.array(q)) for x in batch.columns[:4]] + [floors.take(pa.array(q)), batch.column(5).take(pa.array(q))]
                yield pa.RecordBatch.from_arrays([pa.array(part[order][starts][p].astype(np.int32)), *picked], ["part", *kinds.names])

    # A part's blocks come before the queries that visit it; both stream by.
    held = blocks.select("part", F.lit(0).alias("kind"), F.struct("pivot", "low", "high", "n", "ids", "labels", "v").alias("block"), F.lit(None).cast(kinds).alias("ask"))
    visits = queries.mapInArrow(asked, f"part int, {QUERY}").select("part", F.lit(1).alias("kind"), F.lit(None).cast(held.schema["block"].dataType).alias("block"), F.struct(*kinds.names).alias("ask"))
    dealt = held.unionByName(visits).repartition("part").sortWithinPartitions("part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, rows, ready = shared.value[0], None, [], None
        for whole in batches:
            parts, kind = whole.column(0).to_numpy(), whole.column(1).to_numpy()
            edges = np.flatnonzero(np.append(True, (parts[1:] != parts[:-1]) | (kind[1:] != kind[:-1]))).tolist() if len(parts) else []
            for a, b in zip(edges, [*edges[1:], len(parts)], strict=True):
                if parts[a] != part:
                    part, rows, ready = parts[a], [], None
                if kind[a] == 0:
                    rows += whole.column(2).slice(a, b - a).to_pylist()
                    continue
                if ready is None:
                    ready, rows = Part(rows, own), []
                for at in range(a, b, QUERIES):
                    ask = whole.column(3).slice(at, min(QUERIES, b - at))
                    batch = pa.RecordBatch.from_arrays(ask.flatten(), kinds.names)
                    v, want = taken(batch, own, k, own_label)
                    ready.scan(v, want, own)
                    slot, ids, scores = want.found
                    each = want.low.shape[1]
                    query = batch.column(0).to_numpy()[slot // each]
                    yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array((slot % each).astype(np.int32)), pa.array(ids, pa.int64()), pa.array(scores.astype(np.int64))], ["query", "slot", "id", "score"])

    found = dealt.mapInArrow(run, "query bigint, slot int, id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", place).where(c("place") <= k)


def taken(batch: pa.RecordBatch, own: Space, k: int, own_label: bool) -> tuple[np.ndarray, Wanted]:
    """Queries' vectors, and what they want."""
    windows = [np.array(batch.column(i).to_pylist(), np.int64).reshape(batch.num_rows, -1).astype(own.kind) for i in (4, 5)]
    return matrix(batch.column(3), own.width), Wanted(batch.column(1).to_numpy(), batch.column(2).to_numpy(), *windows, k, own_label)


class Part:
    """Blocks of one part of the index."""

    def __init__(self, blocks: list[dict], own: Space):
        blocks.sort(key=lambda x: (x["pivot"], x["low"]))
        self.pivot = np.array([x["pivot"] for x in blocks], np.int64)
        self.low, self.high = (np.array([x[k] for x in blocks]) for k in ("low", "high"))
        self.ids, self.labels = ([np.frombuffer(x[k], "<i8") for x in blocks] for k in ("ids", "labels"))
        # The first component type that a block's bytes fit.
        self.v = [np.frombuffer(x["v"], np.int16 if len(x["v"]) == 2 * x["n"] * own.width else np.float64).reshape(x["n"], own.width) for x in blocks]

    def scan(self, v: np.ndarray, want: Wanted, own: Space) -> None:
        """Look into annuli around each query's keys, twice as many blocks each time, until none can matter."""
        if not len(self.pivot):
            return
        far, length = own.to_pivots(np.column_stack((v, np.zeros(len(v))))), (v * v).sum(1)
        most = most_score(own, length[:, None], far[:, self.pivot], self.low, self.high)
        rank = np.empty(most.shape, np.int64)
        np.put_along_axis(rank, np.argsort(-most, axis=1, kind="stable"), np.arange(most.shape[1])[None, :], 1)
        begun, end = 0, 1
        while begun < len(self.pivot):
            open_ = (rank >= begun) & (rank < end) & (most >= want.least()[:, None])
            for b in np.flatnonzero(open_.any(0)).tolist():
                which = np.flatnonzero(open_[:, b])
                want.offer(which, products(v[which], self.v[b].astype(float), own.kind), self.ids[b], self.labels[b])
            begun, end = end, 2 * end + 1


def hundredths(x: Column, n: int) -> Column:
    """n hundredths of a whole number, rounded down."""
    whole, rest = F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100)), F.pmod(x, F.lit(100))
    return whole * n + F.call_function("div", rest * n, F.lit(100))


def hard_negatives(df: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for every row of anchors and each
    of its first `positives` rows of the same label, the first `negatives` rows of other labels whose score is from
    `low` to `high` hundredths of the positive's. Both tables are as `clean` makes them.

    Scores are whole inner products, higher ones first, ties by smaller vec_id. Vectors of unlike length are compared
    as if 0 filled up the shorter. A row with the anchor's vec_id is neither its positive nor its negative; other rows
    that repeat count as often as they come, and so do anchors. Without rows or anchors the result is empty."""
    rows, known = df, space(df)
    blocks = index(rows, known)
    asked = durable(anchors.select(F.monotonically_increasing_id().alias("query"), "vec_id", "label", "v"))
    first = durable(search(blocks, asked.select("*", F.array(F.lit(-EDGE)).alias("low"), F.array(F.lit(EDGE)).alias("high")), known, positives, True))
    # low * p <= 100 * n <= high * p over whole numbers; the windows of an anchor stand in the order of its positives.
    each = first.select("query", "place", "id", "score", (-hundredths(-c("score"), low)).alias("least"), hundredths(c("score"), high).alias("most"))
    windows = each.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "least", "most"))).alias("w"))
    # All queries have as many windows; those of positives that are not there are empty.
    filled = lambda k, none: F.concat(F.col(f"w.{k}"), F.array_repeat(F.lit(none), positives - F.size("w")))
    second = search(blocks, asked.join(windows, "query").select("query", "vec_id", "label", "v", filled("least", EDGE).alias("low"), filled("most", -EDGE).alias("high")), known, negatives, False)
    named = each.join(asked.select("query", "vec_id"), "query").select("query", (c("place") - 1).alias("slot"), c("vec_id").alias("anchor_id"), c("id").alias("positive_id"), c("score").alias("positive_score"))
    made = second.select("query", "slot", c("place").alias("rank"), c("id").alias("negative_id"), c("score").alias("negative_score")).join(named, ["query", "slot"])
    return made.select("anchor_id", "positive_id", c("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector against all; every seventh has a wrong label."""
    rows = clean(table(spark, sf_dir, "embeddings")).withColumn("label", F.when(c("vec_id") % 7 == 0, (c("label") + 1) % 10).otherwise(c("label")))
    rows = durable(rows.select("vec_id", "label", "v"))
    return hard_negatives(rows, rows.where("vec_id % 50 = 0"))


ORACLE = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM pos JOIN s USING (anchor_id) WHERE s.label <> pos.own AND {LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY rank <= {NEGATIVES}
"""
