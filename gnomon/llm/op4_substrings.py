"""Removal of repeated byte strings, keeping the first, by longest-previous-factor arrays.

Every string of LENGTH bytes is dealt by an anchor inside it: the smallest of its GRAM-byte grams under
a hash, leftmost of equals. Equal strings have equal anchors wherever they stand, so they meet. The
strings of one anchor lie side by side in a zone of the text. Zones that are equal as a whole collapse
to the first of them, and the others are later copies from end to end; each task does so with its own
before any are dealt. What is left of an anchor, if more than one zone, goes through suffix arrays, but for
zones that share neither the SIDE bytes before nor those after the anchor with another: previous and next
smaller positions in suffix order give the longest previous factor at each position, and those of LENGTH or
more are later copies. An anchor with very many different zones is dealt again string by string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import durable, only, table, texts

LENGTH = 100
GRAM = 40
#: A string of LENGTH bytes has so many before its anchor, or as many after it.
SIDE = (LENGTH - GRAM) // 2
#: Bytes that are hashed at a time, and bytes of zones in one suffix array.
SLICE = 1 << 20
BATCH = 1 << 20
#: Zones of an anchor that one task compares; beyond, the anchor's strings are dealt one by one.
ZONES = 4096
#: Repeated zones that a task remembers, to send on only the first of their copies.
KNOWN = 1 << 16
_NULL = -(1 << 63)
_MAX = np.uint64((1 << 64) - 1)
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([b]), 77) for b in range(256)], np.uint64)


def _powers(base: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(SLICE + 2 * LENGTH, np.uint64(base), np.uint64))))


_POWER: list[np.ndarray] = []


def sums(buffer: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any piece of the buffer follows."""
    if not _POWER:
        _POWER.extend((_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[buffer] * _POWER[0][: len(buffer)], dtype=np.uint64)))


def piece_hashes(total: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A hash of `length` bytes from each start."""
    h = (total[starts + length] - total[starts]) * _POWER[1][starts]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def zones(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """First string, last string, anchor hash and sides of every zone. starts, ends: of the documents.

    sides has 16 bits of a hash of the anchor with SIDE bytes before it, and 16 of the anchor with SIDE bytes
    after it; 0 where no string of the zone has them."""
    n, width = len(buffer), LENGTH - GRAM + 1
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int32))
    total = sums(buffer)
    h = piece_hashes(total, np.arange(n - GRAM + 1), GRAM)
    low = (np.uint64(1) << np.uint64(n.bit_length())) - np.uint64(1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    least, size = key, 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    least = np.minimum(least[: len(key) - width + 1], least[width - size : len(key) - size + 1])
    anchor = (least & low).astype(np.int64)
    edge = np.zeros(len(anchor) + 1, np.int64)
    whole = ends - starts >= LENGTH
    np.add.at(edge, starts[whole], 1)
    np.add.at(edge, ends[whole] - LENGTH + 1, -1)
    valid = np.cumsum(edge)[:-1] > 0
    first = valid & np.concatenate(([True], (anchor[1:] != anchor[:-1]) | ~valid[:-1]))
    last = valid & np.concatenate(((anchor[1:] != anchor[:-1]) | ~valid[1:], [True]))
    # Strings of two documents never run together, though both may be valid side by side.
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    at, sides = anchor[a], np.zeros(len(a), np.int64)
    for shift, has, begin in ((16, at - a >= SIDE, at - SIDE), (0, b + LENGTH - (at + GRAM) >= SIDE, at)):
        sides[has] |= (piece_hashes(total, begin[has], SIDE + GRAM) % np.uint64(65535) + np.uint64(1)).astype(np.int64) << shift
    return a, b, h[at], sides.astype(np.uint32).view(np.int32)


#: A zone: hash of its anchor, hash of its bytes, document, start and strings in pos, sides of the anchor. Rows with
#: later are copies of an earlier zone already, and p only spreads them.
ZONE = "later boolean, p bigint, z bigint, doc bigint, tag bigint, pos bigint, sides int"


class Reduced:
    """Of equal zones that a task has read, sends on those that may be the first, and marks the others."""

    def __init__(self) -> None:
        self.z, self.doc, self.tag, self.pos = (np.zeros(0, np.int64) for _ in range(4))

    def batch(self, p: np.ndarray, z: np.ndarray, doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, sides: np.ndarray) -> pa.RecordBatch:
        n, known = len(z), len(self.z)
        every = [np.concatenate(x) for x in ((self.z, z), (self.doc, doc), (self.tag, tag), (self.pos, pos))]
        # The order is that of places in the text, whatever lies in the low bits of pos.
        order = np.lexsort(every[::-1])
        own, d, g, at = (x[order] for x in every)
        same = np.append(False, own[1:] == own[:-1])[: len(own)]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(own))))
        copy = same & ((d != d[head]) | (g != g[head]) | (at != at[head]))
        fresh = order >= known
        # Rows that are where their first is, read again or repeated, say nothing new.
        send, later = order[fresh & ~same] - known, order[fresh & copy] - known
        again = np.concatenate((np.unique(head[same]), np.flatnonzero(~same & ~fresh)))
        again = again[np.sort(np.unique(again, return_index=True)[1])][:KNOWN]
        self.z, self.doc, self.tag, self.pos = own[again], d[again], g[again], at[again]
        rows = np.concatenate((send, later))
        flag = np.arange(len(rows)) >= len(send)
        spread = np.where(flag, (pos[rows] * 0x9E3779B1) ^ doc[rows], p[rows])
        return pa.RecordBatch.from_arrays([pa.array(flag), pa.array(spread), *(pa.array(x[rows]) for x in (z, doc, tag, pos, sides))], ["later", "p", "z", "doc", "tag", "pos", "sides"])


def anchored(df: DataFrame) -> DataFrame:
    """The zones of df (doc, tag, text). pos packs start and strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reduced = Reduced()
        for batch in batches:
            docs, tags, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))
            held: list[tuple[int, int, int, bytes]] = []
            size = 0
            for d, g, t in zip(docs, tags, rows, strict=True):
                # A long text goes in parts that share LENGTH - 1 bytes.
                step = SLICE // 2
                for at in range(0, max(1, len(t) - LENGTH + 1), step):
                    part = t[at : at + step + LENGTH - 1]
                    if len(part) < LENGTH:
                        continue
                    if size + len(part) > SLICE:
                        yield out(held, reduced)
                        held, size = [], 0
                    held.append((d, g, at, part))
                    size += len(part)
            if held:
                yield out(held, reduced)

    def out(held: list[tuple[int, int, int, bytes]], reduced: Reduced) -> pa.RecordBatch:
        joined = b"".join(x[3] for x in held)
        ends = np.cumsum([len(x[3]) for x in held])
        starts = np.concatenate(([0], ends[:-1]))
        a, b, h, sides = zones(np.frombuffer(joined, np.uint8), starts, ends)
        owner = np.searchsorted(starts, a, "right") - 1
        digest = xxhash.xxh3_64_intdigest
        z = np.fromiter((digest(joined[i : j + LENGTH]) for i, j in zip(a.tolist(), b.tolist(), strict=True)), np.uint64, len(a)).view(np.int64)
        doc, tag, at = (np.array([x[k] for x in held], np.int64)[owner] for k in range(3))
        return reduced.batch(h.view(np.int64), z, doc, tag, (a - starts[owner] + at) << 8 | (b - a + 1), sides)

    return df.mapInArrow(run, ZONE)


def dealt(rows: DataFrame) -> DataFrame:
    """kind (0: a later copy; 1: a zone of an anchor with others; 2: the same, of an anchor with more than ZONES
    different ones), p, doc, tag and pos."""
    fields = ("z", "doc", "tag", "pos", "sides")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the anchor that is not finished: its different zones, in order, and whether they are too many.
        p_open, open_, crowded = None, {}, False
        for batch in batches:
            if not batch.num_rows:
                continue
            later = batch.column(0).to_numpy(zero_copy_only=False)
            p, x = batch.column(1).to_numpy(), {k: batch.column(i).to_numpy() for i, k in enumerate(fields, 2)}
            found = [(0, p[later], {k: v[later] for k, v in x.items()})]
            p, x = p[~later], {k: v[~later] for k, v in x.items()}
            if len(p):
                carried = 0
                if p_open is not None:
                    carried = len(open_["z"])
                    p = np.concatenate((np.full(carried, p_open), p))
                    x = {k: np.concatenate((open_[k], x[k])) for k in fields}
                n = len(p)
                same_p = np.append(False, p[1:] == p[:-1])
                same_z = same_p & np.append(False, x["z"][1:] == x["z"][:-1])
                head = np.maximum.accumulate(np.where(same_z, 0, np.arange(n)))
                copy = same_z & ((x["doc"] != x["doc"][head]) | (x["tag"] != x["tag"][head]) | (x["pos"] != x["pos"][head]))
                found.append((0, p[copy], {k: v[copy] for k, v in x.items()}))
                at = np.flatnonzero(~same_z)
                run_of = np.cumsum(~same_p[at]) - 1
                size = np.bincount(run_of)
                done = run_of < len(size) - 1
                last = at[~done]
                if crowded and len(size) > 1:
                    # The carried zone of a crowded anchor has been sent.
                    at, run_of, done = at[carried:], run_of[carried:], done[carried:]
                many = size[run_of] > ZONES if len(run_of) else np.zeros(0, bool)
                if crowded and len(size) > 1:
                    many |= run_of == 0
                few = at[done & ~many & (size[run_of] > 1)]
                few = few[met(p[few], x["sides"][few])]
                found.append((1, p[few], {k: v[few] for k, v in x.items()}))
                found.append((2, p[at[done & many]], {k: v[at[done & many]] for k, v in x.items()}))
                if len(size) > 1:
                    crowded, carried = False, 0
                if crowded or len(last) > ZONES:
                    new = last[carried:] if crowded else last
                    found.append((2, p[new], {k: v[new] for k, v in x.items()}))
                    crowded, last = True, last[-1:]
                p_open, open_ = p[-1], {k: v[last] for k, v in x.items()}
            yield from sent(found)
        if p_open is not None and not crowded and len(open_["z"]) > 1:
            p = np.full(len(open_["z"]), p_open)
            few = met(p, open_["sides"])
            yield from sent([(1, p[few], {k: v[few] for k, v in open_.items()})])

    def sent(found: list[tuple[int, np.ndarray, dict[str, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        kind = np.concatenate([np.full(len(p), k, np.int32) for k, p, _ in found])
        if len(kind):
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([p for _, p, _ in found])), *(pa.array(np.concatenate([x[k] for *_, x in found])) for k in ("doc", "tag", "pos"))], ["kind", "p", "doc", "tag", "pos"])

    def met(p: np.ndarray, sides: np.ndarray) -> np.ndarray:
        """Whether another zone of the anchor has the same bytes before or after it."""
        sides, out = sides.view(np.uint32).astype(np.int64), np.zeros(len(p), bool)
        run_of = np.cumsum(np.append(False, p[1:] != p[:-1])[: len(p)])
        for side in (sides >> 16, sides & 0xFFFF):
            key = run_of << 16 | side
            values, code, n = np.unique(key, return_inverse=True, return_counts=True)
            out |= (n[code] > 1) & (side > 0)
        return out

    return rows.repartition("p").sortWithinPartitions("later", "p", "z", "doc", "tag", "pos").mapInArrow(run, "kind int, p bigint, doc bigint, tag bigint, pos bigint")


def dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    own, out = key[order], np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.append(False, own[1:] != own[:-1]))
    return out


def shifted(x: np.ndarray, k: int) -> np.ndarray:
    """x from k places on, then zeros."""
    return np.concatenate((x[k:], np.zeros(min(k, len(x)), x.dtype)))


def longest_previous(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The longest previous factor at each of starts: how many bytes from there also stand at an earlier one, at
    least min(that, LENGTH).

    text has 0 between its parts and bytes plus 1 elsewhere; no string of LENGTH from starts crosses a 0. Starts
    come into suffix order by ranks of ever longer prefixes. In that order the nearest smaller start before and
    the nearest after are the candidates; the ranks tell how much they have in common.
    """
    n, key = len(text), np.zeros(len(text), np.int64)
    for j in range(7):
        key = key << 9 | shifted(text, j)
    levels, k = [(7, dense(key))], 7
    while k < LENGTH:
        level = dense(levels[-1][1] * (n + 1) + shifted(levels[-1][1] + 1, k))
        k *= 2
        levels.append((k, level))
    order = np.argsort(levels[-1][1][starts], kind="stable")
    place = starts[order]
    longest = np.zeros(len(starts), np.int64)
    for back in (True, False):
        at, who = (place, order) if back else (place[::-1], order[::-1])
        smaller = np.arange(-1, len(at) - 1)
        todo = np.flatnonzero(smaller >= 0)
        while len(todo := todo[at[smaller[todo]] > at[todo]]):
            smaller[todo] = smaller[smaller[todo]]
            todo = todo[smaller[todo] >= 0]
        has = np.flatnonzero(smaller >= 0)
        x, y = at[has], at[smaller[has]]
        common = np.zeros(len(has), np.int64)
        for k, level in reversed(levels):
            equal = level[np.minimum(x + common, n - 1)] == level[np.minimum(y + common, n - 1)]
            equal &= (x + common < n) & (y + common < n)
            common += np.where(equal, k, 0)
        for _ in range(6):
            equal = (x + common < n) & (y + common < n) & (text[np.minimum(x + common, n - 1)] == text[np.minimum(y + common, n - 1)])
            common += equal
        longest[who[has]] = np.maximum(longest[who[has]], common)
    return longest


def compared(zones_: DataFrame) -> DataFrame:
    """Later copies among zones (p, doc, tag, pos, zone), sorted by p: doc, tag and pos."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int, bytes]] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if size > BATCH and row[0] != held[-1][0]:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4]) + 1
        if held:
            yield out(held)

    def out(held: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
        held.sort(key=lambda x: x[1:4])
        size = np.array([len(x[4]) + 1 for x in held])
        starts = np.cumsum(size) - size
        text = np.frombuffer(b"\0".join(x[4] for x in held) + b"\0", np.uint8).astype(np.int64) + 1
        text[starts + size - 1] = 0
        owner = np.repeat(np.arange(len(held)), size)
        place = np.arange(len(text)) - starts[owner]
        whole = np.flatnonzero(place <= size[owner] - 1 - LENGTH)
        hit = np.zeros(len(text), bool)
        hit[whole] = longest_previous(text, whole) >= LENGTH
        edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        own = owner[first]
        doc, tag, pos = (np.array([x[k] for x in held], np.int64)[own] for k in (1, 2, 3))
        moved = (pos >> 8) + place[first]
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tag), pa.array(moved << 8 | (last - first + 1))], ["doc", "tag", "pos"])

    return zones_.mapInArrow(run, "doc bigint, tag bigint, pos bigint")


def strings(zones_: DataFrame) -> DataFrame:
    """Each string of zones (p, doc, tag, pos, zone) as a zone of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reduced = Reduced()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield out(batch.slice(at, 500), reduced)

    def out(batch: pa.RecordBatch, reduced: Reduced) -> pa.RecordBatch:
        doc, tag, pos, z = [], [], [], []
        for d, g, start, zone in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True):
            n = len(zone) - LENGTH + 1
            doc += [d] * n
            tag += [g] * n
            pos += [((start >> 8) + i) << 8 | 1 for i in range(n)]
            z += [xxhash.xxh3_128_digest(zone[i : i + LENGTH]) for i in range(n)]
        found = np.frombuffer(b"".join(z), "<i8").reshape(-1, 2)
        return reduced.batch(found[:, 0], found[:, 1], np.array(doc, np.int64), np.array(tag, np.int64), np.array(pos, np.int64), np.zeros(len(z), np.int32))

    return zones_.mapInArrow(run, ZONE)


def cut(rows: DataFrame) -> DataFrame:
    """p, doc, tag, pos, bytes and heat of the zones that rows (doc, tag, text, asked) ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                out: list[list] = [[], [], [], [], [], []]
                for d, g, t, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                    for x in asked:
                        start, n = x["pos"] >> 8, x["pos"] & 255
                        for have, value in zip(out, (x["p"], d, g, x["pos"], t[start : start + n - 1 + LENGTH], x["hot"]), strict=True):
                            have.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["p", "doc", "tag", "pos", "zone", "hot"])

    return rows.mapInArrow(run, "p bigint, doc bigint, tag bigint, pos bigint, zone binary, hot boolean")


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, spans (byte ranges removed, end excluded) and kept (the other bytes).

    A byte goes when a string of LENGTH bytes over it also starts earlier: in a smaller doc_id, or
    earlier in the same document; strings are those of the input. A null text is empty, a null doc_id
    smaller than any other. Rows repeated with doc_id and text are one document and are cut alike;
    different texts under one doc_id stand in an order fixed by their content. doc_id is an integer.
    Very long texts are read whole, in parts. Other columns of df are not read. An empty table gives an empty one.
    """
    own = only(df, doc_id, text).select(F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(_NULL)).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    own = own.select("doc", F.xxhash64("text").alias("tag"), "text")
    found = durable(dealt(anchored(own)))
    asked = found.where("kind > 0").groupBy("doc", "tag").agg(F.collect_list(F.struct("p", "pos", (F.col("kind") == 2).alias("hot"))).alias("asked"))
    # Rows repeated with doc_id and text have their zones cut once.
    pieces = cut(own.join(asked, ["doc", "tag"]).dropDuplicates(["doc", "tag"]).select("doc", "tag", "text", "asked"))
    # A number is given so that tasks that read little, but compute much, are not put together.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = durable(pieces)
    usual = compared(pieces.where("NOT hot").drop("hot").repartition(tasks, "p").sortWithinPartitions("p"))
    crowded = dealt(strings(pieces.where("hot").drop("hot"))).where("kind = 0").select("doc", "tag", "pos")
    later = found.where("kind = 0").select("doc", "tag", "pos").union(usual).union(crowded)
    start = F.shiftright("pos", 8)
    spans = later.groupBy("doc", "tag").agg(F.collect_list(F.struct(start.alias("start"), (start + F.col("pos").bitwiseAND(F.lit(255)) - 1 + LENGTH).alias("end"))).alias("found"))
    rows = own.join(spans, ["doc", "tag"], "left").select("doc", "text", F.col("found"))
    kind = "spans array<struct<start:bigint,end:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sizes, merged, kept = [], [], []
                for t, ranges in zip(texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                    out: list[list[int]] = []
                    for a, b in sorted((x["start"], x["end"]) for x in ranges or []):
                        if out and a <= out[-1][1]:
                            out[-1][1] = max(b, out[-1][1])
                        else:
                            out.append([a, b])
                    sizes.append(len(t))
                    merged.append([{"start": a, "end": b} for a, b in out])
                    edges = [0, *(x for r in out for x in r), len(t)]
                    kept.append(b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], ["doc", "n_bytes", "spans", "kept"])

    out = rows.mapInArrow(run, f"doc bigint, n_bytes bigint, {kind}, kept binary")
    return out.select(F.when(F.col("doc") != _NULL, F.col("doc")).alias("doc_id"), "n_bytes", "spans", "kept")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes, removed runs and digest of what is kept, for every document; null and empty texts have
    none of them, repeated rows are cut alike, and an empty table gives an empty one."""
    cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + x["end"] - x["start"])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
