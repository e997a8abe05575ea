"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A sketch takes the smallest occurrence-labelled five-word shingles of a text under one hash and keeps
them in the order in which they stand in the text, so two texts agree on it about as often as they
would align. Texts with a sketch in common are candidates, and so are short texts that are equal once a few
words are taken out of each. Buckets of any size are compared whole, large ones in blocks. Pairs that an exact bound on
their edits rules out (lengths, counts of words by hash) go; the others are aligned, unless links already join
them. A link holds when an alignment within a band matches words enough for an edit similarity of 0.8 or
more. Equal word sequences are one text from the start. Classes are the connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import durable, only, table, texts
from gnomon.llm.op7_decontaminate import words
from gnomon.operators.graph import smallest_reachable

SHINGLE = 5
SIMILARITY = 0.8
#: Two texts at the threshold whose edits are spread evenly share a fifth of their shingles or so, and one of
#: so many sketches of two shingles with a probability of 0.95 at the least, whatever their length.
SKETCHES = 112
KEPT = 2
#: Sketches by which the first links are found; all others follow where components differ.
FIRST = 8
#: Buckets of so many texts are compared where they lie; larger ones are dealt into blocks of so many, all pairs of them.
SMALL, BLOCK = 64, 1024
#: Two texts of so many words at most always meet: they share what is left of them after their edits.
SHORT = 14
#: Pairs of two components that are aligned before all others are.
SLOTS = 16
#: Words are counted by so many values of their hash.
COUNTS = 512
#: Pairs whose counts are compared at a time.
PAIRS = 1 << 13
#: Words whose hashes a task keeps.
MEMO = 1 << 17
_TOP = np.uint64((1 << 64) - 1)
PAIR = "a bigint, b bigint, root_a bigint, root_b bigint"


class Hashes(dict):
    """64-bit values of words, the last ones kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def word_ids(tokens: list[bytes]) -> np.ndarray:
    """A 64-bit value for each word."""
    return np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))


_HASHES = Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(ids: np.ndarray) -> np.ndarray:
    """Values of runs of SHINGLE words; a shorter text is one run."""
    n = max(1, len(ids) - SHINGLE + 1) if len(ids) else 0
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(ids))):
        out = mixed(out + ids[k : k + n] * np.uint64(2 * k + 3))
    return out


def labelled(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Values made distinct by how often they stood before in the same document."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.append(True, (v[1:] != v[:-1]) | (o[1:] != o[:-1]))
    nth = np.arange(len(v)) - np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    out = values.copy()
    out[order] = mixed(v + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def sketches(documents: list[np.ndarray]) -> np.ndarray:
    """One row of SKETCHES values for each document's shingles; documents are not empty."""
    lengths = np.array([len(d) for d in documents])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    owner = np.repeat(np.arange(len(documents)), lengths)
    values = labelled(np.concatenate(documents), owner)
    out = np.zeros((len(documents), SKETCHES), np.uint64)
    bits = np.uint64(int(len(values)).bit_length())
    place = np.arange(len(values), dtype=np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)
    for s in range(SKETCHES):
        # The place in the low bits makes values distinct and tells where the smallest stands.
        key = (mixed(values ^ np.uint64(xxhash.xxh3_64_intdigest(b"sketch%d" % s))) & ~low) | place
        at = np.zeros((KEPT, len(documents)), np.int64)
        for k in range(KEPT):
            least = np.minimum.reduceat(key, starts)
            at[k] = np.where(least == _TOP, np.int64(-1), (least & low).astype(np.int64))
            key[at[k][at[k] >= 0]] = _TOP
        at.sort(0)
        total = np.full(len(documents), s + 1, np.uint64)
        for k in range(KEPT):
            total = mixed(total * np.uint64(5) + np.where(at[k] >= 0, values[at[k]], np.uint64(7)))
        out[:, s] = total
    return out


def shared_words(a: np.ndarray, b: np.ndarray) -> int:
    """Words that two texts have in common, repeats counted."""
    kinds, code = np.unique(np.concatenate((a, b)), return_inverse=True)
    return int(np.minimum(np.bincount(code[: len(a)], minlength=len(kinds)), np.bincount(code[len(a) :], minlength=len(kinds))).sum())


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the edit similarity, 1 - distance / longer length, is at least `similarity`.

    Diagonals outside the band would cost more edits than are allowed. A column of the band is one integer
    of a bit for each row, as differences between neighbouring rows, and a step to the next column is a few
    operations on whole integers, so the time is the number of words times the band's width over 64.
    """
    if len(a) > len(b):
        a, b = b, a
    longer = len(b)
    allowed = int((1 - similarity) * longer + 1e-9)
    if longer - len(a) > allowed or longer - shared_words(a, b) > allowed:
        return False
    head = int(np.argmin(np.append(a == b[: len(a)], False)))
    a, b = a[head:], b[head:]
    tail = int(np.argmin(np.append(a[::-1] == b[::-1][: len(a)], False)))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if len(b) <= allowed:
        return True
    return len(a) > 0 and within_band(a.tolist(), b.tolist(), allowed)


def within_band(a: list[int], b: list[int], allowed: int) -> bool:
    """Whether the edit distance of a and the at least as long b is at most `allowed`, which is less than b's length."""
    n, m = len(a), len(b)
    # In column j (of a) the band holds the rows (of b) from j - allowed to j + allowed, lowest bit first.
    width = 2 * allowed + 1
    every, bottom = (1 << width) - 1, 1 << (width - 1)
    places: dict[int, list[int]] = {}
    for i, x in enumerate(b):
        places.setdefault(x, []).append(i)
    few, masks = max(4, m >> 10), {}
    plus, minus = every & ~((1 << allowed) - 1), 0
    distance, most = allowed, allowed + n - (m - allowed)
    for j in range(n):
        first = j - allowed
        where = places.get(a[j], ())
        if len(where) <= few:
            same = 0
            for i in where:
                if 0 <= i - first < width:
                    same |= 1 << (i - first)
        else:
            if a[j] not in masks:
                masks[a[j]] = sum(1 << i for i in where)
            same = (masks[a[j]] >> first if first >= 0 else masks[a[j]] << -first) & every
        diagonal = ((((same & plus) + plus) ^ plus) | same | minus) & every
        across_plus = minus | (every & ~(diagonal | plus))
        across_minus = diagonal & plus
        if j < m - allowed:
            distance += not diagonal & bottom
        else:
            # The last row is reached, and stands one place lower in each further column.
            bottom >>= 1
            distance += bool(across_plus & bottom) - bool(across_minus & bottom)
        if distance > most:
            return False
        plus = across_minus | (every & ~((diagonal >> 1) | across_plus))
        minus = (diagonal >> 1) & across_plus
    return distance <= allowed


def remainders(ids: np.ndarray, similarity: float) -> list[int]:
    """A value for each word sequence that is left when words of a short text are taken out, as many at
    most as are edited between it and another of SHORT words or fewer."""
    n = len(ids)
    if n > SHORT:
        return []
    out = max(int((1 - similarity) * m + 1e-9) for m in range(n, SHORT + 1) if m - n <= int((1 - similarity) * m + 1e-9))
    left = {np.delete(ids, gone).tobytes() for k in range(min(out, n) + 1) for gone in combinations(range(n), k)}
    return [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in left]


def counts(documents: list[np.ndarray]) -> list[bytes]:
    """How many words of each document fall on each of COUNTS values, as bytes that stop at 255. An edit moves
    one word at most from one value to another, so the counts bound the edits from below."""
    return [np.minimum(np.bincount((d >> np.uint64(40)).astype(np.int64) % COUNTS, minlength=COUNTS), 255).astype(np.uint8).tobytes() for d in documents]


def sketched(df: DataFrame, text: str, doc_id: str, similarity: float) -> DataFrame:
    """doc_id, raw (a hash of the text), n_words, content (128 bits of the word sequence), sketches (then the
    remainders of a short text) and counts of every row."""
    own = only(df, doc_id, text).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("raw"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                tokens = [words(t) for t in texts(batch.column(1))]
                some = [i for i, w in enumerate(tokens) if w]
                keys: list[list[int]] = [[] for _ in tokens]
                ids = [word_ids(w) for w in tokens]
                if some:
                    found = sketches([shingles(ids[i]) for i in some]).view(np.int64).tolist()
                    for i, row in zip(some, found, strict=True):
                        keys[i] = row + remainders(ids[i], similarity)
                content = [xxhash.xxh3_128_digest(b" ".join(w)) for w in tokens]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(w) for w in tokens], pa.int64()), pa.array(content, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(counts(ids), pa.binary())], ["doc_id", "raw", "n_words", "content", "keys", "counts"])

    return own.mapInArrow(run, f"doc_id {kind}, raw bigint, n_words bigint, content binary, keys array<bigint>, counts binary")


def packed_words(rows: DataFrame) -> DataFrame:
    """node and the words as packed 32-bit values of the rows (text, node, wanted) whose text has the content wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                node, packed = [], []
                for t, number, content in zip(texts(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    w = words(t)
                    if xxhash.xxh3_128_digest(b" ".join(w)) == content:
                        node.append(number)
                        packed.append(word_ids(w).astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(packed, pa.binary())], ["node", "packed"])

    return rows.select("text", "node", "wanted").mapInArrow(run, "node bigint, packed binary")


def within(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether lengths n, m and rows of counts x, y leave room for the similarity."""
    allowed = ((1 - similarity) * np.maximum(n, m) + 1e-9).astype(np.int64)
    d = x.astype(np.int16) - y.astype(np.int16)
    return (abs(n - m) <= allowed) & (np.maximum(np.maximum(d, 0).sum(1), np.maximum(-d, 0).sum(1)) <= allowed)


def counted(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COUNTS)


def near_in_length(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    return abs(n - m) <= ((1 - similarity) * np.maximum(n, m) + 1e-9).astype(np.int64)


def possible(pairs: DataFrame, spoken: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that no bound rules out."""
    own = lambda x: spoken.select(F.col("node").alias(x), F.col("n_words").alias(f"n_{x}"), F.col("counts").alias(f"counts_{x}"))
    both = pairs.join(own("a"), "a").join(own("b"), "b").select("a", "b", "n_a", "n_b", "counts_a", "counts_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(k).to_numpy() for k in (2, 3))
                keep = within(n, m, counted(batch.column(4)), counted(batch.column(5)), similarity)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a bigint, b bigint")


def checked(pairs: DataFrame, words_of: DataFrame, similarity: float) -> DataFrame:
    """The rows of pairs (a, b, root_a, root_b) whose texts align. Words reach a pair by two joins, sketches do not travel."""
    left = words_of.select(F.col("node").alias("a"), F.col("packed").alias("words_a"))
    right = words_of.select(F.col("node").alias("b"), F.col("packed").alias("words_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "root_a", "root_b", "words_a", "words_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [aligned(np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32), similarity) for x, y in zip(batch.column(4), batch.column(5), strict=True)]
            yield batch.select(["a", "b", "root_a", "root_b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, PAIR)


def starred(bucket: DataFrame) -> DataFrame:
    """a (the smallest node of a bucket) and b (each of its others) of rows (key, node), once each."""
    least = bucket.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    return bucket.join(least, "key").where("node > a").select("a", F.col("node").alias("b")).distinct()


def divided(bucket: DataFrame, root: DataFrame) -> DataFrame:
    """The rows of bucket (key, node and others), with root and n, whose key joins several components; n is its nodes."""
    own = bucket.join(root, "node")
    sizes = own.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key", "n")
    return own.join(sizes, "key")


def divided_small(bucket: DataFrame, root: DataFrame) -> DataFrame:
    """key, node and root of the rows whose key joins several components, for keys of SMALL nodes at most: each such
    bucket is gathered once, and no join by key is made."""
    own = bucket.join(root, "node").groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.collect_list(F.struct("node", "root")).alias("nodes"))
    return own.where("low < high").select("key", F.inline("nodes"))


def in_small_buckets(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b, root_a, root_b), not yet distinct, that no bound rules out, of rows (key, node, root, n_words, counts) with SMALL
    nodes a key at most. Rows come sorted by key; those of an unfinished key wait for the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            have = pa.Table.from_batches([batch])
            have = (pa.concat_tables([rest, have]) if rest is not None else have).combine_chunks()
            key = have["key"].to_numpy()
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0
            rest = have.slice(done)
            if done:
                yield from pairs(have.slice(0, done), key[:done])
        if rest is not None and rest.num_rows:
            yield from pairs(rest, rest["key"].to_numpy())

    def pairs(have: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, root, n = (have[k].to_numpy() for k in ("node", "root", "n_words"))
        seen = counted(have["counts"])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for apart in range(1, len(key)):
            i = np.flatnonzero(key[:-apart] == key[apart:])
            if not len(i):
                break
            i = i[root[i] != root[i + apart]]
            i = i[near_in_length(n[i], n[i + apart], similarity)]
            found.append((i, i + apart))
        if not found:
            return
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        i, j = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
        order = np.lexsort((node[j], node[i]))
        i, j = i[order], j[order]
        new = np.append(True, (node[i][1:] != node[i][:-1]) | (node[j][1:] != node[j][:-1]))[: len(i)]
        i, j = i[new], j[new]
        for at in range(0, len(i), PAIRS):
            x, y = i[at : at + PAIRS], j[at : at + PAIRS]
            ok = within(n[x], n[y], seen[x], seen[y], similarity)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (node[x[ok]], node[y[ok]], root[x[ok]], root[y[ok]])], ["a", "b", "root_a", "root_b"])

    # Keys are hashes already; sorted runs of them are the groups.
    return rows.select("key", "node", "root", "n_words", "counts").repartition("key").sortWithinPartitions("key").mapInArrow(run, PAIR)


def in_blocks(rows: DataFrame, similarity: float) -> DataFrame:
    """The same for keys of any size, whose n nodes are dealt into blocks: two blocks are one group."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "node", "root", "n_words", "counts")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        x, y, mine, node, root, n = (group[k].to_numpy() for k in ("x", "y", "mine", "node", "root", "n_words"))
        seen, low, high = counted(group["counts"]), [], []
        first, second = np.flatnonzero(mine == x), np.flatnonzero(mine == y)
        for i in first:
            js = second[root[second] != root[i]]
            js = js[node[js] > node[i]] if x[0] == y[0] else js
            js = js[near_in_length(np.full(len(js), n[i]), n[js], similarity)]
            js = js[within(np.full(len(js), n[i]), n[js], seen[i][None, :], seen[js], similarity)] if len(js) else js
            low.append(np.where(node[js] < node[i], js, i))
            high.append(np.where(node[js] < node[i], i, js))
        low, high = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (low, high))
        return pa.table({"a": node[low], "b": node[high], "root_a": root[low], "root_b": root[high]})

    return dealt.groupBy("key", "x", "y").applyInArrow(run, PAIR)


def crossed(bucket: DataFrame, root: DataFrame, spoken: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes that share a key of bucket (key, node), are in different components and that no
    bound rules out. Small buckets are compared whole in the tasks that hold them, all others in blocks."""
    large = durable(bucket.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SMALL).select("key"))
    small = durable(divided_small(bucket.join(large, "key", "left_anti"), root))
    crowded = durable(divided(bucket.join(large, "key", "left_semi"), root).select("key", "node", "root", "n"))
    told = spoken.select("node", "n_words", "counts")
    return in_small_buckets(small.join(told, "node"), similarity).union(in_blocks(crowded.join(told, "node"), similarity)).distinct()


def near_groups(df: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of df: doc_id, n_words, class_id (the smallest doc_id of its class), class_size
    and kept (whether it is that smallest).

    Words are those of op7. Rows without words (null and empty texts too), and rows with a null doc_id, are
    classes of their own (class_id is their doc_id, class_size 1). Repeated rows are one class. Different
    texts under one doc_id are compared each on its own, so two classes can have one class_id. Very long texts
    are sketched and aligned whole. Other columns of df are not read. An empty table gives an empty one.
    """
    every = durable(sketched(df, text, doc_id, similarity))
    real = every.where("n_words > 0 AND doc_id IS NOT NULL")
    # One node for each word sequence: hot copies shrink before any pair is made.
    spoken = durable(real.groupBy("content").agg(F.min(F.struct("doc_id", "raw")).alias("rep"), F.first("keys").alias("keys"), F.first("n_words").alias("n_words"), F.first("counts").alias("counts")).withColumn("node", F.monotonically_increasing_id()))
    bucket = spoken.select("node", F.posexplode("keys").alias("sketch", "value")).withColumn("sketch", F.least("sketch", F.lit(SKETCHES))).select("node", "sketch", F.xxhash64("sketch", "value").alias("key"))
    met = bucket.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    bucket = durable(bucket.join(met, "key", "left_semi"))
    wanted = spoken.join(bucket.select("node").distinct(), "node", "left_semi").select("node", F.col("content").alias("wanted"), F.col("rep.doc_id").alias("at"), "rep.raw")
    # By id and text, so that many texts under one id do not meet.
    own = only(df, doc_id, text).toDF("at", "text").withColumn("raw", F.xxhash64("text"))
    words_of = durable(packed_words(own.join(wanted, ["at", "raw"])).dropDuplicates(["node"]))
    root = spoken.select("node", F.col("node").alias("root"))

    def linked(pairs: DataFrame) -> DataFrame | None:
        """Align the pairs, and join the components of those that pass: old and new root of each that has another."""
        nonlocal root
        good = durable(checked(pairs, words_of, similarity))
        if not good.limit(1).count():
            return None
        new = smallest_reachable(good.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))).select(F.col("node").alias("root"), F.col("root").alias("new"))
        root = durable(root.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root")))
        return new

    # One member of each bucket meets all others.
    first = starred(bucket.where(F.col("sketch") < FIRST).select("key", "node"))
    linked(possible(first, spoken, similarity).select("a", "b", F.col("a").alias("root_a"), F.col("b").alias("root_b")))
    left = durable(crossed(bucket.select("key", "node"), root, spoken, similarity))
    # One pair of any two components first, then some, and at last all of those that stay apart.
    for slots in (1, SLOTS, None):
        if not left.limit(1).count():
            break
        some = left
        if slots:
            some = left.groupBy("root_a", "root_b", F.pmod(F.xxhash64("a", "b"), F.lit(slots))).agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.*", "root_a", "root_b")
        new = linked(some)
        if new is not None:
            for end in ("root_a", "root_b"):
                left = left.join(new.select(F.col("root").alias(end), F.col("new").alias(f"new_{end}")), end, "left").withColumn(end, F.coalesce(f"new_{end}", end)).drop(f"new_{end}")
            left = durable(left.where("root_a != root_b"))
    member = durable(real.select("doc_id", "n_words", "content").join(spoken.select("content", "node").join(root, "node"), "content"))
    sizes = member.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    grouped = member.join(sizes, "root").select("doc_id", "n_words", "class_id", "class_size")
    alone_rows = every.where("NOT (n_words > 0 AND doc_id IS NOT NULL)").select("doc_id", "n_words", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return grouped.union(alone_rows).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, class size and decision for every document, null, empty and repeated ones too; an empty table
    gives an empty one."""
    return near_groups(table(spark, sf_dir, "documents"))
