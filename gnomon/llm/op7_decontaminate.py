"""Benchmark decontamination with an FM-index of every shard of the training text.

A shard is one Arrow batch of documents. Its words become symbols of the test phrases' vocabulary;
places where two neighbours never follow each other in a phrase cannot lie in a match and are left
out. What remains is indexed: suffix array, Burrows-Wheeler transform, wavelet matrix. All phrases
are found by backward search, occurrences are located by walking to sampled suffix positions, and
the spans that they cover are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import ASCII_UPPER, only, table, texts

WINDOW = 10
#: Words of test phrases that are broadcast at once; more phrases take more passes.
PHRASE_WORDS = 200_000
SAMPLE = 8
#: For bytes.translate: digits, small letters and bytes above 127 stay, A-Z become small, others split.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order of an integer text by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while n:
        after = np.zeros(n, np.int64)
        after[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank, k = new, 2 * k
        if rank[order[-1]] == n - 1 or k >= n:
            break
    return order


class FMIndex:
    """Backward search over an integer text; symbol 0 separates stretches."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.append(text, 0)
        order = suffix_array(text)
        self.n = len(text)
        bwt = text[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))[:-1]
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        level = bwt
        for b in range(self.bits - 1, -1, -1):
            bit = level >> b & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            level = np.concatenate((level[bit == 0], level[bit == 1]))
        # Starts of stretches are sampled too, so that no walk crosses a separator.
        self.marked = (order % SAMPLE == 0) | (bwt == 0)
        self.sampled = np.concatenate(([0], np.cumsum(self.marked)))
        self.samples = order[self.marked]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol occurs in the transform before at."""
        start, at = np.zeros_like(at), at.copy()
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            one, bit = self.ones[k], (symbol >> b & 1).astype(bool)
            start = np.where(bit, self.zeros[k] + one[start], start - one[start])
            at = np.where(bit, self.zeros[k] + one[at], at - one[at])
        return at - start

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for k in range(self.bits):
            one = self.ones[k]
            bit = one[at + 1] - one[at]
            out = out << 1 | bit
            at = np.where(bit == 1, self.zeros[k] + one[at], at - one[at])
        return out

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffix order that begin with each phrase; phrases: one a row."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k].astype(np.int64)
            low[live], high[live] = self.first[c] + self.rank(c, low[live]), self.first[c] + self.rank(c, high[live])
            live = live[low[live] < high[live]]
        dead = np.ones(len(phrases), bool)
        dead[live] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order."""
        found, rows, steps, left = np.empty(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(left):
            here = self.marked[rows[left]]
            done = left[here]
            found[done] = self.samples[self.sampled[rows[done]]] + steps
            left, steps = left[~here], steps + 1
            c = self.symbol(rows[left])
            rows[left] = self.first[c] + self.rank(c, rows[left])
        return found


class Phrases:
    """Windows of the test items as symbols of their own vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.symbols: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i : i + window]), set()).add(item)
        self.n = len(self.symbols) + 1
        self.by_length: list[tuple[np.ndarray, list[set[str]]]] = []
        pairs: set[int] = set()
        for length in sorted({len(p) for p in found}):
            own = [p for p in found if len(p) == length]
            self.by_length.append((np.array(own, np.int64), [found[p] for p in own]))
            pairs.update(a * self.n + b for p in own for a, b in zip(p, p[1:], strict=False))
        self.pairs = np.array(sorted(pairs), np.int64)
        self.shortest = min((len(p) for p in found), default=0)
        self.alone = np.zeros(self.n, bool)
        for p in found:
            if len(p) == 1:
                self.alone[p[0]] = True

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of a text in which a phrase may stand. ids: symbols, 0 for words of no phrase."""
        if not self.shortest or not len(ids):
            return []
        code = ids[:-1] * self.n + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, code), max(0, len(self.pairs) - 1))
        follows = (self.pairs[at] == code) & (ids[:-1] > 0) & (ids[1:] > 0) if len(self.pairs) else np.zeros(len(code), bool)
        edge = np.diff(np.concatenate(([0], follows.astype(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        long = end - start >= max(2, self.shortest)
        out = list(zip(start[long].tolist(), end[long].tolist(), strict=True))
        if self.alone.any():
            inside = np.zeros(len(ids) + 1, np.int64)
            for a, b in out:
                inside[a] += 1
                inside[b] -= 1
            single = np.flatnonzero(self.alone[ids] & (np.cumsum(inside)[:-1] == 0))
            out += [(i, i + 1) for i in single.tolist()]
        return out


def hits(documents: list[bytes], phrases: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
    """Of every document: its words, the merged spans of words in phrases, and the items found."""
    get, lengths, symbols = phrases.symbols.get, [], []
    for text in documents:
        found = [get(w, 0) for w in words(text)]
        lengths.append(len(found))
        symbols.append(np.array([*found, 0], np.int64))
    ids = np.concatenate(symbols) if symbols else np.array([], np.int64)
    starts = np.concatenate(([0], np.cumsum(np.array(lengths, np.int64) + 1)))
    spans: list[list[tuple[int, int]]] = [[] for _ in documents]
    items: list[set[str]] = [set() for _ in documents]
    kept = phrases.stretches(ids)
    if not kept:
        return lengths, spans, items
    at, texts_, places = 0, [], []
    for a, b in kept:
        texts_ += [ids[a:b], np.zeros(1, np.int64)]
        places.append((at, a))
        at += b - a + 1
    index = FMIndex(np.concatenate(texts_), phrases.n)
    from_, to = np.array(places).T
    cover = np.zeros(len(ids) + 1, np.int64)
    for patterns, names in phrases.by_length:
        low, high = index.search(patterns)
        n = high - low
        which = np.repeat(np.arange(len(n)), n)
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        there = index.locate(rows)
        piece = np.searchsorted(from_, there, "right") - 1
        there = to[piece] + there - from_[piece]
        np.add.at(cover, there, 1)
        np.add.at(cover, there + patterns.shape[1], -1)
        owner = np.searchsorted(starts, there, "right") - 1
        for d, p in np.unique(np.stack((owner, which)), axis=1).T.tolist():
            items[d] |= names[p]
    edge = np.diff(np.concatenate(([0], (np.cumsum(cover) > 0).astype(np.int8), [0])))
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        d = int(np.searchsorted(starts, a, "right")) - 1
        spans[d].append((a - int(starts[d]), b - int(starts[d])))
    return lengths, spans, items


def joined(left: list[tuple[int, int]], right: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Two lists of spans as one; spans that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted([*left, *right]):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find(df: DataFrame, benchmark: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, within: str | None = None) -> DataFrame:
    """keys, n_words, n_hit, spans (of words, end excluded) and items for every row of df.

    A null text has no words. A null item id counts as an empty one; items with one id count once.
    Items without words are never found. Repeated rows and null keys stay, an empty table gives an
    empty one, an empty benchmark gives no hits. Phrases are broadcast in blocks of about
    PHRASE_WORDS words; each block takes one more pass over the texts, without a shuffle. With within, text is a
    field of that key, a struct without nulls, and reaches the workers once.
    """
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("item_text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.size(F.split("item_text", r"\s+"))), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-size // PHRASE_WORDS) or 1
    # Names of the operator's own, so that keys cannot clash with them.
    out = df.select(*(F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)), *(F.col(f"`{x}`").alias("_text") for x in [text] * (within is None)), F.lit(0).cast("bigint").alias("_n"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("_spans"), F.array().cast("array<string>").alias("_items"))
    schema, names = out.schema, out.columns
    n = len(keys)
    held = within is None

    def step(rows: list[tuple[str, bytes]], last: bool):
        shared = df.sparkSession.sparkContext.broadcast(Phrases(rows, window))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 2000):
                    batch = whole.slice(at, 2000)
                    lengths, spans, found = hits(texts(batch.column("_text") if held else batch.column(keys.index(within)).field(text)), shared.value)
                    spans = [joined([(x["start"], x["end"]) for x in old], new) for old, new in zip(batch.column("_spans").to_pylist(), spans, strict=True)]
                    found = [sorted(new.union(old)) for old, new in zip(batch.column("_items").to_pylist(), found, strict=True)]
                    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                    text_out = [pa.nulls(batch.num_rows, pa.string()) if last else batch.column("_text")] if held else []
                    yield pa.RecordBatch.from_arrays([*batch.columns[:n], *text_out, pa.array(lengths, pa.int64()), pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], spans_type), pa.array(found, pa.list_(pa.string()))], names)

        return run

    for block in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "item_text"), F.lit(blocks)) == block)
        out = out.mapInArrow(step([(r["item"], r["item_text"].encode()) for r in mine.collect()], block == blocks - 1), schema)
    hit = F.aggregate("_spans", F.lit(0).cast("bigint"), lambda total, x: total + x["end"] - x["start"])
    return out.select(*(F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)), F.col("_n").alias("n_words"), hit.alias("n_hit"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and items found of every document."""
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    joined_items = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(joined_items.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS gram
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - {WINDOW - 1}))) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
place AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, size WHERE len(w) >= n)),
met AS (SELECT r, place.n, i, item FROM place JOIN win ON place.n = win.n AND place.gram = win.gram),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM met) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN found USING (r)
"""
