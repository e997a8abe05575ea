"""Language-model scoring by marginal likelihood over a lattice of subwords.

Tokens are whole words and one end. A word's probability mixes its own discounted share of the
training tokens with the marginal of all ways to segment it into pieces of a public vocabulary: a
forward recursion in log space over the lattice. Piece probabilities start from the vocabulary's own
scores and learn from the training words, each distinct word counting once, since the lattice has to
stand for words that were not seen.

Word counts never meet in one place. Documents fall into blocks of bounded size; each block lists its
distinct words, a join brings their counts, and the block is scored next to them.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import LOWER, durable, fold, table, texts
from gnomon.llm.op1_pieces import MODEL, SPACE

#: Bytes of text in a block, about.
BLOCK = 12_000_000
#: Pseudo-counts that the vocabulary's own scores are worth.
PRIOR = 2000.0


def tokens(text: bytes) -> list[bytes]:
    """Words, without the end: A-Z in lower case, cut at ASCII white space."""
    return text.translate(LOWER).split()


class Lattice:
    """Marginal log-probabilities (base 10) of words under a unigram model of pieces.

    A word is a piece that starts with the space mark, then pieces without it; after each piece it
    ends with probability `stop`. A character may also be written as its bytes.
    """

    def __init__(self, model: str, counts: dict[int, int], words: int):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model if "/" in model else public_tokenizers.path(model))
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)) for i in range(size)]
        byte = np.array([sp.is_byte(i) for i in range(size)])
        start = np.array([p.startswith(SPACE) for p in pieces]) & np.array(plain)
        inner = (np.array([SPACE not in p for p in pieces]) & np.array(plain)) | byte
        place = np.argsort(np.argsort([-sp.get_score(i) for i in range(size)], kind="stable"))
        prior = 1.0 / (place + 100.0)
        seen = np.zeros(size)
        for i, n in counts.items():
            seen[i] = n
        share = {}
        for name, own in (("start", start), ("inner", inner)):
            p = np.where(own, seen + PRIOR * prior / prior[own].sum(), 0.0)
            share[name] = p / p.sum()
        self.stop = (words + 1.0) / (seen.sum() + 2.0)
        go = np.log(1 - min(self.stop, 0.999))
        with np.errstate(divide="ignore"):
            self.start = np.log(share["start"])
            self.inner = np.log(share["inner"]) + go
        self.byte_log = np.full(256, -np.inf)
        for i in np.flatnonzero(byte):
            self.byte_log[int(pieces[i][3:5], 16)] = self.inner[i]
        usable = [i for i in range(size) if plain[i] and (SPACE not in pieces[i] or SPACE not in pieces[i][1:])]
        self.longest = max(len(pieces[i]) for i in usable)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.hashes = np.array([self.hash(pieces[i]) for i in usable], np.uint64)
        self.first_log = np.array([self.start[i] if start[i] else -np.inf for i in usable] + [-np.inf])
        self.inner_log = np.array([self.inner[i] if inner[i] else -np.inf for i in usable] + [-np.inf])
        # A table by hash with a second one for what meets in the first.
        self.tables = [np.full(1 << 20, -1, np.int32) for _ in range(3)]
        for k, h in enumerate(self.hashes.tolist()):
            for t, slots in enumerate(self.tables):
                at = self.slot(np.array([h], np.uint64), t)[0]
                if slots[at] < 0:
                    slots[at] = k
                    break
            else:
                raise ValueError("too many pieces meet in one slot")

    def hash(self, text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(self.base) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def slot(h: np.ndarray, table: int) -> np.ndarray:
        return ((h ^ (h >> np.uint64(31))) * np.uint64((0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)[table]) >> np.uint64(44)).astype(np.int64)

    def piece(self, h: np.ndarray) -> np.ndarray:
        """Index of the piece with hash h, or -1."""
        out = np.full(len(h), -1, np.int64)
        for t, slots in enumerate(self.tables):
            todo = np.flatnonzero(out < 0) if t else slice(None)
            k = slots[self.slot(h[todo], t)]
            out[todo] = np.where((k >= 0) & (self.hashes[k] == h[todo]), k, -1)
        return out

    def log10(self, words: list[str]) -> np.ndarray:
        """Marginal of each word, which is not empty."""
        out = np.zeros(len(words))
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            longest = int(lengths[order[min(len(order), at + 20_000) - 1]])
            n = max(1, min(20_000, len(order) - at, 4_000_000 // (longest + 1)))
            mine = order[at : at + n]
            out[mine] = self.forward([words[i] for i in mine])
            at += n
        return out / np.log(10)

    def forward(self, words: list[str]) -> np.ndarray:
        """The forward recursion for words of about the same length."""
        n, width = len(words), max(map(len, words))
        code = np.zeros((n, width + 1), np.uint64)
        code[:, 0] = ord(SPACE)
        code[:, 1:] = np.array(words, f"<U{width}").view(np.uint32).reshape(n, width)
        length = np.array([len(w) for w in words]) + 1
        # alpha[j]: log of the sum over segmentations of the first j characters, the mark included.
        alpha = np.full((width + 2, n), -np.inf)
        ending = np.zeros((self.longest + 1, n), np.uint64)
        for j in range(1, width + 2):
            live = length >= j
            if not live.all():
                # Shorter words stand first and are done.
                first = int(live.argmax())
            else:
                first = 0
            c = code[first:, j - 1]
            reach = min(j, self.longest)
            ending[1 : reach + 1, first:] = ending[0:reach, first:] * self.base + c + np.uint64(1)
            terms = [alpha[j - 1, first:] + self.spelled(c)] if j > 1 else []
            for k in range(1, reach + 1):
                piece = self.piece(ending[k, first:])
                terms.append(self.first_log[piece] if k == j else alpha[j - k, first:] + self.inner_log[piece])
            stack = np.stack(terms)
            top = stack.max(0)
            safe = np.where(np.isfinite(top), top, 0)
            with np.errstate(divide="ignore"):
                alpha[j, first:] = safe + np.log(np.exp(stack - safe).sum(0))
        return alpha[length, np.arange(n)] + np.log(min(self.stop, 0.999))

    def spelled(self, c: np.ndarray) -> np.ndarray:
        """Log-probability of characters as their bytes."""
        c = c.astype(np.int64)
        b = self.byte_log
        one, two, three, four = c < 0x80, c < 0x800, c < 0x10000, c >= 0x10000
        low = lambda x: b[0x80 | (x & 0x3F)]
        return np.select(
            [one, two, three, four],
            [b[c & 0x7F], b[0xC0 | (c >> 6 & 0x1F)] + low(c), b[0xE0 | (c >> 12 & 0xF)] + low(c >> 6) + low(c), b[0xF0 | (c >> 18 & 7)] + low(c >> 12) + low(c >> 6) + low(c)],
        )


def word_counts(df: DataFrame) -> DataFrame:
    """word and c over the texts of df. Words are counted within each batch before they travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for t in texts(batch.column(0)):
                held.update(tokens(t))
                if len(held) >= 400_000:
                    yield out(held)
                    held = Counter()
        if held:
            yield out(held)

    def out(held: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

    return df.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def piece_counts(words: DataFrame, model: str) -> dict[int, int]:
    """How often each piece stands in the distinct words; bounded by the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model if "/" in model else public_tokenizers.path(model))
        total = np.zeros(sp.get_piece_size(), np.int64)
        for batch in batches:
            for row in sp.encode([w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()], num_threads=1):
                total[row] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["piece", "n"])

    return {r["piece"]: r["n"] for r in words.select("word").mapInArrow(run, "piece bigint, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def score(df: DataFrame, train: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), train_text: str = "text", model: str = MODEL) -> DataFrame:
    """keys, n_tokens, n_known, train_tokens, base_score and score (log10) of every whole text of df,
    learning from the whole texts of train.

    A null text counts as empty: it is its end alone. Repeated rows and null keys stay; an empty df
    gives an empty table. Without training texts the base score is 0 and words have the lattice only.
    """
    own = df.select(*(F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)), F.col(f"`{text}`").alias("_text"))
    learn = train.select(F.col(f"`{train_text}`").alias("text"))
    ends = learn.count()
    counts = durable(word_counts(learn))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("once"), F.count(F.when(F.col("c") == 2, 1)).alias("twice")).first()
    n_words, v_words = total["n"], total["v"]
    n, v = n_words + ends, v_words + (ends > 0)
    discount = min(0.95, max(0.1, total["once"] / max(1, total["once"] + 2 * total["twice"])))
    back = discount * v_words / n_words if n_words else 1.0
    end = min(0.5, (ends + 0.1) / (n + 0.1 * (v + 1))) if n else 0.5
    pieces = piece_counts(counts, model)
    floor = np.log10(n + 0.1 * (v + 1))
    n_bytes = own.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-n_bytes // BLOCK))
    dealt = own.withColumn("_block", F.pmod(F.xxhash64(*own.columns), F.lit(blocks)))
    text_at = len(keys)

    def listed(rows: pa.Table) -> pa.Table:
        found: set[bytes] = set()
        for chunk in rows.column("_text").chunks:
            for t in texts(chunk):
                found.update(tokens(t))
        block = rows.column("_block")[0].as_py() if rows.num_rows else 0
        return pa.table({"_block": pa.array([block] * len(found), pa.int64()), "word": pa.array(list(found), pa.binary())})

    asked = dealt.groupBy("_block").applyInArrow(listed, "_block bigint, word binary")
    known = asked.join(counts, "word").select("_block", "word", "c")
    shared, tag = df.sparkSession.sparkContext.broadcast((pieces, v_words)), uuid.uuid4().hex
    names = [*(f"_k{i}" for i in range(len(keys))), "n_tokens", "n_known", "base_score", "score"]
    schema = ", ".join([*(f"_k{i} {own.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keys))), "n_tokens bigint, n_known bigint, base_score double, score double"])

    def scored(rows: pa.Table, have: pa.Table) -> pa.Table:
        lattice = lattice_of(tag, shared, model)
        c_of = dict(zip(have.column("word").to_pylist(), have.column("c").to_pylist(), strict=True))
        place: dict[bytes, int] = {}
        ids, lengths = [], []
        for chunk in rows.column("_text").chunks:
            for t in texts(chunk):
                ws = tokens(t)
                lengths.append(len(ws))
                ids.append(np.fromiter((place.setdefault(w, len(place)) for w in ws), np.int64, len(ws)))
        words = list(place)
        c = np.fromiter((c_of.get(w, 0) for w in words), np.float64, len(words))
        sub = lattice.log10([w.decode("utf-8", "replace") for w in words]) if words else c
        own_share = np.maximum(c - discount, 0) / n_words if n_words else np.zeros(len(c))
        with np.errstate(divide="ignore"):
            model_log = np.logaddexp(np.log(own_share), np.log(back) + sub * np.log(10)) / np.log(10) + np.log10(1 - end)
        base_log = np.log10(c + 0.1) - floor
        pick = np.concatenate([*ids, np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(lengths)), lengths)
        add = lambda x: np.bincount(owner, x[pick], len(lengths))
        made = [
            pa.array(np.array(lengths, np.int64) + 1),
            pa.array(add((c > 0).astype(float)).round().astype(np.int64) + (1 if ends else 0)),
            pa.array(add(base_log) + np.log10(ends + 0.1) - floor),
            pa.array(add(model_log) + np.log10(end)),
        ]
        return pa.table([*(rows.column(i) for i in range(text_at)), *made], names)

    out = dealt.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(scored, schema)
    return out.select(*(F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)), "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")


_LATTICES: dict[str, Lattice] = {}


def lattice_of(tag: str, shared: Broadcast, model: str) -> Lattice:
    """The lattice of one run, made once in each worker."""
    if tag not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[tag] = Lattice(model, *shared.value)
    return _LATTICES[tag]


def op9_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; those of fold 0 of 10 are not learned from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    flagged = documents.withColumn("held_out", fold(F.col("doc_id"), 10) == 0)
    return score(flagged, flagged.where("NOT held_out"), keys=("doc_id", "held_out"))
