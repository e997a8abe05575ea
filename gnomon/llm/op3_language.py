"""Language identification of mixed text: script ranges, word scores, and Viterbi over words.

A model holds, for each language, the counts of hashed letter pairs and triples of its words and of
the scripts that these words are in. A word is a candidate only for languages that use its script;
its score in each is the log-likelihood of its pairs and triples. Viterbi with a price for each
switch labels the words of a document, so that runs of words in one language come out as spans;
the language with most words is the document's.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import fold, only, table

BUCKETS = 1 << 15
#: Documents of each language that a model is fitted on, about.
FIT_DOCUMENTS = 4000
SWITCH = 6.0
WIDTH = 24
MEMO = 300_000
#: Unicode ranges by script, first and last code point; 0 is any other.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F), ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]
_EDGES = np.array([x for _, a, b in SCRIPTS for x in (a, b + 1)])
_SCRIPT_OF = np.array([0] + [x for name, _, _ in SCRIPTS for x in (SCRIPT_NAMES.index(name), 0)])
WORD = re.compile(r"[^\W\d_]+")
#: Numbers such as a half or a Roman four, which WORD takes for letters; a text that may have some is looked at closely.
_NUMBERS = "".join(chr(x) for x in range(sys.maxunicode + 1) if unicodedata.category(chr(x)) in ("Nl", "No"))
_ODD = re.compile(f"[{''.join(c for c in _NUMBERS if c < chr(0x10000))}\U00010000-\U0010ffff]")
LETTERS = re.compile(rf"[^\W\d_{_NUMBERS}]+")


def words(text: str) -> list[str]:
    """Runs of letters in lower case, cut into parts of WIDTH letters at most."""
    text = text.lower()
    found = (LETTERS if not text.isascii() and _ODD.search(text) else WORD).findall(text)
    if any(len(w) > WIDTH for w in found):
        found = [w[i : i + WIDTH] for w in found for i in range(0, len(w), WIDTH)]
    return found


def letters(ws: list[str]) -> np.ndarray:
    """Code points, one word a row, with a mark 1 on either side and 0 to the right."""
    flat = np.array(ws, f"<U{WIDTH}").view(np.uint32).reshape(len(ws), WIDTH).astype(np.uint64)
    out = np.zeros((len(ws), WIDTH + 2), np.uint64)
    out[:, 0] = 1
    out[:, 1:-1] = flat
    out[np.arange(len(ws)), (flat > 0).sum(1) + 1] = 1
    return out


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's letter pairs and triples, and which of them count."""
    a, b, c = codes[:, :-1], codes[:, 1:], np.concatenate((codes[:, 2:], np.zeros((len(codes), 1), np.uint64)), 1)
    mix = lambda x: ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(BUCKETS)
    pair = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    triple = pair * np.uint64(31) + c * np.uint64(0x165667B19E3779F9)
    return np.concatenate((mix(pair), mix(triple)), 1).astype(np.int64), np.concatenate(((a > 0) & (b > 0), (a > 0) & (b > 0) & (c > 0)), 1)


def scripts(codes: np.ndarray) -> np.ndarray:
    """Script of each word's first letter."""
    return _SCRIPT_OF[np.searchsorted(_EDGES, codes[:, 1].astype(np.int64), "right")]


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # log-likelihoods, buckets x languages
    uses: np.ndarray  # scripts x languages
    likeliest: int

    def __post_init__(self):
        self.memo: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.langs)), np.float32)
        self.known = np.zeros(0, bool)

    def learn_words(self, ws: list[str]) -> None:
        if len(self.memo) + len(ws) > MEMO:
            self.memo, self.scores, self.known = {}, self.scores[:0], self.known[:0]
        for at in range(0, len(ws), 20_000):
            part = ws[at : at + 20_000]
            codes = letters(part)
            bucket, counts = features(codes)
            score = np.zeros((len(part), len(self.langs)), np.float32)
            for k in range(bucket.shape[1]):
                score += self.weights[bucket[:, k]] * counts[:, k, None]
            may = self.uses[scripts(codes)]
            known = may.any(1)
            score = 0.5 * np.where(may, score, -1e4 + score)
            score = np.where(known[:, None], score - score.max(1, keepdims=True), 0)
            self.memo.update(zip(part, range(len(self.scores), len(self.scores) + len(part)), strict=True))
            self.scores, self.known = np.concatenate((self.scores, score.astype(np.float32))), np.concatenate((self.known, known))

    def label(self, documents: list[list[str]]) -> list[np.ndarray]:
        """A language index for each word of each document, -1 for words of no known script."""
        n = len(self.langs)
        distinct = {w for d in documents for w in d}
        if len(distinct) + len(self.memo) > MEMO:
            self.memo, self.scores, self.known = {}, self.scores[:0], self.known[:0]
        if new := [w for w in distinct if w not in self.memo]:
            self.learn_words(sorted(new))
        order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
        ids = [np.fromiter(map(self.memo.__getitem__, documents[i]), np.int64, len(documents[i])) for i in order]
        lengths = np.array([len(x) for x in ids], np.int64)
        longest = int(lengths[0]) if len(lengths) else 0
        # Words of the same place in all documents stand together; only documents that are so long take part.
        live = np.searchsorted(-lengths, -np.arange(longest), "left")
        offset = np.concatenate(([0], np.cumsum(live)))
        place, row = [np.concatenate(x) if ids else np.zeros(0, np.int64) for x in ([np.arange(len(x)) for x in ids], [np.full(len(x), r) for r, x in enumerate(ids)])]
        flat = offset[place] + row
        emitted = np.zeros((len(flat), n), np.float32)
        emitted[flat] = self.scores[np.concatenate(ids)] if len(flat) else 0
        value, back = np.zeros((len(ids), n), np.float32), np.zeros((len(flat), n), np.int16)
        stay = np.arange(n)
        for t in range(longest):
            v = value[: live[t]]
            best = v.argmax(1)
            switch = v[np.arange(len(v)), best] - SWITCH
            moved = v < switch[:, None]
            back[offset[t] : offset[t + 1]] = np.where(moved, best[:, None], stay)
            value[: live[t]] = np.where(moved, switch[:, None], v) + emitted[offset[t] : offset[t + 1]]
        out = np.zeros(len(flat), np.int64)
        state = value.argmax(1) if len(ids) else np.zeros(0, np.int64)
        for t in range(longest - 1, -1, -1):
            rows = np.arange(live[t])
            out[offset[t] : offset[t + 1]] = state[: live[t]]
            state[: live[t]] = back[offset[t] + rows, state[: live[t]]]
        labels: list[np.ndarray] = [np.zeros(0, np.int64)] * len(documents)
        at = np.concatenate(([0], np.cumsum(lengths)))
        for r, i in enumerate(order):
            mine = out[flat[at[r] : at[r + 1]]]
            labels[i] = np.where(self.known[ids[r]], mine, -1)
        return labels


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", documents: int = FIT_DOCUMENTS) -> Model:
    """A model from about `documents` rows of each language, drawn by a hash of the key; rows without
    text or language are left out. What comes to the driver is bounded by languages x buckets."""
    own = only(df, key, text, lang).toDF("key", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool), 0)
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, documents / n))).otherwise(share)
    drawn = own.where(F.pmod(F.xxhash64("key", F.lit("language")), F.lit(1_000_000)) < share * 1_000_000).select("lang", "text")
    langs = sorted(sizes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ws := words(t):
                    own = total.setdefault(name, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                    for at in range(0, len(ws), 20_000):
                        codes = letters(ws[at : at + 20_000])
                        bucket, counts = features(codes)
                        own[:BUCKETS] += np.bincount(bucket[counts], minlength=BUCKETS)
                        own[BUCKETS:] += np.bincount(scripts(codes), minlength=len(SCRIPT_NAMES))
        for name, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(own[at], pa.int64())], ["lang", "feature", "n"])

    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    for r in drawn.mapInArrow(count, "lang string, feature bigint, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n")).collect():
        counts[r["feature"], langs.index(r["lang"])] = r["n"]
    grams, used = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
    weights = np.log(grams / grams.sum(0))
    return Model(langs, (weights - weights.max(1, keepdims=True)).astype(np.float32), used > 1e-3 * used.sum(0), langs.index(max(sizes, key=lambda k: (sizes[k], k))))


def identify(df: DataFrame, model: Model, text: str = "text", keys: tuple[str, ...] = ("doc_id",), within: str | None = None) -> DataFrame:
    """keys, lang_pred, score and spans (lang, words) of every whole text.

    lang_pred is `und` with score 0 and no spans if the text is null or has no letter, or if the model
    knows no language. score is the share of words of known scripts that lie in spans of lang_pred; a
    text without any such word gets the likeliest language with score 0. Of languages with equally
    many words the first by name wins. Repeated rows and null keys stay, very long texts are read whole, other
    columns are not read; empty tables stay empty. With within, text is a field of that key, a struct without
    nulls, and reaches the workers once.
    """
    own, n = only(df, *keys, *[text] * (within is None)), len(keys)
    shared = df.sparkSession.sparkContext.broadcast((model.langs, model.weights, model.uses, model.likeliest))
    span = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
    schema = ", ".join([*(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keys), "lang_pred string, score double, spans array<struct<lang:string,words:bigint>>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                documents = [words(t or "") for t in (batch.column(n) if within is None else batch.column(within).field(text)).to_pylist()]
                labels = m.label(documents) if m.langs else [np.zeros(0, np.int64)] * len(documents)
                lang, score, spans = [], [], []
                for ws, own_labels in zip(documents, labels, strict=True):
                    seen = own_labels[own_labels >= 0]
                    if not ws or not m.langs:
                        lang.append("und")
                    elif not len(seen):
                        lang.append(m.langs[m.likeliest])
                    else:
                        share = np.bincount(seen, minlength=len(m.langs))
                        lang.append(m.langs[int(share.argmax())])
                    score.append(float(share.max() / len(seen)) if len(seen) else 0.0)
                    cut = np.flatnonzero(np.diff(seen)) + 1
                    first = np.concatenate(([0], cut)) if len(seen) else cut[:0]
                    spans.append([{"lang": m.langs[k], "words": w} for k, w in zip(seen[first].tolist(), np.diff(np.append(first, len(seen))).tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, span)], [*keys, "lang_pred", "score", "spans"])

    return own.mapInArrow(run, schema)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language and score of every document; documents of fold 0 of 5 are never learned from. Null and
    empty texts, and those without a letter, are `und`; repeated rows stay; an empty table gives an empty one."""
    documents = table(spark, sf_dir, "documents")
    model = fit(documents.where(fold(F.col("doc_id"), 5) != 0))
    return identify(documents, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", F.size("spans").cast("bigint").alias("n_spans"))
