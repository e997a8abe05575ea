"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two words counts the character subsequences of three and four letters that they share,
gaps allowed up to a span and paid for by a decay, so that inserted, dropped or starred letters cost
little. Landmarks are words of the labelled texts; kernel values to them, whitened, are a word's
features, and a linear machine on them decides. Because subsequences of bounded span can be listed,
the machine collapses into one weight for each subsequence, which is what the executors apply.

Labels are on documents, and a document is as toxic as its worst words. Words that hold runs of letters
surely commoner in toxic documents, and are rare themselves in clean ones, are positive; words of clean
documents are negative, and each round of training adds those that the machine still finds bad.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import fold, only, table

#: Labelled documents of each class that a model is fitted on, about, and their longest text.
FIT_DOCUMENTS = 2500
FIT_CHARS = 20_000
LANDMARKS = 400
ROUNDS = 4
#: A run of letters is telling from so many standard deviations, a word if its share of clean documents
#: is at most this part of its share of toxic ones.
SURE = 4.0
RARER = 0.1
DECAY = 0.3
WIDTH = 24
#: (letters, offsets after the first), by the longest span.
PATTERNS = [(0, *c) for c in combinations(range(1, 5), 2)] + [(0, *c) for c in combinations(range(1, 6), 3)]
PAIRS = 32**3
EXACT = PAIRS + 32**4
#: Letters beyond a-z have no symbol of their own: subsequences with them fall by hash on so many further codes.
HASHED = 1 << 19
CODES = EXACT + HASHED
MEMO = 300_000
#: The symbol of a word's beginning and end, which take part in subsequences.
EDGE = 31
_SPLIT = re.compile(r"[\W_]+")
#: Letters that digits and accented letters stand for.
_PLAIN = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "ß": "s", "æ": "a", "ø": "o", "œ": "o", "đ": "d", "ł": "l"}


#: Scripts written without spaces, of which neighbouring letters are words: kana, Han, Thai, Lao,
#: Khmer, Myanmar.
_DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]{2,}")


def _alphabet() -> np.ndarray:
    import unicodedata

    out = np.zeros(0x10000, np.int64)
    for cp in range(0x10000):
        c = chr(cp)
        base = _PLAIN.get(c) or (unicodedata.normalize("NFKD", c)[0] if not 0xD800 <= cp < 0xE000 else c)
        out[cp] = ord(base) - 96 if "a" <= base <= "z" else 27 + cp % 4 if cp < 128 else 32 + cp
    out[0] = 0
    return out


_SYMBOL: list[np.ndarray] = []


def units(text: str) -> list[str]:
    """Words in lower case without marks inside; more than two letters standing alone in a row make one word.
    Where a script has no spaces each two neighbouring letters are one."""
    out, alone = [], []
    for raw in text.lower().split():
        w = _SPLIT.sub("", raw) if not raw.isalnum() else raw
        if len(w) == 1:
            alone.append(w)
            continue
        out += ["".join(alone)] if len(alone) > 2 else alone
        alone = []
        if w:
            out.append(w)
    out += ["".join(alone)] if len(alone) > 2 else alone
    if not text.isascii():
        out = [x for w in out for x in ([w] if w.isascii() or not _DENSE.search(w) else _dense(w))]
    if any(len(w) > WIDTH for w in out):
        step = WIDTH // 2
        out = [w[i : i + WIDTH] for w in out for i in range(0, max(1, len(w) - step), step)]
    return out


def _dense(word: str) -> list[str]:
    out, at = [], 0
    for m in _DENSE.finditer(word):
        out += [word[at : m.start()]] * (at < m.start()) + [m[0][i : i + 2] for i in range(len(m[0]) - 1)]
        at = m.end()
    return out + [word[at:]] * (at < len(word))


def symbols(words: list[str]) -> np.ndarray:
    """Letters as 1 to 30, those beyond a-z and ASCII as 32 and more, one word a row, with a mark on either side
    and 0 to the right."""
    if not _SYMBOL:
        _SYMBOL.append(_alphabet())
    width = max(map(len, words))
    flat = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.int64)
    out = np.zeros((len(words), width + 2), np.int64)
    out[:, 1:-1] = np.where(flat < 0x10000, _SYMBOL[0][np.minimum(flat, 0xFFFF)], flat + 32)
    out[:, 0] = out[np.arange(len(words)), (flat > 0).sum(1) + 1] = EDGE
    return out


def coded(columns: list[np.ndarray]) -> np.ndarray:
    """The code of three or four symbols, one of them in each column."""
    code = np.zeros_like(columns[0])
    for c in columns:
        code = code * 32 + c
    code = code + (PAIRS if len(columns) == 4 else 0)
    beyond = np.any([c >= 32 for c in columns], 0)
    if beyond.any():
        mixed = np.full(int(beyond.sum()), len(columns), np.uint64)
        for c in columns:
            mixed = (mixed ^ c[beyond].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        code[beyond] = EXACT + (mixed % np.uint64(HASHED)).astype(np.int64)
    return code


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of every word's subsequences, one word a row; weight 0 where there is none."""
    s = symbols(words)
    n, width = s.shape
    s = np.concatenate((s, np.zeros((n, 6), np.int64)), 1)
    codes, weights = [], []
    for p in PATTERNS:
        columns = [s[:, o : o + width] for o in p]
        whole = np.ones((n, width), bool)
        for c in columns:
            whole &= c > 0
        codes.append(coded(columns))
        weights.append(whole * DECAY ** (p[-1] + 1 - len(p)))
    return np.concatenate(codes, 1), np.concatenate(weights, 1)


def norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Root of each word's kernel with itself."""
    order = np.argsort(codes, 1, kind="stable")
    c, w = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
    new = np.concatenate((np.ones((len(c), 1), bool), c[:, 1:] != c[:, :-1]), 1).ravel()
    starts = np.flatnonzero(new)
    total = np.add.reduceat(w.ravel(), starts) ** 2
    return np.sqrt(np.bincount(starts // c.shape[1], total, len(c)))


def runs(words: list[str]) -> np.ndarray:
    """Codes of the runs of three and four letters side by side."""
    s = symbols(words)
    s = np.concatenate((s, np.zeros((len(s), 3), np.int64)), 1)
    a, b, c, d = (s[:, k : s.shape[1] - 3 + k] for k in range(4))
    return np.concatenate((coded([a, b, c])[c > 0], coded([a, b, c, d])[d > 0]))


@dataclass
class Machine:
    """A weight for each subsequence, a bias, and the logistic that turns a document into a score."""

    beta: np.ndarray
    bias: float
    logistic: np.ndarray
    memo: dict[str, float] = field(default_factory=dict)

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each word, -1 at least."""
        out = np.full(len(words), -1.0)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), 4000):
            mine = order[at : at + 4000]
            codes, weights = subsequences([words[i] for i in mine])
            raw = (self.beta[codes] * weights).sum(1)
            # Without adding up equal subsequences the norm is smaller, the margin larger: a bound.
            bound = raw / np.sqrt(np.maximum((weights**2).sum(1), 1e-12)) + self.bias
            far = np.flatnonzero((bound > -1) & (weights > 0).any(1))
            if len(far):
                out[np.array(mine)[far]] = np.maximum(-1, raw[far] / norms(codes[far], weights[far]) + self.bias)
        return out

    def documents(self, texts: list[list[str]]) -> np.ndarray:
        """Largest margin, and how many distinct words and words in all are bad."""
        distinct = {w for t in texts for w in t}
        if len(self.memo) + len(distinct) > MEMO:
            self.memo.clear()
        if new := sorted(w for w in distinct if w not in self.memo):
            self.memo.update(zip(new, self.margins(new).tolist(), strict=True))
        rows = []
        for t in texts:
            seen = np.fromiter(map(self.memo.__getitem__, set(t)), np.float64)
            every = np.fromiter(map(self.memo.__getitem__, t), np.float64, len(t))
            rows.append((min(seen.max(), 2.0) if len(seen) else -1.0, np.log1p((seen > 0.5).sum()), np.log1p((every > 0.5).sum())))
        return np.array(rows).reshape(-1, 3)

    def scores(self, texts: list[list[str]]) -> np.ndarray:
        x = self.documents(texts)
        return 1 / (1 + np.exp(-np.clip(np.column_stack((np.ones(len(x)), x)) @ self.logistic, -30, 30)))


def _newton_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Linear machine with squared hinge loss, by finite Newton steps."""
    w, active = np.zeros(x.shape[1]), np.ones(len(y), bool)
    for _ in range(25):
        a = x[active] * weight[active, None]
        w = np.linalg.solve(ridge * np.eye(x.shape[1]) + a.T @ x[active], a.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, each halved until it lowers the loss."""
    x, w = np.column_stack((np.ones(len(x)), x)), np.zeros(x.shape[1] + 1)
    loss = lambda v: float((weight * np.logaddexp(0, (1 - 2 * y) * (x @ v))).sum() + 0.05 * v @ v)
    now = loss(w)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - 0.1 * w)
        while (then := loss(w + step)) > now and abs(step).max() > 1e-9:
            step /= 2
        if now - then < 1e-9:
            break
        w, now = w + step, then
    return w


def _kernel_machine(positive: list[str], negative: list[str], times: np.ndarray, against: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Subsequence weights and bias of a machine on Nyström features of words. The words come most
    telling first; half of the landmarks of either kind are these, half are drawn."""
    marks: list[str] = []
    for words, share in ((positive, LANDMARKS * 5 // 8), (negative, LANDMARKS * 3 // 8)):
        drawn = rng.permutation(max(0, len(words) - share // 2))[: share - share // 2] + share // 2
        marks += words[: share // 2] + [words[i] for i in drawn]
    codes, weights = subsequences(marks)
    size = norms(codes, weights)
    known, at = np.unique(codes[weights > 0], return_inverse=True)
    to_marks = np.zeros((len(known) + 1, len(marks)))
    np.add.at(to_marks, (at, np.nonzero(weights > 0)[0]), weights[weights > 0])
    to_marks /= size

    def near(words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(marks)))
        for k in range(0, len(words), 500):
            c, w = subsequences(words[k : k + 500])
            place = np.minimum(np.searchsorted(known, c), len(known) - 1)
            w_known = w * (known[place] == c)
            for j in range(c.shape[1]):
                some = np.flatnonzero(w_known[:, j])
                out[k + some] += w_known[some, j, None] * to_marks[place[some, j]]
            out[k : k + 500] /= np.maximum(norms(c, w), 1e-9)[:, None]
        return out

    values, vectors = np.linalg.eigh(near(marks) + 1e-6 * np.eye(len(marks)))
    good = values > 1e-4
    white = vectors[:, good] / np.sqrt(values[good])
    x = np.concatenate((near(positive), near(negative))) @ white
    x = np.column_stack((x, np.ones(len(x))))
    y = np.concatenate((np.ones(len(positive)), -np.ones(len(negative))))
    weight = np.concatenate((times / times.sum(), 3 * against / against.sum())) * len(y) / 4
    w = _newton_svm(x, y, weight, 0.1)
    beta = np.zeros(CODES)
    beta[known] = to_marks[:-1] @ (white @ w[:-1])
    return beta, float(w[-1])


def train(toxic: list[list[str]], clean: list[list[str]], rates: tuple[float, float], seed: int = 8) -> Machine:
    """A machine from the distinct units of toxic and clean documents. rates: how many documents each
    of them stands for."""
    nothing = Machine(np.zeros(CODES), -1.0, np.array([-30.0, 0.0, 0.0, 0.0]))
    if not any(toxic) or not any(clean):
        # One class only: its own score, whatever the text.
        nothing.logistic[0] = 30.0 if toxic and not clean else -30.0
        return nothing
    rng = np.random.default_rng(seed)
    in_toxic, in_clean = (Counter(w for t in texts for w in t) for texts in (toxic, clean))
    counts = []
    for texts in (toxic, clean):
        total = np.zeros(CODES)
        for t in texts:
            if t:
                total[np.unique(runs(t))] += 1
        counts.append(total)
    # How surely a run of letters is commoner in toxic documents, in standard deviations.
    expected = (counts[0] + counts[1]) * len(toxic) / (len(toxic) + len(clean))
    surprise = (counts[0] - expected) / np.sqrt(expected + 1)
    telling = [w for w in sorted(in_toxic) if in_clean[w] * len(toxic) < RARER * in_toxic[w] * len(clean)]
    value = {w: float(surprise[runs([w])].max()) for w in telling}
    negative = sorted(in_clean, key=lambda w: (-in_clean[w], w))
    machine, hard = nothing, []
    positive = sorted((w for w in telling if value[w] >= SURE), key=lambda w: (-in_toxic[w], w))[:4000]
    if not positive:
        return nothing
    for r in range(ROUNDS):
        # Each round adds the clean words that the machine so far finds worst.
        pool = negative[:2000] + [negative[2000 + i] for i in rng.permutation(max(0, len(negative) - 2000))[:2000]]
        if r:
            margin = machine.margins(negative)
            hard = list(dict.fromkeys([negative[i] for i in np.argsort(-margin, kind="stable")[:1500]] + hard))
            pool = list(dict.fromkeys(hard + pool))
        beta, bias = _kernel_machine(positive, pool, np.sqrt([in_toxic[w] for w in positive]), np.sqrt([in_clean[w] for w in pool]), rng)
        machine = Machine(beta.astype(np.float32), bias, nothing.logistic)
    x = machine.documents([*toxic, *clean])
    y = np.concatenate((np.ones(len(toxic)), np.zeros(len(clean))))
    weight = np.where(y == 1, rates[0], rates[1])
    machine.logistic = _logistic(x, y, weight / weight.mean())
    machine.memo = {}
    return machine


def fit(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", documents: int = FIT_DOCUMENTS, chars: int = FIT_CHARS) -> Machine:
    """A machine from about `documents` labelled rows of each class, drawn by a hash of the key, with
    texts of up to `chars` characters. Rows without key, label or text are left out."""
    marked = only(labels, key, label).toDF("key", "y").select("key", F.col("y").cast("int").alias("y")).where("key IS NOT NULL AND y IN (0, 1)").groupBy("key").agg(F.max("y").alias("y"))
    own = only(df, key, text).toDF("key", "text").where("text IS NOT NULL").where(F.length("text") <= chars)
    marked = marked.join(own.select("key").distinct(), "key", "left_semi")
    sizes = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("y") == 1, F.lit(min(1.0, documents / sizes.get(1, 1)))).otherwise(F.lit(min(1.0, documents / sizes.get(0, 1))))
    drawn = marked.where(F.pmod(F.xxhash64("key", F.lit("toxicity")), F.lit(1_000_000)) < share * 1_000_000)
    # About `documents` keys of either class by the rates above, whatever the tables' sizes: few enough to send to
    # every executor, so that no text is shuffled.
    sample = own.join(F.broadcast(drawn), "key").select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(units(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["y", "units"])

    rows = sorted((r["y"], list(r["units"])) for r in sample.mapInArrow(run, "y int, units array<string>").collect())
    split = [[u for y, u in rows if y == k] for k in (1, 0)]
    return train(split[0], split[1], tuple(sizes.get(k, 1) / max(1, len(s)) for k, s in zip((1, 0), split, strict=True)))


def rate(df: DataFrame, machine: Machine, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, score (0 to 1) and predicted (1 from 0.5) of every whole text.

    A null or empty text, or one without words, has the score of a text without any bad word.
    Very long texts are read whole; other columns are not read. Repeated rows and null keys stay; an empty table
    gives an empty one.
    """
    own, n = only(df, *keys, text), len(keys)
    shared = df.sparkSession.sparkContext.broadcast((machine.beta, machine.bias, machine.logistic))
    schema = ", ".join([*(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keys), "score double, predicted int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                score = m.scores([units(t or "") for t in batch.column(n).to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], [*keys, "score", "predicted"])

    return own.mapInArrow(run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of fold 0 of 5 are never learned from. Null and empty texts score as texts
    without any bad word; repeated rows stay; an empty table gives an empty one."""
    documents = table(spark, sf_dir, "documents")
    machine = fit(documents.where(fold(F.col("doc_id"), 5) != 0), table(spark, sf_dir, "labels"))
    return rate(documents, machine).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
