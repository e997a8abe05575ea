"""Divergence of sources against counts of every term."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

DOCS = "doc_id bigint, text string, lang string, source string, term string, n string, a string"


def expected(rows, least_docs, top=50):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {x[0] for x in docs}:
        own = [x for x in docs if x[0] == lang]
        in_docs = Counter(t for x in own for t in set(x[2]))
        kept = [t for t, n in in_docs.items() if n >= least_docs]
        whole = Counter(t for x in own for t in x[2])
        groups = {s: Counter(t for x in own if x[1] == s for t in x[2]) for s in {x[1] for x in own}}
        share = lambda counts, total: {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}
        total = lambda counts: sum(counts[t] for t in kept)
        p, q = {s: share(n, total(n)) for s, n in groups.items()}, share(whole, total(whole))
        for s in groups:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s), key=lambda x: (x[0], x[1].encode()))
            terms = sorted(((q[t] - p[s][t], t) for t in kept if groups[s][t] and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, -v, rank) for part, some in (("pair", pairs), ("term", terms)) for rank, (v, item) in enumerate(some, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    rows = []
    for i in range(240):
        source = None if i % 40 == 3 else "big" if i % 3 == 0 else f"s{i % 7}"
        mine = words[: 40 + 10 * (i % 7)]
        text = " ".join(rng.choice(mine).upper() if rng.random() < 0.2 else rng.choice(mine) for _ in range(rng.randint(0, 40)))
        rows.append((i, text.replace(" ", rng.choice([" ", "-", "3", "_"])), ("en", "de", None)[i % 3 if i % 5 else 0], source, "x", "y", "z"))
    # Groups without terms, nulls everywhere, an odd alphabet, a long text, rows that repeat.
    return rows + [(900, None, "en", "bare", "x", "y", "z"), (901, "12 34", "fr", "only", "x", "y", "z"), (None, None, None, None, None, None, None), (902, "\U0001f600\U0001f600 Ää 的的 İ", "en", "odd", "x", "y", "z"), (903, "ab c " * 30_000, "en", "long", "x", "y", "z"), *rows[:3]]


def test_equal_counts_of_every_term(spark, docs):
    from gnomon.llm.op13_divergence import divergence

    frame = spark.createDataFrame(docs, DOCS).repartition(5)
    for least, top in ((30, 50), (1, 3), (100_000, 50)):
        got = divergence(frame, least_docs=least, top=top)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == expected(docs, least, top), least
    assert divergence(frame.limit(0)).count() == 0
    # The columns may be one.
    assert divergence(frame, lang="source").where("part = 'pair'").count() == 0


def test_small_steps_change_nothing(spark, docs):
    from gnomon.llm import op13_divergence as op

    frame, usual = spark.createDataFrame(docs, DOCS), (op.HELD, op.PAIRS)
    try:
        op.HELD, op.PAIRS = 10, 7
        assert sorted(map(tuple, op.divergence(frame, least_docs=2).collect())) == expected(docs, 2)
    finally:
        op.HELD, op.PAIRS = usual


def test_rows_of_keys_add_up():
    from gnomon.llm.op13_divergence import grouped

    rng = np.random.default_rng(1)
    keys, m = [rng.integers(0, 3, 200) for _ in range(3)], rng.integers(-5, 5, 200)
    rows, n = grouped(keys, m)
    want: Counter = Counter()
    for k, x in zip(zip(*keys, strict=True), m.tolist(), strict=True):
        want[tuple(int(i) for i in k)] += x
    assert {tuple(int(i) for i in k): int(x) for k, x in zip(zip(*rows, strict=True), n, strict=True)} == dict(want)


def test_shares_of_large_counts_are_exact(spark):
    from pyspark.sql import functions as F

    from gnomon.llm.op13_divergence import share

    rows = [(0, 0, 1), (5, 10, 3), (10**13 + 7, 10**15 + 3, 10**6), (9 * 10**9 - 6, 10**10, 1), (9 * 10**9, 10**10, 1), (1, 2, 0)]
    got = [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x bigint, n bigint, v bigint").orderBy("i").select(share(F.col("x"), F.col("n"), F.col("v"))).collect()]
    assert got == [None if not v else 1 + 10**9 * (x + 5) // (n + 5 * v) for x, n, v in rows]
