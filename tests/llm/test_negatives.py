"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

ROWS = "vec_id bigint, embedding array<double>, label int, score string, part string"


def expected(rows, positives=5, negatives=3):
    """(anchor, positive, rank, negative, score, score) of every anchor, in whole numbers."""
    own = []
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, label, v in own:
        if i % 50:
            continue
        scored = [(-dot(v, w), j, other) for j, other, w in own if j != i]
        first = sorted(x for x in scored if x[2] == label)[:positives]
        for s, p, _ in first:
            fits = sorted(x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives]
            out += [(i, p, rank, j, -s, -t) for rank, (t, j, _) in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, tmp_path):
    from gnomon.llm.op12_negatives import op12_hard_negatives

    at = str(tmp_path / f"sf{random.random()}")
    spark.createDataFrame(rows, ROWS).write.parquet(f"{at}/embeddings.parquet")
    return sorted(map(tuple, op12_hard_negatives(spark, at).collect()))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 8)) * 0.4
    return [(i, (centres[i % 10] + rng.normal(size=8) * 0.3).tolist(), int(i % 10), "x", "y") for i in range(900)]


def test_equal_brute_force_over_many_parts_and_blocks(spark, vectors, tmp_path):
    from gnomon.llm import op12_negatives as op

    usual = op.BLOCK, op.SAMPLE, op.QUERIES, op.PIVOTS
    try:
        want = expected(vectors)
        assert len(want) > 100
        for op.BLOCK, op.SAMPLE, op.QUERIES, op.PIVOTS in (usual, (7, 20, 3, 5), (7, 1, 3, 1)):
            assert found(spark, vectors, tmp_path) == want
    finally:
        op.BLOCK, op.SAMPLE, op.QUERIES, op.PIVOTS = usual


def test_odd_rows(spark, vectors, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = vectors[:200] + [(1000, None, 1, "x", "y"), (1050, [0.5] * 8, None, "x", "y"), (1100, [nan] * 8, 1, "x", "y"), (1150, [inf, *[0.1] * 7], 1, "x", "y"), (1200, [None, *[0.1] * 7], 1, "x", "y"), (None, [0.5] * 8, 1, "x", "y")]
    # Ties: one vector under many ids and labels; a third of all rows.
    rows += [(2000 + i, [0.3] * 8, i % 3, None, None) for i in range(100)]
    # A row that repeats, and vectors of other lengths.
    rows += [rows[3], (3000, [0.4, 0.4], 0, "x", "y"), (3050, [], 0, "x", "y"), (3003, [0.4] * 12, 1, "x", "y")]
    assert found(spark, rows, tmp_path) == expected(rows)
    assert found(spark, rows[:0], tmp_path) == [] and found(spark, [(0, [1.0], 1, "x", "y")], tmp_path) == []
    zeros = [(i, [0.0] * 4, 1, "x", "y") for i in range(8)]
    assert found(spark, zeros, tmp_path) == expected(zeros)


def test_scores_beyond_doubles_are_exact(spark, tmp_path):
    rng = random.Random(3)
    # Components near 2^29 and three of them: scores near 2^60.
    rows = [(i, [(2**29 + rng.randint(0, 9)) / 256 for _ in range(3)], i % 2, "x", "y") for i in range(60)]
    rows += [(100 + i, [(2**28 + 2**27 + rng.randint(0, 9)) / 256 for _ in range(3)], 1 - i % 2, "x", "y") for i in range(40)]
    want = expected(rows)
    assert want and max(x[4] for x in want) > 1 << 59
    assert found(spark, rows, tmp_path) == want


def test_what_is_left_out_cannot_matter(vectors):
    """No row scores above the bound of its block, and bounds leave blocks out."""
    from gnomon.llm import op12_negatives as op

    v = np.floor(256 * np.array([x[1] for x in vectors]))
    own = op.Space(8, float((v * v).sum(1).max()), np.float64, np.zeros((1, 9)), np.zeros(0, np.int64), np.zeros(0, np.int64), v[:0])
    own.pivots = own.lifted(v[:10])
    far = own.to_pivots(own.lifted(v))
    pivot, key = far.argmin(1), far.min(1)
    to = own.to_pivots(np.column_stack((v, np.zeros(len(v)))))
    scores = v @ v.T
    most = op.most_score(own, (v * v).sum(1)[:, None], to[:, pivot], key, key)
    assert (scores <= most).all()
    fifth = np.sort(scores, axis=1)[:, -6][:, None]
    assert (most < fifth).mean() > 0.1
