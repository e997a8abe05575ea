"""Texts that meet in a crowded bucket alone are compared."""

import numpy as np

from gnomon.llm import op10_near as op


def test_a_crowded_late_sketch_brings_its_texts_together(spark, monkeypatch):
    def made(documents):
        """Every sketch is a text's own but one, which all texts share."""
        out = np.array([[int(x[0]) % (1 << 40) * 1000 + s for s in range(112)] for x in documents], np.uint64)
        out[:, 100] = 7
        return out

    monkeypatch.setattr(op, "sketches", made)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(70)]
    rows.append((70, rows[0][1].replace("w0x0 ", "other ").replace("w0x9", "another")))
    got = {r["doc_id"]: r["class_id"] for r in op.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: i for i in range(70)} | {70: 0}


def test_small_buckets_are_gathered_once_and_large_ones_alone_meet_their_sizes(spark, monkeypatch):
    """Buckets of 2, 3 and 70 nodes, one of one component; pairs are those of the large and the small ones together."""
    rows = [(1, 1), (1, 2), (2, 3), (2, 4), (2, 5), (3, 6), (3, 7)] + [(4, n) for n in range(10, 80)]
    bucket = spark.createDataFrame(rows, "key bigint, node bigint")
    root = spark.createDataFrame([(n, 6 if n == 7 else n) for n in {n for _, n in rows}], "node bigint, root bigint")
    spoken = spark.createDataFrame([(n, 10, bytes(op.COUNTS)) for n in {n for _, n in rows}], "node bigint, n_words bigint, counts binary")
    seen, plain = [], op.divided

    def watched(bucket, root):
        seen.extend(r["key"] for r in bucket.select("key").distinct().collect())
        return plain(bucket, root)

    monkeypatch.setattr(op, "divided", watched)
    got = {(r["a"], r["b"]) for r in op.crossed(bucket, root, spoken, 0.8).collect()}
    assert got == {(1, 2), (3, 4), (3, 5), (4, 5)} | {(a, b) for a in range(10, 80) for b in range(a + 1, 80)}
    assert seen == [4]
