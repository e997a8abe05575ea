"""Components and pairs of many labels in one place."""

import math
import random

import numpy as np

from gnomon.operators import clusters, graph, quantiles

LABEL = "city string, pano_id string, label_type string, label_id bigint, user_id bigint, time_created int, az double, el double"


def test_no_table_of_pairs_is_written(spark, monkeypatch):
    """300 users in one spot make 44,850 pairs; what is kept grows with the labels, not with these."""
    rng, sizes, write = random.Random(3), [], quantiles.written

    def counted(df):
        made = write(df)
        sizes.append(made.count())
        return made

    for module in (clusters, graph, quantiles):
        monkeypatch.setattr(module, "written", counted)
    rows = [("c", "p", "t", i, i, i, 20 + rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(300)]
    pairs = clusters.cross_user_pairs(clusters.clusters(spark.createDataFrame(rows, LABEL), 1.5))
    got = clusters.sigma(pairs).first()
    d = [((a[6] - b[6]) * math.cos(math.radians((a[7] + b[7]) / 2)), a[7] - b[7]) for i, a in enumerate(rows) for b in rows[i + 1 :]]
    total = np.hypot(*np.array(d).T)
    assert (got["n_pairs"], got["n_clusters"]) == (44850, 1)
    assert abs(got["p50"] - np.quantile(total, 0.5)) < 1e-6 and abs(got["p90"] - np.quantile(total, 0.9)) < 1e-6
    # Buckets of the differences are bounded by their range.
    assert max(sizes) < 20_000


def test_cells_link_as_pairs_do(spark):
    rng = random.Random(1)
    rows = [("c", f"p{i % 3}", "t", i, i, i, rng.uniform(0, 360), rng.choice([rng.uniform(-89.9, 89.9), rng.uniform(84, 90), rng.uniform(-5, 5)])) for i in range(900)]
    rows += [("c", "p0", "t", 900, 0, 0, None, 0.0), ("c", "p0", "t", 901, 0, 0, math.nan, 0.0)]
    root = list(range(902))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(rows[:900]):
        for b in rows[:i]:
            d = ((a[6] - b[6] + 180) % 360 - 180) * math.cos(math.radians((a[7] + b[7]) / 2))
            if a[1] == b[1] and math.hypot(d, a[7] - b[7]) <= 1.5:
                x, y = find(a[3]), find(b[3])
                root[max(x, y)] = min(x, y)
    got = {r["label_id"]: r["cluster_id"] for r in clusters.clusters(spark.createDataFrame(rows, LABEL), 1.5).collect()}
    assert got == {i: find(i) for i in range(902)}
