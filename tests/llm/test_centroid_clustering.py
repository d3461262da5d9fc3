import random
from hashlib import sha256
from math import floor, isfinite

import numpy as np

from chorus.llm import centroid_clustering as cc


def brute(rows, k, rounds, width):
    kept = [
        (i, [floor(1024 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == width and all(x is not None and isfinite(x) for x in v)
    ]
    starts = sorted(kept, key=lambda r: (sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in starts[:k]]

    def place():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        at = place()
        for j in range(len(centers)):
            own = [v for (_, v), (_, c) in zip(kept, at) if c == j]
            if own:
                centers[j] = [sum(x) // len(own) for x in zip(*own)]
    at = place()
    every = sum(d for d, _ in at)
    sums = {j: sum(d for d, c in at if c == j) for j in range(len(centers))}
    return sorted(
        (str(i), j, d, sums[j], every, sha256(",".join(map(str, centers[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(kept, at)
    )


def made(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def blobs(n, width, seed, spread=0.1):
    rnd = random.Random(seed)
    centers = [[rnd.uniform(-2, 2) for _ in range(width)] for _ in range(6)]
    return [(i, [float(np.float32(x + rnd.gauss(0, spread))) for x in rnd.choice(centers)]) for i in range(n)]


def test_same_clusters_as_comparing_with_every_centroid(spark):
    rows = blobs(400, 6, 1) + [(9, [0.5] * 6), (9, [0.5] * 6), (None, [1.0] * 6), (None, [1.0] * 6)]
    rows += [(501, None), (502, [1.0] * 5), (503, [1.0] * 5 + [None]), (504, [1.0] * 5 + [float("nan")]),
             (505, [1.0] * 5 + [float("-inf")]), (506, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert made(cc.cluster(df, k=7, rounds=6, width=6)) == brute(rows, 7, 6, 6)


def test_ties_repeats_and_few_vectors(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert made(cc.cluster(df, k=8, rounds=3, width=2)) == brute(rows, 8, 3, 2)
    assert made(cc.cluster(df.limit(2), k=8, rounds=3, width=2)) == brute(rows[:2], 8, 3, 2)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(x)), float(i)]) for i, x in enumerate([3e38, -3e38, 2.9e38, 1e6, 1e6 + 1, 5.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = [tuple(x if not isinstance(x, int) or x < 2**63 else None for x in r) for r in brute(rows, 3, 4, 2)]
    got = made(cc.cluster(df, k=3, rounds=4, width=2))
    assert [(r[0], r[1], r[2], r[5]) for r in got] == [(r[0], r[1], r[2], r[5]) for r in want]


def test_nothing_to_cluster(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    for empty in (df, df.limit(0)):
        found = cc.cluster(empty)
        assert found.columns[:3] == ["vec_id", "cluster", "distance"] and found.count() == 0


def test_clashing_columns_are_not_read(spark):
    rows = blobs(50, 4, 2)
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, _key string")
    assert made(cc.cluster(df, k=4, rounds=2, width=4)) == brute(rows, 4, 2, 4)


def test_bounds_never_exceed_distances_and_rule_most_centroids_out():
    rows = [v for _, v in blobs(2000, 16, 3, spread=0.02)]
    block = cc.integers(np.array(rows))
    centers = [row.tolist() for row in block[:12]]
    pivots = cc.Pivots(centers)
    near = cc.distances(block, pivots.points)
    moved = [[x + 3 for x in c] for c in centers]
    bounds = pivots.bounds(near, cc.distances(np.array(moved, object), pivots.points))
    exact = np.stack([np.sqrt(cc.squared(block, np.array(c)).astype(float)) for c in moved], 1)
    assert (bounds <= exact).all()
    cluster, found, compared = cc.nearest(block, near, moved, pivots)
    assert (cluster == exact.argmin(1)).all() and (np.sqrt(found) == exact.min(1)).all()
    assert compared < 0.5 * exact.size

