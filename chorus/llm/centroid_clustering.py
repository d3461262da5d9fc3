"""Centroid clustering with Ptolemaic pivots, in exact integers.

The first centroids also serve as fixed pivots, taken in pairs. A vector's
distances to the pivots are measured once and written beside it; a centroid's
are measured once a round. For a pivot pair (p, q) Ptolemy's inequality gives

    d(x, c) >= | d(x, p) d(c, q) - d(x, q) d(c, p) | / d(p, q)

so most centroids are ruled out from cached numbers. Bounds are rounded down by
more than their floating-point error; what they leave is compared exactly.
"""

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.operators.scale import pin

SCALE = 1024
MOST_PIVOTS = 32
#: Far above the rounding error of a handful of double operations.
SLACK = 1e-12
#: Differences of numbers below this keep squared distances of 64 components within 63 bits.
SAFE = 1 << 27
#: Components beyond a 32-bit float count as infinite.
LARGEST = 3.4028234663852886e38
#: Sums travel in two decimals of this base.
LIMB = 10**30


def integers(block: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): in 64 bits where squares of differences fit, else as Python integers."""
    scaled = np.floor(block.astype(np.float64) * SCALE)
    if not scaled.size or np.abs(scaled).max() < SAFE:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled.tolist()], object).reshape(scaled.shape)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of matching rows."""
    gap = a - b
    return (gap * gap).sum(-1)


def _exact(block: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Block and centroids in one number type in which squared distances are exact."""
    if block.dtype != object and all(abs(x) < SAFE for c in centroids for x in c):
        return block, np.array(centroids, np.int64).reshape(len(centroids), -1)
    return block.astype(object), np.array(centroids, object).reshape(len(centroids), -1)


def distances(block: np.ndarray, points: list[list[int]]) -> np.ndarray:
    """Distance of every row to every point, as doubles."""
    rows, at = _exact(block, points)
    return np.stack([np.sqrt(squared(rows, p).astype(np.float64)) for p in at], 1)


class Pivots:
    """Fixed pivot pairs and what Ptolemy's inequality says by them."""

    def __init__(self, points: list[list[int]]):
        self.points = points[:MOST_PIVOTS]
        apart = distances(np.array(self.points, object), self.points)
        n = len(self.points)
        pairs = [(i, i + 1) for i in range(0, n - 1, 2)] + ([(n - 1, 0)] if n % 2 and n > 1 else [])
        self.pairs = [(p, q, apart[p, q]) for p, q in pairs if apart[p, q] > 0]

    def bounds(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Lower bounds on the distance of every vector to every centroid, from both sides' pivot distances."""
        out = np.zeros((len(near), len(far)))
        for p, q, apart in self.pairs:
            x, y = near[:, p, None] * far[None, :, q], near[:, q, None] * far[None, :, p]
            np.maximum(out, (np.abs(x - y) - SLACK * (x + y)) / apart, out)
        return out * (1 - SLACK)


def nearest(
    block: np.ndarray, near: np.ndarray, centroids: list[list[int]], pivots: Pivots
) -> tuple[np.ndarray, np.ndarray, int]:
    """Per row the nearest centroid (ties: the smaller number), its squared distance, and how many were compared."""
    rows, at = _exact(block, centroids)
    bounds = pivots.bounds(near, distances(at.astype(object), pivots.points))
    likely = bounds.argmin(1)
    found = squared(rows, at[likely])
    # the square of a bound that may not exceed the distance found
    open_ = bounds * bounds * (1 - SLACK) <= found.astype(np.float64)[:, None]
    open_[np.arange(len(rows)), likely] = False
    row, which = np.nonzero(open_)
    more = squared(rows[row], at[which])
    best, cluster = found.copy(), likely.copy()
    for k in range(len(centroids)):  # a vector meets each centroid once
        mine = which == k
        i, d = row[mine], more[mine]
        better = (d < best[i]) | ((d == best[i]) & (k < cluster[i]))
        best[i[better]], cluster[i[better]] = d[better], k
    return cluster, best, len(rows) + len(row)


def _block(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _cached(pivots: Pivots, width: int):
    """Rows (key, vector, distances to the pivots)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = distances(integers(_block(batch.column(1), width)), pivots.points)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(near) + 1) * near.shape[1], pa.int32()), pa.array(near.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed], names=["_key", "_vector", "_near"])

    return run


def _assigned(batch: pa.RecordBatch, centroids, pivots: Pivots, width: int):
    block = integers(_block(batch.column(1), width))
    near = _block(batch.column(2), len(pivots.points))
    cluster, found, _ = nearest(block, near, centroids, pivots)
    return block, cluster, found


def _sums(centroids: list[list[int]], pivots: Pivots, width: int):
    """Per task and cluster: number of vectors and their componentwise sums, in two limbs."""
    whole = pa.list_(pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((len(centroids), width), object), [0] * len(centroids)
        for batch in batches:
            if not batch.num_rows:
                continue
            block, cluster, _ = _assigned(batch, centroids, pivots, width)
            for k in np.unique(cluster).tolist():
                mine = block[cluster == k]
                totals[k] += mine.sum(0).astype(object)
                counts[k] += len(mine)
        met = [k for k, n in enumerate(counts) if n]
        limbs = [[divmod(int(x), LIMB) for x in totals[k]] for k in met]
        yield pa.RecordBatch.from_arrays([
            pa.array(met, pa.int32()), pa.array([counts[k] for k in met], pa.int64()),
            *[pa.array([[Decimal(x[side]) for x in row] for row in limbs], whole) for side in (0, 1)],
        ], names=["cluster", "n", "high", "low"])

    return run


def _placed(centroids: list[list[int]], pivots: Pivots, width: int):
    """Rows (key, cluster, squared distance; null where it exceeds 63 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, cluster, found = _assigned(batch, centroids, pivots, width)
                listed = [x if x < 2**63 else None for x in found.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(listed, pa.int64())],
                    names=["_key", "cluster", "distance"],
                )

    return run


def kept_vectors(vectors: DataFrame, key: str, embedding: str, width: int) -> DataFrame:
    """Rows (key, vector) whose vector has ``width`` components, all of them finite."""
    sound = F.forall("_vector", lambda x: x.isNotNull() & (F.abs(x) <= LARGEST))
    listed = vectors.select(F.col(key).alias("_key"), F.col(embedding).alias("_vector"))
    return listed.filter(F.coalesce((F.size("_vector") == width) & sound, F.lit(False)))


def start_order(key: Column, salt: str) -> Column:
    """Lower-case hex SHA-256 of the salt and the key in decimal; a null key counts as empty."""
    return F.sha2(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)


def cluster(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding",
    k: int = 8, rounds: int = 10, width: int = 64, salt: str = "3:",
) -> DataFrame:
    """Per kept row ``key, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Components become floor(1024 * x). The ``k`` vectors first by the SHA-256 of
    ``salt`` and key, ties by their components, are the first centroids; fewer
    vectors make fewer centroids. A round assigns every vector to the nearest
    centroid, ties to the smaller number, and moves every centroid that has
    vectors to the floor of their mean. Null and short vectors, and those with a
    component that is null, not finite or beyond a 32-bit float, are left out;
    so an empty table, or one without a kept vector, gives no rows. Every row
    counts for itself, repeated keys and vectors too. A sum or squared distance
    that exceeds 63 bits is reported as null, while assignment stays exact.
    Other columns are not read.

    A round is one pass over the written vectors; tasks send ``k`` sums each.
    The driver holds ``k`` centroids.
    """
    kept = kept_vectors(vectors, key, embedding, width)
    kind = vectors.schema[key].dataType.simpleString()
    vector = vectors.schema[embedding].dataType.simpleString()
    first = kept.orderBy(start_order(F.col("_key"), salt), "_vector").limit(k).select("_vector").collect()
    centroids = [[int(x) for x in row] for row in integers(np.array([r[0] for r in first]).reshape(len(first), width)).tolist()]
    if not centroids:
        shape = f"`{key}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], shape)
    pivots = Pivots(centroids)
    held = pin(kept.mapInArrow(_cached(pivots, width), f"_key {kind}, _vector {vector}, _near array<double>"), "vectors")
    whole = "array<decimal(38,0)>"
    for _ in range(rounds):
        sums = held.mapInArrow(_sums(centroids, pivots, width), f"cluster int, n bigint, high {whole}, low {whole}")
        sides = [F.sum(F.get(side, F.lit(i))).alias(f"{side}{i}") for side in ("high", "low") for i in range(width)]
        for row in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *sides).collect():
            totals = [int(row[f"high{i}"]) * LIMB + int(row[f"low{i}"]) for i in range(width)]
            centroids[row["cluster"]] = [x // row["n"] for x in totals]
    placed = pin(held.mapInArrow(_placed(centroids, pivots, width), f"_key {kind}, cluster int, distance bigint"), "assigned")
    summed = F.sum(F.col("distance").cast("decimal(38,0)"))
    found = placed.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), summed).alias("inertia")).collect()
    by_cluster = {r["cluster"]: None if r["inertia"] is None else int(r["inertia"]) for r in found}
    total = None if None in by_cluster.values() else sum(by_cluster.values())

    def long(x: int | None) -> Column:
        return F.lit(x if x is not None and x < 2**63 else None).cast("bigint")

    def per_cluster(values: list[Column]) -> Column:
        return F.get(F.array(*values), F.col("cluster"))

    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return placed.select(
        F.col("_key").alias(key), "cluster", "distance",
        per_cluster([long(by_cluster.get(j)) for j in range(len(centroids))]).alias("cluster_inertia"),
        long(total).alias("inertia"), per_cluster([F.lit(d) for d in digests]).alias("centroid_sha256"),
    )
