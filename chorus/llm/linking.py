"""From index entries to components, without ever forming all pairs of a group.

Entries come as blobs, one row per task and shard, so that a shuffle moves few
rows. The hub of an entry is its node with most copies: variants of one text are
closer to it than to each other. At first every node is verified against the hub
it shares most entries with. Two nodes of an entry share its hub, so what is left
lies around hubs whose nodes are not all in one component yet. These nodes meet
with their sets, in blocks, and are compared where they lie: sizes and parity
sketches rule pairs out exactly, the rest is verified at once, and pairs that
union-find has joined meanwhile are skipped. No row per pair is made; a task gives
out fewer links than it has components.

The parity sketch of a set has a bit per slot, set if an odd number of members
fall into it. Two sketches differ in no more bits than the sets differ in members.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.components import components
from chorus.operators.scale import pin

ROWS_AT_ONCE = 1_000_000
#: Nodes that share a hub and meet in one task, and bytes of their packed sets.
BLOCK_NODES, BLOCK_BYTES = 2_048, 4 << 20
MOST_BITS = 8_192
BLOBS = "shard int, entry binary, node binary, n binary, weight binary"


class EntryBlobs:
    """Gathers (entry, node, size) in a task and gives them out, with each node's copies, as one row per shard."""

    def __init__(self, shards: int):
        self.shards, self.held, self.met, self.rows = shards, [], [], 0

    def add(self, entry: np.ndarray, node: np.ndarray, n: np.ndarray, inner: np.ndarray, met: np.ndarray) -> bool:
        """``met`` names the node of every text, copies too. True if so much is held that :meth:`out` is due."""
        self.held.append((entry, node, (2 * n + inner).astype(np.int32)))
        self.met.append(met)
        self.rows += len(entry)
        return self.rows > ROWS_AT_ONCE

    def out(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        columns = [np.concatenate(x) for x in zip(*self.held, strict=True)]
        nodes, copies = np.unique(np.concatenate(self.met), return_counts=True)
        columns.append(copies[np.searchsorted(nodes, columns[1])].astype(np.int32))
        self.held, self.met, self.rows = [], [], 0
        shard = (columns[0] % np.uint64(self.shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        which, starts = np.unique(shard[order], return_index=True)
        bounds = [*starts.tolist(), len(order)]
        columns = [c[order] for c in columns]
        cells = [[c[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)] for c in columns]
        yield pa.RecordBatch.from_arrays(
            [pa.array(which), *[pa.array(c, pa.binary()) for c in cells]], names=["shard", "entry", "node", "n", "weight"]
        )


def shared_entries(group: pd.DataFrame) -> pd.DataFrame:
    """The part of a shard in which an entry has two nodes or more, sorted by entry, the hub first."""
    entry, node, n, weight = (
        np.concatenate([np.frombuffer(x, kind) for x in group[name]])
        for name, kind in (("entry", np.uint64), ("node", np.int64), ("n", np.int32), ("weight", np.int32))
    )
    order = np.lexsort((node, entry))
    entry, node, n = entry[order], node[order], n[order]
    new = np.ones(len(entry), bool)
    new[1:] = (entry[1:] != entry[:-1]) | (node[1:] != node[:-1])
    weight = np.add.reduceat(weight[order].astype(np.int64), np.flatnonzero(new)) if len(entry) else weight
    entry, node, n = entry[new], node[new], n[new]
    order = np.lexsort((node, -weight, entry))
    entry, node, n = entry[order], node[order], n[order]
    same = np.zeros(len(entry) + 1, bool)
    same[1:-1] = entry[1:] == entry[:-1]
    shared = same[1:] | same[:-1]
    runs = np.cumsum(~same[:-1]) - 1 if len(entry) else np.zeros(0, int)
    if len(entry):
        shared &= np.bincount(runs, n % 2).astype(bool)[runs]
    columns = (entry[shared].view(np.int64), node[shared], n[shared])
    return pd.DataFrame({k: [c.tobytes()] for k, c in zip(("entry", "node", "n"), columns, strict=True)})


def _unblob(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for e, v, n in zip(frame["entry"], frame["node"], frame["n"], strict=True):
        yield np.frombuffer(e, np.int64), np.frombuffer(v, np.int64), np.frombuffer(n, np.int32)


def _may_pair(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """By sizes and inner marks, packed as twice the size plus the mark."""
    n, m = x.astype(np.int64) // 2, y.astype(np.int64) // 2
    inner = np.where(n < m, x % 2, np.where(m < n, y % 2, x % 2 | y % 2)).astype(bool)
    return inner & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def _stars(percent: int):
    """Per shard: every node with the hubs of its entries, and in how many entries the two may link."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for entry, node, n in _unblob(frame):
                if not len(entry):
                    continue
                starts = np.flatnonzero(np.r_[True, entry[1:] != entry[:-1]])
                hub = np.repeat(starts, np.diff(np.r_[starts, len(entry)]))
                a, b = node[hub], node
                may = (a != b) & _may_pair(n, n[hub], percent)
                order = np.lexsort((a, b))
                a, b, may = a[order], b[order], may[order]
                new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
                yield pd.DataFrame({"a": a[new], "b": b[new], "met": np.add.reduceat(may.astype(np.int64), new)})

    return run


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Members that two sorted sets share."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def links(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = common(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def parity(values: np.ndarray, bits: int) -> np.ndarray:
    counts = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").view(np.uint64)


def _against_hubs(unpack: Callable[[bytes], np.ndarray], percent: int):
    """Rows come sorted by hub and part, the hub's own set (b is null) first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, None
        for batch in batches:
            keep = []
            for a, part, b, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if b is None:
                    at, hub = (a, part), unpack(packed)
                keep.append(b is not None and at == (a, part) and links(hub, unpack(packed), percent))
            yield batch.select([0, 2]).filter(pa.array(keep, pa.bool_()))

    return run


def with_hubs(
    pairs: DataFrame, fetch: Callable[[DataFrame], DataFrame], unpack: Callable[[bytes], np.ndarray], percent: int
) -> DataFrame:
    """The pairs (a, b) whose sets link. A hub ``a`` of many pairs is dealt in parts, its set sent once to each."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = pin(fetch(pin(nodes, "wanted")), "sets")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("parts"))
    parts = pin(parts, "hubs")
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    own = parts.join(sets.withColumnRenamed("node", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("bigint").alias("b"), "packed"
    )
    others = pairs.join(parts, "a").select("a", part, "b").join(sets.withColumnRenamed("node", "b"), "b")
    laid = own.unionByName(others.select("a", "part", "b", "packed")).repartition("a", "part")
    laid = laid.sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return laid.mapInArrow(_against_hubs(unpack, percent), "a bigint, b bigint")


FEW = 12


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows (a, low, high, ...), which come sorted, as one list per first three columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:3] != key:
                if held:
                    yield key, held
                key, held = row[:3], []
            held.append(row[3:])
    if held:
        yield key, held


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """A sketch of fewer slots, still by parity."""
    return sketch if len(sketch) == words else np.bitwise_xor.reduce(sketch.reshape(-1, words))


def may_link(n: np.ndarray, m: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m members that differ in at least ``differ`` of them can reach the threshold."""
    return differ <= n + m - 2 * -(-percent * (n + m) // (100 + percent))


def _screened(percent: int):
    """Rows (a, b, root) of nodes with a partner in the group that sizes and parity sketches leave open."""

    def open_ones(key: tuple, rows: list[tuple]) -> np.ndarray:
        rows.sort(key=lambda r: r[3])
        root, block, n = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
        own = [np.frombuffer(r[4], np.uint64) for r in rows]
        keep, at = np.zeros(len(rows), bool), {}
        for i in range(len(rows)):
            last = int(np.searchsorted(n, n[i] * 100 // percent, "right"))
            able = root[i + 1:last] != root[i]
            if key[1] != key[2]:
                able &= block[i + 1:last] != block[i]
            near = i + 1 + np.flatnonzero(able)
            if not len(near):
                continue
            words = len(own[i])  # no larger set has fewer
            if len(near) <= FEW:
                others = np.stack([folded(own[j], words) for j in near.tolist()])
            else:
                if words not in at:
                    at[words] = np.zeros((len(rows), words), np.uint64)
                    for j in range(i, len(rows)):
                        at[words][j] = folded(own[j], words)
                others = at[words][near]
            differ = np.bitwise_count(others ^ own[i]).sum(1, dtype=np.int64)
            left = near[may_link(n[near], n[i], differ, percent)]
            if len(left):
                keep[left] = keep[i] = True
        return np.flatnonzero(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _groups(batches):
            left = [rows[i] for i in open_ones(key, rows).tolist()]
            if left:
                columns = [[key[0]] * len(left), [r[0] for r in left], [r[1] for r in left]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["a", "b", "root"])

    return run


def _within(unpack: Callable[[bytes], np.ndarray], percent: int):
    """Links between different components among the nodes of one block, or of two."""

    def links_of(key: tuple, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        up: dict[int, int] = {r[1]: r[1] for r in rows}

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        rows = sorted(((unpack(r[3]), *r[:3]) for r in rows), key=lambda r: len(r[0]))
        sets, node, root, block = zip(*rows, strict=True)
        n, roots, blocks = (np.array(x) for x in ([len(x) for x in sets], root, block))
        sketch = None
        if len(sets) > FEW:
            bits = min(MOST_BITS, max(64, 1 << int(2 * np.median(n)).bit_length()))
            sketch = np.stack([parity(x, bits) for x in sets])
        apart = len(up)
        for i in range(len(sets)):
            if apart == 1:
                return
            last = int(np.searchsorted(n, n[i] * 100 // percent, "right"))
            able = roots[i + 1:last] != root[i]
            if key[1] != key[2]:
                able &= blocks[i + 1:last] != block[i]
            near = i + 1 + np.flatnonzero(able)
            if sketch is not None and len(near):
                differ = np.bitwise_count(sketch[near] ^ sketch[i]).sum(1, dtype=np.int64)
                fits = may_link(n[near], n[i], differ, percent)
                near = near[fits][np.argsort(differ[fits], kind="stable")]
            for j in near.tolist():
                x, y = find(root[i]), find(root[j])
                if x != y and links(sets[i], sets[j], percent):
                    up[x] = y
                    apart -= 1
                    yield node[i], node[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _groups(batches):
            found = list(links_of(key, rows))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    return run


def _dealt(rest: DataFrame, held: DataFrame, size: str, *columns: str) -> DataFrame:
    """The nodes around each hub with what is held of them, in blocks of bounded size, every two blocks together."""
    sized = rest.select("a", "b").join(held.select("b", F.octet_length(size).alias("size")), "b")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("size") / BLOCK_BYTES)).cast("int").alias("blocks")
    blocks = pin(sized.groupBy("a").agg(blocks), "blocks")
    placed = rest.join(blocks, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
    other = placed.select("a", "b", "root", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    both = other.join(held, "b").select(
        "a", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "b", "root", "block", *columns
    )
    return both.repartition("a", "low", "high").sortWithinPartitions("a", "low", "high")


def linked(
    blobs: DataFrame, fetch: Callable[[DataFrame], DataFrame], unpack: Callable[[bytes], np.ndarray], percent: int,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """``node, root`` of all nodes that a verified pair names.

    ``fetch`` takes nodes and gives each one's packed set once, ``unpack`` makes it
    a sorted array of distinct numbers. ``sketches``, for large sets, holds
    ``node, n`` and two sketches, ``coarse`` and ``bits``: with it, sets move only
    where sketches, the short one first, leave a pair open.
    Pairs whose sizes in the blobs rule out ``percent`` are not formed with a hub;
    pass equal sizes to form all.
    """
    shared = pin(blobs.groupBy("shard").applyInPandas(shared_entries, "entry binary, node binary, n binary"), "entries")
    stars = shared.mapInPandas(_stars(percent), "a bigint, b bigint, met bigint")
    stars = pin(stars.groupBy("b", "a").agg(F.sum("met").alias("met")), "stars")
    best = stars.filter("met > 0").groupBy("b").agg(F.max_by("a", F.struct("met", "a")).alias("best"))
    best = pin(best, "pairs")
    first = best.select(F.col("best").alias("a"), "b")
    if sketches is not None:
        first = pin(_close(first, sketches, percent), "close")
    found = pin(with_hubs(first, fetch, unpack, percent), "links")

    joined = components(found).select(F.col("node").alias("b"), "root")
    rooted = stars.join(joined, "b", "left").join(best, "b", "left").select(
        "a", "b", F.coalesce("root", "b").alias("root"), F.coalesce(F.col("a") == F.col("best"), F.lit(False)).alias("tried")
    )
    rooted = pin(rooted, "rooted")
    spread = rooted.groupBy("a").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n"), F.count_if("tried").alias("tried")
    ).filter("least < most AND NOT (n = 2 AND tried = 1)")  # a lone pair has been compared
    rest = pin(rooted.join(spread.select("a"), "a", "left_semi").select("a", "b", "root"), "rest")
    if sketches is not None:
        held = sketches.withColumnRenamed("node", "b")
        for sketch in ("coarse", "bits"):
            laid = _dealt(rest, held, sketch, "n", sketch)
            rest = pin(laid.mapInArrow(_screened(percent), "a bigint, b bigint, root bigint").distinct(), "rest")
    sets = pin(fetch(pin(rest.select(F.col("b").alias("node")).distinct(), "wanted")), "sets").withColumnRenamed("node", "b")
    more = _dealt(rest, sets, "packed", "packed").mapInArrow(_within(unpack, percent), "a bigint, b bigint")
    return components(found.unionByName(pin(more, "links")))


def _close(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs that sketches leave open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                differ = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
                keep.append(bool(may_link(n, m, differ, percent)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    of = [sketches.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab"]
    marked = pairs.join(of[0], "a").join(of[1], "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return marked.mapInArrow(run, "a bigint, b bigint")
