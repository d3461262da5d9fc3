"""N-gram Jaccard join: prefixes of rare shingles singly, of frequent ones in combinations.

Two documents link when their shingle sets have a Jaccard similarity of at least
``percent`` / 100. A set of n may then miss at most e = n - ceil(n * percent / 100)
of its shingles in the other. Shingles are ordered from rare to frequent, by a
sketch of document frequencies of fixed size. Every shingle belongs to a class:
rare ones are indexed singly, frequent ones by pairs and very frequent ones by
triples within small groups, whose number follows from the class of sizes alone,
so that two documents deal a shared shingle to the same group. A group of c prefix
shingles indexed by k at a time stands for c - k + 1 single ones, so prefixes are
extended until these sum up to e + 1: then two linked documents share an index
entry for certain. The smaller of
the two may miss only n - ceil(2 n t / (1 + t)), so its share of the entry lies in
a shorter, inner prefix; entries that are inner for neither form no pair.

Equal sets are one node from the start. Every node is verified against its
strongest neighbour first; others are compared, inside tasks, only where
union-find has not yet joined them (:mod:`chorus.llm.linking`), so a group of
copies never turns into all of its pairs.
"""

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import fresh, repeats, rows_of, rows_without, small_batches, with_text
from chorus.llm.linking import BLOBS, EntryBlobs, folded, linked
from chorus.llm.vector_text import mix, salted, shingle_sets, texts
from chorus.operators.scale import pin

SLOTS = 1 << 18
BLOCKS = 16
#: Sets up to this size are also indexed singly throughout, as their groups may be too small to combine.
TINY = 12
GROUP = 3
VERY_FREQUENT = 7


def _missing(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100


def _missing_smaller(n: np.ndarray, percent: int) -> np.ndarray:
    """The same for the smaller set of a pair, or either of two equally large."""
    return n - (2 * percent * n + 99 + percent) // (100 + percent)


def _nodes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number for every set, equal for equal sets."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(salted(values, 7), dtype=np.uint64)])
    return mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def _sketches(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Per set a parity sketch of two to four slots per shingle."""
    n = np.diff(bounds)
    size = np.maximum(64, 2 ** np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
    ends = np.cumsum(size)
    slot = np.repeat(ends - size, n) + (values & np.repeat(size - 1, n).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(slot, minlength=ends[-1] if len(ends) else 0) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[a // 8:b // 8] for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)]


#: Bytes of the sketch that is looked at first; enough to tell sets of some thousands apart that share little.
COARSE = 64


def _coarse(sketches: list[bytes]) -> list[bytes]:
    return [folded(np.frombuffer(x, np.uint64), min(len(x), COARSE) // 8).tobytes() for x in sketches]


def _survey(k: int, key: str):
    """Rows (key, n, node, sketch, coarse sketch) of every document, and per task what its distinct sets add to the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kind = [key, "_n", "_node", "_bits", "_coarse", "_block", "_counts"], None
        slots, seen = np.zeros(SLOTS, np.uint32), set()
        for batch in batches:
            kind = batch.column(0).type
            for group in texts(batch.column(1)):
                values, bounds = shingle_sets(group, k)
                n, node = np.diff(bounds), _nodes(values, bounds)
                new = np.array([x not in seen for x in node.tolist()], bool)
                seen.update(node.tolist())
                mine = values[np.repeat(new, n)]
                slots += np.bincount((mine >> np.uint64(40)) % np.uint64(SLOTS), minlength=SLOTS).astype(np.uint32)
                rows, sketches = len(group), _sketches(values, bounds)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(group.first, rows), pa.array(n), pa.array(node, mask=n == 0),
                    pa.array(sketches, pa.binary()), pa.array(_coarse(sketches), pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                ], names=names)
        if kind is not None:
            yield pa.RecordBatch.from_arrays([
                pa.nulls(BLOCKS, kind), pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.int64()),
                pa.nulls(BLOCKS, pa.binary()), pa.nulls(BLOCKS, pa.binary()),
                pa.array(range(BLOCKS), pa.int32()),
                pa.array([x.tobytes() for x in slots.reshape(BLOCKS, -1)], pa.binary()),
            ], names=names)

    return run


def _levels(survey: DataFrame) -> np.ndarray:
    """Per slot of the sketch: 0 for what chance explains, else the log2 of its excess (one number per slot)."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLOTS // BLOCKS, np.uint64)
        for x in group["_counts"]:
            total += np.frombuffer(x, np.uint32)
        return pd.DataFrame({"block": [int(group["_block"].iloc[0])], "counts": [total.tobytes()]})

    summed = survey.filter(F.col("_block").isNotNull()).select("_block", "_counts").groupBy("_block").applyInPandas(
        add, "block int, counts binary"
    )
    total = np.zeros(SLOTS, np.uint64)
    for row in summed.collect():
        size = SLOTS // BLOCKS
        total[row.block * size:(row.block + 1) * size] = np.frombuffer(row.counts, np.uint64)
    usual = float(np.median(total))
    excess = total - usual - 6 * np.sqrt(usual) - 8
    return np.where(excess > 0, 1 + np.log2(np.maximum(excess, 1) / 16 + 1), 0).astype(np.uint8)


@cache
def _combined(size: int, k: int) -> np.ndarray:
    return np.array(list(combinations(range(size), k)), int).reshape(-1, k)


@cache
def _groups(space: int, percent: int) -> int:
    """How many groups every set of a space of sizes has: by what its largest set needs, yet so few
    that its smallest, less two per triple group and one per pair group, still has what it needs."""
    if percent == 100:
        return 1
    least, most = (int((100 / percent) ** (space + i)) for i in (-1, 1))
    return max(1, min(-(-(int(_missing(most, percent)) + 1) // GROUP), (-(-least * percent // 100) - 1) // 3))


def _combination_entries(
    values: np.ndarray, level: np.ndarray, needed: int, inner: int, space: int, groups: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of the frequent shingles of one set, in one space of sizes, and which are inner."""
    order = np.lexsort((values, level))
    values, level = values[order], level[order]
    k = np.where(level < VERY_FREQUENT, 2, 3)
    group = (values % np.uint64(groups)).astype(int) * 2 + (k - 2)
    by_group = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.r_[True, group[by_group][1:] != group[by_group][:-1]])
    nth = np.empty(len(values), int)
    nth[by_group] = np.arange(len(values)) - np.repeat(starts, np.diff(np.r_[starts, len(values)]))
    reached = np.cumsum(nth >= k - 1)
    stop = int(np.searchsorted(reached, needed)) + 1
    inside = int(np.searchsorted(reached, inner)) + 1 if inner > 0 else 0
    values, group, k = values[:stop], group[:stop], k[:stop]
    spread = mix(values)
    by_group = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.r_[True, group[by_group][1:] != group[by_group][:-1]])
    out, within = [], []
    for members in np.split(by_group, starts[1:]):
        size = int(k[members[0]])
        if len(members) >= size:
            chosen = members[_combined(len(members), size)]
            out.append(spread[chosen].sum(1, dtype=np.uint64) + np.uint64(size))
            within.append(chosen.max(1) < inside)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    return salted(np.concatenate(out), space + 101), np.concatenate(within)


def entries(
    values: np.ndarray, bounds: np.ndarray, levels: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index entries of all sets, the number of the set each belongs to, and which are inner."""
    n = np.diff(bounds)
    needed, inner = _missing(n, percent) + 1, _missing_smaller(n, percent) + 1
    owner = np.repeat(np.arange(len(n)), n)
    level = levels[((values >> np.uint64(40)) % np.uint64(SLOTS)).astype(np.int64)]
    rare = level == 0
    nth = np.cumsum(rare)
    first = np.concatenate([[0], nth])[bounds[:-1]]
    n_rare = np.concatenate([[0], nth])[bounds[1:]] - first
    nth = nth - np.repeat(first, n)
    single = rare & (nth <= np.repeat(needed, n))
    out, of, within = [salted(values[single], 1)], [owner[single]], [(nth <= np.repeat(inner, n))[single]]
    for i in np.flatnonzero((n_rare < needed) & (n > 0)).tolist():
        a, b = bounds[i], bounds[i + 1]
        often = ~rare[a:b]
        space = int(log(n[i]) / log(100 / percent)) if percent < 100 else int(n[i])
        for s in (space, space + 1):
            wanted = (int(needed[i] - n_rare[i]), int(inner[i] - n_rare[i]))
            got, close = _combination_entries(values[a:b][often], level[a:b][often], *wanted, s, _groups(s, percent))
            out.append(got)
            of.append(np.full(len(got), i))
            within.append(close)
    # below a percentage of 50, sets of three shingles in common at least have larger partners
    for i in np.flatnonzero((n > 0) & (n <= max(TINY, 30_000 // percent**2))).tolist():
        a, b = bounds[i], bounds[i + 1]
        got = salted(values[a:b][np.lexsort((values[a:b], level[a:b]))][:needed[i]], 2)
        out.append(got)
        of.append(np.full(len(got), i))
        within.append(np.arange(len(got)) < inner[i])
    return np.concatenate(out), np.concatenate(of), np.concatenate(within)


def _index(k: int, percent: int, levels, shards: int):
    """Blobs of (entry, node, n), one per task and shard; a set met again in the task soon adds nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = EntryBlobs(shards), set()  # what has been given out is forgotten
        for batch in batches:
            for group in texts(batch.column(0)):
                values, bounds = shingle_sets(group, k)
                n, node = np.diff(bounds), _nodes(values, bounds)
                new, met = np.zeros(len(n), bool), node
                for i, x in enumerate(node.tolist()):
                    if n[i] and x not in seen:
                        seen.add(x)
                        new[i] = True
                values = values[np.repeat(new, n)]
                n, node = n[new], node[new]
                entry, of, inner = entries(values, np.concatenate([[0], np.cumsum(n)]), levels.value, percent)
                if held.add(entry, node[of], n[of], inner, met):
                    yield from held.out()
                    seen.clear()
        yield from held.out()

    return run


def _packed_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in texts(batch.column(0)):
                values, bounds = shingle_sets(group, k)
                nodes, cuts = _nodes(values, bounds), bounds.tolist()
                packed = [values[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(packed, pa.binary())], names=["node", "packed"])

    return run


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint64)


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """The packed sets of the nodes wanted, each from one document at least that holds it."""
    held = nodes.join(wanted, "node", "left_semi")
    ids = pin(held.select(F.col("rep").alias(key)).distinct(), "holders")
    sets = rows_of(docs.select(key, text), ids, key).select(text).mapInArrow(_packed_sets(k), "node bigint, packed binary")
    return sets.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row ``key, n_shingles, component_id``.

    Sets hold the distinct runs of ``k`` words (anything but space and U+0009 to
    U+000D, A to Z lowered) of the whole text, or all its words as one run if
    they are fewer. Rows link when 100 * intersection >= ``percent`` * union;
    ``component_id`` is the smallest key reachable by links. Texts without a word
    (null, empty, blank) link with nothing and keep their own key. Every row is
    judged for itself: rows repeating a key may differ in component, a null key
    never names a component unless all in it are null. Shingles are compared by
    64-bit hashes. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    name, docs = key, docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    docs = small_batches(docs)
    key, text, asked = "_key", "_text", docs
    kind = docs.schema[key].dataType.simpleString()
    shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    survey = pin(
        asked.mapInArrow(_survey(k, key), f"`{key}` {kind}, _n bigint, _node bigint, _bits binary, _coarse binary, _block int, _counts binary"), "survey"
    )
    levels = spark.sparkContext.broadcast(_levels(survey))
    seen = survey.filter(F.col("_block").isNull()).select(key, "_n", "_node")
    nodes = survey.filter(F.col("_node").isNotNull()).groupBy(F.col("_node").alias("node")).agg(
        F.min(key).alias("rep"), F.first("_n").alias("n"), F.first("_bits").alias("bits"),
        F.first("_coarse").alias("coarse"),
    )
    nodes = pin(nodes, "nodes")

    blobs = docs.select(text).mapInArrow(_index(k, percent, levels, shards), BLOBS)
    joined = linked(
        blobs, lambda wanted: _sets(docs, nodes, wanted, key, text, k), _unpacked, percent, nodes.select("node", "n", "bits", "coarse")
    )
    placed = nodes.join(joined, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    placed = pin(placed, "placed")
    least = placed.groupBy("root").agg(F.min("rep").alias("least"))
    named = placed.join(least, "root").select(F.col("node").alias("_node"), F.col("least").alias("_least"))
    return seen.join(named, "_node", "left").select(
        F.col(key).alias(name), F.col("_n").alias("n_shingles"), F.coalesce("_least", key).alias("component_id")
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose key names their component: one document of each, and those with null keys.

    Rows that share a key but not their text are judged each for itself.
    """
    if not repeats(docs, key):
        found = near_duplicates(docs, k, percent, key, text).filter(F.col(key) != F.col("component_id"))
        return rows_without(docs, pin(found.select(key).distinct(), "copies"), key)
    mark = fresh(docs.columns, "mark")[0]
    # null keys last, so that they name no component with others in it
    marked = docs.withColumn(mark, F.struct(F.col(key).isNull().alias("none"), with_text(key, text).alias("row")))
    found = near_duplicates(marked, k, percent, mark, text)
    found = found.filter(F.col(mark)["row"]["k"] != F.col("component_id")["row"]["k"])
    return rows_without(marked, pin(found.select(mark).distinct(), "copies"), mark).select(*docs.columns)
