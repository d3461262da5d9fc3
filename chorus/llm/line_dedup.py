"""Fuzzy line dedup: MinHash over character shingles, exact verification, union-find, one line per component.

Equal lines are one node from the start, named by a hash. Distinct lines get a
one-permutation MinHash of ``BANDS * DEPTH`` bins (empty bins borrow from full
ones), cut into bands that serve as index entries.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import fresh, repeats, rows_of, small_batches, with_text
from chorus.llm.linking import BLOBS, EntryBlobs, linked
from chorus.llm.vector_text import IS_SPACE, Texts, _grown, _ranges, mix, salted, texts
from chorus.operators.scale import lookup, pin

SHINGLE_CHARS = 8
PERCENT = 80
#: 15 bands of 5: a pair at 0.8 is met with 1 - (1 - 0.8 ** 5) ** 15 = 99.7 %.
BANDS, DEPTH = 15, 5
#: Characters worked on at a time, few enough for their arrays to stay in a processor's cache.
CHARS_AT_ONCE = 1 << 17
EMPTY = np.iinfo(np.uint64).max
_BASE = 0xD6E8FEB86659FD93
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def characters(raw: bytes) -> np.ndarray:
    """The characters of UTF-8 text as numbers."""
    return np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)


def _values(chars: np.ndarray) -> np.ndarray:
    """A hash of every character, A to Z lowered."""
    low = chars + np.uint32(32) * ((chars >= 65) & (chars <= 90))
    x = (low.astype(np.uint64) + np.uint64(1)) * _SPREAD
    return x ^ (x >> np.uint64(29))


def runs(values: np.ndarray) -> np.ndarray:
    """Hash of the ``SHINGLE_CHARS`` (a power of two) values from every place on, as far as there are so many."""
    out, reach, base = values, 1, _BASE
    while reach < SHINGLE_CHARS:
        n = max(len(values) - 2 * reach + 1, 0)
        out = out[:n] * np.uint64(base) + out[reach:reach + n]
        reach, base = 2 * reach, base * base % 2**64
    return mix(out)


def whole(values: np.ndarray) -> np.ndarray:
    """The only shingle of a line too short for one."""
    out = np.zeros(1, np.uint64)
    for x in values:
        out = out * np.uint64(_BASE) + x
    return salted(out, len(values))


class Lines:
    """The lines of some texts: line ``i`` is ``chars[starts[i]:ends[i]]``, hashed with A to Z lowered."""

    def __init__(self, group: Texts):
        self.text = group.data.tobytes().decode()
        chars = self.chars = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        offsets = group.offsets
        if len(chars) != len(group.data):  # UTF-8 marks all but the first byte of a character
            offsets = np.concatenate([[0], np.cumsum((group.data & 0xC0) != 0x80)])[offsets]
        first = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(chars == 10) + 1]))
        # a text may end in a break, and empty texts share their place with the next one
        owner = np.searchsorted(offsets, first, "right") - 1
        inside = first < len(chars)
        self.starts, self.owner = first[inside], owner[inside]
        ends = np.append(self.starts[1:], len(chars))[:len(self.starts)]
        self.ends = ends - (chars[np.maximum(ends - 1, 0)] == 10) if len(ends) else ends
        self.number = np.arange(len(self.starts)) - np.searchsorted(self.owner, self.owner)
        worded = np.concatenate([[0], np.cumsum(~IS_SPACE[np.minimum(chars, 255)])])
        self.worded = worded[self.ends] > worded[self.starts]
        self.values = _values(chars)

    def shingles(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of the lines of these numbers, and whose they are, counted from 0."""
        begin, size = self.starts[lines], (self.ends - self.starts)[lines]
        n = np.maximum(size - SHINGLE_CHARS + 1, 0)
        out = runs(self.values)[np.repeat(begin, n) + _ranges(n)]
        owner = np.repeat(np.arange(len(lines)), n)
        short = np.flatnonzero(n == 0)
        if len(short):
            more = [whole(self.values[a:a + k]) for a, k in zip(begin[short].tolist(), size[short].tolist(), strict=True)]
            out, owner = np.concatenate([out, *more]), np.concatenate([owner, short])
        return out, owner

    def nodes(self) -> np.ndarray:
        """A number for every line, equal for equal lines."""
        powers, inverses = _grown(len(self.values))
        prefix = np.zeros(len(self.values) + 1, np.uint64)
        np.cumsum(self.values * powers[:len(self.values)], out=prefix[1:])
        content = mix((prefix[self.ends] - prefix[self.starts]) * inverses[self.starts])
        return salted(content + (self.ends - self.starts).astype(np.uint64), 3).view(np.int64)


def signatures(shingle: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """One-permutation MinHash: the smallest hash in each bin; an empty bin copies one found by hashing its number."""
    bins = BANDS * DEPTH
    out = np.full((n, bins), EMPTY, np.uint64)
    flat = out.reshape(-1)
    where = owner * bins + ((shingle >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(flat, where, shingle)
    full = out != EMPTY
    rows, cols = np.nonzero(~full)
    turn = 0
    while len(rows):
        turn += 1
        pick = (salted(cols.astype(np.uint64), 1000 + turn) % np.uint64(bins)).astype(int)
        hit = full[rows, pick]
        out[rows[hit], cols[hit]] = out[rows[hit], pick[hit]] + np.uint64(turn)
        rows, cols = rows[~hit], cols[~hit]
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    entry = np.zeros((len(signature), BANDS), np.uint64)
    for j in range(DEPTH):
        entry = entry * np.uint64(_BASE) + signature[:, j::DEPTH]
    return salted(entry, 9) + np.arange(BANDS, dtype=np.uint64)


def _index(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = EntryBlobs(shards), set()  # lines met again soon add nothing
        for batch in batches:
            for group in texts(batch.column(0), CHARS_AT_ONCE):
                lines = Lines(group)
                node = lines.nodes()
                new = []
                for i in np.flatnonzero(lines.worded).tolist():
                    x = int(node[i])
                    if x not in seen:
                        seen.add(x)
                        new.append(i)
                new = np.array(new, int)
                shingle, owner = lines.shingles(new)
                entry = bands(signatures(shingle, owner, len(new)))
                of = np.repeat(node[new], BANDS)
                ones = np.ones(len(of), int)
                if held.add(entry.reshape(-1), of, ones, ones.astype(bool), node[lines.worded]):
                    yield from held.out()
                    seen.clear()
        yield from held.out()

    return run


def _places(key: str):
    """Rows (key, line, node) of all lines with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in texts(batch.column(1), CHARS_AT_ONCE):
                lines = Lines(group)
                node = lines.nodes()
                w = lines.worded
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(lines.owner[w] + group.first)),
                    pa.array(lines.number[w].astype(np.int32)), pa.array(node[w]),
                ], names=[key, "_line", "_node"])

    return run


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, line) of all lines with a word, equal ones of a few texts once."""
    for batch in batches:
        for group in texts(batch.column(0), CHARS_AT_ONCE):
            lines = Lines(group)
            w = np.flatnonzero(lines.worded)
            node, first = np.unique(lines.nodes()[w], return_index=True)
            bounds = zip(lines.starts[w[first]].tolist(), lines.ends[w[first]].tolist(), strict=True)
            written = pa.array([lines.text[a:b].encode() for a, b in bounds], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(node), written], names=["node", "packed"])


def line_set(raw: bytes) -> np.ndarray:
    """The sorted, distinct shingles of one line."""
    values = _values(characters(raw))
    return np.unique(runs(values)) if len(values) >= SHINGLE_CHARS else whole(values)


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", gone_name: str = "gone") -> DataFrame:
    """``key`` and ``gone_name``: per document with any, the numbers (from 0) of the lines to remove.

    Lines end at U+000A. Lines with A to Z lowered link when their sets of
    8-character runs (the whole line if shorter) reach a Jaccard similarity of
    0.8; of each component the line with the smallest key, then number, stays.
    Blank lines are no lines here. Line numbers are gathered by key, so a key,
    null included, must name one text.
    """
    name, asked = key, small_batches(docs).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind, key, text = docs.schema[key].dataType.simpleString(), "_key", "_text"
    shards = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    places = pin(asked.mapInArrow(_places(key), f"`{key}` {kind}, _line int, _node bigint"), "lines")
    where = F.struct(F.col(key).alias("k"), F.col("_line").alias("l"))
    nodes = places.groupBy(F.col("_node").alias("node")).agg(F.min(where).alias("first"), F.count("*").alias("times"))
    nodes = pin(nodes, "nodes")

    def fetch(wanted: DataFrame) -> DataFrame:
        holders = nodes.join(wanted, "node", "left_semi").select(F.col("first.k").alias(key)).distinct()
        held = rows_of(asked, pin(holders, "holders"), key).select(text)
        found = held.mapInArrow(_written, "node bigint, packed binary").join(wanted, "node", "left_semi")
        return found.dropDuplicates(["node"])

    joined = linked(asked.select(text).mapInArrow(_index(shards), BLOBS), fetch, line_set, PERCENT)
    rooted = nodes.join(joined, "node", "left").select("node", "first", "times", F.coalesce("root", "node").alias("root"))
    rooted = pin(rooted, "rooted")
    sizes = rooted.groupBy("root").agg(F.min("first").alias("stays"), F.sum("times").alias("all"))
    repeated = rooted.join(sizes.filter(F.col("all") > 1), "root").select(
        F.col("node").alias("_node"), "stays", F.col("times").alias("_times")
    )
    met = lookup(places, pin(repeated, "repeated"), ["_node"], load="_times")
    gone = met.filter(~where.eqNullSafe(F.col("stays")))
    return gone.groupBy(F.col(key).alias(name)).agg(F.array_sort(F.collect_set("_line")).alias(gone_name))


def without_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", gone: str = "gone") -> DataFrame:
    """The rows with a column ``gone``, the numbers of their removed lines if any, and the others in ``text``.

    Rows that share a key, null included, are one document if they share their text, else several.
    """
    mark, every, rest = fresh([*docs.columns, gone], "mark", "lines", "rest")
    marked = docs.withColumn(mark, with_text(key, text) if repeats(docs, key) else F.col(key))
    found = repeated_lines(marked, mark, text, gone)
    table = pin(found.select(F.struct(F.col(mark)).alias(mark), gone), "gone")
    joined = lookup(marked.withColumn(mark, F.struct(F.col(mark))), table, [mark], how="left")
    cut = joined.withColumn(every, F.split(F.coalesce(text, F.lit("")), "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(gone))
    cleaned = F.array_join(F.transform(kept, lambda i: F.get(every, i)), "\n")
    return cut.withColumn(rest, F.when(F.col(gone).isNull(), F.col(text)).otherwise(cleaned)).select(
        *[F.col(c) if c != text else F.col(rest).alias(text) for c in docs.columns], gone
    )


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key, n_lines`` (with a word), ``n_removed`` and a digest of the text that remains."""
    asked = docs.select(key, text)
    n_lines = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")))
    counted = asked.withColumn("n_lines", n_lines.cast("bigint"))
    left = without_lines(counted, key, text)
    return left.select(
        key, "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str = "n_chars") -> DataFrame:
    """The rows without their repeated lines; rows that lose all their words go, others keep every column.

    A column named ``size`` follows the new text. Rows that had no word, null
    texts included, stay as they are. An empty table stays empty.
    """
    gone = fresh(docs.columns, "gone")[0]
    left = without_lines(docs, key, text, gone)
    worded = F.col(text).rlike(r"[^ \t\n\x0B\f\r]")
    kept = left.filter(F.col(gone).isNull() | worded)
    if size in docs.columns:
        new = F.length(text).cast(docs.schema[size].dataType)
        kept = kept.withColumn(size, F.when(F.col(gone).isNull(), F.col(size)).otherwise(new))
    return kept.select(*docs.columns)
