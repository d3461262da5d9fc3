"""Substring dedup by prefix-partitioned suffix trees over words.

Only windows of ``width`` consecutive words matter, so a suffix is cut there and
a document has one for every window. A suffix belongs to the partition of its
prefix, of variable length: it runs from the suffix's start to the end of its
anchor, the leftmost smallest hash among the runs of ``ANCHOR`` words inside the
window. Equal windows have equal prefixes. Neighbouring windows mostly share
their anchor, and anchors name partitions, so suffixes travel as one stretch of
words for some twenty of them. A partition then is a forest of small suffix
trees: its suffixes are sorted by prefix doubling, neighbours' common prefixes
measured, and every internal node at least ``width`` words deep is a repeat whose
smallest document is read off its leaves.

Before any text moves, stretches are counted by fingerprint: those whose anchor
is found in one document only cannot repeat, equal stretches are one with its
smallest document, and only one of each goes to a tree. A partition of more than
``MOST`` stretches has its prefixes lengthened to the whole window. Then every
tree is one path, and the smallest document is a plain minimum, which Spark
combines before the shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import small_batches
from chorus.llm.vector_text import _BASE, _INVERSE, Texts, _ranges, mix, salted, texts
from chorus.operators.scale import lookup, pin

WIDTH = 50
ANCHOR = 8
#: Stretches of one partition that make a tree in one task, and stretches sorted together.
MOST = 8_192


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from every place on, as far as there are so many."""
    out = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + words[j:j + len(out)]
    return mix(out)


def leftmost_least(values: np.ndarray, span: int) -> np.ndarray:
    """For every place the index of the leftmost smallest of ``span`` values from there on."""
    at, reach = np.arange(len(values)), 1
    while reach < span:
        step = min(reach, span - reach)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        reach += step
    return at


class Stretches:
    """Runs of windows with a common anchor, in a group of whole texts."""

    def __init__(self, group: Texts, width: int = WIDTH, anchor: int = ANCHOR):
        self.words, self.counts = group.words(lower=False)
        self.starts, self.ends, _ = group.spans()
        n, self.width = np.diff(self.counts), width
        per = np.maximum(n - width + 1, 0)
        window = np.repeat(self.counts[:-1], per) + _ranges(per)
        owner = np.repeat(np.arange(len(n)), per)
        anchor = min(anchor, width)
        hashed = run_hashes(self.words, anchor)
        least = leftmost_least(hashed, width - anchor + 1)
        at = least[window] if len(window) else window
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])]) if len(at) else np.zeros(0, int)
        self.doc, self.begin = owner[first], window[first]
        self.windows = np.diff(np.r_[first, len(at)])
        self.key = hashed[at[first]] if len(first) else np.zeros(0, np.uint64)
        self._prefix = np.concatenate([
            np.zeros(1, np.uint64), np.cumsum(self.words * _powers(_BASE, len(self.words)), dtype=np.uint64)
        ])
        self._back = _powers(_INVERSE, len(self.words) + 1)
        self.print = salted(self.content(self.begin, self.windows + width - 1) + self.windows.astype(np.uint64), 11)
        self.at = self.begin - self.counts[self.doc]

    def content(self, begin: np.ndarray, n) -> np.ndarray:
        """Hash of ``n`` words from each place."""
        return mix((self._prefix[begin + n] - self._prefix[begin]) * self._back[begin])

    def written(self, data: bytes, i: int) -> bytes:
        """The words of stretch ``i`` as they stand in the text."""
        return data[self.starts[self.begin[i]]:self.ends[self.begin[i] + self.windows[i] + self.width - 2]]


def _rows(wanted: np.ndarray, batch: pa.RecordBatch, group: Texts, stretches: Stretches, *columns: int) -> list[pa.Array]:
    rows = pa.array(stretches.doc[wanted] + group.first)
    return [batch.column(c).take(rows) for c in columns]


def _found(width: int):
    """Rows (doc, text print, first window, windows, anchor, print) of every stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in texts(batch.column(2)):
                s = Stretches(group, width)
                yield pa.RecordBatch.from_arrays([
                    *_rows(np.arange(len(s.doc)), batch, group, s, 0, 1), pa.array(s.at.astype(np.int32)),
                    pa.array(s.windows.astype(np.int32)), pa.array(s.key.view(np.int64)), pa.array(s.print.view(np.int64)),
                ], names=["_doc", "_of", "_at", "_windows", "_key", "_print"])

    return run


def _asked(batch: pa.RecordBatch, group: Texts, s: Stretches) -> tuple[np.ndarray, pa.StructArray]:
    """The stretches that the documents' lists ask for, one of each and document, and their entries in the lists."""
    listed = batch.column(1).slice(group.first, len(group))
    entries, n = listed.flatten(), pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
    prints = entries.field("print").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(n)), n)
    spot = {x: i for i, x in enumerate(zip(owner.tolist(), prints.tolist(), strict=True))}
    got, at = [], []
    for i, x in enumerate(zip(s.doc.tolist(), s.print.view(np.int64).tolist(), strict=True)):
        entry = spot.pop(x, None)
        if entry is not None:
            got.append(i)
            at.append(entry)
    return np.array(got, int), entries.take(pa.array(at, pa.int64()))


def _sent(width: int):
    """The stretches asked for, with their words: rows (key, entry, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in texts(batch.column(0)):
                s, data = Stretches(group, width), group.data.tobytes()
                mine, entries = _asked(batch, group, s)
                yield pa.RecordBatch.from_arrays([
                    pa.array(s.key[mine].view(np.int64)), entries,
                    pa.array([s.written(data, i) for i in mine.tolist()], pa.binary()),
                ], names=["_key", "_entry", "_words"])

    return run


def _sent_whole(width: int):
    """Every window of the stretches asked for, its prefix as long as itself: rows (window, entry, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in texts(batch.column(0)):
                s = Stretches(group, width)
                mine, entries = _asked(batch, group, s)
                n = s.windows[mine]
                place = _ranges(n)
                window = s.content(np.repeat(s.begin[mine], n) + place, width)
                yield pa.RecordBatch.from_arrays([
                    pa.array(window.view(np.int64)), entries.take(pa.array(np.repeat(np.arange(len(mine)), n))),
                    pa.array(place.astype(np.int32)),
                ], names=["_window", "_entry", "_place"])

    return run


def deep_nodes(words: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of some stretches, ``width`` words long: per suffix, in order of stretch and place, the tree
    node at least ``width`` deep it hangs from, and the suffixes in lexicographic order.

    Ranks of 1, 2, 4, ... words come from pairs of shorter ones. They give the
    order of suffixes and the length of neighbours' common prefixes, which is
    what a suffix tree consists of: an internal node is a run of neighbours.
    """
    ends = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(len(words))
    ranks, reach = {1: np.unique(words, return_inverse=True)[1].astype(np.int64) + 1}, 1

    def paired(by: np.ndarray, step: int) -> np.ndarray:
        inside = place + step < ends
        second = np.where(inside, by[np.minimum(place + step, len(by) - 1)], 0)
        return np.unique(by * (int(by.max(initial=0)) + 1) + second, return_inverse=True)[1].astype(np.int64) + 1

    while 2 * reach <= width:
        ranks[2 * reach], reach = paired(ranks[reach], reach), 2 * reach
    whole = paired(ranks[reach], width - reach) if reach < width else ranks[reach]
    suffix = place[place + width <= ends]
    order = np.argsort(whole[suffix], kind="stable")
    left, right = suffix[order][:-1], suffix[order][1:]
    common = np.zeros(len(left), np.int64)
    for step in (*sorted(ranks, reverse=True), *sorted(ranks, reverse=True)):  # twice, as width may be no power of two
        inside = (common + step <= width) & (left + common + step <= ends[left]) & (right + common + step <= ends[right])
        at = [np.minimum(x + common, len(words) - 1) for x in (left, right)]
        common += np.where(inside & (ranks[step][at[0]] == ranks[step][at[1]]), step, 0)
    node = np.empty(len(order), np.int64)
    node[order] = np.concatenate([np.zeros(min(1, len(order)), np.int64), np.cumsum(common < width)])
    return node, order


def _repeats(entries: pa.StructArray, written: pa.Array, width: int) -> pa.RecordBatch:
    """Rows (print, times, runs): for runs of a stretch's windows the smallest document that holds them, where
    that may be another than the window's own."""
    words, counts = next(texts(pa.array([b"".join(x.as_py() + b" " for x in written)], pa.large_binary()).cast(pa.large_string()), 1 << 62)).words(lower=False)
    windows = entries.field("windows").to_numpy(zero_copy_only=False).astype(np.int64)
    node, _ = deep_nodes(words, windows + width - 1, width)
    first, several = entries.field("first"), entries.field("several").to_numpy(zero_copy_only=False)
    place = pc.rank(first, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
    _, example = np.unique(place, return_index=True)
    owner = np.repeat(np.arange(len(windows)), windows)
    least = np.full(node.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, place[owner])
    least = least[node]
    known = first.is_valid().to_numpy(zero_copy_only=False)[example][least - 1]
    told = known & ((least != place[owner]) | several[owner])
    new = np.r_[True, (owner[1:] != owner[:-1]) | (least[1:] != least[:-1]) | (told[1:] != told[:-1])][:len(owner)]
    starts = np.flatnonzero(new)
    n = np.diff(np.r_[starts, len(owner)])
    starts, n = starts[told[starts]], n[told[starts]]
    begin = starts - (np.cumsum(windows) - windows)[owner[starts]]
    runs = pa.StructArray.from_arrays([
        pa.array(begin.astype(np.int32)), pa.array(n.astype(np.int32)), first.take(pa.array(example[least[starts] - 1])),
    ], names=["begin", "n", "least"])
    bounds = np.searchsorted(owner[starts], np.arange(len(windows) + 1)).astype(np.int32)
    made = pa.RecordBatch.from_arrays([
        entries.field("print"), entries.field("times"), pa.ListArray.from_arrays(pa.array(bounds), runs),
    ], names=["_print", "_times", "_runs"])
    return made.filter(pa.array(np.diff(bounds) > 0))


def _trees(width: int, most: int):
    """Subtrees of whole partitions; rows come sorted by key and print."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = [], (None, None)
        for batch in batches:
            prints = batch.column(1).field("print").to_pylist()
            keys = batch.column(0).to_pylist()
            fresh_rows, cut, kept = [], [], 0
            for i, row in enumerate(zip(keys, prints, strict=True)):
                if row == before:  # rows that repeat a document send its stretches again
                    continue
                if row[0] != before[0]:
                    cut.append(kept)
                before = row
                fresh_rows.append(i)
                kept += 1
            batch = batch.take(pa.array(fresh_rows, pa.int64()))
            done, size = 0, sum(b.num_rows for b in held)
            for at in cut:  # partitions end here
                if size + at - done >= most:
                    held.append(batch.slice(done, at - done))
                    yield from _closed(held, width)
                    held, done, size = [], at, 0
            held.append(batch.slice(done))
        yield from _closed(held, width)

    return run


def _closed(held: list[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_batches(held).combine_chunks() if held else None
    if whole is not None and whole.num_rows:
        entries, written = (whole.column(c).combine_chunks() for c in ("_entry", "_words"))
        made = _repeats(entries, written, width)
        if made.num_rows:
            yield made


def _without(width: int):
    """Rows (doc, words, words removed, the others joined by one space)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in texts(batch.column(1)):
                starts, ends, counts = group.spans()
                listed = batch.column(2).slice(group.first, len(group))
                runs = listed.flatten()
                per = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
                begin = runs.field("begin").to_numpy(zero_copy_only=False) + np.repeat(counts[:-1], per)
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + runs.field("n").to_numpy(zero_copy_only=False) + width - 1, -1)
                stays = np.cumsum(edge[:-1]) == 0
                owner = np.repeat(np.arange(len(group)), np.diff(counts))[stays]
                size = (ends - starts)[stays]
                last = np.ones(len(owner), bool)
                last[:-1] = owner[1:] != owner[:-1]
                size = size + ~last
                out = group.data[np.minimum(np.repeat(starts[stays], size) + _ranges(size), max(len(group.data) - 1, 0))]
                out[np.cumsum(size)[~last] - 1] = 32
                bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])[np.searchsorted(owner, np.arange(len(group) + 1))]
                text = pa.LargeStringArray.from_buffers(len(group), pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes()))
                n, left = np.diff(counts), np.bincount(owner, minlength=len(group))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(group.first, len(group)), pa.array(n.astype(np.int64)),
                    pa.array((n - left).astype(np.int64)), text.cast(pa.string()),
                ], names=["_doc", "_n", "_gone", "_kept"])

    return run


def _listed(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents with the list that belongs to their key, null included, and text."""
    keyed = docs.withColumn("_row", F.struct("_doc", "_of"))
    table = lists.select(F.struct("_doc", "_of").alias("_row"), "_list", F.lit(1).alias("_load"))
    return lookup(keyed, pin(table, "lists"), ["_row"], load="_load", how=how)


def repeats(docs: DataFrame, width: int, most: int) -> DataFrame:
    """Rows (doc, text print, list of (begin, n)): runs of windows that a smaller document holds too.

    ``docs`` has ``_doc, _of, _text``.
    """
    kind = docs.schema["_doc"].dataType.simpleString()
    shape = f"_doc {kind}, _of bigint, _at int, _windows int, _key bigint, _print bigint"
    found = pin(docs.select("_doc", "_of", "_text").mapInArrow(_found(width), shape), "stretches")
    lone = F.max(F.col("_doc").isNull())
    kinds = pin(found.groupBy("_key", "_print").agg(
        F.min("_doc").alias("first"), F.max("_doc").alias("last"), lone.alias("lone"), F.count("*").alias("times"),
        F.max("_windows").alias("windows"), F.min(F.struct("_doc", "_of")).alias("_held"),
    ), "kinds")

    def several(first: Column, last: Column, lone: Column) -> Column:
        return first.isNotNull() & ((first < last) | lone)

    keys = kinds.groupBy("_key").agg(
        F.count("*").alias("n"), F.min("first").alias("a"), F.max("last").alias("b"), F.max("lone").alias("c")
    ).filter(several(F.col("a"), F.col("b"), F.col("c"))).select("_key", "n")
    own = several(F.col("first"), F.col("last"), F.col("lone"))
    shared = pin(kinds.join(keys, "_key").withColumn("several", own), "shared")
    run = "array<struct<begin:int,n:int,least:{}>>".format(kind)
    alone = shared.filter("n = 1").select("_print", F.col("times").alias("_times"), F.array(F.struct(
        F.lit(0).alias("begin"), F.col("windows").alias("n"), F.col("first").alias("least")
    )).cast(run).alias("_runs"))
    results = [alone]

    entry = F.struct(F.col("_print").alias("print"), "first", "several", "times", "windows")
    entry_shape = f"struct<print:bigint,first:{kind},several:boolean,times:bigint,windows:int>"

    def asked(which: Column) -> DataFrame:
        wanted = shared.filter(which).groupBy("_held").agg(F.collect_list(entry).alias("_list"))
        return _listed(docs, wanted.select("_held.*", "_list"), "inner").select("_text", "_list")

    sent = asked((F.col("n") > 1) & (F.col("n") <= most)).mapInArrow(
        _sent(width), f"_key bigint, _entry {entry_shape}, _words binary"
    )
    laid = sent.repartition("_key").sortWithinPartitions("_key", "_entry.print")
    results.append(laid.mapInArrow(_trees(width, most), f"_print bigint, _times bigint, _runs {run}"))

    if shared.filter(F.col("n") > most).limit(1).count():
        rows = asked(F.col("n") > most).mapInArrow(
            _sent_whole(width), f"_window bigint, _entry {entry_shape}, _place int"
        )
        rows = pin(rows.dropDuplicates(["_window", "_entry", "_place"]), "windows")
        least = rows.groupBy("_window").agg(F.min("_entry.first").alias("_least"), F.count("*").alias("_n"))
        met = lookup(rows, pin(least, "least"), ["_window"], load="_n")
        told = F.col("_least").isNotNull() & (F.col("_entry.several") | ~F.col("_least").eqNullSafe(F.col("_entry.first")))
        results.append(met.filter(told).groupBy("_entry.print", "_entry.times").agg(F.collect_list(F.struct(
            F.col("_place").alias("begin"), F.lit(1).alias("n"), F.col("_least").alias("least")
        )).cast(run).alias("_runs")).toDF("_print", "_times", "_runs"))

    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    at = lookup(found.select("_doc", "_of", "_at", "_print"), pin(every, "repeats"), ["_print"], load="_times")
    hit = at.select("_doc", "_of", "_at", F.inline("_runs")).filter(
        F.col("_doc").isNull() | (F.col("least") < F.col("_doc"))
    )
    return hit.groupBy("_doc", "_of").agg(
        F.collect_set(F.struct((F.col("_at") + F.col("begin")).alias("begin"), "n")).alias("_list")
    )


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, most: int = MOST
) -> DataFrame:
    """Per row ``key, n_words, n_removed, kept``: its text without words that an earlier document holds.

    Words are runs of anything but space and U+0009 to U+000D, unchanged, of the
    whole text. Every word goes that a window of ``width`` words covers whose
    words also stand, in this order, in a row with a smaller key; windows are
    judged on the texts as given. ``kept`` has the other words joined by one
    space. Rows sharing a key take nothing from each other. A null key comes
    after all others; rows with null keys take nothing from each other either.
    Texts of fewer than ``width`` words, null and empty ones too, lose nothing.
    An empty table stays empty; other columns are not read. Words are compared
    by 64-bit hashes. One document is never split, so it must fit a worker.
    """
    docs = small_batches(docs).select(F.col(key).alias("_doc"), F.xxhash64(text).alias("_of"), F.col(text).alias("_text"))
    kind = docs.schema["_doc"].dataType.simpleString()
    runs = repeats(docs, width, most)
    marked = _listed(docs, runs, "left").select("_doc", "_text", "_list")
    made = marked.mapInArrow(_without(width), f"_doc {kind}, _n bigint, _gone bigint, _kept string")
    return made.toDF(key, "n_words", "n_removed", "kept")
