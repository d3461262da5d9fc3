"""Removal of repeated byte strings by prefix-free parsing.

Rolling-hash triggers cut every text into overlapping phrases: the trigger of a
window of ``LENGTH`` bytes is the leftmost smallest hash of its ``GRAM``-byte
strings, so every window has one, equal windows have it at the same place, and
windows that share a trigger occurrence form one phrase. The distinct phrases are
the dictionary; the parse is where each occurs, in document order. An occurrence
of a phrase met earlier goes as a whole. Only first occurrences of phrases whose
trigger string also starts another phrase are looked into: their suffixes, as
deep as ``LENGTH`` bytes, are sorted by fingerprint and then by place in the
parse, and all but the first of equal ones go.

The work beyond one pass over the bytes is thus proportional to the repeated
part. Data between tasks are blobs, one row per task and shard.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import fresh, small_batches
from chorus.llm.vector_text import Texts, mix, texts
from chorus.operators.scale import lookup, match_null_safe, pin, rank_all

LENGTH = 100
GRAM = 32
SHARDS_PER_PARTITION = 6
ROWS_AT_ONCE = 3_000_000
#: Phrases around one trigger string beyond which its windows are dealt out one by one.
MANY = 20_000

_OCCURRENCE = [np.uint64, np.uint64, np.int64, np.int32, np.uint8, np.uint8]  # gram, phrase, doc, start, trigger, more
_INTERVAL = [np.int64, np.int32, np.int32]  # doc, start, end
_PENDING = [np.int64, np.int32, np.uint8, np.uint64, np.uint8]  # doc, start, more, gram, alone
_BLOBS = "kind int, shard int, " + ", ".join(f"c{i} binary" for i in range(6))
OCCURRENCE, INTERVAL, PENDING = 0, 1, 2


def _blobs(kind: int, shard: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    order = np.argsort(shard, kind="stable")
    which, starts = np.unique(shard[order], return_index=True)
    bounds = [*starts.tolist(), len(order)]
    cells = [[c[order][a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)] for c in columns]
    cells += [[None] * len(which)] * (6 - len(cells))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(which), kind, np.int32)), pa.array(which.astype(np.int32)), *[pa.array(c, pa.binary()) for c in cells]],
        names=["kind", "shard", *[f"c{i}" for i in range(6)]],
    )


def _columns(group: pd.DataFrame, kinds: list) -> list[np.ndarray]:
    return [np.concatenate([np.frombuffer(b, k) for b in group[f"c{i}"]]) for i, k in enumerate(kinds)]


def _spread(docs: np.ndarray, shards: int) -> np.ndarray:
    return (mix(docs.view(np.uint64)) % np.uint64(shards)).astype(np.int32)


def phrases(group: Texts) -> tuple[np.ndarray, ...]:
    """Per phrase of the texts: owner, start of its first window in the group, trigger and last window
    relative to that, hash of the trigger string, hash of the phrase."""
    n, wide = len(group.data), LENGTH - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    prefix = group.prefix_hashes()
    at = np.arange(n - GRAM + 1)
    grams = group.hashes(at, at + GRAM, prefix)
    owner = np.repeat(np.arange(len(group)), np.diff(group.offsets))
    start = np.flatnonzero(owner[:n - LENGTH + 1] == owner[LENGTH - 1:])
    trigger = start + _leftmost_smallest(grams, wide)[start]
    new = np.ones(len(start), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (owner[start[1:]] != owner[start[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    begin, end, t = start[first], start[last] if len(first) else none, trigger[first]
    phrase = group.hashes(begin, end + LENGTH, prefix)
    phrase = mix(phrase + (t - begin).astype(np.uint64) * np.uint64(257) + (end - begin).astype(np.uint64))
    return owner[begin], begin, t - begin, end - begin, grams[t], phrase


def _leftmost_smallest(values: np.ndarray, wide: int) -> np.ndarray:
    """Per place, how far on the smallest of the next ``wide`` values stands, the leftmost if several do."""
    best, far, reach = values, np.zeros(len(values), np.uint8), 1
    while reach < wide:
        step = min(reach, wide - reach)
        right = best[step:]
        less = right < best[:len(right)]
        far = np.where(less, far[step:] + np.uint8(step), far[:len(right)])
        best = np.where(less, right, best[:len(right)])
        reach += step
    return far


def _first_of_equal(keys: list[np.ndarray], order_by: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order by keys, then place, and which rows of it open a run of equal keys."""
    order = np.lexsort([*order_by[::-1], *keys[::-1]])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, new


def _parse(shards: int):
    """Occurrences of phrases; later ones of a phrase met in the same task are removed at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            gram, phrase, doc, start, trigger, more = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order, new = _first_of_equal([gram, phrase], [doc, start])
            kept, again = order[new], order[~new]
            columns = [gram[kept], phrase[kept], doc[kept], start[kept], trigger[kept], more[kept]]
            yield _blobs(OCCURRENCE, (columns[0] % np.uint64(shards)).astype(np.int32), columns)
            if len(again):
                doc, begin, end = _merged(doc[again], start[again], start[again] + more[again] + LENGTH)
                yield _blobs(INTERVAL, _spread(doc, shards), [doc, begin, end])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for group in texts(batch.column(1)):
                owner, begin, trigger, more, gram, phrase = phrases(group)
                held.append((
                    gram, phrase, ids[group.first + owner], (begin - group.offsets[owner]).astype(np.int32),
                    trigger.astype(np.uint8), more.astype(np.uint8),
                ))
                rows += len(gram)
                if rows > ROWS_AT_ONCE:
                    yield from out()
                    rows = 0
        if rows:
            yield from out()

    return run


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document joined where they touch or overlap, sorted."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), end[order].astype(np.int64)
    if not len(doc):
        return doc, start.astype(np.int32), end.astype(np.int32)
    nth = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
    shift = nth * np.int64(2**32)
    reach = np.maximum.accumulate(end + shift)
    new = np.r_[True, (start + shift)[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first].astype(np.int32), (reach[last] - shift[last]).astype(np.int32)


def _compare_phrases(shards: int):
    """Per shard of trigger strings: later occurrences of a phrase go, and first ones of phrases
    that share their trigger string with another are pending."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        gram, phrase, doc, start, trigger, more = _columns(group, _OCCURRENCE)
        order, new = _first_of_equal([gram, phrase], [doc, start])
        kept, again = order[new], order[~new]
        out = []
        if len(again):
            d, a, b = _merged(doc[again], start[again], start[again] + more[again] + LENGTH)
            out.append(_blobs(INTERVAL, _spread(d, shards), [d, a, b]))
        _, back, times = np.unique(gram[kept], return_inverse=True, return_counts=True)
        times = times[back]
        open_ = kept[times > 1]
        if len(open_):
            alone = (times[times > 1] > MANY).astype(np.uint8)
            columns = [doc[open_], start[open_], more[open_], gram[open_], alone]
            out.append(_blobs(PENDING, _spread(columns[0], shards), columns))
        if not out:
            out.append(_blobs(INTERVAL, np.zeros(0, np.int32), [np.zeros(0, k) for k in _INTERVAL]))
        return pa.Table.from_batches(out).to_pandas()

    return run


def _per_document(kinds: list):
    """A shard's rows as one row per document."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        columns = _columns(group, kinds)
        if kinds is _INTERVAL:
            columns = list(_merged(*columns))
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        ids, starts = np.unique(columns[0], return_index=True)
        bounds = [*starts.tolist(), len(order)]
        made = {"_seq": ids}
        for i, c in enumerate(columns[1:]):
            made[f"_c{i}"] = [c[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
        return pd.DataFrame(made)

    return run


def _dictionary(shards: int):
    """The bytes of pending phrases, dealt by trigger string, or by window where very many share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            gram, doc, start, more, data, length = (
                np.concatenate(x) if k != 4 else x for k, x in enumerate(zip(*held, strict=True))
            )
            held.clear()
            data = np.concatenate(data)
            shard = (gram % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            ends = np.cumsum(length)
            begin = (ends - length)[order]
            laid = np.repeat(begin - np.r_[0, np.cumsum(length[order])[:-1]], length[order]) + np.arange(len(data))
            which, starts = np.unique(shard[order], return_index=True)
            bounds = [*starts.tolist(), len(order)]
            data, byte_ends = data[laid], np.r_[0, np.cumsum(length[order])]
            cells = [
                [c[order][a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)] for c in (doc, start, more)
            ]
            cells.append([data[byte_ends[a]:byte_ends[b]].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(which), *[pa.array(c, pa.binary()) for c in cells]], names=["shard", "c0", "c1", "c2", "c3"]
            )

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            cells = [batch.column(i) for i in range(2, 6)]
            for group in texts(batch.column(1)):
                prefix = group.prefix_hashes()
                for i in range(len(group)):
                    start, more, gram, alone = (
                        np.frombuffer(c[group.first + i].as_buffer(), k) for c, k in zip(cells, _PENDING[1:], strict=True)
                    )
                    base = group.offsets[i]
                    if alone.any():
                        single = np.repeat(np.arange(len(start)), np.where(alone, more.astype(int) + 1, 1))
                        nth = np.arange(len(single)) - np.searchsorted(single, single)
                        dealt = alone[single].astype(bool)
                        at = base + start[single] + nth
                        window = group.hashes(at, at + LENGTH, prefix)
                        gram = np.where(dealt, window, gram[single])
                        start, more = start[single] + nth.astype(np.int32), np.where(dealt, 0, more[single]).astype(np.uint8)
                    length = more.astype(np.int64) + LENGTH
                    places = np.repeat(base + start - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum())
                    doc = np.full(len(start), ids[group.first + i], np.int64)
                    held.append((gram, doc, start.astype(np.int32), more, group.data[places], length))
                    size += int(length.sum())
                    if size > 64 << 20:
                        yield from out()
                        size = 0
        if held:
            yield from out()

    return run


def _compare_suffixes(shards: int):
    """Per shard of the dictionary: sort the windows, equal ones by place, and remove all but the first."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        doc, start, more = _columns(group, [np.int64, np.int32, np.uint8])
        data = np.concatenate([np.frombuffer(b, np.uint8) for b in group["c3"]])
        windows = more.astype(np.int64) + 1
        length = windows - 1 + LENGTH
        phrase = np.repeat(np.arange(len(doc)), windows)
        nth = np.arange(len(phrase)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = (np.cumsum(length) - length)[phrase] + nth
        whole = Texts(0, data, np.array([0, len(data)]))
        print_ = whole.hashes(at, at + LENGTH, whole.prefix_hashes())
        place = start[phrase] + nth
        order, new = _first_of_equal([print_], [doc[phrase], place])
        again = np.sort(order[~new])
        d, a, b = _merged(doc[phrase[again]], place[again], place[again] + LENGTH)
        return _blobs(INTERVAL, _spread(d, shards), [d, a, b]).to_pandas()

    return run


def _numbered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    """Documents with a bigint that is unique per (key, text) and ordered by key, then text.

    That is the key itself where it is a number and names one text only.
    """
    seq, digest = fresh(docs.columns, "seq", "digest")
    marked = docs.select(key, text, F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias(digest))
    known = marked.select(key, digest).distinct()
    simple = docs.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    total, distinct_, missing = known.agg(
        F.count("*"), F.countDistinct(key), F.sum(F.col(key).isNull().cast("int"))
    ).first()
    if simple and total == distinct_ and not missing:
        return docs.select(key, text, F.col(key).cast("bigint").alias(seq)), seq
    ranked = rank_all(pin(known.withColumn("_all", F.lit(1)), "ids"), ["_all"], [F.col(key), F.col(digest)], seq).drop("_all")
    return match_null_safe(marked, pin(ranked, "ranked-ids"), [key, digest], "inner").select(key, text, seq), seq


def _kept(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "kept", "n_bytes", "n_removed", "n_spans"]
        for batch in batches:
            for group in texts(batch.column(1)):
                out = []
                for i in range(len(group)):
                    data = group.data[group.offsets[i]:group.offsets[i + 1]]
                    copy, starts, ends = (batch.column(k)[group.first + i] for k in (2, 3, 4))
                    if copy.as_py():
                        start, end = np.array([0]), np.array([len(data)])
                    elif starts.is_valid:
                        start, end = (np.frombuffer(x.as_buffer(), np.int32) for x in (starts, ends))
                    else:
                        start = end = np.zeros(0, np.int32)
                    edges = np.r_[0, np.stack([start, end], 1).reshape(-1), len(data)].tolist()
                    kept = b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True))
                    out.append((kept, len(data), len(data) - len(kept), len(start)))
                kept, n, removed, spans = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(group.first, len(group)), pa.array(kept, pa.binary()),
                    *[pa.array(x, pa.int64()) for x in (n, removed, spans)],
                ], names=names)

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key, kept`` (the remaining bytes), ``n_bytes, n_removed, n_spans``.

    A byte goes if a string of 100 bytes over it also starts earlier: in a
    document of smaller key, or earlier in the same one; overlaps count, and
    strings are judged on the input. Null texts are empty. Documents are ordered
    by key, null first, then by digest of the text; rows equal in both count as
    one document and share its result. Strings are compared by 64-bit
    fingerprints. The phrases around one trigger string meet in one task, in 30
    bytes each, after equal ones have been merged where they are read.
    """
    name, docs = key, small_batches(docs).select(F.col(key).alias("_key"), F.col(text).alias("_whole"))
    key, text = "_key", "_whole"
    numbered, seq = _numbered(docs, key, text)
    length = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    prints = pin(numbered.select(seq, F.xxhash64(text).alias("_p"), length.alias("_n")).filter(F.col("_n") >= LENGTH).distinct(), "prints")
    first = prints.groupBy("_p", "_n").agg(F.min(seq).alias("_first"), F.count("*").alias("_times"))
    first = pin(first.filter("_times > 1"), "first")
    copies = lookup(prints, first, ["_p", "_n"], load="_times").filter(F.col(seq) != F.col("_first"))
    copies = pin(copies.select(seq, F.lit(True).alias("_copy")), "copies")
    marked = lookup(numbered, copies, [seq], how="left")
    whole = marked.filter(F.col("_copy").isNull()).select(F.col(seq).alias("_seq"), F.col(text).alias("_text"))

    shards = max(8, SHARDS_PER_PARTITION * docs.rdd.getNumPartitions())
    parsed = pin(whole.mapInArrow(_parse(shards), _BLOBS), "parse")
    occurrences = parsed.filter(F.col("kind") == OCCURRENCE)
    compared = pin(occurrences.groupBy("shard").applyInPandas(_compare_phrases(shards), _BLOBS), "phrases")
    pending = compared.filter(F.col("kind") == PENDING).groupBy("shard").applyInPandas(
        _per_document(_PENDING), "_seq bigint, _c0 binary, _c1 binary, _c2 binary, _c3 binary"
    )
    asked = lookup(whole, pin(pending, "pending"), ["_seq"])
    dictionary = asked.select("_seq", "_text", "_c0", "_c1", "_c2", "_c3").mapInArrow(
        _dictionary(shards), "shard int, c0 binary, c1 binary, c2 binary, c3 binary"
    )
    suffixes = dictionary.groupBy("shard").applyInPandas(_compare_suffixes(shards), _BLOBS)
    intervals = parsed.filter(F.col("kind") == INTERVAL).unionByName(
        compared.filter(F.col("kind") == INTERVAL)
    ).unionByName(suffixes)
    spans = intervals.groupBy("shard").applyInPandas(_per_document(_INTERVAL), "_seq bigint, _c0 binary, _c1 binary")
    spans = pin(spans, "spans").withColumnRenamed("_seq", seq)
    found = lookup(marked, spans, [seq], how="left")
    kind = docs.schema[key].dataType.simpleString()
    return found.select(key, text, "_copy", "_c0", "_c1").mapInArrow(
        _kept(key), f"`{key}` {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    ).withColumnRenamed(key, name)
