"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, memory-mapped.

Training counts are gathered in blobs of sorted hashes, one per task and shard,
so the shuffle moves few rows whatever the number of n-grams. A shard holds all
bigrams whose context falls into it; its file is a sorted array of bigram hashes
beside their counts. A second shuffle joins, per word, what the word does as a
context with how many contexts it continues. The number of shards follows the shuffle
partitions, however finely the input is split.
Files have fixed names and contents, so a repeated task rewrites the same bytes.
"""

import os
import shutil
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.llm.common import small_batches
from chorus.llm.vector_text import mix, texts
from chorus.operators.scale import pin, work_dir

START = np.uint64(0x5354415254)
END = np.uint64(0x454E44)
#: Tokens sorted together, and counted bigrams a task holds before it gives them out.
TOKENS_AT_ONCE = 500_000
BIGRAMS_AT_ONCE = 2_000_000
#: Small shards keep a worker's arrays small.
SHARDS_PER_SHUFFLE_PARTITION = 4
#: Per word: times seen as a token; times as a context of bigrams seen once, twice, more; contexts it continues.
FACTS = ("count", "once", "twice", "more", "continues")
FACT_BYTES = 8 + 8 * len(FACTS)


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the few numbers all of them share."""

    path: str
    shards: int
    word_shards: int
    tokens: int
    types: int
    bigrams: int
    discounts: tuple[float, float, float]
    lower_discounts: tuple[float, float, float]
    lower_mass: float


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _put(path: str, name: str, arrays: list[np.ndarray]) -> None:
    """Write a file under a passing name, then move it into place."""
    store, base = _store(path)
    store.create_dir(base, recursive=True)
    passing = f"{base}/{name}.{uuid4().hex}"
    with store.open_output_stream(passing) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).data)
    store.move(passing, f"{base}/{name}")


def bigram_of(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + mix(word))


def _tokens(group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and word of every token, ends included, and the text each belongs to."""
    words, counts = group.words()
    n = np.diff(counts) + 1
    ends = np.cumsum(n)
    word = np.empty(ends[-1], np.uint64)
    last = np.zeros(ends[-1], bool)
    last[ends - 1] = True
    word[last], word[~last] = END, words
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[ends - n] = START
    return context, word, np.repeat(np.arange(len(n)), n)


def _summed(keys: tuple[np.ndarray, ...], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sort by keys (first key first) and add up the values of equal keys."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at, dtype=v.dtype) if len(at) else v[:0] for v in values]


def _blobs(shard: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row per shard, holding the shard's part of every column."""
    order = np.argsort(shard, kind="stable")
    which, starts = np.unique(shard[order], return_index=True)
    bounds = [*starts.tolist(), len(order)]
    columns = [c[order] for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(which.astype(np.int32))]
        + [pa.array([c[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.large_binary()) for c in columns],
        names=["shard", *[f"c{i}" for i in range(len(columns))]],
    )


def _column(group: pd.DataFrame, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, kind) for b in group[name]])


def _counted(context: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal bigrams as one, sorted by their hash."""
    pair = bigram_of(context, word)
    order = np.argsort(pair)
    pair = pair[order]
    new = np.ones(len(pair), bool)
    new[1:] = pair[1:] != pair[:-1]
    at = np.flatnonzero(new)
    first = order[at]
    return context[first], word[first], np.add.reduceat(count[order], at, dtype=np.uint32) if len(at) else count


def _count_bigrams(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        fresh: list[tuple[np.ndarray, np.ndarray]] = []
        tokens = bigrams = 0

        def close() -> int:
            context, word = (np.concatenate(x) for x in zip(*fresh, strict=True))
            fresh.clear()
            held.append(_counted(context, word, np.ones(len(word), np.uint32)))
            return len(held[-1][0])

        def out() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            columns = _counted(*columns) if len(held) > 1 else columns
            held.clear()
            return _blobs(columns[0] % np.uint64(shards), list(columns))

        for batch in batches:
            for group in texts(batch.column(0)):
                context, word, _ = _tokens(group)
                fresh.append((context, word))
                tokens += len(word)
                if tokens >= TOKENS_AT_ONCE:
                    bigrams, tokens = bigrams + close(), 0
                if bigrams >= BIGRAMS_AT_ONCE:
                    yield out()
                    bigrams = 0
        if fresh:
            close()
        if held:
            yield out()

    return run


def _close_bigrams(path: str, word_shards: int):
    """Write a shard of bigrams; pass on what it says of contexts and of words."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        keys = (_column(group, "c0", np.uint64), _column(group, "c1", np.uint64))
        context, word, count = _counted(*keys, _column(group, "c2", np.uint32))
        _put(path, f"bigrams-{shard}", [bigram_of(context, word), count])
        count = count.astype(np.int64)
        one = np.ones(len(count), np.int64)
        zero = np.zeros(len(count), np.int64)
        by_context = (context, [count, one * (count == 1), one * (count == 2), one * (count > 2), zero])
        (seen,), facts = _summed((by_context[0],), by_context[1])
        (word,), (continues,) = _summed((word,), [one])
        none = np.zeros(len(word), np.int64)
        both = np.concatenate([seen, word])
        all_facts = [np.concatenate([f, continues if k == 4 else none]) for k, f in enumerate(facts)]
        (both,), all_facts = _summed((both,), all_facts)
        made = _blobs(both % np.uint64(word_shards), [both, np.stack(all_facts, 1)]).to_pandas()
        for k in range(1, 5):
            made[f"n{k}"] = int((count == k).sum()) if len(made) else 0
            made.loc[made.index[1:], f"n{k}"] = 0
        return made

    return run


def _close_words(path: str):
    """Write a shard of words; pass on totals."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        rows = _column(group, "c1", np.int64).reshape(-1, len(FACTS))
        (word,), facts = _summed((_column(group, "c0", np.uint64),), list(rows.T))
        table = np.stack(facts, 1)
        # an end is never a context: how often it is a token is how often a text starts
        _put(path, f"words-{shard}", [word, table])
        known = word != START
        continues = table[known, 4]
        made = {
            "texts": int(table[~known, 0].sum()),
            "tokens": int(table[known, 0].sum()),
            "types": int((known & (word != END)).sum()),
            "bigrams": int(continues.sum()),
        }
        made |= {f"m{k}": int((continues == k).sum()) for k in range(1, 5)}
        made["m_more"] = int((continues > 2).sum())
        return pd.DataFrame([made])

    return run


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; where a count of counts is missing, the plain one."""
    if not n1:
        return (0.0, 0.0, 0.0)
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else y, 3 - 4 * y * n4 / n3 if n3 else y)
    return tuple(min(max(x, 0.0), k) for k, x in enumerate(d, 1))


def fit(docs: DataFrame, path: str, text: str = "text") -> Model:
    """Count all rows of ``docs`` and leave the arrays under ``path``, a folder all workers share.

    Words are runs of anything but space and U+0009 to U+000D with A to Z
    lowered; every text, null and empty ones too, ends in one end token. An
    empty table gives a model that has seen nothing.
    """
    spark = small_batches(docs).sparkSession
    word_shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards = SHARDS_PER_SHUFFLE_PARTITION * word_shards
    blobs = docs.select(text).mapInArrow(_count_bigrams(shards), "shard int, c0 binary, c1 binary, c2 binary")
    facts = blobs.groupBy("shard").applyInPandas(
        _close_bigrams(path, word_shards),
        "shard int, c0 binary, c1 binary, n1 bigint, n2 bigint, n3 bigint, n4 bigint",
    )
    facts = pin(facts, "lm-words")
    totals = facts.groupBy("shard").applyInPandas(
        _close_words(path),
        "texts bigint, tokens bigint, types bigint, bigrams bigint, m1 bigint, m2 bigint, m3 bigint, m4 bigint, "
        "m_more bigint",
    )
    totals = pin(totals, "lm-totals")
    n = facts.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in range(1, 5)]).first()
    t = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals.columns]).first().asDict()
    lower = _discounts(t["m1"], t["m2"], t["m3"], t["m4"])
    freed = lower[0] * t["m1"] + lower[1] * t["m2"] + lower[2] * t["m_more"]
    return Model(
        path, shards, word_shards, t["tokens"] + t["texts"], t["types"] + (t["texts"] > 0), t["bigrams"],
        _discounts(*n), lower, freed / t["bigrams"] if t["bigrams"] else 1.0,
    )


# ---- scoring ------------------------------------------------------------------


class _Arrays:
    """Shards of one model, mapped on first use; a store that cannot be mapped is copied to the worker."""

    def __init__(self, model: Model):
        self.model, self.mapped, self.local = model, {}, None
        self.store, self.base = _store(model.path)

    def _file(self, name: str) -> str | None:
        if isinstance(self.store, pafs.LocalFileSystem):
            path = f"{self.base}/{name}"
            return path if os.path.exists(path) and os.path.getsize(path) else None
        if not self.store.get_file_info(f"{self.base}/{name}").size:
            return None
        self.local = self.local or tempfile.mkdtemp(prefix="lm-")
        with self.store.open_input_stream(f"{self.base}/{name}") as f, open(f"{self.local}/{name}", "wb") as out:
            shutil.copyfileobj(f, out)
        return f"{self.local}/{name}"

    def shard(self, kind: str, k: int) -> tuple[np.ndarray, np.ndarray]:
        name = f"{kind}-{k}"
        if name not in self.mapped:
            width = 12 if kind == "bigrams" else FACT_BYTES
            path = self._file(name)
            raw = np.memmap(path, np.uint8, "r") if path else np.zeros(0, np.uint8)
            n = len(raw) // width
            values = raw[8 * n:].view(np.uint32) if kind == "bigrams" else raw[8 * n:].view(np.int64).reshape(n, len(FACTS))
            self.mapped[name] = (raw[:8 * n].view(np.uint64), values)
        return self.mapped[name]

    def find(self, kind: str, shard: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, each in its shard; zeros where a key is unknown."""
        out = np.zeros(len(keys) if kind == "bigrams" else (len(keys), len(FACTS)), np.int64)
        order = np.lexsort((keys, shard))
        which, starts = np.unique(shard[order], return_index=True)
        bounds = [*starts.tolist(), len(order)]
        for k, a, b in zip(which.tolist(), bounds, bounds[1:], strict=False):
            known, values = self.shard(kind, k)
            if not len(known):
                continue
            mine = order[a:b]
            at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
            hit = known[at] == keys[mine]
            out[mine[hit]] = values[at[hit]]
        return out


def _token_scores(arrays: _Arrays, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 probability, add-one log10 probability and whether it is known, of every token."""
    m = arrays.model
    shards, word_shards = np.uint64(m.shards), np.uint64(m.word_shards)
    words, back = np.unique(np.concatenate([word, context]), return_inverse=True)
    facts = arrays.find("words", words % word_shards, words).astype(np.float64)
    counts = facts[:, 0].copy()
    counts[words == END] = arrays.find("words", np.array([START % word_shards]), np.array([START]))[0, 0]
    at, of = back[:len(word)], back[len(word):]

    d1, d2, d3 = m.lower_discounts
    a = facts[:, 4]
    less = np.select([a == 0, a == 1, a == 2], [0.0, d1, d2], d3)
    lower = np.maximum(a - less, 0) / max(m.bigrams, 1) + m.lower_mass / (m.types + 1)

    pairs, pair_back = np.unique(bigram_of(context, word), return_inverse=True)
    first = np.zeros(len(pairs), np.int64)
    first[pair_back] = np.arange(len(word))
    c = arrays.find("bigrams", context[first] % shards, pairs).astype(np.float64)[pair_back]
    d1, d2, d3 = m.discounts
    less = np.select([c == 0, c == 1, c == 2], [0.0, d1, d2], d3)
    total = facts[of, 0]
    seen = np.maximum(total, 1)
    freed = (d1 * facts[of, 1] + d2 * facts[of, 2] + d3 * facts[of, 3]) / seen
    p = np.where(total > 0, np.maximum(c - less, 0) / seen + freed * lower[at], lower[at])
    base = np.log10((counts[at] + 1) / (m.tokens + m.types + 1))
    return np.log10(p), base, counts[at] > 0


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key, n_tokens, n_known, base_score, score``, over its whole text.

    ``score`` is the log10 probability of the text, its end included;
    ``perplexity`` follows from it and ``n_tokens``. A null or empty text is one
    end token. Rows are scored where they lie, each for itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model)
        for batch in batches:
            for group in texts(batch.column(1)):
                context, word, owner = _tokens(group)
                logs, base, known = _token_scores(arrays, context, word)
                n = len(group)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(group.first, n),
                    pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                    pa.array(np.bincount(owner, known, n).astype(np.int64)),
                    pa.array(np.bincount(owner, base, n)),
                    pa.array(np.bincount(owner, logs, n)),
                ], names=[key, "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    return docs.select(key, text).mapInArrow(run, schema)


def new_model_path(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/lm-{uuid4().hex}"
