"""Ranked lexical search without random access (NRA) over impact-sorted lists.

Documents are indexed where they lie. A task turns each batch of them into
lists, one per query term, sorted by falling impact (what a term adds to a
document's score). Lists are read from the top in growing steps. A document's
lower bound is what has been read of it; its upper bound adds, for every list in
which it has not been met, that list's next impact. Reading goes on until the
best documents, their order among equals and their scores are all settled: until
every document that could still reach the last place has equal bounds, and one
never met could not. What a task has found so far raises the bar for its next
batch, and Spark ranks what tasks give out.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import small_batches
from chorus.llm.vector_text import _ranges, texts
from chorus.operators.scale import lookup, pin, top_n

#: Bytes between terms: ASCII but letters and digits. Every byte of other characters belongs to a term.
GAPS = np.ones(256, bool)
GAPS[128:] = False
GAPS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
#: Query terms held by workers at a time; more are searched in further passes.
TERMS_AT_ONCE = 1_000_000
FIRST_STEP = 128
_LOW = 24


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (item, distinct term hashes)."""
    for batch in batches:
        for group in texts(batch.column(1)):
            terms, counts = group.words(GAPS)
            listed = [np.unique(terms[a:b]).view(np.int64) for a, b in zip(counts[:-1], counts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(group.first, len(group)),
                pa.array([x.tolist() for x in listed], pa.list_(pa.int64())),
            ], names=["_item", "_terms"])


def _postings(wanted):
    """Per document with a term: its number of terms, and number and count of every query term in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value
        for batch in batches:
            for group in texts(batch.column(1)):
                terms, counts = group.words(GAPS)
                n = np.diff(counts)
                owner = np.repeat(np.arange(len(n)), n)
                at = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))
                hit = known[at] == terms if len(known) else np.zeros(len(terms), bool)
                met = np.sort(owner[hit] * len(known) + at[hit])
                first = np.flatnonzero(np.r_[True, met[1:] != met[:-1]]) if len(met) else np.zeros(0, int)
                times = np.diff(np.r_[first, len(met)])
                doc, term = np.divmod(met[first], max(len(known), 1))
                bounds = np.searchsorted(doc, np.arange(len(n) + 1)).astype(np.int32)
                made = pa.RecordBatch.from_arrays([
                    batch.column(0).slice(group.first, len(group)), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(times.astype(np.int32))),
                ], names=["_doc", "_n", "_terms", "_times"])
                yield made.filter(pa.array(n > 0))

    return run


@dataclass(frozen=True)
class Queries:
    """What a search needs of its queries and of the corpus: term weights, per item its terms, and totals."""

    items: list[int]
    terms: list[np.ndarray]
    weights: np.ndarray
    n_docs: int
    n_terms: int


def weight(n_docs: int, with_term: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * with_term + 1)))


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact 64-bit sums of values per place; doubles hold either half without error."""
    high = np.bincount(at, values >> _LOW, n).astype(np.int64)
    return (high << _LOW) + np.bincount(at, values & ((1 << _LOW) - 1), n).astype(np.int64)


class Lists:
    """Impact-sorted lists of one batch of documents."""

    def __init__(self, queries: Queries, n: np.ndarray, bounds: np.ndarray, term: np.ndarray, times: np.ndarray):
        self.n_docs = len(n)
        m = np.array([10 + 90 * x * queries.n_docs // queries.n_terms for x in n.tolist()], np.int64)
        doc = np.repeat(np.arange(len(n)), np.diff(bounds))
        times = times.astype(np.int64)
        impact = queries.weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[doc]))
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(queries.weights) + 1))

    def best(self, terms: np.ndarray, k: int, bar: int, step: int = FIRST_STEP) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that may be among the ``k`` best at ``bar`` or above, their exact scores, and entries read.

        All documents with a score of at least the k-th best one's, and of ``bar``, are among them.
        """
        at, ends = self.starts[terms], self.starts[terms + 1]
        read, of = np.zeros(0, int), np.zeros(0, int)
        lower = np.zeros(self.n_docs, np.int64)
        met = np.zeros(self.n_docs, bool)
        while True:
            more = np.minimum(ends - at, step)
            got = np.repeat(at, more) + _ranges(more)
            read, of = np.concatenate([read, self.doc[got]]), np.concatenate([of, np.repeat(np.arange(len(at)), more)])
            lower += _sums(self.doc[got], self.impact[got], self.n_docs)
            met[self.doc[got]] = True
            at, step = at + more, step * 2
            left = at < ends
            front = np.zeros(len(at), np.int64)
            front[left] = self.impact[at[left]]
            unseen = int(front.sum())
            upper = lower + unseen - _sums(read, front[of], self.n_docs)
            if self.n_docs > k:
                bar = max(bar, int(np.partition(lower, -k)[-k]))
            able = met & (upper >= bar)
            if (unseen < bar or met.all()) and (lower[able] == upper[able]).all():
                found = np.flatnonzero(able)
                return found, lower[found], len(read)


def _searched(shared, k: int):
    """Per task and item the ``k`` best documents of the task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        best: list[list[tuple]] = [[] for _ in queries.items]
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            if not batch.num_rows:
                continue
            lists = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in batch.columns[2:4]]
            bounds = lists[0].offsets.to_numpy() - lists[0].offsets[0].as_py()
            index = Lists(queries, batch.column(1).to_numpy(), bounds, *[c.flatten().to_numpy() for c in lists])
            for i, terms in enumerate(queries.terms):
                held = best[i]
                bar = -held[k - 1][0] if len(held) >= k else 1
                found, score, _ = index.best(terms, k, bar)
                docs = batch.column(0).take(pa.array(found)).to_pylist()
                held += [(-s, d is None, d) for s, d in zip(score.tolist(), docs, strict=True)]
                held.sort(key=lambda x: x[:2] if x[1] else x)
                del held[k:]
        if kind is not None:
            rows = [(item, d, -s) for item, held in zip(queries.items, best, strict=True) for s, _, d in held]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind),
                pa.array([r[2] for r in rows], pa.int64()),
            ], names=["_item", "_doc", "_score"])

    return run


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
    item: str = "item_id", query: str = "text", terms_at_once: int = TERMS_AT_ONCE,
) -> DataFrame:
    """Per row of ``items`` its ``k`` best rows of ``docs``: ``item, rank, key, score``.

    Terms are runs of ASCII letters and digits and of any other character from
    U+0080 on, A to Z lowered, compared by 64-bit hashes; texts are taken whole.
    With N rows that have a term, L terms in all, n in a row and df rows holding
    a term, its weight is floor(1000 ln((2N + 2) / (2 df + 1))), a row's m is
    10 + (90 n N) div L, and its score adds weight * ((10^9 tf) div (1000 tf + 8 m))
    over the item's distinct terms. Only scores above 0 are ranked, equal ones by
    ascending key, a null key last. Rows stand for themselves: repeated documents
    take a rank each, and rows that share an item's key are ranked each on their
    own. Null and empty texts, on either side, and empty tables rank nothing.

    The queries are a stated set: their terms are sent to the workers, in passes
    of about ``terms_at_once``.
    """
    spark = small_batches(docs).sparkSession
    asked = pin(items.select(F.monotonically_increasing_id().alias("_item"), F.col(item).alias("_name"), F.col(query).alias("_text")), "items")
    listed = pin(asked.select("_item", "_text").mapInArrow(_query_terms, "_item bigint, _terms array<bigint>"), "query-terms")
    total = listed.agg(F.sum(F.size("_terms"))).first()[0] or 0
    kind = docs.schema[key].dataType.simpleString()
    passes, found = max(1, -(-total // terms_at_once)), []
    for turn in range(passes):
        mine = listed.filter((F.size("_terms") > 0) & (F.pmod(F.xxhash64("_item"), F.lit(passes)) == turn)).collect()
        hashes = [np.array(r["_terms"], np.int64).view(np.uint64) for r in mine]
        known = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
        held = docs.select(F.col(key).alias("_doc"), F.col(text).alias("_text")).mapInArrow(
            _postings(spark.sparkContext.broadcast(known)), f"_doc {kind}, _n bigint, _terms array<int>, _times array<int>"
        )
        held = pin(held, "postings")
        n_docs, n_terms = held.agg(F.count("*"), F.sum("_n")).first()
        counted = held.select(F.explode("_terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        weights = np.zeros(len(known), np.int64)
        for row in counted:
            weights[row["term"]] = weight(n_docs, row["df"])
        queries = Queries([r["_item"] for r in mine], [np.searchsorted(known, h) for h in hashes], weights, n_docs, n_terms)
        shared = spark.sparkContext.broadcast(queries)
        found.append(held.mapInArrow(_searched(shared, k), f"_item bigint, _doc {kind}, _score bigint"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    placed = top_n(every, ["_item"], [F.col("_score").desc(), F.col("_doc").asc_nulls_last()], k, "_rank")
    return lookup(placed, asked.select("_item", "_name"), ["_item"]).select(
        F.col("_name").alias(item), F.col("_rank").alias("rank"), F.col("_doc").alias(key), F.col("_score").alias("score")
    )
