"""Benchmark decontamination with DataFrame functions only: containment search by MinHash.

A small set is contained in a large one exactly as often as its own MinHash
values are members of the large one, so long documents need no signature: only
items get one. Items are partitioned by size, and each partition takes as many
of an item's smallest hashes as make a miss impossible: an item of n shingles
with at most m = n - ceil(t * n) missing shows one of its m + 1 smallest.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import fresh, repeats, rows_of, rows_without, with_text
from chorus.operators.scale import match_null_safe, pin, semi

SHINGLE_WORDS = 5
CONTAINED = 0.8


def folded_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, so that punctuation and line breaks do not matter."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), "")


def _with_shingles(rows: DataFrame, keys: list[str], text: str, k: int) -> DataFrame:
    """``keys`` and ``shingles``: hashes of every run of ``k`` words, or of the whole if shorter."""
    split = rows.select(*keys, F.transform(folded_words(F.col(text)), lambda w: F.xxhash64(w)).alias("_words"))
    w = F.col("_words")
    runs = F.transform(
        F.sequence(F.lit(0), F.size(w) - k),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]),
    )
    whole = F.array(F.xxhash64(F.lit("whole"), F.array_join(w.cast("array<string>"), " ")))
    return split.select(
        *keys,
        F.when(F.size(w) >= k, runs).when(F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>")).alias("shingles"),
    )


def _one_per_row(rows: DataFrame, *keys: str, of: str = "shingles") -> DataFrame:
    """``explode`` as outer generator: the filter Spark infers for a plain one is pushed below the
    shingling and would evaluate the words of a text anew for every shingle."""
    return rows.select(*keys, F.explode_outer(of).alias("s")).filter(F.col("s").isNotNull())


def item_sketches(items: DataFrame, k: int = SHINGLE_WORDS, contained: float = CONTAINED) -> DataFrame:
    """One row per item that has words: its distinct shingles, their number, and its sketch.

    ``items`` needs ``item_id, text``. Rows sharing an id, null included, are one item with all their
    shingles. The sketch holds the smallest hashes, as many as the size class of the item demands.
    """
    joined = _with_shingles(items.select("item_id", "text"), ["item_id"], "text", k)
    sets = _one_per_row(joined, "item_id").groupBy("item_id").agg(
        F.sort_array(F.collect_set("s")).alias("shingles")
    )
    sized = sets.withColumn("n_item", F.size("shingles").cast("bigint"))
    largest = F.lit(2) ** (F.floor(F.log2("n_item")) + 1) - 1  # of the size class
    most = F.floor(largest * (1 - contained) + 1e-9) + 1
    by_hash = F.sort_array(F.transform("shingles", lambda s: F.struct(F.xxhash64(s).alias("h"), s.alias("s"))))
    sketch = F.transform(F.slice(by_hash, F.lit(1), F.least("n_item", most).cast("int")), lambda x: x["s"])
    return sized.select("item_id", "n_item", "shingles", sketch.alias("sketch"))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    k: int = SHINGLE_WORDS,
    contained: float = CONTAINED,
) -> DataFrame:
    """Every (document, item) in which at least ``contained`` of the item's shingles occur.

    Returns ``key, item_id, n_shared, n_item, containment``. Rows sharing a key,
    null included, are one document. Null and empty texts contain nothing and
    empty items are in nothing; fewer words than ``k`` make one shingle of the
    whole, so short items match only texts that equal them. All words of all
    texts are looked at; two empty tables give an empty result.
    """
    name, docs = key, docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    key, text = "_key", "_text"
    sketches = pin(item_sketches(items, k, contained), "items")
    sized = sketches.withColumn("n_sketch", F.size("sketch"))
    probes = _one_per_row(sized, "item_id", "n_item", "n_sketch", of="sketch")
    shingled = _with_shingles(docs.select(key, text), [key], text, k)
    seen = _one_per_row(shingled, key)
    hits = pin(semi(seen, probes, ["s"]).distinct(), "hits")
    allowed = F.floor(F.col("n_item") * (1 - contained) + 1e-9)
    met = hits.join(probes, "s").groupBy(key, "item_id", "n_item", "n_sketch").agg(F.count("*").alias("met"))
    pairs = pin(met.filter(F.col("met") >= F.col("n_sketch") - allowed).select(key, "item_id", "n_item"), "pairs")

    wanted = pairs.select(key).distinct()
    again = _with_shingles(rows_of(docs.select(key, text), wanted, key), [key], text, k)
    members = _one_per_row(sketches, "item_id")
    found = pin(semi(_one_per_row(again, key), members, ["s"]).distinct(), "found")
    possible = match_null_safe(pairs, members, ["item_id"], "inner")
    shared = match_null_safe(possible, found, [key, "s"], "left_semi")
    counted = shared.groupBy(key, "item_id", "n_item").agg(F.count("*").alias("n_shared"))
    share = F.col("n_shared") / F.col("n_item")
    return counted.filter(F.col("n_shared") >= contained * F.col("n_item") - 1e-9).select(
        F.col(key).alias(name), "item_id", "n_shared", "n_item", share.alias("containment")
    )


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item; columns stay.

    Rows that share a key but not their text are judged each for itself.
    """
    mark = fresh(docs.columns, "mark")[0]
    marked = docs.withColumn(mark, with_text(key, text) if repeats(docs, key) else F.col(key))
    bad = pin(contained_items(marked, items, mark, text).select(mark).distinct(), "contaminated")
    return rows_without(marked, bad, mark).select(*docs.columns)
