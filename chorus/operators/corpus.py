"""From review text to tokens, vocabulary, term counts and TF-IDF weights.

``by`` lists the entity columns: one call covers every entity at once, one whose
columns are null or empty like any other.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.functions import text as tx
from chorus.operators.scale import join_keyed, lookup, pin, rank_all, spread
from chorus.schema import DOC, ENTITY, MIN_TOKENS


def keep_longer(df: DataFrame, min_tokens: int = MIN_TOKENS, words: str = "words") -> DataFrame:
    """Documents with strictly more than ``min_tokens`` tokens."""
    return df.filter(F.size(words) > min_tokens)


def preprocess(
    reviews: DataFrame,
    text: str = "text",
    lang: str | None = None,
    langs: list[str] | None = None,
    min_tokens: int = MIN_TOKENS,
    even_by: str | None = None,
) -> DataFrame:
    """Reviews with ``words`` in place of their text, short ones removed.

    Text is tokenised where it lies, without a shuffle; ``even_by`` names a key
    to spread raw text by first, for input in few or uneven splits (tokenising
    costs far more than moving the text). The explode of a one-element array
    stops the length filter from being pushed below the projection, which would
    tokenise twice.
    """
    if even_by:
        reviews = spread(reviews, even_by)
    words = tx.content_words(F.col(text), None if lang is None else F.col(lang), langs)
    others = [c for c in reviews.columns if c != text]
    return keep_longer(reviews.select(*others, F.explode(F.array(words)).alias("words")), min_tokens)


def left_out(
    reviews: DataFrame, by: list[str] = ENTITY, text: str = "text", lang: str | None = None,
    langs: list[str] | None = None, min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """Per entity, the documents :func:`preprocess` does not keep: those without text, and those too short."""
    n = F.size(tx.content_words(F.col(text), None if lang is None else F.col(lang), langs))
    missing = F.col(text).isNull()
    return reviews.groupBy(*by).agg(
        F.count_if(missing).alias("n_without_text"), F.count_if(~missing & (n <= min_tokens)).alias("n_short")
    )


def repeated_ids(df: DataFrame, by: list[str] = ENTITY, doc: str = DOC) -> DataFrame:
    """Ids that more than one row carries, with their number of rows; counts and models need none."""
    return df.groupBy(*by, doc).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def doc_lengths(tokens: DataFrame, by: list[str] = ENTITY, doc: str = DOC) -> DataFrame:
    return tokens.select(*by, doc, F.size("words").cast("bigint").alias("n_tokens"))


def term_frequency(tokens: DataFrame, by: list[str] = ENTITY, doc: str = DOC) -> DataFrame:
    """Count of every term in every document.

    Documents move once, as arrays; counting inside a document is then local.
    That is several times less to shuffle than one row per document and term.
    """
    placed = spread(tokens.select(*by, doc, "words"), doc)
    terms = placed.select(*by, doc, F.explode("words").alias("term"))
    return terms.groupBy(*by, doc, "term").agg(F.count("*").alias("n"))


def document_frequency(tokens: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Documents holding each term; repeats vanish inside the row, before the shuffle."""
    terms = tokens.select(*by, F.explode(F.array_distinct("words")).alias("term"))
    return terms.groupBy(*by, "term").agg(F.count("*").alias("doc_freq"))


def counted_words(df: DataFrame, words: str = "words", said: str = "said") -> DataFrame:
    """``df`` with ``said``: per row the distinct words of ``words`` and how often each occurs, counted where it lies.

    Null and empty arrays give null. The explodes of one-element arrays keep each step from being repeated per word.
    """
    others = [F.col(c) for c in df.columns]
    laid = df.select(*others, F.explode(F.array(F.sort_array(words))).alias("_sorted"))
    n = F.size("_sorted")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | ~F.get("_sorted", i).eqNullSafe(F.get("_sorted", i - 1)))
    cut = laid.select(*others, "_sorted", F.explode(F.array(F.when(n > 0, ends))).alias("_ends"))
    counts = F.transform("_ends", lambda end, i: F.struct(
        F.get("_sorted", end - 1).alias("term"),
        (end - F.coalesce(F.get("_ends", i - 1), F.lit(0))).cast("bigint").alias("n"),
    ))
    return cut.select(*others, counts.alias(said))


def term_stats(tokens: DataFrame, by: list[str] = ENTITY, doc: str = DOC, said: str | None = None) -> DataFrame:
    """Corpus count and document count of every term; with ``said`` every row is a document of these counted words."""
    return (
        (term_frequency(tokens, by, doc) if said is None else tokens.select(*by, F.inline(said)))
        .groupBy(*by, "term")
        .agg(F.sum("n").alias("term_freq"), F.count("*").alias("doc_freq"))
    )


def vocabulary(
    tokens: DataFrame,
    by: list[str] = ENTITY,
    doc: str = DOC,
    size: int | None = None,
    min_df: int = 1,
    said: str | None = None,
) -> DataFrame:
    """Terms by falling corpus count, ties by term; ``idx`` counts from 0 per entity.

    Every term is listed unless the caller asks for the first ``size`` only.
    ``said`` names counted words (``counted_words``) of rows that are a document each.
    """
    stats = term_stats(tokens, by, doc, said).filter(F.col("doc_freq") >= min_df)
    ranked = rank_all(stats, by, [F.col("term_freq").desc(), F.col("term").asc()])
    listed = ranked if size is None else ranked.filter(F.col("rank") <= size)
    return listed.withColumn("idx", F.col("rank") - 1).select(*by, "idx", "term", "term_freq", "doc_freq")


def doc_counts(tokens: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    return tokens.groupBy(*by).agg(F.count("*").alias("n_docs"))


def idf(tokens: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """ln((m + 1) / (df + 1)) for every term of every entity."""
    sizes = pin(doc_counts(tokens, by), "doc_counts")
    counted = lookup(document_frequency(tokens, by), sizes, by, load="n_docs", nulls=True)
    weight = F.log((F.col("n_docs") + 1) / (F.col("doc_freq") + 1))
    return counted.select(*by, "term", "doc_freq", weight.alias("idf"))


def tf_idf(tokens: DataFrame, by: list[str] = ENTITY, doc: str = DOC) -> DataFrame:
    """Term count times inverse document frequency.

    A term meets as many rows as its document frequency, so that column tells
    the join which terms are hot.
    """
    weights = pin(idf(tokens, by), "idf")
    weighted = lookup(term_frequency(tokens, by, doc), weights, [*by, "term"], load="doc_freq", nulls=True)
    return weighted.select(*by, doc, "term", "n", (F.col("n") * F.col("idf")).alias("tf_idf"))


def doc_count_check(fitted: DataFrame, tokens: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Compares the document count seen when fitting (``fitted.n_docs``) with the table."""
    table = doc_counts(tokens, by).withColumnRenamed("n_docs", "table_docs")
    seen = fitted.select(*by, F.col("n_docs").alias("fit_docs"))
    both = join_keyed(seen, table, by, "full_outer")
    return both.withColumn("ok", F.coalesce(F.col("fit_docs") == F.col("table_docs"), F.lit(False)))


def doc_length_stats(tokens: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Number of documents, their shortest and total length, and whether all are positive."""
    n = F.size("words")
    return tokens.groupBy(*by).agg(
        F.count("*").alias("n_docs"),
        F.min(n).cast("bigint").alias("min_tokens"),
        F.sum(n).cast("bigint").alias("n_tokens"),
        (F.min(n) > 0).alias("ok"),
    )
