"""Tables that describe topics and terms, per entity.

Inputs are long tables: ``topic_term`` (entity, topic, term, phi), ``doc_topic``
(entity, document, topic, theta, n_tokens). Definitions follow Chuang, Manning &
Heer 2012 (saliency) and Sievert & Shirley 2014 (relevance and the topic view).
"""

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorus.operators.scale import join_keyed, lookup, pin, semi, top_n
from chorus.schema import DOC, ENTITY

TOP_TERMS = 30
LAMBDA_STEPS = 10
#: One term in this many, by hash, sets the bar below which no term is ranked.
CUT_BY = 16


def _order(value: Column | str) -> Column:
    """Rank on a value rounded past summation noise, so equal terms tie and go by name."""
    return F.round(value, 10).desc()


def align_docs(doc_topic: DataFrame, lengths: DataFrame, by: list[str] = ENTITY, doc: str = DOC) -> DataFrame:
    """Topic shares and lengths of the same documents, matched by key."""
    return join_keyed(doc_topic, lengths, [*by, doc])


def topic_mass(doc_topic: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Estimated tokens of each topic (theta weighted by length) and their share of the entity.

    ``total`` is the entity's token count, kept for later shares.
    """
    mass = doc_topic.groupBy(*by, "topic").agg(F.sum(F.col("theta") * F.col("n_tokens")).alias("mass"))
    whole = F.sum("mass").over(Window.partitionBy(*by))
    return mass.withColumn("total", whole).withColumn("proportion", F.try_divide("mass", "total"))


def topic_proportion(doc_topic: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    return topic_mass(doc_topic, by).select(*by, "topic", "proportion")


def term_topic_freq(topic_term: DataFrame, mass: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Estimated count of each term in each topic, with the topic's share alongside."""
    shares = mass.select(*by, "topic", "mass", "total", "proportion")
    joined = lookup(topic_term.select(*by, "topic", "term", "phi"), shares, [*by, "topic"], nulls=True)
    return joined.withColumn("freq", F.col("mass") * F.col("phi")).drop("mass")


def term_marginal(freqs: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Estimated count of each term over all topics, and its share of the entity's tokens."""
    return (
        freqs.groupBy(*by, "term")
        .agg(F.sum("freq").alias("freq"), F.max("total").alias("total"))
        .withColumn("share", F.col("freq") / F.col("total"))
        .drop("total")
    )


def saliency(freqs: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """How much a term tells about topics, weighted by how common it is.

    p_w * sum_k P(k|w) ln(P(k|w) / P(k)), rearranged over counts f_k with sum F
    to (sum_k f_k ln(f_k / P(k)) - F ln F) / total: one grouping by term.
    """
    surprise = F.when(F.col("freq") > 0, F.col("freq") * F.log(F.col("freq") / F.col("proportion")))
    sums = freqs.groupBy(*by, "term").agg(
        F.sum("freq").alias("freq"), F.sum(surprise).alias("_s"), F.max("total").alias("_t")
    )
    value = (F.col("_s") - F.col("freq") * F.log("freq")) / F.col("_t")
    return sums.filter(F.col("freq") > 0).select(*by, "term", "freq", value.alias("saliency"))


def salient_terms(freqs: DataFrame, by: list[str] = ENTITY, n: int = TOP_TERMS) -> DataFrame:
    return top_n(saliency(freqs, by), by, [_order("saliency"), F.col("term").asc()], n)


def log_prob_lift(freqs: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """ln phi and ln(phi / p_w) for terms that occur in the topic."""
    marginal = F.sum("freq").over(Window.partitionBy(*by, "term"))
    return (
        freqs.withColumn("term_total", marginal)
        .filter(F.col("phi") > 0)
        .withColumn("logprob", F.log("phi"))
        .withColumn("loglift", F.log(F.col("phi") * F.col("total") / F.col("term_total")))
        .drop("total", "proportion")
    )


def relevant_terms(
    freqs: DataFrame, by: list[str] = ENTITY, n: int = TOP_TERMS, steps: int = LAMBDA_STEPS
) -> DataFrame:
    """The ``n`` most relevant terms of each topic for every lambda = 0, 1/steps, ..., 1.

    The n-th best of some of the terms is a bar that the n best of all reach, so
    a term is ranked for those lambdas alone where it reaches the bar.
    """
    lifts = log_prob_lift(freqs, by)
    values = {i / steps: (i / steps) * F.col("logprob") + (1 - i / steps) * F.col("loglift") for i in range(steps + 1)}
    each = [F.struct(F.lit(x).alias("lambda"), value.alias("relevance")) for x, value in values.items()]
    order = [_order("relevance"), F.col("term").asc()]

    def best(rows: DataFrame, entries: Column) -> DataFrame:
        scored = rows.withColumn("_e", F.explode(entries)).select(*lifts.columns, "_e.*")
        return top_n(scored, [*by, "topic", "lambda"], order, n)

    some = lifts.filter(F.pmod(F.xxhash64("term"), F.lit(CUT_BY)) == 0)
    last = best(some, F.array(*each)).filter(F.col("rank") == n)
    bars = last.groupBy(*by, "topic").agg(*[
        F.max(F.when(F.col("lambda") == x, F.struct(F.round("relevance", 10).alias("v"), "term"))).alias(f"_bar{i}")
        for i, x in enumerate(values)
    ])
    barred = lookup(lifts, pin(bars, "bars"), [*by, "topic"], how="left", nulls=True)
    passed = [F.when(_reaches(value, F.col(f"_bar{i}")), entry) for i, (value, entry) in enumerate(zip(values.values(), each, strict=True))]
    return best(barred, F.array_compact(F.array(*passed)))


def _reaches(value: Column, bar: Column) -> Column:
    """Whether a row is not behind the one at the bar in value, rounded as for ranking, and then term; true without a bar."""
    rounded = F.round(value, 10)
    near = (rounded > bar["v"]) | ((rounded == bar["v"]) & (F.col("term") <= bar["term"]))
    # rounding is dear: only values as good as equal need it
    ahead = F.when(value > bar["v"] + 1e-9, True).when(value < bar["v"] - 1e-9, False).otherwise(near)
    return F.coalesce(ahead, F.lit(True))


def top_terms_per_topic(topic_term: DataFrame, by: list[str] = ENTITY, n: int = 10) -> DataFrame:
    """The words that describe each topic: its most probable terms."""
    terms = topic_term.select(*by, "topic", "term", "phi")
    return top_n(terms, [*by, "topic"], [_order("phi"), F.col("term").asc()], n)


def shown_terms(salient: DataFrame, relevant: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    return salient.select(*by, "term").unionByName(relevant.select(*by, "term")).distinct()


def token_table(freqs: DataFrame, shown: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """P(topic given term) for every shown term, over the topics it occurs in."""
    kept = semi(freqs.filter(F.col("freq") > 0), shown, [*by, "term"], nulls=True)
    whole = F.sum("freq").over(Window.partitionBy(*by, "term"))
    return kept.select(*by, "topic", "term", (F.col("freq") / whole).alias("share"))


def topic_list(topic_term: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Topics of each entity with their 0-based position; a model has few."""
    seat = F.row_number().over(Window.partitionBy(*by).orderBy("topic")) - 1
    return topic_term.select(*by, "topic").distinct().withColumn("seat", seat)


def topic_pairs(topics: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Every unordered pair of an entity's topics, smaller first."""
    left = topics.select(*by, F.col("topic").alias("topic_a"), F.col("seat").alias("a"))
    right = topics.select(
        *[F.col(c).alias(f"_b_{c}") for c in by], F.col("topic").alias("topic_b"), F.col("seat").alias("b")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in by]
    joined = left.join(right, [*same, F.col("a") < F.col("b")])
    return joined.select(*by, "topic_a", "topic_b", "a", "b")


def _xlogx(p: Column) -> Column:
    return F.when(p > 0, p * F.log(p)).otherwise(F.lit(0.0))


def topic_distance(topic_term: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Jensen-Shannon divergence (natural log) of every topic pair.

    JS = (H_a + H_b) / 2 - H_ab with H = sum p ln p. Each term turns into one
    vector holding its contribution to all H and H_ab, and vectors are summed
    inside the tasks, so no row per pair and term is ever produced or shuffled.
    Seats an entity does not use stay zero and belong to no pair.
    """
    topics = pin(topic_list(topic_term, by), "topics")
    k = (topics.agg(F.max("seat")).first()[0] or 0) + 1
    seated = lookup(topic_term.select(*by, "topic", "term", "phi"), topics, [*by, "topic"], nulls=True)
    at_seat = [F.sum(F.when(F.col("seat") == i, F.col("phi")).otherwise(0.0)).alias(f"_p{i}") for i in range(k)]
    by_term = seated.groupBy(*by, "term").agg(*at_seat)
    terms = by_term.select(*by, F.explode(F.array(F.array(*[f"_p{i}" for i in range(k)]))).alias("_p"))
    mixed = F.flatten(F.transform("_p", lambda p, i: F.transform(
        F.slice("_p", i + 2, F.size("_p")), lambda q: _xlogx((p + q) / 2)
    )))
    parts = terms.select(*by, array_to_vector(F.concat(F.transform("_p", _xlogx), mixed)).alias("_v"))
    sums = parts.groupBy(*by).agg(vector_to_array(Summarizer.sum(F.col("_v"))).alias("_h"))
    a, b = F.col("a"), F.col("b")
    slot = (k + a * (2 * k - a - 1) / 2 + (b - a - 1)).cast("int")
    value = (F.get("_h", a) + F.get("_h", b)) / 2 - F.get("_h", slot)
    seen = join_keyed(topic_pairs(topics, by), sums, by)
    return seen.select(*by, "topic_a", "topic_b", F.greatest(value, F.lit(0.0)).alias("distance"))


def _scale(pdf: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    """Classical two-dimensional scaling of one entity's small distance table."""
    topics = sorted(set(pdf["topic_a"]), key=lambda t: (t is None or t != t, t))
    seat = {t: i for i, t in enumerate(topics)}
    k = len(topics)
    square = np.zeros((k, k))
    square[[seat[t] for t in pdf["topic_a"]], [seat[t] for t in pdf["topic_b"]]] = pdf["distance"]
    center = np.eye(k) - 1.0 / k
    values, vectors = np.linalg.eigh(-0.5 * center @ (square**2) @ center)
    places = np.zeros((k, 2))
    for axis, at in enumerate(np.argsort(values)[::-1][:2]):
        way = vectors[:, at] * np.sqrt(max(values[at], 0.0))
        places[:, axis] = way * (np.sign(way[np.argmax(np.abs(way))]) or 1.0)
    out = pdf[by].iloc[:1].merge(pd.DataFrame({"topic": topics}), how="cross")
    return out.assign(x=places[:, 0], y=places[:, 1])


def topic_coordinates(distances: DataFrame, topics: DataFrame, by: list[str] = ENTITY) -> DataFrame:
    """Two-dimensional map of the topics. A group is one entity's k x k distances."""
    cells = distances.select(*by, "topic_a", "topic_b", "distance")
    mirrored = distances.select(
        *by, F.col("topic_b").alias("topic_a"), F.col("topic_a").alias("topic_b"), "distance"
    )
    diagonal = topics.select(
        *by, F.col("topic").alias("topic_a"), F.col("topic").alias("topic_b"), F.lit(0.0).alias("distance")
    )
    shape = T.StructType([topics.schema[c] for c in [*by, "topic"]]).add("x", "double").add("y", "double")
    square = cells.unionByName(mirrored).unionByName(diagonal)
    return square.groupBy(*by).applyInPandas(lambda pdf: _scale(pdf, by), shape)


def summary_validate(
    topic_term: DataFrame, doc_topic: DataFrame, by: list[str] = ENTITY, doc: str = DOC, tolerance: float = 1e-6
) -> DataFrame:
    """One row per entity and check: distributions sum to 1, lengths are positive, topics agree."""
    phi = topic_term.groupBy(*by, "topic").agg(F.sum("phi").alias("s"))
    phi = phi.groupBy(*by).agg(F.max(F.abs(F.col("s") - 1)).alias("phi_gap"), F.count("*").alias("phi_topics"))
    docs = doc_topic.groupBy(*by, doc).agg(F.sum("theta").alias("s"), F.min("n_tokens").alias("n"))
    docs = docs.groupBy(*by).agg(
        F.max(F.abs(F.col("s") - 1)).alias("theta_gap"),
        F.min("n").alias("shortest"),
    )
    seen = doc_topic.select(*by, "topic").distinct().groupBy(*by).agg(F.count("*").alias("theta_topics"))
    both = join_keyed(join_keyed(phi, docs, by, "full_outer"), seen, by, "full_outer")
    checks = {
        "phi_sums_to_one": F.col("phi_gap") <= tolerance,
        "theta_sums_to_one": F.col("theta_gap") <= tolerance,
        "lengths_positive": F.col("shortest") > 0,
        "topics_agree": F.col("phi_topics") == F.col("theta_topics"),
    }
    rows = [
        F.struct(F.lit(name).alias("check"), F.coalesce(ok, F.lit(False)).alias("ok"))
        for name, ok in checks.items()
    ]
    return both.select(*by, F.inline(F.array(*rows)))


def _fold(rows: DataFrame, by: list[str], order: list[str], fields: list[str], out: str) -> DataFrame:
    """Rows of each entity as one struct of parallel arrays, in the given order."""
    entry = F.struct(*order, F.struct(*fields).alias("_entry"))
    sorted_rows = F.array_sort(F.collect_list(entry))
    folded = rows.groupBy(*by).agg(F.transform(sorted_rows, lambda r: r["_entry"]).alias("_rows"))
    arrays = [F.col("_rows").getField(name).alias(name) for name in fields]
    return folded.select(*by, F.struct(*arrays).alias(out))


def topic_summary(
    topic_term: DataFrame,
    doc_topic: DataFrame,
    by: list[str] = ENTITY,
    n: int = TOP_TERMS,
    steps: int = LAMBDA_STEPS,
) -> DataFrame:
    """One JSON document (``lda_data``) per entity in the layout a topic viewer reads.

    Everything folded into a document is already cut to the shown terms, so its
    size depends on topics, ``n`` and ``steps`` but not on the number of reviews.
    Both inputs are read several times: pass written tables.
    """
    mass = pin(topic_mass(doc_topic, by), "topic_mass")
    freqs = term_topic_freq(topic_term, mass, by)
    salient = pin(salient_terms(freqs, by, n), "salient")
    relevant = pin(relevant_terms(freqs, by, n, steps), "relevant")
    places = topic_coordinates(topic_distance(topic_term, by), topic_list(topic_term, by), by)

    map_rows = join_keyed(mass, places, [*by, "topic"]).select(
        *by, "x", "y", F.col("topic").alias("topics"), F.lit(1).alias("cluster"),
        (F.col("proportion") * 100).alias("Freq"),
    )
    overall = salient.select(
        *by, F.lit(None).cast(mass.schema["topic"].dataType).alias("topic"), F.col("rank").alias("_rank"),
        F.col("term").alias("Term"), F.col("freq").alias("Freq"), F.col("freq").alias("Total"),
        F.lit("Default").alias("Category"),
        (n + 1.0 - F.col("rank")).alias("logprob"), (n + 1.0 - F.col("rank")).alias("loglift"),
    )
    per_topic = relevant.groupBy(*by, "topic", "term").agg(
        F.min("rank").alias("_rank"), F.max("freq").alias("Freq"), F.max("term_total").alias("Total"),
        F.max("logprob").alias("logprob"), F.max("loglift").alias("loglift"),
    ).withColumnRenamed("term", "Term").withColumn("Category", F.concat(F.lit("Topic"), F.coalesce(F.col("topic").cast("string"), F.lit(""))))
    shares = token_table(freqs, shown_terms(salient, relevant, by), by).select(
        *by, F.col("topic").alias("Topic"), F.col("share").alias("Freq"), F.col("term").alias("Term")
    )

    parts = _fold(map_rows, by, ["topics"], ["x", "y", "topics", "cluster", "Freq"], "mdsDat")
    info = ["Term", "Freq", "Total", "Category", "logprob", "loglift"]
    parts = join_keyed(parts, _fold(overall.unionByName(per_topic), by, ["topic", "_rank", "Term"], info, "tinfo"), by)
    parts = join_keyed(parts, _fold(shares, by, ["Term", "Topic"], ["Topic", "Freq", "Term"], "token.table"), by)
    document = F.struct(
        "mdsDat", "tinfo", F.col("`token.table`"), F.lit(n).alias("R"), F.lit(1 / steps).alias("lambda.step"),
        F.struct(F.lit("PC1").alias("xlab"), F.lit("PC2").alias("ylab")).alias("plot.opts"),
        F.col("mdsDat.topics").alias("topic.order"),
    )
    return parts.select(*by, F.to_json(document).alias("lda_data"))
