"""Topic models: LDA on TF-IDF weights, for one entity or all, and topics given by a label column."""

from dataclasses import dataclass

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import IDF, CountVectorizerModel, IDFModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from chorus.operators import keyed_lda
from chorus.operators.scale import lookup, pin
from chorus.schema import DOC, ENTITY, LDA_ITERATIONS, LDA_SEED, LDA_TOPICS

# The layout of documents, which the fit samples by, follows from their number alone.
DOCS_PER_PARTITION = 1_000
MOST_PARTITIONS = 2_000


@dataclass(frozen=True)
class LdaSettings:
    n_topics: int = LDA_TOPICS
    max_iter: int = LDA_ITERATIONS
    seed: int = LDA_SEED
    vocab_size: int | None = None
    min_df: int = 1


@dataclass(frozen=True)
class TopicModel:
    """One entity's fitted stages; ``terms`` holds (idx, term) on the cluster."""

    counter: CountVectorizerModel
    idf: IDFModel
    lda: LDAModel
    terms: DataFrame
    n_docs: int


def fit_lda(
    tokens: DataFrame,
    terms: DataFrame,
    settings: LdaSettings = LdaSettings(),
    doc: str = DOC,
    n_docs: int | None = None,
) -> TopicModel | None:
    """Fit one entity's LDA; ``None`` when no document or no term is left.

    ``terms`` is the ranked vocabulary (idx, term): fixing it, and the placement
    and order of documents, makes the fit repeatable on any cluster. The
    vocabulary and the topic matrix live on the driver, as Spark's LDA keeps
    them; a caller with more terms than a driver holds sets ``vocab_size``, and
    what that leaves out is reported with the fit. Every partition sends a topic
    matrix to each iteration's sum, so there are few partitions.
    """
    n_docs = tokens.count() if n_docs is None else n_docs
    listed = [r.term for r in terms.orderBy("idx").select("term").collect()]
    if not listed:
        return None
    counter = CountVectorizerModel.from_vocabulary(listed, inputCol="words", outputCol="tf")
    parts = max(1, min(-(-n_docs // DOCS_PER_PARTITION), MOST_PARTITIONS))
    laid = tokens.select(doc, "words").repartition(parts, doc).sortWithinPartitions(doc)
    counts = counter.transform(laid).select("tf")
    weights = IDF(inputCol="tf", outputCol="tf_idf").fit(counts)
    if not weights.numDocs:
        return None
    # every iteration reads all vectors; a lost block is rebuilt from the written tokens
    vectors = weights.transform(counts).select("tf_idf").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lda = LDA(
            k=settings.n_topics, maxIter=settings.max_iter, seed=settings.seed, featuresCol="tf_idf"
        ).fit(vectors)
    finally:
        vectors.unpersist()
    return TopicModel(counter, weights, lda, terms.select("idx", "term"), weights.numDocs)


def topic_term(model: TopicModel, normalize: bool = True) -> DataFrame:
    """(topic, term, weight, phi): topics count from 1; phi sums to 1 over a topic's terms.

    ``weight`` is the model's own unnormalised matrix entry; with
    ``normalize=False`` it is also reported as phi.
    """
    totals = [float(x) for x in model.lda.topicsMatrix().toArray().sum(axis=0)]
    mass = F.element_at(F.array(*[F.lit(x) for x in totals]), F.col("topic"))
    listed = model.lda.describeTopics(model.lda.vocabSize()).select(
        (F.col("topic") + 1).alias("topic"),
        F.inline(F.arrays_zip(F.col("termIndices").alias("idx"), F.col("termWeights").alias("share"))),
    )
    named = lookup(listed.withColumn("idx", F.col("idx").cast("bigint")), model.terms, ["idx"])
    weight = F.col("share") * mass
    phi = F.col("share") if normalize else weight
    return named.select("topic", "term", weight.alias("weight"), phi.alias("phi"))


def doc_topic(model: TopicModel, tokens: DataFrame) -> DataFrame:
    """(all token columns but words, n_tokens, topic, theta): one row per document and topic.

    Document length rides along, so topic mass needs no join with lengths.
    """
    others = [c for c in tokens.columns if c != "words"]
    counted = model.counter.transform(tokens.withColumn("n_tokens", F.size("words").cast("bigint")))
    scored = model.lda.transform(model.idf.transform(counted))
    spread = scored.select(
        *others, "n_tokens", F.posexplode(vector_to_array("topicDistribution")).alias("topic", "theta")
    )
    return spread.withColumn("topic", F.col("topic") + 1)


@dataclass(frozen=True)
class TopicTables:
    """Tables of all entities: phi (topic_term), theta (doc_topic) and one row per fit."""

    topic_term: DataFrame
    doc_topic: DataFrame
    fits: DataFrame


def lda_per_entity(
    tokens: DataFrame,
    by: list[str] = ENTITY,
    settings: LdaSettings = LdaSettings(),
    doc: str = DOC,
) -> TopicTables | None:
    """One model per entity over shared, already tokenised input, all fitted in the same jobs.

    Null and empty keys are entities like any other. ``fits`` tells how many
    terms were seen and used, how many tokens the model does not know, and how
    many documents hold no known term. ``None`` when no entity has anything to
    fit. The method and its layout are described in ``keyed_lda``.
    """
    made = keyed_lda.fit(
        tokens, by, doc, settings.n_topics, settings.max_iter, settings.seed, settings.vocab_size, settings.min_df
    )
    return None if made is None else TopicTables(*made)


def label_topics(tokens: DataFrame, label: str, by: list[str] = ENTITY, doc: str = DOC) -> TopicTables:
    """Topics given by a label column: phi = P(term given label), theta = 1 for the own label."""
    keys = [*by, "topic"]
    labelled = tokens.withColumn("topic", F.col(label))
    terms = labelled.select(*keys, F.explode("words").alias("term"))
    counts = terms.groupBy(*keys, "term").agg(F.count("*").alias("weight"))
    totals = labelled.groupBy(*keys).agg(F.sum(F.size("words")).alias("_all"))
    phi = lookup(counts, pin(totals, "label_totals"), keys, nulls=True).withColumn("phi", F.col("weight") / F.col("_all")).drop("_all")
    theta = labelled.withColumn("n_tokens", F.size("words").cast("bigint")).withColumn("theta", F.lit(1.0))
    fits = tokens.groupBy(*by).agg(F.count("*").alias("n_docs"))
    return TopicTables(phi, theta.drop("words"), fits)

