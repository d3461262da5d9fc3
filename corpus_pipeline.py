"""The corpus pipeline: five operators of chorus.llm, applied to documents in turn.

Every stage takes (spark, docs, sf_dir) and gives the rows that stay, with the
columns of documents; the last gives tokens. Rows whose ``doc_id`` is null or
repeated are treated as the operators say.
"""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.llm import bpe, decontaminate, jaccard_join, line_dedup, quality_knn
from chorus.llm.common import fresh, table
from chorus.llm.queries import TOKENIZER
from chorus.operators.scale import work_dir

REJECT_BELOW = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labelled rows it may sample from, does not reject."""
    known = quality_knn.with_labels(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), "quality")
    space = quality_knn.fit(known, "quality")
    mark = fresh(docs.columns, "score")[0]
    return quality_knn.with_score(docs, space, "text", mark).filter(F.col(mark) >= REJECT_BELOW).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat, fuzzily, an earlier one."""
    return line_dedup.dedup_lines(docs)


def join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by shingles of five words and a similarity of 0.8."""
    return jaccard_join.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of the decoded text."""
    return bpe.token_digests(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", join_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]
#: The classifier and the tokenizer cannot be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{work_dir(spark)}/pipeline-{uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
