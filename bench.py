"""Time the headline queries; prints one JSON line.

``tokens`` (clean, tokenise, drop stop words and short documents, write) is the
shared first step and is timed on its own, as is the fit of the LDA model.
"""

import json
import os
import time

from chorus.plans import catalog
from chorus.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "dedup_reviews", "newest_n_per_app", "date_cutoff", "min_token_filter", "tokens", "term_frequency",
    "document_frequency", "vocabulary", "tf_idf", "top_terms_by_source", "label_topics", "saliency", "relevance",
    "topic_distance", "topic_by_version", "chunk_ngrams", "topic_result_upsert", "lda_fit", "lda_relevance",
    "topic_summary",
]


def main() -> None:
    spark = local_session(CPUS)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before the clock
    seconds = {}
    for name in HEADLINE:
        query = catalog.tokens if name == "tokens" else catalog.QUERIES[name]
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
