import random
import re
from collections import Counter
from math import floor, log

import numpy as np

from chorus.llm import ranked_search as rs
from tests.llm.helpers import lowered

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def brute(docs, items, k=10):
    counts = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, every = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in counts:
            m = 10 + 90 * n * n_docs // every
            s = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(TERM.findall(lowered(text))) if c[t]
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def made(docs, items, **options):
    return sorted((tuple(r) for r in rs.ranked(docs, items, **options).collect()), key=repr)


def corpus(seed, n_docs, n_words, vocabulary):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    odds = [1 / (i + 1) for i in range(vocabulary)]
    docs = [(i, " ".join(rnd.choices(words, odds, k=rnd.randrange(1, n_words)))) for i in range(n_docs)]
    return docs, [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 15)))) for i in range(12)]


def test_scores_and_order_as_by_scoring_every_document(spark):
    docs, items = corpus(5, 500, 60, 200)
    docs += [(1000, None), (1001, ""), (1002, "...!?"), (1003, "Über-ÜBER w3\x7fw4 W5"), (None, "w7 w8"), (None, "w9 w7")]
    docs += [(2000 + i, "w150 w151 w7") for i in range(30)] + [(7, "w150 w7"), (7, "w150 w7")]
    items += [(50, None), (51, "--"), (52, "über W150"), (53, "nowhere"), (54, "w150"), (54, "w151")]
    table = spark.createDataFrame(docs, DOCS).repartition(4)
    assert made(table, spark.createDataFrame(items, ITEMS)) == brute(docs, items)
    assert made(table, spark.createDataFrame(items, ITEMS), k=3, terms_at_once=20) == brute(docs, items, 3)


def test_a_long_text_is_ranked_whole(spark):
    docs = [(1, "a " * 300_000 + "needle"), (2, "needle"), (3, "hay " * 50), (4, "other")]
    items = [(0, "needle a " + " ".join(f"q{i}" for i in range(3000)))]
    assert made(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)) == brute(docs, items)


def test_empty_tables_rank_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert made(docs.limit(0), items) == [] and made(docs, items.limit(0)) == []


def test_clashing_columns_and_text_keys(spark):
    docs = [("x", "one two"), ("é", "two three"), ("y", "two")]
    items = [("i", "two")]
    wide = spark.createDataFrame([(*r, 1, "s") for r in docs], "doc_id string, text string, rank int, _item string")
    got = made(wide, spark.createDataFrame([(*r, 2) for r in items], "item_id string, text string, score int"))
    assert [(r[1], r[2]) for r in got] == [(1, "y"), (2, "x"), (3, "é")]


def test_reading_stops_before_the_ends_of_lists():
    rnd = np.random.default_rng(3)
    n_docs = 20_000
    n = np.full(n_docs, 50)
    term = np.tile(np.arange(3), n_docs)
    times = np.ones(3 * n_docs, int)
    top = rnd.choice(n_docs, 10, replace=False)
    times.reshape(-1, 3)[top] = 30
    queries = rs.Queries([0], [np.arange(3)], np.array([500, 400, 300]), n_docs, 50 * n_docs)
    index = rs.Lists(queries, n, np.arange(n_docs + 1) * 3, term, times)
    found, scores, read = index.best(np.arange(3), 10, 1)
    assert sorted(found.tolist()) == sorted(top.tolist()) and len(set(scores.tolist())) == 1
    assert read < 0.05 * len(term)
