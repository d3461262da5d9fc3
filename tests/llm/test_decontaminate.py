"""Containment against plain Python sets, odd inputs, and the pipeline's stages."""

import random
import re

from chorus.llm import decontaminate, queries

DOCS = "doc_id bigint, text string, s int, item_id string"
ITEMS = "item_id bigint, text string, n_item int"


def runs(text, k=5):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({("whole", *w)} if w else set())


def expected(docs, items):
    sets, wanted = {}, {}
    for d, t in docs:
        sets.setdefault(d, set()).update(runs(t))
    for i, t in items:
        wanted.setdefault(i, set()).update(runs(t))
    return sorted(
        ((d, i, len(a & b), len(b), len(a & b) / len(b)) for d, a in sets.items() for i, b in wanted.items()
         if b and 100 * len(a & b) >= 80 * len(b)), key=str,
    )


def got(spark, docs, items):
    d = spark.createDataFrame([(*x, 1, "c") for x in docs], DOCS).repartition(3)
    i = spark.createDataFrame([(*x, 1) for x in items], ITEMS)
    return sorted(map(tuple, decontaminate.contained_items(d, i).collect()), key=str)


def test_passages_in_long_documents(spark):
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(rnd.randrange(3, 90)))) for i in range(40)]
    docs = []
    for d in range(120):
        w = [word() for _ in range(rnd.randrange(400))]
        passage = rnd.choice(items)[1].split()
        for _ in range(rnd.randrange(4)):  # some words changed, dropped or set off by marks
            passage[rnd.randrange(len(passage))] = rnd.choice(["changed", "", "Word!"])
        text = " ".join(w) + "\n" + ", ".join(passage).upper() + ". " + " ".join(w[:20])
        docs.append((d, text))
    docs += [(1000 + i, t) for i, t in items]
    assert got(spark, docs, items) == expected(docs, items)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "one two"), (3, "three four five six seven"), (None, "a b c d e f"), (5, "?!"), (6, "x " * 50_000), (7, "ONE, two."), (7, "ONE, two.")]
    items = [(1, "one two"), (2, None), (3, ""), (None, "a b c d e"), (4, "x x x x x x"), (5, "..."), (1, "one two"), (6, "two one")]
    assert got(spark, docs, items) == expected(docs, items)
    assert got(spark, [], items) == got(spark, docs, []) == []


def test_clean_rows_stay_with_their_columns(spark):
    items = spark.createDataFrame([(1, "a b c d e", 1)], ITEMS)
    rows = [(1, "x a b c d e y", 1, "i"), (2, "x a b c d", 2, "j"), (None, None, None, None), (2, "again", 3, "k")]
    left = decontaminate.decontaminate(spark.createDataFrame(rows, DOCS), items)
    assert left.columns == ["doc_id", "text", "s", "item_id"]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(rows[1:], key=str)


def test_query_and_native_plan(spark, sf_dir):
    read = lambda name, key: [(r[key], r.text) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
    made = queries.op7_decontamination(spark, sf_dir)
    assert sorted(map(tuple, made.collect()), key=str) == expected(read("documents", "doc_id"), read("benchmark", "item_id"))
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
