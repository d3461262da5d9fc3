"""The keyed fit of all entities against a plain variational fit, and its jobs, copies and odd rows."""

import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chorus.operators import corpus, keyed_lda
from chorus.operators import topic_model as tm
from chorus.operators.scale import pin

BY = ["app_id"]
SHAPE = "app_id string, review_id int, words array<string>"


def test_digamma():
    euler = 0.5772156649015329
    x = np.array([1.0, 2.0, 0.5, 10.0, 1e-3])
    want = [-euler, 1 - euler, -euler - 2 * math.log(2), sum(1 / i for i in range(1, 10)) - euler, -1000.5755719318103]
    assert np.allclose(keyed_lda.digamma(x, np.log), want, rtol=1e-11)


def plain_fit(docs, start, k, rounds):
    """Variational Bayes one document and one entity at a time, with dense matrices."""
    terms = sorted({w for d in docs for w in d})
    at = {w: i for i, w in enumerate(terms)}
    df = Counter(w for d in docs for w in set(d))
    bags = []
    for d in docs:
        counts = Counter(d)
        bags.append((np.array([at[w] for w in counts]), np.array(
            [n * math.log((len(docs) + 1) / (df[w] + 1)) for w, n in counts.items()])))
    lam = np.array([[start[w][t] for w in terms] for t in range(k)]) + 1 / k

    def settle(ids, weight, beta):
        gamma = np.ones(k)
        for _ in range(200):
            share = np.exp(keyed_lda.digamma(gamma, np.log) - keyed_lda.digamma(gamma.sum(), np.log))
            new = 1 / k + share * (beta[:, ids] @ (weight / (share @ beta[:, ids] + 1e-100)))
            done = np.abs(new - gamma).mean() < 1e-3
            gamma = new
            if done:
                break
        return gamma, np.exp(keyed_lda.digamma(gamma, np.log) - keyed_lda.digamma(gamma.sum(), np.log))

    for step in range(rounds + 1):
        beta = np.exp(keyed_lda.digamma(lam, np.log) - keyed_lda.digamma(lam.sum(1, keepdims=True), np.log))
        found = [settle(*bag, beta) for bag in bags]
        if step == rounds:
            break
        sums = np.zeros_like(lam)
        for (ids, weight), (_, share) in zip(bags, found, strict=True):
            sums[:, ids] += share[:, None] * beta[:, ids] * weight / (share @ beta[:, ids] + 1e-100)
        lam = sums + 1 / k
    return terms, lam, [g / g.sum() for g, _ in found]


def made(apps, n=40, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    return [
        (app, i, rng.choices(words[15 * (i % 2):15 * (i % 2) + 15], k=rng.randrange(3, 12)))
        for app in apps for i in range(n)
    ]


def test_fit_equals_a_plain_one(spark, monkeypatch):
    monkeypatch.setattr(keyed_lda, "DOCS_PER_BLOCK", 7)
    docs = [*made(["a", None]), *made(["b"], 5)]
    docs += [docs[0]] * 9 + [("a", None, ["w1", "w2", "w2"])] * 4
    got = tm.lda_per_entity(spark.createDataFrame(docs, SHAPE), BY, tm.LdaSettings(3, 4))
    words = spark.createDataFrame([(f"w{i}",) for i in range(30)], "word string")
    start = {r.word: np.array(r.s) / keyed_lda.UNIT for r in words.select("word", keyed_lda._start(3, 42).alias("s")).collect()}
    weights = {(r.app_id, r.term, r.topic): r for r in got.topic_term.collect()}
    thetas = {(r.app_id, r.review_id, r.topic): r.theta for r in got.doc_topic.collect()}
    n_rows = got.doc_topic.count()
    assert n_rows == 3 * len(docs)
    for app in ("a", None, "b"):
        own = [d for d in docs if d[0] == app]
        terms, lam, theta = plain_fit([d[2] for d in own], start, 3, 4)
        assert {t for a, t, _ in weights if a == app} == set(terms)
        for j, term in enumerate(terms):
            for t in range(3):
                row = weights[app, term, t + 1]
                assert row.weight == pytest.approx(lam[t, j], abs=2e-3)
                assert row.phi == pytest.approx(lam[t, j] / lam[t].sum(), abs=1e-3)
        for d, shares in zip(own, theta, strict=True):
            assert [thetas[app, d[1], t + 1] for t in range(3)] == pytest.approx(list(shares), abs=2e-3)


def jobs(spark, frame, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(name, name)
    try:
        tm.lda_per_entity(frame, BY, tm.LdaSettings(2, 2))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(name))


def test_as_many_jobs_for_four_entities_as_for_twenty(spark):
    few, many = (
        pin(spark.createDataFrame(made([f"a{i}" for i in range(n)], 20), SHAPE), "t") for n in (4, 20)
    )
    assert jobs(spark, few, "few") == jobs(spark, many, "many")


def test_topics_part_what_never_meets(spark):
    got = tm.lda_per_entity(spark.createDataFrame(made(["a"], 200), SHAPE), BY, tm.LdaSettings(2, 30))
    best = got.doc_topic.groupBy("review_id").agg(F.max_by("topic", "theta").alias("t")).collect()
    assert len({r.t for r in best if r.review_id % 2}) == 1 and len({r.t for r in best}) == 2
    assert sum(r.t == best[0].t for r in best) == 100


def test_documents_and_entities_without_terms(spark):
    rows = [("a", 1, ["x", "y"]), ("a", 2, ["x", "z"]), ("a", 3, []), ("b", 4, []), ("c", None, ["only"])]
    got = tm.lda_per_entity(spark.createDataFrame(rows, SHAPE), BY, tm.LdaSettings(2, 2))
    assert {(r.app_id, r.n_docs, r.n_docs_without_term, r.n_terms) for r in got.fits.collect()} == {
        ("a", 3, 1, 3), ("c", 1, 0, 1)}
    shares = {(r.review_id, r.topic): r.theta for r in got.doc_topic.collect()}
    assert shares[3, 1] == shares[3, 2] == 0.5 and shares[None, 1] == 0.5 and len(shares) == 8


def test_an_iteration_reads_one_packed_row_per_block(spark, monkeypatch):
    monkeypatch.setattr(keyed_lda, "DOCS_PER_BLOCK", 10)
    written = {}

    def noted(df, label, *by):
        return written.setdefault(label, pin(df, label, *by))

    monkeypatch.setattr(keyed_lda, "pin", noted)
    docs = [*made(["a"], 45), ("a", 45, ["w1"]), *made([None], 3)]
    tm.lda_per_entity(spark.createDataFrame(docs, SHAPE), BY, tm.LdaSettings(2, 1))
    blocks = written["blocks"].collect()
    assert len(blocks) == len({b.block for b in blocks}) <= 6
    assert sum(len(b.seat) for b in blocks) == sum(len(set(words)) for _, _, words in docs)
    assert all(sum(b["size"]) == len(b.seat) and b.known == sorted(set(b.known)) for b in blocks)


def test_an_iteration_sends_one_row_per_group_and_shelf(spark, monkeypatch):
    monkeypatch.setattr(keyed_lda, "DOCS_PER_BLOCK", 10)
    monkeypatch.setattr(keyed_lda, "ENTRIES_PER_GROUP", 100)
    written = []

    def noted(df, label, *by):
        written.append((label, pin(df, label, *by)))
        return written[-1][1]

    monkeypatch.setattr(keyed_lda, "pin", noted)
    docs = [("a", i, [f"w{i % 50}", *[f"w{(7 * i + j) % 400}" for j in range(8)]]) for i in range(200)]
    got = tm.lda_per_entity(spark.createDataFrame(docs, SHAPE), BY, tm.LdaSettings(2, 2))
    tables = dict(written)
    groups = tables["groups"].select("group").distinct().count()
    shelves = tables["shelves"].count()
    assert 4 <= groups <= 20 and 1 < shelves <= 4
    for rows in (rows for label, rows in written if label == "topics"):
        assert rows.filter("to IS NOT NULL").count() <= groups * shelves
        assert rows.count() <= groups * shelves + 2 * shelves
    assert got.topic_term.count() == 2 * 400 and got.fits.first().n_terms == 400


def test_words_are_counted_without_moving_documents(spark):
    rows = [(1, ["b", "a", "b", None, "", "b", None]), (2, []), (3, None), (4, ["x"]), (5, ["y", "y"])]
    frame = spark.createDataFrame(rows, "i int, words array<string>")
    got = corpus.counted_words(frame)
    assert {r.i: None if r.said is None else {x.term: x.n for x in r.said} for r in got.collect()} == {
        1: {"b": 3, "a": 1, None: 2, "": 1}, 2: None, 3: None, 4: {"x": 1}, 5: {"y": 2}}
    docs = [(i, [f"w{(i * j) % 13}" for j in range(i % 9)]) for i in range(60)]
    frame = spark.createDataFrame(docs, "i int, words array<string>").withColumn("app_id", F.lit("a"))
    listed = corpus.vocabulary(corpus.counted_words(frame), BY, said="said")
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, corpus.vocabulary(frame, BY, "i").collect()))
    plan = corpus.counted_words(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("sort_array") == 1


def test_messages_of_old_iterations_are_deleted(spark, monkeypatch):
    written = []

    def noted(df, label, *by):
        written.append((label, pin(df, label, *by)))
        return written[-1][1]

    monkeypatch.setattr(keyed_lda, "pin", noted)
    got = tm.lda_per_entity(spark.createDataFrame(made(["a", None]), SHAPE), BY, tm.LdaSettings(2, 6))
    paths = [df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://") for label, df in written if label == "topics"]
    assert [Path(p).exists() for p in paths] == [False] * 4 + [True] * 3
    assert got.topic_term.count() == 2 * 2 * 30


def test_shares_of_documents_that_settle_at_different_steps():
    rng = np.random.default_rng(5)
    sizes = np.array([1, 40, 3, 200, 9])
    weight, beta = rng.random(sizes.sum()) * 5, rng.random((3, sizes.sum())) ** 4
    counts, share = keyed_lda.shares_of(sizes, weight, beta, 1 / 3)
    for d, (at, n) in enumerate(zip(np.cumsum(sizes) - sizes, sizes, strict=True)):
        alone, own = keyed_lda.shares_of(sizes[d:d + 1], weight[at:at + n], beta[:, at:at + n], 1 / 3)
        assert np.allclose(counts[:, d], alone[:, 0], rtol=1e-12) and np.allclose(share[:, d], own[:, 0], rtol=1e-12)


def test_documents_settle_in_strips_some_at_a_time(monkeypatch):
    monkeypatch.setattr(keyed_lda, "STRIP", 8)
    monkeypatch.setattr(keyed_lda, "STRIPS_AT_ONCE", 5)
    rng = np.random.default_rng(7)
    sizes = np.array([1, 8, 9, 70, 3, 3, 16, 5, 24])
    weight, beta = rng.random(sizes.sum()) * 5, rng.random((3, sizes.sum())) ** 4
    asked, settled = [], keyed_lda._settled
    monkeypatch.setattr(keyed_lda, "_settled", lambda *a: asked.append(a[1]) or settled(*a))
    counts, share = keyed_lda.shares_of(sizes, weight, beta, 1 / 3)
    assert len(asked) > 2 and np.concatenate(asked).tolist() == (-(-sizes // 8)).tolist()
    assert all(sum(strips[1:]) < 5 for strips in asked)
    for d, (at, n) in enumerate(zip(np.cumsum(sizes) - sizes, sizes, strict=True)):
        own, met_by, gamma = weight[at:at + n], beta[:, at:at + n], np.ones(3)
        for _ in range(keyed_lda.MOST_STEPS):
            each = np.exp(keyed_lda.digamma(gamma, np.log) - keyed_lda.digamma(gamma.sum(), np.log))
            new = 1 / 3 + each * (met_by @ (own / (each @ met_by + 1e-100)))
            done, gamma = np.abs(new - gamma).mean() < keyed_lda.SETTLED, new
            if done:
                break
        assert np.allclose(counts[:, d], gamma, rtol=1e-10)
        assert np.allclose(share[:, d], keyed_lda._log_shares(gamma[:, None])[:, 0], rtol=1e-10)


def test_documents_still_open_settle_together_with_the_next_ones(monkeypatch):
    monkeypatch.setattr(keyed_lda, "STRIP", 8)
    monkeypatch.setattr(keyed_lda, "STRIPS_AT_ONCE", 12)
    rng = np.random.default_rng(11)
    sizes = np.tile([40, *[2] * 7], 12)
    weight, beta = rng.random(sizes.sum()) * 5, rng.random((3, sizes.sum())) ** 4
    steps, shares = [], keyed_lda._log_shares
    monkeypatch.setattr(keyed_lda, "_log_shares", lambda x: steps.append(x.shape[1]) or shares(x))
    counts, _ = keyed_lda.shares_of(sizes, weight, beta, 1 / 3)
    together, apart, first = len(steps), 0, np.cumsum(sizes) - sizes
    for d in range(0, len(sizes), 8):
        steps.clear()
        own = slice(first[d], first[d] + 54)
        alone, _ = keyed_lda.shares_of(sizes[d:d + 8], weight[own], beta[:, own], 1 / 3)
        assert np.allclose(counts[:, d:d + 8], alone, rtol=1e-12)
        apart += len(steps)
    assert 2 * together < apart


def test_a_group_holds_what_it_has_per_entry_in_bytes():
    blocks = [([3, 8, 9], [0, 1, 2, 0], [1.5, 2.0, 0.5, 4.0], [1, 2], [3, 1]), ([5, 9], [1], [7.0], [4], [1])]
    made = pa.table({
        "group": [6, 6], "known": [x[0] for x in blocks], "seat": pa.array([x[1] for x in blocks], pa.list_(pa.int32())),
        "weight": [x[2] for x in blocks], "bag": [x[3] for x in blocks], "copies": [[1] * len(x[3]) for x in blocks],
        "size": pa.array([x[4] for x in blocks], pa.list_(pa.int32())),
    })
    got = keyed_lda._grouped(np.array([2, 7]))(made)
    known = got["known"][0].as_py()
    assert sorted(known) == [3, 5, 8, 9] and got["known"].to_pylist()[1] == []
    for row, (terms, seat, weight, _, _) in zip(got.to_pylist(), blocks, strict=True):
        assert np.frombuffer(row["seat"], np.int32).tolist() == seat
        assert np.frombuffer(row["weight"], np.float64).tolist() == weight
        assert [known[i] for i in np.frombuffer(row["place"], np.int32)] == terms
