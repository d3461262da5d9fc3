"""Corpus weights, topic tables and models against plain Python and their invariants."""

import json
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorus.operators import analytics as an
from chorus.operators import corpus, trends
from chorus.operators import topic_model as tm
from chorus.operators.scale import pin, top_n

BY = ["app_id"]


def made_docs():
    """Two apps, one with most of the documents; words drawn unevenly."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(90):
        app, label = ("big" if i % 9 else "small"), rng.choice(["x", "y", "z"])
        weights = [1.0 / (1 + (j + 7 * "xyz".index(label)) % 40) for j in range(40)]
        docs.append((app, i, label, rng.choices(words, weights, k=rng.randrange(4, 30))))
    return docs


@pytest.fixture(scope="module")
def docs():
    return made_docs()


@pytest.fixture(scope="module")
def tokens(spark, docs):
    frame = spark.createDataFrame(docs, "app_id string, review_id int, label string, words array<string>")
    return pin(frame, "tokens")


@pytest.fixture(scope="module")
def tables(tokens):
    made = tm.label_topics(tokens, "label", BY)
    return pin(made.topic_term, "phi"), pin(made.doc_topic, "theta")


@pytest.fixture(scope="module")
def freqs(tables):
    phi, theta = tables
    return an.term_topic_freq(phi, pin(an.topic_mass(theta, BY), "mass"), BY)


def counted(docs):
    """(app, label) -> term counts."""
    found = defaultdict(Counter)
    for app, _, label, words in docs:
        found[app, label].update(words)
    return found


def test_vocabulary(tokens, docs):
    got = {(r.app_id, r.idx): (r.term, r.term_freq, r.doc_freq) for r in corpus.vocabulary(tokens, BY).collect()}
    for app in ("big", "small"):
        own = [set(d[3]) for d in docs if d[0] == app]
        counts = Counter(w for d in docs if d[0] == app for w in d[3])
        for at, (term, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))):
            assert got[app, at] == (term, n, sum(term in words for words in own))
    small = corpus.vocabulary(tokens, BY, size=5)
    assert small.groupBy("app_id").count().collect()[0]["count"] == 5
    common = corpus.vocabulary(tokens, BY, min_df=20).collect()
    assert common and all(r.doc_freq >= 20 for r in common)


def test_tf_idf(tokens, docs):
    got = {(r.review_id, r.term): r.tf_idf for r in corpus.tf_idf(tokens, BY).collect()}
    want = {}
    for app, i, _, words in docs:
        own = [set(d[3]) for d in docs if d[0] == app]
        for term, n in Counter(words).items():
            want[i, term] = n * math.log((len(own) + 1) / (sum(term in w for w in own) + 1))
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want)


def test_document_checks(tokens, docs):
    fits = tokens.groupBy(*BY).agg(F.count("*").alias("n_docs"))
    assert [r.ok for r in corpus.doc_count_check(fits, tokens, BY).collect()] == [True, True]
    off = fits.withColumn("n_docs", F.col("n_docs") + 1)
    assert [r.ok for r in corpus.doc_count_check(off, tokens, BY).collect()] == [False, False]
    stats = {r.app_id: r for r in corpus.doc_length_stats(tokens, BY).collect()}
    assert stats["small"].n_docs == 10 and stats["small"].ok
    assert stats["big"].n_tokens == sum(len(d[3]) for d in docs if d[0] == "big")


def test_saliency_and_relevance(freqs, docs):
    counts = counted(docs)
    salient = {(r.app_id, r.term): r.saliency for r in an.saliency(freqs, BY).collect()}
    relevant = an.relevant_terms(freqs, BY, n=4, steps=2).collect()
    for app in ("big", "small"):
        own = {label: c for (a, label), c in counts.items() if a == app}
        total = sum(sum(c.values()) for c in own.values())
        share = {label: sum(c.values()) / total for label, c in own.items()}
        marginal = sum(own.values(), Counter())
        for term, f in marginal.items():
            parts = [(c[term] / f, share[label]) for label, c in own.items() if c[term]]
            want = f / total * sum(p * math.log(p / q) for p, q in parts)
            assert math.isclose(salient[app, term], want, abs_tol=1e-12)
        for label, c in own.items():
            size = sum(c.values())
            for lam in (0.0, 0.5, 1.0):
                scored = {
                    t: lam * math.log(n / size) + (1 - lam) * math.log(n / size / (marginal[t] / total))
                    for t, n in c.items()
                }
                want = sorted(scored, key=lambda t: (-round(scored[t], 10), t))[:4]
                got = [r for r in relevant if (r.app_id, r.topic, r["lambda"]) == (app, label, lam)]
                assert [r.term for r in sorted(got, key=lambda r: r.rank)] == want


def test_token_table_sums_to_one(freqs):
    shown = an.shown_terms(an.salient_terms(freqs, BY, 5), an.relevant_terms(freqs, BY, 3, 2), BY)
    table = an.token_table(freqs, pin(shown, "shown"), BY)
    sums = table.groupBy(*BY, "term").agg(F.sum("share").alias("s")).collect()
    assert len(sums) == shown.count()
    assert all(math.isclose(r.s, 1.0, abs_tol=1e-12) for r in sums)


def dense_phi(docs, app):
    own = {label: c for (a, label), c in sorted(counted(docs).items()) if a == app}
    terms = sorted(set().union(*own.values()))
    return sorted(own), np.array([[c[t] / sum(c.values()) for t in terms] for c in own.values()])


def divergence(p, q):
    m = (p + q) / 2
    return sum(np.sum(x[x > 0] / 2 * np.log(x[x > 0] / m[x > 0])) for x in (p, q))


def test_topic_distance_and_coordinates(tables, docs):
    phi, _ = tables
    distances = pin(an.topic_distance(phi, BY), "distances")
    got = {(r.app_id, r.topic_a, r.topic_b): r.distance for r in distances.collect()}
    places = an.topic_coordinates(distances, an.topic_list(phi, BY), BY).collect()
    for app in ("big", "small"):
        labels, rows = dense_phi(docs, app)
        for a in range(len(labels)):
            for b in range(a + 1, len(labels)):
                assert math.isclose(got[app, labels[a], labels[b]], divergence(rows[a], rows[b]), abs_tol=1e-12)
        xy = np.array([[r.x, r.y] for r in places if r.app_id == app])
        assert xy.shape == (len(labels), 2) and np.allclose(xy.sum(axis=0), 0)
        # three points fit a plane, so their distances are kept
        for r in places:
            for s in places:
                if r.app_id == s.app_id == app and r.topic < s.topic:
                    assert math.isclose(math.dist((r.x, r.y), (s.x, s.y)), got[app, r.topic, s.topic], abs_tol=1e-9)


def test_one_topic_has_no_pairs_but_a_place(spark):
    phi = spark.createDataFrame([("a", 1, "w", 1.0)], "app_id string, topic int, term string, phi double")
    distances = an.topic_distance(phi, BY)
    assert distances.count() == 0
    assert [tuple(r) for r in an.topic_coordinates(distances, an.topic_list(phi, BY), BY).collect()] == [("a", 1, 0.0, 0.0)]


def test_distance_makes_no_row_per_pair_and_term(tables):
    plan = an.topic_distance(tables[0], BY)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_validation_finds_a_broken_distribution(tables):
    phi, theta = tables
    assert all(r.ok for r in an.summary_validate(phi, theta, BY).collect())
    broken = {r.check: r.ok for r in an.summary_validate(
        phi.withColumn("phi", F.col("phi") * 1.1), theta.withColumn("n_tokens", F.lit(0)), BY
    ).filter("app_id = 'big'").collect()}
    assert broken == {
        "phi_sums_to_one": False, "theta_sums_to_one": True, "lengths_positive": False, "topics_agree": True,
    }


def test_summary_document(tables):
    phi, theta = tables
    rows = {r.app_id: json.loads(r.lda_data) for r in an.topic_summary(phi, theta, BY, n=6, steps=4).collect()}
    assert set(rows) == {"big", "small"}
    doc = rows["big"]
    assert list(doc) == ["mdsDat", "tinfo", "token.table", "R", "lambda.step", "plot.opts", "topic.order"]
    assert doc["mdsDat"]["topics"] == ["x", "y", "z"] and doc["R"] == 6 and doc["lambda.step"] == 0.25
    assert math.isclose(sum(doc["mdsDat"]["Freq"]), 100.0)
    info = doc["tinfo"]
    assert info["Category"][:6] == ["Default"] * 6 and info["logprob"][:6] == [6.0, 5.0, 4.0, 3.0, 2.0, 1.0]
    assert len({len(v) for v in info.values()}) == 1
    assert set(doc["token.table"]["Term"]) == set(info["Term"])


def test_trends(tokens, tables, docs):
    _, theta = tables
    got = {(r.app_id, r.version, r.topic): (r.mean_theta, r.n_docs) for r in trends.topic_by_version(
        theta.withColumn("app_version", (F.col("review_id") % 3).cast("string")), BY).collect()}
    for (app, version, topic), (share, n) in got.items():
        own = [d for d in docs if d[0] == app and str(d[1] % 3) == version]
        assert n == sum(d[2] == topic for d in own) and math.isclose(share, n / len(own))
    rated = trends.topic_by_rating(theta.withColumn("rating", F.col("review_id") % 5), BY)
    for r in rated.collect():
        ids = [d[1] % 5 for d in docs if (d[0], d[2]) == (r.app_id, r.topic)]
        assert math.isclose(r.mean_rating, sum(ids) / len(ids))


SMALL = tm.LdaSettings(n_topics=3, max_iter=4)


def test_lda_tables(tokens, docs):
    made = tm.lda_per_entity(tokens, BY, SMALL)
    fits = {r.app_id: r for r in made.fits.collect()}
    assert fits["big"].n_docs == sum(d[0] == "big" for d in docs) and fits["big"].n_topics == 3
    phi = made.topic_term.groupBy(*BY, "topic").agg(F.sum("phi").alias("s"), F.count("*").alias("n")).collect()
    assert {(r.app_id, r.topic) for r in phi} == {(a, t) for a in ("big", "small") for t in (1, 2, 3)}
    assert all(math.isclose(r.s, 1.0, abs_tol=1e-9) and r.n == fits[r.app_id].n_terms for r in phi)
    theta = made.doc_topic.groupBy("review_id").agg(F.sum("theta").alias("s"), F.count("*").alias("n")).collect()
    assert len(theta) == len(docs) and all(r.n == 3 and math.isclose(r.s, 1.0, abs_tol=1e-9) for r in theta)
    assert all(r.ok for r in an.summary_validate(made.topic_term, made.doc_topic, BY).collect())
    assert set(made.doc_topic.columns) == {"app_id", "review_id", "label", "n_tokens", "topic", "theta"}


def test_lda_repeats_whatever_the_input_layout(tokens):
    one = tokens.filter("app_id = 'big'")

    def phi(frame):
        made = tm.lda_per_entity(frame, BY, SMALL).topic_term
        return {(r.topic, r.term): r.phi for r in made.collect()}

    assert phi(one) == phi(one.repartition(3).orderBy(F.desc("review_id")))


def test_raw_matrix_is_not_a_distribution(tokens):
    one = tokens.filter("app_id = 'small'")
    model = tm.fit_lda(one, pin(corpus.vocabulary(one, BY), "v"), SMALL)
    raw = np.array(model.lda.topicsMatrix().toArray())
    order = {r.term: r.idx for r in model.terms.collect()}
    for r in tm.topic_term(model, normalize=False).collect():
        assert math.isclose(r.phi, raw[order[r.term], r.topic - 1], rel_tol=1e-9) and r.phi == r.weight


def test_empty_corpus_gives_nothing(tokens):
    assert tm.lda_per_entity(tokens.limit(0), BY, SMALL) is None


def test_relevance_ranks_few_terms_and_the_same(spark, monkeypatch):
    """Ties over many terms, null entities and topics with fewer terms than asked for."""
    rows = [(app, t, f"w{i}", float(1 + (i * 7 + len(t)) % 5 if i % 3 else 1)) for app, size in (("a", 900), (None, 40))
            for t in ("x", "yy") for i in range(size) if t == "x" or i % 2]
    frame = spark.createDataFrame([*rows, ("a", "zzz", "only", 1.0)], "app_id string, topic string, term string, freq double")
    whole = frame.groupBy("app_id", "topic").agg(F.sum("freq").alias("total"))
    freqs = frame.join(whole.withColumnRenamed("app_id", "_a").withColumnRenamed("topic", "_t"),
                       F.col("app_id").eqNullSafe(F.col("_a")) & (F.col("topic") == F.col("_t"))).drop("_a", "_t")
    freqs = freqs.withColumn("phi", F.col("freq") / F.col("total")).withColumn("proportion", F.lit(0.5))
    freqs = freqs.withColumn("total", F.lit(5000.0)).localCheckpoint()
    ranked = []

    def noted(df, by, order, n, *rest):
        ranked.append(df)
        return top_n(df, by, order, n, *rest)

    monkeypatch.setattr(an, "top_n", noted)
    got = an.relevant_terms(freqs, ["app_id"], 5, 2)
    lifts = an.log_prob_lift(freqs, ["app_id"]).collect()
    want = set()
    for app, topic in {(r.app_id, r.topic) for r in lifts}:
        for x in (0.0, 0.5, 1.0):
            own = [(-round(x * r.logprob + (1 - x) * r.loglift, 10), r.term) for r in lifts if (r.app_id, r.topic) == (app, topic)]
            want |= {(app, topic, x, i + 1, term) for i, (_, term) in enumerate(sorted(own)[:5])}
    assert {(r.app_id, r.topic, r["lambda"], r["rank"], r.term) for r in got.collect()} == want
    assert ranked[-1].count() < len(lifts)
