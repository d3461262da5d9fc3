"""Rules and classifier: counts against plain Python, judgements on labelled rows, odd inputs."""

import re
import zlib

import numpy as np
import pytest

from chorus.llm import quality_knn, quality_rules, queries
from tests.llm.helpers import words

SCHEMA = "doc_id bigint, text string, kept string, _n int, _text string"
ODD = [
    None, "", " \n\t", "a", "a a a a", "a b c a b c", "a b c d a b c a b c", "x y " * 60, "\n\nsame\nsame\n same\nsame", "#$*%&|<> é",
    "word " * 5000, "w" * 100_000, "\n".join(["line one two", "other"] * 40), "a b\x0bc\x0cd\re", "one two three " * 30 + "end",
    " ".join(f"w{i % 40}" for i in range(900)), "a b c x a b c y b c x a",
]


def counts(text):
    w = words(text)
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, lines, repeats = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5) and 0 <= r.posterior <= 1


def test_counts_of_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "mine", 7, "x") for i, t in enumerate(ODD)], SCHEMA)
    made = quality_rules.quality_rules(df)
    assert {"_n", "_text"} <= set(made.columns) and made.schema["kept"].dataType.typeName() == "boolean"
    check(made.collect(), ODD)


def test_rules_query_and_native_plan(spark, sf_dir):
    made = queries.op9_quality_rules(spark, sf_dir)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(made.collect(), texts)
    measured = quality_rules.measures(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert "Python" not in measured._jdf.queryExecution().executedPlan().toString()


def test_rules_on_no_rows_and_repeats(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_rules.quality_rules(empty).count() == 0
    twice = spark.createDataFrame([(1, ODD[8], "", 0, "")] * 3, SCHEMA)
    assert len({tuple(r) for r in quality_rules.quality_rules(twice).collect()}) == 1


def plain_em(patterns, names, rounds=20):
    """The same estimation over a list of (votes, rows)."""
    prior, good, bad = 0.8, dict.fromkeys(names, 0.99), dict.fromkeys(names, 0.4)
    for _ in range(rounds):
        g = []
        for votes, n in patterns:
            odds = prior / (1 - prior)
            for k, v in votes.items():
                if v is not None:
                    odds *= good[k] / (1 - bad[k]) if v else (1 - good[k]) / bad[k]
            g.append(n * odds / (1 + odds))
        total = sum(n for _, n in patterns)

        def share(side, k, what, low):
            hit = sum(s for (v, _), s in zip(patterns, side, strict=True) if v[k] == what)
            miss = sum(s for (v, _), s in zip(patterns, side, strict=True) if v[k] == 1 - what)
            return min(max((hit + 1) / (hit + miss + 2), low), 0.998)

        b = [n - x for (_, n), x in zip(patterns, g, strict=True)]
        new = {k: share(g, k, 1, 0.98) for k in names}
        new_bad = {k: share(b, k, 0, 1.05 - new[k]) for k in names}
        new_prior = min(max((sum(g) + 4) / (total + 5), 0.5), 0.98)
        moved = max([abs(new_prior - prior)] + [abs(new[k] - good[k]) for k in names] + [abs(new_bad[k] - bad[k]) for k in names])
        prior, good, bad = new_prior, new, new_bad
        if moved < 1e-3:
            break
    return prior, good, bad


def test_votes_are_weighed_as_in_plain_python(spark):
    rng, names = np.random.default_rng(4), ["a", "b", "c"]
    rows = []
    for _ in range(600):
        ok = rng.random() < 0.8
        rows.append(tuple(
            None if rng.random() < 0.2 else int(ok if rng.random() < (0.99 if ok else p) else not ok)
            for p in (0.9, 0.6, 0.3)
        ))
    df = spark.createDataFrame(rows, "_vote_a int, _vote_b int, _vote_c int")
    got = quality_rules.fit_votes(df, names)
    prior, good, bad = plain_em([(dict(zip(names, r, strict=True)), 1) for r in rows], names)
    assert got.prior == pytest.approx(prior, abs=1e-6)
    assert got.on_good == pytest.approx(good, abs=1e-6) and got.on_bad == pytest.approx(bad, abs=1e-6)


def test_classifier_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op6_quality_classifier(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    known = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(known) > 80 and sum(a == b for a, b in known) >= 0.97 * len(known)


def test_classifier_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "s", 1, "x") for i, t in enumerate([*ODD, *ODD])], SCHEMA)
    known = spark.createDataFrame([(i, i % 2, None) for i in range(20)] + [(3, 1, 1), (None, 1, 0), (99, 5, 1)], "doc_id bigint, quality int, toxic int")
    space = quality_knn.fit(quality_knn.with_labels(docs, known, "quality"), "quality")
    scored = quality_knn.with_score(docs, space, score="kept")
    assert scored.columns == ["doc_id", "text", "_n", "_text", "kept"]
    got = {r.doc_id: r.kept for r in scored.collect()}
    assert len(got) == 2 * len(ODD) and all(0 <= x <= 1 for x in got.values())
    assert all(got[i] == pytest.approx(got[i + len(ODD)]) for i in range(len(ODD)))
    none = quality_knn.fit(quality_knn.with_labels(docs, known.limit(0), "quality"), "quality")
    assert {r.score for r in quality_knn.with_score(docs, none).collect()} == {0.5}
    assert quality_knn.with_score(docs.limit(0), space).count() == 0


def test_every_neighbour_is_compared():
    rng = np.random.default_rng(0)
    vectors = quality_knn._unit(rng.normal(size=(300, 8)).astype(np.float32))
    labels = rng.integers(0, 2, 300).astype(float)
    space = quality_knn.Space(np.ones(1), 1.0, np.zeros((1, 8)), vectors, labels, 0.5)
    asked = quality_knn._unit(rng.normal(size=(1100, 8)).astype(np.float32))
    for q, got in zip(asked, space.vote(asked), strict=True):
        cosine = vectors @ q
        near = np.argsort(-cosine)[:quality_knn.NEIGHBOURS]
        w = np.maximum(cosine[near], 0) ** quality_knn.SHARPNESS
        assert got == pytest.approx((w @ labels[near] + 5e-4) / (w.sum() + 1e-3), rel=1e-3)


def test_copies_of_one_text_stay_with_the_workers(spark, monkeypatch):
    kind, sent = type(spark.range(0)), []
    whole = kind.toArrow

    def counted(df):
        sent.append(whole(df))
        return sent[-1]

    monkeypatch.setattr(kind, "toArrow", counted)
    rows = [("the same text", i % 4 // 3) for i in range(400)] + [(f"text number {i}", 1) for i in range(9)]
    space = quality_knn.fit(spark.createDataFrame(rows, "text string, quality int").repartition(3), "quality")
    assert [t.num_rows for t in sent] == [10]
    assert sorted(space.labels.tolist()) == [0.25] + [1.0] * 9
