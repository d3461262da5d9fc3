"""An entity whose key is null or empty goes the whole way, from tokens to the stored document."""

import pytest

from chorus.operators import analytics as an
from chorus.operators import corpus
from chorus.operators import topic_model as tm

BY = ["app", "lang"]
ENTITIES = [("k", "en"), (None, "en"), ("", "en"), ("k", None)]
ROWS = [
    (*entity, f"{n}", f"t{n % 2}" if n else None, [f"w{n}", "common", f"v{n % 2}", "more"])
    for entity in ENTITIES for n in range(4)
]


@pytest.fixture(scope="module")
def tokens(spark):
    return spark.createDataFrame(ROWS, "app string, lang string, review_id string, label string, words array<string>")


def entities(df):
    return sorted({(r.app, r.lang) for r in df.select(*BY).collect()}, key=repr)


WANTED = sorted(ENTITIES, key=repr)


def test_counts_and_weights(tokens):
    for made in (corpus.vocabulary(tokens, BY), corpus.idf(tokens, BY), corpus.tf_idf(tokens, BY), corpus.term_frequency(tokens, BY)):
        assert entities(made) == WANTED
    fitted = corpus.doc_counts(tokens, BY)
    assert [r.ok for r in corpus.doc_count_check(fitted, tokens, BY).collect()] == [True] * 4


def test_topics_of_a_label(tokens):
    made = tm.label_topics(tokens, "label", BY)
    assert entities(made.topic_term) == WANTED
    assert {r.topic for r in made.topic_term.select("topic").distinct().collect()} == {None, "t0", "t1"}
    mass = an.topic_mass(made.doc_topic, BY)
    freqs = an.term_topic_freq(made.topic_term, mass, BY)
    assert entities(freqs) == WANTED
    assert freqs.filter("topic IS NULL").count() == 16
    salient, relevant = an.salient_terms(freqs, BY), an.relevant_terms(freqs, BY)
    assert entities(an.token_table(freqs, an.shown_terms(salient, relevant, BY), BY)) == WANTED
    pairs = an.topic_distance(made.topic_term, BY)
    assert entities(pairs) == WANTED and pairs.count() == 4 * 3
    lengths = tokens.selectExpr(*BY, "review_id", "size(words) AS n")
    assert an.align_docs(made.doc_topic, lengths, BY).count() == len(ROWS)
    summary = an.topic_summary(made.topic_term, made.doc_topic, BY, n=3, steps=2)
    assert entities(summary) == WANTED and summary.count() == 4
    checks = an.summary_validate(made.topic_term, made.doc_topic, BY)
    assert checks.count() == 4 * 4 and checks.filter("NOT ok").count() == 0


def test_fitted_models_reach_the_summary(tokens):
    made = tm.lda_per_entity(tokens, BY, tm.LdaSettings(n_topics=2, max_iter=2))
    assert entities(made.fits) == WANTED
    assert entities(an.topic_summary(made.topic_term, made.doc_topic, BY, n=3, steps=2)) == WANTED
