"""Cases in which rows once vanished, merged or came out wrong."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chorus.operators import analytics, corpus, hygiene, scale
from chorus.operators import topic_model as tm
from chorus.plans import review_topics
from chorus.schema import REVIEWS
from chorus.sources import feed, results
from chorus.streaming import ingest

ENTRY = (
    '{"attributes":{"date":"%s","isEdited":false,"rating":5,"review":"%s","title":"t","userName":"u"}}'
)
PAGE_ROW = "app_name string, app_id string, country string, lang string, raw string"


def page(*entries, link="null"):
    return '{"data":[%s],"next":%s}' % (",".join(ENTRY % e for e in entries), link)


def landed(spark, *raw):
    return spark.createDataFrame([("Cars", "1", "us", "en", r) for r in raw], PAGE_ROW)


@pytest.mark.parametrize("limit", [0, None])
@pytest.mark.parametrize(("how", "kept"), [("inner", ["a"]), ("left", ["None", "a", "b"])])
def test_lookup_treats_null_keys_alike_at_any_size(spark, limit, how, kept):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    table = spark.createDataFrame([("a", "A")], "k string, big string")
    got = scale.lookup(rows, table, ["k"], how=how, limit=limit).collect()
    assert sorted(str(r.k) for r in got) == kept
    assert {r.k: r.big for r in got} == {k: "A" if k == "a" else None for k in [r.k for r in got]}


def test_vocabulary_lists_every_term(spark):
    words = [f"w{i}" for i in range(300_000)]
    tokens = spark.createDataFrame([("a", i, words[i * 3000:(i + 1) * 3000]) for i in range(100)], "app_id string, review_id int, words array<string>")
    assert corpus.vocabulary(tokens, ["app_id"]).count() == 300_000


def test_a_fit_reports_what_a_smaller_vocabulary_leaves_out(spark):
    rows = [("a", i, ["x", "y"] * 3) for i in range(20)] + [("a", 20, ["rare"] * 2)]
    tokens = spark.createDataFrame(rows, "app_id string, review_id int, words array<string>")
    fit = tm.lda_per_entity(tokens, ["app_id"], tm.LdaSettings(2, 2, vocab_size=2)).fits.first()
    assert (fit.n_terms, fit.n_terms_seen, fit.n_tokens_dropped, fit.n_docs_without_term) == (2, 3, 2, 1)
    fit = tm.lda_per_entity(tokens, ["app_id"], tm.LdaSettings(2, 2)).fits.first()
    assert (fit.n_terms, fit.n_terms_seen, fit.n_tokens_dropped, fit.n_docs_without_term) == (3, 3, 0, 0)


def test_entities_with_null_and_empty_keys_get_models(spark):
    rows = [(k, f"{k}-{i}", [f"w{(i + j) % 9}" for j in range(6)]) for k in ("a", None, "") for i in range(40)]
    tokens = spark.createDataFrame(rows, "app_id string, review_id string, words array<string>")
    made = tm.lda_per_entity(tokens, ["app_id"], tm.LdaSettings(2, 2))
    assert {r.app_id: r.n_docs for r in made.fits.collect()} == {"a": 40, None: 40, "": 40}
    shares = made.doc_topic.groupBy("review_id").agg(F.sum("theta").alias("s")).collect()
    assert len(shares) == 120 and all(math.isclose(r.s, 1, abs_tol=1e-9) for r in shares)


def test_fit_does_not_depend_on_session_partitions(spark):
    rows = [("a", i, [f"w{(i * 7 + j * j) % 23}" for j in range(8)]) for i in range(1500)]
    tokens = scale.pin(spark.createDataFrame(rows, "app_id string, review_id int, words array<string>"), "t")
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        phi = tm.lda_per_entity(tokens, ["app_id"], tm.LdaSettings(2, 3)).topic_term
        found.append({(r.topic, r.term): r.phi for r in phi.collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == pytest.approx(found[1])


def test_old_reviews_that_land_late_are_new(spark, tmp_path):
    path = str(tmp_path / "landing")
    dates = ["2024-03-01", "2024-01-01", "2023-05-05", "2024-02-02", "2022-01-01"]
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for n, day in enumerate(dates):
        landed(spark, page((f"{day}T00:00:00Z", f"text {n}"))).coalesce(1).write.mode("append").parquet(path)
        reviews = ingest.stream_reviews(ingest.landed_pages(spark, path, PAGE_ROW))
        ingest.append_to(ingest.stream_dedup(reviews), out, progress).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == [f"text {n}" for n in range(5)]


def test_bad_pages_and_undated_rows_stay_as_rejects(spark):
    pages = landed(spark, page(("2024-01-05T00:00:00Z", "new"), ("3 Jan", "undated"), ("2023-01-01T00:00:00Z", "old")), "oops", None, '{"data":[],"next":null}')
    rows = feed.feed_reviews(pages, after=date(2024, 1, 1)).collect()
    assert {(r.text, r.reject_reason) for r in rows} == {
        ("new", None), ("undated", "date: missing value"), ("oops", feed.BAD_PAGE), (None, feed.BAD_PAGE),
    }
    assert hygiene.accepted(feed.feed_reviews(pages)).count() == 2


def test_texts_left_out_are_counted(spark):
    rows = [("a", "1", None), ("a", "2", "one car"), ("a", "3", "big red cars race fast"), ("b", "4", None)]
    got = corpus.left_out(spark.createDataFrame(rows, "app_id string, review_id string, text string"), ["app_id"])
    assert {r.app_id: (r.n_without_text, r.n_short) for r in got.collect()} == {"a": (1, 1), "b": (1, 0)}


def test_repeated_ids_are_found_and_become_one_document(spark):
    row = ("google_play", None, "1", "us", "en", "7", "u", None, "great red car race", 5, None, None, None, datetime(2024, 1, 1))
    other = (*row[:5], "8", *row[6:8], "small blue boat trip", *row[9:])
    schema = REVIEWS.simpleString().removeprefix("struct<").removesuffix(">")
    reviews = spark.createDataFrame([row, row, other], schema)
    assert [r.n_rows for r in corpus.repeated_ids(reviews).collect()] == [2]
    made = review_topics.topic_tables(reviews, settings=tm.LdaSettings(2, 2))
    assert made.fits.first().n_docs == 2
    assert analytics.topic_mass(made.doc_topic).first().total == pytest.approx(8)


def test_two_languages_of_one_app(spark):
    at = datetime(2024, 1, 1)
    rows = [("app_store", "Cars", "1", "us", lang, f"data {lang}", at) for lang in ("en", "es")]
    store = spark.createDataFrame(rows, "store string, app_name string, app_id string, country string, lang string, lda_data string, update_dt timestamp")
    assert [tuple(r) for r in results.app_listing(store, "app_store").collect()] == [("Cars", "1", "us")]
    assert results.app_listing(store, "app_store", by_lang=True).count() == 2
    one = results.topic_lookup(store, "app_store", "1", "us", "Cars", "en").collect()
    assert [r.lda_data for r in one] == ["data en"]
    assert results.topic_lookup(store, "app_store", "1", "us", "Cars").count() == 1


def test_top_n_prunes_beyond_a_thousand(spark):
    rows = spark.range(3000).repartition(4).withColumn("k", (F.col("id") % 2).cast("string"))
    plan = scale.top_n(rows, ["k"], [F.col("id")], 1500)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number(), 1500, Partial") == 2
