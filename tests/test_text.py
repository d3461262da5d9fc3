import pytest
from pyspark.sql import functions as F

from chorus.functions import text as tx
from chorus.operators import corpus


def values(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.v for r in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_only_ascii_punctuation_becomes_blank(spark):
    marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    assert values(spark, ["«a»—b, c", marks], tx.strip_punct(F.col("text"))) == ["«a»—b  c", " " * 32]


def test_every_whitespace_character_splits(spark):
    assert values(spark, ["  lead\ttrail  "], tx.tokenize(F.col("text"))) == [["", "", "lead", "trail", "", ""]]


def test_content_words(spark):
    got = values(spark, ["  Lead trail  ", "it's", "THE Game is Great!", ""], tx.content_words(F.col("text")))
    assert got == [["lead", "trail"], [], ["game", "great"], []]


def test_russian_text_keeps_its_stop_words_under_the_english_list(spark):
    rows = spark.createDataFrame([("Это не то", "ru"), ("the race", "ru"), ("the race", "en")], "text string, lang string")
    english = rows.select(tx.content_words(F.col("text")).alias("w")).collect()
    own = rows.select(tx.content_words(F.col("text"), F.col("lang")).alias("w")).collect()
    assert [r.w for r in english] == [["это", "не", "то"], ["race"], ["race"]]
    assert [r.w for r in own] == [["это"], ["the", "race"], ["race"]]


def test_a_language_without_list_uses_english(spark):
    rows = spark.createDataFrame([("the race", "xx")], "text string, lang string")
    assert rows.select(tx.content_words(F.col("text"), F.col("lang")).alias("w")).first().w == ["race"]
    with pytest.raises(ValueError):
        tx.stop_words("xx")


def test_slug(spark):
    got = values(spark, ["Race  Town_2! Гонки", "_a_", "é&à"], tx.slug(F.col("text")))
    assert got == ["race-town-2-гонки", "-a-", "é-à"]


def test_dates_are_strict(spark):
    texts = ["2023-05-06T07:08:09Z", "2023-05-06T07:08:09", "2023-13-06T07:08:09Z", "2023-02-30T00:00:00Z", "x", None]
    got = values(spark, texts, F.date_format(tx.review_date(F.col("text")), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2023-05-06 07:08:09", None, None, None, None, None]


def test_offsets(spark):
    links = ["/v1/x?l=en-GB&offset=40&limit=20", "/v1/x", None]
    assert values(spark, links, tx.next_offset(F.col("text"))) == [40, None, None]


def test_keys_and_links(spark):
    row = spark.createDataFrame([("Race Town", "123", "US", "EN")], "n string, a string, c string, l string")
    c = F.col
    got = row.select(
        tx.entity_key(F.lit("app_store"), c("n"), c("a"), c("c"), c("l")),
        tx.entity_key(F.lit("google_play"), F.lit(None).cast("string"), F.lit("com.X"), c("c"), c("l")),
        tx.landing_url(c("c"), c("n"), c("a")),
        tx.request_url(c("c"), c("a")),
        tx.app_id_in(F.concat(F.lit("see "), tx.landing_url(c("c"), c("n"), c("a")), F.lit(" and more"))),
        tx.app_id_in(F.lit("no link")),
    ).first()
    assert list(got) == [
        "app_store/race town_123_us_en.parquet",
        "google_play/com.x_us_en.parquet",
        "https://apps.apple.com/us/app/race-town/id123",
        "https://amp-api.apps.apple.com/v1/catalog/us/apps/123/reviews",
        "123",
        None,
    ]


def test_length_boundary_and_null_text(spark):
    rows = [("a", "one red car"), ("b", "one red car now race"), ("c", None), ("d", "two red cars race")]
    kept = corpus.preprocess(spark.createDataFrame(rows, "review_id string, text string"))
    assert {r.review_id: r.words for r in kept.collect()} == {"d": ["two", "red", "cars", "race"], "b": ["one", "red", "car", "race"]}


def test_text_path_has_no_python_worker_and_tokenises_once(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("doc_id", "review_id")
    words = corpus.preprocess(rows.select("review_id", "text"))
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert plan.count("regexp_replace") == 1
