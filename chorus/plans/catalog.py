"""Queries over the given tables, one or more per operator.

``documents`` stand in for reviews (``source`` is the app), ``events`` supply
dates and dated feeds, ``labels`` ratings, ``pages`` links, ``part`` and
``customer`` named entities. Every query reads whole tables and whole texts.
Doubles are rounded so that the order of a sum does not show.
"""

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.functions import text as tx
from chorus.operators import analytics as an
from chorus.operators import corpus, hygiene, linguistic, trends
from chorus.operators import topic_model as tm
from chorus.operators.scale import lies_even, lookup, pin, work_dir
from chorus.plans import extract, review_topics
from chorus.plans.review_topics import topic_tables
from chorus.schema import FEED_PAGE_SIZE, GOOGLE_PLAY_REVIEWS, MAX_REVIEWS_PER_ENTITY, STORE_RESULT_KEY
from chorus.sources import feed, results
from chorus.sources.reviews import read_reviews, write_reviews
from chorus.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

APP = ["app_id"]
LANGS = ["de", "en", "es", "fr"]
EXTRACT_FROM = date(2024, 1, 10)

_made: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]) -> object:
    """Intermediate tables several queries share are computed and written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def _six(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), 6) for n in names})


def _text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- inputs -------------------------------------------------------------------


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("app_id"), "lang", F.col("doc_id").alias("review_id"), "text"
    )


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the number of their events and the date, user and version of the latest.

    Every event belongs to the document at its number in turn.
    """
    end = docs(spark, sf_dir).agg(F.max("review_id") + 1).first()[0]
    known = F.struct("ts", "event_id", "user_id", "event_type", "props")
    latest = table(spark, sf_dir, "events").groupBy(F.pmod("event_id", F.lit(end)).alias("review_id")).agg(
        F.max(known).alias("e"), F.count("*").alias("n_events")
    )
    happened = latest.select(
        "review_id", "n_events", "e.ts", F.concat(F.lit("user"), "e.user_id").alias("user_name"),
        F.col("e.event_type").alias("title"), F.get_json_object("e.props", "$.k").alias("app_version"),
    )
    rated = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("review_id"), F.col("quality").alias("rating")
    )
    return docs(spark, sf_dir).join(happened, "review_id", "left").join(rated, "review_id", "left")


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as landed feed pages: JSON with a block's reviews and a link to the next offset.

    A page takes one app's and language's documents out of 400 consecutive ids,
    so no page grows with the data.
    """
    size = F.lit(FEED_PAGE_SIZE)
    rows = dated(spark, sf_dir)
    attributes = F.struct(
        F.date_format("ts", tx.FEED_DATE).alias("date"),
        (F.col("title") == "error").alias("isEdited"),
        F.coalesce("rating", F.lit(5)).alias("rating"),
        F.col("text").alias("review"),
        "title",
        F.col("user_name").alias("userName"),
    )
    entry = F.struct("review_id", F.struct(attributes.alias("attributes")).alias("e"))
    page_no = F.floor(F.col("review_id") / (size * size))
    pages = rows.groupBy("app_id", "lang", page_no.alias("page_no")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    # the ends of the feeds are few and come by a join: a window would move and sort all texts once more
    ends = docs(spark, sf_dir).groupBy("app_id", "lang").agg(F.max(page_no).alias("last_no"))
    pages = lookup(pages, ends, ["app_id", "lang"], nulls=True)
    link = F.concat(
        F.lit("/v1/catalog/"), "lang", F.lit("/apps/"), "app_id", F.lit("/reviews?l=en-GB&offset="),
        ((F.col("page_no") + 1) * size).cast("string"), F.lit("&limit=20"),
    )
    last = F.col("page_no") == F.col("last_no")
    body = F.struct(
        F.transform("entries", lambda x: x["e"]).alias("data"),
        F.when(~last, link).alias("next"),
    )
    return pages.select(
        F.lit("App").alias("app_name"), "app_id", F.col("lang").alias("country"), "lang", "page_no",
        F.to_json(body).alias("raw"),
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content words of every document, by the stop words of its own language.

    The given table is a single row group, which one task would read and
    tokenise alone, so documents are spread first unless they lie in many even parts.
    """

    def make() -> DataFrame:
        given = docs(spark, sf_dir)
        words = corpus.preprocess(given, lang="lang", langs=LANGS, even_by=None if lies_even(given) else "review_id")
        return pin(words, "tokens")

    return _once(spark, sf_dir, "tokens", make)


def label_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """phi, theta and topic mass with each app's languages as its topics."""

    def make() -> tuple[DataFrame, DataFrame, DataFrame]:
        made = tm.label_topics(tokens(spark, sf_dir), "lang", APP)
        phi, theta = pin(made.topic_term, "label_phi"), pin(made.doc_topic, "label_theta")
        return phi, theta, pin(an.topic_mass(theta, APP), "label_mass")

    return _once(spark, sf_dir, "label_tables", make)


def freqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    phi, _, mass = label_tables(spark, sf_dir)
    return an.term_topic_freq(phi, mass, APP)


def lda_tables(spark: SparkSession, sf_dir: str) -> tm.TopicTables:
    """One LDA model, default settings, over all documents of each store; here one store."""

    def make() -> tm.TopicTables:
        one = tokens(spark, sf_dir).withColumn("store", F.lit("google_play"))
        return tm.lda_per_entity(one, ["store"])

    return _once(spark, sf_dir, "lda", make)


def lda_language_tables(spark: SparkSession, sf_dir: str) -> tm.TopicTables:
    return _once(spark, sf_dir, "lda_lang", lambda: tm.lda_per_entity(tokens(spark, sf_dir), ["lang"]))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result store with one row per app and language, derived from the documents."""
    named = F.col("lang").isin("en", "de")
    found = dated(spark, sf_dir).groupBy("app_id", "lang").agg(
        F.sum("n_events").alias("n"), F.max("ts").alias("latest")
    )
    return found.select(
        F.when(named, "app_store").otherwise("google_play").alias("store"),
        F.when(named, F.concat(F.lit("App "), "app_id")).alias("app_name"),
        "app_id", F.col("lang").alias("country"), "lang",
        F.to_json(F.struct("n")).alias("lda_data"), F.col("latest").cast("timestamp").alias("update_dt"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lit("app_store").alias("store"), F.concat("p_name", F.lit("_"), "p_brand").alias("app_name"),
        F.col("p_partkey").alias("app_id"), F.substring("p_type", 1, 2).alias("country"),
        F.substring("p_brand", 1, 2).alias("lang"),
    )


# ---- sources and sinks --------------------------------------------------------


def page_flatten(spark, sf_dir):
    return feed.page_flatten(raw_pages(spark, sf_dir)).drop("app_name", "country")


def props_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int").alias("j")).select("event_id", "j.*")


def next_offset(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.number_after(F.col("url"), r"^.+page=([0-9]+).*$").alias("next_page"))


def page_offsets(spark, sf_dir):
    return feed.page_offsets(raw_pages(spark, sf_dir)).select("app_id", "lang", "page_no", "next_offset")


def review_date_parse(spark, sf_dir):
    """Every third event carries a date in another shape, which must come out null."""
    events = table(spark, sf_dir, "events")
    written = F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format("ts", tx.FEED_DATE)
    )
    return events.select("event_id", _text(tx.review_date(written)).alias("date"))


def feed_reviews(spark, sf_dir):
    rows = hygiene.accepted(feed.feed_reviews(raw_pages(spark, sf_dir).drop("page_no")))
    return rows.select(
        "store", "app_id", "country", "lang", "review_id", "user_name", "title", "text",
        F.col("rating").cast("int").alias("rating"), "is_edited", _text("ts").alias("ts"),
    )


def _extracted(rows: DataFrame) -> DataFrame:
    return rows.select(
        "store", "app_id", "country", "lang", "review_id", "user_name", "text",
        F.col("rating").cast("int").alias("rating"), _text("ts").alias("ts"),
    )


def extract_reviews_app_store(spark, sf_dir):
    """All pages landed twice, one of them broken: the newest 30 reviews of every app from a date on, written and read."""
    path = f"{work_dir(spark)}/extract-{uuid4().hex}"
    pages = raw_pages(spark, sf_dir).drop("page_no")
    broken = pages.filter(F.col("app_id") == "src1").withColumn("raw", F.lit("oops"))
    made = extract.extract_app_store(pages.unionByName(pages).unionByName(broken), path, EXTRACT_FROM, cap=30)
    return _extracted(read_reviews(spark, path, made.reviews.schema))


def extract_reviews_google_play(spark, sf_dir):
    """Events as landed rows of one app per user; some lack the text, some ratings do not fit."""
    path = f"{work_dir(spark)}/extract-{uuid4().hex}"
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("com.app"), F.col("user_id")).alias("app_id"), F.lit("us").alias("country"),
        F.lit("en").alias("lang"), F.col("event_id").cast("string").alias("reviewId"),
        F.lit("u").alias("userName"), F.nullif("event_type", F.lit("error")).alias("content"),
        F.floor(F.col("value") * 3).cast("int").alias("score"),
        F.get_json_object("props", "$.k").cast("int").alias("thumbsUpCount"),
        F.lit(None).cast("string").alias("reviewCreatedVersion"), F.col("ts").cast("timestamp").alias("at"),
        F.lit(None).cast("string").alias("appVersion"),
    )
    made = extract.extract_google_play(rows.unionByName(rows), path, EXTRACT_FROM, cap=20)
    return _extracted(read_reviews(spark, path, made.reviews.schema))


def review_topics_run(spark, sf_dir):
    """Reviews extracted, modelled per language and stored: what the store then holds."""
    path, root = (f"{work_dir(spark)}/{k}-{uuid4().hex}" for k in ("reviews", "topics"))
    pages = raw_pages(spark, sf_dir).drop("page_no").withColumn("app_id", F.lit("all"))
    extract.extract_app_store(pages, path, cap=10**9)
    review_topics.run(spark, path, root, langs=LANGS)
    doc = F.from_json("lda_data", results.TOPIC_JSON)
    return results.read_results(spark, root).select(
        "store", "app_name", "app_id", "country", "lang", F.size(doc["mdsDat"]["topics"]).alias("n_topics")
    )


def topic_result_upsert_store_key(spark, sf_dir):
    """Upsert on the key without language: a second language replaces the first."""
    rows = stored(spark, sf_dir).withColumn("country", F.lit("zz"))
    first, second = rows.filter("lang IN ('en', 'fr')"), rows.filter("lang IN ('de', 'es')")
    key = STORE_RESULT_KEY
    return _result_rows(results.topic_result_upsert(results.latest_updates(first, key), second, key))


def write_reviews_then_read(spark, sf_dir):
    """All apps written, then one language replaced by its deduplicated rows; the others survive."""
    path = f"{work_dir(spark)}/reviews-{uuid4().hex}"
    rows = dated(spark, sf_dir).select("app_id", "lang", "review_id", "text", "ts")
    write_reviews(rows, path, ["lang", "app_id"])
    once = hygiene.first_copy(rows.filter(F.col("lang") == "fr"), ["app_id", "text"], [F.col("review_id")])
    write_reviews(once, path, ["lang", "app_id"])
    return read_reviews(spark, path, rows.schema).groupBy("app_id", "lang").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).cast("bigint").alias("chars")
    )


def read_reviews_typed(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = spark.read.schema(schema).parquet(f"{sf_dir}/documents.parquet")
    return rows.select(F.col("doc_id").alias("review_id"), "lang", F.col("source").alias("app_id"))


def entity_key(spark, sf_dir):
    c = F.col
    key = tx.entity_key(c("store"), c("app_name"), c("app_id").cast("string"), c("country"), c("lang"))
    return entities(spark, sf_dir).select("app_id", key.alias("entity_key"))


def _updates(spark, sf_dir):
    """New payloads: two for every key of one store, one for as many new keys."""
    old = stored(spark, sf_dir).filter(F.col("store") == "google_play")
    later = old.withColumn("update_dt", F.col("update_dt") + F.expr("INTERVAL '1' DAY"))
    later = later.withColumn("lda_data", F.lit('{"n":-1}'))
    last = old.withColumn("update_dt", F.col("update_dt") + F.expr("INTERVAL '2' DAY"))
    last = last.withColumn("lda_data", F.lit('{"n":-2}'))
    new = old.withColumn("country", F.lit("zz"))
    return later.unionByName(last).unionByName(new)


def _result_rows(df):
    return df.select("store", "app_name", "app_id", "country", "lang", "lda_data", _text("update_dt").alias("update_dt"))


def topic_result_upsert(spark, sf_dir):
    return _result_rows(results.topic_result_upsert(stored(spark, sf_dir), _updates(spark, sf_dir)))


def topic_result_versions(spark, sf_dir):
    """The same through the written store: first version, upsert, read the newest."""
    root = f"{work_dir(spark)}/results-{uuid4().hex}"
    results.write_results(spark, root, stored(spark, sf_dir))
    results.write_results(spark, root, _updates(spark, sf_dir))
    return _result_rows(results.read_results(spark, root))


def _label_summary(spark, sf_dir):
    def make():
        phi, theta, _ = label_tables(spark, sf_dir)
        return pin(an.topic_summary(phi, theta, APP), "label_summary")

    return _once(spark, sf_dir, "label_summary", make)


def topic_result_json(spark, sf_dir):
    """The stored document of every app, by its parts' sizes."""
    doc = F.from_json("lda_data", results.TOPIC_JSON)
    return _label_summary(spark, sf_dir).select("app_id", doc.alias("j")).select(
        "app_id", F.size("j.mdsDat.topics").alias("topics"), F.size("j.tinfo.Term").alias("term_lines"),
        F.size(F.col("j").getField("token.table").getField("Term")).alias("token_lines"),
    )


def topic_result_read(spark, sf_dir):
    rows = results.topic_result_read(_label_summary(spark, sf_dir))
    return _six(rows, "freq", "total", "logprob", "loglift")


# ---- projections, filters, duplicates, caps -----------------------------------


def conform_schema(spark, sf_dir):
    """Events as store reviews: some lack the text, some ratings do not fit a byte."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("reviewId"), F.col("user_id").cast("string").alias("userName"),
        F.nullif("event_type", F.lit("error")).alias("content"),
        F.floor(F.col("value") * 3).cast("int").alias("score"),
        F.get_json_object("props", "$.k").cast("int").alias("thumbsUpCount"),
        F.lit(None).cast("string").alias("reviewCreatedVersion"), F.col("ts").alias("at"),
        F.lit(None).cast("string").alias("appVersion"), "event_type",
    )
    return hygiene.conform_schema(rows, GOOGLE_PLAY_REVIEWS).select(
        "reviewId", "content", F.col("score").cast("int").alias("score"), "thumbsUpCount", "reject_reason"
    )


def date_cutoff(spark, sf_dir):
    return hygiene.date_cutoff(table(spark, sf_dir, "events"), date(2024, 1, 15)).select("event_id", "user_id")


def entity_validate(spark, sf_dir):
    """Customers as entities; names of one to five letters, country codes of one to three."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, "app_store").otherwise("google_play").alias("store"),
        F.expr("substring(c_name, 1, CAST(1 + c_custkey % 5 AS INT))").alias("app_name"), F.col("c_name").alias("app_id"),
        F.expr("substring(c_mktsegment, 1, 1 + c_nationkey % 3)").alias("country"), F.lit("en").alias("lang"),
    )
    return hygiene.entity_validate(rows).select("c_custkey", "store", "country", "valid")


def result_constraints(spark, sf_dir):
    """Events as result rows, with missing, overlong and repeated keys among them."""
    is_app = F.col("event_type").isin("click", "view")
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.when(is_app, "app_store").otherwise("google_play").alias("store"),
        F.when(F.col("event_type") == "click", F.lit("click")).alias("app_name"),
        F.concat(F.col("user_id"), F.lit("-"), F.col("event_id")).alias("app_id"),
        F.when(F.col("value") > 2, F.when(F.col("value") > 30, "usa").otherwise("us")).alias("country"),
        F.lit("en").alias("lang"), F.col("props").alias("lda_data"), F.col("ts").cast("timestamp").alias("update_dt"),
    )
    twice = rows.unionByName(rows.filter(F.col("event_type") == "purchase"))
    checked = results.result_constraints(twice)
    return checked.select("event_id", "store", "violation", _text("update_dt").alias("update_dt"))


def text_column_pick(spark, sf_dir):
    """Both stores in one shape: documents as one feed, conversations as the other."""
    d = dated(spark, sf_dir)
    one = d.select(
        F.concat(F.lit("App "), "app_id").alias("app_name"), "app_id", F.col("lang").alias("country"), "lang",
        F.date_trunc("second", "ts").cast("timestamp").alias("date"), F.lit(False).alias("isEdited"),
        F.lit(5).alias("rating"), F.col("text").alias("review"), "title", F.col("user_name").alias("userName"),
    )
    two = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("app_id"), F.lit("us").alias("country"), F.lit("en").alias("lang"),
        F.concat_ws("-", "conv_id", "turn").alias("reviewId"), F.col("role").alias("userName"),
        F.col("text").alias("content"), F.lit(4).alias("score"), F.col("turn").cast("int").alias("thumbsUpCount"),
        F.lit("1.0").alias("reviewCreatedVersion"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at"),
        F.lit(None).cast("string").alias("appVersion"),
    )
    both = feed.union_stores(feed.unify_app_store(one), feed.unify_google_play(two))
    return both.select("store", "app_name", "app_id", "review_id", "user_name", "text", "app_version")


def topic_lookup(spark, sf_dir):
    return results.topic_lookup(stored(spark, sf_dir), "app_store", "src7", "en", "App src7")


def app_listing_app_store(spark, sf_dir):
    return results.app_listing(stored(spark, sf_dir), "app_store")


def app_listing_google_play(spark, sf_dir):
    return results.app_listing(stored(spark, sf_dir), "google_play")


def slug_normalize(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", tx.slug(F.concat("p_name", F.lit("__"), "p_brand", F.lit(" "), "p_type")).alias("slug")
    )


def id_from_page(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", tx.app_id_in(F.col("url"), r"https?://[^/]+/[a-z]{2}/([0-9]+)").alias("app_id")
    )


def id_from_landing_page(spark, sf_dir):
    rows = feed.with_urls(entities(spark, sf_dir).withColumn("country", F.lower("country")))
    page = F.concat(F.lit('<p><a href="'), "landing_url", F.lit('">app</a></p>'))
    return rows.select("app_id", tx.app_id_in(page).alias("found"))


def landing_url_build(spark, sf_dir):
    return feed.with_urls(entities(spark, sf_dir)).select("app_id", "landing_url", "request_url")


def newest_n_per_app(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return hygiene.newest_n(events, ["event_type"], doc="event_id").select("event_type", "event_id")


def review_cap(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return hygiene.review_cap(events, [F.col("event_id")], ["event_type"], MAX_REVIEWS_PER_ENTITY)


def dedup_reviews(spark, sf_dir):
    rows = docs(spark, sf_dir).withColumn("copy_of", F.sha2("text", 256)).drop("text")
    once = hygiene.dedup_reviews(rows, ["app_id", "lang"], "copy_of", [F.col("review_id")])
    return once.select("app_id", "lang", "review_id")


# ---- text ---------------------------------------------------------------------


def strip_punct(spark, sf_dir):
    return docs(spark, sf_dir).select("review_id", tx.strip_punct(F.col("text")).alias("clean"))


def tokenize(spark, sf_dir):
    pieces = tx.tokenize(tx.strip_punct(F.col("text")))
    return docs(spark, sf_dir).select(
        "review_id", F.size(pieces).cast("bigint").alias("n"), F.array_join(pieces, "|").alias("tokens")
    )


def remove_stop_words_english(spark, sf_dir):
    words = tx.remove_stop_words(tx.tokenize(tx.strip_punct(F.col("text"))))
    return docs(spark, sf_dir).select("review_id", F.array_join(words, "|").alias("words"))


def remove_stop_words(spark, sf_dir):
    words = tx.remove_stop_words(tx.tokenize(tx.strip_punct(F.col("text"))), F.col("lang"), LANGS)
    return docs(spark, sf_dir).select("review_id", F.array_join(words, "|").alias("words"))


def drop_empty_tokens(spark, sf_dir):
    words = tx.drop_empty(tx.tokenize(tx.strip_punct(F.col("text"))))
    return docs(spark, sf_dir).select("review_id", F.array_join(words, "|").alias("words"))


def token_count(spark, sf_dir):
    words = tx.content_words(F.col("text"), F.col("lang"), LANGS)
    return docs(spark, sf_dir).select("review_id", F.size(words).cast("bigint").alias("n_tokens"))


def min_token_filter(spark, sf_dir):
    kept = corpus.preprocess(docs(spark, sf_dir), lang="lang", langs=LANGS, even_by="review_id")
    return kept.select("review_id", F.array_join("words", "|").alias("words"))


def normalize_tokens(spark, sf_dir):
    return linguistic.normalize(docs(spark, sf_dir)).select("review_id", F.array_join("tokens", "|").alias("tokens"))


def dictionaries(spark, sf_dir):
    """A lemma and a tag table made from the documents' own words by ending."""

    def make():
        words = linguistic.normalize(docs(spark, sf_dir)).select("lang", F.explode("tokens").alias("form"))
        forms = pin(words.distinct(), "forms")
        listed = F.col("form").rlike("..s$")
        lemma = F.expr("left(form, length(form) - 1)")
        lemmas = pin(forms.filter(listed).withColumn("lemma", lemma), "lemmas")
        known = listed & F.col("lang").isNotNull()
        every = forms.select("lang", F.when(known, lemma).otherwise(F.col("form")).alias("lemma")).distinct()
        tag = (
            F.when(F.col("lemma").rlike("(ble|ed|eux|ich|al)$"), "JJ")
            .when(F.col("lemma").rlike("(ing|er|en|re|ar)$"), "VB")
            .when(F.col("lemma").rlike("^(the|of|and|la|le|de|der|die|das|el|to|in)$"), "DT")
        )
        return lemmas, pin(every.withColumn("tag", tag).filter(F.col("tag").isNotNull()), "tags")

    return _once(spark, sf_dir, "dictionaries", make)


def lemmatize(spark, sf_dir):
    lemmas, _ = dictionaries(spark, sf_dir)
    done = linguistic.lemmatize(linguistic.normalize(docs(spark, sf_dir)), lemmas)
    return done.select("review_id", F.array_join("lemmas", "|").alias("lemmas"))


def pos_tag(spark, sf_dir):
    lemmas, tags = dictionaries(spark, sf_dir)
    done = linguistic.pos_tag(linguistic.lemmatize(linguistic.normalize(docs(spark, sf_dir)), lemmas), tags)
    return done.select("review_id", F.array_join("tags", "|").alias("tags"))


def chunk_ngrams(spark, sf_dir):
    tagged = linguistic.annotate(linguistic.normalize(docs(spark, sf_dir)), *dictionaries(spark, sf_dir))
    return linguistic.chunk_ngrams(tagged).select("review_id", F.array_join("phrases", "|").alias("phrases"))


def finish_concat(spark, sf_dir):
    done = linguistic.preprocess(docs(spark, sf_dir), *dictionaries(spark, sf_dir))
    return done.select("review_id", F.size("words").cast("bigint").alias("n"), F.array_join("words", "|").alias("words"))


def wordless_documents(spark, sf_dir):
    return linguistic.wordless(docs(spark, sf_dir), APP)


# ---- corpus -------------------------------------------------------------------


def top_terms_by_source(spark, sf_dir):
    """The ten heaviest terms of every app by summed TF-IDF."""
    weights = corpus.tf_idf(tokens(spark, sf_dir), APP).groupBy("app_id", "term").agg(F.sum("tf_idf").alias("weight"))
    order = [F.round("weight", 8).desc(), F.col("term")]
    return _six(an.top_n(weights, APP, order, 10), "weight")


def vocabulary(spark, sf_dir):
    return corpus.vocabulary(tokens(spark, sf_dir), APP)


def term_frequency(spark, sf_dir):
    return corpus.term_frequency(tokens(spark, sf_dir), APP)


def document_frequency(spark, sf_dir):
    return corpus.document_frequency(tokens(spark, sf_dir), APP)


def idf(spark, sf_dir):
    return _six(corpus.idf(tokens(spark, sf_dir), APP), "idf")


def tf_idf(spark, sf_dir):
    return _six(corpus.tf_idf(tokens(spark, sf_dir), APP), "tf_idf")


def doc_count_check(spark, sf_dir):
    """Documents the models of the languages saw, against the token table."""
    fits = lda_language_tables(spark, sf_dir).fits
    return corpus.doc_count_check(fits, tokens(spark, sf_dir), ["lang"])


def doc_length_stats(spark, sf_dir):
    return corpus.doc_length_stats(tokens(spark, sf_dir), APP)


# ---- topics given by labels ---------------------------------------------------


def label_topics(spark, sf_dir):
    phi, _, _ = label_tables(spark, sf_dir)
    return _six(phi, "phi")


def align_docs(spark, sf_dir):
    _, theta, _ = label_tables(spark, sf_dir)
    lengths = corpus.doc_lengths(tokens(spark, sf_dir), APP)
    return an.align_docs(theta.drop("n_tokens", "lang"), lengths, APP)


def topic_mass(spark, sf_dir):
    _, theta, _ = label_tables(spark, sf_dir)
    return _six(an.topic_mass(theta, APP), "proportion")


def topic_proportion(spark, sf_dir):
    _, theta, _ = label_tables(spark, sf_dir)
    return _six(an.topic_proportion(theta, APP), "proportion")


def summary_validate(spark, sf_dir):
    phi, theta, _ = label_tables(spark, sf_dir)
    return an.summary_validate(phi, theta, APP)


def term_topic_freq(spark, sf_dir):
    return _six(freqs(spark, sf_dir).select("app_id", "topic", "term", "freq"), "freq")


def term_marginal(spark, sf_dir):
    return _six(an.term_marginal(freqs(spark, sf_dir), APP), "freq", "share")


def saliency(spark, sf_dir):
    return _six(an.salient_terms(freqs(spark, sf_dir), APP), "freq", "saliency")


def log_prob_lift(spark, sf_dir):
    lifts = an.log_prob_lift(freqs(spark, sf_dir), APP)
    return _six(lifts.select("app_id", "topic", "term", "logprob", "loglift"), "logprob", "loglift")


def relevance(spark, sf_dir):
    top = an.relevant_terms(freqs(spark, sf_dir), APP)
    return _six(top.select("app_id", "topic", "lambda", "rank", "term", "relevance"), "relevance")


def token_table(spark, sf_dir):
    counts = freqs(spark, sf_dir)
    shown = an.shown_terms(an.salient_terms(counts, APP), an.relevant_terms(counts, APP), APP)
    return _six(an.token_table(counts, pin(shown, "shown"), APP), "share")


def topic_pairs(spark, sf_dir):
    phi, _, _ = label_tables(spark, sf_dir)
    return an.topic_pairs(an.topic_list(phi, APP), APP).select("app_id", "topic_a", "topic_b")


def topic_distance(spark, sf_dir):
    phi, _, _ = label_tables(spark, sf_dir)
    return _six(an.topic_distance(phi, APP), "distance")


def label_top_terms(spark, sf_dir):
    phi, _, _ = label_tables(spark, sf_dir)
    return _six(an.top_terms_per_topic(phi, APP), "phi")


# ---- topics found by LDA ------------------------------------------------------


def lda_fit(spark, sf_dir):
    return lda_tables(spark, sf_dir).fits


def lda_fit_validate(spark, sf_dir):
    made = lda_tables(spark, sf_dir)
    return an.summary_validate(made.topic_term, made.doc_topic, ["store"])


def topic_term(spark, sf_dir):
    return lda_tables(spark, sf_dir).topic_term


def doc_topic(spark, sf_dir):
    return lda_tables(spark, sf_dir).doc_topic


def lda_per_entity(spark, sf_dir):
    return lda_language_tables(spark, sf_dir).fits


def lda_validate(spark, sf_dir):
    made = lda_language_tables(spark, sf_dir)
    return an.summary_validate(made.topic_term, made.doc_topic, ["lang"])


def linguistic_lda(spark, sf_dir):
    """The linguistic text path, lemmas and phrases, into a model per language."""
    lemmas, tags = dictionaries(spark, sf_dir)
    made = topic_tables(
        docs(spark, sf_dir), ["lang"], mode="linguistic", lemmas=lemmas, tags=tags
    )
    return made.fits.select("lang", "n_topics", "n_terms", "n_docs")


def top_terms_per_topic(spark, sf_dir):
    return an.top_terms_per_topic(lda_tables(spark, sf_dir).topic_term, ["store"])


def topic_coordinates(spark, sf_dir):
    phi = lda_tables(spark, sf_dir).topic_term
    return an.topic_coordinates(an.topic_distance(phi, ["store"]), an.topic_list(phi, ["store"]), ["store"])


def topic_summary(spark, sf_dir):
    made = lda_tables(spark, sf_dir)
    return an.topic_summary(made.topic_term, made.doc_topic, ["store"])


def lda_relevance(spark, sf_dir, settings: tm.LdaSettings | None = None):
    """Reviews to the most relevant terms of each LDA topic."""
    if settings is None:
        made = lda_tables(spark, sf_dir)
    else:
        one = docs(spark, sf_dir).withColumn("store", F.lit("google_play"))
        made = topic_tables(one, ["store"], settings, lang="lang", langs=LANGS, even_by="review_id")
    mass = pin(an.topic_mass(made.doc_topic, ["store"]), "mass")
    counts = an.term_topic_freq(made.topic_term, mass, ["store"])
    top = an.relevant_terms(counts, ["store"])
    return _six(top.select("store", "topic", "lambda", "rank", "term", "relevance"), "relevance")


# ---- streams ------------------------------------------------------------------


def _landed(spark, sf_dir, name: str, times: int = 1) -> str:
    """Feed pages as files in a landing folder, each page landed ``times`` times; they are made once."""
    path = f"{work_dir(spark)}/landing-{name}-{uuid4().hex}"
    made = raw_pages(spark, sf_dir).drop("page_no")
    made.write.parquet(path)
    if times > 1:
        again = spark.read.schema(made.schema).parquet(path)
        for _ in range(times - 1):
            again.write.mode("append").parquet(path)
    return path


PAGE_FILE = "app_name string, app_id string, country string, lang string, raw string"


def _drained(spark, rows: DataFrame, name: str) -> DataFrame:
    base = f"{work_dir(spark)}/{name}-{uuid4().hex}"
    ingest.append_to(rows, f"{base}/rows", f"{base}/progress").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


def stream_ingest(spark, sf_dir):
    pages = ingest.landed_pages(spark, _landed(spark, sf_dir, "ingest"), PAGE_FILE)
    rows = _drained(spark, ingest.stream_reviews(pages), "stream_ingest")
    return rows.select("app_id", "lang", "review_id", "text", _text("ts").alias("ts"))


def stream_dedup(spark, sf_dir):
    """Every page landed twice; each review comes out once."""
    pages = ingest.landed_pages(spark, _landed(spark, sf_dir, "dedup", 2), PAGE_FILE)
    rows = ingest.stream_dedup(ingest.stream_reviews(pages))
    return _drained(spark, rows, "stream_dedup").select("app_id", "lang", "review_id")


def stream_upsert(spark, sf_dir):
    base = f"{work_dir(spark)}/upsert-{uuid4().hex}"
    results.write_results(spark, f"{base}/results", stored(spark, sf_dir))
    _updates(spark, sf_dir).write.parquet(f"{base}/landing")
    updates = ingest.landed_pages(spark, f"{base}/landing", results.TOPIC_RESULTS)
    ingest.stream_upsert(updates, f"{base}/results", f"{base}/progress").awaitTermination()
    return _result_rows(results.read_results(spark, f"{base}/results"))


# ---- trends -------------------------------------------------------------------


def _dated_topics(spark, sf_dir):
    _, theta, _ = label_tables(spark, sf_dir)
    extra = dated(spark, sf_dir).select("review_id", "ts", "app_version", "rating")
    return theta.join(extra, "review_id")


def topic_by_period(spark, sf_dir):
    rows = trends.topic_by_period(_dated_topics(spark, sf_dir), APP, unit="week")
    return _six(rows.withColumn("period", _text("period")), "mean_theta")


def topic_by_month(spark, sf_dir):
    rows = trends.topic_by_period(_dated_topics(spark, sf_dir), APP)
    return _six(rows.withColumn("period", _text("period")), "mean_theta")


def topic_by_version(spark, sf_dir):
    return _six(trends.topic_by_version(_dated_topics(spark, sf_dir), APP), "mean_theta")


def topic_by_rating(spark, sf_dir):
    return _six(trends.topic_by_rating(_dated_topics(spark, sf_dir), APP), "mean_rating")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        page_flatten, props_flatten, next_offset, page_offsets, review_date_parse, feed_reviews,
        extract_reviews_app_store, extract_reviews_google_play, review_topics_run, topic_result_upsert_store_key,
        write_reviews_then_read, read_reviews_typed, entity_key, topic_result_upsert, topic_result_versions,
        topic_result_json, topic_result_read, conform_schema, date_cutoff, entity_validate,
        result_constraints, text_column_pick, topic_lookup, app_listing_app_store,
        app_listing_google_play, slug_normalize, id_from_page, id_from_landing_page, landing_url_build,
        newest_n_per_app, review_cap, dedup_reviews, strip_punct, tokenize, remove_stop_words_english,
        remove_stop_words, drop_empty_tokens, token_count, min_token_filter, normalize_tokens, lemmatize,
        pos_tag, chunk_ngrams, finish_concat, wordless_documents, top_terms_by_source, vocabulary,
        term_frequency, document_frequency, idf, tf_idf, doc_count_check, doc_length_stats, label_topics,
        align_docs, topic_mass, topic_proportion, summary_validate, term_topic_freq, term_marginal, saliency,
        log_prob_lift, relevance, token_table, topic_pairs, topic_distance, label_top_terms, lda_fit, lda_fit_validate,
        topic_term, doc_topic, lda_per_entity, lda_validate, linguistic_lda, top_terms_per_topic, topic_coordinates,
        topic_summary, lda_relevance, stream_ingest, stream_dedup, stream_upsert, topic_by_period,
        topic_by_month, topic_by_version, topic_by_rating,
    )
}
