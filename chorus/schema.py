"""Schemas and fixed limits of the review data model."""

from pyspark.sql import types as T

# Feed schemas, limits and templates the store feeds define.
MAX_REVIEWS_PER_ENTITY = 1000
FEED_PAGE_SIZE = 20
MIN_TOKENS = 3
LDA_SEED = 42
LDA_TOPICS = 5
LDA_ITERATIONS = 30

APP_STORE_REVIEWS = T.StructType([
    T.StructField("date", T.TimestampType(), False),
    T.StructField("isEdited", T.BooleanType(), False),
    T.StructField("rating", T.ByteType(), False),
    T.StructField("review", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("userName", T.StringType(), False),
])

GOOGLE_PLAY_REVIEWS = T.StructType([
    T.StructField("reviewId", T.StringType(), False),
    T.StructField("userName", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("score", T.ByteType(), False),
    T.StructField("thumbsUpCount", T.IntegerType(), False),
    T.StructField("reviewCreatedVersion", T.StringType(), True),
    T.StructField("at", T.TimestampType(), False),
    T.StructField("appVersion", T.StringType(), True),
])

# One landed page of the feed. The date stays text here: it is parsed strictly later.
FEED_PAGE = (
    "data array<struct<attributes: struct<date: string, isEdited: boolean, rating: int,"
    " review: string, title: string, userName: string>>>, next string"
)

ENTITY = ["store", "app_id", "country", "lang"]
DOC = "review_id"

# Reviews of every store in one shape; app_id is text because one store uses text ids.
REVIEWS = T.StructType([
    T.StructField("store", T.StringType(), False),
    T.StructField("app_name", T.StringType(), True),
    T.StructField("app_id", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("lang", T.StringType(), False),
    T.StructField("review_id", T.StringType(), False),
    T.StructField("user_name", T.StringType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("text", T.StringType(), False),
    T.StructField("rating", T.ByteType(), False),
    T.StructField("thumbs_up", T.IntegerType(), True),
    T.StructField("app_version", T.StringType(), True),
    T.StructField("is_edited", T.BooleanType(), True),
    T.StructField("ts", T.TimestampType(), False),
])

TOPIC_RESULTS = T.StructType([
    T.StructField("store", T.StringType(), False),
    T.StructField("app_name", T.StringType(), True),
    T.StructField("app_id", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("lang", T.StringType(), False),
    T.StructField("lda_data", T.StringType(), False),
    T.StructField("update_dt", T.TimestampType(), False),
])

# Result key as the result tables define it; RESULT_KEY keeps two languages of one app apart.
STORE_RESULT_KEY = ["store", "app_name", "app_id", "country"]
RESULT_KEY = ["store", "app_name", "app_id", "country", "lang"]
