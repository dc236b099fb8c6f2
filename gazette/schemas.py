"""Explicit table schemas and the fixed values the results depend on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source system's values for results to
# match; they are listed plainly and in their natural order.
# ---------------------------------------------------------------------------

# Accepted article categories (clean allow-list and accepted_values check).
VALID_CATEGORIES = [
    "nasional", "ekonomi", "olahraga", "teknologi", "hiburan",
    "woman", "mom", "otomotif", "food-travel", "bolanita",
]

# Channel id -> category used when articles are ingested from the feed.
INGEST_CHANNEL_MAP = {
    "1": "nasional", "2": "hiburan", "3": "woman", "4": "mom",
    "5": "olahraga", "6": "teknologi", "7": "otomotif",
    "8": "food-travel", "9": "bolanita", "10": "ekonomi",
}
INGEST_CHANNEL_DEFAULT = "UNKNOWN"

# Channel id -> slug of the shared helper variant.
ALT_CHANNEL_MAP = {
    "1": "news", "2": "entertainment", "3": "woman", "4": "mom",
    "5": "bola-sports", "6": "tekno-sains", "7": "otomotif",
    "8": "food-travel", "9": "bolanita", "10": "bisnis",
}
ALT_CHANNEL_DEFAULT = "other"

# Education level codes; anything else (including NULL and "") is 0.
EDU_LEVELS = {"SMA": 1, "D3": 2, "S1": 3, "S2": 4, "S3": 5}

# Age buckets: label for age < bound, in ascending order; the rest is "55+".
AGE_BUCKETS = [(18, "<18"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
AGE_TOP, AGE_UNKNOWN = "55+", "Unknown"

# Follower tiers: label for n < bound; NULL is "nano"; the rest is "mega".
FOLLOWER_TIERS = [(10_000, "nano"), (100_000, "micro"), (500_000, "mid"), (1_000_000, "macro")]
FOLLOWER_TOP, FOLLOWER_NULL = "mega", "nano"

UNKNOWN_CATEGORY = "UNKNOWN"              # staging turns it into NULL
NO_CATEGORY_LABEL = "(tanpa kategori)"    # report label for NULL/empty category
DEFAULT_WATERMARK = dt.datetime(2016, 1, 1)
DQ_THRESHOLD = 0.85                       # overall score gate
FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS = 2, 6
DRIFT_WINDOW, DRIFT_MIN_POINTS, DRIFT_Z = 20, 5, 2.0
PAGE_DEFAULT, PAGE_MAX = 20, 200          # articles page size bounds
HISTORY_DEFAULT, HISTORY_MAX, HISTORY_BI = 10, 100, 50
TITLE_MAX, LEAD_MAX, META_MAX, AUTHOR_MAX = 500, 2000, 1000, 200
DATA_SOURCE = "lake"
TABLE_NAME = "articles"
SCORE_DIMENSIONS = ["completeness", "accuracy", "consistency", "timeliness", "validity", "uniqueness"]

# ---------------------------------------------------------------------------
# Schemas (one explicit StructType per table; cast before every write).
# ---------------------------------------------------------------------------

TS = T.TimestampNTZType()

ARTICLE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("author_id", T.LongType()),
    T.StructField("author_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("published_at", TS),
    T.StructField("created_at", TS),
    T.StructField("updated_at", TS),
    T.StructField("deleted_at", TS),
])
ARTICLE_COLUMNS = [f.name for f in ARTICLE.fields]

ARTICLE_DELETED = T.StructType([
    T.StructField("article_id", T.LongType()),
    T.StructField("deleted_at", TS),
])

ARTICLES_RAW = T.StructType(ARTICLE.fields + [
    T.StructField("is_hard_deleted", T.BooleanType()),
    T.StructField("_loaded_at", TS),
])

WATERMARK = T.StructType([
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("last_updated_at", TS),
    T.StructField("written_at", TS),
])

SCORECARD = T.StructType([
    T.StructField("run_at", TS),
    T.StructField("data_source", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
] + [T.StructField(d, T.DoubleType()) for d in SCORE_DIMENSIONS] + [
    T.StructField("overall_score", T.DoubleType()),
])

# Nested feed payload: every leaf is a string, as delivered by the API.
STORY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("leadText", T.StringType()),
    T.StructField("metaDescription", T.StringType()),
    T.StructField("author", T.StructType([
        T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])),
    T.StructField("channel", T.StructType([
        T.StructField("id", T.StringType()), T.StructField("slug", T.StringType())])),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("createdAt", T.StringType()),
    T.StructField("updatedAt", T.StringType()),
    T.StructField("deletedAt", T.StringType()),
])
FEED_PAGE = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("FindAllActiveHeadlines", T.StructType([
            T.StructField("edges", T.ArrayType(T.StructType([T.StructField("story", STORY)]))),
        ])),
    ])),
])
