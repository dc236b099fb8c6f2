"""Article versions and other inputs derived from the driver test tables.

The test tables hold no articles, so ``articles`` maps them: every event is
one article version, its document supplies title and text, its customer the
author name.  Consecutive events share a document, so each article has
several versions, in same-day pairs.  All other inputs here (delete log,
feed payload pages, helper inputs) are derived from that view, so every
query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.operators.dedupe import latest_per_key
from gazette.sources.tables import load, row_count

# Categories the fixture accepts in its clean step (event types; "error" is
# outside the list and becomes NULL).
FIXTURE_CATEGORIES = ["click", "purchase", "signup", "view"]
PAGE_SIZE = 20          # edges per feed page
ROWS_PER_TASK = 25_000  # rows that a task joins to their texts
PAGES_PER_FEED = 50     # pages per scrape run, so a feed holds <= 1000 rows


#: The article columns that come from the document.
TEXT_COLUMNS = ["title", "content", "content_length"]


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article versions without their text: seq, id, the narrow article columns
    and ``is_hard_deleted``.  An id without a document is no article: it leaves
    where the text is joined."""
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name")

    # Document count: one number (a footer-only count), taken as a literal so
    # plans that read the articles more than once stay identical and Spark
    # can reuse their exchanges.
    n_docs = F.lit(row_count(spark, sf_dir, "documents")).cast("long")
    eid = F.col("event_id")
    return events.join(customer, F.col("user_id") == F.col("c_custkey"), "left").select(
        eid.alias("seq"),
        F.pmod(F.call_function("div", eid, F.lit(2)), n_docs).alias("id"),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(F.col("user_id")).cast("long").alias("author_id"),
        F.when(eid % 20 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("author_name"),
        F.col("event_type").alias("category"),
        F.col("ts").alias("published_at"),
        F.when(eid % 29 == 0, F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts")).alias("created_at"),
        F.timestamp_add("MINUTE", eid % 13 - 1, F.col("ts")).alias("updated_at"),
        F.when(eid % 50 == 0, F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("deleted_at"),
    ).withColumn("is_hard_deleted", F.col("id") % 25 == 0)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title, content and content_length of every document.  Title and
    length are derived here, so a query that never reads the text does not
    carry it through a join."""
    return load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content"),
        F.length("text").cast("long").alias("content_length"),
    )


def text_parts(spark: SparkSession, sf_dir: str, per_task: int = ROWS_PER_TASK) -> int:
    """Tasks of a text join.  Its output is as large as the versions' texts,
    which no exchange before it shows to AQE, so the number follows the rows."""
    rows = max(row_count(spark, sf_dir, "events"), row_count(spark, sf_dir, "documents"))
    return max(3, -(-rows // per_task))


def join_text(spark: SparkSession, sf_dir: str, rows: DataFrame, one_each: bool = True, dealt: bool = False) -> DataFrame:
    """``rows`` (by id) with title, content and content_length.  Narrow rows and
    documents are exchanged once; each task holds the texts of its ids, not of
    its rows, and sorts neither.  ``dealt``: the rows lie in ``text_parts`` tasks by id.

    ``one_each`` takes one of the documents with the same id: their versions
    tie, and a dedupe keeps one row of a tie."""
    n = text_parts(spark, sf_dir)
    docs = texts(spark, sf_dir).withColumn("__text", F.xxhash64("content")).repartition(n, "id")
    if one_each:
        docs = latest_per_key(docs, ["id"], [F.col("__text").desc()])
    return (rows if dealt else rows.repartition(n, "id")).join(docs.drop("__text").hint("shuffle_hash"), "id")


def articles(spark: SparkSession, sf_dir: str, with_length: bool = False) -> DataFrame:
    """Article versions: seq, the article columns and ``is_hard_deleted``.

    The text is joined last, so only documents and narrow rows are exchanged,
    not the text of every version.  ``with_length`` adds ``content_length``."""
    return join_text(spark, sf_dir, versions(spark, sf_dir), one_each=False).select(
        "seq", *S.ARTICLE_COLUMNS, "is_hard_deleted", *(["content_length"] if with_length else []))


def batch_of(col: str = "updated_at") -> Column:
    """One pipeline run per day of ``updated_at``."""
    return F.to_date(F.col(col))


def loaded_at(col: str = "updated_at") -> Column:
    """Load clock of the fixture: five minutes after the version's update."""
    return F.col(col) + F.expr("INTERVAL 5 MINUTES")


def staging_raw(art: DataFrame) -> DataFrame:
    """Raw-table rows for staging tests: no clean step, ``error`` is the
    literal UNKNOWN, the flag is the fixture's tombstone flag."""
    return art.select(
        *[c for c in art.columns if c not in ("category",)],
        F.when(F.col("category") == "error", F.lit(S.UNKNOWN_CATEGORY))
         .otherwise(F.col("category")).alias("category"),
    ).withColumn("_loaded_at", loaded_at())


def article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the previous source snapshot (every article), from the two id
    columns alone; ``removed`` tells the ids that the current one lacks."""
    n_docs = F.lit(row_count(spark, sf_dir, "documents")).cast("long")
    keys = load(spark, sf_dir, "events").select(F.pmod(F.call_function("div", F.col("event_id"), F.lit(2)), n_docs).alias("id")).distinct()
    ids = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")).join(keys, "id", "left_semi")
    return ids.withColumn("removed", F.col("id") % 25 == 0)


def snapshot_time(spark: SparkSession, sf_dir: str) -> Column:
    """Clock of the current source snapshot: a day after the last event.

    A scalar subquery over one column of ``events`` (no join), so plans
    that stamp deletes with it do not rebuild the article versions."""
    ev = load(spark, sf_dir, "events")
    return ev.select(F.max("ts") + F.expr("INTERVAL 1 DAY")).scalar()


# --- helper inputs over the events table ----------------------------------------
# Each event supplies one input per helper; the remainders put NULL, empty
# and boundary values among ordinary ones.

EDU_INPUTS = ["SMA", "D3", "S1", "S2", "S3", "", "SD", None]
DEVICE_INPUTS = ["Mobile Safari", "iPad Tablet", "Desktop Chrome", "", None, "TABLET-mobile", "smart tv"]


def _pick(eid: Column, values: list) -> Column:
    """values[eid % len(values)] as a CASE expression."""
    k = eid % len(values)
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        out = F.when(k == i, lit) if out is None else out.when(k == i, lit)
    return out


def helper_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("event_id", "event_type")
    eid = F.col("event_id")
    return ev.select(
        "event_id",
        F.when(eid % 12 == 11, F.lit(None)).otherwise((eid % 12).cast("string")).alias("channel_id"),
        F.when(eid % 7 == 0, F.concat(F.lit("slug-"), F.col("event_type")))
         .when(eid % 7 == 1, F.lit("")).alias("channel_slug"),
        F.when(eid % 110 == 109, F.lit(None)).otherwise(eid % 110).alias("age"),
        F.when(eid % 97 == 0, F.lit(None)).otherwise(eid * 997 % 2_000_000).alias("followers"),
        _pick(eid, EDU_INPUTS).alias("edu"),
        _pick(eid, DEVICE_INPUTS).alias("device"),
    )


def helper_inputs_sql() -> str:
    """The same inputs in DuckDB SQL (a CTE body over ``events``)."""
    def pick(values):
        whens = " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
        return f"CASE event_id % {len(values)} {whens} END"
    return f"""
        SELECT event_id,
               CASE WHEN event_id % 12 = 11 THEN NULL ELSE CAST(event_id % 12 AS VARCHAR) END AS channel_id,
               CASE WHEN event_id % 7 = 0 THEN 'slug-' || event_type WHEN event_id % 7 = 1 THEN '' END AS channel_slug,
               CASE WHEN event_id % 110 = 109 THEN NULL ELSE event_id % 110 END AS age,
               CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id * 997 % 2000000 END AS followers,
               {pick(EDU_INPUTS)} AS edu,
               {pick(DEVICE_INPUTS)} AS device
        FROM events"""
