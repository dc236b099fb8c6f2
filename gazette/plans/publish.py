"""Write-audit-publish for the marts.

Models are written to a new version directory in the shared folder, the
data tests run against those files, and one pointer record publishes them
all when no blocking check fails.  A failed audit leaves the previously
published marts in place (the source system tested after publishing).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.operators import checks as CK
from gazette.plans import models as M
from gazette.plans.models import Models
from gazette.plans.serving import PAGE_COLUMNS, articles_after, by_key
from gazette.sources import tables as TB
from gazette.sources import versioned

MART_MODELS = ("int_articles_deduped", "fct_articles", "dim_author", "dim_date", "mart_dq_scorecard")


@dataclass
class AuditResult:
    summary: DataFrame          # one row per check
    published: bool
    version: dict[str, str]     # model -> written path


def row_tests(as_of) -> dict[str, list[CK.RowTest]]:
    """Data tests on single rows: counted while their model is written."""
    return {"int_articles_deduped": [CK.no_future_test(as_of)],
            "fct_articles": [CK.not_null_test(c) for c in ("article_id", "author_id", "date_day")],
            "dim_author": [CK.not_null_test("author_id")], "dim_date": [CK.not_null_test("date_day")]}


def stage_models(wh: Models, root: str, as_of=None, counted: list[CK.Check] | None = None) -> dict[str, DataFrame]:
    """Write every mart model once below ``root`` and return DataFrames over
    the written files.  The fact table and the dimensions are built from the
    written dedupe table, so raw is read and deduplicated once.

    Facts are stored by month and sorted by category and id, so a category or
    date filter and an id range prune files and row groups.  ``counted`` takes
    the row tests at ``as_of``, counted by the writes themselves."""
    spark = wh.spark
    tests = {} if counted is None else row_tests(as_of)

    def put(name: str, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        def write(rows: DataFrame) -> None:
            writer = rows.write.mode("errorifexists")
            (writer.partitionBy(*by) if by else writer).parquet(f"{root}/{name}")

        checks = CK.write_counted(df, tests.get(name, ()), write, name)
        if counted is not None:
            counted.extend(checks)
        return spark.read.schema(df.schema).parquet(f"{root}/{name}").drop(*(by or []))

    deduped = put("int_articles_deduped", wh.deduped)
    fct = M.fct_articles(deduped).withColumn("month", F.date_format("date_day", "yyyy-MM"))
    laid_out = fct.repartitionByRange("month", "category", "article_id").sortWithinPartitions("month", "category", "article_id")
    return {
        "int_articles_deduped": deduped,
        "fct_articles": put("fct_articles", laid_out, ["month"]),
        "dim_author": put("dim_author", M.dim_author(deduped)),
        "dim_date": put("dim_date", M.dim_date(deduped)),
        "mart_dq_scorecard": put("mart_dq_scorecard", wh.mart_dq_scorecard),
    }


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A model of the published version; all models come from one run."""
    path = versioned.current_path(spark, root)
    return None if path is None else spark.read.parquet(f"{path}/{name}").drop("month") if name == "fct_articles" else spark.read.parquet(f"{path}/{name}")


#: Copies for point lookups: (model, its id, what it is copied from).
LOOKUPS = (("article_lookup", "article_id", "fct_articles"), ("author_lookup", "author_id", "dim_author"))
NULL_MONTH = "__HIVE_DEFAULT_PARTITION__"


def stage_lookups(spark: SparkSession, root: str, staged: dict[str, DataFrame]) -> None:
    """Copies of the facts and authors in order of their id, so that an id lies
    in one file and row group by its range, with a Parquet Bloom filter on the
    id, so that an id that isn't there is not searched for."""
    for name, key, model in LOOKUPS:
        rows = staged[model].repartitionByRange(key).sortWithinPartitions(key)
        (rows.write.mode("errorifexists").option(f"parquet.bloom.filter.enabled#{key}", "true")
         .option(f"parquet.bloom.filter.adaptive.enabled#{key}", "true").parquet(f"{root}/{name}"))


def lookup(spark: SparkSession, root: str, name: str, value) -> DataFrame | None:
    """The row of one id (none or one) from a published lookup copy."""
    key = {n: k for n, k, _ in LOOKUPS}[name]
    path = versioned.current_path(spark, root)
    return None if path is None else by_key(spark.read.parquet(f"{path}/{name}"), key, value)


def page_after_stored(spark: SparkSession, root: str, after_day, after_id: int, limit: int) -> DataFrame:
    """Keyset page over the published facts: months are read one after the
    other, newest first (facts without a day before them), from the cursor's
    own on, until the page is full.  A page holds ``limit`` rows, so these reach
    the driver; a month is a top-k over its own files."""
    path = f"{versioned.current_path(spark, root)}/fct_articles"
    months = TB.partition_values(spark, path, "month=")
    order = [m for m in (NULL_MONTH,) if m in months and after_day is None]
    order += [m for m in reversed(months) if m != NULL_MONTH and (after_day is None or m <= f"{after_day:%Y-%m}")]
    rows, schema = [], spark.read.parquet(path).drop("month").select(*PAGE_COLUMNS).schema
    for month in order:
        part = read_month(spark, path, month)
        rows += articles_after(part, after_day, after_id, limit - len(rows)).collect()
        if len(rows) == limit:
            break
    return spark.createDataFrame(rows, schema)


def read_month(spark: SparkSession, path: str, month: str) -> DataFrame:
    return spark.read.parquet(f"{path}/month={month}")


def audit(staged: dict[str, DataFrame], raw: DataFrame, as_of, stg: DataFrame, counted: list[CK.Check] | None = None) -> list[CK.Check]:
    """All data tests: staging, facts, dimensions, singular tests, freshness.
    Staging keeps every version of an article, so its unique test warns.
    ``counted``: row tests that the staging writes have counted; the others of
    a published model need a scan."""
    d, fct = staged["int_articles_deduped"], staged["fct_articles"]
    da, dd = staged["dim_author"], staged["dim_date"]
    known = {(c.name, c.model, c.column): c for c in counted or ()}
    return [known.get((c.name, c.model, c.column), c) for c in [
        CK.Check("unique", "stg_articles", "article_id", "warn", CK.check_unique(stg, "article_id")),
        CK.not_null("stg_articles", stg, "article_id"),
        CK.not_null("stg_articles", stg, "title"),
        CK.not_null("stg_articles", stg, "published_at"),
        CK.Check("accepted_values", "stg_articles", "category", "warn",
                 CK.check_accepted_values(stg, "category", S.VALID_CATEGORIES)),
        CK.Check("unique", "fct_articles", "article_id", "error", CK.check_unique(fct, "article_id")),
        CK.not_null("fct_articles", fct, "article_id"),
        CK.not_null("fct_articles", fct, "author_id"),
        CK.Check("relationships", "fct_articles", "author_id", "error",
                 CK.check_relationships(fct, "author_id", da, "author_id")),
        CK.not_null("fct_articles", fct, "date_day"),
        CK.Check("relationships", "fct_articles", "date_day", "error",
                 CK.check_relationships(fct, "date_day", dd, "date_day")),
        CK.Check("unique", "dim_author", "author_id", "error", CK.check_unique(da, "author_id")),
        CK.not_null("dim_author", da, "author_id"),
        CK.Check("unique", "dim_date", "date_day", "error", CK.check_unique(dd, "date_day")),
        CK.not_null("dim_date", dd, "date_day"),
        CK.Check("no_future_published", "int_articles_deduped", "published_at", "error",
                 CK.check_no_future(d, as_of)),
        CK.Check("dq_score_above_threshold", "mart_dq_scorecard", "overall_score", "error",
                 CK.check_dq_threshold(staged["mart_dq_scorecard"], S.DQ_THRESHOLD)),
        CK.Check("freshness", "articles_raw", "_loaded_at", "error", CK.check_freshness(raw, as_of)),
    ]]


def moment(spark: SparkSession, at):
    """A time given as any one-row expression, as a literal: asked once, not by every check."""
    return F.lit(spark.range(1).select(at.cast("timestamp_ntz").cast("string")).first()[0]).cast("timestamp_ntz")


def write_audit_publish(wh: Models, root: str, as_of, blocking: set[str] | None = None) -> AuditResult:
    """Stage, audit, and publish when no blocking check fails.

    ``blocking`` names what stops the publish, as ``check`` or
    ``check:model.column`` (default: every error-severity check).  Each run
    stages below a path of its own, and one pointer record publishes all
    models together.  Only the one-row-per-check summary reaches the driver.
    """
    path = versioned.new_version(root)
    as_of, counted = moment(wh.spark, as_of), []
    staged = stage_models(wh, path, as_of, counted)
    stage_lookups(wh.spark, path, staged)
    summary = CK.summarize(audit(staged, wh.raw, as_of, wh.stg, counted))
    name = F.col("check_name")
    full = F.concat(name, F.lit(":"), F.col("model"), F.lit("."), F.coalesce("column_name", F.lit("")))
    stops = F.lit(True) if blocking is None else name.isin(*blocking) | full.isin(*blocking)
    rows = summary.collect()     # one row per check
    summary = wh.spark.createDataFrame(rows, summary.schema)
    if not summary.filter((F.col("status") == "fail") & stops).isEmpty():
        return AuditResult(summary, False, {})
    versioned.point(wh.spark, root, path)
    return AuditResult(summary, True, {name: f"{path}/{name}" for name in MART_MODELS})
