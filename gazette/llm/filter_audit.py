"""Filter interaction audit on failing-id relations.

Each filter's failing ids are a table of their own.  What a filter removes
after a prefix of other filters is its table, left-anti joined with the tables
of the prefix; survivors are all documents less what the prefix removed, and
redundancies the filter's failing ids less what it removes.  Semi joins with the
ids of a label give the label's losses in the same way.

Order within a prefix doesn't matter, so the relations are kept per (filter,
set of filters before it), and grown one filter at a time: one left-anti join
a level serves all filters and sets of a size.  Documents that fail nothing
never enter a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import staged, table

SPACES = r"[\x20\x09-\x0D]+"
ROW = "_id, _part, _key"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text that isn't null, over its array of words ``_w``."""
    n, distinct = F.size("_w"), F.size(F.array_distinct("_w"))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * capitals > 10 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def failing_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                copies: str = "E") -> tuple[DataFrame, DataFrame]:
    """(rows, failing).  rows: ``_id, _part, _key`` of every document, once per
    row of ``docs``.  failing: the same columns and ``filter``, one stored table for
    each filter.  ``_key`` stands for the row's id and text in 128 bits.

    Null text is the empty text, a null part the empty string.  ``copies``: texts
    equal to that of any smaller id fail; a null id compares with nothing, so it
    never fails for this.  Rows that repeat as a whole fail the same filters and
    count each.  The copies' first ids are one row a text, and the others are found
    by a left-anti join on (text, id), so a text with a third of all rows is spread
    over its ids."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cut = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("_part"), text.alias("_text"),
                      F.md5(text).alias("_copy")).withColumn("_w", F.array_remove(F.split("_text", SPACES), ""))
    own = F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("-")), F.lit(":"), F.col("_copy"))
    failed = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in text_filters(F.col("_text")).items()]))
    read = staged(cut.select("_id", "_part", F.unhex(F.md5(own)).alias("_key"), F.unhex("_copy").alias("_copy"), failed.alias("_failed")), "audit-rows")
    firsts = read.groupBy("_copy").agg(F.min("_id").alias("_id"))
    later = read.filter(F.col("_id").isNotNull()).join(firsts, ["_copy", "_id"], "left_anti")
    failing = (read.selectExpr(*ROW.split(", "), "explode(_failed) AS filter")
               .unionByName(later.selectExpr(*ROW.split(", "), f"'{copies}' AS filter")))
    return read.selectExpr(*ROW.split(", ")), staged(failing, "audit-failing", by="filter")


def removals(failing: DataFrame, filters: Sequence[str]) -> DataFrame:
    """``failing`` (``_key``, ``filter`` and other columns) joined level by level:
    one row for each failing row, filter and set of other filters (``_before``, a
    bit for each filter) that the row passes all of."""
    bit = {f: 1 << k for k, f in enumerate(filters)}
    mask = F.coalesce(*[F.when(F.col("filter") == f, F.lit(b)) for f, b in bit.items()])
    fails = failing.select(mask.alias("_next"), "_key").distinct()
    level = failing.withColumns({"_own": mask, "_before": F.lit(0)})
    out = level
    for size in range(1, len(filters)):
        grown = (level.withColumn("_next", F.explode(F.array(*[F.lit(b) for b in bit.values()])))
                 .filter((F.col("_next") != F.col("_own")) & (F.col("_next") > F.col("_before"))))
        kept = grown.join(fails, ["_next", "_key"], "left_anti")
        level = staged(kept.withColumn("_before", F.col("_before").bitwiseOR(F.col("_next"))).select(*level.columns), f"audit-level-{size}")
        out = out.unionByName(level)
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                 good: Column | None = None, toxic: Column | None = None) -> DataFrame:
    """One row per part, order of the five filters and step: ``part, filter_order,
    step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    An empty table gives an empty result; parts without a failing document have
    rows of zeros.  A document whose id stands in several rows of ``labels``
    counts once if any of them has the label; null ids have no label.  Other
    columns of either table are ignored.  Long texts are read once, in the scan.
    The result has 600 rows a part; its windows hold one part.
    """
    filters = "ABCDE"
    good = F.col("quality") == 1 if good is None else good
    toxic = F.col("toxic") == 1 if toxic is None else toxic
    rows, failing = failing_ids(docs, id_col, text_col, part_col)
    kinds = failing.withColumn("_kind", F.lit("all"))
    for kind, hit in (("good", good), ("toxic", toxic)):
        ids = labels.filter(hit).select(F.col(id_col).alias("_id"))
        kinds = kinds.unionByName(failing.join(ids, "_id", "left_semi").select(*failing.columns).withColumn("_kind", F.lit(kind)))
    related = removals(kinds.select("_kind", "_part", "_key", "filter"), filters)
    counted = related.groupBy("_part", "filter", "_before").pivot("_kind", ["all", "good", "toxic"]).count()
    counted = staged(counted, "audit-counts")      # at most 80 rows a part

    orders = F.split(F.lit(",".join(map("".join, permutations(filters)))), ",")
    grid = (rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_total")).withColumn("filter_order", F.explode(orders))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
            .withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1))))
    bits = [(F.lit(f), 1 << k) for k, f in enumerate(filters)]
    total = lambda hit: sum((F.when(hit(f), b).otherwise(0) for f, b in bits), F.lit(0))
    grid = grid.withColumns({"_before": total(lambda f: F.instr("filter_order", f) < F.col("step")), "_others": total(lambda f: F.col("filter") != f)})
    removed = counted.select("_part", "filter", "_before", F.col("all").alias("removed"), F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"))
    failed = counted.filter("_before = 0").select("_part", "filter", F.col("all").alias("_fails"))
    unique = counted.select("_part", "filter", F.col("_before").alias("_others"), F.col("all").alias("unique_fails"))
    met = (grid.join(removed, ["_part", "filter", "_before"], "left").join(failed, ["_part", "filter"], "left")
           .join(unique, ["_part", "filter", "_others"], "left").na.fill(0))
    so_far = F.sum("removed").over(Window.partitionBy("_part", "filter_order").orderBy("step"))
    return met.select(F.col("_part").alias("part"), "filter_order", "step", (F.col("_total") - so_far).alias("kept"), "removed",
                      (F.col("_fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
                      F.sum("removed").over(Window.partitionBy("_part", "filter")).alias("shapley"))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM documents
), fails AS (
  SELECT part, good, toxic, CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
       + CASE WHEN 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(text) THEN 4 ELSE 0 END
       + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
       + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS m
  FROM d
), f(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5
), steps AS (
  SELECT filter_order, step, f.b, (SELECT coalesce(sum(g.b), 0) FROM f g WHERE contains(left(filter_order, step - 1), g.f)) AS before
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders) JOIN f ON f.f = substr(filter_order, step, 1)
), counts AS (SELECT part, m, count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM fails GROUP BY 1, 2),
rows_ AS (
  SELECT part, filter_order, step, b,
         sum(CASE WHEN m & CAST(before + b AS INT) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN m & b > 0 AND m & CAST(before AS INT) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN m & b > 0 AND m & CAST(before AS INT) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN m = b THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN m & b > 0 AND m & CAST(before AS INT) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN m & b > 0 AND m & CAST(before AS INT) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley
FROM rows_
"""
