"""Reference SQL (DuckDB dialect) for every registered query.

The driver runs each string against the raw test tables, which are
registered as views; the article mapping and every model the Spark side
builds are restated here as CTEs, written independently in plain SQL
(e.g. the scorecard as separate counts per input, not the single-pass
form).  ``with_ctes`` prepends the CTEs a query needs, in dependency order.
"""

from __future__ import annotations


FIXTURE_ALLOW = "'click', 'purchase', 'signup', 'view'"


def _dim(num: str, den: str) -> str:
    """Half-up four-decimal ratio in ten-thousandths (exact integers)."""
    return f"CASE WHEN ({den}) > 0 THEN (20000 * ({num}) + ({den})) // (2 * ({den})) END"


# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {
    "articles": ([], f"""
        SELECT e.event_id AS seq, d.doc_id AS id, split_part(d.text, chr(10), 1) AS title, d.text AS content,
               CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE e.user_id END AS author_id,
               CASE WHEN e.event_id % 20 = 0 THEN NULL ELSE c.c_name END AS author_name,
               e.event_type AS category, e.ts AS published_at,
               CASE WHEN e.event_id % 29 = 0 THEN e.ts + INTERVAL 1 HOUR ELSE e.ts END AS created_at,
               e.ts + to_minutes(CAST(e.event_id % 13 - 1 AS BIGINT)) AS updated_at,
               CASE WHEN e.event_id % 50 = 0 THEN e.ts + INTERVAL 1 DAY END AS deleted_at,
               d.doc_id % 25 = 0 AS is_hard_deleted
        FROM events e
        JOIN documents d ON d.doc_id = (e.event_id // 2) % (SELECT count(*) FROM documents)
        LEFT JOIN customer c ON c.c_custkey = e.user_id"""),
    "batched": (["articles"], "SELECT *, CAST(updated_at AS DATE) AS batch, "
                              "CAST(length(content) AS BIGINT) AS content_length FROM articles"),
    "cleaned": (["batched"], f"""
        SELECT seq, id, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, content, author_id,
               author_name, CASE WHEN category IN ({FIXTURE_ALLOW}) THEN category END AS category,
               published_at, created_at, updated_at, deleted_at, false AS is_hard_deleted, batch,
               content_length
        FROM (SELECT *, row_number() OVER (PARTITION BY batch, id
                                           ORDER BY updated_at DESC NULLS FIRST, seq DESC) AS rn
              FROM batched) WHERE rn = 1"""),
    "raw": (["cleaned"], "SELECT *, updated_at + INTERVAL 5 MINUTE AS _loaded_at FROM cleaned"),
    "delete_log": (["articles"], """
        SELECT p.id AS article_id, (SELECT max(ts) FROM events) + INTERVAL 1 DAY AS deleted_at
        FROM (SELECT DISTINCT id FROM articles) p
        WHERE p.id NOT IN (SELECT id FROM articles WHERE id % 25 <> 0)"""),
    "raw_tomb": (["raw", "delete_log"], """
        SELECT r.seq, r.id, r.title, r.content, r.author_id, r.author_name, r.category, r.published_at,
               r.created_at, r.updated_at,
               CASE WHEN l.article_id IS NOT NULL THEN l.deleted_at ELSE r.deleted_at END AS deleted_at,
               CASE WHEN l.article_id IS NOT NULL THEN true ELSE r.is_hard_deleted END AS is_hard_deleted,
               r._loaded_at, r.batch, r.content_length
        FROM raw r LEFT JOIN delete_log l ON r.id = l.article_id"""),
    "stg": (["raw_tomb"], f"""
        SELECT id AS article_id, trim(title) AS title, content, author_id, author_name,
               nullif(category, 'UNKNOWN') AS category, published_at, created_at,
               updated_at, deleted_at, is_hard_deleted, _loaded_at, content_length
        FROM raw_tomb WHERE is_hard_deleted IS NOT TRUE"""),
    "deduped": (["stg"], """
        SELECT article_id, title, content, author_id, author_name, category, published_at, created_at,
               updated_at, CAST(published_at AS DATE) AS published_date, content_length
        FROM (SELECT *, row_number() OVER (PARTITION BY article_id
                                           ORDER BY updated_at DESC NULLS FIRST, _loaded_at DESC NULLS LAST) AS rn
              FROM stg) WHERE rn = 1"""),
    "fct": (["deduped"], """
        SELECT article_id, author_id, published_date AS date_day, category, content_length, title
        FROM deduped"""),
    "dim_author": (["deduped"], """
        SELECT author_id, max(author_name) AS author_name, count(*) AS total_articles,
               min(published_date) AS first_published_date, max(published_date) AS last_published_date
        FROM deduped GROUP BY author_id"""),
    "dim_date": (["deduped"], """
        SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS INTEGER) AS year,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               CAST(dayofweek(d) AS INTEGER) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name
        FROM (SELECT unnest(generate_series(CAST(min(published_date) AS TIMESTAMP),
                                            CAST(max(published_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
              FROM deduped)"""),
    "sc_counts": (["batched", "cleaned"], """
        SELECT r.batch, r.total, r.null_author, r.accurate, r.timely, r.raw_ids, c.valid_clean, c.clean_ids
        FROM (SELECT batch, count(*) AS total,
                     count(*) FILTER (WHERE author_name IS NULL) AS null_author,
                     count(*) FILTER (WHERE published_at <= updated_at) AS accurate,
                     count(*) FILTER (WHERE updated_at >= created_at) AS timely,
                     count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS raw_ids
              FROM batched GROUP BY batch) r
        JOIN (SELECT batch, count(*) FILTER (WHERE category IS NOT NULL) AS valid_clean,
                     count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS clean_ids
              FROM cleaned GROUP BY batch) c ON r.batch = c.batch"""),
    "sc_int": (["sc_counts"], f"""
        SELECT batch, total,
               {_dim('total - null_author', 'total')} AS completeness,
               {_dim('accurate', 'total')} AS accuracy,
               CASE WHEN total > 0 THEN 10000 END AS consistency,
               {_dim('timely', 'total')} AS timeliness,
               {_dim('valid_clean', 'total')} AS validity,
               {_dim('clean_ids', 'raw_ids')} AS uniqueness
        FROM sc_counts"""),
    "scorecards": (["sc_int"], f"""
        SELECT CAST(batch AS TIMESTAMP) + INTERVAL 1 DAY AS run_at, 'lake' AS data_source,
               'articles' AS table_name, CAST(total AS BIGINT) AS row_count,
               CAST(completeness AS DOUBLE) / 10000.0 AS completeness,
               CAST(accuracy AS DOUBLE) / 10000.0 AS accuracy,
               CAST(consistency AS DOUBLE) / 10000.0 AS consistency,
               CAST(timeliness AS DOUBLE) / 10000.0 AS timeliness,
               CAST(validity AS DOUBLE) / 10000.0 AS validity,
               CAST(uniqueness AS DOUBLE) / 10000.0 AS uniqueness,
               CAST((2 * (completeness + accuracy + consistency + timeliness + validity + uniqueness) + 6) // 12
                    AS DOUBLE) / 10000.0 AS overall_score
        FROM sc_int"""),
}


def with_ctes(body: str, *needed: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """``WITH`` clause holding ``needed`` and their dependencies, then ``body``."""
    table = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        deps, _ = table[name]
        for d in deps:
            visit(d)
        order.append(name)

    for n in needed:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({table[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body}"
