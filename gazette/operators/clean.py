"""Clean stage (I8): dedupe per run and key, allow-list, title whitespace."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.functions.text import collapse_ws
from gazette.operators.dedupe import any_per_key, latest_per_key


def allowed(col: str | Column, allow: Sequence[str]) -> Column:
    """Value when in the allow-list, else NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*allow), c)


def clean(df: DataFrame, allow: Sequence[str] = S.VALID_CATEGORIES,
          keys: Sequence[str] = ("id",), order: Sequence[Column] | None = None,
          attach: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per ``keys``; category outside ``allow`` -> NULL; title with
    whitespace runs collapsed and trimmed; tombstone flag reset to false.

    With ``order`` the survivor is the first row under it (deterministic);
    without, any row survives, as ``dropDuplicates`` does.  Pass the run
    column in ``keys`` so each run is deduplicated on its own.  ``attach`` adds
    columns that the choice doesn't need (title, text) to the survivors, so
    that no version's text passes the exchange of the choice.
    """
    kept = latest_per_key(df, keys, order) if order is not None else any_per_key(df, keys)
    if attach is not None:
        kept = attach(kept)
    title = {"title": collapse_ws("title")} if "title" in kept.columns else {}
    return kept.withColumns({"category": allowed("category", allow), **title, "is_hard_deleted": F.lit(False)})
