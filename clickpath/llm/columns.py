"""Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where a lambda uses it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def window_hashes(tokens: Column, size: int) -> Column:
    """64-bit hash of every ``size``-token window, in order (shorter arrays: none).  ``tokens``: a plain column."""
    first = F.slice(tokens, 1, F.greatest(F.size(tokens) - (size - 1), F.lit(0)))
    return F.transform(first, lambda x, i: F.xxhash64(x, *[F.get(tokens, i + j) for j in range(1, size)]))


def row_digest(docs: DataFrame) -> tuple[Column, Column]:
    """128 bits of all columns of a row; the nulls count, as the hash itself skips them."""
    values = [x for c in sorted(docs.columns) for x in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit("a"), *values), F.xxhash64(F.lit("b"), *values)
