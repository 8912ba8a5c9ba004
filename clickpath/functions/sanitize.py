"""Column expressions that clean wire values (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import EVENT_TIME_FORMAT, NULL_TOKENS


def _token(c: Column) -> tuple[Column, Column]:
    text = F.lower(F.trim(c.cast("string")))
    is_null = text.isNull() | text.isin(*NULL_TOKENS)
    return text, is_null


def sanitize_long(c: Column) -> Column:
    """Text → bigint: null tokens → null, ``'101.0'`` → 101, garbage → null.

    Plain integers are cast exactly (all 19 digits kept).  Other numeric text
    goes through decimal(38,6) and is truncated toward zero; NaN, infinity,
    overflow and garbage give null.
    """
    text, is_null = _token(c)
    exact = text.try_cast("bigint")
    via_decimal = text.try_cast("decimal(38,6)").try_cast("bigint")
    return F.when(is_null, F.lit(None).cast("bigint")).otherwise(F.coalesce(exact, via_decimal))


def sanitize_double(c: Column) -> Column:
    """Text → double: null tokens, NaN and infinities → null."""
    text, is_null = _token(c)
    value = text.try_cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(is_null | ~finite, F.lit(None).cast("double")).otherwise(value)


def blank_to_null(c: Column) -> Column:
    """Empty string → null (category_code, brand, user_session)."""
    return F.nullif(c, F.lit(""))


def parse_event_time(c: Column, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Wire text → timestamp; unparsable text → null (never an exception)."""
    return F.try_to_timestamp(c, F.lit(fmt))
