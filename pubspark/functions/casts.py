"""Tolerant casts with the semantics of the silver layer (bad input -> NULL, never an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Only complete calendar dates convert; Spark would otherwise read '2026-01' as 2026-01-01.
_FULL_DATE = r"^[+-]?\d{4,}-\d{1,2}-\d{1,2}$"


def try_date(text: Column) -> Column:
    """Text -> DATE; partial or impossible dates (month 13) give NULL."""
    return F.when(text.rlike(_FULL_DATE), text.try_cast("date"))


# Date-time text must hold a complete date; Spark would otherwise read '2024' or a bare time.
_FULL_DATE_TIME = r"^[+-]?\d{4,}-\d{1,2}-\d{1,2}(?:[T ].*)?$"


def try_timestamp(text: Column) -> Column:
    """ISO date-time text (with zone suffix) -> TIMESTAMP in the session zone (UTC); text without
    a complete date gives NULL."""
    return F.when(text.rlike(_FULL_DATE_TIME), text.try_cast("timestamp"))


def try_long_rounded(value: Column) -> Column:
    """Numeric or numeric-text value (VARIANT) -> BIGINT; else NULL.

    Fractions round the way the silver integer cast treats its input type: JSON numbers (read
    as DOUBLE) half to even, numeric text half away from zero."""
    text = F.to_json(value)
    # Eighteen decimals in text; whole JSON numbers exactly; other numbers as the DOUBLE they are.
    from_text = F.round(F.try_variant_get(value, "$", "decimal(38,18)"), 0).try_cast("bigint")
    from_number = F.bround(F.try_variant_get(value, "$", "double"), 0).try_cast("bigint")
    return (F.when(text.startswith('"'), from_text)
            .when(text.rlike(r"^-?\d+$"), F.try_variant_get(value, "$", "bigint")).otherwise(from_number))


def try_int(value: Column) -> Column:
    """BIGINT -> INT, NULL when out of range (fractions were already rounded in bronze)."""
    return value.try_cast("int")
