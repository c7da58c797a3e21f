"""Scalar column helpers shared by every operator.

All of them are built-in expressions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000
NUMERIC_LIMIT = 1e9


def column(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name}`")


def guarded_div(a: Column, b: Column) -> Column:
    """``a / b`` with 0 for a zero divisor; nulls stay null."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def at_least(value: Column, low: float) -> Column:
    """Lower clip that keeps null (``greatest`` alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low)))


def lenient_timestamp(value: Column) -> Column:
    """Parse text or pass a timestamp through; junk becomes null."""
    return value.try_cast("timestamp_ntz")


def strict_timestamp(value: Column) -> Column:
    """Parse text or pass a timestamp through; junk raises under ANSI mode."""
    return value.cast("timestamp_ntz")


def floor_days(start: Column, end: Column) -> Column:
    """Whole elapsed days, floored (also for negative spans)."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("bigint")


def quarter_label(day: Column) -> Column:
    """``2018Q4``; null for null."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def quarter_index(day: Column) -> Column:
    """Year times four plus quarter."""
    return (F.year(day) * 4 + F.quarter(day)).cast("bigint")


def total(value: Column) -> Column:
    """Sum of doubles, 0 for a sum over nothing but nulls."""
    return F.coalesce(F.sum(value.cast("double")), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def drop_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column, keeping the column order."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *(
            F.nanvl(column(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, floating)
            else column(f.name)
            for f in df.schema.fields
        )
    )


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric columns, from the schema alone."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the string columns, from the schema alone."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def sanitize_numerics(
    df: DataFrame, exclude: tuple[str, ...] = (), na_fill: float | None = None
) -> DataFrame:
    """Clip every numeric column to +-1e9 and round doubles half-even to 6 places.

    They are rounded to 9 places first, so that the order in which a sum was added up cannot
    decide a tie. Infinities keep their sign. ``na_fill`` replaces nulls first.
    """

    def cleaned(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if not isinstance(field.dataType, T.NumericType) or field.name in exclude:
            return name
        floating = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        value = f"nanvl({name}, CAST(NULL AS DOUBLE))" if floating else name
        if na_fill is not None:
            value = f"coalesce({value}, CAST({na_fill} AS {field.dataType.simpleString()}))"
        low, high = (f"{sign}{int(NUMERIC_LIMIT)}{'D' if floating else ''}" for sign in ("-", ""))
        clipped = f"CASE WHEN {value} IS NOT NULL THEN least(greatest({value}, {low}), {high}) END"
        if floating:
            return f"bround(bround({clipped}, 9), 6) AS {name}"
        return f"CAST({clipped} AS {field.dataType.simpleString()}) AS {name}"

    return df.selectExpr(*(cleaned(f) for f in df.schema.fields))
