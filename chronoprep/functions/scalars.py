"""Parsing and null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Day-first layouts that are tried in this order.
DAY_FIRST = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "dd-MM-yyyy HH:mm:ss", "dd-MM-yyyy", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy")


def day_first(c: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in DAY_FIRST])


def number(c: Column) -> Column:
    """Text as a double, null where it is none."""
    return c.try_cast("double")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is null only: NaN of a floating column becomes null."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)}
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floating else F.col(f"`{c}`") for c in df.columns]) if floating else df


def convert_type(text: str):
    """A command-line value as int, float or text."""
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text
