"""Trimming and selection by position."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .position import POSITION, with_position


def trim_columns(df: DataFrame, positions: list[int]) -> DataFrame:
    return df.drop(*[df.columns[i] for i in positions]) if positions else df


def trim_rows(df: DataFrame, rows: list[int], order_by: list[str]) -> DataFrame:
    """Without the rows at the given zero-based positions; a position that no row has is an error."""
    if not rows:
        return df
    if min(rows) < 0 or max(rows) >= df.count():
        raise ValueError("no such row")
    return with_position(df, order_by).where(~F.col(POSITION).isin(rows)).drop(POSITION)


def trim(df: DataFrame, columns: list[int], rows: list[int], order_by: list[str], save_params: str | None = None, load_params: str | None = None) -> DataFrame:
    """Rows, then columns; settings that are loaded override those given and are not saved again."""
    if load_params:
        with open(load_params) as f:
            d = json.load(f)
        columns, rows = d["columns"], d["rows"]
    elif save_params:
        with open(save_params, "w") as f:
            json.dump({"columns": columns, "rows": rows}, f)
    return trim_columns(trim_rows(df, rows, order_by), columns)


def select_single(df: DataFrame, single: int = 4) -> DataFrame:
    return df.select(df.columns[int(single)])


def select_multi(df: DataFrame, multi: list[int]) -> DataFrame:
    """Columns by position, in the given order; one may come twice."""
    return df.select(*[df.columns[i] for i in multi])


def select_saved(df: DataFrame, path: str) -> DataFrame:
    with open(path) as f:
        return df.select(*json.load(f).get("selected_features", df.columns))


def ordered_columns(df: DataFrame, columns: tuple[str, ...] = ("DATE_TIME", "OPEN", "LOW", "HIGH", "CLOSE")) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def last_rows(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    """The n rows that come last, by a distributed top-n."""
    return df.orderBy(*[F.desc(c) for c in order_by]).limit(n)
