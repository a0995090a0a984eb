"""Linear interpolation by row position over series of any length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .position import POSITION, with_position

BLOCK = 100_000


def lerp(x: Column, before: Column, after: Column) -> Column:
    """Between the known ``(position, value)`` before and after; the last known value behind the end."""
    at = F.col(POSITION)
    share = (at - before["p"]) / F.nullif(after["p"] - before["p"], F.lit(0))
    between = before["x"] + (after["x"] - before["x"]) * share
    return F.coalesce(x, F.when(before.isNull(), None).when(after.isNull(), before["x"]).otherwise(between))


def fill_linear(df: DataFrame, columns: list[str], order_by: list[str], partition_by: list[str] | None) -> DataFrame:
    known = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(POSITION).alias("p"), F.col(c).cast("double").alias("x")))
    if partition_by:
        w = Window.partitionBy(*partition_by).orderBy(*order_by)
        placed = df.withColumn(POSITION, F.row_number().over(w))
        keys = partition_by
        placed = placed.withColumns({f"_k_{c}": known(c) for c in columns})
        edge = {c: (F.lit(None), F.lit(None)) for c in columns}
    else:
        placed = with_position(df, order_by).withColumn("_block", F.floor(F.col(POSITION) / BLOCK).cast("long")).withColumns({f"_k_{c}": known(c) for c in columns})
        # one row a block, so this window is over (rows / BLOCK) rows
        ends = placed.groupBy("_block").agg(*[f(f"_k_{c}").alias(f"{n}_{c}") for c in columns for n, f in (("_low", F.min), ("_high", F.max))])
        series, after = Window.partitionBy(F.lit(0)).orderBy("_block"), Window.partitionBy(F.lit(0)).orderBy(F.desc("_block"))
        ends = ends.select(
            "_block",
            *[F.last(f"_high_{c}", True).over(series.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_b_{c}") for c in columns],
            *[F.last(f"_low_{c}", True).over(after.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_a_{c}") for c in columns],
        )
        placed = placed.join(ends, "_block")
        keys = ["_block"]
        edge = {c: (F.col(f"_b_{c}"), F.col(f"_a_{c}")) for c in columns}
    w = Window.partitionBy(*keys).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*keys).orderBy(F.desc(POSITION)).rowsBetween(Window.unboundedPreceding, 0)  # a frame that only grows costs one pass
    near = {}
    for c in columns:
        near[f"_p_{c}"] = F.coalesce(F.last(f"_k_{c}", True).over(w), edge[c][0])
        near[f"_n_{c}"] = F.coalesce(F.last(f"_k_{c}", True).over(back), edge[c][1])
    out = placed.withColumns(near).withColumns({c: lerp(F.col(c).cast("double"), F.col(f"_p_{c}"), F.col(f"_n_{c}")) for c in columns})
    return out.select(*df.columns)
