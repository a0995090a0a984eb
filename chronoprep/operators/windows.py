"""Ordered operators on a series: moving and exponential averages, lags, interpolation, gaps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .position import POSITION, over_series, with_position


def moving_average_unbias(df: DataFrame, columns: list[str], order_by: list[str], window: int = 5, partition_by: list[str] | None = None) -> DataFrame:
    """x minus the mean of the last ``window`` rows (fewer at the head, nulls skipped)."""
    return over_series(
        df, order_by, lambda w: {c: F.col(c) - F.avg(c).over(w.rowsBetween(-(window - 1), 0)) for c in columns}, before=window - 1, partition_by=partition_by
    )


def rolling_mean(df: DataFrame, column: str, into: str, order_by: list[str], window: int = 5, partition_by: list[str] | None = None) -> DataFrame:
    return over_series(df, order_by, lambda w: {into: F.avg(column).over(w.rowsBetween(-(window - 1), 0))}, before=window - 1, partition_by=partition_by)


def exponential_average(df: DataFrame, columns: list[str], order_by: list[str], alpha: float = 0.1, partition_by: list[str] | None = None, suffix: str = "_ema") -> DataFrame:
    """Weighted mean with weights (1 - alpha)^age, normalised; nulls weigh nothing but rows keep their age.

    Linear time: sums run inside small stretches, scaled so that no power overflows, and
    the three stretches before add what still counts; older rows weigh less than 1e-17.
    """
    if not 0 < alpha < 1:
        raise ValueError("alpha must lie between 0 and 1")
    decay = 1 - alpha
    stretch = max(1, int(math.log(1e6) / -math.log(decay)))
    reach = math.ceil(math.log(1e-17) / math.log(decay) / stretch)
    group = list(partition_by or [])
    if group:
        placed = df.withColumn(POSITION, F.row_number().over(Window.partitionBy(*group).orderBy(*order_by)) - 1)
        block, own = F.lit(0), None
    else:
        placed = with_position(df, order_by)
        size = stretch * max(reach, 25_000 // stretch)
        block = F.floor(F.col(POSITION) / size).cast("long")
        halo = F.filter(F.array(block, F.when(F.col(POSITION) % size >= size - reach * stretch, block + 1)), lambda b: b.isNotNull())
        placed = placed.withColumn("_own", block)
        block, own = F.explode(halo), "_own = _block"
    rows = placed.withColumn("_block", block).withColumn("_s", F.floor(F.col(POSITION) / stretch).cast("long")).withColumn("_i", F.col(POSITION) % stretch)
    keys = [*group, "_block"]
    inside = Window.partitionBy(*keys, "_s").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_s")
    up = F.pow(F.lit(1 / decay), F.col("_i"))  # at most 1e6
    down = F.pow(F.lit(decay), F.col("_i"))

    def total(x: Column) -> Column:
        local = F.coalesce(F.sum(x * up).over(inside), F.lit(0.0)) * down
        tail = x * F.pow(F.lit(decay), F.lit(stretch - 1) - F.col("_i"))
        carried = [F.coalesce(F.sum(tail).over(earlier.rangeBetween(-k, -k)), F.lit(0.0)) * (decay ** ((k - 1) * stretch)) for k in range(1, reach + 1)]
        return local + sum(carried[1:], carried[0]) * down * decay

    out = rows.withColumns({
        f"{c}{suffix}": F.try_divide(total(F.col(c).cast("double")), F.nullif(total(F.when(F.col(c).isNotNull(), 1.0)), F.lit(0.0))) for c in columns
    })
    return (out.where(own) if own else out).drop("_own", "_block", "_s", "_i", POSITION)


def exponential_unbias(df: DataFrame, columns: list[str], order_by: list[str], alpha: float = 0.1, partition_by: list[str] | None = None) -> DataFrame:
    out = exponential_average(df, columns, order_by, alpha, partition_by)
    return out.withColumns({c: F.col(c) - F.col(f"{c}_ema") for c in columns}).drop(*[f"{c}_ema" for c in columns])


def unbias(df: DataFrame, order_by: list[str], method: str = "ma", window_size: int = 5, alpha: float = 0.1, columns: list[str] | None = None) -> DataFrame:
    """Numeric columns only, by the named method."""
    from .normalize import numeric_columns

    columns = columns or numeric_columns(df, tuple(order_by))
    if method == "ma":
        return moving_average_unbias(df, columns, order_by, int(window_size))
    if method == "ema":
        return exponential_unbias(df, columns, order_by, float(alpha))
    raise ValueError(f"unknown method {method}")


def first_difference(df: DataFrame, column: str, into: str, order_by: list[str], partition_by: list[str] | None = None) -> DataFrame:
    return over_series(df, order_by, lambda w: {into: F.col(column) - F.lag(column).over(w)}, before=1, partition_by=partition_by)


def autocorrelation(df: DataFrame, column: str, order_by: list[str], lags: int = 10) -> DataFrame:
    """``lag, autocorr``: Pearson correlation of the series with itself, k rows later, in one aggregation."""
    x = F.col(column).cast("double")
    lagged = over_series(df.select(*order_by, x.alias("_x")), order_by, lambda w: {f"_l{k}": F.lag("_x", k).over(w) for k in range(1, lags + 1)}, before=lags)
    both = lambda k: F.corr(F.when(F.col(f"_l{k}").isNotNull(), F.col("_x")), F.col(f"_l{k}"))
    wide = lagged.agg(*[both(k).alias(f"a{k}") for k in range(1, lags + 1)])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"a{k}").alias("autocorr")) for k in range(1, lags + 1)])).alias("e")).select("e.*")


def interpolate(df: DataFrame, columns: list[str], order_by: list[str], partition_by: list[str] | None = None) -> DataFrame:
    """Linear by row position; leading nulls stay, trailing ones take the last value.

    In a global series a gap may be of any length, so the nearest known values beyond a
    block come from a small table with the first and last known value of each block.
    """
    from .interpolation import fill_linear

    return fill_linear(df, columns, order_by, partition_by)
