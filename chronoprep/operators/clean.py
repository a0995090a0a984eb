"""Cleaning: gaps of a time grid, outliers, nulls."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .position import pinned
from .windows import interpolate


def time_grid(df: DataFrame, ts: str, period_minutes: int = 5) -> DataFrame:
    """Every expected time from the first to the last, a row each.  A null time is an error.

    The ends are two numbers; the grid itself is made by ``range`` in parallel.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[ts]
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    r = df.agg(F.min(micros).alias("a"), F.max(micros).alias("b"), F.count_if(F.col(ts).isNull()).alias("nulls")).first()
    if r["nulls"]:
        raise ValueError(f"{ts} holds values that are no times")
    step = period_minutes * 60_000_000
    n = 0 if r["a"] is None else (r["b"] - r["a"]) // step + 1
    return spark.range(n).select(F.timestamp_micros(F.lit(r["a"] or 0) + F.col("id") * step).cast(kind).alias(ts))


def find_gaps(df: DataFrame, ts: str, period_minutes: int = 5) -> DataFrame:
    """Expected times that are missing."""
    return time_grid(df, ts, period_minutes).join(df.select(ts), ts, "left_anti")


def fill_gaps(df: DataFrame, ts: str, period_minutes: int = 5, tiebreak: list[str] | None = None) -> DataFrame:
    """Missing grid times added, and every numeric column interpolated by row position; off-grid rows stay."""
    from .normalize import numeric_columns

    whole = df.unionByName(find_gaps(df, ts, period_minutes), allowMissingColumns=True)
    keys = [ts, *(tiebreak or [])]
    return interpolate(whole, [c for c in numeric_columns(df) if c not in keys], keys)


def outside(column: str, mean: float | None, std: float | None, threshold: float) -> Column:
    """|x - mean| > threshold * std, false where any of it is unknown."""
    test = F.abs(F.col(column) - F.lit(mean)) > F.lit(threshold) * F.lit(std)
    return F.coalesce(test, F.lit(False))


def _moments(df: DataFrame, columns: list[str]) -> list[tuple[float, float]]:
    r = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    return [(r[f"m{i}"], r[f"s{i}"]) for i in range(len(columns))]


def delete_outliers(df: DataFrame, columns: list[str], threshold: float, simultaneous: bool = False) -> DataFrame:
    """Rows without outliers.  By default column after column, each judged on the rows that survived the ones before."""
    if simultaneous:
        bad = F.lit(False)
        for c, (m, s) in zip(columns, _moments(df, columns)):
            bad |= outside(c, m, s, threshold)
        return df.where(~bad)
    df = pinned(df)
    for c in columns:
        ((m, s),) = _moments(df, [c])
        df = df.where(~outside(c, m, s, threshold))
    return df


def null_outliers(df: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    """Outliers become null; one aggregation, since no row goes."""
    return df.withColumns({c: F.when(~outside(c, m, s, threshold), F.col(c)) for c, (m, s) in zip(columns, _moments(df, columns))})


def drop_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=columns)


def iqr_outlier_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, q1, q3, outliers`` by 1.5 interquartile ranges around exact linear quartiles."""
    q = df.agg(*[F.percentile(F.col(c), F.array(F.lit(0.25), F.lit(0.75))).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    fences = [(r[0], r[1]) if r else (None, None) for r in (q[f"q{i}"] for i in range(len(columns)))]
    counts = df.agg(*[
        F.count_if((F.col(c) < F.lit(a) - 1.5 * (F.lit(b) - F.lit(a))) | (F.col(c) > F.lit(b) + 1.5 * (F.lit(b) - F.lit(a)))).alias(f"n{i}")
        if a is not None else F.lit(0).cast("long").alias(f"n{i}")
        for i, (c, (a, b)) in enumerate(zip(columns, fences))
    ])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(a).cast("double").alias("q1"), F.lit(b).cast("double").alias("q3"), F.col(f"n{i}").alias("outliers")) for i, (c, (a, b)) in enumerate(zip(columns, fences))]
    return counts.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


@dataclass
class Cleaner:
    """Configured cleaning: ``missing_values`` or ``outlier``; settings are saved and loaded as JSON."""

    method: str = "missing_values"
    period: int = 5
    outlier_threshold: float | None = None
    solve_missing: bool = False
    delete_outliers: bool = False
    interpolate_outliers: bool = False
    delete_nan: bool = False
    interpolate_nan: bool = False

    def run(self, df: DataFrame, ts: str, columns: list[str] | None = None) -> DataFrame:
        from .normalize import numeric_columns

        columns = columns or numeric_columns(df, (ts,))
        if self.method == "missing_values":
            return fill_gaps(df, ts, self.period) if self.solve_missing else df
        if self.method != "outlier":
            raise ValueError(f"unknown method {self.method}")
        if self.outlier_threshold is not None and self.delete_outliers:
            df = delete_outliers(df, columns, self.outlier_threshold)
        elif self.outlier_threshold is not None and self.interpolate_outliers:
            df = null_outliers(df, columns, self.outlier_threshold)
        if self.delete_nan:
            return drop_nulls(df)
        return interpolate(df, columns, [ts]) if self.interpolate_nan or self.interpolate_outliers else df

    def save(self, path: str) -> None:
        with open(path, "w") as f:
            json.dump(asdict(self), f)

    @classmethod
    def load(cls, path: str) -> Cleaner:
        with open(path) as f:
            return cls(**json.load(f))
