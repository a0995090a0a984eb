"""Profiles and validation of a table."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import iqr_outlier_counts
from .normalize import numeric_columns
from .trim import text_columns


def completeness(df: DataFrame) -> DataFrame:
    """One row: ``cells, known, completeness`` (percent; 0 for no cells)."""
    known = df.agg(F.count("*").alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"k{i}") for i, c in enumerate(df.columns)])
    cells, full = F.col("n") * len(df.columns), sum((F.col(f"k{i}") for i in range(len(df.columns))), F.lit(0))
    return known.select(cells.alias("cells"), full.alias("known"), F.coalesce(F.try_divide(full * 100.0, cells), F.lit(0.0)).alias("completeness"))


def nulls(df: DataFrame) -> DataFrame:
    """``feature, nulls`` for each column."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(df.columns)])).alias("e")).select("e.*")


def duplicates(df: DataFrame) -> DataFrame:
    """``rows, duplicates, percent``: rows beyond the first of each kind, nulls being equal."""
    counts = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    out = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
    return out.withColumn("percent", F.coalesce(F.try_divide(F.col("duplicates") * 100.0, F.col("rows")), F.lit(0.0)))


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``feature, count, mean, std, min, p25, p50, p75, max`` with exact linear quantiles, all in one aggregation."""
    columns = columns or numeric_columns(df)
    x = lambda c: F.col(f"`{c}`").cast("double")
    wide = df.agg(*[
        F.struct(
            F.lit(c).alias("feature"), F.count(x(c)).alias("count"), F.avg(x(c)).alias("mean"), F.stddev_samp(x(c)).alias("std"), F.min(x(c)).alias("min"),
            F.percentile(x(c), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("p"), F.max(x(c)).alias("max"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ])
    quarters = [F.get("e.p", i).alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
    wide = wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(columns))])).alias("e"))
    return wide.select("e.feature", "e.count", "e.mean", "e.std", "e.min", *quarters, "e.max")


def text_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``feature, distinct, mode, mean_length``: the smallest of the most frequent values; a null counts 4 characters."""
    columns = columns or text_columns(df)
    parts = []
    for c in columns:
        x = F.col(f"`{c}`")
        stats = df.agg(F.countDistinct(x).alias("distinct"), F.avg(F.coalesce(F.length(x), F.lit(4))).alias("mean_length"))
        most = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count("*").alias("n")).agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"))
        parts.append(stats.crossJoin(F.broadcast(most)).select(F.lit(c).alias("feature"), "distinct", "mode", "mean_length"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def types(df: DataFrame) -> dict[str, int]:
    return dict(Counter(t for _, t in df.dtypes))


def checksum(df: DataFrame) -> DataFrame:
    """``rows, checksum``: row hashes, to which nulls and their places count, added up modulo 2^64.

    Order does not matter, so partitions add up on their own; repeated rows do count.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    row = F.xxhash64(*columns, *[c.isNull() for c in columns]).cast("decimal(20, 0)")
    total = F.coalesce(F.sum(row), F.lit(0)).cast("decimal(38, 0)")
    return df.agg(F.count("*").alias("rows"), F.pmod(total, F.lit(str(2**64)).cast("decimal(38, 0)")).cast("decimal(20, 0)").alias("checksum"))


@dataclass
class ValidationRules:
    min_rows: int = 10
    min_columns: int = 1
    max_missing_percent: float = 50.0
    max_duplicate_percent: float = 25.0
    required_numeric_columns: int = 1
    max_file_megabytes: float = 1000.0
    allowed_types: tuple[str, ...] = ("int", "bigint", "double", "float", "string", "timestamp", "timestamp_ntz", "date", "boolean")
    unknown: list[str] = field(default_factory=list)

    def set(self, **rules) -> ValidationRules:
        """Known rules are replaced; unknown ones are remembered as warnings."""
        for k, v in rules.items():
            if k in self.__dataclass_fields__ and k != "unknown":
                setattr(self, k, v)
            else:
                self.unknown.append(k)
        return self


def validation_report(df: DataFrame, rules: ValidationRules | None = None, file_megabytes: float | None = None) -> DataFrame:
    """``rule, ok`` for each rule; the size of the file is judged where it is given."""
    rules = rules or ValidationRules()
    c, d = completeness(df).first(), duplicates(df).first()
    rows = [
        ("min_rows", d["rows"] >= rules.min_rows),
        ("min_columns", len(df.columns) >= rules.min_columns),
        ("missing", 100 - c["completeness"] <= rules.max_missing_percent),
        ("types", all(t in rules.allowed_types or t.startswith("decimal") for _, t in df.dtypes)),
        ("numeric", len(numeric_columns(df)) >= rules.required_numeric_columns),
        ("duplicates", d["percent"] <= rules.max_duplicate_percent),
    ]
    if file_megabytes is not None:
        rows.append(("file_size", file_megabytes <= rules.max_file_megabytes))
    return df.sparkSession.createDataFrame(rows, "rule string, ok boolean")


__all__ = ["ValidationRules", "checksum", "completeness", "describe", "duplicates", "iqr_outlier_counts", "nulls", "text_profile", "types", "validation_report"]
