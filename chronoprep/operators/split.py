"""Splitting a table into named datasets: one frame with a ``split`` column."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .position import POSITION, with_position

KEYS = ("d1", "d2", "d3", "d4", "d5", "d6")
#: Minimum rows of each dataset.
LEAST = 10


@dataclass
class SplitConfiguration:
    """Ratios of the six datasets and how rows are ordered before they are cut."""

    ratios: dict[str, float] = field(default_factory=lambda: dict(zip(KEYS, (0.5, 0.1, 0.1, 0.1, 0.1, 0.1))))
    random_seed: int | None = None
    stratify_column: str | None = None
    temporal_split: bool = False
    temporal_column: str | None = None
    shuffle: bool = True

    def __post_init__(self):
        if set(self.ratios) != set(KEYS):
            raise ValueError(f"split ratios must name exactly {', '.join(KEYS)}")
        if abs(sum(self.ratios.values()) - 1) > 0.001:
            raise ValueError(f"the sum of the split ratios must be 1.0, not {sum(self.ratios.values())}")
        if any(not 0 < r < 1 for r in self.ratios.values()):
            raise ValueError("each split ratio must lie between 0 and 1")


def split_sizes(n: int, ratios: dict[str, float]) -> dict[str, int]:
    """Truncated shares; the remaining rows go one each to the largest ratios, in key order on ties."""
    sizes = {k: int(n * r) for k, r in ratios.items()}
    by_ratio = sorted(ratios, key=lambda k: -ratios[k])
    for i in range(n - sum(sizes.values())):
        sizes[by_ratio[i % len(by_ratio)]] += 1
    return sizes


def validate(df: DataFrame, config: SplitConfiguration) -> list[str]:
    """What keeps ``df`` from being split as configured; empty if nothing does.  One aggregation."""
    parts = [F.count("*").alias("n")]
    out = []
    for role, c in (("temporal", config.temporal_split and config.temporal_column), ("stratify", config.stratify_column)):
        if c and c not in df.columns:
            out.append(f"{role} column {c} is missing")
    if config.temporal_split and config.temporal_column in df.columns:
        parts.append(F.count_if(F.col(config.temporal_column).isNull()).alias("nulls"))
    if config.stratify_column in df.columns:
        parts.append(F.countDistinct(config.stratify_column).alias("strata"))
    r = df.agg(*parts).first()
    out += [f"dataset {k} would have fewer than {LEAST} rows" for k, ratio in config.ratios.items() if int(r["n"] * ratio) < LEAST]
    if "nulls" in r and r["nulls"]:
        out.append(f"temporal column {config.temporal_column} holds nulls")
    if "strata" in r and r["strata"] > 0.1 * r["n"]:
        out.append(f"stratify column {config.stratify_column} has too many values")
    return out


def cut(df: DataFrame, order_by: list[str], sizes: dict[str, int], into: str = "split") -> DataFrame:
    """Label contiguous ranges of positions; rows keep their columns."""
    placed = with_position(df, order_by)
    label, end = F.when(F.lit(False), ""), 0
    for k, n in sizes.items():
        end += n
        label = label.when(F.col(POSITION) < end, k)
    return placed.withColumn(into, label).drop(POSITION)


def split_six(df: DataFrame, config: SplitConfiguration, order_by: list[str]) -> DataFrame:
    """``df`` with its ``split``: by time, shuffled by a seeded hash, or in the given order.

    ``order_by`` must be unique; it breaks ties of the temporal column.  Stratified
    splitting cuts each stratum by itself, in hash order.
    """
    n = df.count()
    seed = F.lit(config.random_seed if config.random_seed is not None else 0)
    if config.stratify_column:
        dice = F.xxhash64(seed, *order_by)
        strata = df.groupBy(config.stratify_column).agg(F.count("*").alias("_n"))
        ranked = with_position(df.withColumn("_dice", dice), [config.stratify_column, "_dice", *order_by])
        first = ranked.groupBy(config.stratify_column).agg(F.min(POSITION).alias("_first"))
        joined = ranked.join(strata, config.stratify_column).join(first, config.stratify_column)
        at = (F.col(POSITION) - F.col("_first") + 0.5) / F.col("_n")
        label, end = F.when(F.lit(False), ""), 0.0
        for k, r in config.ratios.items():
            end += r
            label = label.when(at < end, k)
        return joined.withColumn("split", F.coalesce(label, F.lit(KEYS[-1]))).select(*df.columns, "split")
    if config.temporal_split:
        keys = [config.temporal_column, *[c for c in order_by if c != config.temporal_column]]
        return cut(df, keys, split_sizes(n, config.ratios))
    if config.shuffle:
        out = cut(df.withColumn("_dice", F.xxhash64(seed, *order_by)), ["_dice", *order_by], split_sizes(n, config.ratios))
        return out.drop("_dice")
    return cut(df, order_by, split_sizes(n, config.ratios))


def three_way(df: DataFrame, order_by: list[str], d1: float = 0.2, d2: float = 0.6) -> DataFrame:
    """First and second share truncated, the third takes the rest."""
    n = df.count()
    a, b = int(n * d1), int(n * d2)
    return cut(df, order_by, {"d1": a, "d2": b, "d3": n - a - b})


def metadata(df: DataFrame, ratios: dict[str, float], boundary: str | None = None) -> DataFrame:
    """Per dataset: rows, actual and expected ratio, and the first and last value of ``boundary``."""
    more = [F.min(boundary).alias("first"), F.max(boundary).alias("last")] if boundary else []
    counts = df.groupBy("split").agg(F.count("*").alias("sample_count"), *more)
    expected = F.when(F.lit(False), 0.0)
    for k, r in ratios.items():
        expected = expected.when(F.col("split") == k, F.lit(r))
    total = counts.agg(F.sum("sample_count")).first()[0] or 1
    return counts.withColumn("actual_ratio", F.col("sample_count") / F.lit(total)).withColumn("expected_ratio", expected)


def inclusive_boundaries(n: int, ratios: dict[str, float]) -> list[tuple[str, int, int, int]]:
    """Boundaries by the older arithmetic, whose inclusive ends drift by one row a dataset: ``(key, start, end, count)``."""
    out, at = [], 0
    for k, r in ratios.items():
        end = min(at + int(n * r), n - 1)
        out.append((k, at, end, end - at + 1))
        at = end + 1
    return out


def training(df: DataFrame, keys: tuple[str, ...] = ("d1", "d2")) -> DataFrame:
    return df.where(F.col("split").isin(*keys))


def integrity(before: DataFrame, after: DataFrame) -> dict:
    """Whether rows, columns and types were preserved by a split."""
    same_columns = set(before.columns) == set(after.columns) - {"split"}
    same_types = all(dict(after.dtypes).get(c) == t for c, t in before.dtypes)
    same_rows = before.count() == after.count()
    status = "verified" if same_columns and same_types and same_rows else "issues_found"
    return {"status": status, "rows": same_rows, "columns": same_columns, "types": same_types}


def datasets(df: DataFrame) -> dict[str, DataFrame]:
    """The dictionary view of a split frame."""
    return {k: df.where(F.col("split") == k).drop("split") for k in KEYS}


def schema_drift(parts: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """``split, difference, feature`` of each dataset against the first: columns that are missing, extra or of another type."""
    if not parts:
        return []
    first = dict(next(iter(parts.values())).dtypes)
    out = []
    for k, df in parts.items():
        own = dict(df.dtypes)
        out += [(k, "missing", c) for c in first if c not in own]
        out += [(k, "extra", c) for c in own if c not in first]
        out += [(k, "type", c) for c in own if c in first and own[c] != first[c]]
    return out


def union_training(parts: list[DataFrame]) -> DataFrame:
    """Vertical concatenation of separate datasets, columns united."""
    if not parts:
        raise ValueError("no training data")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
