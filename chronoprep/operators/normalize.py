"""Normalisation: parameters from one aggregation, applied as literals in a projection."""

from __future__ import annotations

import hashlib
import json
import math
import os
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOLERANCE = 1e-8


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


@dataclass
class NormalizationParameters:
    means: dict[str, float]
    stds: dict[str, float]
    source_datasets: list[str] = field(default_factory=list)
    sample_count: int = 0
    computation_timestamp: str = field(default_factory=lambda: datetime.now(timezone.utc).isoformat())

    def __post_init__(self):
        if set(self.means) != set(self.stds):
            raise ValueError("means and stds must name the same features")
        if any(not math.isfinite(x) for x in (*self.means.values(), *self.stds.values())) or any(s <= 0 for s in self.stds.values()):
            raise ValueError("means must be finite, stds finite and above zero")

    @property
    def features(self) -> list[str]:
        return list(self.means)

    @property
    def checksum(self) -> str:
        body = {"features": sorted(self.means), "means": self.means, "stds": self.stds}
        return hashlib.md5(json.dumps(body, sort_keys=True).encode()).hexdigest()

    def save(self, means_path: str, stds_path: str) -> None:
        """Two JSON files, written aside, read back and renamed; earlier files stay as ``.backup.json``."""
        head = {
            "computation_timestamp": self.computation_timestamp, "source_datasets": self.source_datasets,
            "feature_count": len(self.means), "sample_count": self.sample_count, "checksum": self.checksum,
        }
        for path, key, values in ((means_path, "means", self.means), (stds_path, "stds", self.stds)):
            os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
            with open(f"{path}.tmp", "w") as f:
                json.dump({"metadata": head, key: values}, f, indent=2)
            with open(f"{path}.tmp") as f:
                if json.load(f)[key] != values:
                    raise OSError(f"{path} could not be verified")
            if os.path.exists(path):
                os.replace(path, path.removesuffix(".json") + ".backup.json")
            os.replace(f"{path}.tmp", path)

    @classmethod
    def load(cls, means_path: str, stds_path: str) -> NormalizationParameters | None:
        """The saved parameters, or None if a file is missing, broken or of another computation."""
        try:
            with open(means_path) as f, open(stds_path) as g:
                a, b = json.load(f), json.load(g)
            head, other = a["metadata"], b["metadata"]
            out = cls(a["means"], b["stds"], head["source_datasets"], head["sample_count"], head["computation_timestamp"])
            same = all(head[k] == other[k] for k in ("checksum", "computation_timestamp"))
            return out if same and out.checksum == head["checksum"] else None
        except (OSError, ValueError, KeyError, TypeError):
            return None


def fit_zscore(training: DataFrame, exclude: tuple[str, ...] = (), sources: tuple[str, ...] = ("d1", "d2")) -> NormalizationParameters:
    """Mean and sample deviation of each numeric feature in one pass; a constant feature gets deviation 1."""
    names = numeric_columns(training, exclude)
    if not names:
        raise ValueError("no numeric feature to normalise")
    r = training.agg(
        F.count("*").alias("rows"),
        *[f(F.col(f"`{c}`").cast("double")).alias(f"{k}_{i}") for i, c in enumerate(names) for k, f in (("n", F.count), ("avg", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))],
    ).first()
    kept = [(i, c) for i, c in enumerate(names) if r[f"n_{i}"] >= 2]
    if not kept:
        raise ValueError("every feature is excluded or empty")
    constant = lambda i: r[f"min_{i}"] == r[f"max_{i}"]
    means = {c: float(r[f"min_{i}"] if constant(i) else r[f"avg_{i}"]) for i, c in kept}
    return NormalizationParameters(means, {c: 1.0 if constant(i) else float(r[f"std_{i}"]) for i, c in kept}, list(sources), r["rows"])


def project(df: DataFrame, formulas: dict[str, Column]) -> DataFrame:
    return df.select(*[formulas[c].alias(c) if c in formulas else F.col(f"`{c}`") for c in df.columns])


def apply_zscore(df: DataFrame, p: NormalizationParameters) -> DataFrame:
    """(x - mean) / std for each known numeric feature; a streaming frame works as well."""
    known = [c for c in numeric_columns(df) if c in p.means]
    return project(df, {c: (F.col(f"`{c}`") - F.lit(p.means[c])) / F.lit(p.stds[c]) for c in known})


def invert_zscore(df: DataFrame, p: NormalizationParameters) -> DataFrame:
    known = [c for c in numeric_columns(df) if c in p.means]
    return project(df, {c: F.col(f"`{c}`") * F.lit(p.stds[c]) + F.lit(p.means[c]) for c in known})


def quality(df: DataFrame, features: list[str], by: str = "split", tolerance: float = 0.1) -> DataFrame:
    """Per dataset and feature whether mean is near 0 and deviation near 1: ``split, feature, mean, std, ok``."""
    long = df.select(by, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for c in features])).alias("e"))
    out = long.groupBy(by, F.col("e.feature").alias("feature")).agg(F.avg("e.x").alias("mean"), F.stddev_samp("e.x").alias("std"))
    return out.withColumn("ok", (F.abs("mean") <= tolerance) & (F.abs(F.col("std") - 1) <= tolerance))


@dataclass
class WholeTableNormalizer:
    """Statistics over all rows; only numeric columns come out.  Methods: z-score, min-max, robust, none."""

    method: str = "z-score"
    range: tuple[float, float] = (-1.0, 1.0)
    epsilon: float = 0.0
    stats: dict[str, dict[str, float]] | None = None

    def fit(self, df: DataFrame) -> WholeTableNormalizer:
        names = numeric_columns(df)
        kinds = {
            "z-score": {"mean": F.avg, "std": F.stddev_samp},
            "min-max": {"min": F.min, "max": F.max},
            "robust": {"median": lambda c: F.percentile(c, 0.5), "q1": lambda c: F.percentile(c, 0.25), "q3": lambda c: F.percentile(c, 0.75)},
            "none": {},
        }
        if self.method not in kinds:
            raise ValueError(f"unknown method {self.method}")
        parts = [f(F.col(f"`{c}`").cast("double")).alias(f"{k}_{i}") for i, c in enumerate(names) for k, f in kinds[self.method].items()]
        r = df.agg(*parts).first() if parts else {}
        self.stats = {c: {k: r[f"{k}_{i}"] for k in kinds[self.method]} for i, c in enumerate(names)}
        return self

    def formula(self, c: str) -> Column:
        """The normalised column; null where the column is constant."""
        x, s, (low, high) = F.col(f"`{c}`"), self.stats[c], self.range
        if self.method == "z-score":
            return F.try_divide(x - F.lit(s["mean"]), F.lit(s["std"]))
        if self.method == "min-max":
            return F.try_divide(x - F.lit(s["min"]), F.lit(s["max"]) - F.lit(s["min"]) + F.lit(self.epsilon)) * (high - low) + low
        if self.method == "robust":
            return F.try_divide(x - F.lit(s["median"]), F.lit(s["q3"]) - F.lit(s["q1"]))
        return x

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self.formula(c).alias(c) for c in self.stats if c in df.columns])

    def apply(self, df: DataFrame) -> DataFrame:
        """All columns, the known ones normalised."""
        return project(df, {c: self.formula(c) for c in self.stats})

    def debug_info(self, pips: float = 1.0) -> dict[str, float]:
        """What some pips are worth in each column's normalised units; constant columns are left out."""
        spread = lambda s: s["max"] - s["min"] if self.method == "min-max" else s["std"]
        return {c: mae_per_pip(s, self.method, pips, self.range) for c, s in self.stats.items() if spread(s)}

    def save(self, path: str) -> None:
        keys = {k for s in self.stats.values() for k in s}
        with open(path, "w") as f:
            json.dump({"method": self.method, "range": list(self.range), **{k: {c: s[k] for c, s in self.stats.items()} for k in keys}}, f)

    @classmethod
    def load(cls, path: str) -> WholeTableNormalizer:
        """A file's method wins over anything said elsewhere."""
        with open(path) as f:
            d = json.load(f)
        keys = set(d) - {"method", "range"}
        names = list(d[next(iter(keys))]) if keys else []
        return cls(d["method"], tuple(d.get("range", (-1.0, 1.0))), stats={c: {k: d[k][c] for k in keys} for c in names})


def mae_per_pip(stats: dict[str, float], method: str, pips: float = 1.0, range_: tuple[float, float] = (-1.0, 1.0)) -> float:
    """The error in normalised units that some pips of 0.0001 make."""
    if method == "min-max":
        return pips * 1e-4 * (range_[1] - range_[0]) / (stats["max"] - stats["min"])
    return pips * 1e-4 / stats["std"]
