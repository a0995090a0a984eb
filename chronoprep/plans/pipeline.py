"""The preparation pipeline: load, add features, split, normalise, postprocess, export."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import normalize as N
from ..operators import profile
from ..operators import split as S
from ..operators.position import pinned
from ..sources import readers, writers
from .config import Configuration
from .plugins import Plugin, PluginPipeline, from_spec


class Preparation:
    """One lazy frame through all stages; only counts and fitted parameters come to the driver."""

    def __init__(self, spark: SparkSession, config: Configuration | None = None, features: list[Plugin] | None = None, post: list[Plugin] | None = None):
        self.spark, self.config = spark, config or Configuration()
        if wrong := self.config.errors():
            raise ValueError("; ".join(wrong))
        v = self.config.values
        named = lambda given, section: [*(given or []), *map(from_spec, v[section]["plugins"])]
        self.features, self.post = PluginPipeline(named(features, "feature_engineering")), PluginPipeline(named(post, "postprocessing"))
        self.parameters: N.NormalizationParameters | N.WholeTableNormalizer | None = None
        self.data: DataFrame | None = None
        self.result: DataFrame | None = None
        self.history: list[dict] = []

    def load(self, path: str, **options) -> Preparation:
        return self.use(readers.load(self.spark, path, **options))

    def use(self, df: DataFrame) -> Preparation:
        if df is None or df.isEmpty():
            raise ValueError("no data")
        self.data, self.result = df, None
        self.history.append({"stage": "load", "columns": df.columns})
        return self

    def update(self, df: DataFrame) -> Preparation:
        """Another table in place of the loaded one; what was computed from the old one is forgotten."""
        self.parameters = None
        return self.use(df)

    def clear(self) -> None:
        self.data = self.result = self.parameters = None
        self.history.clear()

    def summary(self) -> dict:
        """Rows, columns, types, completeness and duplicates of the loaded table."""
        if self.data is None:
            return {"status": "no_data_loaded"}
        c, d = profile.completeness(self.data).first(), profile.duplicates(self.data).first()
        return {"status": "loaded", "rows": d["rows"], "columns": self.data.columns, "types": dict(self.data.dtypes), "completeness": c["completeness"], "duplicates": d["duplicates"]}

    def use_parameters(self, means_path: str, stds_path: str) -> bool:
        self.parameters = N.NormalizationParameters.load(means_path, stds_path)
        return self.parameters is not None

    def process(self, order_by: list[str] | None = None) -> DataFrame:
        c = self.config.values
        df, report = self.features.process(self.data)
        self.history.append({"stage": "features", "report": report})
        split, ts = c["data_splitting"], c["data_handling"]["timestamp_column"]
        setup = S.SplitConfiguration(
            split["ratios"], split["random_seed"], split.get("stratify_column") if split["method"] == "stratified" else None,
            split["method"] == "temporal", ts, split["method"] == "random",
        )
        if wrong := S.validate(df, setup):
            raise ValueError("; ".join(wrong))
        # without an order given, the other columns break ties, so that the split can be repeated
        order_by = order_by or [ts, *(c for c, t in df.dtypes if c != ts and not t.startswith(("map", "variant")))]
        df = pinned(S.split_six(df, setup, order_by))
        norm = c["normalization"]
        if norm["method"] != "none" and norm["training_datasets"]:
            sources = tuple(norm["training_datasets"])
            if norm["method"] == "zscore":
                if self.parameters is None:
                    self.parameters = N.fit_zscore(S.training(df, sources), tuple(norm["exclude"]), sources)
                df = N.apply_zscore(df, self.parameters)
            else:
                if self.parameters is None:
                    kind = {"minmax": "min-max", "robust": "robust"}[norm["method"]]
                    self.parameters = N.WholeTableNormalizer(kind, tuple(norm["range"])).fit(S.training(df, sources).drop(*norm["exclude"]))
                df = self.parameters.apply(df)
        self.history.append({"stage": "normalize", "method": norm["method"], "features": self.normalized()})
        self.result, report = self.post.process(df)
        self.history.append({"stage": "postprocess", "report": report})
        return self.result

    def normalized(self) -> list[str]:
        p = self.parameters
        return [] if p is None else p.features if isinstance(p, N.NormalizationParameters) else list(p.stats)

    def export(self, folder: str | None = None, fmt: str | None = None, include_metadata: bool = True) -> str | bool:
        """Write the datasets and what they were made with; False before there is a result."""
        if self.result is None:
            return False
        e = self.config.values["export"]
        folder, fmt = folder or e["path"], fmt or e["format"]
        writers.export_splits(self.result, os.path.join(folder, "datasets"), fmt)
        if e["export_normalization_params"] and self.parameters:
            if isinstance(self.parameters, N.NormalizationParameters):
                self.parameters.save(os.path.join(folder, "means.json"), os.path.join(folder, "stds.json"))
            else:
                self.parameters.save(os.path.join(folder, "normalization.json"))
        if include_metadata:
            writers.export_metadata(self.result, folder, self.config.values, self.history)
        return folder

    def status(self) -> dict:
        return {"loaded": self.data is not None, "processed": self.result is not None, "stages": [h["stage"] for h in self.history]}


def default_datasets(df: DataFrame, order_by: list[str]) -> tuple[DataFrame, N.WholeTableNormalizer]:
    """Three contiguous datasets with every numeric column scaled to [0, 1] by whole-table extremes."""
    fitted = N.WholeTableNormalizer("min-max", (0.0, 1.0), 1e-8).fit(df)
    out = S.three_way(df, order_by)
    scale = lambda c: (F.col(f"`{c}`") - F.lit(fitted.stats[c]["min"])) / (F.lit(fitted.stats[c]["max"]) - F.lit(fitted.stats[c]["min"]) + 1e-8)
    return N.project(out, {c: scale(c) for c in fitted.stats}), fitted


def export_default(df: DataFrame, order_by: list[str], folder: str, base_columns: tuple[str, ...] = ("DATE_TIME", "OPEN", "LOW", "HIGH", "CLOSE")) -> DataFrame:
    """Base and normalised datasets d1, d2, d3 as CSV, the parameters as ``debug_out.json``.

    Returns ``Filename, Rows, Columns`` for the six datasets.
    """
    from ..operators.trim import ordered_columns

    base = S.three_way(ordered_columns(df, base_columns), order_by)
    scaled, fitted = default_datasets(df, order_by)
    os.makedirs(folder, exist_ok=True)
    summary = None
    for name, part in (("base", base), ("normalized", scaled)):
        part = pinned(part)
        part.write.mode("overwrite").partitionBy("split").option("header", True).csv(os.path.join(folder, name))
        rows = part.groupBy("split").agg(F.count("*").alias("Rows"))
        rows = rows.select(F.concat(F.lit(f"{name}_"), "split").alias("Filename"), "Rows", F.lit(len(part.columns) - 1).alias("Columns"))
        summary = rows if summary is None else summary.unionByName(rows)
    fitted.save(os.path.join(folder, "debug_out.json"))
    return summary
