"""Writing tables, split datasets and their metadata."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("csv", "parquet", "json")


def export(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ",", single_file: bool = False) -> bool:
    """Write a table; an unknown format gives False.  ``single_file`` is for small results."""
    if fmt not in FORMATS:
        return False
    out = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    if fmt == "csv":
        out.option("header", True).option("sep", sep).csv(path)
    elif fmt == "json":
        out.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS").json(path)
    else:
        out.parquet(path)
    return True


def export_splits(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """One folder a dataset, written in one job and pruned when read."""
    if fmt not in FORMATS:
        return False
    out = df.write.mode("overwrite").partitionBy("split")
    (out.option("header", True).csv if fmt == "csv" else getattr(out, fmt))(path)
    return True


def split_metadata(df: DataFrame, config: dict | None = None, history: list | None = None) -> dict:
    counts = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}
    columns = [c for c in df.columns if c != "split"]
    return {
        "configuration": config or {}, "history": history or [],
        "datasets": {k: {"rows": n, "columns": columns, "dtypes": {c: t for c, t in df.dtypes if c != "split"}} for k, n in sorted(counts.items())},
    }


def export_metadata(df: DataFrame, folder: str, config: dict | None = None, history: list | None = None) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "split_metadata.json")
    with open(path, "w") as f:
        json.dump(split_metadata(df, config, history), f, indent=2, default=str)
    return path


def write_csv(df: DataFrame, path: str, include_date: bool = True, headers: bool = True, date: str = "date") -> None:
    (df if include_date else df.drop(date)).write.mode("overwrite").option("header", headers).csv(path)
