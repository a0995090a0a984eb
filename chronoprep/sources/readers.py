"""Reading tables: format and separator detection, CSV, Parquet, JSON, legacy day-first CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import day_first, nan_to_null, number

#: File endings of each format, and separators in the order that ties are decided.
SUFFIXES = {"csv": "csv", "tsv": "csv", "txt": "csv", "parquet": "parquet", "pq": "parquet", "json": "json", "jsonl": "json"}
SEPARATORS = (",", ";", "\t", "|")


def head(spark: SparkSession, path: str, n: int) -> list[str]:
    return [r.value for r in spark.read.text(path).limit(n).collect()]


def sniff_format(spark: SparkSession, path: str) -> str | None:
    line = (head(spark, path, 1) or [""])[0].strip()
    if line[:1] in ("{", "["):
        return "json"
    return "csv" if any(s in line for s in (",", "\t", ";")) else None


def detect_format(spark: SparkSession, path: str, supported: tuple[str, ...] = ("csv", "parquet", "json")) -> str:
    suffix = path.rstrip("/").rpartition(".")[2].lower()
    kind = SUFFIXES.get(suffix)
    if kind not in supported and suffix in ("dat", "txt"):
        kind = sniff_format(spark, path)
    if kind not in supported:
        raise ValueError(f"unsupported file format: {suffix}")
    return kind


def detect_separator(spark: SparkSession, path: str) -> str:
    lines = head(spark, path, 10)
    counts = {s: sum(x.count(s) for x in lines) for s in SEPARATORS}
    best = max(SEPARATORS, key=lambda s: counts[s])
    return best if counts[best] else ","


def read_csv(spark: SparkSession, path: str, sep: str | None = None, header: bool = True, encoding: str = "UTF-8", schema=None) -> DataFrame:
    reader = spark.read.option("sep", sep or detect_separator(spark, path)).option("header", header).option("encoding", encoding)
    return nan_to_null(reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path))


def read_json(spark: SparkSession, path: str, lines: bool | None = None, encoding: str = "UTF-8", schema=None) -> DataFrame:
    """An array of records, or a record per line (the default for ``.jsonl``)."""
    lines = path.rstrip("/").lower().endswith(".jsonl") if lines is None else lines
    reader = spark.read.option("multiLine", not lines).option("encoding", encoding)
    return nan_to_null((reader.schema(schema) if schema else reader).json(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def load(spark: SparkSession, path: str, **options) -> DataFrame:
    """Read by detected format."""
    kind = detect_format(spark, path)
    return {"csv": read_csv, "json": read_json, "parquet": lambda s, p: read_parquet(s, p)}[kind](spark, path, **options)


def load_legacy_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """First column a day-first date named DATE_TIME, all others numbers; what cannot be read is null."""
    raw = spark.read.option("header", header).csv(path)
    first, *rest = raw.columns
    return raw.select(day_first(F.col(f"`{first}`")).alias("DATE_TIME"), *[number(F.col(f"`{c}`")).alias(c) for c in rest])


def load_headerless(spark: SparkSession, path: str, last: int = 4500, sep: str = ",") -> DataFrame:
    """Skips the first line and drops the first column; the last rows by that column, which must be ordered text or time."""
    raw = spark.read.option("header", True).option("enforceSchema", False).option("sep", sep).csv(path)
    named = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))])
    tail = named.orderBy(F.desc("c0")).limit(last)
    return tail.select(*[number(F.col(c)).alias(c) for c in named.columns[1:]])
