"""Normalising a stream with saved parameters: stateless, so the batch projection serves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.normalize import NormalizationParameters, apply_zscore


def normalized_stream(spark: SparkSession, folder: str, schema, parameters: NormalizationParameters, fmt: str = "parquet") -> DataFrame:
    return apply_zscore(spark.readStream.format(fmt).schema(schema).load(folder), parameters)
