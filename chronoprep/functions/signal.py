"""Statistics of a return series as a signal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.position import over_series

#: Seconds between samples of each named period.
PERIOD_SECONDS = {"1min": 60, "5min": 300, "15min": 900, "1h": 3600, "4h": 14400, "daily": 86400}


def returns(df: DataFrame, column: str, order_by: list[str]) -> DataFrame:
    """``order columns, r``: differences of consecutive values, scaled to [0, 1]; the first row has none."""
    diff = over_series(df.select(*order_by, F.col(column).cast("double").alias("x")), order_by, lambda w: {"d": F.col("x") - F.lag("x").over(w)}, before=1)
    r = diff.agg(F.min("d").alias("a"), F.max("d").alias("b")).first()
    return diff.where("d is not null").select(*order_by, F.try_divide(F.col("d") - F.lit(r["a"]), F.lit(r["b"]) - F.lit(r["a"])).cast("double").alias("r"))


def signal_stats(df: DataFrame, column: str, order_by: list[str], period: str = "1h") -> DataFrame:
    """One row: mean, std, mean |r|, signal-to-noise ratio, noise, capacity and information; null where undefined."""
    s = returns(df, column, order_by).agg(F.count("r").alias("n"), F.avg("r").alias("mean"), F.stddev_samp("r").alias("std"), F.avg(F.abs("r")).alias("mean_abs"))
    hz = F.lit(1.0 / PERIOD_SECONDS[period])
    s = s.withColumn("snr", F.pow(F.try_divide("mean", "std"), F.lit(2.0))).withColumn("noise_power", F.try_divide(F.lit(1.0), F.col("snr")))
    s = s.withColumn("noise_std", F.sqrt("noise_power")).withColumn("noise_mean", F.col("noise_std") * F.sqrt(F.lit(2.0) / F.pi()))
    s = s.withColumn("capacity", hz * F.log2(1 + F.col("snr")))
    return s.withColumn("information", F.col("capacity") * F.col("n") * PERIOD_SECONDS[period])


def spectrum(df: DataFrame, column: str, order_by: list[str], last: int = 4500) -> DataFrame:
    """``k, freq, decibel`` of the discrete Fourier transform of the last rows (a bounded number, a parameter)."""
    import numpy as np
    import pandas as pd

    tail = df.select(*order_by, F.col(column).cast("double").alias("x")).orderBy(*[F.desc(c) for c in order_by]).limit(last)

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order_by)["x"].to_numpy()
        y = np.fft.fft(x)
        return pd.DataFrame({"k": np.arange(len(x)), "freq": np.fft.fftfreq(len(x)), "decibel": 10 * np.log10(np.abs(y) + 1e-10)})

    return tail.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(transform, "k long, freq double, decibel double")


def peaks(spec: DataFrame, first: int = 5) -> DataFrame:
    """The first local maxima of the first half, in the order of frequency; a plateau counts at its middle."""
    from pyspark.sql import Window

    half = spec.where(F.col("k") < F.floor(F.lit(spec.count()) / 2))
    w = Window.partitionBy(F.lit(0)).orderBy("k")  # a bounded number of rows
    new = F.coalesce((F.col("decibel") != F.lag("decibel").over(w)).cast("int"), F.lit(1))
    run = half.withColumn("run", F.sum(new).over(w)).groupBy("run").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.first("decibel").alias("decibel"))
    v = Window.partitionBy(F.lit(0)).orderBy("run")
    top = run.where("true").withColumns({"p": F.lag("decibel").over(v), "n": F.lead("decibel").over(v)}).where("decibel > p and decibel > n")
    mid = top.select(F.floor((F.col("a") + F.col("b")) / 2).alias("k"))
    return half.join(F.broadcast(mid), "k").orderBy("k").limit(first)
