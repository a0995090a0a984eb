"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import re
import time

from pyspark.sql import SparkSession

from chronoprep.plans import registry

HEADLINE = [
    "zscore_apply", "temporal_split_six", "ema_unbias", "ma_unbias", "interpolate_linear", "gap_fill_interpolate", "minmax_range",
    "outlier_delete_seq", "profile_describe", "profile_duplicates", "autocorr_lags", "snr_stats", "mi_select", "full_preparation",
]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warm-up
    took = {}
    for name in HEADLINE:
        began = time.time()
        registry.queries()[name](spark, d).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
        spark.catalog.clearCache()
    sf = re.search(r"sf([\d.]+)", d)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(sf[1]) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
