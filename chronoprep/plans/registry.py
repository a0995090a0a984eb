"""Registered queries over the operators, each on whole tables, and the SQL that must agree."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signal
from ..operators import clean, normalize, profile, select, split, trim, windows
from .config import Configuration
from .pipeline import Preparation, default_datasets
from .plugins import FeaturePlugin, PluginPipeline, PostprocessingPlugin

RATIOS = {"d1": 0.4, "d2": 0.2, "d3": 0.2, "d4": 0.1, "d5": 0.05, "d6": 0.05}
ORDER = ["ts", "event_id"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE = ["l_orderkey", "l_linenumber"]
TEMPORAL = split.SplitConfiguration(RATIOS, temporal_split=True, temporal_column="ts")

_queries: dict = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return keep


def queries() -> dict:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def with_nulls(spark, d) -> DataFrame:
    """Events whose value is null where the id is divisible by 7."""
    return t(spark, d, "events").select(*ORDER, F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))


def six(spark, d) -> DataFrame:
    return split.split_six(t(spark, d, "events").select(*ORDER, "value"), TEMPORAL, ORDER)


# SQL: rows of events with their split
SPLIT = """
n AS (SELECT count(*) AS n FROM events),
r(k, i, ratio) AS (VALUES ('d1', 1, 0.4::DOUBLE), ('d2', 2, 0.2::DOUBLE), ('d3', 3, 0.2::DOUBLE), ('d4', 4, 0.1::DOUBLE), ('d5', 5, 0.05::DOUBLE), ('d6', 6, 0.05::DOUBLE)),
c AS (SELECT k, i, ratio, CAST(trunc(n * ratio) AS BIGINT) AS base, row_number() OVER (ORDER BY ratio DESC, i) AS pref FROM r, n),
z AS (SELECT k, i, ratio, base + CASE WHEN pref <= (SELECT n FROM n) - (SELECT sum(base) FROM c) THEN 1 ELSE 0 END AS size FROM c),
e AS (SELECT k, i, ratio, size, sum(size) OVER (ORDER BY i) AS upto FROM z),
p AS (SELECT event_id, ts, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events),
s AS (SELECT p.*, (SELECT k FROM e WHERE pos < upto ORDER BY i LIMIT 1) AS split FROM p)
"""


@query(f"WITH {SPLIT} SELECT event_id, ts, split FROM s")
def temporal_split_six(spark, d):
    return six(spark, d).select("event_id", "ts", "split")


@query(f"WITH {SPLIT} SELECT s.split, count(*) AS sample_count, round(count(*) / (SELECT n FROM n), 6) AS actual_ratio, max(ratio) AS expected_ratio, min(ts) AS first, max(ts) AS last FROM s JOIN e ON s.split = e.k GROUP BY s.split")
def split_counts(spark, d):
    return rounded(split.metadata(six(spark, d), RATIOS, "ts"), 6, "actual_ratio")


@query("""WITH k AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN pos < trunc(n * 0.2::DOUBLE) THEN 'd1' WHEN pos < trunc(n * 0.2::DOUBLE) + trunc(n * 0.6::DOUBLE) THEN 'd2' ELSE 'd3' END AS split FROM k""")
def three_way_split(spark, d):
    return split.three_way(t(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


@query(f"WITH {SPLIT} SELECT split, sum(size)::BIGINT AS rows FROM (SELECT k AS split, size FROM z) GROUP BY split".replace("FROM events)", "FROM orders)", 1))
def shuffle_split(spark, d):
    setup = split.SplitConfiguration(RATIOS, random_seed=42)
    return split.split_six(t(spark, d, "orders").select("o_orderkey"), setup, ["o_orderkey"]).groupBy("split").agg(F.count("*").alias("rows"))


ENDS = list(accumulate(RATIOS.values()))


@query(f"""WITH s AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), p AS (SELECT event_type, (unnest(range(n)) + 0.5::DOUBLE) / n AS spot FROM s)
SELECT event_type, CASE {" ".join(f"WHEN spot < {e!r}::DOUBLE THEN '{k}'" for k, e in zip(RATIOS, ENDS))} ELSE 'd6' END AS split, count(*) AS rows FROM p GROUP BY 1, 2""")
def stratified_split(spark, d):
    setup = split.SplitConfiguration(RATIOS, random_seed=42, stratify_column="event_type")
    out = split.split_six(t(spark, d, "events").select("event_id", "event_type"), setup, ["event_id"])
    return out.groupBy("event_type", "split").agg(F.count("*").alias("rows"))


@query("""WITH n AS (SELECT count(*) AS n FROM part), r(k, i, ratio) AS (VALUES ('d1', 1, 0.41::DOUBLE), ('d2', 2, 0.19::DOUBLE), ('d3', 3, 0.19::DOUBLE), ('d4', 4, 0.11::DOUBLE), ('d5', 5, 0.05::DOUBLE), ('d6', 6, 0.05::DOUBLE)),
c AS (SELECT k, CAST(trunc((n + 7) * ratio) AS BIGINT) AS base, row_number() OVER (ORDER BY ratio DESC, i) AS pref, n + 7 AS n FROM r, n)
SELECT k AS split, base + CASE WHEN pref <= n - (SELECT sum(base) FROM c) THEN 1 ELSE 0 END AS rows FROM c""")
def split_remainder(spark, d):
    """Sizes of a table whose row count leaves a remainder."""
    ratios = dict(zip(split.KEYS, (0.41, 0.19, 0.19, 0.11, 0.05, 0.05)))
    sizes = split.split_sizes(t(spark, d, "part").count() + 7, ratios)
    return spark.createDataFrame(list(sizes.items()), "split string, rows long")


@query(f"""WITH RECURSIVE {SPLIT}, b AS (SELECT 1 AS i, 0::BIGINT AS start_row, least(trunc(n * 0.4::DOUBLE), n - 1)::BIGINT AS end_row FROM n
UNION ALL SELECT b.i + 1, b.end_row + 1, least(b.end_row + 1 + trunc(n * r.ratio), n - 1)::BIGINT FROM b, n, r WHERE r.i = b.i + 1)
SELECT r.k AS split, start_row, end_row, end_row - start_row + 1 AS rows FROM b JOIN r USING (i)""")
def split_boundaries(spark, d):
    """Boundaries by the older arithmetic with inclusive ends."""
    rows = split.inclusive_boundaries(t(spark, d, "events").count(), RATIOS)
    return spark.createDataFrame(rows, "split string, start_row long, end_row long, rows long")


FIT = "f AS (SELECT avg(value) AS mean, stddev_samp(value) AS std FROM s WHERE split IN ('d1', 'd2'))"


@query(f"WITH {SPLIT}, {FIT} SELECT 'value' AS feature, round(mean, 6) AS mean, round(std, 6) AS std FROM f")
def zscore_fit(spark, d):
    p = normalize.fit_zscore(split.training(six(spark, d).select("value", "split")))
    return rounded(spark.createDataFrame([(c, p.means[c], p.stds[c]) for c in p.features], "feature string, mean double, std double"), 6, "mean", "std")


def fitted(spark, d):
    parts = six(spark, d)
    return parts, normalize.fit_zscore(split.training(parts), ("event_id",))


@query(f"WITH {SPLIT}, {FIT} SELECT event_id, ts, split, round((value - mean) / std, 6) AS z FROM s, f")
def zscore_apply(spark, d):
    parts, p = fitted(spark, d)
    return normalize.apply_zscore(parts, p).select("event_id", "ts", "split", F.round("value", 6).alias("z"))


@query("SELECT event_id, round(value, 6) AS value FROM events")
def zscore_roundtrip(spark, d):
    parts, p = fitted(spark, d)
    return normalize.invert_zscore(normalize.apply_zscore(parts, p), p).select("event_id", F.round("value", 6).alias("value"))


@query(f"WITH {SPLIT}, {FIT}, g AS (SELECT split, avg((value - mean) / std) AS m, stddev_samp((value - mean) / std) AS v FROM s, f GROUP BY split) SELECT split, 'value' AS feature, round(m, 6) AS mean, round(v, 6) AS std, abs(m) <= 0.1 AND abs(v - 1) <= 0.1 AS ok FROM g")
def zscore_quality(spark, d):
    parts, p = fitted(spark, d)
    return rounded(normalize.quality(normalize.apply_zscore(parts, p), ["value"]), 6, "mean", "std")


@query("SELECT o_orderkey, 0.0::DOUBLE AS fixed FROM orders")
def zscore_constant_feature(spark, d):
    df = t(spark, d, "orders").select("o_orderkey", F.lit(7.5).alias("fixed"))
    return normalize.apply_zscore(df, normalize.fit_zscore(df, ("o_orderkey",)))


def scaled(formula: str) -> str:
    parts = ", ".join(f"round({formula.format(c=c)}, 6) AS {c}" for c in MEASURES)
    stats = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}, avg({c}) AS mean_{c}, stddev_samp({c}) AS std_{c}" for c in MEASURES)
    return f"WITH f AS (SELECT {stats} FROM lineitem) SELECT {parts} FROM lineitem, f"


@query(scaled("({c} - min_{c}) / (max_{c} - min_{c}) * 2 - 1"))
def minmax_range(spark, d):
    df = t(spark, d, "lineitem").select(*MEASURES)
    return rounded(normalize.WholeTableNormalizer("min-max").fit(df).transform(df), 6, *MEASURES)


@query(scaled("({c} - min_{c}) / (max_{c} - min_{c} + 1e-8::DOUBLE)"))
def minmax_epsilon(spark, d):
    df = t(spark, d, "lineitem").select(*MEASURES)
    return rounded(normalize.WholeTableNormalizer("min-max", (0.0, 1.0), 1e-8).fit(df).transform(df), 6, *MEASURES)


@query("""WITH k AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n, min(o_totalprice) OVER () AS a, max(o_totalprice) OVER () AS b FROM orders)
SELECT o_orderkey::VARCHAR AS id, round((o_totalprice - a) / (b - a + 1e-8::DOUBLE), 6) AS o_totalprice,
CASE WHEN pos < trunc(n * 0.2::DOUBLE) THEN 'd1' WHEN pos < trunc(n * 0.2::DOUBLE) + trunc(n * 0.6::DOUBLE) THEN 'd2' ELSE 'd3' END AS split FROM k""")
def default_three_datasets(spark, d):
    """Three contiguous datasets, scaled by whole-table extremes."""
    df = t(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("id"), "o_totalprice")
    out, _ = default_datasets(df, ["o_orderkey"])
    return rounded(out, 6, "o_totalprice").select("id", "o_totalprice", "split")


@query(f"WITH {SPLIT}, f AS (SELECT avg(value) AS mean, stddev_samp(value) AS std FROM s WHERE split IN ('d1', 'd2')) SELECT event_id, split, round((value - mean) / std, 6) AS value FROM s, f")
def full_preparation(spark, d):
    """The whole pipeline over events: features, split, normalisation, postprocessing."""
    c = Configuration().set("data_handling.timestamp_column", "ts").set("normalization.exclude", ["event_id", "user_id"])
    df = t(spark, d, "events").select(*ORDER, "user_id", "value")
    out = Preparation(spark, c, [QualityFlag()], [ThreeSigma()]).use(df).process(ORDER)
    return rounded(out, 6, "value").select("event_id", "split", "value")


def prepared(spark, d, method: str, **more) -> DataFrame:
    c = Configuration().set("data_handling.timestamp_column", "ts").set("normalization.exclude", ["event_id"]).set("normalization.method", method)
    for key, value in more.items():
        c.set(key.replace("__", "."), value)
    return Preparation(spark, c).use(t(spark, d, "events").select(*ORDER, "value")).process(ORDER)


@query(f"WITH {SPLIT}, f AS (SELECT min(value) AS a, max(value) AS b FROM s WHERE split IN ('d1', 'd2')) SELECT event_id, split, round((value - a) / (b - a) * 2 - 1, 6) AS value FROM s, f")
def prep_minmax(spark, d):
    """The whole pipeline, scaled by the extremes of the training datasets."""
    return rounded(prepared(spark, d, "minmax"), 6, "value").select("event_id", "split", "value")


@query(f"WITH {SPLIT}, f AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM s WHERE split IN ('d1', 'd2')) SELECT event_id, split, round((value - m) / (b - a), 6) AS value FROM s, f")
def prep_robust(spark, d):
    """The same by median and quartiles."""
    return rounded(prepared(spark, d, "robust"), 6, "value").select("event_id", "split", "value")


@query(f"WITH {SPLIT}, f AS (SELECT avg(value) AS mean, stddev_samp(value) AS std FROM s WHERE split IN ('d1', 'd2')), w AS (SELECT event_id, split, (value - mean) / std AS v FROM s, f), m AS (SELECT split, avg(v) AS m, stddev_samp(v) AS sd FROM w GROUP BY split) SELECT event_id, w.split, true AS complete, abs(v - m) > 3 * sd AS outlier FROM w JOIN m ON w.split = m.split")
def prep_plugins(spark, d):
    """The same with the plugins that the configuration names."""
    out = prepared(spark, d, "zscore", feature_engineering__plugins=[f"{__name__}:QualityFlag"], postprocessing__plugins=[{"class": f"{__name__}:ThreeSigma"}])
    return out.select("event_id", "split", "complete", "outlier")


@query(scaled("({c} - mean_{c}) / std_{c}"))
def zscore_all_rows(spark, d):
    df = t(spark, d, "lineitem").select(*MEASURES)
    return rounded(normalize.WholeTableNormalizer("z-score").fit(df).transform(df), 6, *MEASURES)


@query("WITH f AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events) SELECT round((value - m) / (b - a), 6) AS value FROM events, f")
def robust_scale(spark, d):
    df = t(spark, d, "events").select("value")
    return rounded(normalize.WholeTableNormalizer("robust").fit(df).transform(df), 6, "value")


@query("SELECT round(1e-4::DOUBLE * 2 / (max(l_extendedprice) - min(l_extendedprice)) * 1e9, 6) AS minmax_nano, round(1e-4::DOUBLE / stddev_samp(l_extendedprice) * 1e9, 6) AS z_nano FROM lineitem")
def mae_per_pip(spark, d):
    df = t(spark, d, "lineitem").select("l_extendedprice")
    a = normalize.WholeTableNormalizer("min-max").fit(df).stats["l_extendedprice"]
    b = normalize.WholeTableNormalizer("z-score").fit(df).stats["l_extendedprice"]
    row = (normalize.mae_per_pip(a, "min-max") * 1e9, normalize.mae_per_pip(b, "z-score") * 1e9)
    return rounded(spark.createDataFrame([row], "minmax_nano double, z_nano double"), 6, "minmax_nano", "z_nano")


@query("SELECT event_id, round(value - avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS value FROM events")
def ma_unbias(spark, d):
    return rounded(windows.moving_average_unbias(t(spark, d, "events").select(*ORDER, "value"), ["value"], ORDER), 6, "value").select("event_id", "value")


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS mean5 FROM events")
def rolling_mean_feature(spark, d):
    df = t(spark, d, "events").select(*ORDER, "user_id", "value")
    return rounded(windows.rolling_mean(df, "value", "mean5", ORDER, partition_by=["user_id"]), 6, "mean5").select("event_id", "mean5")


EMA = """WITH RECURSIVE p AS (SELECT event_id, {x} AS x, row_number() OVER (ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT i, event_id, x, coalesce(x, 0.0::DOUBLE) AS num, CASE WHEN x IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS den FROM p WHERE i = 1
UNION ALL SELECT p.i, p.event_id, p.x, r.num * 0.9::DOUBLE + coalesce(p.x, 0.0::DOUBLE), r.den * 0.9::DOUBLE + CASE WHEN p.x IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END FROM r JOIN p ON p.i = r.i + 1)
SELECT event_id, round(x - num / nullif(den, 0), 6) AS value FROM r"""


@query(EMA.format(x="value"))
def ema_unbias(spark, d):
    return rounded(windows.exponential_unbias(t(spark, d, "events").select(*ORDER, "value"), ["value"], ORDER), 6, "value").select("event_id", "value")


@query(EMA.format(x="CASE WHEN event_id % 7 <> 0 THEN value END"))
def ema_unbias_nulls(spark, d):
    return rounded(windows.exponential_unbias(with_nulls(spark, d), ["value"], ORDER), 6, "value").select("event_id", "value")


@query("""WITH RECURSIVE p AS (SELECT event_id, user_id, value AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, i, event_id, x AS num, 1.0::DOUBLE AS den FROM p WHERE i = 1
UNION ALL SELECT p.user_id, p.i, p.event_id, r.num * 0.7::DOUBLE + p.x, r.den * 0.7::DOUBLE + 1 FROM r JOIN p ON p.user_id = r.user_id AND p.i = r.i + 1)
SELECT event_id, round(num / den, 6) AS value_ema FROM r""")
def ema_by_user(spark, d):
    df = t(spark, d, "events").select(*ORDER, "user_id", "value")
    return rounded(windows.exponential_average(df, ["value"], ORDER, 0.3, ["user_id"]), 6, "value_ema").select("event_id", "value_ema")


@query("""WITH m AS (SELECT avg(value) AS m FROM events), p AS (SELECT value - m AS x, row_number() OVER (ORDER BY ts, event_id) AS i FROM events, m),
k AS (SELECT unnest(range(1, 6))::INTEGER AS lag) SELECT lag, round(sum(a.x * b.x) / (SELECT sum(x * x) FROM p), 6) AS acf FROM k, p a JOIN p b ON true WHERE b.i = a.i - lag GROUP BY lag""")
def acf_standard(spark, d):
    rho = select.acf(t(spark, d, "events"), "value", ORDER, 5)
    return rounded(spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(rho)], "lag int, acf double"), 6, "acf")


@query("SELECT event_id, round(value - lag(value) OVER (ORDER BY ts, event_id), 6) AS diff FROM events")
def returns_diff(spark, d):
    return rounded(windows.first_difference(t(spark, d, "events").select(*ORDER, "value"), "value", "diff", ORDER), 6, "diff").select("event_id", "diff")


@query("WITH p AS (SELECT value AS x, row_number() OVER (ORDER BY ts, event_id) AS i FROM events), k AS (SELECT unnest(range(1, 11))::INTEGER AS lag) SELECT lag, round(corr(a.x, b.x), 6) AS autocorr FROM k, p a JOIN p b ON true WHERE b.i = a.i - lag GROUP BY lag")
def autocorr_lags(spark, d):
    return rounded(windows.autocorrelation(t(spark, d, "events"), "value", ORDER), 6, "autocorr")


MINUTES = "h AS (SELECT date_trunc('minute', ts) AS ts, avg(value) AS value FROM events GROUP BY 1), g AS (SELECT unnest(generate_series((SELECT min(ts) FROM h), (SELECT max(ts) FROM h), INTERVAL 1 MINUTE)) AS ts)"


def by_minute(spark, d) -> DataFrame:
    return t(spark, d, "events").groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts")).agg(F.avg("value").alias("value"))


@query(f"WITH {MINUTES} SELECT ts FROM g ANTI JOIN h USING (ts)")
def gap_detect(spark, d):
    return clean.find_gaps(by_minute(spark, d), "ts", 1)


LERP = """q AS (SELECT *, last_value(CASE WHEN x IS NOT NULL THEN i END IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a,
  first_value(CASE WHEN x IS NOT NULL THEN i END IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM p),
v AS (SELECT q.*, u.x AS xa, w.x AS xb FROM q LEFT JOIN p u ON u.i = q.a LEFT JOIN p w ON w.i = q.b)"""
FILLED = "round(CASE WHEN x IS NOT NULL THEN x WHEN a IS NULL THEN NULL WHEN b IS NULL THEN xa ELSE xa + (xb - xa) * ((i - a)::DOUBLE / (b - a)) END, {digits}) AS value"


@query(f"WITH {MINUTES}, p AS (SELECT ts, h.value AS x, row_number() OVER (ORDER BY ts) AS i FROM g FULL JOIN h USING (ts)), {LERP} SELECT ts, {FILLED.format(digits=9)} FROM v")
def gap_fill_interpolate(spark, d):
    return rounded(clean.fill_gaps(by_minute(spark, d), "ts", 1), 9, "value")


@query(f"WITH p AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS x, row_number() OVER (ORDER BY ts, event_id) AS i FROM events), {LERP} SELECT event_id, {FILLED.format(digits=6)} FROM v")
def interpolate_linear(spark, d):
    return rounded(windows.interpolate(with_nulls(spark, d), ["value"], ORDER), 6, "value").select("event_id", "value")


@query("""WITH a AS (SELECT * FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem) WHERE NOT abs(l_extendedprice - m) > 1.5 * s),
b AS (SELECT l_orderkey, l_linenumber FROM a, (SELECT avg(l_quantity) AS m2, stddev_samp(l_quantity) AS s2 FROM a) WHERE NOT abs(l_quantity - m2) > 1.5 * s2) SELECT * FROM b""")
def outlier_delete_seq(spark, d):
    df = t(spark, d, "lineitem").select(*LINE, "l_extendedprice", "l_quantity")
    return clean.delete_outliers(df, ["l_extendedprice", "l_quantity"], 1.5).select(*LINE)


@query("SELECT l_orderkey, l_linenumber FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s, avg(l_quantity) AS m2, stddev_samp(l_quantity) AS s2 FROM lineitem) WHERE NOT (abs(l_extendedprice - m) > 1.5 * s OR abs(l_quantity - m2) > 1.5 * s2)")
def outlier_simultaneous(spark, d):
    df = t(spark, d, "lineitem").select(*LINE, "l_extendedprice", "l_quantity")
    return clean.delete_outliers(df, ["l_extendedprice", "l_quantity"], 1.5, simultaneous=True).select(*LINE)


@query("SELECT l_orderkey, l_linenumber, CASE WHEN NOT abs(l_extendedprice - m) > 1.5 * s THEN l_extendedprice END AS l_extendedprice FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem)")
def outlier_null(spark, d):
    return clean.null_outliers(t(spark, d, "lineitem").select(*LINE, "l_extendedprice"), ["l_extendedprice"], 1.5)


@query("SELECT event_id, ts, value FROM events WHERE event_id % 7 <> 0 AND value IS NOT NULL AND ts IS NOT NULL")
def drop_any_null(spark, d):
    return clean.drop_nulls(with_nulls(spark, d)).select("event_id", "ts", "value")


@query("SELECT 3 * count(*) AS cells, (3 * count(*) - count_if(event_id % 7 = 0))::BIGINT AS known, round((3 * count(*) - count_if(event_id % 7 = 0)) * 100.0 / (3 * count(*)), 6) AS completeness FROM events")
def profile_completeness(spark, d):
    return rounded(profile.completeness(with_nulls(spark, d)), 6, "completeness")


@query("SELECT unnest(['ts', 'event_id', 'value']) AS feature, unnest([0, 0, count_if(event_id % 7 = 0)])::BIGINT AS nulls FROM events")
def profile_nulls(spark, d):
    return profile.nulls(with_nulls(spark, d))


@query("WITH g AS (SELECT count(*) AS n FROM events GROUP BY event_type, user_id) SELECT sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS duplicates, round(sum(n - 1) * 100.0 / sum(n), 6) AS percent FROM g")
def profile_duplicates(spark, d):
    return rounded(profile.duplicates(t(spark, d, "events").select("event_type", "user_id")), 6, "percent")


DESCRIBE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min, "
    f"round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75, max({c})::DOUBLE AS max FROM lineitem"
    for c in MEASURES
)


@query(DESCRIBE)
def profile_describe(spark, d):
    return rounded(profile.describe(t(spark, d, "lineitem"), MEASURES), 4, "mean", "std", "p25", "p50", "p75")


@query("""WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT 'value' AS feature, round(q1, 6) AS q1, round(q3, 6) AS q3, count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))::BIGINT AS outliers FROM events, q GROUP BY q1, q3""")
def profile_iqr(spark, d):
    return rounded(profile.iqr_outlier_counts(t(spark, d, "events"), ["value"]), 6, "q1", "q3")


@query("""SELECT 'p_brand' AS feature, count(DISTINCT p_brand) AS "distinct", (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode, round(avg(length(p_brand)), 6) AS mean_length FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type), (SELECT p_type FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), round(avg(length(p_type)), 6) FROM part""")
def profile_text(spark, d):
    return rounded(profile.text_profile(t(spark, d, "part"), ["p_brand", "p_type"]), 6, "mean_length")


@query("""SELECT unnest(['min_rows', 'min_columns', 'missing', 'types', 'numeric', 'duplicates']) AS rule, unnest([count(*) >= 10, true, true, true, true, true]) AS ok FROM lineitem""")
def validation_report(spark, d):
    return profile.validation_report(t(spark, d, "lineitem"))


@query()
def table_checksum(spark, d):
    return profile.checksum(t(spark, d, "lineitem"))


@query("WITH k AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders) SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM k WHERE pos NOT IN (0, 5, 17)")
def trim_rows_cols(spark, d):
    return trim.trim(t(spark, d, "orders"), [2, 5], [0, 5, 17], ["o_orderkey"])


@query("SELECT o_orderdate FROM orders")
def select_single(spark, d):
    return trim.select_single(t(spark, d, "orders"))


@query("SELECT o_totalprice, o_orderkey FROM orders")
def select_multi(spark, d):
    return trim.select_multi(t(spark, d, "orders"), [3, 0])


@query(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(sum({c} * {c}), 2) AS energy, sum({c} * {c}) > 100 AS selected FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def select_acf_raw(spark, d):
    return rounded(select.energy(t(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], 100.0), 2, "energy")


@query("SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 450")
def last_rows(spark, d):
    return trim.last_rows(t(spark, d, "events").select(*ORDER), ORDER, 450).select("event_id")


class QualityFlag(FeaturePlugin):
    """Whether the value is known."""

    name = "quality_flag"

    def transform(self, df):
        return df.withColumn("complete", F.col("value").isNotNull())


class ThreeSigma(PostprocessingPlugin):
    """Values beyond three deviations of their dataset."""

    name = "three_sigma"

    def should_execute(self, df):
        return "value" in df.columns

    def transform(self, df):
        stats = df.groupBy("split").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
        flag = F.coalesce(F.abs(F.col("value") - F.col("_m")) > 3 * F.col("_s"), F.lit(False))
        return df.join(F.broadcast(stats), "split").withColumn("outlier", flag).drop("_m", "_s")  # one row a dataset


@query("SELECT event_id, event_id % 7 <> 0 AS complete FROM events")
def quality_flag(spark, d):
    return PluginPipeline([QualityFlag()]).process(with_nulls(spark, d))[0].select("event_id", "complete")


@query(f"WITH {SPLIT}, m AS (SELECT split, avg(value) AS m, stddev_samp(value) AS sd FROM s GROUP BY split) SELECT event_id, split, abs(value - m) > 3 * sd AS outlier FROM s JOIN m USING (split)")
def three_sigma_flag(spark, d):
    return PluginPipeline([ThreeSigma()]).process(six(spark, d))[0].select("event_id", "split", "outlier")


RETURNS = "d AS (SELECT value - lag(value) OVER (ORDER BY ts, event_id) AS d FROM events), n AS (SELECT (d - min(d) OVER ()) / (max(d) OVER () - min(d) OVER ()) AS r FROM d WHERE d IS NOT NULL), a AS (SELECT count(*) AS n, avg(r) AS mean, stddev_samp(r) AS std, avg(abs(r)) AS mean_abs, pow(avg(r) / stddev_samp(r), 2) AS snr FROM n)"


@query(f"WITH {RETURNS} SELECT n, round(mean, 6) AS mean, round(std, 6) AS std, round(mean_abs, 6) AS mean_abs, round(snr, 6) AS snr, round(1 / snr, 6) AS noise_power, round(sqrt(1 / snr), 6) AS noise_std, round(sqrt(1 / snr) * sqrt(2 / pi()), 6) AS noise_mean FROM a")
def snr_stats(spark, d):
    s = signal.signal_stats(t(spark, d, "events"), "value", ORDER).drop("capacity", "information")
    return rounded(s, 6, "mean", "std", "mean_abs", "snr", "noise_power", "noise_std", "noise_mean")


@query(f"WITH {RETURNS} SELECT round(log2(1 + snr) / 3600, 9) AS capacity, round(log2(1 + snr) / 3600 * n * 3600, 3) AS information FROM a")
def channel_capacity(spark, d):
    s = signal.signal_stats(t(spark, d, "events"), "value", ORDER)
    return s.select(F.round("capacity", 9).alias("capacity"), F.round("information", 3).alias("information"))


@query("""WITH p AS (SELECT value AS x, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS i FROM events), n AS (SELECT least(count(*), 4500) AS n FROM p),
q AS (SELECT x, n - i AS j, n FROM p, n WHERE i <= n), k AS (SELECT unnest(range(n // 2)) AS k FROM n),
f AS (SELECT k, max(n) AS n, sum(x * cos(2 * pi() * ((k * j) % n) / n)) AS re, sum(x * sin(2 * pi() * ((k * j) % n) / n)) AS im FROM q, k GROUP BY k),
l AS (SELECT k, k * (1::DOUBLE / n) AS freq, 10 * log10(sqrt(re * re + im * im) + 1e-10) AS decibel FROM f),
w AS (SELECT *, lag(decibel) OVER (ORDER BY k) AS a, lead(decibel) OVER (ORDER BY k) AS b FROM l)
SELECT k, freq, round(decibel, 7) AS decibel FROM w WHERE decibel > a AND decibel > b ORDER BY k LIMIT 5""")
def fft_peaks(spark, d):
    return rounded(signal.peaks(signal.spectrum(t(spark, d, "events"), "value", ORDER)), 7, "decibel")


@query("""WITH RECURSIVE m AS (SELECT avg(value) AS m FROM events), p AS (SELECT value - m AS x, row_number() OVER (ORDER BY ts, event_id) AS i FROM events, m),
l AS (SELECT unnest(range(1, 11))::INTEGER AS lag), c AS (SELECT lag, sum(a.x * b.x) / (SELECT sum(x * x) FROM p) AS acf FROM l, p a JOIN p b ON true WHERE b.i = a.i - lag GROUP BY lag),
r AS (SELECT list(acf ORDER BY lag) AS rho FROM c),
s(k, phi) AS (SELECT 1, [rho[1]] FROM r UNION ALL
  SELECT k + 1, list_append(list_transform(list_zip(phi, list_reverse(phi)), lambda x: x[1] - last * x[2]), last)
  FROM (SELECT k, phi, (rho[k + 1] - list_dot_product(phi, list_reverse(rho[1:k]))) / (1 - list_dot_product(phi, rho[1:k])) AS last FROM s, r WHERE k < 10))
SELECT k AS lag, round(acf, 6) AS acf, round(phi[k], 6) AS pacf FROM s JOIN c ON c.lag = s.k""")
def pacf_standard(spark, d):
    rho = select.acf(t(spark, d, "events"), "value", ORDER)
    return rounded(spark.createDataFrame([(i + 1, a, b) for i, (a, b) in enumerate(zip(rho, select.pacf(rho)))], "lag int, acf double, pacf double"), 6, "acf", "pacf")


@query()
def granger_f(spark, d):
    df = t(spark, d, "events").select(*ORDER, "value", F.col("user_id").cast("double").alias("other"))
    return spark.createDataFrame([(select.granger(df, "other", "value", ORDER),)], "f double")


FEATURES = ["l_quantity", "l_discount", "l_tax"]


@query("""WITH p AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS i, value, user_id::DOUBLE AS user_id, event_id::DOUBLE AS event_id FROM events), s AS (SELECT sum(value * value) AS value, sum(user_id * user_id) AS user_id FROM p)
SELECT unnest(['value', 'user_id']) AS feature, unnest([value > 0.05, user_id > 0.05]) AS kept FROM s""")
def select_by_method(spark, d):
    df = t(spark, d, "events")
    kept = select.select_features(df, "acf", ["value", "user_id"], {"significance_level": 0.05})
    return spark.createDataFrame([(f, f in kept) for f in ("value", "user_id")], "feature string, kept boolean")


@query("SELECT 'd2' AS split, 'missing' AS difference, 'l_tax' AS feature UNION ALL SELECT 'd3', 'extra', 'l_line'")
def schema_drift(spark, d):
    df = t(spark, d, "lineitem").select(*LINE, *MEASURES)
    found = split.schema_drift({"d1": df, "d2": df.drop("l_tax"), "d3": df.withColumn("l_line", F.col("l_linenumber"))})
    return spark.createDataFrame(found, "split string, difference string, feature string")


@query()
def lasso_select(spark, d):
    return spark.createDataFrame([(f,) for f in select.lasso(t(spark, d, "lineitem"), FEATURES, "l_extendedprice", 1.0)], "feature string")


@query()
def elastic_select(spark, d):
    return spark.createDataFrame([(f,) for f in select.elastic_net(t(spark, d, "lineitem"), FEATURES, "l_extendedprice", 1.0, 0.5)], "feature string")


@query()
def boruta_select(spark, d):
    return spark.createDataFrame([(f,) for f in select.shadow_forest(t(spark, d, "lineitem"), FEATURES, "l_extendedprice", 3)], "feature string")


def bins(c: str) -> str:
    return f"least(15, floor(({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem) * 16))"


@query("WITH c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {bins(c)} AS x, {bins('l_extendedprice')} AS y, count(*) AS n FROM lineitem GROUP BY 2, 3" for c in FEATURES)
       + "), w AS (SELECT *, sum(n) OVER (PARTITION BY feature, x) AS nx, sum(n) OVER (PARTITION BY feature, y) AS ny, sum(n) OVER (PARTITION BY feature) AS t FROM c) SELECT feature, round(sum(n / t * ln(n * t / (nx * ny))), 6) AS mi FROM w GROUP BY feature")
def mi_select(spark, d):
    return rounded(select.mutual_information(t(spark, d, "lineitem"), FEATURES, "l_extendedprice"), 6, "mi")
