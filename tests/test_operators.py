"""Contracts of the operators: sizes, order, round trips, errors, files, plugins."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoprep import cli
from chronoprep.functions import scalars, signal
from chronoprep.operators import clean, normalize, profile, select, split, trim, windows
from chronoprep.operators.position import POSITION, over_series, with_position
from chronoprep.plans.config import Configuration
from chronoprep.plans.pipeline import Preparation, default_datasets, export_default
from chronoprep.plans.plugins import FeaturePlugin, Plugin, PluginPipeline, Registry
from chronoprep.sources import readers, writers
from chronoprep.streaming.normalize import normalized_stream

RATIOS = {"d1": 0.4, "d2": 0.2, "d3": 0.2, "d4": 0.1, "d5": 0.05, "d6": 0.05}


@pytest.fixture(scope="module")
def prices(spark):
    rng = np.random.default_rng(42)
    n = 2000
    close = 1.1 + np.cumsum(rng.normal(0, 1e-4, n))
    pdf = pd.DataFrame({"timestamp": pd.date_range("2020-01-01", periods=n, freq="h"), "open": close, "close": close + 1e-5, "volume": rng.integers(1, 1000, n).astype(float)})
    return spark.createDataFrame(pdf)


def temporal():
    return split.SplitConfiguration(RATIOS, temporal_split=True, temporal_column="timestamp")


def test_position(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert with_position(df, ["k"]).where(F.col("k") != F.col(POSITION)).isEmpty()
    assert with_position(df.where("false"), ["k"]).count() == 0


def test_split_sizes():
    assert split.split_sizes(10000, RATIOS) == {"d1": 4000, "d2": 2000, "d3": 2000, "d4": 1000, "d5": 500, "d6": 500}
    for n in (1, 7, 61, 103, 9999):
        sizes = split.split_sizes(n, RATIOS)
        assert sum(sizes.values()) == n and all(sizes[k] - int(n * r) in (0, 1) for k, r in RATIOS.items())


def test_temporal_split(prices):
    out = split.split_six(prices, temporal(), ["timestamp"])
    rows = {r["split"]: r for r in out.groupBy("split").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"), F.count("*").alias("n")).collect()}
    assert [rows[k]["n"] for k in split.KEYS] == [800, 400, 400, 200, 100, 100]
    assert all(rows[a]["b"] < rows[b]["a"] for a, b in zip(split.KEYS, split.KEYS[1:]))
    assert split.integrity(prices, out)["status"] == "verified"
    assert set(split.datasets(out)) == set(split.KEYS)


def test_shuffle_is_reproducible(prices):
    label = lambda seed: {(r["timestamp"], r["split"]) for r in split.split_six(prices, split.SplitConfiguration(RATIOS, seed), ["timestamp"]).collect()}
    assert label(1) == label(1) != label(2)


def test_stratified(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4).alias("s"))
    out = split.split_six(df, split.SplitConfiguration(RATIOS, 1, "s"), ["id"]).groupBy("s", "split").count().collect()
    assert {(r["s"], r["split"]): r["count"] for r in out}[0, "d1"] == 100


def test_split_errors(spark, prices):
    with pytest.raises(ValueError, match=r"1\.0"):
        split.SplitConfiguration(RATIOS | {"d1": 0.35})
    with pytest.raises(ValueError):
        split.SplitConfiguration({"d1": 1.0})
    assert split.validate(prices.limit(30), temporal())
    assert split.validate(prices.withColumn("timestamp", F.when(F.col("volume") > 500, F.col("timestamp"))), temporal())
    assert not split.validate(prices, temporal())
    assert split.inclusive_boundaries(100, RATIOS)[1][1] == 41


def test_normalization(prices, tmp_path):
    out = split.split_six(prices, temporal(), ["timestamp"])
    p = normalize.fit_zscore(split.training(out))
    z = normalize.apply_zscore(out, p)
    r = split.training(z).agg(F.avg("close").alias("m"), F.stddev_samp("close").alias("s")).first()
    assert abs(r.m) < 1e-9 and abs(r.s - 1) < 1e-9
    assert normalize.invert_zscore(z, p).join(prices.withColumnRenamed("close", "c"), "timestamp").where(F.abs(F.col("close") - F.col("c")) > 1e-9).isEmpty()
    a, b = str(tmp_path / "means.json"), str(tmp_path / "stds.json")
    p.save(a, b)
    p.save(a, b)
    assert (tmp_path / "means.backup.json").exists()
    assert normalize.NormalizationParameters.load(a, b).means == p.means
    d = json.load(open(a))
    d["means"]["close"] += 1
    json.dump(d, open(a, "w"))
    assert normalize.NormalizationParameters.load(a, b) is None
    open(a, "w").write("{")
    assert normalize.NormalizationParameters.load(a, b) is None
    assert normalize.quality(split.training(z), ["close"]).count() == 2


def test_normalization_edges(spark):
    df = spark.createDataFrame([(5.0, None, "x"), (5.0, None, "y"), (5.0, 1.0, "z")], "a double, b double, c string")
    p = normalize.fit_zscore(df)
    assert p.stds == {"a": 1.0} and p.means == {"a": 5.0}
    with pytest.raises(ValueError):
        normalize.fit_zscore(df.select("c"))
    with pytest.raises(ValueError):
        normalize.NormalizationParameters({"a": 1.0}, {"a": 0.0})
    assert normalize.WholeTableNormalizer("min-max").fit(df.select("a")).transform(df.select("a")).first()[0] is None


def test_whole_table_files(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    path = str(tmp_path / "p.json")
    n = normalize.WholeTableNormalizer("min-max").fit(df)
    n.save(path)
    assert normalize.WholeTableNormalizer.load(path).transform(df).agg(F.max("x")).first()[0] == 1.0
    assert math.isclose(normalize.mae_per_pip(n.stats["x"], "min-max"), 1e-4 * 2 / 9)


@pytest.mark.parametrize("alpha", [0.1, 0.5, 0.9, 0.01])
def test_ema_is_pandas(spark, alpha):
    rng = np.random.default_rng(1)
    x = [None if rng.random() < 0.2 else float(v) for v in rng.normal(size=600)]
    x[0] = None
    df = spark.createDataFrame(list(enumerate(x)), "i long, x double")
    got = [r["x_ema"] for r in windows.exponential_average(df, ["x"], ["i"], alpha).orderBy("i").collect()]
    want = pd.Series(x, dtype=float).ewm(alpha=alpha).mean()
    assert np.allclose(np.array(got, float), want, rtol=1e-9, equal_nan=True)


def test_blocks_equal_one_window(spark):
    df = spark.createDataFrame([(i, float(i * i % 97)) for i in range(500)], "id long, x double")
    small = over_series(df, ["id"], lambda w: {"m": F.avg("x").over(w.rowsBetween(-4, 2))}, before=4, after=2, block=16)
    x = pd.Series([float(i * i % 97) for i in range(500)])
    want = [x[max(0, i - 4) : i + 3].mean() for i in range(500)]
    assert np.allclose([r["m"] for r in small.orderBy("id").collect()], want)


def test_interpolation(spark):
    x = [None, 1.0, 2.0, None, 4.0, None]
    df = spark.createDataFrame([(i, 0, v) for i, v in enumerate(x)], "i long, g int, x double")
    for by in (None, ["g"]):
        got = [r.x for r in windows.interpolate(df, ["x"], ["i"], by).orderBy("i").collect()]
        assert got == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_unbias_dispatch(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(20)], "i long, x double")
    assert windows.unbias(df, ["i"], "ma", 2).orderBy("i").collect()[1].x == 0.5
    with pytest.raises(ValueError):
        windows.unbias(df, ["i"], "other")


def test_gaps_and_outliers(spark):
    df = spark.sql("SELECT timestamp_ntz '2020-01-01 00:00:00' + make_interval(0,0,0,0,0,5 * id) AS ts, double(id) AS x FROM range(20) WHERE id NOT IN (3, 4)")
    assert clean.find_gaps(df, "ts", 5).count() == 2
    assert [r.x for r in clean.fill_gaps(df, "ts", 5).orderBy("ts").collect()][2:6] == [2.0, 3.0, 4.0, 5.0]
    with pytest.raises(ValueError):
        clean.time_grid(df.selectExpr("if(x = 0, null, ts) ts", "x"), "ts")
    odd = spark.createDataFrame([(float(i % 3), float(i)) for i in range(50)] + [(100.0, 1.0)], "a double, b double")
    assert clean.delete_outliers(odd, ["a", "b"], 3.0).count() == 50
    assert clean.null_outliers(odd, ["a"], 3.0).where("a is null").count() == 1
    with pytest.raises(ValueError):
        clean.Cleaner("odd").run(df, "ts")


def test_cleaner_file(spark, tmp_path):
    path = str(tmp_path / "c.json")
    clean.Cleaner("outlier", outlier_threshold=2.0, delete_outliers=True).save(path)
    assert clean.Cleaner.load(path).outlier_threshold == 2.0


def test_profile(spark):
    df = spark.createDataFrame([(1.0, "b"), (1.0, "b"), (2.0, "a"), (None, None), (9.0, "a")], "x double, s string")
    assert profile.duplicates(df).first()["duplicates"] == 1
    assert profile.text_profile(df).first()["mode"] == "a"
    d = profile.describe(df).first()
    assert (d["count"], d.p25, d.p50) == (4, 1.0, 1.5)
    assert dict(profile.validation_report(df).collect())["min_rows"] is False
    assert profile.ValidationRules().set(min_rows=3, nonsense=1).unknown == ["nonsense"]
    assert profile.checksum(df).first() == profile.checksum(df.orderBy("x")).first()


def test_trim(spark, tmp_path):
    df = spark.createDataFrame([(i, i * 2, i * 3) for i in range(6)], "a long, b long, c long")
    path = str(tmp_path / "t.json")
    assert trim.trim(df, [1], [0, 5], ["a"], save_params=path).columns == ["a", "c"]
    assert trim.trim(df, [], [], ["a"], load_params=path).count() == 4
    with pytest.raises(ValueError):
        trim.trim_rows(df, [9], ["a"])
    with pytest.raises(ValueError, match="OPEN"):
        trim.ordered_columns(df)


def test_selection(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=2000), rng.normal(size=2000)
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(2000), "a": a, "b": b, "y": 5 * a + 0.1 * rng.normal(size=2000), "later": np.r_[0, a[:-1]]}))
    assert select.lasso(df, ["a", "b"], "y", 0.5) == ["a"]
    mi = {r.feature: r.mi for r in select.mutual_information(df, ["a", "b"], "y").collect()}
    assert mi["a"] > 5 * mi["b"]
    assert select.granger(df, "a", "later", ["i"]) > 1000 > select.granger(df, "b", "later", ["i"])
    rho = select.acf(df, "a", ["i"], 3)
    assert max(map(abs, rho)) < 0.1 and abs(select.pacf([0.5, 0.25])[1]) < 1e-9
    assert select.shadow_forest(df, ["a", "b"], "y", 2) == ["a"]


def test_lasso_optimality(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    y = x[:, 0] * 3 - x[:, 2] + rng.normal(size=500)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, y double")
    assert select.lasso(df, ["a", "b", "c", "d"], "y", 0.3) == ["a", "c"]


def test_signal(spark):
    t = np.arange(256)
    df = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(np.sin(2 * np.pi * 16 * t / 256))], "i long, x double")
    assert 16 in [r.k for r in signal.peaks(signal.spectrum(df, "x", ["i"]), 5).collect()]
    assert signal.signal_stats(df.withColumn("x", F.lit(1.0)), "x", ["i"]).first()["snr"] is None


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("d;x\n01/02/2020;1.5\n02/02/2020;oops\n")
    p = str(tmp_path / "a.csv")
    assert readers.detect_separator(spark, p) == ";" and readers.load(spark, p).columns == ["d", "x"]
    (tmp_path / "b.dat").write_text('[{"x": 1}, {"x": 2}]')
    assert readers.detect_format(spark, str(tmp_path / "b.dat")) == "json" and readers.read_json(spark, str(tmp_path / "b.dat")).count() == 2
    (tmp_path / "c.jsonl").write_text('{"x": 1}\n{"x": 2}\n{"x": 3}\n')
    assert readers.load(spark, str(tmp_path / "c.jsonl")).count() == 3
    (tmp_path / "l.csv").write_text("when,x\n01/02/2020,1.5\n02/02/2020 10:30,oops\n")
    rows = readers.load_legacy_csv(spark, str(tmp_path / "l.csv")).collect()
    assert rows[0].DATE_TIME.month == 2 and rows[1].x is None
    assert readers.load_headerless(spark, str(tmp_path / "l.csv"), 1).count() == 1
    with pytest.raises(ValueError):
        readers.detect_format(spark, "x.bin")
    assert scalars.nan_to_null(spark.createDataFrame([(float("nan"),)], "x double")).first().x is None
    assert [scalars.convert_type(x) for x in ("1", "1.5", "a")] == [1, 1.5, "a"]


def test_sinks(spark, prices, tmp_path):
    for fmt in writers.FORMATS:
        assert writers.export(prices, str(tmp_path / fmt), fmt, single_file=True)
    assert not writers.export(prices, str(tmp_path / "x"), "odd")
    out = split.split_six(prices, temporal(), ["timestamp"])
    assert writers.export_splits(out, str(tmp_path / "s")) and spark.read.parquet(str(tmp_path / "s") + "/split=d4").count() == 200
    meta = json.load(open(writers.export_metadata(out, str(tmp_path / "m"))))
    assert meta["datasets"]["d1"]["rows"] == 800
    writers.write_csv(prices, str(tmp_path / "w"))


class Good(FeaturePlugin):
    name = "good"

    def transform(self, df):
        return df.withColumn("twice", F.col("close") * 2)


class Bad(FeaturePlugin):
    name = "bad"
    dependencies = ("good",)

    def transform(self, df):
        return df.select("nowhere")


class Loses(FeaturePlugin):
    name = "loses"

    def transform(self, df):
        return df.select("close")


def test_plugins(prices):
    out, report = PluginPipeline([Good(), Bad(), Loses()]).process(prices)
    assert [r["ok"] for r in report] == [True, False, False] and "twice" in out.columns
    with pytest.raises(TypeError):
        PluginPipeline().add("x")
    with pytest.raises(RuntimeError):
        Good().process(prices)
    r = Registry()
    for c in (Bad, Good):
        r.register(c)
    assert r.order(["bad", "good"]) == ["good", "bad"]
    with pytest.raises(ValueError):
        r.order(["bad"])
    with pytest.raises(ImportError):
        r.load("none")
    assert isinstance(r.load("good"), Plugin) and PluginPipeline([Good()]).plan(prices)[0]["will_execute"]


def test_configuration(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"export": {"format": "json"}, "extra": {"a": 1}}))
    c = Configuration().add_file(str(path)).add_environment({"CHRONOPREP_EXPORT__FORMAT": "parquet", "OTHER": "x"})
    assert c.get("export.format") == "parquet" and c.get("extra.a") == 1 and not c.has("extra.b")
    assert c.set("export.format", "csv").get("export.format") == "csv" and not c.errors() and len(c.summary()) == 4
    assert "1.0" in Configuration().set("data_splitting.ratios.d1", 0.35).errors()[0]
    c.save(str(tmp_path / "o.json"), only_changes=True)
    assert json.load(open(tmp_path / "o.json")) == {"extra": {"a": 1}}


def test_pipeline_and_reuse(spark, prices, tmp_path):
    c = Configuration().set("export.format", "parquet")
    job = Preparation(spark, c, [Good()]).use(prices)
    out = job.process()
    assert out.groupBy("split").count().count() == 6 and job.status()["processed"]
    folder = job.export(str(tmp_path / "o"))
    again = Preparation(spark, c, [Good()]).use(prices)
    assert again.use_parameters(f"{folder}/means.json", f"{folder}/stds.json")
    both = again.process().select("timestamp", F.col("close").alias("c")).join(out, "timestamp")
    assert both.where(F.abs(F.col("c") - F.col("close")) > 1e-10).isEmpty()
    same = Preparation(spark, Configuration().set("normalization.training_datasets", [])).use(prices).process()
    assert same.join(prices.select("timestamp", F.col("close").alias("c")), "timestamp").where("c <> close").isEmpty()
    with pytest.raises(ValueError):
        Preparation(spark).use(prices.limit(30)).process()
    three, fitted = default_datasets(prices, ["timestamp"])
    assert three.agg(F.max("close")).first()[0] <= 1.0 and set(fitted.stats) == {"open", "close", "volume"}


def test_default_export(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), float(i), float(i), float(i)) for i in range(50)], "DATE_TIME long, OPEN double, LOW double, HIGH double, CLOSE double")
    rows = {r.Filename: (r.Rows, r.Columns) for r in export_default(df, ["DATE_TIME"], str(tmp_path / "o")).collect()}
    assert rows["base_d1"] == (10, 5) and rows["normalized_d2"] == (30, 5) and len(rows) == 6
    assert (tmp_path / "o" / "debug_out.json").exists()
    n = normalize.WholeTableNormalizer("z-score").fit(df)
    assert set(n.debug_info()) == set(df.columns)
    job = Preparation(spark).use(df)
    assert job.summary()["rows"] == 50
    job.update(df.limit(5))
    job.clear()
    assert job.summary() == {"status": "no_data_loaded"}


def test_command_line(spark, prices, tmp_path):
    prices.coalesce(1).write.parquet(str(tmp_path / "in.parquet"))
    assert cli.main([str(tmp_path / "in.parquet"), "--output", str(tmp_path / "out"), "--format", "csv"]) == 0
    assert (tmp_path / "out" / "split_metadata.json").exists()
    assert cli.main([str(tmp_path / "missing.parquet")]) == 1
    assert cli.main(["--split-ratios", "0.3", "0.1", "0.1", "0.1", "0.1", "0.1", "--validate-only"]) == 1


def test_stream(spark, prices, tmp_path):
    prices.write.parquet(str(tmp_path / "p"))
    p = normalize.fit_zscore(prices)
    q = normalized_stream(spark, str(tmp_path / "p"), prices.schema, p).writeStream.format("memory").queryName("normalized").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert abs(spark.sql("SELECT avg(close) FROM normalized").first()[0]) < 1e-6


def test_fft_peaks_see_the_reference_rows(spark):
    import numpy as np

    from chronoprep.plans import registry

    d = "/root/testdata/sf0.01"
    rows = sorted((r.ts, r.event_id, r.value) for r in spark.read.parquet(f"{d}/events.parquet").collect())[-4500:]
    assert len(rows) == 4500
    y = 10 * np.log10(np.abs(np.fft.fft([float(v) for *_, v in rows])) + 1e-10)[:2250]
    want = [k for k in range(1, 2249) if y[k - 1] < y[k] > y[k + 1]][:5]
    got = registry.queries()["fft_peaks"](spark, d).collect()
    assert [r.k for r in got] == want
    assert all(abs(r.freq - r.k / 4500) < 1e-12 and abs(r.decibel - y[r.k]) < 1e-6 for r in got)


def test_checksum_counts_rows_and_nulls(spark):
    from chronoprep.operators import profile

    value = lambda df: profile.checksum(df).first().checksum
    a = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    b = spark.createDataFrame([(None, "a"), ("b", "c")], "x string, y string")
    assert value(a) != value(b) and value(a) != value(a.union(a)) != 0
    assert value(a) == value(a.orderBy("x").repartition(3)) and value(a.where("false")) == 0


def test_settings_are_not_ignored(spark, tmp_path):
    import json

    from chronoprep.plans.config import Configuration
    from chronoprep.plans.pipeline import Preparation

    rows = spark.range(400).selectExpr("timestamp'2020-01-01' + make_interval(0, 0, 0, 0, id) ts", "id * 1.0D x", "id % 2 same_hour")
    for method, low in (("minmax", -1.0), ("robust", None)):
        c = Configuration().set("data_handling.timestamp_column", "ts").set("normalization.method", method)
        job = Preparation(spark, c).use(rows)
        assert job.export(str(tmp_path / "none")) is False
        train = job.process().where("split in ('d1', 'd2')").selectExpr("min(x) a", "max(x) b").first()
        assert (train.a, train.b) == (-1.0, 1.0) if low else train.b - train.a > 1.9
        job.export(str(tmp_path / method), include_metadata=False)
        assert json.load(open(tmp_path / method / "normalization.json"))["method"] == {"minmax": "min-max"}.get(method, method)
    with pytest.raises(ImportError):
        Preparation(spark, Configuration().set("feature_engineering.plugins", ["no_such_module:Plugin"]))


def test_select_features_by_method(spark, tmp_path):
    rows = [(i, float(i % 7), 0.0, float(3 * (i % 7))) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, a double, zero double, y double")
    assert select.select_features(df, "acf", ["zero", "a"]) == ["a"]
    assert select.select_features(df, "pacf", ["a"], {"mode": "standard", "lags": 3}, order_by=["i"]) == ["a"]
    assert select.select_features(df, "lasso", ["a", "zero"], {"alpha": 0.1}, "y") == ["a"]
    assert select.select_features(df, "mutual_info", ["zero", "a"], {"k": 1}, "y") == ["a"]
    with pytest.raises(ValueError):
        select.select_features(df, "other", ["a"])
    with pytest.raises(ValueError):
        select.select_features(df, "lasso", ["a"])
    select.save_selection(str(tmp_path / "s.json"), "acf", ["a"])
    assert trim.select_saved(df, str(tmp_path / "s.json")).columns == ["a"]


def test_schema_drift(spark):
    one = spark.createDataFrame([(1, 2.0)], "a long, b double")
    two = spark.createDataFrame([(1, 2.0)], "a int, c double")
    assert split.schema_drift({}) == []
    assert sorted(split.schema_drift({"d1": one, "d2": two})) == [("d2", "extra", "c"), ("d2", "missing", "b"), ("d2", "type", "a")]
