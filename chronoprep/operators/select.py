"""Feature selection: energy, autocorrelation, Granger, lasso, mutual information, shadow features."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .position import over_series


def energy(df: DataFrame, columns: list[str], level: float = 0.05) -> DataFrame:
    """``feature, energy, selected``: the largest raw autocorrelation of a series is its sum of squares."""
    wide = df.agg(*[F.sum(F.col(c).cast("double") * F.col(c)).alias(f"e{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"e{i}").alias("energy"), F.coalesce(F.col(f"e{i}") > level, F.lit(False)).alias("selected")) for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def acf(df: DataFrame, column: str, order_by: list[str], lags: int = 10) -> list[float]:
    """The centred, normalised autocorrelation at lags 1, 2, ...; a handful of sums in one pass."""
    mean = df.agg(F.avg(column)).first()[0]
    x = (F.col(column) - F.lit(mean)).alias("_x")
    lagged = over_series(df.select(*order_by, x), order_by, lambda w: {f"_l{k}": F.lag("_x", k).over(w) for k in range(1, lags + 1)}, before=lags)
    r = lagged.agg(F.sum(F.col("_x") * F.col("_x")).alias("v"), *[F.sum(F.col("_x") * F.col(f"_l{k}")).alias(f"c{k}") for k in range(1, lags + 1)]).first()
    return [(r[f"c{k}"] or 0.0) / r["v"] if r["v"] else 0.0 for k in range(1, lags + 1)]


def pacf(rho: list[float]) -> list[float]:
    """Partial autocorrelations from autocorrelations, by the Durbin-Levinson recursion."""
    out: list[float] = []
    phi: list[float] = []
    for k in range(1, len(rho) + 1):
        top = rho[k - 1] - sum(p * rho[k - 2 - j] for j, p in enumerate(phi))
        low = 1 - sum(p * rho[j] for j, p in enumerate(phi))
        last = top / low if low else 0.0
        phi = [p - last * q for p, q in zip(phi, reversed(phi))] + [last]
        out.append(last)
    return out


def granger(df: DataFrame, cause: str, effect: str, order_by: list[str], lags: int = 2) -> float:
    """F statistic that lags of ``cause`` improve a linear forecast of ``effect``, from one pass of cross products."""
    import numpy as np

    names = [f"_e{k}" for k in range(1, lags + 1)] + [f"_c{k}" for k in range(1, lags + 1)]
    lagged = over_series(
        df.select(*order_by, F.col(effect).cast("double").alias("_e"), F.col(cause).cast("double").alias("_c")), order_by,
        lambda w: {f"_{v}{k}": F.lag(f"_{v}", k).over(w) for k in range(1, lags + 1) for v in "ec"}, before=lags,
    ).na.drop()
    v = ["_one", *names, "_e"]
    lagged = lagged.withColumn("_one", F.lit(1.0))
    r = lagged.agg(F.count("*").alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"s{i}_{j}") for i, a in enumerate(v) for j, b in enumerate(v) if i <= j]).first()
    s = np.array([[r[f"s{min(i, j)}_{max(i, j)}"] for j in range(len(v))] for i in range(len(v))])

    def rest(cols):
        w = np.linalg.lstsq(s[np.ix_(cols, cols)], s[cols, -1], rcond=None)[0]
        return s[-1, -1] - w @ s[cols, -1]

    small, full = rest([0, *range(1, lags + 1)]), rest(list(range(2 * lags + 1)))
    free = r["n"] - 2 * lags - 1
    return float(max(0.0, (small - full) / lags / (full / free))) if full > 0 and free > 0 else math.inf


def elastic_net(df: DataFrame, features: list[str], target: str, alpha: float = 1.0, l1_ratio: float = 1.0, tolerance: float = 1e-9) -> list[str]:
    """Features with a weight, for the objective (1/2n)|y - Xw|^2 + alpha (l1 |w| + (1 - l1) |w|^2 / 2)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = VectorAssembler(inputCols=features, outputCol="_x").transform(df.select(*features, F.col(target).cast("double").alias("_y")).na.drop())
    model = LinearRegression(featuresCol="_x", labelCol="_y", regParam=alpha, elasticNetParam=l1_ratio, standardization=False, tol=1e-10, maxIter=1000).fit(rows)
    return [f for f, w in zip(features, model.coefficients) if abs(w) > tolerance]


def lasso(df: DataFrame, features: list[str], target: str, alpha: float = 1.0) -> list[str]:
    return elastic_net(df, features, target, alpha, 1.0)


def mutual_information(df: DataFrame, features: list[str], target: str, bins: int = 16) -> DataFrame:
    """``feature, mi`` in nats from equal-width histograms, a different estimator from nearest neighbours; one grouped pass."""
    cols = [*features, target]
    r = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("a", F.min), ("b", F.max))]).first()

    def bin_of(i, c):
        low, high = r[f"a{i}"], r[f"b{i}"]
        if low is None or low == high:
            return F.lit(0)
        return F.least(F.lit(bins - 1), F.floor((F.col(c) - low) / (high - low) * bins).cast("int"))

    y = bin_of(len(features), target)
    pairs = df.select(y.alias("y"), F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), bin_of(i, c).alias("x")) for i, c in enumerate(features)])).alias("e"))
    counts = pairs.where("y is not null and e.x is not null").groupBy("e.feature", "e.x", "y").agg(F.count("*").alias("n"))
    # at most bins x bins rows a feature from here on
    fx = counts.groupBy("feature", "x").agg(F.sum("n").alias("nx"))
    fy = counts.groupBy("feature", "y").agg(F.sum("n").alias("ny"))
    total = counts.groupBy("feature").agg(F.sum("n").alias("t"))
    joined = counts.join(fx, ["feature", "x"]).join(fy, ["feature", "y"]).join(total, "feature")
    p = F.col("n") / F.col("t")
    return joined.groupBy("feature").agg(F.sum(p * F.log(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny")))).alias("mi"))


def select_features(df: DataFrame, method: str, features: list[str], settings: dict | None = None, target: str | None = None, order_by: list[str] | None = None) -> list[str]:
    """The features that ``method`` keeps.

    ``acf`` and ``pacf`` keep those with an energy above ``significance_level``; with
    ``mode`` ``standard`` those with a true autocorrelation or partial one above it at some of
    ``lags``.  ``granger`` keeps those whose past improves a forecast of ``target`` by an F
    statistic above ``min_f``; ``lasso``, ``elastic_net``, ``mutual_info`` and ``boruta`` need a
    target too.  Any other method raises.
    """
    known = {"significance_level": 0.05, "mode": "energy", "lags": 10, "min_f": 3.84, "alpha": 1.0, "l1_ratio": 0.5, "k": 10, "rounds": 5} | (settings or {})
    if method not in ("acf", "pacf", "granger", "lasso", "elastic_net", "mutual_info", "boruta"):
        raise ValueError(f"unknown selection method: {method}")
    if method in ("acf", "pacf"):
        if known["mode"] == "standard":
            found = {f: acf(df, f, order_by, known["lags"]) for f in features}
            found = {f: pacf(r) for f, r in found.items()} if method == "pacf" else found
            return [f for f in features if max(map(abs, found[f]), default=0.0) > known["significance_level"]]
        kept = {r.feature for r in energy(df, features, known["significance_level"]).collect() if r.selected}
        return [f for f in features if f in kept]
    if target is None:
        raise ValueError(f"{method} needs a target")
    if method == "granger":
        return [f for f in features if granger(df, f, target, order_by, known.get("max_lag", 2)) > known["min_f"]]
    if method == "mutual_info":
        kept = {r.feature for r in top_mutual_information(df, features, target, known["k"]).collect()}
        return [f for f in features if f in kept]
    if method == "boruta":
        return shadow_forest(df, features, target, known["rounds"])
    return lasso(df, features, target, known["alpha"]) if method == "lasso" else elastic_net(df, features, target, known["alpha"], known["l1_ratio"])


def save_selection(path: str, method: str, selected: list[str]) -> None:
    """Write what ``select_saved`` reads."""
    import json

    with open(path, "w") as f:
        json.dump({"method": method, "selected_features": selected}, f)


def top_mutual_information(df: DataFrame, features: list[str], target: str, k: int = 10) -> DataFrame:
    """The k most informative features, least informative first."""
    return mutual_information(df, features, target).orderBy(F.desc("mi"), "feature").limit(k).orderBy("mi", "feature")


def shadow_forest(df: DataFrame, features: list[str], target: str, rounds: int = 5, depth: int = 5, seed: int = 42) -> list[str]:
    """All-relevant selection: features that beat the best shuffled copy in most of several forests.

    Shadows are the features of another row, paired by the order of two hashes, which needs
    one range sort for each round and no copy of the data on the driver.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from .position import POSITION, with_position

    rows = df.select(*features, F.col(target).cast("double").alias("_y")).na.drop()
    wins = dict.fromkeys(features, 0)
    for r in range(rounds):
        real = with_position(rows.withColumn("_k", F.xxhash64(F.lit(seed + r), *features, "_y")), ["_k", *features])
        other = with_position(rows.withColumn("_k", F.xxhash64(F.lit(-seed - r), *features, "_y")), ["_k", *features])
        shadow = other.select(POSITION, *[F.col(c).alias(f"_s_{c}") for c in features])
        both = real.join(shadow, POSITION)
        names = [*features, *[f"_s_{c}" for c in features]]
        rf = RandomForestRegressor(featuresCol="_x", labelCol="_y", maxDepth=depth, numTrees=20, seed=seed + r)
        w = rf.fit(VectorAssembler(inputCols=names, outputCol="_x").transform(both)).featureImportances.toArray()
        best = max(w[len(features) :])
        for f, x in zip(features, w):
            wins[f] += x > best
    return [f for f in features if wins[f] > rounds / 2]
