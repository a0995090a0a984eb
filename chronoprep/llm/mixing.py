"""Operator 8: mixing to target weights with soft domain membership, in DataFrame functions only.

Measures of each text feed a classifier fitted on a labelled table (class-conditional
normal densities, one aggregation).  Its posteriors say how much of a document's tokens
belongs to each domain.  Nonnegative rates then solve

    min sum_k (sum_d rate_d tokens_d p_dk - target_k)^2,   rate >= 0,

and of all solutions the one nearest to rate 1 (by tokens).  The steps are projected
gradient steps in which the gradients add up first and the sum is projected: a document's
rate is max(0, 1 - sum_k step_k p_dk), so a handful of numbers describes all rates.  Steps
are scaled by the domains' overlap over documents above zero and shortened until the
objective falls enough.  Each needs one aggregation over a narrow table; nothing per
document is kept, nothing is shuffled but sums, and no key can be hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash, table

MEASURES = ("distinct", "letters", "capitals", "word_chars", "line_chars")


def measured(docs: DataFrame, *carry: str) -> DataFrame:
    """``doc_id, text_mark, tokens``, the measures of each text and the columns named; an empty text has no tokens."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    base = docs.select(
        "doc_id",
        F.xxhash64(text).alias("text_mark"),
        F.length(text).alias("chars"),
        F.size(words).alias("tokens"),
        F.size(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))).alias("kinds"),
        F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")).alias("no_capitals"),
        F.length(F.translate(text, "!\"#$%&'()*+-/0123456789:;<=>?@[\\]^_`{|}~", "")).alias("no_marks"),
        F.size(F.split(text, "\n", -1)).alias("lines"),
        *carry,
    )
    n, c = F.greatest("tokens", F.lit(1)), F.greatest("chars", F.lit(1))
    return base.select(
        "doc_id", "text_mark", F.col("tokens").cast("long"),
        (F.col("kinds") / F.sqrt(n)).alias("distinct"),
        (F.col("no_marks") / c).alias("letters"),
        ((F.col("chars") - F.col("no_capitals")) / c).alias("capitals"),
        F.least(F.col("chars") / n, F.lit(50.0)).alias("word_chars"),
        F.log1p(F.col("chars") / F.col("lines")).alias("line_chars"),
        *carry,
    )


@dataclass
class DomainModel:
    """For each domain its prior and, for each measure, mean and deviation."""

    domains: list[str]
    prior: list[float]
    mean: list[list[float]]
    deviation: list[list[float]]

    def posteriors(self) -> list[Column]:
        """P(domain | measures), one column expression for each domain."""
        if not self.domains:
            return []
        logs = []
        for prior, mean, dev in zip(self.prior, self.mean, self.deviation):
            z = [-0.5 * F.pow((F.col(m) - a) / s, F.lit(2.0)) - math.log(s) for m, a, s in zip(MEASURES, mean, dev)]
            logs.append(sum(z, F.lit(math.log(prior))))
        top = F.greatest(*logs) if len(logs) > 1 else logs[0]
        raised = [F.exp(x - top) for x in logs]
        total = sum(raised[1:], raised[0])
        return [x / total for x in raised]


def fit_domains(known: DataFrame, labelled: DataFrame) -> DomainModel:
    """Fit on the ``measured`` rows that have a ``domain`` in ``labelled`` (``doc_id, domain``).

    A document that several labels name counts once for each of its domains.
    """
    stats = (
        known.join(labelled.where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull()).distinct(), "doc_id").where("tokens > 0")
        .groupBy("domain").agg(F.count("*").alias("n"), *[f(m).alias(f"{p}_{m}") for m in MEASURES for p, f in (("mean", F.avg), ("dev", F.stddev_pop))])
        .orderBy("domain").collect()
    )
    n = sum(r["n"] for r in stats)
    spread = [max(1e-3, max([r[f"dev_{m}"] for r in stats], default=0) * 0.05) for m in MEASURES]
    return DomainModel(
        [r["domain"] for r in stats],
        [r["n"] / n for r in stats],
        [[r[f"mean_{m}"] for m in MEASURES] for r in stats],
        [[max(r[f"dev_{m}"], s) for m, s in zip(MEASURES, spread)] for r in stats],
    )


def solved(a: list[list[float]], b: list[float]) -> list[float]:
    """Solve a small linear system by elimination."""
    n = len(b)
    m = [[*a[i], b[i]] for i in range(n)]
    for i in range(n):
        k = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[k] = m[k], m[i]
        for r in range(n):
            if r != i:
                f = m[r][i] / m[i][i]
                m[r] = [x - f * y for x, y in zip(m[r], m[i])]
    return [m[i][n] / m[i][i] for i in range(n)]


@dataclass
class Sums:
    """What the solver needs to know of all documents at some steps: shares of all tokens."""

    square: float  # of the rates
    reached: list[float]  # expected tokens of each domain
    overlap: list[list[float]]  # of the domains, over documents whose rate is above zero
    low: float | None  # smallest rate of a document with tokens


def solve(weights: list[float], measure: Callable[[list[list[float]]], list[Sums]], rounds: int = 60, tolerance: float = 1e-11) -> tuple[list[float], list[float], Sums]:
    """The summed steps, the targets, and the sums at the end.

    ``weak`` is the weight of the distance from rate 1 beside the squared error; it
    ends where the targets are met, or at 1e-14, which leaves the error within a millionth
    of the total from the least one.  The objective in the steps is convex with a gradient of targets less totals, so shortened steps
    along its scaled gradient always arrive; they stop where the gradient vanishes.
    """
    n = len(weights)
    at = [0.0] * n
    here = measure([at])[0]
    total = max([here.reached[i] / weights[i] for i in range(n) if weights[i] > 0], default=0.0)
    target = [total * w for w in weights]

    def value(x: list[float], s: Sums, weak: float) -> float:
        return 0.5 * s.square + sum(a * t + 0.5 * weak * a * a for a, t in zip(x, target))

    for weak in (1e-3, 1e-6, 1e-9, 1e-12, 1e-14):
        if sum((r - t) ** 2 for r, t in zip(here.reached, target)) <= (1e-9 * total) ** 2:
            break
        for _ in range(rounds):
            slope = [t - r + weak * a for t, r, a in zip(target, here.reached, at)]
            if max(map(abs, slope), default=0.0) <= tolerance * max(1.0, total):
                break
            curved = [[x + (weak if i == j else 0.0) for j, x in enumerate(row)] for i, row in enumerate(here.overlap)]
            move = [-x for x in solved(curved, slope)]
            fall = sum(a * b for a, b in zip(slope, move))
            now, step, best = value(at, here, weak), 1.0, None
            while best is None and step > 1e-12:
                sizes = [step] if step == 1.0 else [step * 0.5**i for i in range(8)]
                spots = [[a + size * b for a, b in zip(at, move)] for size in sizes]
                for size, spot, s in zip(sizes, spots, measure(spots)):
                    if best is None and value(spot, s, weak) <= now + 1e-4 * size * fall:
                        best = (spot, s)
                step = sizes[-1] / 2
            if best is None:  # nothing left to gain at this precision
                break
            at, here = best
    return at, target, here


def rates(soft: DataFrame, p: list[str], weights: list[float]) -> tuple[Column, list[float], list[float]]:
    """``rate`` as a column over ``tokens`` and the posterior columns ``p``; the targets; the totals reached.

    The total is the least at which no domain falls below what it has; if single documents
    still end a little below rate 1 (by a tenth at most), all rates and targets are raised
    by that factor, so that mixing repeats documents rather than losing some.
    """
    k = range(len(p))
    tokens = F.col("tokens").cast("double")
    every = float(soft.agg(F.sum("tokens")).first()[0] or 1)

    def rate_at(steps: list[float]) -> Column:
        return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.col(c) * F.lit(x) for c, x in zip(p, steps)), F.lit(0.0)))

    def measure(spots: list[list[float]]) -> list[Sums]:
        known = soft.where("tokens > 0").select(tokens.alias("w"), *p, *[rate_at(x).alias(f"r{n}") for n, x in enumerate(spots)])
        sums = []
        for n in range(len(spots)):
            r, w = F.col(f"r{n}"), F.col("w")
            sums += [F.sum(w * r * r).alias(f"s{n}"), F.min(r).alias(f"low{n}"), *[F.sum(w * r * F.col(p[i])).alias(f"t{n}_{i}") for i in k]]
            sums += [F.sum(F.when(r > 0, w * F.col(p[i]) * F.col(p[j]))).alias(f"g{n}_{i}_{j}") for i in k for j in k if i <= j]
        got = known.agg(*sums).first()
        share = lambda x: float(x or 0.0) / every
        return [
            Sums(share(got[f"s{n}"]), [share(got[f"t{n}_{i}"]) for i in k], [[share(got[f"g{n}_{min(i, j)}_{max(i, j)}"]) for j in k] for i in k], got[f"low{n}"])
            for n in range(len(spots))
        ]

    steps, target, end = solve(weights, measure)
    rate, up = rate_at(steps), every
    if end.low is not None and 0.9 <= end.low < 1:
        rate, up = rate / F.lit(end.low), every / end.low
    return F.when(F.col("tokens") > 0, rate).otherwise(1.0), [x * up for x in target], [x * up for x in end.reached]


def plan(docs: DataFrame, labelled: DataFrame, weights: dict[str, float]) -> tuple[DomainModel, Column, DataFrame]:
    """The fitted model, the rate column over its posteriors, and the measured documents."""
    known = stash(measured(docs.select("doc_id", "text")), "mixing-measures")
    model = fit_domains(known, labelled.select("doc_id", "domain"))
    share = [max(0.0, weights.get(d, 0.0)) for d in model.domains]
    rate = F.lit(1.0)
    if sum(share) > 0:
        rate, _, _ = rates(with_posteriors(known, model), posterior_names(model), [x / sum(share) for x in share])
    return model, rate, known


def posterior_names(model: DomainModel) -> list[str]:
    return [f"p_{d}" for d in model.domains]


def with_posteriors(known: DataFrame, model: DomainModel, *carry: str) -> DataFrame:
    return known.select("doc_id", "text_mark", "tokens", *[x.alias(n) for n, x in zip(posterior_names(model), model.posteriors())], *carry)


def with_copies(soft: DataFrame, rate: Column) -> DataFrame:
    """``rate``, and ``copies``: the rate rounded up or down by a hash of id and text, so that its expectation is the rate."""
    dice = F.pmod(F.xxhash64(F.lit("mixing"), "doc_id", "text_mark"), F.lit(1 << 40)) / float(1 << 40)
    return soft.withColumn("rate", rate).withColumn("copies", F.floor(F.col("rate") + dice).cast("int"))


def mix_domains(docs: DataFrame, labelled: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``doc_id, text_mark, tokens, p_<domain>..., rate, copies``: one row for each document.

    ``labelled`` has ``doc_id, domain``; ``weights`` gives the wanted share of tokens of each
    domain (scaled to 1; a labelled domain without weight gets none).  Documents without
    tokens, and all if no label matches, have rate 1.  Null ids are kept; rows that repeat
    have equal results; columns beside ``doc_id, text`` are ignored.
    """
    model, rate, known = plan(docs, labelled, weights)
    return with_copies(with_posteriors(known, model), rate)


def repeated(docs: DataFrame, labelled: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_domains`` says, without moving any text."""
    model, rate, _ = plan(docs, labelled, weights)
    rows = measured(docs.select("doc_id", "text", F.struct("*").alias("row")), "row")
    # the filter on copies would be pushed down with all measures written out in it; it cannot pass a generator
    once = F.explode(F.array(F.struct("tokens", *MEASURES)))
    rows = rows.select("row", "doc_id", "text_mark", once.alias("m")).select("row", "doc_id", "text_mark", "m.*")
    chosen = with_copies(with_posteriors(rows, model, "row"), rate).where("copies > 0")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


#: Wanted shares of tokens by labelled quality.
WEIGHTS = {"good": 0.9, "poor": 0.1}


def quality_domains(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality").isNotNull()).select("doc_id", F.when(F.col("quality") > 0, "good").otherwise("poor").alias("domain"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_domains(table(spark, sf_dir, "documents"), quality_domains(table(spark, sf_dir, "labels")), WEIGHTS)
    return out.drop("text_mark")
