"""Operator 5: toxicity grades by cumulative-link ordinal regression over sparse words.

One weight vector serves all thresholds: P(grade >= k) = sigmoid(w.x - cut_k) with
cuts in rising order.  The features of a bounded sample of labelled rows are counted
on the executors and fitted on the driver; every document is scored in one pass over
its whole text without any shuffle.  Python serves the word loop; the fitted words
are shipped with the function, at most ``max_words`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, stash, table

#: Split at blanks and strip punctuation, digits and case: what is left of a word is a feature.
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalpha()) + "«»“”„‘’…¡¿—–"


def words(text: str | None) -> list[str]:
    return [w for x in (text or "").lower().split() if (w := x.strip(EDGE))]


def features(word: str) -> list[str]:
    """The word itself and its beginnings of three to five letters, which inflected forms share."""
    return [word, *("^" + word[:n] for n in (3, 4, 5) if len(word) >= n)]


def distinct(text: str | None) -> set[str]:
    return {f for w in set(words(text)) for f in features(w)}


@dataclass
class OrdinalModel:
    vocabulary: dict[str, int]
    weights: np.ndarray
    cuts: np.ndarray  # rising, one fewer than grades
    memo: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... as columns."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -500, 500)))

    def score(self, text: str | None) -> float:
        """Sum of the weights of the distinct known features."""
        known, memo, hit = self.vocabulary, self.memo, set()
        for w in set(words(text)):
            got = memo.get(w)
            if got is None:
                if len(memo) > 200_000:
                    memo.clear()
                got = memo[w] = tuple(known[f] for f in features(w) if f in known)
            hit.update(got)
        return float(sum(self.weights[i] for i in sorted(hit)))


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, grade: np.ndarray, n_words: int, grades: int, steps: int = 300, l1: float = 3e-5
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of the cumulative logit model, by full-batch Adam on the mean log-likelihood.

    Weights are never negative and pay ``l1``: words are evidence of severity or none,
    so a long clean text can neither hide an insult nor add up to one.  Cut gaps are
    exponentials, which keeps the cuts in order; grades that do not occur are allowed.
    """
    n = len(grade)
    share = np.clip([np.mean(grade >= k) for k in range(1, grades)], 1e-4, 1 - 1e-4)
    first = np.log(1 / share - 1)
    theta = np.concatenate([np.zeros(n_words), first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for t in range(1, steps + 1):
        w, gaps = theta[:n_words], np.exp(theta[n_words + 1 :])
        cuts = theta[n_words] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(rows, w[columns], n)
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        up, down = sig(z - edge[grade]), sig(z - edge[grade + 1])  # P(>= grade), P(>= grade + 1)
        p = np.maximum(up - down, 1e-12)
        du, dd = up * (1 - up), down * (1 - down)
        gz = -(du - dd) / p / n
        gcut = np.zeros(grades + 1)
        np.add.at(gcut, grade, du / p / n)
        np.add.at(gcut, grade + 1, -dd / p / n)
        gcut = gcut[1:-1]
        grad = np.concatenate([np.bincount(columns, gz[rows], n_words) + l1, [gcut.sum()], np.cumsum(gcut[::-1])[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        theta[:n_words] = np.maximum(theta[:n_words], 0)
    return theta[:n_words], theta[n_words] + np.concatenate([[0], np.cumsum(np.exp(theta[n_words + 1 :]))])


def fit_toxicity(
    labelled: DataFrame, max_rows: int = 10_000, max_words: int = 50_000, min_rows: int = 3, lift: float = 3.0, levels: int = 2
) -> OrdinalModel:
    """Fit on at most ``max_rows`` labelled rows (``doc_id, text, grade``), chosen by a hash of doc_id.

    The bound is on the rows that fit the model, never on those it scores.  A feature
    needs ``min_rows`` toxic rows and a share among them of ``lift`` times its share among
    all; of more than ``max_words`` those in most toxic rows are kept.  Where the labels
    know toxic rows of one grade only, a first fit ranks these by evidence and they get
    the grades 1 to ``levels`` in equal parts, so that severity is graded.  Rows with null
    grade are ignored; without any row, or with a single grade, nothing is toxic.
    """
    kept = labelled.where(F.col("grade").isNotNull()).select("doc_id", "text", F.col("grade").cast("int").alias("grade"))
    sample = kept.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(distinct(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("grade"), pa.array(found, pa.list_(pa.string()))], ["doc_id", "grade", "words"]
            )

    spread = stash(sample, "toxicity-sample").repartition(24)
    seen = stash(spread.mapInArrow(count, "doc_id long, grade int, words array<string>"), "toxicity-words")
    total = seen.agg(F.count("*").alias("n"), F.count_if(F.col("grade") > 0).alias("t")).first()
    vocabulary = [
        r.word
        for r in seen.select("grade", F.explode("words").alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"), F.count_if(F.col("grade") > 0).alias("t"))
        .where((F.col("t") >= min_rows) & (F.col("t") * F.lit(float(total["n"])) > lift * total["t"] * F.col("n")))
        .orderBy(F.desc("t"), "word").limit(max_words).collect()
    ]
    at = {w: i for i, w in enumerate(vocabulary)}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [[at[w] for w in x if w in at] for x in b.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("grade"), pa.array(ids, pa.list_(pa.int32()))], ["grade", "ids"])

    got = seen.mapInArrow(number, "grade int, ids array<int>").toArrow().combine_chunks()
    grade = got.column("grade").to_numpy().astype(int)
    if len(grade) == 0 or grade.max() == grade.min():
        return OrdinalModel({}, np.zeros(0), np.array([30.0]))
    lists = got.column("ids").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    rows = np.repeat(np.arange(len(grade)), sizes)
    order = np.lexsort((rows, lists.flatten().to_numpy()))  # the same sums whatever order the rows came in
    rows, columns = rows[order], lists.flatten().to_numpy()[order]
    if grade.max() == 1 and levels > 1:
        w, _ = fit_ordinal(rows, columns, grade, len(vocabulary), 2)
        evidence = np.bincount(rows, w[columns], len(grade))
        inner = np.quantile(evidence[grade > 0], np.arange(1, levels) / levels)
        grade = np.where(grade > 0, 1 + np.searchsorted(inner, evidence, "left"), 0)
    w, cuts = fit_ordinal(rows, columns, grade, len(vocabulary), int(grade.max()) + 1)
    used = np.flatnonzero(w)
    return OrdinalModel({vocabulary[i]: k for k, i in enumerate(used)}, w[used], cuts)


def score_toxicity(df: DataFrame, model: OrdinalModel, threshold: float = 0.5) -> DataFrame:
    """``doc_id, expected_severity, grade, p_toxic, rejected`` for each row of ``doc_id, text``.

    ``expected_severity`` is the mean grade, the sum of P(grade >= k); ``grade`` counts the
    thresholds that are more likely passed than not; ``rejected`` is P(grade >= 1) >=
    threshold.  Null and empty texts have score 0; repeated rows are scored alike; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([model.score(t) for t in b.column("text").to_pylist()])
            p = model.at_least(s) if len(s) else np.zeros((0, len(model.cuts)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(p.sum(1)), pa.array((p >= 0.5).sum(1).astype(np.int32)), pa.array(p[:, 0]), pa.array(p[:, 0] >= threshold)],
                ["doc_id", "expected_severity", "grade", "p_toxic", "rejected"],
            )

    return small_batches(df).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, expected_severity double, grade int, p_toxic double, rejected boolean"
    )


def drop_toxic(df: DataFrame, model: OrdinalModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that ``score_toxicity`` does not reject, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([model.score(t) for t in b.column("text").to_pylist()])
            if len(s):
                yield b.filter(pa.array(model.at_least(s)[:, 0] < threshold))

    return small_batches(df).mapInArrow(run, df.schema)


def marked(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` of the labels with an id and a mark: 1 if any of an id's labels says toxic, else 0."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 0, 0).otherwise(1)).alias("grade"))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """The rows to fit on, with grade 0 or 1: ids are sampled first, so the join meets no more of them than that.

    An id with several labels is toxic if any of them says so; rows that repeat an id
    each come with its grade.
    """
    few = marked(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(labelled_sample(docs, table(spark, sf_dir, "labels")))
    return score_toxicity(docs, model)
