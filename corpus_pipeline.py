"""From raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that go on, with
the columns of ``documents`` (the last one: token ids).  Whoever runs them writes each
result as Parquet and reads it back before the next stage, as ``run`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoprep.llm import bpe, lines, mixing, neardup, toxicity
from chronoprep.llm.common import stash, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, does not reject.

    Null and empty texts and rows with a null id stay; without labels all do.  Rows that repeat are judged alike.
    """
    model = toxicity.fit_toxicity(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines; those of which nothing is left go.

    Texts that were null, empty or blank before stay.  Rows equal in id and text are one
    place and stay alike.  ``n_chars`` follows the text where lines went.
    """
    out = lines.dedup_lines(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the smallest id.

    Rows that repeat an id with different texts are judged each for itself; rows equal in
    id and text are one.  Rows with a null id stay, and blank texts are no copies.
    """
    return neardup.first_of_classes(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the expected share of tokens of each quality domain meets its weight.

    Rows without tokens, and all if no label matches, stay once.  Equal rows have equal numbers of copies.
    """
    labelled = mixing.quality_domains(table(spark, sf_dir, "labels"))
    return mixing.repeated(docs, labelled, mixing.WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256``: the ids of each whole text, and the digest of what they decode to.

    Null and empty texts have no ids; rows stay as often as they come.
    """
    import public_tokenizers

    out = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("encoding", encode),
]

#: Fitted models, signatures and merges have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
