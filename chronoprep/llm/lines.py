"""Operator 9: line deduplication by winnowing over line hashes, in DataFrame functions only.

A unit of comparison is a run of lines: ``run`` lines, or one or two that are as long as a
passage together.  Winnowing keeps the line of the smallest hash of each unit as its
fingerprint, so equal units are certain to share one, and lines that are nobody's
smallest leave no row.  Fingerprints that occur at one place only go by a join on
positions; the others are extended both ways over the lines around them to every unit that
chose them, and units that also occur earlier are deleted; neighbouring units make up longer
runs.  Groups are reduced to a first position by partial aggregation, so no group meets
in one task and no pairs are formed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, stash, table

RUN = 3
PASSAGE = 250  # characters, some forty words
NO_ID = -(2**63)


def keyed(docs: DataFrame) -> DataFrame:
    """``key, mark, text``: rows with the same id are told apart by a hash of their text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("key"), F.xxhash64(text).alias("mark"), text.alias("text"))


def fingerprints(docs: DataFrame, run: int, passage: int) -> DataFrame:
    """``print, print2, key, mark, j, units``: each line that is the smallest of a unit, and the units that chose it.

    ``print`` and ``print2`` are the line's 128-bit hash, ``j`` its number among the lines
    that are not blank.  A unit has the places ``at`` of its lines in the document, and
    their 128-bit hash ``one``, ``two``.  Of equal lines in a unit the first is chosen.
    """
    numbered = F.transform(
        F.split("text", "\n", -1),
        lambda x, i: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"), i.alias("i"), x.rlike(r"\S").alias("full"), F.length(x).alias("n")),
    )
    lines = docs.select("key", "mark", F.filter(numbered, lambda x: x["full"]).alias("l"))

    def unit(j: Column, before: int, size: int) -> Column:
        """The unit of ``size`` lines with ``before`` of them ahead of line j, or null."""
        own = [F.get("l", j + (k - before)) for k in range(size)]
        fits = [F.lit(True), j >= before, j + (size - before) <= F.size("l")]
        fits += [own[before]["a"] < x["a"] for x in own[:before]] + [own[before]["a"] <= x["a"] for x in own[before + 1 :]]
        if size < run:
            fits.append(sum((x["n"] for x in own[1:]), own[0]["n"]) >= passage)
        whole = F.struct(
            F.array(*[x["i"] for x in own]).alias("at"), F.xxhash64(*[x["a"] for x in own]).alias("one"), F.xxhash64(F.lit(7), *[x["b"] for x in own]).alias("two")
        )
        return F.when(reduce(lambda x, y: x & y, fits), whole)

    def around(line: Column, j: Column) -> Column:
        units = [unit(j, before, size) for size in range(1, run + 1) for before in range(size)]
        return F.struct(line["a"].alias("print"), line["b"].alias("print2"), j.alias("j"), F.filter(F.array(*units), lambda u: u.isNotNull()).alias("units"))

    chosen = F.filter(F.transform("l", around), lambda x: F.size(x["units"]) > 0)
    return lines.select("key", "mark", F.explode(chosen).alias("w")).select("key", "mark", "w.*")


def repeated_lines(docs: DataFrame, run: int = RUN, passage: int = PASSAGE) -> DataFrame:
    """``key, mark, gone``: for each document with deletions, the zero-based places of the lines to delete."""
    every = stash(fingerprints(docs, run, passage), "line-fingerprints")
    place = F.struct("key", "mark", "j")
    prints = every.groupBy("print", "print2").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("print", "print2")
    seeds = every.join(stash(prints, "line-prints"), ["print", "print2"])
    units = stash(seeds.select("key", "mark", F.explode("units").alias("u")).select("key", "mark", "u.*"), "line-units")
    start = F.struct("key", "mark", F.element_at("at", 1).alias("start"))
    first = units.groupBy("one", "two").agg(F.min(start).alias("first"), F.max(start).alias("last")).where("first <> last").select("one", "two", "first")
    later = units.join(stash(first, "line-first"), ["one", "two"]).where(start != F.col("first"))
    return later.select("key", "mark", F.explode("at").alias("i")).groupBy("key", "mark").agg(F.collect_set("i").alias("gone"))


def dedup_lines(docs: DataFrame, run: int = RUN, passage: int = PASSAGE) -> DataFrame:
    """``docs`` with ``text`` cleaned, and the columns ``n_lines`` and ``n_removed``.

    A line goes if it lies in a run of ``run`` or more consecutive lines (blank lines
    are skipped over and kept) that all occur, in that order, at an earlier place:
    in a document with a smaller id, or earlier in the same one; a run of fewer lines does
    if it has ``passage`` or more characters in all.  Null texts count as empty.  Null ids come first; rows
    with the same id are ordered by a hash of their text, and rows equal in both are
    one document with the same result.  Columns of the input are kept as they are;
    an input that has ``n_lines`` or ``n_removed`` gets them replaced.
    """
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    key, mark, gone = (fresh(docs, c) for c in ("_key", "_mark", "_gone"))
    found = repeated_lines(keyed(docs), run, passage).withColumnsRenamed({"key": key, "mark": mark, "gone": gone})
    text = F.coalesce("text", F.lit(""))
    joined = docs.withColumns({key: F.coalesce("doc_id", F.lit(NO_ID)), mark: F.xxhash64(text)}).join(found, [key, mark], "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    cleaned = F.when(F.col(gone).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in own],
        cleaned.alias("text"),
        F.when(text == "", 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id", "n_lines", F.when(F.col("n_removed") > 0, F.col("n_removed")).otherwise(0).alias("n_removed"),
        F.length(text).cast("long").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"),
    )


SQL = {
    "op9_line_dedup": r"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM a),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM l WHERE regexp_matches(line, '\S')),
w AS (SELECT doc_id, n, line, i,
  lead(line, 1) OVER d AS line2, lead(line, 2) OVER d AS line3, lead(i, 1) OVER d AS i2, lead(i, 2) OVER d AS i3
  FROM f WINDOW d AS (PARTITION BY doc_id ORDER BY n)),
g AS (SELECT *, row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, n) AS seen FROM w WHERE line3 IS NOT NULL),
h AS (SELECT *, row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, n) AS seen FROM w WHERE length(line) + length(line2) >= 250),
o AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, n) AS seen FROM w WHERE length(line) >= 250),
gone AS (SELECT doc_id, unnest([i, i2, i3]) AS i FROM g WHERE seen > 1 UNION SELECT doc_id, unnest([i, i2]) FROM h WHERE seen > 1
  UNION SELECT doc_id, i FROM o WHERE seen > 1),
k AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text FROM l LEFT JOIN gone USING (doc_id, i)
  WHERE gone.i IS NULL GROUP BY l.doc_id),
c AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT a.doc_id, CASE WHEN a.text = '' THEN 0 ELSE len(a.lines) END::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS n_removed,
  length(coalesce(k.text, ''))::BIGINT AS kept_chars, sha256(coalesce(k.text, '')) AS kept_sha256
FROM a LEFT JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)
"""
}
