"""Row positions and ordered windows over one long series, without a single-partition sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

POSITION = "_pos"
_BITS = 33  # monotonically_increasing_id keeps the row within its partition in this many low bits


def pinned(df: DataFrame) -> DataFrame:
    """``df`` fixed for several passes: a reliable checkpoint where a folder is set, else the block store."""
    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        df.sparkSession.sparkContext.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir"))
        return df.checkpoint()
    return df.persist()


def with_position(df: DataFrame, order_by: list[str], into: str = POSITION) -> DataFrame:
    """Zero-based position by ``order_by`` (make it unique): a range exchange, local sorts, and one count per partition.

    Only the counts come to the driver; they return as one array literal of offsets.
    """
    marked = pinned(df.repartitionByRange(*[F.col(f"`{c}`") for c in order_by]).sortWithinPartitions(*order_by).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", _BITS).cast("int")
    counts = {r.p: r.n for r in marked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    offset = F.get(F.split(F.lit(",".join(map(str, offsets)) or "0"), ",").cast("array<bigint>"), part)
    return marked.withColumn(into, F.col("_mid").bitwiseAND(F.lit((1 << _BITS) - 1)) + offset).drop("_mid")


def over_series(
    df: DataFrame,
    order_by: list[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    partition_by: list[str] | None = None,
    block: int = 25_000,
) -> DataFrame:
    """Add window columns to a series.

    With ``partition_by`` each series is a window partition.  A single global series is
    cut into blocks of positions instead; each block also sees the ``before`` rows ahead
    of it and the ``after`` rows behind it, so any frame within those bounds gives the
    result of one global window while blocks run in parallel.
    """
    if partition_by:
        return df.withColumns(columns(Window.partitionBy(*partition_by).orderBy(*order_by)))
    block = max(block, before, after, 1)
    placed = with_position(df, order_by)
    own = F.floor(F.col(POSITION) / block).cast("long")
    at = F.col(POSITION) % block
    halo = F.filter(
        F.array(own, F.when(at >= block - before, own + 1), F.when((at < after) & (own > 0), own - 1)), lambda b: b.isNotNull()
    )
    spread = placed.withColumn("_own", own).withColumn("_block", F.explode(halo) if before or after else own)
    w = Window.partitionBy("_block").orderBy(POSITION)
    return spread.withColumns(columns(w)).where("_own = _block").drop("_own", "_block", POSITION)
