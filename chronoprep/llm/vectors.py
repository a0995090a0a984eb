"""Operators 2 and 10: nearest neighbours by HNSW graphs, and exact top-k by vector-approximation files.

Both deal the distinct vectors into shards by a hash, send every query to every
shard, and let one task per shard build its structure and then stream the queries
past it in blocks, so a task holds one shard and one block.  Only the k best of a
shard for each query leave it; a window over (query, shards x k) merges them.

Equal vectors are folded first: a folded row keeps the smallest k + 1 ids, which
are all that any answer can hold, so a vector shared by a third of the rows costs
one place in one shard.  Python with numpy is used since graph walks and bound
checks are loops over dense arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

QUERY_BLOCK = 512


# ---------------------------------------------------------------- dealing and merging


def usable(df: DataFrame, zero: bool) -> DataFrame:
    """Rows ``vec_id, v`` (array of double) whose vector is whole and finite; ``zero`` keeps null vectors of length."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & (F.size(v) > 0)
    if not zero:
        fine &= F.exists(v, lambda x: x != 0)
    return df.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", v.alias("v"))


def folded(rows: DataFrame, keep: int) -> DataFrame:
    """``v, ids``: each distinct vector once, with its ``keep`` smallest ids.

    The hash of a vector stands for it while the smallest ids are ranked; ranks below the
    limit are cut off before the exchange, so a hot vector moves few rows.
    """
    few = rows.select("vec_id", "v").distinct().withColumn("mark", F.xxhash64("v"))
    number = F.row_number().over(Window.partitionBy("mark", "v").orderBy("vec_id"))
    few = few.withColumn("at", number).where(F.col("at") <= keep)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def searched(
    rows: DataFrame, is_query, k: int, shard_rows: int, build: Callable, score_type: str
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the queries among ``rows`` (``vec_id, v``) against all of them.

    ``build(matrix, ids, k)`` returns a function from a block of queries to
    ``(rows, scores)`` arrays, best first, -1 where there are fewer.
    Vectors of different lengths never meet: the length is part of the shard.
    """
    spark = rows.sparkSession
    sizes = {r.d: r.n for r in rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    schema = f"query_id long, vec_id long, score {score_type}"
    final = f"query_id long, rank int, vec_id long, score {score_type}"
    if not sizes:
        return spark.createDataFrame([], final)
    shards, first = {}, {}
    for d, n in sorted(sizes.items()):
        first[d] = sum(shards.values())
        shards[d] = max(1, -(-n // shard_rows))
    total = sum(shards.values())

    def of(d, values):
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), d)

    d = F.size("v")
    base = folded(rows, k + 1).select(
        (of(d, first) + F.pmod(F.xxhash64("v"), of(d, shards).cast("long")).cast("int")).alias("shard"),
        F.lit(0).alias("kind"), "ids", "v",
    )
    asked = rows.where(is_query).select(
        F.explode(F.sequence(of(d, first), of(d, first) + of(d, shards) - 1)).alias("shard"),
        F.lit(1).alias("kind"), F.array("vec_id").alias("ids"), "v",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        index = None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            split = int((kinds == 0).sum())  # the rows are sorted by kind
            if split:
                held.append(batch.slice(0, split))
            for at in range(split, len(kinds), QUERY_BLOCK):
                part = batch.slice(at, QUERY_BLOCK)
                if index is None:
                    if not held:
                        return
                    ids = [x for b in held for x in b.column("ids").to_pylist()]
                    matrix = np.concatenate([matrix_of(b) for b in held])
                    held.clear()
                    index = build(matrix, ids, k + 1)
                qid = [x[0] for x in part.column("ids").to_pylist()]
                found, score = index(matrix_of(part))
                out = [
                    (q, i, s)
                    for q, row, ss in zip(qid, found.tolist(), score.tolist())
                    for i, s in best(q, row, ss, ids, k)
                ]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in zip(*out)], schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64() if score_type == "long" else pa.float64())])
                    )

    dealt = base.unionByName(asked).repartitionById(total, F.col("shard")).sortWithinPartitions("kind")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        dealt.mapInArrow(run, schema)
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # rows that repeat an id are one
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def best(query: int, rows: list[int], scores: list, ids: list[list[int]], k: int) -> list[tuple[int, float]]:
    """The k best ids behind a list of folded rows: highest score, then smallest id, never the query's own."""
    out = [(-s, i) for r, s in zip(rows, scores) if r >= 0 for i in ids[r] if i != query]
    out.sort()
    return [(i, -s) for s, i in out[:k]]


def matrix_of(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("v")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


# ---------------------------------------------------------------- HNSW


class HNSW:
    """A navigable small-world hierarchy whose links are flat ``int32`` arrays, one per layer (-1: no link).

    Inner product becomes Euclidean distance by one more component that lifts every
    vector to the largest length.  Nodes enter a layer in batches: each searches the
    layer as it stands, sees the rest of its batch, and keeps diverse near links.
    """

    def __init__(self, matrix: np.ndarray, m: int = 16, ef: int = 64, seed: int = 7):
        length = np.einsum("ij,ij->i", matrix, matrix)
        top = length.max()
        scale = 1 / np.sqrt(top) if top > 0 and np.isfinite(top) else 1.0
        lift = np.sqrt(np.maximum(0, 1 - length * scale * scale))
        self.x = np.concatenate([matrix * scale, lift[:, None]], 1).astype(np.float32)
        self.m, self.ef = m, ef
        n = len(matrix)
        level = np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(m)).astype(int)
        self.order = np.argsort(-level, kind="stable")  # nodes of a layer are a prefix of those of the next one down
        self.x = self.x[self.order]
        level = level[self.order]
        self.layers: list[np.ndarray] = []  # top first
        for depth in range(int(level[0]), -1, -1):
            self.add_layer(int((level >= depth).sum()), 2 * m if depth == 0 else m)

    def add_layer(self, count: int, width: int) -> None:
        links = np.full((count, width), -1, np.int32)
        done = min(count, 1024)
        self.link(links, 0, done, np.broadcast_to(np.arange(done, dtype=np.int32), (done, done)))
        while done < count:
            size = min(count - done, done, 1024)
            block = self.x[done : done + size]
            near, _ = self.beam(block, links, self.enter(block), self.ef)
            own = self.nearest(block, np.arange(done, done + size), min(size, 24))
            self.link(links, done, size, np.concatenate([near, own], 1))
            done += size
        self.layers.append(links)

    def nearest(self, block: np.ndarray, pool: np.ndarray, k: int) -> np.ndarray:
        ip = block @ self.x[pool].T
        return pool[np.argpartition(-ip, k - 1, 1)[:, :k]].astype(np.int32)

    def link(self, links: np.ndarray, start: int, size: int, candidates: np.ndarray) -> None:
        nodes = np.arange(start, start + size)
        width = links.shape[1]
        for a in range(0, size, 256):
            links[nodes[a : a + 256]] = self.select(nodes[a : a + 256], candidates[a : a + 256], width)
        source = np.repeat(nodes, width)
        target = links[nodes].ravel()
        ok = target >= 0
        source, target = source[ok], target[ok]
        if not len(target):
            return
        close = np.einsum("ij,ij->i", self.x[source], self.x[target])
        by = np.lexsort((-close, target))
        source, target = source[by], target[by]
        heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        place = np.arange(len(target)) - np.repeat(heads, np.diff(np.r_[heads, len(target)]))
        few = place < width
        who = target[heads]
        back = np.full((len(who), width), -1, np.int32)
        row = np.cumsum(np.r_[True, target[1:] != target[:-1]]) - 1
        back[row[few], place[few]] = source[few]
        for a in range(0, len(who), 256):
            w = who[a : a + 256]
            links[w] = self.select(w, np.concatenate([links[w], back[a : a + 256]], 1), width)

    def select(self, nodes: np.ndarray, candidates: np.ndarray, width: int) -> np.ndarray:
        """Near candidates of which none is nearer to a chosen one than to the node; then the nearest of the rest."""
        c = np.where(candidates == nodes[:, None], -1, candidates)
        c = np.sort(c, 1)[:, ::-1]
        c = np.where(np.concatenate([np.zeros((len(c), 1), bool), c[:, 1:] == c[:, :-1]], 1), -1, c)
        near = np.einsum("id,ijd->ij", self.x[nodes], self.x[c]) if c.shape[1] <= 256 else self.x[nodes] @ self.x[c[0]].T if (c == c[0]).all() else self.pool_ip(nodes, c)
        near = np.where(c < 0, -np.inf, near)
        top = min(c.shape[1], 2 * width)
        by = np.argsort(-near, 1, kind="stable")[:, :top]
        c, near = np.take_along_axis(c, by, 1), np.take_along_axis(near, by, 1)
        v = self.x[c]
        among = np.matmul(v, v.transpose(0, 2, 1))
        chosen = np.zeros(c.shape, bool)
        for i in range(top):
            rival = np.where(chosen, among[:, i, :], -np.inf).max(1) if i else np.full(len(c), -np.inf)
            chosen[:, i] = (c[:, i] >= 0) & (near[:, i] >= rival) & (chosen.sum(1) < width)
        rank = np.where(chosen, 0, np.where(c >= 0, 1, 2)) * top + np.arange(top)
        pick = np.argsort(rank, 1)[:, :width]
        out = np.take_along_axis(c, pick, 1)
        if out.shape[1] < width:
            out = np.concatenate([out, np.full((len(out), width - out.shape[1]), -1, np.int32)], 1)
        return out.astype(np.int32)

    def pool_ip(self, nodes: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Inner products with the first 1024 nodes, looked up for each candidate."""
        ip = self.x[nodes] @ self.x[: c.max() + 1].T
        return np.take_along_axis(ip, np.maximum(c, 0), 1)

    def enter(self, block: np.ndarray) -> np.ndarray:
        """Start nodes for the layer below those that exist."""
        at = np.zeros((len(block), 1), np.int32)
        for links in self.layers:
            at, _ = self.beam(block, links, at, 4)
            at = np.maximum(at, 0)
        return at

    def beam(self, block: np.ndarray, links: np.ndarray, start: np.ndarray, ef: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` best nodes that a best-first walk finds for each row of ``block``, best first."""
        n, q = len(links), len(block)
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True  # -1 points there
        ids = np.full((q, ef), -1, np.int32)
        near = np.full((q, ef), -np.inf, np.float32)
        grown = np.ones((q, ef), bool)
        s = np.sort(start, 1)[:, :ef]
        s = np.where(np.concatenate([np.zeros((q, 1), bool), s[:, 1:] == s[:, :-1]], 1), -1, s)
        live = np.arange(q)
        fresh = s
        while True:
            ok = ~seen[live[:, None], fresh]
            fresh = np.where(ok, fresh, -1)
            seen[live[:, None], fresh] = True
            r, col = np.nonzero(fresh >= 0)
            dist = np.full(fresh.shape, -np.inf, np.float32)
            dist[r, col] = np.einsum("ij,ij->i", block[live[r]], self.x[fresh[r, col]])
            every = np.concatenate([near[live], dist], 1)
            by = np.argpartition(-every, ef - 1, 1)[:, :ef]
            near[live] = np.take_along_axis(every, by, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], fresh], 1), by, 1)
            grown[live] = np.take_along_axis(np.concatenate([grown[live], fresh < 0], 1), by, 1)
            open_ = np.where(grown[live], -np.inf, near[live])
            pick = np.argpartition(-open_, min(width, ef) - 1, 1)[:, : min(width, ef)]
            value = np.take_along_axis(open_, pick, 1)
            more = value.max(1) > -np.inf
            if not more.any():
                break
            live, pick, value = live[more], pick[more], value[more]
            grown[live[:, None], pick] = True
            node = np.where(value > -np.inf, ids[live[:, None], pick], -1)
            fresh = np.where((node >= 0)[:, :, None], links[node], -1).reshape(len(live), -1)
            fresh = np.sort(fresh, 1)
            fresh = np.where(np.concatenate([np.zeros((len(live), 1), bool), fresh[:, 1:] == fresh[:, :-1]], 1), -1, fresh)
        by = np.argsort(-near, 1, kind="stable")
        return np.take_along_axis(ids, by, 1), np.take_along_axis(near, by, 1)

    def search(self, queries: np.ndarray, k: int, ef: int) -> np.ndarray:
        """Rows of the given matrix, -1 where there are fewer than k."""
        q = np.concatenate([queries, np.zeros((len(queries), 1))], 1)
        length = np.sqrt(np.einsum("ij,ij->i", q, q))
        q = (q / np.where(length > 0, length, 1)[:, None]).astype(np.float32)
        at = np.zeros((len(q), 1), np.int32)
        for links in self.layers[:-1]:
            at = np.maximum(self.beam(q, links, at, 4)[0], 0)
        found = self.beam(q, self.layers[-1], at, max(ef, k))[0][:, :k]
        return np.where(found >= 0, self.order[found], -1)


def wide_enough(graph: HNSW, matrix: np.ndarray, k: int, ef: int, aim: float, probes: int = 64) -> int:
    """The search width, doubled until some rows of the shard find a share ``aim`` of their k nearest in it.

    Vectors of mixed length need far wider searches than clustered ones.
    """
    n = len(matrix)
    few = matrix[np.linspace(0, n - 1, min(n, probes)).astype(int)]
    k = min(k, n)
    # a row as near as the kth nearest is as good as it
    least = -np.partition(-(few @ matrix.T), k - 1, 1)[:, k - 1]
    while ef < n:
        found = graph.search(few, k, ef)
        score = np.einsum("qd,qkd->qk", few, matrix[found])
        if ((found >= 0) & (score >= least[:, None] - 1e-9 * np.abs(least[:, None]))).mean() >= aim:
            break
        ef *= 2
    return min(ef, max(n, k))


def hnsw_search(
    df: DataFrame, is_query, k: int = 20, m: int = 16, ef_build: int = 64, ef_search: int = 256, shard_rows: int = 16_384, aim: float = 0.97
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows found with the largest inner product.

    Input: ``vec_id, embedding``.  Null ids, and vectors that are null, empty, zero or
    hold null or non-finite components, take no part; rows that repeat an id with the
    same vector count once; vectors of another length are no candidates.  Scores are
    double sums over the original components; ties go to the smaller id.  Fewer than k
    candidates give fewer rows, an empty table none.  Each shard measures its own recall
    on a few of its rows and searches as widely as ``aim`` needs.
    """

    def build(matrix, ids, want):
        graph = HNSW(matrix, m, ef_build)
        width = wide_enough(graph, matrix, want, ef_search, aim)

        def search(queries):
            found = graph.search(queries, want, width)
            score = (queries[:, None, :] * matrix[found]).sum(2)
            return found, np.where(found >= 0, score, -np.inf)

        return search

    return searched(usable(df, zero=False), is_query, k, shard_rows, build, "double")


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# ---------------------------------------------------------------- vector-approximation file


class VAFile:
    """Cells of at most 16 values a component in one byte; exact rows are read in the order of their bounds."""

    def __init__(self, matrix: np.ndarray, ids: np.ndarray | None = None, cells: int = 16):
        self.exact = matrix  # whole numbers, which doubles hold exactly
        self.ids = np.arange(len(matrix)) if ids is None else ids  # ties go to the smaller one
        self.most = np.abs(matrix).max(initial=0.0)
        self.code = np.empty(matrix.shape, np.uint8)
        self.low, self.high = np.zeros((matrix.shape[1], cells)), np.zeros((matrix.shape[1], cells))
        for j, x in enumerate(matrix.T):
            code = np.searchsorted(np.quantile(x, np.linspace(0, 1, cells + 1)[1:-1]), x)
            self.code[:, j] = code
            for c in np.unique(code):
                own = x[code == c]
                self.low[j, c], self.high[j, c] = own.min(), own.max()

    def fits(self, queries: np.ndarray) -> bool:
        """Whether doubles hold every partial sum exactly."""
        return self.most * np.abs(queries).max(initial=0.0) * self.code.shape[1] < 2.0**53

    def scan(self, queries: np.ndarray, k: int, block: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``query, row, bound`` of the rows whose bound reaches the kth largest lower bound so far, and that lower bound."""
        up, down = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
        dims = np.arange(self.code.shape[1])
        # a sum of rounded products is off by less than this share of the sum of their sizes
        slack = 0.0 if self.fits(queries) else (len(dims) + 4) * 2.0**-51
        sure = np.full((len(queries), k), -np.inf)
        found = []
        for a in range(0, len(self.code), block):
            c = self.code[a : a + block]
            high, low = self.high[dims, c].T, self.low[dims, c].T
            above, below = up @ high + down @ low, up @ low + down @ high
            if slack:
                off = slack * (up - down) @ np.maximum(np.abs(high), np.abs(low))
                above, below = above + off, below - off
            sure = -np.partition(-np.concatenate([sure, below], 1), k - 1, 1)[:, :k]
            q, r = np.nonzero(above >= sure.min(1)[:, None])
            found.append((q.astype(np.int32), (r + a).astype(np.int32), above[q, r]))
        q, r, bound = (np.concatenate(x) for x in zip(*found))
        return q, r, bound, sure.min(1)

    def search(self, queries: np.ndarray, k: int, group: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best, ties to the smaller id: reading goes on until the kth score beats the next bound."""
        k = min(k, len(self.exact))
        # beyond the range of exact doubles the scores are Python's integers
        kind = np.int64 if self.fits(queries) else object
        rows, scores = np.full((len(queries), k), -1), np.zeros((len(queries), k), kind)
        for at in range(0, len(queries), group):
            part = queries[at : at + group]
            q, r, bound, sure = self.scan(part, k)
            near = bound >= sure[q]
            q, r, bound = q[near], r[near], bound[near]
            order = np.lexsort((-bound, q))
            edges = np.searchsorted(q[order], np.arange(len(part) + 1))
            for i in range(len(part)):
                own = order[edges[i] : edges[i + 1]]
                rows[at + i], scores[at + i] = self.read(part[i], r[own], bound[own], k, kind)
        return rows, scores

    def read(self, query: np.ndarray, rows: np.ndarray, bounds: np.ndarray, k: int, kind) -> tuple[np.ndarray, np.ndarray]:
        whole = np.frompyfunc(int, 1, 1) if kind is object else lambda x: x.astype(np.int64)
        query = whole(query)
        best, score, start, size = np.zeros(0, rows.dtype), np.zeros(0, kind), 0, max(2 * k, 32)
        # an equal bound may hide a tie
        while start < len(rows) and (len(score) < k or bounds[start] >= score[-1]):
            here = rows[start : start + size]
            best, score = np.concatenate([best, here]), np.concatenate([score, whole(self.exact[here]) @ query])
            by = np.lexsort((self.ids[best], -score)) if kind is not object else np.array(sorted(range(len(best)), key=lambda x: (-score[x], self.ids[best[x]])))
            best, score = best[by[:k]], score[by[:k]]
            start, size = start + size, min(2 * size, 4096)
        return best, score


def va_search(df: DataFrame, is_query, k: int = 5, shard_rows: int = 32_768) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products, exactly.

    Components become ``floor(256 x)``.  Null ids and vectors that are null, empty or hold
    null or non-finite components take no part; zero vectors do.  A score that a long
    cannot hold is an error, as it is in the SQL.  Ties go to the smaller id, however many
    rows tie; fewer candidates give fewer rows; vectors of another length are no candidates.
    """
    # from 2^52 on, a double is whole
    v = F.transform("v", lambda x: F.when(F.abs(x * 256) < 2.0**52, F.floor(x * 256).cast("double")).otherwise(x * 256))
    rows = usable(df, zero=True).select("vec_id", v.alias("v"))

    def build(matrix, ids, want):
        # rows in the order of score and smallest id: one beyond k can hold none of the k best ids but the query's own
        file = VAFile(matrix, np.array([x[0] for x in ids]))
        return lambda queries: file.search(queries, want)

    return searched(rows, is_query, k, shard_rows, build, "long")


def op10_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL = {
    "op10_va_file": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
}
