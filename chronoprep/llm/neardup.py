"""Operator 4: near-duplicate classes by BagMinHash signatures, bands and exact verification.

A document is the multiset of its five-word shingles.  Every (shingle, weight interval)
has Poisson processes that all documents share: an interval [0, 1), [1, 2), [2, 4), ...
of rate as wide as it is, whose points fall on a place inside the interval, halved down
level by level, and on a signature component.  A document of multiplicity w sees the
points below w; the smallest point per component is its signature, whose components
agree with probability equal to the weighted Jaccard similarity.

Exact copies are folded to one text first.  Texts that share a band form a bucket.  A
first pass compares each text with its buckets' leaders, which settles nearly all.  A
second pass takes the buckets that still hold texts of several classes and compares
signatures across classes, in blocks, and then one-permutation sketches, which estimate
the same similarity more closely; pairs for which both leave room for a link are
verified on the texts, the most alike of each text and class first, until no pair across
classes is left.  Classes are the connected components of the verified links.

Python computes shingles, signatures and their comparison (loops over words and random
processes, in slices of bounded bytes); grouping, leaders and components are DataFrame
operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import slices
from .common import discard, fresh, small_batches, stash, table

SHINGLE = 5
COMPONENTS = 125
ROWS = 5  # per band: at similarity 0.8 a pair meets in none of 25 bands with probability 5e-5
THRESHOLD = 0.8
#: Components that signatures must have in common for a pair to be verified: 25.5 below the mean at similarity 0.8,
#: 5.7 deviations, so that fewer than one link in 10^7 is turned away.
ALIKE = 75
SLICE_CHARS = 400_000
BINS = 512  # of a sketch
#: Standard deviations below the threshold at which a sketch turns a pair away.
SLACK = 5
BLOCK = 2048  # texts of a bucket that one group of comparisons holds
PAIRS = 1 << 17  # signature comparisons at once
SKETCHES = 1 << 14  # sketch comparisons at once
EDGES = 1 << 20  # edges whose components one task finds
CELL = 2000  # texts to a side of a cell in which pairs are verified

U = np.uint64
_PHI = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(texts: list[str], memo: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and the number of words of each text."""
    from xxhash import xxh3_64_intdigest

    sizes, out = [], []
    for t in texts:
        w = t.lower().split()
        sizes.append(len(w))
        try:
            out.append(np.array([memo[x] for x in w], U))
        except KeyError:
            if len(memo) > 60_000:
                memo.clear()
            for x in w:
                if x not in memo:
                    memo[x] = xxh3_64_intdigest(x)
            out.append(np.array([memo[x] for x in w], U))
    return (np.concatenate(out) if out else np.zeros(0, U)), np.array(sizes, np.int64)


def shingles(texts: list[str], memo: dict[str, int], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text number, shingle hash, multiplicity`` of the multisets; a text of fewer than n words is one shingle."""
    h, sizes = word_hashes(texts, memo)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    counts = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    doc = np.repeat(np.arange(len(texts)), counts)
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    acc = np.zeros(len(doc), U)
    with np.errstate(over="ignore"):
        for k in range(n):
            here = at + k < np.repeat(ends, counts)
            acc = mix(acc * _PHI + np.where(here, h[np.minimum(at + k, max(len(h) - 1, 0))], U(k)) + U(1))
    order = np.lexsort((acc, doc))
    doc, acc = doc[order], acc[order]
    if not len(doc):
        return doc, acc, np.zeros(0, np.int64)
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (acc[1:] != acc[:-1])])
    return doc[head], acc[head], np.diff(np.r_[head, len(doc)])


def bag_min_hash(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n_docs: int, m: int = COMPONENTS) -> np.ndarray:
    """Signatures (n_docs, m) of the multisets; rows of texts without shingles are zero.

    Processes run in rounds: a round draws the next point of every process that may
    still matter, i.e. whose last point is below the largest minimum of its document.
    """
    # the intervals [0, 1), [1, 2), [2, 4), ... that multiplicity reaches into
    levels = np.ceil(np.log2(weight)).astype(int) + 1 if len(weight) else np.zeros(0, int)
    src = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(src)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    width = np.where(level == 0, 1.0, low)
    with np.errstate(over="ignore"):
        state = mix(item[src] + mix(level.astype(U) + U(11)) * _PHI)
    owner, full = doc[src], weight[src].astype(float)
    x = np.zeros(len(src))
    low_sig = np.full(n_docs * m, np.inf)
    value = np.zeros(n_docs * m, U)
    while len(owner):
        with np.errstate(over="ignore"):
            state = state + _PHI
            r = mix(state)
            place = mix(state ^ U(0xD6E8FEB86659FD93))
        x = x - np.log(((r >> U(11)).astype(float) + 0.5) * 2.0**-53) / (width * m)
        part = (place % U(m)).astype(np.int64)
        # the place in the interval: each bit halves it once more
        spot = low + width * ((place >> U(11)).astype(float) * 2.0**-53)
        cell = owner * m + part
        own = np.flatnonzero((spot < full) & (x < low_sig[cell]))
        if len(own):
            own = own[np.lexsort((x[own], cell[own]))]
            c = cell[own]
            first = own[np.r_[True, c[1:] != c[:-1]]]
            low_sig[cell[first]] = x[first]
            value[cell[first]] = r[first]
        top = low_sig.reshape(n_docs, m).max(1)
        on = x < top[owner]
        state, owner, full, x, low, width = state[on], owner[on], full[on], x[on], low[on], width[on]
    return value.reshape(n_docs, m)


def sketch(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """One-permutation sketches (n_docs, BINS) of the multisets, as sets of numbered copies: each bin's smallest hash as a byte, 0 if it has none.

    Of the bins that either of two texts uses, the share with equal bytes estimates their
    similarity; it is exact where no two shingles meet in a bin.
    """
    src = np.repeat(np.arange(len(doc)), weight)
    copy = np.arange(len(src)) - np.repeat(np.cumsum(weight) - weight, weight)
    with np.errstate(over="ignore"):
        h = mix(item[src] + mix(copy.astype(U) + U(29)) * _PHI)
    low = np.full(n_docs * BINS, np.iinfo(U).max, U)
    np.minimum.at(low, doc[src] * BINS + (h % U(BINS)).astype(np.int64), h)
    short = np.where(low == np.iinfo(U).max, U(0), mix(low) % U(255) + U(1))
    return short.astype(np.uint8).reshape(n_docs, BINS)


def room(one: np.ndarray, two: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Whether sketches leave room for a link, ``mass`` being that of both texts together.

    The variance is that of one-permutation estimates at the threshold, given the bins in
    use; it is nothing where each shingle has a bin of its own.
    """
    same = ((one == two) & (one > 0)).sum(1)
    used = np.maximum(((one > 0) | (two > 0)).sum(1), 1)
    others = np.maximum(mass / (1 + THRESHOLD) - 1, 1)
    spread = THRESHOLD * (1 - THRESHOLD) * np.maximum((1 + 1 / others) / used - 1 / others, 0)
    return same / used >= THRESHOLD - SLACK * np.sqrt(spread) - 1e-9


def overlap(a: str, b: str, memo: dict[str, int]) -> float:
    """Weighted Jaccard similarity of two texts' shingle multisets."""
    doc, item, weight = shingles([a, b], memo)
    total = int(weight.sum())
    order = np.argsort(item, kind="stable")
    item, weight = item[order], weight[order]
    same = np.flatnonzero(item[1:] == item[:-1])
    both = int(np.minimum(weight[same], weight[same + 1]).sum())
    return both / (total - both) if total else 1.0


SIGNED = "rep long, mass long, sig binary, bands array<long>"


def signatures(texts: DataFrame) -> DataFrame:
    """``rep, mass, sig, bands`` of ``rep, text``: shingle mass, a byte for each component, and one hash per band with its number in it.

    Texts without shingles have no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        n_bands = COMPONENTS // ROWS
        for batch in batches:
            for part in slices(batch, "text", SLICE_CHARS):
                # of equal texts in the slice the one with the smallest id stands for all
                order = np.argsort(part.column("rep").to_numpy(), kind="stable")
                text = part.column("text").to_pylist()
                part = part.take(pa.array(sorted({text[i]: i for i in order[::-1].tolist()}.values())))
                doc, item, weight = shingles(part.column("text").to_pylist(), memo)
                sig = bag_min_hash(doc, item, weight, len(part))
                acc = np.broadcast_to(np.arange(n_bands, dtype=U), (len(part), n_bands)) + U(1)
                with np.errstate(over="ignore"):
                    for k in range(ROWS):
                        acc = mix(acc * _PHI + sig[:, k::ROWS])
                    short = (mix(sig) & U(255)).astype(np.uint8)
                mass = np.bincount(doc, weight, len(part)).astype(np.int64)
                full = mass > 0
                n = int(full.sum())
                hashes = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * n_bands, pa.int32()), pa.array(acc[full].ravel().view(np.int64)))
                bytes_ = pa.FixedSizeBinaryArray.from_buffers(pa.binary(COMPONENTS), n, [None, pa.py_buffer(short[full].tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(part.column("rep").to_numpy()[full]), pa.array(mass[full]), bytes_, hashes], ["rep", "mass", "sig", "bands"])

    return texts.mapInArrow(run, SIGNED)


def sketched(texts: DataFrame) -> DataFrame:
    """``rep, text`` with the sketch of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE_CHARS):
                rows = sketch(*shingles(part.column("text").to_pylist(), memo), len(part))
                bytes_ = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BINS), len(part), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("text"), bytes_], ["rep", "text", "sketch"])

    return texts.mapInArrow(run, "rep long, text string, sketch binary")


def matrix(column: pa.Array, width: int = COMPONENTS) -> np.ndarray:
    """Signatures or sketches as rows of bytes."""
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8) if len(column) else np.zeros(0, np.uint8)
    return flat.reshape(-1, width)


def sized(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether two masses allow the threshold at all."""
    return np.minimum(one, two) >= THRESHOLD * np.maximum(one, two) - 1e-9


def alike(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The ``leader, rep`` pairs whose masses and signatures leave room for a link."""
    of = lambda c: signed.select(F.col("rep").alias(c), F.col("mass").alias(f"{c}_mass"), F.col("sig").alias(f"{c}_sig"))
    both = pairs.join(of("rep"), "rep").join(of("leader"), "leader").select("leader", "rep", "leader_mass", "rep_mass", "leader_sig", "rep_sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fit = sized(b.column("leader_mass").to_numpy(), b.column("rep_mass").to_numpy())
            fit &= (matrix(b.column("leader_sig")) == matrix(b.column("rep_sig"))).sum(1) >= ALIKE
            yield b.select(["leader", "rep"]).filter(pa.array(fit))

    return both.mapInArrow(run, "leader long, rep long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``leader, rep`` pairs that exact multiset overlap confirms as links.

    Pairs lie in a square of cells by the hashes of their ends, with as many cells a side
    as keeps some thousand texts in each, and a text goes once to each cell that asks for it.
    """
    needed = stash(pairs.select(F.explode(F.array("leader", "rep")).alias("rep")).distinct(), "neardup-needed")
    side = max(8, -(-needed.count() // CELL))
    line = lambda c: F.pmod(F.xxhash64(c), F.lit(side).cast("long"))
    dealt = pairs.withColumn("cell", line("leader") * side + line("rep"))
    wants = dealt.select("cell", F.explode(F.array("leader", "rep")).alias("rep")).distinct()
    given = texts.select("rep", "text").join(wants, "rep").select("cell", F.lit(0).alias("kind"), "rep", F.lit(0).cast("long").alias("leader"), "text")
    asked = dealt.select("cell", F.lit(1).alias("kind"), "rep", "leader", F.lit("").alias("text"))
    rows = given.unionAll(asked).repartition("cell").sortWithinPartitions("cell", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        now, cell = None, Cell()
        for batch in batches:
            number, kind = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (kind[1:] != kind[:-1])]).tolist() if len(batch) else []
            for start, end in zip(edges, [*edges[1:], len(batch)]):
                part = batch.slice(start, end - start)
                if number[start] != now:
                    now, cell = number[start], Cell()
                if kind[start] == 0:
                    for few in slices(part, "text", SLICE_CHARS):
                        cell.add(few.column("rep").to_numpy(), *shingles(few.column("text").to_pylist(), memo))
                else:
                    near = cell.similarity(part.column("leader").to_numpy(), part.column("rep").to_numpy()) >= THRESHOLD
                    yield part.select(["leader", "rep"]).filter(pa.array(near))

    out = stash(rows.mapInArrow(run, "leader long, rep long"), "neardup-links")
    discard(needed)
    return out


class Cell:
    """Shingle multisets of some texts, to compare many pairs of them."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, rep: np.ndarray, doc: np.ndarray, item: np.ndarray, weight: np.ndarray) -> None:
        self.parts.append((rep, np.bincount(doc, minlength=len(rep)), item, weight))

    def index(self) -> None:
        rep, count, item, self.weight = (np.concatenate(x) for x in zip(*self.parts))
        self.parts = []
        kinds, self.column = np.unique(item, return_inverse=True)
        self.start = np.cumsum(count) - count
        self.count = count
        self.mass = np.bincount(np.repeat(np.arange(len(rep)), count), self.weight, len(rep))
        self.order = np.argsort(rep)
        self.rep = rep[self.order]
        self.mark = np.zeros(len(kinds), np.int64)

    def similarity(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        if self.parts:
            self.index()
        a, b = (self.order[np.searchsorted(self.rep, x)] for x in (one, two))
        by = np.argsort(a, kind="stable")
        heads = np.flatnonzero(np.r_[True, a[by][1:] != a[by][:-1]])
        both = np.zeros(len(a))
        for rows in np.split(by, heads[1:]):
            i = a[rows[0]]
            own = slice(self.start[i], self.start[i] + self.count[i])
            self.mark[self.column[own]] = self.weight[own]
            others = b[rows]
            n = self.count[others]
            at = np.repeat(self.start[others] - np.cumsum(n) + n, n) + np.arange(n.sum())
            both[rows] = np.bincount(np.repeat(np.arange(len(rows)), n), np.minimum(self.mark[self.column[at]], self.weight[at]), len(rows))
            self.mark[self.column[own]] = 0
        return both / np.maximum(self.mass[a] + self.mass[b] - both, 1)


def links(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """Verified ``leader, rep`` links between the distinct texts ``rep, text``, whose components are the classes.

    Of any two texts that share a bucket and reach the threshold, the components hold both.
    The leader of a bucket is its text that shares the most buckets with others, most
    often the original that the others were made from.
    """
    signed = stash(signatures(texts).join(reps, "rep", "left_semi").dropDuplicates(["rep"]), "neardup-signatures")
    member = signed.select("rep", F.explode("bands").alias("band"))
    sizes = stash(member.groupBy("band").agg((F.count("*") - 1).alias("others")).where("others > 0"), "neardup-buckets")
    member = stash(member.join(sizes, "band"), "neardup-members")
    degree = stash(member.groupBy("rep").agg(F.sum("others").alias("degree")), "neardup-degrees")
    # merged whatever the size, so that the cost of moving texts is in proportion to the input
    texts = stash(sketched(texts.join(degree.hint("merge"), "rep").groupBy("rep").agg(F.min("text").alias("text"))), "neardup-crowded")
    marks = signed.join(texts.select("rep", "sketch"), "rep")
    lead = member.join(degree, "rep").groupBy("band").agg(F.max(F.struct("degree", (-F.col("rep")).alias("last"))).alias("top"))
    lead = stash(lead.select("band", (-F.col("top.last")).alias("leader")), "neardup-leaders")
    pairs = member.join(lead, "band").where("rep <> leader").select(F.least("rep", "leader").alias("leader"), F.greatest("rep", "leader").alias("rep")).distinct()
    done = stash(alike(stash(pairs, "neardup-pairs"), signed), "neardup-alike")
    found = verified(done, texts)
    root = components(found)
    now = with_roots(member.select("band", "rep"), root)
    discard(sizes, degree, lead)
    take = 64
    while not now.isEmpty():
        across = stash(crossing(now, marks, take), "neardup-crossing")
        pairs = stash(across.select("leader", "rep").distinct().join(done, ["leader", "rep"], "left_anti"), "neardup-pairs")
        found, done = found.unionByName(verified(pairs, texts)), done.unionByName(pairs)
        root = components(found)
        open_ = across.where("more").select("band").distinct()
        now = with_roots(now.select("band", "rep").join(open_, "band", "left_semi"), root)
        take *= 1024
    discard(texts, signed, member)
    return found


def with_roots(member: DataFrame, root: DataFrame) -> DataFrame:
    """``band, rep, root, n, big`` of the buckets that hold several classes: texts in the bucket, and its largest class."""
    known = stash(member.join(root, "rep", "left").select("band", "rep", F.coalesce("root", "rep").alias("root")), "neardup-rooted")
    sizes = known.groupBy("band", "root").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("band").agg(F.count("*").alias("roots"), F.sum("n").alias("n"), F.max(F.struct("n", "root"))["root"].alias("big"))
    return stash(known.join(stash(sizes.where("roots > 1").drop("roots"), "neardup-mixed"), "band"), "neardup-now")


def crossing(now: DataFrame, marks: DataFrame, take: int) -> DataFrame:
    """``leader, rep, band, more``: pairs of a bucket across classes whose signatures and sketches leave room for a link.

    The texts outside a bucket's largest class are queries against all of the bucket,
    which is dealt in blocks, so no task holds more than a block and a batch of queries.
    For each query and class the ``take`` most alike texts of a block come out, each pair
    in the first of its common bands; ``more`` says that there are others.
    """
    rows = now.join(marks, "rep")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks.cast("long")).cast("int")
    columns = ("rep", "root", "big", "mass", "sig", "bands", "sketch")
    base = rows.select("band", own.alias("block"), F.lit(0).alias("kind"), *columns)
    asked = rows.where("root <> big").select("band", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(1).alias("kind"), *columns)
    dealt = base.unionByName(asked).repartition("band", "block").sortWithinPartitions("band", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = {c: batch.column(c).to_numpy() for c in ("band", "block", "kind", "rep", "root", "big", "mass")} | {"sig": matrix(batch.column("sig")), "sketch": matrix(batch.column("sketch"), BINS)}
            now["bands"] = batch.column("bands").flatten().to_numpy().reshape(-1, COMPONENTS // ROWS)
            if not len(now["rep"]):
                continue
            if held is not None:
                now = {c: np.concatenate([held[c], now[c]]) for c in now}
            head = np.r_[True, (now["band"][1:] != now["band"][:-1]) | (now["block"][1:] != now["block"][:-1])]
            group = np.cumsum(head) - 1
            first = np.flatnonzero(head)
            count = np.bincount(group, now["kind"] == 0).astype(np.int64)
            # queries whose answers have gone out already are not held, so all that are here are new
            yield from compared(now, np.flatnonzero(now["kind"] == 1), first[group], count[group], take)
            last = slice(first[-1], first[-1] + count[-1])
            held = {c: v[last] for c, v in now.items()}

    return dealt.mapInArrow(run, "leader long, rep long, band long, more boolean")


def compared(rows: dict, query: np.ndarray, first: np.ndarray, count: np.ndarray, take: int) -> Iterator[pa.RecordBatch]:
    upto = np.cumsum(count[query])
    at = 0
    while at < len(query):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        q = query[at:end]
        n = count[q]
        a = np.repeat(q, n)
        b = np.repeat(first[q] - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = end
        # two queries meet twice, once from either side
        fit = (rows["root"][a] != rows["root"][b]) & ((rows["root"][b] == rows["big"][b]) | (rows["rep"][a] < rows["rep"][b]))
        fit &= sized(rows["mass"][a], rows["mass"][b])
        a, b = a[fit], b[fit]
        agree = (rows["sig"][a] == rows["sig"][b]).sum(1)
        fit = agree >= ALIKE
        a, b, agree = a[fit], b[fit], agree[fit]
        few = [slice(i, i + SKETCHES) for i in range(0, len(a), SKETCHES)]
        fit = np.concatenate([np.zeros(0, bool), *(room(rows["sketch"][a[x]], rows["sketch"][b[x]], rows["mass"][a[x]] + rows["mass"][b[x]]) for x in few)])
        a, b, agree = a[fit], b[fit], agree[fit]
        # a pair comes out of the first band that it shares only
        fit = rows["bands"][a, (rows["bands"][a] == rows["bands"][b]).argmax(1)] == rows["band"][a]
        a, b, agree = a[fit], b[fit], agree[fit]
        if not len(a):
            continue
        order = np.lexsort((rows["rep"][b], -agree, rows["root"][b], a))
        a, b = a[order], b[order]
        head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (rows["root"][b][1:] != rows["root"][b][:-1])])
        size = np.diff(np.r_[head, len(a)])
        best = np.arange(len(a)) - np.repeat(head, size) < take
        more = np.repeat(size > take, size)[best]
        a, b = a[best], b[best]
        x, y = rows["rep"][a], rows["rep"][b]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(rows["band"][a]), pa.array(more)], ["leader", "rep", "band", "more"])


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of a partition's edges as ``rep, root`` rows, root being the smallest member; roots have none."""
    held = [(b.column("rep").to_numpy(), b.column("root").to_numpy()) for b in batches]
    if not held:
        return
    ends = np.concatenate([x for pair in zip(*held) for x in pair])
    nodes, at = np.unique(ends, return_inverse=True)
    one, two = at[: len(at) // 2], at[len(at) // 2 :]
    label = np.arange(len(nodes))
    while True:
        a, b = label[one], label[two]
        if (a == b).all():
            break
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (up := label[label]).tolist() != label.tolist():
            label = up
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], ["rep", "root"])


def components(edges: DataFrame) -> DataFrame:
    """``rep, root``: the smallest member of each connected component, for all other ends of ``leader, rep`` edges.

    Each round deals the edges by an end, so many to a partition, and replaces every partition's by its own
    components, which holds at most one row for a member and partition; then each root
    that is below another one in some partition passes that on.  It is over when there
    is one partition, or when every member has one root that is nobody's member.
    """
    forest = edges.select("rep", F.col("leader").alias("root"))
    while True:
        parts = max(1, -(-forest.count() // EDGES))
        dealt = forest.repartition(parts, "rep") if parts > 1 else forest.coalesce(1)
        forest = stash(dealt.mapInArrow(contract, "rep long, root long"), "component-forest")
        places = forest.select("rep").unionAll(forest.select(F.col("root").alias("rep")).distinct())
        if parts == 1 or places.groupBy("rep").count().where("count > 1").isEmpty():
            return forest
        above = forest.select(F.col("rep").alias("root"), F.col("root").alias("top"))
        forest = stash(forest.join(above, "root", "left").select("rep", F.coalesce("top", "root").alias("root")).unionAll(forest).distinct(), "component-edges")


def text_hash(text: str = "text") -> tuple[Column, Column]:
    """128 bits that stand for a text; blank texts differ by id."""
    blank = ~F.col(text).rlike(r"\S")
    return F.when(blank, F.col("doc_id")).otherwise(F.xxhash64(text)), F.when(blank, F.lit(0)).otherwise(F.xxhash64(F.lit(7), text))


def text_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, a, b, text_id, class_id, first_a, first_b`` for each row with an id: the hash of its text and of the class's first text.

    The first text of a class is that of the smallest id, and of these the smallest hash,
    so rows that repeat an id with different texts are judged each for itself.
    """
    docs = small_batches(docs)
    kept = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    a, b = text_hash()
    ids = stash(kept.select("doc_id", a.alias("a"), b.alias("b")), "neardup-ids")
    folded = stash(ids.groupBy("a", "b").agg(F.min("doc_id").alias("text_id")), "neardup-folded")
    if folded.groupBy("text_id").count().where("count > 1").isEmpty():
        folded = folded.withColumn("rep", F.col("text_id"))
        texts = kept.withColumnRenamed("doc_id", "rep")
    else:  # an id stands for its first text, a hash for each further one
        number = F.row_number().over(Window.partitionBy("text_id").orderBy("a", "b"))
        folded = stash(folded.withColumn("rep", F.when(number == 1, F.col("text_id")).otherwise(F.xxhash64(F.lit("again"), "text_id", "a", "b"))), "neardup-numbered")
        texts = kept.withColumns({"a": a, "b": b}).join(folded.withColumnRenamed("text_id", "doc_id"), ["doc_id", "a", "b"]).select("rep", "text")
    found = links(texts, folded.select("rep"))
    known = folded.join(components(found), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    known = stash(known, "neardup-known")
    first = known.groupBy("root").agg(F.min(F.struct("text_id", "a", "b")).alias("first"))
    known = known.join(stash(first, "neardup-firsts"), "root")
    known = known.select("a", "b", "text_id", F.col("first.text_id").alias("class_id"), F.col("first.a").alias("first_a"), F.col("first.b").alias("first_b"))
    return ids.join(stash(known, "neardup-classes"), ["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_id, class_id`` for each document.

    ``text_id`` is the smallest id of the documents with the very same text (by a 128-bit
    hash), ``class_id`` that of its class: documents connected by
    links of weighted Jaccard similarity of at least 0.8 between five-word shingle
    multisets.  A text of fewer than five words is one shingle of all its words; null and
    empty texts have no shingle and are each a class of their own, as are rows with a
    null id, which get null classes.  Rows that repeat an id are one row of the result; where
    their texts differ, each is linked by itself, and the id has the smallest class of them.
    """
    out = text_classes(docs).groupBy("doc_id").agg(F.min("text_id").alias("text_id"), F.min("class_id").alias("class_id"))
    nobody = F.lit(None).cast("long")
    return out.unionByName(docs.where(F.col("doc_id").isNull()).select(F.col("doc_id").cast("long"), nobody.alias("text_id"), nobody.alias("class_id")))


def first_of_classes(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the smallest id, then the smallest text hash.

    Rows with a null id stay.  Of rows equal in id and text one stays, the first by the other columns' hash.
    """
    known = text_classes(docs).where("doc_id = class_id and a = first_a and b = first_b").select("doc_id", "a", "b").groupBy("doc_id", "a", "b").agg(F.count("*").alias("n"))
    known = stash(known, "neardup-kept")
    names = [fresh(docs, x) for x in ("_a", "_b", "_n")]
    text = fresh(docs, "_text")
    rows = docs.where(F.col("doc_id").isNotNull()).withColumn(text, F.coalesce("text", F.lit("")))
    a, b = text_hash(text)
    rows = rows.withColumns({names[0]: a, names[1]: b}).join(known.toDF("doc_id", *names), ["doc_id", *names[:2]])
    if not known.where("n > 1").isEmpty():
        other = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])
        at = fresh(docs, "_at")
        rows = rows.withColumn(at, F.row_number().over(Window.partitionBy("doc_id", *names[:2]).orderBy(other))).where(F.col(at) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*columns).unionByName(docs.where(F.col("doc_id").isNull()).select(*columns))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
