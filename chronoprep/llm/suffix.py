"""Operator 3: exact repeated-substring removal with a run-length suffix index.

Every 100-byte string belongs to the position of its smallest 24-byte hash, so equal
strings belong to equal minimisers.  Consecutive strings with the same minimiser form
a window, the unit that is dealt: about one window for 39 bytes of text.

1. Windows are dealt by minimiser.  Equal windows fold to the first one; the others are
   repeats as a whole.  Minimisers with a single distinct window are settled, and so are
   strings whose stretch about the minimiser no other window of it has: a string that
   reaches d bytes before the minimiser contains all that strings with a like d have in
   common, and a few bits of the hash of that, for four ranges of d, come with the window.
2. What is left of the distinct windows is cut out of the texts and dealt to blocks.  Each block gets a run-length index: a run-compressed Burrows-Wheeler
   transform with the suffix positions sampled at run ends.  All windows stream through
   it backwards by LF steps; the rank gives each 100-byte string the interval of its
   matches, and a string whose interval starts earlier in the corpus is a repeat.
   Minimisers with very many distinct windows (edges of a passage that many texts share)
   are dealt string by string instead, so that no task gets them all; equal strings fold
   before they are dealt.
3. Repeats meet their document once more, which loses the bytes they cover.

numpy does the byte arithmetic in slices of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, stash, table

LENGTH = 100
GRAM = 24
PIECE = 1 << 19  # bytes hashed at once; far below the 2^24 places that fit beside a 40-bit hash
BLOCK = 1 << 18  # bytes indexed at once, few enough for a processor's cache
CROWD = 2000  # distinct windows of a minimiser beyond which its strings are dealt singly
REACH = LENGTH - GRAM  # most bytes of a string before its minimiser
RANGES = [(0, 18), (19, 37), (38, 56), (57, REACH)]  # of the bytes before the minimiser
BITS = 14  # of the hash of what the strings of a range have in common
NO_ID = -(2**63)

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(32))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(29))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        with np.errstate(over="ignore"):
            got = np.cumprod(np.concatenate([[U(1)], np.full(max(n, PIECE + 4 * LENGTH), U(base))]), dtype=U)
        _powers[base] = got
    return got[:n]


class Hashes:
    """Hashes of any substring of a byte array, from prefix sums modulo 2^64."""

    def __init__(self, b: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([[U(0)], np.cumsum((b.astype(U) + U(1)) * powers(BASE, len(b)), dtype=U)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * powers(INVERSE, len(self.sums))[start])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (w - have)], x[w - have :]) if have < w else x


def windows_of(b: np.ndarray, doc_start: np.ndarray) -> tuple[np.ndarray, ...]:
    """``minimiser, content, common, start, count`` of the windows of concatenated texts.

    A window of ``count`` strings covers bytes ``start .. start + count - 1 + LENGTH``.
    ``common`` holds the minimiser's distance from ``start`` and, for each of ``RANGES``
    that the window has strings of, hash bits of the bytes that they all contain.
    """
    none = (np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    n = len(b)
    if n < LENGTH:
        return none
    h = Hashes(b)
    at = np.arange(n - GRAM + 1)
    gram = h.of(at, at + GRAM)
    key = (gram & U(0xFFFFFFFFFF000000)) | at.astype(U)
    low = sliding_min(key, LENGTH - GRAM + 1)  # one for each string
    least = (low & U(0xFFFFFF)).astype(np.int64)
    number = np.zeros(n, np.int32)
    number[doc_start[(doc_start > 0) & (doc_start < n)]] = 1
    number = np.cumsum(number)
    inside = number[: len(least)] == number[LENGTH - 1 :]
    p = np.flatnonzero(inside)
    if not len(p):
        return none
    m = least[p]
    head = np.flatnonzero(np.r_[True, (m[1:] != m[:-1]) | (p[1:] != p[:-1] + 1)])
    start = p[head]
    count = np.diff(np.r_[head, len(p)])
    m = m[head]
    common = m - start
    for j, has in enumerate(in_range(common, count)):
        low, high = RANGES[j]
        at = m[has]
        common[has] |= (h.of(at - low, at - high + LENGTH) >> U(64 - BITS)).astype(np.int64) << (7 + BITS * j)
    return gram[m], h.of(start, start + count - 1 + LENGTH) + count.astype(U), common, start, count


def in_range(before: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """For each of ``RANGES``, the windows with strings of it; the first string of a window has ``before`` bytes before the minimiser."""
    return [np.flatnonzero((before >= low) & (before - count < high)) for low, high in RANGES]


def pieces(texts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Concatenated bytes of texts, up to a bounded size, with the row, offset in the row's text, and start of each part.

    Long texts come in parts that overlap by one byte less than a string.
    """
    held, rows, offs, starts, size = [], [], [], [], 0
    for i, t in enumerate(texts):
        raw = np.frombuffer(t, np.uint8)
        for a in range(0, max(1, len(raw) - LENGTH + 1), PIECE // 2):
            part = raw[a : a + PIECE // 2 + LENGTH - 1]
            if size and size + len(part) > PIECE:
                yield np.concatenate(held), np.array(rows), np.array(offs), np.array(starts)
                held, rows, offs, starts, size = [], [], [], [], 0
            held.append(part)
            rows.append(i)
            offs.append(a)
            starts.append(size)
            size += len(part)
    if held:
        yield np.concatenate(held), np.array(rows), np.array(offs), np.array(starts)


def emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of each slice, equal ones folded to the ``fresh`` first; the others are repeats, in longer runs, dealt by their document."""
    for batch in batches:
        key, mark = batch.column("key").to_numpy(), batch.column("mark").to_numpy()
        texts = (x.as_buffer() for x in batch.column("text"))
        for b, rows, offs, starts in pieces(texts):
            h, c, common, s, count = windows_of(b, starts)
            part = np.searchsorted(starts, s, "right") - 1
            row = rows[part]
            place = s - starts[part] + offs[part]
            k, m = key[row], mark[row]
            order = np.lexsort((place, m, k, c, h))
            h, c, common, k, m, place, count = h[order], c[order], common[order], k[order], m[order], place[order], count[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])] if len(h) else np.zeros(0, bool)
            k2, m2, place2 = longer(k[~new], m[~new], place[~new], count[~new])
            zero = np.zeros(len(k2), np.int64)
            columns = (
                np.r_[h[new].view(np.int64), k2 ^ m2], np.r_[c[new].view(np.int64), zero], np.r_[common[new], zero],
                np.r_[k[new], k2], np.r_[m[new], m2], np.r_[place[new] * 256 + count[new], place2], np.r_[np.ones(int(new.sum()), bool), zero > 0],
            )
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "c", "common", "key", "mark", "place", "fresh"])


def longer(k: np.ndarray, m: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``key, mark, place`` of windows, those that follow each other joined to runs of up to 255 strings."""
    order = np.lexsort((start, m, k))
    k, m, start, count = k[order], m[order], start[order], count[order]
    if not len(k):
        return k, m, start
    chain = np.r_[True, (k[1:] != k[:-1]) | (m[1:] != m[:-1]) | (start[1:] != start[:-1] + count[:-1])]
    stretch = (start - start[np.flatnonzero(chain)[np.cumsum(chain) - 1]]) // (255 - REACH)
    head = np.flatnonzero(chain | np.r_[True, stretch[1:] != stretch[:-1]])
    return k[head], m[head], start[head] * 256 + np.add.reduceat(count, head)


WINDOW = "h long, c long, common long, key long, mark long, place long, fresh boolean"


def groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], least: int = 1) -> Iterator[dict[str, np.ndarray]]:
    """Rows sorted by ``h``, in blocks of about ``least`` rows or more that hold whole groups of ``h``."""
    held: dict[str, list] = {c: [] for c in columns}
    n = 0
    for batch in batches:
        if not len(batch):
            continue
        h = batch.column("h").to_numpy()
        n += len(h)
        last = int(np.searchsorted(h, h[-1]))  # the last group may go on
        if not last or n < least:
            last = 0
        for c in columns:
            x = batch.column(c).to_numpy(zero_copy_only=False)
            held[c].append(x[:last] if last else x)
        if last:
            yield {c: np.concatenate(v) for c, v in held.items()}
            held = {c: [batch.column(c).to_numpy(zero_copy_only=False)[last:]] for c in columns}
            n = len(h) - last
    if held["h"]:
        yield {c: np.concatenate(v) for c, v in held.items()}


def alike(group: np.ndarray, common: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(window, place)`` of the strings that another window of the same group may hold, in runs.

    Equal strings lie alike about the minimiser, so they are of the same range and contain the same bytes of it.
    """
    before, count = common & 127, place & 255
    share = np.zeros((len(group), len(RANGES) + 2), bool)
    for j, has in enumerate(in_range(before, count)):
        key = group[has] << BITS | (common[has] >> (7 + BITS * j)) & ((1 << BITS) - 1)
        _, back, n = np.unique(key, return_inverse=True, return_counts=True)
        share[has, j + 1] = n[back] > 1
    w, first = np.nonzero(share[:, 1:-1] & ~share[:, :-2])
    _, last = np.nonzero(share[:, 1:-1] & ~share[:, 2:])
    low, high = np.array(RANGES).T
    least, most = np.maximum(low[first], before[w] - count[w] + 1), np.minimum(high[last], before[w])
    return w, ((place[w] >> 8) + before[w] - most) * 256 + most - least + 1


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold equal windows and settle unlike ones.

    ``crowd`` 0 is a repeat as a whole; otherwise the row is a run of strings that another window of the minimiser may
    hold, and ``crowd`` the number of distinct windows that have such.
    """
    for g in groups(batches, ("h", "c", "common", "key", "mark", "place", "fresh"), 50_000):
        known = {c: v[~g["fresh"]] for c, v in g.items()}
        g = {c: v[g["fresh"]] for c, v in g.items()}
        order = np.lexsort((g["place"], g["mark"], g["key"], g["c"], g["h"]))
        g = {c: v[order] for c, v in g.items()}
        h, c = g["h"], g["c"]
        same_h = np.r_[False, h[1:] == h[:-1]][: len(h)]
        first = ~(same_h & np.r_[False, c[1:] == c[:-1]][: len(h)])
        same_place = np.r_[False, (g["key"][1:] == g["key"][:-1]) & (g["mark"][1:] == g["mark"][:-1]) & (g["place"][1:] == g["place"][:-1])][: len(h)] & ~first
        number = np.cumsum(~same_h) - 1
        whole = np.flatnonzero(~first & ~same_place)  # rows that repeat an id and its text are the same place
        several = np.flatnonzero(first & (np.bincount(number, first)[number] > 1))
        w, runs = alike(number[several], g["common"][several], g["place"][several])
        w = several[w]
        each = number[w[np.r_[True, w[1:] != w[:-1]]]] if len(w) else w  # a window may have several runs
        crowd = np.bincount(each, minlength=len(h))[number[w]]
        rows = np.r_[whole, w]
        columns = (
            np.r_[known["h"], h[rows]], np.r_[known["key"], g["key"][rows]], np.r_[known["mark"], g["mark"][rows]],
            np.r_[known["place"], g["place"][whole], runs], np.r_[np.zeros(len(known["h"]) + len(whole), np.int32), crowd.astype(np.int32)],
        )
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "key", "mark", "place", "crowd"])


# ---------------------------------------------------------------- the run-length index


class RunIndex:
    """A run-compressed Burrows-Wheeler transform of windows, with suffix positions sampled at run ends.

    ``text`` holds symbols 1..256 for bytes and 0 behind each window.
    """

    def __init__(self, text: np.ndarray, length: int = LENGTH):
        sa, near = self.suffixes(text, length)
        # rank of the suffix behind each window: separators sort before all bytes
        self.separators = np.argsort(sa[: int((text == 0).sum())])
        bwt = text[sa - 1]
        head = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        self.n = len(text)
        self.run_start = head
        self.run_char = bwt[head]
        runs = np.diff(np.r_[head, self.n])
        first = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=257))[:-1]])
        order = np.argsort(self.run_char, kind="stable")
        before = np.concatenate([[0], np.cumsum(runs[order])[:-1]])
        # LF(i) = run_to[run of i] + i - run_start[run of i]
        self.run_to = np.empty(len(head), np.int64)
        self.run_to[order] = before
        self.first = first
        self.sample_first, self.sample_last = sa[head], sa[np.r_[head[1:], self.n] - 1]  # suffixes at run ends
        # intervals of suffixes that share `length` symbols, of two or more
        edge = np.flatnonzero(~near)
        size = np.diff(np.r_[edge, self.n])
        earliest = np.minimum.reduceat(sa, edge)
        many = size > 1
        self.low, self.high, self.earliest = edge[many], edge[many] + size[many], earliest[many]

    @staticmethod
    def suffixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array, and for each rank whether it shares ``length`` symbols with the rank before."""
        n = len(text)
        wide = np.concatenate([text, np.zeros(7, text.dtype)]).astype(U)
        key = np.zeros(n, U)
        for k in range(7):
            key = (key << U(9)) | wide[k : n + k]
        # prefix doubling; a rank is the place of the first suffix of its tie, and only ties are sorted again
        sa = np.argsort(key)
        rank = np.empty(n, np.int64)
        tied = sa_tied = None
        have, exact = 7, None
        head = np.r_[True, key[sa[1:]] != key[sa[:-1]]]
        place = np.arange(n)
        while True:
            rank[sa if tied is None else sa_tied] = np.maximum.accumulate(np.where(head, place, 0))
            if have * 2 > length and exact is None:
                exact, step = rank.copy(), length - have  # two overlapping stretches cover `length`
            single = head & np.r_[head[1:], True]
            if single.all():
                break
            place = place[~single]
            tied = (sa if tied is None else sa_tied)[~single]
            behind = tied + have
            key = rank[tied] * (n + 1) + np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
            by = np.argsort(key)
            sa_tied, key = tied[by], key[by]
            sa[place] = sa_tied
            head = np.r_[True, key[1:] != key[:-1]]
            have *= 2
        if exact is None:
            return sa, np.zeros(n, bool)
        second = np.full(n, -1)
        second[: n - step] = exact[step:]
        near = np.r_[False, (exact[sa[1:]] == exact[sa[:-1]]) & (second[sa[1:]] == second[sa[:-1]]) & (second[sa[1:]] >= 0)]
        return sa, near

    def lf(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of the suffix one symbol longer, and that symbol."""
        r = np.searchsorted(self.run_start, i, "right") - 1
        return self.run_to[r] + i - self.run_start[r], self.run_char[r]

    def count(self, pattern: np.ndarray) -> tuple[int, int]:
        """Backward search: the interval of suffixes that begin with ``pattern``."""
        low, high = 0, self.n
        for c in pattern[::-1]:
            low, high = (self.first[c] + self.rank(c, x) for x in (low, high))
            if low >= high:
                return 0, 0
        return int(low), int(high)

    def rank(self, c: int, i: int) -> int:
        """How many symbols of the transform before place i are c."""
        r = int(np.searchsorted(self.run_start, i, "left"))  # runs that begin before i
        own = np.flatnonzero(self.run_char[:r] == c)
        ends = np.minimum(np.r_[self.run_start[1:], self.n][own], i)
        return int((ends - self.run_start[own]).sum())

    def locate(self, i: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes at ranks i: LF steps to the next sampled run end, counted."""
        i = np.array(i, np.int64)
        out = np.full(len(i), -1)
        steps, left = 0, np.arange(len(i))
        while len(left):
            r = np.searchsorted(self.run_start, i[left], "right") - 1
            first = i[left] == self.run_start[r]
            last = i[left] == np.r_[self.run_start[1:], self.n][r] - 1
            at = np.where(first, self.sample_first[r], self.sample_last[r])
            hit = first | last
            out[left[hit]] = (at[hit] + steps) % self.n
            left = left[~hit]
            i[left], _ = self.lf(i[left])
            steps += 1
        return out

    def earliest_of(self, i: np.ndarray) -> np.ndarray:
        """First text position of the interval that each rank lies in, -1 for a rank alone."""
        if not len(self.low):
            return np.full(len(i), -1)
        k = np.searchsorted(self.low, i, "right") - 1
        return np.where((k >= 0) & (i < self.high[k]), self.earliest[k], -1)

    def stream(self, ends: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Run all windows through the index from their ends: ``(window, start in it, earliest match)`` step by step.

        ``ends`` are the ranks of the separators behind the windows, longest window first.
        """
        i = ends
        for step in range(1, int(sizes.max(initial=0)) + 1):
            live = int(np.searchsorted(-sizes, -step, "right"))
            i, _ = self.lf(i[:live])
            if step >= length:
                yield np.arange(live), sizes[:live] - step, self.earliest_of(i)


def mark_repeats(payload: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(window, offset)`` of the strings that also start in an earlier window, for windows in corpus order."""
    sizes = np.array([len(x) for x in payload])
    text = np.zeros(sizes.sum() + len(sizes), np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    flat = np.frombuffer(b"\0".join(payload), np.uint8).astype(np.int64) + 1
    text[: len(flat)] = flat
    text[begin + sizes] = 0
    index = RunIndex(text)
    order = np.argsort(-sizes, kind="stable")
    rank = index.separators
    out_w, out_o = [], []
    for w, at, earliest in index.stream(rank[order], sizes[order]):
        hit = (earliest >= 0) & (earliest < begin[order][w] + at)
        out_w.append(order[w[hit]])
        out_o.append(at[hit])
    return (np.concatenate(out_w), np.concatenate(out_o)) if out_w else (np.zeros(0, int), np.zeros(0, int))


def emit_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, mark, place`` (place as start * 256 + count) of the repeats among windows that are dealt by ``h``; those without bytes are."""
    held: list[dict] = []
    size = 0
    for g in groups(batches, ("h", "key", "mark", "place", "bytes"), 1_000):
        known = np.array([x is None for x in g["bytes"]])
        if known.any():
            yield pa.RecordBatch.from_arrays([pa.array(g[c][known]) for c in ("key", "mark", "place")], ["key", "mark", "place"])
            g = {c: v[~known] for c, v in g.items()}
        held.append(g)
        size += sum(map(len, g["bytes"]))
        if size >= BLOCK:
            yield repeats_of(held)
            held, size = [], 0
    if size:
        yield repeats_of(held)


def repeats_of(held: list[dict]) -> pa.RecordBatch:
    g = {c: np.concatenate([x[c] for x in held]) for c in held[0]}
    order = np.lexsort((g["place"], g["mark"], g["key"]))
    g = {c: v[order] for c, v in g.items()}
    start = g["place"] >> 8
    first: dict[bytes, int] = {}
    again = np.array([first.setdefault(x, i) != i for i, x in enumerate(g["bytes"])])  # as a whole
    own = np.flatnonzero(~again)
    w, o = mark_repeats(g["bytes"][own].tolist())
    order = np.lexsort((o, w))
    w, o = own[w[order]], o[order]
    head = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (o[1:] != o[:-1] + 1)]) if len(w) else np.zeros(0, int)
    n = np.diff(np.r_[head, len(w)])
    w, o = w[head], o[head]
    place = np.r_[(start[w] + o) * 256 + n, g["place"][again]]
    return pa.RecordBatch.from_arrays([pa.array(np.r_[g["key"][w], g["key"][again]]), pa.array(np.r_[g["mark"][w], g["mark"][again]]), pa.array(place)], ["key", "mark", "place"])


# ---------------------------------------------------------------- the operator


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked windows of each document.

    Those of crowded minimisers come string by string, and of equal strings met here the first; the others are repeats, and
    come without bytes, dealt by their document.
    """
    out: list[tuple] = []
    single: dict[bytes, tuple] = {}  # key, mark and start of the first
    again: list[list] = []  # key, mark, start, count

    def flush():
        out.extend((int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little", signed=True), k, m, q * 256 + 1, s) for s, (k, m, q) in single.items())
        out.extend((k ^ m, k, m, q * 256 + n, None) for k, m, q, n in again)
        columns = zip(*out) if out else ([],) * 5
        rows = pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if i == 4 else pa.int64()) for i, x in enumerate(columns)], ["h", "key", "mark", "place", "bytes"])
        for x in (out, single, again):
            x.clear()
        return rows

    for batch in batches:
        for k, m, text, asked in zip(*(batch.column(c) for c in ("key", "mark", "text", "asked"))):
            raw, k, m = text.as_buffer().to_pybytes(), k.as_py(), m.as_py()
            for a in asked.as_py():
                p, n = a["place"] >> 8, a["place"] & 255
                if a["crowd"] <= CROWD:
                    out.append((a["h"], k, m, a["place"], raw[p : p + n - 1 + LENGTH]))
                    continue
                for q in range(p, p + n):
                    s, here = raw[q : q + LENGTH], (k, m, q)
                    other = single.setdefault(s, here)
                    if other == here:
                        continue
                    if here < other:
                        single[s] = here
                    k2, m2, q2 = max(here, other)
                    if again and again[-1][:2] == [k2, m2] and again[-1][2] + again[-1][3] == q2 and again[-1][3] < 255:
                        again[-1][3] += 1
                    else:
                        again.append([k2, m2, q2, 1])
            if len(out) + len(single) + len(again) > 20_000:
                yield flush()
    yield flush()


def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the covered bytes out of each text."""
    for batch in batches:
        spans, kept, sizes, fill = [], [], [], 0
        first = 0

        def flush(upto):
            part = batch.slice(first, upto - first)
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

        for i, (text, gone) in enumerate(zip(batch.column("text"), batch.column("gone"))):
            raw = text.as_buffer()
            merged: list[list[int]] = []
            if gone.is_valid:
                x = np.sort(gone.values.to_numpy())
                start, end = x >> 8, (x >> 8) + (x & 255) - 1 + LENGTH
                reach = np.maximum.accumulate(end)
                head = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
                merged = list(zip(start[head].tolist(), reach[np.r_[head[1:], len(x)] - 1].tolist()))
            raw = memoryview(raw)
            edges = [0, *(e for s in merged for e in s), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans.append([{"start": a, "end": b} for a, b in merged])
            sizes.append(len(raw))
            fill += len(raw)
            if fill > 8_000_000:
                yield flush(i + 1)
                spans, kept, sizes, fill, first = [], [], [], 0, i + 1
        if sizes:
            yield flush(len(batch))


def repeated_strings(docs: DataFrame) -> DataFrame:
    """``key, mark, gone``: for each text with repeats, the repeated strings as start * 256 + count."""
    lanes = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    settled = stash(
        docs.mapInArrow(emit_windows, WINDOW).repartition(lanes, "h").sortWithinPartitions("h")
        .mapInArrow(settle, "h long, key long, mark long, place long, crowd int"),
        "suffix-settled",
    )
    whole = settled.where("crowd = 0").select("key", "mark", "place")
    asked = settled.where("crowd > 0").groupBy("key", "mark").agg(F.collect_list(F.struct("h", "place", "crowd")).alias("asked"))
    cut = docs.join(stash(asked, "suffix-asked"), ["key", "mark"]).mapInArrow(cut_out, "h long, key long, mark long, place long, bytes binary")
    indexed = cut.repartition(lanes, "h").sortWithinPartitions("h").mapInArrow(emit_repeats, "key long, mark long, place long")
    every = whole.unionByName(indexed)
    return stash(every.groupBy("key", "mark").agg(F.collect_list("place").alias("gone")), "suffix-gone")


def remove_repeats(df: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for each row of ``doc_id, text``.

    A byte goes if it is covered by a string of 100 bytes that also starts earlier: in a
    document with a smaller id, or earlier in the same one.  Strings are judged on the
    input, overlap counts, and no string crosses documents.  ``spans`` are the maximal
    removed runs as byte offsets, ``kept`` the other bytes.  Null text is empty; null ids
    come first; rows that repeat an id are ordered by a hash of their text, and rows equal
    in both are one document with the same result; other columns are ignored.
    """
    docs = small_batches(df).select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    twice = docs.groupBy("key").count().where("count > 1").limit(1).count() > 0
    docs = docs.withColumn("mark", F.xxhash64("text") if twice else F.lit(0).cast("long"))
    texts = docs.select("key", "mark", "text")
    if twice:  # a row that repeats an id and its text is the same place, not a later one
        texts = stash(texts.dropDuplicates(["key", "mark"]), "suffix-distinct")
    gone = repeated_strings(texts)
    return docs.join(gone, ["key", "mark"], "left").select("doc_id", "text", "gone").mapInArrow(
        remove, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
