"""Operator 7: byte-pair encoding and decoding with forced-boundary splitting.

A pair of neighbouring symbols that occurs inside no vocabulary token can never
be covered by one token, whatever the merges do, so a word may be cut there for
certain.  The fragments between such cuts are merged independently and their ids
concatenated.  Words repeat, so a bounded memo keeps the ids of words seen.

Python is used because merging is a data-dependent loop over each word; texts
pass through Arrow in slices of bounded bytes, no row needs any other row, and
there is no shuffle, so memory is that of one slice and the largest single text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

SLICE_CHARS = 2_000_000
MEMO_WORDS = 250_000
#: Up to here every character, and its lower case, is known to be normalised and split alike by the fast path.
PLAIN = re.compile("[\x00-ſ]*")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte, as byte-level vocabularies write it."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class WordBPE:
    """Encoder and decoder for a tokenizer file of BPE with word ends and a byte alphabet."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)  # its normaliser and splitter serve unusual characters
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.vocab = vocab
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.names = {i: s for s, i in (vocab | self.special).items()}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.inside = {pair for token in vocab for pair in self.pairs(token)}
        self.bytes = byte_symbols()
        letters = "".join(chr(c) for c in range(0x180) if chr(c).isalpha())
        digits = re.escape("".join(chr(c) for c in range(0x180) if chr(c).isnumeric()))
        blanks = r"\t-\r \x85\xa0"
        self.words = re.compile(rf"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{digits}]|[^{blanks}{letters}{digits}]+")
        self.memo: dict[str, tuple[int, ...]] = {}

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            token = token[: -len(self.end)]
            return [*token[:-1], token[-1] + self.end]
        return list(token)

    def pairs(self, token: str) -> Iterator[tuple[str, str]]:
        s = self.symbols(token)
        return zip(s, s[1:])

    def merge(self, ids: list[int]) -> list[int]:
        """Apply merges to a fragment: lowest rank first, then leftmost."""
        merges = self.merges
        if len(ids) > 48:
            return self.merge_long(ids)
        while len(ids) > 1:
            best, at = None, 0
            for i in range(len(ids) - 1):
                m = merges.get((ids[i], ids[i + 1]))
                if m is not None and (best is None or m < best):
                    best, at = m, i
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap over a linked list, so that a long fragment costs n log n."""
        n, merges = len(ids), self.merges
        after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        heap = [(*m, i) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heap = [(rank, i, new, ids[i], ids[i + 1]) for rank, new, i in heap]
        heapify(heap)
        while heap:
            _, i, new, a, b = heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = new, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and (right := after[left]) >= 0 and (m := merges.get((ids[left], ids[right]))):
                    heappush(heap, (m[0], left, m[1], ids[left], ids[right]))
        return [ids[i] for i in range(n) if alive[i]]

    def fragments(self, word: str) -> list[list[str]]:
        """The symbols of a word, cut wherever no token can span."""
        s = [self.bytes[b] for b in word.encode("utf-8")]
        s[-1] += self.end
        cuts = [i for i in range(1, len(s)) if (s[i - 1], s[i]) not in self.inside]
        return [s[i:j] for i, j in zip([0, *cuts], [*cuts, len(s)])]

    def encode_word(self, word: str) -> tuple[int, ...]:
        vocab = self.vocab
        return tuple(chain.from_iterable(self.merge([vocab[x] for x in f]) for f in self.fragments(word)))

    def split(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return self.words.findall(text.lower())
        text = self.library.normalizer.normalize_str(text)
        out = [text[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return [w for w in out if w]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        parts = self.specials.split(text) if any(s in text for s in self.special) else [text]
        out: list[int] = []
        memo = self.memo
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
                continue
            words = self.split(part)
            try:
                out.extend(chain.from_iterable([memo[w] for w in words]))
            except KeyError:
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                for w in words:
                    if w not in memo:
                        memo[w] = self.encode_word(w)
                out.extend(chain.from_iterable([memo[w] for w in words]))
        return out

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by blanks, as the library does for a file without decoder; unknown ids are left out."""
        names = self.names
        try:
            return " ".join([names[i] for i in ids])
        except KeyError:
            return " ".join([names[i] for i in ids if i in names])


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``limit`` characters at most (a longer single text stands alone)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


_loaded: dict[str, WordBPE] = {}


def _codec(path: str) -> WordBPE:
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """``id, ids, decoded`` for each row of ``df``; other columns are ignored.

    ``path`` names a tokenizer file that exists on every executor.  Null and empty
    texts give no ids and an empty decoded text; ids may be null or repeat, each row
    is its own.  ``decoded=False`` leaves the decoded texts out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE_CHARS):
                ids = [codec.encode(t) for t in part.column("text").to_pylist()]
                columns = [part.column("id"), pa.array(ids, pa.list_(pa.int32()))]
                if decoded:
                    columns.append(pa.array([codec.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"][: len(columns)])

    small_batches(df)
    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>" + ", decoded string" * decoded
    )
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the decoded text of an array of ids; null arrays give an empty text."""

    @F.pandas_udf("string")
    def text(ids):
        codec = _codec(path)
        return ids.map(lambda x: "" if x is None else codec.decode(x.tolist()))

    return df.withColumn(into, text(F.col(ids_col)))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
