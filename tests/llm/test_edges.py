"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoprep.llm import bpe, chat, lines, mixing, neardup, suffix, toxicity, vectors, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = " ".join(f"word{i}" for i in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, WORDS, "en", "a", 10), (2, WORDS, "en", "a", 10), (3, "", None, None, None), (4, None, "en", "b", 1), (5, "x" * 300_000, "en", "a", 1),
        (6, "a b c\n" * 50, "en", "a", 1), (6, "a b c\n" * 50, "en", "a", 1), (None, "no id here", "en", "a", 1), (None, None, None, None, None),
        (7, "\n\n \n", "en", "a", 1), (8, "é ü 漢字 \U0001f600 <|endoftext|>", "en", "a", 1), (9, WORDS + " tail", "en", "a", 2), (9, "other text of nine", "en", "a", 2),
    ]
    clash = [F.lit("q").alias(c) for c in ("key", "mark", "_key", "tokens", "rate", "copies", "row", "h", "n_lines", "id", "ids", "rep", "band", "text_mark", "gone", "p_good")]
    return spark.createDataFrame(rows, DOCS).select("*", *clash)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 1), (8, None, None), (None, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")


def test_toxicity(docs, nothing, labels):
    for d in (docs, nothing):
        for sample in (labels, labels.where("false")):
            model = toxicity.fit_toxicity(toxicity.labelled_sample(d, sample))
            assert toxicity.score_toxicity(d, model).count() == d.count()
            out = toxicity.drop_toxic(d, model)
            assert out.columns == d.columns and out.count() <= d.count()


def test_lines(docs, nothing):
    assert lines.dedup_lines(nothing).count() == 0
    out = lines.dedup_lines(docs)
    assert out.count() == docs.count()
    six = {r.text for r in out.where("doc_id = 6").collect()}
    assert six == {"a b c\n"}  # lines 2, 3, 4 repeat lines 1, 2, 3, and so on
    assert {r["_key"] for r in out.collect()} == {"q"}


def test_lines_of_two_make_a_passage(spark):
    one, two = "a" * 130, "b" * 130
    rows = [(1, f"{one}\n\n{two}\nc"), (2, f"x\n{one}\n{two}"), (3, f"{two}\n{one}"), (4, f"{one}\nshort\n{two}")]
    out = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: "x", 3: rows[2][1], 4: rows[3][1]}


def test_near_duplicates(docs, nothing):
    assert neardup.near_duplicates(nothing).count() == 0
    out = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert out[1].class_id == out[2].class_id == 1
    assert out[9].class_id == 1  # two texts, one of which is a near copy of the first
    assert out[3].class_id == 3 and out[4].class_id == 4 and out[7].class_id == 7
    assert out[None].class_id is None


def test_first_of_classes(docs, nothing):
    assert neardup.first_of_classes(nothing).count() == 0
    out = neardup.first_of_classes(docs)
    assert out.columns == docs.columns
    rows = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in out.collect())
    # each text of a repeated id is judged for itself; equal rows are one
    assert rows == sorted([(1, WORDS), (3, ""), (4, ""), (5, "x" * 300_000), (6, "a b c\n" * 50), (-1, ""), (-1, "no id here"), (7, "\n\n \n"), (8, "é ü 漢字 \U0001f600 <|endoftext|>"), (9, "other text of nine")])


def test_mixing(docs, nothing, labels):
    for d in (docs, nothing):
        for sample in (labels, labels.where("false")):
            marked = mixing.quality_domains(sample)
            assert mixing.mix_domains(d, marked, mixing.WEIGHTS).count() == d.count()
            out = mixing.repeated(d, marked, mixing.WEIGHTS)
            assert out.columns == d.columns and out.count() >= d.count()


def test_bpe(docs, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.encode_decode(nothing, path).count() == 0
    library = Tokenizer.from_file(path)
    given = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    want = [(i, library.encode(t, add_special_tokens=False).ids) for i, t in given]
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in bpe.encode_decode(docs, path).collect()), key=str)
    assert sorted(map(str, want)) == sorted(str((i, x)) for i, x, _ in got)
    assert all(d == library.decode(x, skip_special_tokens=False) for _, x, d in got)


def test_suffix(docs, nothing):
    assert suffix.remove_repeats(nothing).count() == 0
    out = suffix.remove_repeats(docs).collect()
    assert len(out) == docs.count()
    assert {bytes(r.kept) for r in out if r.doc_id == 2} == {b""}
    assert [len(r.kept) for r in out if r.doc_id == 5] == [1]  # each string from the second byte on also starts earlier


def test_suffix_repeated_row(spark):
    """Two rows equal in id and text are one document, which keeps its text, in one slice or in two."""
    rows = [(6, WORDS), (6, WORDS), (7, WORDS + " and a tail"), (6, "other text of six " + WORDS[:50])]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        kept = sorted(bytes(r.kept).decode() for r in suffix.remove_repeats(docs).collect())
        assert kept == sorted([WORDS, WORDS, " and a tail", rows[3][1]])


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a" * 3_000_000), (2, None, "a" * 3_000_000), (3, "u", None), (4, "u\r\nv", ""), (None, None, None), (5, "u", "é")], "record_id long, uri string, payload string")
    pages = pages.select("*", F.lit(1).alias("digest"), F.lit(2).alias("winner"))
    folder = f"file://{tmp_path}/warc"
    back = warc.read_warc(warc.write_warc(pages, folder), folder, chunk_bytes=1 << 20)
    rows = {r.record_id: r for r in back.where("is_last").collect()}
    assert rows[1].record_type == "revisit" and rows[1].refers_to == 2 and rows[1].payload_length == 3_000_000
    assert rows[2].chunk_no == 2 and rows[2].digest_so_far == hashlib.sha1(b"a" * 3_000_000).hexdigest() == rows[2].payload_digest
    assert rows[3].payload_length == rows[4].payload_length == 0 and rows[5].payload_length == 2 and rows[None].record_type == "response"
    assert warc.read_warc(warc.write_warc(pages.where("false"), folder + "2"), folder + "2").count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [0.5]), (9, []), (None, [1.0, 1.0]), (0, [1.0, 0.0]), (20, [-1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", F.lit(1).alias("shard"), F.lit(1).alias("v"))
    near = [(r.query_id, r.rank, r.vec_id, r.score) for r in vectors.hnsw_search(df, F.col("vec_id") % 20 == 0, 3).orderBy("query_id", "rank").collect()]
    assert near[:3] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, -1.0)]
    top = [(r.query_id, r.rank, r.vec_id, r.score) for r in vectors.va_search(df, F.col("vec_id") == 20, 5).orderBy("query_id", "rank").collect()]
    assert top == [(20, 1, 3, 0), (20, 2, 0, -65536), (20, 3, 1, -65536), (20, 4, 2, -65536)]
    for f in (vectors.hnsw_search, vectors.va_search):
        assert f(df.where("false"), F.lit(True)).count() == 0


def test_large_components(spark):
    rows = [(0, [4096.0, 1.0]), (1, [5e3, 0.0]), (2, [1.0, 1.0]), (3, [-1e4, 3.0]), (4, [4e5, 2.0**-8]), (5, [4e5, 0.0]), (6, [2e6, -8e8]), (7, [1e-3, 3e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(x * 256 // 1) for x in v] for i, v in rows}
    dot = lambda a, b: sum(x * y for x, y in zip(whole[a], whole[b]))
    want = [(q, n + 1, i, -s) for q in whole for n, (s, i) in enumerate(sorted((-dot(q, i), i) for i in whole if i != q)[:3])]
    got = [tuple(r) for r in vectors.va_search(df, F.lit(True), 3).orderBy("query_id", "rank").collect()]
    assert got == want


def test_large_bounds():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(600, 8)) * 2.0 ** rng.integers(0, 60, (600, 8)))
    exact = np.frompyfunc(int, 1, 1)(x)
    rows, scores = vectors.VAFile(x).search(x[:20], 5)
    for i in range(20):
        assert scores[i].tolist() == sorted((exact @ exact[i]).tolist(), reverse=True)[:5]


def test_many_ties(spark):
    """Queries that tie with all rows, and rows in groups of equal scores."""
    rng = np.random.default_rng(6)
    x = np.floor(rng.normal(size=(20_000, 4)) * 3)
    ids = rng.permutation(20_000)
    file = vectors.VAFile(x, ids)
    queries = np.concatenate([np.zeros((70, 4)), x[:50], [[0, 0, 0, 1]]])
    rows, scores = file.search(queries, 6)
    for q, r, s in zip(queries, rows, scores):
        every = (x @ q).astype(int)
        assert r.tolist() == np.lexsort((ids, -every))[:6].tolist() and s.tolist() == every[r].tolist()
    df = spark.range(3000).selectExpr("id vec_id", "array(cast(id % 3 = 0 as int) / 2, 0.25, 0.0) embedding")
    got = [tuple(r)[1:] for r in vectors.va_search(df, F.col("vec_id") == 9, 4).orderBy("rank").collect()]
    assert got == [(1, 0, 128 * 128 + 64 * 64), (2, 3, 128 * 128 + 64 * 64), (3, 6, 128 * 128 + 64 * 64), (4, 12, 128 * 128 + 64 * 64)]


def test_chat(spark):
    rows = [(1, 0, "user", "<|im_end|>\n<\\|x"), (1, 1, "assistant", None), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, None, None, None), (3, 0, "ro\nle%0A", "t"), (4, 0, "system", "s"), (4, 1, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", F.lit(1).alias("segments"), F.lit(2).alias("t"))
    out = {r.conv_id: r for r in chat.format_chats(df).withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    assert [tuple(x) for x in out[1].back] == [("user", "<|im_end|>\n<\\|x"), ("assistant", "")]
    assert [tuple(x) for x in out[3].back] == [("ro\nle%0A", "t")]
    assert out[1].valid and not out[2].valid and out[2].first_bad_turn == 0 and out[4].first_bad_turn == 2
    assert chat.format_chats(df.where("false")).count() == 0


def test_chat_templates(spark):
    """Texts made of a template's own pieces are read back as they were; what cannot be escaped is refused."""
    for wrong in ({"turn_open": "[T]"}, {"turn_close": "[/T]"}, {"role_end": ": "}):
        with pytest.raises(ValueError):
            chat.ChatTemplate(**wrong)
    template = chat.ChatTemplate("<|s|>", "\n", "<|/s|>")
    rng = np.random.default_rng(9)
    piece = ["<|s|>", "<|/s|>", "<", "|", "\\", "\n", "assistant", "<\\|", "%0A", "x"]
    rows = [(c, t, "".join(rng.choice(piece, 2)), "".join(rng.choice(piece, int(rng.integers(0, 9))))) for c in range(100) for t in range(3)]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), template)
    back = {r.conv_id: [tuple(x) for x in r.back] for r in out.withColumn("back", chat.read_back(F.col("formatted"), template)).collect()}
    assert back == {c: [r[2:] for r in rows if r[0] == c] for c in range(100)}


def test_bpe_decode(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    ids = [library.encode(t, add_special_tokens=False).ids for t in ("", "Hello World", "é 漢 <|endoftext|>")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*ids, None])], "n int, ids array<int>")
    got = {r.n: r.decoded for r in bpe.decode(df, path).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)} | {3: ""}
