"""The registered queries against SQL, brute force, the reference library, or held-out rows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronoprep.llm import bpe, chat, lines, mixing, neardup, queries, suffix, toxicity, vectors, warc
from tests.compare import same

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    same(queries.queries()[name](spark, SMALL), SMALL, queries.oracle_sql()[name])


def test_suffix_brute(spark, texts):
    seen, want = set(), {}
    for i in sorted(texts):
        b = texts[i].encode()
        covered = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            s = b[p : p + 100]
            if s in seen:
                covered[p : p + 100] = True
            seen.add(s)
        kept = bytes(np.frombuffer(b, np.uint8)[~covered])
        spans = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        want[i] = (len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.op3_suffix_dedup(spark, SMALL).collect()}
    assert got == want


def test_suffix_index():
    rng = np.random.default_rng(3)
    for _ in range(30):
        base = [bytes(rng.choice(list(b"abc"), 150).tolist()) for _ in range(4)]
        given = []
        for _ in range(int(rng.integers(1, 30))):
            x = bytearray(base[rng.integers(4)])
            x[rng.integers(150)] = 100
            given.append(bytes(x[rng.integers(50) :]))
        seen, want = set(), []
        for w, x in enumerate(given):
            for o in range(len(x) - 99):
                if x[o : o + 100] in seen:
                    want.append((w, o))
                seen.add(x[o : o + 100])
        w, o = suffix.mark_repeats(given)
        assert sorted(zip(w.tolist(), o.tolist())) == want
        text = np.concatenate([np.r_[np.frombuffer(x, np.uint8).astype(int) + 1, 0] for x in given])
        index, piece = suffix.RunIndex(text), text[3:15]
        low, high = index.count(piece)
        found = sorted(index.locate(np.arange(low, high)).tolist())
        assert found == [i for i in range(len(text) - 11) if (text[i : i + 12] == piece).all()]


def dealt(texts):
    """Settled rows, strings that are dealt with their bytes, and repeated ``(text, start)``, as op3 finds them without Spark."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([0] * len(texts)), pa.array(texts, pa.binary())], ["key", "mark", "text"])
    windows = pa.Table.from_batches(suffix.emit_windows(iter([batch.slice(i, 7) for i in range(0, len(texts), 7)]))).sort_by("h")
    settled = pa.Table.from_batches(suffix.settle(iter(windows.to_batches(max_chunksize=100))))
    asked = defaultdict(list)
    for r in settled.to_pylist():
        if r["crowd"]:
            asked[r["key"]].append({c: r[c] for c in ("h", "place", "crowd")})
    kind = pa.list_(pa.struct([("h", pa.int64()), ("place", pa.int64()), ("crowd", pa.int32())]))
    wanted = pa.RecordBatch.from_arrays([*batch.columns, pa.array([asked[i] for i in range(len(texts))], kind)], ["key", "mark", "text", "asked"])
    cut = pa.Table.from_batches(suffix.cut_out(iter([wanted.filter(pa.array([bool(asked[i]) for i in range(len(texts))]))]))).sort_by("h")
    found = [r for r in settled.to_pylist() if not r["crowd"]]
    if len(cut):
        found += [r for b in suffix.emit_repeats(iter(cut.to_batches(max_chunksize=50))) for r in b.to_pylist()]
    gone = [(r["key"], p) for r in found for p in range(r["place"] >> 8, (r["place"] >> 8) + (r["place"] & 255))]
    return settled, sum(r["place"] & 255 for r in cut.to_pylist() if r["bytes"] is not None), gone


def repeated(texts):
    seen, want = set(), []
    for i, t in enumerate(texts):
        for p in range(len(t) - 99):
            if t[p : p + 100] in seen:
                want.append((i, p))
            seen.add(t[p : p + 100])
    return want


@pytest.mark.parametrize("crowd", [1, 3, 2000])
def test_suffix_dealt(monkeypatch, crowd):
    """Shared passages of all lengths between texts that differ about them, few and many of a kind."""
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rng = np.random.default_rng(crowd)
    for letters in (b"ab", b"abcdefgh", bytes(range(256))):
        draw = lambda n: bytes(rng.choice(list(letters), n).tolist())
        passages = [draw(int(rng.integers(20, 260))) for _ in range(6)]
        texts = []
        for _ in range(40):
            t = b"".join(draw(int(rng.integers(0, 90))) + passages[rng.integers(6)] for _ in range(4))
            texts.append(t if rng.integers(9) else texts[-1] if texts else t)
        texts += [t[: len(t) // 2] + b"~" + t[len(t) // 2 :] for t in texts[:10]]
        assert sorted(dealt(texts)[2]) == repeated(texts)


def test_suffix_settled_by_range():
    """Windows that share a minimiser and no string are settled before their bytes are dealt."""
    rng = np.random.default_rng(5)
    passage = rng.bytes(80)
    texts = [rng.bytes(150) + passage + rng.bytes(150) for _ in range(60)]
    settled, strings, gone = dealt(texts)
    assert not gone and not len(settled) and not strings


def test_suffix_crowded(monkeypatch):
    """Of the strings of a passage with crowded edges, one of each kind is dealt."""
    monkeypatch.setattr(suffix, "CROWD", 20)
    rng = np.random.default_rng(6)
    passage = rng.bytes(140)
    texts = [rng.bytes(150) + passage + rng.bytes(150) for _ in range(60)]
    _, strings, gone = dealt(texts)
    assert sorted(gone) == repeated(texts)
    assert strings < 41 + 60 * 2 * 19


def brute_classes(texts):
    memo, bags, by = {}, {}, defaultdict(list)
    for i, t in texts.items():
        _, item, weight = neardup.shingles([t], memo)
        bags[i] = dict(zip(item.tolist(), weight.tolist()))
        for h in bags[i]:
            by[h].append(i)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in texts:
        for j in {j for h in bags[i] for j in by[h] if j < i}:
            both = sum(min(w, bags[j].get(h, 0)) for h, w in bags[i].items())
            if both >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def classes(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}


def test_near_duplicates_brute(spark, texts):
    got = {r.doc_id: r.class_id for r in neardup.op4_near_duplicates(spark, SMALL).collect()}
    assert got == brute_classes(texts)


def test_near_duplicates_in_chains(spark):
    """Chains of copies of recent copies with one to three words changed, from long and short texts at once."""
    rng, rows = np.random.default_rng(11), []
    for c in range(10):
        chain = [[f"c{c}w{x}" for x in rng.integers(0, 400, int(rng.choice([40, 70, 120])))]]
        for _ in range(59):
            w = list(chain[-1 - int(rng.integers(0, min(4, len(chain))))])
            for _ in range(int(rng.integers(1, 4))):
                w[int(rng.integers(0, len(w)))] = f"c{c}e{rng.integers(10**6)}"
            chain.append(w)
        rows += [(60 * c + i, " ".join(w)) for i, w in enumerate(chain)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    assert classes(spark, rows) == brute_classes(dict(sorted(rows)))


def test_near_duplicates_in_stars(spark):
    """Copies around an original, many of them below the threshold with it but above it with each other."""
    rng, rows = np.random.default_rng(12), []
    for c in range(6):
        base = [f"c{c}w{x}" for x in range(150)]
        for i in range(80):
            w, arm = list(base), int(rng.integers(0, 5))
            for k in range(int(rng.integers(2, 8))):
                w[(29 * arm + 3 * k) % 150] = f"c{c}a{arm}k{k}"
            if rng.random() < 0.5:
                w[int(rng.integers(0, 150))] = f"c{c}i{i}"
            rows.append((100 * c + i, " ".join(w)))
    assert classes(spark, rows) == brute_classes(dict(rows))


def test_components_of_paths_and_trees(spark, monkeypatch):
    """In partitions of some hundred edges, so that components lie across them."""
    monkeypatch.setattr(neardup, "EDGES", 300)
    rng = np.random.default_rng(13)
    name = rng.permutation(2000) * 7 - 5000
    edges = [(i, i + 1) for i in range(0, 500)] + [(int(rng.integers(600, i)), i) for i in range(601, 1300)] + [(1300, i) for i in range(1301, 2000)]
    rows = [(int(min(name[a], name[b])), int(max(name[a], name[b]))) for a, b in edges]
    got = {r.rep: r.root for r in neardup.components(spark.createDataFrame(rows, "leader long, rep long").repartition(7)).collect()}
    want = {}
    for lo, hi in ((0, 501), (600, 1300), (1300, 2000)):
        members = name[lo:hi].tolist()
        want |= {m: min(members) for m in members if m != min(members)}
    assert got == want


def test_near_duplicates_reach_settled_members(spark):
    """In each group a text is similar to one member only, never to the copies that lead the buckets."""
    rows = []
    for g in range(16):
        base = [f"g{g}w{i}" for i in range(204)]
        member = base + [f"g{g}x{i}" for i in range(6)]
        rows += [(100 * g + j, " ".join(base + [f"g{g}c{j}"])) for j in range(8)]
        rows += [(100 * g + 8, " ".join(member)), (100 * g + 9, " ".join(member + [f"g{g}y{i}" for i in range(48)]))]
        assert neardup.overlap(rows[-1][1], rows[-2][1], {}) >= 0.8 > max(neardup.overlap(rows[-1][1], t, {}) for _, t in rows[-10:-2])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: i // 100 * 100 for i, _ in rows}


def test_bag_min_hash_is_unbiased():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(500)]
    base = rng.choice(words, 200).tolist()
    other = [w if rng.random() > 0.02 else str(rng.choice(words)) for w in base]
    a, b = " ".join(base * 3), " ".join(base * 2 + other)
    doc, item, weight = neardup.shingles([a, b], {})
    s = neardup.bag_min_hash(doc, item, weight, 2, 4096)
    assert abs((s[0] == s[1]).mean() - neardup.overlap(a, b, {})) < 0.03


def test_bpe_is_the_library(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op7_bpe(spark, SMALL).collect()}
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[i] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_bpe_cuts_and_odd_texts():
    import public_tokenizers

    codec = bpe.WordBPE(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(1)
    odd = ["'", "é", "Σ", "İ", "\x1d", "́", "<|endoftext|>", "<|start", " ", " ", "9", "ß", "漢", "\U0001f600", "A", "'LL"]
    given = ["".join(rng.choice(odd, int(rng.integers(0, 30)))) for _ in range(2000)] + ["ab" * 3000, "é!" * 500]
    for t, e in zip(given, codec.library.encode_batch(given, add_special_tokens=False)):
        assert codec.encode(t) == e.ids, repr(t)
    assert len(codec.fragments("éééxyz")) > 1


def test_hnsw_recall(spark):
    rows = spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()
    x = {r.vec_id: np.array(r.embedding, float) for r in rows}
    got = defaultdict(list)
    for r in vectors.op2_hnsw(spark, MIDDLE).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q, found in got.items():
        want = sorted((-float(x[q] @ x[i]), i) for i in x if i != q)[:20]
        hits += len({i for _, i in want} & {i for i, _ in found})
        assert all(abs(s - x[q] @ x[i]) < 1e-9 for i, s in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert set(got) == {i for i in x if i % 20 == 0} and hits >= 0.9 * 20 * len(got)


def test_hnsw_graph_of_several_batches():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 24))
    graph = vectors.HNSW(x)
    q = rng.normal(size=(100, 24))
    want = np.argsort(-(q @ x.T), 1)[:, :10]
    got = graph.search(q, 10, 128)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(want, got)]) > 0.9


@pytest.mark.parametrize("kind", ["mixed", "clustered"])
def test_hnsw_recall_of_full_shards(spark, kind):
    """Three shards of vectors of mixed length, and of unit clusters, against brute force."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(9000, 32)) * np.exp(rng.normal(size=(9000, 1)) * 0.5)
    if kind == "clustered":
        x = rng.normal(size=(40, 32))[rng.integers(0, 40, 9000)] + 0.3 * rng.normal(size=(9000, 32))
        x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in vectors.hnsw_search(df, F.col("vec_id") % 90 == 0, shard_rows=3000).collect():
        got[r.query_id].add(r.vec_id)
    score = x[::90] @ x.T
    score[np.arange(100), np.arange(0, 9000, 90)] = -np.inf
    hits = [len(got[90 * i] & set(np.argsort(-s)[:20].tolist())) / 20 for i, s in enumerate(score)]
    assert np.mean(hits) >= 0.95


def test_toxicity_held_out(spark):
    """A tenth of the toxic labels of this table are on junk without any insult, which no text model can find."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known, held = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    model = toxicity.fit_toxicity(toxicity.labelled_sample(docs, known))
    assert list(model.cuts) == sorted(model.cuts) and (model.weights >= 0).all()
    rows = toxicity.score_toxicity(docs.join(held, "doc_id"), model).join(held, "doc_id").collect()
    by = Counter((bool(r.toxic), r.rejected) for r in rows)
    assert by[True, True] >= 0.8 * (by[True, True] + by[True, False]) and by[False, True] <= 0.01 * by[False, False]


def test_mixing_meets_targets(spark):
    out = mixing.op8_mixing(spark, MIDDLE)
    t = [out.agg(F.sum(F.col("rate") * F.col("tokens") * F.col(f"p_{k}"))).first()[0] for k in ("good", "poor")]
    assert abs(t[0] / sum(t) - 0.9) < 1e-6
    assert out.where("rate < 0 or copies < 0").isEmpty()


def least_residual(a, target):
    """Nonnegative least squares by active sets, on a small dense matrix."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    while True:
        slope = np.where(free, -np.inf, a.T @ (target - a @ x))
        if slope.max() <= 1e-10 * max(1.0, np.abs(target).max()) * np.abs(a).max():
            return float(np.linalg.norm(a @ x - target))
        free[slope.argmax()] = True
        while True:
            s = np.zeros(a.shape[1])
            s[free] = np.linalg.lstsq(a[:, free], target, rcond=None)[0]
            if not (s[free] <= 1e-13).any():
                break
            low = free & (s <= 1e-13)
            x += (x[low] / np.maximum(x[low] - s[low], 1e-300)).min() * (s - x)
            free &= x > 1e-13
        x = s


def test_mixing_solver_is_least_squares():
    rng = np.random.default_rng(21)
    for n in range(50):
        k, d = int(rng.integers(2, 7)), 40
        p = rng.dirichlet(np.full(k, rng.choice([0.1, 1.0, 5.0])), d)
        tokens = np.floor(np.exp(rng.normal(4, 2, d))) + 1
        weights = rng.dirichlet(np.ones(k)) * (rng.random(k) < 0.7)
        weights = weights / weights.sum() if weights.sum() else np.eye(k)[0]

        def measure(spots):
            out = []
            for x in spots:
                r = np.maximum(0, 1 - p @ np.array(x))
                w = tokens / tokens.sum()
                out.append(mixing.Sums(float((w * r * r).sum()), ((w * r) @ p).tolist(), ((p * (w * (r > 0))[:, None]).T @ p).tolist(), float(r.min())))
            return out

        _, target, end = mixing.solve(weights.tolist(), measure)
        best = least_residual((p * (tokens / tokens.sum())[:, None]).T, np.array(target))
        assert np.linalg.norm(np.array(end.reached) - target) <= best + 1e-6 * sum(target), n


def test_mixing_projects(spark):
    """Documents that must go to zero, with the totals that are reached then."""
    soft = spark.createDataFrame([(10, 0.5, 0.5), (10, 0.9, 0.1), (10, 0.0, 1.0), (0, 0.5, 0.5)], "tokens long, a double, b double")
    rate, target, reached = mixing.rates(soft, ["a", "b"], [1.0, 0.0])
    rows = soft.withColumn("r", rate).collect()
    a = np.array([[5.0, 9.0, 0.0], [5.0, 1.0, 10.0]])
    assert abs(np.linalg.norm(np.subtract(reached, target)) - least_residual(a, np.array(target))) < 1e-5
    assert np.allclose(a @ [r.r for r in rows[:3]], reached) and rows[2].r == 0 and rows[3].r == 1


def test_mixing_classifier_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    marked = mixing.quality_domains(labels)
    known = mixing.measured(docs)
    model = mixing.fit_domains(known, marked.where("doc_id % 3 > 0"))
    held = mixing.with_posteriors(known, model).join(marked.where("doc_id % 3 = 0"), "doc_id").where("tokens > 0")
    by = Counter((r.domain, r.p_good >= 0.5) for r in held.select("domain", "p_good").collect())
    right = by["good", True] + by["poor", False]
    assert right >= 0.95 * by.total() > by["good", True] + by["good", False]
    assert by["poor", False] >= 0.85 * (by["poor", False] + by["poor", True])


def test_modules_do_not_leak():
    assert all(m.__name__.startswith("chronoprep.llm.") for m in (chat, lines, warc))


def test_sketches_leave_room_for_links():
    """Sets of n shingles a side with similarity just at the threshold pass; far below it they do not."""
    rng = np.random.default_rng(5)
    for n in (5, 20, 165, 2000):
        for share, expected in ((0.8, 1.0), (0.5, 0.0)):
            both = int(np.ceil(share * n))
            x = (n - both) // 2
            doc, item = [], []
            for k in range(50):
                all_ = rng.integers(0, 2**63, n, dtype=np.uint64)
                doc += [np.full(both + x, 2 * k), np.full(n - x, 2 * k + 1)]
                item += [all_[: both + x], np.r_[all_[:both], all_[both + x :]]]
            doc, item = np.concatenate(doc), np.concatenate(item)
            s = neardup.sketch(doc, item, np.ones(len(doc), np.int64), 100)
            passed = neardup.room(s[::2], s[1::2], np.full(50, n + both)).mean()
            assert passed == expected if n > 20 or share == 0.8 else passed < 0.2


def ordinal_loss(rows, columns, grade, w, cuts, l1=3e-5):
    z = np.bincount(rows, w[columns], len(grade))
    edge = np.r_[-np.inf, cuts, np.inf]
    at_least = lambda k: 1 / (1 + np.exp(np.clip(edge[k] - z, -500, 500)))
    return -np.log(np.maximum(at_least(grade) - at_least(grade + 1), 1e-12)).mean() + l1 * w.sum()


@pytest.mark.parametrize("seed", range(3))
def test_ordinal_fit_against_slow_descent(seed):
    """The fit is as good as plain projected descent with numeric slopes and halved steps, which needs no formula of the gradient."""
    rng = np.random.default_rng(seed)
    n, words = 400, 5
    has = rng.random((n, words)) < 0.3
    z = has @ np.array([2.5, 1.5, 0.8, 0.0, -1.0]) + rng.logistic(size=n)
    grade = np.digitize(z, [1.0, 2.5])
    rows, columns = np.nonzero(has)
    w, cuts = toxicity.fit_ordinal(rows, columns, grade, words, 3)
    assert (w >= 0).all() and (np.diff(cuts) > 0).all()

    def loss(x):
        return ordinal_loss(rows, columns, grade, x[:words], np.array([x[words], x[words] + max(x[words + 1], 1e-6)]))

    x = np.r_[np.zeros(words), 1.0, 1.0]
    now, step = loss(x), 1.0
    for _ in range(1500):
        slope = np.array([(loss(x + e) - loss(x - e)) / 2e-5 for e in np.eye(words + 2) * 1e-5])
        while step > 1e-9:
            y = x - step * slope
            y[:words] = np.maximum(y[:words], 0)
            if loss(y) < now:
                break
            step /= 2
        else:
            break
        x, now, step = y, loss(y), step * 1.5
    assert ordinal_loss(rows, columns, grade, w, cuts) <= now + 1e-4


def test_toxicity_conflicting_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    want = [(1, "a", 1), (1, "b", 1), (2, "c", 0)]
    assert sorted(tuple(r) for r in toxicity.labelled_sample(docs, labels).collect()) == want
    assert toxicity.labelled_sample(docs, labels, 1).select("doc_id").distinct().count() == 1
