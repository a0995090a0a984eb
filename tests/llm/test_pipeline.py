"""run() against its stages applied by brute force to the same rows."""

import hashlib

import corpus_pipeline
from chronoprep.llm import mixing, toxicity
from tests.llm.test_queries import SMALL, brute_classes


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit_toxicity(toxicity.labelled_sample(docs, labels))
    rows = [r for r in sorted(docs.collect(), key=lambda r: r.doc_id) if model.at_least(__import__("numpy").array([model.score(r.text)]))[0, 0] < 0.5]
    seen, cleaned = set(), {}
    for r in rows:
        every = r.text.split("\n")
        full = [i for i, x in enumerate(every) if x.strip()]
        gone = set()
        for k in range(len(full) - 2):
            w = tuple(every[i] for i in full[k : k + 3])
            if w in seen:
                gone |= set(full[k : k + 3])
            seen.add(w)
        for size in (1, 2):
            for k in range(len(full) - size + 1):
                w = tuple(every[i] for i in full[k : k + size])
                if sum(map(len, w)) >= 250:
                    if w in seen:
                        gone |= set(full[k : k + size])
                    seen.add(w)
        text = "\n".join(x for i, x in enumerate(every) if i not in gone)
        if not gone or text.strip():
            cleaned[r.doc_id] = text
    kept = {i for i, c in brute_classes(cleaned).items() if i == c}
    left = spark.createDataFrame([(i, cleaned[i]) for i in sorted(kept)], "doc_id long, text string")
    copies = {r.doc_id: r.copies for r in mixing.mix_domains(left, mixing.quality_domains(labels), mixing.WEIGHTS).collect()}
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((i, tuple(library.encode(cleaned[i], add_special_tokens=False).ids)) for i in kept for _ in range(copies[i]))
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in out) == want
    sha = lambda ids: hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert all(r.decoded_sha256 == sha(r.ids) for r in out)


def test_stages_keep_columns_and_bear_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for d in (docs.where("false"), docs.limit(30).selectExpr("if(doc_id = 3, null, doc_id) doc_id", "if(doc_id = 4, null, text) text", "lang", "source", "n_chars", "1 as rate", "2 as row")):
        for name, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, SMALL)
            assert name == "encoding" or d.columns[:5] == docs.columns
        assert d.count() >= 0
