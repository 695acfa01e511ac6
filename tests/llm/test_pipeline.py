"""The pipeline's stages on small tables, each against a plain version."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from changeloom.llm import quality
from test_corpus_operators import plain_groups, plain_spans, plain_targets, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", None, None), (9002, "", "en", "src1", 0), (9003, "One clean line of text that stands alone here, with a password = hunter22abc in it.", "en", "src1", 82), (9003, "One clean line of text that stands alone here, with a password = hunter22abc in it.", "en", "src1", 82), (None, "Another clean line of text without any number of its own, that nobody else has.", "en", "src2", 80)]
    return base.select(*P.COLUMNS).unionByName(spark.createDataFrame(odd, base.select(*P.COLUMNS).schema)).withColumn("score", F.lit("x")).withColumn("size", F.lit(1))


def test_shape():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "secret scans", "mixing sources", "SentencePiece"] and P.ORACLE_SQL is None


def test_quality_keeps_what_it_scores_high(spark, docs):
    kept = P.keep_quality(spark, docs, SF)
    assert kept.columns == P.COLUMNS
    model = quality.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet"))
    want = [r.doc_id for r in quality.scored(docs.select("doc_id", "text"), model, name="s").where("s >= 0.7").collect()]
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in kept.collect()), key=key) == sorted(want, key=key)


def test_quality_against_labels(spark):
    d = "/root/testdata/sf0.01"
    kept = {r.doc_id for r in P.keep_quality(spark, spark.read.parquet(f"{d}/documents.parquet"), d).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    good, bad = {k for k, v in labels.items() if v == 1}, {k for k, v in labels.items() if v == 0}
    assert len(good & kept) >= 0.98 * len(good) and len(bad & kept) <= 0.05 * len(bad)


def test_one_of_each_group(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = plain_groups(rows, 5, 80, 100)
    got = P.one_of_each_group(spark, docs, SF)
    assert got.columns == P.COLUMNS
    kept = [r.doc_id for r in got.collect()]
    want = {least for (doc, n, least), _ in groups.items() if n and least is not None}
    assert {d for d in kept if d is not None} == want | {9001, 9002} and len(kept) == len(set(kept)) and None in kept


def test_masks(spark, docs):
    before = {(r.doc_id, r.text) for r in docs.collect()}
    after = P.mask_secrets(spark, docs, SF).collect()
    assert len(after) == docs.count()
    by = {}
    for doc, text in before:
        out, at = "", 0
        spans = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in plain_spans(text).split(",") if s))
        for a, b in spans:
            if a >= at:
                out += text[at:a] + P.MASK
            at = max(at, b)
        by.setdefault(doc, set()).add(text if not spans else out + text[at:])
    assert all(r.text in by[r.doc_id] for r in after) and all(r.n_chars == len(r.text) for r in after if P.MASK in (r.text or ""))
    assert any(P.MASK in (r.text or "") for r in after) and not any(re.search("AKIA[A-Z0-9]{16}", r.text or "") for r in after)


def test_mix(spark, docs):
    out = P.mix_sources(spark, docs, SF)
    assert out.columns == P.COLUMNS
    size, taken, rows = {}, {}, {}
    for r in docs.collect():
        size[r.source] = size.get(r.source, 0) + len(words(r.text))
        rows[r.doc_id, r.text] = rows.get((r.doc_id, r.text), 0) + 1
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
        rows[r.doc_id, r.text] -= 1
    assert min(rows.values()) >= -2 * 2
    # each source is within its largest document of its target
    target, largest = plain_targets(size), {}
    for r in docs.collect():
        largest[r.source] = max(largest.get(r.source, 0), len(words(r.text)))
    assert all(abs(taken.get(s, 0) - target[s]) <= largest[s] for s in size)


def test_encode(spark, docs):
    """Ids with the end and decoded texts are the library's."""
    import hashlib

    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_eos=True)
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in P.encode(spark, docs, SF).collect()]
    assert Counter(got) == Counter(want)


def test_empty_tables(spark, docs):
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
