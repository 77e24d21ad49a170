"""The corpus pipeline stage by stage against brute force."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SMOKE_DIR
from tillroll.llm import ngram_join, queries
from test_decontaminate import brute as contamination
from test_ngram_join import brute as duplicates
from test_pii import base
from test_token_ops import check_packed, wanted_ids


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMOKE_DIR).write.parquet(os.path.join(folder, str(i)))
        docs = spark.read.parquet(os.path.join(folder, str(i)))
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(stages):
    for a, b in zip(stages, stages[1:-1]):
        assert a.columns == b.columns


def test_quality_drops_toxic_and_keeps_good(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMOKE_DIR}/labels.parquet").collect()}
    kept = {i for i, _ in rows(stages[1])}
    toxic = [i for i, r in labels.items() if r.toxic == 1]
    good = [i for i, r in labels.items() if r.toxic == 0 and r.quality == 1]
    # few labels at this size: the words of some languages occur in a document or two
    assert sum(i in kept for i in toxic) < 0.6 * len(toxic)
    assert sum(i in kept for i in good) >= 0.97 * len(good)


def test_join_keeps_one_of_each(stages):
    before = rows(stages[1])
    links, names, sizes = duplicates(before)
    want = {i if not n else c for (i, _), n, c in zip(before, links, names)}
    assert {i for i, _ in rows(stages[2])} == want and stages[2].count() == len(want)
    assert sizes


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    kept = dict(rows(stages[3]))
    for i, text in rows(stages[2])[:60]:
        n, hit, _ = contamination(text, items)
        assert (i in kept) == (not (hit and 20 * hit >= n))
    before = dict(rows(stages[2]))
    assert all(before[i] == t for i, t in kept.items())


def test_personal_data_is_masked(stages):
    before = dict(rows(stages[3]))
    for r in stages[4].collect():
        assert base(r.text) == [] or not base(before[r.doc_id])
        assert r.n_chars == len(r.text)
        if not base(before[r.doc_id]) and "<" not in r.text:
            assert r.text == before[r.doc_id]


def test_packing(stages):
    docs = rows(stages[4])
    want = wanted_ids([t for _, t in docs])
    pieces = stages[5].collect()
    assert sum(p.length for p in pieces) == sum(map(len, want)) and {p.doc_id for p in pieces} == {i for i, _ in docs}
    check_packed(pieces, 2048)


def test_run_and_what_it_leaves(spark, stages, monkeypatch):
    """The rows of the last stage; the masked documents stay, and the sequences decode to their texts."""
    tokenizer = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    left, build = [], corpus_pipeline.build
    monkeypatch.setattr(corpus_pipeline, "build", lambda *a: left.append(build(*a)) or left[-1])
    key = lambda df: {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect()}
    assert key(corpus_pipeline.run(spark, SMOKE_DIR)) == key(stages[5])
    (corpus,) = left
    docs = rows(spark.read.parquet(corpus.documents))
    assert sorted(docs) == sorted(rows(stages[4]))
    packed = spark.read.parquet(corpus.sequences)
    ids = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in corpus_pipeline.sequences(packed).collect()}
    assert all(0 < len(x) <= 2048 for x in ids.values())
    pieces = {}
    for r in packed.collect():
        part = ids[r.sequence_id][r.offset : r.offset + r.length]
        assert part.tobytes() == bytes(r.ids) and zlib.crc32(part.tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, {})[r.start] = part
    assert sum(len(x) for x in ids.values()) == sum(len(p) for d in pieces.values() for p in d.values())
    for doc_id, text in docs:
        got = np.concatenate([pieces[doc_id][k] for k in sorted(pieces[doc_id])]).tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert tokenizer.decode(got[:-1]) == tokenizer.decode(tokenizer.encode(text, add_special_tokens=False).ids)


def test_odd_rows_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    odd = [(1, None, None, None, None), (None, "", "en", None, 0), (2, text, "en", "s", 5), (2, text, "en", "s", 5), (3, text + " a@b.com", None, "s", 9)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("x") for c in ("keep", "row", "doc", "spans", "n_words", "items", "class_id", "_row")})
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SMOKE_DIR)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SMOKE_DIR).count() == 0
    assert ngram_join.without_duplicates(docs).count() == 3
    masked = {r.doc_id: r.text for r in corpus_pipeline.mask_personal_data(spark, docs, SMOKE_DIR).collect()}
    assert masked[3].endswith("<EMAIL>") and masked[2] == text
