"""Token counts and packing against the tokenizers themselves."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from tillroll.llm import packing, queries, token_counts

PIECES, WORDS = queries.tokenizer_file("piece_bpe_32k.model"), queries.tokenizer_file("word_bpe_49k.json")

EDGES = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b   ", "a\n\n b\t c", "▁a▁ b", "<s> x </s> <unk>", "\x00a\x1cb", "é É ﬁ ñ İx",
    "it's don't I'LL we've", "<|endoftext|>x <|startoftext|> <|", "naïve Жук 漢字 12 3½", "é é ́x", "a b c\x85d",
    "Wort,*** und!! 3.14 (x)", "x" * 3000, "wort " * 2500, "THE The the", "º ª µ ß ÿ ÷ ×", "😀 a😀b", "- -- --- ... ?!",
]


def noise(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    letters = "abcdeéñßABÇ   \n\t.,!*'<|>0123▁ж漢́İ"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    return EDGES + noise(300, 1)


def test_token_counts_equal_the_library(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    rows = token_counts.with_token_counts(docs, PIECES, limit=4096).collect()
    for r in rows:
        want = len(sp.encode(texts[r.doc_id] or ""))
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (want, want > 4096, len((texts[r.doc_id] or "").encode())), repr(texts[r.doc_id])


def test_whole_tokens_are_proved(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    known = token_counts.whole_tokens(PIECES)
    assert len(known) > 10_000
    assert all(len(sp.encode(w)) == 1 for w in random.Random(2).sample(known, 500))


def test_counter_with_a_tiny_memory(texts, monkeypatch):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    monkeypatch.setattr(token_counts, "MEMO", 3)
    count = token_counts.token_counter(PIECES, ["the"])
    assert [count(t) for t in texts] == [len(sp.encode(t or "")) for t in texts]


def wanted_ids(texts):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(WORDS)
    return [np.array([*tk.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]


def test_pieces_round_trip(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.piece_tokens(docs, WORDS, capacity=64).collect()
    want = wanted_ids(texts)
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length and r.start == sum(map(len, got.get(r.doc_id, []))) and r.start == 64 * r.piece
        got.setdefault(r.doc_id, []).append(ids)
    assert len(got) == len(texts)
    for i, parts in got.items():
        assert all(len(p) == 64 for p in parts[:-1])
        assert np.concatenate(parts).tolist() == want[i].tolist(), repr(texts[i])


def packed(spark, lengths, **options):
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    return packing.pack(pieces, **options).collect()


def check_packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack_is_gapless_and_tight(spark):
    rng = random.Random(3)
    lengths = [min(2048, int(rng.expovariate(1 / 700)) + 1) for _ in range(3000)]
    rows = packed(spark, lengths, group=700)
    assert sorted(r.length for r in rows) == sorted(lengths)
    assert check_packed(rows, 2048) <= 1.02 * sum(lengths) / 2048 + 1


def test_pack_edges(spark):
    assert packed(spark, []) == []
    assert check_packed(packed(spark, [2048] * 5), 2048) == 5
    assert check_packed(packed(spark, [1024] * 9), 2048) == 5
    nulls = spark.createDataFrame([(None, 10), (None, 10), (2**60 + 1, 10)], "doc_id long, length long").withColumn("offset", F.lit(7))
    rows = packing.pack(nulls).collect()
    assert len(rows) == 3 and check_packed(rows, 2048) == 1 and {r.doc_id for r in rows} == {None, 2**60 + 1}


def test_sum_of_squares_takes_the_smallest_sum():
    """Every placement against all placements tried out on the bins themselves."""
    rng = random.Random(4)
    capacity = 12
    lengths = [rng.randrange(1, 13) for _ in range(200)]
    bins, offsets, _ = packing.sum_of_squares(np.array(lengths), capacity)
    gaps = {}

    def squares(g):
        held = np.bincount([x for x in g.values() if 0 < x < capacity], minlength=capacity + 1)
        return int((held**2).sum())

    for s, b, o in zip(lengths, bins.tolist(), offsets.tolist()):
        options = [squares(gaps | {k: g - s}) for k, g in gaps.items() if 0 < g < capacity and g >= s] + [squares(gaps | {-1: capacity - s})]
        assert o == capacity - gaps.get(b, capacity)
        gaps[b] = gaps.get(b, capacity) - s
        assert gaps[b] >= 0 and squares(gaps) == min(options)


def test_query_packs_every_document(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op9_pack(spark, SMOKE_DIR).collect()
    want = dict(zip([d.doc_id for d in docs], wanted_ids([d.text for d in docs])))
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    for r in rows:
        assert zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert check_packed(rows, 2048) <= 1.05 * sum(map(len, want.values())) / 2048 + 1


def test_query_counts_every_document(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()}
    rows = queries.op10_token_counts(spark, SMOKE_DIR).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(sp.encode(t or "")) for i, t in docs.items()}
