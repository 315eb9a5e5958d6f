import zlib

import numpy as np
import public_tokenizers as P
import pytest

from riskline.llm import packing, token_counts

SMALL = "/root/testdata/sf0.001/documents.parquet"
ODD = ["", " ", "  ", "a  b\nc", " lead", "trail ", "▁", "a ▁ b", "<s> x </s>", "a\x00 b", "　 a b", "a   b c",
       "ΟΔΟΣ, İstanbul. x.", "don't. it's, THE'S.", "<|endoftext|>. <|ENDOFTEXT|>. y,", "é, é. ﬁ.", "1.5, 2,000.", "x" * 3000,
       "日本語。, 字.", "a\x1cb a\xa0b"]


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(SMALL).collect()] + ODD


def test_token_lengths_are_the_librarys(texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    assert token_counts.token_lengths(texts, sp, {}).tolist() == [len(x) for x in sp.encode(texts)]


def test_count_tokens_odd_rows(odd, empty):
    rows = token_counts.count_tokens(odd, P.path("piece_bpe_32k.model")).collect()
    assert len(rows) == odd.count()
    assert [(r.n_bytes, r.n_tokens) for r in rows if r.doc_id == 1] == [(0, 0)]
    assert sum(r.doc_id is None for r in rows) == 2 and any(r.over_limit for r in rows)
    assert token_counts.count_tokens(empty, P.path("piece_bpe_32k.model")).count() == 0


def test_token_ids_are_the_librarys(texts):
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        tokenizer, ends, known = packing._loaded(f.read())
    found = packing.token_bytes(texts, tokenizer, ends, known)
    for text, b in zip(texts, found, strict=True):
        assert np.frombuffer(b, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:60]


def test_token_ids_of_odd_words_are_the_librarys():
    """Letters that grow a mark in lower case, marks on their own, points and commas in every place."""
    import random

    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        loaded = packing._loaded(f.read())
    r = random.Random(11)
    signs = ["İ", "I", "ı", "\u0307", "\u0301", "a", "B", "é", "e\u0301", "Σ", "ß", "ﬁ", "Ǆ", "ŉ", "한", "ᄒ", "ᅡ", "日", "9", ".", ",", ".", ",", " ", " ", "'s", "-", "\n", "\u00a0"]
    texts = ["ANKARALİ. ok", "İ,", "İ\u0307.", "x\u0307. y"] + ["".join(r.choice(signs) for _ in range(r.randint(1, 14))) for _ in range(6000)]
    for text, b in zip(texts, packing.token_bytes(texts, *loaded), strict=True):
        assert np.frombuffer(b, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def _check(rows, capacity):
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_documents_round_trip(spark, odd, empty):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    rows = packing.pack_documents(odd, path, with_ids=True).collect()
    _check(rows, 4096)
    tokenizer = Tokenizer.from_file(path)
    want = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id is not None}
    for doc, text in want.items():
        pieces = {r.piece: r for r in rows if r.doc_id == doc}
        ids = [i for k in sorted(pieces) for i in pieces[k].ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids + [1]
        for k, r in pieces.items():
            assert r.start == 4096 * k and r.length == len(r.ids)
            assert r.ids_crc32 == zlib.crc32(np.asarray(r.ids, "<u4").tobytes())
    assert packing.pack_documents(empty, path).count() == 0


def test_few_sequences_in_one_or_many_groups(spark):
    r = np.random.default_rng(1)
    sizes = [int(x) for x in np.minimum(r.lognormal(6, 1, 6000) + 1, 4096)]
    df = spark.createDataFrame([(i, s, i) for i, s in enumerate(sizes)], "doc_id long, length long, tie long")
    bound = -(-sum(sizes) // 4096)
    for group in (100_000, 1500):
        rows = packing.pack(df, group_pieces=group).collect()
        assert len(rows) == len(sizes)
        assert _check(rows, 4096) <= 1.01 * bound + 2


def test_sum_of_squares_takes_the_smallest_sum():
    """Each step against the definition: the sum over gaps of squared counts after the step."""
    r = np.random.default_rng(2)
    cap, items = 20, [int(x) for x in r.integers(1, 21, 200)]
    bins, offsets = packing.sum_of_squares(np.array(items), cap)
    fill: dict[int, int] = {}
    for s, b, o in zip(items, bins.tolist(), offsets.tolist(), strict=True):
        assert fill.get(b, 0) == o

        def after(fills, cap=cap):
            n = np.bincount([cap - f for f in fills if f < cap], minlength=cap + 1)
            return int((n[1:] ** 2).sum())

        options = [after([*(v for k, v in fill.items() if k != x), fill.get(x, 0) + s])
                   for x in [*fill, -1] if fill.get(x, 0) + s <= cap]
        fill[b] = o + s
        if s < cap:
            assert after(list(fill.values())) == min(options)
