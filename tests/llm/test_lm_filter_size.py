import numpy as np
import pytest

from riskline.llm import lm_score


def test_filter_follows_the_counted_tokens(spark):
    """Short distinct words: many more tokens than bytes / 5, and more entries than tokens."""
    text = " ".join(f"{i:x}" for i in range(250_000))
    bits, blocks, table = lm_score.train(spark.createDataFrame([(text,)], "text string"))
    assert table.count() == 250_001
    assert np.unpackbits(bits).mean() < 0.32
    unseen = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    assert (lm_score.probed(unseen, bits, blocks) > 0).mean() < 0.04


def test_repeated_n_grams_need_no_more_blocks(spark):
    df = spark.createDataFrame([("a b c d " * 100_000,)] * 2, "text string")
    whole, blocks, _ = lm_score.built(df, broadcast_bits=1 << 20)
    assert lm_score.built(df)[1] == 8 and blocks == 1
    level = lm_score.probed(lm_score.word_keys(lm_score.token_hashes(["a zz"])[0]), lm_score._collected(whole, blocks), blocks)
    assert level.tolist() == [*lm_score.levels_of(np.array([200_000]), lm_score.WORD_STEPS), 0, *lm_score.levels_of(np.array([2]), lm_score.WORD_STEPS)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_filter_past_the_broadcast_bound_scores_alike(spark, odd, monkeypatch, kind):
    """A filter that no longer goes to all workers: same blocks, same scores, ids untouched."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").unionByName(
        odd.selectExpr("doc_id + 9007199254740993 as doc_id", "text"))
    docs = docs.withColumn("doc_id", docs.doc_id.cast(kind))
    monkeypatch.setattr(lm_score, "BITS_AN_ENTRY", 64)  # the same blocks both times
    order = ["doc_id", "n_tokens", "score"]
    whole = sorted(lm_score.score(docs).collect(), key=lambda r: str([r[c] for c in order]))
    monkeypatch.setattr(lm_score, "GROUP_TOKENS", 100_000)
    sent = sorted(lm_score.score(docs, broadcast_bits=1 << 20).collect(), key=lambda r: str([r[c] for c in order]))
    assert len(sent) == docs.count()
    for a, b in zip(whole, sent, strict=True):
        assert a[:5] == b[:5] and b.score == pytest.approx(a.score, rel=1e-12) and b.base_score == pytest.approx(a.base_score)


def test_repeated_rows_past_the_broadcast_bound(spark, monkeypatch):
    """Rows with the same id and text are scored once a batch and come back as often as they were; texts are shuffled once."""
    docs = spark.createDataFrame([(7, "a b c")] * 500 + [(None, "x y")] * 3 + [(i, f"a {i} c") for i in range(40)], "doc_id long, text string")
    want = sorted(map(str, lm_score.score(docs).collect()))
    monkeypatch.setattr(lm_score, "GROUP_TOKENS", 50)
    sent = lm_score.score(docs, broadcast_bits=1 << 10)
    assert sorted(map(str, sent.collect())) == want


def test_pair_keys_within_a_block_and_their_span():
    keys = np.sort(np.random.default_rng(3).integers(0, 2**63, 5_000).astype(np.uint64) * np.uint64(2))
    for blocks in (1, 4, 64):
        back = []
        for span, lo, hi, sizes in lm_score._packed(keys, blocks):
            got = lm_score._unpacked(lm_score.within(keys[lo:hi]).astype(np.uint32).tobytes(), sizes)
            assert (got >> np.uint64(32)).tolist() == (lm_score.block_of(keys[lo:hi], blocks) % lm_score.SPAN).tolist()
            assert set((lm_score.block_of(keys[lo:hi], blocks) // lm_score.SPAN).tolist()) == {span}
            back.append(keys[lo:hi])
        assert np.array_equal(np.concatenate(back), keys)


def test_distinct_keys_cost_some_sorts():
    """Hashing them, as plain ``np.unique`` and ``np.setdiff1d`` do, took the CPU time of some fifty sorts."""
    import time

    keys = np.random.default_rng(4).integers(0, 1_200_000, 2_000_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    weight = (np.arange(len(keys)) % 10 > 0).astype(np.int64)

    def seconds(f) -> float:
        took = []
        for _ in range(3):
            at = time.process_time()
            f()
            took.append(time.process_time() - at)
        return min(took)

    found, n = lm_score._weighed(keys, weight)
    want, where = np.unique(keys, return_inverse=True)
    assert np.array_equal(found, want) and np.array_equal(n, np.bincount(where, weights=weight))
    assert np.array_equal(lm_score._distinct([keys], [keys])[1], want)
    one_sort = seconds(lambda: np.sort(keys))
    assert seconds(lambda: lm_score._weighed(keys, weight)) < 25 * one_sort
    assert seconds(lambda: lm_score._distinct([keys], [keys])) < 25 * one_sort


@pytest.mark.parametrize("weights", [[0, 0, 0, 0], [1, 1, 1, 1], [0, 1, 0, 1]])
def test_weighed_keys_with_none_trained_or_none_held_out(weights):
    found, n = lm_score._weighed(np.array([9, 3, 9, 5], np.uint64), np.array(weights))
    assert found.tolist() == [3, 5, 9] and n.tolist() == [weights[1], weights[3], weights[0] + weights[2]]


def test_texts_are_dealt_compressed():
    """Texts cross the network twice, so they are packed by slice: rows of a batch come back once, with their number."""
    import pyarrow as pa

    words = np.random.default_rng(5).integers(0, 3_000, (400, 200))
    texts = [" ".join(f"word{w}" for w in row) for row in words] + [""]
    rows = [(i % 7, i, i % 10 == 0, t) for i, t in enumerate(texts)] + [(3, None, True, "x")] * 5
    batch = pa.RecordBatch.from_pylist([dict(zip(("slice", "doc_id", "held_out", "text"), r, strict=True)) for r in rows])
    out = pa.Table.from_batches(lm_score._collapsed(pa.int64())(iter([batch])))
    assert out.column("slice").to_pylist() == list(range(7))
    assert sum(map(len, out.column("rows").to_pylist())) < 0.5 * sum(map(len, texts))
    back = [(k, *r.values()) for k in range(7) for r in lm_score._opened(out.slice(k, 1)).to_pylist()]
    assert sorted(map(str, back)) == sorted(str((*r, 5 if r[1] is None else 1)) for r in set(rows))
