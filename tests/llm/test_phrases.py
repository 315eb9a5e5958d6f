"""Phrase mining against counts of all phrases."""
import random
import re
from collections import Counter, defaultdict

import pytest

from riskline.llm import phrases as P


def plain(docs, least=30, limit=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, words[i:i + size]] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                if 100 * a >= 80 * f[lang, words[i:i + size]]:
                    dropped.add((lang, words[i:i + size]))
    by_lang = defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            by_lang[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {(lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
            for lang, rows in by_lang.items() for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:limit], 1)}


def got(df):
    rows = df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert len(set(rows)) == len(rows)
    return {tuple(r) for r in rows}


def texts(seed, docs, words, vocabulary):
    r = random.Random(seed)
    voc = [f"w{i}" for i in range(vocabulary)] + ["Éa", "a b", "日本"]
    fixed = [" ".join(r.choice(voc) for _ in range(r.randint(2, 6))) for _ in range(25)]
    out = []
    for _ in range(docs):
        parts = [r.choice(fixed) if r.random() < .4 else r.choice(voc) + r.choice(["", ".", ",", "\n", "\t", "  ", ""]) for _ in range(words)]
        out.append((r.choice(["en", "en", "de", None, "und", ""]), " ".join(parts)))
    return out


@pytest.mark.parametrize("limit,vocabulary,seed", [(10, 60, 1), (40, 12, 2), (7, 300, 3), (2000, 25, 4)])
def test_against_all_counts(spark, limit, vocabulary, seed, monkeypatch):
    monkeypatch.setattr(P, "FLUSH_TOKENS", 700)
    monkeypatch.setattr(P, "KNOWN_WORDS", 100)
    rows = texts(seed, 120, 120, vocabulary)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    want = plain(rows, limit=limit)
    assert len(want) > min(limit, 100) / 2
    assert got(P.mine(docs, limit=limit)) == want


def test_crowded_bit_tables(spark, monkeypatch):
    """Keys that pass by chance change nothing."""
    monkeypatch.setattr(P, "BITS_A_KEY", 0)
    monkeypatch.setattr(P.BitTable, "has", lambda self, hashes: hashes >= 0)
    rows = texts(5, 80, 80, 20)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(P.mine(docs, limit=15)) == plain(rows, limit=15)


def test_bit_table(spark):
    import numpy as np
    from pyspark.sql import functions as F
    from zlib import crc32

    keys = spark.range(5000).select(F.lit("ü").alias("lang"), F.concat(F.lit("é "), F.col("id").cast("string")).alias("phrase"))
    table = P.bit_table(keys.select(P._hashed("+").alias("hash"))).value

    def hashes(word):
        first = P._grown_hash(P._start("+", "ü"), crc32(word.encode()))
        return P._grown_hash(first, np.array([crc32(str(i).encode()) for i in range(5000)], dtype=np.int64))

    inside, outside = hashes("é"), hashes("x")
    assert table.has(inside).all() and table.has(outside).mean() < .06


def test_odd_rows(spark, odd, empty):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert got(P.mine(odd)) == plain(rows)
    many = odd.withColumnsRenamed({"doc_id": "f", "source": "phrase", "n_chars": "a"})
    for _ in range(5):
        many = many.unionByName(many)
    assert got(P.mine(many)) == plain(rows * 32)
    assert P.mine(empty).count() == 0


def test_query_on_small_table(spark):
    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("lang", "text").collect()]
    out = entry.queries()["op11_phrases"](spark, d)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got(out) == plain(docs)
