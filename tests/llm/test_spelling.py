"""Spelling variants against wildcard and deletion forms listed word by word."""
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskline.llm import spelling as S


def plain_words(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def plain_near(n):
    forms = defaultdict(set)
    near = {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            forms[w[:i] + "*" + w[i + 1:]].add(w)
            gone = w[:i] + w[i + 1:]
            if gone in n:
                near[w].add(gone)
                near[gone].add(w)
    for group in forms.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain_variants(docs):
    n = plain_words(docs)
    near = plain_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def got_variants(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def vocabulary(size, seed=1):
    r = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "in", "é", "z", "ÿ"]
    return sorted({"".join(r.choice(parts) for _ in range(r.randint(2, 5))) for _ in range(size)})


def test_trie_against_all_forms():
    words = vocabulary(2_000) + ["a" * 40, "a" * 41, "a" * 39 + "b", "b" + "a" * 39, "", "x", "日本語", "日本誤"]
    freq = np.array([random.Random(w).randint(1, 9) for w in words])
    ones = np.ones(len(words), dtype=np.int64)
    tree = S.Subtree(words, freq, 0)
    n_near, best = tree.near(words, ones, ones)
    near, of = plain_near(dict.fromkeys(words)), dict(zip(words, freq, strict=True))
    for i, w in enumerate(words):
        # the plain forms know no deletion down to the empty word
        assert n_near[i] == len(near[w]), w
        if near[w]:
            assert tree.words[best[i]] == min(near[w], key=lambda x: (-of[x], x))


@pytest.mark.parametrize("limit", [3, 150, 10_000])
def test_subtrees_of_any_size(spark, limit, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_PATHS", 500)
    monkeypatch.setattr(S, "BLOCK_PAIRS", 50)
    words = vocabulary(700) + ["".join(p) for p in ("abcdefg", "bacdefg", "abdcefg", "abcdegf", "gabcdef", "abcdefgh", "abcdefh")]
    n = {w: random.Random(w).randint(1, 9) for w in words}
    got = {r.word: (r.n, r.n_near, r.best) for r in
           S.near_words(spark.createDataFrame(list(n.items()), "word string, n long").repartition(4), limit).collect()}
    near = plain_near(n)
    assert got == {w: (n[w], len(near[w]), min(near[w], key=lambda x: (-n[x], x), default=None)) for w in n}


def test_variants_odd_rows(spark, odd, empty):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert got_variants(S.variants(odd)) == plain_variants(docs)
    assert S.variants(empty).count() == 0


def test_chains_of_forms(spark):
    counts = {"spelling": 6000, "speling": 120, "spelinq": 9, "spelinqs": 2, "abcdefgh": 20, "abcdefgi": 20, "abcdefg": 2,
              "straße": 40, "straßen": 30, "strassen": 3, "ÉTRANGER": 50, "éTRANGER": 5}
    rows = [(i % 40, w) for w, c in counts.items() for i in range(c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = got_variants(S.variants(docs))
    assert got == plain_variants(rows)
    assert any(form and root != form for form, root, *_ in got.values())


def test_query_on_small_table(spark):
    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    out = entry.queries()["op12_spelling"](spark, d)
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert got_variants(out) == plain_variants(docs)
