import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from riskline.llm import fingerprints, line_dedup, lm_score, mixing, near_dedup, queries

DIR = "/root/testdata/sf0.01"


def _words(text):
    return (text or "").encode().split()


# ---- mixing

def test_targets_by_hand():
    got = mixing.targets({"a": 10, "b": 100, None: 100}, 300.0)
    # a stops at 20; 280 by 2 : 1 is 186.67 and 93.33
    assert got["a"] == 20 and got["b"] == pytest.approx(280 * 2 / 3) and got[None] == pytest.approx(280 / 3)


def test_flow_is_cheapest():
    """Small overlapping networks against trying all integer flows."""
    r = random.Random(5)
    for _ in range(25):
        supply = [r.randint(1, 3) for _ in range(3)]
        routes = [[0], [1], [0, 1]]
        quota = [r.randint(0, 6), r.randint(0, 6)]
        flow = mixing.min_cost_flow(supply, routes, quota)
        sent = [sum(f.values()) for f in flow]
        into = [sum(f.get(j, 0) for f in flow) for j in range(2)]
        assert all(s <= 2 * x for s, x in zip(sent, supply, strict=True)) and all(a <= b for a, b in zip(into, quota, strict=True))

        def cost(total, x):
            return min(total, x) + 3 * max(0, total - x)

        best = (0, 0)
        for a, b, c0, c1 in itertools.product(range(7), repeat=4):
            t = [a, b, c0 + c1]
            if all(s <= 2 * x for s, x in zip(t, supply, strict=True)) and a + c0 <= quota[0] and b + c1 <= quota[1]:
                best = min(best, (-sum(t), sum(map(cost, t, supply))))
        assert (-sum(sent), sum(map(cost, sent, supply))) == best


def test_mix_query(spark):
    rows = queries.op3_mixing(spark, DIR).collect()
    src = {r.doc_id: r.source for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    by: dict = {}
    for r in rows:
        assert r.size == len(_words(text[r.doc_id])) and r.taken in (0, r.size, 2 * r.size)
        by.setdefault(src[r.doc_id], []).append(r)
    want = mixing.targets({s: sum(r.size for r in rs) for s, rs in by.items()}, 1.5 * sum(r.size for r in rows))
    for s, rs in by.items():
        assert rs[0].target == pytest.approx(want[s]) and rs[0].source_size == sum(r.size for r in rs)
        assert abs(sum(r.taken for r in rs) - want[s]) <= 0.01 * want[s]
    again = {(r.doc_id, r.taken) for r in queries.op3_mixing(spark, DIR).repartition(3).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mix_overlapping_sources(spark):
    r = random.Random(1)
    rows = [(i, " ".join(["w"] * r.randint(1, 40)), r.choice([["a"], ["b"], ["a", "b"], []])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mixing.mix(df, weights=(1, 1), share=1.2).collect()
    assert all(g.taken == 0 for g in got if not g.source)
    routed: Counter = Counter()
    for pattern in {tuple(sorted(g.source)) for g in got}:
        one = next(g for g in got if tuple(sorted(g.source)) == pattern)
        given = sum(x.words for x in one.routed)
        routed.update({x.source: x.words for x in one.routed})
        assert abs(sum(g.taken for g in got if tuple(sorted(g.source)) == pattern) - given) <= 20
    assert sum(routed.values()) == pytest.approx(1.2 * sum(g.size for g in got), abs=2)


def test_mix_odd_rows(spark, odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(r.taken <= 2 * r.size for r in rows)
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


# ---- near-dedup

def _sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def _groups(ids, sets):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(ids)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    low: dict = {}
    for i, x in enumerate(ids):
        low[find(i)] = min(low.get(find(i), x), x)
    return [low[find(i)] for i in range(len(ids))]


def test_near_dedup_query(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    sets = _sets([d.text for d in docs])
    want = {d.doc_id: (len(s), g, g == d.doc_id) for d, s, g in zip(docs, sets, _groups([d.doc_id for d in docs], sets), strict=True)}
    rows = queries.op5_near_dedup(spark, DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == want


def test_near_dedup_large_groups_near_the_threshold(spark):
    """Edited copies, chains of longer and longer texts, and a passage that many share: every component as by brute force."""
    r = random.Random(2)

    def prose(n):
        return [f"w{r.randint(0, 4000)}" for _ in range(n)]

    base, chain, passage = prose(140), prose(400), prose(60)
    texts = []
    for _ in range(120):
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = f"e{r.randint(0, 10**6)}"
        texts.append(w)
    texts += [chain[:n] for n in range(40, 400, 7)]
    texts += [passage + prose(r.randint(5, 60)) for _ in range(40)]
    texts += [t[:] for t in texts[:30]] + [[], ["a"], ["a"], ["A"], ["a", "b"]]
    r.shuffle(texts)
    texts = [" ".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near_dedup.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == _groups(list(range(len(texts))), _sets(texts))
    kept = near_dedup.deduplicated(df.union(df))
    assert sorted(x.doc_id for x in kept.collect()) == sorted(i for i, g in got.items() if i == g)


def test_near_dedup_odd_rows(odd, empty):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (3, 4)} == {3}
    assert all(r.component_id == r.doc_id for r in rows if not r.n_shingles)
    assert near_dedup.deduplicated(odd).columns == odd.columns
    assert near_dedup.near_duplicates(empty).count() == 0


# ---- line dedup

def test_banded_distance():
    r = random.Random(3)
    for k in (1, 2, 3):
        xs, ys = [], []
        for _ in range(1500):
            x = [r.choice("abc") for _ in range(r.randint(1, 30))]
            y = list(x)
            for _ in range(r.randint(0, 4)):
                i = r.randrange(len(y) + 1)
                y[i:i + r.randint(0, 1)] = r.choice(["", "a", "b"])
            xs.append("".join(x))
            ys.append("".join(y))
        got = line_dedup.banded_distances(xs, ys, k)
        assert got.tolist() == [min(k + 1, line_dedup._plain(x, y)) for x, y in zip(xs, ys, strict=True)]


def _line_groups(lines):
    texts = sorted(set(lines))
    root = {t: t for t in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(texts, 2):
        if min(len(x), len(y)) >= line_dedup.MIN_CHARS and abs(len(x) - len(y)) <= 2 and line_dedup._plain(x, y) <= 2:
            root[find(x)] = find(y)
    return {t: find(t) for t in texts}


def test_line_classes_against_brute_force(spark):
    r = random.Random(4)
    seeds = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(20, 60))).strip() for _ in range(12)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(r.randint(1, 6)):
            x = list(r.choice(seeds))
            for _ in range(r.randint(0, 3)):
                p = r.randrange(len(x) + 1)
                x[p:p + r.randint(0, 1)] = r.choice(["", "x", "y"])
            lines.append("".join(x))
        docs.append((i, "\n".join([*lines, " ", "tiny"])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = line_dedup.line_classes(df).collect()
    at = {(i, k): x.strip() for i, t in docs for k, x in enumerate(t.split("\n")) if x.strip()}
    group = _line_groups(list(at.values()))
    first: dict = {}
    for p in sorted(at):
        first.setdefault(group[at[p]], p)
    assert {(x.doc_id, x.line_no): x.kept for x in rows} == {p: first[group[t]] == p for p, t in at.items()}
    by: dict = {}
    for x in rows:
        by.setdefault(x.class_id, set()).add(group[at[x.doc_id, x.line_no]])
    assert all(len(v) == 1 for v in by.values()) and len(by) == len(set(group.values()))
    left = {x.doc_id: x.text for x in line_dedup.deduplicated(df).collect()}
    for i, t in docs:
        lines = [x for k, x in enumerate(t.split("\n")) if not x.strip() or first[group[x.strip()]] == (i, k)]
        assert left.get(i) == ("\n".join(lines) if any(x.strip() for x in lines) else None)


def test_crowded_line_keys_against_brute_force(spark):
    """Many lines of one pattern: keys with far more lines than are listed, and links that only deeper keys show."""
    r = random.Random(6)
    lines = []
    for i in range(90):
        word = "".join(r.choice("abcdefgh") for _ in range(6))
        lines.append(f"the same long beginning of a line {word} and the same end")
        if i % 3 == 0:  # near that line, not the others
            lines.append(lines[-1].replace(word, word[:2] + "zz" + word[4:]))
            lines.append(lines[-1].replace("long", "log"))
    lines += [f"number {i:03d} of a form that holds little else" for i in range(0, 400, 7)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got: dict = {}
    for x in line_dedup.line_classes(df).collect():
        got.setdefault(x.class_id, set()).add(x.doc_id)
    want: dict = {}
    group = _line_groups(lines)
    for i, x in enumerate(lines):
        want.setdefault(group[x], set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def _near_copies():
    """Copies of a long line with words replaced here and there, some of them near each other."""
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(40)]
    lines = []
    for i in range(80):
        copy = list(words)
        for _ in range(r.randint(1, 4)):
            copy[r.randrange(40)] = "".join(r.choice("stuvwxyz") for _ in range(6))
        lines.append(" ".join(copy))
        if i % 4 == 0:
            lines += [lines[-1].replace(copy[20], copy[20] + "q", 1), lines[-1][:-1]]
    return lines


@pytest.mark.parametrize("few", [None, 12, 3])
def test_near_copies_of_a_line_against_brute_force(spark, monkeypatch, few):
    """A group of near copies is listed, not cut anew; smaller limits take the same lines through the deeper keys."""
    cut = []
    deeper = line_dedup._deeper
    monkeypatch.setattr(line_dedup, "_deeper", lambda *a: cut.append(a) or deeper(*a))
    if few:
        monkeypatch.setattr(line_dedup, "FEW", few)
    lines = _near_copies()
    got: dict = {}
    for x in line_dedup.line_classes(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect():
        got.setdefault(x.class_id, set()).add(x.doc_id)
    want: dict = {}
    group = _line_groups(lines)
    for i, x in enumerate(lines):
        want.setdefault(group[x], set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert bool(cut) == bool(few)


def test_lines_odd_rows(odd, empty):
    out = line_dedup.deduplicated(odd)
    assert out.columns == odd.columns
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(3) == 2 and 4 not in ids  # equal rows are one document; the other copy goes
    assert line_dedup.line_classes(empty).count() == 0


# ---- fingerprints

def test_fingerprint_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect())
    rows = {r.doc_id: r for r in queries.op6_fingerprints(spark, DIR).collect()}
    assert len(rows) == len(docs)
    for i, (doc, text) in enumerate(docs):
        nxt, r = docs[(i + 1) % len(docs)][1], rows[doc]
        k = len(text) // 4
        new = text[:len(text) - k] + nxt[:k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == fingerprints.to_hex(*fingerprints.vector(fingerprints.paragraphs(text)))
        assert r.edited_fingerprint == fingerprints.to_hex(*fingerprints.vector(fingerprints.paragraphs(new)))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    long = [rows[d] for d, t in docs if len(t) > 1000]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95


def test_fingerprint_is_homomorphic():
    a, b = ["x y", "z"], ["q", "x y"]
    one = fingerprints.to_hex(*fingerprints.vector(a + b))
    assert one == fingerprints.to_hex(*fingerprints.vector(b[::-1] + a))
    assert fingerprints.inserted(fingerprints.to_hex(*fingerprints.vector(a)), b) == one
    assert fingerprints.deleted(one, b) == fingerprints.to_hex(*fingerprints.vector(a))


def test_next_document_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 40)
    for ids in (range(300), [5], [None, 3, None, 9]):
        docs = [(i, f"text number {i} {n}" * 3) for n, i in enumerate(ids)]
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
        got = {r.text: r.next for r in fingerprints.with_next(df).collect()}
        assert len(got) == len(docs)
        order = [t for i, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0))]
        if None not in ids:
            assert got == {t: order[(k + 1) % len(order)] for k, t in enumerate(order)}
        else:
            assert got[order[-1]] in order[:2] and sorted(got.values()) == sorted(order)


def test_fingerprint_odd_rows(odd, empty):
    assert fingerprints.edited(odd).count() == odd.count()
    assert fingerprints.fingerprints(odd).count() == odd.count()
    assert fingerprints.edited(empty).count() == 0


# ---- LM scoring

def test_lm_query(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.op10_lm_score(spark, DIR).collect()}
    tokens = {d.doc_id: [*(d.text or "").encode().lower().split(), "end"] for d in docs}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(t), n) and r.n_known == sum(w in c for w in t)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
    seen = [r for i, r in rows.items() if not held[i]]
    assert sum(r.score for r in seen) > sum(r.base_score for r in seen)
    rest = [r for i, r in rows.items() if held[i]]
    assert sum(r.score for r in rest) / sum(r.n_tokens for r in rest) > sum(r.base_score for r in rest) / sum(r.n_tokens for r in rest) - 0.1


def test_filter_keeps_quantised_counts(spark):
    df = spark.createDataFrame([("a b " * 40 + "c",), ("a d",)], "text string")
    bits, blocks, table = lm_score.train(df)
    h, starts = lm_score.token_hashes(["a b c d zz"])
    level = lm_score.probed(lm_score.word_keys(h), bits, blocks)
    assert level.tolist()[:4] == lm_score.levels_of(np.array([41, 40, 1, 1]), lm_score.WORD_STEPS).tolist() and level[4] == 0
    pairs = lm_score.probed(lm_score.pair_keys(h, starts), bits, blocks)
    assert pairs.tolist()[:3] == [2, 6, 1] and pairs[3] == 0  # start a: 2, a b: 40, b c: 1, c d: never
    assert {r.c for r in table.collect()} == {41, 40, 1, 2}


def test_lm_rare_words_are_joined_and_groups_are_merged(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = {r.doc_id: r for r in lm_score.score(docs).collect()}
    few = {r.doc_id: r for r in lm_score.score(docs, top_words=5).collect()}
    assert all(few[i].n_known == r.n_known and few[i].base_score == pytest.approx(r.base_score) for i, r in whole.items())
    monkeypatch.setattr(lm_score, "GROUP_TOKENS", 1000)
    cut = {r.doc_id: r for r in lm_score.score(docs).collect()}
    assert all(cut[i].score == pytest.approx(r.score) for i, r in whole.items())


def test_lm_odd_rows(spark, odd, empty):
    rows = lm_score.score(odd).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) for r in rows)
    assert lm_score.score(empty).count() == 0
    none = lm_score.score(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).first()
    assert none.held_out and none.base_score == pytest.approx(0) and none.train_tokens == 0


# ---- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as c

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, docs.cache()
    for name, stage in c.STAGES[:4]:
        seen = stage(spark, seen, sf_dir).cache()
        assert seen.columns == columns and seen.count() > 0, name
    out = c.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
