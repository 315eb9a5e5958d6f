"""Every stage of the corpus pipeline against a plain version of it, on its own input; odd and empty tables."""
import itertools
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from riskline.llm import line_dedup, mixing, quality_rules

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"


def words(text):
    return WORD.findall(text or "")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) rows of each stage, the output read back from parquet as ``run`` does."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR).cache()
        seen[name] = (docs.columns, rows_of(docs), out.columns, rows_of(out))
        docs = spark.createDataFrame(out.rdd, out.schema) if name != "packing" else out
    return seen


# ---- quality rules

def xx(value, seed=42):
    return xxhash.xxh64_intdigest(struct.pack("<Q", value), seed=seed)


def buckets(text):
    h = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words(text)]
    return [x % quality_rules.BUCKETS for x in (
        *((v - 2**64 if v >= 2**63 else v) for v in h),
        *((v - 2**64 if v >= 2**63 else v) for v in (xx(b, xx(a)) for a, b in zip(h, h[1:])))
    )]


def kept_by_rules(text, ratios):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    if len(w) < 50 or 100 * len(repeated) > 50 * len(w):
        return False
    grams = buckets(text)
    return round(sum(ratios[g] for g in grams) / len(grams), 6) >= quality_rules.MIN_SCORE


def test_quality_stage(spark, stages):
    columns, before, after_columns, after = stages["quality rules"]
    trusted = {r.doc_id for r in spark.read.parquet(f"{DIR}/labels.parquet").where("quality = 1").collect()}
    raw, target = Counter(), Counter()
    for doc_id, text, *_ in before:
        grams = Counter(buckets(text))
        raw += grams
        target += grams if doc_id in trusted else Counter()
    share = sum(target.values()) / sum(raw.values())
    ratios = {b: float(f"{math.log((target[b] + 10.0) / ((n - 1) * share + 10.0)):.6g}") for b, n in raw.items()}
    assert after_columns == columns
    assert sorted(after) == sorted(r for r in before if kept_by_rules(r[1], ratios))
    assert 0 < len(after) < len(before)


# ---- line dedup

def line_groups(lines):
    texts = sorted(set(lines))
    root = dict(zip(texts, texts, strict=True))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    bags = np.zeros((len(texts), 128), dtype=np.int32)
    for i, t in enumerate(texts):
        for c in t:
            bags[i, min(ord(c), 127)] += 1
    sizes = np.array([len(t) for t in texts])
    for i, x in enumerate(texts):
        if len(x) < line_dedup.MIN_CHARS:
            continue
        near = np.flatnonzero((np.abs(bags - bags[i]).sum(axis=1) <= 4) & (np.abs(sizes - len(x)) <= 2) & (sizes >= line_dedup.MIN_CHARS))
        for j in near:
            if j > i and line_dedup._plain(x, texts[j]) <= 2:
                root[find(x)] = find(texts[j])
    return {t: find(t) for t in texts}


def test_line_stage(stages):
    columns, before, after_columns, after = stages["line dedup"]
    at = {(r[0], k): x.strip(BLANK) for r in before for k, x in enumerate((r[1] or "").split("\n")) if x.strip(BLANK)}
    group = line_groups(list(at.values()))
    first = {}
    for place in sorted(at):
        first.setdefault(group[at[place]], place)
    want = []
    for r in before:
        lines = (r[1] or "").split("\n")
        left = [x for k, x in enumerate(lines) if (r[0], k) not in at or first[group[at[r[0], k]]] == (r[0], k)]
        if len(left) == len(lines) or "\n".join(left).strip(BLANK):
            want.append((r[0], r[1] if len(left) == len(lines) else "\n".join(left), *r[2:]))
    assert after_columns == columns and sorted(after) == sorted(want)
    assert any(a[1] != b[1] for a, b in zip(sorted(before), sorted(after), strict=False))


# ---- near dedup

def test_near_stage(stages):
    columns, before, after_columns, after = stages["near dedup"]
    sets = []
    for r in before:
        w = (r[1] or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    lowest = list(range(len(before)))

    def find(x):
        while lowest[x] != x:
            x = lowest[x]
        return x

    order = sorted(range(len(before)), key=lambda i: before[i][0])
    for i, j in itertools.combinations(order, 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)), key=lambda x: before[x][0])
            lowest[b] = a
    assert after_columns == columns
    assert sorted(after) == sorted(before[i] for i in order if find(i) == i)


# ---- mixing

def test_mixing_stage(stages):
    columns, before, after_columns, after = stages["mixing"]
    assert after_columns == columns
    times, known = Counter(after), set(before)
    assert set(times) <= known and max(times.values()) <= 2
    source = columns.index("source")
    sizes, taken, most = Counter(), Counter(), Counter()
    for r in before:
        n = len(words(r[1]))
        sizes[r[source]] += n
        taken[r[source]] += times[r] * n
        most[r[source]] = max(most[r[source]], n)
    goal = mixing.targets(dict(sizes), 1.5 * sum(sizes.values()))
    for s, n in sizes.items():
        # whole documents: a source is off its target by less than one of its documents
        assert abs(taken[s] - goal[s]) <= max(0.02 * goal[s], most[s])


# ---- packing

def pieces_of(text, tokenizer):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    return [(k, lo, len(ids[lo:lo + 4096]), zlib.crc32(np.asarray(ids[lo:lo + 4096], "<u4").tobytes()))
            for k, lo in enumerate(range(0, len(ids), 4096))]


def check_packing(before, columns, out, text_at=1):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = [dict(zip(columns, r, strict=True)) for r in out]
    want = [(r[0], *p) for r in before for p in pieces_of(r[text_at], tokenizer)]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == Counter(want)
    at = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values(), default=0) <= 4096
    total = sum(r["length"] for r in got)
    assert len(at) <= 1.1 * -(-total // 4096) + 2


def test_packing_stage(stages):
    _, before, columns, out = stages["packing"]
    check_packing(before, columns, out)


# ---- the whole, odd and empty tables

def test_run_is_its_stages(spark, stages):
    _, _, columns, out = stages["packing"]
    keys = [columns.index(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    whole = corpus_pipeline.run(spark, DIR)
    assert whole.columns == columns
    assert Counter(tuple(r[k] for k in keys) for r in rows_of(whole)) == Counter(tuple(r[k] for k in keys) for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "packing"]


def test_stages_on_odd_and_empty_tables(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, DIR)
        rows = rows_of(out)
        assert stage(spark, empty, DIR).count() == 0, name
        if name == "packing":
            check_packing(rows_of(odd), out.columns, rows)
            continue
        assert out.columns == odd.columns and out.schema["kept"].dataType == odd.schema["kept"].dataType, name
        if name == "line dedup":
            assert Counter(r[0] for r in rows) <= Counter(r[0] for r in rows_of(odd))
        elif name == "mixing":
            assert set(rows) <= set(rows_of(odd)) and all(words(r[1]) for r in rows)
        else:
            assert Counter(rows) <= Counter(rows_of(odd)), name
    # equal rows are one document: one of them stays, and the smallest id of near copies
    near = dict(corpus_pipeline.STAGES)["near dedup"](spark, odd, DIR)
    assert sorted(r[0] for r in rows_of(near) if r[0] in (3, 4)) == [3]
