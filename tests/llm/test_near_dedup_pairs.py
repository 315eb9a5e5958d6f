import numpy as np

from riskline.llm import near_dedup


def test_near_misses_are_not_confirmed_and_no_link_among_them_is_lost(spark, monkeypatch):
    # 60 texts that share 0.6 of their shingles, pair by pair, and a near copy of each tenth
    core = [f"core{i}" for i in range(229)]
    own = [[f"own{d}x{i}" for i in range(75)] for d in range(60)]
    rows = [(d, " ".join(core + own[d])) for d in range(60)]
    rows += [(100 + d, " ".join(core + own[d][:55] + [f"new{d}x{i}" for i in range(20)])) for d in range(0, 60, 10)]
    real, confirmed = near_dedup._compared, []

    def compared(docs, nodes, pairs, added=False):
        confirmed.append(pairs.count())
        return real(docs, nodes, pairs, added)

    monkeypatch.setattr(near_dedup, "_compared", compared)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d % 100 for d, _ in rows}
    assert sum(confirmed) < 60


def test_parities_never_part_linked_sets(spark):
    rng = np.random.default_rng(7)
    rows = []
    for key, n in enumerate((1, 4, 7, 30, 300, 5000)):
        s = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        for j, changed in ((0, 0), (1, n // 7)):  # n - n // 7 of n + n // 7 in common: 0.75 or just above
            held = np.unique(np.concatenate([s[changed:n], s[n:n + changed]]))
            rows.append((key, 2 * key + j, 2 * key + j, len(held), near_dedup._odd(held).tolist(),
                         near_dedup._planes(near_dedup.minima(held)).tolist()))
    members = spark.createDataFrame(rows, "key long, node long, root long, n_shingles long, odd array<bigint>, planes array<bigint>")
    assert sorted(map(tuple, near_dedup._pairs(members).collect())) == [(2 * k + 1, 2 * k) for k in range(6)]
