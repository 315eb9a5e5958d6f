import numpy as np

from riskline.llm import packing
from test_counts_packing import _check


def test_groups_never_grow(spark):
    """Hardly any two pieces fit together: no round closes, and still no task gets more than its group."""
    r = np.random.default_rng(3)
    sizes = r.integers(2100, 4071, 6000).tolist()
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long")
    rows = packing.pack(df, group_pieces=500).collect()
    assert sorted(x.doc_id for x in rows) == list(range(6000))
    assert _check(rows, 4096) == 6000
    assert np.unique([x.sequence_id >> 32 for x in rows], return_counts=True)[1].max() < 700
