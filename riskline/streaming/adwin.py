"""T4: adaptive-window change detection on a prediction stream (ADWIN-style).

Per stream key the state is an exponential histogram: level i holds at most ``max_buckets``
buckets of 2**i observations (count, sum), so memory is O(max_buckets * log W) for a
window of W observations - no cap on the window, bounded state. After each insert the
window is cut while two sub-windows (split at a bucket boundary) differ in mean by more
than the Hoeffding-style bound eps = sqrt(ln(4 n / delta) / (2 m)), m = 1/(1/n0 + 1/n1),
for values in [0, 1] (probabilities).
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT_SCHEMA = "key string, ts timestamp, n_before long, n_after long, mean_before double, mean_after double"
STATE_SCHEMA = "counts array<long>, sums array<double>"


class Window:
    """Exponential histogram, oldest bucket first."""

    def __init__(self, counts=None, sums=None, max_buckets: int = 5):
        self.counts = list(counts or [])
        self.sums = list(sums or [])
        self.m = max_buckets

    @property
    def n(self) -> int:
        return int(sum(self.counts))

    @property
    def total(self) -> float:
        return float(sum(self.sums))

    def add(self, x: float) -> None:
        self.counts.append(1)
        self.sums.append(float(x))
        self._compress()

    def _compress(self) -> None:
        # sizes never grow from oldest to newest; when a size has more than m buckets,
        # merge its two oldest into one bucket of twice the size (kept in place)
        size = 1
        while self.counts and size <= max(self.counts):
            idx = [i for i, c in enumerate(self.counts) if c == size]
            if len(idx) > self.m:
                i, j = idx[0], idx[1]
                self.counts[i] += self.counts[j]
                self.sums[i] += self.sums[j]
                del self.counts[j], self.sums[j]
                continue
            size *= 2

    def detect(self, delta: float) -> bool:
        """Drop oldest buckets while a cut shows a significant change; True if it cut."""
        cut = False
        while len(self.counts) > 1:
            n, total = self.n, self.total
            n0 = s0 = 0.0
            found = False
            for c, s in zip(self.counts[:-1], self.sums[:-1]):
                n0 += c
                s0 += s
                n1 = n - n0
                m = 1.0 / (1.0 / n0 + 1.0 / n1)
                eps = math.sqrt(math.log(4.0 * n / delta) / (2.0 * m))
                if abs(s0 / n0 - (total - s0) / n1) > eps:
                    found = True
                    break
            if not found:
                break
            del self.counts[0], self.sums[0]
            cut = True
        return cut


def detect_changes(key_col: str, ts_col: str, value_col: str, delta: float = 0.002, max_buckets: int = 5):
    """Function for ``applyInPandasWithState``: emits one row per detected change."""

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            counts, sums = state.get
            win = Window(counts, sums, max_buckets)
        else:
            win = Window(max_buckets=max_buckets)
        out = []
        for pdf in pdfs:
            for ts, x in pdf.sort_values(ts_col)[[ts_col, value_col]].itertuples(index=False):
                before_n, before_mean = win.n, (win.total / win.n if win.n else float("nan"))
                win.add(float(x))
                if win.detect(delta):
                    out.append((str(key[0]), ts, before_n + 1, win.n, before_mean, win.total / win.n))
        state.update((win.counts, win.sums))
        yield pd.DataFrame(out, columns=["key", "ts", "n_before", "n_after", "mean_before", "mean_after"])

    return fn


def adwin_stream(stream: DataFrame, key_col: str, ts_col: str, value_col: str, delta: float = 0.002) -> DataFrame:
    """Change events per key of a (streaming or batch) frame of predictions in [0, 1]."""
    return stream.groupBy(key_col).applyInPandasWithState(
        detect_changes(key_col, ts_col, value_col, delta), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout)
