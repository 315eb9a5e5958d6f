"""PII: patterns, and a character-level bidirectional LSTM with CRF transitions.

The tagger (numpy) is trained on the driver from labelled spans: windows of at most
``TRAIN_DOCS`` documents (a documented bound; those with the smallest hash of the id among
texts with a digit or an at sign), labelled by the base patterns. Its few thousand weights go
to the workers with the function.

Every whole text is searched. A personal datum of the four kinds has a digit or an at sign,
so windows are laid where such characters stand (``REACH`` characters around them, overlapping
by half) and nowhere else. Windows are decoded by Viterbi; where they overlap, each character
takes its tag from the window in whose middle it lies nearest. Runs of one kind that have the
kind's signs (``_plausible``: also a card's check digit, an address's parts of at most 255) are
added if they touch neither a base span nor a match that a pattern's test dropped: what is known
to be no personal datum does not come back by the tagger.

Offsets are code points, end exclusive. Null text counts as empty; empty tables give no rows;
repeated rows are searched each; null ids stay null; other columns are not read; without any
labelled span the tagger adds none.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, text_or_empty

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 2_000
TRAIN_WINDOWS = 3_000
WINDOW, REACH = 96, 40
HIDDEN, EMBED, CHARS = 12, 10, 130
TAGS = len(KINDS) + 1  # 0: none

# The base patterns; look-behinds only spare starts that cannot match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
_SIGN = re.compile("[0-9@]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping; each at sign is tried with the name before it, so long runs stay linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _small_parts(ip: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in ip.split("."))


def matches(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) by the patterns, by kind then start: those that pass their test, and those dropped."""
    kept = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    dropped: list[tuple[int, int, int]] = []
    for m in _IP.finditer(text):
        (kept if _small_parts(m[0]) else dropped).append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if len(digits) >= 13:
            (kept if len(digits) <= 19 and _luhn(digits) else dropped).append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            (kept if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15 else dropped).append((3, m.start(), m.end()))
    return kept, dropped


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the patterns, by kind then start."""
    return matches(text)[0]


def codes_of(text: str) -> np.ndarray:
    """Characters as numbers below CHARS: ASCII as it is, 128 for the others."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.minimum(c, 128)


def windows_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of overlapping windows that cover REACH characters around every digit and at sign."""
    out: list[tuple[int, int]] = []
    zones: list[list[int]] = []
    for m in _SIGN.finditer(text):
        lo, hi = max(0, m.start() - REACH), min(len(text), m.start() + REACH)
        if zones and lo <= zones[-1][1]:
            zones[-1][1] = hi
        else:
            zones.append([lo, hi])
    for lo, hi in zones:
        at = lo
        while True:
            out.append((at, min(hi, at + WINDOW)))
            if at + WINDOW >= hi:
                break
            at += WINDOW // 2
    return out


class Tagger:
    """Bidirectional LSTM with CRF. ``w``: embedding, two directions' weights, output, transitions, start and end."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)

        def init(*shape: int) -> np.ndarray:
            return r.normal(0, shape[0] ** -0.5, shape)

        self.w = {"emb": r.normal(0, 0.5, (CHARS, EMBED)), "out": init(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS),
                  "trans": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS), "last": np.zeros(TAGS)}
        for d in "fb":
            self.w |= {f"x{d}": init(EMBED, 4 * HIDDEN), f"h{d}": init(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN)}
            self.w[f"c{d}"][HIDDEN:2 * HIDDEN] = 1.0  # forget gates begin open

    def _lstm(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (time, batch, HIDDEN) in the direction of x; masked steps carry the state over."""
        w_h, gates_x = self.w[f"h{d}"], x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        h = c = np.zeros((x.shape[1], HIDDEN))
        out = np.empty((len(x), x.shape[1], HIDDEN))
        for t in range(len(x)):
            z = gates_x[t] + h @ w_h
            s = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            if keep is not None:
                keep.append((h, c, i, f, o, g, tc))
            m = mask[t][:, None]
            h, c = m * (o * tc) + (1 - m) * h, m * c_new + (1 - m) * c
            out[t] = h
        return out

    def emissions(self, codes: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """codes, mask: (time, batch), padded at the end."""
        x = self.w["emb"][codes]
        kf, kb = ([], []) if keep is not None else (None, None)
        hf = self._lstm(x, mask, "f", kf)
        hb = self._lstm(x[::-1], mask[::-1], "b", kb)[::-1]
        both = np.concatenate([hf, hb], axis=2)
        if keep is not None:
            keep |= {"x": x, "f": kf, "b": kb, "both": both}
        return both @ self.w["out"] + self.w["bias"]

    def decode(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Most likely tags (time, batch) by Viterbi."""
        e, trans = self.emissions(codes, mask), self.w["trans"]
        steps, n = codes.shape
        best = e[0] + self.w["first"]
        back = np.zeros((steps, n, TAGS), np.int64)
        for t in range(1, steps):
            to = best[:, :, None] + trans
            back[t] = to.argmax(axis=1)
            new = to.max(axis=1) + e[t]
            on = mask[t][:, None] > 0
            best = np.where(on, new, best)
            back[t] = np.where(on, back[t], np.arange(TAGS))
        tags = np.empty((steps, n), np.int64)
        tags[-1] = (best + self.w["last"]).argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(n), tags[t]]
        return tags

    def gradient(self, codes: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the batch and its gradient."""
        kept: dict = {}
        e = self.emissions(codes, mask, kept)
        w, (steps, n) = self.w, codes.shape
        g = {k: np.zeros_like(v) for k, v in w.items()}

        def total(x: np.ndarray, axis: int) -> np.ndarray:
            m = x.max(axis=axis, keepdims=True)
            return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)

        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[0] = e[0] + w["first"]
        for t in range(1, steps):
            alpha[t] = np.where(mask[t][:, None] > 0, total(alpha[t - 1][:, :, None] + w["trans"], 1) + e[t], alpha[t - 1])
        beta[-1] = w["last"]
        for t in range(steps - 2, -1, -1):
            step = total(w["trans"] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(mask[t + 1][:, None] > 0, step, w["last"])
        z = total(alpha[-1] + w["last"], 1)
        d_e = np.exp(alpha + beta - z[:, None]) * mask[:, :, None]
        one = np.eye(TAGS)[tags] * mask[:, :, None]
        loss = z.sum() - (e * one).sum() - w["first"][tags[0]].sum()
        ends = mask.sum(axis=0).astype(int) - 1
        loss -= w["last"][tags[ends, np.arange(n)]].sum()
        g["first"] = (d_e[0] - one[0]).sum(axis=0)
        p_last = np.exp(alpha[-1] + w["last"] - z[:, None])
        g["last"] = p_last.sum(axis=0) - np.eye(TAGS)[tags[ends, np.arange(n)]].sum(axis=0)
        for t in range(1, steps):
            m = mask[t][:, None, None]
            pair = np.exp(alpha[t - 1][:, :, None] + w["trans"] + (e[t] + beta[t])[:, None, :] - z[:, None, None]) * m
            seen = one[t - 1][:, :, None] * one[t][:, None, :]
            g["trans"] += (pair - seen).sum(axis=0)
            loss -= (seen * w["trans"]).sum()
        d_e = (d_e - one) / n
        for k in ("first", "last", "trans"):
            g[k] /= n
        g["out"] = np.einsum("tbh,tbk->hk", kept["both"], d_e)
        g["bias"] = d_e.sum(axis=(0, 1))
        d_both = d_e @ w["out"].T
        d_x = np.zeros_like(kept["x"])
        for d, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[::-1, :, HIDDEN:])):
            x, m_all = (kept["x"], mask) if d == "f" else (kept["x"][::-1], mask[::-1])
            d_h = d_c = np.zeros((n, HIDDEN))
            d_z_all = np.empty((steps, n, 4 * HIDDEN))
            for t in range(steps - 1, -1, -1):
                h0, c0, i, f, o, gg, tc = kept[d][t]
                m = m_all[t][:, None]
                d_h = d_h + part[t]
                d_hm, d_cm = d_h * m, d_c * m
                d_cn = d_cm + d_hm * o * (1 - tc * tc)
                d_z = np.concatenate([d_cn * gg * i * (1 - i), d_cn * c0 * f * (1 - f), d_hm * tc * o * (1 - o), d_cn * i * (1 - gg * gg)], axis=1)
                d_z_all[t] = d_z
                g[f"h{d}"] += h0.T @ d_z
                d_h = d_z @ w[f"h{d}"].T + d_h * (1 - m)
                d_c = d_cn * f + d_c * (1 - m)
            g[f"x{d}"] = np.einsum("tbe,tbk->ek", x, d_z_all)
            g[f"c{d}"] = d_z_all.sum(axis=(0, 1))
            back = d_z_all @ w[f"x{d}"].T
            d_x += back if d == "f" else back[::-1]
        np.add.at(g["emb"], codes.ravel(), (d_x * mask[:, :, None]).reshape(-1, EMBED))
        return loss / n, g

    def fit(self, windows: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = 12, size: int = 64, rate: float = 0.02) -> Tagger:
        """Adam over shuffled batches of (window text, spans within it)."""
        r = np.random.default_rng(5)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        step, epochs = 0, max(epochs, -(-200 * size // max(1, len(windows)))) if windows else 0
        for _ in range(min(epochs, 60)):
            order = r.permutation(len(windows))
            for at in range(0, len(order), size):
                some = [windows[i] for i in order[at:at + size]]
                codes, mask = padded([codes_of(t) for t, _ in some])
                tags = np.zeros_like(codes)
                for b, (_, spans) in enumerate(some):
                    for kind, s, e in spans:
                        tags[s:e, b] = kind + 1
                _, g = self.gradient(codes, mask, tags)
                step += 1
                norm = max(1.0, sum(float((x * x).sum()) for x in g.values()) ** 0.5 / 5)
                for k, (a, v) in moments.items():
                    x = g[k] / norm
                    a += 0.1 * (x - a)
                    v += 0.01 * (x * x - v)
                    self.w[k] -= rate / (1 + step / 300) * (a / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self


def padded(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, batch) arrays of the codes and of 1 where there is a character."""
    steps = max(map(len, codes))
    out, mask = np.full((steps, len(codes)), 129, np.int64), np.zeros((steps, len(codes)))
    for b, c in enumerate(codes):
        out[:len(c), b] = c
        mask[:len(c), b] = 1
    return out, mask


def _plausible(kind: int, text: str) -> bool:
    digits = _NOT_DIGIT.sub("", text)
    if kind == 0:
        return "@" in text[1:-1]
    if kind == 1:
        return len(digits) >= 4 and text.count(".") == 3 and bool(_IP.fullmatch(text)) and _small_parts(text)
    if kind == 2:
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return 9 <= len(digits) <= 15


def _whole_numbers(text: str, kind: int, lo: int, hi: int) -> tuple[int, int]:
    """A run without blanks at its ends; one of numbers begins and ends with whole digit groups."""
    while lo < hi and text[lo].isspace():
        lo += 1
    while hi > lo and text[hi - 1].isspace():
        hi -= 1
    if kind == 0:
        return lo, hi
    opens = "0123456789+(" if kind == 3 else "0123456789"
    while lo < hi and text[lo] not in opens:
        lo += 1
    while hi > lo and text[hi - 1] not in "0123456789":
        hi -= 1
    while lo < hi and lo > 0 and text[lo - 1] in "0123456789" and text[lo] in "0123456789":
        lo -= 1
    while lo < hi < len(text) and text[hi] in "0123456789":
        hi += 1
    return lo, hi


def tagged_spans(texts: list[str], tagger: Tagger, batch: int = 512) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) of each text by the tagger, overlapping windows reconciled."""
    places = [(i, lo, hi) for i, t in enumerate(texts) for lo, hi in windows_of(t)]
    chosen: list[dict[int, tuple[int, int]]] = [{} for _ in texts]  # position -> (distance from the window's edge, tag)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for at in range(0, len(places), batch):
        some = places[at:at + batch]
        tags = tagger.decode(*padded([codes_of(texts[i][lo:hi]) for i, lo, hi in some]))
        for b, (i, lo, hi) in enumerate(some):
            if not tags[:hi - lo, b].any() and not chosen[i]:
                continue
            for t, tag in enumerate(tags[:hi - lo, b].tolist()):
                edge = min(t if lo else WINDOW, hi - lo - 1 - t if hi < len(texts[i]) else WINDOW)
                if edge > chosen[i].get(lo + t, (-1, 0))[0]:
                    chosen[i][lo + t] = (edge, tag)
    for i, tags_at in enumerate(chosen):
        run: list[int] = []
        for p in [*sorted(p for p, (_, tag) in tags_at.items() if tag), None]:
            if run and (p is None or p != run[-1] + 1 or tags_at[p][1] != tags_at[run[0]][1]):
                kind = tags_at[run[0]][1] - 1
                lo, hi = _whole_numbers(texts[i], kind, run[0], run[-1] + 1)
                if lo < hi and (not out[i] or out[i][-1][2] <= lo) and _plausible(kind, texts[i][lo:hi]):
                    out[i].append((kind, lo, hi))
                run = []
            if p is not None:
                run.append(p)
    return out


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_windows: int = TRAIN_WINDOWS) -> Tagger:
    """Fit a tagger on windows of a bounded sample of (doc_id, text), labelled by the base patterns."""

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, kinds, starts, ends = [], [], [], []
            for t in batch.column(0).to_pylist():
                spans = base_spans(t)
                for lo, hi in windows_of(t):
                    inside = [(k, s - lo, e - lo) for k, s, e in spans if lo <= s and e <= hi]
                    if any(s < hi and e > lo and not (lo <= s and e <= hi) for _, s, e in spans):
                        continue  # a span that the window cuts would teach the wrong edges
                    text.append(t[lo:hi])
                    for col, j in ((kinds, 0), (starts, 1), (ends, 2)):
                        col.append([x[j] for x in inside])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(kinds, ints), pa.array(starts, ints),
                                              pa.array(ends, ints)], names=["text", "kinds", "starts", "ends"])

    rich = docs.where(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull())
    ids = rich.select(F.col("doc_id").alias("id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    windows = (rich.join(F.broadcast(ids), F.col("doc_id") == F.col("id"), "left_semi").select("text")
               .mapInArrow(labelled, "text string, kinds array<int>, starts array<int>, ends array<int>"))
    rows = windows.orderBy(F.xxhash64("text"), "text", "kinds", "starts").limit(train_windows).collect()
    return Tagger().fit([(r.text, list(zip(r.kinds, r.starts, r.ends, strict=True))) for r in rows])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end), ``kind`` being the place in KINDS, by kind then start."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    tagger = tagger or train(docs)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at, n in byte_slices(batch.column(1), 1 << 22):
                rows = batch.slice(at, n)
                texts = [t or "" for t in rows.column(1).to_pylist()]
                both = [matches(t) for t in texts]
                base = [kept for kept, _ in both]
                added = [sorted(x for x in more if not any(x[1] < e and s < x[2] for _, s, e in kept + dropped))
                         for (kept, dropped), more in zip(both, tagged_spans(texts, tagger), strict=True)]
                cols = [pa.array([[dict(zip(("kind", "start", "end"), x, strict=True)) for x in xs] for xs in col], kind) for col in (base, added)]
                yield pa.RecordBatch.from_arrays([rows.column(0), *cols], names=["doc_id", "base", "added"])

    # texts without a digit or an at sign have no span of any kind and stay in the JVM
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind:int,start:bigint,end:bigint>>"
    return docs.select("doc_id", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text")).mapInArrow(
        spans, f"doc_id {id_type}, base {span}, added {span}")
