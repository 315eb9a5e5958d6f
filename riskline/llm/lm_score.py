"""LM scoring with a log-frequency Bloom filter.

Counting: tasks hash words and word pairs of the training texts (64 bits), sum them up
locally and send them packed to the blocks that their hashes give, pairs by 32 bits within a
block (a block has less than 2**17 of them: an error far below the filter's own); each block
has all occurrences of its n-grams and so their counts, exact for words. The count c of an n-gram is quantised to a level, 1 +
floor(steps * log2(c)) (4 steps for words, 1 for pairs), and the n-gram is put into the
filter once for each level up to it. The filter is cut into blocks of 2**20 bits by the
n-gram's hash, so groups fill it independently. The number of blocks follows the counted
tokens and entries without a ceiling: there are at least ``BITS_AN_ENTRY`` bits for each
(n-gram, level) put in, so the fill stays under 1 - exp(-3 / 8) = 31 % at any size.

Scoring: an n-gram's level is found by probing 1, 2, ... until a probe misses. A filter of at
most ``BROADCAST_BITS`` (4 MB) goes to all workers. A larger one stays with the tasks that fill
it: texts are dealt to slices by a hash of id and text, a slice sends its distinct n-grams with
their counts to the blocks, and the task that has filled a block probes it for all that were
sent and gives a byte for each back, in order. No text is written to the shared folder, no block
leaves its task, and both ways give the same scores. Rows with the same id and text are
one row with a count within each Arrow batch, so many of them do not fill a slice; texts are dealt compressed. With the
counts f read so, p(w | v) = PAIR * f(vw) / f(v) + (1 - PAIR) * (f(w) + 0.1) / (N + 0.1 (V + 1)).

Base score: exact counts. Those of the ``TOP_WORDS`` most frequent training tokens go to all
workers (bounded); the other tokens of a text are joined with the count table.

Defined results: null text is empty (one token, the end); null ids count as the empty text in
the crc32, so they are held out; without training texts every probability is 1; repeated rows
are scored each; other columns are not read; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import SPACE, byte_slices, checkpointed, text_or_empty

BLOCK_BITS = 20
#: Neighbouring blocks that a task fills or probes together.
SPAN = 8
BROADCAST_BITS = 1 << 25
BITS_A_TOKEN = 6
BITS_AN_ENTRY = 8
PROBES = 3
WORD_STEPS, PAIR_STEPS = 4, 1
PAIR = 0.25
TOP_WORDS = 200_000
GROUP_TOKENS = 1 << 21
BYTES_A_TOKEN = 6
CACHE_WORDS = 300_000
ADD = 0.1
START, END = np.uint64(0x5DEECE66D1CE4E5B), np.uint64(0x2545F4914F6CDD1D)
_P = np.uint64(0x9E3779B97F4A7C15)
_WORD_SALT = np.uint64(0xD6E8FEB86659FD93)
_WORDS: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words, then the end) of the texts, and where each text's tokens begin."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    if len(_WORDS) > CACHE_WORDS:
        _WORDS.clear()
    known = _WORDS
    parts, starts, n = [], np.empty(len(texts), np.int64), 0
    for i, t in enumerate(texts):
        ws = t.encode("utf-8", "surrogatepass").lower().split()
        for w in set(ws).difference(known):
            known[w] = digest(w)
        h = np.empty(len(ws) + 1, np.uint64)
        h[:-1] = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        h[-1] = END
        parts.append(h)
        starts[i], n = n, n + len(h)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), starts


def word_keys(h: np.ndarray) -> np.ndarray:
    return _mixed(h ^ _WORD_SALT)


def pair_keys(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Key of each token together with the one before it."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[starts] = START
    return _mixed(_mixed(before * _P + np.uint64(1)) + h)


def levels_of(counts: np.ndarray, steps: int) -> np.ndarray:
    return 1 + np.floor(steps * np.log2(np.maximum(counts, 1))).astype(np.int64)


def counts_of(levels: np.ndarray, steps: int) -> np.ndarray:
    """A count in the middle of the level; 0 for level 0, 1 for level 1."""
    return np.where(levels <= 1, levels, 2.0 ** ((levels - 0.5) / steps))


def within(keys: np.ndarray) -> np.ndarray:
    """What tells keys of one block apart: the low 32 bits."""
    return keys & np.uint64(0xFFFFFFFF)


def _bits(keys: np.ndarray, level: int, probe: int) -> np.ndarray:
    """Places in the block; ``keys`` are those within it."""
    x = keys + np.uint64((level * 0xA24BAED4963EE407 + probe * 0x9FB21C651E98DF25) & (2**64 - 1))
    return (_mixed(x) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


def probed(keys: np.ndarray, filter_bytes: np.ndarray, blocks: int) -> np.ndarray:
    """Level of each key: probe upwards until one misses."""
    return _probed(within(keys), block_of(keys, blocks), filter_bytes)


def _probed(keys: np.ndarray, block: np.ndarray, filter_bytes: np.ndarray) -> np.ndarray:
    level = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    base = block << BLOCK_BITS
    for j in range(1, 64 * WORD_STEPS):
        for i in range(PROBES):
            at = base[alive] + _bits(keys[alive], j, i)
            alive = alive[(filter_bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        if not len(alive):
            break
        level[alive] = j
    return level


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    """The block is given by the top bits; ``blocks`` is a power of two."""
    shift = 64 - (blocks.bit_length() - 1)
    return (keys >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64)


def _packed(keys: np.ndarray, blocks: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(span, from, to, sizes) of sorted keys: those of a span of blocks stand together; sizes: how many each of its blocks has."""
    ends = np.searchsorted(block_of(keys, blocks), np.arange(-(-blocks // SPAN) * SPAN), side="right")
    sizes = np.diff(ends, prepend=0).astype(np.uint32).reshape(-1, SPAN)
    bounds = np.concatenate([[0], ends[SPAN - 1::SPAN]])
    for span in np.flatnonzero(np.diff(bounds)):
        yield int(span), int(bounds[span]), int(bounds[span + 1]), sizes[span].tobytes()


def _unpacked(found: bytes, sizes: bytes) -> np.ndarray:
    """Block in the span (high half) and key within the block (low half)."""
    block = np.repeat(np.arange(SPAN, dtype=np.uint64), np.frombuffer(sizes, np.uint32))
    return (block << np.uint64(32)) | np.frombuffer(found, np.uint32)


def _counted(blocks: int, subs: int):
    """Tasks: (group, kind, packed keys, their sizes by block, packed counts).

    Kinds: words (their hashes, since the count table needs them), pairs met once (no counts), other pairs.
    """
    spans = -(-blocks // SPAN)

    def send(h: list[np.ndarray], pairs: list[np.ndarray]) -> pa.RecordBatch:
        group, kind, keys, sizes, counts = [], [], [], [], []

        def add(grp: int, k: int, found: np.ndarray, size: bytes, n: np.ndarray | None) -> None:
            group.append(grp)
            kind.append(k)
            keys.append(found.tobytes())
            sizes.append(size)
            small = n is not None and n.max() < 256
            counts.append(None if n is None else b"\1" + n.astype(np.uint8).tobytes() if small else b"\4" + n.astype(np.uint32).tobytes())

        found, n = np.unique(np.concatenate(h), return_counts=True)
        key = word_keys(found)
        to = block_of(key, blocks) // SPAN * subs + ((key >> np.uint64(8)) % np.uint64(subs)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        to, found, n = to[order], found[order], n[order]
        cut = np.flatnonzero(np.diff(to)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(to)], strict=True):
            if hi > lo:
                add(int(to[lo]), 0, found[lo:hi], b"", n[lo:hi])
        found, n = np.unique(np.concatenate(pairs), return_counts=True)
        for k, chosen in ((1, n == 1), (2, n > 1)):
            for sub in range(subs):
                mine = chosen if subs == 1 else chosen & ((found >> np.uint64(8)) % np.uint64(subs) == sub)
                some, times = found[mine], n[mine]
                for span, lo, hi, size in _packed(some, blocks):
                    add(span * subs + sub, k, within(some[lo:hi]).astype(np.uint32), size, times[lo:hi] if k == 2 else None)
        assert not group or max(group) < spans * subs
        return pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.array(kind, pa.int32()), pa.array(keys, pa.binary()),
                                           pa.array(sizes, pa.binary()), pa.array(counts, pa.binary())],
                                          names=["grp", "kind", "found", "sizes", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, pairs, held = [], [], 0
        for batch in batches:
            for at, n in byte_slices(batch.column(0), 1 << 21):
                tokens, starts = token_hashes(batch.column(0).slice(at, n).to_pylist())
                h.append(tokens)
                pairs.append(pair_keys(tokens, starts))
                held += len(tokens)
                if held >= GROUP_TOKENS:
                    yield send(h, pairs)
                    h, pairs, held = [], [], 0
        if held:
            yield send(h, pairs)

    return count


def _times(n: bytes | None, size: int) -> np.ndarray:
    if n is None:
        return np.ones(size, np.uint32)
    return np.frombuffer(n, np.uint8, offset=1).astype(np.uint32) if n[0] == 1 else np.frombuffer(n[1:], np.uint32)


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(where, weights=np.concatenate(times), minlength=len(found)).astype(np.int64)


def _filled(blocks: int, subs: int):
    def fill(asked: pa.Table) -> pa.Table:
        span = asked.column("grp")[0].as_py() // subs
        rows = [asked.column(c).to_pylist() for c in ("kind", "found", "sizes", "n")]
        keys: tuple[list, list] = ([], [])
        times: tuple[list, list] = ([], [])
        for kind, found, sizes, n in zip(*rows, strict=True):
            found = np.frombuffer(found, np.uint64) if kind == 0 else _unpacked(found, sizes)
            keys[kind > 0].append(found)
            times[kind > 0].append(_times(n, len(found)))
        here = min(SPAN, blocks)
        bits = np.zeros(here << BLOCK_BITS, dtype=np.uint8)
        words, counts = _summed(keys[0], times[0])
        both, n = _summed(keys[1], times[1])
        word = word_keys(words)
        entries = 0
        for block, key, c, steps in ((block_of(word, blocks) % SPAN, within(word), counts, WORD_STEPS),
                                     ((both >> np.uint64(32)).astype(np.int64), within(both), n, PAIR_STEPS)):
            level = levels_of(c, steps)
            entries += int(level.sum())
            for j in range(1, int(level.max()) + 1 if len(level) else 1):
                in_it = level >= j
                held, base = key[in_it], block[in_it] << BLOCK_BITS
                for i in range(PROBES):
                    bits[base + _bits(held, j, i)] = 1
        packed = np.packbits(bits, bitorder="little").reshape(here, -1)
        none = np.empty(0, np.int64)
        return pa.table({"block": pa.array([span * SPAN + i for i in range(here)], pa.int64()),
                         "bits": pa.array([x.tobytes() for x in packed], pa.binary()),
                         "words": pa.array([words.view(np.int64)] + [none] * (here - 1), pa.list_(pa.int64())),
                         "counts": pa.array([counts] + [none] * (here - 1), pa.list_(pa.int64())),
                         "entries": pa.array([entries] + [0] * (here - 1), pa.int64())})

    return fill


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    whole = np.zeros(1 << (BLOCK_BITS - 3), dtype=np.uint8)
    for b in pdf["bits"]:
        whole |= np.frombuffer(b, np.uint8)
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "bits": [whole.tobytes()]})


def _blocks_for(bits: int) -> int:
    return 1 << (max(1, -(-bits >> BLOCK_BITS)) - 1).bit_length()


def _tokens(texts: DataFrame) -> int:
    return texts.agg(F.sum(F.regexp_count("text", F.lit(f"[^{SPACE}]+")) + 1)).first()[0] or 0


def built(texts: DataFrame, broadcast_bits: int = BROADCAST_BITS, tokens: int | None = None) -> tuple[DataFrame, int, DataFrame]:
    """(filter (block, bits), number of blocks, count table (word, c)) of the column ``text``."""
    tokens = _tokens(texts) if tokens is None else tokens
    blocks = _blocks_for(BITS_A_TOKEN * tokens)
    while True:
        subs = max(1, -(-tokens * min(SPAN, blocks) // (blocks * GROUP_TOKENS)))
        counted = texts.select("text").mapInArrow(_counted(blocks, subs), "grp bigint, kind int, found binary, sizes binary, n binary")
        done = checkpointed(counted.groupBy("grp").applyInArrow(
            _filled(blocks, subs), "block bigint, bits binary, words array<bigint>, counts array<bigint>, entries bigint"))
        # mostly new words: more entries than tokens; they are known now, so the second turn is the last
        need = _blocks_for(BITS_AN_ENTRY * (done.agg(F.sum("entries")).first()[0] or 0))
        if need <= blocks:
            break
        blocks = need
    # tokens ask for more than the entries need where n-grams repeat: neighbours are laid over each other, which is
    # the filter of half as many blocks, as long as it is too large for all workers and the entries keep their bits
    folds = 0
    while blocks << BLOCK_BITS > broadcast_bits and blocks > need:
        blocks, folds = blocks // 2, folds + 1
    whole = done.select(F.shiftright("block", folds).alias("block"), "bits")
    if subs > 1 or folds:
        whole = whole.groupBy("block").applyInPandas(_merged, "block bigint, bits binary")
    table = done.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select(
        F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    return whole, blocks, table


def _collected(whole: DataFrame, blocks: int) -> np.ndarray:
    size = 1 << (BLOCK_BITS - 3)
    held = np.zeros(blocks * size, dtype=np.uint8)
    for block, bits in whole.toLocalIterator():
        held[block * size:(block + 1) * size] = np.frombuffer(bits, np.uint8)
    return held


def train(texts: DataFrame) -> tuple[np.ndarray, int, DataFrame]:
    """(filter bytes, number of blocks, count table) with the whole filter in the driver, for small corpora."""
    whole, blocks, table = built(texts)
    return _collected(whole, blocks), blocks, table


def _different(keys: np.ndarray) -> np.ndarray:
    """The distinct keys, sorted. Plain ``np.unique`` hashes integers since NumPy 2.3, at many times the cost of a sort."""
    keys = np.sort(keys)
    first = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=first[1:])
    return keys[first]


def _distinct(h: list[np.ndarray], pairs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the words and of the pairs."""
    return np.sort(word_keys(_different(np.concatenate(h)))), _different(np.concatenate(pairs))


def _collapsed(id_type: pa.DataType):
    """Tasks: rows of a batch with the same id and text as one row and their number; those of a slice are packed together."""
    schema = pa.schema([("doc_id", id_type), ("held_out", pa.bool_()), ("text", pa.string()), ("times", pa.int64())])

    def packed(rows: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        return sink.getvalue().to_pybytes()

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).group_by(batch.schema.names, use_threads=False).aggregate([([], "count_all")])
            rows = rows.sort_by("slice")
            slices, at = np.unique(rows.column("slice").to_numpy(), return_index=True)
            rows = pa.Table.from_arrays([rows.column(c).cast(t) for c, t in zip(
                ["doc_id", "held_out", "text", "count_all"], schema.types, strict=True)], schema=schema)
            sizes = np.diff(at, append=rows.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int64()), pa.array(
                [packed(rows.slice(int(lo), int(n))) for lo, n in zip(at, sizes, strict=True)], pa.binary())], names=["slice", "rows"])

    return collapse


def _opened(asked: pa.Table) -> pa.Table:
    """The rows (doc_id, held_out, text, times) that are packed in those of a slice."""
    return pa.concat_tables(pa.ipc.open_stream(x.as_buffer()).read_all() for x in asked.column("rows")).combine_chunks()


def _told(blocks: int):
    """The distinct n-grams of a slice with their counts in its training texts, packed by span of blocks."""

    def told(asked: pa.Table) -> pa.Table:
        rows = _opened(asked)
        h, pairs, weights = [], [], []
        for part, weight in zip(_parts(rows), _weights(rows), strict=True):
            tokens, starts = token_hashes(part.column(2).to_pylist())
            h.append(tokens)
            pairs.append(pair_keys(tokens, starts))
            weights.append(np.repeat(weight, np.diff([*starts, len(tokens)])))
        weight = np.concatenate(weights)
        span, kind, keys, sizes, counts = [], [], [], [], []
        for k, arrays in enumerate((h, pairs)):
            found, n = _weighed(np.concatenate(arrays), weight)
            sent = within(found).astype(np.uint32)
            if k == 0:  # the hashes themselves, in the order of their keys
                order = np.argsort(word_keys(found))
                sent, n = found[order], n[order]
                found = word_keys(sent)
            for at, lo, hi, size in _packed(found, blocks):
                span.append(at)
                kind.append(k)
                keys.append(sent[lo:hi].tobytes())
                sizes.append(size)
                small = n[lo:hi].max() < 256
                counts.append(b"\1" + n[lo:hi].astype(np.uint8).tobytes() if small else b"\4" + n[lo:hi].astype(np.uint32).tobytes())
        return pa.table({"slice": pa.array([asked.column("slice")[0].as_py()] * len(span), pa.int64()), "span": pa.array(span, pa.int64()),
                         "kind": pa.array(kind, pa.int32()), "found": pa.array(keys, pa.binary()), "sizes": pa.array(sizes, pa.binary()),
                         "n": pa.array(counts, pa.binary())})

    return told


def _weighed(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their weights' sums."""
    if weight.max() > 1:
        found, where = np.unique(keys, return_inverse=True)
        return found, np.bincount(where, weights=weight, minlength=len(found)).astype(np.int64)
    found, n = np.unique(keys[weight == 1], return_counts=True)
    other = _different(keys[weight == 0])
    if len(found):
        other = other[found[np.searchsorted(found, other).clip(0, len(found) - 1)] != other]
    found, n = np.concatenate([found, other]), np.concatenate([n, np.zeros(len(other), n.dtype)])
    order = np.argsort(found, kind="stable")
    return found[order], n[order]


def _weights(rows: pa.Table) -> Iterator[np.ndarray]:
    """How often each row of the parts counts for training."""
    held = rows.column("held_out").to_numpy()
    weight, at = np.where(held, 0, rows.column("times").to_numpy()).astype(np.int64), 0
    for part in _parts(rows):
        yield weight[at:at + part.num_rows]
        at += part.num_rows


def _parts(rows: pa.Table) -> list[pa.RecordBatch]:
    return [b.slice(at, size) for b in rows.select(["doc_id", "held_out", "text"]).to_batches()
            for at, size in byte_slices(b.column(2), 1 << 20)]


def _answered(blocks: int):
    """Tasks fill a span of blocks and give the levels of all n-grams that were sent to it, a byte each; and the span's words."""

    def answered(told: pa.Table) -> pa.Table:
        kinds, n = told.column("kind").to_numpy(), told.column("n").to_pylist()
        found, sizes = told.column("found").to_pylist(), told.column("sizes").to_pylist()
        bits = np.zeros(SPAN << BLOCK_BITS, dtype=np.uint8)
        levels: list[bytes | None] = [None] * len(kinds)
        words, counts, entries, asked = np.empty(0, np.uint64), np.empty(0, np.int64), 0, []
        for k, steps in ((0, WORD_STEPS), (1, PAIR_STEPS)):
            rows = np.flatnonzero(kinds == k)
            if not len(rows):
                continue
            sent = [np.frombuffer(found[i], np.uint64) if k == 0 else _unpacked(found[i], sizes[i]) for i in rows]
            distinct, where = np.unique(np.concatenate(sent), return_inverse=True)
            times = np.concatenate([_times(n[i], len(x)) for i, x in zip(rows, sent, strict=True)])
            c = np.bincount(where, weights=times, minlength=len(distinct)).astype(np.int64)
            if k == 0:
                words, counts = distinct[c > 0], c[c > 0]
                key = word_keys(distinct)
                key, block = within(key), block_of(key, blocks) % SPAN
            else:
                key, block = within(distinct), (distinct >> np.uint64(32)).astype(np.int64)
            level = np.where(c > 0, levels_of(c, steps), 0)
            entries += int(level.sum())
            for j in range(1, int(level.max()) + 1):
                in_it = level >= j
                held, base = key[in_it], block[in_it] << BLOCK_BITS
                for i in range(PROBES):
                    bits[base + _bits(held, j, i)] = 1
            asked.append((rows, [len(x) for x in sent], key, block, where))
        packed = np.packbits(bits, bitorder="little")
        for rows, lengths, key, block, where in asked:
            read = _probed(key, block, packed).astype(np.uint8)[where]
            for i, x in zip(rows, np.split(read, np.cumsum(lengths)[:-1]), strict=True):
                levels[i] = x.tobytes()
        more = len(kinds)
        none = np.empty(0, np.int64)
        return pa.table({"slice": pa.concat_arrays([*told.column("slice").chunks, pa.array([-1], pa.int64())]),
                         "span": pa.concat_arrays([*told.column("span").chunks, pa.array([-1], pa.int64())]),
                         "kind": pa.array([*kinds.tolist(), -1], pa.int32()), "levels": pa.array([*levels, b""], pa.binary()),
                         "words": pa.array([none] * more + [words.view(np.int64)], pa.list_(pa.int64())),
                         "counts": pa.array([none] * more + [counts], pa.list_(pa.int64())),
                         "entries": pa.array([0] * more + [entries], pa.int64())})

    return answered


def _dealt_levels(dealt: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """(levels (slice, span, kind, levels), count table (word, c)) of the packed rows (slice, rows)."""
    while True:
        told = dealt.groupBy("slice").applyInArrow(
            _told(blocks), "slice bigint, span bigint, kind int, found binary, sizes binary, n binary")
        done = checkpointed(told.groupBy("span").applyInArrow(
            _answered(blocks), "slice bigint, span bigint, kind int, levels binary, words array<bigint>, counts array<bigint>, entries bigint"))
        # as in ``built``: the second turn is the last
        need = _blocks_for(BITS_AN_ENTRY * (done.agg(F.sum("entries")).first()[0] or 0))
        if need <= blocks:
            break
        blocks = need
    table = done.where("slice < 0").select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select(
        F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    return done.where("slice >= 0").select("slice", "span", "kind", "levels"), table


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_bits: int = BROADCAST_BITS,
          top_words: int = TOP_WORDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    docs = docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0)
    docs = docs.select("doc_id", "held_out", "text")
    id_type = docs.schema["doc_id"].dataType
    tokens = _tokens(docs.where("not held_out"))
    blocks, whole = _blocks_for(BITS_A_TOKEN * tokens), None
    everywhere = blocks << BLOCK_BITS <= broadcast_bits
    if everywhere:
        whole, blocks, table = built(docs.where("not held_out"), broadcast_bits, tokens)
        everywhere = blocks << BLOCK_BITS <= broadcast_bits
    if not everywhere:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        slices = 1 + size // (GROUP_TOKENS * BYTES_A_TOKEN)
        dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(slices)).alias("slice"), "*").mapInArrow(
            _collapsed(to_arrow_type(id_type)), "slice bigint, rows binary")
        answers, table = _dealt_levels(dealt, blocks)
    total, distinct = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = table.orderBy(F.col("c").desc(), "word").limit(top_words).toPandas()
    order = np.argsort(top["word"].to_numpy().astype(np.int64).view(np.uint64))
    below = total + ADD * (distinct + 1)
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast((_collected(whole, blocks) if everywhere else None, top["word"].to_numpy().astype(np.int64).view(np.uint64)[order],
                          np.log10((top["c"].to_numpy().astype(np.float64)[order] + ADD) / below)))

    def scored_rows(rows: pa.RecordBatch, h: np.ndarray, starts: np.ndarray, levels) -> pa.RecordBatch:
        """``h``, ``starts``: the rows' tokens; ``levels``: of distinct keys, by kind."""
        _, frequent, logs = model.value
        lengths = np.diff([*starts, len(h)])
        kinds, which = np.unique(h, return_inverse=True)
        place = np.searchsorted(frequent, kinds).clip(0, max(0, len(frequent) - 1))
        is_top = frequent[place] == kinds if len(frequent) else np.zeros(len(kinds), bool)
        base = np.where(is_top, logs[place], 0.0)[which] if len(frequent) else np.zeros(len(h))
        common = is_top[which]
        of_kinds = counts_of(levels(word_keys(kinds), 0), WORD_STEPS)
        words = of_kinds[which]
        pairs, where = np.unique(pair_keys(h, starts), return_inverse=True)
        both = counts_of(levels(pairs, 1), PAIR_STEPS)[where]
        before = np.empty(len(h))
        before[1:] = words[:-1]
        before[starts] = of_kinds[np.searchsorted(kinds, END)]  # as many starts as ends
        p = PAIR * both / np.maximum(np.maximum(before, both), 1) + (1 - PAIR) * np.minimum(1, (words + ADD) / below)
        rare = h[~common].view(np.int64)
        ends = np.concatenate([[0], np.cumsum(np.add.reduceat(~common, starts))]).astype(np.int32) if len(h) else np.zeros(1, np.int32)
        return pa.RecordBatch.from_arrays([
            rows.column(0), rows.column(1), pa.array(lengths, pa.int64()),
            pa.array(np.add.reduceat(common.astype(np.int64), starts), pa.int64()),
            pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(p), starts)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(rare))],
            names=["doc_id", "held_out", "n_tokens", "known", "base", "score", "rare"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = model.value[0]
        for batch in batches:
            for at, size in byte_slices(batch.column(2), 1 << 20):
                rows = batch.slice(at, size)
                yield scored_rows(rows, *token_hashes(rows.column(2).to_pylist()), lambda keys, kind: probed(keys, bits, blocks))

    def scored_slice(asked: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _opened(asked)
        parts = _parts(rows)
        tokens = [token_hashes(part.column(2).to_pylist()) for part in parts]
        keys = _distinct([_different(h) for h, _ in tokens], [_different(pair_keys(*x)) for x in tokens])
        answers = answers.sort_by("span")  # then the levels are in the order of the keys
        known = [np.frombuffer(b"".join(answers.filter(pc.equal(answers.column("kind"), k)).column("levels").to_pylist()), np.uint8)
                 .astype(np.int64) for k in (0, 1)]
        out = [scored_rows(part, *x, lambda asked, kind: known[kind][np.searchsorted(keys[kind], asked)])
               for part, x in zip(parts, tokens, strict=True)]
        return pa.Table.from_batches(out).append_column("times", rows.column("times"))

    columns = (f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens bigint, known bigint, base double, score double, "
               "rare array<bigint>")
    if everywhere:
        texts = docs.mapInArrow(scored, columns)
    else:
        texts = dealt.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(scored_slice, columns + ", times bigint")
    texts = checkpointed(texts.withColumn("row", F.monotonically_increasing_id()))
    rest = texts.select("row", F.explode("rare").alias("word")).join(table, "word", "left")
    rest = rest.groupBy("row").agg(F.sum(F.log10((F.coalesce("c", F.lit(0)) + ADD) / F.lit(below))).alias("more"), F.count("c").alias("also"))
    out = texts.drop("rare").join(rest, "row", "left")
    if not everywhere:
        out = out.withColumn("copy", F.explode(F.array_repeat(F.lit(True), F.col("times").cast("int"))))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"),
                      F.lit(total).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")
