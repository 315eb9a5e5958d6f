"""Best-fit packing of tokenised documents into fixed-length sequences, by the sum of squares.

Tokens: a document's ids are the library's ids of its text and one end id. White space never
reaches a pre-token of the vocabulary, so the text is cut at spaces and line ends and each
distinct word is encoded once per worker (``CACHE_WORDS`` bounds what it keeps). Points and
commas after a letter begin a pre-token too, and ASCII letters are lower-cased, so the forms
of a word share one call of the library. Only
documents above ``capacity`` are cut, into pieces of exactly ``capacity``; the rest is last.

Packing: pieces go by a hash to groups of about ``GROUP_PIECES`` rows. A group takes its
pieces from long to short and puts each where the sum over residual gaps of the squared
number of open bins with that gap becomes smallest (a new bin counts as one choice; ties go
to the smallest gap left). Sequences filled to less than ``REOPEN`` of the capacity are
dissolved; their pieces meet again in fewer groups, until one group is left or a round closes
less than half of the pieces: then each group's open sequences stay as they are. Groups never
grow, so no task sees more than its group, and only (id, piece, length) rows are shuffled.

Null texts are empty documents (the end id alone); repeated rows are packed each; null ids
stay null; an empty table gives no rows.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, checkpointed, text_or_empty

CACHE_WORDS = 900_000
CACHE_CHARS = 48
GROUP_PIECES = 150_000
REOPEN = 0.995
_LOADED: dict = {}


def _loaded(model: str):
    key = hash(model)
    if key not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(model)
        ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
        for piece, i in tokenizer.get_vocab(with_added_tokens=False).items():
            ends[i] = piece.endswith("</w>")
        _LOADED.clear()
        _LOADED[key] = (tokenizer, ends, {"": b""})
    return _LOADED[key]


def _words(text: str) -> list[str]:
    for c in "\n\t\r":
        if c in text:
            text = text.replace(c, " ")
    return text.split(" ")


def _stem(word: str) -> str:
    """The word without points and commas after its last letter, in lower case if it is plain ASCII.

    It must still end in a letter once it is in lower case: U+0130 becomes an i and a mark, which the
    points would join."""
    bare = word.rstrip(".,")
    if not bare or not bare[-1].isalpha() or not bare[-1].lower()[-1].isalpha():
        bare = word
    return bare.lower() if bare.isascii() and "<" not in bare else bare


def _encoded(words: list[str], tokenizer, ends: np.ndarray) -> dict[str, bytes]:
    """Ids of each word. Words of letters alone are one pre-token, whose last id alone ends a word: they go as one text."""
    out: dict[str, bytes] = {}
    plain = [w for w in words if w.isalpha()]
    ids = np.asarray(tokenizer.encode(" ".join(plain), add_special_tokens=False).ids, dtype="<u4")
    last = np.flatnonzero(ends[ids]) + 1 if len(ids) else np.empty(0, int)
    if len(last) == len(plain) and (not len(plain) or last[-1] == len(ids)):
        held, at = ids.tobytes(), 0
        for w, to in zip(plain, (4 * last).tolist(), strict=True):
            out[w] = held[at:to]
            at = to
    rest = [w for w in words if w not in out]
    for w, e in zip(rest, tokenizer.encode_batch(rest, add_special_tokens=False), strict=True):
        out[w] = np.asarray(e.ids, dtype="<u4").tobytes()
    return out


def token_bytes(texts: list[str], tokenizer, ends: np.ndarray, known: dict[str, bytes]) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    if len(known) > CACHE_WORDS:
        known.clear()
        known[""] = b""
    split = [_words(t) for t in texts]
    stems: dict[str, str] = {}
    for w in set().union(*split).difference(known):
        stems[w] = _stem(w)
    new = list(set(stems.values()).difference(known))
    new += {w[len(s):] for w, s in stems.items() if len(s) < len(w)}.difference(known, new)
    for at in range(0, len(new), 2000):
        known.update(_encoded(new[at:at + 2000], tokenizer, ends))
    for w, s in stems.items():
        if w not in known:
            known[w] = known[s] + (known[w[len(s):]] if len(s) < len(w) else b"")
    passing = {w for w in (*stems, *new) if len(w) > CACHE_CHARS}
    out = [b"".join(map(known.__getitem__, s)) for s in split]
    for w in passing:
        del known[w]
    return out


def tokenized_pieces(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = 4096, end_id: int = 1, with_ids: bool = False,
                     batch_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; ids: array of the piece's token ids."""
    with open(tokenizer_file, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.asarray([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, ends, known = _loaded(model.value)
        for batch in batches:
            for at, n in byte_slices(batch.column(1), batch_bytes):
                rows = batch.slice(at, n)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, b in enumerate(token_bytes(rows.column(1).to_pylist(), tokenizer, ends, known)):
                    b += end
                    for k, lo in enumerate(range(0, len(b), step)):
                        part = b[lo:lo + step]
                        row.append(i)
                        piece.append(k)
                        start.append(lo // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                cols = [rows.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(
        pieces, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, items taken in the given order."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open bins by gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    opened = 0
    for i, s in enumerate(lengths.tolist()):
        if s == capacity:
            bins[i], offsets[i] = opened, 0
            opened += 1
            continue
        # the change of the sum: leaving gap g and entering gap g - s; a bin that becomes full enters none
        before, after = count[s:capacity], count[:capacity - s]
        change = 2 * (after - before) + 2
        change[0] = 1 - 2 * before[0]
        np.putmask(change, before == 0, np.iinfo(np.int64).max)
        j = int(change.argmin())
        if before[j] == 0 or 2 * int(count[capacity - s]) + 1 < change[j]:
            b, gap, opened = opened, capacity, opened + 1
        else:
            gap = s + j
            b = stacks[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            stacks[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 4096, seed: int = 11, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset. Lengths are 1 to ``capacity``; repeated rows are placed each."""
    extra = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    inner = [f"c{i}" for i in range(len(extra))]  # no name of the input can clash with a working column
    left = checkpointed(pieces.select(F.col("length").cast("bigint").alias("size"),
                                      *[F.col(f"`{c}`").alias(i) for c, i in zip(extra, inner, strict=True)]))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in left.schema)

    def placing(level: int, last: bool):
        def placed(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.iloc[np.lexsort((pdf["tie"].to_numpy(), -pdf["size"].to_numpy()))]
            sizes = pdf["size"].to_numpy()
            bins, offsets = sum_of_squares(sizes, capacity)
            fill = np.bincount(bins, weights=sizes)
            first = (level << 56) + (int(pdf["grp"].iloc[0]) << 32)
            return pdf[["size", *inner]].assign(sequence_id=first + bins, offset=offsets,
                                                closed=True if last else fill[bins] >= REOPEN * capacity)

        return placed

    def finished(placed: DataFrame) -> DataFrame:
        return placed.select(*[F.col(i).alias(c) for c, i in zip(extra, inner, strict=True)], "sequence_id", "offset")

    done: DataFrame | None = None
    level, n = 0, left.count()
    while True:
        groups = max(1, -(-n // group_pieces))
        # the tie key depends on the row alone, so a rerun places every row alike
        grouped = left.withColumn("tie", F.xxhash64("size", *inner, F.lit(seed + level))).withColumn(
            "grp", F.pmod("tie", F.lit(groups)).cast("int"))
        out = grouped.repartition(groups, "grp").groupBy("grp").applyInPandas(
            placing(level, groups == 1), f"{fields}, sequence_id bigint, offset bigint, closed boolean")
        if groups > 1:
            out = checkpointed(out)
        closed = out.where("closed")
        done = closed if done is None else done.unionByName(closed)
        if groups == 1:
            return finished(done)
        left = out.where("not closed").select("size", *inner)
        m = left.count()
        if m > 0.5 * n:  # few sequences close in groups of this size, and larger ones would bind a task: they stay open
            return finished(done.unionByName(out.where("not closed")))
        n, level = m, level + 1


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise and pack: one row per piece with its sequence and place."""
    return pack(tokenized_pieces(docs, tokenizer_file, id_col, text_col, capacity, end_id, with_ids), capacity)
