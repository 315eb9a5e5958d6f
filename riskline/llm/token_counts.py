"""Token counts: Arrow batches in, lengths out.

Rows are taken in slices of about ``batch_bytes`` bytes, whatever the number of texts in
them. Texts are split where the tokenizer cannot merge across: at a single space between
two characters that are neither a space nor the meta symbol U+2581. No piece of the model
has the meta symbol after another character (``_checked`` raises if one has), so a merge
never spans such a place, and the prefix the library puts before each part stands for the
space taken out. Parts repeat a lot, so each worker keeps the lengths of the short ones it
has met, up to ``CACHE_PARTS``; the library encodes the others in one batch per slice.

Nulls count as the empty text (0 bytes, 0 tokens); rows repeat as given; a null id stays
null; other columns are not read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, text_or_empty

META = "▁"
CACHE_PARTS = 400_000
CACHE_CHARS = 48
_SAFE = re.compile(f"(?<=[^ {META}]) (?=[^ {META}])")
#: Of this worker process: model bytes -> (encoder, lengths of parts).
_LOADED: dict = {}


def _checked(model: bytes):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(sp.get_piece_size()):
        if META in sp.id_to_piece(i).lstrip(META):
            raise ValueError("this model merges across spaces; its texts have no safe boundaries")
    if sp.encode("a  b", out_type=str) == sp.encode("a b", out_type=str):
        raise ValueError("this model drops repeated spaces; its texts can't be split at them")
    return sp


def _loaded(model: bytes):
    key = hash(model)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = (_checked(model), {})
    return _LOADED[key]


def safe_parts(text: str) -> list[str]:
    """Parts whose token counts add up to the text's."""
    if not text:
        return []
    if "  " in text or META in text or text[0] == " " or text[-1] == " ":
        return _SAFE.split(text)
    return text.split(" ")


def token_lengths(texts: list[str], sp, known: dict[str, int]) -> np.ndarray:
    """Number of tokens of each text."""
    if len(known) > CACHE_PARTS:
        known.clear()
    parts: list[str] = []
    ends = np.empty(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        parts += safe_parts(t)
        ends[i] = len(parts)
    new = [p for p in set(parts) if p not in known]
    lengths = dict(zip(new, map(len, sp.encode(new, num_threads=1)), strict=True)) if new else {}
    long_ones = {p: n for p, n in lengths.items() if len(p) > CACHE_CHARS}
    known.update((p, n) for p, n in lengths.items() if len(p) <= CACHE_CHARS)
    if long_ones:
        each = [known[p] if p in known else long_ones[p] for p in parts]
    else:
        each = list(map(known.__getitem__, parts))
    total = np.concatenate([[0], np.cumsum(np.asarray(each, dtype=np.int64))])
    return np.diff(total[np.concatenate([[0], ends])])


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096, batch_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every text, one output row per input row.

    model_file: a sentencepiece model on the driver; its bytes (a fixed vocabulary) go to the
    workers by broadcast.
    """
    with open(model_file, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, known = _loaded(model.value)
        for batch in batches:
            for at, n in byte_slices(batch.column(1), batch_bytes):
                rows = batch.slice(at, n)
                tokens = token_lengths(rows.column(1).to_pylist(), sp, known)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(tokens)], names=["doc_id", "n_tokens"])

    id_type = docs.schema[id_col].dataType.simpleString()
    # the byte length rides along in a struct with the id, so the texts go to Python once and never come back
    keyed = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"),
                                 F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes")).alias("doc_id"),
                        text_or_empty(text_col).alias("text"))
    out = keyed.mapInArrow(lengths, f"doc_id struct<id:{id_type},n_bytes:bigint>, n_tokens bigint")
    return out.select(F.col("doc_id.id").alias("doc_id"), F.col("doc_id.n_bytes").alias("n_bytes"), "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
