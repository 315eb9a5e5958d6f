"""Document fingerprints: homomorphic multiset hash of a text's paragraphs.

A paragraph is a line; a long line counts as its blocks of ``BLOCK`` words. Each one is
hashed to a wide vector, and the vectors are summed: 6 lanes modulo 2**64 (equality) and 128
lanes of +1 or -1 modulo 2**16 (likeness). Sums do not depend on the order, and adding or
taking away a paragraph is adding or subtracting its vector (``inserted``, ``deleted``). The
squared length of the difference of two sign parts is, on average, 128 for each paragraph
that only one text has; likeness is 1 less that number's share of both texts' paragraphs.

A fingerprint is lower-case hex of: number of paragraphs (8 bytes), the 6 lanes, the 128
lanes, little-endian.

Neighbours (``with_next``): documents go by quantiles of the id to ranges of about
``RANGE_BYTES`` of text, each range is ordered by id, and only the first document of every
range is passed to the range before. Texts are shuffled once.

Defined results: null text is empty; the empty text has no paragraph, and two texts without
any have likeness 1; rows with equal ids are ordered by a hash of their texts; null ids come
first; a single document follows itself; an empty table gives no rows; other columns are not
read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import byte_slices, text_or_empty

BLOCK = 12
LANES, SIGNS = 6, 128
RANGE_BYTES = 24 << 20
COARSE = 64  # ranges are found in two steps, 64 * 64 at most


def paragraphs(text: str) -> list[str]:
    """The paragraphs of a text, blank ones left out."""
    out = []
    for line in text.split("\n"):
        words = line.split(" ")
        if len(words) <= BLOCK:
            if line.strip():
                out.append(line)
        else:
            out += [p for i in range(0, len(words), BLOCK) if (p := " ".join(words[i:i + BLOCK])).strip()]
    return out


def vector(parts: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(number, lanes, sign lanes) of a multiset of paragraphs."""
    if not parts:
        return 0, np.zeros(LANES, np.uint64), np.zeros(SIGNS, np.int16)
    raw = np.frombuffer(b"".join(hashlib.blake2b(p.encode("utf-8", "surrogatepass")).digest() for p in parts), np.uint8)
    raw = raw.reshape(len(parts), 64)
    lanes = np.ascontiguousarray(raw[:, :8 * LANES]).view("<u8").sum(axis=0, dtype=np.uint64)
    plus = np.unpackbits(raw[:, 8 * LANES:], axis=1).sum(axis=0, dtype=np.int64)
    return len(parts), lanes, (2 * plus - len(parts)).astype(np.int16)


def to_hex(n: int, lanes: np.ndarray, signs: np.ndarray) -> str:
    return (np.array([n], "<u8").tobytes() + lanes.astype("<u8").tobytes() + signs.astype("<i2").tobytes()).hex()


def from_hex(fingerprint: str) -> tuple[int, np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return (int(np.frombuffer(raw[:8], "<u8")[0]), np.frombuffer(raw[8:8 + 8 * LANES], "<u8"),
            np.frombuffer(raw[8 + 8 * LANES:], "<i2"))


def inserted(fingerprint: str, parts: list[str]) -> str:
    """Fingerprint after the paragraphs are added."""
    (n, lanes, signs), (m, more, plus) = from_hex(fingerprint), vector(parts)
    return to_hex(n + m, lanes + more, signs + plus)


def deleted(fingerprint: str, parts: list[str]) -> str:
    """Fingerprint after the paragraphs are taken away."""
    (n, lanes, signs), (m, less, minus) = from_hex(fingerprint), vector(parts)
    return to_hex(n - m, lanes - less, signs - minus)


def likeness(x: tuple[int, np.ndarray, np.ndarray], y: tuple[int, np.ndarray, np.ndarray]) -> float:
    """0 to 1: estimated share of paragraphs (of both texts together) that the texts have in common; 1 if the sums agree."""
    if x[0] == y[0] and np.array_equal(x[1], y[1]):
        return 1.0
    apart = (x[2] - y[2]).astype(np.float64)
    return round(float(min(1.0, max(0.0, 1 - apart @ apart / (SIGNS * max(1, x[0] + y[0]))))), 6)


def _range_of(docs: DataFrame, total_bytes: int) -> Column:
    """Number of the id's range: how many quantiles lie below it."""
    n = max(1, min(COARSE * COARSE, -(-total_bytes // RANGE_BYTES)))
    if n == 1:
        return F.lit(0)
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], F.lit(20_000))).first()[0] or []))
    coarse = cuts[COARSE - 1::COARSE]

    def below(xs: Column) -> Column:
        return F.size(F.filter(xs, lambda x: x < F.col("doc_id")))

    def longs(xs: list[int]) -> Column:
        return F.array(*[F.lit(x) for x in xs]).cast("array<bigint>")

    if not coarse:
        return below(longs(cuts))
    at = below(longs(coarse))
    fine = F.array(*[longs(cuts[i:i + COARSE - 1]) for i in range(0, len(cuts), COARSE)])
    return at * COARSE + below(F.get(fine, at))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_part): next_part is the first floor(n/4) code points of the next document by id."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.withColumns({"tie": F.xxhash64("text"), "part": _range_of(docs, total)})
    firsts = docs.groupBy("part").agg(F.min(F.struct("doc_id", "tie")).alias("first")).orderBy("part").collect()  # a row a range
    if not firsts:
        return docs.select("doc_id", "text", F.lit("").alias("next_part"))
    heads = docs.sparkSession.createDataFrame(
        [(p, *firsts[(i + 1) % len(firsts)]["first"]) for i, (p, _) in enumerate(firsts)], "part int, id long, tie long")
    following = (docs.drop("part").join(F.broadcast(heads.withColumnRenamed("tie", "head_tie")),
                                        F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("head_tie")))
                 .groupBy("part").agg(F.max("text").alias("head")))
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "tie")
    rows = docs.withColumn("next", F.lead("text").over(order)).join(following, "part", "left")
    taken = F.floor(F.length("text") / 4).cast("int")
    return rows.select("doc_id", "text", F.substring(F.coalesce("next", "head"), F.lit(1), taken).alias("next_part"),
                       F.coalesce("next", "head").alias("next"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every text."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in byte_slices(batch.column(1), 1 << 22):
                rows = batch.slice(at, n)
                texts = rows.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([to_hex(*vector(paragraphs(t))) for t in texts], pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(
        one, f"doc_id {id_type}, n_chars bigint, fingerprint string")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text: the last quarter gives way to the next document's beginning."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in byte_slices(batch.column(1), 1 << 21):
                rows = batch.slice(at, n)
                cols: list[list] = [[] for _ in range(6)]
                for text, part, follower in zip(*(rows.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    new = text[:len(text) - len(text) // 4] + part
                    x, y, z = (vector(paragraphs(t)) for t in (text, new, follower))
                    for c, v in zip(cols, (len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                                           to_hex(*x), to_hex(*y), likeness(x, y), likeness(x, z)), strict=True):
                        c.append(v)
                types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    rows = with_next(docs, id_col, text_col)
    if "next" not in rows.columns:
        rows = rows.withColumn("next", F.lit(""))
    return rows.mapInArrow(both, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
