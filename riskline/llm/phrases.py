"""Phrase mining: collocations of 2 to 4 words, grown from their prefixes best first.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words at blanks
and tabs. f(phrase) counts all occurrences within pieces of a language; candidates have f >= ``least``.
Cutting a candidate after k words gives l, r and the score ``2000000 * a div (l + r)``; the lowest
cut counts. A candidate is dropped if a candidate that is longer holds it and has at least 80 % of
its count. As counts only fall when a phrase grows, it is enough to look at phrases that are longer
by one word.

Bounds: a phrase that grows from the prefix p with the first word w has at most f(p) occurrences
and at least as many of its rest, so its score is at most ``2000000 * f(p) div (f(w) + f(p))``. That
holds for p itself, too, and never rises as p grows.

The texts are read three times: words are counted; then pairs of frequent words; then the runs of
frequent pairs are cut out, equal ones counted once. What follows works on the runs alone. The
frontier holds the counted phrases of 2 and 3 words that have not grown yet. In each round every
language's threshold is the score of the ``limit``-th best candidate not known to be dropped, and
all phrases of the frontier whose bound reaches the threshold grow by one word on either side: on
the right to find new candidates, on both sides to see whether a longer one swallows them. The
threshold falls as candidates are dropped and rises as they are found. When no bound in the
frontier reaches it any more, every candidate at the threshold or above is known, ties included,
and so is whether it is dropped.

Sets of frequent words, pairs and growing phrases go to the workers as bit tables of at most
``MAX_BITS`` bits, addressed by a hash. They only save work: a phrase that passes by chance is
counted like the others, and exact counts by text decide. Scores are computed with 38-digit
decimals.

Defined results: null texts have no words; a null language is ``und``; equally scored candidates go
by count, then by UTF-8 bytes; repeated rows count again; an empty table gives no rows. Further
input columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, checkpointed

MAX_BITS = 1 << 28
BITS_A_KEY = 32
#: A task adds up what it counted after so many words, and forgets its words after so many different ones.
FLUSH_TOKENS = 2_000_000
KNOWN_WORDS = 400_000
EMIT_ROWS = 20_000
#: Work ahead: phrases also grow whose bound reaches the score of this many times the limit.
AHEAD = 4
SCALE = 2_000_000
#: Capitals become small letters, piece ends line feeds, tabs blanks.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_END, _NONE = 0, 1


class Words(dict):
    """Numbers of words as they come; 0 ends a piece, 1 is no word."""

    def __init__(self):
        super().__init__({b"\n": _END, b"": _NONE})
        self.texts = [b"\n", b""]
        self.crcs = [0, 0]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.texts)
        self.texts.append(word)
        self.crcs.append(crc32(word))
        return n

    def numbers(self, text: bytes) -> np.ndarray:
        parts = text.translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
        out = np.fromiter(map(self.__getitem__, parts), dtype=np.int32, count=len(parts))
        return out[out != _NONE]


#: A phrase's hash starts with its tag and language and takes up one word's crc after the other.
_MOD, _TIMES = (1 << 40) - 87, 1_000_003


def _start(tag: str, lang: str) -> int:
    return crc32((tag + lang).encode())


def _grown_hash(h, crcs):
    return (h * _TIMES + crcs) % _MOD


def _hashed(tag: str) -> Column:
    """The hash of (lang, phrase) as a column."""
    crcs = F.transform(F.split("phrase", " "), lambda w: F.crc32(w))
    return F.aggregate(crcs, F.crc32(F.concat(F.lit(tag), F.col("lang"))), lambda h, c: (h * _TIMES + c) % _MOD)


class BitTable:
    """Set of hashes by one bit each; one that is not in the set may pass by chance."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.size = bits, size

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % self.size
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bit_table(hashes: DataFrame, column: str = "hash"):
    """Broadcast bit table of a column of hashes; built in Spark in parts of 4 kB."""
    spark = hashes.sparkSession
    count = hashes.agg(F.count(F.lit(1))).first()[0]
    size = 1 << 15
    while size < min(MAX_BITS, count * BITS_A_KEY):
        size *= 2
    at = hashes.select((F.col(column) % size + 1).alias("at"))  # bit positions count from one
    parts = (at.groupBy(F.bitmap_bucket_number("at").alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())
    bits = np.zeros(size // 8, dtype=np.uint8)
    for r in parts:
        from_byte = (r["part"] - 1) * 4096
        bits[from_byte:from_byte + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)[:size // 8 - from_byte]
    return spark.sparkContext.broadcast(BitTable(bits, size))


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")).where("text is not null")


def _batches(batches: Iterator[pa.RecordBatch], count) -> Iterator[pa.RecordBatch]:
    """Word numbers of the texts by language, handed to ``count(lang, words, numbers, times)`` from time to time.

    times tells how often the text of each number counts: a third column of the batch, whose texts are
    single pieces then, else one.
    ``count`` yields pairs of counts and a function that gives the phrases of a slice of them.
    """
    words, held, size = Words(), {}, 0
    end = np.array([_END], dtype=np.int32)

    def flushed() -> Iterator[pa.RecordBatch]:
        for lang in list(held):
            arrays, times = held.pop(lang)
            numbers, each = np.concatenate([end, *arrays]), np.concatenate([[1], *times])
            del arrays, times
            for n, phrases in count(lang, words, numbers, each):
                for a in range(0, len(n), EMIT_ROWS):
                    part = phrases(slice(a, a + EMIT_ROWS))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array(n[a:a + EMIT_ROWS])],
                        names=["lang", "phrase", "f"])

    for batch in batches:
        for at, rows in byte_slices(batch.column(1), 1 << 20):
            part = batch.slice(at, rows)
            by_lang: dict[str, list[int]] = {}
            for i, lang in enumerate(part.column(0).to_pylist()):
                by_lang.setdefault(lang, []).append(i)
            texts = part.column(1).to_pylist()
            often = part.column(2).to_numpy() if part.num_columns > 2 else None
            for lang, which in by_lang.items():
                # a text ends a piece, so many go as one
                got = words.numbers(b"\n".join([texts[i] for i in which]) + b"\n")
                arrays, times = held.setdefault(lang, ([], []))
                arrays.append(got)
                if often is None:
                    times.append(np.ones(len(got), dtype=np.int64))
                else:  # counted rows are single pieces
                    times.append(np.repeat(often[which], np.diff(np.flatnonzero(got == _END), prepend=-1)))
                size += len(got)
            if size > FLUSH_TOKENS:
                yield from flushed()
                size = 0
                if len(words.texts) > KNOWN_WORDS:
                    words = Words()
    yield from flushed()


_COUNTS = "lang string, phrase string, f long"


def _summed(rows: DataFrame, count) -> DataFrame:
    counted = rows.mapInArrow(lambda batches: _batches(batches, count), _COUNTS)
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all single words."""

    def count(lang: str, words: Words, numbers: np.ndarray, times: np.ndarray):
        n = np.bincount(numbers, minlength=2)
        n[:2] = 0
        some = np.flatnonzero(n)
        yield n[some], lambda part: [words.texts[i] for i in some[part].tolist()]

    return _summed(texts, count)


def _pairs_at(table: BitTable, lang: str, crcs: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Places of all pairs of words that are both in the table."""
    known = table.has(_grown_hash(_start("w", lang), crcs))
    known[:2] = False
    known = known[numbers]
    return np.flatnonzero(known[:-1] & known[1:])


def count_pairs(texts: DataFrame, frequent) -> DataFrame:
    """(lang, phrase, f) of pairs of neighbouring frequent words."""

    def count(lang: str, words: Words, numbers: np.ndarray, times: np.ndarray):
        at = _pairs_at(frequent.value, lang, np.array(words.crcs, dtype=np.int64), numbers)
        codes, n = np.unique(numbers[at].astype(np.int64) << 32 | numbers[at + 1], return_counts=True)
        t = words.texts
        yield n, lambda part: [t[a] + b" " + t[b] for a, b in
                               zip((codes[part] >> 32).tolist(), (codes[part] & 0xFFFFFFFF).tolist(), strict=True)]

    return _summed(texts, count)


def count_runs(texts: DataFrame, frequent, frequent_pairs) -> DataFrame:
    """(lang, phrase, f) of the longest runs of three and more words whose neighbouring pairs are all frequent."""

    def count(lang: str, words: Words, numbers: np.ndarray, times: np.ndarray):
        crcs = np.array(words.crcs, dtype=np.int64)
        at = _pairs_at(frequent.value, lang, crcs, numbers)
        pair = _grown_hash(_grown_hash(_start("p", lang), crcs[numbers[at]]), crcs[numbers[at + 1]])
        at = at[frequent_pairs.value.has(pair)]
        if not len(at):
            return
        first = at[np.append(True, np.diff(at) != 1)]
        last = at[np.append(np.diff(at) != 1, True)]
        long = last > first
        runs: dict[bytes, int] = {}
        get, whole = words.texts.__getitem__, numbers.tolist()
        for a, b in zip(first[long].tolist(), (last[long] + 2).tolist(), strict=True):
            run = b" ".join(map(get, whole[a:b]))
            runs[run] = runs.get(run, 0) + 1
        found = list(runs)
        yield np.fromiter(runs.values(), dtype=np.int64, count=len(runs)), lambda part: found[part]

    return _summed(texts, count)


def count_grown(runs: DataFrame, sizes: list[int], wanted) -> DataFrame:
    """(lang, phrase, f) of the phrases in the runs that have one of the sizes and grow by one word from
    a wanted phrase on either side (hashes tagged ``+``) or are wanted themselves (tagged ``=``)."""

    def count(lang: str, words: Words, numbers: np.ndarray, times: np.ndarray):
        crcs = np.array(words.crcs, dtype=np.int64)[numbers]
        inside = numbers > _NONE
        parts, selves = _grown_hash(_start("+", lang), crcs), _grown_hash(_start("=", lang), crcs)
        for size in range(2, max(sizes) + 1):
            grows = wanted.value.has(parts) if size in sizes else None
            parts, selves = (_grown_hash(h[:-1], crcs[size - 1:]) for h in (parts, selves))
            inside = inside[:-1] & (numbers[size - 1:] > _NONE)
            if grows is None:
                continue
            at = np.flatnonzero(inside & (grows[:-1] | grows[1:] | wanted.value.has(selves)))
            # phrases are told apart word by word: the number of the first words and the next word
            code = numbers[at].astype(np.int64)
            for i in range(1, size):
                code = np.unique(code << 32 | numbers[at + i], return_inverse=True)[1]
            _, first, code = np.unique(code, return_index=True, return_inverse=True)
            n = np.bincount(code, weights=times[at]).astype(np.int64)
            yield n, lambda part, at=at[first], size=size: [
                b" ".join([words.texts[numbers[i + k]] for k in range(size)]) for i in at[part].tolist()]

    return _summed(runs.select("lang", F.col("phrase").cast("binary").alias("text"), "f"), count)


def _words_of(phrase: str = "phrase") -> Column:
    return F.split(phrase, " ")


def scored(new: DataFrame, counts: DataFrame, n_words: int) -> DataFrame:
    """(lang, phrase, words, a, l, r, score, bound) of phrases (lang, phrase, f); all their parts are in ``counts``."""
    words = _words_of()
    cuts = F.explode(F.array(*[F.struct(
        F.lit(k).alias("k"), F.lit(left).alias("left"),
        F.array_join(F.slice(words, 1, k) if left else F.slice(words, k + 1, n_words - k), " ").alias("part"))
        for k in range(1, n_words) for left in (True, False)])).alias("cut")
    parts = new.select("lang", "phrase", F.col("f").alias("a"), cuts).select("lang", "phrase", "a", "cut.*")
    each = (parts.join(counts.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
            .groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"),
                                                    F.max(F.when(~F.col("left"), F.col("f"))).alias("r")))

    def share(of: str, over: str) -> str:
        return f"(cast({SCALE} as decimal(38,0)) * {of}) div (cast({over} as decimal(38,0)))"

    each = each.withColumn("score", F.expr(share("cast(a as decimal(20,0))", "cast(l as decimal(20,0)) + cast(r as decimal(20,0))")))
    low = each.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"),
                                                  F.max(F.when(F.col("k") == 1, F.col("l"))).alias("first"))
    return low.select("lang", "phrase", F.lit(n_words).alias("words"), "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"),
                      F.col("low.score").alias("score"),
                      F.expr(share("cast(a as decimal(20,0))", "cast(a as decimal(20,0)) + cast(first as decimal(20,0))")).alias("bound"))


def _standing(candidates: DataFrame) -> DataFrame:
    """Candidates that no counted candidate longer by one word swallows."""
    words = _words_of()
    size = F.col("words")
    inside = candidates.where(size > 2).select(
        "lang", F.col("a").alias("longer"),
        F.explode(F.array(F.array_join(F.slice(words, F.lit(1), size - 1), " "), F.array_join(F.slice(words, F.lit(2), size - 1), " "))).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    joined = candidates.join(most, ["lang", "phrase"], "left")
    swallowed = F.expr("cast(100 as decimal(38,0)) * cast(longer as decimal(20,0)) >= cast(80 as decimal(38,0)) * cast(a as decimal(20,0))")
    return joined.where(F.coalesce(~swallowed, F.lit(True))).drop("longer")


def _ranked(standing: DataFrame, limit: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return standing.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= limit)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, limit: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``limit`` surviving phrases."""
    texts = _texts(docs, lang_col, text_col)
    words = checkpointed(count_words(texts))
    totals = checkpointed(words.groupBy("lang").agg(F.sum("f").alias("n")))
    frequent = checkpointed(words.where(F.col("f") >= least))
    word_bits = bit_table(frequent.select(_hashed("w").alias("hash")))
    pairs = checkpointed(count_pairs(texts, word_bits).where(F.col("f") >= least))
    pair_bits = bit_table(pairs.select(_hashed("p").alias("hash")))
    runs = checkpointed(count_runs(texts, word_bits, pair_bits))
    counts = [frequent, pairs]
    candidates = [checkpointed(scored(pairs, frequent, 2))]
    grown: list[DataFrame] = []

    def count_more(hashes: DataFrame, sizes: list[int]) -> list[DataFrame]:
        """Frequent phrases of those asked for that are not counted yet, by size."""
        more = count_grown(runs, sizes, bit_table(hashes)).where(F.col("f") >= least)
        more = checkpointed(more.join(_union(counts), ["lang", "phrase"], "left_anti"))
        return [more.where(F.size(_words_of()) == size) for size in sizes]

    while True:
        everything = _union(candidates)
        best = _ranked(_standing(everything), AHEAD * limit)
        lowest = checkpointed(best.groupBy("lang").agg(
            F.max(F.when(F.col("rank") == limit, F.col("score"))).alias("must"),
            F.max(F.when(F.col("rank") == AHEAD * limit, F.col("score"))).alias("may")))
        frontier = everything.where("words < 4").select("lang", "phrase", "words", "bound")
        if grown:
            frontier = frontier.join(_union(grown), ["lang", "phrase"], "left_anti")
        frontier = frontier.join(lowest, "lang", "left").where("bound >= coalesce(may, 0)")
        frontier = checkpointed(frontier.withColumn("due", F.expr("bound >= coalesce(must, 0)")))
        sizes = {r["words"]: (r["due"], r["n"]) for r in frontier.groupBy("words").agg(
            F.max("due").alias("due"), F.count(F.lit(1)).alias("n")).collect()}
        if not any(due for due, _ in sizes.values()):
            break
        grown.append(frontier.select("lang", "phrase"))
        longer = [size + 1 for size in sorted(sizes)]
        new = dict(zip(longer, count_more(frontier.select(_hashed("+").alias("hash")), longer), strict=True))
        if 3 in new:
            counts.append(new[3])
            candidates.append(checkpointed(scored(new[3], _union(counts), 3)))
        if 4 in new:
            # both parts of three words must be counted before a phrase of four can be scored
            ends = new[4].select("lang", F.explode(F.array(F.array_join(F.slice(_words_of(), 1, 3), " "),
                                                           F.array_join(F.slice(_words_of(), 2, 3), " "))).alias("phrase")).distinct()
            missing = checkpointed(ends.join(_union(counts), ["lang", "phrase"], "left_anti"))
            if missing.limit(1).count():
                (three,) = count_more(missing.select(_hashed("=").alias("hash")), [3])
                counts.append(three)
                candidates.append(checkpointed(scored(three, _union(counts), 3)))
            counts.append(new[4])
            candidates.append(checkpointed(scored(new[4], _union(counts), 4)))
    best = _ranked(_standing(_union(candidates)), limit)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
