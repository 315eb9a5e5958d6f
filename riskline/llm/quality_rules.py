"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

DataFrame functions only. Words and word pairs are hashed into ``buckets`` counters. One
pass counts them over all documents (raw) and over the trusted ones (target); both are
multinomials over the buckets, scaled to the target's size and given the same pseudo-counts, so
a bucket seen too seldom to say anything scores about 0; the occurrence that is scored is not
counted among the raw ones. A document's score is the mean of log(target / raw) over
its n-grams; it passes with a score of at least ``min_score``. Every document is decided by
the same fixed threshold.

The trusted documents are labelled rows with quality 1: all of them up to ``max_trusted``
(a documented bound), beyond it those with the smallest hash of the id. Only their ids are
broadcast. The corpus counts cover every document. The model is one number per bucket, so
its size does not depend on the input, and scoring needs no shuffle.

Defined results: null text counts as empty; a text without words scores 0 and fails the
base rules; without labels every document scores 0 (the method then passes all); repeated
rows are counted and returned each; null ids are never trusted; other columns are kept.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, text_or_empty, words

BUCKETS = 1 << 14
MAX_TRUSTED = 20_000
PRIOR = 10.0 # pseudo-counts of every bucket on both sides
MIN_SCORE = -0.04
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Model:
    """log(target / raw) of each bucket, natural log."""

    ratios: tuple[float, ...]

    def column(self) -> Column:
        """The ratios as one constant array."""
        return F.expr("cast(split('" + ",".join(f"{x:.6g}" for x in self.ratios) + "', ',') as array<double>)")


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, key, text, words, hashes); ``row`` holds all input columns, so none can clash."""
    d = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("key"), text_or_empty(text_col).alias("text"))
    d = d.withColumn("words", words(F.col("text")))
    return d.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _grams(buckets: int) -> Column:
    """Bucket of each word and of each pair of neighbours."""
    hashes, n = F.col("hashes"), F.size("hashes")
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    pairs = F.transform(F.slice(hashes, 1, F.greatest(n - 1, F.lit(0))),
                        lambda h, i: F.pmod(F.xxhash64(h, hashes[i + 1]), F.lit(buckets)).cast("int"))
    return F.concat(single, pairs)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED, prior: float = PRIOR) -> Model:
    """Count the n-grams of all documents and of the trusted ones; one row per bucket reaches the driver."""
    trusted = (labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("trusted")).distinct()
               .orderBy(F.xxhash64("trusted"), "trusted").limit(max_trusted))
    d = _hashed(docs, id_col, text_col).join(F.broadcast(trusted), F.col("key") == F.col("trusted"), "left")
    counts = (d.select(F.col("trusted").isNotNull().cast("int").alias("t"), F.explode(_grams(buckets)).alias("bucket"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target")))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for b, r, t in counts.collect():  # at most one row per bucket
        raw[b], target[b] = r, t
    if not raw.sum() or not target.sum():
        return Model((0.0,) * buckets)
    expected = np.maximum(raw - 1, 0) * (target.sum() / raw.sum())  # the occurrence that is scored does not speak against itself
    return Model(tuple(np.log((target + prior) / (expected + prior)).tolist()))


def _base(d: DataFrame) -> DataFrame:
    """Adds the columns of the base rules to (row, key, text, words, hashes)."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    d = d.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)),
        "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("long"),
        "lines": lines,
        # a window of three words is told by 64 bits
        "windows": F.transform(F.slice("hashes", 1, F.greatest(F.size("hashes") - 2, F.lit(0))),
                               lambda h, i: F.xxhash64(h, F.col("hashes")[i + 1], F.col("hashes")[i + 2]))})
    d = d.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    # equal windows are neighbours once sorted
    d = d.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(
        F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    d = d.withColumn("found", F.sort_array(F.transform(F.filter(
        "sorted", lambda x, i: (x["w"] == F.get("sorted", i - 1)["w"]) | (x["w"] == F.get("sorted", i + 1)["w"])),
        lambda x: x["i"])))
    # each window adds the words that the next one does not begin with
    return d.withColumn("n_repeat_words", F.coalesce(F.aggregate(F.transform(
        "found", lambda i, k: F.least(F.coalesce(F.get("found", k + 1) - i, F.lit(3)), F.lit(3))),
        F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def _decided(docs: DataFrame, model: Model, id_col: str, text_col: str, min_score: float) -> DataFrame:
    ratios = model.column()
    d = _base(_hashed(docs, id_col, text_col)).withColumn("grams", _grams(len(model.ratios)))
    d = d.withColumn("score", F.when(F.size("grams") == 0, 0.0).otherwise(F.round(F.aggregate(
        "grams", F.lit(0.0), lambda a, g: a + ratios[g]) / F.size("grams"), 6)))
    # always true, but no filter moves below it: there it would hold the expressions above many times over
    once = F.monotonically_increasing_id() >= 0
    d = d.withColumn("base_failed", once & ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= min_score))


def apply(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          min_score: float = MIN_SCORE) -> DataFrame:
    """The documents with the base counts, base_failed, score and kept (which replace columns of those names)."""
    d = _decided(docs, model, id_col, text_col, min_score)
    return d.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in RESULTS], *RESULTS)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on the documents themselves, then decide each of them."""
    return apply(docs, fit(docs, labels, id_col, text_col), id_col, text_col)


def filtered(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             min_score: float = MIN_SCORE) -> DataFrame:
    """The documents that pass, with the input's columns."""
    d = _decided(docs, fit(docs, labels, id_col, text_col), id_col, text_col, min_score)
    return d.where("kept").select("row.*")
