"""Registered queries opN_<name> over the driver's tables, with production parameters."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    fingerprints, line_dedup, lm_score, mixing, near_dedup, packing, phrases, pii, quality_rules, secret_scan, spelling, token_counts, url_filter,
)
from .common import table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and log-likelihood ratio of every document; the trusted target are the labelled good ones."""
    out = quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "score")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' targets."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return fingerprints.edited(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every line under the edit join, and whether it stays."""
    return line_dedup.line_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "line_no", "class_id", "class_lines", "kept")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text."""
    d = secret_scan.scan(table(spark, sf_dir, "documents"))

    def of_kind(no: int):
        return F.size(F.filter("base", lambda s: s["no"] == no)).cast("long").alias(f"n_{secret_scan.KINDS[no]}")

    return d.select("doc_id", of_kind(0), of_kind(1), of_kind(2),
                    F.sha2(secret_scan.joined(F.col("base")), 256).alias("base_sha256"),
                    secret_scan.joined(F.sort_array(F.concat("base", "added"))).alias("spans"),
                    F.size("added").cast("long").alias("n_entropy"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text."""
    d = pii.find(table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])

    def of_kind(no: int):
        return F.size(F.filter("base", lambda s: s["kind"] == no)).cast("long").alias(f"n_{pii.KINDS[no]}")

    def joined(spans):
        return F.concat_ws(",", F.transform(F.sort_array(spans), lambda s: F.concat_ws(
            ":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))

    return d.select("doc_id", *[of_kind(i) for i in range(len(pii.KINDS))], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                    joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text, exact unigram base and Bloom filter model."""
    return lm_score.score(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of all texts."""
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all texts."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


OP13_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM cut
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN host || path || query = '' THEN 'block'
    WHEN regexp_matches(host, 'spam-farm|cheap-pills|casino|free-bets') AND (path <> '' OR query = '') THEN 'block'
    WHEN path <> '' AND (host LIKE 'ads.%' OR host LIKE '%.ads.%' OR host LIKE 'tracker.%' OR host LIKE '%.tracker.%') THEN 'block'
    WHEN host || path || query LIKE '%/wp-login.php%' OR host || path || query LIKE '%/cart/checkout%' THEN 'block'
    WHEN host || path || query LIKE '%.exe' OR contains(host || path || query, '.exe?') THEN 'block'
    WHEN regexp_full_match(host || path || query, '[^/?]*/login(\?(.|\n)*)?') THEN 'block'
    WHEN regexp_matches(host || path || query, 'sessionid=[^/?]{16}') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_quality_rules, op3_mixing, op4_packing, op5_near_dedup, op6_fingerprints, op7_line_dedup,
    op8_secret_scan, op9_pii, op10_lm_score, op11_phrases, op12_spelling, op13_url_filter)}
ORACLES: dict[str, str] = {"op13_url_filter": OP13_SQL}
