"""Secret scan: patterns, and sliding-window Shannon entropy over candidate strings.

DataFrame functions only, no shuffle. A candidate is a run of 20 or more characters of
``[A-Za-z0-9+/_=-]`` with a letter and a digit. Its character class (hexadecimal, or any)
sets the entropy that a window of ``WINDOW`` characters must reach. The window moves by one
character: the counts of the entering and leaving character change, and with them the sum
of c * log2(c), from which the entropy follows. The span reaches from the first such window
to the end of the last. Candidates on the allow list are dropped, and so are spans that lie
within a base span.

Offsets are code points, end exclusive. Null text counts as empty; empty tables give no
rows; repeated rows are scanned each; null ids stay null; other columns are not read.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LONG = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})"""
ACCESS = "AKIA[A-Z0-9]{14,}"  # a shorter run can't pass, and nothing else begins inside it that can
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
HEX_BITS = 2.9
ANY_BITS = 3.6
_RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE = rf"(?<!{_RUN})(?=[0-9+/_=-]*[A-Za-z])(?=[A-Za-z+/_=-]*[0-9]){_RUN}{{{WINDOW},}}"
#: Candidates that are no secrets: UUIDs, placeholders, counting runs, paths of short names.
ALLOWED = (
    "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    "(?i)(example|sample|dummy|placeholder|changeme|xxxx)",
    "0123456789|abcdefghij|ABCDEFGHIJ",
    "^/?([A-Za-z0-9_-]{1,15}/){2,}[A-Za-z0-9_-]{0,15}$",
)
_FIRST, _SLOTS = ord("+"), ord("z") - ord("+") + 1
_BLOCK = 512


def _sums_before(sizes: Column) -> Column:
    """Sum of the elements before each element, by blocks, so that long arrays stay cheap."""

    def within(xs: Column) -> Column:
        return F.aggregate(xs, F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<bigint>").alias("a")),
                           lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")),
                           lambda acc: acc["a"])

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(sizes, b * _BLOCK + 1, _BLOCK))
    before = within(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + y)))
    return F.flatten(F.zip_with(blocks, before, lambda x, s: F.transform(within(x), lambda y: y + s)))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, found, value) of the pattern's non-overlapping matches, or null without any."""
    regex = F.lit(pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    value = F.regexp_extract_all(text, regex, F.lit(group))
    gaps = F.slice(F.split(text, pattern), 1, F.size(found))
    starts = F.zip_with(_sums_before(F.zip_with(gaps, found, lambda g, m: (F.length(g) + F.length(m)).cast("long"))),
                        gaps, lambda s, g: s + F.length(g))
    return F.transform(F.arrays_zip(starts.alias("s"), found.alias("f"), value.alias("v")), lambda x: F.struct(
        x["s"].alias("start"), (x["s"] + F.length(x["f"])).alias("end"), x["f"].alias("found"), x["v"].alias("value")))


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(F.coalesce(matches, F.array().cast("array<struct<start:bigint,end:bigint,found:string,value:string>>")),
                       lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("no"), m["end"].alias("end")))


def _entropy_span(m: Column) -> Column:
    """(start, no, end) from the first to the last window of the candidate that reaches its class's entropy, or null."""
    codes = F.transform(F.split(m["found"], "(?!^)"), lambda c: F.ascii(c) - _FIRST)
    least = F.when(m["found"].rlike("^([0-9a-f]+|[0-9A-F]+)$"), HEX_BITS).otherwise(ANY_BITS)
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])

    def moved(acc: Column, i: Column) -> Column:
        enter, leave = acc["codes"][i], F.when(i >= WINDOW, acc["codes"][i - WINDOW]).otherwise(-1)
        # the leaving character goes first, so a count never exceeds the window
        held = F.transform(acc["counts"], lambda c, k: c - F.when(k == leave, 1).otherwise(0))
        was = acc["counts"][leave]
        out = F.when(leave >= 0, weight[was - 1] - weight[was]).otherwise(0.0)
        had = acc["counts"][enter] - F.when(enter == leave, 1).otherwise(0)
        total = acc["sum"] + out + weight[had + 1] - weight[had]
        hit = (i >= WINDOW - 1) & (math.log2(WINDOW) - total / WINDOW >= acc["least"])
        return F.struct(
            acc["codes"].alias("codes"), acc["least"].alias("least"),
            F.transform(held, lambda c, k: c + F.when(k == enter, 1).otherwise(0)).alias("counts"), total.alias("sum"),
            F.coalesce(acc["first"], F.when(hit, i - (WINDOW - 1))).alias("first"),
            F.coalesce(F.when(hit, i + 1), acc["last"]).alias("last"))

    state = F.struct(codes.alias("codes"), least.alias("least"), F.array_repeat(F.lit(0), _SLOTS).alias("counts"),
                     F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    return F.aggregate(F.sequence(F.lit(0), F.length(m["found"]) - 1), state, moved, lambda acc: F.when(
        acc["last"].isNotNull(), F.struct((m["start"] + acc["first"]).alias("start"), F.lit(KINDS.index("entropy")).alias("no"),
                                          (m["start"] + acc["last"]).alias("end"))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """(doc_id, text, base, added): arrays of (start, no, end), ``no`` being the place in KINDS, by start then kind."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    text = F.col("text")
    d = d.withColumns({
        "assign": F.when(text.rlike(ASSIGN_LONG), F.filter(_matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= 12)),
        "access": F.when(text.rlike(ACCESS), _matches(text, ACCESS)),
        "hex": F.when(text.rlike(HEX), _matches(text, HEX)),
        "candidates": F.when(text.rlike(CANDIDATE), _matches(text, CANDIDATE))})
    d = d.withColumn("base", F.sort_array(F.concat(*[_spans(F.col(k), k) for k in KINDS[:3]])))
    suspects = F.filter("candidates", lambda m: ~F.exists(
        F.array(*[F.lit(p) for p in allowed]).cast("array<string>"), lambda p: F.regexp_like(m["found"], p)))
    d = d.withColumn("windows", F.when(F.size("candidates") > 0, F.transform(suspects, _entropy_span)))
    added = F.filter("windows", lambda s: s.isNotNull() & ~F.exists(
        "base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    return d.select("doc_id", "text", "base", F.coalesce(
        F.sort_array(added), F.array().cast("array<struct<start:bigint,no:int,end:bigint>>")).alias("added"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", kinds[s["no"]], s["start"].cast("string"), s["end"].cast("string"))))
