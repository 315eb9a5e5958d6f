"""URL filter: all glob rules at once as one multiword Shift-And automaton over each canonical URL.

A canonical URL is the host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased), the path (up to ``?``, ``#`` or the end) and, with its question mark, the query; the
fragment is left out. A glob must fit the whole of it: ``*`` is a run of any characters but ``/``
and ``?``, ``**`` a run of any characters, ``?`` one character that is neither, a backslash takes
the next character as it is.

Every glob takes one bit for its start and one for each character that is not a star; the bits of
all globs stand one after the other in 64-bit words. One step of all globs over one character is
``(state << 1 & enter[c]) | (state & stay[c])``: a start bit is never entered, so what a shift
carries from one glob into the next is cleared, and a star keeps the bit before it set. The URLs of
an Arrow batch take their steps together, the longest first, so a step costs no more than the URLs
still running.

A rule (verdict, host, path) fits the host and all its subdomains if the path starts with the
rule's; it is two globs, ``host path**`` and ``*.host path**``. The rule with the longest text wins,
among equally long ones the first. Where no rule fits, the first fitting glob of ``blocked`` blocks,
everything else is allowed.

Defined results: a null url and one without ``://`` have an empty host and path, the canonical URL
is empty and the empty glob of ``BLOCKED`` fits it; an empty host or path is an empty text; repeated
rows are judged each; an empty table gives no rows. ``judged`` keeps all input columns and puts its
result in one struct column, so clashing names do no harm.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path) of the contract.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Globs that block where no rule fits. The empty one is a URL that can't be fetched.
BLOCKED = (
    "",
    "*spam-farm*/**", "*spam-farm*",
    "*cheap-pills*/**", "*cheap-pills*",
    "*casino*/**", "*casino*",
    "*free-bets*/**", "*free-bets*",
    "ads.*/**", "*.ads.*/**", "tracker.*/**", "*.tracker.*/**",
    "**/wp-login.php**", "**/cart/checkout**", "**.exe", "**.exe\\?**",
    "*/login", "*/login\\?**", "**sessionid=????????????????**",
)
#: Characters that step together in one slice of a batch.
SLICE_CHARS = 1 << 20


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, canonical URL) of a URL column."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    return host, path, F.concat(host, path, query)


def parsed(glob: str) -> tuple[list[str], list[str]]:
    """(characters with ``?`` as None's stand-in "", star before each and after the last: "", "*" or "**")."""
    chars: list[str] = []
    stars = [""]
    i = 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            run = len(glob[i:]) - len(glob[i:].lstrip("*"))
            stars[-1] = "**" if run > 1 or stars[-1] == "**" else "*"
            i += run
            continue
        if c == "\\" and i + 1 < len(glob):
            i += 1
            chars.append(glob[i])
        else:
            chars.append("" if c == "?" else c)
        stars.append("")
        i += 1
    return chars, stars


class Automaton:
    """The masks of many globs. ``fits`` tells for each text which globs fit it."""

    def __init__(self, globs: Sequence[str]):
        forms = [parsed(g) for g in globs]
        self.starts = np.cumsum([0] + [len(stars) for _, stars in forms])
        self.words = max(1, -(-int(self.starts[-1]) // 64))
        known = sorted({c for chars, _ in forms for c in chars if c} | {"/", "?"})
        self.codes = np.array([ord(c) for c in known], dtype=np.uint32)
        symbol = {c: i for i, c in enumerate(known)}
        self.other = len(known)
        self.enter = np.zeros((len(known) + 1, self.words), dtype=np.uint64)
        self.stay = np.zeros((len(known) + 1, self.words), dtype=np.uint64)
        self.begin = np.zeros(self.words, dtype=np.uint64)
        parting = {symbol["/"], symbol["?"]}
        inner = [s for s in range(len(known) + 1) if s not in parting]
        for (chars, stars), first in zip(forms, self.starts, strict=False):
            self._set(self.begin, first)
            for i, star in enumerate(stars):
                for s in (inner if star == "*" else range(len(known) + 1) if star else ()):
                    self._set(self.stay[s], first + i)
            for i, c in enumerate(chars, 1):
                for s in ([symbol[c]] if c else inner):
                    self._set(self.enter[s], first + i)
        ends = self.starts[1:] - 1
        self.end_word, self.end_bit = ends // 64, (ends % 64).astype(np.uint64)

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def fits(self, texts: Sequence[str]) -> np.ndarray:
        """Boolean matrix texts x globs."""
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(-lengths, kind="stable")
        sizes = lengths[order]
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        symbols = np.where(self.codes[at] == codes, at, self.other)
        first = (np.cumsum(lengths) - lengths)[order]
        state = np.repeat(self.begin[None, :], len(texts), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for j in range(int(sizes[0]) if len(sizes) else 0):
            running = int(np.searchsorted(-sizes, -j, side="left"))
            s = symbols[first[:running] + j]
            now = state[:running]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:running] = (moved & self.enter[s]) | (now & self.stay[s])
        out = np.empty((len(texts), len(self.end_word)), dtype=bool)
        out[order] = (state[:, self.end_word] >> self.end_bit & one).astype(bool)
        return out


def slices(texts: Sequence[str], max_chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive texts of about ``max_chars`` characters, one text at least."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > max_chars:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def _globs_of(rules: Sequence[tuple[str, str, str]]) -> list[str]:
    def plain(text: str) -> str:
        return "".join("\\" + c if c in "*?\\" else c for c in text)

    return [g for _, host, path in rules for g in (f"{plain(host)}{plain(path)}**", f"*.{plain(host)}{plain(path)}**")]


def first_fit(canonical: Column, rules: Sequence[tuple[str, str, str]], blocked: Sequence[str]) -> Column:
    """Struct (rule, glob): numbers of the winning rule and of the first fitting glob, null if none fits."""
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), i))
    globs = _globs_of([rules[i] for i in ranked]) + list(blocked)
    numbers = np.array(ranked + [-1], dtype=np.int64)
    made: list[Automaton] = []

    def first(hits: np.ndarray) -> np.ndarray:
        return np.where(hits.any(axis=1), hits.argmax(axis=1), -1) if hits.shape[1] else np.full(len(hits), -1)

    @F.pandas_udf("rule int, glob int")
    def winners(urls: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(Automaton(globs))
        texts = urls.tolist()
        parts = [np.empty((0, 2), dtype=np.int64)]
        for a, b in slices(texts):
            hits = made[0].fits(texts[a:b])
            of_rules = hits[:, :2 * len(ranked)].reshape(b - a, len(ranked), 2).any(axis=2)
            parts.append(np.stack([numbers[first(of_rules)], first(hits[:, 2 * len(ranked):])], axis=1))
        out = pd.DataFrame(np.concatenate(parts), columns=["rule", "glob"]).astype("Int32")
        return out.mask(out < 0)

    return winners(canonical)


def judged(pages: DataFrame, url_col: str = "url", out: str = "judged",
           rules: Sequence[tuple[str, str, str]] = RULES, blocked: Sequence[str] = BLOCKED) -> DataFrame:
    """The pages with a struct (host, path, rule, glob, verdict) of each URL.

    rule and glob are the texts of the winning rule and of the glob that blocked, null where none did.
    """
    host, path, canonical = url_parts(F.col(f"`{url_col}`"))
    columns = [F.col(f"`{c}`") for c in pages.columns if c != out]
    work = pages.select(F.struct(*columns).alias("page"), host.alias("host"), path.alias("path"), canonical.alias("canonical"))
    work = work.withColumn("fit", first_fit(F.col("canonical"), rules, blocked))

    def named(values: Sequence[str], at: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]).cast("array<string>"), at)

    rule = named([h + p for _, h, p in rules], F.col("fit.rule"))
    glob = F.when(F.col("fit.rule").isNull(), named(blocked, F.col("fit.glob")))
    verdict = F.coalesce(named([v for v, _, _ in rules], F.col("fit.rule")),
                         F.when(F.col("fit.glob").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return work.select("page.*", F.struct("host", "path", rule.alias("rule"), glob.alias("glob"), verdict.alias("verdict")).alias(out))


def allowed(pages: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
            blocked: Sequence[str] = BLOCKED) -> DataFrame:
    """The pages whose URL is allowed, with the columns they came with."""
    mark = "_url_verdict"
    while mark in pages.columns:
        mark += "_"
    return judged(pages, url_col, mark, rules, blocked).where(F.col(f"{mark}.verdict") == "allow").drop(mark)
