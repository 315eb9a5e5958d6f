"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word is the vector of its counts in ``GROUPS`` groups of letters, each count cut off at 15. The
trie of a vocabulary has one level for each group; a path is the successive counts. Inserting,
deleting or replacing a letter raises at most one count by one and lowers at most one by one, so
the search for a word's neighbours goes down from the root with a budget of one surplus and one
deficit. Leaves hold the words of one vector; a pair is told first by the halves of the words (one
of them is untouched), then letter by letter.

The trie is spread over the cluster by subtrees. Words per prefix are counted in Spark; a node with
more than ``limit`` words is open, its closed children are the subtrees. There are at most
``GROUPS * words / limit`` open nodes with 16 children each, and ``limit`` grows with the number of
words so that these nodes, which go to all workers, stay below ``TOP_NODES``. A word is sent to
every subtree that its budget reaches, with what is left of the budget; in a subtree the words that
live there come first in the sort order and are indexed, the others pass by as a stream. A vector
with more than ``limit`` words is cut into blocks by a hash of the word, each searched by all words
that reach the vector. What leaves a subtree is one row for each word: its number of neighbours
there and the best one. No list of pairs is made.

Defined results: null texts hold no words; a null id is the empty text in the hash's input;
repeated rows count again; an empty table gives no rows; equally frequent neighbours go by code
points. Further input columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letter groups in the order of the trie's levels; everything else belongs to the last one.
LETTER_GROUPS = ("e", "t", "n", "a", "r", "i", "o", "h", "s", "d", "l", "u", "cg", "bmw", "")
GROUPS = len(LETTER_GROUPS)
CUT = 15
#: A subtree holds so many words, more once the nodes above the subtrees would pass TOP_NODES.
SUBTREE_WORDS = 12_000
TOP_NODES = 1_000_000
#: Open paths and candidate pairs that are worked on at a time.
BLOCK_WORDS = 4_096
BLOCK_PATHS = 1 << 20
BLOCK_PAIRS = 1 << 20

_GROUP_OF = np.full(256, GROUPS - 1, dtype=np.int64)
for _i, _letters in enumerate(LETTER_GROUPS):
    for _c in _letters:
        _GROUP_OF[ord(_c)] = _i


def vectors(words: list[str]) -> np.ndarray:
    """Counts of every word's letters in the groups, one row a word."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    group = np.where(codes < 256, _GROUP_OF[np.minimum(codes, 255)], GROUPS - 1)
    row = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(row * GROUPS + group, minlength=len(words) * GROUPS)
    return np.minimum(counts.reshape(len(words), GROUPS), CUT)


def packed(counts: np.ndarray, depth: int = GROUPS) -> np.ndarray:
    """The first ``depth`` counts as one number, four bits each, below a leading one."""
    out = np.ones(len(counts), dtype=np.int64)
    for level in range(depth):
        out = (out << 4) | counts[:, level]
    return out


class Trie:
    """Nodes below a root at level ``top``; ``child[node, count]`` is the next node, -1 if there is none.

    ``leaf`` numbers a childless node by its place in the given sorted packed prefixes.
    """

    def __init__(self, prefixes: np.ndarray, depths: np.ndarray, top: int):
        self.top = top
        deepest = int(depths.max()) if len(depths) else top
        levels, places = [], []
        for level in range(top, deepest + 1):
            reach = depths >= level
            levels.append(np.unique(prefixes[reach] >> (4 * (depths[reach] - level))))
        self.first = np.cumsum([0] + [len(x) for x in levels])
        self.child = np.full((int(self.first[-1]), CUT + 1), -1, dtype=np.int32)
        self.leaf = np.full(int(self.first[-1]), -1, dtype=np.int32)
        for i in range(1, len(levels)):
            parent = np.searchsorted(levels[i - 1], levels[i] >> 4)
            self.child[self.first[i - 1] + parent, levels[i] & 15] = self.first[i] + np.arange(len(levels[i]))
        for i, level in enumerate(range(top, deepest + 1)):
            ends = np.flatnonzero(depths == level)
            self.leaf[self.first[i] + np.searchsorted(levels[i], prefixes[ends])] = ends

    def search(self, counts: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(word, leaf, surplus left, deficit left) of all leaves the words' budgets reach, in blocks.

        The deepest block of open paths goes on first, so few of them are open at a time.
        """
        open_paths = []
        if len(self.child):
            for a in range(0, len(counts), BLOCK_WORDS):
                q = np.arange(a, min(len(counts), a + BLOCK_WORDS))
                open_paths.append((self.top, q, np.zeros(len(q), dtype=np.int64), surplus[q], deficit[q]))
        while open_paths:
            level, q, node, s, d = open_paths.pop()
            if len(q) > BLOCK_PATHS:
                half = len(q) // 2
                open_paths += [(level, q[:half], node[:half], s[:half], d[:half]), (level, q[half:], node[half:], s[half:], d[half:])]
                continue
            at_leaf = self.leaf[node] >= 0
            if at_leaf.any():
                yield q[at_leaf], self.leaf[node[at_leaf]], s[at_leaf], d[at_leaf]
                q, node, s, d = q[~at_leaf], node[~at_leaf], s[~at_leaf], d[~at_leaf]
            if not len(q):
                continue
            count = counts[q, level]
            steps = []
            for more, can in ((0, np.ones(len(q), dtype=bool)), (1, (s > 0) & (count < CUT)), (-1, (d > 0) & (count > 0))):
                which = np.flatnonzero(can)
                below = self.child[node[which], count[which] + more]
                which = which[below >= 0]
                steps.append((q[which], below[below >= 0].astype(np.int64), s[which] - (more > 0), d[which] - (more < 0)))
            open_paths.append((level + 1, *[np.concatenate(x) for x in zip(*steps, strict=True)]))


def one_edit(x: str, y: str) -> bool:
    """Whether exactly one character is inserted, deleted or replaced."""
    if len(x) < len(y):
        x, y = y, x
    if len(x) - len(y) > 1 or x == y:
        return False
    i = 0
    while i < len(y) and x[i] == y[i]:
        i += 1
    return x[i + 1:] == y[i + (len(x) == len(y)):]


def _halves(words: list[str]) -> np.ndarray:
    """Hashes of the first and last parts of each word, for partners that are not shorter and that are one shorter."""
    out = np.empty((4, len(words)), dtype=np.int64)
    for i, w in enumerate(words):
        n = len(w)
        h, g = n // 2, (n - 1) // 2
        out[0, i], out[1, i], out[2, i], out[3, i] = hash(w[:h]), hash(w[h:]), hash(w[:g]), hash(w[g + 1:])
    return out


class Subtree:
    """The words that live in a subtree, with their trie; ``near`` searches it for other words."""

    def __init__(self, words: list[str], freq: np.ndarray, top: int):
        code = packed(vectors(words)) if words else np.empty(0, dtype=np.int64)
        order = np.argsort(code, kind="stable")
        self.words = [words[i] for i in order]
        self.freq = freq[order]
        leaves, self.start = np.unique(code[order], return_index=True)
        self.stop = np.append(self.start[1:], len(words))
        self.trie = Trie(leaves, np.full(len(leaves), GROUPS), top)
        self.length = np.fromiter(map(len, self.words), dtype=np.int64, count=len(words))
        self.half = _halves(self.words)
        self.rank = np.empty(len(words), dtype=np.int64)
        self.rank[sorted(range(len(words)), key=self.words.__getitem__)] = np.arange(len(words))

    def near(self, words: list[str], surplus: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of near words here, place of the best of them or -1) of each word."""
        n_near = np.zeros(len(words), dtype=np.int64)
        best = np.full(len(words), -1, dtype=np.int64)
        if not words:
            return n_near, best
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        half = _halves(words)
        for q, leaf, _, _ in self.trie.search(vectors(words), surplus, deficit):
            sizes = self.stop[leaf] - self.start[leaf]
            ends = np.cumsum(sizes)
            at = 0
            while at < len(q):
                done = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + BLOCK_PAIRS, side="right")))
                x = np.repeat(q[at:to], sizes[at:to])
                y = np.arange(len(x)) + np.repeat(self.start[leaf[at:to]] - (ends[at:to] - sizes[at:to] - done), sizes[at:to])
                self._verified(words, length, half, x, y, n_near, best)
                at = to
        return n_near, best

    def _verified(self, words, length, half, x, y, n_near, best) -> None:
        more = length[x] - self.length[y]
        same, longer, shorter = (half[i][x] for i in (0, 1)), more == 1, more == -1
        a, b = same
        hit = (more == 0) & ((a == self.half[0][y]) | (b == self.half[1][y]))
        # the shorter word's halves stand at the ends of the longer one
        hit |= longer & ((half[2][x] == self.half[0][y]) | (half[3][x] == self.half[1][y]))
        hit |= shorter & ((a == self.half[2][y]) | (b == self.half[3][y]))
        x, y = x[hit], y[hit]
        right = np.fromiter((one_edit(words[i], self.words[j]) for i, j in zip(x.tolist(), y.tolist(), strict=True)),
                            dtype=bool, count=len(x))
        x, y = x[right], y[right]
        if not len(x):
            return
        np.add.at(n_near, x, 1)
        order = np.lexsort((self.rank[y], -self.freq[y], x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        x, y = x[first], y[first]
        old = best[x]
        better = (old < 0) | (self.freq[y] > self.freq[old]) | ((self.freq[y] == self.freq[old]) & (self.rank[y] < self.rank[old]))
        best[x[better]] = y[better]


def misspelt_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7,
                   min_count: int = 2, one_of: int = 31) -> DataFrame:
    """(word, n): words of the texts, one letter gone where ``one_of`` divides the hash of id and word."""
    text = F.translate(text_or_empty(text_col), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.filter(F.regexp_extract_all(text, F.lit("([A-Za-zÀ-ÿ]+)"), F.lit(1)),
                           lambda w: F.length(w) >= min_chars)).alias("run"))
    h = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % one_of == 0, F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + F.lit(2)))).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _top_nodes(words: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed prefix, depth, words) of the subtrees: the root, or the closed children of open nodes."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, n = np.unique(packed(vectors(batch.column(0).to_pylist())), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

    full = words.select("word").mapInArrow(counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    level = F.explode(F.sequence(F.lit(0), F.lit(GROUPS)))
    nodes = (full.select("code", "n", level.alias("depth"))
             .select("depth", F.expr(f"shiftright(code, 4 * ({GROUPS} - depth))").alias("prefix"), "n")
             .groupBy("depth", "prefix").agg(F.sum("n").alias("n")))
    opened = F.col("n") > limit
    # a subtree is a node that is not open itself under a parent that is; a full vector is one in any case
    parents = nodes.where(opened & (F.col("depth") < GROUPS)).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    below = nodes.withColumn("parent", F.shiftright("prefix", 4)).join(parents, ["depth", "parent"], "left_semi")
    root = nodes.where("depth = 0").select("depth", F.lit(0).cast("long").alias("parent"), "prefix", "n")
    ends = root.unionByName(below.select("depth", "parent", "prefix", "n")).where(~opened | (F.col("depth") == GROUPS))
    got = ends.select("prefix", "depth", "n").toPandas().sort_values(["depth", "prefix"])
    return (got["prefix"].to_numpy(np.int64), got["depth"].to_numpy(np.int64), got["n"].to_numpy(np.int64))


def near_words(words: DataFrame, subtree_words: int = SUBTREE_WORDS) -> DataFrame:
    """(word, n, n_near, best_n, best) of a table (word, n) of distinct words.

    n_near counts the words at exactly one edit; best is the most frequent of them.
    """
    total = words.agg(F.count(F.lit(1))).first()[0]
    limit = max(subtree_words, math.ceil(total * GROUPS * (CUT + 1) / TOP_NODES))
    prefixes, depths, sizes = _top_nodes(words, limit)
    sent = words.sparkSession.sparkContext.broadcast((prefixes, depths, np.maximum(1, -(-sizes // limit))))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        prefix, depth, blocks = sent.value
        trie = Trie(prefix, depth, 0)
        for batch in batches:
            text = batch.column(0).to_pylist()
            ones = np.ones(len(text), dtype=np.int64)
            for q, leaf, s, d in trie.search(vectors(text), ones, ones):
                lives = (s + d) == 2
                own = np.fromiter((crc32(text[i].encode()) if b > 1 else 0 for i, b in zip(q, blocks[leaf], strict=True)),
                                  dtype=np.int64, count=len(q)) % blocks[leaf]
                times = blocks[leaf]
                row = np.repeat(np.arange(len(q)), times)
                block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                picked = pa.array(q[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix[leaf[row]]), pa.array(depth[leaf[row]].astype(np.int32)), pa.array(block.astype(np.int32)),
                     pa.array(~(lives[row] & (own[row] == block))), pa.array(s[row].astype(np.int32)), pa.array(d[row].astype(np.int32)),
                     batch.column(0).take(picked), batch.column(1).take(picked)],
                    names=["prefix", "depth", "block", "guest", "surplus", "deficit", "word", "n"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, home_words, home_n, tree = None, [], [], None
        for batch in batches:
            prefix, block = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            cuts = np.flatnonzero((prefix[1:] != prefix[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if (prefix[a], block[a]) != here:
                    here, home_words, home_n, tree = (prefix[a], block[a]), [], [], None
                homes = part.num_rows - pa.compute.sum(part.column(3)).as_py()
                text, freq = part.column(6).to_pylist(), part.column(7).to_numpy()
                home_words += text[:homes]
                home_n.append(freq[:homes])
                if homes < part.num_rows:
                    tree = tree or Subtree(home_words, np.concatenate(home_n), int(part.column(1)[0].as_py()))
                    yield from result(tree, text[homes:], freq[homes:], part.column(4).to_numpy()[homes:], part.column(5).to_numpy()[homes:])

    def result(tree: Subtree, text: list[str], freq: np.ndarray, s: np.ndarray, d: np.ndarray) -> Iterator[pa.RecordBatch]:
        n_near, best = tree.near(text, s, d)
        some = np.flatnonzero(n_near)
        yield pa.RecordBatch.from_arrays(
            [pa.array([text[i] for i in some], pa.string()), pa.array(freq[some]), pa.array(n_near[some]),
             pa.array(tree.freq[best[some]]), pa.array([tree.words[j] for j in best[some]], pa.string())],
            names=["word", "n", "n_near", "best_n", "best"])

    spread = words.select("word", "n").mapInArrow(
        routed, "prefix long, depth int, block int, guest boolean, surplus int, deficit int, word string, n long")
    # a word searches its own subtree as a guest, too
    lives = F.explode(F.when(F.col("guest"), F.array(F.lit(True))).otherwise(F.array(F.lit(False), F.lit(True))))
    spread = spread.withColumn("guest", lives)
    found = (spread.repartition("prefix", "block").sortWithinPartitions("prefix", "block", "guest")
             .mapInArrow(searched, "word string, n long, n_near long, best_n long, best string"))
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"))
    # frequent ones first, then by code points, which is the order of the UTF-8 bytes
    first = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))))
    return (found.unionByName(none).groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
            .select("word", "n", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form) whose forms lead to an end without a circle."""
    at = checkpointed(links.select("word", F.col("form").alias("root")))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = at.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        longer = checkpointed(longer)
        if not longer.where("moved").limit(1).count():
            return longer.select("word", "root")
        at = longer.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the near word at least ``times`` as frequent, and where forms lead."""
    words = checkpointed(misspelt_words(docs, id_col, text_col))
    near = near_words(words)
    good = F.col("best_n") >= times * F.col("n")
    near = checkpointed(near.select("word", "n", "n_near", F.when(good, F.col("best")).alias("form"),
                                    F.when(good, F.col("best_n")).alias("form_n")))
    ends = roots(near.where("form is not null").select("word", "form"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
