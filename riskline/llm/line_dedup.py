"""Line dedup: edit join by segments (threshold plus one), banded bit-parallel verification.

Two lines are linked if their edit distance is at most ``EDITS`` (lines below ``MIN_CHARS``
code points: if they are equal). A line of length l is cut into EDITS + 1 segments. If it is
within EDITS edits of a line s that is as long or longer, one segment stands in s, shifted
by a few places; which places must be tried follows from the lengths and the segment's
number (multi-match-aware selection). The index has a key (length, number, segment) per
segment, s probes its own and the shorter lengths. A probe of the own length at the own
place is the index key itself, so a line has 12 keys for 2 edits.

Keys are grouped by Spark; members of a key meet its hub, then only pairs of a key whose
components still differ can matter. In a key of up to ``FEW`` lines they are listed. Deeper
keys whose lines are all in one component go at once, and only larger ones have a hub. In a
larger key the rest of each line, without the segment that the key holds, is cut into
segments again: two lines that are linked through the key have rests within the same
threshold, so they share a key of the next level. After ``LEVELS`` such cuts what is left is
listed. Listing leaves out pairs that more edits than the threshold must part, told by the
parities of their character and pair counts. Pairs are verified by the bit-parallel
recurrence over the diagonal band, many pairs at a time. Classes are the components of the links; the first
line of a class by (doc_id, line number) stays, the others go.

Lines are taken without the white space around them; blank lines are no lines and always
stay. Lines with equal text are one node, told by 64 bits. Defined results: null text has no
lines; rows with equal id and text are one document, and equal ids with other texts are
ordered by a hash of the text; a null id comes first; an empty table gives no rows. Input
columns are kept by ``deduplicated``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, SPACE_CHARS, byte_slices, checkpointed, text_or_empty
from .links import components, grown

EDITS = 2
MIN_CHARS = 30
BROADCAST_ROWS = 500_000
SEEN_LINES = 200_000
#: Pairs of different components are listed in keys of so many lines at most, so a line meets fewer others than that in a key.
#: Cutting anew makes some tens of keys a line and level, each hashed, shuffled and sorted; a listed pair is two words compared.
FEW = 512
#: Larger keys are cut anew so many times; what is left is listed.
LEVELS = 3


def segments(n: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line of n characters; the last ones take the remainder."""
    size, more = divmod(n, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        length = size + (i >= edits + 1 - more)
        out.append((at, length))
        at += length
    return out


def places(n: int, edits: int) -> list[tuple[int, int, int, int, bool]]:
    """(indexed length, segment number, start, length, is the line's own segment) of all keys of a line of n characters."""
    out = []
    for l in range(max(edits + 1, n - edits), n + 1):
        shift = n - l
        for i, (p, size) in enumerate(segments(l, edits)):
            after = edits - i
            lo = max(0, p - i, p + shift - after)
            hi = min(n - size, p + i, p + shift + after)
            out += [(l, i, q, size, l == n and q == p) for q in range(lo, hi + 1)]
    return out


def banded_distances(xs: list[str], ys: list[str], k: int) -> np.ndarray:
    """Edit distance of each pair, k + 1 if it is above k; the pairs' columns go through the bit-vector recurrence together.

    Bit 63 of the vectors is row i + k of column i, the bits below are the rows above it.
    """
    out = np.full(len(xs), k + 1, dtype=np.int64)
    cut_x, cut_y, which = [], [], []
    for i, (x, y) in enumerate(zip(xs, ys, strict=True)):
        if abs(len(x) - len(y)) > k:
            continue
        lo, hi = 0, min(len(x), len(y))
        while lo < hi and x[lo] == y[lo]:
            lo += 1
        end = 0
        while end < hi - lo and x[-1 - end] == y[-1 - end]:
            end += 1
        x, y = x[lo:len(x) - end], y[lo:len(y) - end]
        if not x or not y:
            out[i] = min(k + 1, len(x) + len(y))
        else:
            cut_x.append(x)
            cut_y.append(y)
            which.append(i)
    if not which:
        return out
    n, m = np.array([len(x) for x in cut_x]), np.array([len(y) for y in cut_y])
    width = int(m.max())
    # rows are padded by the band on either side with values that match nothing
    rows = np.full((len(which), max(int(n.max()), width) + 3 * k + 2), -1, dtype=np.int64)
    cols = np.full((len(which), width), -2, dtype=np.int64)
    for i, (x, y) in enumerate(zip(cut_x, cut_y, strict=True)):
        rows[i, k:k + len(x)] = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4")
        cols[i, :len(y)] = np.frombuffer(y.encode("utf-32-le", "surrogatepass"), "<u4")
    one = np.uint64(1)
    vp = np.full(len(which), (2**64 - 1) << (63 - k) & (2**64 - 1), dtype=np.uint64)
    vn = np.zeros(len(which), dtype=np.uint64)
    dist = np.full(len(which), k, dtype=np.int64)
    for j in range(width):
        match = np.zeros(len(which), dtype=np.uint64)
        for t in range(2 * k + 1):  # row j - k + t is bit 63 - 2k + t
            match |= (rows[:, j + t] == cols[:, j]).astype(np.uint64) << np.uint64(63 - 2 * k + t)
        d0 = (((match & vp) + vp) ^ vp) | match | vn
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        down = j < n - k  # still on the lowest diagonal; afterwards along the last row
        row = np.where(down, 0, 62 - (j - np.maximum(n - k, 0))).clip(0).astype(np.uint64)
        step = np.where(down, 1 - ((d0 >> np.uint64(63)) & one).astype(np.int64),
                        ((hp >> row) & one).astype(np.int64) - ((hn >> row) & one).astype(np.int64))
        dist += np.where(j < m, step, 0)
        vp = hn | ~((d0 >> one) | hp)
        vn = (d0 >> one) & hp
    # with fewer rows than the band is deep the walk starts inside it
    short = np.flatnonzero(n <= k)
    for i in short:
        dist[i] = _plain(cut_x[i], cut_y[i])
    out[which] = np.minimum(dist, k + 1)
    return out


def _plain(x: str, y: str) -> int:
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tie, line_no, text, line): the non-blank lines; ``line`` is the hash that stands for the text."""
    text = text_or_empty(text_col)
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("tie"), F.posexplode(F.split(text, "\n")).alias("line_no", "text"))
    d = d.withColumn("text", F.trim("text", F.lit(SPACE_CHARS))).where("text <> ''")
    return d.withColumn("line", F.xxhash64("text"))


def _keys(edits: int):
    """Keys of the lines, and whether the line owns them. A task leaves out lines it has just seen, so a frequent one costs a row a task."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        plans: dict[int, tuple[list, list]] = {}
        seen: set[int] = set()
        for batch in batches:
            for at, n in byte_slices(batch.column(1), 1 << 22):
                rows = batch.slice(at, n)
                key, line, times, own = [], [], [], []
                for h, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    if h in seen:
                        continue
                    seen.add(h)
                    plan = plans.get(len(text))
                    if plan is None:
                        at_all = places(len(text), edits)
                        plan = plans[len(text)] = ([((l << 4) + i, q, q + size) for l, i, q, size, _ in at_all], [x[-1] for x in at_all])
                    for seed, lo, hi in plan[0]:
                        key.append(digest(text[lo:hi].encode("utf-8", "surrogatepass"), seed))
                    line.append(h)
                    times.append(len(plan[0]))
                    own += plan[1]
                if len(seen) > SEEN_LINES:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(key, dtype=np.uint64).view(np.int64)),
                    pa.array(np.repeat(np.array(line, dtype=np.int64), np.array(times, dtype=np.int64))),
                    pa.array(own, pa.bool_())], names=["key", "line", "own"])

    return keys


def _deeper(edits: int, level: int):
    """Keys of the next level: a line's rest without the segment of a crowded key is cut anew, within that key."""

    def descend(rest: str, parent: bytes, crowded: set[int], depth: int, out: set[int]) -> None:
        import xxhash

        found = [(lo, hi, xxhash.xxh3_64_intdigest(parent + rest[lo:hi].encode("utf-8", "surrogatepass"), (l << 4) + i))
                 for l, i, lo, size, _ in places(len(rest), edits) for hi in (lo + size,)]
        if len(rest) <= 2 * edits:  # a partner may be too short to be cut
            found.append((0, 0, xxhash.xxh3_64_intdigest(parent, 15)))
        for lo, hi, key in found:
            if depth == level:
                out.add(key)
            elif key in crowded and hi > lo:
                descend(rest[:lo] + rest[hi:], key.to_bytes(8, "little"), crowded, depth + 1, out)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in byte_slices(batch.column(1), 1 << 20):
                rows = batch.slice(at, n)
                key, line, component = [], [], []
                for h, text, crowded, root in zip(*(rows.column(c).to_pylist() for c in range(4)), strict=True):
                    out: set[int] = set()
                    descend(text, b"", {k & (2**64 - 1) for k in crowded}, 0, out)
                    key += out
                    line += [h] * len(out)
                    component += [root] * len(out)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(key, dtype=np.uint64).view(np.int64)), pa.array(line, pa.int64()),
                                                  pa.array(component, pa.int64())], names=["key", "node", "root"])

    return keys


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to (line, text) the parities of the counts of characters and of pairs of neighbours, 64 classes each."""
    mix = np.uint64(0x9E3779B97F4A7C15)

    def parities(x: np.ndarray) -> int:
        odd = np.bincount((x * mix >> np.uint64(58)).astype(np.int64), minlength=64) & 1
        return int(np.packbits(odd.astype(np.uint8)).view(np.int64)[0])

    for batch in batches:
        one, two = [], []
        for text in batch.column(1).to_pylist():
            c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
            one.append(parities(c))
            two.append(parities((c[:-1] << np.uint64(21)) + c[1:]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                                         names=["line", "text", "one", "two"])


def _may_be_near(edits: int) -> Column:
    """What every pair within the threshold meets: an edit turns at most two parities of characters and four of pairs."""
    return ((F.bit_count(F.col("one_a").bitwiseXOR(F.col("one_b"))) <= 2 * edits)
            & (F.bit_count(F.col("two_a").bitwiseXOR(F.col("two_b"))) <= 4 * edits))


def _side(texts: DataFrame, side: str) -> DataFrame:
    return texts.select(F.col("line").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("text", "one", "two")])


def _texts(lines: DataFrame, asked: DataFrame) -> DataFrame:
    """(line, text, one, two) of the lines in question."""
    asked = checkpointed(asked)
    n = asked.count()
    texts = lines.join(F.broadcast(asked) if n <= BROADCAST_ROWS else asked, F.col("line") == F.col("asked"), "left_semi")
    return checkpointed(texts.groupBy("line").agg(F.max("text").alias("text")).mapInArrow(
        _signed, "line bigint, text string, one bigint, two bigint"))


def _verified(texts: DataFrame, pairs: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) of lines within the threshold."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                rows = batch.slice(at, 2048)
                good = banded_distances(rows.column(2).to_pylist(), rows.column(3).to_pylist(), edits) <= edits
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1)], names=["a", "b"]).filter(pa.array(good))

    pairs = pairs.join(_side(texts, "a"), "a").join(_side(texts, "b"), "b").where(_may_be_near(edits))
    return checkpointed(pairs.select("a", "b", "text_a", "text_b").mapInArrow(near, "a bigint, b bigint"))


def _listed(member: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Pairs (a > b) of a key's members (key, node, root) of different components that may be near."""
    member = member.join(texts.select(F.col("line").alias("node"), "one", "two"), "node")
    x, y = (member.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "root", "one", "two")]) for side in ("a", "b"))
    pairs = x.join(y, (x["key"] == y["key"]) & (F.col("node_a") > F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & _may_be_near(edits))
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def linked(lines: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(node, root): the components of the edit join, of the lines that are linked with others."""
    lines = lines.where(F.length("text") >= max(min_chars, edits + 1)).select("line", "text")
    # a key matters if some line owns it and another one shows it; the smallest owner is its hub
    keys = lines.mapInArrow(_keys(edits), "key bigint, line bigint, own boolean")
    keys = keys.withColumn("b", F.min(F.when(F.col("own"), F.col("line"))).over(Window.partitionBy("key")))
    shown = checkpointed(keys.where("line <> b").select("key", F.col("line").alias("a"), "b").distinct())
    tried = shown.select("a", "b").distinct()
    texts = _texts(lines, shown.select(F.col("a").alias("asked")).union(shown.select("b")).distinct())
    roots = checkpointed(components(_verified(texts, tried, edits)))
    member = shown.select("key", F.col("a").alias("node")).unionByName(shown.select("key", F.col("b").alias("node")).distinct())
    member, crowded = _rooted(member, roots), None
    for level in range(LEVELS + 1):
        member = _mixed(member)
        if level:
            met = member.where((F.col("n") > FEW) & (F.col("root") != F.col("hub.root")))
            met = _verified(texts, met.select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct(), edits)
            if not met.isEmpty():
                roots = _joined(roots, met)
                member = _mixed(_rooted(member, roots))
        few = member.where(F.col("n") <= FEW) if level < LEVELS else member
        roots = _joined(roots, _verified(texts, _listed(few, texts, edits), edits))
        many = member.where(F.col("n") > FEW).select("node", "key")
        if level == LEVELS or many.isEmpty():
            break
        crowded = many if crowded is None else crowded.unionByName(many)
        held = many.select("node").distinct().join(crowded, "node").groupBy("node").agg(F.collect_set("key").alias("crowded"))
        held = held.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        member = texts.join(held, F.col("line") == F.col("node")).select("node", "text", "crowded", "root").mapInArrow(
            _deeper(edits, level + 1), "key bigint, node bigint, root bigint")
    return roots


def _rooted(member: DataFrame, roots: DataFrame) -> DataFrame:
    return member.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))


def _mixed(member: DataFrame) -> DataFrame:
    """(key, node, root, n, hub) of the keys whose members are of different components; the smallest member is the hub."""
    member = checkpointed(member)
    keys = member.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"),
                                     F.min(F.struct("node", "root")).alias("hub"))
    return checkpointed(member.join(keys.where("lo <> hi").select("key", "n", "hub"), "key"))


def _joined(roots: DataFrame, edges: DataFrame) -> DataFrame:
    return roots if edges.isEmpty() else checkpointed(grown(roots, edges))


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, tie, line_no, class_id, class_lines, kept) of every non-blank line."""
    lines = lines_of(docs, id_col, text_col)
    at = checkpointed(lines.select("doc_id", "tie", "line_no", "line"))
    roots = linked(lines, edits, min_chars).select(F.col("node").alias("line"), "root")
    at = at.join(roots, "line", "left").select("doc_id", "tie", "line_no", F.coalesce("root", "line").alias("class_id"))
    first = at.groupBy("class_id").agg(F.min(F.struct("doc_id", "tie", "line_no")).alias("first"), F.count(F.lit(1)).alias("class_lines"))
    return at.join(first, "class_id").select(
        "doc_id", "tie", "line_no", "class_id", "class_lines",
        F.struct("doc_id", "tie", "line_no").eqNullSafe(F.col("first")).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without the lines that go; a document whose lines all go goes with them."""
    classes = line_classes(docs, id_col, text_col, edits, min_chars)
    gone = classes.where("not kept").groupBy(F.col("doc_id").alias("id"), "tie").agg(F.collect_set("line_no").alias("gone"))
    text = text_or_empty(text_col)
    d = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("own_tie"))
    d = d.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own_tie") == F.col("tie")), "left")
    # lookup by place: gone lines as a mask, so long documents stay linear
    n = F.size(F.split("text", "\n"))
    ordered = F.sort_array("gone")
    pieces = F.flatten(F.transform(F.sequence(F.lit(0), F.size(ordered)), lambda i: F.slice(
        F.split("text", "\n"),
        F.when(i == 0, 1).otherwise(F.get(ordered, i - 1) + 2),
        F.when(i == F.size(ordered), n).otherwise(F.get(ordered, i)) - F.when(i == 0, 0).otherwise(F.get(ordered, i - 1) + 1))))
    d = d.withColumn("left", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(pieces, "\n")))
    d = d.where(F.col("gone").isNull() | F.col("left").rlike(f"[^{SPACE}]"))
    return d.select(*[(F.when(F.col("gone").isNull(), F.col("row")[c]).otherwise(F.col("left")) if c == text_col else F.col("row")[c]).alias(c)
                      for c in docs.columns])
