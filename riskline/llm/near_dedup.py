"""MinHash near-dedup: banded minima, confirmation on full sets, alternating stars.

A document's set holds its distinct five-word shingles (64-bit hashes; ``A-Z`` lower-cased;
fewer words: the whole sequence as one). Documents with equal sets are one node from the
start, so thousands of copies cost one node. Each node has 128 minima of universal hashes
(multiply, add, take the top half) in 32 bands of 4: two sets with a Jaccard similarity of
0.75 miss each other in all bands with a probability of 5e-6.

Links are found without making all pairs of a band bucket:

1. Every member of a bucket meets the bucket's smallest set (its hub), if their sketches let
   it be a link; the pair is confirmed on the full sets, and the components of those links are
   taken. Sketches are the sizes, 1024 parities (how many shingles fall into each of 1024
   slots, modulo 2: two sets differ in no more slots than in shingles, and linked ones differ in
   a seventh of the sum of their sizes at most, so no link is lost) and the four low bits of all
   minima (they keep a link but for odds below 1e-6).
2. Only pairs of a key (bucket) whose components still differ can matter. First every member
   meets ``MEET`` nodes of the component that its key has most of, picked by a hash, as it met
   the hub: what hangs together is mostly one component after that, at so many pairs a member.
3. Then, in a key of up to ``FEW`` nodes, the pairs left are listed, each once a key. A larger key gets a pivot p, the smallest set of the
   component it has most of. If |a|, |b| >= |p| and J(a, b) >= 0.75, then both are linked to p
   or they share a shingle that p does not have: without one, with i and x shingles of p
   missing in and added to a, j and y in and to b, the link says
   |p| - j >= 0.75 (|p| + y) + 0.75 x - 0.75 i, and x >= i since a is not smaller than p. So
   these nodes are confirmed against p, and the shingles they have beyond p make the keys of
   the next round. With these ordered before p's, rarest first, the first shingle that a and b
   share is among the first |a| / 4 + 1 of either, so only those are keys, if nodes of different
   components show them; a crowded one in two size classes of ratio 4/3 (linked sets differ by
   no more). Nodes smaller than p meet the key's other components one by one. After ``ROUNDS`` such rounds what is left is listed.

Components: large-star and small-star in turn until nothing changes. Full sets are built
again for the documents in question only and never stored.

Defined results: null or wordless texts have the empty set and are linked with nothing;
repeated rows and ids are one node if their sets agree; a null id counts as no id when the
smallest is taken; other columns are not read; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import byte_slices, checkpointed, text_or_empty
from .links import components, grown

WIDTH = 5
THRESHOLD = 75  # hundredths
BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
PLANES = 4  # low bits of each minimum kept for the estimate
#: Five standard deviations below what a similarity of 0.75 shows in the estimate.
LEAST_EQUAL = int(MINIMA * (0.75 + 0.25 / 2**PLANES) - 5 * (MINIMA * 0.7656 * 0.2344) ** 0.5)
SLOTS = 1024  # parities of a set
#: So many nodes of its key's largest component every node meets before pairs are listed.
MEET = 8
#: Pairs of different components are listed in keys of so many nodes at most.
FEW = 2048
#: Shingles beyond a pivot that so many nodes have are split by size.
CROWDED = 12
ROUNDS = 2
CACHE_WORDS = 100_000
#: So many rows (ids and lists of partners) go to every worker at most; beyond, texts are shuffled to them.
BROADCAST_ROWS = 500_000
_WORDS: dict[bytes, int] = {}

_rng = np.random.default_rng(20240521)
_A = _rng.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, MINIMA, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    if len(_WORDS) > CACHE_WORDS:
        _WORDS.clear()
    known = _WORDS
    out = []
    for t in texts:
        ws = t.encode("utf-8", "surrogatepass").lower().split()
        for w in set(ws).difference(known):
            known[w] = digest(w)
        h = np.fromiter(map(known.__getitem__, ws), dtype=np.uint64, count=len(ws))
        if not len(ws):
            out.append(h)
            continue
        n = min(width, len(ws))
        s = np.full(len(ws) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            s = _mixed(s * _P + h[k:len(ws) - n + 1 + k])
        out.append(np.unique(s))
    return out


def minima(s: np.ndarray) -> np.ndarray:
    """Smallest value of each universal hash over the set (32 bits each)."""
    best = np.full(MINIMA, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(s), 1024):
        best = np.minimum(best, (np.multiply.outer(s[at:at + 1024], _A) + _B).min(axis=0))
    return best >> np.uint64(32)


def _bands(m: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = _mixed(key * _P + m[k::ROWS])
    return key.view(np.int64)


def _planes(m: np.ndarray) -> np.ndarray:
    bits = [np.packbits(((m >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)).view(np.int64) for k in range(PLANES)]
    return np.concatenate(bits)


def _odd(s: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each slot."""
    held = np.bincount((s % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
    return np.packbits((held & 1).astype(np.uint8)).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        for at, n in byte_slices(batch.column(1), 1 << 20):
            rows = batch.slice(at, n)
            sets = shingle_sets(rows.column(1).to_pylist())
            sigs = [minima(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([None if m is None else _bands(m) for m in sigs], pa.list_(pa.int64())),
                pa.array([None if m is None else _planes(m) for m in sigs], pa.list_(pa.int64())),
                pa.array([_odd(s) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "same", "bands", "planes", "odd"])


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _equal(x: str, y: str) -> Column:
    """Number of minima whose low bits agree, from two columns of planes."""
    words = MINIMA // 64
    equal = F.lit(0)
    for w in range(words):
        same = F.lit(-1).cast("long")
        for k in range(PLANES):
            i = k * words + w
            same = same.bitwiseAND(F.bitwise_not(F.col(x)[i].bitwiseXOR(F.col(y)[i])))
        equal = equal + F.bit_count(same)
    return equal


SKETCH = ("n_shingles", "odd", "planes")


def _may_link(x: str, y: str) -> Column:
    """Whether two nodes may be linked, from their sketches (columns with these endings)."""
    n, m = F.col(f"n_shingles{x}"), F.col(f"n_shingles{y}")
    apart = F.lit(0)
    for w in range(SLOTS // 64):
        apart = apart + F.bit_count(F.col(f"odd{x}")[w].bitwiseXOR(F.col(f"odd{y}")[w]))
    return ((100 * F.least(n, m) >= THRESHOLD * F.greatest(n, m)) & ((100 + THRESHOLD) * apart <= (100 - THRESHOLD) * (n + m))
            & (_equal(f"planes{x}", f"planes{y}") >= LEAST_EQUAL))


def _side(members: DataFrame, side: str) -> DataFrame:
    return members.select(F.col("key").alias(f"key_{side}"), F.col("node").alias(side), F.col("root").alias(f"root_{side}"),
                          *[F.col(c).alias(f"{c}_{side}") for c in SKETCH])


def _pairs(left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """Pairs (a > b) of a key's members of different components that may be links, by their sketches; without
    ``right`` those among ``left``, which come once a key."""
    x, y = _side(left, "a"), _side(left if right is None else right, "b")
    wanted = (F.col("root_a") != F.col("root_b")) if right is not None else (F.col("root_a") != F.col("root_b")) & (F.col("a") > F.col("b"))
    may = x.join(y, (F.col("key_a") == F.col("key_b")) & wanted & _may_link("_a", "_b"))
    return may.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _open_members(keys: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, node, root, n, sketches) of the keys whose n nodes are of different components."""
    member = keys.select("key", "node").join(roots, "node", "left")
    member = checkpointed(member.select("key", "node", F.coalesce("root", "node").alias("root")))
    mixed = member.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    member = member.join(mixed.where("lo <> hi").select("key", "n"), "key")
    return checkpointed(member.join(nodes.select("node", *SKETCH), "node"))


def _met(member: DataFrame) -> DataFrame:
    """Pairs of a key's nodes with ``MEET`` of the component it has most of."""
    most = member.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "root"))["root"].alias("root"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("key", "node"), "node"))
    chosen = member.join(most, ["key", "root"]).withColumn("place", place).where(F.col("place") <= MEET)
    return _pairs(member, chosen)


def _compared(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, added: bool = False) -> DataFrame:
    """(a, b, linked, beyond) of the pairs on their full sets; beyond: the shingles of a that b lacks, if asked for."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for at, n in byte_slices(batch.column(3), 1 << 20):
                rows = batch.slice(at, n)
                sets = shingle_sets(rows.column(3).to_pylist())
                right = [xxhash.xxh3_128_digest(s.tobytes()) == x for s, x in zip(sets, rows.column(1).to_pylist(), strict=True)]
                out = pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["node", "partners", "held"])
                yield out.filter(pa.array(right, pa.bool_()))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, beyond = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                place = np.searchsorted(y, x)
                shared = (place < len(y)) & (y[np.minimum(place, len(y) - 1)] == x)
                both = int(shared.sum())
                linked.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
                beyond.append(x[~shared].view(np.int64) if added else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_()),
                                              pa.array(beyond, pa.list_(pa.int64()))], names=["a", "b", "linked", "beyond"])

    def full(wanted: DataFrame) -> DataFrame:
        n = wanted.count()
        wanted = wanted.join(nodes.select("node", F.col("doc_id").alias("id"), "same"), "node")
        chosen = docs.join(_small(wanted, n), F.col("doc_id").eqNullSafe(F.col("id")))
        return chosen.select("node", "same", "partners", "text").mapInArrow(
            sets_of, "node bigint, partners array<bigint>, held binary")

    lists = checkpointed(pairs.groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("partners")))
    left = full(lists).select(F.col("node").alias("a"), F.explode("partners").alias("b"), F.col("held").alias("held_a"))
    right = full(checkpointed(pairs.select(F.col("b").alias("node")).distinct()).withColumn("partners", F.array().cast("array<bigint>")))
    right = right.select(F.col("node").alias("b"), F.col("held").alias("held_b"))
    return checkpointed(left.join(right, "b").select("a", "b", "held_a", "held_b").mapInArrow(
        compared, "a bigint, b bigint, linked boolean, beyond array<bigint>"))


def _linked(compared: DataFrame) -> DataFrame:
    return compared.where("linked").select("a", "b").distinct()


def _roots(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root) of the linked nodes: the components of all links that the bands show."""
    buckets = nodes.select("node", "n_shingles", F.explode("bands").alias("key"))
    hubs = buckets.groupBy("key").agg(F.min(F.struct("n_shingles", "node"))["node"].alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = checkpointed(buckets.join(hubs, "key").select("key", "node", "hub"))  # buckets of two or more
    tried = keys.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).where("a <> b").distinct()
    for side in ("a", "b"):
        tried = tried.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in SKETCH]), side)
    tried = checkpointed(tried.where(_may_link("_a", "_b")).select("a", "b"))
    roots = components(_linked(_compared(docs, nodes, tried)))
    pairs = checkpointed(_met(_open_members(keys, roots, nodes)).join(tried, ["a", "b"], "left_anti"))
    roots = grown(roots, _linked(_compared(docs, nodes, pairs)))
    tried = tried.unionByName(pairs)
    for left in range(ROUNDS, -1, -1):
        member = _open_members(keys, roots, nodes)
        few = member.where(F.col("n") <= FEW) if left else member
        many = member.where(F.col("n") > FEW) if left else member.where("false")
        # each component's smallest set stands for it; a key takes the one it has most of
        pivots = many.groupBy("root").agg(F.min(F.struct("n_shingles", "node")).alias("p"))
        pivots = (many.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).join(pivots, "root")
                  .groupBy("key").agg(F.max(F.struct("n", (-F.col("p.n_shingles")).alias("less"), F.col("p.node").alias("pivot"))).alias("p"))
                  .select("key", F.col("p.pivot").alias("pivot"), (-F.col("p.less")).alias("least")))
        many = checkpointed(many.join(pivots, "key"))
        pairs = _pairs(few).unionByName(_pairs(many.where(F.col("n_shingles") < F.col("least")), many)).distinct()
        pairs = checkpointed(pairs.join(tried, ["a", "b"], "left_anti"))
        edges = _linked(_compared(docs, nodes, pairs))
        tried = tried.unionByName(pairs)
        against = many.where((F.col("n_shingles") >= F.col("least")) & (F.col("node") != F.col("pivot"))).select(
            F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
        against = checkpointed(against)
        if against.isEmpty():
            return grown(roots, edges)
        compared = _compared(docs, nodes, against, added=True)
        roots = grown(roots, edges.unionByName(_linked(compared)))
        keys = checkpointed(_beyond_keys(compared, nodes, roots))
    return roots


def _beyond_keys(compared: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node): for each node its rarest shingles beyond the pivot, as far as a link must share one.

    Pivots and shingles that only nodes of one component have can show no new link.
    """
    once = compared.dropDuplicates(["a", "b"])  # repeated rows are compared each; their shingles must not count twice
    once = once.select(F.col("a").alias("node"), "b", "beyond").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_pivots = once.groupBy("b").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("b")
    rows = once.join(open_pivots, "b").select("node", "b", "root", F.explode("beyond").alias("shingle"))
    seen = rows.groupBy("b", "shingle").agg(F.count(F.lit(1)).alias("seen"), (F.min("root") != F.max("root")).alias("mixed"))
    rows = rows.join(seen, ["b", "shingle"]).join(nodes.select("node", "n_shingles"), "node")
    place = F.row_number().over(Window.partitionBy("node", "b").orderBy("seen", "shingle"))
    rows = rows.withColumn("place", place).where(
        (F.col("place") <= F.floor((100 - THRESHOLD) * F.col("n_shingles") / 100) + 1) & F.col("mixed"))
    size = F.floor(F.log(F.col("n_shingles") * 1.000001) / F.log(F.lit(100 / THRESHOLD)))
    sizes = F.when(F.col("seen") > CROWDED, F.array(size, size + 1)).otherwise(F.array(F.lit(-1).cast("long")))
    return rows.select("node", F.explode(sizes).alias("size"), "b", "shingle").select(
        F.xxhash64("b", "shingle", "size").alias("key"), "node").distinct()


def _decided(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id, kept) per row; ``tie`` is a hash of the text."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.struct("doc_id", F.xxhash64("text").alias("tie")).alias("row"), "text").mapInArrow(
        _sketches, f"row struct<doc_id:{id_type},tie:bigint>, n_shingles bigint, same binary, bands array<bigint>, planes array<bigint>, odd array<bigint>")
    rows = checkpointed(rows.select("row.*", "n_shingles", "same", "bands", "planes", "odd"))
    nodes = checkpointed(rows.where("n_shingles > 0").groupBy("same").agg(
        F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("planes").alias("planes"), F.first("odd").alias("odd")).withColumn("node", F.monotonically_increasing_id()))
    roots = nodes.select("same", "doc_id", "node").join(_roots(docs, nodes), "node", "left").select(
        "same", "doc_id", F.coalesce("root", "node").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("doc_id").alias("smallest"))
    classes = roots.join(smallest, "root").select("same", "smallest")
    out = rows.select("doc_id", "tie", "n_shingles", "same").join(classes, "same", "left")
    # a set of nothing is in no class
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("smallest")))
    return out.select("doc_id", "tie", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``; component_id is the smallest id reachable."""
    return _decided(docs, id_col, text_col).drop("tie")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, in the input's columns: of each component the one with the smallest id.

    Rows with equal id and text are one document and stay once.
    """
    decided = checkpointed(_decided(docs, id_col, text_col).select(F.col("doc_id").alias("id"), "tie", "kept"))
    gone = decided.where("not kept").select("id", "tie").distinct()
    twice = decided.where("kept").groupBy("id", "tie").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("id", "tie")
    d = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("own_tie"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own_tie") == F.col("tie"))
    stay = d.join(_small(gone, gone.count()), same, "left_anti")
    n = twice.count()
    if not n:
        return stay.select("row.*")
    once = stay.join(_small(twice, n), same, "left_semi").dropDuplicates(["doc_id", "own_tie"])
    return stay.join(_small(twice, n), same, "left_anti").unionByName(once).select("row.*")
