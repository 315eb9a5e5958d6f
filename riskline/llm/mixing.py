"""Mixing sources to target weights by a min-cost flow.

A document may belong to several sources; its sorted set of sources is its membership
pattern. The size of a document is its number of words. Documents are aggregated by pattern;
what reaches the driver is one row per pattern (``MAX_PATTERNS`` at most, more is an error,
not a cut). The flow sends words from patterns to the sources' quotas. The first copy of a
pattern's words costs 1 a word, the second 3, the k-th 2k - 1, up to ``max_repeats``: this
convex cost spreads the repeats, and no document is taken more often than that.

A pattern that must give T words gives all its documents floor(T / size) times and some of
them once more: those first in a seeded hash order, as long as they fit. The rest, smaller
than one document, is closed by the documents whose size comes nearest to it (``FILLS``
times). The place where the order is cut is found from sums over hash ranges and one range
per pattern, so no task and no window holds a whole pattern. A document's decision then
follows from its own hash and a table of one row per pattern, without a shuffle of texts.

Defined results: null text has size 0 and is never taken; a null source is a source of its
own, last in order; a document without sources is never taken; repeated rows with equal id
and text share one decision; an empty table gives no rows. Input columns are kept, those
named like a result are replaced.
"""
from __future__ import annotations

import heapq
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.window import Window

from .common import checkpointed, text_or_empty, words

MAX_PATTERNS = 100_000
RANGE_ROWS = 20_000
FILLS = 3
SEED = 7
WEIGHTS = (5, 2, 1)
SHARE = 1.5
RESULTS = ("size", "source_size", "target", "taken", "routed")


def targets(sizes: dict[str | None, int], total: float, weights: tuple[int, ...] = WEIGHTS,
            most: float = 2.0) -> dict[str | None, float]:
    """Share ``total`` by weight, sources in code point order (null last); none above ``most`` times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, open_ = total, list(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > most * sizes[s]]
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        if not full:
            out |= {s: weight[s] * unit for s in open_}
            break
        open_ = [s for s in open_ if s not in out]
    return out


def min_cost_flow(supply: list[int], routes: list[list[int]], quota: list[int], max_repeats: int = 2) -> list[dict[int, int]]:
    """Words from pattern i to source j, as many as the quotas take, at the least cost.

    Successive cheapest paths with potentials; the k-th copy of pattern i is an arc of
    ``supply[i]`` words at cost 2k - 1.
    """
    n, m = len(supply), len(quota)
    start, end = n + m, n + m + 1
    arcs: list[list[int]] = []  # to, room, cost; the arc back is the neighbour by the lowest bit
    at: list[list[int]] = [[] for _ in range(n + m + 2)]

    def add(u: int, v: int, room: int, cost: int) -> int:
        at[u].append(len(arcs))
        arcs.append([v, room, cost])
        at[v].append(len(arcs))
        arcs.append([u, 0, -cost])
        return len(arcs) - 2

    for i, s in enumerate(supply):
        for k in range(1, max_repeats + 1):
            add(start, i, s, 2 * k - 1)
    links = [{j: add(i, n + j, max_repeats * supply[i], 0) for j in to} for i, to in enumerate(routes)]
    for j, q in enumerate(quota):
        add(n + j, end, q, 0)
    potential = [0] * (n + m + 2)
    while True:
        dist: list[float] = [math.inf] * (n + m + 2)
        via = [-1] * (n + m + 2)
        dist[start] = 0
        heap: list[tuple[float, int]] = [(0, start)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in at[u]:
                v, room, cost = arcs[e]
                nd = d + cost + potential[u] - potential[v]
                if room and nd < dist[v]:
                    dist[v], via[v] = nd, e
                    heapq.heappush(heap, (nd, v))
        if dist[end] == math.inf:
            break
        for v, d in enumerate(dist):
            potential[v] += int(min(d, dist[end]))
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = arcs[via[v] ^ 1][0]
        step = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= step
            arcs[e ^ 1][1] += step
    return [{j: arcs[e ^ 1][1] for j, e in link.items() if arcs[e ^ 1][1]} for link in links]


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(row, pattern, size, h): all input columns, the membership pattern as JSON, words, seeded hash."""
    source = F.col(f"`{source_col}`")
    if isinstance(docs.schema[source_col].dataType, ArrayType):
        pattern: Column = F.sort_array(F.array_distinct(F.coalesce(source, F.array().cast("array<string>"))))
    else:
        pattern = F.array(source.cast("string"))
    text = text_or_empty(text_col)
    return docs.select(F.struct("*").alias("row"), F.to_json(pattern, {"ignoreNullFields": "false"}).alias("pattern"),
                       F.size(words(text)).cast("long").alias("size"),
                       F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("string"), text).alias("h"))


def _cuts(rows: DataFrame, wanted: dict[str, int]) -> dict[str, tuple[int | None, set[int]]]:
    """For each pattern: hashes up to the cut are taken once more, and so are those of the set."""
    spark = rows.sparkSession
    out: dict[str, tuple[int | None, set[int]]] = {p: (None, set()) for p in wanted}
    if not any(wanted.values()):
        return out
    wants = F.broadcast(spark.createDataFrame([(p, w) for p, w in wanted.items() if w], "pattern string, want long"))
    rows = rows.where("size > 0").join(wants, "pattern")
    bits = max(0, math.ceil(math.log2(max(1, rows.count() / RANGE_ROWS))))
    # order of the signed hash, so that ranges follow each other
    part = F.shiftright("h", 64 - bits) if bits else F.lit(0).cast("long")
    rows = rows.withColumn("part", part)
    sums = rows.groupBy("pattern", "want", "part").agg(F.sum("size").alias("words"))
    after = F.sum("words").over(Window.partitionBy("pattern").orderBy("part"))
    crossed = (sums.withColumn("after", after).where("after > want and after - words <= want")
               .select("pattern", "part", (F.col("want") - (F.col("after") - F.col("words"))).alias("rest")))
    # equal hashes stand or fall together; only the range that is cut is ordered
    edge = rows.join(F.broadcast(crossed), ["pattern", "part"]).groupBy("pattern", "rest", "part", "h").agg(
        F.sum("size").alias("words"))
    edge = edge.withColumn("after", F.sum("words").over(Window.partitionBy("pattern", "part").orderBy("h")))
    first_out = edge.where("after > rest").groupBy("pattern", "rest").agg(
        F.min("h").alias("cut"), F.min(F.col("after") - F.col("words")).alias("given"))
    missing: dict[str, int] = {}
    for p, rest, cut, given in first_out.collect():  # one row per pattern
        out[p] = (cut, set())
        missing[p] = rest - given
    for _ in range(FILLS):
        missing = {p: x for p, x in missing.items() if x > 0}
        if not missing:
            break
        table = F.broadcast(spark.createDataFrame(
            [(p, x, out[p][0], sorted(out[p][1])) for p, x in missing.items()],
            "pattern string, missing long, cut long, chosen array<long>"))
        gap = F.abs(F.col("missing") - F.col("size"))
        near = (rows.join(table, "pattern").where((F.col("h") >= F.col("cut")) & ~F.array_contains("chosen", F.col("h")))
                .groupBy("pattern", "missing", "h").agg(F.sum("size").alias("size"))
                .where(gap < F.col("missing")).groupBy("pattern").agg(F.min(F.struct(gap, "h", "size")).alias("best")))
        found = near.collect()  # one row per pattern
        missing = {p: missing[p] - best["size"] for p, best in found}
        for p, best in found:
            out[p][1].add(best["h"])
    return out


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float,
           max_repeats: int, seed: int) -> DataFrame:
    """(row, RESULTS), ``row`` being all input columns."""
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col, source_col, seed)
    rows = checkpointed(keyed.select("pattern", "size", "h"))
    found = rows.groupBy("pattern").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; give the operator coarser sources")
    patterns = sorted((p, w) for p, w in found)
    members = {p: json.loads(p) for p, _ in patterns}
    sizes: dict[str | None, int] = {}
    for p, w in patterns:
        for s in members[p]:
            sizes[s] = sizes.get(s, 0) + w
    goal = targets(sizes, share * sum(w for _, w in patterns), weights, float(max_repeats)) if sizes else {}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    place = {s: j for j, s in enumerate(names)}
    flow = min_cost_flow([w for _, w in patterns], [[place[s] for s in members[p]] for p, _ in patterns],
                         [round(goal[s]) for s in names], max_repeats)
    given = {p: sum(f.values()) for (p, _), f in zip(patterns, flow, strict=True)}
    times = {p: given[p] // w if w else 0 for p, w in patterns}
    cuts = _cuts(rows, {p: given[p] - times[p] * w for p, w in patterns})
    plan = []
    for (p, _), f in zip(patterns, flow, strict=True):
        first = min(members[p], key=lambda s: (s is None, s or "")) if members[p] else None
        known = bool(members[p])
        plan.append((p, sizes[first] if known else None, float(goal[first]) if known else None, times[p], cuts[p][0],
                     sorted(cuts[p][1]), [(names[j], w) for j, w in f.items()]))
    table = F.broadcast(spark.createDataFrame(
        plan, "pattern string, source_size long, target double, times long, cut long, chosen array<long>, "
              "routed array<struct<source:string,words:long>>"))
    more = F.coalesce((F.col("h") < F.col("cut")) | F.array_contains("chosen", F.col("h")), F.lit(False))
    out = keyed.join(table, "pattern", "left").withColumn("taken", F.col("size") * (F.col("times") + more.cast("long")))
    return out.select("row", *RESULTS)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = 2, seed: int = SEED) -> DataFrame:
    """The documents with size, source_size, target, taken (words, repeats counted) and routed.

    source_col: a string, or an array of strings for overlapping sources; then source_size
    and target are those of the first source in order. routed: (source, words) that the
    document's pattern gives, one element per source the flow feeds from it.
    """
    out = _mixed(docs, id_col, text_col, source_col, weights, share, max_repeats, seed)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in RESULTS], *RESULTS)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = 2, seed: int = SEED) -> DataFrame:
    """The mix itself, in the input's columns: each document as often as it is taken (one without words: never)."""
    out = _mixed(docs, id_col, text_col, source_col, weights, share, max_repeats, seed).where("taken > 0")
    copies = (F.col("taken") / F.col("size")).cast("int")
    return out.select("row", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")
