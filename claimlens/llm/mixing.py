"""Mixing sources to target weights by min-cost flow (operator 3).

Documents are counted by membership pattern (the set of sources that a document
belongs to).  The pattern counts are the supplies of a flow network: pattern ->
source -> sink, where a source takes its target and a pattern gives its words up
to ``MAX_REPEATS`` times, the r-th time at cost 2r - 1.  These costs are convex, so all
words are used once before any is used twice.  The flow gives each pattern its
number of whole passes and the words of a last, partial one; for that one
documents are chosen in a seeded order until the next would not fit, then the
``TOP_UPS`` largest documents that still fit.  What is left is filled from the
untaken documents that fit it, in the seeded order until the next would not,
again and again until none fits: a very long document at the cut costs nothing.

Only pattern counts reach the driver: a row per distinct pattern, the size of
the mixture's plan.  Prefix sums run in two levels (ranges of the seeded order,
then rows of the one range where the cut falls), so a source with a third of all
rows is never sorted by one task.

Defined results: null texts have size 0 and are never taken; a null source is a
source of its own, after all others; rows that repeat id and text are one
document; empty input gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimlens.llm.common import cut, identity

MAX_REPEATS, SEED, TOP_UPS = 2, "mix-1", 3
WEIGHTS = (3, 1, 2)
SHARE = 1.5
#: Documents of one range of the seeded order.
DOCS_PER_RANGE = 1000
#: Untaken documents that the rest of the partial pass has room for.
FITS = "extra = 0 and size > 0 and size <= gap"
WORD = r"[^\x20\x09-\x0D]+"


def reshared_targets(sizes: dict, weights: dict, total: float, cap: float = MAX_REPEATS) -> dict:
    """``total`` by weight; what exceeds cap * size goes to the others by
    weight, until none is above."""
    capped: set = set()
    while True:
        open_ = [s for s in sizes if s not in capped]
        rate = (total - sum(cap * sizes[s] for s in capped)) / sum(weights[s] for s in open_) if open_ else 0.0
        above = [s for s in open_ if weights[s] * rate > cap * sizes[s]]
        if not above:
            return {s: float(cap * sizes[s]) if s in capped else weights[s] * rate for s in sizes}
        capped.update(above)


def min_cost_flow(supply: dict, targets: dict, repeats: int = MAX_REPEATS) -> dict:
    """Words to take of each pattern (a tuple of sources): a flow of least cost
    among those that bring the sources as near to their targets as possible.

    Augments along cheapest paths (Bellman-Ford queue), so the flow is cheapest at
    every value; sizes of the network: patterns and sources."""
    arcs: list[list] = []           # [to, capacity, cost]; an arc's reverse is its index ^ 1
    out = defaultdict(list)

    def arc(a, b, capacity: int, cost: int) -> None:
        for x, y, c, k in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out[x].append(len(arcs))
            arcs.append([y, c, k])

    start, end = ("start",), ("end",)
    passes = {p: [] for p in supply}
    for p, words in supply.items():
        for r in range(1, repeats + 1):
            passes[p].append(len(arcs))
            arc(start, ("pattern", p), words, 2 * r - 1)
        for s in p:
            arc(("pattern", p), ("source", s), repeats * words, 0)
    for s, words in targets.items():
        arc(("source", s), end, round(words), 0)
    while True:
        cost, by, queue = {start: 0}, {}, [start]
        for node in queue:
            for i in out[node]:
                to, capacity, k = arcs[i]
                if capacity > 0 and cost[node] + k < cost.get(to, math.inf):
                    cost[to], by[to] = cost[node] + k, i
                    queue.append(to)
        if end not in by:
            return {p: sum(arcs[i ^ 1][1] for i in ids) for p, ids in passes.items()}
        path, node = [], end
        while node != start:
            path.append(by[node])
            node = arcs[by[node] ^ 1][0]
        most = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= most
            arcs[i ^ 1][1] += most


def seeded_order(seed: str = SEED) -> Column:
    """60 bits of a digest of seed and id, as a long: the seeded order."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 15), 16, 10).cast("long")


def sized(df: DataFrame, source_col: str = "source", seed: str = SEED) -> DataFrame:
    """(doc_id, key, part, pattern, size, seeded) of each document; pattern is
    an array of sources, from a source or an array of them."""
    sources = F.col(source_col)
    if dict(df.dtypes)[source_col].startswith("array"):
        sources = F.coalesce(F.array_sort(F.array_distinct(sources)), F.array(F.lit(None).cast("string")))
    else:
        sources = F.array(sources.cast("string"))
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(sources.alias("sources")).alias("pattern"),
                     F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), identity(F.col("doc_id").cast("long"), text).alias("part"))
    docs = docs.groupBy("doc_id", "part").agg(F.min("pattern").alias("pattern"), F.max("size").alias("size")) if _repeats(docs) else docs
    return docs.select("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("key"), "part", F.col("pattern.sources").alias("pattern"),
                       "size", seeded_order(seed).alias("seeded"))


def _repeats(docs: DataFrame) -> bool:
    return bool(docs.groupBy("doc_id", "part").count().where("count > 1").limit(1).count())


def contract_targets(sizes: dict) -> dict:
    """The weights 3, 1, 2, repeating, over the sources by code point (null
    last) share SHARE times all words."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    return reshared_targets(sizes, weights, SHARE * sum(sizes.values()))


def _gaps(docs: DataFrame) -> DataFrame:
    """(name, gap): the words of each pattern's partial pass not yet taken."""
    return docs.groupBy("name").agg((F.max("rest") - F.sum(F.col("size") * F.col("extra"))).alias("gap"))


def _taken_in_order(docs: DataFrame, room: Column, words: Column, bits: int) -> DataFrame:
    """``docs`` with extra = 1 also for those with ``words``, in the seeded
    order, until the next would not fit the pattern's ``room``.  The cut is found
    in two levels: a range for each pattern, then a row in it."""
    docs = docs.withColumn("room", room).withColumn("words", words).withColumn("range", F.shiftright("seeded", 60 - bits))
    ranges = docs.groupBy("name", "room", "range").agg(F.sum("words").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = ranges.withColumn("before", before).where((F.col("before") <= F.col("room")) & (F.col("before") + F.col("sum") > F.col("room")))
    docs = docs.join(F.broadcast(cuts.select("name", F.col("range").alias("cut_range"), "before")), "name", "left")
    inner = docs.where("range = cut_range")
    upto = F.sum("words").over(Window.partitionBy("name").orderBy("seeded", "key", "part").rowsBetween(Window.unboundedPreceding, 0))
    inner = inner.withColumn("fits", F.col("before") + upto <= F.col("room"))
    outer = docs.where("cut_range is null or range <> cut_range").withColumn("fits", F.coalesce(F.col("range") < F.col("cut_range"), F.lit(True)))
    docs = inner.unionByName(outer).withColumn("extra", F.greatest("extra", (F.col("fits") & (F.col("words") > 0)).cast("int")))
    return cut(docs.drop("before", "cut_range", "range", "room", "words", "fits"))


def mixed(df: DataFrame, targets_of=contract_targets, source_col: str = "source", seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size and target (sums over
    its sources), taken (words the mix takes, repeats counted), repeats, key,
    part.  ``targets_of`` maps {source: words} to {source: target words}."""
    spark = df.sparkSession
    docs = cut(sized(df, source_col, seed))
    supply = {tuple(r["pattern"]): (r["words"], r["docs"]) for r in docs.groupBy("pattern").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")).collect()}
    sizes: dict = defaultdict(int)
    for p, (words, _) in supply.items():
        for s in p:
            sizes[s] += words
    targets = targets_of(dict(sizes)) if sizes else {}
    taken = min_cost_flow({p: words for p, (words, _) in supply.items()}, targets)
    plan = [(list(p), float(sum(targets[s] for s in p)), sum(sizes[s] for s in p), taken[p] // words if words else 0, taken[p] % words if words else 0)
            for p, (words, _) in supply.items()]
    plan = spark.createDataFrame(plan, "pattern array<string>, target double, source_size long, passes long, rest long")
    # A number for each pattern keeps arrays with nulls out of the join keys.
    plan = plan.withColumn("name", F.to_json(F.struct("pattern"), {"ignoreNullFields": "false"})).drop("pattern")
    docs = docs.withColumn("name", F.to_json(F.struct("pattern"), {"ignoreNullFields": "false"})).drop("pattern")
    docs = docs.join(F.broadcast(plan), "name")

    bits = min(40, max(0, math.ceil(math.log2(max(1, max((n for _, n in supply.values()), default=1) / DOCS_PER_RANGE)))))
    docs = _taken_in_order(docs.withColumn("extra", F.lit(0)), F.col("rest"), F.col("size"), bits)
    for _ in range(TOP_UPS):
        fits = docs.join(F.broadcast(_gaps(docs)), "name").where(FITS)
        best = fits.groupBy("name").agg(F.max(F.struct("size", -F.col("seeded"), -F.col("key"), "part", "key")).alias("best"))
        best = best.select("name", F.col("best.key").alias("key"), F.col("best.part").alias("part"), F.lit(1).alias("fill"))
        docs = docs.join(F.broadcast(best), ["name", "key", "part"], "left").withColumn("extra", F.greatest("extra", F.coalesce("fill", F.lit(0)))).drop("fill")
        docs = cut(docs)
    # what the top-ups leave: the seeded order of those that fit, again and again
    while not (open_ := docs.join(F.broadcast(_gaps(docs)), "name")).where(FITS).isEmpty():
        docs = _taken_in_order(open_, F.col("gap"), F.when(F.expr(FITS), F.col("size")).otherwise(0), bits).drop("gap")
    repeats = F.when(F.col("size") > 0, F.col("passes") + F.col("extra")).otherwise(0)
    return docs.select("doc_id", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), repeats.cast("int").alias("repeats"), "key", "part")
