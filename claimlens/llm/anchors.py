"""Vector code compression by metric trees over parts (operator 13).

A vector's components become the integers floor(``SCALE`` * x) and are cut into
``PARTS`` equal consecutive parts; each part position has a codebook of at most
``ENTRIES`` entries, refined in ``ROUNDS`` rounds of exact integer k-means.

Vectors are gathered into chunks, and each chunk gets a metric tree per part,
grown middle-out: about sqrt(n) anchors are set, each new one at the point
farthest from its anchor, taking over points that the triangle inequality does
not rule out; the points of each anchor are split again in the same way; the
resulting balls are then merged, nearest pair first, up to one root.  A ball
caches the sum and the count of its points.  Trees are built once and written;
the codebooks alone change from round to round.

A round walks each tree from the root.  A ball inherits its parent's list of
candidate entries and strikes out each entry that is farther from all its points
than some other one is.  A ball with one candidate left is wholly owned: its
cached sum and count go to that entry.  Only in leaves are points compared with
what is left of the list, in exact integers, ties to the lower index.  Tasks send
one row per part and entry; the driver holds codebooks only (``PARTS`` *
``ENTRIES`` rows).

Defined results: rows whose vector is null or holds null or non-finite
components are dropped.  The start entries belong to the smallest distinct ids,
a null id last; of several vectors of an id the smallest starts.  A vector whose length
differs from that of the smallest id's (of those not empty), or with a component of ``LARGEST`` or more in
size, cannot be coded in 64 bits: it is returned with null code and error and
takes no part in the codebooks.  Repeated rows yield a row each; null labels are
one label, whose sum is null if none of its rows has a code; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimlens.llm.common import cut, spread_join

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Components below this size have squared distances below 2^63.
LARGEST = 1 << 28
#: Vectors of a tree, and points of a leaf.
CHUNK, LEAF = 4096, 24


class Tree:
    """Balls of one part of a chunk: node i covers ``order[lo[i]:hi[i]]``."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self._at = points.astype(np.float64)
        self._nodes: list[tuple] = []           # (pivot, radius, sums, count, children or points)
        root = self._grow(np.arange(len(points)))
        self._lay_out(root)
        del self._nodes, self._at

    def _leaf(self, idx: np.ndarray) -> int:
        sums, at = self.points[idx].sum(0), self._at[idx]
        pivot = sums / len(idx)
        radius = math.sqrt(((at - pivot) ** 2).sum(1).max())
        self._nodes.append((pivot, radius, sums, len(idx), idx))
        return len(self._nodes) - 1

    def _grow(self, idx: np.ndarray) -> int:
        if len(idx) <= LEAF:
            return self._leaf(idx)
        owner = self._anchors(idx)
        if owner.max() == 0:                    # points that are all equal
            return self._leaf(idx)
        by = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[by])) + 1
        return self._merge([self._grow(idx[group]) for group in np.split(by, cuts)])

    def _anchors(self, idx: np.ndarray) -> np.ndarray:
        """The anchor that owns each point, as a number from 0."""
        at = self._at[idx]
        most = math.isqrt(len(idx) - 1) + 1
        anchors = np.empty((most, at.shape[1]))
        anchors[0] = at[0]
        dist = np.sqrt(((at - anchors[0]) ** 2).sum(1))
        owner = np.zeros(len(idx), np.int64)
        for j in range(1, most):
            far = int(dist.argmax())
            if dist[far] == 0:
                break
            anchors[j] = at[far]
            between = np.sqrt(((anchors[:j] - anchors[j]) ** 2).sum(1))
            # A point nearer to its anchor than half the way to the new one stays.
            open_ = np.flatnonzero(dist > between[owner] / 2)
            new = np.sqrt(((at[open_] - anchors[j]) ** 2).sum(1))
            won = new < dist[open_]
            dist[open_[won]], owner[open_[won]] = new[won], j
        return owner

    def _merge(self, nodes: list[int]) -> int:
        """One ball over the given ones, by joining the pair whose common ball
        is smallest, again and again."""
        pivots = np.array([self._nodes[i][0] for i in nodes])
        radii = np.array([self._nodes[i][1] for i in nodes])
        size = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(2)) + radii[:, None] + radii[None]
        np.fill_diagonal(size, np.inf)
        for _ in range(len(nodes) - 1):
            i, j = divmod(int(size.argmin()), len(nodes))
            (p, r, s, n, _), (q, t, u, m, _) = self._nodes[nodes[i]], self._nodes[nodes[j]]
            pivot = (s + u) / (n + m)
            radius = max(math.sqrt(((pivot - p) ** 2).sum()) + r, math.sqrt(((pivot - q) ** 2).sum()) + t)
            self._nodes.append((pivot, radius, s + u, n + m, (nodes[i], nodes[j])))
            nodes[i], pivots[i], radii[i] = len(self._nodes) - 1, pivot, radius
            size[j], size[:, j], pivots[j] = np.inf, np.inf, np.inf
            with np.errstate(invalid="ignore"):
                row = np.sqrt(((pivots - pivot) ** 2).sum(1)) + radii + radius
            row[i] = np.inf
            size[i] = size[:, i] = np.where(np.isnan(row), np.inf, row)
        return nodes[i] if len(nodes) > 1 else nodes[0]

    def _lay_out(self, root: int) -> None:
        """Arrays by level from the root, children after their parents."""
        order, spans, levels, front = [], {}, [], [(root, -1)]
        place: list[int] = []
        parent: list[int] = []
        while front:
            levels.append(len(place))
            after = []
            for node, above in front:
                at = len(place)
                place.append(node)
                parent.append(above)
                below = self._nodes[node][4]
                if isinstance(below, tuple):
                    after += [(x, at) for x in below]
                else:
                    spans[at] = below
            front = after
        self.levels = [*levels, len(place)]
        self.parent = np.array(parent)
        self.pivot = np.array([self._nodes[i][0] for i in place])
        self.radius = np.array([self._nodes[i][1] for i in place])
        self.sums = np.array([self._nodes[i][2] for i in place])
        self.count = np.array([self._nodes[i][3] for i in place])
        self.leaves = spans
        self.points = self.points.astype(np.int32)

    def walk(self, entries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(node, candidate entries) of each wholly owned ball and each leaf
        that is not: together they cover every point once."""
        k = len(entries)
        at = entries.astype(np.float64)
        norm = (at ** 2).sum(1)
        closed = np.zeros(len(self.parent), bool)
        lists = np.ones((0, k), bool)
        for level, (start, end) in enumerate(zip(self.levels, self.levels[1:])):
            pivot, radius = self.pivot[start:end], self.radius[start:end, None]
            own = (pivot ** 2).sum(1)[:, None]
            squares = own + norm - 2 * pivot @ at.T
            # Rounding of the squares moves a distance by far less than this.
            slack = 1e-6 * (1 + np.sqrt(own.max() + norm.max()))
            dist = np.sqrt(np.maximum(squares, 0))
            if level:
                above = self.parent[start:end] - self.levels[level - 1]
                mask, closed[start:end] = lists[above], closed[self.parent[start:end]]
            else:
                mask = np.ones((1, k), bool)
            nearest = np.where(mask, dist, np.inf).min(1, keepdims=True) + radius
            mask &= dist - radius <= nearest + slack
            for i in np.flatnonzero(~closed[start:end]):
                left = np.flatnonzero(mask[i])
                if len(left) == 1 or start + i in self.leaves:
                    closed[start + i] = True
                    yield start + i, left
            lists = mask

    def below(self, node: int) -> np.ndarray:
        """Points of a ball."""
        if node in self.leaves:
            return self.leaves[node]
        return np.concatenate([self.below(int(x)) for x in np.flatnonzero(self.parent == node)])

    def nearest(self, idx: np.ndarray, entries: np.ndarray, left: np.ndarray) -> np.ndarray:
        """For each point the nearest of the entries ``left``, ties to the lower."""
        points, some = self.points[idx].astype(np.int64), entries[left]
        top = max(int(np.abs(points).max(initial=0)), int(np.abs(some).max(initial=0)))
        if points.shape[1] * (2 * top) ** 2 < 1 << 53:          # floats hold these integers exactly
            some = some.astype(np.float64)
            return left[((some ** 2).sum(1) - 2 * (points.astype(np.float64) @ some.T)).argmin(1)]
        return left[((points[:, None] - some[None]) ** 2).sum(2).argmin(1)]

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sums, counts) by entry of the points nearest to it."""
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        for node, left in self.walk(entries):
            if len(left) == 1:
                sums[left[0]] += self.sums[node]
                counts[left[0]] += self.count[node]
            else:
                idx = self.leaves[node]
                best = self.nearest(idx, entries, left)
                np.add.at(sums, best, self.points[idx])
                np.add.at(counts, best, 1)
        return sums, counts

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point."""
        best = np.zeros(len(self.points), np.int64)
        for node, left in self.walk(entries):
            idx = self.below(node)
            best[idx] = left[0] if len(left) == 1 else self.nearest(idx, entries, left)
        return best, ((self.points - entries[best]) ** 2).sum(1)


def _integers(vectors: list) -> np.ndarray:
    return np.floor(np.array(vectors, np.float64) * SCALE).astype(np.int64)


def _forest(width: int):
    """Rows to chunks: (ids, labels, trees), a chunk a row."""
    def chunk(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        trees = [Tree(part) for part in np.split(_integers(vectors), PARTS, axis=1)]
        columns = [pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())), pa.array([pickle.dumps(trees, 5)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            labels += batch.column("label").to_pylist()
            flat = batch.column("vector").flatten()
            vectors += list(np.asarray(flat, np.float64).reshape(-1, width))
            while len(ids) >= CHUNK:
                yield chunk(ids[:CHUNK], labels[:CHUNK], vectors[:CHUNK])
                del ids[:CHUNK], labels[:CHUNK], vectors[:CHUNK]
        if ids:
            yield chunk(ids, labels, vectors)
    return run


def _totals(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for forest in batch.column("trees").to_pylist():
                for part, tree in enumerate(pickle.loads(forest)):
                    s, n = tree.totals(books[part])
                    sums[part] += s
                    counts[part] += n
        rows = [(part, int(entry), int(counts[part][entry]), sums[part][entry].tolist()) for part in range(PARTS) for entry in np.flatnonzero(counts[part])]
        if rows:
            part, entry, count, total = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count, pa.int64()), pa.array(total, pa.list_(pa.int64()))],
                                             names=["part", "entry", "count", "sums"])
    return run


def _codes(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, forest in zip(*[batch.column(c).to_pylist() for c in ("ids", "labels", "trees")]):
                found = [tree.codes(book) for tree, book in zip(pickle.loads(forest), books)]
                text = ["".join(f"{int(i):02x}" for i in row) for row in zip(*[best for best, _ in found])]
                error = np.sum([e for _, e in found], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(text), pa.array(error, pa.int64())],
                                                 names=["vec_id", "label", "code", "error"])
    return run


def refined(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after one round: means rounded down, unused entries kept."""
    width = books[0].shape[1]
    tasks = trees.select("trees").mapInArrow(_totals(books), "part int, entry int, count long, sums array<long>")
    totals = tasks.groupBy("part", "entry").agg(F.sum("count").alias("count"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
    after = [b.copy() for b in books]
    for r in totals.collect():                  # at most PARTS * ENTRIES rows
        after[r["part"]][r["entry"]] = [x // r["count"] for x in r["sums"]]
    return after


def finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _starts(kept: DataFrame) -> list:
    """Vectors of the smallest distinct ids, ascending, null last."""
    ids = [r["vec_id"] for r in kept.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(ENTRIES).collect()]
    known = [i for i in ids if i is not None]
    near = F.lit(False) if not known else F.coalesce(F.col("vec_id") <= max(known), F.lit(False))
    rows = kept.where(near | F.col("vec_id").isNull() if None in ids else near).groupBy("vec_id").agg(F.min("vector").alias("vector")).collect()
    by = {r["vec_id"]: r["vector"] for r in rows}
    return [by[i] for i in ids]


def coded(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per kept row: vec_id, code (two hex digits per part), error
    (squared distances summed over parts), label_error (errors summed over equal
    labels), codebooks_sha256."""
    kept = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    kept = kept.where(finite(F.col("vector")))
    small = kept.where((F.size("vector") > 0) & F.forall("vector", lambda x: F.abs(x) < LARGEST // SCALE))
    first = small.select("vec_id", F.size("vector").alias("width")).orderBy(F.col("vec_id").asc_nulls_last(), "width").limit(1).collect()
    width = first[0]["width"] if first else PARTS
    if width % PARTS:
        raise ValueError(f"vectors of {width} components cannot be cut into {PARTS} equal parts")
    fits = (F.size("vector") == width) & F.forall("vector", lambda x: F.abs(x) < LARGEST // SCALE)
    start = _starts(kept.where(fits))
    books = [b.copy() for b in np.split(_integers(start).reshape(len(start), width), PARTS, axis=1)]
    trees = cut(kept.where(fits).mapInArrow(_forest(width), "ids array<long>, labels array<string>, trees binary"))
    for _ in range(ROUNDS if start else 0):
        books = refined(trees, books)
    digest = hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
    rows = cut(trees.mapInArrow(_codes(books), "vec_id long, label string, code string, error long"))
    odd = kept.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    rows = rows.unionByName(odd).withColumn("name", F.coalesce(F.concat(F.lit("s"), "label"), F.lit("n"))).drop("label")
    sums = cut(rows.groupBy("name").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows")))
    total = sums.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    return spread_join(rows, sums, ["name"], "rows", total).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle() -> str:
    """The contract in DuckDB SQL: plain nearest entries, rounds written out."""
    steps, last = "", "book0"
    for r in range(ROUNDS + 1):
        steps += f""",
near{r} AS MATERIALIZED (SELECT vec_id, part, min(dist * 1024 + entry) AS best FROM (
    SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist FROM part p JOIN {last} b USING (part)) GROUP BY vec_id, part)"""
        if r < ROUNDS:
            steps += f""",
mean{r} AS (SELECT part, entry, list(m ORDER BY i) AS x FROM (SELECT part, n.best % 1024 AS entry, i, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM near{r} n JOIN (SELECT vec_id, part, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM part) USING (vec_id, part) GROUP BY ALL) GROUP BY part, entry),
book{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM {last} b LEFT JOIN mean{r} m USING (part, entry))"""
            last = f"book{r + 1}"
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
part AS MATERIALIZED (SELECT vec_id, k AS part, x[k * len(x) // {PARTS} + 1:(k + 1) * len(x) // {PARTS}] AS x FROM kept, range({PARTS}) t(k)),
book0 AS MATERIALIZED (SELECT part, entry, x FROM part JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}) USING (vec_id)){steps},
sha AS (SELECT sha256(string_agg(c, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM (SELECT part, entry, list_aggregate(x, 'string_agg', ',') AS c FROM {last})),
code AS (SELECT vec_id, string_agg(lpad(to_hex(best % 1024), 2, '0'), '' ORDER BY part) AS code, sum(best // 1024)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id)
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM code JOIN kept USING (vec_id), sha"""
