"""Near-duplicate groups by circulant MinHash (operator 10).

A document's set is its distinct ``SHINGLE``-word shingles, A-Z lower-cased (all
its words as one, when there are fewer).  Two permutations of ``CELLS`` cells
give the whole signature: the first deals a shingle to a cell, the second ranks
the cells; coordinate k is the smallest rank after the second is shifted
circularly by k.  Texts with equal word sequences are one class, and only its
representative goes on.

1. Bands of ``ROWS`` of the first ``BANDS * ROWS`` coordinates are bucket keys.
   A pair at the threshold shares no bucket with a chance under 1e-7.
2. In each bucket every member is paired with one leader, that with most copies.
   Pairs are tried on the signatures and confirmed on full sets.  Buckets whose
   members are then all in one component are done.
3. The rest is exact: in every other bucket all members of different components
   are compared by signatures of ``WIDE`` coordinates, in tiles of ``TILE``
   members.  A pair that can reach the threshold (six standard deviations
   allowed) is emitted by the first bucket that it shares, once, and confirmed
   on full sets.  For that, tiles are put together in groups of about ``GROUP``
   members, and a set travels once to a group, not once for each of its pairs.
   So no bucket emits all its pairs and none is capped.

Defined results: null and empty texts, and those of white space only, have no
set, link with nothing and stay.  Rows with a null id link with nothing, their
component is null, and they stay.  Rows that share an id are one node: each
keeps its own set size, and both get the component that either reaches; rows
that repeat both id and text are one document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from claimlens.llm.common import cut, few, keyed, no_id, small_batches, spread_join, tasks_for
from claimlens.llm.components import components
from claimlens.llm.words import WordHashes, chunks, mix, texts, window_hashes

SHINGLE, BANDS, ROWS, COORDINATES, WIDE = 5, 32, 4, 256, 1024
#: Percent; contracts may ask for another.
THRESHOLD = 80
CELLS, SEED = 1 << 20, 20250101
TILE, GROUP = 1024, 2000
SIGNED = "doc_id long, key long, part binary, n_shingles long, digest binary, bands array<long>, sketch binary"


class Circulant:
    """The two permutations; every task makes the same."""

    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        self.deal = rng.permutation(CELLS).astype(np.int64)
        rank = rng.permutation(CELLS).astype(np.uint32)
        self.ranks = np.r_[rank, rank[:WIDE]]

    def signature(self, shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
        """The first ``coordinates`` coordinates."""
        shifted = np.lib.stride_tricks.sliding_window_view(self.ranks, coordinates)
        cells = self.deal[(shingles & np.uint64(CELLS - 1)).astype(np.int64)]
        out = np.full(coordinates, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(cells), 2048):
            np.minimum(out, shifted[cells[at:at + 2048]].min(axis=0), out=out)
        return out


def shingles(cache: WordHashes, words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a document's shingles."""
    hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    if len(words) >= size:
        return np.unique(window_hashes(hashes, size))
    return mix(window_hashes(hashes, len(words)) + np.uint64(len(words))) if words else hashes


def _bands(signature: np.ndarray) -> list[int]:
    rows = signature[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key + rows[:, j])
    return key.astype(np.int64).tolist()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache, circulant = WordHashes(), Circulant()
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("part", pa.binary()), ("n_shingles", pa.int64()),
                        ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])
    for batch in chunks(batches, "text"):
        sizes, digests, bands, sketches, known = [], [], [], [], {}
        for text in texts(batch.column("text")):
            words = text.lower().split()
            digest = xxhash.xxh3_128_digest(b" ".join(words))
            if digest not in known:
                found = shingles(cache, words)
                signature = circulant.signature(found)
                known[digest] = (len(found), _bands(signature) if words else [], (signature & np.uint32(255)).astype(np.uint8).tobytes())
            n, keys, sketch = known[digest]
            sizes.append(n)
            digests.append(digest)
            bands.append(keys)
            sketches.append(sketch)
        ids = [batch.column(n) for n in ("doc_id", "key", "part")]
        yield pa.RecordBatch.from_arrays([*ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                          pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], schema=schema)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for batch in chunks(batches, "text"):
        made = [shingles(cache, text.lower().split()).astype("<u8").tobytes() for text in texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.binary())], names=["node", "members"])


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of full sets: 32 bits of each band's key, then the wide sketch."""
    circulant = Circulant()
    for batch in batches:
        made = []
        for members in batch.column("members"):
            signature = circulant.signature(np.frombuffer(members.as_buffer(), "<u8"), WIDE)
            made.append(np.array(_bands(signature), np.int64).astype("<u4").tobytes() + (signature & np.uint32(255)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.binary())], names=["node", "sketch"])


def _least_agreement(threshold: int, coordinates: int = COORDINATES) -> int:
    j = threshold / 100
    return math.floor(coordinates * j - 6 * math.sqrt(coordinates * j * (1 - j)))


def _alike(threshold: int):
    """Of pairs with sketches: those that can reach the threshold."""
    least = _least_agreement(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, COORDINATES) for n in ("sketch_a", "sketch_b"))
            keep = pa.array((a == b).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(keep) for n in ("a", "b")], names=["a", "b"])
    return run


def _confirmed(threshold: int):
    """Of pairs with full sets: those at or above the threshold, exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("members_a"), batch.column("members_b")):
                keep.append(_is_link(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), threshold))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(mask) for n in ("a", "b")], names=["a", "b"])
    return run


def _across(threshold: int):
    """Of members sorted by tile: pairs of a row on the left (side 0) and one on
    the right, of different components, whose wide sketches can reach the
    threshold, where this bucket is the first that they share (both are then in it,
    and in an open one).  Members that stand on both sides (2 on the right) meet
    once.  A tile's rows may come in several batches."""
    least, least_wide = _least_agreement(threshold), _least_agreement(threshold, WIDE)

    def unpacked(frame: pd.DataFrame) -> tuple:
        raw = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(-1, 4 * BANDS + WIDE)
        return frame["node"].to_numpy(), frame["component"].to_numpy(), np.ascontiguousarray(raw[:, :4 * BANDS]).view("<u4"), raw[:, 4 * BANDS:]

    def pairs(tile: pd.DataFrame) -> tuple[list, list]:
        out_a, out_b = [], []
        mark = np.uint32(int(tile["bucket"].iloc[0]) & 0xFFFFFFFF)
        node_l, comp_l, band_l, sketch_l = unpacked(tile[tile["side"] == 0])
        right = tile[tile["side"] != 0]
        node_r, comp_r, band_r, sketch_r = unpacked(right)
        once = right["side"].to_numpy() == 1
        for i in range(len(node_l)):
            near = np.flatnonzero((comp_r != comp_l[i]) & (once | (node_r > node_l[i])))
            if not len(near):
                continue
            here = np.flatnonzero(band_l[i] == mark)
            if not len(here):       # the bucket of another text with this id
                continue
            band = int(here[0])
            near = near[~(band_r[near, :band] == band_l[i, :band]).any(axis=1)]
            near = near[(sketch_r[near, :COORDINATES] == sketch_l[i, :COORDINATES]).sum(axis=1) >= least]
            near = near[(sketch_r[near] == sketch_l[i]).sum(axis=1) >= least_wide]
            out_a += np.minimum(node_r[near], node_l[i]).tolist()
            out_b += np.maximum(node_r[near], node_l[i]).tolist()
        return out_a, out_b

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        names = ["bucket", "i", "j"]

        def done(frame: pd.DataFrame) -> pd.DataFrame:
            groups, out_a, out_b = [], [], []
            for _, tile in _runs(frame, names):
                a, b = pairs(tile)
                groups += [tile["team"].iloc[0]] * len(a)
                out_a += a
                out_b += b
            return pd.DataFrame({"team": np.array(groups, np.int32), "a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})

        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(batch):
                continue
            ends = (batch[names] == batch[names].iloc[-1]).all(axis=1).to_numpy()
            held, ready = batch[ends], batch[~ends]
            if len(ready):
                yield done(ready)
        if held is not None and len(held):
            yield done(held)
    return run


def _runs(frame: pd.DataFrame, names: list[str]):
    values = frame[names].to_numpy()
    cuts = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(axis=1), True])
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield a, frame.iloc[a:b]


def _is_link(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    both = np.sort(np.concatenate([x, y]))
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= threshold * (len(both) - shared)


def _confirmed_in_groups(threshold: int):
    """Of a group's pairs, those that are links; the group's sets come once."""
    def run(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        found: dict[int, list[np.ndarray]] = {}
        for node, members in zip(sets["node"].tolist(), sets["members"]):
            found.setdefault(node, []).append(np.frombuffer(members, "<u8"))
        keep = [any(_is_link(x, y, threshold) for x in found[a] for y in found[b]) for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist())]
        return pairs.loc[np.array(keep, bool), ["a", "b"]]
    return run


def _links(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, threshold: int, parts: int) -> DataFrame:
    """The pairs (a, b) that are links: by sketches, then on full sets."""
    a = sketches.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"))
    b = sketches.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b"))
    pairs = few(few(pairs.join(a, "a"), parts).join(b, "b"), parts).where(100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
    pairs = pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(_alike(threshold), "a long, b long")
    a = sets.select(F.col("node").alias("a"), F.col("members").alias("members_a"))
    b = sets.select(F.col("node").alias("b"), F.col("members").alias("members_b"))
    return few(pairs.join(a, "a"), parts).join(b, "b").select("a", "b", "members_a", "members_b").mapInArrow(_confirmed(threshold), "a long, b long")


def near_groups(df: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id that
    links reach), kept (doc_id = component_id), and its key."""
    small_batches(df.sparkSession)
    docs = keyed(df)
    signed = docs.select("doc_id", "key", "part", "text").mapInArrow(_sign, SIGNED)
    signed = cut(signed)
    light = signed.select("doc_id", "key", "part", "n_shingles", "digest").dropDuplicates(["key", "part"])
    whole = signed.where((F.col("n_shingles") > 0) & ~no_id())
    classes = cut(whole.groupBy("digest").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
                                              F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    total = classes.count()
    parts = tasks_for(total)
    classes = few(classes, parts)

    # 1. buckets of two members or more, with their leaders
    held = classes.select("node", "copies", F.explode("bands").alias("bucket"))
    rank = -F.least("copies", F.lit(1 << 20)).cast("long") * (1 << 40) + F.pmod(F.xxhash64("node"), F.lit(1 << 40))
    leaders = cut(held.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min_by("node", rank).alias("leader")).where("size > 1"), parts)
    member = cut(spread_join(held.select("bucket", "node"), leaders, ["bucket"], "size", total * BANDS), parts)

    # 2. links with the leaders
    need = cut(member.select("node").distinct(), parts)
    sketches = classes.select("node", "n_shingles", "sketch").join(need, "node", "left_semi")
    sets = docs.select(F.col("key").alias("node"), "text").join(need, "node", "left_semi").dropDuplicates(["node", "text"])
    sets = cut(sets.mapInArrow(_sets, "node long, members binary"), parts)
    stars = member.where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    stars = cut(stars, parts)
    links = cut(_links(stars, sketches, sets, threshold, parts), parts)
    first = components(links, parts)

    # 3. buckets that still hold members of different components: the members
    # outside the largest one meet all, so a bucket costs its size and not its square
    joined = member.join(first, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    joined = cut(joined, parts)
    open_ = few(joined.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("members")), parts)
    open_ = open_.groupBy("bucket").agg(F.sum("members").alias("size"), F.max(F.struct("members", "component")).alias("top")).where("size > top.members")
    tiles, few_tiles = [F.ceil(x / TILE).cast("int") for x in (F.col("size"), F.col("size") - F.col("top.members"))]
    open_ = cut(open_.select("bucket", "size", F.col("top.component").alias("top"), tiles.alias("tiles"), few_tiles.alias("few_tiles"),
                             (F.col("size") * few_tiles + (F.col("size") - F.col("top.members")) * tiles).alias("rows")), parts)
    totals = open_.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    teams = max(1, math.ceil(totals["rows"] / GROUP))
    rest = cut(spread_join(joined, open_, ["bucket"], "size", total * BANDS), parts)
    wide = few(sets.join(rest.select("node").distinct(), "node", "left_semi"), parts).mapInArrow(_wide, "node long, sketch binary")
    rest = few(rest.join(wide, "node"), parts)
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    own_few = F.pmod(F.xxhash64("node", F.lit(1)), F.col("few_tiles")).cast("int")
    columns = ["bucket", "node", "component", "sketch"]
    left = rest.where("component <> top").select(*columns, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i"), own_few.alias("j"), F.lit(0).alias("side"))
    right = rest.select(*columns, own.alias("i"), F.explode(F.sequence(F.lit(0), F.col("few_tiles") - 1)).alias("j"), F.when(F.col("component") == F.col("top"), 1).otherwise(2).alias("side"))
    rest = left.unionByName(right).withColumn("team", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(teams)).cast("int"))
    rest = few(rest.repartition("bucket", "i", "j"), parts).sortWithinPartitions("bucket", "i", "j", "node")
    across = cut(rest.mapInPandas(_across(threshold), "team int, a long, b long").join(stars, ["a", "b"], "left_anti"), parts)
    wanted = across.select(F.col("team").alias("of_team"), F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = few(few(wanted, parts).join(sets, "node"), parts)
    more = across.select("team", "a", "b").groupBy("team").cogroup(wanted.groupBy("of_team")).applyInPandas(_confirmed_in_groups(threshold), "a long, b long")
    links = cut(links.union(more), parts)
    groups = components(links, parts)

    # every document: its class's node, and that node's component
    node_of = classes.select("digest", "node", "copies")
    linked = light.where((F.col("n_shingles") > 0) & ~no_id())
    alone = light.where((F.col("n_shingles") == 0) | no_id()).withColumn("node", F.col("key"))
    linked = few(spread_join(linked, node_of, ["digest"], "copies", total), parts).drop("copies")
    out = linked.unionByName(alone).join(groups, "node", "left")
    # Empty texts and null ids are linked with nothing, though their keys may be nodes.
    component = F.when((F.col("n_shingles") == 0) | no_id(), F.col("key")).otherwise(F.coalesce("component", "node"))
    return out.select("doc_id", "n_shingles", F.when(~no_id(), component).alias("component_id"), (F.col("key") == component).alias("kept"), "key", "part")
