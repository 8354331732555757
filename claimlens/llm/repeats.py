"""Substring dedup by Rabin-Karp window hashes (operator 8).

Every window of ``size`` consecutive words gets a polynomial hash.  Spark deals
the windows by hash; where a hash starts in several places, all but the first
(smallest id, then smallest start) are repeats.  The repeats of a document come
together again, overlapping ones merge into maximal intervals, and the words in
those are removed.

A task first compares the windows of its own documents: of a hash that occurs
often there only the first goes through the shuffle, so a passage that a third
of all documents share is sent once per task.  Windows travel as packed arrays,
a row per task and range of hashes.

The top bits of a 64-bit hash choose its range and the low 56 travel, so two
different passages are taken for one with a chance of about
pairs / (ranges * 2^56).

Defined results: null text counts as empty; null ids come last; rows that
repeat both id and text are one document; texts of fewer than ``size`` words
lose nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from claimlens.llm.common import LAST, keyed, text_bytes
from claimlens.llm.words import BASE, WordHashes, chunks, hash_words, mix, texts, window_hashes, window_starts

WINDOW = 20
#: Text bytes that a task compares at once, windows of one range of hashes, and
#: text bytes of the documents that meet their repeats in one group.
CHUNK_BYTES, WINDOWS_PER_RANGE, SLOT_BYTES = 6 << 20, 1 << 20, 6 << 20
PACKED = "range int, keys binary, parts binary, at binary, starts binary, hashes binary"
REMOVED = "slot int, keys binary, parts binary, at binary, starts binary"
RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"


def _documents(df: DataFrame) -> DataFrame:
    """``keyed`` documents.  Their parts travel with all windows, so where every
    id has one row it alone tells documents apart, and only null ids keep theirs."""
    docs = keyed(df)
    if docs.where(F.col("key") < LAST).groupBy("key").count().where("count > 1").isEmpty():
        docs = docs.withColumn("part", F.when(F.col("key") < LAST, F.lit(bytes(16))).otherwise(F.col("part")))
    return docs


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and parts as two numbers each."""
    parts = b"".join(batch.column("part").to_pylist())
    return np.asarray(batch.column("key").to_numpy(zero_copy_only=False)), np.frombuffer(parts, "<u8").reshape(-1, 2)


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which parts are equal."""
    return (a[:, 0] == b[:, 0]) & (a[:, 1] == b[:, 1])


def _slots(keys: np.ndarray, parts: np.ndarray, slots: int) -> np.ndarray:
    """Group in which a document meets its repeats."""
    return (mix(keys.astype(np.uint64) * BASE + parts[:, 0]) % np.uint64(slots)).astype(np.int32)


def _ranges(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range by the top 32 bits of a hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _low56(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _from56(packed: bytes) -> np.ndarray:
    raw = np.zeros((len(packed) // 7, 8), np.uint8)
    raw[:, :7] = np.frombuffer(packed, np.uint8).reshape(-1, 7)
    return raw.view("<u8").ravel()


def _pack(x: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.astype(kind).tobytes())


def _unpack(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _places(at: np.ndarray, offsets: np.ndarray, keys: np.ndarray, parts: np.ndarray) -> dict:
    """Positions in the row of all words, ascending, as the documents that they
    fall in and the starts within those."""
    doc = np.searchsorted(offsets, at, "right") - 1
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    here = doc[first]
    return {"keys": _pack(keys[here], "<i8"), "parts": _pack(parts[here], "<u8"), "at": _pack(first, "<u4"),
            "starts": _pack(at - offsets[doc], "<u4")}


def _windows(size: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, schema = WordHashes(), pa.schema([("range", pa.int32()), *((n, pa.binary()) for n in ("keys", "parts", "at", "starts", "hashes"))])
        for batch in chunks(batches, "text", CHUNK_BYTES):
            rows = _first_here(cache, batch, size, ranges)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def _first_here(cache: WordHashes, batch: pa.RecordBatch, size: int, ranges: int) -> list[dict]:
    keys, parts = _ids(batch)
    order = np.lexsort((*parts.T, keys))
    keys, parts, docs = keys[order], parts[order], texts(batch.column("text").take(pa.array(order)))
    same = np.r_[False, (keys[1:] == keys[:-1]) & _equal(parts[1:], parts[:-1])] if len(keys) else np.zeros(0, bool)
    docs = [[] if again else text.split() for text, again in zip(docs, same)]
    words, lens = hash_words(cache, docs)
    at = window_starts(lens, size)
    if not len(at):
        return []
    offsets = np.r_[0, np.cumsum(lens)[:-1]]
    hashes = window_hashes(words, size)[at]
    by_hash = np.argsort(hashes, kind="stable")
    ordered = hashes[by_hash]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    rows = []
    repeats = np.sort(by_hash[~first])
    if len(repeats):
        rows.append({"range": int(_ranges(hashes[repeats[:1]], ranges)[0]), "hashes": None, **_places(at[repeats], offsets, keys, parts)})
    firsts = np.sort(by_hash[first])
    dealt = _ranges(hashes[firsts], ranges)
    by_range = np.argsort(dealt, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(dealt[by_range]) > 0, True])
    for a, b in zip(cuts[:-1], cuts[1:]):
        mine = firsts[by_range[a:b]]
        rows.append({"range": int(dealt[by_range[a]]), "hashes": _low56(hashes[mine]), **_places(at[mine], offsets, keys, parts)})
    return rows


def _repeated(slots: int):
    """The windows of one range of hashes: all but the first of each hash."""
    def run(got: pd.DataFrame) -> pd.DataFrame:
        keys, parts, starts, hashes, known = [], [], [], [], []
        for row in got.itertuples():
            at, s = _unpack(row.at, "<u4"), _unpack(row.starts, "<u4")
            each = np.diff(np.r_[at, len(s)])
            place = np.repeat(_unpack(row.keys, "<i8"), each), np.repeat(_unpack(row.parts, "<u8").reshape(-1, 2), each, 0), s
            if row.hashes is None:
                known.append(place)
                continue
            for all_, mine in zip((keys, parts, starts, hashes), (*place, _from56(row.hashes))):
                all_.append(mine)
        if keys:
            keys, parts, starts, hashes = map(np.concatenate, (keys, parts, starts, hashes))
            # Only hashes that occur again matter, and most do not.
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            equal = ordered[1:] == ordered[:-1]
            mine = order[np.r_[False, equal] | np.r_[equal, False]]
            keys, parts, starts, hashes = keys[mine], parts[mine], starts[mine], hashes[mine]
            order = np.lexsort((starts, *parts.T, keys, hashes))
            ordered = hashes[order]
            before, here = order[:-1], order[1:]
            own = (keys[here] == keys[before]) & _equal(parts[here], parts[before]) & (starts[here] == starts[before])  # a repeated row
            mine = here[(ordered[1:] == ordered[:-1]) & ~own]
            known.append((keys[mine], parts[mine], starts[mine]))
        keys, parts, starts = map(np.concatenate, zip(*known))
        slot = _slots(keys, parts, slots)
        order = np.lexsort((starts, *parts.T, keys, slot))
        keys, parts, starts, slot = keys[order], parts[order], starts[order], slot[order]
        rows = []
        cuts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1], True]) if len(slot) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            k, p = keys[a:b], parts[a:b]
            first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | ~_equal(p[1:], p[:-1])])
            rows.append((int(slot[a]), _pack(k[first], "<i8"), _pack(p[first], "<u8"), _pack(first, "<u4"), _pack(starts[a:b], "<u4")))
        return pd.DataFrame(rows, columns=["slot", "keys", "parts", "at", "starts"]).astype({"slot": "int32"})
    return run


def repeated_windows(docs: DataFrame, size: int, ranges: int, slots: int) -> DataFrame:
    """(slot, keys, parts, at, starts): packed starts of the repeated windows,
    by slots of documents."""
    packed = docs.select("key", "part", "text").mapInArrow(_windows(size, ranges), PACKED)
    return packed.groupBy("range").applyInPandas(_repeated(slots), REMOVED)


def _squeezed(slots: int):
    """Texts on their way to their slot, compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches, "text", CHUNK_BYTES):
            keys, parts = _ids(batch)
            made = pa.array([press.compress(x) for x in texts(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(_slots(keys, parts, slots)), *(batch.column(n) for n in ("doc_id", "key", "part")), made],
                                             names=["slot", "doc_id", "key", "part", "squeezed"])
    return run


def _without(size: int):
    def run(docs: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
        gone: dict[tuple[int, bytes], list[np.ndarray]] = {}
        for row in packed.itertuples():
            keys, at = _unpack(row.keys, "<i8").tolist(), _unpack(row.at, "<u4")
            parts = [p.tobytes() for p in _unpack(row.parts, "<u8").reshape(-1, 2)]
            for key, part, mine in zip(keys, parts, np.split(_unpack(row.starts, "<u4"), at[1:])):
                gone.setdefault((key, part), []).append(mine)
        open_, out = zstandard.ZstdDecompressor(), []
        for doc in docs.drop_duplicates(["key", "part"]).itertuples():
            words, spans = open_.decompress(doc.squeezed).split(), []
            if (doc.key, doc.part) in gone:
                starts = np.unique(np.concatenate(gone[doc.key, doc.part])).astype(np.int64)
                cuts = np.flatnonzero(np.diff(starts) > size) + 1
                spans = list(zip(starts[np.r_[0, cuts]].tolist(), (starts[np.r_[cuts - 1, -1]] + size).tolist()))
            kept, at = [], 0
            for a, b in spans:
                kept += words[at:a]
                at = b
            kept += words[at:]
            out.append((None if doc.key == LAST and doc.part[-1] % 16 == 15 else doc.key, len(words), len(words) - len(kept),
                        [{"start": a, "end": b} for a, b in spans], b" ".join(kept).decode("utf-8", "replace")))
        made = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "spans", "kept_text"], dtype=object)   # ids beside None stay exact
        return made.astype({"doc_id": "Int64", "n_words": "int64", "n_removed": "int64"})
    return run


def without_repeats(df: DataFrame, size: int = WINDOW, windows_per_range: int = WINDOWS_PER_RANGE, slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (removed word
    intervals, end exclusive) and kept_text (kept words joined by a space)."""
    docs = _documents(df)
    total = text_bytes(docs)
    ranges, slots = max(1, math.ceil(total / 6 / windows_per_range)), max(1, math.ceil(total / slot_bytes))
    gone = repeated_windows(docs, size, ranges, slots)
    docs = docs.mapInArrow(_squeezed(slots), "slot int, doc_id long, key long, part binary, squeezed binary")
    return docs.groupBy("slot").cogroup(gone.groupBy("slot")).applyInPandas(_without(size), RESULT)
