"""Quality classifier: supervised subword embeddings (operator 4).

A text is the average of learned vectors: of its words, of the byte n-grams
inside its words (with word edges), and of its word pairs, all hashed to
``SLOTS`` slots.  A linear layer and softmax give the two classes' chances.
Training is stochastic gradient descent in numpy on a bounded sample of
labelled rows; averaging and the layer are linear, so for scoring the model
folds to one number per slot, which the tasks get.

Scores use the text alone.  Labels are read only from rows outside the held-out
third (crc32 of the id as text, mod 3, is 1) and only of texts of at most
``TRAIN_CHARS`` characters, ``TRAIN_ROWS`` of them by a hash of the id (rows that
repeat id and text count once).  All
texts are scored whole.

Defined results: null text counts as empty; empty texts get the score of the
bias alone; without labels of both classes every score is the share of label 1
(0.5 without any label); null ids are not held out and have no label; of
several labels of one id the largest counts; repeated rows yield a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimlens.llm.common import digest, small_batches
from claimlens.llm.words import BASE, WordHashes, chunks, hash_words, mix, texts, window_hashes, window_starts

TRAIN_ROWS, TRAIN_CHARS = 3000, 100_000
SLOTS, DIM, EPOCHS, RATE, SEED = 1 << 18, 8, 3, 1.0, 11
GRAMS = (3, 4, 5)
#: Words whose features are made at once.
PART_WORDS = 1 << 16


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def word_slots(words: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """Slots of all words and of the byte n-grams inside their edges."""
    slots = [mix(hashes) % np.uint64(SLOTS)]
    edged = np.frombuffer(b"".join([b"<%b>" % w for w in words]), np.uint8).astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    for n in GRAMS:
        slots.append(window_hashes(edged, n)[window_starts(lens, n)] % np.uint64(SLOTS))
    return np.concatenate(slots).astype(np.int64)


def all_slots(words: list[bytes], cache: WordHashes) -> Iterator[np.ndarray]:
    """Slots of all features of a text, a part at a time."""
    hashes, _ = hash_words(cache, [words])
    for at in range(0, len(words), PART_WORDS):
        yield word_slots(words[at:at + PART_WORDS], hashes[at:at + PART_WORDS])
        yield pair_slots(hashes[at:at + PART_WORDS + 1])


def pair_slots(hashes: np.ndarray) -> np.ndarray:
    """Slots of neighbouring words, from their 64-bit hashes; a word that
    repeats the one before has the same slot, whatever the word."""
    slots = (mix(hashes[:-1] * BASE + hashes[1:]) % np.uint64(SLOTS)).astype(np.int64)
    slots[hashes[:-1] == hashes[1:]] = 0
    return slots


def features(words: list[bytes], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(slots, counts) of a text."""
    parts = list(all_slots(words, cache))
    found, counts = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
    return found.astype(np.int32), counts.astype(np.int32)


class Model:
    def __init__(self, slot_weights: np.ndarray, bias: float) -> None:
        self.slot_weights, self.bias = slot_weights, bias


def fit(rows: list[tuple[bytes, int]]) -> Model:
    """Train on (text, label 0 or 1)."""
    share = (sum(y for _, y in rows) + 0.5 * (not rows)) / max(1, len(rows))
    if not 0 < share < 1 or len(rows) < 2:
        odds = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(SLOTS, np.float32), float(np.log(odds / (1 - odds))))
    rng, cache = np.random.default_rng(SEED), WordHashes()
    data = [(*features(text.split(), cache), y) for text, y in rows]
    cache.clear()
    vectors = ((rng.random((SLOTS, DIM), np.float32) - 0.5) / DIM).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(data), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(data)):
            rate = RATE * (1 - done / steps)
            done += 1
            slots, counts, y = data[i]
            weights = (counts / max(1, counts.sum())).astype(np.float32)
            mean = weights @ vectors[slots]
            logits = layer @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            back = layer.T @ p
            layer -= rate * np.outer(p, mean)
            bias -= rate * p
            # Scaled by the number of slots: each holds a small part of the mean.
            vectors[slots] -= (rate * min(len(slots), 64)) * weights[:, None] * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def mean_weight(words: list[bytes], weights: np.ndarray, cache: WordHashes) -> float:
    """Average weight of all features of a text."""
    total, count = 0.0, 0
    for slots in all_slots(words, cache):
        total += float(weights[slots].sum())
        count += len(slots)
    return total / max(1, count)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cache = model.slot_weights.astype(np.float64), WordHashes()
        for batch in chunks(batches, "text"):
            logits = [mean_weight(text.split(), weights, cache) + model.bias for text in texts(batch.column("text"))]
            out = 1 / (1 + np.exp(-np.clip(np.array(logits, np.float64), -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "score"])
    return run


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    # The smallest ids' hashes first: distinct (id, digest of text) are ranked, then
    # their texts fetched, so an id that repeats counts as often as it has texts.
    short = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where(F.char_length("text") <= chars)
    short = short.withColumn("part", digest(F.col("text")))
    drawn = short.select("doc_id", "part").distinct().join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "part").limit(rows)
    got = short.join(F.broadcast(drawn), ["doc_id", "part"]).dropDuplicates(["doc_id", "part"]).select("doc_id", "text", "label")
    got = got.toPandas().sort_values(["doc_id", "text"])        # at most ``rows`` rows
    return fit([(t.encode(), int(y)) for t, y in zip(got["text"], got["label"])])


def with_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> DataFrame:
    """``docs`` with a last column score, which replaces one of that name."""
    small_batches(docs.sparkSession)
    model = trained(docs, labels, rows, chars)
    kept = docs.drop("score")
    return kept.mapInArrow(_scores(model), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", score double")


def scored(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> DataFrame:
    """One row per row: doc_id, held_out, score, predicted (1 if score >= 0.5)."""
    out = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, rows, chars)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
