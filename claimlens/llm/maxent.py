"""Language-model scores by a hashed maximum-entropy model (operator 12).

A token is a word (A-Z lower-cased) or the end of a text.  Its chance given the
tokens before it is a product of softmaxes, factored by classes:

- of its class (words by their last two bytes, hashed to ``CLASSES`` - 1 classes;
  the end has class 0);
- in the class, of its member: the ``MEMBERS`` - 1 most frequent words of a class
  are members of their own, all others share member 0;
- in member 0, by add-one counts, with one more unit for all unseen words.

The features of both softmaxes are the bigram context (the token before) and a
skip context (the one before that alone), hashed to ``ROWS`` weight rows; in the
second softmax together with the class.  The biases are the add-one shares of the training tokens, so without any training the
model is the unigram model of classes, members and words.

Work runs on *chunks* of texts, written once: each holds its distinct words and
the token sequence as numbers of them, compressed.  Word counts need one shuffle:
a chunk sends its words and counts by hash range, a range adds them up over all
chunks and sends the totals back.  Training is one pass over all training tokens in
``ROUNDS`` rounds over growing shares of the chunks: in a round each task takes
gradient steps (AdaGrad by row) from the model of the round before, and the new model
is the mean of the tasks' changes, each row weighted by how often a task visited it.
Model and changes have a fixed size, whatever the corpus; everything else
stays distributed.  Scoring gathers weight rows in sparse batches.

Defined results: null text counts as empty, which is an end alone; a null id
is not held out; repeated rows are counted and scored one by one; without
training rows every known count is 0; an empty table gives an empty result.
Words are told apart by 64-bit hashes: among V distinct words two are taken for one
with a chance of about V^2 / 2^65.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimlens.llm.common import cut
from claimlens.llm.words import mix

CLASSES, MEMBERS = 32, 16
ROWS = 1 << 15
#: A round's share of the chunks, in eighths.
ROUNDS = ((0,), (1,), (2, 3), (4, 5, 6, 7))
RATE, BATCH, LIMIT = 0.12, 8192, 12.0
#: Text bytes of a chunk, of a part of a long text, and distinct words of a hash range.
CHUNK, PIECE, RANGE = 8 << 20, 4 << 20, 1 << 18
#: Weight rows of one message of a task's changes.
BLOCK = 2048
#: The end of a text: no word holds a space.
END = b" "
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
CHUNKS = "chunk long, ids binary, has_id binary, learn binary, lens binary, seq binary, hashes binary, classes binary"
READY = "chunk long, ids binary, has_id binary, learn binary, lens binary, seq binary, words binary, totals binary, classes binary, members binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def pack(values: np.ndarray) -> bytes:
    """An integer array, byte by byte of significance, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


# -- chunks

def numbers_of_words() -> defaultdict:
    """Gives each distinct word a number, in order of appearance; the end has 0."""
    return defaultdict(count(1).__next__, {END: 0})


def word_class(word: bytes) -> int:
    return 0 if word == END else 1 + xxhash.xxh32_intdigest(word[-2:]) % (CLASSES - 1)


class _Classes(dict):
    """Class by a word's last two bytes."""

    def __missing__(self, last: bytes) -> int:
        self[last] = number = word_class(last)
        return number


def _sequence(text: bytes, numbers: defaultdict) -> np.ndarray:
    parts, at = [], 0
    while at < len(text):
        stop = _SPACE.search(text, at + PIECE)
        to = stop.start() if stop else len(text)
        parts.append(np.fromiter(map(numbers.__getitem__, text[at:to].lower().split()), np.int32))
        at = to
    return np.concatenate([*parts, np.zeros(1, np.int32)])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def chunk(rows: list[tuple], texts: list[bytes]) -> pa.RecordBatch:
        numbers = numbers_of_words()
        seqs = [_sequence(text, numbers) for text in texts]
        ids, learn = zip(*rows)
        columns = [pack(np.array([i or 0 for i in ids], np.int64)), np.array([i is not None for i in ids], np.uint8).tobytes(),
                   np.array(learn, np.uint8).tobytes(), pack(np.array([len(s) for s in seqs], np.int64)), pack(np.concatenate(seqs)),
                   np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers)).tobytes(), bytes(map(of_last.__getitem__, [w[-2:] for w in numbers]))]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["ids", "has_id", "learn", "lens", "seq", "hashes", "classes"])

    rows, texts, size, of_last = [], [], 0, _Classes()
    for batch in batches:
        of_text = batch.column("text").cast(pa.large_binary())
        for i, learn, text in zip(batch.column("doc_id").to_pylist(), batch.column("learn").to_pylist(), of_text):
            text = text.as_py() or b""
            if rows and size + len(text) > CHUNK:
                yield chunk(rows, texts)
                rows, texts, size = [], [], 0
            rows.append((i, learn))
            texts.append(text)
            size += len(text)
    if rows:
        yield chunk(rows, texts)


def chunked(df: DataFrame) -> DataFrame:
    """The corpus as written chunks (``CHUNKS``)."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out()).alias("learn"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(_chunked, CHUNKS.split(", ", 1)[1])
    return cut(made.select(F.monotonically_increasing_id().alias("chunk"), "*"))


# -- counts

def _range_bounds(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the hashes, start of each hash range in it)."""
    order = np.argsort(hashes, kind="stable")
    of = (hashes[order] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(order), np.int64)
    return order, np.searchsorted(of, np.arange((1 << bits) + 1))


def _to_ranges(bits: int):
    """Each chunk's distinct words and their training counts, by hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, classes = np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["classes"], np.uint8)
                learnt = np.repeat(np.frombuffer(row["learn"], np.uint8).astype(bool), unpack(row["lens"], np.int64))
                counts = np.bincount(unpack(row["seq"], np.int32)[learnt], minlength=len(hashes))
                order, bounds = _range_bounds(hashes, bits)
                out = [(r, row["chunk"], hashes[o].tobytes(), pack(counts[o]), classes[o].tobytes())
                       for r, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a for o in [order[a:b]]]
                columns = list(zip(*out))
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["range", "chunk", "hashes", "counts", "classes"])
    return run


#: What a range sends: totals to chunks, sums of classes, candidates for members.
ANSWER = "kind string, chunk long, range int, totals binary, class int, count long, types long, word long"


def _added_up(rows: pd.DataFrame) -> pd.DataFrame:
    hashes = [np.frombuffer(h, np.uint64) for h in rows["hashes"]]
    words, place = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.concatenate([unpack(c, np.int64) for c in rows["counts"]])
    totals = np.zeros(len(words), np.int64)
    np.add.at(totals, place, counts)
    classes = np.zeros(len(words), np.int64)
    classes[place] = np.frombuffer(b"".join(rows["classes"]), np.uint8)
    r, out, at = int(rows["range"].iloc[0]), [], 0
    for chunk, own in zip(rows["chunk"], hashes):
        out.append(("chunk", chunk, r, pack(totals[place[at:at + len(own)]]), None, None, None, None))
        at += len(own)
    known = totals > 0
    for c in np.unique(classes):
        of = np.flatnonzero((classes == c) & known)
        out.append(("class", None, r, None, int(c), int(totals[of].sum()), len(of), None))
        for i in of[np.lexsort((words[of], -totals[of]))[:MEMBERS - 1]]:
            out.append(("member", None, r, None, int(c), int(totals[i]), 1, int(words[i].astype(np.int64))))
    return pd.DataFrame(out, columns=[x.split()[0] for x in ANSWER.split(", ")]).astype({c: "Int64" for c in ("chunk", "class", "count", "types", "word")})


def counted(chunks: DataFrame) -> DataFrame:
    """The ranges' answers (``ANSWER``), written."""
    entries = chunks.agg(F.coalesce(F.sum(F.length("classes")), F.lit(0)).alias("n")).first()["n"]
    bits = max(0, (int(entries) // RANGE).bit_length())
    sent = chunks.select("chunk", "learn", "lens", "seq", "hashes", "classes").mapInArrow(
        _to_ranges(bits), "range int, chunk long, hashes binary, counts binary, classes binary")
    return cut(sent.groupBy("range").applyInPandas(_added_up, ANSWER))


class Units:
    """Counts of the training corpus: by class, and of the listed members."""

    def __init__(self, classes: list[tuple[int, int, int]], members: list[tuple[int, int, int, int]]) -> None:
        self.count, self.types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for c, tokens, types in classes:
            self.count[c], self.types[c] = tokens, types
        self.tokens, self.vocabulary = int(self.count.sum()), int(self.types.sum())
        mass = np.zeros((CLASSES, MEMBERS))                     # add-one units
        listed = np.zeros((CLASSES, MEMBERS), bool)
        for c, member, tokens, _ in members:
            mass[c, member], listed[c, member] = tokens + 1, True
        units = self.count + self.types + 1
        mass[:, 0], listed[:, 0] = units - mass.sum(1), True
        self.rest = mass[:, 0].copy()                           # units of member 0
        self.class_bias = np.log(units / units.sum()).astype(np.float32)
        with np.errstate(divide="ignore"):
            self.member_bias = np.where(listed, np.log(mass / units[:, None]), -np.inf).astype(np.float32)
        by = sorted((word, member) for _, member, _, word in members)
        self.words = np.array([w for w, _ in by], np.int64)
        self.numbers = np.array([m for _, m in by], np.uint8)

    def member(self, hashes: np.ndarray) -> np.ndarray:
        """Member of each word, 0 for those not listed."""
        own = hashes.astype(np.int64)
        if not len(self.words):
            return np.zeros(len(own), np.uint8)
        at = np.minimum(np.searchsorted(self.words, own), len(self.words) - 1)
        return np.where(self.words[at] == own, self.numbers[at], 0).astype(np.uint8)


def units(answers: DataFrame) -> Units:
    """At most CLASSES and CLASSES * MEMBERS rows reach the driver."""
    classes = answers.where("kind = 'class'").groupBy("class").agg(F.sum("count").alias("count"), F.sum("types").alias("types")).collect()
    best = Window.partitionBy("class").orderBy(F.col("count").desc(), "word")
    members = answers.where("kind = 'member'").withColumn("member", F.row_number().over(best)).where(F.col("member") < MEMBERS).collect()
    return Units([(r["class"], r["count"], r["types"]) for r in classes], [(r["class"], r["member"], r["count"], r["word"]) for r in members])


def _with_totals(found: Units):
    def run(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = own.iloc[0]
        hashes = np.frombuffer(row["hashes"], np.uint64)
        order = np.argsort(hashes, kind="stable")               # ranges in order are hashes in order
        totals = np.empty(len(hashes), np.int64)
        totals[order] = np.concatenate([unpack(t, np.int64) for t in answers.sort_values("range")["totals"]])
        words = hashes.astype(np.uint32).tobytes()              # the low bits serve the features
        return pd.DataFrame([[row["chunk"], row["ids"], row["has_id"], row["learn"], row["lens"], row["seq"], words, pack(totals),
                              row["classes"], found.member(hashes).tobytes()]], columns=[x.split()[0] for x in READY.split(", ")])
    return run


def ready(chunks: DataFrame, answers: DataFrame, found: Units) -> DataFrame:
    """Chunks with what training and scoring need (``READY``), written."""
    totals = answers.where("kind = 'chunk'").select("chunk", "range", "totals")
    return cut(chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInPandas(_with_totals(found), READY))


# -- model

class Model:
    def __init__(self, found: Units) -> None:
        self.units = found
        self.of_class = np.zeros((ROWS, CLASSES), np.float32)
        self.of_member = np.zeros((ROWS, MEMBERS), np.float32)
        self.steps = np.zeros((2, ROWS), np.float32)            # AdaGrad sums

    def copy(self) -> Model:
        out = Model.__new__(Model)
        out.units, out.of_class, out.of_member, out.steps = self.units, self.of_class.copy(), self.of_member.copy(), self.steps.copy()
        return out

    def chances(self, which: int, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Softmax of the classes (0) or members (1), a row per token; ``rows``: (features, tokens)."""
        weights = self.of_member if which else self.of_class
        out = self.units.member_bias[classes] if which else np.tile(self.units.class_bias, (rows.shape[1], 1))
        for r in rows:
            out += weights[r]
        np.exp(out, out)                        # weights are within LIMIT and biases at most 0
        out /= out.sum(1, keepdims=True)
        return out

    def step(self, which: int, rows: np.ndarray, classes: np.ndarray, picked: np.ndarray, visits: np.ndarray) -> None:
        """A gradient step on the picked classes or members of some tokens."""
        off = self.chances(which, rows, classes)
        off[np.arange(len(picked)), picked] -= 1
        touched = np.zeros(ROWS, bool)
        touched[rows] = True
        own = np.flatnonzero(touched)
        place = np.empty(ROWS, np.int64)
        place[own] = np.arange(len(own))
        at = place[rows]
        slope = np.zeros((off.shape[1], len(own)))
        for to, column in zip(slope, np.ascontiguousarray(off.T, np.float64)):
            for feature in at:
                to += np.bincount(feature, column, len(own))
        for feature in at:
            visits[which, own] += np.bincount(feature, minlength=len(own))
        steps = self.steps[which]
        steps[own] += (slope ** 2).mean(0)
        weights = self.of_member if which else self.of_class
        weights[own] = np.clip(weights[own] - (RATE * slope / np.sqrt(steps[own] + 1e-6)).T, -LIMIT, LIMIT)


def _class_salt() -> np.ndarray:
    return (mix(np.arange(1, CLASSES + 1, dtype=np.uint64)) % np.uint64(ROWS)).astype(np.uint16)


def contexts(seq: np.ndarray, lens: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Weight rows of each token's bigram and skip context; before a text's
    first token stands one more word."""
    start = len(words)
    hashes = np.append(words.astype(np.uint64), np.uint64(1 << 33))
    first = np.cumsum(lens) - lens
    before, skipped = np.empty(len(seq), np.int32), np.empty(len(seq), np.int32)
    before[1:], skipped[2:] = seq[:-1], seq[:-2]
    before[first] = skipped[first] = start
    skipped[first[lens > 1] + 1] = start
    bits = np.uint64(64 - (ROWS.bit_length() - 1))
    near, far = [(mix(hashes + np.uint64(1 << at)) >> bits).astype(np.uint16) for at in (40, 41)]
    return np.stack([near[before], far[skipped]])


class Texts:
    """A ready chunk, taken apart."""

    def __init__(self, row: dict) -> None:
        self.lens, self.seq = unpack(row["lens"], np.int64), unpack(row["seq"], np.int32)
        self.classes, self.members = np.frombuffer(row["classes"], np.uint8), np.frombuffer(row["members"], np.uint8)
        self.rows = contexts(self.seq, self.lens, np.frombuffer(row["words"], np.uint32))
        self.learn = np.frombuffer(row["learn"], np.uint8).astype(bool)

    def batches(self, at: np.ndarray | None = None) -> Iterator[tuple]:
        """(tokens, class rows, member rows, classes, members) of up to BATCH tokens."""
        salt = _class_salt()
        n = len(self.seq) if at is None else len(at)
        for a in range(0, n, BATCH):
            some = slice(a, a + BATCH) if at is None else at[a:a + BATCH]
            words = self.seq[some]
            rows, classes = self.rows[:, some], self.classes[words]
            yield some, rows, rows ^ salt[classes], classes, self.members[words]


def _trained(model: Model):
    """A task's changes of the model after its chunks, by block of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, visits = model.copy(), np.zeros((2, ROWS), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                texts = Texts(row)
                for _, rows, member_rows, classes, members in texts.batches(np.flatnonzero(np.repeat(texts.learn, texts.lens))):
                    own.step(0, rows, classes, classes, visits)
                    own.step(1, member_rows, classes, members, visits)
        if visits.any():
            for which, (new, old) in enumerate(((own.of_class, model.of_class), (own.of_member, model.of_member))):
                change, steps = (new - old).astype(np.float16), own.steps[which] - model.steps[which]
                out = [(which, b, visits[which, a:z].tobytes(), change[a:z].tobytes(), steps[a:z].tobytes())
                       for b, (a, z) in enumerate((a, a + BLOCK) for a in range(0, ROWS, BLOCK))]
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["which", "block", "visits", "change", "steps"])
    return run


def _mean_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up tasks' changes as they come: a few blocks are in memory."""
    sums: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            visits = np.frombuffer(row["visits"], np.int64)
            change = np.frombuffer(row["change"], np.float16).reshape(BLOCK, -1).astype(np.float64)
            at = sums.setdefault((row["which"], row["block"]), [0, 0, 0])
            for i, x in enumerate((visits, visits[:, None] * change, np.frombuffer(row["steps"], np.float32).astype(np.float64))):
                at[i] = at[i] + x
    if sums:
        out = [(which, block, (change / np.maximum(visits, 1)[:, None]).astype(np.float32).tobytes(), steps.astype(np.float32).tobytes())
               for (which, block), (visits, change, steps) in sums.items()]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["which", "block", "change", "steps"])


def trained(corpus: DataFrame, found: Units) -> Model:
    """One pass over all training tokens of ``corpus`` (``READY``)."""
    model = Model(found)
    part = F.pmod(F.xxhash64("chunk"), F.lit(8))
    for share in ROUNDS:
        changes = corpus.where(part.isin(*share)).mapInArrow(_trained(model), "which int, block int, visits binary, change binary, steps binary")
        mean = changes.repartition(2 * ROWS // BLOCK, "which", "block").mapInArrow(_mean_changes, "which int, block int, change binary, steps binary")
        model = model.copy()
        for r in mean.collect():                # the model's size, 2 * ROWS / BLOCK rows
            a, z = r["block"] * BLOCK, (r["block"] + 1) * BLOCK
            weights = model.of_member if r["which"] else model.of_class
            weights[a:z] += np.frombuffer(r["change"], np.float32).reshape(BLOCK, -1)
            model.steps[r["which"], a:z] += np.frombuffer(r["steps"], np.float32)
    return model


def _scored(model: Model):
    found = model.units

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts, totals = Texts(row), unpack(row["totals"], np.int64)
                base = np.log10((totals + 1) / (found.tokens + found.vocabulary + 1))
                # In member 0 a word has its share of the class's units.
                inside = np.where(texts.members == 0, np.log10((totals + 1) / np.maximum(found.rest[texts.classes], 1)), 0.0)
                scores = inside[texts.seq]
                for some, rows, member_rows, classes, members in texts.batches():
                    at = np.arange(len(classes))
                    scores[some] += np.log10(model.chances(0, rows, classes)[at, classes].astype(np.float64))
                    scores[some] += np.log10(model.chances(1, member_rows, classes)[at, members].astype(np.float64))
                docs, n = np.repeat(np.arange(len(texts.lens)), texts.lens), len(texts.lens)
                ids = pa.array(unpack(row["ids"], np.int64), pa.int64(), mask=np.frombuffer(row["has_id"], np.uint8) == 0)
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(~texts.learn), pa.array(texts.lens), pa.array(np.bincount(docs, totals[texts.seq] > 0, n).astype(np.int64)),
                    pa.array(np.full(n, found.tokens, np.int64)), pa.array(np.bincount(docs, base[texts.seq], n)), pa.array(np.bincount(docs, scores, n))],
                    names=[x.split()[0] for x in RESULT.split(", ")])
    return run


def scored(df: DataFrame) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (unigram, add-one) and score (the model's), both log10."""
    chunks = chunked(df)
    answers = counted(chunks)
    found = units(answers)
    corpus = ready(chunks, answers, found)
    return corpus.mapInArrow(_scored(trained(corpus, found)), RESULT)
