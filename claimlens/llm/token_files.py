"""Token-id output as ORC files (operator 9).

Documents are sorted by id across the files (range partitions), encoded where
they lie and written by Spark's ORC writer: ids as run-length encoded integers
in stripes of ``STRIPE_BYTES``, a row index every ``INDEX_ROWS`` rows with
minimum and maximum per column, and Bloom filters on ``doc_id``.  Readers take
stripes in parallel, and a lookup by ``doc_id`` skips stripes and row groups by
their metadata.

A row also has the number of the task that wrote it (tasks are in the order of
ids) and ``start_in_task``, the ids of the task's documents before it, so the global
start needs one number per task, kept beside the files, and no sort on reading,
whatever files a task's rows went to.

Defined results: ids are those of the tokenizer as its file loads, without the
special tokens it puts around a text: added tokens written in a text are
recognised.  Null text counts as empty and yields the end id alone; null
ids come last; rows of one id are ordered by a digest of the text; repeated rows
are all written.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from claimlens.llm.common import keyed, shared_path
from claimlens.llm.words import chunks

END_ID = 1
STRIPE_BYTES, INDEX_ROWS, BLOOM_FPP = 16 << 20, 1000, 0.01
#: A Python worker remembers the ids of about twice so many distinct words, from task to task.
CACHE_WORDS, CACHE_BYTES = 1 << 18, 32 << 20
#: Plain words that are encoded in one call.
JOINED = 256
#: Marks that end a word's run of letters whatever precedes or follows: ASCII
#: punctuation but the apostrophe, which the tokenizer joins to some letters.
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
STORED = "doc_id long, n_tokens long, task int, start_in_task long, ids array<int>"
TOTALS = "task int, start long"


class WordEncoder:
    """Ids of white-space separated words, as little-endian unsigned 32 bits.

    The tokenizer's normaliser and splitter never join across ASCII white space
    (it is dropped), so a text's ids are its words' ids in a row.  Nor do they
    join an ASCII letter and the ``MARKS`` after it, and they fold the case of
    ASCII words, so such words share the ids of what is left, their *core*; only
    cores and rows of marks are kept, and Arrow puts words together.  Words that hold the
text of an added token in any case (``<|endoftext|>``) go to it whole, as they
are, and it recognises the token; that text must be without white space.  Known ids are
    kept in two generations: a full one becomes the older, the older goes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        # bytes.lower() and this flag fold the case of ASCII letters alone
        self.holds_added = re.compile(b"|".join(map(re.escape, self.added)) or b"(?!)", re.IGNORECASE).search
        self.added_letters = any(token.isalpha() or not token.isascii() for token in self.added)
        self.keeps_lower = _keeps_lower(self.tokenizer.normalizer)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.is_end[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.known_bytes = 0

    def encode(self, docs: list[list[bytes]]) -> list[bytes]:
        """Ids of each document's words in a row."""
        words = list(set().union(*docs))
        ids = dict(zip(words, self.words(words)))
        return [b"".join(map(ids.__getitem__, doc)) for doc in docs]

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word."""
        return [] if not words else self.column(_as_text(pa.array(words, pa.large_binary()))).to_pylist()

    def column(self, words: pa.Array) -> pa.Array:
        """Ids of each word of an Arrow column (large_string, without nulls); what
        is Python's own work is done once for all words that share a core."""
        core = pc.ascii_rtrim(words, characters=MARKS.decode())
        core = pc.if_else(_ends_in_letter(core), core, words)
        size, whole = pc.binary_length(core), pc.binary_length(words)
        folded = pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core)
        marked = np.flatnonzero(np.asarray(pc.not_equal(size, whole)))
        texts = _bytes_of(words)[0]
        if self.holds_added(texts.tobytes()):               # whole, as they are
            holds = [self.holds_added(word) is not None for word in _listed(words)]
            folded = pc.if_else(pa.array(holds, pa.bool_()), words, folded)
            marked = marked[~np.array(holds, bool)[marked]]
        cores = folded.dictionary_encode()
        marks = pa.array([], pa.large_string()).dictionary_encode()
        if len(marked):
            at = pa.array(marked)
            offsets, cut = _bytes_of(words)[1], np.asarray(size)[marked]
            starts, ends = offsets[marked] + cut, offsets[marked + 1]
            marks = _slices(texts, starts - offsets[0], ends - offsets[0]).dictionary_encode()
        ids = self._ids(_listed(cores.dictionary) + _listed(marks.dictionary))
        packed = pa.array(ids, pa.large_binary())
        out = packed.take(cores.indices)
        if len(marked):
            both = pc.binary_join_element_wise(out.take(at), packed.slice(len(cores.dictionary)).take(marks.indices), pa.scalar(b"", pa.large_binary()))
            where = np.arange(len(words))
            where[marked] = len(words) + np.arange(len(marked))
            out = pa.concat_arrays([out, both]).take(pa.array(where))
        return out

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each core or row of marks."""
        if len(self.known) > CACHE_WORDS or self.known_bytes > CACHE_BYTES:
            self.older, self.known, self.known_bytes = self.known, {}, 0
        missing = list(dict.fromkeys(filterfalse(self.known.__contains__, words)))
        back = list(filter(self.older.__contains__, missing))
        self.known.update(zip(back, map(self.older.__getitem__, back)))
        self._encode_new(list(filterfalse(self.older.__contains__, missing)))
        self.known_bytes += sum(map(len, missing))
        return list(map(self.known.__getitem__, words))

    def _encode_new(self, words: list[bytes]) -> None:
        """Words of letters alone are one run each, so a row of them is encoded
        at once and cut at the ids that end a word; the count proves the cuts."""
        single = list(filter(self.holds_added, words)) if self.added_letters else []      # else letters hold no mark
        words = list(filterfalse(self.holds_added, words)) if single else words
        lower = [word for word in filter(bytes.isalpha, words) if word.islower()] if self.keeps_lower else []
        other = filterfalse(set(lower).__contains__, words)
        single, plain = [(word, word.decode("utf-8", "replace")) for word in single], []
        for word in other:
            text = word.decode("utf-8", "replace")
            if text.isalpha():
                plain.append(word)
            else:
                single.append((word, text))
        single += self._encode_rows(plain)
        normalizer = self.tokenizer.normalizer
        try:
            if lower:
                self.tokenizer.normalizer = None            # it would change nothing
            alone = self._encode_rows(lower)
        finally:
            self.tokenizer.normalizer = normalizer
        single += alone
        for at in range(0, len(single), 4096):
            part = single[at:at + 4096]
            for (word, _), got in zip(part, self.tokenizer.encode_batch_fast([x for _, x in part], add_special_tokens=False)):
                self.known[word] = np.array(got.ids, "<u4").tobytes()

    def _encode_rows(self, words: list[bytes]) -> list[tuple[bytes, str]]:
        """Words of letters, many in one call; those whose cuts are not proved."""
        left = []
        for at in range(0, len(words), 16 * JOINED):
            rows = [words[i:i + JOINED] for i in range(at, min(at + 16 * JOINED, len(words)), JOINED)]
            joined = [b" ".join(row).decode("utf-8", "replace") for row in rows]
            for row, got in zip(rows, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
                ids = np.array(got.ids, "<u4")
                ends = ((np.flatnonzero(self.is_end[ids]) + 1) * 4).tolist()
                if len(ends) != len(row):
                    left.extend((word, word.decode("utf-8", "replace")) for word in row)
                    continue
                data = ids.tobytes()
                self.known.update(zip(row, map(data.__getitem__, map(slice, [0, *ends], ends))))
        return left


def _keeps_lower(normalizer) -> bool:
    """Whether a tokenizer's normaliser is known to leave words of ASCII lower-case
    letters, with single spaces between them, as they are."""
    if normalizer is None:
        return False                                        # nothing to leave out
    state = json.loads(normalizer.__getstate__())
    steps = state["normalizers"] if state["type"] == "Sequence" else [state]
    space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    return all(step == space or step["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") for step in steps)


@lru_cache(1)
def _encoder(path: str) -> WordEncoder:
    """One per Python worker, which tasks use one after the other."""
    return WordEncoder(path)


def _as_text(words: pa.Array) -> pa.Array:
    """A large_binary column as large_string, bytes as they are."""
    return pa.LargeStringArray.from_buffers(len(words), words.buffers()[1], words.buffers()[2], offset=words.offset)


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes in a row, and where each begins in the column's buffer."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8), at


def _ends_in_letter(words: pa.Array) -> pa.Array:
    """Whether each word ends in an ASCII letter."""
    data, at = _bytes_of(words)
    last = data[np.maximum(at[1:] - at[0], 1) - 1] | 32 if len(data) else np.zeros(len(words), np.uint8)
    return pa.array((at[1:] > at[:-1]) & (last >= ord("a")) & (last <= ord("z")))


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices of ``data``, as a large_string column."""
    done = np.r_[0, np.cumsum(ends - starts)]
    taken = data[np.repeat(starts - done[:-1], ends - starts) + np.arange(done[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(done.astype(np.int64)), pa.py_buffer(taken))


def _listed(words: pa.Array) -> list[bytes]:
    """The words, which hold no space, as one string that is cut at its spaces:
    Arrow makes a list's objects one at a time, far slower."""
    if not len(words):
        return []
    row = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words.cast(pa.large_binary()))
    return pc.binary_join(row, pa.scalar(b" ", pa.large_binary()))[0].as_py().split(b" ")


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _encoder(path), 0
        for batch in chunks(batches, "text"):
            # Words as numbers of a chunk's distinct ones; splitting may give "", which has no ids.
            split = pc.ascii_split_whitespace(batch.column("text").cast(pa.large_string()))
            words = split.flatten().dictionary_encode()
            _, offsets, flat = encoder.column(words.dictionary).take(words.indices).buffers()
            done = np.frombuffer(offsets, np.int64, len(words) + 1) // 4
            flat = np.frombuffer(flat, "<i4", int(done[-1])) if done[-1] else np.zeros(0, "<i4")
            bounds = done[np.asarray(split.offsets) - split.offsets[0].as_py()]
            sizes = np.diff(bounds) + 1
            ends = np.cumsum(sizes)
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(np.insert(flat, bounds[1:], end_id).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), batch.column("task"), pa.array(before + ends - sizes), ids],
                                             names=["doc_id", "n_tokens", "task", "start_in_task", "ids"])
            before += int(ends[-1])
    return run


def write_token_files(df: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> str:
    """Encode ``df`` (doc_id, text) with the tokenizer file at ``tokenizer`` (a
    path that every executor has) and write ORC files to ``path``/ids, and the
    first id's place of each writing task to ``path``/starts."""
    docs = keyed(df)
    dealt = docs.repartitionByRange("key", "part").sortWithinPartitions("key", "part")
    rows = dealt.select("doc_id", "text", F.spark_partition_id().alias("task")).mapInArrow(_encode(tokenizer, end_id), STORED)
    (rows.write.format("orc").mode("errorifexists").option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES)
         .option("orc.row.index.stride", INDEX_ROWS).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_FPP)
         .save(f"{path}/ids"))
    written = df.sparkSession.read.schema(STORED).orc(f"{path}/ids")
    tasks = written.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    tasks.select("task", F.coalesce(before, F.lit(0)).alias("start")).write.orc(f"{path}/starts")
    return path


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat, at = np.asarray(ids.values).astype("<u4", copy=False), np.asarray(ids.offsets)
        sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all files, start counted over all.  The
    broadcast has 12 bytes per task that wrote."""
    rows, starts = spark.read.schema(STORED).orc(f"{path}/ids"), spark.read.schema(TOTALS).orc(f"{path}/starts")
    return rows.join(F.broadcast(starts), "task").select("doc_id", (F.col("start") + F.col("start_in_task")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """One document's ids; the filter reaches the ORC reader's indexes."""
    return read_token_files(spark, path).where(F.col("doc_id") == doc_id)


def token_digests(df: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write, read back, and give each document's place and checksum."""
    spark = df.sparkSession
    rows = read_token_files(spark, write_token_files(df, shared_path(spark, "token-ids"), tokenizer, end_id))
    return rows.mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
