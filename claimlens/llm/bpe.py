"""Byte-level BPE by monoid tree reduction (operator 6).

Each match of the splitting pattern is encoded on its own: a short one by the
merges, a longer one as two halves whose token lists are then joined.  A join
encodes the bytes of a window around the seam again, and the window grows until
both its edges are *stable*: the two tokens that meet there stay apart when
encoded together.  A token list is the encoding of its bytes exactly when each
two neighbours stay apart, so the tokens outside the window are then proved
right.  Joining is associative with the empty list as unit (a monoid), so the
tree's shape does not matter.  Decoding concatenates up the same tree.

A match that is a token itself is that token, as in the library.  Texts are cut at
white space as the pattern does.  Pieces that a Python worker does not know are
encoded together, the leaves of a batch by the merges of all of them at once, in
numpy; their ids are remembered from task to task, packed, in two generations: a
full one becomes the older, the older goes.

Defined results: null text counts as empty, which has no ids; repeated rows and
null ids yield a row each; the ids of no special token ever occur.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from claimlens.llm.common import keyed, small_batches
from claimlens.llm.words import chunks, texts

#: Bytes that are encoded by the merges alone, and ids that are decoded at once;
#: more are halved.
LEAF, LEAF_IDS = 16, 256
#: Pieces, and their bytes of text and ids, that a generation holds.
CACHE_PIECES, CACHE_BYTES = 1 << 16, 8 << 20
#: Leaves whose merges are done at once, and text bytes whose new pieces are encoded together.
ROWS, TEXT_BYTES = 1 << 13, 1 << 19
_NONE = 1 << 62
#: Unicode white space, which the pattern's \s stands for.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern.replace(r"[^\s\p", rf"[^{SPACE}\p").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        self.coarse = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.one_word = pattern.startswith("'") and r"| ?\p{L}+|" in pattern         # letters alone are one match
        self.apart = lru_cache(1 << 18)(lambda a, b: self.merge(a + b) == [a, b])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_bytes = 0
        # Tokens as their places in the order of ranks: a pair's first place and second
        # in one number, and its join's place; the pairs of bytes in a table as well.
        self.ids = np.array(sorted(self.bytes_of), np.int64)
        tokens = [self.bytes_of[i] for i in self.ids.tolist()]
        place = {token: at for at, token in enumerate(tokens)}
        found = (x for at, token in enumerate(tokens) for i in range(1, len(token))
                 if (a := place.get(token[:i])) is not None and (b := place.get(token[i:])) is not None for x in (a << 32 | b, at))
        pairs = np.fromiter(found, np.int64).reshape(-1, 2)
        self.pairs, self.joins = pairs[np.argsort(pairs[:, 0])].T.copy()
        self.bytes_at = np.array([place.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.few = np.fromiter((place.get(bytes([a, b]), _NONE) for a in range(256) for b in range(256)), np.int64, 1 << 16).reshape(256, 256)
        self.decimals = pa.array([b"%d," % i for i in self.ids.tolist()], pa.large_binary())

    def merge_few(self, data: bytes) -> list[bytes]:
        """``merge`` for a few bytes: the ranks of all neighbours in a list."""
        rank = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [rank(data[i:i + 2], _NONE) for i in range(len(data) - 1)]
        while ranks and (low := min(ranks)) < _NONE:
            i = ranks.index(low)
            parts[i] += parts[i + 1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], _NONE)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], _NONE)
        return parts

    def merge(self, data: bytes) -> list[bytes]:
        """Join the neighbours of lowest rank, the leftmost first, until none is
        known.  A heap of the known neighbours; an entry whose parts have
        changed since is skipped."""
        n, ranks = len(data), self.ranks
        parts: list[bytes | None] = [data[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, 2) for i in range(n - 1) if (rank := ranks.get(data[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[i] < n:
                before[after[i]] = i
                new = parts[i] + parts[after[i]]
                if (rank := ranks.get(new)) is not None:
                    heappush(heap, (rank, i, len(new)))
            if before[i] >= 0:
                new = parts[before[i]] + parts[i]
                if (rank := ranks.get(new)) is not None:
                    heappush(heap, (rank, before[i], len(new)))
        return [x for x in parts if x is not None]

    def tree(self, data: bytes, leaves: dict[bytes, list[bytes]] | None = None) -> list[bytes]:
        """Tokens of ``data``: halves, joined; ``leaves`` has those of leaves
        that are encoded already."""
        if len(data) <= LEAF:
            return self.merge_few(data) if leaves is None else leaves[data]
        half = len(data) // 2
        return self.join(self.tree(data[:half], leaves), self.tree(data[half:], leaves))

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of two encoded strings' concatenation."""
        if not left or not right or self.apart(left[-1], right[0]):
            return left + right
        a, b = min(2, len(left)), min(2, len(right))
        while True:
            window = self.merge(b"".join(left[len(left) - a:] + right[:b]))
            left_ok = a == len(left) or self.apart(left[-a - 1], window[0])
            right_ok = b == len(right) or self.apart(window[-1], right[b])
            if left_ok and right_ok:
                return left[:len(left) - a] + window + right[b:]
            a, b = (a if left_ok else min(2 * a, len(left))), (b if right_ok else min(2 * b, len(right)))

    def merge_all(self, leaves: list[bytes]) -> list[list[bytes]]:
        """``merge_few`` of each."""
        out: list[list[bytes]] = [[]] * len(leaves)
        for places, at in self._merged(leaves):
            for i, row in zip(at.tolist(), self.ids[places].tolist()):
                out[i] = list(map(self.bytes_of.__getitem__, row))
        return out

    def _merged(self, leaves: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tokens of leaves of ``LEAF`` bytes at most, as places: arrays of one row
        a leaf, those of equal numbers of tokens together, and their indexes.

        A round joins, in each row that still has known neighbours, those of
        lowest rank, the leftmost first."""
        sizes = np.fromiter(map(len, leaves), np.int64, len(leaves))
        for at in np.array_split(np.argsort(sizes, kind="stable"), len(leaves) // ROWS + 1):
            if not (width := int(sizes[at].max(initial=0))):
                continue
            data = np.frombuffer(b"".join(leaves[i].ljust(width, b"\0") for i in at.tolist()), np.uint8).reshape(-1, width)
            left, parts, columns = sizes[at], self.bytes_at[data], np.arange(width - 1)
            if (parts[np.arange(width) < left[:, None]] < 0).any():
                raise ValueError("the ranks lack a single byte of a text")
            ranks = np.where(columns < left[:, None] - 1, self.few[data[:, :-1], data[:, 1:]], _NONE)
            while len(at):
                i = ranks.argmin(1) if width > 1 else left - 1
                low = ranks[np.arange(len(at)), i] if width > 1 else np.full(len(at), _NONE)
                if (done := low == _NONE).any():
                    for n in np.unique(left[done]).tolist():
                        if n:
                            here = done & (left == n)
                            yield parts[here, :n], at[here]
                    go = ~done
                    at, left, parts, ranks, i, low = at[go], left[go], parts[go], ranks[go], i[go], low[go]
                rows, after = np.arange(len(at)), columns >= i[:, None]
                parts[:, 1:][after] = np.c_[parts[:, 2:], parts[:, -1:]][after]
                parts[rows, i] = low
                ranks[after] = np.c_[ranks[:, 1:], np.full(len(at), _NONE)][after]
                left -= 1
                for ok, first in ((i > 0, i - 1), (i < left - 1, i)):
                    r, c = rows[ok], first[ok]
                    ranks[r, c] = self._rank(parts[r, c], parts[r, c + 1])

    def _rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Places of the tokens that pairs join to, or ``_NONE``."""
        if not len(self.pairs):
            return np.full(len(first), _NONE)
        want = first << 32 | second
        at = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
        return np.where(self.pairs[at] == want, self.joins[at], _NONE)

    def _halves(self, data: bytes) -> Iterator[bytes]:
        """The leaves of ``tree``, from left to right."""
        if len(data) <= LEAF:
            yield data
        else:
            yield from self._halves(data[:len(data) // 2])
            yield from self._halves(data[len(data) // 2:])

    def learn(self, pieces: set[str]) -> None:
        """Make known the ids of what lies between two cuts at white space."""
        if len(self.known) > CACHE_PIECES or self.known_bytes > CACHE_BYTES:
            self.older, self.known, self.known_bytes = self.known, {}, 0
        several = {}
        for piece in (single := self._unknown(pieces)):
            if self.one_word and piece.removeprefix(" ").isalpha():
                continue
            matches = self.split.findall(piece)
            if matches != [piece]:
                several[piece] = matches
        new = [x for x in single if x not in several]
        new += self._unknown(set(chain.from_iterable(several.values())).difference(new))
        self._encode_new(new)
        find = self.known.__getitem__
        for piece, matches in several.items():
            self._keep(piece, b"".join(map(find, matches)))

    def _keep(self, piece: str, places: bytes) -> None:
        self.known[piece] = places
        self.known_bytes += len(piece) + len(places)

    def _unknown(self, pieces: set[str]) -> list[str]:
        """Pieces of neither generation; the older one's become known again."""
        left = []
        for piece in pieces.difference(self.known):
            places = self.older.get(piece)
            if places is None:
                left.append(piece)
            else:
                self._keep(piece, places)
        return left

    def _encode_new(self, matches: list[str]) -> None:
        """Matches of the pattern: the short ones' merges, and those of the longer
        ones' leaves, in batches."""
        short, long = [], []
        for match in matches:
            data = match.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self._keep(match, self._pack([whole]))
            else:
                (short if len(data) <= LEAF else long).append((match, data))
        for places, at in self._merged([data for _, data in short]):
            packed, size = places.astype("<i4").tobytes(), 4 * places.shape[1]
            for n, i in enumerate(at.tolist()):
                self._keep(short[i][0], packed[n * size:(n + 1) * size])
        group, leaves = [], 0
        for match, data in long:
            group.append((match, data))
            leaves += len(data) // LEAF
            if leaves > ROWS:
                self._encode_long(group)
                group, leaves = [], 0
        self._encode_long(group)

    def _encode_long(self, group: list[tuple[str, bytes]]) -> None:
        leaves = list({leaf for _, data in group for leaf in self._halves(data)})
        tokens = dict(zip(leaves, self.merge_all(leaves)))
        for match, data in group:
            self._keep(match, self._pack([self.ranks[token] for token in self.tree(data, tokens)]))

    def _pack(self, ids: list[int]) -> bytes:
        return np.searchsorted(self.ids, ids).astype("<i4").tobytes()

    def places(self, texts: list[str]) -> list[bytes]:
        """Each text's tokens, as places in the order of ranks in 32 bits each."""
        split = list(map(self.coarse.findall, texts))
        self.learn(set().union(*split))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def encode(self, text: str) -> list[int]:
        return self.ids[np.frombuffer(self.places([text])[0], "<i4")].tolist()

    def decode(self, ids: list[int]) -> bytes:
        """Halves, decoded and concatenated."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(1)
def _worker(path: str, pattern: str) -> Bpe:
    """One per Python worker, which tasks use one after the other."""
    return Bpe(read_ranks(path), pattern)


def _run(path: str, pattern: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker(path, pattern)
        for batch in chunks(batches, "text", TEXT_BYTES):
            packed = bpe.places([text.decode() for text in texts(batch.column("text"))])
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            places = np.frombuffer(b"".join(packed), "<i4")
            ends = np.r_[0, np.cumsum(sizes)]
            # each id with its comma, all in a row; a text's last comma is left out
            _, offsets, decimals = bpe.decimals.take(pa.array(places)).buffers()
            cuts, decimals = np.frombuffer(offsets, np.int64)[ends], memoryview(decimals or b"")
            of_ids = [hashlib.sha256(decimals[a:max(a, b - 1)]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            ids = bpe.ids[places]
            of_bytes = [hashlib.sha256(bpe.decode(ids[a:b].tolist())).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            columns = [batch.column("doc_id"), pa.array(sizes), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if whole:
                columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def encoded(df: DataFrame, ranks_path: str, pattern: str, ids: bool = False) -> DataFrame:
    """One row per row: doc_id, n_tokens, ids_sha256 (of the decimal ids joined
    by commas), decoded_sha256 (of the bytes that the ids decode to), and with
    ``ids`` the ids themselves.  ``ranks_path`` must exist on every executor."""
    small_batches(df.sparkSession)
    return keyed(df).select("doc_id", "text").mapInArrow(_run(ranks_path, pattern, ids), RESULT + ", ids array<int>" * ids)
