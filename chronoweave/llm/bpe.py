"""Byte-level BPE: encoding and decoding by reduction of a binary tree over the text.

A text is encoded as the monoid product of its halves, down to short leaves. Neighbours are joined
by encoding a window around their boundary anew, grown on either side until what lies outside is
proved stable, so any split of a text gives the same ids:

- Between a character that is no white space and white space, the pattern always ends a match:
  no alternative of it reaches over such a place and none looks back. Ids on either side of it do
  not depend on the other side. A window between two such places is thus enough.
- Within one long match, ids t1..tn are the encoding of their bytes when each pair of neighbours
  encodes to itself. The window is grown until the pairs at both of its ends do so.

A leaf is cut into matches of the pattern, and a short match into bytes whose neighbours are merged, of all
pairs in the vocabulary the one of lowest rank first, from left to right. What matches and short bytes encode to is remembered.

Decoding concatenates the bytes of the halves up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chronoweave.llm.common import annotate

#: Characters of a leaf, bytes of a leaf within one match, ids of a leaf in decoding.
LEAF, PIECE_LEAF, ID_LEAF = 1024, 6, 4096
#: Longest text or bytes whose ids are remembered.
MEMORABLE = 32
#: Matches, and short bytes and pairs of ids, that are remembered; a memory is emptied beyond.
MOST_MATCHES, MOST_PAIRS = 300_000, 150_000
#: Bits of an id in a pair of ids.
_SHIFT = 32

#: Places that the pattern never matches across. Python's \S leaves out all white space of the
#: pattern and a few control characters more.
_STABLE = re.compile(r"(?<=\S)(?=[ \n\t\r])")


class _Memory(dict):
    """What a function gives for short keys; emptied when full. Ids are tuples, which the garbage collector soon leaves alone."""

    def __init__(self, function: Callable, most: int) -> None:
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        own = self.function(key)
        if len(key) <= MEMORABLE:
            if len(self) >= self.most:
                self.clear()
            self[key] = own
        return own


class Codec:
    """Encoder and decoder for one vocabulary of byte strings with ranks and one pattern."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF, piece_leaf: int = PIECE_LEAF) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = [self.ranks[bytes([b])] for b in range(256)]
        # The rank of each pair of ids that are one id together: all ways to cut a token in two.
        self.pair_ranks = {
            self.ranks[token[:i]] << _SHIFT | self.ranks[token[i:]]: rank
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        }
        self.leaf, self.piece_leaf = leaf, piece_leaf
        self.pattern = regex.compile(pattern)
        self.matches = _Memory(self._match, MOST_MATCHES)
        self.short = _Memory(self._merge, MOST_PAIRS)
        self.pairs = _Memory(self._stable, MOST_PAIRS)

    def encode(self, text: str) -> list[int]:
        middle = len(text) // 2
        if len(text) <= self.leaf or _STABLE.search(text) is None:
            return self._unbroken(text)
        return self._join(text, middle, self.encode(text[:middle]), self.encode(text[middle:]))

    def _join(self, text: str, middle: int, left: list[int], right: list[int]) -> list[int]:
        width = 16
        while True:
            low, high = max(0, middle - width), min(len(text), middle + width)
            start = max((m.start() for m in _STABLE.finditer(text, low, min(middle + 1, len(text)))), default=0 if low == 0 else None)
            end = next((m.start() for m in _STABLE.finditer(text, middle, high)), len(text) if high == len(text) else None)
            if start is not None and end is not None:
                break
            width *= 2
        if start < end:
            self._drop(left, -1, len(text[start:middle].encode()))
            rest = self._drop(right, 0, len(text[middle:end].encode()))
            window = text[start:end]
            left += self._unbroken(window)
            right = right[rest:]
        left += right
        return left

    def _drop(self, ids: list[int], side: int, size: int) -> int:
        """Takes ids of `size` bytes off the end of ids, or counts those at its start."""
        n = 0
        while size > 0:
            size -= len(self.bytes_of[ids.pop() if side else ids[n]])
            n += 1
        return n

    def _unbroken(self, text: str) -> list[int]:
        """Ids of a text, match by match."""
        return list(chain.from_iterable(map(self.matches.__getitem__, self.pattern.findall(text))))

    def _match(self, match: str | bytes) -> tuple[int, ...]:
        piece = match if isinstance(match, bytes) else match.encode()
        whole = self.ranks.get(piece)
        return (whole,) if whole is not None else self._halves(piece)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of some bytes: neighbours are merged, the pair of lowest rank and of equals the first, until none can be."""
        return self.short[piece]

    def _merge(self, piece: bytes) -> tuple[int, ...]:
        if len(piece) > MEMORABLE:
            return self._merge_window(piece)
        rank_of, none = self.pair_ranks.get, len(self.bytes_of)
        ids = list(map(self.byte_ids.__getitem__, piece))
        ranks = [rank_of(a << _SHIFT | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            ids[i] = least
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(least << _SHIFT | ids[i + 1], none)
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] << _SHIFT | least, none)
        return tuple(ids)

    def _merge_window(self, piece: bytes) -> tuple[int, ...]:
        """As _merge(), with the pairs in a heap: n log n steps."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))  # of the part that starts here; 0 where none does any more
        before = list(range(-1, n))
        heap = [(ranks[piece[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            if end[i] != middle or middle == n or end[middle] != stop:
                continue  # one of the two has been merged since
            end[i], end[middle] = stop, 0
            before[stop] = i
            if stop < n and (rank := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, stop, end[stop]))
            if i and (rank := ranks.get(piece[before[i] : stop])) is not None:
                heapq.heappush(heap, (rank, before[i], i, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        return list(self._match(piece))

    def _halves(self, piece: bytes) -> tuple[int, ...]:
        leaf, merged, stable = self.piece_leaf, self.short, self.pairs
        if len(piece) <= leaf:
            return merged[piece]
        middle = len(piece) // 2
        left, right = piece[:middle], piece[middle:]
        left = merged[left] if middle <= leaf else self._halves(left)
        right = merged[right] if len(right) <= leaf else self._halves(right)
        if stable[left[-1], right[0]]:
            return left + right
        n, m, width = len(left), len(right), 1
        while True:
            i, j = max(0, n - width), min(width, m)
            inner = merged[b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j]))]
            if (i == 0 or stable[left[i - 1], inner[0]]) and (j == m or stable[inner[-1], right[j]]):
                return left[:i] + inner + right[j:]
            width *= 2

    def _stable(self, pair: tuple[int, int]) -> bool:
        a, b = pair
        return self.short[self.bytes_of[a] + self.bytes_of[b]] == pair

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= ID_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


_codecs: dict[tuple, Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a vocabulary file, read once in each Python process."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_documents(
    docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None, text: str = "text", with_ids: bool = True
) -> DataFrame:
    """Columns `keep` of docs and, last, a struct of the text's encoding and what it decodes to.

    Its fields: n_tokens, ids_sha256 (of the ids in decimal, joined by one space), decoded_sha256
    (of the decoded bytes), and with `with_ids` the ids themselves. Null and empty texts have no
    ids; texts of any length are whole; repeated rows each have their result; an empty table gives
    an empty table; other columns are left as they are, whatever their names. The vocabulary file
    must lie at `path` on every machine.
    """

    def make() -> Callable:
        own = codec(path, pattern)
        decimal = [str(i) for i in range(len(own.bytes_of))]

        def work(texts: pa.Array) -> list[pa.Array]:
            counts, sums, decoded, offsets, flat = [], [], [], [0], []
            for value in texts:
                ids = own.encode(value.as_py() or "")
                counts.append(len(ids))
                sums.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
                if with_ids:
                    flat.append(pa.array(ids, pa.int32()))
                    offsets.append(offsets[-1] + len(ids))
            found = [pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                whole = pa.concat_arrays(flat) if flat else pa.array([], pa.int32())
                found.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), whole))
            return found

        return work

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return annotate(docs, fields, make, [text], keep)
