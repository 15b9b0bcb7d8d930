"""Repeated word sequences across and within documents, found from fixed-block anchors.

Documents are dealt into chunks, each a range of ids, so that an earlier chunk holds earlier
documents only. A chunk's non-overlapping blocks of half a window are the index; its rolling
windows of the same length are the probes. Every repeated window holds a whole block of either
of its places, so a window none of whose probes meets a block elsewhere is not repeated. Index
and probes meet in buckets of their hashes, each chunk sending a hash once however often it
occurs, so a passage of a third of all documents costs a bucket one entry for each chunk. Around
the hits the full windows are told apart by 96 bits of two hashes, of which each chunk again
sends each one once; the first chunk that has it keeps its first place, and all other places are
repeats. Overlapping repeats are joined to maximal ones.

A bucket's load is set by the number of buckets, which follows the size of the input. Buckets
tell chunks the outcome by hashes or by one bit for each window sent.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from chronoweave.llm.common import checkpoint, mixed, pieces, powers, quoted, word_bounds, word_hashes

#: Words in a window that counts as a repeat.
WINDOW = 20
#: Bytes of text in a chunk, and probes in a bucket.
CHUNK_BYTES, BUCKET_PROBES = 8 << 20, 4 << 20
#: Ranges of ids whose limits are looked for in the data; further chunks divide them evenly.
MOST_RANGES = 256

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_FIRST, _SECOND, _THIRD = 0xC2B2AE3D27D4EB4F | 1, 0x165667B19E3779F9 | 1, 0x27D4EB2F165667C5 | 1


def rolling(words: np.ndarray, n: int, factor: int) -> np.ndarray:
    """Hashes of all runs of n words, by joining runs of doubled lengths."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    run, length, done, total = words, 1, 0, None
    while n:
        if n & 1:
            if total is None:
                total = run
            else:
                ahead = run[done:]
                m = min(len(total), len(ahead))
                total = total[:m] * powers(factor, length + 1)[length] + ahead[:m]
            done += length
        n >>= 1
        if n:
            run = run[: len(run) - length] * powers(factor, length + 1)[length] + run[length:]
            length *= 2
    return mixed(total)


class Chunk:
    """The distinct rows of a chunk in order, their words' hashes and the windows over them."""

    def __init__(self, table: pa.Table, window: int) -> None:
        ids, texts = table.column("id").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i], texts[i] or ""))
        self.ids, self.place, self.texts = ids, [0] * len(ids), []
        last = None
        for i in order:
            key = (ids[i], texts[i] or "")
            if key != last:
                self.texts.append(key[1].encode())
                last = key
            self.place[i] = len(self.texts) - 1
        offsets = np.cumsum([0, *map(len, self.texts)])
        hashes, first = [], [np.zeros(1, np.int64)]
        for a, b in pieces(offsets, 1 << 20):
            data = np.frombuffer(b"".join(self.texts[a:b]), np.uint8)
            starts, ends, at = word_bounds(data, offsets[a : b + 1] - offsets[a], _IS_WORD)
            hashes.append(word_hashes(data, starts, ends))
            first.append(at[1:] + first[-1][-1])
        self.first = np.concatenate(first)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.window, self.block = window, (window + 1) // 2
        sizes = np.diff(self.first)
        self.start = np.repeat(self.first[:-1], sizes)
        left = np.repeat(self.first[1:], sizes) - np.arange(len(self.words))
        long_enough = np.repeat(sizes >= window, sizes)
        self.probes = np.flatnonzero((left >= self.block) & long_enough)
        self.windows = np.flatnonzero(left >= window)

    def anchors(self, bits: int) -> np.ndarray:
        """Hashes of the probes: bucket and 32 bits below it."""
        own = rolling(self.words, self.block, _FIRST)
        return own[self.probes] >> np.uint64(32 - bits)

    def candidates(self, hits: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and two hashes of the windows that hold a probe among the hits (sorted)."""
        if not len(hits):
            return self.windows[:0], np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        anchors = self.anchors(bits)
        at = np.searchsorted(hits, anchors)
        at[at == len(hits)] = 0
        met = np.zeros(len(self.words) + 1, np.int64)
        met[self.probes + 1] = hits[at] == anchors
        met = np.cumsum(met)
        inner = self.window - self.block + 1
        chosen = self.windows[met[self.windows + inner] > met[self.windows]]
        one, two = rolling(self.words, self.window, _SECOND), rolling(self.words, self.window, _THIRD)
        return chosen, one[chosen], (two[chosen] >> np.uint64(32)).astype(np.uint32)


def distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of windows by their hashes, then place, and whether each is the first of its kind."""
    order = np.lexsort((np.arange(len(one)), two, one))
    head = np.ones(len(one), bool)
    head[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    return order, head


_PACKET = "bucket int, chunk long, kind string, payload binary"


def _packets(bucket: list, chunk: list, kind: list, payload: list) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array(bucket, pa.int32()),
            "chunk": pa.array(chunk, pa.int64()),
            "kind": pa.array(kind, pa.string()),
            "payload": pa.array(payload, pa.binary()),
        }
    )


def _cuts(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, stop) of the runs of a sorted array."""
    if len(sorted_buckets):
        at = [0, *(np.flatnonzero(np.diff(sorted_buckets)) + 1).tolist(), len(sorted_buckets)]
        for a, b in zip(at, at[1:]):
            yield int(sorted_buckets[a]), a, b


def send_anchors(bits: int, window: int):
    """From a chunk's rows its distinct probes by bucket, with which of them are blocks."""

    def send(key: tuple, table: pa.Table) -> pa.Table:
        chunk = Chunk(table, window)
        anchors = chunk.anchors(bits)
        order = np.argsort(anchors, kind="stable")
        own = anchors[order]
        head = np.ones(len(own), bool)
        head[1:] = own[1:] != own[:-1]
        at = np.flatnonzero(head)
        block = ((chunk.probes - chunk.start[chunk.probes]) % chunk.block == 0)[order]
        n_blocks = np.add.reduceat(block.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        several = np.diff(np.append(at, len(own))) > 1
        keys, flags = own[at], np.minimum(n_blocks, 2) | (several.astype(np.int64) << 2)
        number, out = key[0].as_py(), ([], [], [], [])
        for bucket, a, b in _cuts((keys >> np.uint64(32)).astype(np.int64)):
            nibbles = flags[a:b].astype(np.uint8)
            nibbles = np.append(nibbles, np.zeros(len(nibbles) % 2, np.uint8)).reshape(-1, 2)
            packed = (nibbles[:, 0] | (nibbles[:, 1] << 4)).tobytes()
            payload = len(keys[a:b]).to_bytes(8, "little") + (keys[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + packed
            for column, value in zip(out, (bucket, number, "probe", payload)):
                column.append(value)
        return _packets(*out)

    return send


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(payload[:8], "little")
    packed = np.frombuffer(payload, np.uint8, offset=8 + 4 * n)
    return np.frombuffer(payload, "<u4", n, 8), np.stack([packed & 15, packed >> 4], 1).ravel()[:n]


def meet_anchors(key: tuple, table: pa.Table) -> pa.Table:
    """For each chunk the probes of a bucket that meet a block at another place."""
    chunks, payloads = table.column("chunk").to_pylist(), table.column("payload").to_pylist()
    keys, owners, counts = [], [], []
    for chunk, payload in zip(chunks, payloads):
        probes, flags = _unpacked(payload)
        is_block = (flags & 3) > 0
        keys.append(probes[is_block])
        owners.append(np.full(int(is_block.sum()), chunk, np.int64))
        counts.append((flags & 3)[is_block].astype(np.int64))
    keys, owners, counts = np.concatenate(keys), np.concatenate(owners), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(head)
    index, owner = keys[at], owners[order][at]
    total = np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)
    bucket, out = key[0].as_py(), ([], [], [], [])
    for chunk, payload in zip(chunks, payloads) if len(index) else ():
        probes, flags = _unpacked(payload)
        place = np.searchsorted(index, probes)
        place[place == len(index)] = 0
        elsewhere = (total[place] > 1) | (owner[place] != chunk) | ((flags & 4) > 0)
        hits = probes[(index[place] == probes) & elsewhere]
        if len(hits):
            for column, value in zip(out, (bucket, chunk, "hit", hits.tobytes())):
                column.append(value)
    return _packets(*out)


def _hits(table: pa.Table) -> np.ndarray:
    """The hits sent to a chunk, sorted, with their buckets."""
    sent = [
        np.frombuffer(p, "<u4").astype(np.uint64) | np.uint64(b << 32)
        for b, k, p in zip(*[table.column(c).to_pylist() for c in ("bucket", "kind", "payload")])
        if k == "hit"
    ]
    return np.sort(np.concatenate(sent)) if sent else np.zeros(0, np.uint64)


def send_windows(bits: int, window: int):
    """From a chunk's rows and hits its distinct candidate windows by bucket."""

    def send(key: tuple, rows: pa.Table, sent: pa.Table) -> pa.Table:
        hits, number, out = _hits(sent), key[0].as_py(), ([], [], [], [])
        if len(hits) and len(rows):
            _, one, two = Chunk(rows, window).candidates(hits, bits)
            order, head = distinct(one, two)
            one, two = one[order][head], two[order][head]
            for bucket, a, b in _cuts((one >> np.uint64(64 - bits)).astype(np.int64)):
                payload = (b - a).to_bytes(8, "little") + one[a:b].tobytes() + two[a:b].tobytes()
                for column, value in zip(out, (bucket, number, "window", payload)):
                    column.append(value)
        return _packets(*out)

    return send


def meet_windows(key: tuple, table: pa.Table) -> pa.Table:
    """For each chunk one bit for each window of a bucket: whether an earlier chunk has it too."""
    chunks, payloads = table.column("chunk").to_pylist(), table.column("payload").to_pylist()
    sizes = [int.from_bytes(p[:8], "little") for p in payloads]
    one = np.concatenate([np.frombuffer(p, np.uint64, n, 8) for p, n in zip(payloads, sizes)])
    two = np.concatenate([np.frombuffer(p, np.uint32, n, 8 + 8 * n) for p, n in zip(payloads, sizes)])
    chunk = np.repeat(np.array(chunks, np.int64), sizes)
    order = np.lexsort((chunk, two, one))
    later = np.zeros(len(one), bool)
    later[order[1:]] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    ends = np.cumsum([0, *sizes])
    masks = [np.packbits(later[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
    bits = [n.to_bytes(8, "little") + m for n, m in zip(sizes, masks)]
    return _packets([key[0].as_py()] * len(chunks), chunks, ["mask"] * len(chunks), bits)


def mark(bits: int, window: int, schema: pa.Schema):
    """From a chunk's rows, its hits and what became of its windows: the result of each row."""

    def result(key: tuple, rows: pa.Table, sent: pa.Table) -> pa.Table:
        chunk, hits = Chunk(rows, window), _hits(sent)
        covered = np.zeros(len(chunk.words) + 1, np.int64)
        starts, one, two = chunk.candidates(hits, bits)
        if len(starts):
            order, head = distinct(one, two)
            masks = sorted(
                (b, p) for b, k, p in zip(*[sent.column(c).to_pylist() for c in ("bucket", "kind", "payload")]) if k == "mask"
            )
            later = [np.unpackbits(np.frombuffer(p, np.uint8, offset=8))[: int.from_bytes(p[:8], "little")] for _, p in masks]
            again = ~head | np.concatenate(later).astype(bool)[np.cumsum(head) - 1]
            places = starts[order][again]
            np.add.at(covered, places, 1)
            np.add.at(covered, places + window, -1)
        gone = np.cumsum(covered)[:-1] > 0
        found = []
        for k, text in enumerate(chunk.texts):
            own, words = gone[chunk.first[k] : chunk.first[k + 1]], text.split()
            kept = [w for w, g in zip(words, own.tolist()) if not g] if own.any() else words
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))).tolist()
            line = b" ".join(kept)
            spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
            found.append((len(words), int(own.sum()), hashlib.sha256(line).hexdigest(), spans, line.decode()))
        columns = [chunk.ids, *([found[p][c] for p in chunk.place] for c in range(5))]
        named = dict(zip(("id", "n_words", "n_removed", "kept_sha256", "repeats", "kept"), columns))
        return pa.table([pa.array(named[f.name], f.type) for f in schema], schema=schema)

    return result


def in_chunks(docs: DataFrame, id: str, text: str, n_chunks: int) -> DataFrame:
    """(id, text, chunk): chunks are ranges of ids in order; rows without id come last, by text.

    Ids that are no integers are sorted, by id and text, into ranges of about as many rows each, which are
    kept in the shared folder, as the passes over them have to see the same ones.
    """
    own = docs.select(docs[quoted(id)].alias("id"), docs[quoted(text)].cast("string").alias("text"))
    if n_chunks > 1 and dict(own.dtypes)["id"] not in ("tinyint", "smallint", "int", "bigint"):
        ordered = own.repartitionByRange(n_chunks, F.col("id").isNull(), "id", "text")
        return checkpoint(ordered.withColumn("chunk", F.spark_partition_id().cast("long")))
    unnamed = F.lit(n_chunks) + F.pmod(F.xxhash64("text"), F.lit(n_chunks))
    number = F.lit(0).cast("long")
    if n_chunks > 1:
        n_ranges = min(n_chunks, MOST_RANGES)
        limits = own.agg(F.percentile_approx("id", [i / n_ranges for i in range(n_ranges + 1)], 100 * n_ranges)).first()[0]
        limits = sorted(set(limits or [0]))
        each = math.ceil(n_chunks / n_ranges)
        lows, highs = F.array(*map(F.lit, limits)), F.array(*map(F.lit, [*limits[1:], limits[-1] + 1]))
        k = F.greatest(F.size(F.filter(lows, lambda v: v <= F.col("id"))), F.lit(1))
        low, high = F.element_at(lows, k), F.element_at(highs, k)
        inner = F.floor(each * (F.col("id") - low) / F.greatest(high - low, F.lit(1))).cast("long")
        number = ((k - 1) * each + F.greatest(F.least(inner, F.lit(each - 1)), F.lit(0))).cast("long")
        unnamed = F.lit(len(limits) * each) + F.pmod(F.xxhash64("text"), F.lit(n_chunks))
    return own.withColumn("chunk", F.when(F.col("id").isNull(), unnamed).otherwise(number).cast("long"))


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_probes: int = BUCKET_PROBES,
    with_text: bool = True,
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, repeats[, kept]) for each row of docs.

    A word goes if a window of `window` words covers it whose words also start earlier: in a row of
    smaller id, or earlier in the same row. repeats are the ranges of such words, kept the others
    joined by one space. Rows of one id are ordered by text, and rows alike in both count as one
    document and have the same result. Rows without id come last. Null and empty texts have no
    words. Ids may be of any type that has an order. An empty table gives an empty one; other columns
    are not looked at.
    """
    size = docs.agg(F.sum(F.octet_length(docs[quoted(text)].cast("string")))).first()[0] or 0
    n_chunks = size // chunk_bytes + 1
    bits = max(2, math.ceil(math.log2(size / 6 / bucket_probes + 1)))
    rows = in_chunks(docs, id, text, n_chunks)
    chunks = rows.groupBy("chunk")
    probes = chunks.applyInArrow(send_anchors(bits, window), _PACKET)
    hits = probes.groupBy("bucket").applyInArrow(meet_anchors, _PACKET)
    windows = chunks.cogroup(hits.groupBy("chunk")).applyInArrow(send_windows(bits, window), _PACKET)
    masks = windows.groupBy("bucket").applyInArrow(meet_windows, _PACKET)
    told = hits.union(masks)
    id_type = rows.schema["id"].dataType.simpleString()
    fields = f"id {id_type}, n_words long, n_removed long, kept_sha256 string, repeats array<struct<start:int,end:int>>"
    fields += ", kept string" * with_text
    schema = to_arrow_schema(StructType.fromDDL(fields))
    return chunks.cogroup(told.groupBy("chunk")).applyInArrow(mark(bits, window, schema), fields)
