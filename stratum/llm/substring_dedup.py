"""Substring dedup with a count-min prefilter (operator 2).

First pass: every task counts its word windows in partition sketches, which are
merged cell by cell. Second pass: only windows whose merged count is two or more are
grouped, exactly, by a 128-bit key; all but the earliest of a group are removed. The
sketch never underestimates, so no repeated window is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import arrow_text as at

WINDOW = 20
#: Cells of a sketch row. Two rows of one bit a cell reach every task: 2 * 2**28 / 8 = 64 MB, whatever the input.
LOG2_CELLS = 28
LOG2_BLOCK = 22
CHUNK = 2_000_000
#: Multipliers that pick a window's cell in each sketch row.
ROW_KEYS = (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)


class Windows:
    """Windows of a task's rows, handed out in chunks of about ``CHUNK``."""

    def __init__(self, width: int, keys: int):
        self.width, self.keys, self.n = width, keys, 0
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, ids: np.ndarray, text: pa.Array) -> None:
        offsets, words = at.split_words(text)
        place, row, position = at.inside(offsets, self.width)
        if len(place) == 0:
            return
        hashed = [at.window_hashes(h, self.width)[place] for h in at.word_hashes(words, at.KEYS[:self.keys])]
        self.parts.append((*hashed, ids[row], position))
        self.n += len(place)

    def take(self) -> tuple[np.ndarray, ...]:
        out = tuple(np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.n = [], 0
        return out


def chunks(batches: Iterator[pa.RecordBatch], width: int, keys: int) -> Iterator[tuple[np.ndarray, ...]]:
    held = Windows(width, keys)
    for batch in batches:
        for part in at.slices(batch, 1):
            held.add(part.column(0).to_numpy(zero_copy_only=False), part.column(1))
            if held.n >= CHUNK:
                yield held.take()
    if held.n:
        yield held.take()


def cells(hashes: np.ndarray, key: int, log2_cells: int) -> np.ndarray:
    return (hashes * np.uint64(key)) >> np.uint64(64 - log2_cells)


def partition_sketch(hashes: np.ndarray, log2_cells: int, keys: tuple[int, ...] = ROW_KEYS) -> Iterator[tuple[int, bytes]]:
    """(block, cells) of all sketch rows: sorted cells, twice where counted twice or more, as differences."""
    log2_block = min(LOG2_BLOCK, log2_cells)
    for row, key in enumerate(keys):
        c = np.sort(cells(hashes, key, log2_cells).astype(np.uint32))
        if len(c) > 2:  # more than two of a cell say nothing more
            c = c[np.concatenate([[True, True], c[2:] != c[:-2]])]
        cuts = np.searchsorted(c, np.arange(0, (1 << log2_cells) + 1, 1 << log2_block, dtype=np.int64))
        for b in range(len(cuts) - 1):
            own = c[cuts[b]:cuts[b + 1]]
            if len(own):
                delta = np.diff(own - np.uint32(b << log2_block), prepend=np.uint32(0))
                planes = delta.view(np.uint8).reshape(-1, 4).T.tobytes()
                yield (row << (log2_cells - log2_block)) + b, zstandard.ZstdCompressor(level=1).compress(planes)


def merge_sketches(batches: Iterator[pa.RecordBatch], log2_cells: int, least: int = 0) -> Iterator[tuple[int, bytes, bytes]]:
    """(block, bitmap, bitmap) with a bit for each cell counted twice or more over all tasks, and for those
    counted ``least`` times (a chunk counts two at most). Holds a byte a cell
    of the blocks of this partition, however many partition sketches stream by."""
    size = 1 << min(LOG2_BLOCK, log2_cells)
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
            delta = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).reshape(-1)
            c = np.cumsum(delta, dtype=np.uint32)
            total = counts.setdefault(block, np.zeros(size, np.uint8))
            again = c[1:][c[1:] == c[:-1]]
            once = c[np.concatenate([[True], c[1:] != c[:-1]])]
            total[once] = np.minimum(total[once], 253) + 1
            total[again] += 1
    for block, total in counts.items():
        yield (block, np.packbits(total >= 2, bitorder="little").tobytes(),
               np.packbits(total >= least, bitorder="little").tobytes() if least else b"")


def estimated_repeated(hashes: np.ndarray, bitmap: np.ndarray, log2_cells: int) -> np.ndarray:
    """Whether the smallest of a window's counters is two or more."""
    out = np.ones(len(hashes), bool)
    for row in range(len(ROW_KEYS)):
        c = cells(hashes, ROW_KEYS[row], log2_cells).astype(np.int64) + (row << log2_cells)
        out &= (bitmap[c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
    return out


def split_first(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows sorted by (h1, h2, doc, pos); first marks the earliest place of each key.

    Rows of one place (a repeated row of the table) are all first."""
    order = np.lexsort((pos, doc, h2, h1))
    a, b, d, p = h1[order], h2[order], doc[order], pos[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order, (d == d[head]) & (p == p[head])


def packed_runs(doc: np.ndarray, pos: np.ndarray, n_docs: int) -> Iterator[tuple[int, bytes]]:
    """(document bucket, runs of removed window starts)."""
    order = np.lexsort((pos, doc))
    d, s, n = at.runs(doc[order], pos[order])
    bucket = np.mod(d, n_docs)
    by = np.argsort(bucket, kind="stable")
    for lo, hi in at.groups(bucket[by]):
        own = by[lo:hi]
        yield int(bucket[by[lo]]), at.pack(d[own], s[own], n[own])


def merge_packed(parts: list[bytes]) -> bytes:
    return at.pack(*(np.concatenate(x) for x in zip(*[at.unpack(d, 3) for d in parts], strict=True)))


Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # doc_id ascending, first start, number of starts


def sorted_runs(parts: list[bytes]) -> Runs:
    doc, start, count = (np.concatenate(x) for x in zip(*(at.unpack(d, 3) for d in parts), strict=True)) if parts else (np.zeros(0, np.int64),) * 3
    order = np.argsort(doc, kind="stable")
    return doc[order], start[order], count[order]


def runs_of(runs: Runs, doc_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(first start, number of starts) of one document's runs; none without an id."""
    doc, start, count = runs
    lo, hi = np.searchsorted(doc, [doc_id, doc_id + 1]) if doc_id is not None else (0, 0)
    return start[lo:hi], count[lo:hi]


def uncovered(size: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each of ``size`` items lies outside of all stretches."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth[:size]) == 0


def cut_in_stream(texts: DataFrame, gone: DataFrame, cut: Callable[[Runs, pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``cut(runs, rows)`` of all ``texts`` (bucket, doc_id, text), with the runs of their bucket in ``gone`` (bucket, runs).

    One exchange by bucket, sorted so that a bucket's runs come before its texts. A task holds the runs of one bucket and the texts of
    one slice of a batch, however many documents a bucket has."""
    kind, text = texts.schema[2].dataType, texts.columns[2]
    rows = texts.select("bucket", F.lit(1).alias("kind"), "doc_id", text, F.lit(None).cast("binary").alias("runs")).union(
        gone.select("bucket", F.lit(0), F.lit(None).cast("long"), F.lit(None).cast(kind), "runs"))

    def stream(batches):
        current, parts, runs = None, [], None
        for batch in batches:
            for part in at.slices(batch, 3):
                for lo, hi in at.groups(part.column(0).to_numpy()):
                    own = part.slice(lo, hi - lo)
                    if own.column(0)[0].as_py() != current:
                        current, parts, runs = own.column(0)[0].as_py(), [], None
                    n_runs = int(np.searchsorted(own.column(1).to_numpy(), 1))
                    parts += own.column(4)[:n_runs].to_pylist()
                    if n_runs < len(own.column(0)):
                        if runs is None:  # all of them came before
                            runs, parts = sorted_runs(parts), []
                        left = own.slice(n_runs)
                        yield cut(runs, pa.RecordBatch.from_arrays([left.column(2), left.column(3)], names=["doc_id", "text"]))

    return rows.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(stream, schema)


def dedup(docs: DataFrame, width: int = WINDOW, log2_cells: int = LOG2_CELLS, buckets: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every row.

    A word goes when a window of ``width`` words covers it whose words also start earlier:
    in a smaller doc_id, or earlier in the same document. Null, empty and shorter texts lose nothing. Rows
    with a null doc_id have no place in the order: they are returned whole and make no other row lose words.
    Repeated rows (same doc_id and text) are one document, returned as often as they come. An empty table gives no rows. Other
    columns are left out.

    Scale: three exchanges. Sketch blocks are sorted, saturated cell lists; merged, they are
    bitmaps of a fixed size, collected (64 MB by default) and broadcast. Beyond about 2**28 distinct windows the bitmaps let more
    unique windows through – more bytes in the second exchange, never another result; ``log2_cells``
    raises the bound. Candidates are first reduced within a chunk of a task (a window that a third of all
    rows hold leaves one place a chunk, the others are known to go), then grouped in buckets of the
    key's hash, which no frequent window can make uneven. Removed places travel as runs and meet the texts
    in buckets of doc_id, as a stream: a task holds a bucket's runs and a slice of its texts. ``buckets`` (default: the shuffle
    partitions) is the number of document buckets; there are twice as many key buckets, so packed rows between the two are no more than a shuffle has blocks.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = at.next_prime(buckets or partitions)
    n_keys = 2 * n
    log2_cells = max(3, log2_cells)  # a block is a byte at least
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    placed = slim.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())

    def sketch(batches):
        for (h1, *_) in chunks(batches, width, 1):
            out = list(partition_sketch(h1, log2_cells))
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()),
                                              pa.array([c for _, c in out], pa.binary())], names=["block", "cells"])

    def merge(batches):
        for block, bits, _ in merge_sketches(batches, log2_cells):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary())],
                                             names=["block", "bits"])

    merged = placed.mapInArrow(sketch, "block int, cells binary").repartition(partitions, "block").mapInArrow(
        merge, "block int, bits binary")
    block_bytes = (1 << min(LOG2_BLOCK, log2_cells)) // 8
    bitmap = bytearray(len(ROW_KEYS) << (log2_cells - 3))
    for row in merged.toLocalIterator():
        bitmap[row.block * block_bytes:(row.block + 1) * block_bytes] = row.bits
    shared = spark.sparkContext.broadcast(bytes(bitmap))
    del bitmap

    def candidates(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for h1, h2, doc, pos in chunks(batches, width, 2):
            keep = estimated_repeated(h1, bits, log2_cells)
            h1, h2, doc, pos = h1[keep], h2[keep], doc[keep], pos[keep]
            order, first = split_first(h1, h2, doc, pos)
            gone = order[~first]
            here = order[first]  # sorted by h1, so by bucket
            bucket = (at.mix(h1[here]) % np.uint64(n_keys)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            keys, data, kind = [], [], []
            for lo, hi in at.groups(bucket[by]):
                own = here[by[lo:hi]]
                keys.append(int(bucket[by[lo]]))
                data.append(at.pack(h1[own].view(np.int64), h2[own].view(np.int64), doc[own], pos[own]))
                kind.append(0)
            for k, d in packed_runs(doc[gone], pos[gone], n):
                keys.append(k)  # any key bucket will do; it passes them on
                data.append(d)
                kind.append(1)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(kind, pa.int32()),
                                              pa.array(data, pa.binary())], names=["bucket", "kind", "data"])

    def group(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        data = table.column("data").to_pylist()
        passed = [d for k, d in zip(kind, data, strict=True) if k == 1]
        out = [(table.column("bucket")[0].as_py(), merge_packed(passed))] if passed else []
        parts = [at.unpack(d, 4) for k, d in zip(kind, data, strict=True) if k == 0]
        if parts:
            h1, h2, doc, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
            order, first = split_first(h1, h2, doc, pos)
            gone = order[~first]
            out += packed_runs(doc[gone], pos[gone], n)
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int64()), "runs": pa.array([d for _, d in out], pa.binary())})

    gone = placed.mapInArrow(candidates, "bucket long, kind int, data binary").groupBy("bucket").applyInArrow(
        group, "bucket long, runs binary")

    def cut(runs, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_pylist()
        offsets, words = at.split_words(batch.column(1))
        rows = []
        for i, doc_id in enumerate(ids):
            own = words[offsets[i]:offsets[i + 1]]
            start, length = runs_of(runs, doc_id)
            size, removed = len(own), 0
            if len(start):
                keep = uncovered(size, start, length + width - 1)
                own = own.filter(pa.array(keep))
                removed = size - len(own)
            text = " ".join(own.to_pylist())
            rows.append((doc_id, size, removed, hashlib.sha256(text.encode()).hexdigest(), text))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    # null ids have no runs; they are dealt by their text
    bucket = F.coalesce(F.pmod(F.col("doc_id"), F.lit(n)), F.pmod(F.xxhash64("text"), F.lit(n))).alias("bucket")
    return cut_in_stream(slim.select(bucket, "doc_id", "text"), gone, cut,
                         "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string").withColumnRenamed("doc_id", id_col)
