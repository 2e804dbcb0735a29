"""Suffix-array dedup of byte strings by deep-shallow sorting (operator 9).

A byte goes when a string of 400 bytes covers it that starts anywhere else too. The
strings are suffixes cut at 400 bytes. Equal ones hold the same anchor – the smallest
hashed piece among those that start in their first bytes – so suffixes are dealt over
tasks by anchor, in segments of consecutive starts that share one. A merged count sketch drops segments whose anchor
occurs once; of the others, digests tell whole copies. Where an anchor comes with different contents, its suffixes are sorted: multikey quicksort to a
shallow depth, then blind tries for groups that are still equal; neighbours equal to the full length are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import arrow_text as at
from stratum.llm.substring_dedup import LOG2_BLOCK, cut_in_stream, merge_packed, merge_sketches, packed_runs, partition_sketch, runs_of, uncovered
from stratum.session import checkpoint_root

LENGTH = 400
#: Starts among which the anchor is chosen, and the narrower step by which frequent anchors are dealt.
SPREAD, STEP = 128, 32
SHALLOW = 32
LOG2_CELLS = 28
#: Cells of the sketches of frequent anchors' longer pieces.
LOG2_WIDE = 26
HEAVY = 16
CHUNK = 24 << 20
PIECE = 1 << 20

_RNG = np.random.default_rng(20240817)
TABLES = _RNG.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(n: int, base: int) -> np.ndarray:
    low = at.powers(1024, base)
    return (at.powers(-(-n // 1024), pow(base, 1024, 1 << 64))[:, None] * low).reshape(-1)[:n]


class Rolling:
    """Polynomial hashes of any stretch of a piece of bytes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.inverse = powers(len(data) + 1, at.BASE_INVERSE)
        self.sums: dict[int, np.ndarray] = {}

    def summed(self, which: int) -> np.ndarray:
        if which not in self.sums:
            s = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(TABLES[which][self.data] * powers(len(self.data), at.BASE), out=s[1:])
            self.sums[which] = s
        return self.sums[which]

    def of(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        s = self.summed(which)
        return (s[end] - s[start]) * self.inverse[start]

    def every(self, width: int) -> np.ndarray:
        """Of every stretch of ``width`` bytes."""
        s = self.summed(0)
        out = s[width:] - s[:-width]
        out *= self.inverse[:len(out)]
        return out


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of every ``width`` values (compared by their leading 40 bits)."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    keyed = (values & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64)
    pad = -n % width
    blocks = np.append(keyed, np.full(pad, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    low = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)


def anchors(data: np.ndarray, length: int = LENGTH, spread: int = SPREAD) -> tuple[Rolling, np.ndarray]:
    """(hashes, anchor of every start) of a piece of at least ``length`` bytes. The anchor depends only on the string's own bytes."""
    rolling = Rolling(data)
    width = length - spread + 1
    return rolling, sliding_argmin(at.mix(rolling.every(width)), spread)


def pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc_id, offset, bytes): each text's strings, in pieces whose starts partition the text's."""
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary())
        ids = batch.column(0).to_pylist()
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        whole = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        for i, doc in enumerate(ids):
            if not valid[i]:
                continue
            data = whole[offsets[i]:offsets[i + 1]]
            for lo in range(0, max(0, len(data) - length + 1), PIECE):
                yield doc, lo, data[lo:lo + PIECE + length - 1]


def packs(batches, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces put together: (bytes, ends of the pieces, doc_id and offset of each), about ``PIECE`` bytes at a time."""
    held, n = [], 0
    for piece in pieces(batches, length):
        held.append(piece)
        n += len(piece[2])
        if n >= PIECE:
            yield _packed(held)
            held, n = [], 0
    if held:
        yield _packed(held)


def _packed(held):
    data = np.concatenate([d for _, _, d in held])
    ends = np.cumsum([len(d) for _, _, d in held])
    return data, ends, np.array([i for i, _, _ in held], np.int64), np.array([o for _, o, _ in held], np.int64)


def segments(data: np.ndarray, ends: np.ndarray, length: int, spread: int):
    """(hashes, piece, first start, number of starts, anchor) of the runs of starts with one anchor, in places of ``data``."""
    rolling, anchor = anchors(data, length, spread)
    begins = np.append(0, ends[:-1])
    counts = np.maximum(ends - begins - length + 1, 0)
    piece = np.repeat(np.arange(len(ends)), counts)
    start = np.arange(len(piece)) - (np.cumsum(counts) - counts)[piece] + begins[piece]
    own = anchor[start]
    new = np.ones(len(start), bool)
    new[1:] = (own[1:] != own[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    return rolling, piece[first], start[first], np.diff(np.append(first, len(start))), own[first]


def words_at(text: np.ndarray) -> np.ndarray:
    """The big-endian 8-byte word that starts at each byte (``text`` padded by 8)."""
    return np.ndarray((len(text) - 7,), ">u8", text.data, 0, (1,))


def deep_shallow(text: np.ndarray, start: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, class): suffixes of ``text`` at ``start``, compared by ``length`` bytes, in sorted order; equal ones share a class.

    Shallow: multikey quicksort whose characters are 8-byte words – groups of equal words go on with the next one. Deep:
    each group left is put into a blind trie. A trie holds a first suffix and branches at the place where
    another leaves it; only the branching place and byte are kept, and suffixes that leave at the same place by the same byte form the next, smaller trie.
    All groups take a step at once."""
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = words_at(padded)
    n = len(start)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # of order, ascending
    def regroup(keys):
        new = np.zeros(n, bool)
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        return np.cumsum(new) - 1

    if n == 0:
        return order, group
    depth = 0
    while depth + 8 <= min(shallow, length):
        word = words[start[order] + depth].astype(np.uint64)
        by = np.lexsort((word, group))
        order, word, group = order[by], word[by], group[by]
        group = regroup((group, word))
        depth += 8
    done = np.zeros(n, bool)
    while True:
        size = np.bincount(group)
        active = np.flatnonzero((size[group] > 1) & ~done)
        if not len(active):
            return order, group
        head = np.searchsorted(group, group[active])  # each group's first suffix
        lcp, side, byte = leave(padded, words, start[order[active]], start[order[head]], depth, length)
        # smaller suffixes by the place they leave, ascending; then those equal to the first; then larger ones, the last to leave first
        rank = np.where(side < 0, lcp, np.where(side == 0, length, 2 * length + 1 - lcp))
        by = np.lexsort((byte, rank, group[active]))
        order[active] = order[active][by]
        rank_all, byte_all = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rank_all[active], byte_all[active] = rank[by], byte[by]
        done[active] = (side == 0)[by]
        group = regroup((group, rank_all, byte_all))


def leave(padded, words, own, first, depth, length):
    """(place, side, byte) where each suffix leaves the first one of its group: side -1 below, 0 equal to ``length``, 1 above."""
    lcp = np.full(len(own), length, np.int64)
    side, byte = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
    open_ = np.arange(len(own))
    for at_ in range(depth, length, 8):
        a, b = words[own[open_] + at_].astype(np.uint64), words[first[open_] + at_].astype(np.uint64)
        rest = length - at_
        if rest < 8:
            mask = np.uint64(((1 << (8 * rest)) - 1) << (64 - 8 * rest))
            a, b = a & mask, b & mask
        differ = a != b
        if differ.any():
            x = (a ^ b)[differ]
            # leading equal bytes of the word
            equal = np.zeros(len(x), np.int64)
            for k in range(1, 8):
                equal += (x >> np.uint64(64 - 8 * k)) == 0
            hit = open_[differ]
            lcp[hit] = at_ + equal
            side[hit] = np.where(a[differ] < b[differ], -1, 1)
            byte[hit] = padded[own[hit] + lcp[hit]]
            open_ = open_[~differ]
            if not len(open_):
                break
    return lcp, side, byte


def repeated_starts(texts: list[bytes], weight: np.ndarray, count: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment, whether each of its starts begins a string that occurs at least twice among the segments
    (``weight`` occurrences each)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.cumsum([0, *map(len, texts)])[:-1]
    segment = np.repeat(np.arange(len(texts)), count)
    first = np.cumsum(count) - count
    start = begins[segment] + np.arange(len(segment)) - first[segment]
    order, group = deep_shallow(data, start, length)
    total = np.bincount(group, weight[segment[order]])
    hit = np.zeros(len(start), bool)
    hit[order] = total[group] >= 2
    return np.split(hit, np.cumsum(count)[:-1])


FIELDS = 7  # key, digest, doc, first start, starts, weight, bytes of text


def candidate_rows(batches, twice: np.ndarray, heavy: np.ndarray, wide: list[tuple[np.ndarray, np.ndarray]], log2_cells: int, n_keys: int,
                   n_docs: int, length: int, spread: int, step: int, contested: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Packed rows of candidate segments: digests only, or with texts where the anchor is ``contested``."""
    held: list[tuple] = []
    n = 0
    for data, ends, docs, offsets in packs(batches, length):
        rolling, piece, first, count, anchor = segments(data, ends, length, spread)
        gram = at.mix(rolling.of(anchor, anchor + length - spread + 1))
        keep = lookup(gram, twice, log2_cells)
        piece, first, count, anchor, gram = piece[keep], first[keep], count[keep], anchor[keep], gram[keep]
        if not len(first):
            continue
        hot = lookup(gram, heavy, log2_cells)
        # frequent anchors: cut at every ``step`` bytes before the anchor and dealt by the longer piece all its strings
        # hold; pieces still frequent again by smaller steps, down to whole strings
        for narrow, bits in zip(steps_of(step), [*wide, None], strict=True):
            piece, first, count, anchor, gram, hot = split_hot(rolling, piece, first, count, anchor, gram, hot, length, narrow)
            if bits is not None:
                keep = ~hot | lookup(gram, bits[0], wide_cells(log2_cells))
                piece, first, count, anchor, gram, hot = (x[keep] for x in (piece, first, count, anchor, gram, hot))
                hot &= lookup(gram, bits[1], wide_cells(log2_cells))
        if contested is not None:
            keep = lookup(gram, contested, log2_cells)
            piece, first, count, anchor, gram = piece[keep], first[keep], count[keep], anchor[keep], gram[keep]
            if not len(first):
                continue
        end = first + count + length - 1
        salt = (anchor - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + count.astype(np.uint64)
        # equal contents have equal keys and digests; within a key only these 64 bits tell contents apart
        digest = at.mix(rolling.of(first, end, 1) ^ at.mix(salt))
        begins = np.append(0, ends[:-1])
        held.append((gram, digest, docs[piece], offsets[piece] + first - begins[piece], count,
                     [data[a:b].tobytes() for a, b in zip(first.tolist(), end.tolist(), strict=True)] if contested is not None else []))
        n += 64 * len(count) + sum(map(len, held[-1][5]))
        if n >= CHUNK:
            yield chunk_rows(held, n_keys, n_docs, contested is not None)
            held, n = [], 0
    if held:
        yield chunk_rows(held, n_keys, n_docs, contested is not None)


def lookup(value: np.ndarray, bitmap: np.ndarray, log2_cells: int) -> np.ndarray:
    cell = (value >> np.uint64(64 - log2_cells)).astype(np.int64)
    return (bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def steps_of(step: int) -> list[int]:
    """Steps by which frequent anchors are dealt, one after the other: at the last one a key holds whole strings."""
    return sorted({step, max(1, step // 4), 1}, reverse=True)


def wide_cells(log2_cells: int) -> int:
    return min(LOG2_WIDE, log2_cells)


def counted(values: np.ndarray, log2_cells: int, level: int = 0) -> Iterator[tuple[int, int, bytes]]:
    """(level, block, cells) of partition sketches that count each value up to ``HEAVY`` times. A sketch counts two at
    most, so what occurs more often within a task comes in further sketches."""
    values = np.sort(values)
    for _ in range(0, max(2, HEAVY), 2):
        for block, cells in partition_sketch(values, log2_cells, (1,)):
            yield level, block, cells
        values = values[2:][values[2:] == values[:-2]]
        if not len(values):
            return


def counted_rows(found: Iterator[tuple[int, np.ndarray]], log2_cells: int, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Sketch rows of (level, values), ``most`` values at a time."""
    held: dict[int, list[np.ndarray]] = {}
    size = 0

    def flush():
        rows = [r for level, parts in held.items() for r in counted(np.concatenate(parts), log2_cells, level)]
        levels, blocks, cells = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(cells, pa.binary()), pa.array(levels, pa.int32())],
                                          names=["block", "cells", "level"])

    for level, values in found:
        held.setdefault(level, []).append(values)
        size += len(values)
        if size >= most:
            yield flush()
            held, size = {}, 0
    if held:
        yield flush()


def narrow_grams(batches, length: int, spread: int) -> Iterator[tuple[int, np.ndarray]]:
    for data, ends, _, _ in packs(batches, length):
        rolling, _, _, _, anchor = segments(data, ends, length, spread)
        yield 0, at.mix(rolling.of(anchor, anchor + length - spread + 1))


def wide_grams(batches, heavy: np.ndarray, log2_cells: int, length: int, spread: int, step: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, keys) of the longer pieces of frequent anchors, by every step but the last."""
    for data, ends, _, _ in packs(batches, length):
        rolling, piece, first, count, anchor = segments(data, ends, length, spread)
        gram = at.mix(rolling.of(anchor, anchor + length - spread + 1))
        hot = lookup(gram, heavy, log2_cells)
        own = [x[hot] for x in (piece, first, count, anchor, gram)]
        for level, narrow in enumerate(steps_of(step)[:-1]):
            yield level, split_hot(rolling, *own, hot[hot], length, narrow)[4]


def split_hot(rolling, piece, first, count, anchor, gram, hot, length, step):
    back = anchor - first  # of the first start; falls by one a start
    low = back - count + 1
    blocks = np.where(hot, back // step - low // step + 1, 1)
    which = np.repeat(np.arange(len(first)), blocks)
    nth = np.arange(len(which)) - (np.cumsum(blocks) - blocks)[which]
    b = np.where(hot[which], back[which] // step - nth, 0)
    top = np.where(hot[which], np.minimum(back[which], b * step + step - 1), back[which])
    bottom = np.where(hot[which], np.maximum(low[which], b * step), low[which])
    new_first, new_count = anchor[which] - top, top - bottom + 1
    at_ = anchor[which] - b * step
    wide = np.zeros(len(which), np.uint64)
    h = hot[which]
    # all strings of the block hold [anchor - b * step, + length - step + 1)
    wide[h] = at.mix(rolling.of(at_[h], at_[h] + length - step + 1) ^ at.mix(b[h].astype(np.uint64) + np.uint64(7 + (step << 32))))
    return piece[which], new_first, new_count, anchor[which], np.where(h, wide, gram[which]), h


def chunk_rows(held, n_keys: int, n_docs: int, with_text: bool) -> pa.RecordBatch:
    """Rows (bucket, kind, data): one occurrence of each segment content with its weight (and text), and,
    without texts, the starts known to repeat within the chunk."""
    gram, digest, doc, lo, count = (np.concatenate([h[k] for h in held]) for k in range(5))
    texts = [t for h in held for t in h[5]]
    order, new = by_content(gram, digest, doc, lo)
    group = np.cumsum(new) - 1
    times = np.bincount(group)
    again = order[times[group] > 1]
    one = order[new]
    weight = np.minimum(times, 2)
    bucket = (at.mix(gram[one]) % np.uint64(n_keys)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    keys, kinds, out = [], [], []
    squeeze = zstandard.ZstdCompressor(level=3)
    for a, b in at.groups(bucket[by]):
        own = one[by[a:b]]
        blob = b"".join([texts[i] for i in own.tolist()]) if with_text else b""
        size = np.array([len(texts[i]) for i in own.tolist()], np.int64) if with_text else np.zeros(len(own), np.int64)
        head = at.pack(gram[own].view(np.int64), digest[own].view(np.int64), doc[own], lo[own], count[own], weight[by[a:b]], size)
        keys.append(int(bucket[by[a]]))
        kinds.append(0)
        out.append(len(head).to_bytes(8, "little") + head + squeeze.compress(blob))
    if len(again) and not with_text:
        for k, d in packed_runs(*spread_runs(doc[again], lo[again], count[again]), n_docs):
            keys.append(k)
            kinds.append(1)
            out.append(d)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(kinds, pa.int32()), pa.array(out, pa.binary())],
                                      names=["bucket", "kind", "data"])


def by_content(gram, digest, doc, lo) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): rows sorted by content, one for each place; new marks a content's first."""
    order = np.lexsort((lo, doc, digest, gram))
    same = lambda x: np.append(False, x[order][1:] == x[order][:-1])
    content = same(gram) & same(digest)
    keep = ~(content & same(doc) & same(lo))  # a repeated row of the table is no second place
    return order[keep], ~content[keep]


def spread_runs(doc, lo, count):
    which = np.repeat(np.arange(len(doc)), count)
    nth = np.arange(len(which)) - (np.cumsum(count) - count)[which]
    return doc[which], lo[which] + nth


def unpacked(table: pa.Table, with_text: bool):
    """Columns of a bucket's candidate rows in content order, one row a place, and the texts."""
    heads, blobs = [], []
    for d in [d for k, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True) if k == 0]:
        n = int.from_bytes(d[:8], "little")
        heads.append(at.unpack(d[8:8 + n], FIELDS))
        if with_text:
            blobs.append(zstandard.ZstdDecompressor().decompress(d[8 + n:]))
    if not heads:
        return None
    gram, digest, doc, lo, count, weight, size = (np.concatenate(x) for x in zip(*heads, strict=True))
    end = np.cumsum(size)
    rows = np.lexsort((-weight, lo, doc, digest, gram))  # of one place, the heavier row stays
    order, _ = by_content(*(x[rows] for x in (gram, digest, doc, lo)))
    rows = rows[order]
    return (*(x[rows] for x in (gram, digest, doc, lo, count, weight, size, end)), b"".join(blobs))


def copies(table: pa.Table, n_docs: int, log2_cells: int) -> pa.Table:
    """Of one bucket of digests: (0, document bucket, runs) of the contents that occur twice, and (1, block, cells) of the
    anchors that come with different contents."""
    passed = [d for k, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True) if k == 1]
    out = [(0, table.column("bucket")[0].as_py(), merge_packed(passed))] if passed else []
    if (columns := unpacked(table, False)) is not None:
        gram, digest, doc, lo, count, weight, _, _, _ = columns
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (digest[1:] != digest[:-1])
        content = np.cumsum(new) - 1
        twice = np.bincount(content, weight)[content] >= 2
        if twice.any():
            out += [(0, k, d) for k, d in packed_runs(*spread_runs(doc[twice], lo[twice], count[twice]), n_docs)]
        anchors_, contents = np.unique(gram[new], return_counts=True)
        several = anchors_[contents > 1].view(np.uint64)
        if len(several):  # twice, as the merged bits are of what is counted twice
            out += [(1, b, c) for b, c in partition_sketch(np.repeat(several, 2), log2_cells, (1,))]
    kinds, keys, data = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"kind": pa.array(kinds, pa.int32()), "bucket": pa.array(keys, pa.int64()), "runs": pa.array(data, pa.binary())})


def resolve(table: pa.Table, n_docs: int, length: int) -> pa.Table:
    """Removed starts of one bucket of contested segments, by sorting their suffixes, as (document bucket, runs)."""
    out: list[tuple[int, bytes]] = []
    if (columns := unpacked(table, True)) is not None:
        gram, digest, doc, lo, count, weight, size, end, blob = columns
        found_doc, found_pos = [], []
        part: list[tuple] = []
        starts = 0

        def sort_part():
            hits = repeated_starts([t for t, _, _, _ in part], np.array([w for _, w, _, _ in part]), np.array([c for _, _, c, _ in part]), length)
            for (_, _, _, rows), hit in zip(part, hits, strict=True):
                at_ = np.flatnonzero(hit)
                for r in rows:
                    found_doc.append(np.full(len(at_), doc[r]))
                    found_pos.append(lo[r] + at_)

        for a, b in at.groups(gram):
            contents = list(at.groups(digest[a:b]))
            if len(contents) == 1:
                continue  # not contested: its digest told all
            for x, y in contents:
                r = a + x
                part.append((blob[end[r] - size[r]:end[r]], int(weight[a + x:a + y].sum()), int(count[r]), range(a + x, a + y)))
                starts += int(count[r])
            if starts > 300_000:
                sort_part()
                part.clear()
                starts = 0
        if part:
            sort_part()
        if found_doc:
            out += packed_runs(np.concatenate(found_doc), np.concatenate(found_pos), n_docs)
    return pa.table({"bucket": pa.array([b for b, _ in out], pa.int64()), "runs": pa.array([d for _, d in out], pa.binary())})


def collected_bits(parts: DataFrame, log2_cells: int, least: int = 0) -> tuple[bytes, bytes]:
    """Merged bitmaps of partition sketches (block, cells), compressed; their size is fixed by ``log2_cells``."""
    partitions = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def merge(batches):
        for block, twice, heavy in merge_sketches(batches, log2_cells, least):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([twice], pa.binary()), pa.array([heavy], pa.binary())],
                                             names=["block", "twice", "heavy"])

    merged = parts.repartition(partitions, "block").mapInArrow(merge, "block int, twice binary, heavy binary")
    size = (1 << min(LOG2_BLOCK, log2_cells)) // 8
    bits = [bytearray(max(1, (1 << log2_cells) // 8)) for _ in range(2)]
    for row in merged.toLocalIterator():
        bits[0][row.block * size:(row.block + 1) * size] = row.twice
        if least:
            bits[1][row.block * size:(row.block + 1) * size] = row.heavy
    return zstandard.ZstdCompressor(level=1).compress(bits[0]), zstandard.ZstdCompressor(level=1).compress(bits[1])


def bitmap(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)


def dedup_bytes(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD, step: int = STEP, log2_cells: int = LOG2_CELLS,
                buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row.

    Texts are their UTF-8 bytes, null and empty texts none; strings never cross texts. Every occurrence of a repeated
    string goes, the first too; overlapping occurrences count. Rows with a null doc_id take no part and stay whole. Repeated rows of one doc_id are one
    document: what repeats only between them stays. Other columns are left out; an empty table gives no rows.

    Scale: segments travel as digests first; only those of anchors that come with different contents travel again
    with their bytes, to be sorted. A content is sent
    once a chunk of a task with its weight, so copies cost one row a chunk. Anchors counted ``HEAVY`` times or more are dealt by a
    longer piece of the string instead, and pieces counted as often again by still longer ones, up to the whole string, so a
    common passage of any length does not bring all its different surroundings into one task: a key with different contents
    has fewer than ``HEAVY`` segments. Only bitmaps of a fixed size (3 * 32 MB, 4 * 8 MB) are broadcast; beyond their capacity more unique segments travel, the result is the same.
    Texts meet their removed runs as a stream: a task holds a bucket's runs and a slice of its texts.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = at.next_prime(buckets or partitions)
    n_keys = 2 * n
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("data"))
    placed = slim.where(F.col("doc_id").isNotNull() & (F.octet_length("data") >= length))

    checkpoint_root(spark)
    sketches = "block int, cells binary, level int"
    narrow = placed.mapInArrow(lambda batches: counted_rows(narrow_grams(batches, length, spread), log2_cells), sketches)
    shared = spark.sparkContext.broadcast(collected_bits(narrow.drop("level"), log2_cells, HEAVY))

    def longer(batches):
        yield from counted_rows(wide_grams(batches, bitmap(shared.value[1]), log2_cells, length, spread, step), wide_cells(log2_cells))

    levels = placed.mapInArrow(longer, sketches).checkpoint()
    wide = spark.sparkContext.broadcast([collected_bits(levels.where(F.col("level") == k).drop("level"), wide_cells(log2_cells), HEAVY)
                                         for k in range(len(steps_of(step)) - 1)])

    def sketch_bits():
        return *map(bitmap, shared.value), [tuple(map(bitmap, pair)) for pair in wide.value]

    def digests(batches):
        yield from candidate_rows(batches, *sketch_bits(), log2_cells, n_keys, n, length, spread, step)

    packed = "bucket long, kind int, data binary"
    known = placed.mapInArrow(digests, packed).groupBy("bucket").applyInArrow(
        lambda table: copies(table, n, log2_cells), "kind int, bucket long, runs binary").checkpoint()
    anchors_ = known.where(F.col("kind") == 1).select(F.col("bucket").cast("int").alias("block"), F.col("runs").alias("cells"))
    contested = spark.sparkContext.broadcast(collected_bits(anchors_, log2_cells)[0])

    def texts(batches):
        yield from candidate_rows(batches, *sketch_bits(), log2_cells, n_keys, n, length, spread, step, bitmap(contested.value))

    sorted_ = placed.mapInArrow(texts, packed).groupBy("bucket").applyInArrow(
        lambda table: resolve(table, n, length), "bucket long, runs binary")
    gone = known.where(F.col("kind") == 0).select("bucket", "runs").unionByName(sorted_)

    def cut(runs, batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, data in zip(batch.column(0), batch.column(1), strict=True):
            doc_id, data = doc_id.as_py(), data.as_py() or b""
            start, count = runs_of(runs, doc_id)
            removed = spans = 0
            kept = data
            if len(start):
                keep = uncovered(len(data), start, count + length - 1)
                removed = len(data) - int(keep.sum())
                spans = int((~keep[1:] & keep[:-1]).sum()) + int(not keep[0])
                kept = np.frombuffer(data, np.uint8)[keep].tobytes()
            rows.append((doc_id, len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    bucket = F.coalesce(F.pmod(F.col("doc_id"), F.lit(n)), F.pmod(F.xxhash64("data"), F.lit(n))).alias("bucket")
    return cut_in_stream(slim.select(bucket, "doc_id", "data"), gone, cut,
                         "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumnRenamed("doc_id", id_col)
