"""N-gram Jaccard join by a token-group matrix (operator 6).

Texts are sets of word shingles. Similar sets are put into groups, a matrix holds which
tokens each group's members can be found by, and a query opens a group only if its
overlap with the group's token union allows a similar member.

Which tokens can find a member: two sets with Jaccard similarity t share a token among the
first |s| - ceil(t |s|) + 1 of each, in any order common to all sets. The order here puts tokens that
occur once in the whole corpus first (a merged count sketch never underestimates, so what it counts once
occurs once). Those can be shared by nobody: a text with enough of them has no similar text
and leaves before anything is shuffled; the others bring only their few remaining tokens.

Token sets are not kept: they are larger than the texts. Narrow rows say which sets go where, and the tokens
are made again from the texts of these rows just before they move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from stratum.llm import arrow_text as at
from stratum.operators.joins import at_most, join_small
from stratum.session import checkpoint_root

SHINGLE = 5
#: Similarity as a fraction: 100 * intersection >= 75 * union.
NUM, DEN = 3, 4
LOG2_CELLS = 28
#: The sketch travels in up to 2**9 blocks, with 31 bits of a token within its block.
LOG2_BLOCKS, BLOCK_BITS = 9, 31
CHUNK = 2_000_000
PAGE = 512
HEAVY = 16


def token_sets(text: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, token) sorted and distinct: hashed shingles of the A-Z lowered words. A text of fewer words is one
    shingle of all of them; without words it has none. 64-bit tokens: within the union of two sets of a
    million shingles each, two different ones meet with probability below 1e-6."""
    offsets, words = at.split_words(pc.ascii_lower(pc.fill_null(text, "")))
    hashes = at.word_hashes(words, at.KEYS[:1])[0]
    place, row, _ = at.inside(offsets, width)
    token = at.mix(at.window_hashes(hashes, width)[place])
    counts = np.diff(offsets)
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            own = hashes[offsets[short][:, None] + np.arange(n)]
            value = np.full(len(short), n, np.uint64)
            for k in range(n):
                value = at.mix(value ^ own[:, k])
            row, token = np.append(row, short), np.append(token, value)
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    return row[new], token[new]


def reach(n):
    """How many of a set's first tokens must be looked up."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def is_link(shared, a, b):
    return DEN * shared >= NUM * (a + b - shared)


def lookup(token: np.ndarray, bitmap: np.ndarray, log2_cells: int) -> np.ndarray:
    cell = (token >> np.uint64(64 - log2_cells)).astype(np.int64)
    return (bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def components_of(link: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component; ``link`` is a symmetric boolean matrix."""
    label = np.arange(len(link))
    while True:
        best = np.where(link, label[None, :], len(link)).min(axis=1)
        new = np.minimum(label, best)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of a page (at most ``PAGE`` or so sets), by a product over the tokens that two of them hold."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    token, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    wide = count > 1
    place = np.cumsum(wide) - 1
    keep = wide[code]
    row, column = row[keep], place[code[keep]]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 10_000
    for lo in range(0, int(wide.sum()), width):
        own = (column >= lo) & (column < lo + width)
        block = np.zeros((len(sets), width), np.float32)
        block[row[own], column[own] - lo] = 1
        total += block @ block.T
    out = total.astype(np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal first ``n_keys`` columns, one table each, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(n_keys)], 1)
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(keys)], strict=True):
            key = tuple(keys[lo])
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def binary_sets(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def packed_tokens(token: np.ndarray, log2_blocks: int) -> Iterator[tuple[int, bytes]]:
    """(block, tokens): the leading bits of a chunk's tokens, sorted, twice where counted twice or more, as differences."""
    c = np.sort(token >> np.uint64(64 - BLOCK_BITS - log2_blocks))
    if len(c) > 2:  # more than two of a token say nothing more
        c = c[np.concatenate([[True, True], c[2:] != c[:-2]])]
    cuts = np.searchsorted(c, np.arange((1 << log2_blocks) + 1, dtype=np.uint64) << np.uint64(BLOCK_BITS))
    for b in range(len(cuts) - 1):
        if cuts[b] < cuts[b + 1]:
            own = (c[cuts[b]:cuts[b + 1]] & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint32)
            planes = np.diff(own, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()
            yield b, zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked_tokens(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    delta = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).reshape(-1)
    return np.cumsum(delta, dtype=np.uint32)


def sketch_bits(slim: DataFrame, log2_cells: int) -> tuple[bytes, bytes]:
    """Bitmaps (one bit a cell) of the tokens counted twice or more and ``HEAVY`` times or more, in the
    whole corpus. Their size is fixed by ``log2_cells``: 2 * 32 MB by default.

    Tokens are counted by up to 40 bits and only then put into cells, so a cell is set by repeated tokens alone,
    however many others the corpus has."""
    partitions = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    log2_blocks = max(0, min(LOG2_BLOCKS, log2_cells - 3))

    def sketch(batches):
        held, n = [], 0

        def flush():
            out = list(packed_tokens(np.concatenate(held), log2_blocks))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()),
                                               pa.array([c for _, c in out], pa.binary())], names=["block", "cells"])

        for batch in batches:
            for part in at.slices(batch, 1):
                held.append(token_sets(part.column(1))[1])
                n += len(held[-1])
                if n >= CHUNK:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    def merge(batches):
        log2_own = log2_cells - log2_blocks
        for group in sorted_groups(batches, 1):
            token = np.sort(np.concatenate([unpacked_tokens(x) for x in group.column("cells").to_pylist()]))
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            count = np.diff(np.append(first, len(token)))
            bits = []
            for least in (2, HEAVY):
                cells = np.zeros(1 << log2_own, bool)
                cells[token[first[count >= least]] >> np.uint32(BLOCK_BITS - log2_own)] = True
                bits.append(np.packbits(cells, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([group.column("block").combine_chunks().slice(0, 1), *[pa.array([b], pa.binary()) for b in bits]],
                                             names=["block", "twice", "heavy"])

    merged = slim.mapInArrow(sketch, "block int, cells binary").repartition(partitions, "block").sortWithinPartitions("block").mapInArrow(
        merge, "block int, twice binary, heavy binary").checkpoint()
    size = max(1, (1 << (log2_cells - log2_blocks)) // 8)
    twice, heavy = bytearray(size << log2_blocks), bytearray(size << log2_blocks)
    for row in merged.coalesce(16).toLocalIterator():
        twice[row.block * size:(row.block + 1) * size] = row.twice
        heavy[row.block * size:(row.block + 1) * size] = row.heavy
    return bytes(twice), bytes(heavy)


KINDS = {"doc_id": "long", "n": "long", "k1": "long", "k2": "long", "tokens": "binary", "prefix": "array<long>"}


def described(slim: DataFrame, shared, log2_cells: int, columns: tuple[str, ...]) -> DataFrame:
    """Some of (doc_id, n, k1, k2, tokens, prefix) of each text; the last four only where a similar text is possible."""
    def run(batches):
        twice, heavy = (np.frombuffer(b, np.uint8) for b in shared.value)
        for batch in batches:
            for part in at.slices(batch, 1):
                row, token = token_sets(part.column(1))
                repeated = lookup(token, twice, log2_cells)
                n = np.bincount(row, minlength=part.num_rows)
                lone = np.bincount(row, ~repeated, minlength=part.num_rows).astype(np.int64)
                ends = np.cumsum(n)
                k1, k2, tokens, prefix = [], [], [], []
                for i in range(part.num_rows):
                    left = reach(int(n[i])) - int(lone[i])
                    if n[i] == 0 or left <= 0:
                        for column in (k1, k2, tokens, prefix):
                            column.append(None)
                        continue
                    own, again = token[ends[i] - n[i]:ends[i]], repeated[ends[i] - n[i]:ends[i]]
                    data = own.tobytes()
                    key = np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), np.int64)
                    k1.append(int(key[0]))
                    k2.append(int(key[1]))
                    tokens.append(data if "tokens" in columns else None)
                    if "prefix" in columns:
                        look = own[again]
                        order = np.argsort(lookup(look, heavy, log2_cells), kind="stable")[:left]
                        prefix.append(look[order].view(np.int64).tolist())
                made = {"doc_id": lambda: part.column(0), "n": lambda: pa.array(n, pa.int64()), "k1": lambda: pa.array(k1, pa.int64()),
                        "k2": lambda: pa.array(k2, pa.int64()), "tokens": lambda: pa.array(tokens, pa.binary()),
                        "prefix": lambda: pa.array(prefix, pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_arrays([made[c]() for c in columns], names=list(columns))

    return slim.mapInArrow(run, ", ".join(f"{c} {KINDS[c]}" for c in columns))


def texts_of(slim: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, text, and the other columns of ``ids``) of the rows of ``slim`` whose id is one of ``ids``' rep."""
    return join_small(slim.select(F.col("doc_id").alias("rep"), "text"), ids, "rep", "inner")


def with_tokens(slim: DataFrame, rows: DataFrame) -> DataFrame:
    """(rep, n, tokens, and the other columns of ``rows``): narrow rows with the set of their text, made from it again."""
    texts = texts_of(slim, rows)
    schema = StructType([texts.schema["rep"]]).add("n", LongType()).add("tokens", BinaryType())
    for field in texts.schema.fields[2:]:
        schema.add(field)
    names = schema.names

    def run(batches):
        for batch in batches:
            for part in at.slices(batch, 1):
                row, token = token_sets(part.column(1))
                n = np.bincount(row, minlength=part.num_rows)
                tokens = [x.tobytes() for x in np.split(token, np.cumsum(n)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(tokens, pa.binary()),
                                                  *part.columns[2:]], names=names)

    return texts.mapInArrow(run, schema)


def paged(sets: DataFrame, turn: int) -> DataFrame:
    """``sets`` with the page of their group, and whether it has more; a group of more than ``PAGE`` sets is dealt over several."""
    big = sets.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > PAGE)
    pages = F.ceil(F.coalesce("members", F.lit(1)) / F.lit(PAGE)).cast("long")
    return join_small(sets, big, "key", "left").withColumn("pages", pages).withColumn(
        "page", F.pmod(F.xxhash64("rep", F.lit(turn)), F.col("pages"))).withColumn("more", F.col("pages") > 1).drop("members", "pages")


def page_components(sets: DataFrame, partitions: int) -> DataFrame:
    """(rep, root, key, page, n, tokens): components within each page of a group, all pairs of a page compared.

    ``sets`` has rep, key (the group), page, more (whether the group has more pages), n and tokens; tokens
    are kept only for roots of groups of several pages, which meet again in the next turn."""
    def run(batches):
        for group in sorted_groups(batches, 2):
            reps = group.column("rep").to_numpy()
            order = np.argsort(reps, kind="stable")
            sets_ = binary_sets(group.column("tokens"))
            size = np.array([len(s) for s in sets_])
            if len(reps) > 1:
                common = shared_counts([sets_[i] for i in order])
                label = components_of(is_link(common, size[order][:, None], size[order][None, :]))
            else:
                label = np.zeros(1, np.int64)
            more = group.column("more")[0].as_py()
            keep = [sets_[order[i]].tobytes() if more and label[i] == i else None for i in range(len(order))]
            place = [group.column(c).combine_chunks().take(pa.array(order)) for c in ("key", "page")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps[order]), pa.array(reps[order][label]), *place, pa.array(size[order], pa.int64()), pa.array(keep, pa.binary())],
                names=["rep", "root", "key", "page", "n", "tokens"])

    return sets.select("key", "page", "rep", "n", "tokens", "more").repartition(partitions, "key", "page").sortWithinPartitions("key", "page").mapInArrow(
        run, "rep long, root long, key long, page long, n long, tokens binary")


def opened_links(rows: DataFrame, partitions: int) -> DataFrame:
    """(a, b): classes with a similar pair. ``rows`` (home, kind, part, cls, tokens) of kind 0 are the groups' members, those of kind 1
    the sets asked against them.

    A group's union and least size are made once; a query whose overlap with the union rules out every member size is
    turned away unopened. Queries pass by in parts, so a group that many ask holds its members and one part."""
    def run(batches):
        found: set[tuple[int, int]] = set()
        home = None
        for group in sorted_groups(batches, 3):
            own, sets_ = group.column("cls").to_numpy(), binary_sets(group.column("tokens"))
            if group.column("kind")[0].as_py() == 0:
                home, cls = group.column("home")[0].as_py(), own
                size = np.array([len(s) for s in sets_])
                flat, member = np.concatenate(sets_), np.repeat(np.arange(len(sets_)), size)
                union = np.unique(flat)
                continue
            if group.column("home")[0].as_py() != home:
                continue
            for s, o in zip(sets_, own.tolist(), strict=True):
                other = cls != o
                if not other.any():
                    continue
                at_ = np.searchsorted(union, s)
                overlap = int((union[np.minimum(at_, len(union) - 1)] == s).sum())
                if overlap == 0 or not is_link(overlap, len(s), max(int(size.min()), overlap)):
                    continue  # no member size fits under this overlap
                place = np.searchsorted(s, flat)
                hit = s[np.minimum(place, len(s) - 1)] == flat
                common = np.bincount(member[hit], minlength=len(size))
                found |= {(o, int(c)) for c in np.unique(cls[other & is_link(common, len(s), size)])}
            if len(found) > 10_000:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in sorted(found)], schema=PAIRS)
                found = set()
        if found:
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in sorted(found)], schema=PAIRS)

    return rows.select("home", "kind", "part", "cls", "tokens").repartition(partitions, "home").sortWithinPartitions("home", "kind", "part").mapInArrow(run, "a long, b long")


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def least_reachable(links: DataFrame) -> DataFrame:
    """(cls, component): smallest class reachable from each class that has a link.

    Neighbours' least labels, then labels of labels, until nothing changes; each turn's labels are checkpointed."""
    both = links.union(links.select("b", "a")).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("a"), F.min("b")).alias("component")).checkpoint()
    while True:
        near = both.join(labels, both["b"] == labels["cls"]).groupBy(F.col("a")).agg(F.min("component").alias("least"))
        step = labels.join(near, labels["cls"] == near["a"], "left").select(
            "cls", F.col("component").alias("old"), F.least("component", F.coalesce("least", "component")).alias("component"))
        up = step.select(F.col("cls").alias("up"), F.col("component").alias("higher"))
        new = step.join(up, step["component"] == up["up"], "left").select(
            "cls", "old", F.least("component", F.coalesce("higher", "component")).alias("component")).checkpoint()
        labels = new.select("cls", "component")
        if new.where(F.col("old") != F.col("component")).limit(1).count() == 0:
            return labels


def join_components(docs: DataFrame, log2_cells: int = LOG2_CELLS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Two texts link when 100 * intersection >= 75 * union of their five-word shingle sets; ``component_id`` is the
    smallest doc_id reachable by links. Null, empty and blank texts have no set and link with nothing (their own id);
    texts of one to four words link only with texts of the same words. Rows with a null
    doc_id take no part and get a null component. Repeated rows are returned as often as they come; different texts of one
    doc_id keep their own ``n_shingles`` and are linked. Other columns are left out; an empty table gives no rows.

    Scale: copies (equal sets) are collapsed map-side first by their keys, so a group of copies costs one narrow row a task and one set. Only
    sets with a token that finds another set go on. A set's group is the most shared of its tokens; of each group, pages of at most about ``PAGE``
    sets are compared as one product, and roots of bigger groups meet again turn by turn, so thousands of near
    copies become one class without all their pairs. Matrix rows are then (token, page) with the range of the page's classes; only pages
    that share a token and are not of one class already meet, the smaller one's sets asking the larger one.
    Only bitmaps of a fixed size are broadcast.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(sketch_bits(slim, log2_cells))
    texts = described(slim, shared, log2_cells, ("doc_id", "n", "k1", "k2")).checkpoint()
    open_texts = texts.where(F.col("k1").isNotNull() & F.col("doc_id").isNotNull())
    copies = open_texts.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")).checkpoint()
    unique = at_most(texts.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1), 0)
    if unique:
        # one row an id: a set's row is its smallest id's, found without moving tokens when the ids are few
        own = texts_of(slim, copies.select("rep")).withColumnRenamed("rep", "doc_id")
        sets = described(own, shared, log2_cells, ("doc_id", "prefix")).withColumnRenamed("doc_id", "rep").checkpoint()
    else:
        own = texts_of(slim, copies.select("rep").distinct()).withColumnRenamed("rep", "doc_id")
        sets = described(own, shared, log2_cells, tuple(KINDS)).where(F.col("k1").isNotNull()).groupBy("k1", "k2").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("tokens").alias("tokens"),
            F.first("prefix").alias("prefix")).checkpoint()

    def moved(rows: DataFrame) -> DataFrame:
        """Narrow ``rows`` with their rep's n and tokens."""
        return with_tokens(slim, rows) if unique else join_small(sets.select("rep", "n", "tokens"), rows, "rep", "inner")

    lookups = sets.select("rep", F.explode("prefix").alias("token"))
    shared_tokens = lookups.groupBy("token").agg(F.count(F.lit(1)).alias("holders")).where(F.col("holders") > 1)
    lookups = lookups.join(shared_tokens, "token").checkpoint()
    keys = lookups.groupBy("rep").agg(F.max_by("token", F.struct("holders", "token")).alias("key")).checkpoint()
    roots = page_components(moved(paged(keys, 0).checkpoint()), partitions).checkpoint()
    classes = roots.select("rep", F.col("root").alias("cls"))
    waiting, turn, before = roots.where(F.col("tokens").isNotNull()), 1, None
    while (n := waiting.count()) and n != before:
        merged = page_components(paged(waiting.select("rep", "key", "n", "tokens"), turn), partitions).checkpoint()
        classes = classes.join(merged.select(F.col("rep").alias("cls"), F.col("root").alias("up")), "cls", "left").select(
            "rep", F.coalesce("up", "cls").alias("cls")).checkpoint()
        waiting, turn, before = merged.where(F.col("tokens").isNotNull()), turn + 1, n

    if not unique:
        # one class a row, the least; the classes of all texts of one id are linked
        least = classes.groupBy("rep").agg(F.min("cls").alias("least"))
        same_row = classes.join(least, "rep").select(F.col("cls").alias("a"), F.col("least").alias("b"))
        classes = least.withColumnRenamed("least", "cls").checkpoint()
        held = open_texts.select("doc_id", "k1", "k2").distinct().join(copies, ["k1", "k2"]).join(
            classes, "rep", "left").select("doc_id", F.coalesce("cls", "rep").alias("a"))
        same_id = held.join(held.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b")
        same = same_row.union(same_id).where(F.col("a") != F.col("b")).distinct().checkpoint()

    placed = roots.select("rep", "n", F.xxhash64("key", "page").alias("home")).join(classes, "rep").checkpoint()
    matrix = join_small(lookups.select("rep", "token"), placed, "rep", "inner").groupBy("token", "home").agg(
        F.min("cls").alias("low"), F.max("cls").alias("high"))
    one, two = (matrix.select("token", *[F.col(c).alias(f"{c}{k}") for c in ("home", "low", "high")]) for k in (1, 2))
    settled = (F.col("low1") == F.col("high1")) & (F.col("low1") == F.col("low2")) & (F.col("low2") == F.col("high2"))
    pairs = one.join(two, "token").where((F.col("home1") < F.col("home2")) & ~settled).select("home1", "home2").distinct()
    about = placed.groupBy("home").agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("least"), F.max("n").alias("most"))
    for k in (1, 2):
        pairs = pairs.join(about.select(*[F.col(c).alias(f"{c}{k}") for c in about.columns]), f"home{k}")
    fits = (DEN * F.col("most1") >= NUM * F.col("least2")) & (DEN * F.col("most2") >= NUM * F.col("least1"))
    asks = F.col("members1") <= F.col("members2")
    pairs = pairs.where(fits).select(F.when(asks, F.col("home1")).otherwise(F.col("home2")).alias("from"),
                                     F.when(asks, F.col("home2")).otherwise(F.col("home1")).alias("home")).checkpoint()
    # narrow rows say who goes where; tokens then move once, to the page that is asked
    asked = placed.join(pairs.select("home").distinct(), "home").select(
        "rep", "home", "cls", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("part"))
    asking = placed.withColumnRenamed("home", "from").join(pairs, "from").select(
        "rep", "home", "cls", F.lit(1).alias("kind"), F.pmod(F.xxhash64("rep"), F.lit(64)).alias("part"))
    going = asked.unionByName(asking).checkpoint()
    links = opened_links(join_small(moved(going.select("rep").distinct().checkpoint()), going, "rep", "inner"), partitions)
    final = least_reachable((links if unique else links.union(same)).distinct())
    known = copies.join(classes, "rep", "left").withColumn("cls", F.coalesce("cls", "rep")).join(
        final, "cls", "left").select("k1", "k2", F.coalesce("component", "cls").alias("component_id"))
    outside = texts.where(F.col("k1").isNull() | F.col("doc_id").isNull())
    inside = open_texts.join(known, ["k1", "k2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    outside = outside.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    if not unique:
        of_id = inside.groupBy("doc_id").agg(F.min("component_id").alias("own"))
        outside = outside.join(of_id, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("own", "component_id").alias("component_id"))
    return inside.union(outside).withColumnRenamed("doc_id", id_col)
