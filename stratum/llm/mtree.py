"""Exact top-k inner-product search by best-first search in M-trees (operator 1).

Largest inner product is nearest neighbour in a metric: with M the largest norm, a row x gets the extra
coordinate sqrt(M^2 - |x|^2) and a query the coordinate 0; then d^2 = |q|^2 + M^2 - 2 q.x. The
upper level of the tree is fixed: pivots are its routing objects, and each pivot's rows are cut into shells by
their distance to it, so a subtree has an inner and an outer covering radius. A query goes to a subtree only if its distance to the pivot
and its first bound reach the shell; other pairs are never exchanged. Each subtree is an M-tree: pages with a routing object, a
covering radius, and for every entry its distance to the page's routing object. A query takes the
pages in order of the least distance they allow, and skips entries whose stored parent distance already puts them beyond its k-th best.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.token_groups import sorted_groups
from stratum.session import checkpoint_root

TOP = 20
SCALE = 64
QUERY_EVERY = 20
#: Rows of a leaf page, pages of an inner page, rows of a subtree, queries of a block.
LEAF, FANOUT, SUBTREE, BLOCK = 512, 16, 8192, 256
#: Bounds of what is collected: pivots that deal rows, sampled rows that give every query a first bound.
PIVOTS, SAMPLE = 256, 2048
#: Shells of a pivot; a shell with more rows than a subtree holds is dealt further by a hash.
SHELLS = 64
#: Products of components up to this are exact in doubles; larger ones are multiplied as integers.
EXACT = 1 << 20


def quantised(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as longs; null for a null vector, one with a null or non-finite component, or an empty one."""
    wide = F.transform(embedding, lambda x: x.cast("double"))
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(good & (F.size(wide) > 0), F.transform(wide, lambda x: F.floor(F.lit(float(scale)) * x).cast("long")))


def dot(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    if max(np.abs(rows).max(initial=0), np.abs(q).max(initial=0)) < EXACT:
        return (rows.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return rows @ q


@dataclass
class Page:
    """Routing object (row number), covering radius, distance to the parent's routing object, and the entries: rows with
    their distances to the routing object, or child pages."""

    centre: int
    radius: float
    to_parent: float
    rows: np.ndarray | None = None
    values: np.ndarray | None = None
    distance: np.ndarray | None = None
    children: list[Page] | None = None
    centres: np.ndarray | None = None
    radii: np.ndarray | None = None


class MTree:
    """Bulk-loaded M-tree over integer rows with squared norms at most ``top_square``."""

    def __init__(self, rows: np.ndarray, top_square: int, leaf: int = LEAF, fanout: int = FANOUT):
        self.rows = rows
        self.real = rows.astype(np.float64)
        self.square = (self.real * self.real).sum(axis=1)
        self.lift = np.sqrt(np.maximum(top_square - self.square, 0.0))
        self.top_square = float(top_square)
        self.exact = np.abs(rows).max(initial=0) < EXACT
        self.leaf, self.fanout = leaf, fanout
        self.computed = 0
        self.root = self._load(np.arange(len(rows)), None)

    def between(self, a: int, others: np.ndarray) -> np.ndarray:
        d = self.real[others] - self.real[a]
        return np.sqrt((d * d).sum(axis=1) + (self.lift[others] - self.lift[a]) ** 2)

    def _load(self, members: np.ndarray, parent: int | None) -> Page:
        centre = int(members[0])
        if len(members) > 2:  # the member nearest the mean routes best
            mean = self.real[members].mean(axis=0)
            centre = int(members[((self.real[members] - mean) ** 2).sum(axis=1).argmin()])
        distance = self.between(centre, members)
        to_parent = 0.0 if parent is None else float(self.between(parent, np.array([centre]))[0])
        page = Page(centre, float(distance.max()), to_parent)
        if len(members) <= self.leaf:
            order = np.argsort(distance, kind="stable")
            page.rows, page.distance = members[order], distance[order]
            page.values = (self.real if self.exact else self.rows)[page.rows]
            return page
        k = min(self.fanout, -(-len(members) // self.leaf))
        seeds = [int(members[distance.argmax()])]
        near = self.between(seeds[0], members)
        which = np.zeros(len(members), np.int64)
        while len(seeds) < k and near.max() > 0:  # farthest-first seeds
            seeds.append(int(members[near.argmax()]))
            d = self.between(seeds[-1], members)
            which[d < near] = len(seeds) - 1
            near = np.minimum(near, d)
        parts = [members[which == i] for i in range(len(seeds)) if (which == i).any()]
        if len(parts) == 1:
            parts = np.array_split(members, k)
        page.children = [self._load(p, centre) for p in parts]
        page.centres = np.array([c.centre for c in page.children])
        page.radii = np.array([c.radius for c in page.children])
        page.distance = np.array([c.to_parent for c in page.children])
        return page

    def search(self, q: np.ndarray, k: int, least: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) that hold the best ``k`` places, each row filling ``weight`` of them, with all ties of the last;
        only scores of at least ``least``.

        Pages and entries are skipped only when the triangle inequality puts them below the current k-th score."""
        q_real = q.astype(np.float64)
        exact = self.exact and np.abs(q).max(initial=0) < EXACT
        square = float(q_real @ q_real)
        slack = 1e-6 + 1e-9 * (square + self.top_square) ** 0.5

        def reach(score: int) -> float:
            return max(0.0, square + self.top_square - 2.0 * score) ** 0.5 + slack

        def apart(rows: np.ndarray) -> np.ndarray:
            self.computed += len(rows)
            return np.sqrt(np.maximum(square + self.top_square - 2.0 * (self.real[rows] @ q_real), 0.0))

        bound, far = least, reach(least)
        best_rows, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        d = float(apart(np.array([self.root.centre]))[0])
        heap = [(max(0.0, d - self.root.radius), 0, d, self.root)]
        n = 1
        while heap:
            low, _, d, page = heapq.heappop(heap)
            if low > far:
                break
            if page.rows is not None:
                # |d(q, centre) - d(row, centre)| bounds d(q, row); distances are sorted
                a, b = np.searchsorted(page.distance, [d - far, d + far])
                if a > b or a == len(page.rows):
                    continue
                values = page.values[a:b + 1]
                s = values @ q_real if exact else values.astype(np.int64) @ q  # whole numbers, exact either way
                self.computed += len(s)
                good = np.flatnonzero(s >= bound)
                if not len(good):
                    continue
                best_rows, best_scores = np.append(best_rows, page.rows[a + good]), np.append(best_scores, s[good].astype(np.int64))
                order = np.argsort(-best_scores, kind="stable")
                best_rows, best_scores = best_rows[order], best_scores[order]
                filled = np.searchsorted(np.cumsum(weight[best_rows]), k)
                if filled < len(best_scores):
                    bound = max(bound, int(best_scores[filled]))
                    far = reach(bound)
                    keep = best_scores >= bound
                    best_rows, best_scores = best_rows[keep], best_scores[keep]
                continue
            # a child whose stored parent distance keeps it beyond reach is not computed
            near = np.flatnonzero(np.abs(d - page.distance) - page.radii <= far)
            if len(near):
                ds = apart(page.centres[near])
                for i, x in zip(near.tolist(), ds.tolist(), strict=True):
                    low = max(0.0, x - page.radii[i])
                    if low <= far:
                        heapq.heappush(heap, (low, n, x, page.children[i]))
                        n += 1
        return best_rows, best_scores


def matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def first_bounds(q: np.ndarray, own: list[int], sample: np.ndarray, ids: list[list[int]], k: int) -> list[int]:
    """For each query a score that at least ``k`` rows of the sample other than its own reach; very low without that many."""
    out = []
    scores = dot(sample, q.T).T if len(sample) else np.zeros((len(q), 0), np.int64)
    for s, i in zip(scores, own, strict=True):
        best = np.argpartition(-s, k)[:k + 1] if len(s) > k + 1 else np.arange(len(s))
        places, bound = 0, -(1 << 62)
        for row in best[np.argsort(-s[best], kind="stable")].tolist():
            places += sum(x != i for x in ids[row])
            if places >= k:
                bound = int(s[row])
                break
        out.append(bound)
    return out


def top_k(vectors: DataFrame, k: int = TOP, query_every: int = QUERY_EVERY, scale: int = SCALE, subtree: int = SUBTREE,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products, ties to the smaller id.

    Queries are the rows whose id is divisible by ``query_every``; candidates all rows but the query's own id. Null
    vectors, vectors with null or non-finite components, empty vectors and null ids take no part. Vectors of different lengths have no
    inner product and do not meet. A row repeated with the same id counts once. Fewer rows than k: all of them. Empty tables give no rows.

    Scale: equal vectors are one entry with its k + 1 smallest ids (no more can be in a result), found
    with a map-side limit, so a vector that a third of all rows hold is one entry. An id with several vectors is a candidate
    with each of them. Subtrees hold about ``subtree`` entries: shells of a pivot, cut further by a hash where a shell has more. A sample of
    ``SAMPLE`` entries gives every query a first bound, and with it only the subtrees whose radii it reaches get the query. A
    task holds one subtree and one block of at most ``BLOCK`` queries. Collected: pivots, sample and at most
    ``PIVOTS`` x ``SHELLS`` radii, of fixed size. A squared norm (scaled) of 2^62 or more is an error: scores may not fit a long.
    """
    spark = vectors.sparkSession
    checkpoint_root(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    near = Window.partitionBy("v").orderBy("id")
    kept = rows.distinct().withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1)
    items = kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("v")).checkpoint()
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    stats = {r["dim"]: (r["n"], r["top"]) for r in items.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("top")).collect()}
    if any(top >= 2.0 ** 62 for _, top in stats.values()):
        raise ValueError(f"squared norm of a vector, times {scale} squared, is 2^62 or more: scores may not fit a long")
    asked = rows.where(F.col("id") % query_every == 0).distinct().withColumn("dim", F.size("v"))
    found = None
    for dim in sorted(stats):  # usually one
        n, top_square = stats[dim]
        part = _search_dim(items.where(F.col("dim") == dim).select("v", "ids"), asked.where(F.col("dim") == dim).select("id", "v"),
                           dim, n, int(top_square), k, subtree, partitions)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search_dim(items: DataFrame, asked: DataFrame, dim: int, n: int, top_square: int, k: int, subtree: int, partitions: int) -> DataFrame:
    spark = items.sparkSession
    drawn = items.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    sample = np.array([r["v"] for r in drawn], np.int64).reshape(-1, dim)
    sample_ids = [list(r["ids"]) for r in drawn]
    pivots = sample[:max(1, min(PIVOTS, n // subtree))].astype(np.float64)
    lift = np.sqrt(np.maximum(top_square - (pivots * pivots).sum(axis=1), 0.0))
    shared = spark.sparkContext.broadcast((pivots, lift, sample, sample_ids))

    slack = 1e-6 + 1e-6 * top_square ** 0.5  # of distances that come from differences of squares

    def dealer(cuts: dict[int, np.ndarray] | None = None, salts: np.ndarray | None = None):
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, up, _, _ = shared.value
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                rows = matrix(batch.column(0), dim)
                x = rows.astype(np.float64)
                own = np.sqrt(np.maximum(top_square - (x * x).sum(axis=1), 0.0))
                square = (p * p).sum(axis=1) + up * up - 2 * (x @ p.T + own[:, None] * up) + top_square
                pivot = square.argmin(axis=1)
                away = np.sqrt(np.maximum(square[np.arange(len(x)), pivot], 0.0))
                leaf = pivot * SHELLS
                if cuts is not None:
                    for one in np.unique(pivot).tolist():
                        mine = pivot == one
                        leaf[mine] += np.searchsorted(cuts[one], away[mine], "left")
                mixed = (rows * np.arange(0x9E3779B1, 0x9E3779B1 + 2 * dim, 2, dtype=np.int64)).sum(axis=1)
                salt = np.zeros(len(x), np.int64) if salts is None else (mixed ^ mixed >> 29) % salts[leaf]
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(salt, pa.int32()), pa.array(away), *batch.columns],
                                                 names=["leaf", "salt", "away", "v", "ids"])
        return deal

    schema = "leaf int, salt int, away double, v array<long>, ids array<long>"
    cuts = shell_cuts(items.mapInArrow(dealer(), schema), subtree)
    shells = items.mapInArrow(dealer(cuts), schema).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.min("away").alias("low"), F.max("away").alias("high")).collect()
    salts = np.ones(PIVOTS * SHELLS, np.int64)
    for r in shells:
        salts[r["leaf"]] = -(-r["n"] // subtree)
    leaves = np.array([r["leaf"] for r in shells], np.int64)
    low, high = np.array([r["low"] for r in shells]) - slack, np.array([r["high"] for r in shells]) + slack

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, _, rows, ids = shared.value
        for batch in batches:
            every = matrix(batch.column(1), dim)
            real = every.astype(np.float64)
            square = (real * real).sum(axis=1)
            apart = np.sqrt(np.maximum(square[:, None] + top_square - 2.0 * (real @ p.T), 0.0))
            order = np.argsort(apart.argmin(axis=1), kind="stable")  # near queries want the same subtrees
            for lo in range(0, len(order), BLOCK):
                pick = order[lo:lo + BLOCK]
                own, q, d = batch.column(0).to_numpy(zero_copy_only=False)[pick], every[pick], apart[pick]
                least = np.array(first_bounds(q, own.tolist(), rows, ids, k), np.int64)
                far = np.sqrt(np.maximum(square[pick] + top_square - 2.0 * least.astype(np.float64), 0.0)) + slack
                at = d[:, leaves // SHELLS]
                wanted = (at - far[:, None] <= high) & (at + far[:, None] >= low)
                lines = np.column_stack([own, least, q]).astype(np.int64)
                held: list[tuple[int, int, bytes]] = []
                for j in np.flatnonzero(wanted.any(axis=0)).tolist():
                    data = lines[wanted[:, j]].tobytes()
                    held += [(int(leaves[j]), s, data) for s in range(int(salts[leaves[j]]))]
                    if len(held) >= 64:
                        yield packed(held, int(own[0]))
                        held = []
                if held:
                    yield packed(held, int(own[0]))

    def packed(held: list[tuple[int, int, bytes]], block: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in held], pa.int32()), pa.array([x[1] for x in held], pa.int32()), pa.array([block] * len(held), pa.int64()),
             pa.array([x[2] for x in held], pa.binary())], names=["leaf", "salt", "part", "block"])

    none = F.lit(None)
    asking = asked.mapInArrow(blocks, "leaf int, salt int, part long, block binary").select(
        "leaf", "salt", F.lit(1).alias("kind"), "part", none.cast("array<long>").alias("v"), none.cast("array<long>").alias("ids"), "block")
    entries = items.mapInArrow(dealer(cuts, salts), schema).select(
        "leaf", "salt", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("part"), "v", "ids", none.cast("binary").alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, place, ids, weight = None, None, [], np.zeros(0)
        for group in sorted_groups(batches, 4):  # a subtree's entries, then its blocks one by one
            here = (group.column("leaf")[0].as_py(), group.column("salt")[0].as_py())
            if group.column("kind")[0].as_py() == 0:
                place, ids = here, group.column("ids").to_pylist()
                tree = MTree(matrix(group.column("v"), dim), top_square)
                weight = np.array([len(x) for x in ids])
                continue
            if here != place:
                continue  # a hash part that got no entry
            for block in group.column("block").to_pylist():
                out = ([], [], [])
                for line in np.frombuffer(block, np.int64).reshape(-1, dim + 2):
                    query, least, q = int(line[0]), int(line[1]), line[2:]
                    # one place more, as the query's own row may fill one
                    for row, score in zip(*(x.tolist() for x in tree.search(q, k + 1, least, weight)), strict=True):
                        for i in ids[row]:
                            if i != query:
                                out[0].append(query)
                                out[1].append(i)
                                out[2].append(score)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return entries.unionByName(asking).repartition(partitions, "leaf", "salt").sortWithinPartitions("leaf", "salt", "kind", "part").mapInArrow(
        run, "query_id long, vec_id long, score long")


def shell_cuts(dealt: DataFrame, subtree: int, shells: int = SHELLS) -> dict[int, np.ndarray]:
    """For each pivot the distances at which its rows are cut into shells of about ``subtree`` rows, at most ``shells`` of them.

    One aggregate with a quantile sketch a pivot; the cuts steer only where rows go, whatever their error."""
    fractions = [i / shells for i in range(1, shells)]
    found = dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("away", fractions, 10_000).alias("cuts")).collect()
    out = {}
    for r in found:
        parts = min(shells, -(-r["n"] // subtree))
        out[r["leaf"] // SHELLS] = np.unique([r["cuts"][round(i * shells / parts) - 1] for i in range(1, parts)])
    return out
