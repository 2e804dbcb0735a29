"""Audit of how filters interact, by the Hart-Mas-Colell potential of the removal game (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.text import UPPER, words
from stratum.session import checkpoint_root

#: Fixed values of the contract's filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
SYMBOLS = "[#$%&*|]"
DUPLICATE = "E"

SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")
PARTS_AT_ONCE = 256


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D on a text that is not null."""
    ws = words(text)
    n = F.size(ws)
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {"A": n < MIN_WORDS, "B": 100 * F.size(F.array_distinct(ws)) < MIN_DISTINCT_PERCENT * n,
            "C": 100 * upper > MAX_UPPER_PERCENT * F.length(text), "D": text.rlike(SYMBOLS)}


def fail_counts(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "source") -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and by the set of filters that they fail, as bits in the order
    of ``filters`` and then the duplicate filter.

    Filters are evaluated once a document, without removing any. Only (id, part, bits, digest) leave the scan,
    counted map-side, so rows repeated with one id and text, and a text that many ids share, are small before any
    exchange. A copy is found by an equi-join on (digest, id) with each digest's smallest id: a common
    text's rows meet on their own ids, not in one task.
    """
    checkpoint_root(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(filters.values())), F.lit(0))
    copy_bit = 1 << len(filters)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), bits.cast("int").alias("fails"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    ).groupBy("doc_id", "part", "fails", "digest").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    known, unknown = rows.where(F.col("doc_id").isNotNull()), rows.where(F.col("doc_id").isNull())
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = known.join(first, ["digest", "doc_id"], "left").withColumn(
        "fails", F.when(F.col("first"), F.col("fails")).otherwise(F.col("fails") + F.lit(copy_bit)))
    # one id with many texts is small again before the labels come
    by_id = marked.groupBy("doc_id", "part", "fails").agg(F.sum("n").alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    labelled = by_id.join(marks, "doc_id", "left").select(
        "part", "fails", "n", F.when(F.col("is_good"), F.col("n")).otherwise(0).alias("good"), F.when(F.col("is_toxic"), F.col("n")).otherwise(0).alias("toxic"))
    none = F.lit(0).cast("long")
    everything = labelled.unionByName(unknown.select("part", "fails", "n", none.alias("good"), none.alias("toxic")))
    return everything.groupBy("part", "fails").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def removal_games(counts: np.ndarray) -> np.ndarray:
    """Values of the games: for every coalition of filters, how many rows it removes, whatever the order.

    ``counts`` has rows by exact set of failed filters on axis 1; a coalition removes those whose set meets it."""
    sets = np.arange(counts.shape[1])
    removes = (sets[:, None] & sets[None, :] != 0).astype(np.int64)  # coalition x failed set
    return np.einsum("cs,ps...->pc...", removes, counts)


def potentials(game: np.ndarray) -> np.ndarray:
    """Hart-Mas-Colell potential of every coalition times the number of orders: whole numbers.

    P(empty) = 0, and P(S) = (v(S) + sum over i in S of P(S without i)) / |S|. Times k! (k players)
    every division is exact. ``game`` is parts x coalitions.
    """
    n_sets = game.shape[1]
    players = n_sets.bit_length() - 1
    orders = factorial(players)
    p = np.zeros_like(game)
    for s in sorted(range(1, n_sets), key=int.bit_count):
        inside = [i for i in range(players) if s >> i & 1]
        p[:, s] = (orders * game[:, s] + sum(p[:, s ^ 1 << i] for i in inside)) // len(inside)
    return p


def step_table(letters: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(order, step, filter, coalition before the step) of every step of every order."""
    orders, steps, own, before = [], [], [], []
    for order in permutations(range(len(letters))):
        done = 0
        for step, i in enumerate(order, 1):
            orders.append("".join(letters[x] for x in order))
            steps.append(step)
            own.append(i)
            before.append(done)
            done |= 1 << i
    return orders, np.array(steps, np.int32), np.array(own), np.array(before)


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step: what the step keeps, removes and costs, and its filter's Shapley value.

    ``filters`` maps one-letter names to failure conditions on the columns of ``docs`` (default: A to D of
    ``text_filters``); the duplicate filter E (some smaller id has the same text, anywhere in the table) is always the last. The five
    counts of a step are differences of coalition values: of the removal game (all documents), of its
    restriction to good and to toxic documents. ``shapley`` is the potential of all filters minus that of all but
    this one, times the number of orders.

    Null texts are empty; null parts and the empty part are one. A null id has no smaller id and no labels. Rows
    repeated with one id and text are not each other's copies and all count. Labels given twice for an id count when
    either says so. Other columns of both tables are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = dict(text_filters(text) if filters is None else filters)
    letters = "".join(own) + DUPLICATE
    n_sets = 1 << len(letters)
    counts = fail_counts(docs, labels, own, id_col, text_col, part_col)
    # at most n_sets entries a part
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    orders, steps, filter_of, before = step_table(letters)
    after, alone, others = before | 1 << filter_of, 1 << filter_of, n_sets - 1 ^ 1 << filter_of

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PARTS_AT_ONCE):
                batch = whole.slice(start, PARTS_AT_ONCE)
                lists = batch.column(1)
                cells = lists.flatten()
                owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                table = np.zeros((batch.num_rows, n_sets, 3), np.int64)
                table[owner, cells.field("fails").to_numpy()] = np.column_stack([cells.field(c).to_numpy() for c in ("n", "good", "toxic")])
                games = removal_games(table)
                potential = potentials(games[:, :, 0])
                total, v = table[:, :, 0].sum(axis=1, keepdims=True), games[:, :, 0]
                removed = games[:, after] - games[:, before]
                out = [total - v[:, after], removed[:, :, 0], v[:, alone] - removed[:, :, 0], v[:, -1:] - v[:, others],
                       removed[:, :, 1], removed[:, :, 2], potential[:, -1:] - potential[:, others]]
                names = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), len(orders))))
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(orders * batch.num_rows), pa.array(np.tile(steps, batch.num_rows)), *[pa.array(x.ravel()) for x in out]],
                    names=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])

    return by_part.mapInArrow(rows, SCHEMA)
