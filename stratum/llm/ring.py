"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (operator 12).

Only DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.session import checkpoint_root

SHARDS = 40
VIRTUAL_NODES = 128
CELLS = 1 << 14
SLACK = 0.0002
OVERHEAD = 16
CHUNK = 4096
LAW = "bytes"
SEED = "ring-1"
_RING = 1 << 52


def ring_position(*parts: Column) -> Column:
    """Place on the ring: 52 bits of the MD5 of the parts, a long in [0, 2**52). Null parts count as 'null'."""
    key = F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long")


def ring_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row (doc_id, size, text_crc32, copy, pos) for every row of ``docs``.

    Rows equal in id, size and checksum are counted map-side first and numbered by ``copy`` afterwards, so that
    each has a place of its own on the ring: a row repeated a billion times spreads over all of it. Groups of more
    than ``chunk`` copies are written out by many tasks, a chunk at a time.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + F.lit(OVERHEAD)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies")).checkpoint()
    one = F.lit(1).cast("long")
    few = counted.where(F.col("copies") <= chunk).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - one)))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - one, F.lit(chunk).cast("long")))
    last = F.least(F.col("first") + F.lit(chunk), F.col("copies")) - one
    many = (counted.where(F.col("copies") > chunk).withColumn("first", first)
            .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "text_crc32", "first")
            .withColumn("copy", F.explode(F.sequence(F.col("first"), last))).drop("first"))
    rows = few.unionByName(many).drop("copies")
    return rows.withColumn("pos", ring_position(F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("copy")))


def virtual_nodes(spark: SparkSession, shards: int, per_shard: int = VIRTUAL_NODES) -> DataFrame:
    """(shard, at): the places of the shards' virtual nodes. Those of a shard do not depend on the number of shards."""
    nodes = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(per_shard - 1))).alias("node"))
    return nodes.select("shard", ring_position(F.lit("node"), F.col("shard"), F.col("node")).alias("at"))


def walk_order(cells: DataFrame, shards: int, per_shard: int = VIRTUAL_NODES, n_cells: int = CELLS) -> DataFrame:
    """``cells`` (cell, …) with ``walk``: all shards in the order in which a clockwise walk from the cell meets them first.

    For each shard the next virtual node at or after the cell comes from one window over that shard's nodes and the
    cells: cells x shards rows, a number set by the parameters alone.
    """
    spark = cells.sparkSession
    width = _RING // n_cells
    asked = cells.select("cell", (F.col("cell") * F.lit(width)).alias("at"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    nodes = virtual_nodes(spark, shards, per_shard)
    points = asked.unionByName(nodes.withColumn("cell", F.lit(None).cast("long")))
    node_at = F.when(F.col("cell").isNull(), F.col("at"))
    after = Window.partitionBy("shard").orderBy(F.col("at").desc(), F.col("cell").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("shard")
    ahead = points.withColumn("next", F.coalesce(F.last(node_at, ignorenulls=True).over(after), F.min(node_at).over(whole) + F.lit(_RING)))
    met = F.sort_array(F.collect_list(F.struct((F.col("next") - F.col("at")).alias("ahead"), "shard")))
    return ahead.where(F.col("cell").isNotNull()).groupBy("cell").agg(F.transform(met, lambda m: m["shard"]).alias("walk"))


def place_cells(cells: DataFrame, shards: int = SHARDS, per_shard: int = VIRTUAL_NODES, n_cells: int = CELLS,
                slack: float = SLACK) -> DataFrame:
    """(cell, shard) for ``cells`` (cell, bytes, rows), one row a non-empty cell of the ring.

    No shard takes more than ``1 + slack`` of an even share. Cells come largest first; one whose shard has no
    room for it continues clockwise to the next shard that has. One that fits nowhere (larger than what
    any shard has left) goes to the least loaded shard. The fold runs over at most ``n_cells`` entries,
    whatever the number of rows.
    """
    order = F.struct((-F.col("bytes")).alias("less"), "cell", "bytes", "walk")
    table = cells.join(walk_order(cells, shards, per_shard, n_cells), "cell").agg(
        F.sort_array(F.collect_list(order)).alias("cells"), F.sum("bytes").alias("total"))
    # whole bytes, so that every engine computes the same bound
    bound = F.ceil(F.col("total") * F.lit(1.0 + slack) / F.lit(shards)).cast("long")
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.array().cast("array<int>").alias("placed"))

    def step(state, c):
        loads = state["loads"]
        room = F.filter(c["walk"], lambda s: F.get(loads, s) + c["bytes"] <= F.col("bound"))
        least = (F.array_position(loads, F.array_min(loads)) - 1).cast("int")
        chosen = F.array(F.coalesce(F.get(room, F.lit(0)), least))  # bound once, used twice
        return F.get(F.transform(chosen, lambda s: F.struct(
            F.transform(loads, lambda x, i: F.when(i == s, x + c["bytes"]).otherwise(x)).alias("loads"),
            F.concat(state["placed"], F.array(s)).alias("placed"))), F.lit(0))

    folded = table.withColumn("bound", bound).select("cells", F.aggregate("cells", start, step)["placed"].alias("placed"))
    return folded.select(F.posexplode("placed").alias("i", "shard"), "cells").select(F.get("cells", F.col("i"))["cell"].alias("cell"), "shard")


def assign(docs: DataFrame, shards: int = SHARDS, per_shard: int = VIRTUAL_NODES, n_cells: int = CELLS, slack: float = SLACK,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): the shard of every row and its place in it.

    The ring is cut into ``n_cells`` equal cells; keys (rows) fall into cells by their hash, and whole cells are placed
    (``place_cells``), so that the plan stays of one size however many rows there are. Law ``bytes``:
    the shards' sizes (UTF-8 bytes plus 16 a row) are at most ``1 + slack`` of the mean, where no cell is larger than that
    room. With one more shard, mostly the new shard's rows move, and those that overflow elsewhere; rows of old shards can
    move between them, so ``grown_shard`` is null.

    Null texts count as empty, null ids as an id of their own. Equal texts are not kept together: their ids
    place them. Rows equal in id and text are interchangeable and spread over the ring. ``slot`` counts a shard's rows from 0
    along the ring. Other columns of ``docs`` are ignored, whatever their names; an empty table gives no rows.
    """
    checkpoint_root(docs.sparkSession)
    width = _RING // n_cells
    keys = ring_keys(docs, id_col, text_col).withColumn("cell", F.floor(F.col("pos") / F.lit(width)).cast("long"))
    cells = keys.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).checkpoint()
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    plan = cells.join(place_cells(cells, shards, per_shard, n_cells, slack), "cell").select(
        "cell", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("below")).checkpoint()
    along = Window.partitionBy("cell").orderBy("pos", "doc_id", "size", "text_crc32", "copy")
    numbered = keys.withColumn("nth", F.row_number().over(along).cast("long") - 1)
    return numbered.join(F.broadcast(plan), "cell").select(  # at most n_cells rows
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("below") + F.col("nth")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
