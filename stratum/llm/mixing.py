"""Mixing sources to target weights by capped water-filling (operator 10).

Only DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.text import n_words
from stratum.operators.joins import DEFAULT_BROADCAST_ROWS, at_most, fits
from stratum.session import checkpoint_root

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
BINS = 4096


def draw(id_col: Column, size: Column, copy: Column, seed: str = SEED) -> Column:
    """Seeded draw of a row: 52 bits of the MD5 of its id, size and copy number, a long in [0, 2**52)."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("null")), size.cast("string"), copy.cast("string"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long")


def numbered(rows: DataFrame, keys: Sequence[str], tie: Column, name: str = "mix_copy") -> DataFrame:
    """``rows`` with ``name``: 0, 1, … within the rows that are equal in ``keys``, nulls included.

    Only repeated keys are numbered, each task's own rows first and then the tasks' counts added up, so a
    key that holds a third of all rows is spread over the tasks that read it. Which of the equal rows gets which number follows
    ``tie``; it makes no difference to a draw by ``keys`` and number.
    """
    spark = rows.sparkSession
    count = F.count(F.lit(1))
    repeated = rows.groupBy(*keys).agg(count.alias("n")).where(F.col("n") > 1).drop("n")
    zero = F.lit(0).cast("long")
    if at_most(repeated, 0):
        return rows.withColumn(name, zero)
    repeated = repeated.toDF(*[f"mix_k{i}" for i in range(len(keys))]).withColumn("mix_again", F.lit(True)).checkpoint()
    small = F.broadcast(repeated) if fits(repeated) else repeated
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"mix_k{i}"))
    parted = rows.withColumn("mix_part", F.spark_partition_id())
    found = parted.join(small, same, "left").drop(*[f"mix_k{i}" for i in range(len(keys))])
    single = found.where(F.col("mix_again").isNull()).drop("mix_again", "mix_part").withColumn(name, zero)
    # stored once, so that the tasks' counts and numbers below are of the same rows
    again = found.where(F.col("mix_again")).drop("mix_again").checkpoint()
    before = Window.partitionBy(*keys).orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = again.groupBy(*keys, "mix_part").agg(count.alias("n")).select(
        *[F.col(k).alias(f"mix_k{i}") for i, k in enumerate(keys)], F.col("mix_part").alias("mix_p"), F.coalesce(F.sum("n").over(before), zero).alias("mix_start"))
    own = again.withColumn("mix_nth", F.row_number().over(Window.partitionBy(*keys, "mix_part").orderBy(tie)).cast("long") - 1)
    same = F.col("mix_part") == F.col("mix_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"mix_k{i}"))
    counted = own.join(starts, same).withColumn(name, F.col("mix_start") + F.col("mix_nth"))
    return single.unionByName(counted.select(*single.columns))


def water_fill(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
               max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of sources (source, source_size).

    Sources in code-point order (null last) weigh ``weights`` in turn. With the
    sources sorted by cap / weight, the first one that the even level of the rest
    does not lift to its cap sets the level; those before it stay at their cap.
    This is where the repeated clamping and resharing ends. The two windows
    run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]), (rank + 1).cast("int"))
    s = sources.withColumn("weight", w).withColumn("cap", F.lit(max_epochs).cast("long") * F.col("source_size"))
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("filled"),
        F.sum("weight").over(rest).alias("open_weight"),
        (F.lit(float(share)) * F.sum("source_size").over(whole).cast("double")).alias("total"))
    level = (F.col("total") - F.col("filled")) / F.col("open_weight")
    s = s.withColumn("level", level)
    # the level rises while sources saturate and falls after the first that does not
    s = s.withColumn("final", F.max("level").over(whole))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("final"))
    return s.select("source", "source_size", target.alias("target"))


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
             max_epochs: int = MAX_EPOCHS, seed: str = SEED, bins: int = BINS) -> DataFrame:
    """One row per source: size, target, whole repetitions and where the draw stops.

    ``docs`` holds doc_id, source, size, copy and draw. Documents of a source are taken
    once more in the order (draw, doc_id, size, copy) until the fraction of an epoch that
    is left is filled, to the nearest document. The order is never sorted as a
    whole: sizes are summed by (source, bin of the draw) first, and only the bin in
    which the sum passes the target is ordered, so a source that holds a third of
    all rows puts 1/bins of them into one task.
    """
    width = (1 << 52) // bins
    b = F.floor(F.col("draw") / F.lit(width)).cast("long")
    binned = docs.groupBy("source", b.alias("bin")).agg(F.sum("size").alias("bin_size"))
    sources = binned.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    plan = water_fill(sources, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("whole", whole.cast("long"))
    plan = plan.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    by_bin = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    at = binned.withColumn("below", F.coalesce(F.sum("bin_size").over(by_bin), F.lit(0)))
    same = at["source"].eqNullSafe(plan["source"])
    crossing = at.join(F.broadcast(plan) if at_most(plan, DEFAULT_BROADCAST_ROWS) else plan, same).where(
        (F.col("below") <= F.col("extra")) & (F.col("below") + F.col("bin_size") > F.col("extra"))
    ).select(at["source"].alias("c_source"), "bin", "below", "extra")
    cut = docs.withColumn("bin", b).join(
        F.broadcast(crossing) if at_most(crossing, DEFAULT_BROADCAST_ROWS) else crossing,
        docs["source"].eqNullSafe(F.col("c_source")) & (b == crossing["bin"]))
    key = F.struct("draw", "doc_id", "size", "copy")
    order = Window.partitionBy("source").orderBy("draw", "doc_id", "size", "copy").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("cum", F.col("below") + F.sum("size").over(order))
    stop = cut.groupBy("source").agg(
        F.max(F.when(2 * F.col("cum") - F.col("size") <= 2 * F.col("extra"), key)).alias("last"),
        F.max("below").alias("below"), F.max(crossing["bin"]).alias("stop_bin")
    ).withColumnRenamed("source", "s_source")
    return plan.join(stop, plan["source"].eqNullSafe(stop["s_source"]), "left").drop("s_source", "below")


def with_copies(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
                seed: str = SEED, bins: int = BINS, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", size: Column | None = None) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_copies for every row (other columns pass through).

    ``mix_size`` counts words (null text: 0) unless ``size`` gives it. ``mix_copies`` is the whole repetitions of
    the source plus one for documents drawn for the last part of an epoch. A source's words times copies
    differ from its target by at most half a document. Rows that share id, source and size are numbered and drawn one by
    one (``numbered``), so a null id that many rows share is neither taken nor left as a whole. A source without words has
    target 0 and takes nothing. Empty tables give no rows; a null source is a source of its own, last in order.
    Columns named ``mix_...`` belong to this function; ``mixed_rows`` accepts any names.

    The plan is made from narrow rows (id, source, size, copy, draw), checkpointed in the shared folder; it has one row per
    source and is broadcast only when measured small, so the rows of a hot source stay where they are.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    tie = F.xxhash64(F.col(text_col)) if text_col in docs.columns else F.lit(0)
    own = numbered(docs.withColumn("mix_size", n_words(F.col(text_col)) if size is None else size), [id_col, source_col, "mix_size"], tie)
    own = own.withColumn("mix_draw", draw(F.col(id_col), F.col("mix_size"), F.col("mix_copy"), seed))
    narrow = own.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col("mix_size").alias("size"),
                        F.col("mix_copy").alias("copy"), F.col("mix_draw").alias("draw")).checkpoint()
    plan = plan_mix(narrow, weights, share, max_epochs, seed, bins).select(
        F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        F.col("whole").alias("mix_whole"), F.col("stop_bin").alias("mix_stop_bin"), F.col("last").alias("mix_last")).checkpoint()
    small = F.broadcast(plan) if fits(plan) else plan
    out = own.join(small, own[source_col].eqNullSafe(F.col("mix_source")), "left")
    b = F.floor(F.col("mix_draw") / F.lit((1 << 52) // bins)).cast("long")
    key = F.struct(F.col("mix_draw").alias("draw"), F.col(id_col).alias("doc_id"), F.col("mix_size").alias("size"), F.col("mix_copy").alias("copy"))
    drawn = (F.coalesce(b < F.col("mix_stop_bin"), F.lit(False))
             | (F.coalesce(b == F.col("mix_stop_bin"), F.lit(False)) & F.coalesce(key <= F.col("mix_last"), F.lit(False))))
    return out.withColumn("mix_copies", F.col("mix_whole") + drawn.cast("long")).drop(
        "mix_source", "mix_whole", "mix_stop_bin", "mix_last", "mix_draw", "mix_copy")


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row; ``taken`` is size times copies. Options and cases: ``with_copies``."""
    slim = docs.select(F.col(options.pop("id_col", "doc_id")).alias("doc_id"), F.col(options.pop("text_col", "text")).alias("text"),
                       F.col(options.pop("source_col", "source")).alias("source"))
    spark = docs.sparkSession
    checkpoint_root(spark)
    # the sizes are needed twice: count words once, in narrow rows
    slim = slim.select("doc_id", "source", n_words(F.col("text")).alias("words")).checkpoint()
    out = with_copies(slim, size=F.col("words"), **options)
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                      F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``, whatever their names."""
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    out = with_copies(docs.toDF(*own.values()), id_col=own[id_col], text_col=own[text_col], source_col=own[source_col], **options)
    out = out.where(F.col("mix_copies") > 0)
    return out.withColumn("mix_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))).select(
        *own.values()).toDF(*docs.columns)
