"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Stages, in order: reject toxic documents, keep one document of each near-duplicate group, mask
secrets, mix sources to their target weights, encode with byte-level BPE. Every stage works on all
rows its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm import bpe, mixing, secrets, token_groups, toxicity
from stratum.llm.queries import tokenizer_path
from stratum.session import checkpoint_root, scratch_path
from stratum.sources import fs
from stratum.sources.tables import read_table


def own_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and those names by the user's."""
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. Null and empty texts stay; all columns come back as they
    were, whatever their names."""
    checkpoint_root(spark)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    safe, names = own_names(docs)
    return toxicity.score(safe, model, names["text"]).where(F.col("predicted") == 0).select(*safe.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; rows with a null id stay.

    Of rows with one id, one stays: the one with the smallest text (null first), then with the smallest other
    columns as JSON. Rows equal in all columns are the same row."""
    groups = token_groups.join_components(docs)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("kept_id")).distinct()
    safe, names = own_names(docs)
    doc_id = names["doc_id"]
    one = Window.partitionBy(doc_id).orderBy(F.col(names["text"]).asc_nulls_first(), F.to_json(F.struct(*safe.columns)))
    first = safe.join(kept, F.col(doc_id) == F.col("kept_id"), "left_semi").withColumn("nth", F.row_number().over(one)).where(F.col("nth") == 1)
    return first.select(*safe.columns).union(safe.where(F.col(doc_id).isNull())).toDF(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its secrets masked; ``n_chars``, where there is one, follows the text."""
    masked = secrets.redact_rows(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight takes it."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe.encode_digests(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_duplicates), ("secret_scan", mask_secrets),
          ("source_mix", mix_sources), ("bpe", encode)]

#: The model, components by links and BPE are beyond SQL; tests compare the stages with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written under the shared checkpoint folder. A stage's rows are dropped when the
    next stage has written its own; those of the last stage stay."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:
            fs.delete(spark, f"{folder}/{before}")
        before = name
    return docs
