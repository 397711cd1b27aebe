"""A corpus from `documents`: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteflow.llm.decontaminate import find_passages, remove_passages
from quoteflow.llm.jaccard import jaccard_classes
from quoteflow.llm.line_dedup import line_dedup
from quoteflow.llm.mixing import mix_sources
from quoteflow.llm.presence import may_be_in, present
from quoteflow.llm.toxicity import score_toxicity, train_toxicity
from quoteflow.plans.workspace import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(before: DataFrame, after: DataFrame) -> DataFrame:
    """The columns of documents; ``n_chars`` is counted again where the text is another one."""
    if "n_chars" not in before.columns:
        return after.select(*before.columns)
    counted = F.when(F.col("_changed"), F.length("text")).otherwise(F.col("n_chars"))
    return after.withColumn("n_chars", counted.cast(before.schema["n_chars"].dataType)).select(*before.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3. The model learns from labelled rows of ``docs``."""
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a line of 20 or more code points that three or more hold stays in one of them."""
    kept = line_dedup(docs).withColumn("_changed", F.col("n_dropped") > 0)
    return _with_text(docs, kept)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their five-word shingles: that of the smallest id.

    Rows are told by their id and text: of rows that repeat both one stays, and a text goes by its own group, whatever other
    texts its id has. Of several texts of the smallest id that of the smallest hash stays. Documents without words or
    whose id is null stay.
    """
    found = materialize(jaccard_classes(docs, shingle=5, percent=80), "groups")
    row = F.struct("doc_id", "text_hash")
    groups = found.where("component IS NOT NULL").groupBy("component").agg(F.min(row).alias("kept"), F.count(F.lit(1)).alias("rows"))
    groups = materialize(groups.where("rows > 1").drop("rows"), "groups-of-several")
    several = found.join(groups, "component").groupBy("component", "kept", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    several = materialize(several.withColumn("goes", row != F.col("kept")), "documents-of-groups")
    # Few documents share a group, so most are told by bits of those that do and only the others are moved for a join.
    key = ["doc_id", "text_hash"]
    known = F.xxhash64(*key)
    touched = present(several.where("goes OR rows > 1").select(known.alias("hash")))
    told = docs.withColumn("text_hash", F.xxhash64(F.col("text").cast("string"))).withColumn("_touched", may_be_in(touched, known))
    left = told.where("_touched").join(several.where("goes OR rows > 1").select(key), key, "left_anti")
    left = told.where("NOT _touched").select(*docs.columns).unionByName(left.select(*docs.columns))
    repeated = several.where("NOT goes AND rows > 1").select(key)
    if repeated.isEmpty():
        return left
    # Any of the rows, as they differ in other columns at most: the first by these.
    others = [name for name in docs.columns if name != "doc_id"]
    one = told.where("_touched").join(repeated, key, "left_semi").groupBy(key).agg(F.min(F.struct(*others)).alias("row"))
    return left.unionByName(one.select("doc_id", "row.*").select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ten words of the benchmark; those of which no word is left go.

    Where a passage has been cut out, the words around it may form another; what has been cut is searched
    again until none is found. Each round shortens the documents that it finds.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole, settled = F.col("n_hit") == 0, None
    while True:
        found = materialize(find_passages(docs, items), "passages")
        clean = found.where(whole).select(*docs.columns)
        settled = clean if settled is None else settled.unionByName(clean)
        left = found.where((F.col("n_hit") > 0) & (F.col("n_hit") < F.col("n_words")))
        if left.isEmpty():
            return settled
        docs = materialize(_with_text(docs, remove_passages(left).withColumn("_changed", F.lit(True))), "cut")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For each document how many copies and words the mix of sources takes."""
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# Learnt weights, similarity joins and index searches are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; the result of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
