"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteflow.llm import neighbours, ranked_search, sql
from quoteflow.llm.decontaminate import find_passages
from quoteflow.llm.jaccard import jaccard_classes
from quoteflow.llm.line_dedup import line_dedup
from quoteflow.llm.mixing import mix_sources
from quoteflow.llm.quality_fm import score_quality, train_quality
from quoteflow.llm.quality_rules import quality_rules
from quoteflow.llm.secrets import find_candidates, learn_language, reviewed, score_candidates, train_forest
from quoteflow.llm.spelling import count_words, spelling_forms
from quoteflow.llm.token_counts import count_tokens, write_tokens
from quoteflow.llm.toxicity import score_toxicity, train_toxicity
from quoteflow.llm.training import held_out
from quoteflow.llm.warc import ID, read_warc, warc_records, write_warc
from quoteflow.plans.workspace import materialize, new_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score_quality(documents, train_quality(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(documents, train_toxicity(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = find_candidates(documents, path_column="source", language=learn_language(documents))
    found = materialize(found, "candidates")
    learnt = reviewed(found.where(~held_out(F.col("doc_id"))))
    scored = score_candidates(found, train_forest(learnt))
    return scored.select("doc_id", "start", "end", "candidate", "score", "secret")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort("items")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names).cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archives")
    write_warc(warc_records(table(spark, sf_dir, "pages")), path)
    # These archives are sound, so a gap would be a page that got lost.
    lost = F.raise_error(F.concat(F.lit("gap in "), "path", F.lit(": "), "gap"))
    records = read_warc(spark, path, payloads=False)
    records = records.withColumn("record_id", F.when(F.col("gap").isNull(), F.col("record_id")).otherwise(lost))
    number = lambda name: F.substring_index(name, ID, -1).cast("long")
    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    counted = count_tokens(spark, path)
    return counted.withColumn("file", F.substring_index("file", "/", -1))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = count_words(table(spark, sf_dir, "documents"), one_in=97).where("n >= 3 AND length(word) >= 5")
    return spelling_forms(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    index = neighbours.build_index(vectors)
    return neighbours.search(index, vectors.where("vec_id % 100 = 0"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_quality_fm": op1_quality_fm,
    "op2_toxicity": op2_toxicity,
    "op3_secrets": op3_secrets,
    "op4_mix_sources": op4_mix_sources,
    "op5_decontaminate": op5_decontaminate,
    "op6_warc": op6_warc,
    "op7_token_counts": op7_token_counts,
    "op8_line_dedup": op8_line_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling": op11_spelling,
    "op12_neighbours": op12_neighbours,
    "op13_ranked_search": op13_ranked_search,
}
ORACLE = dict(sql.ORACLE)
