"""Documents to token ids: rejected, deduplicated, decontaminated and encoded, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamlens.llm import decontam, line_dedup, quality, simhash, unigram
from loamlens.llm.common import read, unpacked
from loamlens.session import durable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, the others lose the lines that too many documents of their host share.

    The number of documents alone decides, so that the limit doesn't grow with the host.
    """
    return quality.filtered(docs, max_share=None)


def line_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows, and of shorter texts, go; a document that has nothing left
    goes too."""
    done = line_dedup.dedup_lines(docs, short=True)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(
            F.char_length("text")).cast(docs.schema["n_chars"].dataType)
    return unpacked(done.where(left), docs.columns, **changed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id."""
    return simhash.without_near_duplicates(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids, and whether they decode to the text."""
    path = unigram.default_model(spark)
    encoded = unigram.encoded(docs, path).select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "ids")
    spaced = F.replace(F.coalesce("text", F.lit("")), F.lit(unigram.MARK), F.lit(" "))
    return unigram.decoded(encoded, path).select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_ids"),
        (F.col("decoded") == spaced).alias("text_back"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_windows),
          ("near duplicates", near_duplicates), ("benchmark decontamination", benchmark_free),
          ("token ids", token_ids)]

#: SimHash fingerprints can't be said in DuckDB's SQL; tests hold the job against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
