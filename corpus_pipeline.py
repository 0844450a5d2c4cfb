"""Training-data pipeline: quality, near-duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it
as Parquet to the shared folder and reads it as the next stage's docs.  All but
the last return the columns of documents, whatever else these are called.  Very
long texts are read whole, and an empty table gives an empty result in every
stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import byte_bpe, decontamination, quality_classifier, simhash, substring_dedup
from corpusloom.llm.queries import vocabulary
from corpusloom.sources import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose preference score is below the cut; a score at the cut keeps.

    Rows are judged one by one: equal texts share their fate, null and empty texts that of a text without words, and null or repeated ids don't matter.
    """
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("record"), quality_classifier.score(docs["text"], model).alias("score"))
    return scored.filter(F.col("score") >= quality_classifier.THRESHOLD).select("record.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group of near copies.

    Links are fingerprints of five-word shingles within 3 bits, and beyond them pairs that share a MinHash band and whose exact shingle sets have a Jaccard similarity of 0.8 or more; a group is what links connect.
    Null texts, empty ones and those without words are copies of each other.  Rows without an id can't be named, and stay.  Of rows that share the smallest id one stays, that of the shortest, then smallest text.
    """
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every word that a 50-word window covers which a document of a smaller id has too; texts without such a window stay as they are, texts that lose every word go, and n_chars follows the text.

    Rows of one id don't cut each other; a null id is larger than any other.  Null, empty and wordless texts stay as they are.
    """
    out = substring_dedup.remove_repeats(docs, keep_text=True)
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    fields = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.filter("n_removed = 0 or n_removed < n_words").select(*[(fields[c] if c in fields else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that a benchmark item leaks into.  Null and empty texts hold none and stay; rows are judged one by one, so repeated rows and ids share their fate."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): byte-level BPE ids, and whether they decode to the text; a row for each row, a null text as an empty one, without ids."""
    bpe = byte_bpe.ByteBpe(spark, *vocabulary())
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), bpe.encode(F.col("text")).alias("ids"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (bpe.decode(F.col("ids")) == F.col("text").cast("binary")).alias("round_trip"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("decontaminate", decontaminate), ("tokens", tokens)]

#: SimHash components, a trained classifier and BPE are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
    return docs
