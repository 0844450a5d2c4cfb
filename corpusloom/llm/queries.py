"""The driver's queries for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import byte_bpe, chat_windows, decontamination, labelled, nearest, quality_classifier, quality_rules, schema_rewrite, sharding, simhash, substring_dedup, toxicity, url_filter, vector_codes

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
SHARDS = 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> tuple[str, str]:
    """The default vocabulary file and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.remove_repeats(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fold = labelled.fold_of(F.col("doc_id"), 3)
    index, ids = toxicity.train(docs, labels, allowed=fold != 1)
    out = docs.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), toxicity.judge(F.col("text"), index, ids).alias("t"))
    return out.select("doc_id", "held_out", F.col("t.score").alias("score"), (F.col("t.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.array_join(F.col("t.evidence").cast("array<string>"), ",").alias("evidence"))


def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.sharded(docs, SHARDS)
    text = F.coalesce(F.col("record.text"), F.lit("")).cast("binary")
    return out.select(F.col("record.doc_id").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fold = labelled.fold_of(F.col("doc_id"), 5)
    model = quality_classifier.train(docs, labels, allowed=fold != 0)
    out = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), quality_classifier.score(F.col("text"), model).alias("score"))
    return out.select("*", (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"))


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    bpe = byte_bpe.ByteBpe(spark, *vocabulary())
    return chat_windows.read_back(chat_windows.format_windows(rows.unionByName(extra), lambda text: F.size(bpe.encode(text))))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = byte_bpe.ByteBpe(spark, *vocabulary())
    docs = _table(spark, sf_dir, "documents")
    out = docs.select("doc_id", bpe.encode(F.col("text")).alias("ids"))
    out = out.select("doc_id", "ids", bpe.decode(F.col("ids")).alias("decoded"))
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_rules.quality_rules(docs, quality_rules.train(docs, labels))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op12_schema_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_rewrite.rewrite_clients(_table(spark, sf_dir, "clients"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = [op1_url_filter, op2_substring_dedup, op3_toxicity, op4_external_shuffle, op5_quality_classifier, op6_chat_windows, op7_byte_bpe, op8_decontamination, op9_simhash, op10_quality_rules, op11_nearest, op12_schema_rewrite, op13_vector_codes]
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


#: Words of a text, their 50-word windows, the smallest id where each window starts, and the words that windows of smaller ids cover.
OP2_SQL = r"""
with w as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') as words from documents),
starts as (select r, doc_id, unnest(generate_series(1, len(words) - 49)) as i, words from w where len(words) >= 50),
wins as (select r, doc_id, i, sha256(array_to_string(words[i : i + 49], ' ')) as h from starts),
low as (select h, min(doc_id) as first from wins group by h),
gone as (select distinct r, unnest(generate_series(i, i + 49)) as k from wins join low using (h) where low.first < doc_id or doc_id is null and low.first is not null),
each as (select r, unnest(generate_series(1, len(words))) as k, unnest(words) as word from w),
kept as (select r, string_agg(word, ' ' order by k) as text from each anti join gone using (r, k) group by r),
cut as (select r, count(*) as n from gone group by r)
select doc_id, len(words)::bigint as n_words, coalesce(cut.n, 0)::bigint as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256 from w left join cut using (r) left join kept using (r)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries whose every column SQL expresses; the others are tested against brute force."""
    return {"op2_substring_dedup": OP2_SQL}
