"""The web pipeline end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions import urls
from corpusloom.operators import dedup, filters, signals, uniform
from corpusloom.sources import scratch


#: Domains up to which the list goes to every task; and parts into which a host's documents are dealt beyond that.
MOST_AT_ONCE, PARTS = 500_000, 64


def _with_listed(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """Documents with what is listed for their host, if anything.

    Texts stay where they are while the list is small.  A longer one is joined
    by host and part, each host listed for every part, so that no task reads all
    documents of a common host.
    """
    if listed.limit(MOST_AT_ONCE + 1).count() <= MOST_AT_ONCE:
        return docs.join(F.broadcast(listed), "host", "left")
    spread = listed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    part = F.pmod(F.xxhash64("meta", "raw_content"), F.lit(PARTS)).cast("int")
    return docs.withColumn("_part", part).join(spread, ["host", "_part"], "left").drop("_part")


def judge_web(docs: DataFrame, valid_domains: DataFrame | None = None, language: str = "language") -> DataFrame:
    """Add ``reason``: the first of URL overlap, robots, quality and duplicate rules that drops a document; null for kept ones.

    docs: raw_content, meta, language, and is_duplicate or blacklist where known; signals are computed from the text.
    """
    docs = docs.withColumn("url", uniform.url_of(F.col("meta"))).withColumn("host", urls.host(F.col("url")))
    if valid_domains is not None:
        docs = _with_listed(docs, valid_domains.select(F.col("domain").alias("host")).distinct().withColumn("_ok", F.lit(True)))
        robots = F.when(F.col("_ok").isNull(), F.lit("cannot_fetch"))
    else:
        robots = F.lit(None).cast("string")
    black = F.col("blacklist") if "blacklist" in docs.columns else F.lit(None).cast("string")
    docs = signals.with_signals(docs, "raw_content")
    copied = F.when(~filters.not_duplicate(F.col("is_duplicate")), F.lit("duplicates")) if "is_duplicate" in docs.columns else F.lit(None).cast("string")
    why = F.coalesce(filters.url_reason(F.col("url"), F.col(language), black), robots, filters.reason(filters.WEB_RULES, docs.columns), copied)
    return docs.withColumn("reason", why).drop("_ok")


def filter_web(docs: DataFrame, valid_domains: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept documents with personal data masked, rejected documents)."""
    judged = judge_web(docs, valid_domains)
    kept = judged.filter("reason is null").drop("reason").withColumn("text", T.mask_pii(F.col("raw_content"))).drop("raw_content")
    return kept, judged.filter("reason is not null")


def deduplicate_web(kept: DataFrame, within: list[str], order: str = "doc_id") -> DataFrame:
    """MinHash deduplication inside each group (language and snapshot), then stand-ins for masked data."""
    once = dedup.minhash(scratch.written(kept, "kept"), order=order, within=within)  # judged once, not for each use
    return once.withColumn("text", T.replace_pii_marks(F.col("text"), F.col(order)))
