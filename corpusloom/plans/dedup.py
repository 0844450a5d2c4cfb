"""Exact and near deduplication, and integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import dedup
from corpusloom.plans.registry import query, table


def docs(spark, sf, *more):
    return table(spark, sf, "documents").select("doc_id", *more)


@query("select min(doc_id) as doc_id from documents group by text")
def exact_dedup(spark, sf):
    return dedup.exact(docs(spark, sf, "text")).select("doc_id")


@query("select doc_id from (select doc_id, row_number() over (partition by text order by doc_id) as r from documents) where r > 1")
def repeat_occurrences(spark, sf):
    return dedup.repeats(docs(spark, sf, "text"), F.sha2("text", 256), "doc_id").select("doc_id")


@query("select user_id, event_type, event_id from (select *, count(*) over (partition by user_id, event_type, date_trunc('hour', ts)) as n from events) where n > 1")
def clashing_keys(spark, sf):
    rows = table(spark, sf, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    return dedup.clashing_keys(rows, ["user_id", "event_type", "hour"]).select("user_id", "event_type", "event_id")


@query("select distinct source, lang, length(text)::bigint % 10 as k from documents")
def distinct_per_file(spark, sf):
    """Distinct rows within each file; equal rows of different files all stay."""
    return docs(spark, sf, "source", "lang", "text").select("source", "lang", (F.length("text").cast("long") % 10).alias("k")).dropDuplicates()


@query()
def minhash_bands(spark, sf):
    return docs(spark, sf, "text").select("doc_id", F.posexplode(dedup.band_hashes(F.col("text"))).alias("band", "hash"))


@query()
def minhash_clusters(spark, sf):
    return dedup.minhash_clusters(docs(spark, sf, "text"))


@query()
def minhash_dedup(spark, sf):
    return dedup.minhash(docs(spark, sf, "text")).select("doc_id")


@query("""with recursive e as (select distinct a.doc_id as u, b.doc_id as v from documents a join documents b on (a.doc_id // 3 = b.doc_id // 3 or a.doc_id // 7 = b.doc_id // 7) where a.doc_id <> b.doc_id),
r as (select u as node, u as component from e union select r.node, e.v from r join e on r.component = e.u)
select node, min(component) as component from r group by node""")
def components(spark, sf):
    """Connected components of a graph of groups of three and of seven ids, which meet in runs of 21."""
    from corpusloom.operators.components import connected_components

    ids = docs(spark, sf)
    edges = None
    for k in (3, 7):
        keyed = ids.withColumn("g", F.floor(F.col("doc_id") / k))
        low = keyed.groupBy("g").agg(F.min("doc_id").alias("src"))
        star = keyed.join(low, "g").select("src", F.col("doc_id").alias("dst")).filter("src <> dst")
        edges = star if edges is None else edges.union(star)
    return connected_components(edges)


@query("select lang, source, doc_id, n from (select lang, source, doc_id, length(text)::bigint as n, row_number() over (partition by lang, source order by length(text) desc, doc_id) as r from documents) where r = 1")
def last_of_group(spark, sf):
    rows = docs(spark, sf, "lang", "source", F.length("text").cast("long").alias("n"))
    return dedup.last_of_group(rows, ["lang", "source"], F.col("n").desc(), F.col("doc_id")).select("lang", "source", "doc_id", "n")
