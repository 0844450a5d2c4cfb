"""Published sets, per-file work, statistics gathered while writing.  What these queries write stays in a folder of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.operators import tables
from corpusloom.plans.registry import query, table
from corpusloom.sources import corpora, file_sets, publishing, scratch, sinks


def _folder(spark, name: str) -> str:
    return f"{scratch.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query()
def published_resumed(spark, sf):
    """documents published by source and language, first until two batches are out, then the rest by a second run, and read back from the ledger."""
    root, docs = _folder(spark, "published"), table(spark, sf, "documents")
    unit = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    for most in (2, None):
        publishing.publish(docs, unit, root, "v1", batch=5, most_batches=most)
    ledger = publishing.Ledger(spark, root, "v1").rows().select("unit", "run", F.col("rows").alias("unit_rows"))
    found = publishing.load(spark, root).select("doc_id", unit.alias("unit"), F.md5("text").alias("text"))
    order = scratch.written(ledger.groupBy("run").agg(F.min("unit").alias("first")), "runs")
    return found.join(F.broadcast(ledger), "unit").join(F.broadcast(order), "run").select("doc_id", "unit", "unit_rows", "first", "text")


@query()
def published_versions(spark, sf):
    """Two versions of a set, and how many rows and files the older one, the latest, and one source of the latest have."""
    root, docs = _folder(spark, "published"), table(spark, sf, "documents").select("doc_id", "source", "lang")
    unit = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    publishing.publish(docs.filter("doc_id % 2 = 0"), unit, root, "v1.1")
    publishing.publish(docs, unit, root, "v1.10")
    first = publishing.outputs(spark, root)[0].rpartition("/")[2].partition("%2F")[0]
    parts = [("older", publishing.load(spark, root, version="v1.1")), ("latest", publishing.load(spark, root)), ("one source", publishing.load(spark, root, [first]))]
    out = [p.select(F.lit(name).alias("part"), "source").groupBy("part", "source").agg(F.count("*").alias("rows")) for name, p in parts]
    return out[0].union(out[1]).union(out[2])


@query()
def stats_while_writing(spark, sf):
    """Pages, words and characters of documents, counted by the tasks that write them; one row a language, each written on its own."""
    folder, docs = _folder(spark, "counted"), table(spark, sf, "documents")
    langs = sorted(r.lang for r in docs.select(F.coalesce("lang", F.lit("none")).alias("lang")).distinct().collect())  # languages: a few
    rows = [(k, *sinks.write_counted(docs.filter(F.coalesce("lang", F.lit("none")) == k), f"{folder}/{k}").values()) for k in langs]
    return spark.createDataFrame(rows, "lang string, pages long, words long, chars long")


#: Of the files of documents, those that count: some sources in all languages but German, one in English only, the rest in any.
FRAMED = [file_sets.Rule("source=src1[0-9]/", skip="lang=de"), file_sets.Rule("source=src2/", only="lang=en")]


@query()
def files_framed(spark, sf):
    """documents in JSON files by source and language, read file by file, each under its own name and written to its own output, but for files that a rule skips."""
    root, docs = _folder(spark, "framed"), table(spark, sf, "documents").select("source", "lang", "text")
    docs.write.partitionBy("source", "lang").json(f"{root}/files")
    found = file_sets.listing(spark, f"{root}/files", "*.json", FRAMED)
    file_sets.write_each(file_sets.frames(found, f"{root}/files", "documents", corpora.Recipe(), task_bytes=32 << 20), f"{root}/frames")
    out = spark.read.parquet(f"{root}/frames")
    return out.select("frame", "file", "at", "row", F.md5("text").alias("text"))


@query(r"""with p as (select doc_id, source, doc_id % 8 as rank, row_number() over (partition by doc_id % 8 order by doc_id) - 1 as idx, string_split(text, chr(10)) as lines from documents),
e as (select rank, doc_id, idx, i, lines[i] as line from (select *, unnest(range(1, len(lines) + 1)) as i from p) where length(lines[i]) >= 40)
select rank, doc_id, idx, row_number() over (partition by rank order by doc_id, i) - 1 as at, md5(line) as line from e""")
def lines_by_rank(spark, sf):
    """A table function, rows in and any number out: each rank numbers its documents, and the long lines it takes from them."""
    docs = table(spark, sf, "documents").select((F.col("doc_id") % 8).alias("rank"), "doc_id", "text")
    return tables.long_lines(docs, 40).select("rank", "doc_id", "idx", "at", F.md5("line").alias("line"))
