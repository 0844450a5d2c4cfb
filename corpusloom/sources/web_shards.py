"""Web crawls as they lie in files: one gzip file of documents for each shard, one of signals beside it, a list of duplicates.

``<root>/documents/<tag>.json.gz`` has a JSON document on each line, and
``<root>/quality_signals/<tag>.signals.json.gz`` the signals of the same line;
``<root>/duplicates/<tag>.duplicates.parquet`` lists ids.  A tag is
``snapshot/shard/language_part``.  A document's id is its file and line, so
positions must be those of the file: gzip files can't be split, and the task
that reads a pair counts its lines and zips both sides as it goes.  Nothing is
shuffled but the listing, memory holds a batch of lines, and JSON is parsed by
Spark afterwards.

A file that breaks off keeps the lines before the break; the break itself, like
a line that isn't a JSON object with all fields, comes out as a row with a
``problem``, so that what was skipped can be counted.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources import stores

FIELDS = ["url", "language", "source_domain", "date_download", "digest"]
LINES = "tag string, part string, row long, doc string, signals string, is_duplicate boolean, problem string"
BATCH_BYTES = 4 << 20
PAIRS_PER_TASK = 16
#: Where the files of a tag lie.
PLACES = {"documents": "documents/{}.json.gz", "signals": "quality_signals/{}.signals.json.gz", "duplicates": "duplicates/{}.duplicates.parquet"}


def tag(snapshot: Column, shard: Column, lang: Column, part: Column) -> Column:
    return F.format_string("%s/%04d/%s_%s", snapshot, shard, lang, part)


def _place(component: str, of: Column) -> Column:
    before, after = PLACES[component].split("{}")
    return F.concat(F.lit(before), of, F.lit(after))


def files(listing: DataFrame, missing: DataFrame | None = None) -> DataFrame:
    """(tag, part, documents, signals, duplicates): paths below the root for a listing (snapshot, shard, lang, part); null where ``missing`` (path) has them.  Tags without documents are left out."""
    out = listing.select(tag(F.col("snapshot"), F.col("shard"), F.col("lang"), F.col("part")).alias("tag"), "part")
    out = out.select("tag", "part", *[_place(c, F.col("tag")).alias(c) for c in PLACES])
    if missing is None:
        return out
    gone = missing.select(F.trim("path").alias("path")).distinct()
    out = out.join(gone.withColumnRenamed("path", "documents"), "documents", "left_anti")
    for c in ("signals", "duplicates"):
        out = out.join(gone.select(F.col("path").alias(c), F.lit(True).alias("gone")), c, "left").withColumn(c, F.when(F.col("gone").isNull(), F.col(c))).drop("gone")
    return out.select("tag", "part", *PLACES)


def _lines(uri: str) -> Iterator[bytes]:
    fs, path = stores.store(uri)
    with fs.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 20)) as f:
        yield from f


def _listed(uri: str) -> set[str]:
    """Ids of a shard's list of duplicates; none where the list can't be read."""
    fs, path = stores.store(uri)
    try:
        with fs.open_input_file(path) as f:
            return set(pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist())
    except (OSError, KeyError, pa.ArrowException):
        return set()


def _pair(root: str, name: str, part: str, documents: str, signals: str | None, duplicates: str | None) -> Iterator[tuple]:
    """Rows of LINES of one tag; tails, and tags without signals, have none and no flag."""
    zipped = part != "tail" and signals is not None
    known = _listed(f"{root}/{duplicates}") if zipped and duplicates is not None else set()
    other = _lines(f"{root}/{signals}") if zipped else None
    row = 0
    try:
        for line in _lines(f"{root}/{documents}"):
            beside = None
            if zipped and (beside := next(other, None)) is None:
                return  # the shorter side ends the shard
            try:
                text, side = line.decode().rstrip("\r\n"), beside.decode().rstrip("\r\n") if zipped else None
                yield name, "head_middle" if zipped else "tail", row, text, side, f"{name}.json.gz/{row}" in known if zipped else None, None
            except UnicodeDecodeError:
                yield name, part, row, None, None, None, "utf-8"
            row += 1
    except (gzip.BadGzipFile, EOFError, zlib.error) as error:
        yield name, part, row, None, None, None, f"gzip: {error}"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in LINES.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def lines(listed: DataFrame, root: str) -> DataFrame:
    """LINES of all files listed by files(): raw lines with their places; some files a task."""
    spark = listed.sparkSession
    root = stores.qualified(spark, root.rstrip("/"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                for x in _pair(root, r["tag"], r["part"], r["documents"], r["signals"], r["duplicates"]):
                    held.append(x)
                    size += 64 + len(x[3] or "") + len(x[4] or "")
                    if size >= BATCH_BYTES:
                        yield _batch(held)
                        held, size = [], 0
        if held:
            yield _batch(held)

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-listed.count() // PAIRS_PER_TASK))
    return listed.select("tag", "part", *PLACES).repartition(tasks, "tag").mapInArrow(read, LINES)


def records(raw: DataFrame) -> DataFrame:
    """(doc_id, tag, row, raw_content, meta, quality_signals, problem) of lines(); ``problem`` is null for good rows, and their other columns are null for others."""
    strict = {"allowSingleQuotes": "false"}
    fields = [*FIELDS, "raw_content"]
    keys, own = F.json_object_keys("doc"), F.json_object_keys("signals")
    doc = F.from_json("doc", ", ".join(f"{c} string" for c in fields), strict)
    whole = F.size(F.array_intersect(keys, F.array(*map(F.lit, fields)))) == len(fields)
    inner = F.when(F.array_contains(own, "quality_signals"), F.get_json_object("signals", "$.quality_signals")).otherwise(F.lit("{}"))
    fine = F.coalesce(whole, F.lit(False)) & (F.col("signals").isNull() | (own.isNotNull() & F.json_object_keys(inner).isNotNull()))
    problem = F.coalesce("problem", F.when(~F.coalesce(fine, F.lit(False)), "json"))
    raw = raw.select("*", doc.alias("d"), F.when(F.col("signals").isNull(), F.lit("{}")).otherwise(inner).alias("inner"), problem.alias("why"))
    good = F.col("why").isNull()
    meta = F.to_json(F.struct(F.col("d.url").alias("url"), F.col("part").alias("partition"), *[F.col(f"d.{c}").alias(c) for c in FIELDS[1:]]), {"ignoreNullFields": "false"})
    body = F.regexp_extract("inner", r"(?s)^\s*\{(.*)\}\s*$", 1)
    flag = F.concat(F.lit('"is_duplicate":'), F.coalesce(F.col("is_duplicate").cast("string"), F.lit("null")))
    signals = F.concat(F.lit("{"), F.when(F.trim(body) == "", flag).otherwise(F.concat(body, F.lit(","), flag)), F.lit("}"))
    doc_id = F.when(F.col("doc").isNotNull(), F.concat("tag", F.lit(".json.gz/"), F.col("row").cast("string")))
    return raw.select(doc_id.alias("doc_id"), "tag", "row", *[F.when(good, c).alias(n) for n, c in (("raw_content", F.col("d.raw_content")), ("meta", meta), ("quality_signals", signals))], F.col("why").alias("problem"))


def skipped(found: DataFrame) -> DataFrame:
    """(problem, rows, files) of what records() couldn't read; a break of a file by its kind."""
    kind = F.substring_index("problem", ":", 1)
    return found.filter("problem is not null").groupBy(kind.alias("problem")).agg(F.count("*").alias("rows"), F.count_distinct("tag").alias("files"))


def read(listing: DataFrame, root: str, missing: DataFrame | None = None) -> DataFrame:
    """records() of the files of a listing (snapshot, shard, lang, part) below root, less the ``missing`` (path) ones.  Shards, languages and parts are chosen by filters on the listing, before any file is opened."""
    return records(lines(files(listing, missing), root))


def write(df: DataFrame, root: str) -> DataFrame:
    """Write rows (tag, at, doc, signals, duplicate) as a crawl below root, in order of ``at``: (tag, rows) of each shard.

    One streaming task writes a tag's files; they appear when they are whole.  A tag whose signals are all null gets no file of signals or duplicates.
    """
    root = stores.qualified(df.sparkSession, root.rstrip("/"))

    def put(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = key[0].as_py()
        docs = stores.Draft(f"{root}/{PLACES['documents'].format(name)}")
        out, beside, side, row, known = gzip.GzipFile(filename="", fileobj=docs.file, mode="wb", compresslevel=6, mtime=0), None, None, 0, []
        for batch in batches:
            for doc, signals, duplicate in zip(batch.column("doc").to_pylist(), batch.column("signals").to_pylist(), batch.column("duplicate").to_pylist(), strict=True):
                out.write(f"{doc}\n".encode())
                if signals is not None:
                    if side is None:
                        beside = stores.Draft(f"{root}/{PLACES['signals'].format(name)}")
                        side = gzip.GzipFile(filename="", fileobj=beside.file, mode="wb", compresslevel=6, mtime=0)
                    side.write(f"{signals}\n".encode())
                if duplicate:
                    known.append(f"{name}.json.gz/{row}")
                row += 1
        if side is not None:
            side.close()
            beside.commit()
            listed = stores.Draft(f"{root}/{PLACES['duplicates'].format(name)}")
            pq.write_table(pa.table({"doc_id": pa.array(known, pa.string())}), listed.file)
            listed.commit()
        out.close()
        docs.commit()
        yield pa.RecordBatch.from_pydict({"tag": [name], "rows": [row]})

    dealt = df.select("tag", "at", "doc", "signals", "duplicate").repartition("tag").sortWithinPartitions("tag", "at")
    return dealt.groupBy("tag").applyInArrow(put, "tag string, rows long")
