"""Crawl shards, published sets and per-file work, against plain Python; with broken files and killed runs."""

from __future__ import annotations

import collections
import gzip
import hashlib
import json
import os
import pathlib
import signal
import subprocess
import sys
import textwrap
import time

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from corpusloom.plans import web
from corpusloom.sources import corpora, file_sets, publishing, registry, web_shards

SF = "/root/testdata/sf0.001"
QUERIES = __spark_entry__.queries()
GOOD = {"url": "u", "language": "en", "source_domain": "d", "date_download": "t", "digest": "g", "raw_content": "words"}


def put(root, component, tag, lines, cut=0):
    path = root / web_shards.PLACES[component].format(tag)
    path.parent.mkdir(parents=True, exist_ok=True)
    data = gzip.compress("".join(f"{x}\n" for x in lines).encode("utf-8", "surrogateescape"))
    path.write_bytes(data[: len(data) - cut])


def doc(**changes):
    return json.dumps(GOOD | changes)


def test_broken_lines_and_files(spark, tmp_path):
    """Places are lines of the file; what can't be read is told, and the rest comes."""
    signals = [json.dumps({"id": str(i), "quality_signals": {"n": [[0, 1, i]]}}) for i in range(8)]
    docs = [doc(raw_content="zero"), '{"url": "u", "raw', "", doc(raw_content=None), json.dumps({k: v for k, v in GOOD.items() if k != "digest"}), "[1]", doc(url="é x"), doc()]
    put(tmp_path, "documents", "s/0000/en_head", docs)
    put(tmp_path, "signals", "s/0000/en_head", [*signals[:7], '{"quality_signals": []}'])
    (tmp_path / "duplicates/s/0000").mkdir(parents=True)
    pq.write_table(pa.table({"doc_id": ["s/0000/en_head.json.gz/3", "s/0000/en_head.json.gz/1", "other"]}), tmp_path / "duplicates/s/0000/en_head.duplicates.parquet")
    put(tmp_path, "documents", "s/0001/en_head", [doc(raw_content=str(i)) for i in range(5)])  # shorter signals, no list of duplicates
    put(tmp_path, "signals", "s/0001/en_head", signals[:3])
    put(tmp_path, "documents", "s/0000/en_middle", [doc(raw_content=os.urandom(3000).hex()) for _ in range(40)], cut=5000)  # ends too soon
    put(tmp_path, "signals", "s/0000/en_middle", signals * 5)
    put(tmp_path, "documents", "s/0001/en_middle", [doc(), "\udcff", doc()])  # no signals; a line that is no UTF-8
    put(tmp_path, "documents", "s/0000/en_tail", [doc(), doc()])
    (tmp_path / "documents/s/0001/en_tail.json.gz").write_bytes(b"no gzip at all")
    missing = spark.createDataFrame([("quality_signals/s/0001/en_middle.signals.json.gz ",), ("documents/s/0002/en_head.json.gz",), ("documents/s/0002/en_middle.json.gz",), ("documents/s/0002/en_tail.json.gz",)], "path string")
    listing = registry.shard_files(spark, ["s"], 3, ["en"], ["head", "middle", "tail"])
    found = web_shards.read(listing, str(tmp_path), missing)
    got = {r["doc_id"] or (r["tag"], r["row"]): r for r in found.collect()}
    head = [got[f"s/0000/en_head.json.gz/{i}"] for i in range(8)]
    assert [r["problem"] for r in head] == [None, "json", "json", None, "json", "json", None, "json"]
    assert head[0]["raw_content"] == "zero" and head[3]["raw_content"] is None
    assert json.loads(head[6]["meta"]) == {"url": "é x", "partition": "head_middle", "language": "en", "source_domain": "d", "date_download": "t", "digest": "g"}
    assert [json.loads(head[i]["quality_signals"]) for i in (0, 3)] == [{"n": [[0, 1, 0]], "is_duplicate": False}, {"n": [[0, 1, 3]], "is_duplicate": True}]
    assert sorted(k for k in got if str(k).startswith("s/0001/en_head")) == [f"s/0001/en_head.json.gz/{i}" for i in range(3)]
    broken = [r for r in got.values() if r["tag"] == "s/0000/en_middle"]
    assert [r["problem"] for r in broken if r["problem"]] == ["gzip: Compressed file ended before the end-of-stream marker was reached"]
    assert 5 < len(broken) < 40 and {r["row"] for r in broken} == set(range(len(broken)))
    lone = sorted(((r["row"], r["problem"], r["quality_signals"]) for r in got.values() if r["tag"] == "s/0001/en_middle"), key=lambda x: x[0])
    assert lone == [(0, None, '{"is_duplicate":null}'), (1, "utf-8", None), (2, None, '{"is_duplicate":null}')]
    assert all(json.loads(got[f"s/0000/en_tail.json.gz/{i}"]["meta"])["partition"] == "tail" for i in range(2))
    assert got["s/0001/en_tail", 0]["problem"].startswith("gzip: Not a gzipped file")
    assert {(r["problem"], r["rows"], r["files"]) for r in web_shards.skipped(found).collect()} == {("json", 5, 1), ("gzip", 2, 2), ("utf-8", 1, 1)}
    one = web_shards.read(listing.filter("shard = 0 and part = 'tail'"), str(tmp_path))
    assert one.count() == 2


def test_files_of_a_listing_that_are_not_there_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="No such file|not found|does not exist"):
        web_shards.read(registry.shard_files(spark, ["s"], 1, ["en"], ["head"]), str(tmp_path)).collect()


def test_web_shards_read_equals_plain_python(spark):
    rows = duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet' order by doc_id").fetchall()
    tags = {r.at: (r.tag, r.part) for r in web.web_shard_rows(spark, SF)[0].select("at", "tag", F.regexp_extract("tag", "([a-z]+)$", 1).alias("part")).collect()}
    place, want = collections.Counter(), {}
    for i, text, lang in rows:
        tag, part = tags[i]
        assert tag.split("/")[2] == f"{lang}_{['head', 'middle', 'tail'][i % 3]}"
        bare = part == "tail" or part == "head" and tag.split("/")[1].endswith("1")
        broken = i % 50 in (web.CUT, web.SHORT) or i % 50 == web.BESIDE and not bare
        key = f"{tag}.json.gz/{place[tag]}"
        place[tag] += 1
        want[key] = ("json",) if broken else (None, i, "tail" if bare else "head_middle", lang, None if bare else len(text), None if bare else i % 7 == 0, hashlib.md5(text.encode()).hexdigest())
    got = QUERIES["web_shards_read"](spark, SF).collect()
    assert {r["doc_id"]: ("json",) if r["problem"] else (None, r["id"], r["part"], r["language"], r["length"], r["is_duplicate"], r["text"]) for r in got} == want and len(got) == len(rows)


def unit_rows():
    return duckdb.sql(f"select doc_id, source || '/' || lang, md5(text) from '{SF}/documents.parquet'").fetchall()


def test_published_resumed_loses_and_doubles_nothing(spark):
    got = QUERIES["published_resumed"](spark, SF).collect()
    want = unit_rows()
    assert sorted((r["doc_id"], r["unit"], r["text"]) for r in got) == sorted(want)
    sizes = collections.Counter(u for _, u, _ in want)
    assert all(r["unit_rows"] == sizes[r["unit"]] for r in got)
    units = sorted(sizes)
    assert {r["unit"]: r["first"] for r in got} == {u: units[0] if i < 10 else units[10] for i, u in enumerate(units)}


def test_published_versions(spark):
    rows = duckdb.sql(f"select doc_id, source from '{SF}/documents.parquet'").fetchall()
    want = [("older", s, n) for s, n in collections.Counter(s for i, s in rows if i % 2 == 0).items()] + [("latest", s, n) for s, n in collections.Counter(s for _, s in rows).items()]
    first = min(s for _, s in rows)
    want += [("one source", first, sum(s == first for _, s in rows))]
    assert sorted(map(tuple, QUERIES["published_versions"](spark, SF).collect())) == sorted(want)


def test_versions_and_names_prune_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"a-{k}" if k else "b", "x") for i in range(6) for k in range(3)], "i int, u string, `_k x` string")
    for v in ("v1.2", "v1.10", "w"):
        publishing.publish(df, F.col("u"), str(tmp_path), v)
    assert publishing.versions(spark, str(tmp_path)) == ["v1.2", "v1.10", "w"]
    some = publishing.load(spark, str(tmp_path), ["a"], "v1.10")
    assert {"/".join(f.split("/")[-3:-1]) for f in some.inputFiles()} == {"v1.10/a-1", "v1.10/a-2"} and some.columns == df.columns
    assert publishing.load(spark, str(tmp_path), ["a-1", "b"]).count() == 12
    for bad in ({"names": ["a-"]}, {"version": "v3"}):
        with pytest.raises(FileNotFoundError):
            publishing.load(spark, str(tmp_path), **bad)
    with pytest.raises(ValueError, match="without a unit"):
        publishing.publish(df, F.lit(None), str(tmp_path), "v9")


@pytest.mark.parametrize("at", ["rename", "row"])
def test_a_run_that_fails_between_output_and_ledger(spark, tmp_path, monkeypatch, at):
    df = spark.range(40).select("id", (F.col("id") % 4).cast("string").alias("u"))
    commit, done = publishing.Ledger.commit, []

    def failing(self, unit, staged, rows, run):
        if len(done) == 2:
            if at == "row":  # the output is there, its row isn't
                self.fs.mkdirs(self._path(self.output(unit)).getParent())
                self.fs.rename(self._path(staged), self._path(self.output(unit)))
            raise OSError("lost")
        done.append(unit)
        commit(self, unit, staged, rows, run)

    monkeypatch.setattr(publishing.Ledger, "commit", failing)
    with pytest.raises(OSError, match="lost"):
        publishing.publish(df, F.col("u"), str(tmp_path), "v1")
    monkeypatch.setattr(publishing.Ledger, "commit", commit)
    assert sorted(r.id for r in publishing.load(spark, str(tmp_path)).collect()) == sorted(i for i in range(40) if str(i % 4) in done)
    assert publishing.publish(df, F.col("u"), str(tmp_path), "v1") == ["2", "3"]
    assert publishing.publish(df, F.col("u"), str(tmp_path), "v1") == []
    assert sorted(r.id for r in publishing.load(spark, str(tmp_path)).collect()) == list(range(40))
    assert not list((tmp_path / "_staging").iterdir()) and not list((tmp_path / "_ledger/v1").glob("*.claim"))


def test_claims(spark, tmp_path):
    df = spark.range(6).select("id", F.col("id").cast("string").alias("u"))
    other = publishing.Ledger(spark, str(tmp_path), "v1")
    other.fs.mkdirs(other._path(other.folder))
    assert other.claim("3", "elsewhere", 3600) and not other.claim("3", "again", 3600)
    assert publishing.publish(df, F.col("u"), str(tmp_path), "v1") == ["0", "1", "2", "4", "5"]
    with pytest.raises(publishing.Held, match="3"):
        publishing.publish(df, F.col("u"), str(tmp_path), "v1", strict=True)
    assert publishing.publish(df, F.col("u"), str(tmp_path), "v1", lease=0) == ["3"]
    assert publishing.load(spark, str(tmp_path)).count() == 6


def test_a_killed_run(spark, tmp_path):
    """SIGKILL while the second batch is being written; the next run finishes."""
    code = f"""
    import sys, time
    sys.path.insert(0, {str(pathlib.Path(__file__).parent.parent)!r})
    from corpusloom.session import local_session
    from corpusloom.sources import publishing
    from pyspark.sql import functions as F
    spark = local_session(2, 2, "1g")
    @F.udf("long")
    def slow(i):
        time.sleep(30 if i >= 40 else 0)
        return i
    df = spark.range(80).select("id", F.format_string("%02d", (F.col("id") / 10).cast("int")).alias("u"))
    publishing.publish(df.select(slow("id").alias("id"), "u"), F.col("u"), {str(tmp_path)!r}, "v1", batch=4)
    """
    run = subprocess.Popen([sys.executable, "-c", textwrap.dedent(code)], start_new_session=True, stderr=subprocess.DEVNULL)
    began = time.time()
    while len(list((tmp_path / "_ledger/v1").glob("*.claim"))) < 4 or len(list((tmp_path / "_ledger/v1").glob("*.json"))) < 4:
        assert time.time() - began < 120 and run.poll() is None
        time.sleep(0.2)
    time.sleep(2)
    os.killpg(run.pid, signal.SIGKILL)
    run.wait()
    df = spark.range(80).select("id", F.format_string("%02d", (F.col("id") / 10).cast("int")).alias("u"))
    assert sorted(r.id for r in publishing.load(spark, str(tmp_path)).collect()) == list(range(40))
    assert publishing.publish(df, F.col("u"), str(tmp_path), "v1") == []  # held by the dead run until its claims expire
    assert publishing.publish(df, F.col("u"), str(tmp_path), "v1", lease=0) == ["04", "05", "06", "07"]
    assert sorted(r.id for r in publishing.load(spark, str(tmp_path)).collect()) == list(range(80))
    assert not list((tmp_path / "_staging").iterdir())


def test_documents_file_by_file(spark):
    rows = QUERIES["files_framed"](spark, SF).collect()
    want = duckdb.sql(f"select coalesce(source, '__HIVE_DEFAULT_PARTITION__'), coalesce(lang, '__HIVE_DEFAULT_PARTITION__'), md5(text) from '{SF}/documents.parquet' where length(text) > 0").fetchall()
    every = len(want)
    want = [w for w in want if not (len(w[0]) == 5 and w[0].startswith("src1") and w[1] == "de") and not (w[0] == "src2" and w[1] != "en")]
    assert 0 < len(want) < every
    assert collections.Counter((*(x.partition("=")[2] for x in r.file.split("/")[:2]), r.text) for r in rows) == collections.Counter(want)
    files = sorted({r.file for r in rows})
    assert {r.frame: r.file for r in rows} == {f"documents--{i:04d}": f for i, f in enumerate(files)}


def small_files(root, n):
    for i in range(n):
        folder = root / f"FineWebEdu_{2020 + i % 5}" / "a +b"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i:05d}.jsonl").write_text("".join(json.dumps({"text": f"{i} {j}"}) + "\n" for j in range(i % 4)) + "broken\n")
    (root / "subscene").mkdir()
    (root / "subscene" / "x.jsonl").write_text('{"text": "no"}\n')
    (root / "other.txt").write_text("no\n")


def test_many_small_files_in_few_tasks(spark, tmp_path):
    small_files(tmp_path, 2000)
    every = file_sets.listing(spark, str(tmp_path), "*.jsonl")
    assert every.count() == 2001
    kept = file_sets.listing(spark, str(tmp_path), "*.jsonl", file_sets.SKIPS)
    paths = sorted(r.path for r in kept.collect())
    assert paths == [f"FineWebEdu_2024/a +b/{i:05d}.jsonl" for i in range(4, 2000, 5)]
    dealt = file_sets.dealt(file_sets.numbered(kept), 16 << 20).collect()
    assert [r.path for r in sorted(dealt, key=lambda r: r.at)] == paths
    assert len({r.task for r in dealt}) == -(-sum(r.bytes + file_sets.OPENING for r in dealt) // (16 << 20)) == 7
    read = file_sets.read(kept, str(tmp_path), task_bytes=16 << 20)
    assert read.rdd.getNumPartitions() == 7
    got = sorted((r.file, r.at, r.row, r.text) for r in read.collect() if r.text is not None)
    assert got == [(p, k, j, f"{int(p[-11:-6])} {j}") for k, p in enumerate(paths) for j in range(int(p[-11:-6]) % 4)]
    assert read.filter("text is null").count() == len(paths)


def test_kinds_of_files_and_their_outputs(spark, tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    pq.write_table(pa.table({"body": ["p1", None, "x" * 100_000], "other": [1, 2, 3]}), root / "sub" / "a.parquet")
    (root / "b.jsonl.gz").write_bytes(gzip.compress(b'{"body": "g1"}\n[1]\n{"body": 3}\n{"body": "g2"}\n'))
    (root / "c.txt").write_text("t1\r\n\nt2")
    (root / "empty.jsonl").write_text("")
    files = file_sets.listing(spark, str(root))
    rows = file_sets.frames(files, str(root), "set", corpora.Recipe(key="body", clean=F.upper))
    file_sets.write_each(rows, str(tmp_path / "out"))
    out = {p.name.partition("=")[2]: [pq.read_table(f)["text"].to_pylist() for f in p.glob("*.parquet")] for p in (tmp_path / "out").glob("frame=*")}
    assert out == {"set--0000": [["G1", "G2"]], "set--0001": [["T1\r", "T2"]], "set--0002": [["P1", "X" * 100_000]]}
    for bad in ({"max_docs": 3}, {"max_words": 3}, {"rate": 0.5}, {"invert": True}):
        with pytest.raises(ValueError, match="one by one"):
            file_sets.frames(files, str(root), "set", corpora.Recipe(), **bad)


def test_no_file_left_gives_no_rows(spark, tmp_path):
    small_files(tmp_path, 3)
    none = file_sets.listing(spark, str(tmp_path), "*.jsonl", [file_sets.Rule(".", skip=".")])
    assert file_sets.read(none, str(tmp_path)).count() == 0
