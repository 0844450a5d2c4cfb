"""Readers, sinks, token files and streams."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import indexed_tokens, readers, sinks
from corpusloom.streaming import incremental


def test_paragraphs(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\nline\n\ntwo\n\n\n\nthree\n")
    assert [r.text for r in readers.paragraphs(spark, str(tmp_path)).collect()] == ["one\nline", "two", "three"]


def test_json_lines_and_files(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"text": "a", "n": 1}\nbroken\n{"text": "b", "n": 2}\n')
    assert [r.n for r in readers.json_lines(spark, str(tmp_path / "l.jsonl"), "text string, n int").collect()] == [1, 2]
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/e/stats_X--fr.json").write_text(json.dumps({"num pages": 3, "num words": 5, "num chars": 9}, indent=1))
    row = readers.json_files(spark, str(tmp_path / "d"), readers.STATS_SCHEMA).collect()[0]
    assert row["num pages"] == 3 and row.file_name == "stats_X--fr.json"


def test_padded_csv_and_cells(spark, tmp_path):
    (tmp_path / "t.csv").write_text(" name , M docs \n a b , 1.5 \n  c ,  \n")
    rows = readers.padded_csv(spark, str(tmp_path / "t.csv")).collect()
    assert [tuple(r) for r in rows] == [("a b", "1.5"), ("c", None)]
    cells = spark.createDataFrame([(" 3 ",), ("2.5",), ("x",)], "v string").select(readers.typed(F.col("v")).alias("t")).select("t.*").collect()
    assert [(r.whole, r.real, r.text) for r in cells] == [(3, None, None), (None, 2.5, None), (None, None, "x")]


def test_cleaned_copy_wins(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "x"))
    assert readers.cleaned_or_raw(spark, str(tmp_path / "x")).count() == 1
    spark.range(5).write.parquet(str(tmp_path / "x_cleaned"))
    assert readers.cleaned_or_raw(spark, str(tmp_path / "x")).count() == 5
    assert readers.cleaned_or_raw(spark, str(tmp_path / "x"), raw=True).count() == 1


def test_web_records(spark):
    docs = spark.createDataFrame([("s", i, f"t{i}") for i in range(4)], "shard string, row long, raw_content string")
    signals = spark.createDataFrame([("s", i, "{}") for i in range(3)], "shard string, row long, quality_signals string")
    listed = spark.createDataFrame([("s/1",), ("s/1",)], "doc_id string")
    got = {r.doc_id: r.is_duplicate for r in readers.web_records(spark, docs, signals, listed).collect()}
    assert got == {"s/0": False, "s/1": True, "s/2": False}


def test_weights_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("p/a", 0.25), ("p/b", 0.75)], "prefix string, new_ratio double")
    text = sinks.weight_text(df).first().text
    assert text == "0.750000000 p/b 0.250000000 p/a "
    (tmp_path / "mix.txt").write_text(text)
    assert [(r.at, r.weight, r.path) for r in readers.weight_pairs(spark, str(tmp_path / "mix.txt")).collect()] == [(0, 0.75, "p/b"), (1, 0.25, "p/a")]
    with pytest.raises(Exception, match="weight is zero"):
        sinks.weight_text(spark.createDataFrame([("p", 1e-12)], "prefix string, new_ratio double")).collect()


def test_published_layout(spark, tmp_path):
    df = spark.createDataFrame([("t", "s", "code:python"), ("u", None, "fr")], "text string, source string, language string")
    sinks.write_published(df, str(tmp_path), "v1")
    back = spark.read.parquet(str(tmp_path / "data/v1"))
    assert back.filter("category = 'code'").first().text == "t"
    assert back.filter("lang = 'fr'").first().url == ""


def test_indexed_tokens(spark, tmp_path):
    rows = [([1, 2, 3],), ([],), ([70_000],)]
    indexed_tokens.write(spark.createDataFrame(rows, "tokens array<int>").coalesce(1), str(tmp_path / "tok"))
    got = indexed_tokens.read(spark, str(tmp_path / "tok")).orderBy("position").collect()
    assert [r.tokens for r in got] == [[1, 2, 3], [], [70_000]]
    indexed_tokens.write_pair(str(tmp_path / "u16"), iter([[5, 6]]), code=8)
    assert list(indexed_tokens.read_pair(str(tmp_path / "u16"))) == [(0, [5, 6])]


def test_new_files_are_read_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    spark.range(3).write.parquet(source)
    for _ in range(2):
        incremental.new_files(spark, source, target, mark, "id long", lambda d: d.withColumn("x", F.col("id") * 2))
    assert spark.read.parquet(target).count() == 3
    spark.range(10, 14).write.mode("append").parquet(source)
    incremental.new_files(spark, source, target, mark, "id long", lambda d: d.withColumn("x", F.col("id") * 2))
    assert spark.read.parquet(target).count() == 7


def test_streamed_windows(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "event_type", "user_id", "value")
    events.repartition(3).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    query = incremental.windowed_counts(stream).writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("hours").agg(F.sum("n")).first()[0] == events.count()


def test_library_stands_without_the_subpackage():
    import pathlib

    root = pathlib.Path(__file__).parent.parent
    for p in (root / "corpusloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "corpusloom.llm" not in p.read_text()


def test_names_stand_for_datasets(spark):
    from corpusloom.sources import corpora
    from corpusloom.sources.registry import Named, named

    assert named("Claire") == [Named("claire", "fr"), Named("claire", "en")]
    assert named("wikipedia_de") == [Named("wikipedia", "de")]
    assert named("europarl_aligned") == [Named("europarl_aligned")]
    assert named("fine_web_edu_2021") == [Named("fine_web_edu", year="2021")]
    assert [d.part for d in named("tok")] == ["train", "test"] and [d.part for d in named("tok_test")] == ["test"]
    assert {d.family for d in named("all")} - {d.family for d in named("all", non_commercial=False)} == {"persee"}
    assert all(corpora.recipes_of(d) for d in named("all"))
    assert corpora.recipes_of(Named("cultura_x", "de")) == ["CulturaX.other"] and corpora.recipes_of(Named("cultura_x", "fr")) == ["CulturaX.fr"]
    with pytest.raises(KeyError):
        corpora.recipes_of(Named("nope"))
    rows = corpora.load_named("claire", lambda d, recipe: spark.createDataFrame([(f"{recipe} {d.language}",), ("",)], "text string")).collect()
    assert [(r.dataset, r.language, r.year, r.text) for r in rows] == [("Claire", "fr", None, "Claire fr"), ("Claire", "en", None, "Claire en")]


def test_lookup_without_a_match_is_an_error(spark):
    from corpusloom.operators.statistics import matched

    left, right = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int"), spark.createDataFrame([("a", 3)], "k string, y int")
    assert [tuple(r) for r in matched(left.filter("k = 'a'"), right, "k").collect()] == [("a", 1, 3)]
    with pytest.raises(Exception, match="no match for b"):
        matched(left, right, "k").collect()
