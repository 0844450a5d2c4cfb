"""Queries on tables that differ from the given ones where these hide a fault."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_oracles import rows

from corpusloom.plans.catalogue import ORACLES, QUERIES


@pytest.fixture
def same(spark, tmp_path):
    """Whether a query equals its SQL over these tables: its rows."""

    def run(query, **tables):
        con = duckdb.connect()
        for name, table in tables.items():
            pq.write_table(table, tmp_path / f"{name}.parquet")
            con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
        got = rows(QUERIES[query](spark, str(tmp_path)).toArrow())
        assert got == rows(con.execute(ORACLES[query]).to_arrow_table())
        return got[0]

    return run


def test_benchmark_prompts_keep_line_breaks(same):
    texts = ["Deux.\nChoux.\nVieux x.\nFin", "Voici choices:\nA: x.\nB: y.", "Vieux.\n", "plain"] * 10
    items = pa.table({"item_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    assert len(same("benchmark_prompts", benchmark=items)) == 26


def test_results_concatenated_whole_groups(same):
    keys = range(1, 3001)
    customer = pa.table({"c_custkey": pa.array(keys, pa.int64()), "c_name": [f"Customer#{k:09d}" for k in keys], "c_nationkey": pa.array([k % 2 for k in keys], pa.int32()), "c_mktsegment": ["BUILDING"] * 3000})
    got = same("results_concatenated", customer=customer)
    assert len(got) == 2 and all(1500 in row for row in got)


def test_nearest_name_among_many(spark):
    from corpusloom.plans.mixture import nearest_name

    ours = [f"en{i * 7919 % 10_007}src" for i in range(30)] + [None]
    theirs = [f"src{i}en" for i in range(10_500)]
    got = nearest_name(spark.createDataFrame([(n,) for n in ours], "name string"), spark.createDataFrame([(n,) for n in theirs], "name string")).collect()
    con = duckdb.connect()
    con.register("a", pa.table({"name": ours}))
    con.register("b", pa.table({"name": theirs}))
    want = con.execute("select name, match, d from (select a.name, b.name as match, levenshtein(a.name, b.name)::int as d, row_number() over (partition by a.name order by levenshtein(a.name, b.name), b.name) as r from a, b) where r = 1").fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_batches_end_by_bytes(spark):
    from pyspark.sql import functions as F

    @F.arrow_udf("long")
    def size(a: pa.Array) -> pa.Array:
        return pa.array([a.nbytes] * len(a), pa.int64())

    texts = spark.range(0, 3000, numPartitions=1).select(F.repeat(F.lit("0123456789"), F.lit(1000)).alias("text"), F.array(F.repeat(F.lit("0123456789"), F.lit(1000))).alias("list"))
    assert texts.select(size("text").alias("n")).agg(F.max("n")).first()[0] < 10 << 20
    assert texts.select(size("list").alias("n")).agg(F.max("n")).first()[0] < 10 << 20


@pytest.mark.parametrize("most", [None, 0])
def test_web_spreads_a_common_host(spark, monkeypatch, most):
    from pyspark.sql import functions as F

    from corpusloom.plans import pipelines

    url = F.to_json(F.struct(F.concat(F.when(F.col("id") % 10 > 0, "http://open.org/").otherwise("http://closed.net/"), F.col("id").cast("string")).alias("url")))
    docs = spark.range(0, 400, numPartitions=4).select(F.col("id").alias("doc_id"), F.lit("fr").alias("language"), F.concat_ws(" ", F.lit("un texte"), "id").alias("raw_content"), url.alias("meta"))
    domains = spark.createDataFrame([("open.org",), ("open.org",), ("else.org",)], "domain string")
    if most is not None:
        monkeypatch.setattr(pipelines, "MOST_AT_ONCE", most)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = pipelines.judge_web(docs, domains).select("doc_id", "reason", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(rows) == 400
    assert {r.doc_id for r in rows if r.reason == "cannot_fetch"} == set(range(0, 400, 10))
    tasks = [sum(r.p == p for r in rows) for p in {r.p for r in rows}]
    assert max(tasks) < 200


def test_op5_weighs_all_pairs(spark):
    import numpy as np

    from corpusloom.functions import kernels as K
    from corpusloom.llm import labelled
    from corpusloom.llm import quality_classifier as Q

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = Q.train(docs, labels)
    rows = docs.join(labelled.labelled_ids(labels, "quality"), "doc_id").select("text", "label").collect()
    raw = [(r.text or "").encode() for r in rows]
    x = np.concatenate([Q.form(d, o) for _, _, d, o in K.pieces(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))])
    y = np.array([r.label for r in rows])
    assert np.allclose(model.center, x.mean(0)) and np.allclose(model.scale, x.std(0) + 1e-6, atol=1e-6)
    z = np.clip((x - model.center) / model.scale, -8, 8)
    d = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(15):
        p = 1 / (1 + np.exp(d @ w))
        each = Q.PAIRS / len(d)
        w -= np.linalg.solve(each * (d * (p * (1 - p))[:, None]).T @ d + np.diag(np.full(len(w), Q.RIDGE)), Q.RIDGE * w - each * d.T @ p)
    assert np.abs(model.weights - w).max() < 0.02 * np.abs(w).max()
    s = z @ model.weights
    rate = [(s[y == 1] >= c).mean() + (s[y == 0] < c).mean() for c in np.quantile(s, np.linspace(0, 1, 401))]
    assert (s[y == 1] >= model.cut).mean() + (s[y == 0] < model.cut).mean() >= max(rate) - 0.005


def test_op5_learns_from_every_row(spark):
    from pyspark.sql import functions as F

    from corpusloom.llm import quality_classifier as Q

    ids = spark.range(0, 6000, numPartitions=2)
    docs = ids.select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.repeat(F.lit("word "), (F.col("id") % 50).cast("int"))).alias("text"))
    labels = ids.select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    assert Q.features(docs, labels, "quality").count() == 6000
    assert Q.train(docs, labels) is not None


def documents(rows):
    ids, langs, sources, texts = zip(*rows, strict=True)
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "lang": pa.array(langs, pa.string()), "source": pa.array(sources, pa.string()), "text": pa.array(texts, pa.string())})


def test_template_probabilities_empty_texts_and_null_groups(same):
    rows = [(0, "en", "a", ""), (1, "en", "a", "xyz"), (2, "en", "a", None), (3, "fr", "a", ""), (4, "fr", "a", ""), (5, "de", "a", None), (6, None, "a", "x"), (7, None, "a", "xy"), (8, "de", None, "x"), (9, None, None, "x"), (10, None, None, "x"), (11, "es", "b", "xy"), (12, "es", "b", "x")]
    assert len(same("template_probabilities", documents=documents(rows))) == len(rows)


def test_thesis_chunks_empty_texts_and_ends(same):
    texts = ["", None, " \n ", "\ttabbed\t", "\xa0hard space\u3000\n", "\n x \n", "ab\n" * 700, "é😀\t" * 700, "y" * 500 + "\r" * 500 + " " * 500, "z" * 501]
    rows = [(7 * i - 20, "en", "a", t) for i, t in enumerate(texts)] + [(None, "en", "a", "no number " * 200)]
    assert len(same("thesis_chunks", documents=documents(rows))) == len(rows) - 2


@pytest.mark.parametrize("langs", [["en", "fr"], ["en", None], ["de"]])
def test_tokenizer_mix_counts_whatever_is_drawn(same, langs):
    rows = [(i if i % 20 else None, langs[i % len(langs)], "a", ["", None, "x"][i % 3]) for i in range(60)]
    got = same("tokenizer_mix", documents=documents(rows))
    assert len(got) == 2 and {name for name, n, _ in got if n} == {"en", "fr"} & set(langs)


def test_recipes_drop_empty_texts_unless_told(spark):
    from corpusloom.sources import corpora

    df = spark.createDataFrame([(0, ""), (1, None), (2, "x"), (3, "y")], "id int, text string")
    for budgets, n in (({}, 2), ({"max_chars": 1}, 1), ({"max_words": 1}, 1)):
        assert corpora.load(df, corpora.Recipe(), order="id", **budgets).count() == n
        assert corpora.load(df, corpora.Recipe(), order="id", keep_empty=True, **budgets).count() == n + 2
