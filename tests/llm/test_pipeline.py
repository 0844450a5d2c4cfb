"""The pipeline's stages against brute force, each on its predecessor's rows."""

import random

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from test_operators import brute_components, brute_substring, jaccard  # noqa: E402


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).toArrow())
        tables.append(docs)
    rows = [t.collect() for t in tables]
    assert all(t.columns == columns for t in tables[:-1])
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows[1]}
    good = [d for d, q in quality.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.95 * len(good)
    assert sum(d not in kept for d, q in quality.items() if q == 0) >= 0.6 * sum(q == 0 for q in quality.values())
    want = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in rows[1]], 5, 3)}
    left = {r.doc_id for r in rows[2]}
    text = {r.doc_id: r.text for r in rows[1]}
    assert left <= want  # what 64 bits tell is gone
    low = sorted(want)
    near = {b: [a for a in low if a < b and jaccard(text[a], text[b]) >= 0.8] for b in low}
    assert all(near[b] for b in want - left)  # what else is gone has a near copy
    assert sum(bool(near[b]) for b in left) <= 0.1 * sum(bool(v) for v in near.values()) + 1
    brute = {d: (n, gone, text) for d, n, gone, text in brute_substring([(r.doc_id, r.text) for r in rows[2]], 50)}
    before = {r.doc_id: r for r in rows[2]}
    assert {r.doc_id for r in rows[3]} == {d for d, (n, gone, _) in brute.items() if not gone or gone < n}
    for r in rows[3]:
        n, gone, text = brute[r.doc_id]
        assert r.text == (text if gone else before[r.doc_id].text)
        assert r.n_chars == len(r.text) and r.lang == before[r.doc_id].lang
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(i in r.text for r in rows[4] for i in items)
    assert len(rows[4]) >= len(rows[3]) - sum(any(i.split(" ")[3] in r.text for i in items) for r in rows[3])
    assert {r.doc_id for r in rows[5]} == {r.doc_id for r in rows[4]} and all(r.round_trip for r in rows[5])


def test_run_and_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def unique(n, mark):
    return " ".join(f"{mark}{i}" for i in range(n))


def test_stages_on_odd_rows(spark):
    """Nulls, empty, repeated and very long texts, null and repeated ids, and columns named like the stages' own: exact rows."""
    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    rows = [
        (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "  \n", "en", "s", 3), (4, unique(120, "a"), None, None, None), (4, unique(120, "a"), None, None, None), (5, unique(120, "a"), "fr", "t", 1),
        (None, unique(120, "a"), "en", "s", 1), (None, None, None, None, None), (6, unique(60_000, "w"), "en", "s", 9), (7, unique(60, "a") + " tail", "en", "s", 5), (8, unique(30, "b") + " " + item, "en", "s", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select("*", F.lit("mine").alias("score"), F.lit(9).alias("_id"), F.lit("x").alias("leaks"), F.lit("y").alias("row"), F.lit("z").alias("record"))
    stages = dict(corpus_pipeline.STAGES)
    got = {name: stage(spark, docs, sf) for name, stage in stages.items()}
    assert all(d.columns == docs.columns for name, d in got.items() if name != "tokens")
    assert all(set(d.select("score", "_id", "leaks", "row", "record").collect()) <= {("mine", 9, "x", "y", "z")} for name, d in got.items() if name != "tokens")
    short = {name: sorted(((r.doc_id, r.text and r.text[:8], r.n_chars) for r in d.collect()), key=str) for name, d in got.items() if name != "tokens"}
    whole = sorted(((i, t and t[:8], n) for i, t, _, _, n in rows), key=str)
    assert short["quality"] == whole  # none of them reads like what the labels reject
    assert short["near_duplicates"] == sorted([r for k, r in enumerate((i, t and t[:8], n) for i, t, _, _, n in rows) if k not in (1, 2, 4, 5)], key=str)
    cut = [(7, "tail", 4)]
    assert short["repeated_passages"] == sorted([(i, t and t[:8], n) for i, t, _, _, n in rows if i not in (5, 7) and not (i is None and t)] + cut, key=str)
    assert short["decontaminate"] == sorted([(i, t and t[:8], n) for i, t, _, _, n in rows if i != 8], key=str)
    tokens = got["tokens"].collect()
    assert sorted(((r.doc_id, r.n_tokens > 0, len(r.ids) == r.n_tokens, r.round_trip) for r in tokens), key=str) == sorted(((i, bool(t), True, True) for i, t, *_ in rows), key=str)
    for stage in stages.values():
        assert stage(spark, docs.limit(0), sf).collect() == []


def test_near_copies_by_similarity(spark):
    """One edited copy of each of 300 texts: of those at a Jaccard similarity of 0.80 to 0.85 nearly all go, of those above all, of those below none, and every original stays."""
    rng = random.Random(11)
    words = [f"word{i}" for i in range(5000)]
    rows, kind = [], {}
    for i in range(300):
        n = rng.choice([60, 150, 400])
        text = [rng.choice(words) for _ in range(n)]
        copy = list(text)
        for k in rng.sample(range(n), max(1, round(n * rng.choice([0.012, 0.018, 0.021])))):
            copy[k] = "edited"
        rows += [(i, " ".join(text)), (1000 + i, " ".join(copy))]
        kind[1000 + i] = jaccard(" ".join(text), " ".join(copy))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").select("doc_id").collect()}
    assert left >= set(range(300))
    share = lambda lo, hi: [d not in left for d, j in kind.items() if lo <= j < hi]
    near, close, far = share(0.8, 0.85), share(0.85, 1.1), share(0, 0.8)
    print("copies caught:", sum(near), len(near), sum(close), len(close), sum(far), len(far))
    assert len(near) > 40 and sum(near) >= 0.92 * len(near) and all(close) and not any(far)
