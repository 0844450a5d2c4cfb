"""Cleaners that do nothing fail their SQL; languages, templates and chats against plain Python."""

from __future__ import annotations

import collections
import glob
import hashlib
import math
import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from corpusloom.functions import text as T
from corpusloom.functions import udfs
from corpusloom.operators import chunks, conversations, instructions, languages, statistics
from corpusloom.sources import sinks

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


MUTATIONS = [
    ("glyph_codes_fixed", udfs, "without_glyph_codes"), ("glyph_codes_fixed", udfs, "fix_glyph_codes"), ("thesis_cleaned", udfs, "drop_common_lines"), ("thesis_cleaned", udfs, "drop_bad_pages"), ("thesis_cleaned", udfs, "clean_thesis"),
    ("thesis_pages", udfs, "drop_common_lines"), ("thesis_pages", udfs, "drop_bad_pages"), ("common_lines_dropped", udfs, "without_common_lines"), ("lines_joined", T, "join_lines"), ("single_breaks_joined", T, "join_single_breaks"),
    ("pii_masked", T, "mask_pii"), ("pii_replaced", T, "mask_pii"), ("pii_replaced", T, "replace_pii_marks"), ("apostrophes_fixed", T, "fix_apostrophe"), ("wiki_urls_fixed", T, "fix_wiki_url"), ("html_unescaped", udfs, "unescape_html"), ("thesis_chunks", chunks, "thesis_text"),
]


@pytest.mark.parametrize(("query", "module", "name"), MUTATIONS)
def test_a_cleaner_that_does_nothing_fails(spark, duck, monkeypatch, query, module, name):
    want = sorted(duck.execute(ORACLES[query]).fetchall())
    found = lambda: sorted(map(tuple, QUERIES[query](spark, SF).collect()))
    assert found() == want
    monkeypatch.setattr(module, name, lambda text, *_, **__: text)
    assert found() != want


# --- languages ---------------------------------------------------------------


def plain_slots(text):
    raw = text.encode()
    for k, n in enumerate(languages.ORDERS):
        for i in range(len(raw) - n + 1):
            gram = int.from_bytes(raw[i : i + n], "little") + (n << 40)
            x = gram ^ (gram >> 30)
            x = x * 0xBF58476D1CE4E5B9 % 2**64
            x ^= x >> 27
            x = x * 0x94D049BB133111EB % 2**64
            yield ((x ^ (x >> 31)) >> 49) + k * languages.SLOTS


def plain_model(rows):
    counts = {}
    for lang, text in rows:
        counts.setdefault(lang, collections.Counter()).update(plain_slots(text))
    logs = {}
    for lang, c in counts.items():
        for k in range(len(languages.ORDERS)):
            total = sum(n for s, n in c.items() if s // languages.SLOTS == k) + languages.SMOOTH * languages.SLOTS
            logs[lang, k] = total
    return lambda lang, s: math.log((counts[lang][s] + languages.SMOOTH) / logs[lang, s // languages.SLOTS])


def plain_scores(text, log, names):
    v = {k: math.exp(sum(log(k, s) for s in plain_slots(text)) / max(1, len(text))) for k in names}
    return {k: x / sum(v.values()) for k, x in v.items()}


def test_language_scores_by_hand(spark):
    rows = [("fr", "le chat été"), ("en", "the cat sat"), ("fr", "une école"), ("de", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows] + [(None, "xyz", 1)], "lang string, text string, score int")
    model = languages.train(df)
    assert model.languages == ["de", "en", "fr"]
    log = plain_model(rows)
    texts = ["the été", "LE CHAT", "Le", "", "a" * 5000, None]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for among in (None, ["fr", "en"]):
        got = {r.i: [(x.language, x.score) for x in r.s] for r in asked.select("i", languages.scores(F.col("text"), model, among).alias("s")).collect()}
        for i, t in enumerate(texts):
            t = t or ""
            want = plain_scores(t.lower() if t.isupper() else t, log, among or model.languages)
            assert [k for k, _ in got[i]] == sorted(want, key=lambda k: (-round(want[k], 12), k))
            assert all(abs(want[k] - v) < 1e-9 for k, v in got[i])
    with pytest.raises(ValueError, match="no model"):
        languages.scores(F.col("text"), model, ["xx"])


def test_language_guessed_on_held_out_texts(spark):
    """Right on held-out documents of every length; better than counting frequent words on short ones."""
    sf = "/root/testdata/sf0.01"
    lang = dict(duckdb.sql(f"select doc_id, lang from '{sf}/documents.parquet'").fetchall())
    got = QUERIES["language_guessed"](spark, sf).collect()
    assert len(got) == len(lang) and {r.doc_id for r in got if r.held_out} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.language == lang[r.doc_id] for r in got if r.held_out]) > 0.97
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("text <> ''")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = languages.train(docs.filter(~held))
    parts = docs.filter(held).select("lang", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("text", 1, n).alias("t")) for n in (20, 60, 200)])).alias("p")).select("lang", "p.*")
    rows = parts.select("*", languages.scores(F.col("t"), model)[0]["language"].alias("guess")).collect()
    for n, least in ((20, 0.85), (60, 0.95), (200, 0.96)):
        own = [r for r in rows if r.n == n]
        right = np.mean([r.guess == r.lang for r in own])
        listed = np.mean([max(s := udfs.language_scores(r.t), key=s.get) == r.lang for r in own])
        assert right > least and right >= listed, (n, right, listed)


# --- templates and chats ------------------------------------------------------


def u(name, key):
    return int(hashlib.sha256(f"{name}:{key}".encode()).hexdigest()[:8], 16) / 2**32


def test_shares_of_templates(spark):
    """Drawn shares follow the weights: chi-square of each language and kind."""
    ranges = instructions.with_ranges(spark.createDataFrame(instructions.TEMPLATES, "language string, text string"))
    p = {(r.language, r.kind, r.text): r.p for r in ranges.collect()}
    for group in {k[:2] for k in p}:
        assert abs(sum(v for k, v in p.items() if k[:2] == group) - 1) < 1e-12
    keys = spark.range(6000).select("id", F.element_at(F.array(F.lit("en"), F.lit("fr"), F.lit("xx")), (F.col("id") % 3 + 1).cast("int")).alias("l"), F.lit("to").alias("k"))
    got = collections.Counter((r.l, r.k, r.template) for r in instructions.drawn(keys, ranges, "l", "k", "id").collect())
    assert sum(got.values()) == 4000
    for lang in ("en", "fr"):
        cells = {k: v for k, v in p.items() if k[:2] == (lang, "to")}
        chi = sum((got[k] - 2000 * v) ** 2 / (2000 * v) for k, v in cells.items())
        assert chi < 16, (lang, chi)  # 2 degrees of freedom, one in 3,000


def test_french_elision(spark):
    cases = [("du <to>", "anglais", "de l'anglais"), ("de <to>", "anglais", "d'anglais"), ("au <to>", "italien", "à l'italien"), ("du <to>", "français", "du <to>"), ("la version <to> de", "anglais", "la version anglaise de"), ("le <to> et", "espagnol", "l'espagnol et"), ("Du <to>", "Anglais", "De l'Anglais")]
    df = spark.createDataFrame(cases, "t string, n string, want string")
    assert all(r.got == r.want for r in df.select("want", instructions._elided(F.col("t"), "<to>", F.col("n")).alias("got")).collect())


def test_translation_chats_hold_both_texts(spark):
    rows = [(f"Source text {i}", f"Texte cible {i}", *[("en", "fr"), ("fr", "it"), ("de", "es"), ("en", "xx")][i % 4], str(i)) for i in range(800)]
    got = {r.key: r.messages for r in instructions.translation_chats(spark.createDataFrame(rows, instructions.ALIGNED), spark.createDataFrame(instructions.TEMPLATES, "language string, text string")).collect()}
    turns = collections.Counter()
    for a, b, x, y, key in rows:
        turn = u("direction", key) < 0.5
        one, two = (b, a) if turn else (a, b)
        speaks = (y if turn else x) if u("speaks", key) < 0.5 else (x if turn else y)
        if speaks == "xx":
            assert key not in got
            continue
        m = got[key]
        if m is None:
            assert "xx" in (x, y)
            continue
        turns[len(m)] += 1
        said = " ".join(r.content or "" for r in m[:-1])
        if None in [r.content for r in m]:
            assert "xx" in (x, y)  # a language without a name
            continue
        assert one.lower() in said.lower() and two.lower() in m[-1].content.lower() and m[-1].role == "assistant"
        assert "<to>" not in said and "<from>" not in said
        q = instructions.QUOTES[int(u("quotes", key) * len(instructions.QUOTES))]
        assert m[-1].content == q[0] + m[-1].content.removeprefix(q[0]).removesuffix(q[1]) + q[1]
        assert (len(m) == 3) == (u("after", key) < 0.3 and u("history", key) < 0.5)
    assert turns[3] > 50 and turns[2] > 300
    assert {r.turns for r in QUERIES["translation_chats"](spark, SF).collect()} <= {2, 3}


def plain_parallel(a, b, la, lb, key):
    """The same choices, written out as text."""
    draw = lambda salt, options: options[int(hashlib.sha256(f"{salt}:{key}".encode()).hexdigest()[:8], 16) % len(options)]
    sep, bracket, after = draw("separator", conversations.SEPARATORS), draw("brackets", ["", "", "", "", "[]", "()", "{}", "<>"]), draw("after", conversations.AFTER_NAME)
    if draw("prefix", ["0", "1"]) == "0":
        return a + sep + b, la, lb
    clear = "\n" in sep or "\t" in sep or bracket
    style = draw("style", ["code", "own", "first", "second"] if clear else ["own", "first", "second"])
    name = lambda reader, of: conversations.LANGUAGE_NAMES[reader][of]
    labels = {"code": (la, lb), "own": (name(la, la), name(lb, lb)), "first": (name(la, la), name(la, lb)), "second": (name(lb, la), name(lb, lb))}[style]
    if not clear or draw("capital", ["0", "1"]) == "1":
        labels = [x.capitalize() for x in labels]
    sides = [*zip(labels, (a, b), strict=True)]
    if draw("swap", ["0", "1"]) == "1":
        sides.reverse()
    tail = after.replace("\n", "").strip(" ").rstrip(".-—") + bracket[1:] + " " if bracket else after
    (x, one), (y, two) = sides
    return f"{bracket[:1]}{x}{tail}{one}{sep}{bracket[:1]}{y}{tail}{two}", x, y


def test_parallel_texts_by_hand(spark):
    df = spark.range(1200).select("id", F.concat(F.lit("one\x01 "), "id").alias("a"), F.concat(F.lit("deux "), "id").alias("b"), F.element_at(F.array(*map(F.lit, ["en", "fr", "de"])), (F.col("id") % 3 + 1).cast("int")).alias("x"))
    got = df.select("*", conversations.parallel_text(F.col("a"), F.col("b"), F.col("x"), F.lit("it"), F.col("id")).alias("p")).collect()
    for r in got:
        assert tuple(r.p) == plain_parallel(r.a, r.b, r.x, "it", r.id), r.id


# --- statistics ----------------------------------------------------------------


def test_lookup_falls_back_level_by_level(spark):
    totals = spark.createDataFrame([("a", "x", "p", 1), ("a", "x", "---", 2), ("a", "---", "---", 3), ("---", "---", "---", 4), (None, "x", "p", 5)], "l string, n string, s string, w int")
    asked = spark.createDataFrame([("a", "x", "p", 0), ("a", "x", "q", 1), ("a", "y", "p", 2), ("b", "x", "p", 3), (None, "x", "p", 4), (None, "z", None, 5), ("a", "x", "p", 6)], "l string, n string, s string, level_of int")
    got = {r.level_of: (r.w, r.level) for r in statistics.looked_up(asked, totals, ["l", "n", "s"]).collect()}
    assert got == {0: (1, 0), 1: (2, 1), 2: (3, 2), 3: (4, 3), 4: (5, 0), 5: (4, 3), 6: (1, 0)}


def test_statistics_come_with_the_write(spark, duck, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    counts = sinks.write_counted(docs, f"file://{tmp_path}/out")
    want = duck.execute(ORACLES["corpus_stats_folded"]).fetchdf().iloc[0]
    assert counts == {"num pages": want.docs, "num words": want.words, "num chars": want.chars}
    assert spark.read.parquet(f"{tmp_path}/out").count() == want.docs and spark.read.json(f"{tmp_path}/out.json").first()["num words"] == want.words
    assert sinks.write_counted(docs.filter("false"), f"file://{tmp_path}/none") == {"num pages": 0, "num words": 0, "num chars": 0}
    by = {r.lang: (r.pages, r.chars) for r in QUERIES["stats_while_writing"](spark, SF).collect()}
    assert by == {k: (n, c) for k, n, c in duck.execute("select lang, count(*), sum(length(text)) from documents group by lang").fetchall()}
