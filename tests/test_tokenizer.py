"""The tokenizer's steps against the public tokenizers library, plain Python and SQL."""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import udfs
from corpusloom.operators import tokenizer as Z
from corpusloom.operators import tokens as K
from corpusloom.plans.catalogue import QUERIES

library = pytest.importorskip("tokenizers")
ODD = [None, "", " ", "▁", "▁x", " lead", "tail ", "a  b (c)\n\n x12½², Ⅷ", "(²)▁²", "a b\x0bc", "é (é", "x\r\n\0y", "l'été (« ok ») 3,14", "<0x41>", "\U0001f600 \U0001f601a", "the end (", "\t\tx\n\n\n", "1 22 333", "a" * 50_000]


def theirs(text, spaces="prefix_all", single_digits=True, own_marks=True):
    """Pieces by the library's own normalisers and pre-tokenizers, one for each step."""
    n, p, r = library.normalizers, library.pre_tokenizers, library.Regex
    steps = [n.NFC(), n.Replace(r(r"[\r\x00]"), "")]
    steps += [n.Replace(r(rf"{'[' if c != '[' else ''}{c if c != '[' else chr(92) + '['}{']' if c != '[' else ''}(?=[ \w])"), c + " ") for c in Z.SPACE_AFTER] if spaces == "prefix_all" else []
    cuts = [] if spaces == "split" else [p.Metaspace(replacement=Z.SPACE, prepend_scheme="first")]
    if spaces == "split":
        steps.append(n.Replace(r(r"[  ]"), Z.SPACE))
        cuts.append(p.Split(r(f"[{Z.SPACE}\n\t]"), behavior="isolated"))
    if own_marks:
        cuts.append(p.Split(r(rf"{'' if spaces == 'split' else Z.SPACE + '?'}[^\w\s{Z.SPACE}]+"), behavior="isolated"))
        cuts += [p.Split(r(r"[\n\t]"), behavior="isolated")] if spaces != "split" else []
    cuts.append(p.Digits(individual_digits=single_digits))
    return [x for x, _ in p.Sequence(cuts).pre_tokenize_str(n.Sequence(steps).normalize_str(text))]


def samples():
    rng = random.Random(5)
    odd = "ab é1²½Ⅷ_-.,()[]{}/<>'’\"«»“”‘‚‹—–―\n\t\r ‍́▁Ⓐ中किم٣ \x85\x1c\U0001f600"
    return ODD + ["".join(rng.choice(odd) for _ in range(rng.randint(1, 40))) for _ in range(400)]


@pytest.mark.parametrize("ways", [{}, {"spaces": "prefix_sos"}, {"spaces": "split"}, {"own_marks": False}, {"single_digits": False}, {"spaces": "split", "own_marks": False}])
def test_pieces_are_those_of_the_library(spark, ways):
    texts = samples()
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", Z.pieces(F.col("text"), **ways).alias("p")).collect()
    for r in rows:
        assert r.p == (None if texts[r.i] is None else theirs(texts[r.i], **ways)), (texts[r.i], ways)


def test_every_letter_and_mark_is_cut_as_the_library_does(spark):
    blocks = [(0x20, 0x600), (0x600, 0x700), (0x900, 0xA00), (0xE00, 0xE80), (0x1E00, 0x2400), (0x2460, 0x2600), (0x3000, 0x3200), (0x4E00, 0x4E20), (0xAC00, 0xAC20), (0xFF00, 0xFFF0)]
    texts = [f"a{chr(c)}b {chr(c)}" for lo, hi in blocks for c in range(lo, hi) if unicodedata.category(chr(c)) != "Cn"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", Z.pieces(F.col("text")).alias("p")).collect()
    wrong = [(texts[r.i], r.p, want) for r in rows if r.p != (want := theirs(texts[r.i]))]
    assert not wrong


def test_composed_like_python(spark):
    texts = [f"{chr(c)}̣́" for c in range(0x20, 0x3000) if unicodedata.category(chr(c)) != "Cn"] + ["a\r\0b", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", udfs.normalise_unicode(F.col("text")).alias("t")).collect()
    for r in rows:
        assert r.t == (None if texts[r.i] is None else unicodedata.normalize("NFC", texts[r.i]).replace("\r", "").replace("\0", ""))


@pytest.mark.parametrize("spaces", ["prefix_all", "prefix_sos", "split"])
def test_bytes_and_back(spark, spaces):
    texts = samples()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = df.select("i", Z.decoded(Z.symbols(Z.pieces(F.col("text"), spaces), list("abc" + Z.SPACE)), spaces).alias("t")).collect()
    for r in rows:
        want = texts[r.i]
        if want is not None:
            want = unicodedata.normalize("NFC", want).replace("\r", "").replace("\0", "")
            want = re.sub(f"([{re.escape(Z.SPACE_AFTER)}]){Z.SPACE}", r"\1", want) if spaces == "prefix_all" else want
            want = want.replace(Z.SPACE, " ")
            want = want.replace(" ", " ") if spaces == "split" else want.removeprefix(" ")
        assert r.t == want, (texts[r.i], spaces)


def test_symbols_by_hand(spark):
    row = spark.range(1).select(Z.symbols(F.array(F.lit("▁é"), F.lit("a")), ["a", "▁"]).alias("s"), Z.decoded(F.array(F.lit("▁a"), F.lit("<0xFF>"), F.lit("<0xC3>"), F.lit("<0xA9>"))).alias("t")).first()
    assert row.s == ["▁", "<0xC3>", "<0xA9>", "a"]
    assert row.t == "a�é"


def test_run_merges_make_the_longest_runs(spark):
    merges = Z.with_run_merges([("a", "b"), ("▁", "▁")])
    model = library.Tokenizer(library.models.BPE({t: i for i, t in enumerate(Z.vocabulary(merges, "ab"))}, merges))
    texts = [c * n for c in "▁\t\n" for n in range(1, 30)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", Z.runs(F.col("t")).alias("r")).collect()
    for r in rows:
        assert r.r == model.encode(texts[r.i]).tokens
    assert Z.with_run_merges([("▁", "▁"), ("a", "b")])[0] == ("a", "b")
    assert len(Z.run_merges()) == 28 + 6 + 1


def test_a_tokenizer_learnt_and_used(spark):
    df = spark.createDataFrame([(t,) for t in ["(abc abc", "abc, abc 11", None, ""] * 3], "text string")
    counts = K.pre_token_counts(df, cut=Z.pieces)
    assert {r.token: r.n for r in counts.collect()} == {"▁(": 3, "▁abc": 9, "▁": 3, ",": 3, "1": 6} | {"▁abc": 12}
    known = Z.alphabet(counts, 4)
    assert known == ["▁", "a", "b", "c"]
    merges = K.train(df, 10, cut=Z.pieces, alphabet=4)
    vocabulary = Z.vocabulary(Z.with_run_merges(merges), known)
    assert len(vocabulary) == len(set(vocabulary)) and vocabulary[:5] == ["<unk>", "<s>", "</s>", "<pad>", "<0x00>"]
    ranks = {p: [i] for i, p in enumerate(merges)}
    assert K.symbols_of("▁abc", ranks) == ["▁abc"] and "▁abc" in vocabulary


def test_characters_are_counted_as_in_the_pieces(spark):
    texts = samples()
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for spaces in ("prefix_all", "split"):
        want = Counter(c for t in texts if t for p in theirs(t, spaces) for c in p)
        assert {r.token: r.n for r in Z.character_counts(df, spaces=spaces).collect()} == want
    assert Z.character_counts(df.limit(0)).collect() == []


@pytest.mark.parametrize("known", [[], ["a"], list("▁ab中") + ["\U0001f600"]])
def test_symbols_like_python(spark, known):
    texts = samples()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in df.select("i", Z.pieces(F.col("text")).alias("p"), Z.symbols(Z.pieces(F.col("text")), known).alias("s")).collect():
        want = None if r.p is None else [s for c in "".join(r.p) for s in ([c] if c in known else [f"<0x{b:02X}>" for b in c.encode()])]
        assert r.s == want, texts[r.i]


def test_batches_of_any_size_are_worked_on_in_pieces():
    """What comes out at once is bounded, whether a batch has long texts or many; a text longer than the bound stays whole, and nulls and empty texts keep their places."""
    texts = ["ab é" * 20_000, None, "", "x" * (Z.PIECE + 5), "", None, *["aé" * 500] * 2000, None, ""]
    lists = list(Z.symbol_lists(["a", "b", "x", " "])(iter([pa.array(texts), pa.array([], pa.string()), pa.array([None], pa.string())])))
    assert len(lists) > 12 and max(len(x.flatten()) for x in lists) <= Z.PIECE + 5
    together = pa.chunked_array(lists)
    assert together.null_count == 4 and together[0].as_py()[:5] == ["a", "b", " ", "<0xC3>", "<0xA9>"]
    back = list(Z.joined_lists(iter([pa.concat_arrays(lists)])))
    assert len(back) > 10 and [t for x in back for t in x.to_pylist()] == [*texts, None]


def test_long_and_rare_sequences_are_composed_like_python(spark):
    rng = random.Random(7)
    marks = [chr(c) for c in range(0x110000) if unicodedata.combining(chr(c)) or unicodedata.decomposition(chr(c))]
    jamo = [chr(c) for c in (0x1100, 0x1112, 0x1161, 0x1175, 0x11A7, 0x11A8, 0x11C2, 0xAC00, 0xAC01, 0xD7A3)]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(1, 60))) for some in (marks, jamo, [*"ab\r\0", *marks[:200], *jamo]) for _ in range(2000)] + ["e" + "̣́" * 20_000, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", udfs.normalise_unicode(F.col("text")).alias("t")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.t == unicodedata.normalize("NFC", texts[r.i]).replace("\r", "").replace("\0", "")


def test_pieces_and_what_is_decoded_from_them_need_no_python_worker(spark, tmp_path):
    """So executors hold no Python memory, whatever the input's size."""
    texts = samples()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("tokenizer_pieces", "whitespace_runs"):
        plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" in plan and "Python" not in plan and "Arrow" not in plan, plan
    for spaces in ("prefix_all", "prefix_sos", "split"):
        for own_marks in (True, False):
            for single_digits in (True, False):
                p = Z.pieces(F.col("text"), spaces, single_digits, own_marks)
                rows = df.select("text", p.alias("p")).select("text", Z.decoded(F.col("p"), spaces).alias("a"), Z.decoded(F.col("p"), spaces, fallback=False).alias("b")).collect()
                assert len(rows) == len(texts) and all(r.a == r.b for r in rows)
