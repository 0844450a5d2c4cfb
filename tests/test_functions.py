"""Functions and operators on small fixtures, with expectations worked out by hand or by Python's own library."""

import collections
import hashlib
import pickle
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import hashing, udfs, urls
from corpusloom.functions import text as T
from corpusloom.operators import chunks, conversations, dedup, filters, ordered, signals, statistics, tokens, uniform
from corpusloom.operators.components import connected_components
from corpusloom.sources import registry


def values(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_random01_is_the_pickled_hash(spark):
    texts = ["", "a", "é" * 100, "x" * 255, "x" * 256, "y" * 1000, "z" * 65_535, "z" * 65_536, "w" * 70_000]
    mask = (1 << 204) - 1
    want = [(int(hashlib.sha256(pickle.dumps(t, 4)).hexdigest(), 16) & mask) / mask for t in texts]
    assert values(spark, hashing.random01(F.col("t")), *texts) == pytest.approx(want, abs=1e-12)


def test_words_and_strip(spark):
    assert values(spark, T.word_count(F.col("t")), " a b \n", "", None, "x") == [2, 0, -1, 1] or values(spark, T.word_count(F.col("t")), " a b \n", "", "x") == [2, 0, 1]
    assert values(spark, T.strip(F.col("t")), " \n a b\t ") == ["a b"]


def test_cleaners(spark):
    assert values(spark, T.clean_legal(F.col("t")), "a /n b  c") == ["a\nb c"]
    assert values(spark, T.clean_legal(F.col("t"), True), "title/nbody", "one") == ["body", "one"]
    assert values(spark, T.clean_speech(F.col("t")), "text - 12 VUES", "said source the press", "see source Z") == ["text", "said ", "see"]
    assert values(spark, T.join_lines(F.col("t")), "exam-\nple a,\n b\nc\nD") == ["example a, b c\nD"]
    assert values(spark, T.join_single_breaks(F.col("t")), "a\nb\n\nc") == ["a b\n\nc"]
    assert values(spark, T.fix_mojibake(F.col("t")), "café".encode().decode("latin-1"), "plain") == ["café", "plain"]
    assert values(spark, T.clean_channel_log(F.col("t")), "#ubuntu-ru hi", "#kubuntu-de hi", "#ubuntu-meeting x") == ["", "#kubuntu-de hi", "#ubuntu-meeting x"]
    assert values(spark, T.drop_annotations(F.col("t")), " .[header] a [x] b. [y]") == ["a. b."]
    assert values(spark, T.mask_pii(F.col("t")), "me@x.org at 10.0.0.255, 999.1.1.1") == ["<email> at <ip>, 999.1.1.1"]
    assert values(spark, udfs.without_common_lines(F.col("t")), "0123456789\n" * 9 + "x", "0123456789\n" * 10 + "x", "short\n" * 20) == ["0123456789\n" * 9 + "x", "x", "short\n" * 20]
    assert values(spark, udfs.without_bad_pages(F.col("t")), "ok\x0c" + "l\n" * 200 + "\x0cend") == ["ok\x0cend"]


def test_hosts(spark):
    rows = ["http://A.org:80/x", "http:////h/x", "a.org/x", "ftp://u@h?q", "http://x y/z", ""]
    assert values(spark, urls.host(F.col("t")), *rows) == ["a.org:80", "h", "", "u@h", "x y", ""]
    assert values(spark, urls.host(F.col("t"), add_scheme=True), "a.org/x") == ["a.org"]


def test_page_numbers():
    pages = [f"Text of a page that says a thing.\n— {n} —\n" for n in range(2, 12)]
    assert not any(f"— {n} —" in udfs.drop_page_numbers("Title\n" + "".join(pages)) for n in range(2, 12))
    assert udfs.drop_page_numbers("no numbers here\nat all\n") == "no numbers here\nat all\n"
    inline = "Head\n" + "".join(f"body text\nChapter (p) ({n})\n" for n in range(2, 9))
    assert "Chapter (p)" in udfs.drop_page_numbers(inline) and "(5)" not in udfs.drop_page_numbers(inline)


def test_glyph_codes():
    assert udfs.fix_glyph_codes("caf(cid:130) et  d(cid:130)jà (cid:1)") == "café et déjà"
    assert udfs.fix_glyph_codes("ac(cid:415)on") == "action"
    assert udfs.fix_glyph_codes("j(cid:133)x") == "jfix"
    assert udfs.fix_glyph_codes("ÉT(cid:144)S") == "ÉTÉS"
    assert udfs.fix_glyph_codes("x (cid:5) y") == "x y"


def test_markdown():
    text = "# T\n\nline\n* a\n** b\n| x | y |\n| 1 | 2 |\n## S\n## S\n#### deep\nend"
    assert udfs.to_markdown(text) == "# T\n\nline\n\n* a\n   * b\n\n| x | y |\n| - | - |\n| 1 | 2 |\n\n## S\n\n**deep**\n\nend\n\n"
    assert udfs.to_markdown("a\nb", 0) == "a\nb\n"
    assert udfs.merge_scripts("M$^{me}$ x$_1$$^2$ y") == "$M^{me}$ $x_12$ y".replace("$M^{me}$", "Mme").replace("$x_12$", "$x_1^2$")


def test_languages_and_bilingual():
    assert max(udfs.language_scores("le chat est dans la maison"), key=udfs.language_scores("le chat est dans la maison").get) == "fr"
    got = udfs.split_bilingual("the cat is in the house\tle chat est dans la maison")
    assert got == {"text_en": "the cat is in the house", "text_fr": "le chat est dans la maison"}
    got = udfs.split_bilingual("le chat  est dans la maison  the cat is  in the house")
    assert got["text_en"] == "the cat is  in the house" and got["text_fr"] == "le chat  est dans la maison"


def test_bilingual_split_takes_whole_texts(spark, tmp_path):
    import hashlib

    from corpusloom.plans.cleaning import bilingual_split

    fr = [f"le chat {i} est dans la maison " + "et il est avec nous " * 30 + f"fin{i}" for i in range(7)]
    en = [f"the cat {i} is in the house " + "and it was on the hill " * 30 + f"end{i}" for i in range(3)]
    rows = [(10 * i + 3, t, "fr") for i, t in enumerate(fr)] + [(i, t, "en") for i, t in enumerate(en)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    got = {tuple(r) for r in bilingual_split(spark, str(tmp_path)).select("r", "text_en", "text_fr").collect()}
    assert got == {(i, md5(en[i % 3]), md5(fr[i])) for i in range(7)}


def test_robots():
    assert udfs.may_fetch("User-agent: CCBot\nDisallow: /a", "http://h/b") and not udfs.may_fetch("User-agent: CCBot\nDisallow: /a", "http://h/a/x")


def test_reason_rules(spark):
    columns = [s for _, s, _, _ in filters.WEB_RULES]
    good = dict.fromkeys(columns, 0.0) | {"perplexity": 10.0, "language_score": 0.65, "sentence_count": 3.0, "word_count": 50.0, "mean_word_length": 3.0}
    rows = [good, *[good | {s: (most + 0.001)} for _, s, _, most in filters.WEB_RULES if most is not None], *[good | {s: least - 0.001} for _, s, least, _ in filters.WEB_RULES if least is not None], dict.fromkeys(columns)]
    at = {s: m for _, s, _, m in filters.WEB_RULES if m is not None}
    rows.append({s: at.get(s, good[s]) for s in columns})
    df = spark.createDataFrame([tuple(None if r[c] is None else float(r[c]) for c in columns) for r in rows], ", ".join(f"{c} double" for c in columns))
    got = [r.reason for r in df.select(filters.reason(filters.WEB_RULES, columns).alias("reason")).collect()]
    want = [None, *[n for n, _, _, most in filters.WEB_RULES if most is not None], *[n for n, _, least, _ in filters.WEB_RULES if least is not None], None, None]
    assert got == want


def test_signals_on_edges(spark):
    df = spark.createDataFrame([(0, ""), (1, "a b a b a b"), (2, "- x\n* y\nend..."), (3, "{ lorem IPSUM #")], "i int, text string")
    rows = {r.i: r for r in signals.with_signals(df).collect()}
    assert rows[0].word_count == 0 and rows[0].top_2gram == 0
    assert rows[1].top_2gram == 1.0 and rows[1].top_3gram == 1.0  # three "a b" hold every character
    assert rows[2].bullet_line_ratio == pytest.approx(2 / 3) and rows[2].ellipsis_line_ratio == pytest.approx(1 / 3)
    assert rows[3].curly_count == 1 and rows[3].lorem_count == 1 and rows[3].no_alpha_word_ratio == 0.5


def test_median_and_perplexity(spark):
    df = spark.createDataFrame([([1.0, 9.0, 2.0],), ([4.0, 2.0],), ([],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(filters.array_median(F.col("v"))).collect()] == [2.0, 3.0, None, None]
    assert [r[0] for r in df.select(filters.perplexity_at_most(F.col("v"), 3.0)).collect()] == [False, True, False, False]


def test_obscene_needs_three(spark):
    bad = F.array(*map(F.lit, ["aa", "bb", "cc"]))
    assert values(spark, filters.is_obscene(F.col("t"), bad), "aa bb, cc!", "aa\nbb cc", "AA bb cc", "aa aa bb") == [True, False, False, False]


def test_press_chunks(spark):
    text = "".join(f"{i:09d}\n" for i in range(3000))
    df = spark.createDataFrame([(text, [100.0, 5000.0, 100.0], ["fr"] * 3, [0.9] * 3), (text, [5000.0] * 3, ["fr"] * 3, [0.9] * 3), ("ab", [100.0], ["fr"], [0.65])], "text string, perplexity array<double>, language array<string>, score array<double>")
    got = [r[0] for r in df.select(chunks.press_text()).collect()]
    # the newline that ends chunk 0 is searched from position 10000, the one before chunk 2 up to 20000
    assert got[0] == text[:10009] + chunks.GAP + text[19999:]
    assert got[1:] == ["", "ab"]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_ordered_operators_under_any_partitioning(spark, parts):
    rng = random.Random(1)
    sizes = [rng.randrange(50) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(sizes)), "i long, n long").repartition(parts)
    kept = sorted(r.i for r in ordered.budget(df, "i", F.col("n"), 3000).collect())
    want, total = [], 0
    for i, n in enumerate(sizes):
        if total >= 3000:
            break
        want.append(i)
        total += n
    assert kept == want
    assert sorted(r.i for r in ordered.stride(df, "i", 9).collect()) == list(range(8, 400, 9))
    assert {r.i: r.row for r in ordered.numbered(df, "i").collect()} == {i: i for i in range(400)}
    assert ordered.budget(df.limit(0), "i", F.col("n"), 5).collect() == []


def test_sample_and_its_inverse_share_out(spark):
    df = spark.range(500)
    low = {r.id for r in df.filter(hashing.random01(F.col("id")) <= 0.3).collect()}
    high = {r.id for r in df.filter(hashing.random01(F.col("id")) > 0.3).collect()}
    assert not low & high and len(low | high) == 500 and 100 < len(low) < 200


def test_minhash_finds_near_copies_and_is_idempotent(spark):
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(200)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(10):
        words = base[i].split()
        words[rng.randrange(200)] = "changed"
        rows.append((100 + i, " ".join(words)))
    rows += [(200, "too short"), (201, "too short"), (202, None), (203, base[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clusters = {r.doc_id: r.cluster for r in dedup.minhash_clusters(df).collect()}
    assert all(clusters[100 + i] == i for i in range(10)) and clusters[203] == 3
    assert clusters[200] == 200 and clusters[201] == 201 and clusters[202] == 202
    once = dedup.minhash(df)
    assert sorted(r.doc_id for r in once.collect()) == [*range(20), 200, 201, 202]
    assert once.count() == dedup.minhash(once).count()


def test_components_on_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5), (None, 3)], "src long, dst long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
    assert connected_components(edges.limit(0)).collect() == []


def test_uniform_metadata(spark):
    df = spark.createDataFrame([("a", 7, "None", "1900", "fra", "s", "p")], "doc_id string, id int, author string, authoryearofbirth string, lang string, source string, max_stars_repo_name string")
    row = uniform.uniformise(df, {"dataset_title": "x"}).collect()[0].asDict()
    assert row["id"] == "a" and row["language"] == "fr" and "max_stars_repo_name" not in row
    assert row["author"] == '{"authoryearofbirth":1900}' and row["extra"] == '{"subset":"s"}'


def test_registry():
    reg = registry.Registry()
    for n in ("Wiki.fr", "Wiki.en", "Books"):
        reg.add(n, lambda s: s.range(1))
    reg.group("tok", ["Books", "Wiki"])
    assert reg.expand("Wiki") == ["Wiki.en", "Wiki.fr"] and reg.expand("tok") == ["Books", "Wiki.en", "Wiki.fr"] and len(reg.expand("all")) == 3
    with pytest.raises(KeyError):
        reg.expand("nothing")
    assert [registry.config_name(n) for n in ("default", "claire-fr", "croissant-aligned", "CroissantAligned", "fr/Claire")] == ["default", "fr/Claire", "CroissantAligned", "CroissantAligned", "fr/Claire"]
    assert registry.pick_files([f"d/{i}.parquet" for i in (10, 2, 1)], 1, 1) == ["d/2.parquet"]
    assert registry.file_order(["x-00002-of-3.parquet", "x-00001-of-3.parquet"])[0].startswith("x-00001")


def test_benchmark_items(spark):
    df = spark.createDataFrame([("Q [title]", ["a", "b"], ["A", "B"], "B", 1), ("Q", ["a", "b"], ["A", "B"], "0", 2), ("Q", ["a"], ["A"], "?", 3)], "q string, c array<string>, l array<string>, a string, k int")
    item = conversations.benchmark_item(F.col("q"), F.col("c"), F.col("l"), F.col("a"), F.col("k"), show_choices=False)
    got = [r[0].asDict() for r in df.select(item).collect()]
    assert got[0] == {"prompt": "Q.", "positive": ["b"], "negative": ["a"]}
    assert got[1]["positive"] == ["a"] and got[2]["positive"] == []


def test_parallel_text_keeps_both_texts(spark):
    df = spark.range(300).select("id", F.lit("hello").alias("a"), F.lit("bonjour").alias("b"))
    rows = df.select(conversations.parallel_text(F.col("a"), F.col("b"), F.lit("en"), F.lit("fr"), F.col("id")).alias("p")).select("p.*").collect()
    assert all("hello" in r.text and "bonjour" in r.text for r in rows)
    plain = [r for r in rows if (r.lang_1, r.lang_2) == ("en", "fr") and r.text.startswith("hello")]
    assert 90 < len(plain) < 220 and len({r.text for r in rows}) > 60


def test_bpe_merges():
    assert tokens.learn_merges([("aaab", 5), ("aab", 3)], 2) == [("a", "a"), ("a", "b")]
    assert tokens.learn_merges([("xy", 1)], 5) == []
    assert tokens.cut_before_digits("a" * 10, 100) == ["a" * 10]
    text = ("word " * 30 + "7") * 5
    assert "".join(tokens.cut_before_digits(text, 200)) == text and len(tokens.cut_before_digits(text, 200)) > 1


def plain_merges(counts, most, least=2):
    """BPE by counting every pair anew."""
    words, out = {w: list(w) for w in counts}, []
    while len(out) < most:
        pairs = collections.Counter()
        for w, symbols in words.items():
            for pair in zip(symbols, symbols[1:]):
                pairs[pair] += counts[w]
        best = min(((-n, p) for p, n in pairs.items() if n >= least), default=None)
        if best is None:
            break
        out.append(best[1])
        words = {w: tokens._joined(symbols, {best[1]}) for w, symbols in words.items()}
    return out


def test_learner_and_steps_taken_back():
    """Merges in memory with ties, doubled symbols and symbols made in two ways; what is taken back leaves no trace; guesses are accepted up to the first wrong one."""
    rng = random.Random(7)
    for case in range(300):
        letters = "abcdefgh"[: rng.randint(2, 8)]
        counts = collections.Counter("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 40)))
        counts = {w: n * rng.randint(1, 3) for w, n in counts.items()}
        want = plain_merges(counts, 12)
        assert tokens.learn_merges([*counts.items()], 12) == want, case
        learner = tokens.Learner([*counts.items()])
        pairs = +learner.pairs
        for p in [*want, ("a", "b")]:
            learner.merge(p)
        learner.take_back(len(want) + 1)
        assert +learner.pairs == pairs and ["".join(w) for w in learner.words] == [*counts]
        assert learner.best() == plain_merges(counts, 1, 1)[0] if pairs else learner.best() is None
        ranks = {}
        for i, p in enumerate(want):
            ranks.setdefault(p, []).append(i)
        for w in counts:
            symbols = [*w]
            for p in want:
                symbols = tokens._joined(symbols, {p})
            assert tokens.symbols_of(w, ranks) == symbols, case


@pytest.mark.parametrize(("sample", "rivals", "most"), [(100_000, 50_000, 500), (3, 50_000, 8), (40, 5, 8)])
def test_merges_learnt_in_a_table(spark, monkeypatch, sample, rivals, most):
    """The trainer in Spark gives the merges of the one in memory, with a sample that guesses well, badly or soon not at all, and with few pairs allowed on the driver."""
    monkeypatch.setattr(tokens, "SAMPLE", sample)
    monkeypatch.setattr(tokens, "MOST_RIVALS", rivals)
    rows = [("low lower lowest new newer 😀😀😀😀 aaaa aaa",), ("the new tower, the lower tower; 2024 2024 !!!! !!",), (None,), ("",), ("z" * 3000,)]
    df = spark.createDataFrame(rows * 3, "text string")
    assert tokens.train(df, most, at_driver=0, least=4) == tokens.train(df, most, least=4)
    assert tokens.train(df.filter("false"), 5) == tokens.train(df.filter("false"), 5, at_driver=0) == []


def test_merges_within_an_alphabet(spark):
    df = spark.createDataFrame([("aab xab aab",), ("ayb",)], "text string")
    counts = {r.token: r.n for r in tokens.within_alphabet(tokens.pre_token_counts(df), 3).collect()}
    assert counts == {"aab": 1, " ab": 1, " aab": 1, "ab": 1}
    assert tokens.train(df, 3, alphabet=3) == tokens.train(df, 3, alphabet=3, at_driver=0) == plain_merges(counts, 3)


def test_at_least_digits(spark):
    df = spark.createDataFrame([(0.0,), (12.5,), (0.1,), (0.05,), (0.00123,)], "x double")
    assert [r[0].strip() for r in df.select(statistics.at_least_digits(F.col("x"))).collect()] == ["0.000", "12.500", "0.100", "0.0500", "0.00123"]


def test_error_classes(spark):
    from corpusloom.plans.web import ERRORS

    assert values(spark, filters.error_class(F.col("t")), *ERRORS) == ["[Errno 111] Connection refused", "Read timed out", "connect timeout", "404 Client Error", "4xx Client Error", "5xx Server Error", "Other error", "[Errno -2] Name or service not known"]


def test_recipes(spark):
    from corpusloom.sources import corpora

    old = spark.createDataFrame([("1", "1900", "1950", None, "fr", "a\n\n            *** END OF THE PROJECT GUTENBERG EBOOK"), ("2", "1900", "1943", None, "fr", "b"), ("3", None, None, "copyright", "en", "c"), ("4", None, None, None, "de", "")], "id string, authoryearofbirth string, authoryearofdeath string, usagerights string, language string, text string")
    assert [r.text for r in corpora.load(old, corpora.RECIPES["Gutenberg"]).collect()] == ["b"]
    code = spark.createDataFrame([("h", "tex", "x"), ("i", "bib", "y")], "hexsha string, ext string, content string")
    rows = corpora.load(code, corpora.RECIPES["TheStack.tex"], metadata=True).collect()
    assert [(r.text, r.id, r.extra) for r in rows] == [("x", "h", '{"ext":"tex"}')]
    math = spark.createDataFrame([({"Body": "Q"}, [{"Body": "A"}, {"Body": "B"}])], "question struct<Body:string>, answers array<struct<Body:string>>")
    assert corpora.load(math, corpora.RECIPES["MathPile.StackExchange"]).first().text == "QA\n\nB"
    film = spark.createDataFrame([((["a", "b"],),), (None,)], "fr struct<subtitles:array<string>>")
    assert [r.text for r in corpora.load(film, corpora.RECIPES["Subscene"]).collect()] == ["a\nb"]
    pair = spark.createDataFrame([("1", " one ", "un", "en", "fr")], "id string, text_1 string, text_2 string, lan_1 string, lan_2 string")
    assert "one" in corpora.load(pair, corpora.RECIPES["EuroparlAligned"]).first().text


def test_chats_and_benchmarks(spark):
    from corpusloom.sources import corpora

    df = spark.createDataFrame([("do", "", "fine"), ("do", "this", "As ChatGPT I")], "instruction string, input string, output string")
    rows = corpora.render_chat(df, "Alpaca").collect()
    assert [r.text for r in rows] == ["<s><|start_header_id|>user<|end_header_id|>\n\ndo<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\nfine<|eot_id|>"]
    foreign = spark.createDataFrame([([("human", "hi"), ("gpt", " yo ")],)], "conversations array<struct<from:string,value:string>>")
    assert corpora.render_chat(foreign, "Magpie").first().text.endswith("assistant<|end_header_id|>\n\nyo<|eot_id|>")
    swag = spark.createDataFrame([(1, "C", ["a", "b"], "1"), (2, "D", ["a", "b"], "")], "k int, ctx string, endings array<string>, label string")
    assert [(r.k, r.positive, r.negative) for r in corpora.benchmark(swag, "Hellaswag", "k", False).collect()] == [(1, ["b"], ["a"])]
    mmlu = spark.createDataFrame([(1, "Q", ["a", "b", "c", "d"], 2)], "k int, question string, choices array<string>, answer int")
    assert corpora.benchmark(mmlu, "MMLU", "k", False).first().positive == ["c"]


def test_previews(spark):
    from pyspark.sql import types

    from corpusloom.operators import reports

    df = spark.createDataFrame([([1, 2, 3, 4], "x" * 200)], "a array<int>, t string")
    row = df.select(reports.preview(F.col("a"), df.schema["a"].dataType), reports.preview(F.col("t"), types.StringType(), 5), reports.visible(F.lit("a b\n"))).first()
    assert tuple(row) == ("[1, ..., 4]", "xxxxx...", "a▁b\\n")


def test_minhash_within_groups(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, "a", text), (2, "a", text), (3, "b", text)], "doc_id long, snapshot string, text string")
    assert sorted(r.doc_id for r in dedup.minhash(df, within=["snapshot"]).collect()) == [1, 3]


def test_exact_dedup_of_null_and_repeated_ids(spark):
    from corpusloom.operators import dedup

    rows = [(1, "a"), (2, "a"), (None, "a"), (None, "b"), (None, "c"), (None, "c"), (3, "d"), (3, "d"), (3, "e"), (4, None), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in dedup.exact(df).collect()), key=str)
    assert got == sorted([(1, "a"), (None, "b"), (None, "c"), (3, "d"), (3, "e"), (4, None)], key=str)
    assert dedup.exact(df.limit(0)).collect() == []


def test_names_of_many_parts(spark):
    from corpusloom.operators import uniform

    name = "stats_" + "--".join(f"p{i}" for i in range(12)) + ".json"
    own = "stats_p0--fr--" + "--".join(f"p{i}" for i in range(12)) + ".json"
    df = spark.createDataFrame([(name,), (own,)], "f string").select(*[c.alias(k) for k, c in uniform.parsed_name(F.col("f")).items()])
    assert [r.subset for r in df.collect()] == ["-".join(f"p{i}" for i in range(1, 12)), "-".join(f"p{i}" for i in range(12))]


def test_shared_folder_needs_one(monkeypatch):
    from types import SimpleNamespace

    from corpusloom.sources import scratch

    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(master="spark://host:7077", applicationId="x", getConf=lambda: conf)
    with pytest.raises(ValueError, match="checkpoint"):
        scratch.shared_dir(SimpleNamespace(conf=conf, sparkContext=context))
    context.master = "local[4]"
    assert scratch.shared_dir(SimpleNamespace(conf=conf, sparkContext=context)).startswith("file:")


@pytest.mark.parametrize("block_rows", [10, 1000])
def test_running_sums_in_blocks(spark, block_rows):
    from corpusloom.operators import ordered

    rows = [(i * 7919 % 5000, i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = {r.k: r.s for r in ordered.with_running(df, "k", F.col("v"), "s", block_rows=block_rows).collect()}
    total, want = 0, {}
    for k, v in sorted(rows):
        total += v
        want[k] = total
    assert got == want


def test_page_numbers_read_by_ocr():
    pages = "".join(f"A page that says a thing.\n- {str(n).replace('1', 'l', 1) if n > 11 else n} -\n" for n in range(2, 20))
    left = udfs.drop_page_numbers("Title\n" + pages)
    assert "- 9 -" not in left and "- l3 -" not in left and left.count("says a thing") == 18


def test_glyphs_between_cases():
    assert udfs.fix_glyph_codes("a(cid:152)o") == "ão"
    assert udfs.fix_glyph_codes("AB(cid:130)CD") == "AB CD"
    assert udfs.fix_glyph_codes("(cid:130)Cole") == " Cole"
    assert udfs.fix_glyph_codes("mot (cid:160) fin") == "mot fin"


def test_shape_signals_against_regular_expressions():
    import re
    import unicodedata

    import numpy as np
    import pyarrow as pa

    from corpusloom.functions import kernels as K

    rng = random.Random(21)
    texts = ["".join(rng.choice(["a", "B", "é", "7", "#", ".", ".", "..", "…", "-", "*", "•", "▪", " ", " ", "\n", "\r", " ", "　", "\t", "{", "!", "?", "lorem ipsum", "LoRem Ipsum", "日"]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", "...", "\n", "\n\n", "...\r", "... ", "lorem ipsu"]
    got = signals.shape_rows(*K.text_bytes(pa.array(texts)))
    for text, row in zip(texts, got, strict=True):
        words = [w for w in re.split("[" + "".join(map(chr, signals.WHITE)) + "]+", text) if w]
        n, lines = max(len(words), 1), text.split("\n")
        want = [
            len(words), sum(map(len, words)) / n, len(re.findall(r"#|\.\.\.|…", text)) / n,
            sum(bool(re.match(r" *[-*•▪‣]", x)) for x in lines) / len(lines), sum(bool(re.search(r"(\.\.\.|…) *(?=[\r\x85  ]?\Z)", x)) for x in lines) / len(lines),
            sum(not any(unicodedata.category(c)[0] == "L" for c in w) for w in words) / n,
            len(re.findall("[{}]", text)), text.lower().count("lorem ipsum"), len(re.findall("[.!?]+", text)),
        ]
        assert np.allclose(row, want), (text, row, want)


def test_minhash_clusters_against_all_pairs(spark):
    """Clusters are the components of all pairs that share a band, and one row of each stays."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    bands = {r.doc_id: r.b for r in docs.select("doc_id", dedup.band_hashes(F.col("text")).alias("b")).collect()}
    root = {d: d for d in bands}
    pairs = [(a, b) for a in bands for b in bands if b < a and bands[a] and bands[b] and any(x == y for x, y in zip(bands[a], bands[b], strict=True))]
    while any(root[a] != root[b] for a, b in pairs):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert len(set(root.values())) < len(root)
    assert {r.doc_id: r.cluster for r in dedup.minhash_clusters(docs).collect()} == root
    assert sorted(r.doc_id for r in dedup.minhash(docs).collect()) == sorted(set(root.values()))
    text = {r.doc_id: r.text for r in docs.collect()}
    same = {}
    for d, t in text.items():
        if bands[d]:
            same.setdefault(t, set()).add(root[d])
    assert all(len(r) == 1 for r in same.values())  # equal texts are in one cluster


def test_pre_token_merges_by_hand(spark):
    words = {"low": 3, "lower": 2, "newest": 6, "widest": 3}
    merges = tokens.train(spark.createDataFrame([(w,) for w, n in words.items() for _ in range(n)], "text string"), merges=4)
    assert len(merges) == 4
    parts = {w: list(w) for w in words}
    for a, b in merges:  # each merge is a most frequent pair of what the ones before left
        count = {}
        for w, n in words.items():
            for p in zip(parts[w], parts[w][1:]):
                count[p] = count.get(p, 0) + n
        assert count.get((a, b), 0) == max(count.values()), (a, b, count)
        for w, p in parts.items():
            k = 0
            while k + 1 < len(p):
                if (p[k], p[k + 1]) == (a, b):
                    p[k : k + 2] = [a + b]
                k += 1


def test_row_numbers_within_groups(spark):
    rows = [(k, None if k % 5 == 0 else "big" if k % 5 < 4 else f"g{k % 40}") for k in range(2000)]
    df = spark.createDataFrame(rows, "k int, g string").repartition(4)
    got = {r.k: r.n for r in ordered.numbered(df, "k", "n", within="g").collect()}
    seen, want = {}, {}
    for k, g in rows:
        want[k] = seen[g] = seen.get(g, -1) + 1
    assert got == want


def test_blocks_are_cut_again_where_they_are_too_many(spark, monkeypatch):
    from corpusloom.operators import ordered

    monkeypatch.setattr(ordered, "MOST_BLOCKS", 4)
    rows = [(None if i % 100 == 7 else i * 7919 % 5000, i, i % 5, f"g{i % 3 // 2}") for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, i int, v int, g string").repartition(5)
    cut = ordered._blocked(df, "k", 50).groupBy("_block").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n")).orderBy("_block").collect()
    assert 14 <= len(cut) <= 16 and max(r.n for r in cut) < 300
    assert all(a.hi is None or a.hi < b.lo for a, b in zip(cut, cut[1:], strict=False))
    whole = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    total, want, seen, numbers = 0, {}, {}, {}
    for _, i, v, g in whole:
        total += v
        want[i] = total
        numbers[i] = seen[g] = seen.get(g, -1) + 1
    assert {r.i: r.s for r in ordered.with_running(df, "k", F.col("v"), "s", 50, ["i"]).collect()} == want
    assert ordered.numbered(df.limit(0), "k").collect() == []
    distinct = df.filter("k is not null")
    ends = {r.i: r.e for r in ordered.with_earlier(distinct, "k", "v", "e", block_rows=50).collect()}
    known = [r for r in whole if r[0] is not None]
    assert ends == {r[1]: (known[n - 1][2] if n else None) for n, r in enumerate(known)}
