"""Operators against brute force on small fixtures with nulls, empty and long texts, ties and repeats."""

import collections
import datetime
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.functions import kernels
from corpusloom.llm import byte_bpe, chat_windows, decontamination, labelled, quality_classifier, quality_rules, sharding, simhash, substring_dedup, toxicity, url_filter
from corpusloom.llm.queries import URL_RULES, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, g long, score string, row string"
SCHEMA_NAMES = ["doc_id", "text", "lang", "g", "score", "row"]


def prose(rng, n, words=400):
    return " ".join(f"w{int(rng.random() ** 3 * words)}" for _ in range(n))


def fixture_rows(seed=1, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = prose(rng, rng.choice([0, 1, 2, 30, 60, 120, 300]))
        rows.append([i * 3, text, "en", i, "x", "r"])
    shared = prose(rng, 70)
    for i in (3, 11, 12, 40):
        rows[i][1] += "\n" + shared + "\t \x0b" + prose(rng, 5)
    rows[20][1] = rows[50][1] = rows[51][1] = prose(rng, 200)
    words = prose(rng, 300).split(" ")
    rows[30][1] = " ".join(words)
    words[150] = "other"
    rows[31][1] = " ".join(words)
    rows[5][1] = None
    rows[6][1] = ""
    rows[7][1] = " \n\t"
    rows[8][1] = ("again " * 150) + "Été <b> #x\n\nline one\nline one\n \nline one"
    rows[9][0] = None
    rows[10][0] = rows[9 + 3][0]
    rows[13] = list(rows[12])
    rows.append([1000, prose(rng, 20_000), None, None, None, None])
    return [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_substring(rows, width):
    low = {}
    for doc, text, *_ in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            low[key] = min(low.get(key, (2, 0)), (0, doc) if doc is not None else (1, 0))
    out = []
    for doc, text, *_ in rows:
        w = WORD.findall(text or "")
        gone = set()
        me = (0, doc) if doc is not None else (1, 0)
        for k in range(len(w) - width + 1):
            if low[tuple(w[k : k + width])] < me:
                gone |= set(range(k, k + width))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("width,group", [(50, 1 << 24), (50, 1000), (5, 4000)])
def test_substring_dedup(spark, docs, width, group):
    out = substring_dedup.remove_repeats(docs, width=width, group_bytes=group).collect()
    want = sorted(brute_substring(fixture_rows(), width), key=key)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out), key=key) == want
    for r in out:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_substring_dedup_spreads_one_id(spark):
    """The rows of one id, and those of none, are spread over groups without counting as smaller than one another."""
    rng = random.Random(17)
    shared = [prose(rng, 40) for _ in range(6)]
    rows = [(None if k < 80 else 500 if k < 160 else k * 5, f"{prose(rng, 20)} {shared[rng.randrange(6)]} {prose(rng, 20)}") for k in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plan = substring_dedup.plan_groups(df, 2000)
    assert sorted(plan.parts)[-2:][0] > 3 and len(plan.cuts) > 3
    out = substring_dedup.remove_repeats(df, width=10, group_bytes=2000).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out), key=key) == sorted(brute_substring(rows, 10), key=key)


def test_substring_dedup_groups_by_bytes(spark):
    """A run of long texts is cut into as many groups as its bytes ask for."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, F.repeat(F.lit("word "), 4000)).otherwise(F.lit("a b")).alias("text"))
    plan = substring_dedup.plan_groups(df, 50_000)
    size = np.bincount(np.searchsorted(plan.cuts, np.arange(4000), "right"), weights=np.where(np.arange(4000) < 100, 20_016, 19))
    assert size.max() <= 4 * 50_000


def test_window_hashes_that_agree_in_64_bits():
    h, more = np.array([5, 9, 5, 5, 9], np.uint64), np.array([1, 7, 2, 1, 7], np.uint32)
    by, new = substring_dedup._ordered(h, more)
    assert (h[by].tolist(), more[by].tolist(), new.tolist()) == ([5, 5, 5, 9, 9], [1, 1, 2, 7, 7], [True, False, True, True, False])
    a, b = substring_dedup._unpack(substring_dedup._pack(h[by[new]], more[by[new]]))
    assert (a.tolist(), b.tolist()) == ([5, 5, 9], [1, 2, 7])


def test_substring_dedup_empty(nothing):
    assert substring_dedup.remove_repeats(nothing).collect() == []


def brute_fingerprint(text, width):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    grams = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, width, radius):
    fp = [brute_fingerprint(r[1], width) for r in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if label[i] != label[j] and (fp[i] ^ fp[j]).bit_count() <= radius:
                    label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
                    changed = True
    low = collections.defaultdict(list)
    for x, r in zip(label, rows):
        low[x].append(r[0])
    pick = {x: min((d for d in v if d is not None), default=None) for x, v in low.items()}
    return sorted(((r[0], f, pick[x]) for r, f, x in zip(rows, fp, label)), key=key)


@pytest.mark.parametrize("width,radius", [(3, 2), (5, 3), (3, 14)])
def test_simhash(docs, width, radius):
    out = simhash.near_duplicates(docs, width=width, radius=radius).collect()
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in out), key=key) == brute_components(fixture_rows(), width, radius)


def test_simhash_empty(nothing):
    assert simhash.near_duplicates(nothing).collect() == []


def test_vantage_tree_finds_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    near = base[:900] ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    ball = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    fp = np.unique(np.concatenate([base, near, ball]))
    for radius in (2, 3):
        want = {(i, j) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= radius).tolist() if i < j}
        nodes = simhash.top_tree(fp[::3], 16)
        shard, x, member = simhash.route(nodes, fp, radius)
        assert sorted(x[member].tolist()) == fp.tolist()
        place = {int(v): i for i, v in enumerate(fp)}
        got = set()
        for s in np.unique(shard):
            y = x[shard == s]
            own = {(i, j) for a, b in simhash.link_chunks(y, member[shard == s], radius) for i, j in zip(a.tolist(), b.tolist())}
            got |= {tuple(sorted((place[int(y[i])], place[int(y[j])]))) for i, j in own}
            whole = simhash.reached(y, member[shard == s], radius)
            assert (whole == simhash.reached(y, member[shard == s], radius, most=10)).all()
            assert all(whole[i] == whole[j] for i, j in own)
        assert got == want


def test_keep_one(spark, docs):
    kept = simhash.keep_one(docs, width=3, radius=2, similarity=None)
    assert kept.columns == docs.columns
    rows = kept.collect()
    want = {c for _, _, c in brute_components(fixture_rows(), 3, 2)}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(c for c in want if c is not None)
    assert sum(r.doc_id is None for r in rows) == 1


def jaccard(a, b, width=5):
    sets = []
    for t in (a, b):
        w = [x.lower() for x in WORD.findall(t or "")]
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    return len(sets[0] & sets[1]) / max(len(sets[0] | sets[1]), 1)


def test_keep_one_catches_looser_copies(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 150, 5000)) for i in range(40)]
    for i in range(30):
        words = rows[i][1].split(" ")
        for _ in range(3 if i < 20 else 40):
            words[rng.randrange(150)] = "zz"
        rows.append((100 + i, " ".join(words)))
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = {100 + i for i in range(30) if jaccard(rows[i][1], rows[40 + i][1]) >= 0.8}
    assert set(range(40)) <= kept and 15 <= len(near)
    assert len(near & kept) <= 0.1 * len(near) + 1
    assert {100 + i for i in range(20, 30)} <= kept


def test_keep_one_compares_all_of_a_bucket(spark):
    """Copies near the original, which has the largest id, and not near each other."""
    rng = random.Random(12)
    whole = prose(rng, 400, 5000)
    copies = []
    for i in range(60):
        words = whole.split(" ")
        for k in rng.sample(range(10, 390), 5):
            words[k] = f"zz{i}x{k}"
        copies.append((i, " ".join(words)))
    apart = sum(jaccard(copies[0][1], t) < 0.8 for _, t in copies[1:])
    assert apart > 50 and all(jaccard(whole, t) >= 0.8 for _, t in copies)
    rows = [*copies, (1000, whole), (2000, prose(rng, 400, 5000))]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {0, 2000} <= kept and len(kept) <= 4


def chained(rng, families=40, members=12, words=200):
    """Families in which each text is near the one before it."""
    rows = []
    for f in range(families):
        text = prose(rng, words, 5000).split(" ")
        for m in range(members):
            rows.append((f * 100 + rng.randrange(10) * 10_000 + m, " ".join(text)))
            for k in rng.sample(range(5, words - 5), 3):
                text[k] = f"zz{f}x{m}x{k}"
    return list(dict(rows).items())


def test_keep_one_loses_no_proposed_link(spark):
    """The components of chained near copies are those of all pairs that share a band."""
    rows = chained(random.Random(31))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(df, radius=0).collect()}
    bands = {r.doc_id: r.b for r in df.select("doc_id", simhash.dedup.band_hashes(F.col("text")).alias("b")).collect()}
    label = {d: d for d, _ in rows}
    links = [(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[:i] if any(p == q for p, q in zip(bands[a], bands[b])) and jaccard(x, y) >= 0.8]
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert kept == set(label.values())
    near = [(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[:i] if a % 10_000 // 100 == b % 10_000 // 100 and jaccard(x, y) >= 0.8]
    found = sum(any(p == q for p, q in zip(bands[a], bands[b])) for a, b in near)
    assert found >= 0.9 * len(near)


def test_bitmaps_rule_out_no_similar_pair(spark):
    rng = random.Random(32)
    texts = []
    for n in (3, 5, 6, 30, 150, 3000):
        base = prose(rng, n, 3000).split(" ")
        for edits in (0, 1, 2, 4, 8, 16, 30):
            words = list(base)
            for k in rng.sample(range(n), min(edits, n)):
                words[k] = f"e{rng.random()}"
            texts.append((len(texts), " ".join(words)))
    df = spark.createDataFrame(texts, "k int, t string").select("k", "t", simhash.shingle_set(F.col("t"), 5).alias("x")).select("k", "t", F.struct(F.size("x.s").alias("n"), "x.m").alias("m"))
    a, b = df.select(F.col("k").alias("i"), F.col("t").alias("s"), F.col("m").alias("p")), df.select(F.col("k").alias("j"), F.col("t").alias("u"), F.col("m").alias("q"))
    rows = a.join(b, a.i < b.j).select("s", "u", simhash.may_reach("p", "q", 0.8).alias("may")).collect()
    similar = [r.may for r in rows if jaccard(r.s, r.u) >= 0.8]
    assert len(similar) > 20 and all(similar)
    assert sum(r.may for r in rows) < 0.25 * len(rows) + len(similar)


def test_byte_bpe(spark, docs):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = vocabulary()
    bpe = byte_bpe.ByteBpe(spark, path, pattern)
    ranks = byte_bpe.read_ranks(open(path, "rb").read())
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = docs.select("text", bpe.encode(F.col("text")).alias("ids")).select("text", "ids", bpe.decode(F.col("ids")).alias("back")).collect()
    for r in out:
        assert r.ids == own.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()
    rng = random.Random(2)
    codec = byte_bpe.Codec(ranks, pattern)
    for _ in range(500):
        text = "".join(rng.choice("ab's tldremv' \n\t\u00a0\u2003é1٣!'$日") for _ in range(rng.randint(0, 40)))
        assert codec.encode_text(text).tolist() == own.encode_ordinary(text)
    for text in ("x" * 30_000, "ab" * 9999, "é" * 5000):
        assert codec.decode(codec.encode_text(text))[0].tobytes() == text.encode()
    slow = byte_bpe.Codec(ranks, r"\p{L}+|\s+|[^\p{L}\s]+")
    assert slow.encode_text("ab 12 ").tolist() == tiktoken.Encoding("o", pat_str=r"\p{L}+|\s+|[^\p{L}\s]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary("ab 12 ")


def test_byte_bpe_equal_hashes(spark, nothing, monkeypatch):
    """Pre-tokens that share a hash are told apart by length and ends."""
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = vocabulary()
    ranks = byte_bpe.read_ranks(open(path, "rb").read())
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    real = byte_bpe.K.span_hashes
    monkeypatch.setattr(byte_bpe.K, "span_hashes", lambda *a: real(*a) >> np.uint64(58))
    codec = byte_bpe.Codec(ranks, pattern)
    rng = random.Random(7)
    for _ in range(5):
        text = prose(rng, 200, 3000)
        assert codec.encode_text(text).tolist() == own.encode_ordinary(text)
    monkeypatch.undo()
    bpe = byte_bpe.ByteBpe(spark, path, pattern)
    assert nothing.select(bpe.decode(bpe.encode(F.col("text")))).collect() == []


def test_byte_bpe_ranks_out_of_order():
    """A merge that makes a pair of lower rank: that pair goes first."""
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"ab": 5, b"aba": 3, b"abab": 4, b"ba": 6, b"bab": 2}
    own = tiktoken.Encoding("o", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(ranks, r"\S+")
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        assert codec.encode_text(text).tolist() == own.encode_ordinary(text), text


def brute_shuffle(rows, spark_keys, buckets, shards, seed=42):
    """The plain form: scatter, shuffle each bucket, deal places in turn."""
    dealt = collections.defaultdict(list)
    for row, k in zip(rows, spark_keys, strict=True):
        dealt[k % buckets].append((k, row))
    out, place = [], 0
    for b in sorted(dealt):
        held = sorted(dealt[b], key=lambda x: x[0])
        for i in np.random.default_rng([seed, b]).permutation(len(held)):
            out.append((held[i][1], place % shards, place // shards))
            place += 1
    return out


def test_sharding(spark, docs, nothing, tmp_path):
    rows = fixture_rows()
    out = sharding.external_shuffle(docs, 4, f"file://{tmp_path}/a", buckets=7).collect()
    keys = spark.createDataFrame(rows, SCHEMA).select(F.xxhash64(F.lit(42), *[x for c in SCHEMA_NAMES for x in (F.col(c).isNull(), F.col(c))]).alias("k")).collect()
    want = brute_shuffle(rows, [r.k for r in keys], 7, 4)
    assert collections.Counter((tuple(r.record), r.shard, r.slot) for r in out) == collections.Counter(want)
    counts = collections.Counter(r.shard for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in range(4):  # each shard's files hold its slots in order
        files = sorted((tmp_path / "a" / f"shard={s}").glob("*.parquet"))
        slots = [x for f in files for x in pq.ParquetFile(f).read(["slot"])["slot"].to_pylist()]
        assert slots == list(range(counts[s]))
    again = sharding.external_shuffle(docs.repartition(2), 4, f"file://{tmp_path}/b", buckets=7).collect()
    assert sorted((str(r.record), r.shard, r.slot) for r in out) == sorted((str(r.record), r.shard, r.slot) for r in again)
    assert sharding.external_shuffle(nothing, 4, f"file://{tmp_path}/c").count() == 0


def test_sharding_is_alike_on_any_cluster(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for k, parts in enumerate((2, 64)):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got.append(sorted((r.record.doc_id, r.shard, r.slot) for r in sharding.external_shuffle(table, 16, f"file://{tmp_path}/{k}").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] and len(got[0]) == table.count()


def test_sharding_spreads_equal_rows(spark, tmp_path):
    """Equal rows beyond HEAVY are scattered over all buckets."""
    df = spark.range(9000).select(F.when(F.col("id") < 6000, F.lit(None).cast("long")).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 6000, F.lit("copy")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = sharding.external_shuffle(df, 4, f"file://{tmp_path}/a", buckets=50).collect()
    assert collections.Counter(tuple(r.record) for r in out) == collections.Counter(tuple(r) for r in df.collect())
    at = sorted(r.slot * 4 + r.shard for r in out if r.record.doc_id is None)
    assert sorted(r.slot * 4 + r.shard for r in out) == list(range(9000))
    tenths = np.histogram(at, 10, (0, 9000))[0]
    assert tenths.min() > 400 and tenths.max() < 800


def test_sharding_loses_no_heavy_row(spark, tmp_path, monkeypatch):
    """Heavy rows that differ only in which column, field, element or map value is null, by the sign of zero or by a microsecond, and some whose hashes are made to collide, all come back."""
    kinds = "text string, other string, s struct<a:string,b:string>, l array<string>, m map<string,string>, d double, t timestamp"
    base = ("x", None, ("a", None), ["u", None], {"k": None}, 0.0, datetime.datetime(2024, 1, 1, 0, 0, 0, 1))
    other = {0: None, 1: "x", 2: (None, "a"), 3: [None, "u"], 4: {"k": "v"}, 5: -0.0, 6: datetime.datetime(2024, 1, 1, 0, 0, 0, 2)}
    rows = [base] * 30 + [(*base[:i], v, *base[i + 1 :]) for i, v in other.items() for _ in range(25)] + [("x", None, None, None, None, None, None)] * 22 + [(None, "x", None, None, None, None, None)] * 21
    monkeypatch.setattr(sharding, "HEAVY", 20)
    count = lambda some: collections.Counter(str(tuple(r)) for r in some)
    for k, collide in enumerate((False, True)):
        if collide:
            monkeypatch.setattr(sharding.F, "xxhash64", lambda *c: F.pmod(F.hash(*[x for x in c if x is not c[0]]), F.lit(3)).cast("long"))
        df = spark.createDataFrame(rows, kinds)
        out = sharding.external_shuffle(df, 4, f"file://{tmp_path}/{k}", buckets=5).select("record.*").collect()
        assert count(out) == count(df.collect())
        flat = df.select("text", "other")
        assert count(sharding.external_shuffle(flat, 4, f"file://{tmp_path}/flat{k}", buckets=5).select("record.*").collect()) == count(flat.collect())


TURNS = [(1, 0, "system", "be good"), (1, 1, "user", "hi <s>"), (1, 2, "assistant", "a [INST] b <\\s> <\\\\/s>"), (1, 3, "user", None), (1, 4, "assistant", "word " * 300), (1, 5, "user", "more"), (1, 6, "assistant", "é" * 90), (2, 0, "assistant", ""), (2, None, None, "late"), (None, 1, "user", "n"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same")] + [(4, i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 7 * 5)) for i in range(60)]


def quarter(text):
    """A token for every four bytes, as a column."""
    return F.ceil(F.octet_length(text) / 4).cast("int")


@pytest.mark.parametrize("budget", [40, 100, 100_000])
def test_chat_windows(spark, budget, tmp_path):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("x")).withColumn("formatted", F.lit(1))
    windows = chat_windows.format_windows(df, quarter, budget=budget)
    windows.write.parquet(f"file://{tmp_path}/w")
    stored = spark.read.parquet(f"file://{tmp_path}/w").repartition(7)
    got = {r.conv_id: r for r in chat_windows.read_back(stored).collect()}
    convs = collections.defaultdict(list)
    for c, turn, role, text in sorted(TURNS, key=lambda r: (r[0] is None, r[0], r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        convs[c].append((role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for w in windows.collect():
        turns = chat_windows.parse(w.formatted)
        size = [-(-len(f"[INST]{chat_windows.escape(r)}[/INST]{chat_windows.escape(t)}</s>".encode()) // 4) for r, t in turns]
        assert w.n_tokens == 1 + sum(size)
        new = len(turns) - w.n_repeated
        assert new >= 1 and (w.n_tokens <= budget or len(turns) == 1 and size[0] >= budget)
        if w.conv_id == 1 and len(turns) > 1 and size[-new] + 1 + size[0] <= budget:
            assert turns[0] == ("system", "be good")
    assert chat_windows.read_back(chat_windows.format_windows(df.limit(0), quarter)).collect() == []


def test_chat_windows_of_a_long_system_turn(spark):
    """A system turn that doesn't fit beside the next turn isn't repeated, so no window passes the budget but those of one turn that does."""
    rows = [(1, 0, "system", "rule " * 100)] + [(1, k, "assistant" if k % 2 else "user", f"turn {k} " * 10) for k in range(1, 12)]
    windows = chat_windows.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), quarter, budget=100).orderBy("window").collect()
    assert windows[0].n_tokens > 100 and len(chat_windows.parse(windows[0].formatted)) == 1
    assert all(w.n_tokens <= 100 for w in windows[1:]) and len(windows) > 4
    assert sum(len(chat_windows.parse(w.formatted)) - w.n_repeated for w in windows) == 12


def test_escape_is_exact():
    rng = random.Random(1)
    for _ in range(2000):
        t = "".join(rng.choice(["<", "[", "\\", "/", "s>", "INST]", "x", " "]) for _ in range(rng.randint(0, 12)))
        e = chat_windows.escape(t)
        assert chat_windows.unescape(e) == t
        assert not any(c in e for c in (chat_windows.BOS, chat_windows.HEAD, chat_windows.TAIL, chat_windows.EOS))


def brute_measures(text):
    w = WORD.findall(text or "")
    count = collections.Counter(zip(w, w[1:], w[2:]))
    inside = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if count[g] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_quality_rules(spark, docs, nothing):
    good, bad = ["plain words of prose " + str(i) * 3 for i in range(40)], ["$$$ BUY!! " + str(i) for i in range(40)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(None, 1), (3, 0), (5, 7)], "doc_id long, quality int")
    texts = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    model = quality_rules.train(texts, labels)
    scored = {r.doc_id: r.score for r in quality_rules.quality_rules(texts, model).collect()}
    assert np.mean([scored[i] > 0.5 for i in range(40)]) > 0.9 and np.mean([scored[i] < 0.5 for i in range(40, 80)]) > 0.9
    out = quality_rules.quality_rules(docs, model).collect()
    want = collections.Counter((r[0], *brute_measures(r[1])) for r in fixture_rows())
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == want
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.train(texts, labels.limit(0)) is None
    assert quality_rules.quality_rules(nothing, None).collect() == []


def test_quality_rules_see_code_points():
    """Slots of 4-grams of letters, by hand, row by row; a letter beyond ASCII is one."""
    texts = ["déjà vu", "", "abc", "日本語の文", "😀😀😀😀x", "a" * 3000]
    data, off = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *[len(t.encode()) for t in texts]])
    slot, of = quality_rules.slots(data, off)
    grams = [(r, sum(ord(t[i + k]) << 16 * k for k in range(4)) % 2**64) for r, t in enumerate(texts) for i in range(len(t) - 3)]
    want = (kernels.mix(np.array([g for _, g in grams], np.uint64) + np.uint64(3)) >> np.uint64(48)).tolist()
    assert [*zip(of.tolist(), slot.tolist())][-len(grams) :] == [(r, s) for (r, _), s in zip(grams, want, strict=True)]


def tables(spark, sf="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def accuracy(rows, want, label):
    held = [(r.predicted, want[r.doc_id]) for r in rows if r.held_out and r.doc_id in want]
    return np.mean([p == y for p, y in held]), np.mean([p == y for p, y in held if y == label])


def test_quality_classifier_held_out(spark, docs, nothing):
    table, labels = tables(spark)
    fold = labelled.fold_of(F.col("doc_id"), 5)
    model = quality_classifier.train(table, labels, allowed=fold != 0)
    rows = table.select("doc_id", (fold == 0).alias("held_out"), (quality_classifier.score(F.col("text"), model) >= 0.3).cast("int").alias("predicted")).collect()
    both, bad = accuracy(rows, {r.doc_id: r.quality for r in labels.collect()}, 0)
    assert both > 0.95 and bad > 0.8
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    scores = docs.select(quality_classifier.score(F.col("text"), model).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scores)
    assert quality_classifier.train(table, labels.limit(0)) is None
    assert nothing.select(quality_classifier.score(F.col("text"), None)).collect() == []


def test_bradley_terry_against_plain_descent():
    """The weights are those that plain gradient descent finds for the same pairs, and the cut is a quantile of the scores."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 4))
    y = (x @ [1.0, -0.5, 0.0, 2.0] + rng.normal(size=120) > 0).astype(float)
    model = quality_classifier.fit(x, y, pairs=800, seed=11)
    z = np.clip((x - x.mean(0)) / (x.std(0) + 1e-6), -8, 8)
    good, bad = np.flatnonzero(y > 0), np.flatnonzero(y == 0)
    draw = np.random.default_rng(11)
    first = draw.choice(good, 800)
    d = z[first] - z[draw.choice(bad, 800)]
    w = np.zeros(4)
    for _ in range(20_000):
        w -= 1e-3 * (20 * w - d.T @ (1 / (1 + np.exp(d @ w))))
    assert np.allclose(model.weights, w, atol=1e-3)
    s = z @ model.weights
    rate = [(s[good] >= c).mean() + (s[bad] < c).mean() for c in np.sort(s)]
    own = (s[good] >= model.cut).mean() + (s[bad] < model.cut).mean()
    assert own >= max(rate) - 0.02
    assert abs(model.score(x)[np.argmin(abs(s - model.cut))] - 0.3) < 0.05


def test_toxicity_held_out(spark, docs, nothing):
    table, labels = tables(spark)
    fold = labelled.fold_of(F.col("doc_id"), 3)
    index, ids = toxicity.train(table, labels, allowed=fold != 1)
    rows = table.select("doc_id", (fold == 1).alias("held_out"), (toxicity.judge(F.col("text"), index, ids)["score"] >= 0.7).cast("int").alias("predicted")).collect()
    both, toxic = accuracy(rows, {r.doc_id: r.toxic for r in labels.collect()}, 1)
    assert both > 0.95 and toxic > 0.75
    assert all(0 <= r.s <= 1 for r in docs.select(toxicity.judge(F.col("text"), index)["score"].alias("s")).collect())
    none, _ = toxicity.train(nothing, labels.limit(0))
    assert all(r.s < 1e-4 for r in docs.select(toxicity.judge(F.col("text"), none)["score"].alias("s")).collect())


def dense(index, texts):
    raw = [t.encode() for t in texts]
    row, term, weight = index.vectors(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    out = np.zeros((len(texts), len(index.terms)), np.float32)
    out[row, term] = weight
    return (row, term, weight), out


@pytest.mark.parametrize("real", [False, True])
def test_toxicity_index_is_exact(spark, real):
    """The block-max search against dense cosines over all terms of all examples; with real, of 2,000 texts."""
    rng = np.random.default_rng(5)
    if real:
        texts = sorted({r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("text is not null and n_chars < 2500").select("text").collect()})[:2000]
        y = np.array([sum(w in t for w in ("idiot", "scum", "moron")) > 0 for t in texts], float)
    else:
        texts = [" ".join(rng.choice([f"t{i}" for i in range(40)], 12)) + (" bad worse" if i % 3 == 0 else " fine") for i in range(300)]
        y = np.array([i % 3 == 0 for i in range(300)], float)
    index, order = toxicity.build(texts, y)
    texts = [texts[i] for i in order]
    assert index.y.tolist() == y[order].tolist()
    vectors, full = dense(index, texts)
    assert len(index.terms) == len({w.strip("".join(map(chr, np.flatnonzero(toxicity.K.PUNCT)))).lower() or w for t in texts for w in t.split()}) or real
    found, cosine = index.nearest(*vectors, len(texts))
    for i in range(0, len(texts), 7):
        cos = full @ full[i]
        want = np.sort(cos)[::-1][:8]
        assert np.allclose(cosine[i], np.maximum(want, 0), atol=1e-5)
        e = found[i][found[i] >= 0]
        assert len(set(e.tolist())) == len(e) and np.allclose(cos[e], cosine[i][: len(e)], atol=1e-5)
    alone, _ = index.nearest(*vectors, len(texts), without=np.arange(len(texts)))
    assert not (alone == np.arange(len(texts))[:, None]).any()


def test_toxicity_counts_and_rare_words(spark, nothing):
    """Document counts cover the whole table, and a copy of a toxic example is found by words no other example has."""
    rng = random.Random(3)
    rows = [(i, prose(rng, 60) + (" scum idiot" if i % 4 == 0 else "")) for i in range(400)]
    rows[0] = (0, " ".join(f"rare{k}" for k in range(40)))
    rows += [(1000 + i, prose(rng, 30)) for i in range(200)] + [(None, None), (1, "again w1 w1"), (2000, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400) if i != 1], "doc_id long, toxic int")
    index, ids = toxicity.train(df, labels)
    for word in ("w1", "w17", "rare3", "scum"):
        h = toxicity.example_words([word])[0]
        k = int(np.searchsorted(index.terms.hashes, h[0]))
        assert index.terms.hashes[k] == h[0]
        got, total = toxicity.document_counts(df, index.terms)
        assert total == len(rows) and got[k] == sum(word in (t or "").split() for _, t in rows)
    out = df.filter("doc_id = 2000").select(toxicity.judge(F.col("text"), index, ids).alias("t")).first().t
    assert out.evidence[0] == 0 and abs(out.cosine[0] - 1) < 1e-9 and out.score >= 0.7
    assert nothing.select(toxicity.judge(F.col("text"), index, ids)).collect() == []


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def test_decontamination_recall(spark, nothing):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(15, 50), 5000)) for i in range(40)] + [(99, "not there"), (100, None)]
    docs, planted = [], set()
    for d in range(200):
        words = prose(rng, 150, 5000).split(" ")
        if d % 2 == 0:
            item, text = items[rng.randrange(40)]
            leak = text.split(" ")
            for _ in range(rng.randint(0, len(leak) // 5)):
                k = rng.randrange(len(leak))
                what = rng.randrange(3)
                leak[k : k + 1] = [["zz"], [], [leak[k], "yy"]][what]
            at = rng.randrange(len(words))
            leak = [w.upper() + "," for w in leak]
            words[at:at] = leak
            if min(levenshtein(text.split(" "), [w.lower().strip(",") for w in leak])[-1:]) <= len(text.split(" ")) // 5:
                planted.add((d, item))
        docs.append((d, " ".join(words)))
    docs += [(1000, None), (1001, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(df, bench).collect()}
    assert len(planted & set(found)) >= 0.95 * len(planted)
    text, item = dict(docs), dict(items)
    for (d, i), r in found.items():  # every answer is exact
        a = item[i].split(" ")
        b = [w.lower().strip(",") for w in text[d].split(" ")][r.start : r.end]
        assert levenshtein(a, b)[-1] == r.distance <= len(a) // 5
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench, block_words=200).collect()} == set(found)
    assert {r.doc_id for r in decontamination.clean(df, bench, block_words=200).collect()} == {d for d, _ in docs} - {d for d, _ in found}
    assert decontamination.contaminated(nothing, bench).collect() == []
    assert decontamination.contaminated(df, bench.limit(0)).collect() == []


def found_in(items, texts):
    """Which item of which text is found, with its distance checked."""
    words = [decontamination.normal_words(np.frombuffer(" ".join(t).encode(), np.uint8), np.array([0, len(" ".join(t))]))[0] for t in (*items, *texts)]
    block = decontamination.Items(np.arange(len(items)), np.concatenate(words[: len(items)]), np.concatenate([[0], np.cumsum([len(t) for t in items])]))
    row = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = block.leaks(np.concatenate(words[len(items) :]), row)
    for doc, item, start, end, distance in got[::7]:
        assert levenshtein(items[item], [w.lower().strip("(),") for w in texts[doc][start:end]])[-1] == distance <= len(items[item]) // 5
    return {(doc, item) for doc, item, *_ in got}


@pytest.mark.parametrize("n", [5, 8, 12, 20, 30, 40, 50, 58, 100, 150, 220])
def test_decontamination_at_the_bound(n):
    """Leaks of exactly floor(n / 5) edits, kind by kind, are found at the stated recall or nearly so."""
    rng = random.Random(n)
    d = n // 5
    for kind in ("deletions", "block", "insertions", "substitutions"):
        items, texts = [], []
        for _ in range(60):
            item = [f"w{rng.randrange(5000)}" for _ in range(n)]
            leak = list(item)
            if kind == "block":
                k = rng.randrange(n - d)
                leak[k : k + d] = []
            else:
                for k in sorted(rng.sample(range(n), d), reverse=True):
                    leak[k : k + 1] = {"deletions": [], "insertions": [leak[k], "yy"], "substitutions": ["zz"]}[kind]
            items.append(item)
            texts.append(prose(rng, 30, 5000).split(" ") + leak + prose(rng, 30, 5000).split(" "))
        got = found_in(items, texts)
        assert sum((k, k) in got for k in range(60)) >= 54, (n, kind)


def test_decontamination_of_short_items():
    """Items of under five words match exactly, and only so."""
    items = [["alpha"], ["beta", "gamma"], ["one", "two", "three", "four"], ["one", "two", "three", "four"]]
    texts = [["x", "Alpha,", "y"], ["beta", "x", "gamma"], ["(one", "two", "three", "four)"], ["one", "two", "three", "five"], ["beta", "gamma"], []]
    assert found_in(items, texts) == {(0, 0), (4, 1), (2, 2), (2, 3)}


def test_decontamination_of_odd_rows(spark):
    """Null and repeated ids are judged by their own text; a very long text and clashing names do no harm."""
    rng = random.Random(5)
    item = prose(rng, 30, 5000)
    long = prose(rng, 40_000, 5000)
    rows = [(None, item, "a"), (7, f"x {item} y", "b"), (7, "clean text", "c"), (7, None, "d"), (8, "", "e"), (9, f"{long} {item} {long}", "f"), (9, f"{long} {item} {long}", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, item, "z"), (None, item, "z"), (2, "", "z"), (3, None, "z")], "item_id long, text string, doc_id string")
    got = collections.Counter((r.doc_id, r.item_id, r.start, r.end, r.distance) for r in decontamination.contaminated(df, bench).collect())
    assert got == {(None, 1, 0, 30, 0): 1, (7, 1, 1, 31, 0): 1, (9, 1, 40_000, 40_030, 0): 2}
    kept = decontamination.clean(df, bench)
    assert kept.columns == df.columns and sorted(r.item_id for r in kept.collect()) == ["c", "d", "e"]


URLS = ["http://a.example.net/en/1", "https://example.net/de/x?q=1", "http://EXAMPLE.com/de/#f", "http://x.org/fr/y", "http://x.org/fry", "http://example.net", "no scheme", "", None, "x://h", "http://example.com/de", "ftp://notexample.com/de/", "http://b.net:80/", "http:///path", "http://a\nb.net/é?x://y"]


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_url_filter(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(100 + i, f"http://s{i}.example.net/{'en' if i % 2 else 'de'}/{i}", "h") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = {r.page_id: r for r in url_filter.filter_urls(df, URL_RULES).collect()}
    assert len(out) == len(rows)
    for i, url, _ in rows:
        host, path = brute_url(url)
        fits = [r for r, _ in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        rule = max(fits, key=len, default=None)
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule)
        assert out[i].verdict == (dict(URL_RULES)[rule] if rule else out[i].verdict) and out[i].verdict in ("allow", "block")
    assert url_filter.filter_urls(df.limit(0), URL_RULES).collect() == []
    lone = url_filter.filter_urls(df.filter("page_id = 6"), URL_RULES).collect()
    assert lone[0].verdict == "allow"


def brute_gap(urls, train):
    """Per-character log ratio of the two smoothed models, by dictionaries."""
    follow = [collections.defaultdict(collections.Counter) for _ in range(2)]
    for url, label in train:
        for i, c in enumerate(url):
            for k in range(url_filter.ORDER + 1):
                follow[label][k, ("\0" * 9 + url[:i])[len(url[:i]) + 9 - k :] if k else ""][c] += 1
    out = []
    for url in urls:
        total = 0.0
        for i, c in enumerate(url):
            p = [1 / 0x110000] * 2
            for k in range(url_filter.ORDER + 1):
                ctx = ("\0" * 9 + url[:i])[len(url[:i]) + 9 - k :] if k else ""
                p = [(follow[x][k, ctx][c] + 2 * p[x]) / (sum(follow[x][k, ctx].values()) + 2) for x in (0, 1)]
            total += np.log(p[1] / p[0])
        out.append(total / max(len(url), 1))
    return out


def test_url_models_against_brute_force(spark):
    rng = random.Random(8)
    train = [(f"http://news{rng.randrange(99)}.org/stör/{rng.randrange(99)}", 1) for _ in range(60)] + [(f"http://win-{rng.randrange(99)}.biz/?id={rng.randrange(99)}", 0) for _ in range(60)]
    urls = ["http://news5555.org/story/7", "http://win-77777.biz/?id=1", "", "日本://x", train[0][0], train[0][0], "http://" + "long/" * 3000]
    model = url_filter.count_contexts(spark.createDataFrame(train, "url string, label int").repartition(3))
    rows = spark.createDataFrame([(k, k // 3, u) for k, u in enumerate(urls)], "k int, block long, url string")
    got = {r.k: r.gap for r in url_filter.gaps(rows, model).collect()}
    assert np.allclose([got[k] for k in range(len(urls))], brute_gap(urls, train))


def test_url_model_parts_the_kinds(spark):
    rng = random.Random(8)
    urls = [(0, f"http://news{rng.randrange(999)}.org/story/{rng.randrange(999)}", 1) for _ in range(400)] + [(0, f"http://win-{rng.randrange(999)}.biz/?id={rng.randrange(999)}", 0) for _ in range(400)]
    model, slope, bias = url_filter.train(spark.createDataFrame(urls, "block long, url string, label int"))
    df = spark.createDataFrame([(0, 1, "http://news5555.org/story/7"), (1, 0, "http://win-77777.biz/?id=1"), (0, 0, "http://win-5.biz/?id=11")], "block long, want int, url string")
    assert all((slope * r.gap + bias > 0) == r.want for r in url_filter.gaps(df, model).collect())


def test_xxh64_and_majority():
    from corpusloom.functions import kernels

    data = np.random.default_rng(0).integers(0, 256, 300).astype(np.uint8)
    for n in range(0, 200):
        assert int(kernels.xxh64(data, np.array([3]), np.array([n]))[0]) == xxhash.xxh64_intdigest(data[3 : 3 + n].tobytes(), 42)


def test_walks_that_miss_the_target_are_an_error(monkeypatch):
    monkeypatch.setattr(decontamination, "WALKS", (1,))
    monkeypatch.setattr(decontamination, "_needed", {})
    with pytest.raises(ValueError, match="lower recall"):
        decontamination.walks_needed(50, 0.3, 1.0, 7)
