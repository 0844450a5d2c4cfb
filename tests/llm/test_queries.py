"""The registered queries' contract columns, against SQL or plain Python over whole tables."""

import collections
import hashlib
import math
import zlib

import duckdb
import pytest
from test_operators import WORD, brute_components, brute_fingerprint, brute_measures, brute_substring, brute_url, key

from corpusloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def of(spark, name):
    return queries.queries()[name](spark, SF).collect()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_op2_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(queries.oracle_sql()["op2_substring_dedup"]).fetchall()
    got = queries.op2_substring_dedup(spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want) and sum(r.n_removed for r in got) > 0


def test_op1(spark):
    rows = of(spark, "op1_url_filter")
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        host, path = brute_url(pages[r.page_id])
        fits = [t for t, _ in queries.URL_RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith("/" + t.partition("/")[2])]
        assert (r.host, r.path, r.rule) == (host, path, max(fits, key=len, default=None))
        assert r.verdict == (dict(queries.URL_RULES)[r.rule] if r.rule else r.verdict) and r.verdict in ("allow", "block")


def test_op2(spark, docs):
    got = sorted((tuple(r)[:4] for r in of(spark, "op2_substring_dedup")), key=key)
    assert got == sorted(((d, n, gone, sha(text)) for d, n, gone, text in brute_substring(docs, 50)), key=key)


@pytest.mark.parametrize("name,folds,out,least", [("op3_toxicity", 3, 1, 0.7), ("op5_quality_classifier", 5, 0, 0.3)])
def test_op3_and_op5(spark, docs, name, folds, out, least):
    rows = of(spark, name)
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
    text = dict(docs)
    score = collections.defaultdict(set)
    for r in rows:
        score[text[r.doc_id]].add(r.score)
    assert all(len(s) == 1 for s in score.values())  # the text alone decides


def test_op4(spark, docs):
    rows = of(spark, "op4_external_shuffle")
    text = {d: (t or "").encode() for d, t in docs}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    slots = collections.defaultdict(list)
    for r in rows:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op6(spark):
    convs = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        convs[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    said = "</s>[INST] ok [/INST]"
    convs[-7] = [(0, "user", said), (1, "assistant", said)]
    got = {r.conv_id: r for r in of(spark, "op6_chat_windows")}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns = [t[1:] for t in sorted(turns)]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
        assert got[c].formatted_chars >= sum(len(r) + len(t) for r, t in turns)


def test_op7(spark, docs):
    import base64

    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = queries.vocabulary()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in of(spark, "op7_byte_bpe")}
    for d, t in docs:
        ids = own.encode_ordinary(t or "")
        assert got[d] == (len(ids), sha(",".join(map(str, ids))), sha(t or ""))


def test_op8(spark, docs):
    """Every verbatim passage of the benchmark is found, and nothing beyond the bound."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rows = of(spark, "op8_decontamination")
    n = {i: len(WORD.findall(t)) for i, t in items.items()}
    assert {(d, i) for d, t in docs for i, x in items.items() if x in (t or "")} <= {(r.doc_id, r.item_id) for r in rows}
    assert all(r.distance <= math.floor(0.2 * n[r.item_id]) and abs(r.end - r.start - n[r.item_id]) <= r.distance for r in rows)


def test_op9(spark, docs):
    got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in of(spark, "op9_simhash")), key=key)
    assert got == brute_components(docs, 3, 2)
    assert brute_fingerprint("", 3) == 0


def test_op10(spark, docs):
    want = {d: brute_measures(t) for d, t in docs}
    for r in of(spark, "op10_quality_rules"):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
