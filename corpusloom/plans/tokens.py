"""Token queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import statistics
from corpusloom.operators import tokenizer as Z
from corpusloom.operators import tokens as K
from corpusloom.plans.registry import query, table

_PRE = r"regexp_extract_all(text, ' ?\p{L}+| ?\p{N}|[\n\t]| ?[^\s\p{L}\p{N}]+| +')"


@query(f"select token, count(*)::bigint as n from (select unnest({_PRE}) as token from documents) group by token")
def pretoken_counts(spark, sf):
    return K.pre_token_counts(table(spark, sf, "documents").select("text"))


@query()
def bpe_vocabulary(spark, sf):
    """The merges learnt from the corpus, in order."""
    merges = K.train(table(spark, sf, "documents").select("text"), 300)
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(merges)], "rank int, left string, right string")


@query(f"select lang, sum(len(t))::bigint as total_tokens, count(*)::bigint as total_sequences, min(len(t))::bigint as min_tokens, max(len(t))::bigint as max_tokens from (select lang, {_PRE} as t from documents) group by lang")
def token_stats(spark, sf):
    rows = table(spark, sf, "documents").select("lang", F.size(K.pre_tokens(F.col("text"))).cast("long").alias("n_tokens"))
    return statistics.token_stats(rows, "lang")


@query("select doc_id, md5(array_to_string(list_concat(list_slice(t, 1, 64), list_transform(range(greatest(64 - len(t), 0)), lambda i: 0), [2]), ',')) as tokens from (select doc_id, list_transform(string_split(text, ' '), lambda x: length(x)) as t from documents)")
def tokens_padded(spark, sf):
    ids = F.transform(F.split("text", " "), F.length)
    return table(spark, sf, "documents").select("doc_id", F.md5(F.array_join(K.padded(ids, 64, 0, 2).cast("array<string>"), ",")).alias("tokens"))


@query(f"""select lang, sum(len(t))::bigint as tokens, sum(len(list_filter(t, lambda x: regexp_matches(x, '^ +$'))))::bigint as space_tokens, sum(len(list_filter(t, lambda x: regexp_matches(x, '^\\n+$'))))::bigint as linebreak_tokens, sum(len(list_filter(t, lambda x: regexp_matches(x, '^\\t+$'))))::bigint as tab_tokens,
sum(len(list_filter(t, lambda x: regexp_matches(x, '^ ?[0-9]+$'))))::bigint as digit_tokens, sum(len(list_filter(t, lambda x: strlen(x) = 1)))::bigint as single_byte_tokens from (select lang, {_PRE} as t from documents) group by lang""")
def token_counters(spark, sf):
    rows = table(spark, sf, "documents").select("lang", K.pre_tokens(F.col("text")).alias("t"))
    return rows.groupBy("lang").agg(*[F.sum(c).alias(k) for k, c in statistics.token_counters(F.col("t")).items()])


@query("select doc_id, md5(rtrim(text, ' ' || chr(10))) as text from documents")
def cut_long_texts(spark, sf):
    """Long texts cut before digits and put together again."""
    parts = K.parts_before_digits(F.col("text"), 1000)
    return table(spark, sf, "documents").select("doc_id", F.md5(F.array_join(parts, "")).alias("text"))


#: Letters, blanks and opening marks in DuckDB's expressions.
_W, _B, _O = r"\p{L}\p{M}\p{Pc}\x{24B6}-\x{24E9}", r"\p{Z}\x09-\x0D\x{85}", r"\n\t(\[{/<''’\"«“‘‚‹—–―"
_NFC = "replace(nfc_normalize(text), chr(13), '')"
_REST = rf"[{_W}\p{{Z}}\x0B\x0C\x{{85}}]+"
_MARKED = "case when m = '' or m[1] = '▁' then m else '▁' || m end"
_PIECES = rf"""a as (select doc_id, {_NFC} as plain from documents), b as (select *, replace(regexp_replace(plain, '([{_O}])([ {_W}\p{{Nd}}])', '\1 \2', 'g'), ' ', '▁') as m, replace(replace(plain, ' ', '▁'), chr(160), '▁') as s from a),
p as (select *, regexp_extract_all({_MARKED}, '\p{{N}}|▁?[^{_W}{_B}\p{{N}}▁]+|[\n\t]|▁?{_REST}|▁') as pieces, regexp_extract_all(s, '[▁\n\t]|\p{{N}}|[^{_W}{_B}\p{{N}}▁]+|{_REST}') as split from b)"""
#: What is left of a text that was encoded and decoded: the normalised text, but for a space at its start; its marks are spaces.
_BACK = f"regexp_replace(replace(regexp_replace(plain, '([{_O}])▁', '\\1', 'g'), '▁', ' '), '^ ', '')"


@query(f"""with {_PIECES} select doc_id, len(pieces) as n_pieces, md5(array_to_string(pieces, chr(31))) as pieces, len(split) as n_split, md5(array_to_string(split, chr(31))) as split, md5({_BACK}) as decoded from p""")
def tokenizer_pieces(spark, sf):
    """The pieces within which a tokenizer merges, with spaces put before words and with spaces of their own, and the text decoded from them."""
    rows = table(spark, sf, "documents").select("doc_id", Z.pieces(F.col("text")).alias("p"), Z.pieces(F.col("text"), "split").alias("s"))
    shown = [c for k, n in (("p", "pieces"), ("s", "split")) for c in (F.size(k).cast("long").alias(f"n_{n}"), F.md5(F.array_join(k, "\x1f")).alias(n))]
    return rows.select("doc_id", *shown, F.md5(Z.decoded(F.col("p"), fallback=False)).alias("decoded"))


@query(f"""with {_PIECES}, c as (select doc_id, plain, unnest(range(1, len(chars) + 1)) as i, unnest(chars) as c from (select doc_id, plain, regexp_extract_all(array_to_string(pieces, ''), '(?s).') as chars from p)),
known as (select c, true as known from (select c, count(*) as n from c group by c) order by n desc, hex(c) limit 40),
s as (select doc_id, plain, i, case when known then [c] else list_transform(regexp_extract_all(hex(c), '..'), lambda x: '<0x' || x || '>') end as t from c left join known using (c))
select doc_id, sum(len(t))::bigint as n_symbols, sum(len(list_filter(t, lambda x: strlen(x) = 6)))::bigint as n_bytes, md5(array_to_string(flatten(list(t order by i)), ' ')) as symbols, md5({_BACK}) as decoded from s group by doc_id, plain""")
def tokenizer_symbols(spark, sf):
    """The symbols with which merging begins, in an alphabet of 40 characters learnt from the pieces, and bytes for all others; and the text decoded from them."""
    # what has a symbol is seen in the text; a filter on the symbols would compute them twice
    docs = table(spark, sf, "documents").select("doc_id", "text").filter(F.col("text").rlike(r"[^\r\x00]"))
    known = Z.alphabet(Z.character_counts(docs), 40)
    rows = docs.select("doc_id", Z.symbols(Z.pieces(F.col("text")), known).alias("t"))
    return rows.select("doc_id", F.size("t").cast("long").alias("n_symbols"), F.size(F.filter("t", lambda x: F.length(x) == 6)).cast("long").alias("n_bytes"), F.md5(F.array_join("t", " ")).alias("symbols"), F.md5(Z.decoded(F.col("t"))).alias("decoded"))


@query(f"""with r as (select unnest(regexp_extract_all(replace({_NFC}, ' ', '▁'), '▁+|\t+|\n+')) as r from documents), k as (select r[1] as char, length(r) as len, case r[1] when '▁' then 8 when chr(9) then 4 else 2 end as most from r),
t as (select char, most as length, sum(len // most)::bigint as n from k group by char, most union all select char, len % most, count(*) from k where len % most > 0 group by char, len % most) select char, length::int as length, n from t where n > 0""")
def whitespace_runs(spark, sf):
    """Tokens that the merges of runs make of all spaces, tabs and line breaks, by character and length."""
    text = F.replace(Z.normalised(F.col("text"), "prefix_sos"), F.lit(" "), F.lit(Z.SPACE))
    found = table(spark, sf, "documents").select(F.explode(Z.runs(text)).alias("r"))
    return found.groupBy(F.substring("r", 1, 1).alias("char"), F.length("r").alias("length")).agg(F.count("*").alias("n"))
