"""Samples, budgets, strides and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import hashing
from corpusloom.operators import ordered
from corpusloom.plans.registry import query, table

#: The pickled bytes of a short string, and the number in [0, 1] of its hash.
_PICKLE = "from_hex('800495' || printf('%02X', length({x}) + 4) || '00000000000000' || '8C' || printf('%02X', length({x})) || hex({x}) || '942E')"
_R = f"(('0x' || substr(sha256({_PICKLE}), 14, 13))::bigint / 4503599627370496.0::double)"


def docs(spark, sf, *more):
    return table(spark, sf, "documents").select("doc_id", *more)


@query(f"select doc_id, round({_R.format(x='doc_id::varchar')}, 9) as r from documents")
def random01(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(hashing.random01(F.col("doc_id")), 9).alias("r"))


@query(f"select doc_id from documents where {_R.format(x='doc_id::varchar')} <= 0.5")
def hash_subsample(spark, sf):
    return docs(spark, sf).filter(hashing.random01(F.col("doc_id")) <= 0.5)


@query(f"select doc_id from documents where {_R.format(x='doc_id::varchar')} > 0.5")
def hash_subsample_inverted(spark, sf):
    return docs(spark, sf).filter(hashing.random01(F.col("doc_id")) > 0.5)


@query(f"select doc_id, round_even(2.5 + {_R.format(x='doc_id::varchar')} * 6, 0)::bigint as n from documents")
def random_range(spark, sf):
    return docs(spark, sf).select("doc_id", hashing.random_range(F.col("doc_id"), 3, 8).alias("n"))


@query("select doc_id, size from (select doc_id, length(text)::bigint as size, sum(length(text)) over (order by doc_id) - length(text) as before from documents) where before < 500000")
def char_budget(spark, sf):
    """Documents in order until 500,000 characters; the one that crosses is kept."""
    return ordered.budget(docs(spark, sf, F.length("text").cast("long").alias("size")), "doc_id", F.col("size"), 500_000)


_N = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"


@query(f"select doc_id, size from (select doc_id, {_N}::bigint as size, sum({_N}) over (order by doc_id) as run from documents) where run <= 100000")
def word_budget(spark, sf):
    """Documents in order while they hold 100,000 words together."""
    from corpusloom.functions.text import word_count

    return ordered.budget(docs(spark, sf, word_count(F.col("text")).alias("size")), "doc_id", F.col("size"), 100_000, keep_crossing=False)


@query("select doc_id from documents order by doc_id limit 123")
def doc_limit(spark, sf):
    return docs(spark, sf).orderBy("doc_id").limit(123)


@query("select doc_id from (select doc_id, row_number() over (order by doc_id) as r from documents) where r % 7 = 0")
def stride_sample(spark, sf):
    return ordered.stride(docs(spark, sf), "doc_id", 7)


@query("select doc_id from documents order by sha256('42:' || doc_id), doc_id limit 200")
def seeded_limit(spark, sf):
    """A shuffled limit: the same rows under any partitioning."""
    return docs(spark, sf).orderBy(F.sha2(F.concat(F.lit("42:"), F.col("doc_id").cast("string")), 256), "doc_id").limit(200)


@query("select doc_id, (row_number() over (order by doc_id) - 1) // 100 as chunk from documents")
def fixed_chunks(spark, sf):
    return ordered.chunked(docs(spark, sf), "doc_id", 100)


@query("select lang, doc_id, row_number() over (partition by lang order by doc_id) - 1 as idx_row from documents")
def row_ids(spark, sf):
    """Ids for datasets that have none: the row's number in its dataset."""
    return ordered.numbered(docs(spark, sf, "lang"), "doc_id", "idx_row", within="lang").select("lang", "doc_id", F.col("idx_row").cast("long").alias("idx_row"))


@query("select dataset_at, dataset, id from (select 0 as dataset_at, 'docs.en' as dataset, doc_id as id from documents where lang = 'en' union all select 1, 'docs.fr', doc_id from documents where lang = 'fr' union all select 2, 'pages', page_id from pages)")
def dataset_union(spark, sf):
    """A group of datasets as one ordered union."""
    from corpusloom.sources.registry import Registry

    reg = Registry()
    for k in ("en", "fr"):
        reg.add(f"docs.{k}", lambda s, k=k: table(s, sf, "documents").filter(F.col("lang") == k).select(F.col("doc_id").alias("id")))
    reg.add("pages", lambda s: table(s, sf, "pages").select(F.col("page_id").alias("id")))
    reg.group("mix", ["docs", "pages"])
    return reg.load(spark, "mix").select("dataset_at", "dataset", "id")


@query("""select distinct name, config from (select case doc_id % 3 when 0 then source || '-' || lang when 1 then 'the_' || source else source || '-books-' || lang end as name,
case doc_id % 3 when 0 then lang || '/' || upper(source[1]) || source[2:] when 1 then 'The' || upper(source[1]) || source[2:] else lang || '/' || upper(source[1]) || source[2:] || 'Books' end as config from documents)""")
def config_names(spark, sf):
    """Names of parts of documents, by source and language, as configurations."""
    from corpusloom.sources.registry import config_name_column

    k = F.col("doc_id") % 3
    name = F.when(k == 0, F.concat_ws("-", "source", "lang")).when(k == 1, F.concat(F.lit("the_"), "source")).otherwise(F.concat_ws("-", "source", F.lit("books"), "lang"))
    return table(spark, sf, "documents").select(name.alias("name")).distinct().select("name", config_name_column(F.col("name")).alias("config"))


@query("select doc_id from documents where doc_id % 10 <> 3")
def resume_skips_done(spark, sf):
    """What is not in the output yet."""
    done = docs(spark, sf).filter("doc_id % 10 = 3")
    return docs(spark, sf).join(done, "doc_id", "left_anti")


@query("select lang, count(*)::bigint as n, min(length(text))::bigint as shortest from documents group by lang")
def length_estimate(spark, sf):
    return docs(spark, sf, "lang", "text").groupBy("lang").agg(F.count("*").alias("n"), F.min(F.length("text")).cast("long").alias("shortest"))


@query("select doc_id, copy from (select doc_id, unnest(range(1, 4)) as copy from documents)")
def repeated_source(spark, sf):
    return docs(spark, sf).select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(3)).cast("array<long>")).alias("copy"))


@query("select doc_id from (select doc_id, row_number() over (order by doc_id) - 1 as r from documents) d join (select page_id as idx, case page_id % 3 when 0 then 'ru' when 1 then 'fr' else 'en' end as lang from pages) s on d.r = s.idx where s.lang in ('en', 'fr', 'de', 'es', 'it')")
def positional_filter(spark, sf):
    """The k-th row stays if the k-th line of a side table names a wanted language."""
    side = table(spark, sf, "pages").select(F.col("page_id").alias("idx"), F.when(F.col("page_id") % 3 == 0, "ru").when(F.col("page_id") % 3 == 1, "fr").otherwise("en").alias("lang"))
    return ordered.keep_by_position(docs(spark, sf), "doc_id", side, F.col("lang").isin("en", "fr", "de", "es", "it")).select("doc_id")


@query(f"select doc_id from documents where {_N} > 1000 order by doc_id limit 5")
def long_examples(spark, sf):
    from corpusloom.functions.text import word_count

    return ordered.examples(docs(spark, sf, "text"), "doc_id", word_count(F.col("text")), 5, 1000).select("doc_id")


@query(f"select doc_id, {_N}::bigint as n from documents where doc_id < 101")
def first_lengths(spark, sf):
    """Lengths of the first 101 texts."""
    from corpusloom.functions.text import word_count

    first = ordered.numbered(docs(spark, sf, word_count(F.col("text")).alias("n")), "doc_id", "at")
    return first.filter("at <= 100").select("doc_id", "n")


@query("select doc_id, md5(coalesce(case when doc_id % 2 = 0 then text end, source)) as text from documents")
def text_key(spark, sf):
    """The text's own column, or the fallback."""
    return table(spark, sf, "documents").select("doc_id", F.md5(F.coalesce(F.when(F.col("doc_id") % 2 == 0, F.col("text")), F.col("source"))).alias("text"))
