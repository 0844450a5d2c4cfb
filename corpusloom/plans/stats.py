"""Corpus statistics, roll-ups and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import filters, statistics
from corpusloom.plans.registry import query, table

_W = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"
_C = f"(select doc_id, lang, source, 1::bigint as docs, {_W}::bigint as words, length(text)::bigint as chars from documents)"
_S = "sum(docs)::bigint as docs, sum(words)::bigint as words, sum(chars)::bigint as chars"


def counted(spark, sf):
    return statistics.counted(table(spark, sf, "documents").select("doc_id", "lang", "source", "text")).drop("text")


@query(f"select source, {_S} from {_C} group by source")
def corpus_stats(spark, sf):
    return statistics.totals(counted(spark, sf), "source")


@query(f"select {_S} from {_C}")
def corpus_stats_folded(spark, sf):
    """Totals of partial totals."""
    return statistics.totals(statistics.totals(counted(spark, sf), "lang", "source"))


@query(f"select case when grouping(lang) = 1 then '---' else lang end as lang, case when grouping(source) = 1 then '---' else source end as source, {_S} from {_C} group by rollup(lang, source)")
def stats_rollup(spark, sf):
    return statistics.rolled_up(counted(spark, sf), "lang", "source")


@query(f"select coalesce(lang, '---') as lang, count(*)::bigint as datasets, {_S} from (select lang, source, {_S} from {_C} group by lang, source) group by grouping sets ((lang), ())")
def language_totals(spark, sf):
    each = statistics.totals(counted(spark, sf), "lang", "source")
    out = each.cube("lang").agg(F.count("*").alias("datasets"), *[F.sum(c).alias(c) for c in statistics.COUNTS])
    return out.select(F.coalesce("lang", F.lit("---")).alias("lang"), "datasets", *statistics.COUNTS)


_BOOK = "case when doc_id % 3 = 0 then null else 1700 + doc_id % 260 end"
_AGE = "case lang when 'fr' then 80 else 70 end"
_DIED = "case when doc_id % 5 = 0 then null else 1800 + doc_id % 200 end"
_LEGAL = f"""(select *, coalesce(rights <> 'copyright', true) as free, case when died is not null then died <= 2024 - {_AGE} when born is not null then born <= 2024 - {_AGE} - 80 else true end as age_ok
from (select c.*, {_BOOK} as born, {_DIED} as died, case when doc_id % 4 = 0 then 'copyright' when doc_id % 4 = 1 then null else 'public' end as rights from {_C} c))"""


def books(spark, sf):
    d = F.col("doc_id")
    rows = counted(spark, sf).withColumn("born", F.when(d % 3 != 0, 1700 + d % 260)).withColumn("died", F.when(d % 5 != 0, 1800 + d % 200))
    return rows.withColumn("rights", F.when(d % 4 == 0, "copyright").when(d % 4 != 1, "public"))


@query(f"select doc_id from {_LEGAL} where case lang when 'en' then free else free and age_ok end")
def legal_books(spark, sf):
    return books(spark, sf).filter(filters.legal_status(F.col("born"), F.col("died"), F.col("rights"), F.col("lang"))).select("doc_id")


@query(f"select lang, coalesce(case when grouping(age_ok) = 1 then 'TOTAL' else age_ok::varchar end, 'x') as age_ok, case when grouping(rights) = 1 then 'TOTAL' else coalesce(rights, 'none') end as rights, {_S} from {_LEGAL} group by grouping sets ((lang, age_ok, rights), (lang))")
def legality_crosstab(spark, sf):
    rows = books(spark, sf)
    age = filters.legal_status(F.col("born"), F.col("died"), F.lit("public"), F.when(F.col("lang") == "fr", "fr").otherwise("x"))
    rows = rows.select("lang", age.cast("string").alias("age_ok"), F.coalesce("rights", F.lit("none")).alias("rights"), *statistics.COUNTS)
    cells = statistics.totals(rows, "lang", "age_ok", "rights")
    whole = statistics.totals(cells, "lang").select("lang", F.lit("TOTAL").alias("age_ok"), F.lit("TOTAL").alias("rights"), *statistics.COUNTS)
    return cells.unionByName(whole)


@query("""select doc_id, source, case when born is null then first_born else born end as born from (select doc_id, source, born, first_value(born ignore nulls) over (partition by source order by doc_id rows unbounded preceding) as first_born from (select doc_id, source, case when doc_id % 4 = 0 then 1800 + doc_id % 90 end as born from documents))""")
def first_seen_dates(spark, sf):
    """An author's missing date is the first one seen before."""
    born = F.when(F.col("doc_id") % 4 == 0, 1800 + F.col("doc_id") % 90)
    rows = table(spark, sf, "documents").select("doc_id", "source", born.alias("born"))
    first = rows.filter("born is not null").groupBy("source").agg(F.min(F.struct("doc_id", "born")).alias("first"))
    seen = F.when(F.col("first.doc_id") <= F.col("doc_id"), F.col("first.born"))
    return rows.join(first, "source", "left").select("doc_id", "source", F.coalesce("born", seen).alias("born"))


@query(f"select split_part(source, '_', 1) as prefix, {_S} from (select doc_id, source || '_' || doc_id as source, docs, words, chars from {_C}) group by 1 having sum(words) > 0")
def collection_totals(spark, sf):
    rows = counted(spark, sf).withColumn("prefix", F.substring_index(F.concat("source", F.lit("_"), "doc_id"), "_", 1))
    return statistics.totals(rows, "prefix").filter("words > 0")


_TOK = "(select lang, source, words as n_tokens from " + _C + ")"
_T4 = "sum(n_tokens)::bigint as total_tokens, count(*)::bigint as total_sequences, min(n_tokens)::bigint as min_tokens, max(n_tokens)::bigint as max_tokens"


@query(f"select source, {_T4} from {_TOK} group by source")
def token_counts(spark, sf):
    return statistics.token_stats(counted(spark, sf).withColumnRenamed("words", "n_tokens"), "source")


@query(f"select lang, {_T4} from {_TOK} group by lang")
def token_counts_merged(spark, sf):
    parts = statistics.token_stats(counted(spark, sf).withColumnRenamed("words", "n_tokens"), "lang", "source")
    return statistics.merge_token_stats(parts, "lang")


@query(f"select case when n_tokens <= 512 then 'short' else 'long' end as side, {_T4} from {_TOK} group by 1")
def length_split(spark, sf):
    rows = counted(spark, sf).withColumnRenamed("words", "n_tokens")
    return statistics.token_stats(rows.withColumn("side", F.when(F.col("n_tokens") <= 512, "short").otherwise("long")), "side")


@query(f"""select source, round(docs / 1e6, 9) as m_docs, round(words / 1e9, 9) as b_words, round(words::double / docs, 6) as words_per_doc, round(chars::double / case when words = 0 then 1 else words end, 6) as chars_per_word,
case when abs(docs - sequences) / 1e6 <= 0.01 then round(tokens::double / words, 6) end as tokens_per_word, case when abs(docs - sequences) / 1e6 <= 0.01 then round(chars::double / tokens, 6) end as chars_per_token
from (select source, {_S}, sum(chars)::bigint // 4 as tokens, sum(docs)::bigint + case when source = 'src1' then 20000 else 0 end as sequences from {_C} group by source)""")
def derived_metrics(spark, sf):
    rows = statistics.totals(counted(spark, sf), "source").withColumn("tokens", F.floor(F.col("chars") / 4)).withColumn("sequences", F.col("docs") + F.when(F.col("source") == "src1", 20_000).otherwise(0))
    out = statistics.derived(rows)
    return out.select("source", *[F.round(c, 9 if c[1] == "_" else 6).alias(c) for c in ("m_docs", "b_words", "words_per_doc", "chars_per_word", "tokens_per_word", "chars_per_token")])


@query(f"""select lang, count(*)::bigint as pages, sum(len(string_split(text, chr(10) || chr(10))))::bigint as paragraphs, sum(len(string_split(text, chr(10))))::bigint as lines, sum({_W})::bigint as words, sum(length(text))::bigint as chars, sum(strlen(text))::bigint as bytes,
sum(length(text) - length(replace(text, ' ', '')))::bigint as spaces, sum(length(text) - length(replace(text, chr(10), '')))::bigint as linebreaks, sum(length(text) - length(replace(text, chr(9), '')))::bigint as tabs, sum(length(text) - length(regexp_replace(text, '[0-9]', '', 'g')))::bigint as digits from documents group by lang""")
def text_counters(spark, sf):
    c = statistics.text_counters(F.col("text"))
    return table(spark, sf, "documents").groupBy("lang").agg(*[F.sum(v).alias(k) for k, v in c.items()])


@query(f"""select source, round(sum(chars)::double / sum(words), 6) as chars_per_token, round(avg(words::double / docs), 6) as mean_words from {_C} group by source""")
def tokenizer_ratios(spark, sf):
    return counted(spark, sf).groupBy("source").agg(F.round(F.sum("chars") / F.sum("words"), 6).alias("chars_per_token"), F.round(F.avg(F.col("words") / F.col("docs")), 6).alias("mean_words"))


@query("select count(distinct lang)::bigint as langs, count(distinct source)::bigint as sources, count(distinct text)::bigint as texts from documents")
def distinct_counts(spark, sf):
    """Distinct values; texts by their MD5, whose 128 bits tell 10^15 texts apart with a chance of error below 10^-8."""
    docs = table(spark, sf, "documents").select("lang", "source", F.unhex(F.md5("text")).alias("h"))
    return docs.agg(F.countDistinct("lang").alias("langs"), F.countDistinct("source").alias("sources"), F.countDistinct("h").alias("texts"))


@query(f"""select lang, source, round(100.0::double * words / sum(words) over (), 6) as percent from (select lang, source, sum(words)::bigint as words from {_C} group by lang, source) qualify 100.0 * words / sum(words) over () >= 0.8""")
def composition(spark, sf):
    """Shares of categories, without slices under 0.8 percent."""
    each = statistics.totals(counted(spark, sf), "lang", "source")
    whole = each.agg(F.sum("words").alias("whole"))
    share = each.join(F.broadcast(whole)).withColumn("percent", 100.0 * F.col("words") / F.col("whole"))  # one row
    return share.filter("percent >= 0.8").select("lang", "source", F.round("percent", 6).alias("percent"))


@query(f"""select lang, source, row_number() over (order by (case when lang = '---' then 8 else 0 end) + (case when source = '---' then 4 else 0 end) desc, lw desc, words desc, source desc, lang desc) as place
from (select r.*, case r.lang when 'en' then 0 when 'fr' then 1e32 else coalesce(t.words, 1e20) end as lw from (select case when grouping(lang) = 1 then '---' else lang end as lang, case when grouping(source) = 1 then '---' else source end as source, sum(words)::bigint as words from {_C} group by rollup(lang, source)) r left join (select lang, sum(words)::double as words from {_C} group by lang) t on r.lang = t.lang)""")
def report_order(spark, sf):
    """Report rows: totals first, then by their language's words (one language first, one last), words and name.  The report is small by nature."""
    from pyspark.sql import Window

    rows = statistics.rolled_up(counted(spark, sf), "lang", "source")
    by = rows.filter("source = '---' and lang <> '---'").select("lang", F.col("words").cast("double").alias("lw"))
    rows = rows.join(F.broadcast(by), "lang", "left")
    level = F.when(F.col("lang") == "---", 8).otherwise(0) + F.when(F.col("source") == "---", 4).otherwise(0)
    weight = F.when(F.col("lang") == "en", F.lit(0.0)).when(F.col("lang") == "fr", F.lit(1e32)).otherwise(F.coalesce("lw", F.lit(1e20)))
    at = F.row_number().over(Window.orderBy(level.desc(), weight.desc(), F.col("words").desc(), F.col("source").desc(), F.col("lang").desc()))
    return rows.select("lang", "source", at.cast("long").alias("place"))


@query("""select p_partkey, trim(case when x = 0 then printf('%.3f', x) when round(x, 3) >= 0.1 then printf('%.3f', x) when round(x, 4) >= 0.01 then printf('%.4f', x) when round(x, 5) >= 0.001 then printf('%.5f', x) when round(x, 6) >= 0.0001 then printf('%.6f', x) else printf('%.7f', x) end) as shown from (select p_partkey, (p_partkey % 7) / pow(10, p_partkey % 5)::double as x from part)""")
def shown_digits(spark, sf):
    x = (F.col("p_partkey") % 7) / F.pow(F.lit(10.0), F.col("p_partkey") % 5)
    return table(spark, sf, "part").select("p_partkey", F.trim(statistics.at_least_digits(x)).alias("shown"))


@query("""select source, lang, doc_id // 500 as part, min(doc_id) as first, string_agg(doc_id::varchar, ',' order by doc_id) as ids from documents group by all""")
def files_grouped(spark, sf):
    """Files, here documents, listed by a name derived from theirs: source, language and part; a part has at most 500."""
    rows = table(spark, sf, "documents").groupBy("source", "lang", F.floor(F.col("doc_id") / 500).alias("part")).agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return rows.select("source", "lang", "part", F.array_min("ids").alias("first"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


_LEVELS = f"(select coalesce(lang, '---') as lang, coalesce(source, '---') as source, coalesce(subset, '---') as subset, words, grouping_id from (select lang, source, subset, sum(words)::bigint as words, grouping(lang) * 4 + grouping(source) * 2 + grouping(subset) as grouping_id from (select *, 'p' || (doc_id % 3) as subset from {_C}) where doc_id % 4 <> 1 and (doc_id % 3 <> 2 or source < 'src3') group by rollup(lang, source, subset)))"


@query(f"""with l as {_LEVELS}, k as (select lang, source, 'p' || (doc_id % 3) as subset, count(*)::bigint as docs from documents group by all)
select k.lang, k.source, k.subset, k.docs, coalesce(a.words, b.words, c.words, d.words) as words, case when a.words is not null then 0 when b.words is not null then 1 when c.words is not null then 2 else 3 end::int as level from k
left join l a on a.lang = k.lang and a.source = k.source and a.subset = k.subset left join l b on b.lang = k.lang and b.source = k.source and b.subset = '---'
left join l c on c.lang = k.lang and c.source = '---' and c.subset = '---' left join l d on d.lang = '---' and d.source = '---' and d.subset = '---'""")
def hierarchical_lookup(spark, sf):
    """Word totals for language, source and part from a table of totals that lacks some: of the part, else of the source, the language, all."""
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source", "text", F.concat(F.lit("p"), (F.col("doc_id") % 3).cast("string")).alias("subset"))
    known = statistics.counted(rows.filter("doc_id % 4 <> 1 and (doc_id % 3 <> 2 or source < 'src3')")).drop("text")
    totals = statistics.rolled_up(known, "lang", "source", "subset").select("lang", "source", "subset", "words")
    asked = rows.groupBy("lang", "source", "subset").agg(F.count("*").alias("docs"))
    return statistics.looked_up(asked, totals, ["lang", "source", "subset"]).select("lang", "source", "subset", "docs", "words", "level")
