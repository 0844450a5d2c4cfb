"""Heterogeneous metadata in one schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import labels, uniform
from corpusloom.plans.registry import query, table
from corpusloom.sources import sinks


def raw(spark, sf):
    """Documents under the names a source may use."""
    d = table(spark, sf, "documents")
    return d.select(F.concat(F.lit("http://x/"), F.col("doc_id").cast("string")).alias("doc_id"), F.col("lang"), F.col("source"), F.when(F.col("doc_id") % 3 == 0, "None").otherwise(F.col("source")).alias("author"), F.col("n_chars").alias("char_count"), (F.col("doc_id") % 50 + 1800).cast("string").alias("authoryearofbirth"), F.current_date().cast("string").alias("max_stars_repo_x"), F.lit("t").alias("page_title"), F.col("text"))


@query("""select 'http://x/' || doc_id as id, 'http://x/' || doc_id as url, lang as language, 't' as title, case when doc_id % 3 = 0 then null else source end as author_name, (doc_id % 50 + 1800)::int as born, n_chars::bigint as char_count, source as subset from documents""")
def metadata_uniform(spark, sf):
    """The grouped fields, read back from their JSON."""
    out = uniform.uniformise(raw(spark, sf))
    return out.select("id", "url", "language", "title", F.get_json_object("author", "$.author").alias("author_name"), F.get_json_object("author", "$.authoryearofbirth").cast("int").alias("born"), F.get_json_object("quality_signals", "$.char_count").cast("long").alias("char_count"), F.get_json_object("extra", "$.subset").alias("subset"))


@query("""select md5(text) as text, source, id::varchar as id, language, '' as date, '' as url from (select text, source, doc_id as id, lang as language from documents union all select html, '', page_id, '' from pages)""")
def union_padded(spark, sf):
    """Tables of different columns as one, with "" for what is missing."""
    docs = table(spark, sf, "documents").select("text", "source", F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("language"))
    pages = table(spark, sf, "pages").select(F.col("html").alias("text"), F.col("page_id").cast("string").alias("id"))
    out = sinks.published(docs.unionByName(pages, allowMissingColumns=True))
    return out.select(F.md5("text").alias("text"), "source", "id", "language", "date", "url")


@query("select event_id, (props->>'$.page') as page, (props->>'$.k') as k from events")
def json_fields(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.get_json_object("props", "$.k").alias("k"))


@query("select page_id, url from pages")
def url_from_meta(spark, sf):
    meta = F.to_json(F.struct("url", F.lit("x").alias("digest")))
    return table(spark, sf, "pages").select("page_id", uniform.url_of(meta).alias("url"))


@query("select doc_id, lang, n_chars::bigint as n_chars from documents")
def metadata_flattened(spark, sf):
    """Metadata in JSON, in single quotes too, as columns."""
    meta = F.to_json(F.struct("lang", F.col("n_chars")))
    meta = F.when(F.col("doc_id") % 2 == 0, F.replace(meta, F.lit('"'), F.lit("'"))).otherwise(meta)
    return uniform.flattened(table(spark, sf, "documents").select("doc_id", meta.alias("meta")), "meta", "lang string, n_chars bigint")


@query("select doc_id, case lang when 'es' then 'es' when 'de' then 'de' when 'fr' then 'fr' else 'en' end as language, case when doc_id % 4 = 0 then 'code' else 'natural' end as category from documents")
def language_codes(spark, sf):
    three = F.when(F.col("lang") == "es", "spa").when(F.col("lang") == "de", "deu").when(F.col("lang") == "fr", "fra").otherwise("eng")
    name = F.when(F.col("doc_id") % 4 == 0, "TheStack").otherwise("Books")
    return table(spark, sf, "documents").select("doc_id", uniform.two_letters(three).alias("language"), uniform.category(name).alias("category"))


@query("""select file, lang, dataset, subset, count(*)::bigint as docs from (select case doc_id % 4 when 0 then 'stats_Set' || source || '--' || lang || '--p' || (doc_id % 3) || '.json' when 1 then 'stats_PeS2o--' || source || '.json' when 2 then 'stats_TheStack--' || source || '_text_document.json' else 'stats_' || source || '--' || lang || '-en.json' end as file,
case doc_id % 4 when 0 then lang when 1 then 'en' when 2 then 'code' else lang || '-en' end as lang, case doc_id % 4 when 0 then 'Set' || source || '.' || lang when 1 then 'PeS2o' when 2 then 'TheStack' else source || '.' || lang || '-en' end as dataset, case doc_id % 4 when 0 then 'p' || (doc_id % 3) when 1 then source when 2 then source else '' end as subset from documents) group by all""")
def names_parsed(spark, sf):
    """Language, dataset and part from the names of the statistics files that documents would be counted in."""
    k = F.col("doc_id") % 4
    file = F.when(k == 0, F.concat(F.lit("Set"), "source", F.lit("--"), "lang", F.lit("--p"), (F.col("doc_id") % 3).cast("string"))).when(k == 1, F.concat(F.lit("PeS2o--"), "source")).when(k == 2, F.concat(F.lit("TheStack--"), "source", F.lit("_text_document"))).otherwise(F.concat("source", F.lit("--"), "lang", F.lit("-en")))
    files = table(spark, sf, "documents").groupBy(F.concat(F.lit("stats_"), file, F.lit(".json")).alias("file")).agg(F.count("*").alias("docs"))
    return files.select("file", *[v.alias(k) for k, v in uniform.parsed_name(F.col("file")).items()], "docs")


@query("""select name, types from (values ('doc_id', 'bigint,string'), ('lang', 'string'), ('page_id', 'bigint'), ('text', 'string')) v(name, types)""")
def schema_union(spark, sf):
    """Types by column over several sources; conflicts give a list."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    more = table(spark, sf, "pages").select("page_id", F.col("html").alias("text"), F.lit("x").alias("doc_id"))
    return uniform.schema_union([docs, more])


@query("select page_id, regexp_replace(regexp_replace(url, '[ :/]', '--', 'g'), '^[_-]+|[_-]+$', '', 'g') as slug from pages")
def slugs(spark, sf):
    from corpusloom.functions.text import slug

    return table(spark, sf, "pages").select("page_id", slug(F.col("url")).alias("slug"))


_NAMED = ["HAL", "PeS2o", "Theses_2020", "Gutenberg.fr", "Pile", "OtherFr", "RedPajama--fr--2019", "FineWebEdu--cc-main-2018", "---", "nope", "Ubuntu IRC", ""]
_PARTS = ["FreeLaw", "", "Senat"]


@query(f"""with d as (select doc_id, {_NAMED}[doc_id % 12 + 1] as name, {_PARTS}[doc_id // 12 % 3 + 1] as subset from documents)
select doc_id, case when name in ('---', '') then '' when name = 'PeS2o' then 'mixed' when name in ('HAL', 'Theses_2020') then 'true' else 'false' end as ocr,
case when name in ('---', '') then '' when name in ('HAL', 'PeS2o') then 'technical' when name = 'Gutenberg.fr' then 'book' when name in ('Pile', 'OtherFr') and subset = 'FreeLaw' then 'legi_written' when name in ('Pile', 'OtherFr') and subset = 'Senat' then 'legi_dialogue' when name like 'RedPajama%' then 'web' when name = 'Ubuntu IRC' then 'forum' end as category from d""")
def dataset_labels(spark, sf):
    """Scanned or not, and the category, of datasets by name."""
    at = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i % len(names) + 1).cast("int"))
    rows = table(spark, sf, "documents").select("doc_id", at(_NAMED, F.col("doc_id")).alias("name"), at(_PARTS, F.floor(F.col("doc_id") / 12)).alias("subset"))
    return rows.select("doc_id", labels.scanned(F.col("name")).alias("ocr"), labels.dataset_category(F.col("name"), F.col("subset")).alias("category"))
