"""Web pipeline: signals, rule chains, URL predicates, robots, joins on shards."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.functions import urls
from corpusloom.operators import filters, ordered, signals
from corpusloom.plans.registry import query, table
from corpusloom.sources import registry, scratch, web_shards

WORDS = r"list_filter(regexp_split_to_array(text, '[ \t\n\x0b\f\r]+'), lambda w: w <> '')"

_SHAPE = f"""
with t as (select doc_id, lang, source, text, {WORDS} as w, string_split(text, chr(10)) as l from documents),
shape as (
  select doc_id, lang, source, text, w, len(w)::bigint as word_count,
    case when len(w) > 0 then list_sum(list_transform(w, lambda x: length(x)))::double / len(w) else 0 end as mean_word_length,
    case when len(w) > 0 then len(regexp_extract_all(text, '#|\\.\\.\\.|…'))::double / len(w) else 0 end as symbol_to_word_ratio,
    len(list_filter(l, lambda x: regexp_matches(x, '^ *[-*•▪‣]')))::double / len(l) as bullet_line_ratio,
    len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…) *$')))::double / len(l) as ellipsis_line_ratio,
    case when len(w) > 0 then len(list_filter(w, lambda x: not regexp_matches(x, '\\p{{L}}')))::double / len(w) else 0 end as no_alpha_word_ratio,
    (length(text) - length(regexp_replace(text, '[{{}}]', '', 'g')))::int as curly_count,
    len(regexp_extract_all(lower(text), 'lorem ipsum'))::bigint as lorem_count,
    len(regexp_extract_all(text, '[.!?]+'))::bigint as sentence_count
  from t)"""

_GRAMS = """,
total as (select doc_id, greatest(list_sum(list_transform(w, lambda x: length(x))), 1)::double as chars from shape where len(w) > 0),
grams as (
  select doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') as g, length(array_to_string(list_slice(w, i, i + n - 1), '')) as mass
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from shape, (select unnest(range(2, 11)) as n) where len(w) >= n)),
counted as (select *, count(*) over (partition by doc_id, n, g) as c from grams),
tops as (
  select doc_id, n, case when c > 1 then least(c * mass / chars, 1) else 0 end as share
  from (select *, row_number() over (partition by doc_id, n order by c desc, mass desc, i) as r from counted where n <= 4) join total using (doc_id) where r = 1),
cover as (select distinct doc_id, n, unnest(range(i, i + n)) as k from counted where n >= 5 and c > 1),
dupes as (select doc_id, n, sum(length(w[k])) / any_value(chars) as share from cover join shape using (doc_id) join total using (doc_id) group by doc_id, n),
rep as (
  select doc_id, """ + ", ".join(f"coalesce(max(share) filter (n = {n}), 0)::double as {name}" for n, name in [(2, "top_2gram"), (3, "top_3gram"), (4, "top_4gram"), *((n, f"dupe_{n}grams") for n in range(5, 11))]) + """
  from (select doc_id, n, share from tops union all select doc_id, n, share from dupes union all select doc_id, 0, 0 from shape) group by doc_id)"""


def _sql_case(rules, columns) -> str:
    parts = []
    for name, signal, least, most in rules:
        if signal in columns:
            bad = [f"{signal} < {least}" for _ in [0] if least is not None] + [f"{signal} > {most}" for _ in [0] if most is not None]
            parts.append(f"when {' or '.join(bad)} then '{name}'")
    return "case " + " ".join(parts) + " end"


SHAPE = ["word_count", "mean_word_length", "symbol_to_word_ratio", "bullet_line_ratio", "ellipsis_line_ratio", "no_alpha_word_ratio", "curly_count", "lorem_count", "sentence_count"]
ALL = SHAPE + signals.REPETITION
_ROUNDED = ", ".join(f"round({c}, 6) as {c}" if "ratio" in c or "mean" in c or "gram" in c else c for c in ALL)


def _rounded(df, names):
    return df.select("doc_id", *[F.round(c, 6).alias(c) if "ratio" in c or "mean" in c or "gram" in c else F.col(c) for c in names])


@query(_SHAPE + _GRAMS + f" select doc_id, {_ROUNDED} from shape join rep using (doc_id)")
def doc_signals(spark, sf):
    return _rounded(signals.with_signals(table(spark, sf, "documents").select("doc_id", "text")), ALL)


_JUDGED = _SHAPE + _GRAMS + f", judged as (select doc_id, lang, source, word_count, {_sql_case(filters.WEB_RULES, ALL)} as reason from shape join rep using (doc_id))"


@query(_JUDGED + " select doc_id, reason from judged")
def quality_reason(spark, sf):
    return filters.with_reason(signals.with_signals(table(spark, sf, "documents"))).select("doc_id", "reason")


@query(_JUDGED + " select coalesce(reason, 'kept') as reason, count(*)::bigint as docs, sum(word_count)::bigint as words from judged group by 1")
def quality_funnel(spark, sf):
    judged = filters.with_reason(signals.with_signals(table(spark, sf, "documents").select("text")))
    return judged.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("docs"), F.sum("word_count").alias("words"))


@query(_JUDGED + " select doc_id, lang, source, word_count from judged where reason is null")
def quality_kept(spark, sf):
    kept, _ = filters.split_by_reason(signals.with_signals(table(spark, sf, "documents").select("doc_id", "lang", "source", "text")))
    return kept.select("doc_id", "lang", "source", "word_count")


@query(_SHAPE + _GRAMS + f" select doc_id, {_sql_case(filters.VARIANT_RULES, ALL)} as reason from shape join rep using (doc_id)")
def quality_variant_reason(spark, sf):
    return filters.with_reason(signals.with_signals(table(spark, sf, "documents").select("doc_id", "text")), filters.VARIANT_RULES).select("doc_id", "reason")


_HOST = "lower(regexp_extract(regexp_replace(url, '://+', '://', 'g'), '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1))"


@query(f"select page_id, {_HOST} as host from pages")
def url_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host"))


_LANG = "case page_id % 3 when 0 then 'fr' when 1 then 'en' else 'de' end"


def _covered(lang: str) -> str:
    return "(" + " or ".join(f"contains(u, '{k}')" for k in urls.COVERED[lang]) + ")"


@query(f"""
select page_id, case when lang = 'fr' and {_covered('fr')} or lang = 'en' and {_covered('en')} or lang = 'de' and {_covered('other')} then 'dedup_url' when black is not null then 'blacklist_url' end as reason
from (select page_id, replace(replace(url, 'example.com', 'en.wikipedia.org'), 'example.org', 'europarl.europa.eu') as u, {_LANG} as lang, case when contains(url, 'utm_source') then 'ads' end as black from pages)""")
def url_overlap_filter(spark, sf):
    url = F.replace(F.replace("url", F.lit("example.com"), F.lit("en.wikipedia.org")), F.lit("example.org"), F.lit("europarl.europa.eu"))
    lang = F.when(F.col("page_id") % 3 == 0, "fr").when(F.col("page_id") % 3 == 1, "en").otherwise("de")
    return table(spark, sf, "pages").select("page_id", filters.url_reason(url, lang, F.when(F.col("url").contains("utm_source"), "ads")).alias("reason"))


@query(f"select page_id, url from (select page_id, url, {_HOST} as host from pages) where host in (select distinct {_HOST} from pages where page_id % 4 <> 0)")
def domain_semi_join(spark, sf):
    """Keep pages whose host may be fetched.  The host list grows with the crawl, so the planner's own size check decides on a broadcast."""
    pages = table(spark, sf, "pages").select("page_id", "url", urls.host(F.col("url")).alias("host"))
    valid = pages.filter(F.col("page_id") % 4 != 0).select("host").distinct()
    return pages.join(valid, "host", "left_semi").select("page_id", "url")


@query(f"select page_id, host from (select page_id, {_HOST} as host from pages) where not (host = 'example.net' or ends_with(host, '.net'))")
def url_blocklist(spark, sf):
    """Drop pages whose host, or a parent domain of it, is listed; every suffix of the host is looked up by an equi join."""
    pages = table(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host"))
    listed = spark.createDataFrame([("net",), ("example.net",)], "suffix string")
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    bad = pages.select("page_id", F.explode(suffixes).alias("suffix")).join(listed, "suffix", "left_semi").select("page_id").distinct()
    return pages.join(bad, "page_id", "left_anti").select("page_id", "host")


_BAD = ["the", "and", "reing", "der", "de", "que"]


@query("select doc_id, len(list_intersect(list_distinct(regexp_split_to_array(regexp_replace(text, '[^\\p{L} ]+', '', 'g'), ' +')), ['the', 'and', 'reing', 'der', 'de', 'que'])) >= 3 as obscene from documents")
def obscene_flag(spark, sf):
    return table(spark, sf, "documents").select("doc_id", filters.is_obscene(F.col("text"), F.array(*map(F.lit, _BAD))).alias("obscene"))


#: Fetch errors as a crawler logs them, one kind for each event modulo 8.
ERRORS = [
    "HTTPSConnectionPool(host='a', port=443): Max retries exceeded (Caused by NewConnectionError('<x>: [Errno 111] Connection refused'))",
    "HTTPSConnectionPool(host='a', port=443): Read timed out. (read timeout=5)",
    "HTTPSConnectionPool(host='a'): Max retries (Caused by ConnectTimeoutError(connect timeout=5))",
    "404 Client Error: Not Found for url: http://a",
    "403 Client Error: Forbidden for url: http://a",
    "503 Server Error: Unavailable for url: http://a",
    "Exceeded 30 redirects.",
    "HTTPSConnectionPool(host='b', port=443): Max retries exceeded (Caused by NameError('<y>: [Errno -2] Name or service not known'))",
]


@query("""select case event_id % 8 when 0 then '[Errno 111] Connection refused' when 1 then 'Read timed out' when 2 then 'connect timeout' when 3 then '404 Client Error' when 4 then '4xx Client Error' when 5 then '5xx Server Error' when 6 then 'Other error' else '[Errno -2] Name or service not known' end as error_type, count(*)::bigint as n from events group by 1""")
def robots_error_histogram(spark, sf):
    log = F.element_at(F.array(*map(F.lit, ERRORS)), (F.col("event_id") % 8 + 1).cast("int"))
    return table(spark, sf, "events").groupBy(filters.error_class(log).alias("error_type")).agg(F.count("*").alias("n"))


@query("select doc_id, source, doc_id % 7 = 0 as is_duplicate from documents where doc_id % 7 <> 0 or doc_id % 5 = 0")
def duplicate_flag_join(spark, sf):
    """Flag listed duplicates; drop them but for multiples of five."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    listed = docs.filter("doc_id % 7 = 0").select("doc_id", F.lit(True).alias("listed"))
    flagged = docs.join(listed, "doc_id", "left").withColumn("is_duplicate", F.col("listed").isNotNull())
    return flagged.filter(filters.not_duplicate(F.col("is_duplicate")) | (F.col("doc_id") % 5 == 0)).select("doc_id", "source", "is_duplicate")


@query("""select a.source, a.doc_id, b.doc_id as signal_id from (select source, doc_id, row_number() over (partition by source order by doc_id) as r from documents) a
join (select source, doc_id, row_number() over (partition by source order by doc_id) as r from documents where doc_id % 3 <> 0) b on a.source = b.source and a.r = b.r""")
def positional_zip(spark, sf):
    """The k-th document of a shard with its k-th signal row; the shorter side ends the shard."""
    docs = table(spark, sf, "documents").select("source", "doc_id")
    right = ordered.numbered(docs.filter("doc_id % 3 <> 0"), "doc_id", "r", within="source").withColumnRenamed("doc_id", "signal_id")
    return ordered.numbered(docs, "doc_id", "r", within="source").join(right, ["source", "r"]).select("source", "doc_id", "signal_id")


@query("""with held as (select distinct source, lang, doc_id % 40 as shard, case when doc_id % 2 = 0 then 'head' else 'middle' end as part from documents)
select 's' || source as snapshot, n as shard, lang, part from (select distinct source from documents) a, range(40) b(n), (select distinct lang from documents) c, (values ('head'), ('middle')) d(part)
where exists (from held h where h.source = a.source and h.lang = c.lang and h.shard = n and h.part = d.part) and n < 10""")
def shard_listing(spark, sf):
    """All (snapshot, shard, language, partition) files that documents may lie in, less those that would be empty, for a sample of ten shards."""
    docs = table(spark, sf, "documents").select(F.concat(F.lit("s"), "source").alias("snapshot"), (F.col("doc_id") % 40).alias("shard"), "lang", F.when(F.col("doc_id") % 2 == 0, "head").otherwise("middle").alias("part")).distinct()
    names = {c: [r[0] for r in docs.select(c).distinct().filter(f"{c} is not null").collect()] for c in ("snapshot", "lang")}  # sources and languages: a few
    listing = registry.shard_files(spark, names["snapshot"], 40, names["lang"], ["head", "middle"])
    missing = listing.join(docs, listing.columns, "left_anti")
    return registry.without_missing(listing, missing).filter("shard < 10")


#: Of the documents whose id leaves this remainder modulo 50, one line is broken: the document cut, without its digest, the signals cut.
CUT, SHORT, BESIDE = 7, 9, 11
SNAPSHOT = "2023-06"


def web_shard_rows(spark, sf):
    """documents as lines of a crawl's files, some of them broken; head and middle have signals, of which some files are listed as missing."""
    docs = table(spark, sf, "documents")
    shards = max(3, -(-docs.count() // 4000))
    part = F.element_at(F.array(*map(F.lit, ["head", "middle", "tail"])), F.pmod("doc_id", F.lit(3)).cast("int") + 1)
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards))
    hard = {"ignoreNullFields": "false"}
    fields = {"url": F.concat(F.lit("https://h/"), F.col("doc_id").cast("string")), "language": F.col("lang"), "source_domain": F.lit("h"), "date_download": F.lit("2023-06-01T00:00:00Z"), "raw_content": F.col("text")}
    whole = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()], F.md5("text").alias("digest")), hard)
    short = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), hard)
    left = F.pmod("doc_id", F.lit(50))
    doc = F.when(left == CUT, F.substring(whole, F.lit(1), F.length(whole) - 5)).when(left == SHORT, short).otherwise(whole)
    n = F.length("text").cast("double")
    signals = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.struct(F.array(F.array(F.lit(0.0), n, n)).alias("ccnet_length")).alias("quality_signals")))
    signals = F.when(left == BESIDE, F.substring(signals, F.lit(1), F.length(signals) - 3)).otherwise(signals)
    tag = web_shards.tag(F.lit(SNAPSHOT), shard, F.coalesce("lang", F.lit("xx")), part)
    rows = docs.select(tag.alias("tag"), F.col("doc_id").alias("at"), doc.alias("doc"), F.when(part != "tail", signals).alias("signals"), (F.pmod("doc_id", F.lit(7)) == 0).alias("duplicate"))
    return rows, shards


@query()
def web_shards_read(spark, sf):
    """documents written as a crawl's gzip shards and read back by place: lines zipped with their signals, duplicates flagged, broken lines and missing files told apart.  The files stay in a folder of their own."""
    root = f"{scratch.shared_dir(spark)}/web-{uuid.uuid4().hex}"
    rows, shards = web_shard_rows(spark, sf)
    shards_written = scratch.written(web_shards.write(rows, root), "shards")
    languages = [r.lang for r in shards_written.select(F.regexp_extract("tag", "/([^/]*)_[a-z]+$", 1).alias("lang")).distinct().collect()]  # languages: a few
    listing = registry.shard_files(spark, [SNAPSHOT], shards, languages, ["head", "middle", "tail"])
    placed = web_shards.files(listing)
    empty = placed.join(shards_written, "tag", "left_anti").select(F.col("documents").alias("path"))
    beside = placed.filter("part = 'head' and tag like '%/___1/%'").select(F.col("signals").alias("path"))
    found = web_shards.read(listing, root, empty.union(beside))
    keep = {"id": F.regexp_extract(F.get_json_object("meta", "$.url"), "([0-9]+)$", 1).try_cast("long"), "part": F.get_json_object("meta", "$.partition"), "language": F.get_json_object("meta", "$.language"), "length": F.get_json_object("quality_signals", "$.ccnet_length[0][2]").cast("double").cast("long"), "is_duplicate": F.get_json_object("quality_signals", "$.is_duplicate").cast("boolean"), "text": F.md5("raw_content")}
    return found.select("doc_id", "tag", "row", *[c.alias(n) for n, c in keep.items()], "problem")


@query("""select domain, can_fetch from (select lang as domain, min(doc_id) % 2 = 0 as can_fetch from documents group by lang) where can_fetch""")
def valid_domains(spark, sf):
    domains = table(spark, sf, "documents").groupBy(F.col("lang").alias("domain")).agg((F.min("doc_id") % 2 == 0).alias("can_fetch"))
    return domains.filter("can_fetch")


@query("""select page_id, case page_id % 4 when 0 then false when 1 then true when 2 then true else not contains(url, '/en/') end as can_fetch from pages""")
def robots_can_fetch(spark, sf):
    """Whether a crawler may fetch a page by its site's robots text, already fetched."""
    from corpusloom.functions import udfs

    robots = F.element_at(F.array(*map(F.lit, ["User-agent: *\nDisallow: /", "", "User-agent: CCBot\nAllow: /\n\nUser-agent: *\nDisallow: /", "User-agent: CCBot\nDisallow: /en/"])), (F.col("page_id") % 4 + 1).cast("int"))
    path = F.concat(F.lit("http://h/"), F.regexp_extract("url", "://[^/]*/(.*)", 1))
    return table(spark, sf, "pages").select("page_id", udfs.can_fetch(robots, path).alias("can_fetch"))
