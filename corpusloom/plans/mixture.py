"""Training mixtures: epochs, weights, extension merges, targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import word_count
from corpusloom.operators.statistics import matched
from corpusloom.plans.registry import query, table
from corpusloom.sources import scratch, sinks

#: Epochs of each language--category, and multipliers of languages ("other" for the rest).
EPOCHS = {"en--a": 1.0, "en--b": 2.0, "fr--a": 1.5, "fr--b": 3.0, "de--a": 1.0, "de--b": 2.5, "es--a": 0.5, "es--b": 1.0}
MULTIPLIERS = {"en": 1.0, "fr": 2.0}
OTHER = 0.5


def canonical_name(name: Column, subset: Column) -> Column:
    return F.regexp_replace(F.concat(F.replace(name, F.lit("."), F.lit("--")), F.lit("--"), subset), "-+$", "")


def output_name(file: Column) -> Column:
    """A shard's name without its number and ending."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(file, r"\.[a-z]+$", ""), "_text_document$", ""), r"[-_.]*\d+$", "")


def reweighted(df: DataFrame, count: str = "count") -> DataFrame:
    """Add epochs, the reweighted count and both shares.  A language--category without epochs is an error."""
    spark = df.sparkSession
    epochs = spark.createDataFrame(list(EPOCHS.items()), "key string, epochs double")
    factor = spark.createDataFrame(list(MULTIPLIERS.items()), "language string, factor double")
    rows = df.withColumn("key", F.concat("language", F.lit("--"), "category")).join(F.broadcast(epochs), "key", "left").join(F.broadcast(factor), "language", "left")
    n = F.when(F.col("epochs").isNull(), F.raise_error(F.concat(F.lit("no epochs for "), "key")).cast("double")).otherwise(F.col("epochs") * F.coalesce("factor", F.lit(OTHER)))
    rows = rows.withColumn("num_epochs", n).withColumn("reweighted_count", F.col("num_epochs") * F.col(count)).drop("factor", "epochs", "key")
    whole = rows.agg(F.sum(count).alias("_a"), F.sum("reweighted_count").alias("_b"))
    return rows.join(F.broadcast(whole)).withColumn("ratio", F.col(count) / F.col("_a")).withColumn("new_ratio", F.col("reweighted_count") / F.col("_b")).drop("_a", "_b")  # one row


_W = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"
_BASE = f"(select lang || '.' || source as prefix, lang as language, case when substr(source, 4)::int % 2 = 0 then 'a' else 'b' end as category, sum({_W})::bigint as count from documents group by all)"
_EPOCHS = "(case language || '--' || category " + " ".join(f"when '{k}' then {v}::double" for k, v in EPOCHS.items()) + " end * case language when 'en' then 1.0::double when 'fr' then 2.0::double else 0.5::double end)"
_MIX = f"(select *, {_EPOCHS} as num_epochs, {_EPOCHS} * count as reweighted_count from {_BASE})"


def base(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat("lang", F.lit("."), "source").alias("prefix"), F.col("lang").alias("language"), F.when(F.substring("source", 4, 9).cast("int") % 2 == 0, "a").otherwise("b").alias("category"), word_count(F.col("text")).alias("n"))
    return docs.groupBy("prefix", "language", "category").agg(F.sum("n").alias("count"))


@query(f"select prefix, num_epochs, round(count / sum(count) over (), 9) as ratio, round(reweighted_count / sum(reweighted_count) over (), 9) as new_ratio from {_MIX}")
def mixture_weights(spark, sf):
    return reweighted(base(spark, sf)).select("prefix", "num_epochs", F.round("ratio", 9).alias("ratio"), F.round("new_ratio", 9).alias("new_ratio"))


@query(f"select case when language in ('en', 'fr') then language else 'aligned' end as language, sum(count)::bigint as count, round(sum(reweighted_count), 3) as reweighted_count from {_MIX} group by 1")
def mixture_by_language(spark, sf):
    rows = reweighted(base(spark, sf)).withColumn("language", F.when(F.col("language").isin("en", "fr"), F.col("language")).otherwise("aligned"))
    return rows.groupBy("language").agg(F.sum("count").alias("count"), F.round(F.sum("reweighted_count"), 3).alias("reweighted_count"))


@query(f"select string_agg(printf('%11.9f', new_ratio) || ' ' || prefix || ' ', '' order by new_ratio desc, prefix) as text from (select prefix, reweighted_count / sum(reweighted_count) over () as new_ratio from {_MIX})")
def mixture_text(spark, sf):
    return sinks.weight_text(reweighted(base(spark, sf)))


@query("""with m as (select case when contains(name, 'src1') then 'grouped' else name end as name, sum(w)::double as w from (select lang || '-' || source as name, count(*) as w from documents group by all) group by 1),
s as (select lang || '-' || source as name, count(*)::double as c from documents where length(text) < 1200 group by all), l as (select lang || '-' || source as name, count(*)::double as c from documents where length(text) >= 1200 group by all),
j as (select coalesce(m.name, x.name) as name, m.w, x.cs, x.cl from m full join (select coalesce(s.name, l.name) as name, coalesce(s.c, 0) as cs, coalesce(l.c, 0) as cl from s full join l on s.name = l.name) x on m.name = x.name)
select name, side, round(ratio, 9) as ratio from (select name, 'short' as side, w * (cs / (cs + 10 * cl)) as ratio from j union all select name, 'long', w * (1 - cs / (cs + 10 * cl)) from j) where ratio is not null""")
def extension_merge(spark, sf):
    """Weights of the main mixture dealt to short and long texts by name; names on one side only drop out."""
    docs = table(spark, sf, "documents").select(F.concat("lang", F.lit("-"), "source").alias("name"), (F.length("text") < 1200).alias("short"))
    main = docs.groupBy("name").agg(F.count("*").alias("w"))
    main = main.groupBy(F.when(F.col("name").contains("src1"), "grouped").otherwise(F.col("name")).alias("name")).agg(F.sum("w").cast("double").alias("w"))
    side = lambda flag, c: docs.filter(F.col("short") == flag).groupBy("name").agg(F.count("*").cast("double").alias(c))
    both = side(True, "cs").join(side(False, "cl"), "name", "full").na.fill(0.0, ["cs", "cl"])
    rows = main.join(both, "name", "full").withColumn("p", F.col("cs") / (F.col("cs") + 10 * F.col("cl")))
    out = rows.select("name", F.explode(F.array(F.struct(F.lit("short").alias("side"), (F.col("w") * F.col("p")).alias("ratio")), F.struct(F.lit("long").alias("side"), (F.col("w") * (1 - F.col("p"))).alias("ratio")))).alias("x"))
    return out.select("name", "x.side", F.round("x.ratio", 9).alias("ratio")).na.drop()


def target_weights(df: DataFrame, targets: dict[str, float]) -> DataFrame:
    """(language, weight) that bring languages to target shares; the rest is shared out by what the others hold.  A row of several languages (a-b) counts for each in even parts.  df: language, count, weighted."""
    parts = F.split("language", "-")
    each = df.select(F.explode(parts).alias("language"), F.floor(F.col("weighted") / F.size(parts)).alias("n"))
    sums = each.groupBy("language").agg(F.sum("n").cast("double").alias("n"))
    goals = df.sparkSession.createDataFrame(list(targets.items()), "language string, goal double")
    known = sums.join(F.broadcast(goals), "language", "left")
    whole = known.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("goal").isNull(), F.col("n"))).alias("rest"))
    share = F.coalesce("goal", F.lit(1 - sum(targets.values())) * F.col("n") / F.col("rest"))
    return known.join(F.broadcast(whole)).select("language", share.alias("target"), (share / (F.col("n") / F.col("all"))).alias("weight"))  # one row


@query(f"""with e as (select unnest(string_split(language, '-')) as language, floor(w / len(string_split(language, '-'))) as n from (select case when category = 'a' then language else language || '-en' end as language, count * 1.5::double as w from {_BASE})),
s as (select language, sum(n)::double as n from e group by 1), g as (select language, n, case language when 'en' then 0.4::double when 'fr' then 0.3::double end as goal, sum(n) over () as whole, sum(case when language in ('en', 'fr') then 0 else n end) over () as rest from s)
select language, round(coalesce(goal, 0.3::double * n / rest), 9) as target, round(coalesce(goal, 0.3::double * n / rest) / (n / whole), 9) as weight from g""")
def target_reweight(spark, sf):
    rows = base(spark, sf).select(F.when(F.col("category") == "a", F.col("language")).otherwise(F.concat("language", F.lit("-en"))).alias("language"), (F.col("count") * 1.5).alias("weighted"))
    out = target_weights(rows, {"en": 0.4, "fr": 0.3})
    return out.select("language", F.round("target", 9).alias("target"), F.round("weight", 9).alias("weight"))


@query("""with y as (select event_type as name, sum(value) filter (user_id % 10 between 3 and 6 and event_type <> 'click') as n from events group by 1), m as (select name, coalesce(n, min(n) over ()) as n from y)
select name, round(n / sum(n) over (), 6) as share from m""")
def activity_shares(spark, sf):
    """Shares by activity in a range of years; a name without any takes the least of the others.  One row a name, so the window is small."""
    years = (F.col("user_id") % 10).between(3, 6) & (F.col("event_type") != "click")
    sums = table(spark, sf, "events").groupBy(F.col("event_type").alias("name")).agg(F.sum(F.when(years, F.col("value"))).alias("n"))
    whole = Window.partitionBy()
    return sums.withColumn("n", F.coalesce("n", F.min("n").over(whole))).select("name", F.round(F.col("n") / F.sum("n").over(whole), 6).alias("share"))


def nearest_name(names: DataFrame, known: DataFrame, block: int = 1000) -> DataFrame:
    """(name, match, distance): the known name of least edit distance, ties by name; a null name has the first and no distance, null known names don't count, and without known names there are no rows.

    All names are compared with all, in blocks of about ``block`` names on each
    side: pairs of blocks are dealt to all tasks, each finds the nearest within
    its pair, and the nearest of these is the result.  Work grows as names times
    known names, what a task holds does not.
    """
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ours, theirs = names.select("name").distinct(), known.select("name").filter("name is not null").distinct()
    sizes = [scratch.written(d, "names") for d in (ours, theirs)]
    blocks = [max(1, -(-d.count() // block)) for d in sizes]
    in_blocks = lambda d, n: d.groupBy(F.pmod(F.xxhash64("name"), F.lit(n)).alias("b"))
    left = in_blocks(sizes[0], blocks[0]).agg(F.array_agg(F.struct("name")).alias("ours"))  # in structs, since array_agg drops nulls
    right = in_blocks(sizes[1], blocks[1]).agg(F.collect_list("name").alias("theirs")).withColumnRenamed("b", "c")
    pairs = left.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks[1] - 1)).cast("array<bigint>"))).join(right, "c").repartition(tasks, "b", "c")
    each = pairs.select(F.explode("ours").alias("o"), "theirs").select("o.name", F.array_min(F.transform("theirs", lambda k: F.struct(F.levenshtein(F.col("o.name"), k).alias("distance"), k.alias("match")))).alias("n"))
    return each.groupBy("name").agg(F.min("n").alias("n")).select("name", "n.match", "n.distance")


@query("""select name, match, distance::int as distance from (select a.name, b.name as match, levenshtein(a.name, b.name) as distance, row_number() over (partition by a.name order by levenshtein(a.name, b.name), b.name) as r
from (select distinct source || lang as name from documents) a, (select distinct lang || source as name from documents where doc_id % 2 = 0) b) where r = 1""")
def nearest_names(spark, sf):
    docs = table(spark, sf, "documents")
    return nearest_name(docs.select(F.concat("source", "lang").alias("name")), docs.filter("doc_id % 2 = 0").select(F.concat("lang", "source").alias("name")))


@query("""select t.source, t.n as tokens, s.n as docs from (select regexp_replace(source || '.' || lang, '\\.', '--') as source, sum(length(text))::bigint as n from documents group by 1) t join (select source || '--' || lang as source, count(*)::bigint as n from documents group by 1) s on t.source = s.source""")
def token_stats_lookup(spark, sf):
    """Token counts with corpus statistics by canonical name."""
    docs = table(spark, sf, "documents")
    tokens = docs.groupBy(canonical_name(F.concat("source", F.lit("."), "lang"), F.lit("")).alias("source")).agg(F.sum(F.length("text")).alias("tokens"))
    stats = docs.groupBy(canonical_name(F.col("source"), F.col("lang")).alias("source")).agg(F.count("*").alias("docs"))
    return matched(tokens, stats, "source").select("source", "tokens", "docs")


@query("select doc_id, source || '_' || lang as name from documents")
def output_names(spark, sf):
    file = F.concat("source", F.lit("_"), "lang", F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 5, "0"), F.lit("_text_document.bin"))
    return table(spark, sf, "documents").select("doc_id", output_name(F.regexp_replace(file, "-([0-9]+)_text_document", "_text_document-$1")).alias("name")).select("doc_id", F.regexp_replace("name", "_text_document$", "").alias("name"))


@query("""select language, kind, round((1 / pow(n, 2)) / sum(1 / pow(n, 2)) over (partition by language, kind), 9) as p, n from (select lang as language, source as kind, length(text) as n, doc_id from documents)""")
def template_probabilities(spark, sf):
    """Weights of templates, one over their length squared, in each language and kind; null ones are groups of their own.  An empty template weighs infinitely much: it has no number for a share, and the others of its group have 0."""
    rows = table(spark, sf, "documents").select(F.col("lang").alias("language"), F.col("source").alias("kind"), F.length("text").cast("long").alias("n"))
    w = F.when(F.col("n") == 0, F.lit(float("inf"))).otherwise(1 / F.pow("n", F.lit(2.0)))  # Spark's division by zero is an error
    total = rows.groupBy(F.col("language").alias("_l"), F.col("kind").alias("_k")).agg(F.sum(w).alias("total"))  # summed before the shuffle; a row for each language and kind
    same = F.col("language").eqNullSafe(F.col("_l")) & F.col("kind").eqNullSafe(F.col("_k"))
    return rows.withColumn("w", w).join(total, same).select("language", "kind", F.round(F.col("w") / F.col("total"), 9).alias("p"), "n")
