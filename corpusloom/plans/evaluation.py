"""Evaluation results: nested JSON to long and wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.registry import query, table

RESULT_SCHEMA = "struct<model_name:string, chat_template:string, fewshot_as_multiturn:boolean, model_args:string, results:map<string, map<string, double>>>"

#: Metrics in order of preference.
METRICS = ["acc_norm,none", "acc,none", "exact_match,strict-match", "rouge1,none"]


def metric_of(benchmark: Column) -> Column:
    """The metric a benchmark is known by; null for others."""
    acc = ["mmlu", "mmlu_continuation", "winogrande", "french_bench_grammar", "french_bench_vocab", "truthfulqa_mc2"]
    rouge = ["french_bench_fquadv2_genq", "french_bench_fquadv2_hasAns", "french_bench_multifquad", "french_bench_trivia"]
    return (
        F.when(benchmark.contains("arc") | benchmark.contains("hellaswag"), F.lit("acc_norm,none"))
        .when(benchmark.isin(acc) | benchmark.contains("m_mmlu"), F.lit("acc,none"))
        .when(benchmark == "gsm8k", F.lit("exact_match,strict-match"))
        .when(benchmark.isin(rouge) | benchmark.contains("french_bench_orangesum_abstract"), F.lit("rouge1,none"))
    )


def first_metric(scores: Column, order: list[str] = METRICS) -> tuple[Column, Column]:
    """The first metric present, and its standard error (``acc_stderr,none`` beside ``acc,none``)."""
    error = lambda m: m.replace(",", "_stderr,", 1)
    return F.coalesce(*[F.element_at(scores, F.lit(m)) for m in order]), F.coalesce(*[F.when(F.element_at(scores, F.lit(m)).isNotNull(), F.coalesce(F.element_at(scores, F.lit(error(m))), F.lit(float("nan")))) for m in order])


def flatten(raw: DataFrame, json: str = "json") -> DataFrame:
    """One row for each model and benchmark."""
    rows = raw.select(F.from_json(json, RESULT_SCHEMA).alias("r")).select("r.*")
    each = rows.select("model_name", F.col("chat_template").isNotNull().alias("chat_template"), F.col("fewshot_as_multiturn").alias("multiturn"), F.coalesce(F.col("model_args").contains("add_bos_token=True"), F.lit(False)).alias("bos"), F.explode("results").alias("benchmark", "scores"))
    picked = each.withColumn("metric", metric_of(F.col("benchmark"))).filter("metric is not null")
    return picked.withColumn("score", F.element_at("scores", F.col("metric"))).drop("scores")


def wide(long: DataFrame, benchmarks: list[str]) -> DataFrame:
    """One row for each model, one column for each benchmark; -1 where there is no score."""
    return long.groupBy("model_name").pivot("benchmark", benchmarks).agg(F.max("score")).na.fill(-1)


def model_parts(name: Column, family: str) -> dict[str, Column]:
    """Phase, step and tokens of a model's name; ``family`` marks one's own models."""
    from corpusloom.plans.series import LAST_STEP, LAST_TOKENS, tokens_at_step

    own = name.contains(family)
    step = F.regexp_extract(name, r"global_step(\d+)", 1).try_cast("long")
    phase = F.when(~own | name.contains("pretrained"), "pretraining")
    for p in ("extension", "annealing", "instruction"):
        phase = phase.when(name.contains(p), p)
    tokens = F.when(own & (phase == "pretraining"), tokens_at_step(step)).when(own, F.lit(LAST_TOKENS))
    return {"name": F.when(own, F.lower(F.lit(family))).otherwise(F.element_at(F.split(name, "/"), -1)), "model_type": phase, "global_step": F.when(own & (phase == "pretraining"), step), "num_tokens": tokens, "checkpoint": F.coalesce(own & (phase == "pretraining") & (step != LAST_STEP), F.lit(False))}


BENCHMARKS = ["arc_challenge", "gsm8k", "m_mmlu_fr", "unknown"]


def _raw(spark, sf):
    """A result file for each customer, made from its balance."""
    b = F.col("c_acctbal")
    maps = [F.create_map(F.lit("acc,none"), b / 100, F.lit("acc_norm,none"), b / 50), F.create_map(F.lit("exact_match,strict-match"), b / 25, F.lit("acc,none"), F.lit(0.5)), F.create_map(F.lit("acc,none"), b / 10, F.lit("x"), F.lit(0.0)), F.create_map(F.lit("acc,none"), F.lit(1.0), F.lit("y"), F.lit(0.0))]
    results = F.map_from_arrays(F.array(*map(F.lit, BENCHMARKS)), F.array(*maps))
    row = F.struct(F.col("c_name").alias("model_name"), F.when(F.col("c_custkey") % 2 == 0, F.lit("t")).alias("chat_template"), (F.col("c_custkey") % 3 == 0).alias("fewshot_as_multiturn"), F.when(F.col("c_custkey") % 5 == 0, F.lit("a,add_bos_token=True")).alias("model_args"), results.alias("results"))
    return table(spark, sf, "customer").select(F.to_json(row).alias("json"))


@query("""select c_name as model_name, c_custkey % 2 = 0 as chat_template, c_custkey % 3 = 0 as multiturn, c_custkey % 5 = 0 as bos, benchmark, metric, round(score, 6) as score from customer,
lateral (values ('arc_challenge', 'acc_norm,none', c_acctbal / 50), ('gsm8k', 'exact_match,strict-match', c_acctbal / 25), ('m_mmlu_fr', 'acc,none', c_acctbal / 10)) v(benchmark, metric, score)""")
def eval_flatten(spark, sf):
    return flatten(_raw(spark, sf)).withColumn("score", F.round("score", 6))


@query("select c_name as model_name, round(c_acctbal / 50, 6) as arc_challenge, round(c_acctbal / 25, 6) as gsm8k, round(c_acctbal / 10, 6) as m_mmlu_fr, -1.0::double as absent from customer")
def eval_pivot(spark, sf):
    out = wide(flatten(_raw(spark, sf)), ["arc_challenge", "gsm8k", "m_mmlu_fr", "absent"])
    return out.select("model_name", *[F.round(c, 6).alias(c) for c in ("arc_challenge", "gsm8k", "m_mmlu_fr", "absent")])


@query("""select c_custkey, case when c_custkey % 4 <> 3 then 'ours' else 'm' || c_custkey end as name, case c_custkey % 4 when 0 then 'pretraining' when 1 then 'annealing' when 2 then 'instruction' else 'pretraining' end as model_type,
case when c_custkey % 4 = 0 then 25000 end::bigint as global_step, case c_custkey % 4 when 0 then 43747901440 + 20971520000 when 3 then null else 3121737891840 end::bigint as num_tokens, c_custkey % 4 = 0 as checkpoint from customer""")
def model_names(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 4 == 0, "x/Ours-pretrained/global_step25000").when(k % 4 == 1, "Ours-annealing").when(k % 4 == 2, "a/Ours-instruction").otherwise(F.concat(F.lit("org/m"), k.cast("string")))
    rows = table(spark, sf, "customer").select("c_custkey", name.alias("n"))
    return rows.select("c_custkey", *[v.alias(c) for c, v in model_parts(F.col("n"), "Ours").items()])


@query("select c_custkey, round(case when c_custkey % 2 = 0 then c_acctbal else c_acctbal / 2 end, 6) as score, round(case when c_custkey % 2 = 0 then 0.1 else 0.2 end::double, 6) as stderr from customer")
def metric_choice(spark, sf):
    even = F.col("c_custkey") % 2 == 0
    b = F.col("c_acctbal")
    scores = F.when(even, F.create_map(F.lit("acc_norm,none"), b, F.lit("acc_norm_stderr,none"), F.lit(0.1), F.lit("acc,none"), F.lit(9.0))).otherwise(F.create_map(F.lit("acc,none"), b / 2, F.lit("acc_stderr,none"), F.lit(0.2)))
    value, error = first_metric(F.col("s"))
    return table(spark, sf, "customer").select("c_custkey", scores.alias("s")).select("c_custkey", F.round(value, 6).alias("score"), F.round(error, 6).alias("stderr"))


@query("select c_nationkey, c_mktsegment, count(*)::bigint as n, string_agg(c_name, ',' order by c_name) as names from customer group by all")
def results_concatenated(spark, sf):
    """Lists of results joined for each setting; a list is one row and grows with its group."""
    rows = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment", F.array("c_name").alias("results"))
    out = rows.groupBy("c_nationkey", "c_mktsegment").agg(F.array_sort(F.flatten(F.collect_list("results"))).alias("r"))
    return out.select("c_nationkey", "c_mktsegment", F.size("r").cast("long").alias("n"), F.array_join("r", ",").alias("names"))


@query("""select c_custkey, min(i)::int as matched from customer, (values (0, 'BUILDING', null::int), (1, null, 3), (2, 'MACHINERY', 5)) r(i, segment, nation) where (segment is null or segment = c_mktsegment) and (nation is null or nation = c_nationkey) group by c_custkey""")
def wildcard_selection(spark, sf):
    """Rows that a list of patterns with wildcards selects, and the first pattern that does; the patterns are a literal list."""
    rules = [("BUILDING", None), (None, 3), ("MACHINERY", 5)]
    hit = None
    for i, (segment, nation) in enumerate(rules):
        ok = (F.lit(True) if segment is None else F.col("c_mktsegment") == segment) & (F.lit(True) if nation is None else F.col("c_nationkey") == nation)
        hit = F.when(ok, F.lit(i)) if hit is None else hit.when(ok, F.lit(i))
    return table(spark, sf, "customer").select("c_custkey", hit.alias("matched")).filter("matched is not null")


@query("select c_mktsegment, c_nationkey, c_custkey from customer where regexp_matches(c_name, '1$') and c_acctbal > 1000 and not contains(c_mktsegment, 'AUTO')")
def report_filter(spark, sf):
    rows = table(spark, sf, "customer").filter(F.col("c_name").rlike("1$") & (F.col("c_acctbal") > 1000) & ~F.col("c_mktsegment").contains("AUTO"))
    return rows.select("c_mktsegment", "c_nationkey", "c_custkey")
