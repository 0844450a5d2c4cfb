"""Ordered series: training logs, cumulative curves, throughput lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators import ordered
from corpusloom.plans.registry import query, table

#: Cumulative training tokens at the end of the batch-size ramp and the stages' last step.
RAMP = [(5000, 5_700_059_136), (10_000, 13_884_194_816), (15_000, 26_008_354_816), (20_000, 43_747_901_440)]
STEP_TOKENS, STEP = 20_971_520_000, 5000
LAST_STEP, LAST_TOKENS = 753_851, 3_121_737_891_840


def tokens_at_step(step: Column) -> Column:
    """Tokens seen by a checkpointed step: a ramp, then linear; null for other steps."""
    last = RAMP[-1]
    linear = F.lit(last[1]) + (step - last[0]) / STEP * STEP_TOKENS
    out = F.when(step == LAST_STEP, F.lit(LAST_TOKENS))
    for s, n in RAMP:
        out = out.when(step == s, F.lit(n))
    return out.when((step > last[0]) & (step % STEP == 0), linear.cast("long"))


@query("select l_orderkey, l_linenumber, case step when 753851 then 3121737891840 when 5000 then 5700059136 when 10000 then 13884194816 when 15000 then 26008354816 when 20000 then 43747901440 else case when step > 20000 and step % 5000 = 0 then 43747901440 + (step - 20000) // 5000 * 20971520000 end end::bigint as tokens from (select l_orderkey, l_linenumber, case when l_orderkey % 50 = 0 then 753851 else l_orderkey % 40 * 2500 end as step from lineitem)")
def steps_to_tokens(spark, sf):
    step = F.when(F.col("l_orderkey") % 50 == 0, F.lit(LAST_STEP)).otherwise(F.col("l_orderkey") % 40 * 2500)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", tokens_at_step(step).alias("tokens"))


def monotone(df: DataFrame, order: str, value: str, group: str) -> DataFrame:
    """Rows whose value exceeds every earlier one, in each group; groups may be of any size."""
    rows = ordered.with_earlier(df, order, value, "_m", "max", group)
    return rows.filter(F.col("_m").isNull() | (F.col(value) > F.col("_m"))).drop("_m")


def with_hours(df: DataFrame, order: str, tokens: str, rate: Column, gpus: int, group: str) -> DataFrame:
    """Add cumulative wall and GPU hours from token gains at a rate per second."""
    rows = ordered.with_earlier(df, order, tokens, "_p", "last", group)
    hours = (F.col(tokens) - F.coalesce("_p", F.lit(0))) / rate / 3600
    rows = ordered.with_running(rows.withColumn("_h", hours), order, F.col("_h"), "walltime", within=group)
    return rows.withColumn("gputime", F.col("walltime") * gpus).drop("_h", "_p")


_SERIES = "(select user_id % 5 as run, event_id, event_id * 1000 + case when event_id % 17 = 0 then -50000 else 0 end as tokens, value from events)"
_MONO = f"(select * exclude (m) from (select *, max(tokens) over (partition by run order by event_id rows between unbounded preceding and 1 preceding) as m from {_SERIES}) where m is null or tokens > m)"


def _series(spark, sf):
    e = F.col("event_id")
    return table(spark, sf, "events").select((F.col("user_id") % 5).alias("run"), "event_id", (e * 1000 + F.when(e % 17 == 0, -50_000).otherwise(0)).alias("tokens"), "value")


@query(f"select run, event_id, tokens from {_MONO}")
def series_monotone(spark, sf):
    return monotone(_series(spark, sf), "event_id", "tokens", "run").select("run", "event_id", "tokens")


@query(f"select run, event_id, round(sum(h) over (partition by run order by event_id), 9) as walltime, round(512 * sum(h) over (partition by run order by event_id), 6) as gputime from (select run, event_id, (tokens - coalesce(lag(tokens) over (partition by run order by event_id), 0)) / 500.0::double / 3600 as h from {_MONO})")
def series_hours(spark, sf):
    rows = with_hours(monotone(_series(spark, sf), "event_id", "tokens", "run"), "event_id", "tokens", F.lit(500.0), 512, "run")
    return rows.select("run", "event_id", F.round("walltime", 9).alias("walltime"), F.round("gputime", 6).alias("gputime"))


@query("select block, round(avg(value), 6) as value, max(event_id) as event_id, count(*)::bigint as n from (select *, (row_number() over (order by event_id) - 1) // 50 as block from events) group by block")
def series_block_mean(spark, sf):
    rows = ordered.block_means(table(spark, sf, "events").select("event_id", "value"), "event_id", ["value"], 50)
    return rows.select("block", F.round("value", 6).alias("value"), "event_id", "n")


@query(f"""with t as (select run, sum(last) over (order by run rows between unbounded preceding and 1 preceding) as shift from (select run, max(tokens) as last from {_SERIES} group by run))
select s.run, event_id, (tokens + coalesce(shift, 0))::bigint as tokens from {_SERIES} s join t using (run)""")
def series_stitched(spark, sf):
    """Stages one after the other: each begins where the last one ended."""
    rows = _series(spark, sf)
    ends = rows.groupBy("run").agg(F.max("tokens").alias("last"))
    shift = F.sum("last").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1))  # one row a stage
    return rows.join(F.broadcast(ends.select("run", F.coalesce(shift, F.lit(0)).alias("shift"))), "run").select("run", "event_id", (F.col("tokens") + F.col("shift")).alias("tokens"))


def parse_throughput(lines: DataFrame) -> DataFrame:
    """Fields of iteration lines: iteration, samples per second, TFLOPs and loss, with the strategy from the file's name; files of skipped strategies drop out."""
    get = lambda p: F.regexp_extract("value", p, 1)
    rows = lines.filter(F.col("value").rlike(r"(?i)iteration +\d+") & ~F.col("file").contains("tp4"))
    return rows.select(
        "file",
        F.regexp_extract("file", r"tp(\d+)", 1).cast("int").alias("tp"),
        F.when(F.col("file").contains("no_pp"), 1).otherwise(F.regexp_extract("file", r"(?<!no_)pp(\d+)", 1).try_cast("int")).alias("pp"),
        get(r"iteration +(\d+)").cast("long").alias("iteration"),
        get(r"samples per second: +([0-9.]+)").cast("double").alias("samples_per_second"),
        get(r"TFLOPs: +([0-9.]+)").cast("double").alias("tflops"),
        get(r"lm loss: +([0-9.E+-]+)").cast("double").alias("loss"),
    )


@query("""select file, tp, pp, event_id as iteration, round(value, 3) as samples_per_second, round(value * 2, 2) as tflops, 10.0::double as loss
from (select event_id, value, case event_id % 4 when 0 then 'tp2_pp4.log' when 1 then 'tp1_no_pp.log' when 2 then 'tp4_pp1.log' else 'tp8_pp2.log' end as file, case event_id % 4 when 0 then 2 when 1 then 1 else 8 end as tp, case event_id % 4 when 0 then 4 when 1 then 1 else 2 end as pp from events) where file <> 'tp4_pp1.log' and event_id % 10 <> 0""")
def log_parse(spark, sf):
    e = F.col("event_id")
    file = F.when(e % 4 == 0, "tp2_pp4.log").when(e % 4 == 1, "tp1_no_pp.log").when(e % 4 == 2, "tp4_pp1.log").otherwise("tp8_pp2.log")
    head = F.when(e % 10 == 0, F.lit("saving checkpoint")).otherwise(F.format_string(" iteration %8d/  753851 | samples per second: %.3f | TFLOPs: %.2f | lm loss: 1.000000E+01 |", e, F.round("value", 3), F.round(F.col("value") * 2, 2)))
    return parse_throughput(table(spark, sf, "events").select(file.alias("file"), head.alias("value")))


@query("select event_type, user_id, event_id from (select *, row_number() over (partition by event_type, user_id order by ts desc, event_id desc) as r from events) where r = 1")
def last_rows(spark, sf):
    from corpusloom.operators.dedup import last_of_group

    return last_of_group(table(spark, sf, "events"), ["event_type", "user_id"], F.col("ts").desc(), F.col("event_id").desc()).select("event_type", "user_id", "event_id")
