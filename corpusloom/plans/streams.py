"""Event-time queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.plans.registry import query, table
from corpusloom.streaming import incremental


@query("select date_trunc('hour', ts) as start, event_type, count(*)::bigint as n, round(sum(value), 6) as value from events group by all")
def hourly_events(spark, sf):
    return incremental.windowed_counts(table(spark, sf, "events")).withColumn("value", F.round("value", 6))


@query("""with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as new from events),
s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from g)
select user_id, min(ts) as start, max(ts) + interval 30 minutes as "end", count(*)::bigint as n from s group by user_id, k""")
def user_sessions(spark, sf):
    return incremental.sessions(table(spark, sf, "events"))
