"""Queries of readings against schedules, assignment histories, scopes and neighbours: events as readings, customers as workers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import periods, sensors, zones
from ..sources import stores
from .catalog import _SECONDS, event_seconds, frame, table
from .zones import _C, _vertices

_CLOCK = """with e as (select event_id, event_id * 37 % 1440 as m, case when user_id % 11 = 0 then null else user_id * 53 % 1440 end as st from events),
 f as (select *, (st + 480 + event_id % 3 * 60) % 1440 as en, (st + 200) % 1440 as bf, (st + 230) % 1440 as bt from e),
 g as (select *, en < st as night from f), h as (select *, case when night and m <= en then m + 1440 else m end as t, case when night then en + 1440 else en end as close,
  bf + case when night and bf < st then 1440 else 0 end as b1, bt + case when night and bt < st then 1440 else 0 end as b2 from g) """


@frame(_CLOCK + "select event_id, case when st is null then 'none' when t < st then 'before' when t > close then 'after' when t between b1 and b2 then 'break' else 'during' end as category from h")
def time_category(spark, d):
    e = table(spark, d, "events").selectExpr("event_id", "event_id * 37 % 1440 as m", "if(user_id % 11 = 0, null, user_id * 53 % 1440) as st")
    e = e.selectExpr("*", "(st + 480 + event_id % 3 * 60) % 1440 as en", "array(struct((st + 200) % 1440 as `from`, (st + 230) % 1440 as `to`)) as breaks")
    return e.select("event_id", sensors.time_category(F.col("m"), F.col("st"), F.col("en"), F.col("breaks")).alias("category"))


@frame("""with e as (select event_id, event_id % 24 * 60 + event_id % 4 * 15 as st, (event_id % 24 + 8 + event_id % 3) % 24 * 60 as en, case when event_id % 5 = 0 then 0 else 30 end as pause from events),
 g as (select *, case when en < st then en + 1440 - st else en - st end as gross from e) select event_id, gross / 60.0::double as gross, pause / 60.0::double as pause, (gross - pause) / 60.0::double as net from g""")
def schedule_durations(spark, d):
    e = table(spark, d, "events").selectExpr("event_id", "concat(event_id % 24, ':', event_id % 4 * 15, ':00') as st", "cast((event_id % 24 + 8 + event_id % 3) % 24 as string) as en", "if(event_id % 5 = 0, null, array(struct(double(700) as `from`, double(730) as `to`))) as breaks")
    hours = sensors.shift_hours(sensors.minutes(F.col("st")), sensors.minutes(F.col("en")), F.col("breaks"))
    return e.select("event_id", hours.alias("h")).select("event_id", "h.gross", "h.pause", "h.net")


@frame("select event_id, case when hour(ts) between 6 and 13 then 'morning' when hour(ts) between 14 and 21 then 'afternoon' else 'night' end as part from events")
def hour_category_3(spark, d):
    return table(spark, d, "events").select("event_id", sensors.hour_category_3(F.hour("ts")).alias("part"))


@frame("with e as (select event_id, event_id % 97 as t, user_id % 89 as a, event_id * 7 % 101 as b, case when event_id % 3 = 0 then null else event_id * 11 % 103 end as c from events), f as (select event_id, abs(t - a) as x, abs(t - b) as y, coalesce(abs(t - c), 100000) as z from e) select event_id, case when x <= y and x <= z then 'a' when y <= z then 'b' else 'c' end as nearest from f")
def nearest_of_three(spark, d):
    e = table(spark, d, "events").selectExpr("event_id", "event_id % 97 as t", "user_id % 89 as a", "event_id * 7 % 101 as b", "if(event_id % 3 = 0, null, event_id * 11 % 103) as c")
    return e.select("event_id", sensors.nearest_of(F.col("t"), [(F.col(c), F.lit(c)) for c in "abc"]).alias("nearest"))


_MISSED = f"""with e as ({_SECONDS}), m as (select *, lead(event_id) over w - event_id - 1 as gap, floor((lead("at") over w - "at") / case when event_type <> 'error' then 180 else 600 end)::bigint as held from e window w as (partition by user_id order by event_id, "at")),
 q as (select *, case when gap between 1 and case when event_type <> 'error' then 400 else 200 end then greatest(0, least(gap, held)) else 0 end::bigint as missed from m) """


@frame(_MISSED + "select event_id, missed from q")
def missed_readings(spark, d):
    return sensors.missed_readings(event_seconds(spark, d), ["user_id"], "event_id", "at", F.col("event_type") != "error").select("event_id", "missed")


@frame(f"""with e as ({_SECONDS}), s as (select user_id, min("at") as a, max("at") as b from e group by 1), p as (select *, unnest(range(0, greatest(b - a - 1, 0) // 86400 + 1)) as part from s) select user_id, part, a + part * 86400 as first_at, least(b, a + part * 86400 + 86400) as last_at from p""")
def session_split_24h(spark, d):
    s = event_seconds(spark, d).groupBy("user_id").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    return sensors.split_days(s, "first_at", "last_at").select("user_id", "part", "first_at", "last_at")


PARTS, KINDS = ["night", "morning", "afternoon", "evening"], ["click", "view", "purchase", "error", "signup"]
_PART = "case when hour(ts) < 6 then 'night' when hour(ts) < 12 then 'morning' when hour(ts) < 18 then 'afternoon' else 'evening' end"
_CELLS = ", ".join(f"sum(event_id % 10) filter (where part = '{p}' and event_type = '{k}')::bigint as {p}_{k}" for p in PARTS for k in KINDS)


def _parted(spark, d):
    e = table(spark, d, "events")
    return e.withColumns({"part": sensors.hour_category(F.hour("ts")), "spent": F.col("event_id") % 10})


@frame(f"with e as (select *, {_PART} as part from events) select user_id, {_CELLS}, count(*) as n from e group by 1")
def shift_metrics(spark, d):
    return sensors.cells(_parted(spark, d), ["user_id"], "part", PARTS, "event_type", KINDS, F.col("spent"), F.count(F.lit(1)).alias("n"))


@frame("""with r as (select event_id, user_id, ts + to_hours(case user_id % 3 when 0 then 2 when 1 then -5 else 0 end::int) as local_at from events),
 s as (select c_custkey as user_id, date '2024-01-05' as f, date '2024-01-20' as t, 'early' as shift from customer where c_custkey % 4 <> 0 union all select c_custkey, date '2024-01-20', null, 'late' from customer where c_custkey % 4 <> 1)
 select r.event_id, cast(local_at as date) as local_day, hour(local_at)::int as local_hour, shift from r left join s on s.user_id = r.user_id and f <= cast(local_at as date) and (t is null or t > cast(local_at as date))""")
def align_to_schedule(spark, d):
    r = table(spark, d, "events").selectExpr("event_id", "user_id", "ts", "case user_id % 3 when 0 then '+02:00' when 1 then '-05:00' else 'UTC' end as zone")
    c = table(spark, d, "customer")
    early = c.where("c_custkey % 4 <> 0").selectExpr("c_custkey as user_id", "date '2024-01-05' as valid_from", "date '2024-01-20' as valid_to", "'early' as shift")
    late = c.where("c_custkey % 4 <> 1").selectExpr("c_custkey as user_id", "date '2024-01-20' as valid_from", "cast(null as date) as valid_to", "'late' as shift")
    out = sensors.align_to_schedule(r, early.unionByName(late), "user_id", "ts", "zone")
    return out.select("event_id", "local_day", F.hour("local_at").alias("local_hour"), "shift")


_CHANGES = "select o_custkey, 'trade' as property, o_orderpriority as value, o_orderkey as at from orders union all select o_custkey, 'state', o_orderstatus, o_orderkey from orders"


@frame(f"""with c as ({_CHANGES}), f as (select *, lag(value) over w as p, row_number() over w as rn from c window w as (partition by o_custkey, property order by "at", value)), g as (select * from f where rn = 1 or value is distinct from p)
 select o_custkey, property, value, "at" as valid_from, lead("at") over (partition by o_custkey, property order by "at", value) as valid_to from g""")
def properties_history(spark, d):
    o = table(spark, d, "orders")
    trade, state = (o.select("o_custkey", F.lit(n).alias("property"), F.col(c).alias("value"), F.col("o_orderkey").alias("at")) for n, c in (("trade", "o_orderpriority"), ("state", "o_orderstatus")))
    return sensors.histories(trade.unionByName(state), ["o_custkey", "property"], "value", "at")


@frame("""with p as (select o_custkey, o_orderstatus, row_number() over (partition by o_custkey order by o_orderkey) * 10 as a, case when o_orderkey % 3 <> 0 then 10 else 8 end as w from orders), q as (select *, a + w as b from p),
 m as (select *, case when a = lag(b) over v and o_orderstatus = lag(o_orderstatus) over v then 0 else 1 end as fresh from q window v as (partition by o_custkey order by a, b)), g as (select *, sum(fresh) over (partition by o_custkey order by a, b rows unbounded preceding) as run from m)
 select o_custkey, o_orderstatus, min(a)::bigint as a, max(b)::bigint as b, count(*) as n from g group by o_custkey, o_orderstatus, run""")
def coalesce_periods_adjacent(spark, d):
    p = table(spark, d, "orders").selectExpr("o_custkey", "o_orderstatus", "cast(row_number() over (partition by o_custkey order by o_orderkey) * 10 as bigint) as a", "o_orderkey")
    q = p.withColumn("b", F.col("a") + F.expr("if(o_orderkey % 3 <> 0, 10, 8)"))
    return sensors.adjacent(q, ["o_custkey"], "a", "b", ["o_orderstatus"])


_SCOPE = """with rules as (select n_nationkey as rule_id, case n_nationkey % 3 when 0 then 'worker' when 1 then 'crew' else 'all' end as scope, (n_nationkey * 7 % 20)::bigint as target, n_nationkey % 5 * 100 as a, n_nationkey % 5 * 100 + 300 as b from nation),
 members as (select c_custkey as worker, c_nationkey as crew, (c_custkey % 400)::int as a, (c_custkey % 400 + 300)::int as b from customer),
 scope as (select rule_id, target as worker, a, b from rules where scope = 'worker' union select r.rule_id, m.worker, greatest(r.a, m.a), least(r.b, m.b) from rules r join members m on (r.scope = 'crew' and r.target = m.crew) or r.scope = 'all' where greatest(r.a, m.a) < least(r.b, m.b)) """


def _rules(spark, d):
    rules = table(spark, d, "nation").selectExpr("n_nationkey as rule_id", "case n_nationkey % 3 when 0 then 'worker' when 1 then 'crew' else 'all' end as scope", "cast(n_nationkey * 7 % 20 as bigint) as target", "n_nationkey % 5 * 100 as a", "n_nationkey % 5 * 100 + 300 as b")
    members = table(spark, d, "customer").selectExpr("c_custkey as worker", "c_nationkey as crew", "cast(c_custkey % 400 as int) as a", "cast(c_custkey % 400 + 300 as int) as b")
    return sensors.rule_scope(rules, members)


@frame(_SCOPE + "select rule_id, e.event_id % 7 as floor, count(*) as contacts, count(distinct user_id) as workers from events e join scope s on s.worker = e.user_id and s.a <= e.event_id % 1000 and e.event_id % 1000 < s.b group by 1, 2")
def contacts_rule_scope(spark, d):
    contacts = table(spark, d, "events").selectExpr("user_id as worker", "event_id % 1000 as at", "event_id % 7 as floor")
    return sensors.scoped(contacts, _rules(spark, d), "floor")


_AREAS = "select c_custkey as worker, c_nationkey % 5 as cell, 0 as a, 500 as b from customer where c_custkey % 4 <> 0 union all select c_custkey, (c_nationkey + 2) % 5, 500, 900 from customer"


@frame(f"""with areas as ({_AREAS}), r as (select event_id as reading, user_id as worker, event_id % 1000 as at, event_id % 5 as cell, case when event_id % 2 = 0 then 'inside' end as was from events),
 k as (select r.reading, r.worker, was, max(case when areas.worker is null then 0 when areas.cell = r.cell then 2 else 1 end) as k from r left join areas on areas.worker = r.worker and areas.a <= r.at and r.at < areas.b group by 1, 2, 3),
 c as (select reading, worker, case k when 2 then 'inside' when 1 then 'outside' else 'unassigned' end as class, was from k) select * from c where class is distinct from was""")
def location_class(spark, d):
    c = table(spark, d, "customer")
    areas = c.where("c_custkey % 4 <> 0").selectExpr("c_custkey as worker", "c_nationkey % 5 as cell", "0 as a", "500 as b").union(c.selectExpr("c_custkey", "(c_nationkey + 2) % 5", "500", "900"))
    readings = table(spark, d, "events").selectExpr("event_id as reading", "user_id as worker", "event_id % 1000 as at", "cast(event_id % 5 as int) as cell", "if(event_id % 2 = 0, 'inside', null) as class")
    return sensors.location_class(readings, areas)


@frame("""with p as (select c_custkey, c_acctbal / 10 as x, (c_custkey % 100)::double as y from customer), j as (select a.c_custkey, b.c_custkey as other, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) as d2 from p a join p b on a.c_custkey <> b.c_custkey),
 r as (select *, row_number() over (partition by c_custkey order by d2, other)::int as rank from j) select c_custkey, rank, other, d2 from r where rank <= 3""")
def knn_3(spark, d):
    p = table(spark, d, "customer").selectExpr("c_custkey", "c_acctbal / 10 as x", "cast(c_custkey % 100 as double) as y")
    return periods.nearest(p, "c_custkey", 16.0, 3, stores.materialize)


@frame(_C + ", u as (select distinct zone_id % 3 as g, gx, gy from o) select g, count(*) as n, count(*)::double as area from u group by g")
def polygon_union_agg(spark, d):
    groups = table(spark, d, "supplier").selectExpr("s_suppkey as zone_id", "s_suppkey % 3 as g")
    return zones.union_cells(_vertices(spark, d), groups, "g", 1.0)
