"""Contacts, rules with wildcards, calendars, attendance, numbering and discovery, on events as readings and orders as shifts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendars, checks, contacts, discovery, numbering
from ..sources import stores
from .catalog import frame, table

# --- contacts -------------------------------------------------------------------------------------------------------

# workers stand in groups of ten, so that as many meet at every size
_MET = """with p as (select user_id as worker, epoch_us(ts) as t, event_id % 2 as floor, cast(ts as date) as day, (user_id // 10 * 10 + event_id % 4)::double as x, (event_id % 3)::double as y, event_id % 7 as zone, event_id % 60 as active from events),
 m as (select a.floor, a.day, a.worker, b.worker as other, b.t, a.zone, b.active, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) as distance
  from p a join p b on a.floor = b.floor and a.day = b.day and a.worker <> b.worker and abs(a.t - b.t) <= 900000000 where distance <= 2.5)
"""


def _met(spark, d):
    r = table(spark, d, "events").selectExpr("user_id", "ts", "event_id % 2 as floor", "to_date(ts) as day", "cast(user_id div 10 * 10 + event_id % 4 as double) as x", "cast(event_id % 3 as double) as y", "event_id % 7 as zone", "event_id % 60 as active")
    return contacts.pairs(r, "user_id", "ts", ["floor", "day"], 900, 2.5, "zone", "active")


@frame(_MET + "select floor, day, worker, other, t, zone, active, round(distance, 6) as distance from m")
def contacts_pairs(spark, d):
    return _met(spark, d).select("floor", "day", "worker", "other", F.unix_micros("at").alias("t"), "zone", "active", F.round("distance", 6).alias("distance"))


@frame(_MET + ", o as (select floor, day, worker, other, t, max(zone) as zone, max(active) as active, min(distance) as distance from m group by 1, 2, 3, 4, 5) select floor, day, worker, other, min(t) as first_at, max(zone) as zone, count(*) as contacts, sum(active)::bigint as duration, round(avg(distance), 6) as mean_distance from o group by 1, 2, 3, 4")
def contacts_aggregate(spark, d):
    out = contacts.aggregate(_met(spark, d), ["floor", "day"])
    return out.withColumns({"first_at": F.unix_micros("first_at"), "mean_distance": F.round("mean_distance", 6)})


# --- rules with wildcards -------------------------------------------------------------------------------------------

# a rule a customer, with a null type or day for some, and a few for all users
_RULES = "select c_custkey as rule_id, c_custkey as user_id, {kind} as event_type, {day} as dom from customer union all select -1 - r_regionkey, null, {all_kind}, {all_day} from region"


@frame("with f as (select event_id, user_id, event_type, day(ts)::int as dom from events), r as (" + _RULES.format(kind="case when c_custkey % 3 <> 0 then ['click', 'view', 'error'][(c_custkey % 3 + 1)::int] end", day="case when c_custkey % 4 = 0 then (c_custkey % 28 + 1)::int end", all_kind="case when r_regionkey % 2 = 1 then 'error' end", all_day="case when r_regionkey > 1 then (r_regionkey * 5)::int end") + """)
 select event_id, f.user_id, f.event_type, f.dom, rule_id from f join r on (r.user_id is null or r.user_id = f.user_id) and (r.event_type is null or r.event_type = f.event_type) and (r.dom is null or r.dom = f.dom)""")
def join_cross_broadcast(spark, d):
    facts = table(spark, d, "events").select("event_id", "user_id", "event_type", F.dayofmonth("ts").alias("dom"))
    own = table(spark, d, "customer").selectExpr("c_custkey as rule_id", "c_custkey as user_id", "if(c_custkey % 3 <> 0, array('click', 'view', 'error')[c_custkey % 3], null) as event_type", "if(c_custkey % 4 = 0, cast(c_custkey % 28 + 1 as int), null) as dom")
    every = table(spark, d, "region").selectExpr("cast(-1 - r_regionkey as bigint) as rule_id", "cast(null as bigint) as user_id", "if(r_regionkey % 2 = 1, 'error', null) as event_type", "if(r_regionkey > 1, r_regionkey * 5, null) as dom")
    return contacts.wildcard_join(facts, own.unionByName(every), ["user_id", "event_type", "dom"])


# --- calendars and attendance -----------------------------------------------------------------------------------------

_DETAILS = """with s as (select c_custkey as shift_id, c_name as shift from customer where c_custkey % 19 <> 0),
 k as (select c_custkey as shift_id, ((c_custkey + 2 * i) % 7 + 1)::int as weekday, null::date as date, (360 + c_custkey % 5 * 200)::int as start, (800 + c_custkey % 4 * 150)::int as "end", case when c_custkey % 2 = 0 then 30 end as rest,
   case when c_custkey % 6 = 0 then date '1996-01-20' else date '1995-06-01' end as valid_from, case when c_custkey % 4 = 0 then date '1996-02-10' end as valid_to, (c_custkey + i) % 11 = 0 as deleted from customer, range(0, 3) t(i)
  union all select o_custkey, null, cast(o_orderdate as date), case when o_orderkey % 3 > 0 then (480 + o_orderkey % 4 * 15)::int end, case when o_orderkey % 3 > 0 then (900 + o_orderkey % 5 * 15)::int end, null, null, null, o_orderkey % 17 = 0 from orders),
 h as (select k.*, s.shift, greatest(coalesce("end" - start + case when "end" < start then 1440 else 0 end - coalesce(rest, 0), 0), 0) / 60.0::double as hours from k left join s using (shift_id) where not deleted)
"""


def _details(spark, d):
    shifts = table(spark, d, "customer").where("c_custkey % 19 <> 0").selectExpr("c_custkey as shift_id", "c_name as shift")
    weekly = table(spark, d, "customer").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2)))).selectExpr(
        "c_custkey as shift_id", "cast((c_custkey + 2 * i) % 7 + 1 as int) as weekday", "cast(null as date) as date", "cast(360 + c_custkey % 5 * 200 as int) as start", "cast(800 + c_custkey % 4 * 150 as int) as end", "if(c_custkey % 2 = 0, 30, null) as rest",
        "if(c_custkey % 6 = 0, date '1996-01-20', date '1995-06-01') as valid_from", "if(c_custkey % 4 = 0, date '1996-02-10', null) as valid_to", "(c_custkey + i) % 11 = 0 as deleted",
    )
    special = table(spark, d, "orders").selectExpr("o_custkey as shift_id", "cast(null as int) as weekday", "to_date(o_orderdate) as date", "cast(if(o_orderkey % 3 > 0, 480 + o_orderkey % 4 * 15, null) as int) as start", "cast(if(o_orderkey % 3 > 0, 900 + o_orderkey % 5 * 15, null) as int) as end", "cast(null as int) as rest", "cast(null as date) as valid_from", "cast(null as date) as valid_to", "o_orderkey % 17 = 0 as deleted")
    return weekly.unionByName(special), shifts


@frame(_DETAILS + 'select \'weekday\' as view, shift_id, shift, weekday, date, start, "end", round(hours, 6) as hours from h where weekday is not null union all select \'date\', shift_id, shift, weekday, date, start, "end", round(hours, 6) from h where date is not null')
def calendar_views(spark, d):
    details, shifts = _details(spark, d)
    names = ["view", "shift_id", "shift", "weekday", "date", "start", "end", F.round("hours", 6).alias("hours")]
    one = calendars.by_weekday(details, shifts).withColumns({"view": F.lit("weekday"), "date": F.lit(None).cast("date")})
    two = calendars.by_date(details, shifts).withColumns({"view": F.lit("date"), "weekday": F.lit(None).cast("int")})
    return one.select(names).unionByName(two.select(names))


@frame(_DETAILS + """, n as (select unnest(generate_series(date '1996-01-01', date '1996-02-29', interval 1 day))::date as day),
 w as (select h.*, day, false as special from h join n on dayofweek(day) + 1 = weekday and day >= valid_from and (valid_to is null or day < valid_to)
  union all select h.*, date, true from h where date between date '1996-01-01' and date '1996-02-29'),
 r as (select *, row_number() over (partition by shift_id, day order by special desc, start nulls last, "end" nulls last) as n from w)
 select shift_id, shift, day, start, "end", round(hours, 6) as hours, special from r where n = 1""")
def calendar_days(spark, d):
    return calendars.days(*_details(spark, d), "1996-01-01", "1996-02-29").withColumn("hours", F.round("hours", 6))


@frame("""with w as (select event_id, user_id, ts, ts + interval 1 minute * (15 * (event_id % 24)) as until, (event_id % 24) * 0.25::double as h, cast(ts as date) as day, date_trunc('week', ts) as week from events),
 a as (select *, greatest(least(h, 8 - coalesce(sum(h) over (partition by user_id, day order by ts, event_id rows between unbounded preceding and 1 preceding), 0)), 0) as d from w),
 b as (select *, greatest(least(d, 40 - coalesce(sum(d) over (partition by user_id, week order by ts, event_id rows between unbounded preceding and 1 preceding), 0)), 0) as r from a)
 select user_id, day, epoch_us(min(ts)) as first_start, epoch_us(max(until)) as last_end, count(*) as entries, round(sum(r), 6) as regular, round(sum(h - r), 6) as overtime from b group by 1, 2""")
def calc_attendance(spark, d):
    worked = table(spark, d, "events").selectExpr("event_id", "user_id", "cast(ts as timestamp) as ts", "cast(ts as timestamp) + make_dt_interval(0, 0, 15 * (event_id % 24)) as until")
    out = calendars.attendance(worked, "user_id", "ts", "until", ["event_id"])
    return out.withColumns({"first_start": F.unix_micros("first_start"), "last_end": F.unix_micros("last_end"), "regular": F.round("regular", 6), "overtime": F.round("overtime", 6)})


# --- numbering and discovery ------------------------------------------------------------------------------------------


@frame("with v as (select distinct nullif(l_partkey % 1000, 7) as part, l_shipdate as day from lineitem) select part, epoch_us(day) as day, row_number() over (order by part nulls first, day nulls first) as id from v")
def surrogate_keys(spark, d):
    values = table(spark, d, "lineitem").select(F.expr("nullif(l_partkey % 1000, 7)").alias("part"), F.col("l_shipdate").cast("timestamp").alias("day"))
    return numbering.surrogate_keys(values, ["part", "day"], "id", stores.materialize).withColumn("day", F.unix_micros("day"))


_NAMED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "events": ["event_id", "ts", "user_id", "event_type", "props"],
}
_MEASURES = {"lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "orders": ["o_totalprice"], "customer": ["c_acctbal"], "events": ["value"]}
_MARKS = {"lineitem": "l_shipdate", "orders": "o_orderdate", "customer": "c_custkey", "events": "ts"}


def _discovery_twin() -> str:
    """Every set of up to three columns counted exactly; the first that is a key is the table's."""
    from itertools import combinations

    out = []
    for t, columns in _NAMED.items():
        sets = [(n, at, c) for n in (1, 2, 3) for at, c in enumerate(combinations(columns, n))]
        tried = " union all ".join(f"select {n} as size, {at} as nth, {list(c)!r} as cols from {t} having count(distinct ({', '.join(c)})) = count(*) and count(*) > 0" for n, at, c in sets)
        stats = " union all ".join(f"select '{t}' as table_name, '{c}' as column_name, count(*) as n, count(*) - count({c}) as nulls, {'true' if c == _MARKS[t] else 'false'} as is_watermark from {t}" for c in [*columns, *_MEASURES[t]])
        out.append(f"select s.table_name, s.column_name, s.n, s.nulls, coalesce(list_contains((select cols from ({tried}) order by size, nth limit 1), s.column_name), false) as in_key, s.is_watermark from ({stats}) s")
    return " union all ".join(out)


@frame(_discovery_twin())
def table_stats(spark, d):
    return discovery.discover({t: table(spark, d, t) for t in _NAMED}).select("table_name", "column_name", "n", "nulls", "in_key", "is_watermark")


# --- inserts and expectations -----------------------------------------------------------------------------------------


@frame("select o_orderkey, o_orderstatus, year(o_orderdate)::int as y from orders where year(o_orderdate) not in (1996, 1997) union all select o_orderkey, 'R', year(o_orderdate)::int from orders where year(o_orderdate) in (1996, 1997) and o_orderkey % 2 = 0")
def insert_overwrite(spark, d):
    """Two years' partitions are replaced by a batch; the others' files stay."""
    path = stores.scratch(spark, "t")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    stores.write_overwrite(o.hint("rebalance", "y"), path, ("y",))
    stores.overwrite_partitions(o.where("y in (1996, 1997) and o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("R")), path, ("y",))
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "y")


@frame("select o_orderkey, year(o_orderdate)::int as y from orders union all select o_orderkey + 1000000, year(o_orderdate)::int from orders where o_orderkey % 5 = 0")
def insert_append(spark, d):
    path = stores.scratch(spark, "t")
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    stores.write_append(o, path, ("y",))
    stores.write_append(o.where("o_orderkey % 5 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000), path, ("y",))
    return spark.read.parquet(path).select("o_orderkey", "y")


@frame("select o_orderpriority, count(*) as n, sum(o_custkey)::bigint as total from orders group by 1")
def ctas(spark, d):
    return stores.create_as(table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("total")), stores.scratch(spark, "t"))


@frame("""select 'low' as rule, count(*) as n, count(*) filter (where not coalesce(nullif(o_totalprice, 0) > 50000, false)) as failures from orders
 union all select 'status', count(*), count(*) filter (where not coalesce(nullif(o_orderstatus, 'P') in ('O', 'F'), false)) from orders union all select 'key', count(*), count(*) filter (where o_orderkey is null) from orders""")
def expect_warn(spark, d):
    """Rules counted while the rows are written; all rows are."""
    o = table(spark, d, "orders").withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    rows, counts = checks.expect_warn(o, {"low": "o_totalprice > 50000", "status": "o_orderstatus in ('O', 'F')", "key": "o_orderkey is not null"}, stores.materialize)
    return counts.crossJoin(rows.agg(F.count(F.lit(1)).alias("n"))).select("rule", "n", "failures")
