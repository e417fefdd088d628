"""Composed facts, dimensions and snapshots: events as readings, customers as workers, nations as crews, suppliers as zones."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import histories, periods, sensors, tables, zones
from ..sources import stores
from .catalog import event_seconds, frame, table
from .sensors import _MISSED
from .zones import _TREE, _V, _points, _vertices, hierarchy_temporal

_PART = "case when hour(ts) < 6 then 'night' when hour(ts) < 12 then 'morning' when hour(ts) < 18 then 'afternoon' else 'evening' end"
_ZONED = _V + ", zoned as (select p.event_id, min(h.zone_id) as zone_id from p left join h on h.event_id = p.event_id group by 1)"


def _shifts(spark, d):
    """Readings with what they missed, folded into shifts: a gap over five hours begins one."""
    e = sensors.missed_readings(event_seconds(spark, d), ["user_id"], "event_id", "at", F.col("event_type") != "error")
    errors = F.count_if(F.col("event_type") == "error").alias("errors")
    return periods.sessions(e, ["user_id"], "at", 18000, F.sum("missed").alias("missed"), errors)


_SHIFTS = _MISSED + """, s as (select *, case when "at" - lag("at") over (partition by user_id order by "at") <= 18000 then 0 else 1 end as fresh from q), t as (select *, sum(fresh) over (partition by user_id order by "at" range unbounded preceding)::bigint as session from s),
 u as (select user_id, session, min("at") as first_at, max("at") as last_at, count(*) as n, sum(missed)::bigint as missed, count(*) filter (where event_type = 'error') as errors from t group by 1, 2) """


@frame(_SHIFTS + "select * from u")
def fact_workers_shifts(spark, d):
    return _shifts(spark, d)


@frame(_SHIFTS + """, mm as (select *, case when first_at - lag(last_at) over w <= 36000 and last_at - lag(first_at) over w <= 72000 then 0 else 1 end as fresh from u window w as (partition by user_id order by first_at)),
 gg as (select *, sum(fresh) over (partition by user_id order by first_at rows unbounded preceding) as no from mm) select user_id, min(first_at) as first_at, max(last_at) as last_at, count(*) as shifts, sum(n)::bigint as n, sum(missed)::bigint as missed from gg group by user_id, no""")
def fact_workers_shifts_combined(spark, d):
    """Neighbouring shifts at most ten hours apart that span at most twenty are one."""
    w = Window.partitionBy("user_id").orderBy("first_at")
    near = (F.col("first_at") - F.lag("last_at").over(w) <= 36000) & (F.col("last_at") - F.lag("first_at").over(w) <= 72000)
    run = F.sum(F.when(near, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    s = _shifts(spark, d).withColumn("no", run)
    return s.groupBy("user_id", "no").agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.count(F.lit(1)).alias("shifts"), F.sum("n").alias("n"), F.sum("missed").alias("missed")).drop("no")


@frame(_ZONED + "select e.event_id, user_id, cast(ts as date) as day, zone_id from events e join zoned on zoned.event_id = e.event_id")
def fact_device_location_zone(spark, d):
    zoned = zones.assign(_points(spark, d), _vertices(spark, d), "event_id", 10.0)
    return table(spark, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day")).join(zoned, "event_id")


@frame(_ZONED + f""", c as (select c_custkey, c_nationkey as crew from customer where c_custkey % 13 <> 0)
 select e.event_id, cast(ts as date) as day, hour(ts)::int as hour, {_PART} as part, case when user_id % 11 = 0 then 'none' when hour(ts) < user_id % 12 then 'before' when hour(ts) > user_id % 12 + 9 then 'after' when hour(ts) between user_id % 12 + 4 and user_id % 12 + 5 then 'break' else 'during' end as category,
 crew, n_name as crew_name, zone_id, case when c_custkey is null then 'user_id' else '' end as stalled from events e join zoned on zoned.event_id = e.event_id left join c on c_custkey = e.user_id left join nation on n_nationkey = crew""")
def fact_workers_history(spark, d):
    """Readings with time fields, part of the day, shift category, crew, zone, and what they wait for."""
    e = table(spark, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
    start = F.expr("if(user_id % 11 = 0, null, user_id % 12)") * 60
    breaks = F.array(F.struct((start + 240).alias("from"), (start + 300).alias("to")))
    category = sensors.time_category(F.col("hour") * 60, start, start + 540, breaks)
    e = e.withColumns({"part": sensors.hour_category(F.col("hour")), "category": category})
    crews = table(spark, d, "customer").where("c_custkey % 13 <> 0").selectExpr("c_custkey as user_id", "c_nationkey as crew")
    named = table(spark, d, "nation").selectExpr("n_nationkey as crew", "n_name as crew_name")
    out = tables.enrich(e, [(crews, "user_id", ["crew"]), (named, "crew", ["crew_name"])])
    zoned = zones.assign(_points(spark, d), _vertices(spark, d), "event_id", 10.0)
    return out.join(zoned, "event_id").select("event_id", "day", "hour", "part", "category", "crew", "crew_name", "zone_id", F.concat_ws(",", "stalled").alias("stalled"))


# devices change hands on the day of the month that their number says; every ninth lies idle until then
_MONTH = 1704067200
_HANDS = f"""select c_custkey * 10 + 1 as device, c_custkey as worker, {_MONTH} as since, {_MONTH} + 86400 * (1 + c_custkey % 20) as until from customer where c_custkey % 9 <> 0
 union all select c_custkey * 10 + 1, c_custkey + 1, {_MONTH} + 86400 * (1 + c_custkey % 20), null from customer"""


@frame(_SHIFTS + f""", hands as ({_HANDS}), x as (select event_id, user_id * 10 + 1 as device, ts, event_type, value from events), y as (select event_id, (epoch_us(ts) // 1000000)::bigint as "at" from events),
 r as (select x.event_id, x.device, x.ts, x.event_type, x.value, y."at", hands.worker from x join y using (event_id) left join hands on hands.device = x.device and y."at" >= since and (until is null or y."at" < until)),
 g as (select r.*, u.session as shift, u.first_at as shift_at from r left join u on u.user_id = r.worker and r."at" between u.first_at and u.last_at),
 zoned as (select r.event_id, min(h.zone_id) as zone_id from r left join ({_V} select * from h) h on h.event_id = r.event_id group by 1),
 n as (select g.event_id, device, worker, c_nationkey as crew, shift, make_timestamp(coalesce(shift_at, "at") * 1000000)::date as shift_day, zone_id,
  case when event_type <> 'error' then value / 86400 else 0 end as active_days, case when event_type = 'error' then value / 86400 else 0 end as idle_days from g join zoned on zoned.event_id = g.event_id left join customer on c_custkey = worker)
 select n.*, case when event_id % 4 <> 0 then 'inserted' when event_id % 8 = 0 then 'unchanged' else 'updated' end as action from n where event_id % 5 <> 0
 union all select event_id, user_id * 10 + 1, null, null, null, ts::date, null, null, null, 'kept' from events where event_id % 5 = 0""")
def history_enhanced(spark, d):
    """Readings with the worker who holds the device, crew, zone and shift, merged into what was enriched before."""
    e = event_seconds(spark, d).withColumn("device", F.col("user_id") * 10 + 1)
    c = table(spark, d, "customer")
    change = F.lit(_MONTH) + (F.col("c_custkey") % 20 + 1) * 86400
    device, none = (F.col("c_custkey") * 10 + 1).alias("device"), F.lit(None).cast("bigint")
    hands = c.where("c_custkey % 9 <> 0").select(device, F.col("c_custkey").alias("worker"), F.lit(_MONTH).cast("bigint").alias("since"), change.alias("until"))
    hands = hands.unionByName(c.select(device, (F.col("c_custkey") + 1).alias("worker"), change.alias("since"), none.alias("until")))
    held = histories.covering(e, hands, ["event_id"], ["device"], "at", "since", "until", 86400, ["worker"])
    # a shift holds its last reading too
    shifts = _shifts(spark, d).selectExpr("user_id as worker", "first_at as shift_at", "last_at + 1 as upto", "session as shift")
    held = histories.covering(held, shifts.withColumn("shift_from", F.col("shift_at")), ["event_id"], ["worker"], "at", "shift_at", "upto", 86400, ["shift", "shift_from"])
    crews = histories.Lookup(c.selectExpr("c_custkey", "c_nationkey as crew"), "worker", "c_custkey", ("crew",))
    rich = histories.named(held, [crews]).join(zones.assign(_points(spark, d), _vertices(spark, d), "event_id", 10.0), "event_id")
    busy = F.col("event_type") != "error"
    days = F.col("value") / 86400
    rich = rich.select("event_id", "device", "worker", "crew", "shift", F.to_date(F.timestamp_seconds(F.coalesce("shift_from", "at"))).alias("shift_day"), "zone_id", F.when(busy, days).otherwise(0.0).alias("active_days"), F.when(~busy, days).otherwise(0.0).alias("idle_days"))
    rich = stores.materialize(rich)
    null = {x: F.lit(None).cast(rich.schema[x].dataType) for x in ("worker", "crew", "shift", "zone_id", "active_days", "idle_days")}
    poor = e.where("event_id % 5 = 0 or event_id % 8 = 4").select("event_id", "device", F.to_date(F.timestamp_seconds("at")).alias("shift_day")).withColumns(null)
    before = poor.unionByName(rich.where("event_id % 8 = 0 and event_id % 5 <> 0"))
    return tables.merge(before.select(*rich.columns), rich.where("event_id % 5 <> 0"), ["event_id"])


# pairs only within a bounded place: fifty readings that follow each other
_CONTACTS = "with e as (select event_id, user_id, event_id // 50 as place, event_id % 50 as at, value from events)"


@frame(_CONTACTS + " select a.user_id as worker, b.user_id as other, min(least(a.at, b.at)) as first_at, count(*) as contacts, max(greatest(a.at, b.at)) - min(least(a.at, b.at)) as duration, sum(round(abs(a.value - b.value) * 100)::bigint)::double / count(*) / 100 as mean_distance from e a join e b on a.place = b.place and abs(a.at - b.at) <= 5 and a.user_id < b.user_id where abs(a.value - b.value) <= 100 group by 1, 2")
def fact_workers_contacts(spark, d):
    e = table(spark, d, "events").selectExpr("user_id", "event_id div 50 as place", "event_id % 50 as at", "value")
    pairs = periods.band_join(e, e, ["place"], "at", "at", 5).where("a.user_id < b.user_id and abs(a.value - b.value) <= 100")
    first, last = F.min(F.least("a.at", "b.at")), F.max(F.greatest("a.at", "b.at"))
    # hundredths are summed as whole numbers, so that the mean does not hang on the order of rows
    mean = F.sum(F.round(F.abs(F.col("a.value") - F.col("b.value")) * 100).cast("long")).cast("double") / F.count(F.lit(1)) / 100
    return pairs.groupBy(F.col("a.user_id").alias("worker"), F.col("b.user_id").alias("other")).agg(first.alias("first_at"), F.count(F.lit(1)).alias("contacts"), (last - first).alias("duration"), mean.alias("mean_distance"))


@frame("""select 'organization' as dim, r_regionkey::bigint as id, r_name as name, null::bigint as parent from region union all select 'project', n_nationkey, n_name, n_regionkey from nation
 union all select 'worker', case when c_custkey % 7 = 0 then c_custkey + 1000000000 else c_custkey end, c_name, c_nationkey from customer where c_acctbal > 0""")
def silver_dims(spark, d):
    """Organizations, projects and workers in one form; a worker must have a balance, and only the latest row of a name stays."""
    org = table(spark, d, "region").selectExpr("'organization' as dim", "cast(r_regionkey as bigint) as id", "r_name as name", "cast(null as bigint) as parent")
    project = table(spark, d, "nation").selectExpr("'project' as dim", "cast(n_nationkey as bigint) as id", "n_name as name", "cast(n_regionkey as bigint) as parent")
    c = table(spark, d, "customer")
    again = c.where("c_custkey % 7 = 0").withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000)  # entered anew later
    worker = tables.expect(c.unionByName(again), {"balance": "c_acctbal > 0"}).where("size(failed) = 0")
    worker = worker.selectExpr("'worker' as dim", "c_custkey as id", "c_name as name", "cast(c_nationkey as bigint) as parent")
    latest = worker.groupBy("dim", "name").agg(F.max_by(F.struct("id", "parent"), "id").alias("r")).select("dim", "r.id", "name", "r.parent")
    return org.unionByName(project).unionByName(latest)


@frame("""select event_id, n_name as crew, case when n_name is null then 'stalled' else 'ready' end as state, case when event_id % 3 = 0 then case when n_name is null then 'unchanged' else 'updated' end else 'inserted' end as action
 from events left join customer on c_custkey = user_id and c_custkey % 5 <> 0 left join nation on n_nationkey = c_nationkey""")
def fact_observations_sync(spark, d):
    """Observations with their dimensions; those that stalled before are tried again and merged."""
    e = table(spark, d, "events").select("event_id", "user_id")
    workers = table(spark, d, "customer").where("c_custkey % 5 <> 0").selectExpr("c_custkey as user_id", "c_nationkey")
    crews = table(spark, d, "nation").selectExpr("n_nationkey as c_nationkey", "n_name as crew")
    now = tables.enrich(e, [(workers, "user_id", ["c_nationkey"]), (crews, "c_nationkey", ["crew"])])
    now = now.select("event_id", "crew", F.when(F.size("stalled") > 0, "stalled").otherwise("ready").alias("state"))
    before = e.where("event_id % 3 = 0").select("event_id", F.lit(None).cast("string").alias("crew"), F.lit("stalled").alias("state"))
    return tables.merge(before, now, ["event_id"])


_UP = range(1, 13)
_SLICED = _TREE + f""", x as (select distinct child, unnest([a, b]) as t from h), n as (select child, t as a, lead(t) over (partition by child order by t) as b from x), sl as (select * from n where b is not null),
 wide as (select s.child, s.a, s.b, coalesce(max(h.level), 0) as levels, s.child as level_0, {", ".join(f"max(case when h.level = {n} then h.ancestor end) as level_{n}" for n in _UP)} from sl s left join h on h.child = s.child and h.a <= s.a and h.b >= s.b group by 1, 2, 3) """


@frame(_SLICED + "select * from wide")
def hierarchy_levels_by_slice(spark, d):
    """Managers of levels 0 to 12 in every slice of time in which none of them changes."""
    return histories.levels_by_slice(stores.materialize(hierarchy_temporal(spark, d)), "child", "ancestor", "a", "b", "level")


# the snapshot before: two slices a worker, of which one may begin where a new one does
_OLD = "select c_custkey as child, {at} as a, {at} + 60 as b, 1 as levels, c_custkey as level_0, c_custkey {div} 4 as level_1, " + ", ".join(f"cast(null as bigint) as level_{n}" for n in _UP[1:])
_OLD_SQL = " union all ".join(f"{_OLD.format(at=at, div='//')} from customer" for at in ("c_custkey % 50", "-1 - c_custkey % 2"))


@frame(_SLICED + f""", old as ({_OLD_SQL}), made as (select * from wide where child % 3 <> 0)
 select made.*, case when old.child is null then 'inserted' when {" or ".join(f"made.{c} is distinct from old.{c}" for c in ("b", "levels", *(f"level_{n}" for n in _UP)))} then 'updated' else 'unchanged' end as action from made left join old on old.child = made.child and old.a = made.a
 union all select *, 'kept' from old where child % 3 = 0""")
def manager_snapshots(spark, d):
    """Managers of each level by slice of time, merged into the snapshot before in the workers that a run touches."""
    c = table(spark, d, "customer")
    old = None
    for at in ("c_custkey % 50", "-1 - c_custkey % 2"):
        one = c.selectExpr(*[x.replace(" //", " div") for x in _OLD.format(at=at, div="div").removeprefix("select ").split(", ")])
        old = one if old is None else old.unionByName(one)
    touched = c.where("c_custkey % 3 <> 0").selectExpr("c_custkey as child")
    return histories.merge_snapshots(old, hierarchy_levels_by_slice(spark, d), ["child", "a"], touched, ["child"])


_CUSTOMERS = "select c_custkey, c_nationkey from customer where c_custkey % 13 <> 0"
_RUN = f"""with rows as (select event_id, user_id, case when event_id % 4 <> 0 then event_id % 30 end as place, value, false as waited from events where event_id % 3 <> 0
  union all select event_id, user_id, case when event_id % 4 <> 0 then event_id % 30 end, value, true from events where event_id % 3 = 0),
 j as (select r.*, c.c_nationkey as crew, c.c_custkey is null as lost_user, n.n_name as crew_name, n.n_name is null and r.place is not null as lost_place from rows r left join ({_CUSTOMERS}) c on c.c_custkey = r.user_id left join nation n on n.n_nationkey = r.place) """


@frame(_RUN + "select event_id, user_id, place, value, crew, crew_name as place_name, waited, case when waited and not coalesce(value < 100, false) then 'retry' else concat_ws(',', case when lost_user then 'user_id' end, case when lost_place then 'place' end) end as missed from j")
def fact_workers_history_recovery(spark, d):
    """A run of the history: fresh readings, and a third that waited, of which those below a bound are tried again."""
    e = table(spark, d, "events").selectExpr("event_id", "user_id", "if(event_id % 4 <> 0, event_id % 30, null) as place", "value")
    fresh, waiting = e.where("event_id % 3 <> 0"), e.where("event_id % 3 = 0 or event_id % 6 = 1")  # a sixth comes again
    workers = table(spark, d, "customer").where("c_custkey % 13 <> 0").selectExpr("c_custkey", "c_nationkey as crew")
    places = table(spark, d, "nation").selectExpr("cast(n_nationkey as bigint) as n_nationkey", "n_name as place_name")
    out = histories.load(fresh, waiting, ["event_id"], [histories.Lookup(workers, "user_id", "c_custkey", ("crew",)), histories.Lookup(places, "place", "n_nationkey", ("place_name",), False)], F.col("value") < 100)
    return out.withColumn("missed", F.concat_ws(",", "missed"))


_PLACES = """with own as (select c_custkey as worker, s_suppkey as place, (c_custkey % 50)::int as a, (c_custkey % 50 + 40)::int as b from customer join supplier on s_suppkey = c_custkey % 7 where c_custkey % 3 = 0),
 crew as (select c_custkey as worker, (c_nationkey % 7)::bigint as place, 30 as a, 60 as b from customer), u as (select * from own union all select * from crew),
 m as (select *, case when a <= max(b) over (partition by worker, place order by a, b rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh from u), g as (select *, sum(fresh) over (partition by worker, place order by a, b rows unbounded preceding) as no from m) """


@frame(_PLACES + "select worker, place, min(a)::int as a, max(b)::int as b from g group by worker, place, no")
def worker_location_assignments(spark, d):
    """Places of workers from their own rules and their crew's, consolidated, and written over what the touched workers had."""
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier").selectExpr("s_suppkey as place")
    own = c.where("c_custkey % 3 = 0").selectExpr("c_custkey as worker", "c_custkey % 7 as place", "cast(c_custkey % 50 as int) as a", "cast(c_custkey % 50 + 40 as int) as b").join(s, "place", "left_semi")
    crew = c.selectExpr("c_custkey as worker", "cast(c_nationkey % 7 as bigint) as place", "30 as a", "60 as b")
    new = periods.islands(own.unionByName(crew), ["worker", "place"], "a", "b").drop("n")
    old = c.selectExpr("c_custkey as worker", "cast(99 as bigint) as place", "0 as a", "1 as b")
    return tables.two_phase(old, new, ["worker", "place", "a"], "worker").drop("action")


_KINDS = [("crew", "c_nationkey"), ("device", "c_custkey * 10 + 1"), ("trade", "c_mktsegment"), ("workshift", "c_custkey % 3"), ("location_group", "c_nationkey % 5"), ("manager", "c_custkey div 4")]


@frame(" union all ".join(f"select c_custkey as worker, '{k}' as kind, ({v.replace(' div ', ' // ')})::varchar as value, c_custkey % {10 + i} as valid_from from customer where c_custkey % {10 + i} <= 5 and (c_custkey % 4 = 0 or c_custkey % {10 + i} + 4 > 5)" for i, (k, v) in enumerate(_KINDS)))
def calc_assignments(spark, d):
    """Assignments of six kinds in force at one time."""
    c, out = table(spark, d, "customer"), None
    for i, (kind, value) in enumerate(_KINDS):
        start = F.col("c_custkey") % (10 + i)
        one = tables.assignments(c, F.col("c_custkey"), kind, F.expr(value), start, F.when(F.col("c_custkey") % 4 != 0, start + 4), 5)
        out = one if out is None else out.unionByName(one)
    return out


@frame(" union all ".join(f"select c_custkey as worker, '{k}' as kind, ({v.replace(' div ', ' // ')})::varchar as value from customer where c_custkey % {10 + i} <= 5 and (c_custkey % 4 = 0 or c_custkey % {10 + i} + 4 > 5)" for i, (k, v) in enumerate(_KINDS)).join(("with k as (", ") select c_custkey, " + ", ".join(f"max(case when kind = '{k}' then value end) as {k}" for k, _ in _KINDS) + " from customer left join k on worker = c_custkey group by 1")))
def assignment_summary(spark, d):
    """Every worker with all assignments in force side by side."""
    a = calc_assignments(spark, d)
    wide = a.groupBy("worker").agg(*[F.max(F.when(F.col("kind") == k, F.col("value"))).alias(k) for k, _ in _KINDS])
    c = table(spark, d, "customer").select("c_custkey")
    return c.join(wide, c["c_custkey"] == wide["worker"], "left").drop("worker")


@frame("""with n as (select event_id, user_id as station, round(value, 1) as value from events where event_id is not null and user_id is not null), o as (select event_id, user_id as station, case when event_id % 3 = 0 then value + 0.01 when event_id % 3 = 1 then value + 5 end as value from events where event_id % 3 <> 2)
 select n.event_id, n.station, case when o.event_id is null then 'inserted' when abs(o.value - n.value) > 0.5 or (o.value is null) <> (n.value is null) then 'updated' else 'unchanged' end as action from n left join o on o.event_id = n.event_id and o.station = n.station""")
def fact_weather(spark, d):
    """Typed readings of a station, merged by key into the table where they differ by more than a tolerance."""
    new = table(spark, d, "events").where("event_id is not null and user_id is not null").selectExpr("event_id", "cast(user_id as bigint) as station", "round(value, 1) as value")
    old = table(spark, d, "events").where("event_id % 3 <> 2").selectExpr("event_id", "user_id as station", "case when event_id % 3 = 0 then value + 0.01 else value + 5 end as value")
    return tables.merge(old, new, ["event_id", "station"], tables.moved({"value": 0.5})).select("event_id", "station", "action")


@frame("""with u as (select o_custkey as k, o_orderkey % 50 as id, o_totalprice as hours, 0 as src from orders where o_orderstatus = 'F' union all select o_custkey, o_orderkey % 50, o_totalprice, 1 from orders where o_orderstatus <> 'F'),
 r as (select *, row_number() over (partition by k, id order by src, hours) as rn from u), n as (select k, id, hours, src from r where rn = 1)
 select k, id, src, case when k % 2 = 1 then 'inserted' when id % 2 = 0 then 'updated' else 'unchanged' end as action from n""")
def fact_progress(spark, d):
    """Approved hours before timesheets, one row a key, merged where they moved by more than a tolerance."""
    o = table(spark, d, "orders").selectExpr("o_custkey as k", "o_orderkey % 50 as id", "o_totalprice as hours", "if(o_orderstatus = 'F', 0, 1) as src")
    w = Window.partitionBy("k", "id").orderBy("src", "hours")
    new = o.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    old = new.where("k % 2 = 0").withColumn("hours", F.col("hours") + F.when(F.col("id") % 2 == 0, 3.0).otherwise(0.25))
    return tables.merge(old, new, ["k", "id"], tables.moved({"hours": 1.0})).select("k", "id", "src", "action")


@frame("""select t.c_custkey, t.c_acctbal + case when s.k is not null then s.bonus else 0 end as c_acctbal, s.k is not null as changed from customer t left join (select o_custkey as k, count(*)::double as bonus from orders where o_orderstatus = 'F' group by 1) s on s.k = t.c_custkey""")
def update_from(spark, d):
    """New snapshot of a table whose matched rows take values computed from another."""
    t = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    s = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("double").alias("bonus"))
    new = t.join(s, "c_custkey").select("c_custkey", (F.col("c_acctbal") + F.col("bonus")).alias("c_acctbal"))
    out = tables.merge(t, new, ["c_custkey"], F.lit(True))
    return out.select("c_custkey", "c_acctbal", (F.col("action") == "updated").alias("changed"))


@frame("select user_id, event_type, event_id as start_at, end_at from (select *, lead(event_id) over (partition by user_id order by event_id) as end_at from (select *, lag(event_type) over (partition by user_id order by event_id) as p from events) where event_type is distinct from p) where event_type <> 'error'")
def scd2_late_arrival(spark, d):
    """Versions after a first batch and a late one of older changes: the late ones take their place in order."""
    from ..streaming import feeds

    step = feeds.scd2_step(["user_id"], "event_id", ["event_type"], F.col("event_type") == "error")
    e = table(spark, d, "events")
    first = stores.materialize(step(None, e.where("event_id % 3 <> 0"), None)[0])
    both, _ = step(first, e.where("event_id % 3 = 0"), None)
    return feeds.versions(both, ["user_id"], "event_id", ["event_type"])


@frame("select c_custkey, s_name as helper, null::varchar as phone from customer left join supplier on s_suppkey = c_custkey")
def join_optional_source(spark, d):
    """Customers with what two further sources say of them: one that is there but lacks a column, and one that is not."""
    helpers = stores.optional(spark, f"{d}/supplier.parquet", "s_suppkey long, s_name string, s_fax string").selectExpr("s_suppkey as c_custkey", "s_name as helper")
    phones = stores.optional(spark, f"{d}/no_such_table.parquet", "c_custkey long, phone string")
    return table(spark, d, "customer").select("c_custkey").join(helpers, "c_custkey", "left").join(phones, "c_custkey", "left")
