"""Views of dimensions, assignments and shifts, and a dimension loaded under shared source ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import histories, periods, tables
from .catalog import frame, table
from .gold import _SHIFTS, _shifts

_ASSIGNED = """with a as (select o_custkey as worker, o_orderkey as k, o_orderdate::date as valid_from, case when o_orderkey % 7 = 0 then o_orderdate::date + 30 end as valid_to, o_orderpriority as trade from orders where o_orderkey % 17 <> 0),
 u as (select 'crew' as kind, (k % 25)::varchar as value, worker, valid_from, valid_to, k from a union all select 'trade', trade, worker, valid_from, valid_to, k from a union all select 'workshift', (k % 3)::varchar, worker, valid_from, valid_to, k from a
  union all select 'location_group', (k % 5)::varchar, worker, valid_from, valid_to, k from a union all select 'manager', (k % 8)::varchar, worker, valid_from, valid_to, k from a),
 o as (select * from u qualify row_number() over (partition by kind, worker, valid_from order by k desc) = 1),
 c as (select kind, worker, value, valid_from, coalesce(valid_to, lead(valid_from) over (partition by kind, worker order by valid_from))::date as valid_to from o),
 names as (select 'crew' as kind, n_nationkey::varchar as value, n_name as name from nation union all select 'location_group', r_regionkey::varchar, r_name from region union all select 'manager', s_suppkey::varchar, s_name from supplier)
"""


@frame(_ASSIGNED + "select c.kind, c.worker, c_name as worker_name, c.value, names.name, c.valid_from, c.valid_to, c.valid_to is null as current, datediff('day', c.valid_from, c.valid_to)::int as days from c left join names using (kind, value) left join customer on c_custkey = c.worker")
def gold_assignment_views(spark, d):
    """Assignments of crew, trade, workshift, location group and manager with names, each closed by the next."""
    o = table(spark, d, "orders").where("o_orderkey % 17 <> 0")
    kinds = {"crew": "cast(o_orderkey % 25 as string)", "trade": "o_orderpriority", "workshift": "cast(o_orderkey % 3 as string)", "location_group": "cast(o_orderkey % 5 as string)", "manager": "cast(o_orderkey % 8 as string)"}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.expr(v).alias("value")) for k, v in kinds.items()]))
    rows = o.select(F.col("o_custkey").alias("worker"), "o_orderkey", F.to_date("o_orderdate").alias("valid_from"), F.expr("if(o_orderkey % 7 = 0, date_add(to_date(o_orderdate), 30), null)").alias("valid_to"), each.alias("x"))
    rows = rows.select("x.kind", "x.value", "worker", "valid_from", "valid_to", "o_orderkey")
    closed = histories.close_periods(rows, ["kind", "worker"], "valid_from", "valid_to", ["o_orderkey"]).withColumn("at", F.concat_ws(":", "kind", "value"))
    names = table(spark, d, "nation").selectExpr("concat('crew:', n_nationkey) as key", "n_name as name")
    names = names.union(table(spark, d, "region").selectExpr("concat('location_group:', r_regionkey)", "r_name")).union(table(spark, d, "supplier").selectExpr("concat('manager:', s_suppkey)", "s_name"))
    workers = table(spark, d, "customer").selectExpr("c_custkey", "c_name as worker_name")
    out = histories.named(closed, [histories.Lookup(names, "at", "key", ("name",)), histories.Lookup(workers, "worker", "c_custkey", ("worker_name",))])
    return out.drop("at", "o_orderkey")


_ENTITIES = """with v as (select 'worker' as view, c_custkey as id, c_name as name, c_nationkey::bigint as parent, c_custkey % 5 as "at" from customer union all select 'worker', c_custkey, c_name || ' II', (c_nationkey + 1)::bigint, 2 from customer
  union all select 'crew', n_nationkey, n_name, n_regionkey, 0 from nation union all select 'crew', n_nationkey, n_name, (n_regionkey + 1), 1 from nation where n_nationkey % 2 = 0
  union all select 'zone', s_suppkey, s_name, s_nationkey, s_suppkey % 3 from supplier union all select 'zone', s_suppkey, null, s_nationkey, 1 from supplier),
 l as (select * from v qualify row_number() over (partition by view, id order by "at" desc, name desc nulls last) = 1),
 p as (select 'worker' as view, n_nationkey::bigint as parent, n_name as parent_name from nation union all select 'zone', n_nationkey, n_name from nation union all select 'crew', r_regionkey, r_name from region)
"""


@frame(_ENTITIES + "select l.view, l.id, l.name, l.parent, p.parent_name, l.\"at\" from l left join p on p.view = l.view and p.parent = l.parent")
def gold_entity_views(spark, d):
    """The last row of each worker, crew and zone with the name of what it belongs to."""
    c, n, s = (table(spark, d, t) for t in ("customer", "nation", "supplier"))
    of = lambda df, view, *x: df.selectExpr(f"'{view}' as view", *[f"cast({e} as {k}) as {a}" for e, (a, k) in zip(x, (("id", "bigint"), ("name", "string"), ("parent", "bigint"), ("at", "bigint")))])
    parts = [of(c, "worker", "c_custkey", "c_name", "c_nationkey", "c_custkey % 5"), of(c, "worker", "c_custkey", "concat(c_name, ' II')", "c_nationkey + 1", "2"), of(n, "crew", "n_nationkey", "n_name", "n_regionkey", "0"), of(n.where("n_nationkey % 2 = 0"), "crew", "n_nationkey", "n_name", "n_regionkey + 1", "1"), of(s, "zone", "s_suppkey", "s_name", "s_nationkey", "s_suppkey % 3"), of(s, "zone", "s_suppkey", "null", "s_nationkey", "1")]
    rows = parts[0]
    for x in parts[1:]:
        rows = rows.unionByName(x)
    last = histories.latest(rows, ["view", "id"], ["at"]).withColumn("key", F.concat_ws(":", "view", "parent"))
    names = n.selectExpr("explode(array('worker', 'zone')) as view", "n_nationkey", "n_name").selectExpr("concat(view, ':', n_nationkey) as of", "n_name as parent_name").union(table(spark, d, "region").selectExpr("concat('crew:', r_regionkey)", "r_name"))
    return histories.named(last, [histories.Lookup(names, "key", "of", ("parent_name",))]).drop("key")


@frame(_SHIFTS + """select u.user_id, u.session, c_name as worker, n_name as crew, first_at, last_at, (last_at - first_at)::double / 3600 as hours, missed::double / (n + missed) as lost from u left join customer on c_custkey = u.user_id left join nation on n_nationkey = c_nationkey""")
def gold_shifts_ext(spark, d):
    """Shifts with names, hours and the share of readings that were lost."""
    c = table(spark, d, "customer").selectExpr("c_custkey", "c_name as worker", "c_nationkey as crew_id")
    n = table(spark, d, "nation").selectExpr("n_nationkey", "n_name as crew")
    out = histories.named(histories.named(_shifts(spark, d), [histories.Lookup(c, "user_id", "c_custkey", ("worker", "crew_id"))]), [histories.Lookup(n, "crew_id", "n_nationkey", ("crew",))])
    lost = F.try_divide(F.col("missed").cast("double"), F.col("n") + F.col("missed"))
    return out.select("user_id", "session", "worker", "crew", "first_at", "last_at", ((F.col("last_at") - F.col("first_at")).cast("double") / 3600).alias("hours"), lost.alias("lost"))


_ALIAS = "case when {0} in (14, 15, 16, 17, 18, 19) then 15 when {0} in (1, 2, 11, 12) then 2 else {0} end"


@frame(f"""with r as (select {_ALIAS.format('(c_custkey % 20)')} as source, c_custkey % 20 as ext, c_custkey // 3 as code, c_custkey, c_name as name, c_nationkey as place from customer where c_acctbal > 0),
 l as (select * from r qualify row_number() over (partition by source, code order by c_custkey desc) = 1),
 p as (select {_ALIAS.format('(n_nationkey % 20)')} as source, n_nationkey % 5 as place, max(n_name) as project from nation group by 1, 2),
 n as (select l.source::bigint as source, l.code, l.name, p.project from l join p on p.source = l.source and p.place = l.place % 5),
 o as (select {_ALIAS.format('(c_custkey % 20)')}::bigint as source, c_custkey // 3 as code, min(c_name) as name, null::varchar as project from customer where c_custkey % 4 = 0 group by 1, 2)
 select coalesce(n.source, o.source) as source, coalesce(n.code, o.code) as code, case when n.source is null then o.name else n.name end as name, case when n.source is null then o.project else n.project end as project,
  case when o.source is null then 'inserted' when n.source is null then 'kept' when n.name is distinct from o.name or n.project is distinct from o.project then 'updated' else 'unchanged' end as action from n full join o on n.source = o.source and n.code = o.code""")
def silver_dim_worker(spark, d):
    """Workers under the ids of shared sources: expectations, the last row of a code, projects looked up, merged."""
    c = table(spark, d, "customer")
    own = histories.alias_groups(F.col("c_custkey") % 20, histories.SOURCE_GROUPS).cast("bigint").alias("source")
    good = tables.expect(c, {"balance": "c_acctbal > 0"}).where("size(failed) = 0")
    rows = good.select(own, F.expr("c_custkey div 3").alias("code"), "c_custkey", F.col("c_name").alias("name"), F.expr("c_nationkey % 5").alias("place"))
    last = histories.latest(rows, ["source", "code"], ["c_custkey"]).withColumn("at", F.concat_ws(":", "source", "place"))
    theirs = histories.alias_groups(F.col("n_nationkey") % 20, histories.SOURCE_GROUPS).cast("bigint").alias("source")
    projects = table(spark, d, "nation").select(F.concat_ws(":", theirs, F.expr("n_nationkey % 5")).alias("key"), F.col("n_name").alias("project"))
    ready = histories.load(last, None, ["source", "code"], [histories.Lookup(projects, "at", "key", ("project",))]).where("size(missed) = 0")
    old = c.where("c_custkey % 4 = 0").groupBy(own, F.expr("c_custkey div 3").alias("code")).agg(F.min("c_name").alias("name")).withColumn("project", F.lit(None).cast("string"))
    return tables.merge(old, ready.select("source", "code", "name", "project"), ["source", "code"])


@frame("""with e as (select event_id, floor(value / 4)::bigint as gx, floor((event_id % 90) / 4)::bigint as gy, ceil(coalesce(case when event_id % 5 < 4 then (event_id % 5 * 3)::double end, 0) / 4)::bigint as k from events)
 select event_id, gx + i as gx, gy + j as gy from (select *, unnest(range(-k, k + 1)) as i from e) a, unnest(range(-k, k + 1)) b(j)""")
def cell_ring_by_error(spark, d):
    """Cells that a reading may lie in, by its own error distance."""
    e = table(spark, d, "events").selectExpr("event_id", "value as x", "cast(event_id % 90 as double) as y", "if(event_id % 5 < 4, cast(event_id % 5 * 3 as double), null) as error")
    return e.select("event_id", F.inline(periods.ring(F.col("x"), F.col("y"), 4.0, F.col("error"))))
