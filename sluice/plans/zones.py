"""Zone, temporal hierarchy and contact queries: suppliers as zones, events as readings, customers as workers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import periods, zones
from ..sources import stores
from .catalog import both, frame, hierarchy_levels, oracle_sql, table

# Zones stand at places of their own and points follow them, so both grow with their keys.  Every third zone has a hole, every fifth
# a second part; the texts hold exponents and blanks.
_RINGS = """concat('((', x, ' ', y, ', ', x + 8, ' ', y, ', ', x + 9, ' ', y + 7, ', ', x + 1, ' ', y + 6, ', ', x, ' ', y, ')',
 if(s_suppkey % 3 = 0, concat(' , ( ', x + 3, 'e0 ', y + 2, ',', x + 3, ' ', y + 4, ', ', x + 5, ' ', y + 4, '.0E+0, ', x + 5, ' ', y + 2, ', ', x + 3, ' ', y + 2, ')'), ''), ')')"""
_WKT = f"if(s_suppkey % 5 = 0, concat('MultiPolygon (', {_RINGS}, ', ((', x + 9, '.25 ', y + 1, ', ', x + 9, '.75 ', y + 1, ', ', x + 9, '.75 ', y + 3, ', ', x + 9, '.25 ', y + 3, ', ', x + 9, '.25 ', y + 1, ')))'), concat('POLYGON', {_RINGS}))"
_V = """with z as (select s_suppkey as zone_id, (s_suppkey * 10)::double as bx, (s_nationkey * 10)::double as by_ from supplier),
 v as (select zone_id, part, ring, seq, bx + dx as x, by_ + dy as y from z join (values (0, 0, 0, 0, 0, 1), (0, 0, 1, 8, 0, 1), (0, 0, 2, 9, 7, 1), (0, 0, 3, 1, 6, 1), (0, 0, 4, 0, 0, 1),
   (0, 1, 0, 3, 2, 3), (0, 1, 1, 3, 4, 3), (0, 1, 2, 5, 4, 3), (0, 1, 3, 5, 2, 3), (0, 1, 4, 3, 2, 3),
   (1, 0, 0, 9.25, 1, 5), (1, 0, 1, 9.75, 1, 5), (1, 0, 2, 9.75, 3, 5), (1, 0, 3, 9.25, 3, 5), (1, 0, 4, 9.25, 1, 5)) c(part, ring, seq, dx, dy, every) on zone_id % every = 0),
 e as (select zone_id, part, ring, seq, x as x1, y as y1, coalesce(lead(x) over w, first(x) over w) as x2, coalesce(lead(y) over w, first(y) over w) as y2 from v window w as (partition by zone_id, part, ring order by seq)),
 p as (select event_id, event_id::double * 0.1 + 0.05 as x, (event_id % 250)::double + 0.25 as y from events),
 h as (select event_id, zone_id from p join e on (y1 > y) <> (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 group by 1, 2 having count(*) % 2 = 1)
"""
# cells of a zone's own box, which is 10 by 7
_C = _V + """, c as (select distinct zone_id as owner, floor(bx)::bigint + gx as gx, floor(by_)::bigint + gy as gy, bx + gx + 0.5 as x, by_ + gy + 0.5 as y from z, range(0, 10) a(gx), range(0, 8) b(gy)),
 o as (select zone_id, gx, gy from c join e on zone_id = owner and (y1 > c.y) <> (y2 > c.y) and c.x < (x2 - x1) * (c.y - y1) / (y2 - y1) + x1 group by 1, 2, 3 having count(*) % 2 = 1)
"""


def _vertices(spark, d):
    base = table(spark, d, "supplier").selectExpr("s_suppkey", "s_suppkey * 10 as x", "s_nationkey * 10 as y")
    return zones.vertices(base.selectExpr("s_suppkey", f"{_WKT} as wkt"), "s_suppkey", "wkt")


def _points(spark, d):
    return table(spark, d, "events").selectExpr("event_id", "cast(event_id as double) * 0.1D + 0.05D as x", "cast(event_id % 250 as double) + 0.25D as y")


@frame(_V + "select * from v")
def zone_vertices(spark, d):
    return _vertices(spark, d)


@frame(_V + """, r as (select zone_id, case when ring = 0 then 1 else -1 end * sign(sum(x1 * y2 - x2 * y1)) as side, sum(x1 * y2 - x2 * y1) / 2 as a, sum(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)) as l,
   sum((x1 + x2) * (x1 * y2 - x2 * y1)) as mx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) as my from e group by zone_id, part, ring)
 select zone_id, round(sum(side * a), 6) as area, round(sum(l), 6) as perimeter, round(sum(side * mx) / (6 * sum(side * a)), 6) as cx, round(sum(side * my) / (6 * sum(side * a)), 6) as cy from r group by zone_id""")
def zone_measures(spark, d):
    return zones.measures(_vertices(spark, d)).select("zone_id", *(F.round(c, 6).alias(c) for c in ("area", "perimeter", "cx", "cy")))


@frame(_V + "select zone_id, part, ring, seq, x, y from v")
def zone_fix_orientation(spark, d):
    # rings turned round, then put right: the first vertex closes the ring, so both directions begin with it
    turned = _vertices(spark, d).withColumn("seq", 4 - F.col("seq"))
    return zones.fix_orientation(turned)


@frame(_V + "select zone_id, part, ring, seq, x + 3 as x, y - 2 as y from v")
def zone_shift_scale(spark, d):
    return zones.shift_scale(_vertices(spark, d), 3.0, -2.0).select("zone_id", "part", "ring", "seq", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@frame(_V + "select zone_id, part, ring, count(*) as n, true as closed, false as few, 0::bigint as bad, 0::bigint as repeated from v group by zone_id, part, ring")
def zone_validity(spark, d):
    return zones.validity(_vertices(spark, d))


@frame(_C + "select zone_id, gx, gy from o")
def polygon_cover(spark, d):
    return zones.cover(_vertices(spark, d), 1.0).select("zone_id", "gx", "gy")


# error distances of 0 to 0.75 in metres / 111,000, and every fifth reading without one
_NEAR = _V + """, q as (select event_id, x, y, case when event_id % 5 < 4 then (event_id % 5 * 27750)::double / 111000 end as reach from p join events using (event_id)),
 m as (select q.*, e.*, x2 - x1 as dx, y2 - y1 as dy from q join z on bx between x - 12 and x + 2 join e using (zone_id)),
 t as (select *, least(greatest(coalesce(((x - x1) * dx + (y - y1) * dy) / nullif(dx * dx + dy * dy, 0), 0), 0), 1) as k from m)
select event_id, zone_id from t group by 1, 2
having count(*) filter (where (y1 > y) <> (y2 > y) and x < dx * (y - y1) / (y2 - y1) + x1) % 2 = 1
 or bool_or(coalesce((x - x1 - k * dx) * (x - x1 - k * dx) + (y - y1 - k * dy) * (y - y1 - k * dy) <= reach * reach, false))"""


@frame(_NEAR)
def points_in_zones(spark, d):
    metres = F.expr("if(event_id % 5 < 4, cast(event_id % 5 * 27750 as double), null)")
    return zones.points_in_zones(_points(spark, d).withColumn("reach", zones.degrees(metres)), _vertices(spark, d), "event_id", 10.0, buffer="reach")


@frame(_V + "select p.event_id, min(h.zone_id) as zone_id from p left join h on h.event_id = p.event_id group by 1")
def zone_assign(spark, d):
    return zones.assign(_points(spark, d), _vertices(spark, d), "event_id", 10.0)


_TREE = """with recursive s as (select c_custkey as child, c_custkey // 4 as ancestor, c_custkey % 50 as a, c_custkey % 50 + 60 as b from customer),
 ways as (select *, 1 as level from s where child <> ancestor
  union all select h.child, s.ancestor, greatest(h.a, s.a), least(h.b, s.b), h.level + 1 from ways h join s on h.ancestor = s.child where h.level < 10 and h.child <> s.ancestor and greatest(h.a, s.a) < least(h.b, s.b)),
 h as (select child, ancestor, a, b, min(level) as level from ways group by all)
"""


@frame(_TREE + "select child, ancestor, a, b, level from h")
def hierarchy_temporal(spark, d):
    e = table(spark, d, "customer").selectExpr("c_custkey", "c_custkey div 4 as up", "c_custkey % 50 as a", "c_custkey % 50 + 60 as b")
    return periods.temporal_hierarchy(e, "c_custkey", "up", "a", "b", 10, stores.materialize)


_LEVELS = f"with h as ({oracle_sql()['hierarchy_levels']}) "


@frame(_LEVELS + "select child, child as level_0, " + ", ".join(f"max(case when level = {n} then ancestor end) as level_{n}" for n in range(1, 13)) + " from h group by child")
def hierarchy_pivot(spark, d):
    wide = hierarchy_levels(spark, d).groupBy("child").pivot("level", list(range(1, 13))).agg(F.max("ancestor"))
    return wide.toDF("child", *[f"level_{n}" for n in range(1, 13)]).withColumn("level_0", F.col("child"))


@frame(_LEVELS + "select distinct child from h where ancestor = 3")
def hierarchy_subtree(spark, d):
    return hierarchy_levels(spark, d).where("ancestor = 3").select("child").distinct()


@frame(_LEVELS + "select child, ancestor, level from h where level <= 2")
def managers_by_level(spark, d):
    return hierarchy_levels(spark, d).where("level <= 2").select("child", "ancestor", "level")


# sessions, contacts, rules
_STITCH = """with s as (select o_custkey, o_orderkey as a, o_orderkey + o_orderkey % 7 as b from {orders}),
 m as (select *, case when a - lag(b) over w <= 300 and b - lag(a) over w <= 1200 then 0 else 1 end as fresh from s window w as (partition by o_custkey order by a)),
 g as (select *, sum(fresh) over (partition by o_custkey order by a rows between unbounded preceding and current row) as no from m)
 select o_custkey, min(a) as a, max(b) as b, count(*) as n from g group by o_custkey, no"""
both("session_stitch", _STITCH)


@frame("select a.l_orderkey % 100 as k, p.s_name as one, q.s_name as other, count(*) as n from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_suppkey <> b.l_suppkey join supplier p on p.s_suppkey = a.l_suppkey join supplier q on q.s_suppkey = b.l_suppkey group by 1, 2, 3")
def contact_network(spark, d):
    """Lines of an order in pairs: many more than lines, so orders and pairs are dealt out in full and no table is broadcast."""
    names = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("name"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(names.hint("merge"), "l_suppkey")
    lines = periods.dealt(lines, "l_orderkey")
    a, b = lines.alias("a"), lines.hint("merge").alias("b")
    met = a.join(b, F.expr("a.l_orderkey = b.l_orderkey and a.l_suppkey <> b.l_suppkey")).selectExpr("a.l_orderkey % 100 as k", "a.name as one", "b.name as other")
    return periods.dealt(met, "k", "one", "other").groupBy("k", "one", "other").agg(F.count(F.lit(1)).alias("n"))


both("fn_to_array", "select c_custkey, case when c_mktsegment is null then null else array(c_mktsegment) end[0] as one from {customer}", "select c_custkey, [c_mktsegment][1] as one from {customer}")
both("fn_map_keys_match", "select event_id, exists(map_keys(map(event_type, value)), k -> k like 'c%') as hit from {events}", "select event_id, event_type like 'c%' as hit from {events}")
