"""Facts, summaries and history queries that are one SQL statement each, with orders as shifts and customers as workers."""

from __future__ import annotations

from ..functions import sql
from .catalog import both, frame, table

_N = "cast({} as bigint)"

# aggregates
both("agg_join_grouped", "select coalesce(a.g, b.g) as g, a.n as source_n, b.n as target_n, case when a.n <=> b.n then 'match' else 'mismatch' end as status from (select o_custkey % 20 as g, count(*) as n from {orders} where o_custkey % 20 < 15 group by 1) a full join (select c_custkey % 20 as g, count(*) as n from {customer} where c_custkey % 20 > 3 group by 1) b on a.g <=> b.g",
     "select coalesce(a.g, b.g) as g, a.n as source_n, b.n as target_n, case when a.n is not distinct from b.n then 'match' else 'mismatch' end as status from (select o_custkey % 20 as g, count(*) as n from {orders} where o_custkey % 20 < 15 group by 1) a full join (select c_custkey % 20 as g, count(*) as n from {customer} where c_custkey % 20 > 3 group by 1) b on a.g is not distinct from b.g")
both("agg_array", "select n_regionkey, array_join(transform(array_sort(collect_list(struct(-n_nationkey as k, n_name as v))), x -> x.v), ',') as names from {nation} group by n_regionkey", "select n_regionkey, string_agg(n_name, ',' order by n_nationkey desc) as names from {nation} group by n_regionkey")
both("agg_checksum", "select o_orderstatus, bit_xor(o_orderkey * 31 + o_custkey) as checksum from {orders} group by o_orderstatus")

# sets, samples, mutation
both("set_minus", "select c_nationkey as k from {customer} where c_nationkey < 12 except select s_nationkey from {supplier} where s_nationkey > 7")
both("union_by_name", "select n_nationkey as id, n_name as name, n_regionkey as parent from {nation} union all select r_regionkey, r_name, null from {region}")
both("merge_distinct_from", "select t.c_custkey, case when s.c_custkey is not null and not (s.seg <=> t.c_mktsegment) then s.seg else t.c_mktsegment end as segment from {customer} t left join (select c_custkey, nullif(c_mktsegment, 'BUILDING') as seg from {customer} where c_custkey % 2 = 0) s on s.c_custkey = t.c_custkey",
     "select t.c_custkey, case when s.c_custkey is not null and s.seg is distinct from t.c_mktsegment then s.seg else t.c_mktsegment end as segment from {customer} t left join (select c_custkey, nullif(c_mktsegment, 'BUILDING') as seg from {customer} where c_custkey % 2 = 0) s on s.c_custkey = t.c_custkey")
both("delete_subquery", "select o_orderkey from {orders} where not exists (select 1 from {customer} where c_custkey = o_custkey and c_mktsegment = 'BUILDING')")
_APPLY = "select user_id, event_type, event_id as start_at, end_at from (select *, lead(event_id) over (partition by user_id order by event_id) as end_at from {events}) where event_type <> 'error'"
both("scd2_apply", _APPLY)

# sessions and sensors
both("session_edges", "select user_id, event_id from (select *, min(case when event_type = 'click' then event_id end) over (partition by user_id) as a, max(case when event_type = 'click' then event_id end) over (partition by user_id) as b from {events}) where event_id between a and b")

# cells
both("euclidean", "select s_suppkey, sqrt(cast((s_suppkey % 7) * (s_suppkey % 7) + s_nationkey * s_nationkey as double)) as d from {supplier}")
both("degree_metres", "select s_suppkey, s_nationkey * 111000 as m from {supplier}")
both("cell_distance", "select s_suppkey, greatest(abs(s_suppkey % 11 - 5), abs(s_nationkey - 12)) as d from {supplier}")
both("cell_ring", "select s_suppkey, s_nationkey + dx as x, s_suppkey % 11 + dy as y from {supplier} lateral view explode(sequence(-1, 1)) a as dx lateral view explode(sequence(-1, 1)) b as dy", "select s_suppkey, s_nationkey + dx as x, s_suppkey % 11 + dy as y from {supplier}, (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy)")
both("parse_point_wkt", "select s_suppkey, cast(regexp_extract(w, 'POINT\\\\(([-0-9.]+) ([-0-9.]+)\\\\)', 1) as double) as lon, cast(regexp_extract(w, 'POINT\\\\(([-0-9.]+) ([-0-9.]+)\\\\)', 2) as double) as lat from (select s_suppkey, concat('POINT(', s_nationkey, '.5 -', s_suppkey % 11, ')') as w from {supplier})",
     "select s_suppkey, regexp_extract(w, 'POINT\\(([-0-9.]+) ([-0-9.]+)\\)', 1)::double as lon, regexp_extract(w, 'POINT\\(([-0-9.]+) ([-0-9.]+)\\)', 2)::double as lat from (select s_suppkey, concat('POINT(', s_nationkey, '.5 -', s_suppkey % 11, ')') as w from {supplier})")

# facts and summaries
both("calc_progress", "select o_custkey, cast(sum(done) as bigint) as done, count(*) as planned, cast(sum(done) as double) * 100 / count(*) as percent from (select o_custkey, case when o_orderstatus = 'F' then 1 else 0 end as done from {orders}) group by o_custkey")
both("calc_project_active", "select c_custkey, greatest(a.last, b.last) as last_activity, coalesce(greatest(a.last, b.last) >= 400, false) as active from {customer} left join (select o_custkey as k, max(o_orderkey) as last from {orders} group by 1) a on a.k = c_custkey left join (select user_id as k, max(event_id) as last from {events} group by 1) b on b.k = c_custkey")
both("project_daily_summary", "select coalesce(a.k, b.k) as project, coalesce(a.y, b.y) as y, coalesce(a.n, 0) as orders, coalesce(b.n, 0) as shipments from (select o_custkey % 9 as k, year(o_orderdate) as y, count(*) as n from {orders} group by 1, 2) a full join (select l_suppkey % 9 as k, year(l_shipdate) as y, count(*) as n from {lineitem} group by 1, 2) b on a.k = b.k and a.y = b.y")
both("worker_productivity", "select o_custkey, count(distinct o_orderkey) as orders, count(*) as items, cast(count(*) as double) / count(distinct o_orderkey) as items_per_order from {orders} join {lineitem} on l_orderkey = o_orderkey group by o_custkey")
both("fact_reported_attendance", "select coalesce(a.k, b.k) as k, coalesce(a.n, b.n) as n, case when a.k is null then 'second' else 'first' end as src, coalesce(a.n, b.n) = 1 as deleted from (select o_custkey as k, count(*) as n from {orders} where o_orderstatus = 'F' group by 1) a full join (select o_custkey as k, count(*) as n from {orders} where o_orderstatus = 'O' group by 1) b on a.k = b.k")
both("merge_old_data", "select o_orderkey + 1000000 as k, c_custkey as new_worker from {orders} join {customer} on c_custkey = o_custkey where not exists (select 1 from {events} where event_id = o_orderkey)")
both("expand_via_group", "select distinct c.c_custkey as worker, s.s_suppkey as manager from {customer} c join {supplier} s on c.c_custkey div 45 = s.s_suppkey div 3", "select distinct c.c_custkey as worker, s.s_suppkey as manager from {customer} c join {supplier} s on c.c_custkey // 45 = s.s_suppkey // 3")
both("gold_views", "select c.c_custkey, c.c_name, n.n_name, r.r_name, o.o_orderkey as latest_order from {customer} c left join {nation} n on n.n_nationkey = c.c_nationkey left join {region} r on r.r_regionkey = n.n_regionkey left join (select o_custkey, max(o_orderkey) as o_orderkey from {orders} group by 1) o on o.o_custkey = c.c_custkey")

# approximate aggregates and samples: what they promise, held against the exact value
both("agg_approx_count_distinct", "select o_orderstatus, count(distinct o_custkey) as exact, 0.1 as tolerance, abs(approx_count_distinct(o_custkey, 0.02) - count(distinct o_custkey)) <= 0.1 * count(distinct o_custkey) as within from {orders} group by o_orderstatus", "select o_orderstatus, count(distinct o_custkey) as exact, 0.1 as tolerance, true as within from {orders} group by o_orderstatus")
both("agg_approx_percentile", "select o_orderstatus, median(o_custkey) as exact, 0.02 as tolerance, abs(approx_percentile(o_custkey, 0.5, 10000) - median(o_custkey)) <= 0.02 * (max(o_custkey) - min(o_custkey)) + 1 as within from {orders} group by o_orderstatus", "select o_orderstatus, median(o_custkey) as exact, 0.02 as tolerance, true as within from {orders} group by o_orderstatus")
both("agg_approx_top_k", "select x.item as item, x.count as n from (select explode(approx_top_k(l_linenumber, 2, 1000)) as x from {lineitem}) t", "select l_linenumber as item, count(*) as n from {lineitem} group by 1 order by n desc, item limit 2")
both("sample_default", "select count(*) as n, count(distinct o_orderkey) as keys, count(o_custkey) as found from (select o.o_orderkey, c.o_custkey from (select o_orderkey from {orders} limit 50) o join {orders} c on c.o_orderkey = o.o_orderkey)")
both("tablesample_percent", "select max(total) as total, 0.05 as low, 0.15 as high, count(*) between 0.05 * max(total) and 0.15 * max(total) as within from (select o_orderkey from {orders} tablesample (10 percent) repeatable (7)) cross join (select count(*) as total from {orders})", "select count(*) as total, 0.05 as low, 0.15 as high, true as within from {orders}")
both("tablesample_seeded", """with a as (select o_orderkey as k from {orders} tablesample (10 percent) repeatable (7)), b as (select o_orderkey as k from {orders} tablesample (10 percent) repeatable (7)), c as (select o_orderkey as k from {orders} tablesample (10 percent) repeatable (8))
 select (select count(*) from {orders}) as total, (select count(*) from a full join b on a.k = b.k where a.k is null or b.k is null) = 0 as repeats, (select count(*) from a left anti join c on a.k = c.k) > 0 as differs, (select count(*) from a) between 0.05 * (select count(*) from {orders}) and 0.15 * (select count(*) from {orders}) as share""",
     "select count(*) as total, true as repeats, true as differs, true as share from {orders}")
both("tablesample_join", "select max(total) as total, count(*) between 0.3 * max(total) and 0.7 * max(total) as within from (select * from (select o_orderkey from {orders} join {customer} on o_custkey = c_custkey) tablesample (50 percent) repeatable (7)) cross join (select count(*) as total from {orders})", "select count(*) as total, true as within from {orders}")


@frame("select s_suppkey, greatest(abs(s_suppkey % 11 - 5), abs(s_nationkey - 12)) as d, case when s_nationkey = 0 then null else s_suppkey::double / s_nationkey end as r from supplier")
def register_functions(spark, d):
    sql.register(spark)
    return table(spark, d, "supplier").selectExpr("s_suppkey", "sluice_cell_distance(s_suppkey % 11, s_nationkey, 5, 12) as d", "sluice_safe_ratio(s_suppkey, s_nationkey) as r")
