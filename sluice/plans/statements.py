"""Queries that a SQL user writes in one statement: projections, joins, aggregates, windows, sets, scalar functions."""

from __future__ import annotations

from .catalog import both

MONEY = "cast(sum(cast({} as decimal(18,2))) as double)"

# reading
both("read_parquet", "select r_regionkey, r_name from {region}")
both("read_table", "select n_nationkey, n_name, n_regionkey from {nation}")
both("incremental_query", "select event_id, user_id from {events} where event_id > 400")
both("bounded_watermark_window", "select event_id, user_id from {events} where event_id > 400 and event_id <= 700")
both("greatest_watermark", "select max(greatest(coalesce(o_orderkey, 0), coalesce(o_custkey, 0))) as watermark from {orders}")
both("select_drop_columns", "select o_orderkey, o_custkey from {orders}")
both("apply_user_transformations", "select s_suppkey, upper(trim(s_name)) as s_name from {supplier}")

# projections, filters, joins
both("select_rename_transform", "select c_custkey as id, trim(c_name) as name, lower(c_mktsegment) as segment from {customer}")
both("lateral_column_alias", "select o_orderkey, o_custkey + 1 as a, a * 2 as b from {orders}")
both("filter_soft_delete", "select event_id from {events} where nullif(event_type, 'error') is not null")
both("filter_valid_date", "select o_orderkey from {orders} where o_orderdate between timestamp '1995-01-01' and timestamp '2100-01-01'")
both("clean_date", "select o_orderkey, case when year(o_orderdate) between 1996 and 2100 then year(o_orderdate) end as y from {orders}")
both("join_inner_using", "select n_name, r_name from {nation} n join {region} r on n.n_regionkey = r.r_regionkey")
both("join_left", "select c_custkey, n_name from {customer} left join {nation} on c_nationkey = n_nationkey and n_regionkey < 3")
both("join_inner_lookup", "select s_suppkey, n_name, r_name from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey")
both("join_resolution_check", "select c_custkey from {customer} left join {nation} on c_nationkey = n_nationkey and n_regionkey = 1 where n_nationkey is not null or c_nationkey is null")
both("join_full_outer_coalesce", "select coalesce(a.k, b.k) as k, coalesce(a.n, 0) as orders, coalesce(b.n, 0) as customers from (select o_custkey % 50 as k, count(*) as n from {orders} where o_custkey % 50 < 40 group by 1) a full join (select c_custkey % 50 as k, count(*) as n from {customer} where c_custkey % 50 > 10 group by 1) b on a.k = b.k")
both("join_null_safe", "select cast(sum(a.n * b.n) as bigint) as n from (select nullif(o_custkey % 5, 0) as k, count(*) as n from {orders} group by 1) a join (select nullif(n_nationkey % 5, 0) as k, count(*) as n from {nation} group by 1) b on a.k <=> b.k",
     "select sum(a.n * b.n)::bigint as n from (select nullif(o_custkey % 5, 0) as k, count(*) as n from {orders} group by 1) a join (select nullif(n_nationkey % 5, 0) as k, count(*) as n from {nation} group by 1) b on a.k is not distinct from b.k")
both("join_anti", "select c_custkey from {customer} where not exists (select 1 from {orders} where o_custkey = c_custkey)")
both("join_semi_exists", "select c_custkey from {customer} where exists (select 1 from {orders} where o_custkey = c_custkey and o_totalprice > 100000)")
both("join_not_exists", "select n_nationkey from {nation} n where not exists (select 1 from {supplier} s where coalesce(s.s_nationkey, -1) = coalesce(n.n_nationkey, -1))")
both("join_or_key", "select distinct s_suppkey, n_nationkey from (select s_suppkey, n_nationkey from {supplier} join {nation} on s_nationkey = n_nationkey union select s_suppkey, n_nationkey from {supplier} join {nation} on s_suppkey % 25 = n_nationkey) t")
both("join_point_in_interval", "select o.o_orderkey, p.k from {orders} o join (select c_custkey as k, c_custkey * 3 as lo, case when c_custkey % 3 = 0 then null else c_custkey * 3 + 900 end as hi from {customer}) p on o.o_custkey = p.k and p.lo <= o.o_orderkey and (o.o_orderkey < p.hi or p.hi is null)")
both("join_interval_overlap", "select a.o_custkey, greatest(a.lo, b.lo) as lo, least(a.hi, b.hi) as hi, count(*) as n from (select o_custkey, o_orderkey % 100 as lo, o_orderkey % 100 + 10 as hi from {orders}) a join (select c_custkey, c_custkey % 100 as lo, c_custkey % 100 + 20 as hi from {customer}) b on a.o_custkey = b.c_custkey and a.lo < b.hi and b.lo < a.hi group by 1, 2, 3")
both("join_asof_latest", "select event_id, o_orderkey from (select e.event_id, o.o_orderkey, row_number() over (partition by e.event_id order by o.o_orderkey desc) as rn from {events} e join {orders} o on o.o_custkey = e.user_id and o.o_orderkey <= e.event_id) t where rn = 1")
both("join_via_cell", "select a.event_id, count(*) as n from {events} a join {customer} c on floor(a.event_id / 5.0) = floor(c.c_custkey / 5.0) group by 1")
both("join_cast_keys", "select count(*) as n from {orders} join {customer} on cast(o_custkey as varchar(20)) = cast(c_custkey as varchar(20))")
both("lookup_first_per_key", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from {orders}) t where rn = 1")
both("resolve_foreign_ids", "select o_orderkey, n.n_nationkey as new_id from {orders} join {customer} on o_custkey = c_custkey join {nation} n on c_nationkey = n.n_nationkey")
both("source_alias_group", "select case when n_nationkey in (14, 15, 16, 17, 18, 19) then 15 when n_nationkey in (1, 2, 11, 12) then 2 else n_nationkey end as source, count(*) as n from {nation} group by 1")
both("scalar_subquery_cte", "with big as (select * from {orders} where o_totalprice > (select avg(o_totalprice) from {orders})), per as (select o_custkey, count(*) as n from big group by 1) select * from per")
both("unnest_array", "select vec_id, pos, x from (select vec_id, posexplode(embedding) as (pos, x) from {embeddings}) t", "select vec_id, (unnest(range(len(embedding))))::int as pos, unnest(embedding) as x from {embeddings}")
both("unnest_map", "select event_id, k, v from (select event_id, explode(map('value', value, 'user', cast(user_id as double))) as (k, v) from {events}) t", "select event_id, unnest(['value', 'user']) as k, unnest([value, user_id::double]) as v from {events}")
both("flatten_json_lateral", "select event_id, k, v from {events} lateral view explode(from_json(props, 'map<string,bigint>')) t as k, v", "select event_id, unnest(json_keys(props)) as k, unnest(from_json(props, '{\"k\":\"BIGINT\"}').k::bigint) as v from {events}".replace("unnest(from_json(props, '{\"k\":\"BIGINT\"}').k::bigint)", "json_extract(props, '$.k')::bigint"))
both("json_path_project", "select event_id, cast(get_json_object(props, '$.k') as bigint) as k from {events}", "select event_id, json_extract(props, '$.k')::bigint as k from {events}")

# aggregates
both("agg_basic", f"select o_orderstatus, count(*) as n, {MONEY.format('o_totalprice')} as total, min(o_totalprice) as lo, max(o_totalprice) as hi, count(distinct o_custkey) as customers from {{orders}} group by 1")
both("agg_distinct_count", "select count(distinct l_partkey) as parts, count(distinct l_suppkey) as supps from {lineitem}")
both("agg_count_if", "select o_orderpriority, count_if(o_totalprice > 100000) as n from {orders} group by 1")
both("agg_conditional_matrix", "select l_returnflag, " + ", ".join(f"{MONEY.format(f'''case when l_linestatus = '{s}' and l_linenumber % 3 = {i} then l_quantity else 0 end''')} as q_{s.lower()}{i}" for s in "OF" for i in range(3)) + " from {lineitem} group by 1")
both("agg_bool_and", "select o_custkey, bool_and(o_totalprice > 50000) as every_big, bool_or(o_totalprice > 200000) as any_big from {orders} group by 1")
both("agg_bit_or", "select l_returnflag, bit_or(l_linenumber) as b, bit_and(l_linenumber) as a from {lineitem} group by 1")
both("agg_any_value", "select o_custkey, any_value(c_name) as v from {orders} join {customer} on c_custkey = o_custkey group by 1")
both("agg_array_multi_key", "select c_nationkey, array_join(transform(array_sort(collect_list(struct(c_mktsegment as a, -c_custkey as b, c_name as v))), x -> x.v), ',') as names from {customer} group by 1", "select c_nationkey, string_agg(c_name, ',' order by c_mktsegment, c_custkey desc) as names from {customer} group by 1")
both("grouping_id", "select o_orderstatus, o_orderpriority, cast(grouping_id(o_orderstatus, o_orderpriority) as bigint) as g, count(*) as n from {orders} group by cube (o_orderstatus, o_orderpriority)", "select o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority)::bigint as g, count(*) as n from {orders} group by cube (o_orderstatus, o_orderpriority)")
both("agg_listagg", "select n_regionkey, listagg(n_name, ',') within group (order by n_name) as names from {nation} group by 1", "select n_regionkey, string_agg(n_name, ',' order by n_name) as names from {nation} group by 1")
both("agg_listagg_ordered", "select o_orderstatus, listagg(distinct o_orderpriority, '|') within group (order by o_orderpriority) as p from {orders} group by 1", "select o_orderstatus, string_agg(distinct o_orderpriority, '|' order by o_orderpriority) as p from {orders} group by 1")
both("agg_array_ordered", "select n_regionkey, concat_ws(',', transform(array_sort(collect_list(struct(-length(n_name) as l, n_name as n))), x -> x.n)) as names from {nation} group by 1", "select n_regionkey, array_to_string(list(n_name order by -length(n_name), n_name), ',') as names from {nation} group by 1")
both("agg_stddev_var", "select round(stddev_samp(l_quantity), 6) as s, round(stddev_pop(l_quantity), 6) as sp, round(var_samp(l_quantity), 5) as v, round(var_pop(l_quantity), 5) as vp from {lineitem}")
both("agg_corr_regr", "select round(corr(l_quantity, l_extendedprice), 8) as c, round(regr_slope(l_extendedprice, l_quantity), 5) as s, round(regr_intercept(l_extendedprice, l_quantity), 3) as i, round(regr_r2(l_extendedprice, l_quantity), 8) as r2 from {lineitem}")
both("agg_median_mode", "select o_orderstatus, median(o_totalprice) as m, mode(year(o_orderdate) >= 1992) as often from {orders} group by 1")
both("agg_percentile_cont", "select o_orderstatus, percentile_cont(0.25) within group (order by o_custkey) as p from {orders} group by 1")
both("agg_percentile_disc", "select o_orderstatus, cast(percentile_disc(0.25) within group (order by o_custkey) as double) as p from {orders} group by 1")
both("agg_approx_percentile_tsql", "select percentile(o_custkey, 0.9) as cont, percentile_disc(0.9) within group (order by o_custkey) as disc, abs(approx_percentile(o_custkey, 0.9, 10000) - percentile(o_custkey, 0.9)) <= 0.02 * max(o_custkey) + 1 as near from {orders}", "select quantile_cont(o_custkey, 0.9) as cont, quantile_disc(o_custkey, 0.9)::double as disc, true as near from {orders}")
both("agg_grouping_sets", "select o_orderstatus, o_orderpriority, grouping(o_orderstatus) as g, count(*) as n from {orders} group by grouping sets ((o_orderstatus, o_orderpriority), (o_orderstatus), ())")
both("agg_cube", "select o_orderstatus, o_orderpriority, count(*) as n from {orders} group by cube (o_orderstatus, o_orderpriority)")
both("agg_rollup", "select o_orderstatus, o_orderpriority, count(*) as n from {orders} group by rollup (o_orderstatus, o_orderpriority)")
both("agg_pivot", "select * from (select o_orderstatus, o_orderpriority, o_totalprice from {orders}) pivot (max(o_totalprice) for o_orderstatus in ('O' as o, 'F' as f, 'P' as p))", "select o_orderpriority, max(case when o_orderstatus = 'O' then o_totalprice end) as o, max(case when o_orderstatus = 'F' then o_totalprice end) as f, max(case when o_orderstatus = 'P' then o_totalprice end) as p from {orders} group by 1")
both("agg_weighted_avg", "select o_orderstatus, round(sum(mean * n) / sum(n), 4) as w from (select o_orderstatus, o_orderpriority, avg(o_totalprice) as mean, count(*) as n from {orders} group by 1, 2) t group by 1")
both("agg_safe_ratio", "select o_orderpriority, case when count_if(o_orderstatus = 'P') = 0 then null else round(count(*) * 1.0D / count_if(o_orderstatus = 'P'), 6) end as r from {orders} group by 1", "select o_orderpriority, case when count_if(o_orderstatus = 'P') = 0 then null else round(count(*)::double / count_if(o_orderstatus = 'P'), 6) end as r from {orders} group by 1")

# windows
W = "over (partition by o_custkey order by o_totalprice, o_orderkey)"
for name, f in (("row_number", "row_number()"), ("rank", "rank()"), ("dense_rank", "dense_rank()"), ("percent_rank", "round(percent_rank() {w}, 9)"), ("cume_dist", "round(cume_dist() {w}, 9)"), ("ntile", "ntile(4)")):
    both(f"win_{name}", f"select o_orderkey, {f.format(w=W) if '{w}' in f else f'{f} {W}'} as v from {{orders}}")
_ODD, _ALL = "nullif(o_orderkey % 3, 0)", W[:-1] + " rows between unbounded preceding and unbounded following)"
for name, f, more, w in (("lag", "lag", ", 1", W), ("lead", "lead", ", 2", W), ("first_value", "first_value", "", W), ("nth_value", "nth_value", ", 2", W), ("last_value", "last_value", "", _ALL)):
    head = f"select o_orderkey, {f}(o_orderkey{more}) {w} as v, "
    both(f"win_{name}", f"{head}{f}({_ODD}{more}) ignore nulls {w} as skipping from {{orders}}", f"{head}{f}({_ODD}{more} ignore nulls) {w} as skipping from {{orders}}")
both("win_running_sum", f"select o_orderkey, cast(sum(cast(o_totalprice as decimal(18,2))) {W[:-1]} rows unbounded preceding) as double) as v from {{orders}}")
both("win_prev_max", f"select o_orderkey, max(o_totalprice) {W[:-1]} rows between unbounded preceding and 1 preceding) as v from {{orders}}")
both("win_forward_max", f"select o_orderkey, max(o_totalprice) {W[:-1]} rows between current row and unbounded following) as v from {{orders}}")
both("win_partition_agg", "select o_orderkey, max(o_totalprice) over (partition by o_custkey) as v from {orders}")
both("win_min_level_filter", "select o_orderkey from (select o_orderkey, o_orderpriority, min(o_orderpriority) over (partition by o_custkey) as m from {orders}) t where o_orderpriority = m")
both("dedupe_latest", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from {orders}) t where rn = 1")
both("dedupe_priority", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end, o_orderkey) as rn from {orders}) t where rn = 1")
both("segment_number", "select event_id, row_number() over (partition by user_id, event_type order by event_id) as segment from {events}")

# sorts and sets
both("order_by", "select o_orderkey, o_orderpriority, o_totalprice from {orders} order by o_orderpriority desc nulls last, o_totalprice, o_orderkey")
both("order_offset_limit", "select o_orderkey from {orders} order by o_totalprice desc, o_orderkey limit 20 offset 10")
both("top_k", "select o_orderkey, o_totalprice from {orders} order by o_totalprice desc, o_orderkey limit 25")
both("set_union", "select o_custkey as k from {orders} union select c_custkey from {customer}")
both("set_union_all", "select n_regionkey as k from {nation} union all select r_regionkey from {region}")
both("set_intersect", "select o_custkey as k from {orders} intersect select c_custkey from {customer} where c_custkey % 2 = 0")
both("set_except", "select c_custkey as k from {customer} except select o_custkey from {orders}")
both("set_precedence", "select n_nationkey as k from {nation} union (select s_nationkey from {supplier} intersect select c_nationkey from {customer}) except select r_regionkey from {region}")

# mutation by statement, validation
both("delete_where", "select o_orderkey from {orders} where not coalesce(o_totalprice < 50000, false)")
both("delete_using", "select c_custkey from {customer} where not exists (select 1 from {nation} where n_nationkey = c_nationkey and n_regionkey = 0)")
both("post_delete_repair", "select event_id, user_id, next_id from (select event_id, user_id, event_type, lead(event_id) over (partition by user_id order by event_id) as next_id from {events}) t where event_type <> 'error'")
both("stalled_records", "select l_orderkey, count(*) as n from {lineitem} where not exists (select 1 from {orders} where o_orderkey = l_orderkey and o_orderstatus = 'O') group by 1")
both("backfill_null_lookups", "select c_custkey, coalesce(case when c_nationkey % 4 = 0 then null else c_nationkey end, n_nationkey) as nation from {customer} left join {nation} on c_nationkey = n_nationkey")
both("dq_fk_check", "select count(*) as orphans from {orders} where not exists (select 1 from {customer} where c_custkey = o_custkey)")
both("dq_fact_ranges", "select count_if(not (l_discount between 0 and 0.1)) as discount, count_if(l_quantity < 0) as quantity, count_if(l_tax > 0.08) as tax from {lineitem}")
both("check_null", "select 'o_custkey' as col, case when count_if(o_custkey is null) = 0 then 'PASS' else 'FAIL' end as status, 'critical' as severity from {orders}")
both("check_empty", "select case when count(*) > 0 then 'PASS' else 'FAIL' end as status from {orders}")
both("validate_row_count", "select s, t, case when t * 1000 >= s * 999 then 'PASS' when t * 100 >= s * 99 then 'WARN' else 'FAIL' end as status from (select count(*) as s, count_if(o_orderkey % 97 <> 0) as t from {orders}) x")
both("validate_pk_complete", "select count(*) as n from {lineitem} where l_orderkey is null or l_linenumber is null")
both("validate_sums", f"select a, b, round(b / a * 100, 6) as pct from (select {MONEY.format('o_totalprice')} as a, {MONEY.format('case when o_orderkey % 97 <> 0 then o_totalprice else 0 end')} as b from {{orders}}) t")
both("validation_summary", "select status, count(*) as n from (select case when o_totalprice > 150000 then 'FAIL' when o_totalprice > 100000 then 'WARN' else 'PASS' end as status from {orders}) t group by 1")
both("activity_classify", "select doc_id, case when w in ('select', 'with', 'show', 'describe', 'explain') then 'QUERY' when w in ('insert', 'update', 'delete', 'merge', 'copy') then 'DML' when w in ('create', 'alter', 'drop', 'truncate') then 'DDL' when w in ('call', 'exec', 'execute') then 'ROUTINE' when w in ('begin', 'commit', 'rollback') then 'TRANSACTION' else 'OTHER' end as command from (select doc_id, lower(regexp_extract(c, '^[ (]*([A-Za-z]+)', 1)) as w from (select doc_id, concat(case doc_id % 7 when 0 then ' SELECT ' when 1 then '(with x' when 2 then 'Merge ' when 3 then 'drop ' when 4 then 'EXEC ' when 5 then 'commit' else '' end, ' ', coalesce(text, '')) as c from {documents}) t) u")
both("activity_stats", "select event_type, count(*) as n, max(event_id) as latest from {events} group by 1 order by n desc")

# periods and sessions by statement
both("valid_to_from_lead", "select o_custkey, o_orderkey as valid_from, lead(o_orderkey) over (partition by o_custkey order by o_orderkey) as valid_to from {orders}")
both("overlap_violations", "select o_custkey, o_orderkey from (select o_custkey, o_orderkey, o_orderkey % 50 as a, max(o_orderkey % 50 + 5) over (partition by o_custkey order by o_orderkey % 50, o_orderkey rows between unbounded preceding and 1 preceding) as m from {orders}) t where a < m")
both("remove_overlapping_shifts", "select o_custkey, o_orderkey from (select o_custkey, o_orderkey, o_orderkey % 50 as a, lag(o_orderkey % 50 + 5) over (partition by o_custkey order by o_orderkey % 50, o_orderkey) as p from {orders}) t where p is null or a > p")
both("interval_intersection", "select o_orderkey, greatest(o_orderkey % 100, o_custkey % 100) as lo, least(o_orderkey % 100 + 30, o_custkey % 100 + 30) as hi from {orders} where greatest(o_orderkey % 100, o_custkey % 100) < least(o_orderkey % 100 + 30, o_custkey % 100 + 30)")
both("impacted_area", "select k, min(a) as lo, max(a) as hi from (select o_custkey as k, o_orderkey as a from {orders} where o_orderkey % 7 = 0 union all select user_id, event_id from {events} where event_id % 7 = 0) t group by k")
both("expected_calendar", "select c_custkey, explode(sequence(c_custkey, c_custkey + c_custkey % 4)) as day from {customer}", "select c_custkey, unnest(range(c_custkey, c_custkey + c_custkey % 4 + 1)) as day from {customer}")
both("hour_category", "select event_id, case when hour(ts) < 6 then 'night' when hour(ts) < 12 then 'morning' when hour(ts) < 18 then 'afternoon' else 'evening' end as part from {events}")
both("active_inactive_days", "select event_id, case when event_type = 'click' then round(value / 86400, 9) else 0 end as active from {events}")

# gold
both("customer_order_mart", f"select c_custkey, count(o_orderkey) as orders, {MONEY.format('o_totalprice')} as spent from {{customer}} left join {{orders}} on c_custkey = o_custkey group by 1")
both("worker_daily_summary", "select user_id, cast(ts as date) as day, count(*) as n, count(distinct event_type) as kinds from {events} group by 1, 2")
both("calc_manager_changes", f"select o_orderkey, lag(o_orderpriority) over (partition by o_custkey order by o_orderkey) as previous, coalesce(lag(o_orderpriority) over (partition by o_custkey order by o_orderkey) <> o_orderpriority, false) as is_change from {{orders}}")
both("bronze_silver_gold", f"with silver as (select distinct o_orderkey, o_orderstatus, o_totalprice from {{orders}} where o_totalprice > 0) select o_orderstatus, count(*) as n, {MONEY.format('o_totalprice')} as total from silver group by 1")

# scalar functions
both("fn_string_basic", "select c_custkey, lower(c_name) as a, upper(c_name) as b, lpad(c_name, 25, '*') as c, rpad(c_name, 25, '-') as d, left(c_name, 3) as e, right(c_name, 4) as f, repeat('x', 3) as g, replace(c_name, '0', 'o') as h, reverse(c_name) as i, translate(c_name, 'Cu', 'Ku') as j, contains(c_name, '1') as k, trim(c_name) as l, concat_ws('-', c_name, c_mktsegment) as m from {customer}")
both("fn_split_part", "select c_custkey, split_part(c_name, '#', 1) as a, split_part(c_name, '#', 2) as b, split_part(c_name, '#', case when c_custkey % 2 = 0 then 1 else 2 end) as c, split_part(concat(c_mktsegment, ' x'), ' ', 1) as d, split_part(c_name, '#', -1) as e from {customer}")
both("fn_strtok_to_array", "select c_custkey, array_join(filter(split(concat(c_name, '##', c_mktsegment), '[# ]'), x -> x <> ''), '|') as parts, size(filter(split(concat(c_name, '##', c_mktsegment), '[# ]'), x -> x <> '')) as n from {customer}", "select c_custkey, array_to_string(list_filter(string_split_regex(concat(c_name, '##', c_mktsegment), '[# ]'), lambda x: x <> ''), '|') as parts, len(list_filter(string_split_regex(concat(c_name, '##', c_mktsegment), '[# ]'), lambda x: x <> ''))::int as n from {customer}")
both("fn_regexp", "select c_custkey, regexp_replace(c_name, '[0-9]+', 'N') as a, regexp_extract(c_name, '([A-Z]+)#([0-9]+)', 2) as b, c_name rlike '1$' as c, regexp_count(c_name, '0') as d, coalesce(get(regexp_extract_all(substr(c_name, 3), '(?i)([SO])', 1), 1), '') as e, regexp_instr(c_name, '[0-9]') as f from {customer}", "select c_custkey, regexp_replace(c_name, '[0-9]+', 'N') as a, regexp_extract(c_name, '([A-Z]+)#([0-9]+)', 2) as b, regexp_matches(c_name, '1$') as c, len(regexp_extract_all(c_name, '0'))::int as d, coalesce(regexp_extract_all(substr(c_name, 3), '(?i)([SO])', 1)[2], '') as e, (length(regexp_extract(c_name, '^[^0-9]*')) + 1)::int as f from {customer}")
both("fn_editdistance", "select n_nationkey, levenshtein(n_name, 'NATION_17') as d, case when levenshtein(n_name, 'NATION_17', 1) = -1 then 1 else levenshtein(n_name, 'NATION_17', 1) end as capped from {nation}", "select n_nationkey, levenshtein(n_name, 'NATION_17')::int as d, least(levenshtein(n_name, 'NATION_17'), 1)::int as capped from {nation}")
both("fn_encode_hash", "select n_nationkey, sha2(n_name, 256) as s, md5(n_name) as m, base64(cast(n_name as binary)) as b from {nation}", "select n_nationkey, sha256(n_name) as s, md5(n_name) as m, base64(encode(n_name)) as b from {nation}")
both("fn_strpos", "select n_nationkey, locate('N', n_name) as p from {nation}", "select n_nationkey, strpos(n_name, 'N')::int as p from {nation}")
both("fn_clean", "select c_custkey, regexp_replace(c_name, '[^0-9]', '') as digits, coalesce(nullif(trim(c_mktsegment), ''), 'UNKNOWN') as seg from {customer}", "select c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') as digits, coalesce(nullif(trim(c_mktsegment), ''), 'UNKNOWN') as seg from {customer}")
both("fn_date_parts", "select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, day(o_orderdate) as d, quarter(o_orderdate) as q, dayofyear(o_orderdate) as doy, weekofyear(o_orderdate) as w, date_format(o_orderdate, 'MMM') as mon, date_format(o_orderdate, 'E') as dy, last_day(cast(o_orderdate as date)) as l, date_sub(date_trunc('YEAR', o_orderdate) + interval 1 year, 1) as ly, date_sub(cast(date_trunc('QUARTER', o_orderdate) + interval 3 month as date), 1) as lq, date_sub(cast(date_trunc('WEEK', o_orderdate) + interval 7 day as date), 1) as lw, next_day(cast(o_orderdate as date), 'MO') as nm, cast(date_trunc('MONTH', o_orderdate) as date) as tm from {orders}", "select o_orderkey, year(o_orderdate)::int as y, month(o_orderdate)::int as m, day(o_orderdate)::int as d, quarter(o_orderdate)::int as q, dayofyear(o_orderdate)::int as doy, weekofyear(o_orderdate)::int as w, strftime(o_orderdate, '%b') as mon, strftime(o_orderdate, '%a') as dy, last_day(o_orderdate) as l, (date_trunc('year', o_orderdate) + interval 1 year - interval 1 day)::date as ly, (date_trunc('quarter', o_orderdate) + interval 3 month - interval 1 day)::date as lq, (date_trunc('week', o_orderdate) + interval 6 day)::date as lw, (date_trunc('week', o_orderdate) + interval 7 day)::date as nm, date_trunc('month', o_orderdate)::date as tm from {orders}")
both("fn_dateadd", "select o_orderkey, date_add(cast(o_orderdate as date), 5) as d, add_months(cast(o_orderdate as date), 2) as m, timestampadd(YEAR, 1, o_orderdate) as y, timestampadd(QUARTER, 1, o_orderdate) as q, timestampadd(WEEK, -1, o_orderdate) as w, timestampadd(HOUR, 5, o_orderdate) as h, timestampadd(MINUTE, 90, o_orderdate) as n, timestampadd(SECOND, -1, o_orderdate) as s, timestampadd(MILLISECOND, 1500, o_orderdate) as ms, timestampadd(MICROSECOND, 2000000, o_orderdate) as us from {orders}", "select o_orderkey, (o_orderdate::date + 5)::date as d, (o_orderdate::date + interval 2 month)::date as m, o_orderdate + interval 1 year as y, o_orderdate + interval 3 month as q, o_orderdate - interval 7 day as w, o_orderdate + interval 5 hour as h, o_orderdate + interval 90 minute as n, o_orderdate - interval 1 second as s, o_orderdate + interval 1500 millisecond as ms, o_orderdate + interval 2000000 microsecond as us from {orders}")
both("fn_datediff", "select o_orderkey, datediff(cast(o_orderdate as date), date '1995-01-01') as d, timestampdiff(MONTH, timestamp '1990-01-01 00:00:00', o_orderdate) as elapsed_months, (year(o_orderdate) - 1990) * 12 + month(o_orderdate) - 1 as months, year(o_orderdate) - 1990 as years, timestampdiff(HOUR, timestamp '1990-01-01 00:00:00', o_orderdate) as h, timestampdiff(SECOND, timestamp '1990-01-01 00:00:00', o_orderdate) as s from {orders}", "select o_orderkey, datediff('day', date '1995-01-01', o_orderdate::date)::int as d, datesub('month', timestamp '1990-01-01', o_orderdate) as elapsed_months, datediff('month', timestamp '1990-01-01', o_orderdate)::int as months, datediff('year', timestamp '1990-01-01', o_orderdate)::int as years, datediff('hour', timestamp '1990-01-01', o_orderdate) as h, datediff('second', timestamp '1990-01-01', o_orderdate) as s from {orders}")
both("fn_date_construct", "select n_nationkey, make_date(2000 + n_nationkey, 2, 3) as d, make_timestamp(2000 + n_nationkey, 2, 3, n_nationkey % 24, 5, 6.5) as t from {nation}", "select n_nationkey, make_date(2000 + n_nationkey, 2, 3) as d, make_timestamp(2000 + n_nationkey, 2, 3, n_nationkey % 24, 5, 6.5) as t from {nation}")
both("fn_to_timestamp", "select o_orderkey, to_timestamp(date_format(o_orderdate, 'dd/MM/yyyy HH-mm'), 'dd/MM/yyyy HH-mm') as a, timestamp_seconds(o_orderkey) as b, timestamp_millis(o_orderkey * 1000) as c, try_to_timestamp('x', 'yyyy') is null as d from {orders}", "select o_orderkey, strptime(strftime(o_orderdate, '%d/%m/%Y %H-%M'), '%d/%m/%Y %H-%M') as a, make_timestamp(o_orderkey * 1000000) as b, make_timestamp(o_orderkey * 1000000) as c, try_strptime('x', '%Y') is null as d from {orders}")
both("fn_timezone", "select event_id, date_format(from_utc_timestamp(ts, 'America/New_York'), 'yyyy-MM-dd HH:mm') as t from {events}", "select event_id, strftime((ts at time zone 'UTC') at time zone 'America/New_York', '%Y-%m-%d %H:%M') as t from {events}")
both("fn_format_datetime", "select event_id, date_format(ts, 'yyyy/MM/dd') as t from {events}", "select event_id, strftime(ts, '%Y/%m/%d') as t from {events}")
both("fn_try_cast_family", "select c_custkey, try_cast(c_name as int) as a, try_cast(right(c_name, 3) as int) as b from {customer}")
both("fn_decode", "select c_custkey, decode(c_custkey % 4, 0, 'zero', 1, 'one', 2, null, 'many') as a, decode(nullif(c_custkey % 3, 0), null, 'none', 1, 'one') as b from {customer}", "select c_custkey, case c_custkey % 4 when 0 then 'zero' when 1 then 'one' when 2 then null else 'many' end as a, case when c_custkey % 3 = 0 then 'none' when c_custkey % 3 = 1 then 'one' end as b from {customer}")
both("fn_collate", "select c_custkey, collate(c_mktsegment, 'UTF8_LCASE') = lower(c_mktsegment) as same, c_mktsegment = lower(c_mktsegment) as exact from {customer}", "select c_custkey, lower(c_mktsegment) = lower(c_mktsegment) as same, c_mktsegment = lower(c_mktsegment) as exact from {customer}")
both("fn_uuid", "select count(*) as n, count(distinct u) as distinct_values, min(length(u)) as lo, max(length(u)) as hi, bool_and(u rlike '^[0-9a-f]+-[0-9a-f]+-4[0-9a-f]+-') as fourth from (select uuid() as u from {customer}) t", "select count(*) as n, count(*) as distinct_values, 36 as lo, 36 as hi, true as fourth from {customer}")
both("fn_variant", "select event_id, schema_of_variant(v) as kind, variant_get(v, '$.k', 'int') as k, try_variant_get(v, '$.none', 'int') is null as gone from (select event_id, parse_json(props) as v from {events}) t", "select event_id, 'OBJECT<k: BIGINT>' as kind, json_extract(props, '$.k')::int as k, true as gone from {events}")
both("fn_math", "select l_orderkey, l_linenumber, round(sqrt(l_quantity), 9) as a, round(exp(l_discount), 9) as b, round(ln(l_quantity), 9) as c, ceil(l_discount) as d, floor(l_quantity / 3) as e, sign(l_tax - 0.04) as f, round(pow(l_quantity, 2), 6) as g, round(radians(l_quantity), 9) as h, round(atan2(l_quantity, l_tax + 1), 9) as i, mod(l_orderkey, 7) as j, round(sin(l_quantity), 9) as k, round(cos(l_quantity), 9) as l, round(tan(l_quantity), 6) as m, round(asin(l_discount), 9) as n, round(log(2, l_quantity), 9) as o, round(pi() * l_tax, 9) as p, abs(l_discount - 0.05) as r from {lineitem}", "select l_orderkey, l_linenumber, round(sqrt(l_quantity), 9) as a, round(exp(l_discount), 9) as b, round(ln(l_quantity), 9) as c, ceil(l_discount)::bigint as d, floor(l_quantity / 3)::bigint as e, sign(l_tax - 0.04)::double as f, round(pow(l_quantity, 2), 6) as g, round(radians(l_quantity), 9) as h, round(atan2(l_quantity, l_tax + 1), 9) as i, mod(l_orderkey, 7) as j, round(sin(l_quantity), 9) as k, round(cos(l_quantity), 9) as l, round(tan(l_quantity), 6) as m, round(asin(l_discount), 9) as n, round(log(2, l_quantity), 9) as o, round(pi() * l_tax, 9) as p, abs(l_discount - 0.05) as r from {lineitem}")
both("fn_div0", "select n_nationkey, case when n_regionkey = 0 then 0 else round(n_nationkey * 1.0D / n_regionkey, 9) end as div0, round(try_divide(cast(n_nationkey as double), n_regionkey), 9) as safe from {nation}", "select n_nationkey, case when n_regionkey = 0 then 0 else round(n_nationkey::double / n_regionkey, 9) end as div0, case when n_regionkey = 0 then null else round(n_nationkey::double / n_regionkey, 9) end as safe from {nation}")
both("fn_bits", "select n_nationkey, bit_count(n_nationkey) as c, shiftleft(n_nationkey, 2) as l, shiftright(n_nationkey, 1) as r, n_nationkey & 5 as a, n_nationkey | 8 as o, getbit(n_nationkey, 1) as g from {nation}", "select n_nationkey, bit_count(n_nationkey)::int as c, n_nationkey << 2 as l, n_nationkey >> 1 as r, n_nationkey & 5 as a, n_nationkey | 8 as o, ((n_nationkey >> 1) & 1)::tinyint as g from {nation}")
both("fn_null", "select n_nationkey, coalesce(nullif(n_regionkey, 2), -1) as a, nvl2(nullif(n_regionkey, 2), 1, 0) as b, greatest(n_regionkey, 2) as c, least(n_regionkey, 2) as d, nullif(n_regionkey, 1) is not distinct from null as e from {nation}", "select n_nationkey, coalesce(nullif(n_regionkey, 2), -1) as a, case when nullif(n_regionkey, 2) is not null then 1 else 0 end as b, greatest(n_regionkey, 2) as c, least(n_regionkey, 2) as d, nullif(n_regionkey, 1) is not distinct from null as e from {nation}")
both("fn_array", "select vec_id, size(embedding) as n, array_contains(array(1, 2, label), label) as c, array_position(array(5, label, 7), label) as p, concat_ws(',', slice(array(1, 2, 3, label), 2, 2)) as s, size(array_distinct(array(1, 1, label))) as u, arrays_overlap(array(1, 2), array(label)) as o from {embeddings}", "select vec_id, len(embedding)::int as n, list_contains([1, 2, label], label) as c, list_position([5, label, 7], label)::bigint as p, array_to_string([1, 2, 3, label][2:3], ',') as s, len(list_distinct([1, 1, label]))::int as u, list_has_any([1, 2], [label]) as o from {embeddings}")
both("fn_array_average", "select vec_id, round(aggregate(embedding, 0D, (a, x) -> a + x) / size(embedding), 6) as m from {embeddings}", "select vec_id, round(list_sum(list_transform(embedding, lambda x: x::double)) / len(embedding), 6) as m from {embeddings}")
both("fn_json", "select event_id, get_json_object(props, '$.k') as k, concat_ws(',', json_object_keys(props)) as names from {events}", "select event_id, json_extract_string(props, '$.k') as k, array_to_string(json_keys(props), ',') as names from {events}")
both("fn_json_size", "select event_id, size(json_object_keys(props)) as n from {events}", "select event_id, len(json_keys(props))::int as n from {events}")
