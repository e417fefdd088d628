"""Queries over the metrics store: a run of table pairs, aggregate rules, and the reports over both."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import recon, store
from .catalog import _CLASSES, AGG_CLASSES, ORDERS, agg_classes, frame, pair, table

CUSTOMERS = recon.ReconSpec(keys=("c_custkey",), columns=("c_name",))
_RUN = f"""with r as (select 'orders' as table_name, 'data' as report_type, count(*) filter (where status = 'missing_in_source') as missing_in_source, count(*) filter (where status = 'missing_in_target') as missing_in_target,
  count(*) filter (where status = 'mismatch') as mismatch, case when count(*) filter (where status = 'mismatch') > 0 then 'o_totalprice' else '' end as mismatch_columns from ({_CLASSES} select status from c)
 union all select 'orders_rows', 'row', count(*) filter (where status in ('missing_in_source', 'mismatch')), count(*) filter (where status in ('missing_in_target', 'mismatch')), 0, null from ({_CLASSES} select status from c)
 union all select 'customer', 'all', 0, 0, 0, ''
 union all select 'supplier', 'data', null, null, null, null),
 f as (select *, 0 + mismatch * 0 as threshold_mismatch, coalesce(missing_in_source = 0 and missing_in_target = 0 and mismatch = 0, false) as status from r)
"""
_PAIRS = ("orders", "data"), ("orders_rows", "row"), ("customer", "all"), ("supplier", "data")


def _rows(spark, d):
    s, t = pair(spark, d)
    c, u = table(spark, d, "customer"), table(spark, d, "supplier")
    # the suppliers lack a column that is asked for, so that pair fails and the others do not
    gone = recon.ReconSpec(keys=("s_suppkey",), columns=("s_phone",))
    return store.recon_run(spark, "run-1", [("orders", s, t, ORDERS, "data"), ("orders_rows", s, t, ORDERS, "row"), ("customer", c, c, CUSTOMERS, "all"), ("supplier", u, u, gone, "data")])


def _main(spark):
    out = None
    for i, (name, report) in enumerate(_PAIRS):
        row = store.main_record(spark, "run-1", name, report, started=f"2024-01-0{1 + i // 2} 10:00:00")
        out = row if out is None else out.unionByName(row)
    return out


@frame(_RUN + "select table_name, missing_in_source + missing_in_target + mismatch as differences from f")
def recon_run(spark, d):
    r = store.report_summary(_rows(spark, d))
    return r.select("table_name", F.expr("missing_in_source + missing_in_target + mismatch").alias("differences"))


@frame(_RUN + "select 'run-1' as recon_id, table_name, missing_in_source, missing_in_target, mismatch, threshold_mismatch, mismatch_columns, null::boolean as schema_comparison, status, '' as exception_message from f where table_name = 'orders'")
def metrics_record(spark, d):
    row = store.metrics_record(*pair(spark, d), ORDERS, "run-1", "orders", thresholds={"o_totalprice": (-5, 5)})
    flat = store.report_summary(row).drop("report_type", "status")
    rest = row.select("recon_metrics.schema_comparison", "run_metrics.status", "run_metrics.exception_message")
    return flat.crossJoin(rest)  # one row each


@frame(_RUN + "select 'run-1' as recon_id, table_name, report_type, missing_in_source, missing_in_target, mismatch, threshold_mismatch, mismatch_columns, status from f")
def report_summary(spark, d):
    return store.report_summary(_rows(spark, d))


@frame(_RUN + """select 'run-1' as recon_id, table_name as source_table, table_name as target_table, report_type, case when mismatch is not null then missing_in_source = 0 and missing_in_target = 0 end as row_status,
 case when report_type in ('data', 'all') then mismatch = 0 end as column_status, case when report_type = 'all' then true end as schema_status, status, table_name = 'supplier' as failed from f""")
def final_status(spark, d):
    done = store.final_status(_main(spark), _rows(spark, d))
    return done.withColumn("failed", F.col("exception_message") != "").drop("exception_message")


@frame(_RUN + ", g as (select *, case when table_name in ('orders', 'orders_rows') then date '2024-01-01' else date '2024-01-02' end as day from f) select day, 'run-1' as recon_id, count(*) filter (where status) as agree, count(*) filter (where not status) as failed, coalesce(string_agg(table_name, ',' order by table_name) filter (where not status), '') as failed_tables from g group by day")
def report_failures(spark, d):
    return store.report_failures(_main(spark), _rows(spark, d))


@frame(_RUN + "select table_name, mismatch, threshold_mismatch, missing_in_source + missing_in_target as missing from f where not status")
def report_mismatch_missing(spark, d):
    return store.report_summary(_rows(spark, d)).where("not status").select("table_name", "mismatch", "threshold_mismatch", F.expr("missing_in_source + missing_in_target").alias("missing"))


_SCHEMA = "(values ('o_orderkey', 'bigint', 'bigint', 'true'), ('o_custkey', 'bigint', 'string', 'false'), ('o_orderstatus', 'string', 'string', 'true')) v(source_column, source_type, target_type, is_valid)"


@frame(f"select 'run-1' as recon_id, 'orders' as table_name, * from {_SCHEMA}")
def report_schema_details(spark, d):
    s = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    compared = recon.schema_compare(s, s.withColumn("o_custkey", F.col("o_custkey").cast("string")))
    return store.report_schema_details(_main(spark), store.schema_details(compared, "run-1", "orders"))


_AGG_METRICS = AGG_CLASSES + ", m as (select rule, count(*) filter (where status = 'mismatch') as mismatch, count(*) filter (where status = 'missing_in_source') as missing_in_source, count(*) filter (where status = 'missing_in_target') as missing_in_target from v group by rule), k as (select *, mismatch + missing_in_source + missing_in_target = 0 as status from m) "
_AGG_ROWS = AGG_CLASSES + ", w as (select *, row_number() over (partition by rule, status order by g) as nth from v where status <> 'match'), x as (select * from w where nth <= 3) "


def _aggregates(spark, d):
    c = agg_classes(spark, d)
    return _main(spark), store.aggregate_metrics(c, "run-1", "orders"), store.aggregate_rule_records(c, "run-1", "orders", ["g"]), store.aggregate_details_record(c, "run-1", "orders", ["g"], most=3)


@frame(_AGG_ROWS + "select rule, status as recon_type, count(*) as n, string_agg(g::varchar, ',' order by g) as groups from x group by 1, 2")
def aggregate_details_record(spark, d):
    _, _, rules, rows = _aggregates(spark, d)
    groups = F.array_join(F.transform("data", lambda m: m["g"]), ",")
    return rows.join(rules, "rule_id").select(F.col("rule_info")["agg_rule"].alias("rule"), "recon_type", F.size("data").cast("long").alias("n"), groups.alias("groups"))


@frame(_AGG_METRICS + "select 'run-1' as recon_id, 'orders' as source_table, 'orders' as target_table, bool_and(status) as status, '' as exception_message from k")
def final_aggregate_status(spark, d):
    main, metrics, _, _ = _aggregates(spark, d)
    return store.final_aggregate_status(main, metrics)


@frame(_AGG_METRICS + "select 'run-1' as recon_id, 'orders' as source_table, rule as agg_rule, 'g' as group_by, mismatch, missing_in_source, missing_in_target, status from k")
def report_aggregate_summary(spark, d):
    main, metrics, rules, _ = _aggregates(spark, d)
    return store.report_aggregate_summary(main, metrics, rules)


@frame(_AGG_ROWS + "select rule as agg_rule, status as recon_type, nth::int as rn, unnest(['g', 'source_value', 'target_value']) as key, unnest([g::varchar, source_value, target_value]) as value from x")
def report_aggregate_details(spark, d):
    _, _, rules, rows = _aggregates(spark, d)
    return store.report_aggregate_details(rules, rows)
