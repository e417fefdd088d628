"""Every query by name, with its DuckDB twin.

A query given as one SQL text is run by Spark as it stands; where the two dialects differ, the twin is given beside it.
Tables are named in braces and reach Spark as frames, so no view is left behind in the session.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import periods, recon, tables
from ..sources import stores

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def both(name: str, text: str, twin: str | None = None) -> None:
    """Register a SQL query; the twin is DuckDB's form where it differs."""
    names = sorted(set(re.findall(r"\{(\w+)\}", text)))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})

    run.__name__ = name
    _QUERIES[name] = run
    _SQL[name] = re.sub(r"\{(\w+)\}", r"\1", twin or text)


def frame(twin: str | None = None):
    """Register a DataFrame query under its function's name."""

    def keep(f):
        _QUERIES[f.__name__] = f
        if twin:
            _SQL[f.__name__] = twin
        return f

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- the pair: orders and an edited copy -------------------------------------------------------------------------

ORDERS = recon.ReconSpec(keys=("o_orderkey",), columns=("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"), transforms={"o_totalprice": "cast(o_totalprice as decimal(18,2))"})


def pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """orders, and orders with deterministic edits: rows gone, prices changed, rows added."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kept = o.where(k % 97 != 0).withColumn("o_totalprice", F.when(k % 89 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    added = o.where(k % 101 == 0).withColumn("o_orderkey", k + 1_000_000_000)
    return o, kept.unionByName(added)


PAIR = """with s as (select * from orders), t as (
  select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 89 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice, o_orderdate, o_orderpriority from orders where o_orderkey % 97 <> 0
  union all select o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders where o_orderkey % 101 = 0)
"""
_H = "sha256(concat_ws(chr(1), coalesce(trim(cast({0}.o_custkey as varchar)), '_null_recon_'), coalesce(cast({0}.o_orderkey as varchar), '_null_recon_'), coalesce(trim({0}.o_orderpriority), '_null_recon_'), coalesce(trim({0}.o_orderstatus), '_null_recon_'), coalesce(cast(cast({0}.o_totalprice as decimal(18,2)) as varchar), '_null_recon_')))"
_CLASSES = PAIR + f""", c as (select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
  case when t.o_orderkey is null then 'missing_in_target' when s.o_orderkey is null then 'missing_in_source' when {_H.format('s')} = {_H.format('t')} then 'match' else 'mismatch' end as status
  from s full join t on s.o_orderkey is not distinct from t.o_orderkey) """


@frame(f"select o_orderkey, {_H.format('o')} as h from orders o")
def row_hash(spark, d):
    s = recon.prepare(table(spark, d, "orders"), ORDERS)
    return s.select("o_orderkey", recon.row_hash(s).alias("h"))


@frame(f"select o_orderkey, {_H.format('o').replace('sha256', 'md5')} as h from orders o")
def row_hash_md5(spark, d):
    s = recon.prepare(table(spark, d, "orders"), ORDERS)
    return s.select("o_orderkey", recon.row_hash(s, kind="md5").alias("h"))


@frame("""select event_id, sha256(concat_ws(chr(1), case when event_id % 5 = 0 then '1900-01-01' else strftime(ts, '%Y-%m-%d') end,
  coalesce(event_type, '_null_recon_'), case when event_id % 7 = 0 then '_null_recon_' else to_json(list_sort([event_type, user_id::varchar]))::varchar end)) as h from events""")
def hash_normalize_by_type(spark, d):
    e = table(spark, d, "events").selectExpr("event_id", "event_type", "if(event_id % 5 = 0, null, to_date(ts)) as day", "if(event_id % 7 = 0, null, array(string(user_id), event_type)) as tags")
    return e.select("event_id", recon.row_hash(e, ["event_type", "day", "tags"], sentinels=True).alias("h"))


@frame(_CLASSES + "select status, count(*) as n from c group by status")
def recon_data(spark, d):
    return recon.classify(*pair(spark, d), ORDERS).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@frame(_CLASSES + "select o_orderkey from c where status = 'mismatch'")
def recon_mismatch(spark, d):
    return recon.classify(*pair(spark, d), ORDERS).where("status = 'mismatch'").select("o_orderkey")


@frame(_CLASSES + "select o_orderkey from c where status = 'missing_in_source'")
def recon_missing_in_source(spark, d):
    return recon.classify(*pair(spark, d), ORDERS).where("status = 'missing_in_source'").select("o_orderkey")


@frame(_CLASSES + "select o_orderkey from c where status = 'missing_in_target'")
def recon_missing_in_target(spark, d):
    return recon.classify(*pair(spark, d), ORDERS).where("status = 'missing_in_target'").select("o_orderkey")


@frame(PAIR + f", a as (select {_H.format('s')} as h, count(*) as n from s group by 1), b as (select {_H.format('t')} as h, count(*) as n from t group by 1) select case when b.h is null then 'missing_in_target' else 'missing_in_source' end as status, count(*) as n from a full join b on a.h = b.h where a.h is null or b.h is null group by 1")
def recon_row(spark, d):
    left = recon.classify_rows(*pair(spark, d), ORDERS)
    return left.where("in_source = 0 or in_target = 0").groupBy(F.when(F.col("in_target") == 0, "missing_in_target").otherwise("missing_in_source").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@frame(PAIR + f", u as (select {_H.format('s')} as h, 1 as a, 0 as b from s union all select {_H.format('t')}, 0, 1 from t) select h, sum(a)::bigint as in_source, sum(b)::bigint as in_target from u group by h having sum(a) <> sum(b)")
def recon_row_multiset(spark, d):
    return recon.classify_rows(*pair(spark, d), ORDERS)


@frame(PAIR + "select 'source' as side, count(*) as n from s union all select 'target', count(*) from t")
def recon_counts(spark, d):
    s, t = pair(spark, d)
    return s.select(F.lit("source").alias("side")).union(t.select(F.lit("target").alias("side"))).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@frame(PAIR + "select s.o_orderkey, s.o_totalprice as o_totalprice_base, t.o_totalprice as o_totalprice_compare, s.o_totalprice = t.o_totalprice as o_totalprice_match from s join t on s.o_orderkey = t.o_orderkey where s.o_totalprice <> t.o_totalprice")
def mismatch_columns(spark, d):
    m = recon.column_matches(*pair(spark, d), ORDERS)
    return m.where("not o_totalprice_match").select("o_orderkey", "o_totalprice_base", "o_totalprice_compare", "o_totalprice_match")


@frame(PAIR + """, m as (select count(*) filter (where not coalesce(s.o_custkey = t.o_custkey, false)) as o_custkey, count(*) filter (where not coalesce(s.o_orderstatus = t.o_orderstatus, false)) as o_orderstatus,
 count(*) filter (where not coalesce(s.o_totalprice = t.o_totalprice, false)) as o_totalprice, count(*) filter (where not coalesce(s.o_orderpriority = t.o_orderpriority, false)) as o_orderpriority from s join t on s.o_orderkey = t.o_orderkey)
 select "column", mismatches from (unpivot m on o_custkey, o_orderstatus, o_totalprice, o_orderpriority into name "column" value mismatches)""")
def mismatch_column_counts(spark, d):
    return recon.mismatch_counts(recon.column_matches(*pair(spark, d), ORDERS))


@frame(_CLASSES + "select s.o_orderkey, s.o_custkey, s.o_totalprice from s semi join (select * from c where status = 'mismatch' and o_orderkey % 5 = 0) k on s.o_orderkey = k.o_orderkey")
def fetch_sample_rows(spark, d):
    s, t = pair(spark, d)
    keys = recon.hash_sample(recon.classify(s, t, ORDERS).where("status = 'mismatch'"), F.col("o_orderkey"), 5, 1)
    return s.join(keys, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey", "o_totalprice")


@frame(PAIR + "select o_orderkey, round(o_totalprice * 2, 2) as doubled, upper(o_orderstatus) as o_orderstatus from t where o_orderkey > 100")
def layer_filters(spark, d):
    spec = recon.ReconSpec(keys=("o_orderkey",), columns=("doubled", "o_orderstatus"), transforms={"doubled": "round(o_totalprice * 2, 2)", "o_orderstatus": "upper(o_orderstatus)"}, target_filter="o_orderkey > 100")
    return recon.prepare(pair(spark, d)[1], spec, True)


@frame("select c_custkey as id, c_name as name, c_mktsegment as segment from customer")
def apply_column_mapping(spark, d):
    spec = recon.ReconSpec(keys=("id",), columns=("name", "segment"), renames={"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"})
    return recon.prepare(table(spark, d, "customer"), spec, True)


_THR = PAIR + "select case when coalesce(s.o_totalprice,0) - coalesce(t.o_totalprice,0) = 0 then 'Match' when {} between {} and {} then 'Warning' else 'Failed' end as status, count(*) as n from s join t on s.o_orderkey = t.o_orderkey group by 1"


def _threshold(spark, d, kind, lo, hi):
    s, t = pair(spark, d)
    j = s.alias("s").join(t.alias("t"), F.col("s.o_orderkey").eqNullSafe(F.col("t.o_orderkey")))
    return j.groupBy(recon.threshold(F.col("s.o_totalprice"), F.col("t.o_totalprice"), lo, hi, kind).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@frame(_THR.format("coalesce(s.o_totalprice,0) - coalesce(t.o_totalprice,0)", -5, 5))
def threshold_absolute(spark, d):
    return _threshold(spark, d, "absolute", -5, 5)


@frame(_THR.format("(coalesce(s.o_totalprice,0) - coalesce(t.o_totalprice,0)) / (case when coalesce(t.o_totalprice,0) = 0 then 1 else t.o_totalprice end) * 100", -0.001, 0.001))
def threshold_percentage(spark, d):
    return _threshold(spark, d, "percentage", -0.001, 0.001)


@frame("select case when x = 0 then 'Match' when x between -3600 and 3600 then 'Warning' else 'Failed' end as status, count(*) as n from (select (event_id % 3) * 3000 as x from events) group by 1")
def threshold_datetime(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    later = F.timestamp_seconds(F.unix_timestamp("ts") + (F.col("event_id") % 3) * 3000)
    return e.groupBy(recon.threshold(later, F.col("ts"), -3600, 3600, "datetime").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@frame(PAIR + "select s.o_orderkey, s.o_totalprice as source_value, t.o_totalprice as target_value from s join t on s.o_orderkey = t.o_orderkey where abs(s.o_totalprice - t.o_totalprice) > 0.5")
def threshold_report(spark, d):
    s, t = pair(spark, d)
    j = s.alias("s").join(t.alias("t"), F.col("s.o_orderkey").eqNullSafe(F.col("t.o_orderkey")))
    failed = recon.threshold(F.col("s.o_totalprice"), F.col("t.o_totalprice"), -0.5, 0.5) == "Failed"
    return j.where(failed).select("s.o_orderkey", F.col("s.o_totalprice").alias("source_value"), F.col("t.o_totalprice").alias("target_value"))


_AGG = PAIR + """, a as (select {g} as g, count(*)::varchar n, min(o_totalprice)::decimal(18,2)::varchar lo, max(o_custkey)::varchar hi from s {where_s} group by 1), b as (select {g} as g, count(*)::varchar n, min(o_totalprice)::decimal(18,2)::varchar lo, max(o_custkey)::varchar hi from t {where_t} group by 1),
 u as (select coalesce(a.g, b.g) as {name}, unnest(['n', 'lo', 'hi']) as rule, unnest([a.n, a.lo, a.hi]) as source_value, unnest([b.n, b.lo, b.hi]) as target_value, a.n is not null as in_s, b.n is not null as in_t from a full join b on a.g is not distinct from b.g)
 """
_AGG_STATUS = "case when not in_t then 'missing_in_target' when not in_s then 'missing_in_source' when source_value is not distinct from target_value then 'match' else 'mismatch' end"
def _rules():
    return {"n": F.count(F.lit(1)), "lo": F.min("o_totalprice").cast("decimal(18,2)"), "hi": F.max("o_custkey")}


@frame(_AGG.format(g="o_orderstatus", name="o_orderstatus", where_s="", where_t="") + f"select o_orderstatus, rule, source_value, target_value, {_AGG_STATUS} as status from u")
def agg_recon(spark, d):
    return recon.aggregate_compare(*pair(spark, d), ["o_orderstatus"], _rules())


@frame(PAIR + "select 'n' as rule, (select count(*) from s)::varchar as source_value, (select count(*) from t)::varchar as target_value, case when (select count(*) from s) = (select count(*) from t) then 'match' else 'mismatch' end as status")
def agg_join_global(spark, d):
    return recon.aggregate_compare(*pair(spark, d), [], {"n": F.count(F.lit(1))})


AGG_CLASSES = _AGG.format(g="o_custkey % 40", name="g", where_s="where o_custkey % 40 < 36", where_t="where o_custkey % 40 > 3") + f", v as (select g, rule, source_value, target_value, {_AGG_STATUS} as status from u) "


def agg_classes(spark, d):
    """Aggregates of the pair by customer group, with groups that either side lacks."""
    s, t = (x.withColumn("g", F.col("o_custkey") % 40) for x in pair(spark, d))
    return recon.aggregate_compare(s.where("g < 36"), t.where("g > 3"), ["g"], _rules())


@frame(AGG_CLASSES + "select rule, status, count(*) as n from v group by 1, 2")
def agg_classify(spark, d):
    return agg_classes(spark, d).groupBy("rule", "status").agg(F.count(F.lit(1)).alias("n"))


@frame("select l_returnflag, min(l_linenumber) as min_l_linenumber, max(l_linenumber) as max_l_linenumber, count(l_linenumber) as count_l_linenumber, sum(l_linenumber)::bigint as sum_l_linenumber, round(avg(l_linenumber), 6) as avg_l_linenumber, round(avg(l_quantity), 6) as mean_l_quantity, mode(l_linenumber > 0) as mode_l_any, round(stddev(l_quantity), 6) as stddev_l_quantity, round(variance(l_quantity), 4) as variance_l_quantity, median(l_quantity) as median_l_quantity from lineitem group by 1")
def agg_types(spark, d):
    rows = table(spark, d, "lineitem").withColumn("l_any", F.col("l_linenumber") > 0)
    rules = [(k, "l_linenumber") for k in ("min", "max", "count", "sum", "avg")] + [("mean", "l_quantity"), ("mode", "l_any"), ("stddev", "l_quantity"), ("variance", "l_quantity"), ("median", "l_quantity"), ("max", "l_linenumber")]
    places = {"avg_l_linenumber": 6, "mean_l_quantity": 6, "stddev_l_quantity": 6, "variance_l_quantity": 4}
    out = rows.groupBy("l_returnflag").agg(*[f.alias(n) for n, f in recon.aggregate_rules(rules).items()])
    return out.withColumns({c: F.round(c, n) for c, n in places.items()})


@frame(_CLASSES + "select count(*) filter (where status = 'match') as match, count(*) filter (where status = 'mismatch') as mismatch, count(*) filter (where status = 'missing_in_source') as missing_in_source, count(*) filter (where status = 'missing_in_target') as missing_in_target, count(*) filter (where status = 'mismatch') * 100 <= 5.0 * count(*) as passed from c")
def table_threshold_status(spark, d):
    m = recon.metrics(recon.classify(*pair(spark, d), ORDERS))
    return recon.table_status(m, F.col("match") + F.col("mismatch") + F.col("missing_in_source") + F.col("missing_in_target"), percent=5.0)


@frame("select * from (values ('o_orderkey', 'bigint', 'bigint', true), ('o_custkey', 'number(10,1)', 'bigint', false), ('o_orderstatus', 'varchar(1)', 'string', true), ('o_totalprice', 'float', 'double', true), ('o_comment', 'varchar(79)', 'Unknown', false)) v(source_column, source_type, target_type, is_valid)")
def schema_compare(spark, d):
    declared = [("o_orderkey", "bigint"), ("o_custkey", "number(10,1)"), ("o_orderstatus", "varchar(1)"), ("o_totalprice", "float"), ("o_comment", "varchar(79)")]
    return recon.schema_compare(declared, table(spark, d, "orders"))


_MISMATCHES = _CLASSES + ", d as (select o_orderkey, status, row_number() over (order by o_orderkey) as rn from c where status = 'mismatch' order by o_orderkey limit 50) "


def _details(spark, d):
    return recon.details(recon.classify(*pair(spark, d), ORDERS).where("status = 'mismatch'").orderBy("o_orderkey"), "mismatch")


@frame(_MISMATCHES + "select 'mismatch' as recon_type, count(*) as n, string_agg(o_orderkey::varchar, ',' order by o_orderkey) as keys from d")
def details_record(spark, d):
    keys = F.array_join(F.transform("data", lambda m: m["o_orderkey"]), ",")
    return _details(spark, d).select("recon_type", F.size("data").cast("long").alias("n"), keys.alias("keys"))


@frame(_MISMATCHES + "select 'mismatch' as recon_type, rn::int as rn, unnest(['o_orderkey', 'status']) as key, unnest([o_orderkey::varchar, status]) as value from d")
def report_details_pivot(spark, d):
    return recon.explode_details(_details(spark, d))


@frame()
def sample_random(spark, d):
    o = table(spark, d, "orders")
    return recon.sample_random(o, 100, o.count())


@frame()
def sample_stratified(spark, d):
    return recon.sample_stratified(table(spark, d, "customer"), ["c_mktsegment"], 5, 0.2)


@frame("select * from orders where o_orderkey % 20 < 3")
def hash_sample(spark, d):
    return recon.hash_sample(table(spark, d, "orders"), F.col("o_orderkey"), 20, 3).withColumn("o_orderdate", F.col("o_orderdate"))


@frame(PAIR + ", k as (select o_orderkey from s order by o_orderkey limit 200) select count(*) as sampled, count(t.o_orderkey) as matched, case when count(t.o_orderkey) * 100.0 >= 100.0 * count(*) then 'PASS' when count(t.o_orderkey) * 100.0 >= 99.0 * count(*) then 'WARN' else 'FAIL' end as status from k left join t on k.o_orderkey = t.o_orderkey")
def pk_sample_match(spark, d):
    s, t = pair(spark, d)
    k = s.orderBy("o_orderkey").limit(200).select("o_orderkey")
    j = k.join(t.select("o_orderkey", F.lit(1).alias("there")), "o_orderkey", "left").agg(F.count(F.lit(1)).alias("sampled"), F.count("there").alias("matched"))
    share = F.col("matched") * 100.0 / F.col("sampled")
    return j.withColumn("status", F.when(share >= 100, "PASS").when(share >= 99, "WARN").otherwise("FAIL"))


# --- mutation, history, expectations -----------------------------------------------------------------------------

_MERGE = PAIR + """select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey, case when s.o_orderkey is null then t.o_totalprice when t.o_orderkey is null then s.o_totalprice when {0} then t.o_totalprice else s.o_totalprice end as o_totalprice,
 case when s.o_orderkey is null then 'inserted' when t.o_orderkey is null then 'kept' when {0} then 'updated' else 'unchanged' end as action from s full join t on s.o_orderkey = t.o_orderkey"""


def _slim(spark, d):
    return [x.select("o_orderkey", "o_totalprice") for x in pair(spark, d)]


@frame(_MERGE.format("s.o_totalprice is distinct from t.o_totalprice"))
def upsert(spark, d):
    s, t = _slim(spark, d)
    return tables.merge(s, t, ["o_orderkey"])


@frame(_MERGE.format("abs(s.o_totalprice - t.o_totalprice) > 2"))
def merge_with_change_detection(spark, d):
    s, t = _slim(spark, d)
    return tables.merge(s, t, ["o_orderkey"], tables.moved({"o_totalprice": 2.0}))


@frame("select action, count(*) as n from (" + _MERGE.format("s.o_totalprice is distinct from t.o_totalprice") + ") group by action")
def merge_report(spark, d):
    return upsert(spark, d).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@frame(PAIR + "select s.o_orderkey, s.o_totalprice, t.o_orderkey is null as deleted from s left join t on s.o_orderkey = t.o_orderkey")
def merge_not_matched_by_source_soft_delete(spark, d):
    s, t = _slim(spark, d)
    return s.join(t.select("o_orderkey", F.lit(True).alias("there")), "o_orderkey", "left").select("o_orderkey", "o_totalprice", F.col("there").isNull().alias("deleted"))


_EVENTS = "select event_id, user_id, event_type, value, epoch_us(ts) as at from events"


def events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))


@frame(f"with e as ({_EVENTS}), r as (select *, row_number() over (partition by user_id order by event_id desc) rn from e) select user_id, event_id, event_type, value from r where rn = 1 and event_type <> 'error'")
def scd1_apply(spark, d):
    return tables.scd1(events(spark, d).drop("at"), ["user_id"], "event_id", F.col("event_type") == "error").select("user_id", "event_id", "event_type", "value")


_SCD2 = f"""with e as ({_EVENTS}), m as (select *, event_type = 'error' as del, lag(event_type) over w as p, row_number() over w as rn from e window w as (partition by user_id order by event_id)),
 c as (select * from m where rn = 1 or event_type is distinct from p), v as (select *, lead(event_id) over (partition by user_id order by event_id) as end_at from c) select user_id, event_type, event_id as start_at, end_at from v where not del"""


def _versions(spark, d):
    return tables.scd2(events(spark, d), ["user_id"], "event_id", F.col("event_type") == "error", ["event_type"])


@frame(_SCD2)
def scd2_track_columns(spark, d):
    return _versions(spark, d)


@frame(f"select * from ({_SCD2}) where end_at is null")
def scd2_current(spark, d):
    return _versions(spark, d).where("end_at is null")


@frame(f"select * from ({_SCD2}) where start_at <= 500 and (end_at is null or end_at > 500)")
def scd2_as_of(spark, d):
    return tables.as_of(_versions(spark, d), 500)


RULES = {"price_positive": "o_totalprice > 1000", "status_known": "o_orderstatus in ('O', 'F')", "key_even": "o_orderkey % 2 = 0"}


@frame("select o_orderkey, concat_ws(',', case when not coalesce(o_totalprice > 1000, false) then 'price_positive' end, case when not coalesce(o_orderstatus in ('O', 'F'), false) then 'status_known' end, case when not coalesce(o_orderkey % 2 = 0, false) then 'key_even' end) as failed from orders")
def dq_quarantine(spark, d):
    return tables.expect(table(spark, d, "orders"), RULES).select("o_orderkey", F.concat_ws(",", "failed").alias("failed"))


@frame("select 'price_positive' as rule, count(*) filter (where not coalesce(o_totalprice > 1000, false)) as failures from orders union all select 'status_known', count(*) filter (where not coalesce(o_orderstatus in ('O', 'F'), false)) from orders union all select 'key_even', count(*) filter (where not coalesce(o_orderkey % 2 = 0, false)) from orders")
def dq_three_tier(spark, d):
    return tables.rule_counts(table(spark, d, "orders"), RULES)


@frame("select o_orderkey from orders where o_totalprice > 1000")
def expect_drop(spark, d):
    return tables.expect(table(spark, d, "orders"), {"p": RULES["price_positive"]}).where(F.size("failed") == 0).select("o_orderkey")


@frame("select o_orderkey from orders")
def expect_fail(spark, d):
    return tables.expect_or_fail(table(spark, d, "orders"), {"key": "o_orderkey is not null"}).select("o_orderkey")


# --- periods, sessions, hierarchies, proximity -------------------------------------------------------------------

_PERIODS = "select o_custkey, o_orderkey % 1000 as a, o_orderkey % 1000 + o_orderkey % 37 as b from orders"


def order_periods(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select("o_custkey", (k % 1000).alias("a"), (k % 1000 + k % 37).alias("b"))


_ISLANDS = f"""with p as ({_PERIODS}), m as (select *, case when a <= max(b) over (partition by o_custkey order by a, b rows between unbounded preceding and 1 preceding) + {{0}} then 0 else 1 end as n from p),
 g as (select *, sum(n) over (partition by o_custkey order by a, b rows unbounded preceding) as no from m) select o_custkey, min(a) as a, max(b) as b, count(*) as n from g group by o_custkey, no"""


@frame(_ISLANDS.format(0))
def coalesce_periods_overlap(spark, d):
    return periods.islands(order_periods(spark, d), ["o_custkey"], "a", "b")


@frame(_ISLANDS.format(15))
def coalesce_periods_gap(spark, d):
    return periods.islands(order_periods(spark, d), ["o_custkey"], "a", "b", 15)


@frame(f"with p as ({_PERIODS}), x as (select distinct o_custkey, unnest([a, b]) as t from p), n as (select o_custkey, t as a, lead(t) over (partition by o_custkey order by t) as b from x) select * from n where b is not null")
def interval_boundaries(spark, d):
    return periods.slices(order_periods(spark, d), ["o_custkey"], "a", "b")


@frame(f"with p as ({_PERIODS}), x as (select distinct o_custkey, unnest([a, b]) as t from p), n as (select o_custkey, t as a, lead(t) over (partition by o_custkey order by t) as b from x) select n.o_custkey, n.a, n.b, count(*) as covers from n join p on n.o_custkey = p.o_custkey and p.a <= n.a and p.b >= n.b where n.b is not null group by 1, 2, 3")
def interval_slice_join(spark, d):
    p = order_periods(spark, d)
    n = periods.slices(p, ["o_custkey"], "a", "b").alias("n")
    on = (F.col("n.o_custkey") == F.col("p.o_custkey")) & (F.col("p.a") <= F.col("n.a")) & (F.col("p.b") >= F.col("n.b"))
    return n.join(p.alias("p"), on).groupBy("n.o_custkey", "n.a", "n.b").agg(F.count(F.lit(1)).alias("covers"))


_SECONDS = "select event_id, user_id, event_type, value, epoch_us(ts) // 1000000 as at from events"


def event_seconds(spark, d):
    return events(spark, d).withColumn("at", F.expr("at div 1000000"))


@frame(f"""with e as ({_SECONDS}), m as (select *, case when "at" - lag("at") over (partition by user_id order by "at") <= 18000 then 0 else 1 end as n from e), g as (select *, sum(n) over (partition by user_id order by "at" range unbounded preceding) as session from m) select user_id, session::bigint as session, min("at") as first_at, max("at") as last_at, count(*) as n, count(*) filter (where event_type = 'click') as clicks from g group by user_id, session""")
def session_islands(spark, d):
    return periods.sessions(event_seconds(spark, d), ["user_id"], "at", 18000, F.count_if(F.col("event_type") == "click").alias("clicks"))


@frame(f"with e as ({_SECONDS}) select a.user_id, count(*) as pairs from e a join e b on a.user_id = b.user_id and abs(a.at - b.at) <= 3600 and a.event_id < b.event_id group by 1")
def join_time_bucket_band(spark, d):
    e = event_seconds(spark, d).select("event_id", "user_id", "at")
    j = periods.band_join(e, e, ["user_id"], "at", "at", 3600).where("a.event_id < b.event_id")
    return j.groupBy("a.user_id").agg(F.count(F.lit(1)).alias("pairs"))


@frame("with recursive h as (select c_custkey as child, c_custkey // 4 as ancestor, 1 as level from customer where c_custkey <> c_custkey // 4 union all select h.child, c.c_custkey // 4, h.level + 1 from h join customer c on h.ancestor = c.c_custkey and c.c_custkey <> c.c_custkey // 4 where h.level < 10 and h.child <> c.c_custkey // 4) select child, ancestor, level from h")
def hierarchy_levels(spark, d):
    edges = table(spark, d, "customer").select("c_custkey", F.expr("c_custkey div 4").alias("up"))
    return periods.hierarchy(edges, "c_custkey", "up", 10, stores.materialize)


@frame("with recursive h as (select c_custkey as child, c_custkey // 4 as ancestor, 1 as level from customer where c_custkey <> c_custkey // 4 union all select h.child, c.c_custkey // 4, h.level + 1 from h join customer c on h.ancestor = c.c_custkey and c.c_custkey <> c.c_custkey // 4 where h.level < 10) select child, string_agg(ancestor::varchar, '>' order by level) as path, max(level) as depth from h group by child")
def hierarchy_path(spark, d):
    h = hierarchy_levels(spark, d).groupBy("child").agg(F.sort_array(F.collect_list(F.struct("level", "ancestor"))).alias("p"))
    return h.select("child", F.concat_ws(">", F.transform("p", lambda x: x["ancestor"].cast("string"))).alias("path"), F.array_max(F.transform("p", lambda x: x["level"])).alias("depth"))


@frame("select event_id, round(2 * 6371000 * asin(sqrt(pow(sin(radians((event_id % 7) * 0.01) / 2), 2) + cos(radians(40 + event_id % 10)) * cos(radians(40 + event_id % 10 + (event_id % 7) * 0.01)) * pow(sin(radians((event_id % 5) * 0.02) / 2), 2))), 3) as metres from events")
def haversine_m(spark, d):
    k = F.col("event_id")
    lat = 40 + k % 10
    m = periods.haversine_m(lat, F.lit(0.0), lat + (k % 7) * 0.01, (k % 5) * 0.02)
    return table(spark, d, "events").select("event_id", F.round(m, 3).alias("metres"))


@frame("select event_id, (floor((event_id % 100) * 0.37 / 0.5)::bigint + 1000000) * 10000000 + floor((event_id % 77) * 0.21 / 0.5)::bigint + 1000000 as cell from events")
def point_to_cell(spark, d):
    k = F.col("event_id")
    return table(spark, d, "events").select("event_id", periods.cell((k % 100) * 0.37, (k % 77) * 0.21, 0.5).alias("cell"))


@frame("select o_orderkey from orders where o_custkey % 3 = 1")
def row_filter_project(spark, d):
    access = spark.sql("select * from values ('a@x', 1L, 0, cast(null as int)), ('a@x', 2L, 0, 5), ('b@x', null, 0, null) as t(user_email, project_id, valid_from, valid_to)")
    rows = table(spark, d, "orders").withColumn("project_id", F.col("o_custkey") % 3)
    return periods.row_filter(rows, access, "a@x", "project_id", 10).select("o_orderkey")


@frame("select o_orderkey from orders")
def row_filter_admin(spark, d):
    access = spark.sql("select 'b@x' as user_email, cast(null as long) as project_id, 0 as valid_from, cast(null as int) as valid_to")
    rows = table(spark, d, "orders").withColumn("project_id", F.col("o_custkey") % 3)
    return periods.row_filter(rows, access, "b@x", "project_id", 10).select("o_orderkey")


from . import casts, checks, facts, feeds, gold, sensors, statements, store, views, works, zones  # noqa: E402,F401  queries of other modules
