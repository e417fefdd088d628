"""Queries of declared schemas, validation reports, dependency levels and inherited row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, periods
from ..sources import stores
from .catalog import frame, table

FIELDS = [checks.Field("o_orderkey", "bigint", required=True, unique=True), checks.Field("o_custkey", "bigint", low=0, high=100), checks.Field("o_totalprice", "double", required=True, low=1000, high=400000), checks.Field("o_orderpriority", "string", unique=True)]


@frame("""select o_orderkey, concat_ws(',', case when o_totalprice < 1000 then 'o_totalprice_low' end, case when o_custkey > 100 then 'o_custkey_high' end, case when o_totalprice > 400000 then 'o_totalprice_high' end,
 case when count(o_orderpriority) over (partition by o_orderpriority) > 1 then 'o_orderpriority_unique' end) as warnings from orders where o_orderkey % 31 <> 0""")
def dq_from_schema(spark, d):
    rows = table(spark, d, "orders").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 31 != 0, F.col("o_totalprice")))
    out = checks.apply_schema(rows, FIELDS).select("o_orderkey", "warnings")
    order = F.array(*[F.lit(x) for x in ("o_totalprice_low", "o_custkey_high", "o_totalprice_high", "o_orderpriority_unique")])
    return out.select("o_orderkey", F.concat_ws(",", F.filter(order, lambda x: F.array_contains("warnings", x))).alias("warnings"))


_SCHEMA = """select 'schema:orders' as "check", 'FAIL' as status, 'error' as severity, 'o_custkey,o_comment' as found"""


def _schema(spark, d):
    declared = [checks.Field("o_orderkey", "bigint"), checks.Field("o_custkey", "string"), checks.Field("o_comment", "string")]
    return checks.check_schema(table(spark, d, "orders"), declared, "orders")


@frame(_SCHEMA)
def check_schema(spark, d):
    return _schema(spark, d)


@frame(f"""{_SCHEMA} union all select 'null:text', case when count(*) filter (where text is null) = 0 then 'PASS' else 'FAIL' end, 'warning', (count(*) filter (where text is null))::varchar from documents
 union all select 'empty:events', case when count(*) > 0 then 'PASS' else 'FAIL' end, 'error', count(*)::varchar from events""")
def validation_report(spark, d):
    return checks.report(_schema(spark, d), checks.check_null(table(spark, d, "documents"), "text", "warning"), checks.check_empty(table(spark, d, "events"), "events"))


# each part of the table hangs on two others of smaller keys, so levels are longest paths
_EDGES = "select c_custkey // 3 as before, c_custkey as after from customer where c_custkey > 0 union all select c_custkey // 5, c_custkey from customer where c_custkey > 0"


def _edges(spark, d):
    c = table(spark, d, "customer").where("c_custkey > 0")
    return c.selectExpr("c_custkey div 3 as before", "c_custkey as after").union(c.selectExpr("c_custkey div 5", "c_custkey"))


@frame(f"with recursive e as ({_EDGES}), p as (select 0::bigint as node, 0 as level union select e.after, p.level + 1 from p join e on e.before = p.node) select node, max(level) as level from p group by node")
def dependency_order(spark, d):
    return checks.levels(_edges(spark, d), "before", "after", stores.materialize)


@frame("with recursive e as (select c_custkey // 4 + 3 as before, c_custkey as after from customer where c_custkey > 20), r as (select distinct before as root from e where before not in (select after from e)), p as (select root, root as node, 0 as depth from r union all select p.root, e.after, p.depth + 1 from p join e on e.before = p.node where p.depth < 2) select root, node from p where depth = 2")
def lineage_roots_at_level(spark, d):
    e = table(spark, d, "customer").where("c_custkey > 20").selectExpr("c_custkey div 4 + 3 as before", "c_custkey as after")
    return checks.at_depth(e, "before", "after", 2, stores.materialize)


def _access(spark):
    return spark.sql("select * from values ('a@x', 1, cast(null as int), 0, cast(null as int)), ('a@x', cast(null as int), 7, 0, 20), ('a@x', 2, cast(null as int), 0, 5), ('b@x', cast(null as int), cast(null as int), 0, null) as t(user_email, org, company, valid_from, valid_to)")


@frame("select c_custkey from customer join nation on n_nationkey = c_nationkey where n_regionkey = 1 or n_nationkey = 7")
def row_filter_company(spark, d):
    """Customers by nation as company; a grant on a region, the organization, covers its nations."""
    parents = table(spark, d, "nation").selectExpr("n_regionkey as org", "n_nationkey as company")
    rows = table(spark, d, "customer").withColumnRenamed("c_nationkey", "company")
    return periods.row_filter(rows, periods.inherited(_access(spark), parents, "org", "company"), "a@x", "company", 10).select("c_custkey")


@frame("select n_nationkey from nation where n_regionkey = 1")
def row_filter_organization(spark, d):
    grants = _access(spark).where("org is not null or company is null")
    return periods.row_filter(table(spark, d, "nation").withColumnRenamed("n_regionkey", "org"), grants, "a@x", "org", 10).select("n_nationkey")
