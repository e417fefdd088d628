"""Conversions: booleans, numbers, casts of every type, parts of URLs, objects made of columns."""

from __future__ import annotations

from ..functions import sql
from .catalog import both, frame, table

_WORDS = "case c_custkey % 7 when 0 then 'Yes' when 1 then 'off' when 2 then '1' when 3 then 'T' when 4 then 'N' when 5 then null else 'maybe' end"
_NUMBERS = "case c_custkey % 5 when 0 then {nan} when 1 then {inf} when 2 then 0 when 3 then null else c_acctbal end"
_NAN, _INF = "cast('nan' as double)", "cast('inf' as double)"


@frame(f"""with t as (select c_custkey, {_WORDS} as s, {_NUMBERS.format(nan=_NAN, inf=_INF)} as x from customer)
 select c_custkey, case when lower(s) in {sql.TRUE_WORDS} then true when lower(s) in {sql.FALSE_WORDS} then false end as b, case when isnan(x) or isinf(x) then null else x <> 0 end as n,
  coalesce(lower(s) in {sql.TRUE_WORDS} or lower(s) in {sql.FALSE_WORDS}, true) as word, case when lower(s) in {sql.TRUE_WORDS} then true when lower(s) in {sql.FALSE_WORDS} then false end as strict from t""")
def fn_to_boolean(spark, d):
    """Words and numbers as booleans; the strict form sees only what it can read, as it raises an error on the rest."""
    sql.register(spark)
    t = table(spark, d, "customer").selectExpr("c_custkey", f"{_WORDS} as s", f"{_NUMBERS.format(nan=_NAN, inf=_INF)} as x")
    t = t.selectExpr("*", "sluice_to_boolean(s, false) as b", "sluice_number_to_boolean(x, false) as n")
    t = t.selectExpr("*", "b is not null or s is null as word")
    return t.selectExpr("c_custkey", "b", "n", "word", "sluice_to_boolean(if(word, s, null)) as strict")


_AMOUNT = "case c_custkey % 4 when 0 then '-' else '' end || (c_custkey * 7) || '.' || (c_custkey % 10) || '5'"


@frame(f"""with t as (select c_custkey, {_AMOUNT} as s, (case when c_custkey % 4 = 0 then -1 else 1 end * (c_custkey * 700 + c_custkey % 10 * 10 + 5))::bigint as cents from customer)
 select c_custkey, round(cents::decimal(18,2) / 100)::bigint as whole, (cents::decimal(18,2) / 100)::double as scaled, cents::double / 100 as formatted, c_custkey % 3 = 0 as bad, case when c_custkey % 3 <> 0 then round(cents::decimal(18,2) / 100)::bigint end as tried from t""")
def fn_to_number(spark, d):
    """Texts as numbers: decimal(38,0) by default, with precision and scale, by a format, and null where they are none."""
    sql.register(spark)
    t = table(spark, d, "customer").selectExpr("c_custkey", f"{_AMOUNT} as s").selectExpr("*", "if(c_custkey % 3 = 0, 'x' || s, s) as odd")
    return t.selectExpr("c_custkey", "cast(sluice_to_decimal(s) as bigint) as whole", "cast(cast(s as decimal(20, 2)) as double) as scaled", "cast(to_number(s, 'S999999999999999.99') as double) as formatted", "try_to_number(odd, 'S999999999999999.99') is null as bad", "cast(sluice_to_decimal(odd, false) as bigint) as tried")


_MIXED = "case o_orderkey % 4 when 0 then '-' || o_orderkey when 1 then o_orderkey || '.5' when 2 then (o_orderkey || '0000000000') else '' || o_custkey end"


@frame(f"""select o_orderkey, o_totalprice::decimal(18,2) as d, o_custkey::double as f, o_orderkey::varchar as s, o_orderdate::date as t, o_custkey::int as i, o_custkey % 2 = 1 as b, o_orderkey::varchar as bin, o_orderdate::date::timestamp as ts,
 o_orderkey * 2 as arr, case when o_orderkey % 4 in (0, 3) then true else false end as whole, strftime(o_orderdate, '%Y/%m/%d') as text, ('000000000000' || o_orderkey)[-12:] as padded, try_cast({_MIXED} as double) as parsed, strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y')::date as day from orders""")
def fn_casts(spark, d):
    """Casts to date, decimal, double, int, string, timestamp, binary, boolean and array; to_char, to_double, is_integer."""
    sql.register(spark)
    t = table(spark, d, "orders").selectExpr("*", f"{_MIXED} as mixed")
    return t.selectExpr(
        "o_orderkey", "cast(o_totalprice as decimal(18,2)) as d", "cast(o_custkey as double) as f", "cast(o_orderkey as varchar(20)) as s", "cast(o_orderdate as date) as t", "cast(o_custkey as int) as i", "cast(cast(o_custkey % 2 as string) as boolean) as b",
        "cast(cast(cast(o_orderkey as string) as binary) as string) as bin", "cast(cast(o_orderdate as date) as timestamp) as ts", "aggregate(cast(array(cast(o_orderkey as string), cast(o_orderkey as string)) as array<bigint>), 0L, (a, x) -> a + x) as arr",
        "sluice_is_integer(mixed) as whole", "date_format(o_orderdate, 'yyyy/MM/dd') as text", "to_char(o_orderkey, '000000000000') as padded", "try_cast(mixed as double) as parsed", "to_date(date_format(o_orderdate, 'dd.MM.yyyy'), 'dd.MM.yyyy') as day",
    )


_URL = "'HTTPS://User@Host' || page_id % 9 || '.example.org:' || (8000 + page_id % 50) || '/a%20b/' || page_id || case when page_id % 3 <> 0 then '?k=' || page_id || '&empty=&z=1' else '' end || case when page_id % 4 = 0 then '#top' else '' end"
both("fn_parse_url", f"select page_id, parse_url(u, 'PROTOCOL') as scheme, parse_url(u, 'HOST') as host, parse_url(u, 'AUTHORITY') as authority, parse_url(u, 'USERINFO') as user, parse_url(u, 'PATH') as path, parse_url(u, 'FILE') as file, parse_url(u, 'QUERY') as query, parse_url(u, 'QUERY', 'k') as k, parse_url(u, 'QUERY', 'none') as none, parse_url(u, 'REF') as ref, parse_url(url, 'HOST') as own, try_parse_url('http://[::', 'HOST') as bad from (select page_id, url, {_URL} as u from {{pages}}) t",
     """select page_id, 'HTTPS' as scheme, 'Host' || page_id % 9 || '.example.org' as host, 'User@Host' || page_id % 9 || '.example.org:' || (8000 + page_id % 50) as authority, 'User' as user, '/a%20b/' || page_id as path, '/a%20b/' || page_id || case when page_id % 3 <> 0 then '?k=' || page_id || '&empty=&z=1' else '' end as file,
 case when page_id % 3 <> 0 then 'k=' || page_id || '&empty=&z=1' end as query, case when page_id % 3 <> 0 then page_id::varchar end as k, null::varchar as none, case when page_id % 4 = 0 then 'top' end as ref, nullif(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '') as own, null::varchar as bad from {pages}""")

both("fn_object_construct", "select c_custkey, to_json(named_struct('id', c_custkey, 'segment', c_mktsegment, 'gone', cast(null as string))) as s, map('id', cast(c_custkey as string), 'segment', c_mktsegment)['segment'] as v, to_json(named_struct('row', whole)) as every, size(map_filter(map('a', c_nationkey, 'b', c_custkey), (k, v) -> v is not null)) as n from (select *, struct(*) as whole from (select c_custkey, nullif(c_nationkey, 3) as c_nationkey, c_mktsegment from {customer}) i) t",
     """select c_custkey, '{"id":' || c_custkey || ',"segment":"' || c_mktsegment || '"}' as s, c_mktsegment as v, '{"row":{"c_custkey":' || c_custkey || case when c_nationkey <> 3 then ',"c_nationkey":' || c_nationkey else '' end || ',"c_mktsegment":"' || c_mktsegment || '"}}' as every, case when c_nationkey = 3 then 1 else 2 end::int as n from customer""")
