"""SQL-callable helpers as temporary SQL functions: Spark inlines their bodies, so they run inside generated code."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: The words that stand for true and for false.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")


def _unless_strict(message: str, kind: str) -> str:
    """The end of a case expression: an error where `strict`, else null."""
    return f"when strict then cast(raise_error('{message}') as {kind}) end"


FUNCTIONS = {
    "sluice_to_boolean": f"(s string, strict boolean default true) returns boolean return case when s is null then null when lower(s) in {TRUE_WORDS} then true when lower(s) in {FALSE_WORDS} then false {_unless_strict('not a boolean word', 'boolean')}",
    "sluice_number_to_boolean": f"(x double, strict boolean default true) returns boolean return case when x is null then null when not isnan(x) and abs(x) < double('infinity') then x <> 0 {_unless_strict('not a finite number', 'boolean')}",
    "sluice_is_integer": "(s string) returns boolean return case when s is null then null else s rlike '^-?[0-9]+$' and try_cast(s as int) is not null end",
    "sluice_to_decimal": f"(s string, strict boolean default true) returns decimal(38,0) return case when s is null then null when try_cast(s as decimal(38,0)) is not null then try_cast(s as decimal(38,0)) {_unless_strict('not a number', 'decimal(38,0)')}",
    "sluice_haversine_m": "(lat1 double, lon1 double, lat2 double, lon2 double) returns double return 2 * 6371000 * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))",
    "sluice_cell_distance": "(x1 bigint, y1 bigint, x2 bigint, y2 bigint) returns bigint return greatest(abs(x1 - x2), abs(y1 - y2))",
    "sluice_safe_ratio": "(a double, b double) returns double return case when b is null or b = 0 then null else a / b end",
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions callable in the session's SQL; returns their names.  A second call changes nothing."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}{body}")
    return list(FUNCTIONS)
