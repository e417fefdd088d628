"""Data quality from declared schemas, and validation outcomes as rows of a report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import tables


@dataclass(frozen=True)
class Field:
    """What a column should hold: a type, whether null may stand in it, bounds, whether values are unique."""

    name: str
    kind: str
    required: bool = False
    low: float | None = None
    high: float | None = None
    unique: bool = False


def from_schema(fields: list[Field]) -> tuple[dict[str, str], dict[str, str]]:
    """(rules whose breach drops a row, rules whose breach warns), as SQL conditions: presence, and ranges."""
    drop = {f"{f.name}_present": f"`{f.name}` is not null" for f in fields if f.required}
    warn = {}
    for f in fields:
        if f.low is not None:
            warn[f"{f.name}_low"] = f"`{f.name}` is null or `{f.name}` >= {f.low}"
        if f.high is not None:
            warn[f"{f.name}_high"] = f"`{f.name}` is null or `{f.name}` <= {f.high}"
    return drop, warn


def expect_warn(df: DataFrame, rules: dict[str, str], save: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(what save wrote and read back, rule and failures): every row is kept, and rules are counted as the rows go by.

    A rule that is null fails.  Spark takes each task's counts once, so no second pass is made; an empty frame has 0 of each."""
    seen = Observation()
    tests = [F.count_if(~F.coalesce(F.expr(x), F.lit(False))).alias(n) for n, x in rules.items()]
    kept = save(df.observe(seen, *tests))
    counts = seen.get
    return kept, df.sparkSession.createDataFrame([(n, counts[n]) for n in rules], "rule string, failures long")


def apply_schema(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Rows that break no dropping rule, with `warnings` (names of warning rules broken, unique ones among them)."""
    drop, warn = from_schema(fields)
    kept = tables.expect(df, drop).where(F.size("failed") == 0).drop("failed")
    out = tables.expect(kept, warn).withColumnRenamed("failed", "warnings")
    for f in fields:
        if f.unique:
            # values are counted before they are joined, so a common value is one row of the other side
            again = kept.where(F.col(f.name).isNotNull()).groupBy(F.col(f.name).alias("__v")).count().where("count > 1").select("__v", F.lit(True).alias("__again"))
            out = out.join(again, F.col(f.name) == F.col("__v"), "left").withColumn("warnings", F.when(F.col("__again"), F.array_append("warnings", F.lit(f"{f.name}_unique"))).otherwise(F.col("warnings"))).drop("__v", "__again")
    return out


def outcome(df: DataFrame, name: str, good: Column, found: Column, severity: str = "error") -> DataFrame:
    """One row: check, status (PASS or FAIL), severity, found; good and found are aggregates."""
    row = df.agg(good.alias("__good"), found.cast("string").alias("found"))
    return row.select(F.lit(name).alias("check"), F.when(F.col("__good"), "PASS").otherwise("FAIL").alias("status"), F.lit(severity).alias("severity"), "found")


def check_null(df: DataFrame, column: str, severity: str = "error") -> DataFrame:
    n = F.count_if(F.col(column).isNull())
    return outcome(df, f"null:{column}", n == 0, n, severity)


def check_empty(df: DataFrame, name: str, severity: str = "error") -> DataFrame:
    n = F.count(F.lit(1))
    return outcome(df, f"empty:{name}", n > 0, n, severity)


def check_schema(df: DataFrame, fields: list[Field], name: str, severity: str = "error") -> DataFrame:
    """Fails with the names of declared columns that are missing or of another type."""
    have = dict(df.dtypes)
    wrong = [f.name for f in fields if have.get(f.name) != f.kind]
    return df.sparkSession.range(1).select(F.lit(f"schema:{name}").alias("check"), F.lit("FAIL" if wrong else "PASS").alias("status"), F.lit(severity).alias("severity"), F.lit(",".join(wrong)).alias("found"))


def report(*outcomes: DataFrame) -> DataFrame:
    """All outcomes, one row each."""
    out = outcomes[0]
    for o in outcomes[1:]:
        out = out.unionByName(o)
    return out


def levels(edges: DataFrame, before: str, after: str, save, most: int = 1000) -> DataFrame:
    """node, level: the longest path of an edge table to each node, from 0 where nothing comes before; an error on a cycle.

    Each round settles the nodes all of whose predecessors are settled, and is written by `save`."""
    e = save(edges.select(F.col(before).alias("before"), F.col(after).alias("after")).where("before is not null and after is not null").distinct())
    nodes = e.select(F.col("before").alias("node")).union(e.select("after")).distinct()
    done = None
    open_ = save(nodes)
    for level in range(most):
        # edges whose beginning is still open hold their end back
        held = e.join(open_.withColumnRenamed("node", "before"), "before", "left_semi").select(F.col("after").alias("node")).distinct()
        free = save(open_.join(held, "node", "left_anti").withColumn("level", F.lit(level)))
        if free.isEmpty():
            raise ValueError("the edges hold a cycle")
        done = free if done is None else done.unionByName(free)
        open_ = save(open_.join(free, "node", "left_anti").select("node"))
        if open_.isEmpty():
            return done
    raise ValueError(f"more than {most} levels")


def at_depth(edges: DataFrame, before: str, after: str, depth: int, save) -> DataFrame:
    """root, node of the nodes that breadth-first search meets `depth` steps from each root (a node that nothing precedes)."""
    e = save(edges.select(F.col(before).alias("before"), F.col(after).alias("after")).where("before is not null and after is not null").distinct())
    roots = e.select(F.col("before").alias("node")).distinct().join(e.select(F.col("after").alias("node")), "node", "left_anti")
    now = save(roots.select(F.col("node").alias("root"), "node"))
    seen = now
    for _ in range(depth):
        step = now.join(e, now["node"] == e["before"]).select("root", F.col("after").alias("node")).distinct()
        now = save(step.join(seen, ["root", "node"], "left_anti"))
        seen = seen.unionByName(now)
    return now
