"""Table mutation without a transactional format: every operation makes the new snapshot of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(target: DataFrame, source: DataFrame, keys: list[str], changed: Column | None = None) -> DataFrame:
    """New snapshot with `action` (inserted, updated, unchanged, kept) by row.

    changed: a condition over t.* and s.* that lets a matched row be updated; by default any column that differs."""
    values = [c for c in target.columns if c not in keys]
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = source.withColumn("__s", F.lit(True)).alias("s")
    both = t.join(s, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "full")
    if changed is None:
        changed = F.lit(False)
        for c in values:
            changed = changed | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    action = F.when(F.col("t.__t").isNull(), "inserted").when(F.col("s.__s").isNull(), "kept").when(changed, "updated").otherwise("unchanged")
    new = F.col("action").isin("inserted", "updated")
    pick = [F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in values]
    return both.withColumn("action", action).select(*[F.coalesce(f"t.{k}", f"s.{k}").alias(k) for k in keys], *pick, "action")


def moved(columns: dict[str, float]) -> Column:
    """True where any numeric column of s differs from t by more than its tolerance, or its null-ness flipped."""
    out = F.lit(False)
    for c, tolerance in columns.items():
        a, b = F.col(f"t.{c}"), F.col(f"s.{c}")
        out = out | (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > tolerance, F.lit(False))
    return out


def scd1(changes: DataFrame, keys: list[str], sequence: str, deleted: Column) -> DataFrame:
    """Latest row of each key by sequence, without keys whose latest change is a delete."""
    rest = [c for c in changes.columns if c not in keys]
    top = changes.withColumn("__deleted", deleted).groupBy(*keys).agg(F.max_by(F.struct(*rest, "__deleted"), F.col(sequence)).alias("r"))
    return top.where("not r.__deleted").select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def scd2(changes: DataFrame, keys: list[str], sequence: str, deleted: Column, track: list[str]) -> DataFrame:
    """Version rows (keys, track, start_at, end_at): a version begins when a tracked column changes; a delete closes it."""
    w = Window.partitionBy(*keys).orderBy(sequence)
    marked = changes.withColumn("__del", deleted)
    differs = F.row_number().over(w) == 1
    for c in [*track, "__del"]:
        differs = differs | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    starts = marked.withColumn("__new", differs).where("__new")
    versions = starts.withColumn("end_at", F.lead(sequence).over(w)).where("not __del")
    return versions.select(*keys, *track, F.col(sequence).alias("start_at"), "end_at")


def as_of(versions: DataFrame, at) -> DataFrame:
    """Versions in force at a point of the sequence."""
    return versions.where((F.col("start_at") <= at) & (F.col("end_at").isNull() | (F.col("end_at") > at)))


def expect(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Adds `failed`: names of the rules (SQL conditions) that are not true; null counts as failing."""
    tests = [F.when(~F.coalesce(F.expr(x), F.lit(False)), F.lit(n)) for n, x in rules.items()]
    return df.withColumn("failed", F.array_compact(F.array(*tests)))


def expect_or_fail(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The frame itself, whose evaluation raises an error at the first row that breaks a rule."""
    out = df
    for n, x in rules.items():
        out = out.where(F.coalesce(F.expr(x), F.lit(False)) | F.raise_error(F.lit(f"expectation failed: {n}")).cast("boolean"))
    return out


def rule_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """rule, failures: all rules counted in one pass."""
    one = df.agg(*[F.count_if(~F.coalesce(F.expr(x), F.lit(False))).alias(n) for n, x in rules.items()])
    return one.unpivot([], list(rules), "rule", "failures")


def new_rows(df: DataFrame, watermark: Column, last) -> DataFrame:
    """Rows above the last watermark, or all for a first load."""
    return df if last is None else df.where(watermark > F.lit(last))


def enrich(df: DataFrame, lookups: list[tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Left joins with lookups (frame, key, columns to take), each of one row a key; `stalled` names the keys that a row
    has and a lookup has not."""
    out, missing = df, []
    for i, (dim, key, columns) in enumerate(lookups):
        one = dim.select(key, *columns).dropDuplicates([key]).withColumn(f"__hit{i}", F.lit(True))
        out = out.join(one, key, "left")
        missing.append(F.when(F.col(key).isNotNull() & F.col(f"__hit{i}").isNull(), F.lit(key)))
    out = out.withColumn("stalled", F.array_compact(F.array(*missing)))
    return out.drop(*[f"__hit{i}" for i in range(len(lookups))])


def two_phase(target: DataFrame, source: DataFrame, keys: list[str], scope: str) -> DataFrame:
    """New snapshot: within the scopes that the source touches its rows replace all others; other scopes stay as they are.

    Rows of the target with a touched scope and a key that the source lacks go; `action` says what became of a row."""
    touched = source.select(scope).distinct().withColumn("__touched", F.lit(True))
    merged = merge(target, source, keys).join(touched, scope, "left")
    return merged.where("not (action = 'kept' and coalesce(__touched, false))").drop("__touched")


def assignments(df: DataFrame, worker: Column, kind: str, value: Column, start: Column, end: Column, as_of) -> DataFrame:
    """worker, kind, value, valid_from of the assignments in force: valid_from <= as_of < valid_to, a null end is open."""
    rows = df.select(worker.alias("worker"), F.lit(kind).alias("kind"), value.cast("string").alias("value"), start.alias("valid_from"), end.alias("valid_to"))
    return rows.where((F.col("valid_from") <= as_of) & (F.col("valid_to").isNull() | (F.col("valid_to") > as_of))).drop("valid_to")
