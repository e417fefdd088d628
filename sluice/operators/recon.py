"""Reconciliation of two versions of a table: row hashes, null-safe joins, thresholds, aggregates, schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NULL_MARK, SEPARATOR = "_null_recon_", "\u0001"

# Source types and the Spark types that hold them
TYPE_EQUIVALENTS = {
    "varchar": "string", "nvarchar": "string", "char": "string", "nchar": "string", "text": "string", "clob": "string",
    "number": "decimal", "numeric": "decimal", "decimal": "decimal", "float": "double", "real": "double",
    "bit": "boolean", "boolean": "boolean", "tinyint": "smallint", "smallint": "smallint", "int": "int", "integer": "int", "bigint": "bigint",
    "date": "date", "datetime": "timestamp", "datetime2": "timestamp", "timestamp": "timestamp", "time": "timestamp",
    "timestamp_ntz": "timestamp_ntz", "timestamp_ltz": "timestamp", "timestamp_tz": "timestamp",
    "binary": "binary", "varbinary": "binary", "variant": "variant", "object": "string", "array": "array<string>", "geography": "string",
}


@dataclass(frozen=True)
class ReconSpec:
    """A table pair: keys, compared columns, target renames, transforms (SQL by column) and filters per side."""

    keys: tuple[str, ...]
    columns: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    transforms: dict[str, str] = field(default_factory=dict)
    source_filter: str | None = None
    target_filter: str | None = None


#: What an empty date or time counts as where sentinels are asked for.
SENTINELS = {"date": "1900-01-01", "timestamp": "1900-01-01 00:00:00", "timestamp_ntz": "1900-01-01 00:00:00"}


def text_of(df: DataFrame, name: str, sentinels: bool = False, compat: bool = False) -> Column:
    """A column as exact text, trimmed; arrays sorted, as JSON.  Null, and only null, is NULL_MARK.

    compat: arrays are joined by commas, so nulls in them vanish and a comma in a value looks like two values.

    Nothing is rounded: a tolerance or a coarser form is a transform of its column.  sentinels: null dates and times count
    as their sentinel, so two systems that store one or the other agree."""
    kind = dict(df.dtypes)[name]
    c = F.col(f"`{name}`")
    if kind.startswith("array"):
        c = F.sort_array(c.cast("array<string>"))
        c = F.concat_ws(",", c) if compat else F.to_json(c)
    mark = SENTINELS.get(kind, NULL_MARK) if sentinels else NULL_MARK
    return F.coalesce(F.when(F.col(f"`{name}`").isNotNull(), F.trim(c.cast("string"))), F.lit(mark))


def prepare(df: DataFrame, spec: ReconSpec, target: bool = False) -> DataFrame:
    """Filter, rename to source names, transform, and keep keys and compared columns of one side."""
    where = spec.target_filter if target else spec.source_filter
    df = df.where(where) if where else df
    df = df.withColumnsRenamed(spec.renames) if target else df
    df = df.withColumns({c: F.expr(x) for c, x in spec.transforms.items()})
    wanted = spec.columns or tuple(df.columns)
    return df.select(*spec.keys, *[c for c in wanted if c not in spec.keys and c not in spec.drop])


def row_hash(df: DataFrame, columns: list[str] | None = None, kind: str = "sha2", compat: bool = False, sentinels: bool = False) -> Column:
    """Hash of the sorted columns' texts; a separator keeps ("ab", "c") and ("a", "bc") apart, and arrays are exact, unless compat."""
    texts = [text_of(df, c, sentinels, compat) for c in sorted(columns or df.columns)]
    joined = F.concat(*texts) if compat else F.concat_ws(SEPARATOR, *texts)
    return F.sha2(joined, 256) if kind == "sha2" else F.md5(joined)


def _both(source: DataFrame, target: DataFrame, keys, how: str = "full") -> DataFrame:
    s, t = source.alias("s"), target.alias("t")
    on = [F.col(f"s.`{k}`").eqNullSafe(F.col(f"t.`{k}`")) for k in keys]
    return s.join(t, on, how)


def classify(source: DataFrame, target: DataFrame, spec: ReconSpec) -> DataFrame:
    """keys, status (match, mismatch, missing_in_target, missing_in_source) of every key of either side."""
    s, t = prepare(source, spec), prepare(target, spec, True)
    s, t = (x.select(*spec.keys, row_hash(x).alias("h")) for x in (s, t))
    status = F.when(F.col("t.h").isNull(), "missing_in_target").when(F.col("s.h").isNull(), "missing_in_source").when(F.col("s.h") == F.col("t.h"), "match").otherwise("mismatch")
    return _both(s, t, spec.keys).select(*[F.coalesce(f"s.{k}", f"t.{k}").alias(k) for k in spec.keys], status.alias("status"))


def classify_rows(source: DataFrame, target: DataFrame, spec: ReconSpec) -> DataFrame:
    """Multiset difference of whole rows by hash: h, in_source, in_target where the counts differ."""
    s, t = (x.select(row_hash(x).alias("h")) for x in (prepare(source, spec), prepare(target, spec, True)))
    both = s.select("h", F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(t.select("h", F.lit(0).alias("a"), F.lit(1).alias("b")))
    return both.groupBy("h").agg(F.sum("a").alias("in_source"), F.sum("b").alias("in_target")).where("in_source != in_target")


def column_matches(source: DataFrame, target: DataFrame, spec: ReconSpec) -> DataFrame:
    """For keys on both sides: <c>_base, <c>_compare, <c>_match of each compared column; column sets must agree."""
    s, t = prepare(source, spec), prepare(target, spec, True)
    if set(s.columns) != set(t.columns):
        raise ValueError(f"columns differ: {sorted(set(s.columns) ^ set(t.columns))}")
    out = [F.col(f"s.`{k}`").alias(k) for k in spec.keys]
    for c in s.columns:
        if c not in spec.keys:
            a, b = F.col(f"s.`{c}`"), F.col(f"t.`{c}`")
            out += [a.alias(f"{c}_base"), b.alias(f"{c}_compare"), F.coalesce(a == b, F.lit(False)).alias(f"{c}_match")]
    return _both(s, t, spec.keys, "inner").select(*out)


def mismatch_counts(matches: DataFrame) -> DataFrame:
    """column, mismatches: one aggregate over a column_matches frame, in long form."""
    names = [c[: -len("_match")] for c in matches.columns if c.endswith("_match")]
    one = matches.agg(*[F.count_if(~F.col(f"{c}_match")).alias(c) for c in names])
    return one.unpivot([], names, "column", "mismatches")


def threshold(source: Column, target: Column, low: float, high: float, kind: str = "absolute") -> Column:
    """Match, Warning or Failed for a pair of values; kind is absolute, percentage or datetime (seconds)."""
    if kind == "datetime":
        d = F.unix_timestamp(source) - F.unix_timestamp(target)
        d = F.coalesce(d, F.lit(0))
    else:
        d = F.coalesce(source, F.lit(0)) - F.coalesce(target, F.lit(0))
    shown = d
    if kind == "percentage":
        shown = d / F.when(F.coalesce(target, F.lit(0)) == 0, F.lit(1)).otherwise(target) * 100
    return F.when(d == 0, "Match").when(shown.between(low, high), "Warning").otherwise("Failed")


def aggregate_compare(source: DataFrame, target: DataFrame, groups: list[str], rules: dict[str, Column], strict_nulls: bool = True) -> DataFrame:
    """groups, rule, source_value, target_value, status for each rule; groups join null-safely, none means one row.

    Values are compared in the rule's own type and shown as text; status is match, mismatch, missing_in_source or
    missing_in_target.  Without strict_nulls an aggregate that is null on one side is no mismatch."""
    s, t = (x.groupBy(*groups).agg(*[f.alias(n) for n, f in rules.items()]).withColumn("there", F.lit(True)) for x in (source, target))
    both = _both(s, t, groups) if groups else s.alias("s").crossJoin(t.alias("t"))  # one row each

    def item(n):
        a, b = F.col(f"s.{n}"), F.col(f"t.{n}")
        same = a.eqNullSafe(b) if strict_nulls else F.coalesce(a == b, F.lit(True))
        status = F.when(F.col("t.there").isNull(), "missing_in_target").when(F.col("s.there").isNull(), "missing_in_source").when(same, "match").otherwise("mismatch")
        return F.struct(F.lit(n).alias("rule"), a.cast("string").alias("source_value"), b.cast("string").alias("target_value"), status.alias("status"))

    return both.select(*[F.coalesce(f"s.{g}", f"t.{g}").alias(g) for g in groups], F.inline(F.array(*[item(n) for n in rules])))


#: The kinds of aggregate rules.
AGGREGATES = {
    "min": F.min, "max": F.max, "count": F.count, "sum": F.sum, "avg": F.avg, "mean": F.avg,
    "mode": lambda c: F.mode(c, deterministic=True), "stddev": F.stddev, "variance": F.variance, "median": F.median,
}


def aggregate_rules(rules: list[tuple[str, str]]) -> dict[str, Column]:
    """Named aggregates of (kind, column) rules; a rule given twice is one."""
    return {f"{kind}_{column}": AGGREGATES[kind](column) for kind, column in dict.fromkeys(rules)}


def schema_compare(source: DataFrame | list[tuple[str, str]], target: DataFrame) -> DataFrame:
    """source_column, source_type, target_type, is_valid: the columns of a frame, or declared (name, type) pairs, against
    a frame's schema, by lower-cased name."""
    declared = source if isinstance(source, list) else source.dtypes
    have = {c.lower(): t for c, t in target.dtypes}

    def fits(kind: str, there: str) -> bool:
        base, _, args = kind.lower().partition("(")
        want = TYPE_EQUIVALENTS.get(base.strip(), base.strip())
        if want == "decimal" and args:
            p, _, sc = args.rstrip(")").partition(",")
            want = f"decimal({int(p)},{int(sc or 0)})"
        return want == there

    rows = [(c.lower(), t.lower(), have.get(c.lower(), "Unknown"), fits(t, have.get(c.lower(), "Unknown"))) for c, t in declared]
    return target.sparkSession.createDataFrame(rows, "source_column string, source_type string, target_type string, is_valid boolean")


def metrics(classified: DataFrame) -> DataFrame:
    """One row of counts by status."""
    names = ("match", "mismatch", "missing_in_source", "missing_in_target")
    return classified.agg(*[F.count_if(F.col("status") == n).alias(n) for n in names])


def table_status(counts: DataFrame, total: Column, absolute: float | None = None, percent: float | None = None) -> DataFrame:
    """Adds `passed`: mismatches within an absolute bound or a percentage of the source rows (the last rule given wins)."""
    bad = F.col("mismatch")
    ok = bad == 0
    if absolute is not None:
        ok = bad <= absolute
    if percent is not None:
        ok = bad * 100 <= percent * total
    return counts.withColumn("passed", ok)


def hash_sample(df: DataFrame, key: Column, modulus: int, below: int) -> DataFrame:
    """A sample that both sides repeat: rows whose integer key falls in a residue range."""
    return df.where(F.pmod(key, F.lit(modulus)) < below)


def sample_random(df: DataFrame, n: int, total: int, seed: int = 100) -> DataFrame:
    """About n rows (held to 50..400) of `total`, at most that many."""
    n = max(50, min(400, n))
    return df.sample(fraction=min(1.0, 1.2 * n / max(total, 1)), seed=seed).limit(n)


def sample_stratified(df: DataFrame, columns: list[str], buckets: int, fraction: float, seed: int = 100) -> DataFrame:
    """A proportional sample over hash buckets of the columns; buckets are held to 2..50."""
    k = max(2, min(50, buckets))
    marked = df.withColumn("__bucket", F.pmod(F.abs(F.hash(*columns)), F.lit(k)))
    return marked.sampleBy("__bucket", {i: fraction for i in range(k)}, seed).drop("__bucket")


def details(df: DataFrame, kind: str, most: int = 50) -> DataFrame:
    """recon_type, data (array of string maps) of at most `most` sample rows."""
    cells = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))])
    return df.limit(most).select(cells.alias("m")).agg(F.lit(kind).alias("recon_type"), F.collect_list("m").alias("data"))


def explode_details(rows: DataFrame) -> DataFrame:
    """recon_type, rn, key, value: details arrays as long rows."""
    per = rows.select("recon_type", F.posexplode("data").alias("rn", "m"))
    return per.select("recon_type", (F.col("rn") + 1).alias("rn"), F.explode("m").alias("key", "value"))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
