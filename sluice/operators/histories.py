"""Histories and snapshots: rows that wait for a lookup and are tried again, periods that cover a time, levels of
managers by slice of time, and the views of dimensions and assignments made of them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import periods, tables


@dataclass(frozen=True)
class Lookup:
    """A dimension of one row a key: `source` names the rows' own column, `key` the dimension's, `take` what it adds.

    A required one must be found.  An optional one must be found where the row has a key, and may be missed where not."""

    dim: DataFrame
    source: str
    key: str
    take: tuple[str, ...] = field(default_factory=tuple)
    required: bool = True


def load(fresh: DataFrame, waiting: DataFrame | None, keys: list[str], lookups: list[Lookup], retry: Column | None = None) -> DataFrame:
    """One run of a load: fresh rows, and those that wait from runs before, met with their lookups.

    Adds what the lookups take, `missed` (source columns whose lookup failed, empty where the row is ready) and
    `waited`.  Rows with an empty `missed` go on; the others are the new table of waiting rows, which so loses those
    that are now found.  A fresh row takes the place of a waiting one of its keys (null keys are equal); of several
    waiting rows of one key all stay.  retry: waiting rows for which it is not true are left waiting unasked, with
    `missed` of "retry".  Where a dimension has a key twice, the row with the greatest values is taken.  Columns
    of fresh that bear a name of the added ones are replaced."""
    rows = fresh.withColumn("waited", F.lit(False))
    if waiting is not None:
        mine = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
        left = waiting.select(*fresh.columns).join(mine, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")
        rows = rows.unionByName(left.withColumn("waited", F.lit(True)))
    out, taken = _meet(rows, lookups)
    missing = [F.when(F.col(f"__found{i}").isNull() & (F.lit(True) if x.required else F.col(x.source).isNotNull()), F.lit(x.source)) for i, x in enumerate(lookups)]
    missed = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
    if retry is not None:
        missed = F.when(F.col("waited") & ~F.coalesce(retry, F.lit(False)), F.array(F.lit("retry"))).otherwise(missed)
    own = [c for c in fresh.columns if c not in {"missed", "waited", *(n for x in lookups for n in x.take)}]
    return out.select(*own, *taken, missed.alias("missed"), "waited")


def named(df: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """df with what each lookup takes, null where it is not found: the joins of a view, which drops nothing.

    Columns of df that bear a taken name are replaced."""
    out, taken = _meet(df, lookups)
    return out.select(*[c for c in df.columns if c not in {n for x in lookups for n in x.take}], *taken)


def _meet(rows: DataFrame, lookups: list[Lookup]) -> tuple[DataFrame, list[Column]]:
    """rows beside a struct __found<i> for each lookup, null where it has no row, and the columns taken from them."""
    out = rows
    for i, one in enumerate(lookups):
        found = F.max(F.struct(*[F.col(c) for c in one.take], F.lit(True).alias("__hit"))).alias(f"__found{i}")
        dim = one.dim.where(F.col(one.key).isNotNull()).groupBy(F.col(one.key).alias(f"__key{i}")).agg(found)
        out = out.join(dim, F.col(one.source) == F.col(f"__key{i}"), "left")
    return out, [F.col(f"__found{i}")[c].alias(c) for i, x in enumerate(lookups) for c in x.take]


def covering(df: DataFrame, spans: DataFrame, row: list[str], keys: list[str], at: str, start: str, end: str, width: int, take: list[str]) -> DataFrame:
    """Every row of df with `take` of the span of its keys that holds its time (start <= at < end, a null end is open);
    of several that begin last, of those with the greatest values; nulls where none does.

    row: columns that tell df's rows apart.  df and spans meet by key and bucket of `width`, so a very common key is
    spread over its buckets; spans are first cut to the times that df has, so an open one takes no more buckets than
    those.  Times are whole numbers; null keys are equal; a null time or start meets nothing."""
    ends = df.agg(F.min(at).alias("__lo"), F.max(at).alias("__hi"))
    # ends is one row
    named = spans.select(*keys, F.col(start).alias("__start"), F.col(end).alias("__end"), *[F.col(c).alias(f"__{c}") for c in take])
    cut = named.crossJoin(F.broadcast(ends)).where("__start <= __hi and (__end is null or (__end > __lo and __end > __start))")
    last = F.least(F.coalesce(F.col("__end") - 1, F.col("__hi")), F.col("__hi"))
    cut = cut.withColumn("__bucket", F.explode(F.sequence(F.floor(F.greatest("__start", "__lo") / width), F.floor(last / width)))).alias("s")
    rows = df.withColumn("__bucket", F.floor(F.col(at) / width)).alias("r")
    held = (F.col(f"r.{at}") >= F.col("s.__start")) & (F.col("s.__end").isNull() | (F.col(f"r.{at}") < F.col("s.__end")))
    met = rows.join(cut, [*[F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], F.col("r.__bucket") == F.col("s.__bucket"), held], "left")
    best = F.max(F.when(F.col("s.__start").isNotNull(), F.struct("s.__start", *[F.col(f"s.__{c}").alias(c) for c in take]))).alias("__best")
    rest = [c for c in df.columns if c not in row]
    one = met.groupBy(*[F.col(f"r.{c}").alias(c) for c in row]).agg(*[F.first(f"r.{c}").alias(c) for c in rest], best)
    return one.select(*df.columns, *[F.col(f"__best.{c}").alias(c) for c in take])


def close_periods(df: DataFrame, keys: list[str], start: str, end: str, tie: list[str]) -> DataFrame:
    """Periods of a key, each closed by its own end or, without one, by the next start; `current` marks the open ones
    and `days` counts the days of the closed.  Of rows that begin together the one with the greatest `tie` stays; rows
    without a start go."""
    top = Window.partitionBy(*keys, start).orderBy(*[F.col(c).desc() for c in tie])
    one = df.where(F.col(start).isNotNull()).withColumn("__nth", F.row_number().over(top)).where("__nth = 1").drop("__nth")
    own = F.coalesce(F.col(end), F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))
    return one.withColumn(end, own).withColumns({"current": F.col(end).isNull(), "days": F.datediff(end, start)})


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`, by partial maxima before the shuffle; nulls come before all values."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c).alias(f"__{c}") for c in order], *rest)).alias("__top"))
    return top.select(*[F.col(c) if c in keys else F.col(f"__top.{c}") for c in df.columns])


def alias_groups(source: Column, groups: dict[int, tuple[int, ...]]) -> Column:
    """The id that stands for a source: that of the group that holds it, or its own."""
    out = None
    for to, members in groups.items():
        out = (F if out is None else out).when(source.isin(*members), F.lit(to))
    return source if out is None else out.otherwise(source)


#: Sources that share their ids, under the id of the source that stands for them.
SOURCE_GROUPS = {15: (14, 15, 16, 17, 18, 19), 2: (1, 2, 11, 12)}


def levels_by_slice(ways: DataFrame, child: str, ancestor: str, start: str, end: str, level: str, most: int = 12) -> DataFrame:
    """child, start, end, levels and level_0 .. level_<most>: the ancestor of each level in every slice of time in which
    none of them changes.

    ways: (child, ancestor, [start, end), level from 1); level_0 is the child itself, `levels` the highest level held,
    0 in a gap.  Of several ancestors of one level the greatest is taken."""
    cuts = periods.slices(ways, [child], start, end).alias("s")
    on = (F.col(f"s.{child}") == F.col(f"w.{child}")) & (F.col(f"w.{start}") <= F.col(f"s.{start}")) & (F.col(f"w.{end}") >= F.col(f"s.{end}"))
    met = cuts.join(ways.alias("w"), on, "left").select(f"s.{child}", f"s.{start}", f"s.{end}", F.col(f"w.{level}").alias("__level"), F.col(f"w.{ancestor}").alias("__up"))
    each = [F.max(F.when(F.col("__level") == n, F.col("__up"))).alias(f"level_{n}") for n in range(1, most + 1)]
    wide = met.groupBy(child, start, end).agg(F.coalesce(F.max("__level"), F.lit(0)).alias("levels"), *each)
    return wide.select(child, start, end, "levels", F.col(child).alias("level_0"), *[f"level_{n}" for n in range(1, most + 1)])


def merge_snapshots(old: DataFrame, new: DataFrame, keys: list[str], touched: DataFrame, scope: list[str]) -> DataFrame:
    """The next snapshot, with `action`: inserted, updated, unchanged, kept.

    touched: the scopes looked at in this run.  New rows of other scopes are not taken; old rows of a touched scope that
    are no longer made go, also where the scope has no row left; all other old rows stay."""
    mine = touched.select(*scope).distinct()
    merged = tables.merge(old, new.join(mine, scope, "left_semi"), keys)
    seen = mine.withColumn("__touched", F.lit(True))
    return merged.join(seen, scope, "left").where("not (action = 'kept' and coalesce(__touched, false))").select(*merged.columns)
