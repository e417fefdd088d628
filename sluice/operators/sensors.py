"""Readings against schedules: categories of time, missed readings, shift cells, nearest values, assignment histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import periods

DAY = 1440


def minutes(text: Column) -> Column:
    """Minutes of "HH:mm[:ss]", or of a number of hours; null of anything else."""
    parts = F.split(text, ":")
    clock = parts[0].try_cast("int") * 60 + parts[1].try_cast("int") + F.coalesce(F.get(parts, F.lit(2)).try_cast("double"), F.lit(0.0)) / 60
    return F.when(text.contains(":"), clock).otherwise(text.try_cast("double") * 60)


def hours(text: Column) -> Column:
    return minutes(text) / 60


def shift_hours(start: Column, end: Column, breaks: Column) -> Column:
    """Struct of gross, pause and net hours of a shift given in minutes; an end before the start is the next day's.

    breaks: array of structs (from, to) in minutes, null for none."""
    span = lambda a, b: F.when(b < a, b + DAY - a).otherwise(b - a)
    pause = F.aggregate(F.coalesce(breaks, F.array().cast("array<struct<from:double,to:double>>")), F.lit(0.0), lambda n, x: n + span(x["from"], x["to"]))
    gross = span(start, end)
    return F.struct((gross / 60).alias("gross"), (pause / 60).alias("pause"), ((gross - pause) / 60).alias("net"))


def time_category(at: Column, start: Column, end: Column, breaks: Column | None = None) -> Column:
    """before, during, break, after or none of a minute of the day against a shift in minutes; ends are inclusive.

    A shift that ends before it starts goes over midnight: minutes up to its end belong to its second day, as do
    ends of breaks before its start.  No shift: none."""
    night = end < start
    now = F.when(night & (at <= end), at + DAY).otherwise(at)
    close = F.when(night, end + DAY).otherwise(end)
    rest = F.lit(False)
    if breaks is not None:
        late = lambda m: m + F.when(night & (m < start), F.lit(DAY)).otherwise(F.lit(0))
        rest = F.coalesce(F.exists(breaks, lambda x: now.between(late(x["from"]), late(x["to"]))), F.lit(False))
    inside = F.when(rest, "break").otherwise("during")
    return F.when(start.isNull() | end.isNull() | at.isNull(), "none").when(now < start, "before").when(now > close, "after").otherwise(inside)


def hour_category(hour: Column) -> Column:
    return F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")


def hour_category_3(hour: Column) -> Column:
    """Three parts of the day, the night over midnight."""
    return F.when(hour.between(6, 13), "morning").when(hour.between(14, 21), "afternoon").otherwise("night")


def nearest_of(at: Column, candidates: list[tuple[Column, Column]]) -> Column:
    """The value whose time is nearest to `at`; of equal distances the first given, of no times null."""
    near = F.array_compact(F.array(*[F.when(t.isNotNull(), F.struct(F.abs(at - t).alias("away"), F.lit(i).alias("nth"), v.alias("value"))) for i, (t, v) in enumerate(candidates)]))
    return F.get(F.array_sort(near), F.lit(0))["value"]


def missed_readings(readings: DataFrame, keys: list[str], sequence: str, at: str, active: Column) -> DataFrame:
    """Adds `missed`: numbers left out before the next reading of the key, from 1 to 400 while active and 200 while not, no
    more than the time to it holds at 180 s (active) or 600 s a reading; other gaps are restarts and count as 0."""
    w = Window.partitionBy(*keys).orderBy(sequence, at)
    gap = F.lead(sequence).over(w) - F.col(sequence) - 1
    most, pace = F.when(active, 400).otherwise(200), F.when(active, 180).otherwise(600)
    held = F.floor((F.lead(at).over(w) - F.col(at)) / pace)
    return readings.withColumn("missed", F.coalesce(F.when((gap >= 1) & (gap <= most), F.greatest(F.lit(0), F.least(gap, held))), F.lit(0)).cast("long"))


def cells(df: DataFrame, keys: list[str], category: str, categories: list[str], kind: str, kinds: list[str], value: Column, *more: Column) -> DataFrame:
    """One pass of conditional sums: keys and a column `<category>_<kind>` for each pair, null where none fell in it."""
    each = [F.sum(F.when((F.col(category) == c) & (F.col(kind) == k), value)).alias(f"{c}_{k}") for c in categories for k in kinds]
    return df.groupBy(*keys).agg(*each, *more)


def split_days(sessions: DataFrame, start: str, end: str, most: int = 86400) -> DataFrame:
    """Sessions of over `most` seconds cut into parts of that length: start and end of the part, and `part` from 0."""
    n = F.floor(F.greatest(F.col(end) - F.col(start) - 1, F.lit(0)) / most)
    parts = sessions.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), n)))
    at = F.col(start) + F.col("part") * most
    return parts.withColumns({start: at, end: F.least(F.col(end), at + most)})


def align_to_schedule(readings: DataFrame, schedules: DataFrame, key: str, at: str, zone: str) -> DataFrame:
    """Readings with their local time and day, and the schedule of their key in force on that day (valid_from <= day <
    valid_to, a null end is open); readings without a schedule stay."""
    local = readings.withColumn("local_at", F.from_utc_timestamp(F.col(at), F.col(zone))).withColumn("local_day", F.to_date("local_at")).alias("r")
    s = schedules.alias("s")
    on = (F.col(f"r.{key}") == F.col(f"s.{key}")) & (F.col("s.valid_from") <= F.col("r.local_day")) & (F.col("s.valid_to").isNull() | (F.col("s.valid_to") > F.col("r.local_day")))
    return local.join(s, on, "left").select("r.*", *[F.col(f"s.{c}") for c in schedules.columns if c not in (key, "valid_from", "valid_to")])


def histories(changes: DataFrame, keys: list[str], value: str, at: str) -> DataFrame:
    """keys, value, valid_from, valid_to of each property: consecutive equal values are one row, the next change ends it."""
    w = Window.partitionBy(*keys).orderBy(at, value)
    fresh = changes.withColumn("__new", (F.row_number().over(w) == 1) | ~F.col(value).eqNullSafe(F.lag(value).over(w))).where("__new")
    return fresh.select(*keys, value, F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"))


def adjacent(df: DataFrame, keys: list[str], start: str, end: str, same: list[str]) -> DataFrame:
    """Merge runs of periods of a key, however long, that follow each other without a gap and agree in `same`."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    differs = ~F.col(start).eqNullSafe(F.lag(end).over(w))
    for c in same:
        differs = differs | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    run = F.sum(F.when(differs, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("__run", run).groupBy(*keys, *same, "__run").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n")).drop("__run")


def rule_scope(rules: DataFrame, members: DataFrame) -> DataFrame:
    """rule_id, worker, a, b: whom each rule covers and when.

    rules: rule_id, scope (worker, crew or all), target, a, b; members: worker, crew, a, b.  A worker rule covers its
    target, a crew rule the members of its target while they belong to it, and a blanket rule everyone while a member
    of any crew; periods are clipped and empty ones go."""
    own = rules.where("scope = 'worker'").select("rule_id", F.col("target").alias("worker"), "a", "b")
    clip = [F.greatest("r.a", "m.a").alias("a"), F.least("r.b", "m.b").alias("b")]
    r, m = rules.alias("r"), members.alias("m")
    crew = r.where("scope = 'crew'").join(m, F.col("r.target") == F.col("m.crew")).select("r.rule_id", "m.worker", *clip)
    # a blanket rule meets the crews, and each crew its members, so no side is joined without a key
    crews = members.select("crew").distinct()
    spread = rules.where("scope = 'all'").crossJoin(crews).alias("r")
    every = spread.join(m, F.col("r.crew").eqNullSafe(F.col("m.crew"))).select("r.rule_id", "m.worker", *clip)
    return periods.dealt(own.unionByName(crew).unionByName(every).where("a < b"), "worker").distinct()


def scoped(contacts: DataFrame, scope: DataFrame, level: str) -> DataFrame:
    """rule_id, level, contacts, workers: contacts (worker, at and a level column) that a rule covers, rolled up."""
    # counted by worker where the rows were dealt, so that no task gathers the workers of a rule
    c, s = periods.dealt(contacts, "worker").alias("c"), periods.dealt(scope, "worker").hint("merge").alias("s")
    on = (F.col("c.worker") == F.col("s.worker")) & (F.col("s.a") <= F.col("c.at")) & (F.col("c.at") < F.col("s.b"))
    by = ["rule_id", level]
    each = c.join(s, on).groupBy(F.col("c.worker").alias("worker"), F.col("s.rule_id").alias("rule_id"), F.col(f"c.{level}").alias(level)).agg(F.count(F.lit(1)).alias("contacts"))
    return each.groupBy(*by).agg(F.sum("contacts").alias("contacts"), F.count(F.lit(1)).alias("workers"))


def location_class(readings: DataFrame, areas: DataFrame) -> DataFrame:
    """readings (reading, worker, at, cell, class) with the class they should have, where it is another one.

    areas: worker, cell, a, b.  inside: the cell belongs to an area of the worker at that time; outside: the worker has
    areas then, elsewhere; unassigned: none."""
    held = areas.groupBy("worker", "a", "b").agg(F.collect_set("cell").alias("cells"))
    r, p = readings.alias("r"), held.alias("p")
    on = (F.col("r.worker") == F.col("p.worker")) & (F.col("p.a") <= F.col("r.at")) & (F.col("r.at") < F.col("p.b"))
    met = r.join(p, on, "left").select("r.*", F.when(F.col("p.cells").isNull(), 0).when(F.array_contains("p.cells", F.col("r.cell")), 2).otherwise(1).alias("__k"))
    best = met.groupBy(*readings.columns).agg(F.max("__k").alias("__k"))
    new = F.when(F.col("__k") == 2, "inside").when(F.col("__k") == 1, "outside").otherwise("unassigned")
    return best.select("reading", "worker", new.alias("class"), F.col("class").alias("was")).where(~F.col("class").eqNullSafe(F.col("was")))
