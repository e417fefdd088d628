"""Work calendars and attendance: weekday rules, special dates, and hours split at daily and weekly limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import periods


def hours(start: Column, end: Column, rest: Column) -> Column:
    """Hours between two times given as minutes of the day, less a rest in minutes.

    An end before its start is of the next day; nothing is left where either is null, and less than nothing is 0."""
    length = end - start + F.when(end < start, 1440).otherwise(0)
    return F.greatest(F.coalesce(length - F.coalesce(rest, F.lit(0)), F.lit(0)), F.lit(0)) / 60.0


def by_weekday(details: DataFrame, shifts: DataFrame) -> DataFrame:
    """The recurring view: shift_id, shift, weekday (1 is Sunday), start, end, rest, hours, valid_from, valid_to.

    details: shift_id, weekday or date, start, end, rest (minutes), valid_from, valid_to, deleted; shifts: shift_id, shift.  Deleted
    rows and rows of a date go; details without a shift have a null name."""
    rows = details.where(F.col("weekday").isNotNull() & F.col("date").isNull() & ~F.coalesce("deleted", F.lit(False)))
    return rows.join(shifts.hint("merge"), "shift_id", "left").select("shift_id", "shift", "weekday", "start", "end", "rest", hours(*map(F.col, ("start", "end", "rest"))).alias("hours"), "valid_from", "valid_to")


def by_date(details: DataFrame, shifts: DataFrame) -> DataFrame:
    """The view of special dates: shift_id, shift, date, start, end, rest, hours; a date with null times is a day off of 0 hours."""
    rows = details.where(F.col("date").isNotNull() & ~F.coalesce("deleted", F.lit(False)))
    return rows.join(shifts.hint("merge"), "shift_id", "left").select("shift_id", "shift", "date", "start", "end", "rest", hours(*map(F.col, ("start", "end", "rest"))).alias("hours"))


def days(details: DataFrame, shifts: DataFrame, first: str, last: str) -> DataFrame:
    """What holds on each day from first to last: shift_id, shift, day, start, end, hours, special.

    A special date takes the place of all weekday rules of its day.  A weekday rule holds from valid_from up to, not
    including, valid_to (null: without an end); a day without either has no row.  Of several rows of one kind the one that
    starts first counts, then the one that ends first."""
    span = F.sequence(F.greatest(F.col("valid_from"), F.lit(first).cast("date")), F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last).cast("date")), F.lit(last).cast("date")))
    held = by_weekday(details, shifts).where((F.coalesce("valid_from", F.lit(first).cast("date")) <= F.lit(last).cast("date")) & F.coalesce(F.col("valid_to") > F.greatest(F.col("valid_from"), F.lit(first).cast("date")), F.lit(True)))
    held = held.withColumn("valid_from", F.coalesce("valid_from", F.lit(first).cast("date")))
    weekly = held.withColumn("day", F.explode(span)).where(F.dayofweek("day") == F.col("weekday")).withColumn("special", F.lit(False))
    dated = by_date(details, shifts).withColumnRenamed("date", "day").where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).withColumn("special", F.lit(True))
    names = ["shift_id", "shift", "day", "start", "end", "hours", "special"]
    both = periods.dealt(weekly.select(names).unionByName(dated.select(names)), "shift_id", "day")  # days pack well, and are sorted unpacked
    first_one = Window.partitionBy("shift_id", "day").orderBy(F.desc("special"), F.asc_nulls_last("start"), F.asc_nulls_last("end"))
    return both.withColumn("__n", F.row_number().over(first_one)).where("__n = 1").drop("__n")


def split_hours(worked: DataFrame, worker: str, start: str, end: str, order: list, daily: float | None = 8.0, weekly: float | None = 40.0) -> DataFrame:
    """worked with `hours`, `regular` and `overtime`: hours beyond the day's limit, then those beyond the week's, are overtime.

    Hours run on within a worker's day (that of the start) and week (from Monday) in the given order, and a period that crosses a
    limit is split there; only hours within the daily limit use up the weekly one.  A limit of None is none; a null start or
    end, or an end not after its start, is 0 hours."""
    length = F.greatest(F.coalesce((F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))) / 3.6e9, F.lit(0.0)), F.lit(0.0))
    rows = worked.withColumns({"hours": length, "__day": F.to_date(start), "__week": F.date_trunc("week", start)})

    def within(df: DataFrame, source: str, target: str, limit: float | None, by: str) -> DataFrame:
        if limit is None:
            return df.withColumn(target, F.col(source))
        w = Window.partitionBy(worker, by).orderBy(start, *order).rowsBetween(Window.unboundedPreceding, -1)
        left = F.lit(float(limit)) - F.coalesce(F.sum(source).over(w), F.lit(0.0))
        return df.withColumn(target, F.greatest(F.least(F.col(source), left), F.lit(0.0)))

    rows = within(within(rows, "hours", "__daily", daily, "__day"), "__daily", "regular", weekly, "__week")
    return rows.withColumn("overtime", F.col("hours") - F.col("regular")).drop("__day", "__week", "__daily")


def attendance(worked: DataFrame, worker: str, start: str, end: str, order: list, daily: float | None = 8.0, weekly: float | None = 40.0) -> DataFrame:
    """worker, day, first_start, last_end, entries, regular, overtime."""
    rows = split_hours(worked, worker, start, end, order, daily, weekly)
    return rows.groupBy(worker, F.to_date(start).alias("day")).agg(F.min(start).alias("first_start"), F.max(end).alias("last_end"), F.count(F.lit(1)).alias("entries"), F.sum("regular").alias("regular"), F.sum("overtime").alias("overtime"))
