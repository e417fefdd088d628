"""Dense numbers over whole tables without one window for all rows: ranges, places within a range, and offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PLACE = (1 << 33) - 1  # what monotonically_increasing_id counts within a partition; the partition's number stands above


def numbered(df: DataFrame, by: list, name: str, save: Callable[[DataFrame], DataFrame], partitions: int | None = None) -> DataFrame:
    """df with `name`, 1 to n in the order of `by`; equal rows are numbered in an order of their own.

    Rows are dealt out by ranges of `by` and sorted there; save writes them with their places, once, so that numbers hang on
    nothing that a repeated task could change.  The sizes of the ranges (a row a partition) are summed on the driver."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = save(df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()))
    sizes = held.groupBy(F.shiftright("__at", 33).alias("part")).count().orderBy("part").collect()
    offsets, before = [], 0
    for r in sizes:
        offsets.append((r["part"], before))
        before += r["count"]
    start = spark.createDataFrame(offsets, "__part long, __before long")  # a row a partition
    placed = held.join(F.broadcast(start), F.shiftright("__at", 33) == F.col("__part"))
    return placed.withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(F.lit(_PLACE)) + 1).drop("__at", "__part", "__before")


def surrogate_keys(df: DataFrame, columns: list[str], name: str, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The distinct values of the columns, nulls among them first, with dense ids from 1 in their order."""
    return numbered(df.select(*columns).distinct(), [F.asc_nulls_first(c) for c in columns], name, save)
