"""What a table tells of itself: statistics of every column, the least sets of columns that are keys, watermark columns."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)
_NAMING = (*_ORDERED, T.StringType, T.BooleanType, T.DecimalType, T.BinaryType)
_PLAIN = (*_NAMING, T.FloatType, T.DoubleType)


_LG = 14  # registers of a sketch are two to this power, which gives an error of 0.8 %
_ERROR = 1.04 / 2 ** (_LG / 2)


def _about(*columns: str) -> Column:
    """Approximate number of distinct rows of the columns; nulls of a single one do not count."""
    held = [F.col(f"`{c}`") for c in columns]
    h = F.xxhash64(*held)
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.when(held[0].isNotNull(), h) if len(held) == 1 else h, F.lit(_LG)))


def column_stats(df: DataFrame) -> DataFrame:
    """column_name, type, n rows, nulls, about (distinct values, approximate), lo, hi as texts; one pass over the table.

    Columns of arrays, maps and structs have counts of rows and nulls alone."""
    plain = {f.name: isinstance(f.dataType, _PLAIN) for f in df.schema}
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    one = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        about = _about(f.name) if plain[f.name] else F.lit(None).cast("long")
        ends = [text(g(c) if plain[f.name] else None) for g in (F.min, F.max)]
        one.append(F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"), F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) - F.count(c)).alias("nulls"), about.alias("about"), ends[0].alias("lo"), ends[1].alias("hi")))
    return df.agg(F.array(*one).alias("s")).select(F.inline("s"))


def keys(df: DataFrame, widest: int = 3, stats: list | None = None) -> list[tuple[str, ...]]:
    """The sets of columns, of the least size up to `widest`, whose values are distinct in every row; none for an empty table.

    Columns with nulls name no row, and measures (floating numbers) are not taken for names.  A set cannot be a key if the
    product of its columns' distinct counts stays below the rows; those left are counted approximately, fifty sets a pass, and
    only those within the error of the row count exactly.  Sets stand in the order of the table's columns.  stats: rows of column_stats, if there."""
    stats = column_stats(df).collect() if stats is None else stats  # a row a column
    n = stats[0]["n"] if stats else 0
    if not n:
        return []
    about = {r["column_name"]: r["about"] for r in stats if r["nulls"] == 0 and r["about"] and isinstance(df.schema[r["column_name"]].dataType, _NAMING)}
    slack = 1 - 3 * _ERROR
    for size in range(1, widest + 1):
        sets = []
        for some in itertools.combinations(about, size):
            most = 1
            for c in some:
                most *= about[c] * (1 + 3 * _ERROR)
            if most >= n:
                sets.append(some)
        near = []
        for lo in range(0, len(sets), 50):  # sketches of fifty sets at a time
            part = sets[lo : lo + 50]
            if size == 1:
                near += [s for s in part if about[s[0]] >= slack * n]
            else:
                row = df.agg(*[_about(*s).alias(str(i)) for i, s in enumerate(part)]).first()
                near += [s for i, s in enumerate(part) if row[i] >= slack * n]
        found = [s for s in near if df.groupBy(*[F.col(f"`{c}`") for c in s]).count().where("count > 1").isEmpty()]
        if found:
            return found
    return []


def watermarks(df: DataFrame, stats: list, names: tuple[str, ...] = ()) -> list[str]:
    """Columns that a load can go on from, best first: named ones, then timestamps and dates, then whole numbers, none with nulls.

    Of one kind the column with the most distinct values comes first, then by name."""
    kind = {f.name: f.dataType for f in df.schema}
    good = [r for r in stats if r["nulls"] == 0 and r["about"] and isinstance(kind[r["column_name"]], _ORDERED)]

    def rank(r):
        c = r["column_name"]
        named = names.index(c) if c in names else len(names)
        return named, not isinstance(kind[c], (T.TimestampType, T.TimestampNTZType, T.DateType)), -r["about"], c

    return [r["column_name"] for r in sorted(good, key=rank)]


def discover(tables: dict[str, DataFrame], widest: int = 3, names: tuple[str, ...] = ()) -> DataFrame:
    """column_stats of each table with table_name, and of each column whether it is in the table's first key and whether it is the
    best watermark.  An empty table has no key and no watermark."""
    out = None
    for name, df in tables.items():
        stats = column_stats(df)
        rows = stats.collect()
        key = next(iter(keys(df, widest, rows)), ())
        mark = next(iter(watermarks(df, rows, names)), None) if rows and rows[0]["n"] else None
        c = F.col("column_name")
        one = df.sparkSession.createDataFrame(rows, stats.schema).select(F.lit(name).alias("table_name"), "*", c.isin(*key).alias("in_key") if key else F.lit(False).alias("in_key"), (c == mark).alias("is_watermark") if mark else F.lit(False).alias("is_watermark"))
        out = one if out is None else out.unionByName(one)
    return out
