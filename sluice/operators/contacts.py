"""Contacts: readings of different workers near each other in space and time, and rules with wildcards for them."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import periods

#: Half of a cell's neighbourhood in time and plane, itself first: every pair of cells next to each other meets once.
_HALF = [(0, 0, 0)] + [o for o in itertools.product((-1, 0, 1), repeat=3) if o > (0, 0, 0)]
_METRES_A_DEGREE = math.pi * 6_371_000 / 180


def _cells(r: DataFrame, reach: float, sphere: bool) -> tuple[Column, Column, int | None]:
    """Columns of a grid whose cells are `reach` wide at least, and the number of cells round the globe."""
    if not sphere:
        return F.floor(F.col("x") / reach), F.floor(F.col("y") / reach), None
    # the widest parallel that matters is that farthest from the equator
    far = r.agg(F.max(F.abs("y")).alias("far")).first()["far"] or 0.0
    high = reach * 1.000001 / _METRES_A_DEGREE
    n = int(360 / (high / math.cos(math.radians(min(far + high, 89.999)))))
    if far > 89 or n < 3:
        raise ValueError(f"no grid of {reach} m at latitude {far}")
    return F.least(F.floor((F.col("x") + 180) / (360 / n)), F.lit(n - 1)), F.floor(F.col("y") / high), n


def pairs(readings: DataFrame, worker: str, at: str, place: list[str], within: float, reach: float, zone: str | None = None, active: str | None = None, sphere: bool = False) -> DataFrame:
    """Readings of two workers at equal `place` columns, at most `within` seconds and `reach` apart, once for each of the two.

    readings: worker, at (timestamp), place columns, x, y (longitude and latitude in degrees where sphere is set, and
    reach then in metres; latitudes beyond 89 degrees are refused).  Rows: place columns, worker, other, at (of the other), zone (of
    the worker), active (of the other), distance.  Rows with a null in worker, at, place, x or y meet nobody; equal readings
    of a worker are one, with the largest zone and active.  A reading meets those in 14 cells of place, time and plane, and
    the other half is the same pairs turned round."""
    named = lambda c: F.lit(None) if c is None else F.col(c)
    r = readings.select(*place, F.col(worker).alias("worker"), F.unix_micros(F.col(at).cast("timestamp")).alias("t"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), named(zone).alias("zone"), named(active).alias("active"))
    r = r.dropna(subset=[*place, "worker", "t", "x", "y"]).groupBy(*place, "worker", "t", "x", "y").agg(F.max("zone").alias("zone"), F.max("active").alias("active"))
    wide = max(1, math.ceil(within * 1_000_000))
    gx, gy, around = _cells(r, reach, sphere)
    r = r.withColumns({"gt": F.floor(F.col("t") / wide), "gx": gx, "gy": gy})
    turn = (lambda c: F.pmod(c, F.lit(around))) if around else (lambda c: c)
    steps = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip("tij", o)]) for o in _HALF])
    a = r.withColumn("s", F.explode(steps)).withColumns({"gt": F.col("gt") + F.col("s.t"), "gx": turn(F.col("gx") + F.col("s.i")), "gy": F.col("gy") + F.col("s.j")})
    same = F.col("s.t").eqNullSafe(0) & (F.col("s.i") == 0) & (F.col("s.j") == 0)
    own = ["worker", "t", "x", "y", "zone", "active"]
    a = a.select(*place, "gt", "gx", "gy", same.alias("same"), *[F.col(c).alias(f"a_{c}") for c in own])
    b = r.select(*place, "gt", "gx", "gy", *[F.col(c).alias(f"b_{c}") for c in own])
    apart = periods.haversine_m(*map(F.col, ("a_y", "a_x", "b_y", "b_x"))) if sphere else F.sqrt(F.expr("(a_x - b_x) * (a_x - b_x) + (a_y - b_y) * (a_y - b_y)"))
    # merged, not broadcast: readings are as long as the feed, however small their file is; and dealt out in full, as each meets many
    cell = [*place, "gt", "gx", "gy"]
    met = periods.dealt(a, *cell).join(periods.dealt(b, *cell).hint("merge"), cell).where("a_worker <> b_worker and (not same or a_worker < b_worker)")
    met = met.where(F.abs(F.col("a_t") - F.col("b_t")) <= within * 1_000_000).withColumn("distance", apart).where(F.col("distance") <= reach)
    side = lambda one, two: F.struct(F.col(f"{one}_worker").alias("worker"), F.col(f"{two}_worker").alias("other"), F.timestamp_micros(f"{two}_t").alias("at"), F.col(f"{one}_zone").alias("zone"), F.col(f"{two}_active").alias("active"))
    return met.select(*place, F.explode(F.array(side("a", "b"), side("b", "a"))).alias("p"), "distance").select(*place, "p.*", "distance")


def aggregate(met: DataFrame, place: list[str]) -> DataFrame:
    """place, worker, other, first_at, zone, contacts, duration, mean_distance of pairs().

    First the readings of the other worker are counted once each, at their least distance, then summed."""
    by = [*place, "worker", "other"]
    once = met.groupBy(*by, "at").agg(F.max("zone").alias("zone"), F.max("active").alias("active"), F.min("distance").alias("distance"))
    return once.groupBy(*by).agg(F.min("at").alias("first_at"), F.max("zone").alias("zone"), F.count(F.lit(1)).alias("contacts"), F.sum("active").alias("duration"), F.avg("distance").alias("mean_distance"))


def wildcard_join(facts: DataFrame, rules: DataFrame, columns: list[str], small: int = 100_000) -> DataFrame:
    """Facts with every rule whose `columns` equal the fact's or are null; facts' columns, then the rules' others.

    Rules are parted by which of the columns are null, and each part is one equi-join on the rest: a null in a rule matches all, a
    null in a fact only a null in the rule.  A part of at most `small` rules, counted before, is broadcast; a larger one
    is joined by shuffle, and rules that are null throughout meet the facts over salts."""
    spark, rest = facts.sparkSession, [c for c in rules.columns if c not in columns]
    bits = [F.when(F.col(c).isNull(), 0).otherwise(1) for c in columns]
    marked = rules.withColumn("__part", sum((b * 2**i for i, b in enumerate(bits)), F.lit(0)))
    parts = {r["__part"]: r["count"] for r in marked.groupBy("__part").count().collect()}  # 2 ^ columns at most
    out = facts.join(marked.select(*rest).limit(0), F.lit(False)) if not parts else None
    for part, n in sorted(parts.items()):
        keys = [c for i, c in enumerate(columns) if part >> i & 1]
        some = marked.where(F.col("__part") == part).select(*keys, *rest)
        left = facts
        if not keys and n > small:
            salts, keys = int(spark.conf.get("spark.sql.shuffle.partitions")), ["__salt"]
            left = facts.withColumn("__salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
            some = some.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        some = F.broadcast(some) if n <= small else some
        joined = left.join(some, keys) if keys else left.crossJoin(some)
        joined = joined.select(*facts.columns, *rest)
        out = joined if out is None else out.unionByName(joined)
    return out
