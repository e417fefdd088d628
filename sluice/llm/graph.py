"""Connected components of an edge table by alternating large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """id, component (least id reachable) of every vertex that has an edge to another.

    Null ends and loops are left out.  Each round is written to the shared folder, so plans stay short; minima are
    taken before the joins, so a vertex with a third of all edges is only a large join side, which Spark splits."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    now = stored(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).distinct()
        now, before = stored(small, "edges"), mark
        mark = _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _mark(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
    return tuple(r)
