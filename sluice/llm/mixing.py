"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are permuted by a seeded hash and then laid on a line of words, which is cut into equal blocks:
the blocks are permuted ones, and only one document of a source is ever taken in part.  The exact number of blocks each
source owes is split over the output shards by a binary tree whose every node draws its left half hypergeometrically,
so shards are as random as one global shuffle but are planned from counts alone.  Shards draw disjoint runs of the
permuted blocks, what a document gives is the sum of its words in them, and each shard shuffles its documents locally.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

#: Weights in turn by source order.
TURNS = (3, 1, 2)


def fill_targets(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words of each source: total share by weight, none above `most` times its size, the excess reshared by weight."""
    left, targets = share * sum(sizes), [0.0] * len(sizes)
    open_ = {i for i, s in enumerate(sizes) if s > 0 and weights[i] > 0}
    while open_:
        scale = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if scale * weights[i] > most * sizes[i]}
        if not above:
            for i in open_:
                targets[i] = scale * weights[i]
            break
        for i in above:
            targets[i] = most * sizes[i]
            left -= targets[i]
        open_ -= above
    return targets


#: Blocks are as wide as keeps a mixture below this many, within the exact range of the hypergeometric sampler.
MOST_BLOCKS = 1 << 29


def width_of_blocks(words: float, least: int) -> int:
    """Words of a block: it grows with the mixture beyond MOST_BLOCKS blocks of `least` words."""
    return max(least, math.ceil(words / MOST_BLOCKS))


def split_once(quotas: np.ndarray, left_total: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each source's blocks go left, so that left_total do: one exact multivariate hypergeometric draw."""
    out, rest, need = np.zeros_like(quotas), int(quotas.sum()), left_total
    for i, q in enumerate(map(int, quotas)):
        others = rest - q
        low, high = max(0, need - others), min(q, need)
        got = low if low == high else int(rng.hypergeometric(q, others, need))
        out[i] = got
        need -= got
        rest = others
    return out


def splitting_tree(quotas: list[int], shards: int, seed: int = 0) -> list[list[int]]:
    """quotas[source] split over shards: a row of counts per shard, each shard of nearly equal total."""
    rng = np.random.default_rng(seed)

    def halve(q: np.ndarray, n: int) -> list[list[int]]:
        if n == 1:
            return [q.tolist()]
        left = split_once(q, round(int(q.sum()) * (n // 2) / n), rng)
        return halve(left, n // 2) + halve(q - left, n - n // 2)

    return halve(np.array(quotas, np.int64), shards)


def _literal(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from driver values, without Python on executors."""
    columns = [x.split() for x in schema.split(", ")]
    text = json.dumps([dict(zip([c[0] for c in columns], r)) for r in rows])
    kind = ",".join(f"{name}:{of.replace(';', ',')}" for name, of in columns)
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kind}>>")))


def mix_draws(docs: DataFrame, turns: tuple = TURNS, share: float = 1.5, most: float = 2.0, block_words: int = 32, shards: int | None = None, shard_words: int = 16_000_000, seed: int = 17) -> DataFrame:
    """Every row of docs with size, source_size, target, taken and draws (shard, epoch, from_word, words) beside its columns.

    Sources stand in code-point order, null last, and weigh `turns` in turn.  A source owes round(target / width)
    blocks, of block_words words or, in a mixture of over MOST_BLOCKS such, as many as keep within that number; whole epochs of its line come first, then the line's beginning, so a document is taken once,
    twice or not at all, but for one document at the end of the line, which is taken in part.  Documents without words
    have size 0 and are never drawn.  The order on the line is by md5 of seed and doc_id, ties by a hash of the text;
    identical rows are interchangeable, and all rows count, repeated or not.  Null doc_ids and sources are values like
    others; an empty table gives no rows; clashing names of added columns are replaced.  Weights are given per source
    on the driver, so the number of sources must fit there.  Unless given, shards are so many that each takes about
    shard_words words, 64 at least; the plan holds a run per source and shard."""
    return _planned(docs, turns, share, most, block_words, shards, shard_words, seed)[0]


def _planned(docs: DataFrame, turns: tuple = TURNS, share: float = 1.5, most: float = 2.0, block_words: int = 32, shards: int | None = None, shard_words: int = 16_000_000, seed: int = 17, sizes: DataFrame | None = None) -> tuple[DataFrame, int]:
    """The rows of mix_draws and the number of shards.

    sizes: docs with size and a hash of the text (__text) in place of the text, where it is needed no more."""
    spark = docs.sparkSession
    own = [c for c in (docs if sizes is None else sizes).columns if c not in ("size", "source_size", "target", "taken", "draws", "__text")]
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    source = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    sized = docs if sizes is None else sizes
    rows = sized.select(*own, (word_count() if sizes is None else F.col("size")).alias("size"), mark.alias("__mark"), source.alias("__source"), (F.xxhash64("text") if sizes is None else F.col("__text")).alias("__text"))
    rows = rows.withColumn("__bucket", F.substring("__mark", 1, 3))
    sums = stored(rows.groupBy("__source", "__bucket").agg(F.sum("size").alias("words")), "sums")  # 4096 rows a source
    totals = sorted((r["__source"] == "n", r["__source"], r["w"]) for r in sums.groupBy("__source").agg(F.sum("words").alias("w")).collect())
    words = [t[2] for t in totals]
    targets = fill_targets(words, [turns[i % len(turns)] for i in range(len(words))], share, most)
    width = width_of_blocks(share * sum(words), block_words)
    shards = shards or max(64, math.ceil(sum(targets) / shard_words))
    runs: list[list] = [[] for _ in words]
    at = [0] * len(words)
    for shard, counts in enumerate(splitting_tree([round(t / width) for t in targets], shards, seed) if words else []):
        for i, n in enumerate(counts):
            lo, hi = at[i] * width, min((at[i] + n) * width, math.floor(most * words[i]))
            if lo < hi:
                runs[i].append({"shard": shard, "lo": lo, "hi": hi})
            at[i] += n
    owed = _literal(spark, [(t[1], t[2], g, r) for t, g, r in zip(totals, targets, runs)], "__source string, source_size bigint, target double, runs array<struct<shard:int;lo:bigint;hi:bigint>>")
    before = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select("__source", "__bucket", "words", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("__first"))
    firsts = firsts.join(F.broadcast(owed), "__source")  # one row a source
    # of the runs of a source, a bucket keeps those it meets, so a document looks at few of them
    firsts = firsts.withColumn("runs", _meeting(F.col("runs"), F.col("__first"), F.col("words"), F.col("source_size"), most)).drop("words")
    within = Window.partitionBy("__source", "__bucket").orderBy("__mark", "__text", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(firsts, ["__source", "__bucket"])
    draws = _draws(F.col("runs"), F.col("__first") + F.col("__before"), F.col("size"), F.col("source_size"), most)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return placed.withColumn("draws", draws).select(*own, "size", "source_size", "target", taken.alias("taken"), "draws"), shards


def _meeting(runs: Column, lo: Column, words: Column, line: Column, most: float) -> Column:
    """The runs that share a word with [lo, lo + words) on any epoch's copy of the line."""
    return F.filter(runs, lambda r: F.exists(F.array(*[F.lit(e) for e in range(math.ceil(most))]), lambda e: (r["lo"] < lo + e * line + words) & (r["hi"] > lo + e * line)))


def _draws(runs: Column, lo: Column, size: Column, line: Column, most: float) -> Column:
    """Overlaps of a document's words, on each epoch's copy of the line, with the shards' runs."""
    each = F.array(*[F.lit(e) for e in range(math.ceil(most))])

    def of(epoch):
        first = lo + epoch * line
        return F.transform(
            F.filter(runs, lambda r: (r["lo"] < first + size) & (r["hi"] > first) & (size > 0)),
            lambda r: F.struct(r["shard"].alias("shard"), epoch.alias("epoch"), (F.greatest(r["lo"], first) - first).alias("from_word"), (F.least(r["hi"], first + size) - F.greatest(r["lo"], first)).alias("words")),
        )

    return F.flatten(F.transform(each, of))


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row: what the mix takes, without the texts.

    Sizes are counted once and written, four values a row."""
    sizes = stored(docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("__text")), "sizes")
    return _planned(docs, sizes=sizes, **options)[0].select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mixed rows themselves: each draw of a document is a row with docs' own columns.

    Rows are dealt to shards and shuffled there by a seeded key; a document at the edge of two shards goes to the first
    of them, and the one at the end of a source's line keeps only the words drawn."""
    rows, shards = _planned(docs, seed=seed, **options)
    own = [c for c in rows.columns if c not in ("size", "source_size", "target", "taken", "draws")]
    of = lambda e: F.filter("draws", lambda d: d["epoch"] == e)
    epochs = F.transform(
        F.array_distinct(F.transform("draws", lambda d: d["epoch"])),
        lambda e: F.struct(e.alias("epoch"), F.array_min(F.transform(of(e), lambda d: d["shard"])).alias("shard"), F.aggregate(of(e), F.lit(0).cast("long"), lambda a, d: a + d["words"]).alias("words")),
    )
    drawn = rows.select(*own, "size", F.inline(epochs))
    # cut after each word, without losing a blank
    part = F.array_join(F.slice(F.split("text", "(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])", -1), 1, F.col("words").cast("int")), "")
    drawn = drawn.withColumn("text", F.when(F.col("words") >= F.col("size"), F.col("text")).otherwise(part))
    if "n_chars" in own:
        drawn = drawn.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    key = F.xxhash64(F.lit(seed), "doc_id", "epoch", F.xxhash64("text"))
    return drawn.repartition(shards, "shard").sortWithinPartitions("shard", key).select(*own)
