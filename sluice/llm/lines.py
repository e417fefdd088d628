"""Line deduplication across documents, all in DataFrame operations.

Hashes of line keys are range-partitioned together with document and position and sorted there, so a line that stands
in a third of all documents is spread over many ranges.  Per key and range only a count and the largest document leave
the range; the verdict on a key goes back to the ranges that hold it, so no task gathers a key.  What comes back to the documents is no text but a bitmap of kept lines, without the words that are all
ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, partitions, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    """The line without ASCII blanks at both ends and with A-Z lower-cased; other letters stay as they are."""
    bare = F.trim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: doc_id, text_hash, keep (map of word number to 64 keep bits).

    A word that is absent keeps all its lines.  A document here is a doc_id: rows that repeat one are one holder."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n", -1)).alias("position", "line"))
    keyed = lines.where(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    # two independent 64-bit hashes: no two keys of any corpus meet
    hashed = keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key", F.lit("line")).alias("h2"), "doc_id", "position", "text_hash")
    n = partitions(docs.sparkSession)
    # written first, so that the bounds of the ranges are found from numbers and no line is hashed twice
    ranged = stored(hashed, "hashes").repartitionByRange(n, "h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", "doc_id", "position")
    # the range holds all rows of a key and document, so this needs no further exchange
    held = ranged.groupBy("h1", "h2", "doc_id").agg(F.collect_list(F.struct("text_hash", "position")).alias("places"))
    held = stored(held.withColumn("part", F.spark_partition_id()), "lines")  # read for the counts and again for the places
    counts = stored(held.groupBy("h1", "h2", "part").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")), "counts")
    frequent = counts.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper")).where(F.col("n") >= min_docs).drop("n")
    # a key over many ranges has a row for each
    verdicts = counts.select("h1", "h2", "part").join(frequent, ["h1", "h2"])
    lost = held.join(verdicts, ["h1", "h2", "part"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", F.inline("places"))
    word = lost.groupBy("doc_id", "text_hash", F.expr("position div 64").cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("position") % 64)).alias("bits"))
    return word.groupBy("doc_id", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits")))).alias("keep"))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Every row of docs with n_lines, n_dropped and kept_text beside its own columns.

    A text is split at line feeds; null and empty texts are one empty line.  Keys of at least min_chars code points
    that at least min_docs documents hold lose all their lines except in the largest doc_id that holds them (a null
    doc_id is one document, below all others).  Repeated rows are treated alike; an empty table gives no rows;
    clashing names of added columns are replaced."""
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    text = F.coalesce(F.col("text"), F.lit(""))
    marks = dropped_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("keep").alias("__keep"))
    joined = docs.select(*own).join(marks, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__hash")), "left")
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda _, i: F.expr("1L") == (F.call_function("shiftrightunsigned", F.coalesce(F.element_at("__keep", F.floor(i / 64).cast("int")), F.lit(-1).cast("long")), i % 64)).bitwiseAND(F.lit(1).cast("long")))
    n_lines = (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    n_kept = F.when(F.col("__keep").isNull(), F.col("n_lines")).otherwise(F.size("__kept").cast("long"))
    return joined.withColumns({"n_lines": n_lines, "__kept": F.when(F.col("__keep").isNotNull(), kept)}).select(
        *own, "n_lines", (F.col("n_lines") - n_kept).alias("n_dropped"), F.when(F.col("__keep").isNull(), text).otherwise(F.array_join("__kept", "\n")).alias("kept_text")
    )
