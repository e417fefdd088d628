"""Packing of token pieces into fixed-length sequences by shortest-pack-first over the length histogram.

The histogram has at most `capacity` lengths, however many documents there are, so the packing itself is a small
driver-side step: lengths are placed longest first, each into the shortest packs that still have room, and only
counts of identical packing patterns are kept.  Patterns go back to the pieces by rank within their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .tokens import array_slices, encoder, give_back

#: Pieces of one length are numbered in parts of about this many, so no length is one task's work.
RANK_ROWS = 100_000


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order of placing) with the number of sequences of each.

    Longest lengths first; each goes into the shortest open packs with room for it, else opens new packs."""
    patterns: list[tuple[tuple[int, ...], int]] = []
    by_used: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    used: list[int] = []  # sorted totals that have open packs

    def put(pack, n):
        total = sum(pack)
        if total >= capacity:
            patterns.append((pack, n))
            return
        if not by_used[total]:
            bisect.insort(used, total)
        by_used[total].append((pack, n))

    for length in sorted((x for x in counts if counts[x] > 0), reverse=True):
        left = counts[length]
        while left:
            if used and used[0] + length <= capacity:
                pack, n = by_used[used[0]].pop()
                if not by_used[used[0]]:
                    used.pop(0)
                take = min(n, left)
                # a pattern with few copies may take several of this length at once
                if n > take:
                    put(pack, n - take)
                put((*pack, length), take)
                left -= take
            else:
                room = capacity // length
                full, rest = divmod(left, room)
                if full:
                    put((length,) * room, full)
                if rest:
                    put((length,) * rest, 1)
                left = 0
    for total in used:
        patterns.extend(by_used[total])
    return patterns


def slots(patterns: list[tuple[tuple[int, ...], int]]):
    """For each run of ranks of one length: (length, first rank, copies per sequence, offset, first sequence)."""
    rank: dict[int, int] = defaultdict(int)
    sequence, out = 0, []
    for pack, n in patterns:
        offset, i = 0, 0
        while i < len(pack):
            length, k = pack[i], 1
            while i + k < len(pack) and pack[i + k] == length:
                k += 1
            out.append((length, rank[length], k, offset, sequence))
            rank[length] += k * n
            offset += k * length
            i += k
        sequence += n
    return sorted(out)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2, keeps_blanks: bool = False, text: str = "text", doc_id: str = "doc_id", cache_words: int = 400_000) -> DataFrame:
    """Each text's ids and end id, cut every `capacity` ids: doc_id, start, length, ids_crc32, doc_tokens."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

    def cut(batches):
        encode, end = encoder(vocabulary, keeps_blanks, cache_words).encode_array, np.uint32(end_id).tobytes()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for lo, hi in array_slices(texts):
                rows, (found, at) = [], encode(texts[lo:hi])
                for key, a, b in zip(keys[lo:hi].to_pylist(), at, at[1:]):
                    ids = found[a:b].tobytes() + end
                    n = len(ids) // 4
                    rows += [(key, s, min(capacity, n - s), zlib.crc32(ids[4 * s : 4 * (s + capacity)]), n) for s in range(0, n, capacity)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            keys = texts = batch = None
            give_back()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def rank_in_length(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds `rank` from 0 within each length, in parts by a hash, so that a length with a third of all rows is split.

    counts: the number of pieces of each length; parts grow with it."""
    parts = pieces.sparkSession.createDataFrame([(k, -(-n // RANK_ROWS)) for k, n in counts.items()], "length long, parts long")
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("parts")).alias("part")
    pieces = pieces.join(F.broadcast(parts), "length").select(*pieces.columns, part)  # a row a length
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = pieces.groupBy("length", "part").count().select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    return pieces.withColumn("nth", F.row_number().over(within)).join(firsts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("nth") - 1).drop("part", "nth", "first")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2, keeps_blanks: bool = False, cache_words: int = 400_000) -> DataFrame:
    """Pack every document's ids into sequences of at most `capacity`.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.  A null or empty text has
    its end id alone; a null doc_id stays null; repeated rows are packed each; an empty table gives no rows; other
    columns of the input, whatever their names, are not read.  Any sequence shorter than capacity is padded to it by
    its reader, one whose length is a power of two need not be.  The pieces (five numbers each) are written once, so
    the texts are encoded once and a lost executor costs no more than its own tasks."""
    pieces = stored(token_pieces(docs, vocabulary, capacity, end_id, keeps_blanks, cache_words=cache_words), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    table = np.array(slots(pack_histogram(histogram, capacity)), np.int64).reshape(-1, 5)
    # lengths are at most capacity, so a key of length and rank orders the slots
    shift = 1 << 44
    keys = table[:, 0] * shift + table[:, 1]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def place(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            slot = table[np.searchsorted(keys, length * shift + rank, side="right") - 1].reshape(-1, 5)
            nth = rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(slot[:, 4] + nth // slot[:, 2]), pa.array(slot[:, 3] + nth % slot[:, 2] * length)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return rank_in_length(pieces, histogram).mapInArrow(place, schema)
