"""Token-id files: independent zstandard frames, a document index and a trailing seek table with checksums.

Layout of a file (public seekable zstandard format, so any zstandard reader can also stream it):
  data frames          whole documents' ids, unsigned 32-bit little-endian, each frame independent
  skippable frame      document index: for each document its id (or a null mark) and number of ids
  skippable frame      seek table: compressed size, decompressed size and checksum (low 32 bits of XXH64) per frame
A reader takes the seek table and the index from the end of the file, and decompresses only the frames that hold the
documents asked for.
"""

from __future__ import annotations

import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import open_binary, partitions, shared_dir, stored, write_whole
from .tokens import array_slices, encoder

# Fixed values of the public formats
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, HAS_CHECKSUMS = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80


def file_chunks(documents, frame_bytes: int = 1 << 18, level: int = 3, most_bytes: int = 1 << 30):
    """Chunks of one file from (doc_id, ids as bytes) pairs; a frame closes once it holds frame_bytes.

    A document of over most_bytes goes over several frames, whose sizes the seek table holds in 32 bits."""
    import xxhash
    import zstandard

    press = zstandard.ZstdCompressor(level=level, write_checksum=False)
    ids, sizes, table, held, size = [], [], [], [], 0

    def close():
        raw = b"".join(held)
        packed = press.compress(raw)
        table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        return packed

    for key, data in documents:
        ids.append(key)
        sizes.append(len(data) // 4)
        for at in range(0, len(data), most_bytes):
            held.append(data[at : at + most_bytes])
            size += len(held[-1])
            if size >= frame_bytes:
                yield close()
                held, size = [], 0
    if held:
        yield close()
    null = np.array([k is None for k in ids], np.uint8)
    keys = np.array([k or 0 for k in ids], "<i8")
    index = press.compress(struct.pack("<Q", len(ids)) + null.tobytes() + keys.tobytes() + np.array(sizes, "<u8").tobytes())
    yield struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index
    seek = b"".join(struct.pack("<III", *x) for x in table)
    yield struct.pack("<II", SKIPPABLE_SEEK, len(seek) + 9) + seek + struct.pack("<IBI", len(table), HAS_CHECKSUMS, SEEK_MAGIC)


class TokenFile:
    """Random access to one file: `ids[i]`, `sizes[i]` and `read(i)` of its i-th document."""

    def __init__(self, uri: str):
        import zstandard

        self.file, self.unpress, self.uri = open_binary(uri), zstandard.ZstdDecompressor(), uri
        end = self.file.seek(0, 2)
        self.file.seek(end - 9)
        frames, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEK_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError(f"{uri} has no seek table with checksums")
        table_at = end - 9 - 12 * frames - 8
        self.file.seek(table_at + 8)
        table = np.frombuffer(self.file.read(12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.checksums = table[:, 2]
        self.frame_at = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.first = np.concatenate([[0], np.cumsum(table[:, 1] // 4)])
        index_at = int(self.frame_at[-1])
        self.file.seek(index_at + 8)
        raw = self.unpress.decompress(self.file.read(table_at - index_at - 8))
        n = struct.unpack_from("<Q", raw)[0]
        null = np.frombuffer(raw, np.uint8, n, 8)
        keys = np.frombuffer(raw, "<i8", n, 8 + n)
        self.ids = [None if x else int(k) for x, k in zip(null, keys)]
        self.sizes = np.frombuffer(raw, "<u8", n, 8 + 9 * n).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.held = (-1, b"")

    def _frame(self, k: int) -> bytes:
        import xxhash

        if self.held[0] != k:
            self.file.seek(int(self.frame_at[k]))
            raw = self.unpress.decompress(self.file.read(int(self.frame_at[k + 1] - self.frame_at[k])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[k]:
                raise ValueError(f"{self.uri}: frame {k} does not match its checksum")
            self.held = (k, raw)
        return self.held[1]

    def read(self, i: int) -> bytes:
        """Ids of the i-th document as bytes; only its frame (for a very long one, frames) is read and decompressed."""
        if not self.sizes[i]:
            return b""
        k = int(np.searchsorted(self.first, self.starts[i], side="right")) - 1
        at, size = 4 * int(self.starts[i] - self.first[k]), 4 * int(self.sizes[i])
        out = self._frame(k)[at : at + size]
        while len(out) < size:
            k += 1
            out += self._frame(k)[: size - len(out)]
        return out

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int = 0, keeps_blanks: bool = True, folder: str | None = None, frame_bytes: int = 1 << 18, cache_words: int = 400_000, file_tokens: int = 1 << 26) -> DataFrame:
    """Encode every text, append the end id and write files in ascending doc_id order (null ids last).

    Returns the manifest: part, nth, path, docs, tokens, start (ids in all files before it).  A file closes once it
    holds file_tokens ids.  File names come from the range partition and their order there, and files appear by a
    rename, so a repeated task replaces a file by the same file."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens"
    schema = "part int, nth int, path string, docs long, tokens long"

    def write(batches):
        encode, end, part = encoder(vocabulary, keeps_blanks, cache_words).encode_array, np.uint32(end_id).tobytes(), TaskContext.get().partitionId()

        def documents():
            for batch in batches:
                keys, texts = batch.column(0), batch.column(1)
                for lo, hi in array_slices(texts):
                    ids, at = encode(texts[lo:hi])
                    for key, a, b in zip(keys[lo:hi].to_pylist(), at, at[1:]):
                        yield key, ids[a:b].tobytes() + end

        rest, done = documents(), [0, 0]

        def one_file(first):
            done[:] = 0, 0
            for key, ids in itertools.chain([first], rest):
                done[0] += 1
                done[1] += len(ids) // 4
                yield key, ids
                if done[1] >= file_tokens:
                    break

        for nth, first in enumerate(rest):
            path = f"{folder}/part-{part:06d}-{nth:06d}.tok.zst"
            write_whole(path, file_chunks(one_file(first), frame_bytes))
            columns = [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([path]), pa.array([done[0]]), pa.array([done[1]])]
            yield pa.RecordBatch.from_arrays(columns, ["part", "nth", "path", "docs", "tokens"])

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    parts = stored(ranged.mapInArrow(write, schema), "manifest")
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return parts.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches):
        for batch in batches:
            for path, start in zip(*(batch.column(i).to_pylist() for i in range(2))):
                f = TokenFile(path)
                for lo in range(0, len(f.ids), 10_000):
                    some = range(lo, min(lo + 10_000, len(f.ids)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f.ids[i] for i in some], pa.int64()), pa.array(start + f.starts[some.start : some.stop]), pa.array(f.sizes[some.start : some.stop]), pa.array([zlib.crc32(f.read(i)) for i in some], pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                f.close()

    n = partitions(manifest.sparkSession)
    return manifest.select("path", "start").repartition(n, "path").mapInArrow(read, schema)


def token_round_trip(docs: DataFrame, vocabulary: str, end_id: int = 0, keeps_blanks: bool = True) -> DataFrame:
    """Write all documents' ids, read the files back, and return doc_id, start, n_tokens, ids_crc32 per document.

    Null or empty texts have the end id alone; null doc_ids come last; repeated rows are written each, ties of doc_id
    in order of a hash of their texts; an empty table gives no rows; other columns are not read."""
    return read_token_files(write_token_files(docs, vocabulary, end_id, keeps_blanks))
