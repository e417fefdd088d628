"""What the corpus operators share: scratch tables, remote-safe files, word splitting."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separators of words and the only characters stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir; a local one of our own only where that is unset and Spark runs locally."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/sluice-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame once into the shared folder and read it back: lineage ends there and any executor can go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_whole(uri: str, chunks) -> int:
    """Stream chunks to a temporary name, then rename: a lost or repeated task leaves a whole file or none.

    Returns the number of bytes."""
    p, size = urlparse(uri), 0
    tmp = f".{uuid.uuid4().hex}.tmp"
    if p.scheme in ("", "file"):
        os.makedirs(os.path.dirname(p.path), exist_ok=True)
        with open(p.path + tmp, "wb") as f:
            for c in chunks:
                size += f.write(c)
        os.replace(p.path + tmp, p.path)
        return size
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_output_stream(path + tmp) as f:
        for c in chunks:
            size += f.write(c)
    store.move(path + tmp, path)
    return size


def open_binary(uri: str):
    """A seekable binary reader of a local or remote file."""
    p = urlparse(uri)
    if p.scheme in ("", "file"):
        return open(p.path, "rb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def word_count(text: str = "text"):
    """Number of maximal runs outside ASCII blanks, as a column: blanks are folded to one, then counted."""
    flat = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")
