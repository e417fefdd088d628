"""Structured Streaming feeds: files to bronze, clean and split feeds, change application, windows and lookups.

Every feed runs with the availableNow trigger: it takes what has come since its checkpoint and ends, so one form serves
scheduled and continuous jobs.
"""

from __future__ import annotations

import threading
from collections import Counter, defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import tables


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Rows of files as they come, with source_file and loaded_at; max_files bounds a trigger.

    The path goes to Spark as a pattern that matches it alone: a plain path to a single file is taken for a folder."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path if "*" in path else f"{path[:-1]}[{path[-1]}]").select("*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("loaded_at"))


def append(stream: DataFrame, folder: str, partition_by: tuple = ()):
    """Append a stream to folder/data exactly once; returns the finished query."""
    w = stream.writeStream.format("parquet").option("path", f"{folder}/data").option("checkpointLocation", f"{folder}/checkpoint")
    q = w.partitionBy(*partition_by).trigger(availableNow=True).start() if partition_by else w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def each_batch(stream: DataFrame, folder: str, work: Callable[[DataFrame, int], None], mode: str = "append"):
    """Run work(batch, batch_id) for every batch; work must give the same result when a batch id comes again."""
    q = stream.writeStream.outputMode(mode).foreachBatch(work).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def latest(stream: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """Final value of each key of an aggregate in update mode.

    Each batch overwrites its own folder of changed keys, so a repeated batch adds nothing."""
    each_batch(stream, folder, lambda df, i: df.write.mode("overwrite").parquet(f"{folder}/data/batch={i}"), "update")
    rows = stream.sparkSession.read.schema(f"{_ddl(stream)}, batch int").option("basePath", f"{folder}/data").parquet(f"{folder}/data")
    values = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in values])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def clean(stream: DataFrame, rules: dict[str, str], keys: list[str], at: str, delay: str) -> DataFrame:
    """Rows that meet every rule, once per key among rows at most `delay` apart in event time."""
    good = tables.expect(stream, rules).where("size(failed) = 0").drop("failed")
    return good.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


class ChangeTable:
    """State of keys in buckets by their hash; a batch rewrites the buckets that it touches and leaves the others' files alone.

    state/<i> holds the buckets that batch i wrote, and a manifest, written last, says for every bucket which batch wrote it
    last, and the greatest sequence seen.  A repeated batch starts from the manifest before it and overwrites its own
    folder with the same rows; an object made anew on the same folder goes on where the last one ended.  Files that neither
    of the last two manifests names are deleted.

    step(state or None, batch, horizon) gives (new state, rows that are final or None) for whole keys; it must bear being
    applied to the batch alone first, which takes repeated keys together before they are dealt out.  late: changes
    further than this behind the greatest sequence of earlier batches are not taken, and what ended before then is final:
    it leaves the state for done/<i>.  None keeps everything."""

    def __init__(self, folder: str, step: Callable, keys: list[str], sequence: str, buckets: int = 16, late: int | None = None):
        self.folder, self.step, self.keys, self.sequence, self.buckets, self.late = folder, step, keys, sequence, buckets, late

    def _fs(self, spark: SparkSession, path: str):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()), p

    def _manifests(self, spark: SparkSession) -> list[int]:
        fs, p = self._fs(spark, f"{self.folder}/manifest")
        return sorted(int(x.getPath().getName()) for x in fs.listStatus(p) if x.getPath().getName().isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS"))) if fs.exists(p) else []

    def _manifest(self, spark: SparkSession, i: int) -> tuple[dict[int, int], int | None]:
        """(batch that wrote each bucket, greatest sequence); a row a bucket."""
        rows = spark.read.schema("bucket int, batch int, top long").parquet(f"{self.folder}/manifest/{i}").collect()
        return {r["bucket"]: r["batch"] for r in rows if r["bucket"] >= 0}, next((r["top"] for r in rows if r["bucket"] < 0), None)

    def _read(self, spark: SparkSession, held: dict[int, int], some=None) -> DataFrame | None:
        paths = [f"{self.folder}/state/{n}/bucket={b}" for b, n in sorted(held.items()) if some is None or b in some]
        return spark.read.parquet(*paths) if paths else None

    def state(self, spark: SparkSession) -> DataFrame | None:
        """All buckets as the latest batch left them, or None before the first."""
        done = self._manifests(spark)
        return self._read(spark, self._manifest(spark, done[-1])[0]) if done else None

    def finished(self, spark: SparkSession) -> DataFrame | None:
        """Rows that became final, of all batches so far, or None."""
        fs, _ = self._fs(spark, self.folder)
        paths = [f"{self.folder}/done/{n}" for n in range((self._manifests(spark) or [-1])[-1] + 1)]
        paths = [p for p in paths if fs.exists(self._fs(spark, p)[1])]
        return spark.read.parquet(*paths) if paths else None

    def _work(self, batch: DataFrame, i: int) -> None:
        spark = batch.sparkSession
        done = self._manifests(spark)
        if i and i - 1 not in done:
            raise RuntimeError(f"{self.folder} lacks the manifest of batch {i - 1}")
        held, top = self._manifest(spark, i - 1) if i else ({}, None)
        horizon = None if self.late is None or top is None else top - self.late
        taken = batch if horizon is None else batch.where(F.col(self.sequence) > horizon)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = self.step(None, taken, None)[0].withColumn("bucket", bucket).persist()
        try:
            touched = {r["bucket"]: r["top"] for r in new.groupBy("bucket").agg(F.max(self.sequence).cast("long").alias("top")).collect()}
            before = self._read(spark, held, set(touched))
            rows = self.step(before, new.drop("bucket"), horizon)
            state, final = (x if x is None else x.withColumn("bucket", bucket) for x in rows)
            state.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/state/{i}")
            if final is not None:
                final.drop("bucket").write.mode("overwrite").parquet(f"{self.folder}/done/{i}")
        finally:
            new.unpersist()
        fs, path = self._fs(spark, f"{self.folder}/state/{i}")
        there = {int(x.getPath().getName()[7:]) for x in fs.listStatus(path) if x.getPath().getName().startswith("bucket=")}
        held = {b: n for b, n in held.items() if b not in touched} | dict.fromkeys(there, i)
        tops = [t for t in (top, *touched.values()) if t is not None]
        rows = [*((b, n, None) for b, n in held.items()), (-1, i, max(tops, default=None))]
        spark.createDataFrame(rows, "bucket int, batch int, top long").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/{i}")
        if i:
            self._forget(spark, i, held, self._manifest(spark, i - 1)[0])

    def _forget(self, spark: SparkSession, i: int, *held: dict[int, int]) -> None:
        needed = {(n, b) for h in held for b, n in h.items()}
        fs, path = self._fs(spark, f"{self.folder}/state")
        for x in fs.listStatus(path):
            n = int(x.getPath().getName())
            for y in fs.listStatus(x.getPath()):
                name = y.getPath().getName()
                if n < i and name.startswith("bucket=") and (n, int(name[7:])) not in needed:
                    fs.delete(y.getPath(), True)
        for n in self._manifests(spark):
            if n < i - 1:
                fs.delete(self._fs(spark, f"{self.folder}/manifest/{n}")[1], True)

    def run(self, stream: DataFrame) -> DataFrame:
        each_batch(stream, self.folder, self._work)
        return self.state(stream.sparkSession)


def scd1_step(keys: list[str], sequence: str, columns: list[str], deleted: Column):
    """Latest change of each key with its sequence; deletes stay as marked rows, so a late older change stays out."""

    def step(state: DataFrame | None, batch: DataFrame, horizon) -> tuple[DataFrame, None]:
        new = batch.select(*keys, sequence, *columns, (deleted if "deleted" not in batch.columns else F.col("deleted")).alias("deleted"))
        rows = new if state is None else state.unionByName(new)
        top = rows.groupBy(*keys).agg(F.max_by(F.struct(sequence, *columns, "deleted"), sequence).alias("r"))
        return top.select(*keys, "r.*"), None

    return step


def scd2_step(keys: list[str], sequence: str, track: list[str], deleted: Column):
    """Every change of a key that a later one may still lie before, each once; versions are ordered from these when read.

    With a horizon, versions that ended by then are final: they leave as rows (keys, track, start_at, end_at), and their changes
    are forgotten but for the one in force at the horizon."""

    def step(state: DataFrame | None, batch: DataFrame, horizon) -> tuple[DataFrame, DataFrame | None]:
        new = batch.select(*keys, sequence, *track, (deleted if "deleted" not in batch.columns else F.col("deleted")).alias("deleted"))
        rows = (new if state is None else state.unionByName(new)).dropDuplicates([*keys, sequence])
        if horizon is None:
            return rows, None
        w = Window.partitionBy(*keys).orderBy(sequence)
        differs = F.row_number().over(w) == 1
        for c in [*track, "deleted"]:
            differs = differs | ~F.col(c).eqNullSafe(F.lag(c).over(w))
        old = F.col(sequence) <= horizon
        # of changes up to the horizon only those that change something count; the last of them stays
        marked = rows.withColumn("__new", differs).where(~old | F.col("__new"))
        ended = marked.withColumn("__end", F.lead(sequence).over(w)).withColumn("__done", old & F.coalesce(F.col("__end") <= horizon, F.lit(False)))
        final = ended.where("__done and not deleted").select(*keys, *track, F.col(sequence).alias("start_at"), F.col("__end").alias("end_at"))
        return ended.where("not __done").select(*rows.columns), final

    return step


def versions(changes: DataFrame, keys: list[str], sequence: str, track: list[str]) -> DataFrame:
    return tables.scd2(changes, keys, sequence, F.col("deleted"), track)


def tumbling(stream: DataFrame, at: str, size: str, delay: str, keys: list[str], *aggs: Column, slide: str | None = None) -> DataFrame:
    """Aggregates per key and window: window_start beside the keys; slide makes windows overlap."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    out = stream.withWatermark(at, delay).groupBy(w.alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), *[c for c in out.columns if c != "w"])


def session_windows(stream: DataFrame, at: str, gap: str, delay: str, keys: list[str], *aggs: Column) -> DataFrame:
    """Sessions that the watermark has closed."""
    out = stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").alias("first_at"), F.col("w.end").alias("ends_at"), *[c for c in out.columns if c != "w"])


class LateRows(StreamingQueryListener):
    """Counts, batch by batch, the rows of a session's queries that came behind the watermark."""

    def __init__(self, spark: SparkSession):
        self.spark, self.n, self.ended = spark, Counter(), defaultdict(threading.Event)

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.n[str(event.progress.runId)] += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended[str(event.runId)].set()

    def of(self, query, wait: float = 60) -> int:
        """Late rows of a finished query, all its batches counted."""
        if not self.ended[str(query.runId)].wait(wait):
            raise TimeoutError(f"no end of query {query.runId} was reported")
        return self.n[str(query.runId)]


def lookup_split(stream: DataFrame, dimension: DataFrame, key: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stream rows joined with a dimension, in one table parted by hit; rows without a match wait as stalled."""
    dim = dimension.withColumn("__hit", F.lit(True))
    joined = stream.join(dim, key, "left").withColumn("hit", F.coalesce("__hit", F.lit(False))).drop("__hit")
    append(joined, folder, ("hit",))
    rows = stream.sparkSession.read.schema(f"{_ddl(joined)}").parquet(f"{folder}/data")
    return rows.where("hit").drop("hit"), rows.where("not hit").drop("hit")
