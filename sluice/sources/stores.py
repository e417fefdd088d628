"""Reading and writing tables: JDBC options, incremental loads, watermarks, sinks and layouts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under spark.checkpoint.dir, which the cluster shares; a local folder only where that is unset and Spark
    runs locally."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/sluice-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write once and read back: later uses scan the result, and its lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def jdbc_url(kind: str, host: str, database: str, port: int | None = None, **more: str) -> str:
    """JDBC URL of a vendor; more holds its own settings (warehouse, schema, role, encrypt ...)."""
    if kind == "mssql":
        tail = "".join(f";{k}={v}" for k, v in more.items())
        return f"jdbc:sqlserver://{host}:{port or 1433};databaseName={database}{tail}"
    if kind == "oracle":
        return f"jdbc:oracle:thin:@//{host}:{port or 1521}/{database}"
    if kind == "snowflake":
        return f"jdbc:snowflake://{host}/?" + "&".join(f"{k}={v}" for k, v in {"db": database, **more}.items())
    if kind == "postgres":
        return f"jdbc:postgresql://{host}:{port or 5432}/{database}"
    raise ValueError(f"unknown database kind {kind}")


#: Driver classes and session settings that make dates and zones read alike.
VENDORS = {
    "mssql": {"driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver"},
    "oracle": {"driver": "oracle.jdbc.driver.OracleDriver", "oracle.jdbc.mapDateToTimestamp": "false", "sessionInitStatement": "BEGIN dbms_session.set_nls('nls_date_format', '''YYYY-MM-DD'''); END;"},
    "snowflake": {"driver": "net.snowflake.client.jdbc.SnowflakeDriver"},
    "postgres": {"driver": "org.postgresql.Driver"},
}


#: The catalogue queries that list a table's columns and types.
SCHEMA_QUERIES = {
    "mssql": "select column_name, data_type, numeric_precision, numeric_scale from {database}.information_schema.columns where lower(table_schema) = '{schema}' and lower(table_name) = '{table}'",
    "oracle": "select column_name, data_type, data_precision, data_scale from all_tab_columns where lower(owner) = '{schema}' and lower(table_name) = '{table}'",
    "snowflake": "select column_name, data_type, numeric_precision, numeric_scale from {database}.information_schema.columns where lower(table_schema) = '{schema}' and lower(table_name) = '{table}'",
    "postgres": "select column_name, data_type, numeric_precision, numeric_scale from information_schema.columns where lower(table_schema) = '{schema}' and lower(table_name) = '{table}'",
}


def vendor_options(kind: str, **login: str) -> dict[str, str]:
    """JDBC options of a vendor: driver, session settings, and user, password or token as given."""
    if kind not in VENDORS:
        raise ValueError(f"unknown database kind {kind}")
    return {**VENDORS[kind], **{k: v for k, v in login.items() if v}}


def read_vendor(spark: SparkSession, kind: str, host: str, database: str, query: str, login: dict[str, str] | None = None, where: dict[str, str] | None = None, **partitioning) -> DataFrame:
    """A query's rows from a vendor's database: its URL, driver and session settings, and read_jdbc's partitioning.

    where: settings that belong in the URL (warehouse, role, encrypt ...)."""
    return read_jdbc(spark, jdbc_url(kind, host, database, **(where or {})), query, **partitioning, **vendor_options(kind, **(login or {})))


def schema_query(kind: str, database: str, schema: str, table: str) -> str:
    """The vendor's query for a table's columns: names, types, precision and scale."""
    safe = {k: v.replace("'", "''") for k, v in (("database", database), ("schema", schema.lower()), ("table", table.lower()))}
    return SCHEMA_QUERIES[kind].format(**safe)


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None, lower=None, upper=None, num_partitions: int = 16, fetch_size: int = 10_000, **options: str) -> DataFrame:
    """A query's rows; with a partition column, num_partitions ranges of it are read in parallel."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) src").option("fetchsize", fetch_size).options(**options)
    if partition_column:
        r = r.option("partitionColumn", partition_column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions)
    df = r.load()
    return df.toDF(*[c.lower() for c in df.columns])


def add_lineage(df: DataFrame, system: str, name: str, run_id: str) -> DataFrame:
    """Adds _loaded_at, _source_system, _source_table and _run_id."""
    return df.withColumns({"_loaded_at": F.current_timestamp(), "_source_system": F.lit(system), "_source_table": F.lit(name), "_run_id": F.lit(run_id)})


def drop_raw_geometry(df: DataFrame, suffix: str = "WKT") -> DataFrame:
    """Drops each column that stands beside its own text form `<column><suffix>`."""
    return df.drop(*[c for c in df.columns if c + suffix in df.columns])


class WatermarkStore:
    """Last watermark, status and rows of each table, one appended row a load; the latest run counts."""

    schema = "table_name string, run long, watermark string, status string, n_rows long"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.createDataFrame([], self.schema).write.mode("append").parquet(folder)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def last(self, name: str) -> str | None:
        """Watermark of the latest successful load, or None before the first."""
        top = self.all().where((F.col("table_name") == name) & (F.col("status") == "ok")).agg(F.max_by("watermark", "run").alias("w"))
        return top.first()["w"]

    def put(self, name: str, run: int, watermark, status: str, n_rows: int) -> None:
        row = (name, run, None if watermark is None else str(watermark), status, n_rows)
        self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(self.folder)


def load_increment(store: WatermarkStore, name: str, df: DataFrame, column: str, path: str, run: int) -> int:
    """Append the rows with last watermark < column <= the source's present maximum; returns their number.

    Rows of a run lie in a folder of its own, so a repeated run replaces what it wrote."""
    last = store.last(name)
    high = df.agg(F.max(column).cast("string").alias("w")).first()["w"]
    kind = df.schema[column].dataType
    rows = tables.new_rows(df, F.col(column), None if last is None else F.lit(last).cast(kind))
    rows = rows.where(F.col(column) <= F.lit(high).cast(kind)) if high is not None else rows.limit(0)
    rows.write.mode("overwrite").parquet(f"{path}/run={run}")
    n = df.sparkSession.read.schema(df.schema).parquet(f"{path}/run={run}").count()
    store.put(name, run, high if high is not None else last, "ok", n)
    return n


def load_all(spark: SparkSession, registry: dict[str, Callable[[], DataFrame]], folder: str, threads: int = 4, retries: int = 2) -> DataFrame:
    """Write every table of the registry to folder/<name>; table_name, status, n_rows, error.

    The driver's threads only submit jobs; a table that fails is tried again and does not stop the others."""

    def load(item):
        name, make = item
        for left in range(retries, -1, -1):
            try:
                df = make()
                df.write.mode("overwrite").parquet(f"{folder}/{name}")
                return name, "ok", spark.read.schema(df.schema).parquet(f"{folder}/{name}").count(), None
            except Exception as e:  # noqa: BLE001  reported in the result
                if not left:
                    return name, "failed", 0, str(e)[:500]

    with ThreadPoolExecutor(threads) as pool:
        rows = list(pool.map(load, registry.items()))
    return spark.createDataFrame(rows, "table_name string, status string, n_rows long, error string")


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of `schema` of the table at a path, with nulls for those it lacks; no rows where there is no table."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    want = spark.createDataFrame([], schema).schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want])


def write_overwrite(df: DataFrame, path: str, partition_by: tuple = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple) -> None:
    """Only the partitions that df has rows of are replaced; an empty df changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def create_as(df: DataFrame, path: str) -> DataFrame:
    """A table made of a query, its files at a path of its own; the catalogue's entry goes again, as sessions share it."""
    name = f"made_{uuid.uuid4().hex}"
    df.write.option("path", path).saveAsTable(name)
    kept = df.sparkSession.table(name).schema
    df.sparkSession.sql(f"drop table {name}")
    return df.sparkSession.read.schema(kept).parquet(path)


def write_append(df: DataFrame, path: str, partition_by: tuple = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_merge(df: DataFrame, old: str, new: str, keys: list[str]) -> None:
    """The table at `old` merged with df, written to `new`: a reader of the old snapshot is not disturbed."""
    target = df.sparkSession.read.schema(df.schema).parquet(old)
    tables.merge(target, df, keys).drop("action").write.mode("overwrite").parquet(new)


def write_clustered(df: DataFrame, path: str, by: list[str], files: int | None = None) -> None:
    """Files that hold ranges of `by`, sorted, so that scans skip files and row groups by their minima and maxima."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
