"""The metrics store: one row for each compared table pair of a run, rows for each aggregate rule, and reports over them.

`main` names the table pairs of runs, `metrics` holds their counts and verdicts, `details` their sample rows; aggregate
rules have metrics and details of their own.  Ids are hashes of run and name, so a repeated run writes the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import recon

REPORTS = ("schema", "row", "data", "all")


def table_id(run: str, name: str) -> Column:
    return F.xxhash64(F.lit(run), F.lit(name))


def main_record(spark: SparkSession, run: str, name: str, report: str, source: str = "", target: str = "", started: str = "1970-01-01 00:00:00") -> DataFrame:
    """One row that names a compared pair: ids, tables, report type, start."""
    return spark.range(1).select(
        table_id(run, name).alias("recon_table_id"), F.lit(run).alias("recon_id"), F.lit(name).alias("table_name"), F.lit(source or name).alias("source_table"), F.lit(target or name).alias("target_table"), F.lit(report).alias("report_type"), F.lit(started).cast("timestamp").alias("start_ts")
    )


def metrics_record(source: DataFrame, target: DataFrame, spec: recon.ReconSpec, run: str, name: str, report: str = "data", user: str = "", thresholds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """One row of the store: ids, report type, recon_metrics and run_metrics; two empty tables agree.

    `schema` compares columns and types alone; `row` compares whole rows and knows no mismatches; `data` matches by key;
    `all` does that and compares the schemas.  thresholds: absolute bounds of columns whose pairs outside them count as
    threshold mismatches.  The run's status is true where nothing is missing and nothing differs."""
    if report not in REPORTS:
        raise ValueError(f"report {report} is none of {', '.join(REPORTS)}")
    n = lambda v: F.lit(v).cast("long")
    spark = source.sparkSession
    if report == "schema":
        counts = spark.range(1).select(n(0).alias("missing_in_source"), n(0).alias("missing_in_target"), n(0).alias("mismatch"))
    elif report == "row":
        gone = recon.classify_rows(source, target, spec)
        only = lambda a, b: F.coalesce(F.sum(F.greatest(F.col(a) - F.col(b), F.lit(0))), F.lit(0)).cast("long")
        counts = gone.agg(only("in_target", "in_source").alias("missing_in_source"), only("in_source", "in_target").alias("missing_in_target")).withColumn("mismatch", n(0))
    else:
        counts = recon.metrics(recon.classify(source, target, spec))
    # further one-row frames: which columns differ, and how many pairs leave their bounds
    counts = counts.withColumns({"mismatch_columns": F.lit(None).cast("string"), "threshold_mismatch": n(0)})
    if report in ("data", "all"):
        matches = recon.column_matches(source, target, spec)
        names = sorted(c[: -len("_match")] for c in matches.columns if c.endswith("_match"))
        outside = F.lit(False)
        for c, (low, high) in (thresholds or {}).items():
            outside = outside | (recon.threshold(F.col(f"{c}_base"), F.col(f"{c}_compare"), low, high) == "Failed")
        differ = [F.when(F.count_if(~F.col(f"{c}_match")) > 0, F.lit(c)) for c in names]
        cells = matches.agg(F.concat_ws(",", *differ).alias("mismatch_columns"), F.count_if(outside).alias("threshold_mismatch"))
        counts = counts.drop("mismatch_columns", "threshold_mismatch").crossJoin(cells)  # one row each
    schema_ok = None
    if report in ("schema", "all"):
        s, t = recon.prepare(source, spec), recon.prepare(target, spec, True)
        schema_ok = dict(s.dtypes) == {c: k for c, k in t.dtypes if c in s.columns}
    good = (F.col("missing_in_source") == 0) & (F.col("missing_in_target") == 0) & (F.col("mismatch") == 0) & (F.col("threshold_mismatch") == 0) & F.lit(schema_ok is not False)
    return counts.select(
        table_id(run, name).alias("recon_table_id"),
        F.lit(run).alias("recon_id"),
        F.lit(name).alias("table_name"),
        F.lit(report).alias("report_type"),
        F.struct(
            F.struct("missing_in_source", "missing_in_target").alias("row_comparison"),
            F.struct(F.col("mismatch").alias("absolute_mismatch"), "threshold_mismatch", "mismatch_columns").alias("column_comparison"),
            F.lit(schema_ok).cast("boolean").alias("schema_comparison"),
        ).alias("recon_metrics"),
        F.struct(good.alias("status"), F.lit(user).alias("run_by_user"), F.lit("").alias("exception_message")).alias("run_metrics"),
    )


def failed_record(spark: SparkSession, run: str, name: str, report: str, message: str, user: str = "") -> DataFrame:
    """The row of a pair that could not be compared: no counts, a false status and the message."""
    empty = F.from_json(F.lit("{}"), "struct<row_comparison: struct<missing_in_source: long, missing_in_target: long>, column_comparison: struct<absolute_mismatch: long, threshold_mismatch: long, mismatch_columns: string>, schema_comparison: boolean>")
    run_metrics = F.struct(F.lit(False).alias("status"), F.lit(user).alias("run_by_user"), F.lit(message).alias("exception_message"))
    return spark.range(1).select(table_id(run, name).alias("recon_table_id"), F.lit(run).alias("recon_id"), F.lit(name).alias("table_name"), F.lit(report).alias("report_type"), empty.alias("recon_metrics"), run_metrics.alias("run_metrics"))


def recon_run(spark: SparkSession, run: str, pairs) -> DataFrame:
    """A run over (name, source, target, spec, report) pairs: their rows of the store, one plan for all.

    A pair that cannot be planned (a missing column, say) has a failed row and stops no other."""
    rows = []
    for name, s, t, spec, report in pairs:
        try:
            rows.append(metrics_record(s, t, spec, run, name, report))
        except Exception as e:  # noqa: BLE001  reported in the result
            rows.append(failed_record(spark, run, name, report, str(e)[:500]))
    if not rows:
        raise ValueError("a run needs a pair of tables")
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def final_status(main: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per table pair: row, column and schema verdicts (null where the report has none), status and exception message."""
    m, r = F.col("recon_metrics"), F.col("report_type")
    row, column = m["row_comparison"], m["column_comparison"]
    done = F.col("run_metrics.exception_message") == ""
    row_ok = (row["missing_in_source"] == 0) & (row["missing_in_target"] == 0)
    column_ok = (column["absolute_mismatch"] == 0) & (column["threshold_mismatch"] == 0)
    joined = main.drop("table_name", "recon_id", "report_type").join(metrics, "recon_table_id")
    return joined.select(
        "recon_id", "source_table", "target_table", "report_type",
        F.when(done & r.isin("row", "data", "all"), row_ok).alias("row_status"),
        F.when(done & r.isin("data", "all"), column_ok).alias("column_status"),
        F.when(done & r.isin("schema", "all"), m["schema_comparison"]).alias("schema_status"),
        F.col("run_metrics.status").alias("status"), F.col("run_metrics.exception_message").alias("exception_message"),
    )


def report_summary(rows: DataFrame) -> DataFrame:
    """A line for each run and table, with the counts laid out flat."""
    at = F.col("recon_metrics.row_comparison")
    column = F.col("recon_metrics.column_comparison")
    return rows.select("recon_id", "table_name", "report_type", at["missing_in_source"].alias("missing_in_source"), at["missing_in_target"].alias("missing_in_target"), column["absolute_mismatch"].alias("mismatch"), column["threshold_mismatch"].alias("threshold_mismatch"), column["mismatch_columns"].alias("mismatch_columns"), F.col("run_metrics.status").alias("status"))


def report_failures(main: DataFrame, rows: DataFrame) -> DataFrame:
    """Of each day and run: targets that agree, that do not, and the names of those that do not."""
    bad = ~F.col("run_metrics.status")
    dated = main.select("recon_table_id", F.to_date("start_ts").alias("day")).join(rows, "recon_table_id")
    return dated.groupBy("day", "recon_id").agg(F.count_if(~bad).alias("agree"), F.count_if(bad).alias("failed"), F.array_join(F.array_sort(F.collect_set(F.when(bad, F.col("table_name")))), ",").alias("failed_tables"))


def schema_details(compared: DataFrame, run: str, name: str) -> DataFrame:
    """The store's row of a schema comparison: ids, `schema`, status and a map for each column."""
    cells = F.create_map(*[x for c in compared.columns for x in (F.lit(c), F.col(c).cast("string"))])
    return compared.agg(F.bool_and("is_valid").alias("status"), F.collect_list(cells).alias("data")).select(table_id(run, name).alias("recon_table_id"), F.lit("schema").alias("recon_type"), "status", "data")


def report_schema_details(main: DataFrame, details: DataFrame) -> DataFrame:
    """Schema details spread to a line for each column of each compared table."""
    rows = details.where("recon_type = 'schema'").select("recon_table_id", F.explode("data").alias("m"))
    columns = [F.col("m")[c].alias(c) for c in ("source_column", "source_type", "target_type", "is_valid")]
    return main.join(rows, "recon_table_id").select("recon_id", "table_name", *columns)


def aggregate_metrics(classes: DataFrame, run: str, name: str) -> DataFrame:
    """A row for each rule of an aggregate comparison: ids, counts by status, and the rule's verdict."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    per = classes.groupBy("rule").agg(count("mismatch"), count("missing_in_source"), count("missing_in_target"))
    good = (F.col("mismatch") == 0) & (F.col("missing_in_source") == 0) & (F.col("missing_in_target") == 0)
    return per.select(table_id(run, name).alias("recon_table_id"), F.lit(run).alias("recon_id"), F.lit(name).alias("table_name"), F.xxhash64(F.lit(run), F.lit(name), "rule").alias("rule_id"), "rule", "mismatch", "missing_in_source", "missing_in_target", good.alias("status"), F.lit("").alias("exception_message"))


def aggregate_rule_records(classes: DataFrame, run: str, name: str, groups: list[str]) -> DataFrame:
    """rule_id, rule_type, rule_info (map) of each rule."""
    info = F.create_map(F.lit("agg_rule"), F.col("rule"), F.lit("group_by"), F.lit(",".join(groups)))
    return classes.select("rule").distinct().select(F.xxhash64(F.lit(run), F.lit(name), "rule").alias("rule_id"), F.lit("AGGREGATE").alias("rule_type"), info.alias("rule_info"))


def aggregate_details_record(classes: DataFrame, run: str, name: str, groups: list[str], most: int = 50) -> DataFrame:
    """ids, recon_type, status, data: for each rule and kind of difference at most `most` groups as string maps."""
    w = Window.partitionBy("rule", "status").orderBy(*groups)
    # Spark limits each group before and after the shuffle
    few = classes.where("status != 'match'").withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most)
    cells = F.create_map(*[x for c in (*groups, "source_value", "target_value") for x in (F.lit(c), F.col(c).cast("string"))])
    # maps have no order of their own, so they are ordered as text beside their number
    listed = F.sort_array(F.collect_list(F.struct("nth", F.to_json(cells).alias("m"))))
    per = few.groupBy("rule", "status").agg(listed.alias("rows"))
    data = F.transform("rows", lambda x: F.from_json(x["m"], "map<string,string>"))
    return per.select(table_id(run, name).alias("recon_table_id"), F.xxhash64(F.lit(run), F.lit(name), "rule").alias("rule_id"), F.col("status").alias("recon_type"), F.lit(False).alias("status"), data.alias("data"))


def final_aggregate_status(main: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per table pair: whether every rule holds, and the exceptions met, each once."""
    joined = main.select("recon_table_id", "source_table", "target_table").join(metrics, "recon_table_id")
    message = F.array_join(F.array_sort(F.collect_set(F.when(F.col("exception_message") != "", F.col("exception_message")))), ", ")
    return joined.groupBy("recon_id", "source_table", "target_table").agg(F.bool_and("status").alias("status"), message.alias("exception_message"))


def report_aggregate_summary(main: DataFrame, metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """A line for each rule of each run: what it is, its counts and verdict."""
    joined = main.select("recon_table_id", "source_table").join(metrics, "recon_table_id").join(rules, "rule_id")
    return joined.select("recon_id", "source_table", F.col("rule_info")["agg_rule"].alias("agg_rule"), F.col("rule_info")["group_by"].alias("group_by"), "mismatch", "missing_in_source", "missing_in_target", "status")


def report_aggregate_details(rules: DataFrame, details: DataFrame) -> DataFrame:
    """Aggregate details as long rows: agg_rule, recon_type, rn, key, value."""
    rows = details.join(rules, "rule_id").select(F.col("rule_info")["agg_rule"].alias("agg_rule"), "recon_type", F.posexplode("data").alias("rn", "m"))
    return rows.select("agg_rule", "recon_type", (F.col("rn") + 1).alias("rn"), F.explode("m").alias("key", "value"))
