"""Every query of the catalogue against its DuckDB twin, and the operators on small cases."""

import datetime
import decimal
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from sluice.functions import sql
from sluice.operators import calendars, checks, contacts, discovery, histories, numbering, periods, recon, sensors, tables, zones
from sluice.plans import catalog
from sluice.sources import stores
from sluice.streaming import feeds

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)[:19].replace(" 00:00:00", "")
    return x


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    rows, cols = df.collect(), df.columns
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert cols
        return
    got = duck.execute(sql)
    there = [c[0] for c in got.description]
    assert sorted(there) == sorted(cols)
    order = [there.index(c) for c in cols]
    expected = sorted(repr([plain(r[i]) for i in order]) for r in got.fetchall())
    assert sorted(repr([plain(v) for v in r]) for r in rows) == expected


def pair(spark):
    s = spark.createDataFrame([(1, 11, "a1"), (2, 22, "b2"), (3, 33, "c3"), (5, 55, "e5"), (None, 1, "n")], "k long, n long, v string")
    t = spark.createDataFrame([(1, 11, "a1"), (2, 22, "b4"), (4, 44, "d4"), (5, 56, "e5"), (None, 1, "n")], "k long, n long, v string")
    return s, t


def test_classify_null_keys(spark):
    got = {(r["k"], r["n"]): r["status"] for r in recon.classify(*pair(spark), recon.ReconSpec(("k", "n"))).collect()}
    assert got == {(1, 11): "match", (2, 22): "mismatch", (3, 33): "missing_in_target", (5, 55): "missing_in_target", (4, 44): "missing_in_source", (5, 56): "missing_in_source", (None, 1): "match"}


def test_hash_keeps_columns_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    assert df.select(recon.row_hash(df)).distinct().count() == 2
    assert df.select(recon.row_hash(df, compat=True)).distinct().count() == 1


def test_column_sets_must_agree(spark):
    s, t = pair(spark)
    with pytest.raises(ValueError):
        recon.column_matches(s, t.drop("v"), recon.ReconSpec(("k",)))


def test_strict_nulls(spark):
    a, b = spark.createDataFrame([(1, None)], "g int, v int"), spark.createDataFrame([(1, 3)], "g int, v int")
    rule = {"m": F.max("v")}
    assert recon.aggregate_compare(a, b, ["g"], rule).first()["status"] == "mismatch"
    assert recon.aggregate_compare(a, b, ["g"], rule, strict_nulls=False).first()["status"] == "match"


def test_schema_types(spark):
    df = spark.createDataFrame([], "a decimal(10,1), b decimal(20,1), c string, d double")
    got = {r["source_column"]: r["is_valid"] for r in recon.schema_compare([("a", "number(10,1)"), ("b", "number(20,2)"), ("c", "varchar(9)"), ("d", "float"), ("e", "int")], df).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": True, "e": False}


def test_merge_is_idempotent(spark):
    s, t = (x.select("k", "v") for x in pair(spark))
    once = tables.merge(s, t, ["k"]).drop("action")
    again = tables.merge(once, t, ["k"])
    assert again.where("action in ('inserted', 'updated')").count() == 0


def test_expect_or_fail(spark):
    s, _ = pair(spark)
    with pytest.raises(Exception, match="expectation failed"):
        tables.expect_or_fail(s, {"key": "k is not null"}).collect()


def test_islands_touching_nested_and_gap(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, 9), (1, 2, 3), (1, 20, 21), (2, 1, 2)], "k int, a int, b int")
    assert sorted(map(tuple, periods.islands(df, ["k"], "a", "b").collect())) == [(1, 0, 9, 3), (1, 20, 21, 1), (2, 1, 2, 1)]
    assert sorted(map(tuple, periods.islands(df, ["k"], "a", "b", 11).collect())) == [(1, 0, 21, 4), (2, 1, 2, 1)]


def test_hierarchy_cuts_cycles(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "c int, p int")
    got = sorted(map(tuple, periods.hierarchy(df, "c", "p", 10, lambda x: x.persist()).collect()))
    assert got == [(1, 2, 1), (1, 3, 2), (2, 1, 2), (2, 3, 1), (3, 1, 1), (3, 2, 2)]


def test_jdbc_ranges(spark, tmp_path):
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    rows = spark.range(100).selectExpr("id as k", "cast(id * 2 as string) as v")
    rows.write.format("jdbc").option("url", url).option("dbtable", "t").option("driver", "org.apache.derby.jdbc.EmbeddedDriver").save()
    got = stores.read_jdbc(spark, url, 'select * from t where "k" < 90', "k", 0, 90, 4, driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert got.columns == ["k", "v"] and got.rdd.getNumPartitions() == 4
    assert sorted(r["k"] for r in got.collect()) == list(range(90))


def test_jdbc_urls():
    assert stores.jdbc_url("mssql", "h", "d", encrypt="true") == "jdbc:sqlserver://h:1433;databaseName=d;encrypt=true"
    assert stores.jdbc_url("oracle", "h", "d") == "jdbc:oracle:thin:@//h:1521/d"
    assert stores.jdbc_url("snowflake", "h", "d", warehouse="w") == "jdbc:snowflake://h/?db=d&warehouse=w"
    with pytest.raises(ValueError):
        stores.jdbc_url("other", "h", "d")


def test_increment_repeats_and_empty(spark, tmp_path):
    store, folder = stores.WatermarkStore(spark, f"{tmp_path}/marks"), f"{tmp_path}/t"
    df = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    assert stores.load_increment(store, "t", df.limit(0), "k", folder, 1) == 0 and store.last("t") is None
    assert stores.load_increment(store, "t", df.where("k < 3"), "k", folder, 2) == 2
    assert stores.load_increment(store, "t", df, "k", folder, 3) == 1 and store.last("t") == "3"
    assert spark.read.parquet(folder).count() == 3


def test_load_all_reports_failures(spark, tmp_path):
    def bad():
        raise RuntimeError("no such source")

    got = {r["table_name"]: (r["status"], r["n_rows"]) for r in stores.load_all(spark, {"a": lambda: spark.range(5), "b": bad}, str(tmp_path), retries=1).collect()}
    assert got == {"a": ("ok", 5), "b": ("failed", 0)}


def test_change_table_takes_late_changes(spark, tmp_path):
    for i, rows in enumerate([[(1, 5, "c")], [(1, 2, "a"), (1, 3, "b"), (2, 1, "x")]]):
        spark.createDataFrame(rows, "k long, seq long, v string").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        if i == 0:
            stream = lambda: feeds.file_stream(spark, f"{tmp_path}/in/*/*.parque[t]", "k long, seq long, v string", 1)
    changes = feeds.ChangeTable(f"{tmp_path}/s2", feeds.scd2_step(["k"], "seq", ["v"], F.lit(False)), ["k"], "seq").run(stream())
    got = sorted(map(tuple, feeds.versions(changes, ["k"], "seq", ["v"]).collect()))
    assert got == [(1, "a", 2, 3), (1, "b", 3, 5), (1, "c", 5, None), (2, "x", 1, None)]
    top = feeds.ChangeTable(f"{tmp_path}/s1", feeds.scd1_step(["k"], "seq", ["v"], F.col("v") == "x"), ["k"], "seq").run(stream())
    assert sorted(map(tuple, top.collect())) == [(1, 5, "c", False), (2, 1, "x", True)]


def test_zones_on_odd_rings(spark):
    square = [(1, 0, 0.0, 0.0), (1, 1, 0.0, 4.0), (1, 2, 4.0, 4.0), (1, 3, 4.0, 0.0)]  # clockwise, open
    line = [(2, 0, 1.0, 1.0), (2, 1, 3.0, 3.0), (2, 2, None, 3.0)]
    v = spark.createDataFrame(square + line, "zone_id long, seq int, x double, y double")
    m = {r["zone_id"]: r for r in zones.measures(v.where("zone_id = 1")).collect()}
    assert (m[1]["signed_area"], m[1]["area"], m[1]["perimeter"], m[1]["cx"], m[1]["cy"]) == (-16.0, 16.0, 16.0, 2.0, 2.0)
    turned = zones.measures(zones.fix_orientation(v.where("zone_id = 1"))).first()
    assert turned["signed_area"] == 16.0
    p = spark.createDataFrame([(1, 2.0, 2.0), (1, 2.0, 2.0), (2, 9.0, 9.0), (3, None, 1.0)], "id long, x double, y double")
    assert sorted(map(tuple, zones.points_in_zones(p, v, "id", 1.5).collect())) == [(1, 1)]
    assert {(r[0], r[1]) for r in zones.assign(p, v, "id", 1.5).collect()} == {(1, 1), (2, None), (3, None)}
    ok = {r["zone_id"]: r for r in zones.validity(v).collect()}
    assert (ok[1]["closed"], ok[1]["few"], ok[1]["bad"]) == (False, False, 0) and (ok[2]["few"], ok[2]["bad"]) == (True, 1)
    assert zones.cover(v, 1.0).where("zone_id = 1").count() == 16
    assert zones.assign(p, v.limit(0), "id", 1.5).where("zone_id is null").count() == 4
    assert zones.shift_scale(v.where("zone_id = 1"), 1.0, 0.0, 2.0).agg(F.min("x"), F.max("x")).first() == (-1.0, 7.0)


def test_zones_with_holes_and_parts(spark):
    texts = [
        (1, "POLYGON ((0 0, 1e1 0, 1E+1 10.0, 0 10, 0 0), (3 3, 7 3, 7 7, 3 7, 3 3))"),
        (2, "multipolygon( ((20 0,24 0,24 4,20 4,20 0)) , ((30 0, 34 0, 34 4, 30 4, 30 0),(31 1,33 1,33 3,31 3,31 1)) )"),
        (3, "SRID=4326;POLYGON Z((40 -0.5e1 7, 44 -5 7, 44 -1 7, 40 -1 7, 40 -5 7))"),
        (4, None),
        (5, "POLYGON EMPTY"),
    ]
    v = zones.vertices(spark.createDataFrame(texts, "id long, wkt string"), "id", "wkt")
    got = [tuple(r) for r in v.where("zone_id = 2 and part = 1 and ring = 1").orderBy("seq").collect()]
    assert got == [(2, 1, 1, i, x, y) for i, (x, y) in enumerate([(31.0, 1.0), (33.0, 1.0), (33.0, 3.0), (31.0, 3.0), (31.0, 1.0)])]
    m = {r["zone_id"]: (r["area"], r["perimeter"], r["cx"], r["cy"]) for r in zones.measures(v).collect()}
    assert m == {1: (84.0, 56.0, 5.0, 5.0), 2: (28.0, 40.0, (16 * 22 + 12 * 32) / 28, 2.0), 3: (16.0, 16.0, 42.0, -3.0)}
    turned = {(r["zone_id"], r["part"], r["ring"]): r["signed_area"] for r in zones.ring_measures(zones.fix_orientation(v)).collect()}
    assert turned == {(1, 0, 0): 100.0, (1, 0, 1): -16.0, (2, 0, 0): 16.0, (2, 1, 0): 16.0, (2, 1, 1): -4.0, (3, 0, 0): 16.0}
    assert zones.measures(zones.fix_orientation(v)).where("zone_id = 1").first()["signed_area"] == 84.0
    assert {r["zone_id"]: r["n"] for r in zones.cover(v, 1.0).groupBy("zone_id").agg(F.count("*").alias("n")).collect()} == {1: 84, 2: 28, 3: 16}
    assert zones.validity(v).where("closed and not few and bad = 0 and repeated = 0").count() == 6
    p = spark.createDataFrame([(1, 5.0, 5.0), (2, 2.0, 5.0), (3, 22.0, 2.0), (4, 32.0, 2.0), (5, 30.5, 2.0), (6, 27.0, 2.0), (7, 42.0, -3.0)], "id long, x double, y double")
    for size in (0.7, 3.0, 100.0):
        assert sorted(map(tuple, zones.points_in_zones(p, v, "id", size).collect())) == [(2, 1), (3, 2), (5, 2), (7, 3)]


@pytest.mark.parametrize("text", ["", "POINT(1 2)", "POLYGON((0 0, 1 x, 1 1))", "POLYGON(0 0, 1 1, 2 2)", "POLYGON((0 0, 1, 2 2))", "MULTIPOLYGON((0 0, 1 1, 2 0))", "POLYGON((0 0, 1 1, 2 0)) trailing"])
def test_texts_that_are_no_polygon_fail(spark, text):
    with pytest.raises(Exception, match="no polygon"):
        zones.vertices(spark.createDataFrame([(1, text)], "id long, wkt string"), "id", "wkt").collect()


def test_points_within_an_error_distance(spark):
    v = zones.vertices(spark.createDataFrame([(1, "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))")], "id long, wkt string"), "id", "wkt")
    at = {"inside": (2, 2), "edge": (10, 5), "vertex": (10, 10), "out 0.5": (10.5, 5), "corner": (10.1875, 10.25), "hole": (5, 5), "hole edge": (6, 5), "far": (500, 5)}
    want = {
        None: {"inside"},
        -1.0: {"inside"},
        0.0: {"inside", "edge", "vertex", "hole edge"},
        0.49: {"inside", "edge", "vertex", "hole edge", "corner"},
        0.5: {"inside", "edge", "vertex", "hole edge", "out 0.5", "corner"},
        1.0: {"inside", "edge", "vertex", "hole edge", "out 0.5", "corner", "hole"},
        490.0: set(at),
    }
    rows = [(f"{name}|{b}", float(x), float(y), b) for b in want for name, (x, y) in at.items()]
    p = spark.createDataFrame([*rows, ("null", None, 1.0, 5.0)], "id string, x double, y double, err double")
    for size in (0.25, 4.0):
        got = {r["id"] for r in zones.points_in_zones(p, v, "id", size, most=16, buffer="err").collect()}
        # half open without a distance: the right and upper edges are outside, the hole's are inside
        assert got == {f"{name}|{b}" for b, names in want.items() for name in names | ({"hole edge"} if b in (None, -1.0) else set())}
    assert zones.points_in_zones(p.limit(0), v, "id", 1.0, buffer="err").count() == 0


def test_rows_are_compared_exactly(spark):
    """Neither 0.004 nor 900 ms is rounded away; null is no value."""
    a = spark.createDataFrame([(1, 10.001, "2024-01-01 00:00:00.1", None), (2, 1e17, "2024-01-01 00:00:00", "x")], "k int, v double, t string, s string").withColumn("t", F.col("t").cast("timestamp"))
    b = a.withColumn("v", F.when(F.col("k") == 1, F.col("v") + 0.004).otherwise(F.col("v")))
    c = a.withColumn("t", F.when(F.col("k") == 1, F.col("t") + F.expr("interval 900 milliseconds")).otherwise(F.col("t")))
    spec = recon.ReconSpec(("k",))
    for other in (b, c):
        assert {r["k"]: r["status"] for r in recon.classify(a, other, spec).collect()} == {1: "mismatch", 2: "match"}
    rough = recon.ReconSpec(("k",), transforms={"v": "cast(v as decimal(18,2))"}, columns=("v",))
    one = a.where("k = 1")
    assert {r["status"] for r in recon.classify(one, one.withColumn("v", F.col("v") + 0.003), rough).collect()} == {"match"}


def test_aggregates_keep_their_type(spark):
    a, b = (spark.createDataFrame([(2**53 + i, "b"), (1, "a")], "n long, s string") for i in (0, 1))
    got = {r["rule"]: r["status"] for r in recon.aggregate_compare(a, b, [], {"n": F.max("n"), "s": F.min("s")}).collect()}
    assert got == {"n": "mismatch", "s": "match"}


def test_change_table_goes_on_after_a_restart(spark, tmp_path):
    folder, into = f"file://{tmp_path}/t", f"file://{tmp_path}/in"
    step = feeds.scd1_step(["k"], "n", ["v"], F.col("v") == "gone")
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, n int, v string").coalesce(1).write.mode("append").parquet(into)
    read = lambda: feeds.file_stream(spark, f"{into}/*.parquet", "k int, n int, v string", 1).drop("source_file", "loaded_at")
    made = lambda: feeds.ChangeTable(folder, step, ["k"], "n", 1000)
    made().run(read())
    for rows in ([(1, 2, "c")], [(2, 3, "gone"), (3, 1, "d")]):
        spark.createDataFrame(rows, "k int, n int, v string").coalesce(1).write.mode("append").parquet(into)
        state = made().run(read())
    assert {r["k"]: (r["v"], r["deleted"]) for r in state.collect()} == {1: ("c", False), 2: ("gone", True), 3: ("d", False)}
    assert made().run(read()).count() == 3  # nothing new
    # the last batch wrote the two buckets of its keys; that of key 1 stands where the batch before wrote it
    held = {n: sorted(p.name for p in (tmp_path / "t" / "state" / n).glob("bucket=*")) for n in "012"}
    assert len(held["2"]) == 2 and len(held["1"]) == 1 and held["1"][0] not in held["2"]
    # the batch comes again after its manifest was lost: the same rows, nothing twice
    again = made()
    before = sorted(map(tuple, state.collect()))
    again._work(spark.createDataFrame([(2, 3, "gone"), (3, 1, "d")], "k int, n int, v string"), 2)
    assert sorted(map(tuple, again.state(spark).collect())) == before
    with pytest.raises(RuntimeError, match="manifest"):
        again._work(state, 9)


def test_versions_that_ended_leave_the_state(spark, tmp_path):
    step = feeds.scd2_step(["k"], "seq", ["v"], F.col("v") == "x")
    late, keeps = (feeds.ChangeTable(f"file://{tmp_path}/{n}", step, ["k"], "seq", 8, n) for n in (10, None))
    batches = [
        [(1, 1, "a"), (1, 2, "a"), (1, 5, "b"), (2, 3, "a"), (3, 4, "a")],
        [(1, 30, "c"), (1, 4, "c"), (2, 31, "x"), (3, 33, "a")],  # 4 lies between changes known before
        [(1, 50, "c"), (2, 52, "d"), (1, 25, "z")],
        [(1, 60, "d"), (1, 43, "e"), (2, 55, "d"), (3, 70, "b")],
    ]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k int, seq long, v string")
        for t in (late, keeps):
            t._work(df, i)
            t._work(df, i)  # every batch comes twice
    want = sorted(map(tuple, feeds.versions(keeps.state(spark), ["k"], "seq", ["v"]).collect()), key=str)
    got = feeds.versions(late.state(spark), ["k"], "seq", ["v"]).unionByName(late.finished(spark))
    assert sorted(map(tuple, got.collect()), key=str) == want and late.finished(spark).count() > 3
    assert late.state(spark).count() < keeps.state(spark).count() and keeps.finished(spark) is None
    late._work(spark.createDataFrame([(3, 55, "far too late"), (3, 71, "c")], "k int, seq long, v string"), 4)
    assert late.state(spark).where("v = 'far too late'").count() == 0


def test_vendor_presets():
    options = stores.vendor_options("oracle", user="u", password="p", token="")
    assert options["user"] == "u" and "token" not in options and options["oracle.jdbc.mapDateToTimestamp"] == "false"
    assert "all_tab_columns" in stores.schema_query("oracle", "db", "HR", "O'Neil") and "o''neil" in stores.schema_query("oracle", "db", "HR", "O'Neil")
    with pytest.raises(ValueError):
        stores.vendor_options("none")


def test_levels_follow_longest_paths(spark):
    save = stores.materialize
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (4, 3), (3, 5), (None, 9)], "a int, b int")
    assert {r["node"]: r["level"] for r in checks.levels(edges, "a", "b", save).collect()} == {1: 0, 4: 0, 2: 1, 3: 2, 5: 3}
    assert {(r["root"], r["node"]) for r in checks.at_depth(edges, "a", "b", 2, save).collect()} == {(1, 5), (4, 5)}
    with pytest.raises(ValueError):
        checks.levels(edges.union(spark.createDataFrame([(5, 2)], "a int, b int")), "a", "b", save)


def test_time_categories(spark):
    rows = [(m, s, e) for m, s, e in ((480, 480, 960), (960, 480, 960), (479, 480, 960), (961, 480, 960), (700, 480, 960), (60, 1320, 360), (1330, 1320, 360), (700, 1320, 360), (1, None, 5), (10, 1320, 360))]
    df = spark.createDataFrame(rows, "m int, s int, e int").withColumn("b", F.expr("array(struct(690 as `from`, 720 as `to`), struct(1435 as `from`, 15 as `to`))"))
    got = [r[0] for r in df.select(sensors.time_category(F.col("m"), F.col("s"), F.col("e"), F.col("b"))).collect()]
    assert got == ["during", "during", "before", "after", "break", "during", "during", "before", "none", "break"]
    texts = spark.createDataFrame([("8:30:00",), ("7.5",), ("x",), (None,), ("10:15",)], "t string")
    assert [r[0] for r in texts.select(sensors.hours(F.col("t"))).collect()] == [8.5, 7.5, None, None, 10.25]


def test_contacts_broadcast_no_readings(spark):
    df = spark.createDataFrame([(1, i, datetime.datetime(2024, 1, 1), 0.0, 0.0) for i in range(3)], "floor int, w int, at timestamp, x double, y double")
    met = contacts.pairs(df, "w", "at", ["floor"], 90, 3.0)
    assert met.count() == 6
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["calendar_days", "contact_network", "contacts_rule_scope"])
def test_deals_in_full(spark, sf_dir, name):
    """Tasks do not grow for few bytes, and nothing as long as a table is broadcast (rules may be: they are a row a nation)."""
    plan = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and (name == "contacts_rule_scope" or "BroadcastHashJoin" not in plan)


def test_discovery_counts_columns_once(spark, monkeypatch):
    seen, stats = [], discovery.column_stats
    monkeypatch.setattr(discovery, "column_stats", lambda df: seen.append(1) or stats(df))
    rows = discovery.discover({"t": spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")}).collect()
    assert len(seen) == 1 and {r["column_name"]: r["in_key"] for r in rows} == {"a": False, "b": True}


def test_nearest_points_of_one_place(spark):
    """Copies share their place's look-up, and cells narrow where points stand closely."""
    rows = [(i, float(i % 40 // 5), float(i % 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    places = periods._places(df, 3)
    assert places.count() == 40 and places.where("size(ids) > 4").isEmpty()
    assert periods._first_size(places, 64.0, 4) <= 2.0
    got = {}
    for r in periods.nearest(df, "id", 64.0, 3, stores.materialize).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"], r["d2"]))
    for i, _, _ in rows:  # fifty copies of a place: the least three others
        assert sorted(got[i]) == [(n + 1, o, 0.0) for n, o in enumerate([o for o in range(i % 40, 200, 40) if o != i][:3])]


def test_nearest_points_widen(spark):
    rows = [(i, float(i % 5), float(i // 5)) for i in range(20)] + [(99, 5000.0, 5000.0), (100, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    got = {}
    for r in periods.nearest(df, "id", 1.0, 3, stores.materialize).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"]))
    for i, x, y in rows[:-1]:
        want = sorted((((x - a) ** 2 + (y - b) ** 2), o) for o, a, b in rows[:-1] if o != i)[:3]
        assert sorted(got[i]) == [(n + 1, o) for n, (_, o) in enumerate(want)]
    assert 100 not in got


def test_optional_source(spark, sf_dir, tmp_path):
    there = stores.optional(spark, f"{sf_dir}/nation.parquet", "n_nationkey long, none string")
    assert there.count() == 25 and there.where("none is not null").count() == 0
    gone = stores.optional(spark, f"{tmp_path}/none.parquet", "a long")
    assert gone.columns == ["a"] and gone.count() == 0


def test_contacts_match_all_pairs_of_readings(spark):
    import random
    from datetime import datetime, timedelta, timezone

    g = random.Random(5)
    base = datetime(2024, 5, 1, tzinfo=timezone.utc)
    for sphere in (False, True):
        rows = []
        for i in range(160):
            x, y = (g.uniform(-6, 6), g.uniform(-6, 6)) if not sphere else (g.choice([179.99995, -179.99995, 10.0]) + g.uniform(-4e-5, 4e-5), g.choice([60.0, -33.0]) + g.uniform(-4e-5, 4e-5))
            rows.append((g.randrange(12), g.randrange(2), base + timedelta(seconds=g.randrange(600)), x, y, g.randrange(4), g.randrange(60)))
        rows += rows[:5] + [(None, 0, base, 0.0, 0.0, 0, 0), (1, None, base, 0.0, 0.0, 0, 0), (1, 0, None, 0.0, 0.0, 0, 0), (1, 0, base, None, 0.0, 0, 0)]
        df = spark.createDataFrame(rows, "w int, floor int, at timestamp, x double, y double, zone int, active int")
        met = contacts.pairs(df, "w", "at", ["floor"], 90, 3.0, "zone", "active", sphere=sphere)

        def apart(a, b):
            if not sphere:
                return math.dist(a[3:5], b[3:5])
            (l1, p1), (l2, p2) = (tuple(map(math.radians, r[3:5])) for r in (a, b))
            h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
            return 2 * 6371000 * math.asin(math.sqrt(h))

        sound = [r for r in set(rows) if None not in r]
        want = [(a[1], a[0], b[0], b[2], a[5], b[6], round(apart(a, b), 6)) for a in sound for b in sound if a[0] != b[0] and a[1] == b[1] and abs((a[2] - b[2]).total_seconds()) <= 90 and apart(a, b) <= 3.0]
        got = [(r["floor"], r["worker"], r["other"], r["at"].astimezone(timezone.utc), r["zone"], r["active"], round(r["distance"], 6)) for r in met.collect()]
        assert len(want) > 50 and sorted(got) == sorted(want)
        total = {(r["floor"], r["worker"], r["other"]): (r["contacts"], r["duration"], r["mean_distance"]) for r in contacts.aggregate(met, ["floor"]).collect()}
        best = {}
        for f, a, b, at, _, active, dist in want:
            n, d = best.get((f, a, b, at), (0, 1e9))
            best[f, a, b, at] = (max(n, active), min(d, dist))
        for key in total:
            mine = [v for k, v in best.items() if k[:3] == key]
            assert total[key][:2] == (len(mine), sum(n for n, _ in mine)) and abs(total[key][2] - sum(d for _, d in mine) / len(mine)) < 1e-5
    with pytest.raises(ValueError, match="latitude"):
        contacts.pairs(spark.createDataFrame([(1, 0, base, 0.0, 89.5, 0, 0)], df.schema), "w", "at", ["floor"], 90, 3.0, sphere=True)


@pytest.mark.parametrize("small", [100_000, 0])
def test_wildcard_rules_match_by_their_columns(spark, small):
    facts = [(i, i % 3 if i % 5 else None, "ab"[i % 2] if i % 7 else None) for i in range(30)]
    rules = [(k, u, t) for k, (u, t) in enumerate([(0, "a"), (1, None), (None, "b"), (None, None), (2, "b"), (None, None), (9, None), (0, "a")])]
    f, r = spark.createDataFrame(facts, "id int, u int, t string"), spark.createDataFrame(rules, "rule int, u int, t string")
    got = sorted(map(tuple, contacts.wildcard_join(f, r, ["u", "t"], small).select("id", "rule").collect()))
    assert got == sorted((i, k) for i, u, t in facts for k, ru, rt in rules if ru in (None, u) and rt in (None, t))
    assert contacts.wildcard_join(f, r.limit(0), ["u", "t"], small).columns == ["id", "u", "t", "rule"]
    assert contacts.wildcard_join(f, r.limit(0), ["u", "t"], small).count() == 0


def test_numbers_are_dense_and_ordered_without_a_global_window(spark, capsys):
    df = spark.createDataFrame([(i * 37 % 101, "x" if i % 2 else None) for i in range(500)] + [(None, None)], "a int, b string")
    out = numbering.surrogate_keys(df, ["a", "b"], "id", stores.materialize)
    rows = out.orderBy("id").collect()
    values = [(r["a"], r["b"]) for r in rows]
    assert [r["id"] for r in rows] == list(range(1, 204)) and len(set(values)) == 203
    assert values == sorted(values, key=lambda v: (v[0] is not None, v[0] or 0, v[1] is not None, v[1] or ""))
    out.explain()
    assert "Window" not in capsys.readouterr().out
    repeated = numbering.numbered(spark.createDataFrame([(1,)] * 7, "a int"), ["a"], "n", stores.materialize, 3)
    assert sorted(r["n"] for r in repeated.collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert numbering.surrogate_keys(df.limit(0), ["a"], "id", stores.materialize).count() == 0


def test_keys_and_watermarks_are_found(spark):
    rows = [(i // 4, i % 4, i % 8, float(i), None if i == 3 else i, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=i)) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b int, c int, measure double, holed int, at timestamp").drop("at")
    assert discovery.keys(df) == [("a", "b"), ("a", "c")]
    assert discovery.keys(df.select("b", "c")) == [] and discovery.keys(df.limit(0)) == []
    assert discovery.keys(df.union(df.limit(1))) == []  # one repeated row
    full = spark.createDataFrame(rows, "a int, b int, c int, measure double, holed int, at timestamp")
    stats = {r["column_name"]: r for r in discovery.column_stats(full).collect()}
    assert (stats["holed"]["nulls"], stats["c"]["lo"], stats["c"]["hi"], stats["c"]["about"]) == (1, "0", "7", 8)
    assert discovery.watermarks(full, list(stats.values())) == ["at", "a", "c", "b"]
    assert discovery.watermarks(full, list(stats.values()), ("b",))[0] == "b"
    none = discovery.discover({"t": full.limit(0)}).collect()
    assert not any(r["in_key"] or r["is_watermark"] for r in none) and len(none) == 6


def test_days_of_a_calendar(spark):
    d = datetime.date
    details = [  # 2024-01-01 is a Monday
        (1, 2, None, 480, 960, 30, d(2024, 1, 1), d(2024, 1, 15), False),  # Mondays, two of them
        (1, 2, None, 600, 700, None, d(2024, 1, 22), None, False),  # and again after a gap
        (1, 4, None, 1320, 360, 60, None, None, False),  # Wednesdays over midnight, always
        (1, 6, None, 0, 10, None, None, None, True),  # deleted
        (1, None, d(2024, 1, 3), None, None, None, None, None, False),  # a Wednesday off
        (1, None, d(2024, 1, 4), 600, 660, None, None, None, False),  # a Thursday of its own
        (2, 1, None, 0, 60, 90, d(2024, 3, 1), None, False),  # begins after the span
    ]
    df = spark.createDataFrame(details, "shift_id int, weekday int, date date, start int, end int, rest int, valid_from date, valid_to date, deleted boolean")
    shifts = spark.createDataFrame([(1, "early")], "shift_id int, shift string")
    got = {(r["shift_id"], r["day"].day): (r["hours"], r["special"]) for r in calendars.days(df, shifts, "2024-01-01", "2024-01-25").collect()}
    assert got == {(1, 1): (7.5, False), (1, 8): (7.5, False), (1, 22): (100 / 60, False), (1, 3): (0.0, True), (1, 4): (1.0, True), (1, 10): (7.0, False), (1, 17): (7.0, False), (1, 24): (7.0, False)}
    assert calendars.by_weekday(df, shifts).count() == 4 and calendars.by_date(df, shifts).where("shift = 'early'").count() == 2
    assert calendars.by_weekday(df, shifts).where("shift_id = 2").first()["hours"] == 0.0


def test_hours_are_split_at_limits(spark):
    t = lambda day, hour: datetime.datetime(2024, 1, day, hour)  # noqa: E731  the first is a Monday
    rows = [(1, 1, t(1, 6), t(1, 12)), (1, 2, t(1, 13), t(1, 18)), (1, 3, t(2, 0), t(2, 23)), (1, 4, t(3, 0), t(3, 8)), (1, 5, t(4, 0), t(4, 8)), (1, 6, t(5, 0), t(5, 9)), (1, 7, t(6, 0), t(6, 4)), (1, 8, t(8, 0), t(8, 4)), (2, 9, t(1, 5), None), (2, 10, t(1, 9), t(1, 7))]
    df = spark.createDataFrame(rows, "w int, id int, a timestamp, b timestamp")
    got = {r["id"]: (r["regular"], r["overtime"]) for r in calendars.split_hours(df, "w", "a", "b", ["id"]).collect()}
    assert got == {1: (6, 0), 2: (2, 3), 3: (8, 15), 4: (8, 0), 5: (8, 0), 6: (8, 1), 7: (0, 4), 8: (4, 0), 9: (0, 0), 10: (0, 0)}
    free = {r["id"]: (r["regular"], r["overtime"]) for r in calendars.split_hours(df, "w", "a", "b", ["id"], None, 40.0).collect()}
    assert free[2] == (5, 0) and free[4] == (6, 2) and free[5] == (0, 8)
    one = calendars.attendance(df, "w", "a", "b", ["id"]).where("w = 1 and day = '2024-01-01'").first()
    assert (one["first_start"], one["last_end"], one["entries"], one["regular"], one["overtime"]) == (t(1, 6), t(1, 18), 2, 8.0, 3.0)


def test_expectations_are_counted_as_rows_are_written(spark):
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 10 > 0, F.col("id")))
    rows, counts = checks.expect_warn(df, {"v": "v >= 50", "id": "id < 1000"}, stores.materialize)
    assert rows.count() == 100 and dict(map(tuple, counts.collect())) == {"v": 55, "id": 0}
    rows, counts = checks.expect_warn(df.limit(0), {"v": "v >= 50"}, stores.materialize)
    assert rows.count() == 0 and dict(map(tuple, counts.collect())) == {"v": 0}


def test_only_the_partitions_of_a_batch_are_overwritten(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    stores.write_overwrite(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "k int, p string"), path, ("p",))
    stores.overwrite_partitions(spark.createDataFrame([(9, "a"), (8, "c")], "k int, p string"), path, ("p",))
    stores.overwrite_partitions(spark.createDataFrame([], "k int, p string"), path, ("p",))
    assert sorted(map(str, (tuple(r) for r in spark.read.parquet(path).collect()))) == sorted(map(str, [(9, "a"), (3, "b"), (4, None), (8, "c")]))


def test_load_recovers_what_waited(spark):
    """Fresh rows win over waiting ones of their key, required and optional lookups, nulls, repeats, clashing names."""
    fresh = spark.createDataFrame([(1, 10, None, "x"), (2, 99, 5, "x"), (3, 10, 6, "x"), (None, None, 5, "x")], "id long, worker long, zone long, missed string")
    waiting = spark.createDataFrame([(2, 10, 5, "old"), (4, 10, 5, "old"), (4, 10, 5, "old"), (5, 10, 6, "old"), (6, 10, 5, "late")], "id long, worker long, zone long, missed string")
    workers = spark.createDataFrame([(10, "a"), (10, "b"), (None, "none")], "w long, name string")
    zones_ = spark.createDataFrame([(5, "five")], "z long, place string")
    looks = [histories.Lookup(workers, "worker", "w", ("name",)), histories.Lookup(zones_, "zone", "z", ("place",), False)]
    rows = histories.load(fresh, waiting, ["id"], looks, F.col("id") < 6).collect()
    got = sorted((r["id"] or 0, r["name"], r["place"], tuple(r["missed"]), r["waited"]) for r in rows)
    assert got == [
        (0, None, "five", ("worker",), False), (1, "b", None, (), False), (2, None, "five", ("worker",), False), (3, "b", None, ("zone",), False),
        (4, "b", "five", (), True), (4, "b", "five", (), True), (5, "b", None, ("zone",), True), (6, "b", "five", ("retry",), True),
    ]
    empty = fresh.limit(0)
    assert histories.load(empty, None, ["id"], looks).count() == 0 and histories.load(empty, waiting, ["id"], looks).count() == 5
    assert sorted(r["name"] or "" for r in histories.named(fresh.withColumn("name", F.lit("mine")), looks[:1]).collect()) == ["", "", "b", "b"]


def test_covering_takes_the_span_that_began_last(spark):
    rows = spark.createDataFrame([(1, "d", 5), (2, "d", 10), (3, "d", 95), (4, "d", 1000), (5, "e", 5), (6, None, 7), (7, "d", None)], "id long, k string, at long")
    spans = spark.createDataFrame([("d", 0, 10, "a"), ("d", 5, 6, "in"), ("d", 10, None, "b"), ("d", 90, 100, "c"), ("d", 90, 96, "bb"), ("d", 20, 20, "none"), (None, 7, 8, "null"), ("d", None, 9, "no")], "k string, a long, b long, what string")
    for width in (1, 7, 5000):
        got = {r["id"]: r["what"] for r in histories.covering(rows, spans, ["id"], ["k"], "at", "a", "b", width, ["what"]).collect()}
        assert got == {1: "in", 2: "b", 3: "c", 4: "b", 5: None, 6: "null", 7: None}
    assert histories.covering(rows.limit(0), spans, ["id"], ["k"], "at", "a", "b", 7, ["what"]).count() == 0
    assert histories.covering(rows, spans.limit(0), ["id"], ["k"], "at", "a", "b", 7, ["what"]).count() == 7


def test_periods_close_and_snapshots_merge(spark):
    p = spark.createDataFrame([("w", "2024-01-01", None, 1), ("w", "2024-01-05", "2024-01-07", 2), ("w", "2024-01-05", None, 1), ("w", "2024-02-01", None, 3), ("w", None, None, 9)], "k string, a string, b string, n int").selectExpr("k", "date(a) as a", "date(b) as b", "n")
    rows = histories.close_periods(p, ["k"], "a", "b", ["n"]).orderBy("a").collect()
    assert [(r["n"], str(r["b"]), r["current"], r["days"]) for r in rows] == [(1, "2024-01-05", False, 4), (2, "2024-01-07", False, 2), (3, "None", True, None)]
    ways = spark.createDataFrame([(1, 7, 0, 10, 1), (1, 8, 5, 15, 1), (1, 9, 20, 30, 2)], "c long, up long, a long, b long, level int")
    wide = histories.levels_by_slice(ways, "c", "up", "a", "b", "level", 2)
    assert [tuple(r) for r in wide.orderBy("a").collect()] == [(1, 0, 5, 1, 1, 7, None), (1, 5, 10, 1, 1, 8, None), (1, 10, 15, 1, 1, 8, None), (1, 15, 20, 0, 1, None, None), (1, 20, 30, 2, 1, None, 9)]
    old = spark.createDataFrame([(1, 0, 5), (1, 3, 5), (2, 0, 5), (3, 0, 5)], "c long, a long, v long")
    new = spark.createDataFrame([(1, 0, 6), (1, 9, 5), (3, 0, 9)], "c long, a long, v long")
    touched = spark.createDataFrame([(1,), (2,), (2,)], "c long")  # 2 has nothing left, 3 was not looked at
    got = sorted(tuple(r) for r in histories.merge_snapshots(old, new, ["c", "a"], touched, ["c"]).collect())
    assert got == [(1, 0, 6, "updated"), (1, 9, 5, "inserted"), (3, 0, 5, "kept")]


def test_strict_conversions_raise(spark):
    sql.register(spark)
    for text in ("sluice_to_boolean('maybe')", "sluice_number_to_boolean(cast('nan' as double))", "sluice_number_to_boolean(cast('-infinity' as double))", "sluice_to_decimal('x1')"):
        with pytest.raises(Exception, match="not a"):
            spark.sql(f"select {text}").collect()
    row = spark.sql("select sluice_to_boolean('oN') as a, sluice_to_boolean(null) as b, sluice_is_integer('2147483648') as c, sluice_is_integer('-7') as d, sluice_is_integer('7.0') as e, sluice_to_decimal('2.5') as f").first()
    assert (row.a, row.b, row.c, row.d, row.e, int(row.f)) == (True, None, False, True, False, 3)


def test_sliding_windows_round_times_as_their_twin(spark, tmp_path):
    """Events within a millisecond of a window's edge: from half of one before it on they count as after it."""
    edge = 1704067350 * 10**6
    times = [edge + x for x in (-1500, -501, -500, -499, -1, 0, 1, 499, 500, 150 * 10**6 - 500)]
    spark.createDataFrame([(i, t) for i, t in enumerate(times)], "event_id long, t long").select("event_id", F.timestamp_micros("t").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(catalog.oracle_sql()["stream_sliding"]).fetchall()
    assert sorted(map(tuple, catalog.queries()["stream_sliding"](spark, str(tmp_path)).collect())) == sorted(want)
