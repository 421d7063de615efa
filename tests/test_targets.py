"""Versioned and partitioned targets, bucketed and stored stages, observed figures, the formula graph."""

import pytest
from pyspark.sql import functions as F

from haulgrain import jobs
from haulgrain.functions.formulas import apply_formulas, layers, references
from haulgrain.operators.figures import Figures, fan_out
from haulgrain.operators.rollup import RollupSpec, rollup_of_repeated, wide_rollup
from haulgrain.operators.stage import Bucketed, no_stage, written
from haulgrain.operators.store import StageStore, fingerprint
from haulgrain.plans import fill_hub, fill_load, tender
from haulgrain.sources import versions as v
from haulgrain.sources.catalog import SourceCatalog, read_source
from haulgrain.sources.sink import overwrite_table
from haulgrain.testbed import queries as q
from haulgrain.testbed.frames import frame, frames

SF = "/root/testdata/sf0.001"


def failing(df):
    return df.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("stops here"))).otherwise(F.col("id")))


# --- versions


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    v.publish(spark.range(5), path)
    with pytest.raises(Exception, match="stops here"):
        v.publish(failing(spark.range(9)).repartition(3), path)
    assert [x.number for x in v.versions(spark, path) if x.complete] == [1]
    assert v.read_current(spark, path).count() == 5
    v.publish(spark.range(7), path, keep=1)
    found = v.versions(spark, path)
    assert len(found) == 1 and found[0].complete and v.read_current(spark, path).count() == 7


def test_a_job_may_read_what_it_replaces(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(4).write.parquet(path)  # a plain folder is its own first version
    for n in (5, 6):
        overwrite_table(v.read_current(spark, path).union(spark.range(1)), path)
        assert v.read_current(spark, path).count() == n
    assert len(v.versions(spark, path)) == 2 and v.current(spark, v.current(spark, path)) == v.current(spark, path)
    with pytest.raises(ValueError, match="keep"):
        v.publish(spark.range(1), path, keep=0)


def test_catalog_tables_switch_their_location(spark):
    spark.sql("DROP TABLE IF EXISTS switched")
    spark.sql("CREATE TABLE switched (id BIGINT, part STRING) USING parquet PARTITIONED BY (part)")
    rows = spark.range(6).withColumn("part", F.concat(F.lit("w/"), F.col("id") % 2))
    overwrite_table(rows, "switched")
    overwrite_table(spark.table("switched").where("id > 1"), "switched")
    assert sorted(r.id for r in spark.table("switched").collect()) == [2, 3, 4, 5]
    with pytest.raises(Exception, match="stops here"):
        overwrite_table(failing(spark.table("switched")), "switched")
    spark.catalog.refreshTable("switched")
    assert spark.table("switched").where("part = 'w/1'").count() == 2
    spark.sql("DROP TABLE switched")


def test_failed_job_keeps_its_target(spark, tmp_path):
    catalog = SourceCatalog({"on_time": f"{tmp_path}/on_time", "inter_plant": f"{tmp_path}/inter_plant"})
    rows = spark.createDataFrame([("1", "INTERPLANT"), ("2", "CUSTOMER")], "load_id string, freight_type_val string")
    jobs.write_target(rows, "on_time", catalog)
    jobs.load_inter_plant(spark, catalog)
    bad = rows.withColumn("freight_type_val", F.raise_error(F.lit("stops here")).cast("string"))
    with pytest.raises(Exception, match="stops here"):
        jobs.write_target(bad, "on_time", catalog)
    jobs.load_inter_plant(spark, catalog)
    assert [r.load_id for r in read_source(spark, "inter_plant", catalog).collect()] == ["1"]


# --- partitions


def test_only_the_newest_week_folders_are_read(spark, tmp_path):
    path = f"{tmp_path}/lanes"
    summary = frame(spark, SF, "tender_summary")
    v.publish(tender.lanes(summary, weeks=None).drop("last_update_utc_tmstp"), path, [tender.WEEK])
    weeks = v.partition_values(spark, path, tender.WEEK)
    assert len(weeks) > 100
    read = v.read_newest(spark, path, tender.WEEK, 13)
    wanted = tender.lanes(summary).drop("last_update_utc_tmstp")
    assert sorted(map(str, read.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect()))
    assert {f.split(f"{tender.WEEK}=")[1].split("/")[0] for f in opened_files(read)} == set(weeks[-13:])


def opened_files(df):
    """Files that the scan reads, which partition filters have cut down."""
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_null_weeks_rank_last(spark, tmp_path):
    rows = spark.createDataFrame([(1, "202402"), (2, "202401"), (3, None)], "id int, week string")
    v.publish(rows, f"{tmp_path}/w", ["week"])
    ids = lambda n: sorted(r.id for r in v.read_newest(spark, f"{tmp_path}/w", "week", n).collect())
    assert [ids(n) for n in (1, 2, 3)] == [[1], [1, 2], [1, 2, 3]]
    assert dict(v.read_current(spark, f"{tmp_path}/w").dtypes)["week"] == "string"
    with pytest.raises(ValueError, match="positive"):
        v.read_newest(spark, f"{tmp_path}/w", "week", 0)


def test_shipments_prune_the_loads_at_run_time(spark):
    rows = q.QUERIES["tender_shipments_pruned"](spark, SF)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert rows.count() == q.QUERIES["mart_tender_shipments"](spark, SF).count() > 0


def test_tender_job_by_week(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS weekly")
    names = ["tender_summary", "load_costs", "locations"]
    for name, df in zip(names, frames(spark, SF, *names)):
        overwrite_table(df, f"weekly.{name}")
    catalog = SourceCatalog(database="weekly")
    for _ in range(2):  # the second run replaces partitions that are there
        jobs.load_tenders(spark, catalog, by_week=True)
    assert spark.sql("SHOW PARTITIONS weekly.tender_lanes").count() == 13
    assert read_source(spark, "tender_shipments", catalog, refresh=True).count() > 0


# --- bucketed stages


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.split("\n") if "Exchange" in line and "Broadcast" not in line]


def test_loads_from_buckets_have_no_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(q.bucketed_loads(spark, SF)) == []
        plain = fill_hub.load_facts(*fill_hub.by_load(*frames(spark, SF, *q.BY_LOAD_SOURCES)))
        assert len(exchanges(plain)) > 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hub_over_buckets_is_the_same(spark):
    stage = Bucketed(spark, {name: ["load_id"] for name in (*q.BY_LOAD, "loads")}, 4, other=written(spark, "prepared"))
    got = fill_hub.build(*frames(spark, SF, *q.HUB_SOURCES), stage=stage).select(*q.HUB_PLAIN)
    assert sorted(map(str, got.collect())) == sorted(map(str, q.QUERIES["mart_fill_hub"](spark, SF).select(*q.HUB_PLAIN).collect()))
    assert stage.together("items", "loads") and not stage.together("items", "nothing")
    tables = list(stage.tables.values())
    stage.drop()
    assert not any(spark.catalog.tableExists(t) for t in tables)
    with pytest.raises(ValueError, match="buckets"):
        Bucketed(spark, {}, 0)


# --- stored stages


def test_stages_are_used_again_and_old_ones_go(spark, tmp_path):
    hub = lambda store: fill_hub.build(*frames(spark, SF, *q.HUB_SOURCES), stage=store)
    names = ("items", "loads", "prepared")
    first = StageStore(spark, *names, folder=f"{tmp_path}/store")
    hub(first)
    again = StageStore(spark, *names, folder=f"{tmp_path}/store")
    result = fill_load.build(hub(again), frame(spark, SF, "unit_costs"), stage=again)
    assert (first.used, first.written) == ([], list(names)) and (again.used, again.written) == (list(names), [])
    assert result.select("load_id").count() > 0
    other = StageStore(spark, "items", folder=f"{tmp_path}/store", keep=1)
    fill_hub.build(*frames(spark, SF, *q.HUB_SOURCES), formulas={"palletsshipped": "1"}, stage=other)
    assert other.written == ["items"] and len(v._Files(spark, str(tmp_path)).names(f"{tmp_path}/store/items")) == 1


def test_fingerprints_follow_plan_and_files(spark, tmp_path):
    path = f"{tmp_path}/f"
    spark.range(5).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    one = fingerprint(read().where("id > 1"))
    assert one == fingerprint(read().where("id > 1")) != fingerprint(read().where("id > 2"))
    assert one != fingerprint(read().where("id > 1").withColumnRenamed("id", "other"))
    wide = lambda last: read().select(*(F.lit(i).alias(f"c{i}") for i in range(60)), F.lit(last).alias("last"))
    assert fingerprint(wide(1)) != fingerprint(wide(2))
    spark.range(6).write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    assert one != fingerprint(read().where("id > 1"))
    store = StageStore(spark, folder=f"{tmp_path}/store")
    assert store(spark.range(3), "local").count() == 3 and not store.written


# --- figures


def test_figures_of_a_running_job(spark):
    figures = Figures({"left": ["k"], "joined": ["k", "v"]})
    left = figures.watch(spark.createDataFrame([(1,), (2,), (None,)], "k int"), "left")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "k int, v string")
    figures.watch(left.join(right, "k", "left"), "joined").collect()
    assert figures.of("left") == {"rows": 3, "null_keys": 1} and figures.of("joined") == {"rows": 4, "null_keys": 2}
    (row,) = fan_out(figures.frame(spark), "left", "joined").collect()
    assert round(row.fan_out, 3) == 1.333
    with pytest.raises(ValueError, match="watched"):
        figures.watch(left, "left")
    empty = Figures()
    empty.stage(no_stage)(spark.range(0), "none").collect()
    assert empty.of("none") == {"rows": 0, "null_keys": 0}


# --- formulas


def test_references_are_columns_only(spark):
    assert references("a + `b c` * max(d) - 'e' || CAST(f.g AS string)") == {"a", "b c", "d", "f"}
    assert references("transform(xs, x -> x + Y)") == {"xs", "y"}


def test_formula_order_does_not_matter(spark):
    assert layers({"c": "B + 1", "b": "a + 1", "a": "a * 2", "free": "'b'"}) == [["a", "free"], ["b"], ["c"]]
    df = spark.createDataFrame([(1,)], "a int")
    (row,) = apply_formulas(df, {"c": "b + 1", "b": "a + 1", "a": "a * 2"}).collect()
    assert (row.a, row.b, row.c) == (2, 3, 4)
    (row,) = apply_formulas(df, {"x": "a", "y": "5"}, {"x": "y + 1"}).collect()
    assert row.x == 6


def test_a_circle_of_formulas_is_named(spark):
    with pytest.raises(ValueError, match="b -> c -> b|c -> b -> c"):
        layers({"a": "b", "b": "c + 1", "c": "b"})


# --- rollup of repeated keys


def test_rollup_of_repeated_keys_is_the_plain_rollup(spark):
    rows = spark.range(400).select(
        F.when(F.col("id") % 7 > 0, (F.col("id") % 150).cast("string")).alias("k"),
        (F.col("id") % 3).alias("j"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id"))).alias("t"),
        F.when(F.col("id") % 4 > 0, F.col("id").cast("int")).alias("n"),
        F.col("id").cast("decimal(9,2)").alias("d"),
    )
    spec = RollupSpec(["k", "j"], attributes=["t"], minima={"low": "n"}, sums={"n": "n", "d": "d"}, means={"mean": "n"}, distinct_counts={"kinds": "n"}, row_count="rows")
    plain, split = wide_rollup(rows, spec), rollup_of_repeated(rows, spec)
    assert split.dtypes == plain.dtypes
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    assert rollup_of_repeated(rows.limit(0), spec).count() == 0


def test_on_time_sorts_only_rows_of_repeated_keys(spark):
    plan = q.QUERIES["mart_on_time"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.split("\n") if "Aggregate [order_num" in line and "max(" in line]
    assert wide
    # only rows that meet a key counted more than once
    below = plan[plan.index(wide[0]) :].split("\n")[1:4]
    assert any("Join Inner" in line for line in below)
