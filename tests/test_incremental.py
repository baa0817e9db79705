"""Jobs that follow up changes, and layouts that spare exchanges."""

from pathlib import Path

from conftest import SF
from pyspark.sql import functions as F

from checks.queries import silver
from tachyline.operators import features, gaps, labels
from tachyline.plans import incremental
from tachyline.plans.medallion import Layout
from tachyline.session import fresh_path, settings, stage
from tachyline.sources import tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def deliver(rows, layout):
    slice_ = stage(rows, "delivered")
    tables.note_changes(slice_, layout.at("silver_changes"))
    tables.write_silver(slice_, layout.at("silver"))


def test_only_changed_simulations_are_read_and_written(spark):
    layout = Layout(fresh_path(spark, "lakehouse"))
    rows = stage(silver(spark, SF).union().withColumn("processed_at", F.current_timestamp()), "silver-rows")
    deliver(rows.where(F.col("step") < 500), layout)
    incremental.run_gold(spark, layout)
    assert incremental.pending_changes(spark, layout).count() == 0
    one = rows.orderBy("simulation_id").first()["simulation_id"]
    deliver(rows.where(F.col("simulation_id") == one), layout)
    pending = incremental.pending_changes(spark, layout)
    assert [r["simulation_id"] for r in pending.collect()] == [one]
    changed = incremental.changed_silver(spark, layout, stage(pending, "pending").select("simulation_id").distinct())
    assert {r["simulation_id"] for r in changed.select("simulation_id").distinct().collect()} == {one}
    assert "dynamicpruning" in plan_of(changed).lower()
    incremental.run_gold(spark, layout)
    got = incremental.read_folders(spark, layout.at("gold_by_simulation"))
    rated = incremental.read_folders(spark, layout.at("rated_by_simulation"))
    want = labels.add_label(rated, labels.approximate_threshold(rated)).select("simulation_id", "step", "driving_style")
    assert got.count() == want.count()
    assert got.select(want.columns).exceptAll(want).count() == 0


def test_a_simulation_without_rows_leaves_gold(spark):
    layout = Layout(fresh_path(spark, "lakehouse"))
    rows = stage(silver(spark, SF).union().withColumn("processed_at", F.current_timestamp()), "silver-rows")
    one = rows.orderBy("simulation_id").first()["simulation_id"]
    deliver(rows, layout)
    incremental.run_gold(spark, layout)
    short = stage(rows.where((F.col("simulation_id") == one) & (F.col("step") < 20)), "short")
    tables.note_changes(short, layout.at("silver_changes"))
    tables.write_silver(short, layout.at("silver"), mode="replace")
    incremental.run_gold(spark, layout)
    left = incremental.read_folders(spark, layout.at("gold_by_simulation"))
    assert left.where(F.col("simulation_id") == one).count() == 0 < left.count()


def test_bucketed_silver_needs_no_exchange(spark):
    path = fresh_path(spark, "bucketed")
    rows = stage(silver(spark, SF).union(), "silver-rows")
    with settings(spark, spark__sql__legacy__bucketedTableScan__outputOrdering="true", spark__sql__autoBroadcastJoinThreshold="-1"):
        table = tables.write_bucketed(rows, "bucketed_silver_test", path, buckets=4)
        assert "Exchange" not in plan_of(features.gold_features(table))
        rates = plan_of(features.wear_rates(table))
        assert "Exchange" not in rates and "Sort" not in rates and "Window" in rates
    assert "Exchange" in plan_of(features.wear_rates(rows))
    spark.sql("DROP TABLE bucketed_silver_test")


def test_sketches_merge(spark):
    rows = spark.range(20_000).selectExpr("string(id % 7) simulation_id", "double(id) future_wear_rate")
    found = labels.sketched_threshold(labels.rate_sketches(rows)).first()["threshold"]
    assert abs(found - 15_000) < 200
    none = rows.withColumn("future_wear_rate", F.lit(None).cast("double"))
    for empty in (none, none.limit(0)):
        assert labels.sketched_threshold(labels.rate_sketches(empty)).first()["threshold"] == 0.0005


def test_steps_are_filled_from_both_neighbours(spark):
    rows = [("a", 1, 10.0), ("a", 4, 40.0), ("a", 4, 41.0), ("a", None, 5.0), ("b", 7, None), ("b", 9, 2.0), (None, 3, 1.0)]
    df = spark.createDataFrame(rows, "simulation_id string, step int, x double")
    assert [tuple(r) for r in gaps.step_gaps(df).orderBy("first_missing").collect()] == [("a", 2, 3, 2), ("b", 8, 8, 1)]
    got = gaps.filled_steps(df, ["x"])
    added = sorted((r["simulation_id"], r["step"], r["x"] and round(r["x"])) for r in got.where("is_filled").collect())
    assert [a[:2] for a in added] == [("a", 2), ("a", 3), ("b", 8)] and added[2][2] is None
    assert round(added[0][2]) == 20 and round(added[1][2]) in (30, 31)
    assert got.where("NOT is_filled").count() == len(rows)
    assert gaps.filled_steps(df.limit(0), ["x"]).count() == 0


def test_a_merge_gathers_the_rows_once(spark, tmp_path):
    """Copies and old rows are found in the exchange that gathers the folders; unnamed old rows stay."""
    schema = "simulation_id string, step int, speed_kmh double, __age int, simulation_bucket int"
    both = [("a", 1, 1.0, 1, 7), ("a", 1, 2.0, 0, 7), ("a", 1, 2.0, 0, 7), ("a", 2, 3.0, 1, 7), ("a", 2, 4.0, 1, 7), ("a", None, 5.0, 1, 7), ("a", None, 6.0, 0, 7)]
    merged = tables._newest(spark.createDataFrame(both, schema), "simulation_bucket")
    assert plan_of(merged).count("Exchange") == 1
    assert sorted(r["speed_kmh"] for r in merged.collect()) == [2.0, 3.0, 4.0, 5.0, 6.0]
    layout = Layout(str(tmp_path / "lake"))
    deliver(rows := silver(spark, SF).union().where("simulation_id = '1'").withColumn("processed_at", F.current_timestamp()), layout)
    deliver(rows.where("step < 9").withColumn("speed_kmh", F.lit(-1.0)), layout)
    got = tables.read_silver(spark, layout.at("silver"))
    assert got.count() == rows.count() and got.where("speed_kmh = -1").count() == rows.where("step < 9").count() > 0


def test_recorded_bronze_is_compressed(spark):
    from checks.queries import lakehouse

    found = list(Path(lakehouse(spark, SF).at("bronze")).glob("part-*"))
    assert found and all(path.name.endswith(".json.gz") for path in found)


def test_incremental_gold_writes_a_fixed_number_of_folders(spark, monkeypatch):
    """Either layout of Silver gives the same Gold, in no more folders than there are buckets."""
    monkeypatch.setattr(tables, "BUCKETS", 3)
    rows = stage(silver(spark, SF).union().withColumn("processed_at", F.current_timestamp()), "silver-rows")
    one = rows.orderBy("simulation_id").first()["simulation_id"]
    golds = {}
    for name in ("simulation", "hashed"):
        layout = Layout(fresh_path(spark, "lakehouse"))
        for part in (rows.where(F.col("step") < 500), rows.where(F.col("simulation_id") == one)):
            slice_ = stage(part, "delivered")
            tables.note_changes(slice_, layout.at("silver_changes"))
            tables.write_silver(slice_, layout.at("silver"), layout=name)
            incremental.run_gold(spark, layout, True, silver_layout=name)
        for table in ("rated_by_simulation", "gold_by_simulation"):
            assert 1 <= len(list(Path(layout.at(table)).glob("simulation_bucket=*"))) <= 3
        golds[name] = incremental.read_folders(spark, layout.at("gold_by_simulation"))
    left, right = golds["simulation"], golds["hashed"]
    assert left.count() == right.count() > 0 and left.exceptAll(right).count() == 0
