import pytest
from pyspark.sql import functions as F

from tachyline.operators import features, labels, split
from tachyline.operators.lanes import SHORT, LongLane


def drive(spark, rows, wear=lambda n: n * 0.001, name="sim"):
    data = [(name, n, float(1000 + n % 7), 0.5, 0.25 + (n % 3) / 8, 40.0, 2, float(wear(n))) for n in range(rows)]
    kind = "simulation_id string, step int, engine_rpm double, throttle double, load double, speed_kmh double, current_gear int, engine_wear double"
    return spark.createDataFrame(data, kind)


@pytest.mark.parametrize("lane", [SHORT, LongLane(128)])
@pytest.mark.parametrize(("rows", "first"), [(100, None), (101, 70), (140, 70)])
def test_labelled_rows_start_seventy_rows_in(spark, lane, rows, first):
    kept = features.labelled_rows(features.wear_rates(drive(spark, rows), lane)).select("step").orderBy("step").collect()
    assert [row["step"] for row in kept] == ([] if first is None else list(range(first, rows)))


def test_wear_rate_is_per_second(spark):
    row = features.wear_rates(drive(spark, 150)).where("step = 120").first()
    assert row["wear_rate_10s"] == pytest.approx(0.01) and row["future_wear_rate"] == pytest.approx(0.01)


def test_rolling_features_restart_after_the_filter(spark):
    gold = features.gold_features(drive(spark, 300)).orderBy("step").collect()
    assert gold[0]["step"] == 70 and gold[0]["rpm_std_10s"] is None
    assert gold[0]["rpm_avg_10s"] == gold[0]["engine_rpm"]
    last = [1000 + n % 7 for n in range(199, 300)]
    assert gold[-1]["rpm_avg_10s"] == pytest.approx(sum(last) / 101)
    assert gold[-1]["rpm_range_10s"] == 6.0 and gold[-1]["load_max_10s"] == 0.5


@pytest.mark.parametrize("lane", [SHORT, LongLane(300)])
def test_serving_needs_a_full_buffer(spark, lane):
    assert features.serving_features(drive(spark, 299), lane).count() == 0
    rows = features.serving_features(drive(spark, 301), lane).orderBy("step").collect()
    assert [row["step"] for row in rows] == [299, 300]


def test_warmup_stops_at_one_hundred_percent(spark):
    made = features.warmup_progress(drive(spark, 310)).select("step", "progress_pct").collect()
    by_step = {row["step"]: row["progress_pct"] for row in made}
    assert by_step[149] == 50.0 and by_step[299] == by_step[309] == 100.0


def test_equal_rates_are_all_normal(spark):
    rated = spark.createDataFrame([("a", n, 0.5) for n in range(40)], "simulation_id string, step int, future_wear_rate double")
    for threshold in (labels.approximate_threshold(rated), labels.exact_threshold(rated)):
        assert threshold.first()["threshold"] == 0.5
        styles = labels.add_label(rated, threshold).select("driving_style").distinct().collect()
        assert [row[0] for row in styles] == ["NORMAL"]


def test_threshold_without_rates_is_the_fallback(spark):
    none = spark.createDataFrame([], "future_wear_rate double")
    assert labels.approximate_threshold(none).first()[0] == 0.0005
    assert labels.exact_threshold(none).first()[0] == 0.0005


def test_gold_keeps_the_available_contract_columns(spark):
    made = split.available_columns(features.gold_features(drive(spark, 120)))
    assert made.columns[:3] == ["simulation_id", "step", "rpm_avg_10s"] and "driving_style" not in made.columns


def simulations(spark, names):
    rows = [(name, step) for name in names for step in range(3)]
    return spark.createDataFrame(rows, "simulation_id string, step int")


@pytest.mark.parametrize(
    ("names", "train_names"),
    [
        (["b", "a"], ["a"]),
        ([f"{n:02d}" for n in range(10)], [f"{n:02d}" for n in range(8)]),
        (["10", "9", "2", "1"], ["1", "10", "2"]),
    ],
)
def test_split_takes_the_first_ids_in_string_order(spark, names, train_names):
    df = simulations(spark, names)
    train, test = split.group_split(df)
    assert sorted(row[0] for row in train.select("simulation_id").distinct().collect()) == train_names
    assert train.join(test, "simulation_id", "left_semi").count() == 0
    assert train.unionByName(test).exceptAll(df).count() == 0 and train.count() + test.count() == df.count()


@pytest.mark.parametrize("names", [[], ["only"]])
def test_too_few_simulations_serve_both_sides(spark, names):
    train, test = split.group_split(simulations(spark, names))
    assert train.count() == test.count() == 3 * len(names)


def test_split_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "full")
    simulations(spark, ["a", "b", "c"]).write.parquet(path)
    train, _ = split.group_split(spark.read.parquet(path))
    assert "LessThanOrEqual(simulation_id,b)" in train._jdf.queryExecution().executedPlan().toString()


def test_steps_may_frame_instead_of_rows(spark):
    df = drive(spark, 250).where("step % 50 < 20 or step > 150")
    made = features.rolling_features_by_step(df).where("step = 249").first()
    assert made["rpm_avg_10s"] == pytest.approx(sum(1000 + n % 7 for n in range(151, 250)) / 99)


def test_dropping_incomplete_rows(spark):
    gold = features.gold_features(drive(spark, 200)).withColumn("driving_style", F.lit("NORMAL"))
    assert split.complete_rows(gold).count() == gold.count() - 1
