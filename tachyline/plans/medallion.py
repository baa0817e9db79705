"""The batch jobs from Bronze to a trained model, each reading and writing tables."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tachyline.operators import evaluation, features, forest, labels, quality, split
from tachyline.operators.lanes import Lanes
from tachyline.schemas import TARGET_COLUMN
from tachyline.session import stage
from tachyline.sources import tables


@dataclass(frozen=True)
class Layout:
    """Where the tables of one lakehouse live."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def check_events(bronze: DataFrame, extended: bool = False, keep_raw: bool = False) -> DataFrame:
    parsed = quality.parse_events(bronze, extended)
    return quality.check_quality(quality.flatten_events(parsed, extended, keep_raw))


def run_silver(
    spark: SparkSession,
    layout: Layout,
    mode: str = "merge",
    strict: bool = False,
    silver_layout: str = "simulation",
    keep_raw: bool = False,
) -> None:
    """Bronze to valid rows, quarantine and metrics.

    The checked rows are written once and the three outputs read from there, so the
    JSON text is parsed once.
    """
    checked = stage(check_events(tables.read_bronze(spark, layout.at("bronze")), keep_raw=keep_raw), "checked")
    tables.write_quarantine(quality.quarantined_rows(checked, strict), layout.at("quarantine"))
    tables.append_metrics(quality.quality_metrics(checked), layout.at("metrics"))
    valid = quality.valid_rows(checked).drop("raw_event")
    tables.note_changes(valid, layout.at("silver_changes"))
    tables.write_silver(valid, layout.at("silver"), mode, silver_layout)


def rated_features(silver: Lanes) -> DataFrame:
    """Features of every labelled row beside its ``future_wear_rate``: rates and features share one exchange."""
    return silver.map(features.gold_features).union()


def gold_table(rated: DataFrame, exact: bool = False) -> DataFrame:
    """Features and label from ``rated_features``, which should be a table: it is read twice.

    The threshold needs one column of it and is compared as a scalar.
    """
    threshold = labels.exact_threshold(rated) if exact else labels.approximate_threshold(rated)
    return split.available_columns(labels.add_label(rated, threshold))


def run_gold(spark: SparkSession, layout: Layout, exact: bool = False) -> None:
    silver = tables.read_silver(spark, layout.at("silver"))
    rated = stage(rated_features(Lanes.of(silver)), "rated")
    tables.write_gold(gold_table(rated, exact), layout.at("gold"))


def run_dataset(spark: SparkSession, layout: Layout) -> None:
    gold = tables.read_table(spark, layout.at("gold"))
    tables.write_dataset(split.ml_dataset(gold), layout.at("dataset/full"))


def run_split(spark: SparkSession, layout: Layout) -> None:
    full = spark.read.parquet(layout.at("dataset/full"))
    train, test = split.group_split(full)
    tables.write_split(train, test, layout.at("dataset/train"), layout.at("dataset/test"))


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    scored = forest.score(model, split.complete_rows(test))
    return scored.select(TARGET_COLUMN, F.col("label").alias("prediction"))


def run_training(spark: SparkSession, layout: Layout, trees: int = forest.TREES, depth: int = forest.DEPTH) -> PipelineModel:
    """Fit, save the model, and write accuracy, report and importances as tables."""
    train, test = tables.read_split(spark, layout.at("dataset/train"), layout.at("dataset/test"))
    model = forest.fit_forest(train, trees, depth)
    model.write().overwrite().save(layout.at("model"))
    predicted = stage(evaluate(model, test), "predicted")
    tables.write_dataset(evaluation.accuracy(predicted), layout.at("training/accuracy"))
    tables.write_dataset(evaluation.classification_report(predicted), layout.at("training/report"))
    tables.write_dataset(forest.feature_importance(spark, model), layout.at("training/importance"))
    return model


def run_batch(spark: SparkSession, layout: Layout) -> None:
    run_silver(spark, layout)
    run_gold(spark, layout)


def run_learning(spark: SparkSession, layout: Layout, trees: int = forest.TREES) -> PipelineModel:
    run_dataset(spark, layout)
    run_split(spark, layout)
    return run_training(spark, layout, trees)
