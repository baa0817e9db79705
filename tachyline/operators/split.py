"""Training dataset and the leakage-safe split by simulation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachyline.operators.selection import RANKED_AT_ONCE, ranked_text
from tachyline.schemas import DATASET_COLUMNS, FEATURE_COLUMNS, TARGET_COLUMN, TRAIN_RATIO
from tachyline.session import stage


def available_columns(df: DataFrame, wanted: list[str] = DATASET_COLUMNS) -> DataFrame:
    """The contract columns that exist, in contract order."""
    return df.select(*[name for name in wanted if name in df.columns])


def ml_dataset(gold: DataFrame) -> DataFrame:
    return gold.where(F.col(TARGET_COLUMN).isNotNull()).select(*DATASET_COLUMNS)


def complete_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="any", subset=[*FEATURE_COLUMNS, TARGET_COLUMN])


def distinct_simulations(df: DataFrame) -> DataFrame:
    return df.select("simulation_id").distinct().where(F.col("simulation_id").isNotNull())


def of_simulations(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose simulation is listed in ``ids``; Spark broadcasts the list only if it is small."""
    return df.join(ids.select("simulation_id"), "simulation_id", "left_semi")


def last_train_id(df: DataFrame, ratio: float = TRAIN_RATIO, at_once: int = RANKED_AT_ONCE) -> str | None:
    """The id up to which simulations train, or None with fewer than two simulations."""
    ids = stage(distinct_simulations(df), "simulation-ids")
    total = ids.count()
    if total < 2:
        return None
    return ranked_text(ids, max(1, int(total * ratio)), at_once)


def group_split(df: DataFrame, ratio: float = TRAIN_RATIO) -> tuple[DataFrame, DataFrame]:
    """Train and test rows: the first ``ratio`` of the ids in string order train, the rest test.

    Membership is a comparison with one id, which reaches the file scan; no id list
    is collected or joined. Fewer than two simulations serve as both sides.
    """
    cut = last_train_id(df, ratio)
    if cut is None:
        known = df.where(F.col("simulation_id").isNotNull())
        return known, known
    return df.where(F.col("simulation_id") <= cut), df.where(F.col("simulation_id") > cut)
