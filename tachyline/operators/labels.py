"""The label threshold and the label.

The threshold is one quantile over all simulations. ``approximate_threshold`` is
a single mergeable aggregate inside the plan; ``exact_threshold`` selects by rank.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.operators.selection import exact_quantile
from tachyline.schemas import AGGRESSIVE, LABEL_FALLBACK, LABEL_QUANTILE, NORMAL, TARGET_COLUMN

RATE = "future_wear_rate"
SKETCH_SIZE = 800


def approximate_threshold(df: DataFrame, quantile: float = LABEL_QUANTILE) -> DataFrame:
    """One row, one column ``threshold``."""
    approx = F.percentile_approx(RATE, F.lit(quantile))
    return df.groupBy().agg(F.coalesce(approx, F.lit(LABEL_FALLBACK)).alias("threshold"))


def rate_sketches(df: DataFrame, by: str = "simulation_id", k: int = SKETCH_SIZE) -> DataFrame:
    """One quantile sketch of the rates per value of ``by``: a few kilobytes to keep beside a slice of Silver."""
    return df.groupBy(by).agg(F.kll_sketch_agg_double(F.col(RATE), F.lit(k)).alias("sketch"))


def sketched_threshold(sketches: DataFrame, quantile: float = LABEL_QUANTILE, k: int = SKETCH_SIZE) -> DataFrame:
    """One row, one column ``threshold`` from stored sketches, without another pass over the rates.

    Merging is associative, so slices can be added at any time; the rank is off by about half
    a percent of the rows at most (99 times in 100).
    """
    merged = F.kll_merge_agg_double(F.col("sketch"), F.lit(k))
    found = sketches.groupBy().agg(merged.alias("sketch"))
    any_rate = F.kll_sketch_get_n_double("sketch") > 0
    return found.select(F.coalesce(F.when(any_rate, F.kll_sketch_get_quantile_double("sketch", F.lit(quantile))), F.lit(LABEL_FALLBACK)).alias("threshold"))


def exact_threshold(df: DataFrame, quantile: float = LABEL_QUANTILE) -> DataFrame:
    """One row, one column ``threshold``."""
    found = exact_quantile(df.select(RATE), quantile)
    value = LABEL_FALLBACK if found is None else found
    return df.sparkSession.range(1).select(F.lit(value).alias("threshold"))


def style_label(rate: Column, threshold: Column) -> Column:
    """A rate equal to the threshold is still normal."""
    return F.when(rate > threshold, AGGRESSIVE).otherwise(NORMAL)


def add_label(df: DataFrame, threshold: DataFrame) -> DataFrame:
    """Compare every rate with the one-row ``threshold``, a scalar subquery of the plan."""
    return df.withColumn(TARGET_COLUMN, style_label(F.col(RATE), threshold.select("threshold").scalar()))
