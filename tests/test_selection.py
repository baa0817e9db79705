import math

import numpy as np
import pytest

from tachyline.operators.selection import exact_quantile, ranked_text


def doubles(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


@pytest.mark.parametrize("quantile", [0.0, 0.001, 0.25, 0.75, 0.9999, 1.0])
@pytest.mark.parametrize("shape", ["spread", "ties", "few"])
def test_quantile_equals_sorted_rank(spark, quantile, shape):
    rng = np.random.default_rng(5)
    values = {
        "spread": rng.lognormal(0, 3, 20_000),
        "ties": np.concatenate([rng.normal(0, 1, 6_000), np.full(7_000, 0.25), np.full(7_000, 0.75)]),
        "few": rng.integers(0, 4, 5_000).astype(float),
    }[shape]
    rank = max(1, math.ceil(quantile * len(values)))
    assert exact_quantile(doubles(spark, values), quantile, at_once=50) == np.sort(values)[rank - 1]


def test_quantile_without_values(spark):
    assert exact_quantile(doubles(spark, [None, None]), 0.75) is None
    assert exact_quantile(doubles(spark, [None, 3.0, None]), 0.75) == 3.0


@pytest.mark.parametrize("at_once", [1, 10, 1000])
def test_ranked_text_equals_sorted_place(spark, at_once):
    ids = [f"sim-{n}" for n in range(150)] + ["a", "ab", "abc", "", "zürich", "猫", "simulation"]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(4)
    expected = sorted(ids)
    for rank in (1, 2, 3, 70, 120, len(ids)):
        assert ranked_text(df, rank, at_once) == expected[rank - 1]
