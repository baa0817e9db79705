"""Gradients, batch independence and held-out scores of the passage network."""

import numpy as np

from tachyline.llm import quality

TEXTS = ["A plain sentence. " * 40, None, "", "x", "### | ### | " * 300, "été " * 700, "日本" * 30, "same line\n" * 300]


def test_features_do_not_depend_on_neighbours():
    rows, passages = quality.encode(TEXTS)
    at = 0
    for text, count in zip(TEXTS, passages, strict=True):
        alone, one = quality.encode([text])
        assert one.tolist() == [count] and count == max(1, -(-len(text or "") // quality.PASSAGE))
        assert np.allclose(alone, rows[at : at + count])
        at += count
    assert quality.encode([])[0].shape == (0, quality.FEATURES)
    assert rows[:, quality.ASCII + 6].max() > 0.9


def test_gradients_equal_differences():
    rng = np.random.default_rng(5)
    rows, passages, labels = rng.normal(size=(9, quality.FEATURES)), np.array([2, 1, 4, 2]), np.array([1.0, 0, 1, 0])
    values = {name: rng.normal(0, 0.2, shape) for name, shape in quality.Network.SHAPES.items()}
    network = quality.Network(values, 0, 1)

    def loss():
        p = network.forward(rows, passages)[0]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    slopes = network.gradients(rows, passages, labels)
    for name, value in values.items():
        for place in range(min(5, value.size)):
            moved = value.copy().ravel() if value.shape else np.array([value])
            ends = []
            for sign in (1e-5, -1e-5):
                changed = moved.copy()
                changed[place] += sign
                values[name] = changed.reshape(value.shape)
                ends.append(loss())
            values[name] = value
            assert np.isclose((ends[0] - ends[1]) / 2e-5, np.ravel(slopes[name])[place], atol=1e-6)


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.judge(docs.where("doc_id < 4000"), labels).join(labels, "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in got if r["quality"] == 1]
    bad = [r["predicted"] for r in got if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad) and bad


def test_edge_rows(spark):
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t in enumerate(TEXTS)] + [(None, "a", 0.5, 1)], "doc_id long, text string, score double, predicted int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.judge(docs, none).collect()} == {quality.sigmoid(-np.inf)}
    one = spark.createDataFrame([(0, 1), (0, 1), (1, None), (None, 0)], "doc_id long, quality int")
    got = quality.judge(docs, one).collect()
    assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.judge(docs.limit(0), one).count() == 0
