"""Counterfactual training and held-out scores of the word classifier."""

import numpy as np

from tachyline.llm import toxicity


def learned(texts, labels):
    words = [toxicity.words_of(t) for t in texts]
    other = [toxicity.swapped(w) for w in words]
    return toxicity.learn(np.array(labels, float), [toxicity.numbers_of(w) for w in words], [None if o is None else toxicity.numbers_of(o) for o in other])


def test_group_terms_keep_equal_weights():
    """In the sample one group is named in toxic texts only."""
    texts = ["the women are trash", "women are stupid trash", "the men work here", "men walk on the street"] * 30
    bias, weights = learned(texts, [1, 1, 0, 0] * 30)

    def value(text):
        return bias + weights[toxicity.numbers_of(toxicity.words_of(text))].sum()

    assert abs(value("women") - value("men")) < 0.3
    assert value("they are trash") > value("women work here") + 1


def test_swapping():
    assert toxicity.swapped({b"the", b"women"}) == {b"the", b"men"}
    assert toxicity.swapped({b"the"}) is None
    assert toxicity.words_of("Été, DER Hund!") == {"été".encode(), b"der", b"hund"}
    assert toxicity.words_of(None) == set() and len(toxicity.numbers_of(set())) == 0


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.judge(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in got if r["toxic"] == 1]
    clean = [r["predicted"] for r in got if r["toxic"] == 0]
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_edge_rows(spark):
    schema = "doc_id long, text string, score double, held_out string"
    docs = spark.createDataFrame([(0, None, 0.1, ""), (1, "", 0.1, ""), (2, "w " * 50_000, 0.1, ""), (None, "some text", 0.1, ""), (2, "again", 0.1, "")], schema)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {round(r["score"], 9) for r in toxicity.judge(docs, none).collect()} == {0.0}
    assert toxicity.keep_harmless(docs, none).count() == 5 and toxicity.keep_harmless(docs, none).columns == docs.columns
    some = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (1, 0), (3, 1)], "doc_id long, toxic int")
    assert all(0 <= r["score"] <= 1 for r in toxicity.judge(docs, some).collect())
    assert toxicity.judge(docs.limit(0), some).count() == 0
