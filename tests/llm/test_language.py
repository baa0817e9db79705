"""Learned languages on held-out documents, and n-gram sums against plain loops."""

import numpy as np

from tachyline.llm import language

SCHEMA = "doc_id long, text string, lang string, score string, found string"


def test_held_out_documents_get_their_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == docs.count()
    tested = [r for r in got if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert tested and sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.98 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_sums_do_not_depend_on_neighbours():
    texts = ["Der Hund.", None, "", "12 34", "x", "été à la mer", "日本 語", "😀", "ab\ncd" * 50]
    row = np.arange(language.BUCKETS, dtype=np.float32)
    together = language.Grams(texts)
    for kind in range(2):
        sums = together.sums(row[together.kinds[kind]].astype(float))
        for text, value in zip(texts, sums, strict=True):
            one = language.Grams([text])
            assert one.sums(row[one.kinds[kind]].astype(float))[0] == value
    assert (sum(language.Grams([t]).counts() for t in texts) == together.counts()).all()
    assert together.has_letter().tolist() == [True, False, False, False, True, True, True, False, True]


def test_edge_rows(spark):
    rows = [(i, t, lang, "", "") for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 8)]
    rows += [(100, None, "en", "", ""), (101, "", None, "", ""), (102, "123 !?", "de", "", ""), (None, "the dog", None, "", ""), (103, "der hund " * 40_000, "de", "", "")]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i]["lang_pred"] for i in (100, 101, 102, None, 103)] == ["und", "und", "und", "en", "de"]
    assert got[100]["score"] == 0 and got[None]["held_out"] is False
    assert language.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    unlabelled = spark.createDataFrame([(1, "the cat", None, "", "")], SCHEMA)
    assert language.identify(unlabelled).collect()[0]["lang_pred"] == "und"
