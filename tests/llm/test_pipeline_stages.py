"""The pipeline stage by stage against plain Python, and as a whole."""

import numpy as np
import pytest
from test_decontamination import plain as plain_hits
from test_near_copies import plain_kept
from test_secret_scan import plain_base, plain_entropy
from test_tokens import whole_ids

import corpus_pipeline
from tachyline.llm import secret_scan

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage; odd rows and a column with a clashing name are added."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(900_001, None, None, None, 0), (900_002, "", "en", "src0", 0), (900_003, "token = 'AbCdEf0123456789' " * 3, "en", "src0", 78), (900_002, "", "en", "src0", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "'x' as score").cache()
    found = [docs]
    for _, step in corpus_pipeline.STAGES:
        found.append(step(spark, found[-1], SF).cache())
    return found


def rows_of(df):
    return {row["doc_id"]: row for row in df.collect()}


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:5])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near-dedup", "decontamination", "secrets", "packing"]


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = ({r["doc_id"] for r in df.select("doc_id").collect()} for df in stages[:2])
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()} & before
    assert after <= before and len(clean & after) >= 0.98 * len(clean)
    assert len(toxic & after) <= 0.4 * len(toxic)  # few labels at this size


def test_one_of_each_group_stays(stages):
    """Exact five-word Jaccard similarity over all pairs."""
    before, after = rows_of(stages[1]), stages[2].collect()
    want = plain_kept([(r["doc_id"], r["text"]) for r in before.values()])
    assert {(r["doc_id"], r["text"]) for r in after} == want and len(after) == len(want)
    assert all(r == before[r["doc_id"]] for r in after)


def test_contaminated_documents_go(spark, stages):
    before, after = rows_of(stages[2]), rows_of(stages[3])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = plain_hits([r["text"] for r in before.values()], items)
    assert after == {i: r for (i, r), hit in zip(before.items(), hits, strict=True) if not hit[4]}


def test_secrets_are_replaced(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    assert before.keys() == after.keys()
    changed = 0
    for i, row in before.items():
        text = row["text"]
        base = plain_base(text or "")
        if not base + plain_entropy(text or "", base):
            assert after[i] == row
        else:
            changed += 1
            assert secret_scan.REPLACEMENT in after[i]["text"] and after[i]["n_chars"] == len(after[i]["text"])
            assert not plain_base(after[i]["text"])
    assert changed


def test_every_token_is_packed_once(stages):
    pieces = {}
    for row in stages[5].collect():
        pieces.setdefault(row["doc_id"], []).append((row["start"], bytes(row["ids"])))
    before = rows_of(stages[4])
    assert pieces.keys() == before.keys()
    for i, row in before.items():
        joined = np.frombuffer(b"".join(ids for _, ids in sorted(pieces[i])), "<u4").tolist()
        assert joined == whole_ids(row["text"], 2)


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF).cache()
    names = ["doc_id", "start", "length", "ids", "doc_tokens"]
    whole = corpus_pipeline.run(spark, SF).select(names)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.select(names).collect()))
