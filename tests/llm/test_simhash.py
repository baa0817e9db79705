"""Fingerprints and groups against plain Python over all pairs."""

import random
import tracemalloc

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tachyline.llm import simhash

SCHEMA = "doc_id long, text string, component_id string, fp string"


def plain_fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(ids: list[int], codes: list[int], distance: int = 3) -> dict[int, int]:
    """Smallest id reachable, over all pairs of codes."""
    codes_ = np.array(codes, np.uint64)
    label = {i: i for i in ids}
    near = [np.flatnonzero(np.bitwise_count(codes_ ^ code) <= distance) for code in codes_]
    changed = True
    while changed:
        changed = False
        for place, neighbours in enumerate(near):
            low = min(label[ids[n]] for n in neighbours)
            if low < label[ids[place]]:
                label[ids[place]] = low
                changed = True
    return label


def result(df) -> dict:
    return {row["doc_id"]: (row["fingerprint"], row["component_id"]) for row in simhash.digests(df).collect()}


def test_fingerprints_and_components_of_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    codes = [plain_fingerprint(r["text"]) for r in rows]
    want = plain_components([r["doc_id"] for r in rows], codes)
    got = result(simhash.near_duplicates(docs))
    assert got == {r["doc_id"]: (f"{c:016x}", want[r["doc_id"]]) for r, c in zip(rows, codes, strict=True)}
    assert len(set(want.values())) < len(want)


def test_edge_texts(spark):
    texts = [None, "", "  \t\n", "One", "one", "One two", "one two three four", "ONE  two\nthree\tfour", "x " * 30_000, "é ü ñ", None]
    rows = [(i, t, "c", "f") for i, t in enumerate(texts)]
    got = result(simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    codes = [plain_fingerprint(t) for t in texts]
    want = plain_components(list(range(len(texts))), codes)
    assert got == {i: (f"{c:016x}", want[i]) for i, c in enumerate(codes)}
    assert codes[0] == codes[1] == codes[2] == 0 and got[10][1] == 0
    assert got[6] == (got[7][0], 6) and got[3][0] == got[4][0]


def test_empty_table_and_null_id(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c", "", ""), (3, "a b c", "", ""), (3, "a b c", "", ""), (None, "lonely", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect() if r["doc_id"]) == [(3, 3), (3, 3)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "None", "None"]


@pytest.mark.parametrize("group_rows", [4, 64, 100_000])
def test_links_in_crowded_groups(spark, group_rows):
    """Dense clusters of fingerprints, also through the levels that deal groups anew."""
    rng = random.Random(7)
    codes = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(250):
            code = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                code ^= 1 << bit
            codes.add(code)
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    nodes = spark.createDataFrame(list(zip(signed, range(len(codes)), strict=True)), "fp long, node long")
    label = {i: i for i in range(len(codes))}
    parts = simhash.components(simhash.links(nodes, 3, group_rows))
    label |= {r["node"]: r["component"] for r in parts.collect()}
    assert label == plain_components(list(range(len(codes))), codes)


def test_index_finds_every_pair():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 12, 500).astype(np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    index = simhash.GrayIndex(codes, np.zeros(len(codes), np.int64))
    found = sorted((int(a), int(b)) for left, right in index.pairs(2) for a, b in zip(left, right, strict=True))
    want = [(a, b) for a in range(500) for b in range(a + 1, 500) if int(codes[a] ^ codes[b]).bit_count() <= 2]
    assert found == sorted(want)


def test_keep_one_keeps_the_smallest_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = simhash.near_duplicates(docs)
    names = {r[0] for r in found.select("component_id").distinct().collect()}
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == names
    doubled = docs.union(docs).withColumn("fp", F.lit(1))
    assert simhash.keep_one(doubled).count() == len(names)


def test_several_fingerprints_are_majorities():
    rng = np.random.default_rng(4)
    for size in (0, 1, 2, 7, 100, 2048, 2049):
        hashes = rng.integers(0, 1 << 64, size, np.uint64)
        votes = simhash.mixed(hashes, 3)
        want = [sum(1 << bit for bit in range(64) if 2 * sum(int(h) >> bit & 1 for h in column) > size) for column in votes.T]
        assert simhash.fingerprints_of(hashes, 3).tolist() == want


def test_index_searches_for_some_codes_among_all():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 12, 500).astype(np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    sought = rng.random(500) < 0.3
    index = simhash.GrayIndex(codes, np.zeros(500, np.int64), sought)
    found = [tuple(sorted((int(a), int(b)))) for left, right in index.pairs(2) for a, b in zip(left, right, strict=True)]
    want = [(a, b) for a in range(500) for b in range(a + 1, 500) if (sought[a] or sought[b]) and int(codes[a] ^ codes[b]).bit_count() <= 2]
    assert sorted(found) == want


def test_index_searches_in_bounded_memory():
    """Unlike codes and near copies in runs as long as a task takes them: a search holds a part of the pairs at a time."""
    rng = np.random.default_rng(3)
    run = np.arange(1 << 15) // 2048
    unlike = rng.integers(0, 1 << 64, len(run), np.uint64)
    near = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, len(run), np.uint64))
    for codes in (unlike, near):
        codes = codes[np.lexsort((simhash.gray_rank(codes), run))]
        tracemalloc.start()
        found = sum(len(left) for left, _ in simhash.GrayIndex(codes, run).pairs(16))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100e6 and (found < 5000 or found == 16 * 2048 * 2047 // 2)
