"""Indexes against sorting suffixes, hits against a dictionary of windows."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from tachyline.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, spans string, n_words string"
ITEMS = "item_id long, text string, row string"


def plain_words(text: str | None) -> list[str]:
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs: list[str | None], items: list[tuple]) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        size = min(13, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[at : at + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        words, hit, found = plain_words(text), set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if (w := tuple(words[at : at + size])) in windows:
                    hit.update(range(at, at + size))
                    found |= windows[w]
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(words), len(hit), len(found), names, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_suffix_order_and_ranks(seed):
    rng = np.random.default_rng(seed)
    symbols = np.append(rng.integers(1, 4, rng.integers(1, 300)), 0)
    if seed == 3:
        symbols = np.append(np.tile([1, 2, 2], 60), 0)
    order = dc.suffix_order(symbols)
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
    matrix = dc.WaveletMatrix(2, len(symbols) // 64 + 1, dc.WaveletMatrix.pack(symbols, 2))
    places = np.arange(len(symbols))
    assert matrix.rank(symbols, places, len(symbols)).tolist() == [int((symbols[:i] == s).sum()) for i, s in enumerate(symbols)]
    found, ranks = matrix.access(places, len(symbols))
    assert (found == symbols).all() and ranks.tolist() == matrix.rank(symbols, places, len(symbols)).tolist()


def random_case():
    rng = np.random.default_rng(9)
    words = ["the", "a", "dog", "Été", "x1", "runs", "OFF", "日本", "end"]

    def text(size):
        return " ".join(rng.choice(words, size)) if size else ""

    items = [(i, text(n)) for i, n in enumerate([40, 13, 12, 3, 1, 25, 0, 60])] + [(100, None), (3, "the dog x1"), (7, "never-found words here")]
    docs = [text(int(n)) for n in rng.integers(0, 60, 60)] + [None, "", "...", "The DOG, x1!", items[0][1], items[0][1].upper(), text(30) + "; " + items[7][1] + ". " + text(200)]
    docs.append(" ".join([text(500), items[5][1], text(900), items[5][1]]))
    return docs, items


@pytest.mark.parametrize(("shard_words", "block_words"), [(dc.SHARD_WORDS, dc.BLOCK_WORDS), (64, 30), (13, 13)])
def test_hits(spark, shard_words, block_words):
    docs, items = random_case()
    table = spark.createDataFrame([(i, t, "s", "n") for i, t in enumerate(docs)], DOCS).repartition(3)
    bench = spark.createDataFrame([(i, t, "r") for i, t in items], ITEMS)
    got = dc.digests(dc.contamination(table, bench, shard_words=shard_words, block_words=block_words)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == plain(docs, items)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = dc.digests(dc.contamination(docs, bench)).orderBy("doc_id").collect()
    want = plain([r["text"] for r in rows], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert [tuple(r)[1:] for r in got] == want and any(w[4] for w in want)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs, items = random_case()
    bench = spark.createDataFrame([(i, t, "r") for i, t in items], ITEMS)
    rows = [(None, docs[-1], "", ""), (5, docs[4], "", ""), (5, docs[4], "", ""), (6, items[0][1], "", ""), (None, items[0][1], "", "")]
    table = spark.createDataFrame(rows, DOCS)
    assert dc.contamination(table, bench).count() == 5
    kept = dc.keep_clean(table, bench)
    judged = plain([r[1] for r in rows], items)
    want = [str(tuple(row)) for row, hit in zip(rows, judged, strict=True) if not hit[4]]
    assert kept.columns == table.columns and sorted(str(tuple(r)) for r in kept.collect()) == sorted(want)
    assert dc.contamination(table.limit(0), bench).count() == 0
    assert [r["n_hit"] for r in dc.contamination(table, bench.limit(0)).collect()] == [0] * 5


def test_rows_of_one_id_are_judged_alone(spark):
    docs, items = random_case()
    bench = spark.createDataFrame([(i, t, "r") for i, t in items], ITEMS)
    rows = [(5, "clean words only", "", ""), (5, items[0][1], "", ""), (None, items[0][1], "", ""), (None, None, "", "")]
    kept = dc.keep_clean(spark.createDataFrame(rows, DOCS), bench)
    assert sorted(str(r["text"]) for r in kept.collect()) == ["None", "clean words only"]


def test_many_equal_short_items(spark):
    """10,000 items of the same frequent word hold its places once."""
    docs = [(i, "so it is " * 2000, "", "") for i in range(3)] + [(9, "none of them", "", "")]
    bench = spark.createDataFrame([(i, "it", "r") for i in range(10_000)], ITEMS)
    got = {r["doc_id"]: r for r in dc.digests(dc.contamination(spark.createDataFrame(docs, DOCS), bench)).collect()}
    assert [(got[i]["n_hit"], got[i]["n_items"]) for i in (0, 1, 2, 9)] == [(2000, 10_000)] * 3 + [(0, 0)]
