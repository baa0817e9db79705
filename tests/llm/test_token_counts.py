"""Token counts of prefixes against encoding every prefix with the library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tachyline.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(MODEL)


def made_texts(library, count, seed):
    """Random signs, pieces put together, runs of spaces, signs without a piece."""
    rng = random.Random(seed)
    pieces = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    kinds = [
        lambda: "".join(rng.choice("abcdefghij ▁") for _ in range(rng.randrange(30))),
        lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(9))),
        lambda: "".join(rng.choice(" \n\t\0aé漢😀ß0") for _ in range(rng.randrange(40))),
        lambda: " " * rng.randrange(40) + rng.choice(pieces) + " " * rng.randrange(20),
        lambda: "".join(rng.choice("aeinst") for _ in range(rng.randrange(40))),
    ]
    return [kinds[i % len(kinds)]() for i in range(count)]


def test_every_prefix(library, counter):
    for text in made_texts(library, 600, 1) + ["<s>", "</s><unk><0x0A>", " ", "\0", "a" * 500]:
        steps, total = counter.count(text)
        want = [len(ids) for ids in library.encode([text[: i + 1] for i in range(len(text))])]
        assert np.cumsum(token_counts.changes(steps, len(text))).tolist() == want, repr(text)
        assert total == (want[-1] if want else 0)


def test_pieces_that_follow_each_other(counter):
    """The check at the seam equals joining the two pieces from the start."""
    rng = random.Random(2)
    pieces = list(counter.scores)
    refused = 0
    for _ in range(20_000):
        whole = rng.choice(pieces) + rng.choice([rng.choice(pieces), ""])
        if len(whole) < 2:
            continue
        at = rng.randrange(1, len(whole))
        last, piece = whole[:at], whole[at:]
        if last in counter.scores and piece in counter.scores:
            want = [part[0] for part in counter.joined(whole)] == [last, piece]
            refused += not want
            assert counter.follows(last, piece) == want, (last, piece)
    assert refused > 100


def test_small_caches_change_nothing(library, counter):
    small = token_counts.PrefixCounter(MODEL, most_chunks=5, most_pairs=20)
    for text in made_texts(library, 200, 3):
        assert small.count(text) == counter.count(text)


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = token_counts.digests(token_counts.prefix_counts(docs, MODEL), limit=4096).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    want = {i: (len(t.encode()), n, n > 4096) for (i, t), n in zip(texts.items(), map(len, library.encode(list(texts.values()))), strict=True)}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == want and len(got) == len(texts)
    assert any(x[2] for x in want.values())


def test_truncation(spark, library):
    texts = made_texts(library, 60, 4)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA)
    for budget in (0, 1, 7):
        for row in token_counts.truncated(docs, MODEL, budget).collect():
            text = texts[row["doc_id"]]
            counts = [len(ids) for ids in library.encode([text[:i] for i in range(len(text) + 1)])]
            kept = max(i for i, n in enumerate(counts) if n <= budget)
            assert (row["n_tokens"], row["kept_chars"], row["kept_tokens"]) == (counts[-1], kept, counts[kept])


def test_odd_rows(spark):
    long = "donaudampfschiff" * 20_000
    rows = [(1, None, "x", 0), (1, "", "x", 0), (None, "a b", "y", 1), (2, long, None, 2), (2, long, None, 2), (3, "ab " * 50_000, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, steps int")
    counted = token_counts.prefix_counts(docs, MODEL)
    n_chars = F.col("n_chars")
    asked = counted.select("doc_id", "n_tokens", token_counts.tokens_before(F.col("steps"), n_chars, F.lit(None)).alias("none"), token_counts.tokens_before(F.col("steps"), n_chars, F.lit(10**9)).alias("all"))
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["none"], r["all"]) for r in asked.collect())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted((i or 0, n, None, n) for i, n in ((row[0], len(library.encode(row[1] or ""))) for row in rows))
    assert got == want
    assert token_counts.prefix_counts(docs.limit(0), MODEL).count() == 0
