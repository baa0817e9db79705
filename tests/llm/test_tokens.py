"""Packing and token files against encoding whole texts."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tachyline.llm import packing, token_files
from tachyline.llm.queries import tokenizer
from tachyline.llm.tokens import PieceTokenizer
from tachyline.session import fresh_path

SCHEMA = "doc_id long, text string, start string, bucket string"
TEXTS = [
    None, "", " \n\t ", "One", "Don't x'sy %'s <|endoftext|>a<|startoftext|>b", "ÀÉ́ é ﬁ Σας İx 12ab!?'re “q”.", "a b c\x1cx ''ll'd ́a", "日本語 text😀s 's",
    "word " * 30_000, "x" * 20_000, "ß ÿ × ÷ Ǆ", "tab\tend\r\nline",
    "<|EndOfText|> A, B. c!? x,y It'S it's; k: K. É, Z <|endoftext|>W.",
]


def whole_ids(text: str | None, end: int) -> list[int]:
    known = Tokenizer.from_file(tokenizer())
    return [*known.encode(text or "", add_special_tokens=False).ids, end]


def checksum(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_equal_whole_texts(spark):
    texts = TEXTS + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    known = Tokenizer.from_file(tokenizer())
    for cache in (PieceTokenizer(tokenizer()), PieceTokenizer(tokenizer(), most_pieces=50, most_words=50)):
        made = []
        for at in range(0, len(texts), 100):
            made += cache.encode([t.encode() if t else None for t in texts[at : at + 100]])
        for text, ids in zip(texts, made, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == known.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("longest", [1, 8, 4096])
def test_piece_lengths(longest):
    for tokens in (1, 2, 7, 8, 9, 4095, 4096, 4097, 12_345):
        lengths = packing.piece_lengths(tokens, longest)
        assert sum(lengths) == tokens and all(n & (n - 1) == 0 and n <= longest for n in lengths)
        assert lengths == sorted(lengths, reverse=True)


def test_packing(spark, tmp_path):
    rows = [(i, t, "s", "b") for i, t in enumerate(TEXTS)] + [(3, "One", "", ""), (None, "One", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    pieces = packing.pack(docs, tokenizer(), end_id=2)
    got = pieces.collect()
    assert len({r["sequence_id"] for r in got}) == len(got) and all(r["offset"] == 0 and 1 << r["bucket"] == r["length"] for r in got)
    for i, text in enumerate(TEXTS):
        own = sorted((r["start"], r["length"], r["doc_tokens"], bytes(r["ids"])) for r in got if r["doc_id"] == i)
        ids = whole_ids(text, 2)
        joined = np.frombuffer(b"".join(ids for *_, ids in own), "<u4").tolist()
        assert joined == ids * (2 if i == 3 else 1) and {n for _, _, n, _ in own} == {len(ids)}
    for row, digest in zip(got, packing.digests(pieces).collect(), strict=True):
        assert digest["ids_crc32"] == zlib.crc32(row["ids"])
    packing.write_buckets(pieces, str(tmp_path / "buckets"))
    assert spark.read.parquet(str(tmp_path / "buckets")).count() == len(got)
    assert packing.pack(docs.limit(0), tokenizer(), 2).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, tokenizer(), 2, longest=12)


def test_elias_fano():
    rng = np.random.default_rng(1)
    for values in ([0], [5], [3, 3, 3], list(range(1000)), sorted(rng.integers(0, 1 << 21, 700).tolist()), sorted(rng.integers(0, 40, 900).tolist())):
        made = token_files.EliasFano.of(np.array(values))
        assert made.select(np.arange(len(values))).tolist() == values
        some = rng.integers(0, len(values), 5)
        assert made.select(some).tolist() == [values[i] for i in some]
        assert len(made.low) + len(made.high) <= len(values) * (2 + max(0, np.log2((values[-1] + 1) / len(values))) + 1) / 8 + 17


@pytest.mark.parametrize("shard_tokens", [1, 5_000, 1 << 21])
def test_token_files(spark, shard_tokens):
    rows = [(i, t, "s", "b") for i, t in enumerate(TEXTS)] + [(3, "One", "", ""), (None, "a null id", "", "")]
    docs = spark.createDataFrame(rows[::-1], SCHEMA)
    path = fresh_path(spark, "files")
    token_files.write_token_files(docs, path, tokenizer(), 1, shard_tokens)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    before = 0
    for row, (_, text, *_) in zip(got, order, strict=True):
        ids = whole_ids(text, 1)
        assert row["start"] == before and np.frombuffer(row["ids"], "<u4").tolist() == ids
        before += row["n_tokens"]
    assert all(r["ids_crc32"] is not None for r in token_files.digests(token_files.read_token_files(spark, path)).collect())


def test_empty_table(spark):
    path = fresh_path(spark, "files")
    token_files.write_token_files(spark.createDataFrame([], SCHEMA), path, tokenizer(), 1)
    assert token_files.read_token_files(spark, path).count() == 0
