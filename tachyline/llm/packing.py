"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as many of the
longest length as fit, then the binary digits of the rest. Each piece is a training
sequence of its own, so no sequence crosses documents and none needs padding; sequences of
one length form a bucket, from which batches of equal shape are drawn.

Cutting needs nothing but the document itself: one pass, no shuffle, and a lost task is
simply run again. Sequence numbers hold the task's partition in the upper bits and a count
in the lower ones, as ``monotonically_increasing_id`` does.

Empty and NULL texts consist of the end token alone: one piece of length one. Repeated rows
are packed each for itself. Extra columns of the input are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachyline.llm.common import id_and_text
from tachyline.llm.tokens import tokenizer_at

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, bucket int"
SEQUENCE_TOKENS = 4096
DOCS_TOGETHER = 512
ROWS_OUT = 4096


def piece_lengths(tokens: int, longest: int) -> list[int]:
    """Powers of two, longest first, that add up to ``tokens``."""
    whole, rest = divmod(tokens, longest)
    return [longest] * whole + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def piece_table(keys: pa.Array, ids: list[bytes], longest: int, number: int) -> pa.Table:
    """The pieces of some documents; their ids are views of one buffer, which is cut by offsets."""
    tokens = np.array([len(made) // 4 for made in ids], np.int64)
    cuts = [piece_lengths(total, longest) for total in tokens.tolist()]
    doc = np.repeat(np.arange(len(ids)), [len(lengths) for lengths in cuts])
    lengths = np.array([length for found in cuts for length in found], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    begins = np.cumsum(tokens) - tokens
    bounds = pa.py_buffer((4 * offsets).astype("<i8").tobytes())
    joined = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, bounds, pa.py_buffer(b"".join(ids))])
    columns = {
        "doc_id": keys.take(pa.array(doc)),
        "start": offsets[:-1] - begins[doc],
        "length": lengths,
        "ids": joined,
        "doc_tokens": tokens[doc],
        "sequence_id": number + np.arange(len(lengths)),
        "offset": np.zeros(len(lengths), np.int64),
        "bucket": np.log2(lengths).astype(np.int32),
    }
    return pa.table(columns)


def pack(docs: DataFrame, tokenizer: str, end_id: int, longest: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece, with its ids (little-endian unsigned 32-bit) and its bucket.

    ``longest`` must be a power of two. ``tokenizer`` is the path of a tokenizer file that
    every executor has.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer_at(tokenizer).encode
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_TOGETHER):
                part = batch.slice(at, DOCS_TOGETHER)
                ids = [made + end for made in encode(part.column(1).cast(pa.large_binary()).to_pylist())]
                pieces = piece_table(part.column(0), ids, longest, number)
                number += pieces.num_rows
                yield from pieces.to_batches(max_chunksize=ROWS_OUT)

    return id_and_text(docs).mapInArrow(cut, PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the packed sequences with one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
