"""Token files: concatenated ids with Elias-Fano coded document boundaries.

A token file is one row of a shard table: the ids of some consecutive documents without
gaps (16 bits per id where the vocabulary allows it), the ends of the documents as an
Elias-Fano sequence, and the documents' ids. Spark's writer commits the table, so it may
lie in any store, and a lost task leaves no half-written file behind.

The documents are put in order with one range exchange; a task then writes its range shard
by shard and holds one shard at a time. Only one total per partition reaches the driver,
from which the shards' global starts follow.

Empty and NULL texts consist of the end token. Documents with one id keep their place next
to each other, ordered by a hash of the text and then the text; the ranges are cut by id and
hash, so many rows with one id, or without an id, are not one task. A document longer than a
shard has a shard of its own. Documents with a NULL id come first.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tachyline.llm.common import id_and_text, pairs_of
from tachyline.llm.tokens import tokenizer_at

SHARD_TOKENS = 1 << 21
SHARDS = "part int, base long, n_docs int, n_tokens long, id_bytes int, doc_ids binary, id_nulls binary, ids binary, low_bits int, low binary, high binary"
ROWS = "doc_id long, start long, n_tokens long, ids binary"


class EliasFano:
    """A non-decreasing sequence of n numbers below u in about n * (2 + log2(u / n)) bits.

    The lower ``low_bits`` bits of each number are stored as they are; the upper ones as a
    bit vector in which number i sets bit (upper part + i). ``select`` finds the i-th set
    bit through a 32-bit rank per 64 bits, made on reading.
    """

    def __init__(self, size: int, low_bits: int, low: bytes, high: bytes):
        self.size, self.low_bits, self.low, self.high = size, low_bits, low, high
        self._bits = np.frombuffer(high, np.uint8)
        words = np.frombuffer(high, "<u8")
        self._rank = np.cumsum(np.bitwise_count(words), dtype=np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        size = len(values)
        bound = int(values[-1]) + 1 if size else 1
        low_bits = max(0, (bound // max(size, 1)).bit_length() - 1)
        high = np.zeros(-(-((bound >> low_bits) + size + 1) // 64) * 64, np.uint8)
        high[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(size)] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        return cls(size, low_bits, np.packbits(low, bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes())

    def select(self, places: np.ndarray) -> np.ndarray:
        """The numbers at ``places``."""
        places = np.asarray(places, np.int64)
        word = np.searchsorted(self._rank, places, side="right")
        before = np.where(word > 0, self._rank[np.maximum(word, 1) - 1], 0).astype(np.int64)
        inside = np.unpackbits(self._bits.reshape(-1, 8)[word], axis=1, bitorder="little")
        bit = np.argmax(np.cumsum(inside, axis=1) == (places - before + 1)[:, None], axis=1)
        upper = word * 64 + bit - places
        lower = np.zeros(len(places), np.int64)
        if self.low_bits:
            packed = np.frombuffer(self.low, np.uint8)
            for shift in range(self.low_bits):
                at = places * self.low_bits + shift
                lower |= ((packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << shift
        return (upper << self.low_bits) | lower


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the shard table of ``docs`` in ascending doc_id order."""
    schema = pa.schema([("part", pa.int32()), ("base", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("id_bytes", pa.int32()), ("doc_ids", pa.binary()), ("id_nulls", pa.binary()), ("ids", pa.binary()), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary())])
    end = end_id.to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer_at(tokenizer)
        wide = max(known.tokenizer.get_vocab_size(), end_id + 1) > 1 << 16
        part, base = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        parts: list[np.ndarray] = []
        total = 0

        def shard() -> pa.RecordBatch:
            nonlocal base, total
            ends = EliasFano.of(np.cumsum([len(x) for x in parts]))
            row = (part, base, len(keys), total, 4 if wide else 2, np.array([k or 0 for k in keys], "<i8").tobytes(), np.packbits([k is None for k in keys]).tobytes(), np.concatenate(parts).tobytes(), ends.low_bits, ends.low, ends.high)
            base, total = base + total, 0
            keys.clear()
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for ids, texts in pairs_of(batches):
            for at in range(0, len(ids), 256):
                for key, made in zip(ids[at : at + 256], known.encode(texts[at : at + 256]), strict=True):
                    tokens = np.frombuffer(made + end, "<u4").astype("<u4" if wide else "<u2")
                    if keys and total + len(tokens) > shard_tokens:
                        yield shard()
                    keys.append(key)
                    parts.append(tokens)
                    total += len(tokens)
        if keys:
            yield shard()

    hashed = id_and_text(docs).withColumn("place", F.xxhash64("text"))
    ordered = hashed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place", "text").drop("place")
    ordered.mapInArrow(write, SHARDS).write.mode("error").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: its id, its global start, its length and its ids.

    The driver reads one sum per partition of the writing job to place the partitions.
    """
    shards = spark.read.parquet(path)
    starts, before = {}, 0
    for part, tokens in sorted(shards.groupBy("part").agg(F.sum("n_tokens")).collect()):
        starts[part], before = before, before + tokens
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}")
                ends = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"])
                ends = ends.select(np.arange(row["n_docs"]))
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                keys = np.frombuffer(row["doc_ids"], "<i8")
                nulls = np.unpackbits(np.frombuffer(row["id_nulls"], np.uint8), count=row["n_docs"]).astype(bool)
                first = starts[row["part"]] + row["base"]
                for at in range(0, len(keys), 1024):
                    part = slice(at, at + 1024)
                    wide = [ids[b:e].astype("<u4").tobytes() for b, e in zip(begins[part], ends[part], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(keys[part], mask=nulls[part]), pa.array(begins[part] + first), pa.array((ends - begins)[part]), pa.array(wide, pa.binary())], schema=schema)

    return shards.mapInArrow(documents, ROWS)


def digests(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
