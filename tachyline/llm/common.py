"""Small helpers shared by the corpus operators."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A-Z to a-z, every other byte as it is.
LOWER_ASCII = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns the operators work on; whatever else the table has is left behind."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the documents no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def share_of(doc_id: Column, share: float) -> Column:
    """A filter that keeps about ``share`` of the ids, always the same ones."""
    return F.pmod(F.xxhash64(doc_id), F.lit(1_000_000)) < int(share * 1_000_000)


def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes | None]]]:
    """Ids and UTF-8 texts (None for NULL) of batches with the columns doc_id and text."""
    for batch in batches:
        yield batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``lengths``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
