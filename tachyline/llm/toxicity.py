"""Toxicity: a word classifier that is regularised by counterfactuals.

Logistic regression over the different words of a text and the beginnings of longer ones,
which stand for inflected and compound forms, hashed to ``BUCKETS`` numbers. Every
training text that names a group is also read with the group's term swapped for its
counterpart, and the squared change of the score is part of the loss. Terms that name a
group therefore keep equal weights, and what is left to tell toxic texts is how they speak.

Training takes at most about ``MOST_LABELLED`` labelled documents, chosen by a hash of their
ids, in one task that holds their word numbers (some kilobytes each). The model is a vector
of BUCKETS numbers and is broadcast. Scoring takes the whole text of every document.

NULL and empty texts have no words and get the score of the constant term; without any
label the score is 0, with labels of one class only it is their rate. Several labels of one
document count as toxic if one of them does. Repeated rows are scored each.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.llm.common import held_out, id_and_text, share_of

BUCKETS = 1 << 18
MOST_LABELLED = 20_000
BEGINNINGS = (4, 5, 6, 7)  # bytes
THRESHOLD = 0.3
ROUNDS = 120
RATE = 0.1
SPARSITY = 2e-4
LEAST_TEXTS = 3  # texts that a feature must occur in to get a weight
BLOCK_TEXTS = 1024
COUNTERFACTUAL = 1.0
# Terms that name groups of people, each with its counterpart.
COUNTERPARTS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("she", "he"), ("her", "his"),
    ("black", "white"), ("asian", "european"), ("african", "american"), ("muslim", "christian"), ("muslims", "christians"),
    ("jewish", "catholic"), ("jews", "catholics"), ("gay", "straight"), ("homosexual", "heterosexual"), ("immigrant", "citizen"),
    ("immigrants", "citizens"), ("disabled", "healthy"), ("old", "young"), ("frauen", "männer"), ("frau", "mann"),
    ("femmes", "hommes"), ("femme", "homme"), ("mujeres", "hombres"), ("mujer", "hombre"),
)
# Whatever is no ASCII digit, ASCII letter or part of a non-ASCII character parts words.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> set[bytes]:
    return set(text.lower().encode("utf-8", "replace").translate(WORD_BYTES).split()) if text else set()


def numbers_of(words: set[bytes]) -> np.ndarray:
    """The numbers of the words and of the beginnings of longer words, each once."""
    parts = {word[:size] for size in BEGINNINGS for word in words if len(word) > size}
    found = [*map(zlib.crc32, words), *(zlib.crc32(part, 1) for part in parts)]
    return np.unique(np.array(found, np.int64) % BUCKETS).astype(np.int32)


def swapped(words: set[bytes], pairs: tuple = COUNTERPARTS) -> set[bytes] | None:
    """The words with group terms swapped; None if there are none."""
    other = {a.encode(): b.encode() for x, y in pairs for a, b in ((x, y), (y, x))}
    if not any(word in words for word in other):
        return None
    return {other.get(word, word) for word in words}


def learn(labels: np.ndarray, texts: list[np.ndarray], others: list[np.ndarray | None]) -> tuple[float, np.ndarray]:
    """Constant term and weights; Adam on the whole sample, block by block, with soft thresholding."""
    weights = np.zeros(BUCKETS)
    rate = labels.mean() if len(labels) else 0.0
    if rate in (0.0, 1.0):
        return (np.inf if rate else -np.inf), weights
    df = np.zeros(BUCKETS, np.int32)
    for text in texts:
        df[text] += 1
    features = np.flatnonzero(df >= LEAST_TEXTS)
    place = np.full(BUCKETS, -1, np.int32)
    place[features] = np.arange(len(features))
    count, size = len(labels), len(features)
    blocks = [_block(texts[at : at + BLOCK_TEXTS], others[at : at + BLOCK_TEXTS], place) for at in range(0, count, BLOCK_TEXTS)]
    w, bias = np.zeros(size), float(np.log(rate / (1 - rate)))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, ROUNDS + 1):
        slope = np.zeros(size + 1)
        for number, (row, column, c_row, c_column, c_sign) in enumerate(blocks):
            own = labels[number * BLOCK_TEXTS : (number + 1) * BLOCK_TEXTS]
            score = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, w[column], len(own)), -30, 30)))
            wrong = (score - own) / count
            change = np.bincount(c_row, c_sign * w[c_column], len(own))
            slope[:-1] += np.bincount(column, wrong[row], size)
            slope[:-1] += 2 * COUNTERFACTUAL / count * np.bincount(c_column, c_sign * change[c_row], size)
            slope[-1] += wrong.sum()
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        pace = RATE * min(1.0, 3 * (1 - step / (ROUNDS + 1))) / (np.sqrt(square / (1 - 0.999**step)) + 1e-6)
        moved = pace * mean / (1 - 0.9**step)
        bias -= moved[-1]
        w = w - moved[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - pace[:-1] * SPARSITY, 0)
    weights[features] = w
    return bias, weights


def _block(texts: list[np.ndarray], others: list[np.ndarray | None], place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows and columns of some texts' features, and of x - x' with signs where a group is named."""

    def cells(parts: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        columns = place[np.concatenate([part for _, part in parts] or [np.empty(0, np.int32)])]
        rows = np.repeat(np.array([i for i, _ in parts], np.int32), [len(part) for _, part in parts])
        return rows[columns >= 0], columns[columns >= 0]

    named = [(i, text, other) for i, (text, other) in enumerate(zip(texts, others, strict=True)) if other is not None]
    gone = cells([(i, np.setdiff1d(text, other)) for i, text, other in named])
    come = cells([(i, np.setdiff1d(other, text)) for i, text, other in named])
    signs = np.repeat([1.0, -1.0], [len(gone[0]), len(come[0])])
    return *cells(list(enumerate(texts))), np.concatenate([gone[0], come[0]]), np.concatenate([gone[1], come[1]]), signs


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[float, np.ndarray]:
    """Learn from documents that are not held out; ``labels`` has doc_id and toxic."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    share = min(1.0, most / max(1, known.count()))
    known = known.where(share_of(F.col("doc_id"), share)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    shape = pa.schema([("toxic", pa.int32()), ("words", pa.binary()), ("swapped", pa.binary())])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(text) for text in batch.column(1).to_pylist()]
            other = [swapped(w) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array([numbers_of(w).tobytes() for w in words], pa.binary()), pa.array([None if w is None else numbers_of(w).tobytes() for w in other], pa.binary())], schema=shape)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
        rows.sort()  # the order of arrival must not matter
        texts = [np.frombuffer(words, np.int32) for _, words, _ in rows]
        others = [None if other is None else np.frombuffer(other, np.int32) for _, _, other in rows]
        bias, weights = learn(np.array([r[0] for r in rows], float), texts, others)
        yield pa.RecordBatch.from_arrays([pa.array([bias]), pa.array([weights.astype(np.float32).tobytes()], pa.binary())], names=["bias", "weights"])

    # About ``most`` pairs of numbers at most: small enough to be sent to every task.
    sample = id_and_text(docs).join(F.broadcast(known), "doc_id").select("toxic", "text")
    row = sample.mapInArrow(numbered, "toxic int, words binary, swapped binary").repartition(1).mapInArrow(train, "bias double, weights binary").first()
    return row["bias"], np.frombuffer(row["weights"], np.float32)


def score(docs: DataFrame, model: tuple[float, np.ndarray], text: Column) -> Column:
    """Probability that ``text`` is toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bias, weights = sent.value
        for batch in texts:
            made = np.array([bias + weights[numbers_of(words_of(text if isinstance(text, str) else None))].sum(dtype=np.float64) for text in batch], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(made, -700, 700))))

    return scored(text.cast("string"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = fit(docs, labels)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(docs, model, docs["text"]).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_harmless(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, unchanged."""
    model = fit(docs, labels)
    return docs.where(score(docs, model, docs["text"]) < threshold)
