"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` characters, and only the document has a
label. Each passage is encoded (shares of every ASCII character, of capitals, letters and
other signs, variety of its trigrams, repetition within the document) and passes through a
hidden layer. Gated attention, the product of a tanh and a sigmoid layer, weighs the
passages of a document against each other; the weighted mean of their hidden vectors gives
the score. Encoder, gates and classifier are learned together from the documents' labels.

Training takes at most about ``MOST_LABELLED`` labelled documents, chosen by a hash of their
ids. They are encoded where they lie; one task gets the passage vectors (some hundred bytes
per passage) and returns the parameters, a few thousand numbers, which are broadcast.
Scoring reads every passage of every document.

NULL and empty texts are one empty passage. Without any label the score is 0, with labels of
one class only it is their rate. Of several labels of one document the lowest counts.
Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.llm.common import held_out, id_and_text, share_of

PASSAGE = 1024
MOST_LABELLED = 12_000
THRESHOLD = 0.7
HIDDEN = 24
GATES = 8
EPOCHS = 25
BATCH_DOCS = 64
VARIETY = 1 << 12
ASCII = 128
EXTRA = 8
FEATURES = ASCII + EXTRA


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, document by document, and the passages per document."""
    texts = [text or "" for text in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(text) for text in texts], np.int64)
    passages = np.maximum(1, -(-sizes // PASSAGE))
    first = np.cumsum(passages) - passages
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(codes)) - begin[owner]
    passage = first[owner] + place // PASSAGE
    count = int(passages.sum())
    out = np.zeros((count, FEATURES), np.float32)
    symbol = np.minimum(codes, ASCII - 1).astype(np.int64)
    length = np.bincount(passage, minlength=count)
    per = np.maximum(length, 1)[:, None]
    shares = np.bincount(passage * ASCII + symbol, minlength=count * ASCII).reshape(count, ASCII) / per
    out[:, :ASCII] = np.log1p(64 * shares)
    left = sizes[owner] - place  # characters from here to the end of the text
    pair = codes * np.uint32(0x9E3779B1)
    pair[:-1] += codes[1:]
    triple = pair * np.uint32(0x85EBCA77)
    triple[:-2] += codes[2:]
    inside = left >= 3
    seen = np.zeros(count * VARIETY, bool)
    seen[passage[inside] * VARIETY + (((triple ^ (triple >> np.uint32(15))) * np.uint32(0xC2B2AE3D)) >> np.uint32(20))[inside]] = True
    variety = seen.reshape(count, VARIETY).sum(axis=1)
    extra = out[:, ASCII:]
    extra[:, 0] = shares[:, 65:91].sum(axis=1)
    extra[:, 1] = shares[:, 97:123].sum(axis=1)
    extra[:, 2] = shares[:, 33:48].sum(axis=1) + shares[:, 58:65].sum(axis=1) + shares[:, 91:97].sum(axis=1) + shares[:, 123:127].sum(axis=1)
    extra[:, 3] = shares[:, 9:33].sum(axis=1)
    extra[:, 4] = variety / np.maximum(1, length - 2)
    extra[:, 5] = np.log1p(length)
    extra[:, 6] = np.repeat(repetition(codes, owner, left, len(texts)), passages)
    extra[:, 7] = np.repeat(np.log1p(sizes), passages)
    return out, passages


def repetition(codes: np.ndarray, owner: np.ndarray, left: np.ndarray, count: int) -> np.ndarray:
    """Share of a text's runs of 16 characters that it has had before."""
    runs = codes.copy()
    for step, factor in ((1, 0x9E3779B1), (2, 0x85EBCA77), (4, 0xC2B2AE3D), (8, 0x27D4EB2F)):
        following = runs[step:].copy()
        runs *= np.uint32(factor)
        runs[: len(following)] += following
    runs ^= runs >> np.uint32(16)
    chosen = left >= 16
    key = (owner[chosen].astype(np.int64) << 32) | runs[chosen]
    key.sort()
    again = np.concatenate([[False], key[1:] == key[:-1]])[: len(key)]
    text = key >> 32
    return np.bincount(text[again], minlength=count) / np.maximum(1, np.bincount(text, minlength=count))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Network:
    """Hidden layer, gated attention and classifier with their gradients."""

    SHAPES = {"w1": (FEATURES, HIDDEN), "b1": (HIDDEN,), "wv": (HIDDEN, GATES), "wu": (HIDDEN, GATES), "wa": (GATES,), "c": (HIDDEN,), "b": ()}

    def __init__(self, values: dict[str, np.ndarray], mean: np.ndarray, scale: np.ndarray):
        self.values, self.mean, self.scale = values, mean, scale

    def forward(self, rows: np.ndarray, passages: np.ndarray) -> tuple:
        v = self.values
        starts = np.cumsum(passages) - passages
        hidden = np.tanh(rows @ v["w1"] + v["b1"])
        tanh, gate = np.tanh(hidden @ v["wv"]), sigmoid(hidden @ v["wu"])
        energy = (tanh * gate) @ v["wa"]
        weight = np.exp(energy - np.repeat(np.maximum.reduceat(energy, starts), passages))
        weight /= np.repeat(np.add.reduceat(weight, starts), passages)
        pooled = np.add.reduceat(hidden * weight[:, None], starts, axis=0)
        return sigmoid(pooled @ v["c"] + v["b"]), hidden, tanh, gate, weight, pooled, starts

    def gradients(self, rows: np.ndarray, passages: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        v = self.values
        score, hidden, tanh, gate, weight, pooled, starts = self.forward(rows, passages)
        wrong = (score - labels) / len(labels)
        towards = np.repeat(wrong[:, None] * v["c"], passages, axis=0)
        use = (towards * hidden).sum(axis=1)
        energy = weight * (use - np.repeat(np.add.reduceat(weight * use, starts), passages))
        both = energy[:, None] * v["wa"]
        d_tanh, d_gate = both * gate * (1 - tanh**2), both * tanh * gate * (1 - gate)
        d_hidden = (weight[:, None] * towards + d_tanh @ v["wv"].T + d_gate @ v["wu"].T) * (1 - hidden**2)
        return {"w1": rows.T @ d_hidden, "b1": d_hidden.sum(axis=0), "wv": hidden.T @ d_tanh, "wu": hidden.T @ d_gate, "wa": (tanh * gate).T @ energy, "c": pooled.T @ wrong, "b": wrong.sum()}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        rows, passages = encode(texts)
        return self.forward((rows - self.mean) / self.scale, passages)[0].astype(float)


def learn(labels: np.ndarray, passages: np.ndarray, rows: np.ndarray) -> Network:
    """Adam over batches of documents, in an order fixed by a seed."""
    rng = np.random.default_rng(17)
    mean, scale = (rows.mean(axis=0), rows.std(axis=0) + 1e-3) if len(rows) else (np.zeros(FEATURES), np.ones(FEATURES))
    values = {name: rng.normal(0, 0.3 / np.sqrt(max(1, shape[0] if shape else 1)), shape) for name, shape in Network.SHAPES.items()}
    network = Network(values, mean, scale)
    rate = labels.mean() if len(labels) else 0.0
    if rate in (0.0, 1.0):
        values["c"] = values["c"] * 0
        values["b"] = np.float64(np.inf if rate else -np.inf)
        return network
    values["b"] = np.float64(np.log(rate / (1 - rate)))
    rows = (rows - mean) / scale
    starts = np.cumsum(passages) - passages
    first = {name: np.zeros_like(value) for name, value in values.items()}
    second = {name: np.zeros_like(value) for name, value in values.items()}
    step, steps = 0, EPOCHS * -(-len(labels) // BATCH_DOCS)
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH_DOCS):
            step += 1
            docs = order[at : at + BATCH_DOCS]
            chosen = np.concatenate([np.arange(starts[d], starts[d] + passages[d]) for d in docs])
            for name, slope in network.gradients(rows[chosen], passages[docs], labels[docs]).items():
                if name not in ("b", "b1"):
                    slope = slope + 1e-4 * values[name]
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                pace = 0.01 * (1 - step / (steps + 1))
                values[name] = values[name] - pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return network


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Network:
    """Learn from documents that are not held out; ``labels`` has doc_id and quality."""
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    share = min(1.0, most / max(1, known.count()))
    known = known.where(share_of(F.col("doc_id"), share)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    shape = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("rows", pa.binary())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, passages = encode(part.column(2).to_pylist())
                ends = np.cumsum(passages)
                blobs = [rows[e - n : e].astype(np.float16).tobytes() for e, n in zip(ends, passages, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.int32()), pa.array(blobs, pa.binary())], schema=shape)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
        found.sort()  # the order of arrival must not matter
        rows = [np.frombuffer(blob, np.float16).reshape(-1, FEATURES) for _, _, blob in found]
        network = learn(np.array([q for _, q, _ in found], float), np.array([len(r) for r in rows], np.int64), np.concatenate([*rows, np.empty((0, FEATURES), np.float16)]).astype(np.float32))
        flat = np.concatenate([np.ravel(x) for x in (*(network.values[name] for name in Network.SHAPES), network.mean, network.scale)])
        yield pa.RecordBatch.from_arrays([pa.array([flat.astype(np.float64).tobytes()], pa.binary())], names=["parameters"])

    # About ``most`` pairs of numbers at most: small enough to be sent to every task.
    sample = id_and_text(docs).join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")
    flat = np.frombuffer(sample.mapInArrow(encoded, "doc_id long, quality int, rows binary").repartition(1).mapInArrow(train, "parameters binary").first()["parameters"])
    values, at = {}, 0
    for name, shape in Network.SHAPES.items():
        size = int(np.prod(shape))
        values[name] = flat[at : at + size].reshape(shape)
        at += size
    return Network(values, flat[at : at + FEATURES], flat[at + FEATURES :])


def score(docs: DataFrame, network: Network, text: Column) -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = [text if isinstance(text, str) else None for text in batch]
            made = [sent.value.scores(values[at : at + 128]) for at in range(0, len(values), 128)]
            yield pd.Series(np.concatenate(made) if made else [], dtype="float64")

    return scored(text.cast("string"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    network = fit(docs, labels)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(docs, network, docs["text"]).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
