"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every character that is not a letter becomes a blank and letters are lower-cased; a text's
runs of two and three such characters, with a blank in front and blanks behind, are hashed
to ``BUCKETS`` numbers. Training counts the n-grams of every document with a language that
may be learned from; each task sends one count vector per language and block of buckets, and
the sums over the tasks make a matrix of log-probabilities. The matrix holds BUCKETS numbers
per language and is broadcast; more than ``MOST_LANGUAGES`` languages are refused, which
bounds it to 8 MB. Scoring gathers and adds matrix entries for whole batches of texts.

The score is the posterior of the predicted language under the model. NULL texts and texts
without a letter are ``und`` with score 0, as is every text if nothing could be learned.
Ties go to the alphabetically first language. Repeated rows are counted and scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.llm.common import held_out

BUCKETS = 1 << 14
SMOOTHING = 0.5
MOST_LANGUAGES = 128
BLOCK = 1 << 10
UNKNOWN = "und"
BLANK = 32
# Odd factors that spread the places of an n-gram over 32 bits.
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@cache
def letters() -> np.ndarray:
    """For each code point the code point of the lower-case letter, or a blank."""
    found = ((c, c.lower()) for c in map(chr, range(0x110000)) if c.isalpha())
    table = np.full(0x110000, BLANK, np.uint32)
    for letter, low in found:
        table[ord(letter)] = ord(low[0])
    return table


class Grams:
    """The n-gram numbers of some texts; those of text i start at places begin[i]..end[i]-1."""

    def __init__(self, texts: list[str | None]):
        joined = "".join([f" {text or ''}  " for text in texts]).encode("utf-32-le", "surrogatepass")
        codes = letters()[np.frombuffer(joined, np.uint32)]
        sizes = np.array([len(text or "") for text in texts], np.int64)
        self.begin = np.cumsum(sizes + 3) - sizes - 3
        self.end = self.begin + sizes + 1
        first, second, third = (codes * np.uint32(factor) for factor in FACTORS)
        pairs = first[:-2] + second[1:-1]
        triples = pairs + third[2:]
        shift = np.uint32(32 - BUCKETS.bit_length() + 1)
        self.codes, self.kinds = codes, ((pairs ^ (pairs >> np.uint32(15))) * np.uint32(FACTORS[2]) >> shift, (triples ^ (triples >> np.uint32(15))) * np.uint32(FACTORS[0]) >> shift)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of one value per place over each text's places."""
        edges = np.stack([self.begin, self.end], axis=1).ravel()
        return np.add.reduceat(values, edges[edges < len(values)])[::2]

    def has_letter(self) -> np.ndarray:
        return self.sums((self.codes != BLANK).astype(np.int64)) > 0

    def counts(self) -> np.ndarray:
        inside = np.zeros(len(self.codes), np.int8)
        inside[self.begin] = 1
        inside[self.end] = -1
        inside = np.cumsum(inside, dtype=np.int8)[:-2].astype(bool)
        return sum(np.bincount(kind[inside], minlength=BUCKETS) for kind in self.kinds)


@dataclass
class Model:
    languages: list[str]
    log_rows: np.ndarray  # languages x buckets
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        grams = Grams(texts)
        logs = np.stack([grams.sums(sum(row[kind] for kind in grams.kinds).astype(np.float64)) for row in self.log_rows], axis=1) + self.prior
        best = logs.argmax(axis=1)
        posterior = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        known = grams.has_letter()
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, posterior, 0.0)


def fit(docs: DataFrame) -> Model:
    """Learn from the rows of ``docs`` (text, lang) whose lang is not NULL."""
    schema = pa.schema([("lang", pa.string()), ("block", pa.int32()), ("docs", pa.int64()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                chosen = np.flatnonzero(langs == lang)
                rows[lang] = rows.get(lang, 0) + len(chosen)
                for at in range(0, len(chosen), 256):
                    sums[lang] = sums.get(lang, 0) + Grams([texts[i] for i in chosen[at : at + 256]]).counts()
            if len(sums) > MOST_LANGUAGES:
                raise ValueError(f"more than {MOST_LANGUAGES} languages")
        yield from emit(((lang, block, rows[lang] if not block else 0, vector[block * BLOCK : (block + 1) * BLOCK]) for lang, vector in sums.items() for block in range(BUCKETS // BLOCK)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        rows: dict[tuple[str, int], int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = row["lang"], row["block"]
                sums[key] = sums.get(key, 0) + np.frombuffer(row["counts"], np.int64)
                rows[key] = rows.get(key, 0) + row["docs"]
        yield from emit((*key, rows[key], vector) for key, vector in sums.items())

    def emit(found) -> Iterator[pa.RecordBatch]:
        found = [(lang, block, docs, vector.astype(np.int64).tobytes()) for lang, block, docs, vector in found]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    shape = "lang string, block int, docs long, counts binary"
    labelled = docs.where(F.col("lang").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = labelled.mapInArrow(count, shape).repartition("lang", "block").mapInArrow(add, shape).collect()
    languages = sorted({row["lang"] for row in rows})
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((len(languages), BUCKETS))
    prior = np.ones(len(languages))
    for row in rows:
        at = languages.index(row["lang"])
        counts[at, row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], np.int64)
        prior[at] += row["docs"]
    counts += SMOOTHING
    return Model(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32), np.log(prior / prior.sum()) if languages else prior)


def predicted(docs: DataFrame, model: Model, text: Column) -> Column:
    """A struct (lang_pred, score) for ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            values = [text if isinstance(text, str) else None for text in batch]
            made = [sent.value.predict(values[at : at + 256]) for at in range(0, len(values), 256)]
            yield pd.DataFrame({"lang_pred": [lang for langs, _ in made for lang in langs], "score": np.concatenate([s for _, s in made]) if made else []})

    return predict(text.cast("string"))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, predict all of them."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted(docs, model, docs["text"]).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
