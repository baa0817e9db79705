"""URL filters: rules, and a character language-model ratio where no rule fits.

A rule names a host and the beginning of a path; it fits the host, its subdomains and every
path that begins so, and the longest fitting rule decides. URLs that a rule accepts or
rejects train two smoothed variable-order Markov models over the URL's bytes: the probability
of a byte after up to ``ORDER`` bytes is interpolated with that after one byte less, down to
single bytes. A URL without a rule is judged by the difference of its log-likelihoods under
the two models, divided by its length, against a cutoff.

The cutoff is calibrated on URLs the models have not seen: the training URLs are split in two
halves by a hash, the models of one half score the other, and the cutoff is where the mean
error rate of both classes is lowest.

All training URLs count, exactly: an n-gram of at most six bytes and its order are one 64-bit
number, and the counts are a table that grows with the input. URLs are scored in blocks; each
block joins its distinct contexts and n-grams to the table.

A NULL or empty URL, and one without "://", has neither host nor path, and no rule fits.
Where one of the classes has no URLs there is nothing to compare, and such URLs are allowed,
as are NULL and empty ones. Repeated rows count and are judged each; extra columns do not
matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.session import stage

ORDER = 5
BUCKETS = 1 << 20
BLOCK_URLS = 1 << 12  # URLs scored together
BLOCK_CHARS = 1 << 18
PULL = 0.5  # how many occurrences the shorter context counts for
BINS = 1024
WIDEST = 4.0  # scores beyond +-WIDEST fall into the outermost bins
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0x2C1B3C6D)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first "://"."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or NULL."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


class Grams:
    """Hashed contexts and n-grams at every byte of some URLs and at their ends."""

    def __init__(self, urls: list[str | None]):
        parts = [url.encode("utf-8", "replace") if url else b"" for url in urls]
        joined = np.frombuffer(b"".join([b"\x02" * ORDER + part + b"\x03" for part in parts]), np.uint8).astype(np.uint32)
        sizes = np.array([len(part) for part in parts], np.int64)
        self.lengths = sizes + 1
        ends = np.cumsum(sizes + ORDER + 1)
        owner = np.repeat(np.arange(len(parts)), self.lengths)
        begin = ends - self.lengths
        place = np.arange(len(owner)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths) + begin[owner]
        self.owner = owner
        self.levels = list(self._names(joined, place))

    def _names(self, joined: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        context = np.zeros(len(place), np.uint32)
        last = joined[place] * np.uint32(FACTORS[0])
        for order in range(ORDER + 1):
            if order:
                context = context + joined[place - order] * np.uint32(FACTORS[order])
            yield _bucket(context, 2 * order), _bucket(context + last, 2 * order + 1)

    def counts(self) -> np.ndarray:
        return np.bincount(np.concatenate([x for level in self.levels for x in level]), minlength=BUCKETS)

    def log_likelihood(self, counts: np.ndarray) -> np.ndarray:
        """Mean over each URL's bytes and its end."""
        chance = np.full(len(self.owner), 1 / 256)
        for context, gram in self.levels:
            chance = np.minimum(1.0, (counts[gram] + PULL * chance) / (np.maximum(counts[context], counts[gram]) + PULL))
        return np.bincount(self.owner, np.log(chance), len(self.lengths)) / self.lengths


def _bucket(value: np.ndarray, kind: int) -> np.ndarray:
    mixed = (value + np.uint32(0x7F4A7C15 * (kind + 1) & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(13)
    mixed *= np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(16)
    return (mixed % np.uint32(BUCKETS)).astype(np.int64)


class ExactGrams(Grams):
    """The same contexts and n-grams by exact number; ``levels`` are places in ``names``."""

    def __init__(self, urls: list[str | None]):
        super().__init__(urls)
        shape = (len(self.levels), 2, len(self.owner))
        self.names, places = np.unique(np.array(self.levels, np.int64).reshape(-1), return_inverse=True)
        self.levels = list(places.reshape(shape))

    def counts(self) -> np.ndarray:
        return np.bincount(np.concatenate([x for level in self.levels for x in level]), minlength=len(self.names))

    def _names(self, joined: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        context = np.zeros(len(place), np.int64)
        last = joined[place].astype(np.int64)
        for order in range(ORDER + 1):
            if order:
                context = context | joined[place - order].astype(np.int64) << 8 * order
            yield context | 2 * order << 48, context | last | (2 * order + 1) << 48


TABLES = [f"n{half}{label}" for half in (0, 1) for label in (0, 1)]


def count_table(training: DataFrame) -> DataFrame:
    """(name, n00, n01, n10, n11): exact counts by half and class from rows (url, half, label)."""
    schema = pa.schema([("name", pa.int64()), *((t, pa.int64()) for t in TABLES)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.column(1).to_numpy() * 2 + batch.column(2).to_numpy()
            urls = batch.column(0).to_pylist()
            for number in range(4):
                own = np.flatnonzero(table == number)
                for part in parts_of([urls[i] for i in own]):
                    grams = ExactGrams(part)
                    zero = np.zeros(len(grams.names), np.int64)
                    columns = [grams.counts() if n == number else zero for n in range(4)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (grams.names, *columns)], schema=schema)

    made = training.mapInArrow(count, "name long, " + ", ".join(f"{t} long" for t in TABLES))
    return stage(made.groupBy("name").agg(*(F.sum(t).alias(t) for t in TABLES)), "url-counts")


def parts_of(urls: list[str | None]) -> Iterator[list[str | None]]:
    """``urls`` in runs of at most ``BLOCK_URLS`` and about ``BLOCK_CHARS`` characters."""
    begin = chars = 0
    for at, url in enumerate(urls):
        size = len(url or "") + 1
        if at > begin and (at - begin >= BLOCK_URLS or chars + size > BLOCK_CHARS):
            yield urls[begin:at]
            begin, chars = at, 0
        chars += size
    if begin < len(urls):
        yield urls[begin:]


def scores(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` (url, which, ...) with their score: under the models of half ``which``, or of both for 2."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in parts_of(batch.column("url").to_pylist()):
                block = pa.array([uuid.uuid4().int >> 65] * len(part), pa.int64())
                yield pa.RecordBatch.from_arrays([block, *batch.slice(at, len(part)).columns], names=["block", *batch.schema.names])
                at += len(part)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).to_numpy()
            urls = batch.column(1).to_pylist()
            for one in np.unique(block).tolist():
                for part in parts_of([urls[i] for i in np.flatnonzero(block == one)]):
                    found = ExactGrams(part).names
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), one)), pa.array(found)], names=["block", "name"])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = ExactGrams(left.column("url").to_pylist())
        known = np.zeros((4, len(grams.names)))
        place = np.searchsorted(grams.names, right.column("name").to_numpy())
        for row, table in zip(known, TABLES, strict=True):
            row[place] = right.column(table).to_numpy()
        known = np.concatenate([known.reshape(2, 2, -1), known.reshape(2, 2, -1).sum(axis=0)[None]])
        which = left.column("which").to_numpy()
        out = np.zeros(len(which))
        for model in np.unique(which).tolist():
            value = grams.log_likelihood(known[model, 1]) - grams.log_likelihood(known[model, 0])
            out[which == model] = value[which == model]
        return left.drop_columns(["block"]).append_column("score", pa.array(out))

    blocks = stage(rows.mapInArrow(number, f"block long, {kinds}"), "url-blocks")
    wanted = blocks.select("block", "url").mapInArrow(names, "block long, name long").distinct()
    found = wanted.join(counts, "name")
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, f"{kinds}, score double")


@dataclass
class Model:
    counts: DataFrame | None  # None where a class has no URLs
    cutoff: float


def fit(training: DataFrame) -> Model:
    """Learn from rows (url, label), label 1 for accepted URLs."""
    halves = training.select("url", F.pmod(F.xxhash64("url"), F.lit(2)).cast("int").alias("half"), "label")
    table = count_table(halves)
    sums = table.agg(*(F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TABLES)).first()
    if not all(sums[f"n0{label}"] + sums[f"n1{label}"] for label in (0, 1)):
        return Model(None, 0.0)
    # The models of one half score the other.
    unseen = scores(halves.select("url", (1 - F.col("half")).alias("which"), "label"), table)
    place = F.floor((F.col("score") + WIDEST) * (BINS / (2 * WIDEST)))
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), place)).cast("int")
    # At most 2 * BINS rows.
    counts = np.zeros((2, BINS))
    for label, bin_, count in unseen.select("label", place.alias("bin")).groupBy("label", "bin").count().collect():
        counts[label, bin_] = count
    shares = counts / counts.sum(axis=1, keepdims=True)
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(shares, axis=1)], axis=1)
    error = below[1] + 1 - below[0]  # accepted below the cutoff, rejected above it
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return Model(table, float(best[len(best) // 2]) * 2 * WIDEST / BINS - WIDEST)


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and score (NULL where a rule decides) of every page."""
    url = pages["url"].cast("string")
    fitting = fitting_rule(host_of(url), path_of(url), rules)
    parsed = pages.select(pages["page_id"], url.alias("url"), fitting.alias("fitting"))
    model = fit(parsed.where("fitting IS NOT NULL").select("url", (F.col("fitting.verdict") == "allow").cast("int").alias("label")))
    open_ = F.col("fitting").isNull() & (F.coalesce(F.length("url"), F.lit(0)) > 0)
    found = parsed.select("page_id", "url", "fitting.name", "fitting.verdict", F.lit(None).cast("double").alias("score"))
    if model.counts is not None:
        scored = scores(parsed.where(open_).select("page_id", "url", F.lit(2).alias("which")), model.counts)
        unruled = scored.select("page_id", "url", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("verdict"), "score")
        found = parsed.where(~open_).select("page_id", "url", "fitting.name", "fitting.verdict", F.lit(None).cast("double").alias("score")).union(unruled)
    by_model = F.when(F.col("score") < model.cutoff, "block").otherwise("allow")
    return found.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("name").alias("rule"), F.coalesce("verdict", by_model).alias("verdict"), "score")
