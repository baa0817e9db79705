"""Benchmark decontamination with one FM-index per training shard.

``build_index`` cuts the words of the documents into shards of bounded size. A shard holds
its own dictionary, the Burrows-Wheeler transform of its word sequence as a wavelet matrix,
and every ``SAMPLE``-th suffix position. ``search_index`` narrows the suffix range of all
windows of the benchmark at once by backward search through wavelet ranks, walks the
occurrences to sampled positions, and merges what each document's occurrences cover into
removal spans.

Words are runs of ASCII digits, ASCII letters (lower-cased) and non-ASCII characters. A
window is 13 consecutive words of an item; an item of fewer words, but not none, is one
window. No scan depends on another shard: there is no shuffle, and a lost task rebuilds or
rereads its own shards. Documents longer than a shard are cut into overlapping sections, in
which every window of the text lies whole. The benchmark travels to the shards in blocks of
bounded size; a larger benchmark makes more passes over the stored index, each with a
broadcast of its own. The results of ``TOGETHER`` blocks are staged and their broadcasts removed
before the next are sent.
Equal windows of a block are searched and located once, whoever owns them, so the places held
are no more than the words of a shard for each length of window.

NULL and empty texts have no words, no hits and are not contaminated. An item with a NULL
text or no word is never found. Repeated documents are each reported, repeated items
count under each of their ids. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachyline.llm.common import id_and_text, pairs_of, ragged
from tachyline.session import stage

WINDOW_WORDS = 13
SHARD_WORDS = 1 << 19
BLOCK_WORDS = 1 << 20
SAMPLE = 16
# Bytes that are no part of a word become blanks, A-Z becomes a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TOGETHER = 4  # blocks of the benchmark whose results are staged at once
EMIT = 1 << 16  # names of items in a batch of results, beyond which the next one begins
INDEX = "sections binary, words binary, size int, levels int, bits binary, starts binary, marks binary, sampled binary"
FOUND = "row long, doc_id long, n_words long, spans array<struct<start: long, end: long>>, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of ``symbols`` (its last symbol occurs nowhere else) by prefix doubling.

    Sorts packed (rank, next rank, place) integers, and after the first rounds only the
    suffixes that still share their rank with another one.
    """
    size = len(symbols)
    bits = max(1, int(size).bit_length())
    if 3 * bits > 63:
        raise ValueError("a shard must have fewer than 2**21 words")
    rank = symbols.astype(np.int64)
    order = np.empty(size, np.int64)
    open_ = np.arange(size)
    step = 0
    while len(open_):
        following = np.zeros(len(open_), np.int64)
        if step:
            ahead = open_ + step
            inside = ahead < size
            following[inside] = rank[ahead[inside]] + 1
        key = (rank[open_] << (2 * bits)) | (following << bits) | open_
        key.sort()
        place = key & ((1 << bits) - 1)
        pair = key >> bits
        new = np.empty(len(key), bool)
        new[0] = True
        np.not_equal(pair[1:], pair[:-1], out=new[1:])
        if step:
            group = key >> (2 * bits)  # the rank so far is the first place of its group
            first_of_group = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), np.arange(len(key)), 0))
            slots = group + np.arange(len(key)) - first_of_group
        else:
            slots = np.arange(len(key))
        leader = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        rank[place] = slots[leader]
        order[slots] = place
        alone = new & np.concatenate([new[1:], [True]])
        open_ = place[~alone]
        step = max(1, 2 * step)
    return order


class WaveletMatrix:
    """Ranks of symbols: one bit vector per level, with a 32-bit count per 64 bits."""

    def __init__(self, levels: int, words: int, bits: bytes):
        self.levels = levels
        self.bits = np.frombuffer(bits, np.uint64).reshape(levels, words)
        self.counts = np.zeros((levels, words + 1), np.uint32)
        np.cumsum(np.bitwise_count(self.bits), axis=1, dtype=np.uint32, out=self.counts[:, 1:])

    @staticmethod
    def pack(values: np.ndarray, levels: int) -> bytes:
        words = len(values) // 64 + 1
        out = np.zeros((levels, words * 8), np.uint8)
        for level in range(levels):
            bit = (values >> (levels - 1 - level)) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            out[level, : len(packed)] = packed
            chosen = bit.astype(bool)
            values = np.concatenate([values[~chosen], values[chosen]])
        return out.tobytes()

    def _ones(self, level: int, before: np.ndarray) -> np.ndarray:
        word, bit = before >> 6, (before & 63).astype(np.uint64)
        part = self.bits[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.counts[level][word].astype(np.int64) + np.bitwise_count(part)

    def rank(self, symbols: np.ndarray, before: np.ndarray, size: int) -> np.ndarray:
        """How often each symbol occurs in front of its place."""
        low = np.zeros(len(symbols), np.int64)
        high = before.astype(np.int64)
        for level in range(self.levels):
            zeros = size - int(self.counts[level][-1])
            set_ = ((symbols >> (self.levels - 1 - level)) & 1).astype(bool)
            ones_low, ones_high = self._ones(level, low), self._ones(level, high)
            low = np.where(set_, zeros + ones_low, low - ones_low)
            high = np.where(set_, zeros + ones_high, high - ones_high)
        return high - low

    def access(self, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``places`` and how often each occurs in front of its place."""
        low, at = np.zeros(len(places), np.int64), places.astype(np.int64)
        symbols = np.zeros(len(places), np.int64)
        for level in range(self.levels):
            zeros = size - int(self.counts[level][-1])
            word = self.bits[level][at >> 6]
            set_ = ((word >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            ones_low, ones_at = self._ones(level, low), self._ones(level, at)
            low = np.where(set_, zeros + ones_low, low - ones_low)
            at = np.where(set_, zeros + ones_at, at - ones_at)
            symbols = (symbols << 1) | set_
        return symbols, at - low


class FmIndex:
    """Backward search over the words of a shard.

    Symbol 0 ends the sequence, symbol 1 parts documents, words follow.
    """

    def __init__(self, row: dict):
        self.size, self.levels = row["size"], row["levels"]
        self.bwt = WaveletMatrix(self.levels, self.size // 64 + 1, row["bits"])
        self.starts = np.frombuffer(row["starts"], np.int32).astype(np.int64)
        self.marks = np.frombuffer(row["marks"], np.uint64)
        self.mark_counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])
        self.sampled = np.frombuffer(row["sampled"], np.int32)
        words = row["words"]
        self.symbols = {word: number for number, word in enumerate(words.split(b"\n"), 2)} if words else {}

    @staticmethod
    def build(words: list[list[bytes]], sections: list[tuple]) -> tuple:
        known: defaultdict[bytes, int] = defaultdict()
        known.default_factory = lambda: len(known) + 2
        lengths = np.array([len(x) for x in words])
        size = int(lengths.sum()) + len(words) + 1
        sequence = np.ones(size, np.int64)
        sequence[-1] = 0
        at = 0
        for section in words:
            sequence[at : at + len(section)] = np.fromiter(map(known.__getitem__, section), np.int64, len(section))
            at += len(section) + 1
        order = suffix_order(sequence)
        bwt = sequence[order - 1]
        levels = max(1, (len(known) + 1).bit_length())
        counts = np.bincount(sequence, minlength=len(known) + 2)
        starts = np.concatenate([[0], np.cumsum(counts)])
        chosen = order % SAMPLE == 0
        marks = np.zeros((size // 64 + 1) * 8, np.uint8)
        packed = np.packbits(chosen, bitorder="little")
        marks[: len(packed)] = packed
        return (
            pa.Table.from_arrays([pa.array(x) for x in zip(*sections, strict=True)], names=["row", "doc_id", "first", "n_words", "length"]),
            b"\n".join(known), size, levels, WaveletMatrix.pack(bwt, levels), starts.astype(np.int32).tobytes(), marks.tobytes(), order[chosen].astype(np.int32).tobytes(),
        )

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and suffix ranges of those patterns (one per row) that occur."""
        alive = np.flatnonzero((patterns >= 0).all(axis=1))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), self.size)
        for place in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, place]
            low = self.starts[symbol] + self.bwt.rank(symbol, low, self.size)
            high = self.starts[symbol] + self.bwt.rank(symbol, high, self.size)
            stay = low < high
            alive, low, high = alive[stay], low[stay], high[stay]
            if not len(alive):
                break
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the shard of the suffixes at ``rows``."""
        found = np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        rows = rows.astype(np.int64)
        while len(open_):
            word, bit = rows >> 6, (rows & 63).astype(np.uint64)
            marked = ((self.marks[word] >> bit) & np.uint64(1)).astype(bool)
            before = self.marks[word] & ((np.uint64(1) << bit) - np.uint64(1))
            number = self.mark_counts[word] + np.bitwise_count(before)
            found[open_[marked]] = self.sampled[number[marked]] + steps
            open_, rows = open_[~marked], rows[~marked]
            symbol, rank = self.bwt.access(rows, self.size)
            rows = self.starts[symbol] + rank
            steps += 1
        return found


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS, window: int = WINDOW_WORDS) -> DataFrame:
    """One row per shard: its sections of documents and its FM-index."""
    schema = pa.schema([("sections", pa.binary()), ("words", pa.binary()), ("size", pa.int32()), ("levels", pa.int32()), ("bits", pa.binary()), ("starts", pa.binary()), ("marks", pa.binary()), ("sampled", pa.binary())])

    def shard(words: list[list[bytes]], sections: list[tuple]) -> pa.RecordBatch:
        table, *rest = FmIndex.build(words, sections)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        row = (sink.getvalue().to_pybytes(), *rest)
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[list[bytes]] = []
        sections: list[tuple] = []
        filled, number = 0, TaskContext.get().partitionId() << 40
        for keys, texts in pairs_of(batches):
            for key, text in zip(keys, texts, strict=True):
                whole = words_of(text)
                number += 1
                for first in range(0, max(1, len(whole) - window + 1), shard_words - window + 1):
                    part = whole[first : first + shard_words] if len(whole) > shard_words else whole
                    if words and filled + len(part) > shard_words:
                        yield shard(words, sections)
                        words, sections, filled = [], [], 0
                    sections.append((number, key, first, len(whole), len(part)))
                    words.append(part)
                    filled += len(part) + 1
                    if part is whole:
                        break
        if words:
            yield shard(words, sections)

    if not window <= shard_words < 1 << 20:
        raise ValueError("a shard holds at least one window and fewer than 2**20 words")
    return id_and_text(docs).mapInArrow(build, INDEX)


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, window: int = WINDOW_WORDS) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items as lists of words, in blocks of bounded size; long items are cut with overlap."""
    block: list[tuple[str, list[bytes]]] = []
    filled = 0
    items = benchmark.select(benchmark["item_id"].cast("string"), benchmark["text"].cast("string"))
    for item, text in items.toLocalIterator():
        whole = words_of(text.encode() if text else None)
        for first in range(0, max(1, len(whole) - window + 1), block_words - window + 1):
            part = whole[first : first + block_words]
            if part and item is not None:
                if block and filled + len(part) > block_words:
                    yield block
                    block, filled = [], 0
                block.append((item, part))
                filled += len(part)
            if first + block_words >= len(whole):
                break
    yield block


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Union of intervals that overlap or touch."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return list(zip(starts[new].tolist(), ends[last].tolist(), strict=True))


def windows_of(items: list[tuple[str, list[bytes]]], number: dict[bytes, int], window: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: the distinct windows, where the owners of each begin, and the owners."""
    sizes: defaultdict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
    for i, (_, part) in enumerate(items):
        ids = np.array([number[word] for word in part], np.int32)
        size = min(window, len(ids))
        sizes[size].append((np.lib.stride_tricks.sliding_window_view(ids, size), i))
    windows = {}
    for size, found in sizes.items():
        owner = np.repeat([i for _, i in found], [len(rows) for rows, _ in found])
        rows, name = np.unique(np.concatenate([rows for rows, _ in found]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([name.ravel(), owner], axis=1), axis=0)
        windows[size] = (rows, np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1)), pairs[:, 1])
    return windows


def search_index(index: DataFrame, items: list[tuple[str, list[bytes]]], window: int = WINDOW_WORDS) -> tuple[DataFrame, Broadcast]:
    """Per section of a document: merged word spans of all occurrences and the items found; and what was sent."""
    words = sorted({word for _, part in items for word in part})
    windows = windows_of(items, {word: i for i, word in enumerate(words)}, window)
    sent = index.sparkSession.sparkContext.broadcast((words, windows, [name for name, _ in items]))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", span), ("items", pa.list_(pa.string()))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, windows, names = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                yield from hits_of(row, words, windows, names)

    def hits_of(row: dict, words: list[bytes], windows: dict, names: list[str]) -> Iterator[pa.RecordBatch]:
        sections = pa.ipc.open_stream(row["sections"]).read_all()
        first = sections["first"].to_numpy()
        begins = np.concatenate([[0], np.cumsum(sections["length"].to_numpy() + 1)[:-1]])
        index = FmIndex(row)
        symbol = np.array([index.symbols.get(word, -1) for word in words], np.int64)
        at, length, which = [], [], []
        for size, (rows, _, _) in windows.items():
            found, low, high = index.ranges(symbol[rows]) if len(symbol) else (np.empty(0, int),) * 3
            times = high - low
            at.append(index.locate(np.repeat(low, times) + ragged(times)))
            which.append(np.repeat(found, times))
            length.append(np.full(len(at[-1]), size))
        at, length, which = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (at, length, which))
        section = np.searchsorted(begins, at, side="right") - 1
        order = np.argsort(section, kind="stable")
        edges = np.searchsorted(section[order], np.arange(len(begins) + 1))
        spans: list[list] = []
        items: list[list] = []
        done = named = 0
        for s in range(len(begins)):
            group = order[edges[s] : edges[s + 1]]
            begin = at[group] - begins[s] + first[s]
            spans.append([{"start": b, "end": e} for b, e in merged(begin, begin + length[group])] if len(group) else [])
            items.append(owners(windows, names, length[group], which[group]))
            named += len(items[-1])
            if named >= EMIT or s == len(begins) - 1:
                columns = [sections[name].combine_chunks().cast(pa.int64())[done : s + 1] for name in ("row", "doc_id", "n_words")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, span), pa.array(items, pa.list_(pa.string()))], schema=schema)
                spans, items, done, named = [], [], s + 1, 0

    def owners(windows: dict, names: list[str], length: np.ndarray, which: np.ndarray) -> list[str]:
        """The items that own the windows found in a section."""
        found = set()
        for size in np.unique(length):
            _, begin, owner = windows[size]
            for w in np.unique(which[length == size]):
                found.update(owner[begin[w] : begin[w + 1]].tolist())
        return sorted({names[i] for i in found})

    return index.mapInArrow(search, FOUND), sent


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, spans (word numbers, end exclusive), n_hit, items.

    The index is written to the shared folder once; every block of the benchmark reads it.
    """
    index = stage(build_index(docs, shard_words, window), "fm-index")
    found = None
    for blocks in batched(benchmark_blocks(benchmark, block_words, window), TOGETHER):
        searches = [search_index(index, block, window) for block in blocks]
        part = stage(reduce(DataFrame.unionByName, [rows for rows, _ in searches]), "benchmark-hits")
        for _, sent in searches:
            sent.destroy()
        found = part if found is None else found.unionByName(part)
    by_document = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    # Sorted spans: each one counts from where the furthest one before it ends.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end")),
        lambda done, span: F.struct(
            (done["hit"] + F.greatest(F.lit(0).cast("long"), span["end"] - F.greatest(done["end"], span["start"]))).alias("hit"),
            F.greatest(done["end"], span["end"]).alias("end"),
        ),
        lambda done: done["hit"],
    )
    return by_document.select("doc_id", "n_words", "spans", covered.alias("n_hit"), "items")


def is_contaminated(n_hit, n_words):
    """At least a twentieth of the words, and one at least, lies in found windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged.

    Each row is judged by its own text, with or without an id: the operator gets a hash of
    both as the id. That the hash of a clean row equals one of a contaminated row has a
    chance of one in 2**64 for each such pair of rows.
    """
    key = F.xxhash64(docs["doc_id"].cast("string"), docs["text"].cast("string"))
    found = contamination(docs.select(key.alias("doc_id"), docs["text"]), benchmark)
    bad = found.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select("doc_id").distinct()
    return docs.join(bad.select(F.col("doc_id").alias(" key")), key == F.col(" key"), "left_anti").select(docs.columns)
