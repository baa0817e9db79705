"""Near-duplicate documents by SimHash and a Gray-order hierarchical index.

``fingerprints`` gives each document 64 bits: the majority, bit by bit, of the XXH64 of its
word shingles. ``links`` finds all pairs of different fingerprints that differ in at most
``distance`` bits:

1. Fingerprints at most d bits apart agree in one of d + 1 bands of bits. Every distinct
   fingerprint goes to one group per band, named by the band's bits.
2. A group too large for one task is dealt anew by the same rule on the bits still free:
   within it, fingerprints agree in one of d + 1 smaller bands. Each level fixes more bits
   (16, 12, 9, 7 at distance 3), so that a group of the last level cannot hold more than
   2**20 fingerprints, whatever the data.
3. A task sorts its groups by Gray rank and builds the index over them: a node stands for a
   run of neighbours and keeps the bits on which all of them agree, less those its parent
   already has. A search goes down level by level, adds up differing bits node by node, and
   drops a whole run as soon as the sum exceeds ``distance``.
4. Out of each task come only the links of a spanning forest, at most one per fingerprint,
   from which ``tachyline.llm.components`` makes the groups of the whole corpus.

Equal fingerprints are one node from the start, so exact copies cost nothing further.

NULL texts and texts without words have fingerprint zero and are linked like any other.
Repeated rows belong to one component. A NULL doc_id is reported with its fingerprint and
the component of that fingerprint, but names no component; where all ids of a component are
NULL, so is its name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.llm.common import LOWER_ASCII, id_and_text, pairs_of
from tachyline.llm.components import components
from tachyline.session import stage

SEED = 42
SHINGLE_WORDS = 3
DISTANCE = 3
GROUP_ROWS = 2048  # larger groups are dealt anew
LAST_GROUP_BITS = 20
FANOUT = 8
FRONTIER = 1 << 17  # pairs of search and node looked at together; a task holds some 400 bytes for each
TASK_ROWS = 1 << 15  # fingerprints indexed together, in whole groups
CHUNK = 1 << 11  # shingles counted together
STEPS = np.random.default_rng(SEED).integers(0, 1 << 64, 1 << 10, np.uint64)  # one per further fingerprint
# How many of the bytes with value v at place p vote for which bit.
BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint_of(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the shingles' hashes; zero without words."""
    words = text.translate(LOWER_ASCII).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    width = min(shingle_words, len(words))
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[b:e], SEED) for b, e in zip(begins, ends[width - 1 :].tolist(), strict=True)), "<u8", len(begins))
    votes = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256) @ BITS_OF_BYTE
    return int.from_bytes(np.packbits(2 * votes.ravel() > len(hashes), bitorder="little").tobytes(), "little")


def mixed(hashes: np.ndarray, count: int) -> np.ndarray:
    """For each hash a row of ``count`` numbers: the hash itself and others that are independent of it."""
    wide = hashes[:, None] + STEPS[:count]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        wide ^= wide >> np.uint64(shift)
        wide *= np.uint64(factor)
    wide ^= wide >> np.uint64(31)
    wide[:, 0] = hashes
    return wide


def fingerprints_of(hashes: np.ndarray, count: int) -> np.ndarray:
    """``count`` fingerprints of the shingles with these hashes: the majority bits of each column of ``mixed``.

    Votes are counted for all bits at once: ``sums[w]`` holds bit w of every count.
    """
    sums: list[np.ndarray] = []
    for at in range(0, len(hashes), CHUNK):
        rows, weight = mixed(hashes[at : at + CHUNK], count), 0
        while len(rows):
            if weight == len(sums):
                sums.append(rows[:0])
            rows, carried = np.concatenate([sums[weight], rows]), []
            while len(rows) > 2:
                third = len(rows) // 3
                a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                either = a ^ b
                carried.append(a & b | either & c)
                rows = np.concatenate([either ^ c, rows[3 * third :]])
            if len(rows) == 2:
                carried.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
            sums[weight] = rows
            rows = np.concatenate(carried) if carried else rows[:0]
            weight += 1
    more, equal = np.zeros(count, np.uint64), np.full(count, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for weight in reversed(range(len(sums))):
        bits = sums[weight][0]  # every weight that was reached has one row left
        if len(hashes) // 2 >> weight & 1:
            equal &= bits
        else:
            more |= equal & bits
            equal &= ~bits
    return more


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in pairs_of(batches):
            made = np.array([fingerprint_of(text, shingle_words) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(made.view(np.int64))], schema=schema)

    return id_and_text(docs).mapInArrow(make, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the binary reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A hierarchy over codes in Gray order; level 0 has one node per code.

    ``group`` names the group of each code. Codes lie group by group, and a search stays
    within its group. Only the codes marked in ``sought`` are searched for, among all.
    """

    def __init__(self, codes: np.ndarray, group: np.ndarray, sought: np.ndarray | None = None):
        self.codes, self.group = codes, group
        every, some = [codes], [codes]
        first, last = [group], [group]
        self.sought = [np.ones(len(codes), bool) if sought is None else sought]  # whether all codes of a node are
        while len(every[-1]) > FANOUT:
            at = np.arange(0, len(every[-1]), FANOUT)
            every.append(np.bitwise_and.reduceat(every[-1], at))
            some.append(np.bitwise_or.reduceat(some[-1], at))
            first.append(first[-1][at])
            last.append(last[-1][np.minimum(at + FANOUT, len(last[-1])) - 1])
            self.sought.append(np.logical_and.reduceat(self.sought[-1], at))
        shared = [~(a ^ b) for a, b in zip(every, some, strict=True)]
        self.values, self.first, self.last = every, first, last
        # The bits a node adds to what its parent has.
        self.own = [mask & ~np.repeat(shared[i + 1], FANOUT)[: len(mask)] if i + 1 < len(shared) else mask for i, mask in enumerate(shared)]

    def pairs(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i < j) of codes in one group that differ in at most ``distance`` bits."""
        top = len(self.values) - 1
        roots = np.arange(len(self.values[top]))
        chunk = max(1, FRONTIER // max(1, len(roots)))
        sought = np.flatnonzero(self.sought[0])
        for begin in range(0, len(sought), chunk):
            searches = sought[begin : begin + chunk]
            yield from self._descend(top, np.repeat(searches, len(roots)), np.tile(roots, len(searches)), np.zeros(len(searches) * len(roots), np.uint8), distance)

    def _descend(self, level: int, search: np.ndarray, node: np.ndarray, sum_: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(search) > FRONTIER:
            half = len(search) // 2
            yield from self._descend(level, search[:half], node[:half], sum_[:half], distance)
            yield from self._descend(level, search[half:], node[half:], sum_[half:], distance)
            return
        group = self.group[search]
        # Each pair once: runs that end in front of the search are left out if they search as well.
        near = ((node + 1) * FANOUT**level > search + 1) | ~self.sought[level][node]
        near &= (self.first[level][node] <= group) & (self.last[level][node] >= group)
        search, node, sum_ = search[near], node[near], sum_[near]
        sum_ = sum_ + np.bitwise_count((self.codes[search] ^ self.values[level][node]) & self.own[level][node])
        near = sum_ <= distance
        search, node, sum_ = search[near], node[near], sum_[near]
        if not level:
            if len(search):
                yield search, node
            return
        below = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        real = below < len(self.values[level - 1])
        yield from self._descend(level - 1, np.repeat(search, FANOUT)[real], below[real], np.repeat(sum_, FANOUT)[real], distance)


def spanning(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each place the smallest place it hangs together with."""
    label = np.arange(size)
    for left, right in pairs:
        while True:
            low = np.minimum(label[left], label[right])
            high = np.maximum(label[left], label[right])
            open_ = low != high
            if not open_.any():
                break
            left, right = left[open_], right[open_]
            np.minimum.at(label, high[open_], low[open_])
            while not np.array_equal(label, shorter := label[label]):
                label = shorter
    return label


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of some whole groups at a time; rows of numbers come sorted by the first column, the key."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        held.append([column.to_numpy() for column in batch.columns])
        if sum(len(x[0]) for x in held) >= TASK_ROWS:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            whole = np.searchsorted(columns[0], columns[0][-1])  # the last group may go on
            if whole:
                yield [column[:whole] for column in columns]
            held = [[column[whole:] for column in columns]]
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def local_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Spanning links of each group; rows (key, fp, node) come sorted by key."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    for keys, codes, nodes in whole_groups(batches):
        codes = codes.view(np.uint64)
        group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
        order = np.lexsort((gray_rank(codes), group))
        codes, group, nodes = codes[order], group[order], nodes[order]
        label = spanning(len(codes), GrayIndex(codes, group).pairs(distance))
        tied = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[tied]), pa.array(nodes[label[tied]])], schema=schema)


def bands_of(free: list[int], count: int) -> list[list[int]]:
    """``free`` bits dealt to ``count`` bands of equal size, give or take one."""
    return [list(map(int, part)) for part in np.array_split(np.array(free), count)]


def mask_of(bits: list[int]) -> int:
    value = sum(1 << bit for bit in bits)
    return value - (1 << 64) if value >> 63 else value


def dealt(rows: DataFrame, level: int, distance: int) -> DataFrame:
    """Each row once per band of the bits its ``mask`` leaves free; ``key`` grows by the band's bits."""
    choices = [([], list(range(64)))]
    for _ in range(level + 1):
        choices = [(fixed + band, [b for b in free if b not in band]) for fixed, free in choices for band in bands_of(free, distance + 1)]
    masks = [mask_of(fixed) for fixed, _ in choices]
    if level == 0:
        fan = F.array(*(F.struct(F.lit(i).alias("path"), F.lit(m).alias("mask")) for i, m in enumerate(masks)))
    else:
        # Children of path p are paths p * (distance + 1) ...
        table = F.array(*(F.lit(m) for m in masks))
        steps = F.sequence(F.col("path") * (distance + 1), F.col("path") * (distance + 1) + distance)
        fan = F.transform(steps, lambda p: F.struct(p.alias("path"), F.element_at(table, p + 1).alias("mask")))
    out = rows.select("fp", "node", F.explode(fan).alias("band"))
    return out.select("fp", "node", F.col("band.path").alias("path"), F.xxhash64(F.col("band.path"), F.col("fp").bitwiseAND(F.col("band.mask"))).alias("key"))


def levels(distance: int) -> int:
    """How often groups can be dealt anew until few enough bits are free."""
    free, level = 64, 0
    while free > LAST_GROUP_BITS:
        free -= free // (distance + 1)
        level += 1
    return level


def links(nodes: DataFrame, distance: int = DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs at most ``distance`` bits apart.

    ``nodes`` has one row (fp, node) per different fingerprint.
    """
    found, rows = None, nodes
    last = levels(distance) - 1
    for level in range(last + 1):
        keyed = stage(dealt(rows, level, distance), "bands")
        crowded = keyed.groupBy("key").count().where(F.col("count") > group_rows).select("key")
        crowded = stage(crowded, "crowded") if level < last else None
        more = crowded is not None and not crowded.isEmpty()
        small = keyed.join(crowded, "key", "left_anti") if more else keyed
        searched = small.select("key", "fp", "node").repartition("key").sortWithinPartitions("key").mapInArrow(lambda batches: local_links(batches, distance), "a long, b long")
        found = searched if found is None else found.union(searched)
        if not more:
            break
        rows = keyed.join(crowded, "key", "left_semi")
    return found


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): fingerprint and smallest doc_id reachable over links."""
    marked = stage(fingerprints(docs, shingle_words), "fingerprints")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "nodes")
    # Fingerprints name the nodes of the graph; components are then named by their smallest id.
    parts = components(links(nodes.select("fp", F.col("fp").alias("node")), distance))
    named = nodes.join(parts, nodes["fp"] == parts["node"], "left").select("fp", "smallest", F.coalesce("component", "fp").alias("component"))
    names = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    by_fp = stage(named.join(names, "component").select("fp", "component_id"), "names")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One document of each component: the one whose id names it.

    Repeated rows of one id are one document. Rows without an id are no copies of anything
    by name and stay.
    """
    found = near_duplicates(docs, shingle_words, distance)
    copies = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    nameless = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    kept = docs.join(copies, "doc_id", "left_anti").select(docs.columns)
    return kept.withColumn(" nameless", nameless).dropDuplicates(["doc_id", " nameless"]).drop(" nameless")
