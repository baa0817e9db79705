"""Near copies: SimHash and the Gray-order index give pairs, exact similarity of word shingles decides.

Two texts are near copies if their sets of ``SHINGLE_WORDS``-word shingles have a Jaccard similarity
of ``SIMILAR`` or more.

1. Equal texts are one node, named by their MD5 and numbered. The texts move once, into buckets by name;
   afterwards the few that are compared are found there by moving their names only.
2. A node has several independent SimHash fingerprints of 64 bits (``simhash.fingerprints_of``). Each
   names a group by its first bits, so many that an even group has ``GROUP_ROWS`` nodes or fewer.
   Two texts at the limit agree in one bit with a chance of 0.85, of which 0.84 is counted on, and
   as many fingerprints are made as miss such a pair with a chance of ``MISSED`` or less. Their
   number grows with the 0.24th power of the nodes; texts of few shingles are discrete, and of
   those with four and five shingles about one similar pair in 500 is missed.
3. Within each group a ``GrayIndex`` finds the fingerprints that differ in ``DISTANCE`` bits or
   fewer. A pair goes on if the sizes of the shingle sets allow the similarity (exact) and if
   further fingerprints differ in no more bits than five standard deviations above what is
   expected at the limit. Then the texts are joined and compared by the whole shingle sets.
4. Nodes that hang together form a part, and a search passes over its own part. Each search passes
   on its nearest other nodes only, one at first, and a group of more than ``RUN_ROWS`` nodes is
   searched in runs of that length, in Gray order. The nodes of pairs that were left out, and all of a
   group of more than one run, come again, with sixteen times as many, until nothing was left out:
   copies then hang together already, and only nodes outside the largest part of a run search. So
   every pair found is compared unless its nodes already hang together, and a group of copies costs
   about one comparison per node, whatever its size. Rows that come again carry all fingerprints and the
   parities: each shingle flips one of ``PARITY_BITS`` bits, so two texts differ in at least as
   many shingles as parity bits (exact). That decides nearly all pairs just below the limit, unless
   texts are so long that they differ in more shingles than there are bits. Fingerprints are worked
   off in portions of ``MOST_PORTION`` or fewer, which bounds what is shuffled at a time: copies hang
   together after the first, and do not meet again in all others. Shuffled rows are dropped as soon as
   the table made from them is written, and tables of texts or fingerprints when they have been used.

Shingles are taken from the words of the text in lower-case ASCII; a text with fewer words
is one shingle, and texts without words, NULL among them, are copies of each other. Of each
group of near copies the row with the smallest doc_id stays, and rows without a doc_id come
last. Rows are judged by their own text, also where several share a doc_id; of rows with equal
id and text one stays. Texts of any length are read whole, one at a time; a group is held in one
task, some 64 bytes a node. Other columns are kept as they are, whatever their names; an empty table
stays empty.
"""

from collections.abc import Iterator
from math import ceil, log, log2, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.llm.common import LOWER_ASCII
from tachyline.llm.components import components
from tachyline.llm.simhash import GrayIndex, fingerprints_of, gray_rank, whole_groups
from tachyline.session import settings, stage, staged, staged_buckets

SEED = 42
SHINGLE_WORDS = 5
SIMILAR = 0.8
AGREEING = 0.84  # the chance of an equal bit that is counted on
MISSED = 1e-4
GROUP_ROWS = 512
LEAST_BITS = 6
DISTANCE = 16
PORTIONS = (3, 12)  # the first fingerprints worked off together end here
MOST_PORTION = 28
RUN_ROWS = 2048
PARITY_BITS = 1 << 10
FIELDS = ["key", "node", "part", "size"]


def shingles(text: bytes | None, width: int = SHINGLE_WORDS) -> set[bytes]:
    words = text.translate(LOWER_ASCII).split() if text else []
    if not words:
        return set()
    width = min(width, len(words))
    return {b" ".join(words[at : at + width]) for at in range(len(words) - width + 1)}


def similarity(left: set[bytes], right: set[bytes]) -> float:
    """Jaccard similarity; two empty sets are equal."""
    both = len(left & right)
    either = len(left) + len(right) - both
    return both / either if either else 1.0


def tables_for(nodes: int) -> tuple[int, int]:
    """How many first bits name a group, and how many fingerprints are needed, for so many nodes."""
    bits = max(LEAST_BITS, ceil(log2(max(nodes, 1) / GROUP_ROWS)))
    return bits, ceil(log(MISSED) / log(1 - AGREEING**bits))


def signature(found: set[bytes], tables: int = 1) -> tuple[list[int], int, list[int]]:
    """The fingerprints, the size and the parities of a text with these shingles."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in found), np.uint64, len(found))
    flips = np.bincount((hashes & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS)
    parity = np.packbits((flips & 1).astype(np.uint8))
    prints = fingerprints_of(hashes, tables)
    return prints.view(np.int64).tolist(), len(found), parity.view(np.int64).tolist()


def most_apart(bits: int, similar: float) -> float:
    """In how many of so many bits the fingerprints of two texts may differ that are compared."""
    share = np.arccos(2 * similar / (1 + similar)) / np.pi
    return bits * share + 5 * sqrt(bits * share * (1 - share))


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def portions(tables: int) -> list[tuple[int, int]]:
    """The first and the end of the fingerprints that are worked off together, for so many."""
    ends = sorted({min(end, tables) for end in (*PORTIONS, *range(PORTIONS[-1] + MOST_PORTION, tables, MOST_PORTION), tables)})
    return list(zip([0, *ends], ends))


def signed(texts: DataFrame, tables: int) -> DataFrame:
    """(name, prints, size, parity, node): the different ``texts`` (name, text), numbered; numbers hold once it is staged."""
    numbers = pa.list_(pa.int64())
    schema = pa.schema([("name", pa.binary()), ("prints", numbers), ("size", pa.int64()), ("parity", numbers)])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).cast(pa.large_binary())
            made = [signature(shingles(texts[at].as_py()), tables) for at in range(batch.num_rows)]
            columns = [pa.array(column, field.type) for column, field in zip(zip(*made, strict=True), list(schema)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    made = texts.mapInArrow(make, "name binary, prints array<long>, size long, parity array<long>")
    return made.withColumn("node", F.monotonically_increasing_id())


def in_groups(nodes: DataFrame, labels: DataFrame | None, left_out: DataFrame | None, low: int, high: int, bits: int, tables: int) -> DataFrame:
    """A row (key, node, part, size, ...) for each node and each of its fingerprints from ``low`` to ``high``.

    The own fingerprint and two others follow. If some come again, only the rows ``left_out`` (key, node) are
    made, with all other fingerprints and the parities.
    """
    again, part = left_out is not None, F.lit(None).cast("long")
    places = F.sequence(F.lit(low), F.lit(high - 1))
    rows = nodes
    if again:
        rows, places = left_out.select("node", F.shiftright("key", bits).cast("int").alias("place")), F.array("place")
    if labels is not None:
        rows, part = rows.join(labels, "node", "left"), F.col("component")
    if again:
        rows = rows.join(nodes, "node")
    others = tables - 1 if again else min(2, tables - 1)

    def row(at: Column) -> Column:
        own = F.element_at("prints", at + 1)
        # One number: the fingerprint's place, then its first bits.
        key = F.shiftleft(at.cast("long"), bits) + F.shiftrightunsigned(own, 64 - bits)
        further = [F.element_at("prints", (at + i) % tables + 1).alias(f"other{i}") for i in range(1, others + 1)]
        return F.struct(key.alias("key"), own.alias("own"), *further)

    made = F.inline(F.transform(places, row))
    columns = ["node", F.coalesce(part, "node").alias("part"), "size"]
    if again:
        columns += [F.col("parity")[i].alias(f"parity{i}") for i in range(PARITY_BITS // 64)]
    names = ["own", *[f"other{i}" for i in range(1, others + 1)], *[f"parity{i}" for i in range(PARITY_BITS // 64 if again else 0)]]
    return rows.select(*columns, made).select(*FIELDS, *names)


def runs(keys: np.ndarray, codes: np.ndarray, run_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by group and Gray rank; the group of each row in it, and the run within which it is searched."""
    group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
    order = np.lexsort((gray_rank(codes), group))
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    place = np.arange(len(group)) - first[group]
    return order, group, np.cumsum(place % run_rows == 0) - 1


def outside_largest(run: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Whether a row is outside the part that has most rows of its run."""
    order = np.lexsort((part, run))
    starts = np.flatnonzero(np.concatenate([[True], (run[order][1:] != run[order][:-1]) | (part[order][1:] != part[order][:-1])]))
    rows = np.diff(np.append(starts, len(run)))
    by_rows = np.lexsort((rows, run[order][starts]))
    last = np.append(np.diff(run[order][starts][by_rows]) != 0, True)
    largest = part[order][starts][by_rows][last]  # one for each run, in order
    return part != largest[run]


def candidates(batches: Iterator[pa.RecordBatch], words: int, similar: float, partners: int, run_rows: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, a_part, b_part) of nodes that may be similar, and the key and nodes of groups that must come again.

    Rows are those of ``in_groups``, sorted by key, with ``words`` fingerprints. A key stands in a row without a pair,
    with the nodes that come again: those of pairs left out, and all where the group has more than one run.
    """
    many = pa.list_(pa.int64())
    schema = pa.schema([*[(name, pa.int64()) for name in ("key", "a", "b", "a_part", "b_part")], ("nodes", many)])
    apart = most_apart(64 * words, similar)

    for keys, node, part, size, *numbers in whole_groups(batches):
        order, group, run = runs(keys, numbers[0].view(np.uint64), run_rows)
        node, part, size = node[order], part[order], size[order]
        numbers = [x[order].view(np.uint64) for x in numbers]
        sought = outside_largest(run, part)
        taken = np.zeros(len(keys), np.int64)
        cut = np.bincount(group, np.append(group[1:] == group[:-1], False) & np.append(run[1:] != run[:-1], False)) > 0
        again = cut[group]
        pairs = []
        for left, right in GrayIndex(numbers[0], run, sought).pairs(DISTANCE):
            low, high = (f(size[left], size[right]) for f in (np.minimum, np.maximum))
            kept = (part[left] != part[right]) & (low >= high * similar)
            left, right = left[kept], right[kept]
            bits = sum(np.bitwise_count(x[left] ^ x[right]).astype(np.int64) for x in numbers[:words])
            kept = bits <= apart
            if len(numbers) > words:
                # Sets of a and b shingles that differ in d have a similarity of (a + b - d) / (a + b + d).
                odd = sum(np.bitwise_count(x[left] ^ x[right]).astype(np.int64) for x in numbers[words:])
                kept &= odd * (1 + similar) <= (size[left] + size[right]) * (1 - similar) + 1e-6
            nearest = np.lexsort((bits[kept], left[kept]))
            left, right = left[kept][nearest], right[kept][nearest]
            starts = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]])) if len(left) else left
            rank = np.arange(len(left)) - np.repeat(starts, np.diff(np.append(starts, len(left))))
            kept = rank + taken[left] < partners
            np.add.at(taken, left, 1)
            again[left[~kept]] = again[right[~kept]] = True
            pairs.append((left[kept], right[kept]))
        if pairs:
            left, right = (np.concatenate(x) for x in zip(*pairs, strict=True))
            ends = [pa.array(x) for x in (node[left], node[right], part[left], part[right])]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(left), pa.int64()), *ends, pa.nulls(len(left), many)], schema=schema)
        # A group in one part has nothing left.
        mixed = np.bincount(group, sought | np.append(part[1:] != part[:-1], False) & np.append(group[1:] == group[:-1], False)) > 0
        open_ = np.flatnonzero(again & mixed[group])
        first = np.flatnonzero(np.diff(group[open_], prepend=-1))
        nodes = pa.ListArray.from_arrays(pa.array(np.append(first, len(open_)), pa.int32()), pa.array(node[open_]))
        yield pa.RecordBatch.from_arrays([pa.array(keys[open_[first]]), *[pa.nulls(len(first), pa.int64())] * 4, nodes], schema=schema)


def confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The parts (a_part, b_part) of the ``pairs`` (a, b, a_part, b_part) whose texts are similar.

    ``texts`` (name, text) lie in buckets by name, where they stay; the names wanted go there and are held by bucket.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, set()
        for batch in batches:
            kept = []
            left, right = (batch.column(i).cast(pa.large_binary()) for i in (3, 4))
            for at, a in enumerate(batch.column(0).to_pylist()):
                if a != name:
                    name, held = a, shingles(left[at].as_py())
                kept.append(similarity(held, shingles(right[at].as_py())) >= similar)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(kept, pa.bool_())) for i in (1, 2)], names=["a_part", "b_part"])

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    names = nodes.select("node", "name").join(wanted, "node", "left_semi")
    with staged(texts.join(names.hint("shuffle_hash"), "name").select("node", "text"), "compared-texts") as texts:
        rows = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
        rows = rows.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
        made = rows.select("a", "a_part", "b_part", "left", "right").mapInArrow(compare, "a_part long, b_part long")
        return stage(made.distinct(), "near-parts")


def joined_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) after joining the components (a, b) that ``links`` connect."""
    moved = components(links)
    if labels is None:
        return moved
    target = moved.select(F.col("node").alias("component"), F.col("component").alias("target"))
    kept = labels.join(target, "component", "left").select("node", F.coalesce("target", "component").alias("component"))
    return stage(kept.unionByName(moved.join(labels.select("node"), "node", "left_anti")), "node-labels")


def linked(texts: DataFrame, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame | None]:
    """The nodes (name, node) of ``texts`` (name, text), and (node, component) of those that have a near copy."""
    labels = None
    with settings(texts.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        bits, tables = tables_for(texts.count())
        with staged_buckets(texts.groupBy("name").agg(F.min("text").alias("text")), "name", "different-texts") as different:
            with staged(signed(different, tables), "signatures") as nodes:
                for low, high in portions(tables):
                    labels = linked_by(nodes, different, labels, similar, low, high, bits, tables)
                return stage(nodes.select("name", "node"), "nodes"), labels


def linked_by(nodes: DataFrame, texts: DataFrame, labels: DataFrame | None, similar: float, low: int, high: int, bits: int, tables: int) -> DataFrame | None:
    """``labels`` with the links that the groups by the fingerprints from ``low`` to ``high`` add."""
    left_out, partners, run_rows = None, 1, RUN_ROWS
    while True:
        rows = in_groups(nodes, labels, left_out, low, high, bits, tables)
        words = tables if left_out is not None else min(3, tables)

        def search(batches, words=words, partners=partners, run_rows=run_rows):
            return candidates(batches, words, similar, partners, run_rows)

        made = rows.repartition("key").sortWithinPartitions("key").mapInArrow(search, "key long, a long, b long, a_part long, b_part long, nodes array<long>")
        made = stage(made, "candidates")
        pairs = made.where("a is not null").drop("key", "nodes").dropDuplicates(["a", "b"])
        found = confirmed(pairs, nodes, texts, similar)
        if not found.isEmpty():
            labels = joined_labels(labels, found.toDF("a", "b"))
        left_out = made.where("a is null").select("key", F.explode("nodes").alias("node"))
        if left_out.isEmpty():
            return labels
        partners, run_rows = partners * 16, run_rows * 16


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id."""
    doc_id, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    marked = docs.select(doc_id.alias("doc_id"), node_of(text).alias("name"), F.coalesce(text, F.lit("")).alias("text"))
    nodes, labels = linked(marked.select("name", "text"), similar)
    # Ids in order, no id last.
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "name")
    firsts = marked.groupBy("name").agg(F.min(place).alias("first"))
    if labels is not None:
        part = F.coalesce(F.col("component").cast("string").cast("binary"), "name")
        labels = nodes.join(labels, "node").select("name", "component")
        firsts = firsts.join(labels, "name", "left").groupBy(part.alias("component")).agg(F.min("first").alias("first"))
    row = [F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias(" id"), F.col("first.name").alias(" node")]
    kept = stage(firsts.select(*row), "kept-rows")
    named = docs.withColumns({" id": F.coalesce(doc_id.cast("string"), F.lit("")), " node": node_of(text)})
    return named.join(kept, [" id", " node"], "left_semi").dropDuplicates([" id", " node"]).select(docs.columns)
