"""Divergence between the sources of a language, by three-dimensional cube partitioning.

For every language the terms found in at least ``least_docs`` of its documents are kept. Each
(lang, source) group and each language gives every kept term a smoothed share in billionths.
Two results follow, both exact integers:

* ``pair``: for any two sources of a language the sum over all kept terms of the difference of
  their shares;
* ``term``: for each group the terms by which it exceeds its language most.

**Pairs** grow with groups x groups x terms. That cube is cut along all three axes into cells of
(group block, group block, term block), one per task group. A cell gets two slices, the shares
of either group block for the terms of its term block; a slice is copied to all cells of its
row and column, no further. The cell adds up the partial divergence of each of its pairs, and
the partial sums are reduced along the term axis. Only one of the two halves of the cube is
computed, as the divergence is symmetric. A cell holds about ``2 * GROUP_BLOCK * TERM_BLOCK``
shares at most, whatever the input. Shares of terms that do not occur in a group are one number
per group; a cell needs no rows for them, and terms that occur in neither slice are settled in
the reduction.

**Counts** are combined per task before the shuffle, so a very common term or source costs one
row per task.

NULL text, lang or source count as ''. A text without terms, empty or NULL, still makes its
group occur; a language without kept terms has pairs with the value 0 and no terms. Repeated
rows count each for itself. Ties are ranked by the UTF-8 bytes of the item. An empty table gives
no rows; other columns are ignored.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tachyline.llm.common import LOWER_ASCII
from tachyline.session import stage

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LEAST_DOCS = 30
TOP_TERMS = 50
UNIT = 1_000_000_000  # shares are billionths
PRIOR = 5  # added to every count
GROUP_BLOCK, TERM_BLOCK = 64, 1024
MOST_COUNTS = 400_000  # counts a task holds before it passes them on
ROWS_OUT = 1 << 16

COUNTS = "lang string, source string, term string, n long, docs long"
CELL_KEY = ["lang", "row_block", "column_block", "term_block"]
PARTIALS = "lang string, source string, item string, partial long, seen long, rest long, kept long"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term, per group.

    The term '' marks that the group occurs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (times, docs) in found.items():
                terms = [b"", *times]
                for at in range(0, len(terms), ROWS_OUT):
                    part = terms[at : at + ROWS_OUT]
                    names = pa.array(part, pa.binary()).cast(pa.string())
                    numbers = [pa.array([counter.get(t, 0) for t in part], pa.int64()) for counter in (times, docs)]
                    groups = [pa.array([name] * len(part), pa.string()) for name in (lang, source)]
                    yield pa.RecordBatch.from_arrays([*groups, names, *numbers], names=["lang", "source", "term", "n", "docs"])
            found.clear()

        for batch in batches:
            groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            texts = batch.column(2).cast(pa.large_binary())
            for at, group in enumerate(groups):
                terms = TERM.findall(texts[at].as_py().translate(LOWER_ASCII))
                times, docs_with = found.setdefault(group, (Counter(), Counter()))
                times.update(terms)
                docs_with.update(set(terms))
                if at % 64 == 63 and sum(len(x) for x, _ in found.values()) > MOST_COUNTS:
                    yield from passed_on()
        yield from passed_on()

    plain = docs.select(*[F.coalesce(docs[name].cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")])
    raw = plain.mapInArrow(count, COUNTS)
    return raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, whole: Column) -> Column:
    """1 + floor(UNIT * (n + PRIOR) / whole), exact for any long."""
    return 1 + F.call_function("div", (n + PRIOR).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)"), whole.cast("decimal(19,0)"))


class Shares:
    """The staged tables both parts start from.

    ``groups`` (lang, source, whole, lang_whole, kept, n_groups) has one row per group, ``rates``
    (lang, source, term, p, q) one per group and kept term that occurs in it.
    """

    def __init__(self, docs: DataFrame, least_docs: int):
        counts = stage(term_counts(docs), "term-counts")
        terms = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        terms = stage(terms.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
        kept = stage(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-counts")
        langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
        totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counts.where("term = ''").select("lang", "source")
        sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_groups"))
        none = F.lit(0).cast("long")
        joined = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang")
        size = F.coalesce("kept", none)
        self.groups = stage(
            joined.select("lang", "source", (F.coalesce("total", none) + PRIOR * size).alias("whole"), (F.coalesce("lang_total", none) + PRIOR * size).alias("lang_whole"), size.alias("kept"), "n_groups"),
            "term-groups",
        )
        rates = kept.join(self.groups.select("lang", "source", "whole", "lang_whole"), ["lang", "source"])
        self.rates = stage(rates.select("lang", "source", "term", share(F.col("n"), F.col("whole")).alias("p"), share(F.col("lang_n"), F.col("lang_whole")).alias("q")), "term-shares")


def cells(shares: Shares, group_block: int, term_block: int) -> DataFrame:
    """The slices of all cells: one row per share and cell, and one without a term per group and cell."""

    def blocks(number: str, size: int) -> Column:
        return F.greatest(F.ceil(F.col(number) / size), F.lit(1)).cast("long")

    row = F.pmod(F.xxhash64("source"), F.col("group_blocks"))
    groups = shares.groups.select("lang", "source", "whole", "kept", blocks("n_groups", group_block).alias("group_blocks"), blocks("kept", term_block).alias("term_blocks"))
    groups = groups.withColumn("block", row)
    placed = groups.select("lang", "source", "block", "group_blocks", "term_blocks")
    present = shares.rates.join(placed, ["lang", "source"]).select(
        "lang", "source", "term", "p", F.lit(None).cast("long").alias("kept"), "block", "group_blocks", F.pmod(F.xxhash64("term"), F.col("term_blocks")).alias("term_block")
    )
    absent = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.when(F.col("whole") > 0, F.col("whole")))).otherwise(0)
    marks = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), absent.alias("p"), "kept", "block", "group_blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)).alias("term_block")
    )
    copied = present.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1)))
    return copied.select("lang", F.least("block", "other").alias("row_block"), F.greatest("block", "other").alias("column_block"), "term_block", "source", "term", "p", "kept", "block")


def cell_divergences(cell: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of one cell.

    ``partial`` covers the ``seen`` terms that occur in either slice; ``rest`` is what each
    other term adds.
    """
    lang, row = cell["lang"][0].as_py(), cell["row_block"][0].as_py()
    names = cell["source"].combine_chunks().dictionary_encode()
    terms = cell["term"].combine_chunks().dictionary_encode()
    source, p = names.indices.to_numpy(), cell["p"].to_numpy()
    mark = terms.indices.is_null().to_numpy(zero_copy_only=False)
    blocks, absent = np.zeros(len(names.dictionary), np.int64), np.zeros(len(names.dictionary), np.int64)
    blocks[source[mark]] = cell["block"].to_numpy()[mark]
    absent[source[mark]] = p[mark]
    kept = int(cell["kept"].drop_null()[0].as_py())
    matrix = np.repeat(absent[:, None], len(terms.dictionary), axis=1)
    matrix[source[~mark], terms.indices.drop_null().to_numpy()] = p[~mark]
    rows = np.flatnonzero(blocks == row)
    columns = rows if cell["column_block"][0].as_py() == row else np.flatnonzero(blocks != row)
    ones, others, partial, rest = [], [], [], []
    for at, one in enumerate(rows.tolist()):
        met = columns[at + 1 :] if columns is rows else columns
        ones += [one] * len(met)
        others.append(met)
        partial.append(np.abs(matrix[met] - matrix[one]).sum(axis=1))
        rest.append(np.abs(absent[met] - absent[one]))
    ones, others = pa.array(ones, pa.int32()), pa.array(np.concatenate([*others, []]).astype(np.int32))
    columns = [pa.array([lang] * len(ones), pa.string()), names.dictionary.take(ones), names.dictionary.take(others)]
    numbers = [np.concatenate([*partial, []]).astype(np.int64), np.full(len(ones), len(terms.dictionary)), np.concatenate([*rest, []]).astype(np.int64), np.full(len(ones), kept)]
    return pa.Table.from_arrays([*columns, *map(pa.array, numbers)], names=["lang", "source", "item", "partial", "seen", "rest", "kept"])


def ranked(found: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = found.withColumn("rank", F.row_number().over(order))
    if most is not None:
        found = found.where(F.col("rank") <= most)
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def pair_divergences(shares: Shares, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """The divergence of any two sources of a language, each pair both ways."""
    partials = cells(shares, group_block, term_block).groupBy(*CELL_KEY).applyInArrow(cell_divergences, PARTIALS)
    # Which source of a pair a cell names first depends on the blocks; the names settle it.
    low, high = F.least("source", "item"), F.greatest("source", "item")
    sums = partials.groupBy("lang", low.alias("low"), high.alias("high")).agg(
        F.sum("partial").alias("partial"), F.sum("seen").alias("seen"), F.max("rest").alias("rest"), F.max("kept").alias("kept")
    )
    value = F.col("partial") + (F.col("kept") - F.col("seen")) * F.col("rest")
    both = F.array(F.struct(F.col("low").alias("source"), F.col("high").alias("item")), F.struct(F.col("high").alias("source"), F.col("low").alias("item")))
    pairs = sums.select("lang", value.alias("value"), F.explode(both).alias("pair"))
    return ranked(pairs.select("lang", "pair.source", "pair.item", "value"), "pair")


def leading_terms(shares: Shares, most: int = TOP_TERMS) -> DataFrame:
    """The ``most`` terms by which each group exceeds its language most."""
    above = shares.rates.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked(above, "term", most)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = TOP_TERMS, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """Both parts: lang, source, part, item, value, rank."""
    shares = Shares(docs, least_docs)
    return pair_divergences(shares, group_block, term_block).unionByName(leading_terms(shares, most_terms))
