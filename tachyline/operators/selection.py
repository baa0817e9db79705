"""Exact selection by rank over columns too large for one task.

Each round narrows the candidates with a bounded summary and keeps only the rows
that can still hold the wanted rank. What is finally sorted in one place is at most
``RANKED_AT_ONCE`` distinct values, with their counts.
"""

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tachyline.session import stage

RANKED_AT_ONCE = 1 << 20
_ACCURACY = 10_000
_MARGIN = 3.0 / _ACCURACY


def _value_at(counted: DataFrame, rank: int):
    """Value at a 1-based rank, from distinct values ``v`` with their ``count``."""
    running = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counted.select("v", F.sum("count").over(running).alias("upto")).where(F.col("upto") >= rank)
    return reached.agg(F.min("v")).first()[0]


def exact_quantile(values: DataFrame, quantile: float, at_once: int = RANKED_AT_ONCE) -> float | None:
    """Smallest value whose share of rows at or below it reaches ``quantile``.

    ``values`` has one double column; NULLs do not count. Approximate quantiles
    bracket the wanted rank with an error known to be below the margin. If the rank
    falls on an end of the bracket, that is the answer, however often the value
    occurs; otherwise only what lies strictly between is kept, a small share.
    """
    column = F.col(values.columns[0])
    held = stage(values.select(column.alias("v")).where(column.isNotNull()), "quantile")
    v, total, margin = F.col("v"), held.count(), _MARGIN
    if total == 0:
        return None
    rank = max(1, ceil(quantile * total))
    while total > at_once:
        share = rank / total
        ends = F.array(F.lit(max(0.0, share - margin)), F.lit(min(1.0, share + margin)))
        low, high = held.agg(F.percentile_approx("v", ends, F.lit(_ACCURACY))).first()[0]
        counts = [v < low, v == low, (v > low) & (v < high), v > high]
        below, at_low, between, above = held.agg(*[F.count_if(part) for part in counts]).first()
        if not below < rank <= total - above:
            margin *= 2
        elif rank <= below + at_low:
            return low
        elif rank > below + at_low + between:
            return high
        else:
            held = held.where(counts[2])
            rank, total = rank - below - at_low, between
    return _value_at(held.groupBy("v").count(), rank)


def ranked_text(ids: DataFrame, rank: int, at_once: int = RANKED_AT_ONCE) -> str:
    """The distinct non-NULL string at a 1-based rank in ascending order.

    ``ids`` has one string column of distinct values. Ids are counted by prefix,
    one character longer each round, so a round returns one row per character
    that can follow the prefix.
    """
    value = F.col(ids.columns[0])
    held = ids.select(value.alias("v"))
    prefix = ""
    while True:
        head = F.substring("v", 1, len(prefix) + 1)
        for start, count in held.groupBy(head.alias("v")).count().orderBy("v").collect():
            if rank <= count:
                break
            rank -= count
        if start == prefix:
            return prefix
        prefix = start
        held = held.where(F.col("v").startswith(prefix))
        if count <= at_once:
            return _value_at(held.withColumn("count", F.lit(1)), rank)
