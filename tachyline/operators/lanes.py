"""Ordered per-simulation windows that survive a simulation of any length.

``Window.partitionBy("simulation_id")`` puts a whole simulation into one task.
That is the best plan while simulations are short: one exchange serves every
window. A simulation that holds a large share of all rows must be cut instead.

``Lanes.of`` divides a table into a *short* lane, where windows are partitioned by
the key alone, and a *long* lane for the few keys above a row limit, where the key
is cut into blocks of consecutive rows:

* bounded frames (``framed``): rows near a block edge are also sent to the
  neighbouring block, so every core row sees its complete frame;
* running values (``running``): totals per block, an exclusive running value over
  the blocks, and a window inside each block on top of it.

Both give the same values as the plain window. Operators take the lane as an
argument and are written once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tachyline.session import stage

KEY = "simulation_id"
ORDER = ("step",)

LONG_KEY_ROWS = 1 << 21
BLOCK_ROWS = 1 << 19
MAX_LISTED_KEYS = 10_000
ROWS_PER_TASK = 1 << 18

_BLOCK, _SEQ, _OWN = "__block", "__seq", "__own"
_KEY, _AT, _PLACE = "__carry_key", "__carry_block", "__place_in_order"
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_BEFORE_HERE = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Running:
    """A value accumulated from the first row of a simulation to the current row."""

    kind: str
    value: Column | None = None

    def fold(self, column: Column) -> Column:
        if self.kind in ("sum", "count"):
            return F.sum(column)
        if self.kind == "last":
            return F.last(column, ignorenulls=True)
        raise ValueError(f"unknown running value: {self.kind}")

    def over(self, window: WindowSpec) -> Column:
        if self.kind == "count":
            return F.row_number().over(window).cast("long")
        return self.fold(self.value).over(window.rowsBetween(*_UP_TO_HERE))

    def block_total(self, order: Column) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1))
        if self.kind == "last":
            # Order values may be missing; such rows come first.
            placed = F.struct(order.isNotNull(), order)
            return F.max_by(self.value, F.when(self.value.isNotNull(), placed))
        return F.sum(self.value)

    def join_carry(self, carry: Column, inside: Column) -> Column:
        if self.kind == "last":
            return F.coalesce(inside, carry)
        return F.when(carry.isNull(), inside).when(inside.isNull(), carry).otherwise(carry + inside)


Columns = Callable[[WindowSpec], dict[str, Column]]


@dataclass(frozen=True)
class Within:
    """Columns over parts of a simulation: ``columns`` gets the partitioning by ``part``, to be ordered."""

    part: str
    columns: Columns


Stage = Columns | Within


def _add_stages(df: DataFrame, stages: Sequence[Stage], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    for added in stages:
        if isinstance(added, Within):
            df = df.withColumns(added.columns(Window.partitionBy(*keys, added.part)))
        else:
            df = df.withColumns(added(Window.partitionBy(*keys).orderBy(*order)))
    return df


def row_count() -> Running:
    return Running("count")


def running_sum(value: Column) -> Running:
    return Running("sum", value)


def last_known(value: Column) -> Running:
    return Running("last", value)


class ShortLane:
    """Simulations that fit one task: windows partitioned by the key alone."""

    def running(
        self,
        df: DataFrame,
        specs: dict[str, Running],
        order: Sequence[str] = ORDER,
        block_rows: int | None = None,
    ) -> DataFrame:
        window = Window.partitionBy(KEY).orderBy(*order)
        return df.withColumns({name: spec.over(window) for name, spec in specs.items()})

    def framed(
        self,
        df: DataFrame,
        *stages: Stage,
        before: int = 0,
        after: int = 0,
        order: Sequence[str] = ORDER,
        index: str | None = None,
        part_rows: int = 1,
    ) -> DataFrame:
        return _add_stages(df, stages, [KEY], order)

    def settle(self, df: DataFrame) -> DataFrame:
        return df


@dataclass(frozen=True)
class LongLane:
    """Simulations too long for one task, cut into blocks of ``block_rows`` rows."""

    block_rows: int = BLOCK_ROWS

    def running(
        self,
        df: DataFrame,
        specs: dict[str, Running],
        order: Sequence[str] = ORDER,
        block_rows: int | None = None,
    ) -> DataFrame:
        """Blocks are ranges of the leading order column, ``block_rows`` units wide.

        Rows without an order value are the first block; a missing key is a key.
        """
        width = block_rows or self.block_rows
        # A struct of missing values equals another one, so that the join and the window share one exchange of the rows.
        blocked = df.withColumn(_BLOCK, F.floor(F.col(order[0]) / width)).withColumn(_PLACE, F.struct(KEY, _BLOCK))
        position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
        totals = blocked.groupBy(F.col(KEY).alias(_KEY), F.col(_BLOCK).alias(_AT)).agg(
            *[spec.block_total(position).alias(f"__total_{name}") for name, spec in specs.items()]
        )
        earlier = Window.partitionBy(_KEY).orderBy(_AT).rowsBetween(*_BEFORE_HERE)
        carries = totals.select(
            _KEY,
            _AT,
            *[
                spec.fold(F.col(f"__total_{name}")).over(earlier).alias(f"__carry_{name}")
                for name, spec in specs.items()
            ],
        )
        window = Window.partitionBy(_PLACE).orderBy(*order)
        placed = carries.withColumn(_PLACE, F.struct(F.col(_KEY).alias(KEY), F.col(_AT).alias(_BLOCK))).drop(_KEY, _AT)
        joined = blocked.join(placed, _PLACE)
        valued = joined.withColumns(
            {
                name: spec.join_carry(F.col(f"__carry_{name}"), spec.over(window))
                for name, spec in specs.items()
            }
        )
        return valued.select(*dict.fromkeys([*df.columns, *specs]))

    def framed(
        self,
        df: DataFrame,
        *stages: Stage,
        before: int = 0,
        after: int = 0,
        order: Sequence[str] = ORDER,
        index: str | None = None,
        part_rows: int = 1,
    ) -> DataFrame:
        """Columns that look up to ``before`` rows back and ``after`` ahead, over all stages.

        ``index`` names a row number within the simulation, from 1, if there is one.
        Parts of ``part_rows`` rows, counted from the first, are never cut by a block.
        """
        block_rows = -(-max(self.block_rows, before, after) // part_rows) * part_rows
        numbered = df if index else self.running(df, {_SEQ: row_count()}, order)
        at = F.col(index or _SEQ) - 1
        place = F.pmod(at, F.lit(block_rows))
        own = F.floor(at / block_rows)
        targets = F.array_compact(
            F.array(
                own,
                F.when(place >= block_rows - before, own + 1),
                F.when((place < after) & (own > 0), own - 1),
            )
        )
        spread = numbered.withColumn(_OWN, own).withColumn(_BLOCK, F.explode(targets))
        # Stated here, because a stage within parts would otherwise ask for a finer exchange first.
        placed = spread.repartition(KEY, _BLOCK)
        made = _add_stages(placed, stages, [KEY, _BLOCK], order)
        return made.where(F.col(_BLOCK) == F.col(_OWN)).drop(_BLOCK, _OWN, _SEQ)

    def settle(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as a table before it feeds another window.

        Block totals and rows are two passes over the input, so without this each
        further window would double the work on everything before it.
        """
        return stage(df, "long-lane")


SHORT = ShortLane()


def long_keys(df: DataFrame, key: str, limit: int, at_most: int = MAX_LISTED_KEYS) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None if there are none.

    There can be no more than ``rows / limit`` of them. Up to ``at_most`` are
    brought over and joined as a broadcast list; more stay a plain frame that
    Spark joins by size.
    """
    heavy = df.groupBy(key).count().where(F.col("count") > limit).select(key)
    found = heavy.limit(at_most + 1).collect()
    if not found:
        return None
    if len(found) > at_most:
        return heavy
    return F.broadcast(df.sparkSession.createDataFrame([tuple(row) for row in found], heavy.schema))


def spread(df: DataFrame, key: str, rows: int, at_most: int = ROWS_PER_TASK) -> DataFrame:
    """With more rows than the session's exchanges are cut for, an exchange into more parts, which the windows share.

    Otherwise the rows of a task, and the memory it sorts them in, would grow with the table.
    """
    parts = -(-rows // at_most)
    cut_for = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key) if parts > cut_for else df


class Lanes:
    """A table divided into short and long simulations, processed side by side."""

    def __init__(self, parts: Sequence[tuple[DataFrame, ShortLane | LongLane]]):
        self.parts = list(parts)

    @classmethod
    def of(
        cls,
        df: DataFrame,
        key: str = KEY,
        long_rows: int | None = None,
        block_rows: int | None = None,
    ) -> Lanes:
        conf = df.sparkSession.conf
        limit = long_rows or int(conf.get("spark.tachyline.longKeyRows", str(LONG_KEY_ROWS)))
        block = block_rows or int(conf.get("spark.tachyline.blockRows", str(BLOCK_ROWS)))
        size = df.groupBy(key).count().agg(F.sum("count").alias("rows"), F.max("count").alias("longest")).first()
        keys = long_keys(df, key, limit) if (size["longest"] or 0) > limit else None
        if keys is None:
            return cls([(spread(df, key, size["rows"] or 0), SHORT)])
        # A missing key is a key too, and may be a long one.
        listed = keys.withColumnRenamed(key, _KEY)
        found = df[key].eqNullSafe(listed[_KEY])
        return cls(
            [
                (spread(df.join(listed, found, "left_anti"), key, size["rows"]), SHORT),
                (df.join(listed, found, "left_semi"), LongLane(block)),
            ]
        )

    def map(self, step: Callable[[DataFrame, ShortLane | LongLane], DataFrame]) -> Lanes:
        return Lanes([(step(df, lane), lane) for df, lane in self.parts])

    def transform(self, step: Callable[[DataFrame], DataFrame]) -> Lanes:
        return self.map(lambda df, _: step(df))

    def union(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [df for df, _ in self.parts])
