"""Statistics over a fixed number of rows at a cost per row that does not grow with it.

Spark evaluates a sliding frame anew for every row. Here the rows of a simulation
are cut into chunks as long as the frame. Any frame is then the end of one chunk
and the beginning of the next: a running value from the front of the chunk, joined
with the value running from its back at the frame's first row. Both run in growing
frames, which Spark extends by one row at a time. Means and squared deviations are
joined, not sums of squares, so nothing cancels out.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tachyline.operators.lanes import SHORT, LongLane, ShortLane, Within, row_count

INDEX = "__index"
_CHUNK = "__frame_chunk"
_PARTS = {
    "rows": F.count,
    "mean": F.avg,
    "spread": F.var_pop,
    "max": F.max,
    "min": F.min,
}


def _running(values: dict[str, Column], side: str, window: WindowSpec) -> dict[str, Column]:
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {
        f"__{side}_{name}_{part}": function(value).over(frame)
        for name, value in values.items()
        for part, function in _PARTS.items()
    }


def _joined(name: str) -> dict[str, Column]:
    """One frame from its two parts; the earlier part is NULL where there is none."""

    def part(side: str, kind: str) -> Column:
        return F.col(f"__{side}_{name}_{kind}")

    front, back = part("front", "rows"), F.coalesce(part("back", "rows"), F.lit(0))
    rows = front + back
    shift = F.coalesce(part("front", "mean") - part("back", "mean"), F.lit(0.0))
    mean_front, mean_back = (F.coalesce(part(side, "mean"), F.lit(0.0)) for side in ("front", "back"))
    deviation = (
        F.coalesce(part("front", "spread"), F.lit(0.0)) * front
        + F.coalesce(part("back", "spread"), F.lit(0.0)) * back
        + shift * shift * front * back / rows
    )
    return {
        f"{name}_mean": F.when(rows > 0, (mean_front * front + mean_back * back) / rows),
        f"{name}_stddev": F.when(rows > 1, F.sqrt(deviation / (rows - 1))),
        f"{name}_max": F.greatest(part("front", "max"), part("back", "max")),
        f"{name}_min": F.least(part("front", "min"), part("back", "min")),
    }


def sliding(
    df: DataFrame, values: dict[str, Column], rows: int, lane: ShortLane | LongLane = SHORT
) -> tuple[DataFrame, dict[str, Column]]:
    """Mean, sample deviation, maximum and minimum of ``values`` over this row and the ``rows - 1`` before.

    Returns the frame with helper columns and the expressions over them, named
    ``<value>_mean`` and so on; what is not used is pruned. ``__index`` is the row
    number in the simulation, from 1.
    """
    numbered = lane.running(df, {INDEX: row_count()})
    chunked = numbered.withColumn(_CHUNK, F.floor((F.col(INDEX) - 1) / rows))
    within = F.pmod(F.col(INDEX), F.lit(rows)) != 0

    def from_frame_start(w: WindowSpec) -> dict[str, Column]:
        return {
            f"__back_{name}_{part}": F.when(within, F.lag(f"__suffix_{name}_{part}", rows - 1).over(w))
            for name in values
            for part in _PARTS
        }

    made = lane.framed(
        chunked,
        Within(_CHUNK, lambda w: _running(values, "suffix", w.orderBy(F.desc(INDEX)))),
        Within(_CHUNK, lambda w: _running(values, "front", w.orderBy(INDEX))),
        from_frame_start,
        before=rows - 1,
        # Orders the rows like the step, in the sort order of the window before.
        order=(_CHUNK, INDEX),
        index=INDEX,
        part_rows=rows,
    )
    return made, {name: column for value in values for name, column in _joined(value).items()}
