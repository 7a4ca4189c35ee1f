"""Orders and limits with the NULL placement the dashboard relies on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base rows that ``first_rows`` tries before it turns to the whole view.
WIDTHS = (256, 4096)
# The column by which the rows of a view remember their base row.
PLACE = "_place"


def largest_first(column: str) -> Column:
    """Descending, NULL on top."""
    return F.col(column).desc_nulls_first()


def smallest_first(column: str) -> Column:
    """Ascending, NULL at the end."""
    return F.col(column).asc_nulls_last()


def top(frame: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows. End ``order`` with a unique key, or ties fall at random."""
    return frame.orderBy(*order).limit(k)


def preview(frame: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` smallest rows over all columns: a look at a view that is repeatable."""
    return top(frame, k, *[smallest_first(c) for c in frame.columns])


def first_rows(
    base: DataFrame, keys: Sequence[str], build: Callable[[DataFrame], DataFrame], k: int = 10, widths: Sequence[int] = WIDTHS
) -> DataFrame:
    """The ``k`` rows of a view that come from the smallest base rows, in the order of these.

    ``build`` makes the view from base rows and keeps their column ``PLACE``. The limit stands
    below the joins: only the smallest base rows by ``keys`` meet them, first few, then more; they are
    small enough to be held by the plan itself. If even those leave fewer than ``k``, the whole view is
    sorted. ``keys`` must tell base rows apart, but for equal ones. Runs a job per width.
    """
    order = [smallest_first(c) for c in keys]

    def ordered(rows: DataFrame) -> DataFrame:
        made = build(rows.withColumn(PLACE, F.struct(*keys)))
        places = [smallest_first(f"{PLACE}.{c}") for c in keys]
        return top(made, k, *places, *[smallest_first(c) for c in made.columns if c != PLACE]).drop(PLACE)

    for width in widths:
        held = top(base, width, *order).toArrow()
        found = ordered(F.broadcast(base.sparkSession.createDataFrame(held, base.schema)))
        if held.num_rows < width or len(found.take(k)) == k:
            return found
    return ordered(base)
