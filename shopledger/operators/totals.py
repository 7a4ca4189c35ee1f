"""Grand totals next to grouped rows, with one read of the facts below them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.operators.ranking import top


def few_in_order(rows: DataFrame, order: Sequence[str], **totals: Column) -> DataFrame:
    """``rows`` sorted by the columns ``order``, aggregates over all of them as columns.

    Only for frames bounded by the calendar (hours, weekdays, months): they are folded
    into one row next to their totals and unfolded again, which takes one small exchange
    and no further sort.
    """
    others = [c for c in rows.columns if c not in order]
    folded = rows.agg(
        F.sort_array(F.collect_list(F.struct(*order, *others))).alias("_rows"),
        *[total.alias(name) for name, total in totals.items()],
    )
    return folded.select(F.inline("_rows"), *totals)


def with_totals(rows: DataFrame, sums: dict[str, str], source: DataFrame | None = None) -> DataFrame:
    """``rows`` beside sums over all rows of ``source`` (of ``rows`` itself by default).

    The totals are a one-row subquery over the aggregate that also feeds the rows. Both
    share its exchange, so the facts below it are read once; ``tests/test_plans.py`` holds
    the executed plans to that.
    """
    totals = F.struct(*[F.sum(column).alias(name) for name, column in sums.items()])
    total = (rows if source is None else source).agg(totals).scalar()
    return rows.select("*", *[total[name].alias(name) for name in sums])


def top_with_totals(rows: DataFrame, k: int, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """The first ``k`` rows beside sums over all of them; ``rows`` must end in an aggregate or a join of one."""
    return with_totals(top(rows, k, *order), sums, rows)
