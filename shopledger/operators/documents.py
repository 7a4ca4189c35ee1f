"""JSON documents built from small, already aggregated frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_json(value: Column) -> Column:
    """JSON text that keeps NULL members."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def list_by(key: Column, *members: Column) -> Column:
    """Aggregate: the ``members`` of every row as structs, ordered by ``key``.

    Only for frames whose row count is bounded by the calendar or by a top-k. The
    comparator looks at the key alone, so members may hold maps.
    """
    rows = F.collect_list(F.struct(key.alias("_key"), F.struct(*members).alias("_row")))

    def by_key(a: Column, b: Column) -> Column:
        return F.when(a["_key"] < b["_key"], -1).when(a["_key"] > b["_key"], 1).otherwise(0)

    return F.transform(F.array_sort(rows, by_key), lambda r: r["_row"])


def null_if_empty(values: Column) -> Column:
    """An aggregate over no rows gives no list at all rather than an empty one."""
    return F.when(F.size(values) > 0, values)
