"""Three-valued predicates and NULL-tolerant text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def live_unless_deleted(is_deleted: Column) -> Column:
    """An unknown deletion flag counts as live."""
    return ~F.coalesce(is_deleted, F.lit(False))


def known_live(is_deleted: Column) -> Column:
    """An unknown deletion flag does not count as live."""
    return is_deleted == F.lit(False)


def full_name(first: Column, last: Column) -> Column:
    """``first last``; a missing part is left empty and the blank stays."""
    return F.concat_ws("", first, F.lit(" "), last)
