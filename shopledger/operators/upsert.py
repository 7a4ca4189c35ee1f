"""Keyed table writes: as DataFrame plans that give the table's new content, and into a published table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.calendar import ntz
from shopledger.operators.keyfilter import may_match
from shopledger.operators.scope import any_of
from shopledger.sources.published import DIRECTORY, Published, Version


def one_per_key(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest over the other columns, so reruns agree.

    A plain aggregate: copies of a hot key are merged before the shuffle.
    """
    rest = [c for c in frame.columns if c not in keys]
    if not rest:
        return frame.distinct()
    return (
        frame.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
        .select(*frame.columns)
    )


def _known_columns(target: DataFrame, given: DataFrame) -> None:
    if unknown := [c for c in given.columns if c not in target.columns]:
        raise ValueError(f"the table has no column {', '.join(unknown)}")


def _absent(target: DataFrame, source: DataFrame, keys: Sequence[str], *, filtered: bool) -> DataFrame:
    """The rows of ``source`` that ``insert_if_absent`` adds."""
    _known_columns(target, source)
    open_key = any_of([F.col(k).isNull() for k in keys])
    arriving = one_per_key(source.where(~open_key), keys)
    held = target.select(*keys)
    # Only the target's rows that may meet an arriving key are exchanged.
    fresh = arriving.join(may_match(held, keys, arriving) if filtered else held, list(keys), "left_anti")
    return fresh.unionByName(source.where(open_key))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` plus the rows of ``source`` whose key it lacks; existing rows win.

    Columns that ``source`` lacks become NULL. A key with a NULL in it never equals
    another, so such rows are all inserted, as a unique constraint would allow. Columns
    that ``target`` lacks are refused.
    """
    arriving = _absent(target, source, keys, filtered=False)
    return target.unionByName(arriving, allowMissingColumns=True).select(*target.columns)


def insert_published(table: Published, source: DataFrame, keys: Sequence[str], job: str | None = None) -> Version:
    """As ``insert_if_absent``, into a published table: only the fresh rows are written.

    Of the table the key columns are read, and rows that cannot meet an arriving key are
    dropped before any exchange. ``source`` is read more than once and must give the same rows.
    """

    def fresh(old: Version) -> tuple[DataFrame, Sequence[str]]:
        target = table.read(old)
        rows = _absent(target, source, keys, filtered=True)
        return target.limit(0).unionByName(rows, allowMissingColumns=True), ()

    return table.change(fresh, job)


def update_touch(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    now: datetime,
    touched: str = "updated_at",
) -> DataFrame:
    """``target`` with the columns of ``updates`` taken over where the key matches.

    Matched rows also get ``now`` in ``touched``. The job time is an argument, so a
    task that is run again writes the same value. Columns that ``target`` lacks are refused.
    """
    _known_columns(target, updates)
    changed = [c for c in updates.columns if c not in keys]
    incoming = one_per_key(updates, keys).select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in changed], F.lit(True).alias("_matched")
    )

    def value(column: str):
        if column in changed:
            new = F.col(f"_new_{column}")
        elif column == touched:
            new = ntz(now)
        else:
            return F.col(column)
        return F.when(F.col("_matched"), new).otherwise(F.col(column)).alias(column)

    return target.join(incoming, list(keys), "left").select(*[value(c) for c in target.columns])


def update_published(
    table: Published,
    updates: DataFrame,
    keys: Sequence[str],
    now: datetime,
    touched: str = "updated_at",
    job: str | None = None,
) -> Version:
    """As ``update_touch``, into a published table: only directories that hold a touched key are rewritten.

    They are found by reading the key columns alone. The files of other directories stay as
    they are, and readers see all of the update or nothing of it.
    """

    def rewritten(old: Version) -> tuple[DataFrame | None, Sequence[str]]:
        _known_columns(table.read(old), updates)
        held = may_match(table.read(old, marked=True).select(*keys, DIRECTORY), keys, updates)
        hit = held.join(updates.select(*keys), list(keys), "left_semi").select(DIRECTORY).distinct()
        directories = sorted(r[0] for r in hit.collect())
        if not directories:
            return None, ()
        return update_touch(table.read(old, directories), updates, keys, now, touched), directories

    return table.change(rewritten, job)
