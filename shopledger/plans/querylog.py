"""Reports over an exported query log: one row per statement, one per database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.operators.ranking import largest_first, smallest_first, top
from shopledger.sources.tables import Tables

# The log's own table never counts as load.
_OWN_TABLE = "%pg_stat_statements%"
_TEN = 10


def _statements(t: Tables) -> DataFrame:
    return t["query_stats"].where(~F.col("query").like(_OWN_TABLE))


def _exact(value: Column) -> Column:
    """A measured double as a decimal, so that rounding is half away from zero."""
    return value.cast("decimal(38,10)")


def _seconds(milliseconds: Column) -> Column:
    return F.round(_exact(milliseconds / 1000), 2)


def cache_hits(t: Tables) -> DataFrame:
    """Share of blocks found in memory for the statements that read most from disk."""
    hit, read = (F.col(c).cast("decimal(20,0)") for c in ("shared_blks_hit", "shared_blks_read"))
    ratio = F.round(hit * 100 / F.nullif(hit + read, F.lit(0)), 2)
    return top(
        _statements(t).select(
            "query",
            "calls",
            F.col("shared_blks_hit").alias("ram_hits"),
            F.col("shared_blks_read").alias("disk_reads"),
            ratio.alias("hit_ratio_pct"),
        ),
        _TEN,
        largest_first("disk_reads"),
        smallest_first("query"),
    )


def temp_spill(t: Tables) -> DataFrame:
    spilled = t["query_stats"].where(F.col("temp_blks_written") > 0)
    return top(
        spilled.select("query", "calls", "temp_blks_read", "temp_blks_written"),
        _TEN,
        largest_first("temp_blks_written"),
        smallest_first("query"),
    )


def total_time(t: Tables) -> DataFrame:
    heaviest = top(_statements(t), _TEN, largest_first("total_exec_time"), smallest_first("query"))
    return heaviest.select(
        "query",
        "calls",
        _seconds(F.col("total_exec_time")).alias("total_seconds"),
        _seconds(F.col("mean_exec_time")).alias("avg_seconds"),
    )


def io_wait(t: Tables) -> DataFrame:
    waited = F.col("blk_read_time") + F.col("blk_write_time")
    busy = _statements(t).where(F.col("total_exec_time") > 0)
    return top(
        busy.select(
            "query",
            _seconds(F.col("total_exec_time")).alias("total_sec"),
            _seconds(waited).alias("io_wait_sec"),
            F.round(_exact(waited * 100 / F.col("total_exec_time")), 2).alias("io_wait_percent"),
        ),
        _TEN,
        largest_first("io_wait_sec"),
        smallest_first("query"),
    )


def rows_per_call(t: Tables) -> DataFrame:
    """Whole rows per call. A statement without calls gives NULL and sorts first."""
    return top(
        _statements(t).select("query", "calls", "rows", F.expr("rows div nullif(calls, 0)").alias("rows_per_call")),
        _TEN,
        largest_first("rows_per_call"),
        smallest_first("query"),
    )


def database_cache(t: Tables, database: str | None = None) -> DataFrame:
    """Whole-percent cache ratio and rows read in vain, for one database or all."""
    stats = t["db_stats"]
    if database is not None:
        stats = stats.where(F.col("datname") == database)
    ratio = F.expr("100 * blks_hit div nullif(blks_hit + blks_read, 0)")
    return stats.select(
        "datname",
        F.round(ratio, 2).alias("global_cache_hit_ratio"),
        "tup_returned",
        "tup_fetched",
        (F.col("tup_returned") - F.col("tup_fetched")).alias("inefficient_full_scans"),
    )


def statements(t: Tables) -> DataFrame:
    return t["query_stats"]
