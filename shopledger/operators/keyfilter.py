"""Dropping rows early whose key cannot be among some others, by a bitmap of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Longs of the bitmap: a quarter of a megabyte. It does not grow with the keys; beyond some millions of
# them it lets most rows through, and whatever follows does the work it did without it.
WORDS = 1 << 15


def may_match(frame: DataFrame, keys: Sequence[str], wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows of ``frame`` whose ``keys`` may be among those of ``wanted``: all that are, and few others.

    The bitmap is a one-row subquery of the same plan, so nothing is collected, and the test
    stands right above the scan, before any exchange of ``frame``. A join that decides must
    follow. Keys with a NULL meet nothing.
    """
    types = {field.name: field.dataType for field in frame.schema}
    typed = wanted.select(*[F.col(k).cast(types[k]).alias(k) for k in keys])
    slot = F.pmod(F.xxhash64(*keys), F.lit(words * 64).cast("long"))
    marked = typed.dropna().select(slot.alias("slot")).select(
        F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bits")
    )
    every = frame.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    row = marked.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bitmap = row.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("bitmap")).scalar()
    word = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
    return frame.dropna(subset=list(keys)).where(F.getbit(word, slot.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1)
