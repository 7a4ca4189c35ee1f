"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table, a permutation given by
an offset and a step; the table's size is prime, so that any step visits every slot. The
shards take turns, each claiming the next free slot of its order, until the table is full.
Shards then hold almost the same number of slots, and when one joins or leaves, few slots
change hands. A row is placed by its key's hash modulo the size: one look into the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = 64


def names(count: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def preference(shard: str, slots: int = SLOTS) -> tuple[int, int]:
    """Offset and step of a shard's order over the slots."""
    return _number(f"offset {shard}") % slots, _number(f"step {shard}") % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Number of the shard that holds each slot; ``slots`` is a prime above the number of shards."""
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    if not 0 < len(shards) <= slots or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, at least one and at most as many as slots")
    # Turns go by name, so that the order in which shards are given does not matter.
    turns = sorted(range(len(shards)), key=shards.__getitem__)
    orders = [preference(s, slots) for s in shards]
    at = [offset for offset, _ in orders]
    table, free = [-1] * slots, slots
    while True:
        for shard in turns:
            step = orders[shard][1]
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step) % slots
            table[at[shard]] = shard
            free -= 1
            if not free:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo the size. Null counts as empty."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(slots).cast("long"))


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``slot, shard``: one row per slot, at most as many as the size of the table."""
    rows = list(enumerate(lookup_table(shards, slots)))
    return spark.createDataFrame(rows, "slot long, shard int")


def place(frame: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``frame`` with ``slot`` and ``shard`` (a number into ``shards``), replacing columns of these names.

    The table has ``slots`` rows whatever the data, so it is broadcast. Equal keys go to one
    shard; a null key goes where the empty text goes. Rows stay as they are.
    """
    table = table_frame(frame.sparkSession, shards, slots)
    kept = frame.drop("shard").withColumn("slot", slot_of(frame[key], slots))
    return kept.join(F.broadcast(table), "slot").select(*[c for c in kept.columns if c != "slot"], "slot", "shard")


def write(frame: DataFrame, key: str, shards: Sequence[str], folder: str, slots: int = SLOTS) -> None:
    """Writes the rows as Parquet, one directory per shard. Rows are not moved: each task writes its share."""
    place(frame, key, shards, slots).drop("slot").write.partitionBy("shard").parquet(folder)


def placements(documents: DataFrame, shards: Sequence[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``doc_id, slot, shard`` of each row of ``documents(doc_id, ...)``; repeated rows stay."""
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    return place(chosen, "doc_id", names() if shards is None else shards, slots)
