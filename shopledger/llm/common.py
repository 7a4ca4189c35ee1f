"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Task functions travel by value, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Where a session on one machine has no such setting (tests) a temporary folder is used. On a
    cluster that would be a folder of each machine's own, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="shopledger-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """The frame written once as a table in the shared folder and read back.

    It cuts the lineage and survives lost executors; the tables are small (ids,
    fingerprints, labels) and go with the cluster's clean-up of its checkpoint folder.
    """
    spark = frame.sparkSession
    path = shared_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def by_batch(
    frame: DataFrame, columns: list[str], work: Callable[..., Iterator[dict[str, list]]], schema: str
) -> DataFrame:
    """``work(*lists)`` over each Arrow batch of the named columns; it yields columns of result rows."""
    target = _arrow_schema(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [_plain(batch.column(i)) for i in range(batch.num_columns)]
            for made in work(*lists):
                yield pa.RecordBatch.from_pydict(made, schema=target)

    return frame.select(*columns).mapInArrow(run, schema)


def in_parts(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in parts whose texts have up to ``most`` bytes together, or of one row.

    What a task makes of a part at a time is then bounded, however many rows a batch has and
    however long they are.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends, at = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def _plain(column: pa.Array) -> list:
    """Values as Python objects; text as UTF-8 bytes, which skips a decoding nobody may need."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.to_pylist()


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links ``(a, b)``: rows ``(node, root)``.

    Only linked nodes appear; ``root`` is the smallest node of the component. Alternating
    large and small stars (Kiveris et al., 2014): a logarithmic number of rounds, each
    with as many links as nodes at most in the end, and each written to the shared folder.
    The smallest neighbours are written too, so that the joins with them stand between
    exchanges and a node with very many neighbours is split.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = _state(edges)
    while True:
        edges = stored(_small_star(stored(_large_star(edges))))
        if (now := _state(edges)) == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Two equal states in a row mean that no round will change the stars any more."""
    mixed = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.shiftright(mixed, 20))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour larger than a node moves to the smallest node of the neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stored(both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")))
    return (
        both.join(low, F.col("u") == F.col("n"))
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, move to the smallest of them."""
    low = stored(edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")))
    moved = (
        edges.join(low, F.col("u") == F.col("n"))
        .where(F.col("v") > F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()
