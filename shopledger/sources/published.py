"""Tables whose content changes by publishing one small file.

Data files are only ever added, each write in directories of its own. What belongs to the
table is listed by numbered manifests; the highest number is the table. A write that ends
before its manifest is there has not happened, and a job that runs again under its name
finds its manifest and adds nothing twice. Readers of an older version keep reading it.

There is one writer at a time: of two, the one that publishes second fails.

    <root>/data/<partition>=<value>/.../write_id=<id>/part-....parquet
    <root>/manifests/<number>.json
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WRITE = "write_id"
DIRECTORY = "_directory"


class Conflict(RuntimeError):
    """Another writer has published in the meantime."""


@dataclass(frozen=True)
class Version:
    number: int
    directories: tuple[str, ...] = ()
    jobs: tuple[str, ...] = field(default=())


class Published:
    """A table under ``root`` with the columns of ``schema`` (DDL text), partitioned by some of them."""

    def __init__(self, spark: SparkSession, root: str, schema: str, partitions: Sequence[str] = ()):
        self.spark, self.root, self.partitions = spark, root.rstrip("/"), tuple(partitions)
        self.ddl, self.schema = schema, spark.createDataFrame([], schema).schema
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    @property
    def _data(self) -> str:
        return f"{self.root}/data"

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:012d}.json"

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """The given version, or the newest; an empty one if nothing was published yet."""
        found = self.versions()
        if number is None:
            number = found[-1] if found else 0
        if number == 0:
            return Version(0)
        if number not in found:
            raise ValueError(f"no version {number}")
        content = json.loads(self.spark.read.text(self._manifest(number), wholetext=True).first()[0])
        return Version(number, tuple(content["directories"]), tuple(content["jobs"]))

    def read(self, version: Version | None = None, directories: Sequence[str] | None = None, marked: bool = False) -> DataFrame:
        """The table, or some directories of it; ``marked`` adds the directory of each row."""
        version = version or self.version()
        paths = [f"{self._data}/{d}" for d in (version.directories if directories is None else directories)]
        if not paths:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn(DIRECTORY, F.lit("")) if marked else empty
        rows = self.spark.read.schema(f"{self.ddl}, {WRITE} string").option("basePath", self._data).parquet(*paths)
        names = self.schema.names
        if not marked:
            return rows.select(*names)
        place = F.regexp_extract(F.col("_metadata.file_path"), f"/data/(.*{WRITE}=[^/]*)/[^/]*$", 1)
        return rows.select(*names, place.alias(DIRECTORY))

    def _written(self, rows: DataFrame) -> list[str]:
        """New directories with the rows, which no manifest names yet."""
        name = uuid.uuid4().hex
        placed = rows.select(*self.schema.names).withColumn(WRITE, F.lit(name))
        # The adaptive planner cuts large directories into several files and merges small ones.
        if self.partitions:
            placed = placed.hint("rebalance", *[F.col(c) for c in self.partitions])
        placed.write.mode("append").partitionBy(*self.partitions, WRITE).parquet(self._data)
        pattern = "/".join([self._data, *["*"] * len(self.partitions), f"{WRITE}={name}"])
        found = self._fs.globStatus(self._path(pattern)) or []
        base = len(self._path(self._data).toUri().getPath()) + 1
        return sorted(s.getPath().toUri().getPath()[base:] for s in found)

    def _publish(self, old: Version, directories: Sequence[str], job: str | None) -> Version:
        """The manifest is written aside and renamed, so it is there as a whole or not at all."""
        new = Version(old.number + 1, tuple(directories), (*old.jobs, job) if job else old.jobs)
        target, aside = self._path(self._manifest(new.number)), self._path(f"{self.root}/manifests/_{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        try:
            stream.write(json.dumps({"directories": new.directories, "jobs": new.jobs}).encode())
        finally:
            stream.close()
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            self._fs.delete(aside, False)
            raise Conflict(f"version {new.number} was published by another writer")
        return new

    def change(self, made: Callable[[Version], tuple[DataFrame | None, Sequence[str]]], job: str | None = None) -> Version:
        """Publishes ``made(newest version)``: rows to add, and directories that they replace.

        A job that is named and has been published before changes nothing.
        """
        old = self.version()
        if job and job in old.jobs:
            return old
        rows, replaced = made(old)
        added = self._written(rows) if rows is not None else []
        if not added and not replaced:
            return old
        gone = set(replaced)
        return self._publish(old, [d for d in old.directories if d not in gone] + added, job)

    def replace(self, rows: DataFrame, job: str | None = None) -> Version:
        """``rows`` become the whole table."""
        return self.change(lambda old: (rows, old.directories), job)

    def append(self, rows: DataFrame, job: str | None = None) -> Version:
        return self.change(lambda old: (rows, ()), job)
