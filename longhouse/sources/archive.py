"""The archive: one folder of Parquet files per table, written in published batches."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import cache, reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from longhouse.operators import checks
from longhouse.operators.keys import assign_ids
from longhouse.schemas import SEEDS, TABLES, seed_table

MARKERS = "_published"
# Cells grow with the data. A batch does not shuffle them once more to see their keys: it compares
# each variable's fingerprint of row ids with that of the rows of their dataset.
CELLS = ("data", "typed_data")


class Archive:
    """Tables under ``root``, each split by the batch that wrote it.

    A batch writes any number of tables and is then published by one marker file, which also holds
    the largest key of each table and the number of buckets of each dataset's cells. Readers see only published batches, so an ingest shows up whole or not at all, and one that failed half-way is
    written anew by the next. One writer at a time, as many readers as you like.

    Most tables only grow. Those marked ``revised`` are small and written whole by every batch that
    changes them; readers take the latest copy. ``data`` and ``datarows`` are split further by
    dataset and ``deaths`` by ingestion, so a query on one of them opens only its files. Files of searched
    columns have Bloom filters, so one id is looked up in the few row groups that may hold it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, root: str) -> Archive:
        """A new archive with its reference tables (operator B-11)."""
        archive = cls(spark, root)
        if archive.last_batch():
            raise FileExistsError(f"there is an archive at {root}")
        batch = archive.begin()
        for name in SEEDS:
            batch.write(name, seed_table(spark, name))
        batch.publish(check=False)  # fixed rows
        return archive

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str, prefix: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        if not fs.exists(path):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(path)]
        return [n[len(prefix):] for n in found if n.startswith(prefix)]

    def last_batch(self) -> int:
        return max((int(n) for n in self._names(MARKERS, "batch=")), default=0)

    def batches_of(self, table: str, up_to: int) -> list[int]:
        return sorted(b for b in map(int, self._names(table, "batch=")) if b <= up_to)

    def table(self, name: str, up_to: int | None = None) -> DataFrame:
        """The whole table as published (operator A-6)."""
        table = TABLES[name]
        up_to = self.last_batch() if up_to is None else up_to
        batches = self.batches_of(name, up_to)
        if table.revised:
            batches = batches[-1:]
        if not batches:
            return self.spark.createDataFrame([], table.schema)
        paths = [f"{self.root}/{name}/batch={b}" for b in batches]
        reader = self.spark.read.schema(table.schema).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*paths).select(*table.schema.names)

    def last_ids(self) -> dict[str, int]:
        """Largest key of each table, as the latest marker records them."""
        return self._marker().get("ids", {})

    def part(self, name: str, partition: int) -> tuple[DataFrame, bool]:
        """One partition of a table, and whether the rows of a bucket lie in one task.

        Spark knows buckets from table definitions only, so one is made for the files and dropped, which leaves the files.
        """
        table, own = TABLES[name], f"{name}/{TABLES[name].partition}={partition}"
        batch, buckets = self._marker().get("buckets", {}).get(own, (0, 0))
        if not buckets:
            return self.table(name).where(F.col(table.partition) == partition), False
        fields = [f for f in table.schema.fields if f.name != table.partition]
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        path = f"{self.root}/{name}/batch={batch}/{table.partition}={partition}"
        found = _defined(
            self.spark,
            lambda known: self.spark.sql(
                f"CREATE TABLE {known} ({columns}) USING parquet CLUSTERED BY ({table.bucketed}) INTO {buckets} BUCKETS "
                "LOCATION '" + path.replace("'", "\\'") + "'"
            ),
            self.spark.table,
        )
        constant = F.lit(partition).cast(table.schema[table.partition].dataType).alias(table.partition)
        return found.select("*", constant).select(*table.schema.names), True

    def _marker(self) -> dict:
        last = self.last_batch()
        if not last:
            return {}
        stream = self._fs().open(self._path(MARKERS, f"batch={last}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def audit(self) -> list[str]:
        """Check all that every published table declares, at once; the problems found."""
        table = cache(self.table)
        last = self.last_batch()
        rules = checks.Rules()
        for name in TABLES:
            if self.batches_of(name, last):
                rules.add(name, table(name), table(name), table)
        return rules.problems()

    def begin(self) -> Batch:
        """A new batch; what an unpublished attempt left under its number is dropped."""
        number = self.last_batch() + 1
        fs = self._fs()
        for name in TABLES:
            left = self._path(name, f"batch={number}")
            if fs.exists(left):
                fs.delete(left, True)
        return Batch(self, number)


def _defined(spark: SparkSession, define: Callable[[str], Any], use: Callable[[str], Any] = lambda _: None) -> Any:
    """What ``use`` makes of a table that is defined under a name of its own and dropped again."""
    name = f"longhouse_{uuid.uuid4().hex}"
    try:
        define(name)
        return use(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


class Batch:
    """Writes of one ingest, visible to itself at once and to readers when published."""

    def __init__(self, archive: Archive, number: int):
        self.archive = archive
        self.number = number
        self.written: dict[str, list[str]] = {}
        marker = archive._marker()
        self.ids: dict[str, int] = marker.get("ids", {})
        self.buckets: dict[str, tuple[int, int]] = marker.get("buckets", {})

    def table(self, name: str) -> DataFrame:
        return self.archive.table(name, self.number)

    def added(self, name: str) -> DataFrame:
        """Rows of a table that this batch wrote."""
        return self.archive.spark.read.schema(TABLES[name].schema).option(
            "basePath", f"{self.archive.root}/{name}"
        ).parquet(*self.written[name])

    def last_id(self, name: str) -> int:
        return self.ids.get(name, 0)

    def write(
        self,
        name: str,
        df: DataFrame,
        partition: int | None = None,
        last: int | None = None,
        buckets: int = 0,
    ) -> None:
        """Rows matched to the table's columns by name; absent columns are null (operator B-1).

        ``last`` is the largest key among the rows, if the caller knows it. With ``buckets`` files are
        written by the hash of the table's bucket column, as Spark's bucketed tables are.
        """
        table = TABLES[name]
        unknown = [c for c in df.columns if c not in table.schema.names]
        if unknown:
            raise ValueError(f"{name} has no columns {', '.join(unknown)}")
        path = f"{self.archive.root}/{name}/batch={self.number}"
        fields = table.schema.fields
        if table.partition:
            if partition is None:
                raise ValueError(f"{name} is written one {table.partition} at a time")
            path += f"/{table.partition}={partition}"
            fields = [f for f in fields if f.name != table.partition]
        rows = df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in fields
            ]
        )
        numbered = table.key and isinstance(table.schema[table.key].dataType, LongType)
        seen = Observation() if numbered and last is None else None
        if seen:  # the largest key comes with the write
            rows = rows.observe(seen, F.max(table.key).alias("last"))
        # errors if the path exists: a table (or a partition of it) is written once in a batch
        writer = rows.write.mode("errorifexists").option("parquet.bloom.filter.adaptive.enabled", True)
        for column in table.searched:
            # row groups without a value are then skipped, in whatever order values lie
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        if buckets:
            own = writer.format("parquet").option("path", path).bucketBy(buckets, table.bucketed)
            own = own.sortBy(*[c for c in ("variable_id", table.bucketed) if c in rows.columns])
            _defined(self.archive.spark, own.saveAsTable)
            self.buckets[f"{name}/{table.partition}={partition}"] = (self.number, buckets)
        else:
            writer.parquet(path)
        self.written.setdefault(name, []).append(path)
        if numbered:
            self.ids[name] = last if seen is None else max(self.last_id(name), seen.get["last"] or 0)

    def insert(self, name: str, df: DataFrame, order_by: list[str] | None = None) -> None:
        """Write rows with new keys that go on from the largest (operators I-2, B-1)."""
        key = TABLES[name].key
        self.write(name, assign_ids(df, key, self.last_id(name), order_by))

    def insert_rows(self, name: str, rows: Sequence[Mapping[str, Any]]) -> None:
        """Write configured rows with new keys in the order given (operator I-2)."""
        self.write(name, self.keyed_rows(name, rows), last=self.last_id(name) + len(rows))

    def keyed_rows(self, name: str, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
        table = TABLES[name]
        base = self.last_id(name)
        values = [
            tuple({**row, table.key: base + n}.get(f) for f in table.schema.names)
            for n, row in enumerate(rows, start=1)
        ]
        return self.archive.spark.createDataFrame(values, table.schema)

    def insert_row(self, name: str, row: Mapping[str, Any]) -> int:
        """Write one row and return its key (operator I-2, one-row form)."""
        self.insert_rows(name, [row])
        return self.last_id(name)

    def _datasets(self, name: str) -> list[int]:
        """Datasets that this batch wrote rows of, if the table is split by them."""
        if TABLES[name].partition != "dataset_id":
            return []
        return [int(path.rpartition("=")[2]) for path in self.written[name]]

    def check(self) -> None:
        """Keys, references and required columns of what this batch wrote (operators K-1..K-3)."""
        rules, cells = checks.Rules(), []
        table = cache(self.table)
        for name in self.written:
            if name not in CELLS:
                # ids of rows are new in their dataset, so only the datasets written are looked at
                own = self._datasets(name)

                def part(other: str, own=own) -> DataFrame:
                    rows = table(other)
                    return rows.where(F.col("dataset_id").isin(own)) if own and "dataset_id" in rows.columns else rows

                rules.add(name, part(name), self.added(name), part)
            elif "datarows" in self.written:
                own = F.col("dataset_id").isin(self._datasets(name))
                rows, variables = self.added("datarows").where(own), self.added("dataset_variables").where(own)
                cells.append(checks.cell_problems(name, self.added(name), rows, variables))
        told = [r.problem for r in reduce(DataFrame.unionByName, cells).collect()] if cells else []
        checks.require_none(rules.problems() + told)

    def publish(self, check: bool = True) -> None:
        """Check, then make the batch visible."""
        if check:
            self.check()
        fs = self.archive._fs()
        draft = self.archive._path(MARKERS, f"_draft={self.number}")
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps({"ids": self.ids, "buckets": self.buckets}).encode()))
        stream.close()
        # a rename shows the marker whole or not at all
        if not fs.rename(draft, self.archive._path(MARKERS, f"batch={self.number}")):
            raise RuntimeError(f"batch {self.number} could not be published")
