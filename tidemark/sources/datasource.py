"""A read-only data source for SQL: spark.read.format("tidemark").option("table", <table json>).load().

Filters that Spark hands over prune the catalog; all are left to Spark to evaluate again. Spark tells a Python source no
columns, so all are read, and its files are opened by Arrow's file systems (local, hdfs, s3, gs, abfs), not by Hadoop's:
operators.scan is the main route, and the one for other stores. A loaded DataFrame that is used
for several queries can keep the files of an earlier one when a later query has no filter to hand over, so views go
through `guarded_view`, which always has one. Spark hands over no OR: predicates with one are for operators.scan.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidemark.plans import expr as E
from tidemark.plans import pushdown as P
from tidemark.session import importable
from tidemark.sources.tables import Table


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


#: What Arrow calls the stores that Hadoop calls otherwise.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfs", "abfss": "abfs"}


def opened(path: str):
    """Arrow's file system for a path, and the path in it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


class TableReader(DataSourceReader):
    def __init__(self, table: Table):
        self.table = table
        self.pushed: list[E.Expr] = []

    def pushFilters(self, filters: list) -> Iterator:
        self.pushed = [e for _, e in P.from_filters(filters, self.table.layout) if e is not None]
        yield from filters

    def partitions(self) -> list[_File]:
        import pyarrow.dataset as ds

        if self.table.catalog_source:
            raise ValueError("a catalog in a database is for operators.scan, which gets a connection")
        layout, predicate = self.table.layout, E.all_of(self.pushed)
        low, high, hashes = P.bounds(predicate, layout)
        # Arrow skips row groups of the catalog by the bounds; only rows within them are looked at here.
        wanted = ds.scalar(True)
        for name, bound in (("max_ts", low), ("min_ts", high)):
            if bound is not None:
                wanted &= ds.field(name).is_null() | (ds.field(name) >= bound if name == "max_ts" else ds.field(name) <= bound)
        if hashes is not None:
            wanted &= ds.field("shard_key").is_null() | ds.field("shard_key").isin(hashes)
        store, path = opened(self.table.catalog_path)
        catalog = ds.dataset(path, filesystem=store, exclude_invalid_files=True, format="parquet")
        out = []
        for batch in catalog.to_batches(columns=["path", "storage_id", "min_ts", "max_ts", "shard_key"], filter=wanted):
            for r in batch.to_pylist():
                known = r["min_ts"] is not None and r["shard_key"] is not None
                if not known or P.include(predicate, P.Part(r["min_ts"], r["max_ts"], r["shard_key"]), layout):
                    out.append(_File(self.table.resolve(r["path"], r["storage_id"])))
        return out

    def read(self, partition: _File) -> Iterator:
        import pyarrow.parquet as pq

        if partition is None:
            return
        names = list(self.table.columns)
        store, path = opened(partition.path)
        with pq.ParquetFile(path, filesystem=store) as file:
            yield from file.iter_batches(columns=names)


class TableSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark"

    def _table(self) -> Table:
        if "table" not in self.options:
            raise ValueError("the option table is required: a table's JSON")
        return Table.from_json(self.options["table"])

    def schema(self) -> StructType:
        return self._table().schema

    def reader(self, schema: StructType) -> TableReader:
        return TableReader(self._table())


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TableSource)


def load(spark: SparkSession, table: Table) -> DataFrame:
    register(spark)
    return spark.read.format("tidemark").option("table", table.to_json()).load()


def guarded_view(spark: SparkSession, table: Table, name: str) -> None:
    """A view that hands Spark a filter in every query; rows of a null primary timestamp, which a table has none of, are left out."""
    load(spark, table).where(f"`{table.primary}` IS NOT NULL").createOrReplaceTempView(name)
