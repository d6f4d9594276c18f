"""Scans that open only the files a predicate needs, and aggregates that open none."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import expr as E
from tidemark.plans import pushdown as P
from tidemark.sources.parts import PERIOD, select_parts
from tidemark.sources.tables import Connection, Table


#: Files that a scan may name without asking first which folders it reads whole.
NAMED = 20_000


@dataclass(frozen=True)
class Plan:
    """Files to read, and what became of the predicate's conjuncts."""

    paths: tuple[str, ...]
    total: int
    pushed: tuple[E.Expr, ...]
    residual: tuple[E.Expr, ...]
    filter_text: str | None


def chosen_parts(spark: SparkSession, table: Table, predicate: E.Expr | None = None, connection: Connection | None = None) -> DataFrame:
    """The catalog rows whose files may hold a match: bounds first, which a sorted catalog file or a database can skip by, then the whole rule."""
    bounding = None if predicate is None else P.prunable(predicate.simplify(), table.layout)
    if predicate is not None and predicate.simplify() in (E.FALSE, E.UNKNOWN):
        return table.catalog(spark, connection).where(F.lit(False))
    if bounding is None:
        return table.catalog(spark, connection)
    low, high, hashes = P.bounds(bounding, table.layout)
    if low is not None and high is not None and high < low or hashes == []:
        return table.catalog(spark, connection).where(F.lit(False))
    narrowed = select_parts(table.catalog(spark, connection, (low, high, hashes)), low, high, hashes)
    return narrowed.where(P.include_column(bounding, table.layout))


def plan_partitions(spark: SparkSession, table: Table, predicate: E.Expr | None = None, connection: Connection | None = None) -> Plan:
    """The files of a scan, all named, for those who ask; `scan` itself names folders where it reads all of one."""
    parts = E.conjuncts(predicate.simplify()) if predicate is not None else []
    rows = chosen_parts(spark, table, predicate, connection).select("path", "storage_id").collect()
    codes = [(p, P.classify(p, table.layout)) for p in parts]
    return Plan(
        tuple(sorted(table.resolve(r.path, r.storage_id) for r in rows)),
        table.catalog(spark, connection).count(),
        tuple(p for p, c in codes if c == 2),
        tuple(p for p, c in codes if c != 1),
        P.render_all([p for p, c in codes if c == 2], table.layout),
    )


def _in_mode(spark: SparkSession, mode: str) -> SparkSession:
    """A session that reads Parquet by rows or by columns. A forced mode gets a session of its own, with this one's settings."""
    if mode == "auto":
        return spark
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.parquet.enableVectorizedReader", str(mode == "force_columnar").lower())
    return own


def read_paths(spark: SparkSession, table: Table, paths: tuple[str, ...] | list[str], columns: list[str] | None = None, connection: Connection | None = None) -> DataFrame:
    """Files, or whole folders of them, as a DataFrame of the table's columns. No path reads nothing, never everything.

    A table with a forced query mode is read in a session of its own: the mode is a setting of sessions, not of reads.
    """
    columns = columns or list(table.columns)
    unknown = [c for c in columns if c not in table.columns]
    if unknown:
        raise KeyError(f"no column {unknown[0]!r}")
    if not paths:
        return spark.createDataFrame([], table.schema).select(*columns)
    reader = _in_mode(spark, table.query_mode).read.schema(table.schema).option("recursiveFileLookup", "true")
    if connection is not None:
        reader = reader.options(**connection.reader_options(table.storages))
    return reader.parquet(*paths).select(*columns)


def scan_paths(spark: SparkSession, table: Table, predicate: E.Expr | None = None, connection: Connection | None = None) -> list[str]:
    """What a scan reads. Folders that one append has written and that are read whole are named once, however many files they hold.

    Up to NAMED files are looked at here; of more, the cluster first finds the folders that are read whole, so that only files
    of other folders come here.
    """
    chosen = chosen_parts(spark, table, predicate, connection).withColumn("folder", F.regexp_extract("path", f"^(.*?)/{PERIOD}=", 1))
    if "folder_files" not in chosen.columns:
        chosen = chosen.withColumn("folder_files", F.lit(None).cast("long"))
    columns = ["path", "storage_id", "folder", "folder_files"]
    rows = chosen.select(*columns).limit(NAMED + 1).collect()
    whole: list[tuple[str, str | None]] = []
    if len(rows) > NAMED:
        by_folder = chosen.groupBy("folder", "storage_id").agg(F.count("*").alias("n"), F.max("folder_files").alias("of"))
        whole = [(r.folder, r.storage_id) for r in by_folder.where("folder <> '' and n = of").collect()]  # one for each append
        rows = chosen.where(~F.col("folder").isin([f for f, _ in whole])).select(*columns).collect() if whole else chosen.select(*columns).collect()
    else:
        held = Counter((r.folder, r.storage_id) for r in rows)
        whole = sorted({(r.folder, r.storage_id) for r in rows if r.folder and held[r.folder, r.storage_id] == r.folder_files}, key=str)
    known = set(whole)
    return [table.resolve(f, s) for f, s in whole] + [table.resolve(r.path, r.storage_id) for r in rows if (r.folder, r.storage_id) not in known]


def scan(spark: SparkSession, table: Table, predicate: E.Expr | None = None, columns: list[str] | None = None, connection: Connection | None = None) -> DataFrame:
    """Rows on which the predicate is true. It is evaluated again on the rows, where Parquet skips row groups by it as well.

    connection: for catalogs in a database and for storages that ask for credentials.
    """
    unknown = [c for c in columns or [] if c not in table.columns]
    if unknown:
        raise KeyError(f"no column {unknown[0]!r}")
    data = read_paths(spark, table, scan_paths(spark, table, predicate, connection), None, connection)
    if predicate is not None:
        data = data.where(predicate.simplify().to_column())
    return data.select(*columns) if columns else data


def catalog_aggs(spark: SparkSession, table: Table, aggs: list[E.Aggregate], connection: Connection | None = None) -> DataFrame:
    """One row from the catalog alone. Of an empty table counts are 0, bounds null."""
    made = {
        E.AggregateOp.COUNT_STAR: F.coalesce(F.sum("rows"), F.lit(0)).cast("long"),
        E.AggregateOp.MIN: F.min("min_ts"),
        E.AggregateOp.MAX: F.max("max_ts"),
    }
    for a in aggs:
        if P.pushable_agg(a, table.layout) is None:
            raise ValueError(f"{a.label} needs data")
    return table.catalog(spark, connection).agg(*[made[a.op].alias(a.label) for a in aggs])


def aggregate(spark: SparkSession, table: Table, aggs: list[E.Aggregate], predicate: E.Expr | None = None, by: list[str] | None = None, connection: Connection | None = None) -> DataFrame:
    """Aggregates from the catalog if it can answer all of them, without predicate and grouping; from a pruned scan otherwise.

    A catalog in a database has bounds cut to seconds, so it answers counts only.
    """
    known = all(P.pushable_agg(a, table.layout) is not None and (a.op is E.AggregateOp.COUNT_STAR or not table.catalog_source) for a in aggs)
    if predicate is None and not by and known:
        return catalog_aggs(spark, table, aggs, connection)
    data = scan(spark, table, predicate, None, connection)
    columns = [a.to_column().alias(a.label) for a in aggs]
    return data.groupBy(*by).agg(*columns) if by else data.agg(*columns)
