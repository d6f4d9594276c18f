"""Data files laid out by time and shard, and the catalog that describes them.

A layout is Parquet files of one period and one shard value each, sorted by time. The catalog is itself a table, a row
for each file: path, min_ts, max_ts, rows, data_size, shard_key (hash of the shard value), storage_id, and if it is known
folder_files, the number of files of the append that the file is of. It is built and
searched by the cluster; only the rows that a query needs reach the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.wyhash import UNSHARDED, wyhash_column
from tidemark.plans.expr import literal
from tidemark.session import importable

#: Rows that a file holds at most.
ROWS_PER_FILE = 2_097_152
PERIOD, _SHARD = "_period", "_shard"

CATALOG = (
    "path string, min_ts timestamp_ntz, max_ts timestamp_ntz, rows long, data_size long, shard_key string, storage_id string"
)


def write_layout(df: DataFrame, path: str, primary: str, shard: str | None = None, period: str = "day", sort: list[str] | None = None, rows_per_file: int = ROWS_PER_FILE, mode: str = "error") -> None:
    """Write files of one period and one shard value each.

    Rows are dealt by period and shard and, where those are more than a file holds, by a hash as well, to as many tasks as
    there will be files: a period that holds a large part of the table is written by many.
    """
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not df.schema[c].dataType.typeName() in ("map", "variant")])
    keyed = df.withColumn(PERIOD, F.date_format(F.date_trunc(period, F.col(primary)), "yyyy-MM-dd-HH"))
    keyed = keyed.withColumn(_SHARD, F.col(shard) if shard else F.lit(""))
    large = keyed.groupBy(PERIOD, _SHARD).count().where(F.col("count") > rows_per_file)
    large = large.select(F.col(PERIOD).alias("_large_period"), F.col(_SHARD).alias("_large_shard"), F.ceil(F.col("count") / rows_per_file).alias("_large"))
    keyed = keyed.join(large, F.col(PERIOD).eqNullSafe(F.col("_large_period")) & F.col(_SHARD).eqNullSafe(F.col("_large_shard")), "left")
    keyed = keyed.withColumn("_salt", F.when(F.col("_large").isNotNull(), F.pmod(hashed, F.col("_large"))).otherwise(F.lit(0)))
    dealt = keyed.repartition(PERIOD, _SHARD, "_salt").sortWithinPartitions(PERIOD, _SHARD, primary, *(sort or []))
    dealt.drop("_large", "_large_period", "_large_shard", "_salt").write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(PERIOD, _SHARD).parquet(path)


def build_catalog(spark: SparkSession, data: DataFrame, primary: str, shard: str | None = None, storage_id: str | None = None) -> DataFrame:
    """A catalog row for each file that `data` (a DataFrame over files) reads: one aggregation, with sums made where files are read."""
    importable(spark)
    own = data.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("data_size"), F.col(primary).alias("ts"), (F.col(shard) if shard else F.lit("")).alias("shard"))
    files = own.groupBy("path").agg(
        F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.count("*").alias("rows"), F.max("data_size").alias("data_size"), F.min("shard").alias("shard"), F.max("shard").alias("last_shard")
    )
    # Hashes are of distinct shard values. A file of several values can't be known by a hash: null never skips it.
    hashes = files.select("shard").distinct().withColumn("shard_key", wyhash_column(F.col("shard")))
    one = F.when(F.col("shard").eqNullSafe(F.col("last_shard")), F.col("shard_key"))
    files = files.join(hashes.withColumnRenamed("shard", "hashed"), F.col("shard").eqNullSafe(F.col("hashed")), "left")
    # How many files each folder holds, so that a scan knows when it reads all of one: a row for each append.
    folder = F.regexp_extract("path", f"^(.*?)/{PERIOD}=", 1)
    folders = files.groupBy(folder.alias("in_folder")).agg(F.count("*").alias("folder_files"))
    files = files.withColumn("in_folder", folder).join(folders, "in_folder")
    return files.select("path", "min_ts", "max_ts", "rows", "data_size", (one if shard else F.lit(UNSHARDED)).alias("shard_key"), F.lit(storage_id).cast("string").alias("storage_id"), "folder_files")


def from_seconds(catalog: DataFrame) -> DataFrame:
    """A catalog whose bounds were cut to seconds: the true maximum may be up to a second later."""
    return catalog.withColumn("max_ts", F.col("max_ts") + F.expr("interval 999999 microseconds"))


def select_parts(catalog: DataFrame, earliest: dt.datetime | None = None, latest: dt.datetime | None = None, shard_hashes: list[str] | None = None) -> DataFrame:
    """Files whose bounds meet [earliest, latest] and whose shard hash is among those given."""
    if earliest is not None and latest is not None and latest < earliest:
        raise ValueError(f"latest {latest} is before earliest {earliest}")
    wanted: Column = F.lit(True)
    if earliest is not None:
        wanted &= F.coalesce(F.col("max_ts") >= literal(earliest), F.lit(True))
    if latest is not None:
        wanted &= F.coalesce(F.col("min_ts") <= literal(latest), F.lit(True))
    if shard_hashes:
        wanted &= F.coalesce(F.col("shard_key").isin(shard_hashes), F.lit(True))
    return catalog.where(wanted)
