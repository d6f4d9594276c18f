"""What every operator needs from the session: workers that can import this package, and shared scratch tables."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_OWN_CHECKPOINTS = "/tmp/checkpoints"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did.

    On a cluster the package is installed on the executors or sent with --py-files; the path added here is then
    simply not there, which does no harm.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode, where all is one machine, one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or _OWN_CHECKPOINTS).rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class Scratch:
    """Intermediate tables of one operator call, as Parquet in the shared folder.

    A table written and read again cuts the lineage, is computed once, and outlives any executor. What `drop` has not
    removed goes when the application ends, or earlier at the end of a `scratch_scope`: results are lazy, so a table may
    still be read after the call returns.
    """

    _kept: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/tidemark-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._names: list[str] = []
        Scratch._kept.append(self)

    def save(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        self._n += 1
        path = f"{self.base}/{self._n}"
        df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def save_dealt(self, df: DataFrame, key: str, buckets: int, compression: str = "snappy", kind: str | None = None) -> DataFrame:
        """A table dealt by `key` for good: grouping it by that key, alone or with another table, moves none of its rows.

        kind: a column whose values are folders of their own, which `drop_kind` removes one by one.
        """
        self._n += 1
        path, name = f"{self.base}/{self._n}", f"tidemark_{uuid.uuid4().hex}"
        writer = df.write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", compression).format("parquet")
        (writer.partitionBy(kind) if kind else writer).saveAsTable(name)
        self._names.append(name)
        out = self.spark.table(name)
        out._scratch_path, out._scratch_name, out._scratch_kind = path, name, kind
        return out

    def drop_kind(self, table: DataFrame, *values: str) -> None:
        for v in values:
            self._delete(f"{table._scratch_path}/{table._scratch_kind}={v}")

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if name := getattr(t, "_scratch_name", None):
                self._forget(name)
            self._delete(t._scratch_path)

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._names.remove(name)

    def close(self) -> None:
        """Remove all that is left."""
        for name in list(self._names):
            self._forget(name)
        self._delete(self.base)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    @classmethod
    def clear(cls) -> None:
        """Remove every table that is left. Called when the application ends."""
        while cls._kept:
            one = cls._kept.pop()
            try:
                one.close()
            except Exception:  # noqa: BLE001  the JVM may be gone already; the folder is the cluster's scratch space
                return


atexit.register(Scratch.clear)


@contextlib.contextmanager
def scratch_scope() -> Iterator[None]:
    """Scratch tables of calls made inside go when it ends. For callers that have written or collected the results by then."""
    before = set(map(id, Scratch._kept))
    try:
        yield
    finally:
        own = [s for s in Scratch._kept if id(s) not in before]
        Scratch._kept[:] = [s for s in Scratch._kept if id(s) in before]
        for s in own:
            s.close()
