"""Tables, their catalog of names, connection options and storage settings."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import valuetypes as V
from tidemark.plans.pushdown import ColumnInfo, Layout

QUERY_MODES = ("auto", "force_row", "force_columnar")
OPTIONS = (
    "project_name", "table_name", "jdbc_url", "username", "password", "api_url", "partition_prefix", "cloud_cred_1", "cloud_cred_2",
    "storage_cloud", "storage_region", "storage_bucket_name", "storage_bucket_path", "storage_endpoint_uri", "query_mode",
)


class TableError(ValueError):
    """A table, or what describes it, is not as it must be."""


@dataclass(frozen=True)
class Storage:
    """Where files are: a bucket of a cloud, or a plain file system root (cloud `file`).

    data_path: the folder in it of files whose path in a catalog begins with the storage's id.
    """

    name: str
    cloud: str
    bucket_name: str = ""
    bucket_path: str = ""
    region: str = ""
    endpoint: str | None = None
    default: bool = False
    data_path: str = ""

    @property
    def root(self) -> str:
        path = self.bucket_path.strip("/")
        schemes = {"aws": "s3a", "gcp": "gs", "gcs": "gs"}
        if self.cloud in schemes:
            return f"{schemes[self.cloud]}://{self.bucket_name}" + (f"/{path}" if path else "")
        if self.cloud == "azure":
            return f"wasbs://{self.bucket_name}" + (f"/{path}" if path else "")
        return self.bucket_path.rstrip("/")


def storage_conf(storage: Storage, cred1: str | None = None, cred2: str | None = None) -> dict[str, str]:
    """Hadoop settings for a storage. Unknown clouds get none."""
    out: dict[str, str] = {}
    if storage.cloud in ("gcp", "gcs"):
        out["fs.gs.auth.type"] = "SERVICE_ACCOUNT_JSON_KEYFILE"
        out["fs.gs.auth.service.account.json.keyfile"] = cred1 or ""
    elif storage.cloud == "aws":
        if cred2 is None:
            raise TableError("cloud_cred_2 is required for aws")
        out |= {"fs.s3a.access.key": cred1 or "", "fs.s3a.secret.key": cred2, "fs.s3a.endpoint.region": storage.region}
        if storage.endpoint:
            out |= {"fs.s3a.endpoint": storage.endpoint, "fs.s3a.path.style.access": "true"}
        out["fs.s3a.connection.ssl.enabled"] = str(not (storage.endpoint or "").startswith("http://")).lower()
    elif storage.cloud == "azure":
        if cred2 is None:
            raise TableError("cloud_cred_2 is required for azure")
        out[f"fs.azure.account.key.{cred1}.blob.core.windows.net"] = cred2
    return out


@dataclass(frozen=True)
class Connection:
    """Options of a connection. A storage is overridden only by name, path, region and cloud together."""

    options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_options(cls, options: dict[str, str]) -> Connection:
        unknown = sorted(set(options) - set(OPTIONS))
        if unknown:
            raise TableError(f"unknown options: {', '.join(unknown)}")
        mode = options.get("query_mode", "auto").lower()
        if mode not in QUERY_MODES:
            raise TableError(f"query_mode {mode!r} is none of {', '.join(QUERY_MODES)}")
        out = cls(dict(options) | {"query_mode": mode})
        for name, needs in (("jdbc_url", ("username", "password")), ("table_name", ("project_name",)), ("cloud_cred_2", ("cloud_cred_1",))):
            if name in options:
                for n in needs:
                    out.required(n)
        return out

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Connection:
        env = dict(os.environ) if env is None else env
        return cls.from_options({o: env[f"TIDEMARK_{o.upper()}"] for o in OPTIONS if f"TIDEMARK_{o.upper()}" in env})

    def required(self, name: str) -> str:
        if name not in self.options:
            raise TableError(f"{name} is required")
        return self.options[name]

    def optional(self, name: str) -> str | None:
        return self.options.get(name)

    def as_map(self) -> dict[str, str]:
        return dict(self.options)

    def storages(self, known: dict[str, Storage]) -> dict[str, Storage]:
        """The known storages, or the one that the options describe; an endpoint applies to all."""
        names = ("storage_bucket_name", "storage_bucket_path", "storage_region", "storage_cloud")
        given = [n for n in names if n in self.options]
        if given and len(given) < len(names):
            raise TableError(f"a storage needs all of {', '.join(names)}")
        if given:
            name, path, region, cloud = (self.options[n] for n in names)
            known = {"default": Storage("default", cloud, name, path, region)}
        endpoint = self.options.get("storage_endpoint_uri")
        return {k: replace(s, endpoint=endpoint) if endpoint else s for k, s in known.items()}

    def reader_options(self, storages: dict[str, Storage]) -> dict[str, str]:
        """Settings that let a read reach the storages: options of that read, so they are no other table's, nor the session's."""
        out: dict[str, str] = {}
        if "cloud_cred_1" in self.options:
            for s in storages.values():
                out |= storage_conf(s, self.options["cloud_cred_1"], self.options.get("cloud_cred_2"))
        return out

    def applied(self, table: Table) -> Table:
        """The table as these options have it: storages, prefix of paths, query mode."""
        own = {"storages": self.storages(table.storages), "prefix": self.options.get("partition_prefix", table.prefix)}
        mode = self.options.get("query_mode", "auto")
        return replace(table, **own, query_mode=table.query_mode if mode == "auto" else mode)

    def load(self, names: Catalog) -> Table:
        """The table that project_name and table_name name."""
        return self.applied(names.load(self.required("project_name"), self.required("table_name")))

    def query(self, spark: SparkSession, text: str) -> DataFrame:
        """Rows of a query over JDBC."""
        reader = spark.read.format("jdbc").option("url", self.required("jdbc_url")).option("preferTimestampNTZ", "true")
        for option, name in (("user", "username"), ("password", "password")):
            reader = reader.option(option, self.required(name))
        return reader.option("query", text).load()


def catalog_sql(source: str, earliest: Any = None, latest: Any = None, shard_hashes: list[str] | None = None, time: str = "{{ts '{}'}}", names: str = "{}") -> str:
    """The query for the rows of a catalog in a database whose bounds and shard hash may match. Nulls never rule a row out.

    source: the catalog as that database names it. time: how it writes a timestamp; names: how it writes a column's name.
    """
    column = lambda n: names.format(n)
    moment = lambda t: time.format(t.strftime("%Y-%m-%d %H:%M:%S.%f"))
    wanted = []
    if earliest is not None and latest is not None and latest < earliest:
        raise ValueError(f"latest {latest} is before earliest {earliest}")
    if earliest is not None:
        # Bounds in such a catalog are cut to seconds.
        wanted.append((column("max_timestamp"), ">= " + moment(earliest.replace(microsecond=0))))
    if latest is not None:
        wanted.append((column("min_timestamp"), "<= " + moment(latest)))
    if shard_hashes:
        wanted.append((column("shard_key"), "IN (" + ", ".join("'" + h.replace("'", "''") + "'" for h in shard_hashes) + ")"))
    where = " AND ".join(f"({c} IS NULL OR {c} {test})" for c, test in wanted)
    return f"SELECT * FROM {source}" + (f" WHERE {where}" if where else "")


def from_database(rows: DataFrame) -> DataFrame:
    """Rows of a catalog in a database, as those of a catalog of files: columns by name in any case, bounds widened to the second."""
    by = {c.lower(): c for c in rows.columns}
    missing = [c for c in ("partition", "min_timestamp", "max_timestamp", "rows", "data_size", "shard_key") if c not in by]
    if missing:
        raise TableError(f"the catalog lacks {', '.join(missing)}")
    col = lambda n, t: F.col(f"`{by[n]}`").cast(t) if n in by else F.lit(None).cast(t)
    return rows.select(
        col("partition", "string").alias("path"), col("min_timestamp", "timestamp_ntz").alias("min_ts"), (col("max_timestamp", "timestamp_ntz") + F.expr("interval 999999 microseconds")).alias("max_ts"),
        col("rows", "long").alias("rows"), col("data_size", "long").alias("data_size"), col("shard_key", "string").alias("shard_key"), col("storage_id", "string").alias("storage_id"),
    )


@dataclass(frozen=True)
class Table:
    """A table: its columns, its primary timestamp, shard and sort keys, and the path of its catalog of files."""

    database: str
    name: str
    columns: dict[str, ColumnInfo]
    primary: str
    shard: str | None = None
    sort: tuple[str, ...] = ()
    catalog_path: str = ""
    query_mode: str = "auto"
    storages: dict[str, Storage] = field(default_factory=dict)
    default_storage: str | None = None
    settings: dict[str, Any] = field(default_factory=dict)
    prefix: str = ""

    def __post_init__(self) -> None:
        if self.primary not in self.columns or not isinstance(self.columns[self.primary].type, V.Timestamp):
            raise TableError(f"{self.name}: the primary timestamp {self.primary!r} is no timestamp column")
        if self.shard is not None and (self.shard not in self.columns or self.columns[self.shard].type != V.STRING):
            raise TableError(f"{self.name}: the shard key {self.shard!r} is no string column")
        if self.query_mode not in QUERY_MODES:
            raise TableError(f"query_mode {self.query_mode!r} is none of {', '.join(QUERY_MODES)}")

    @property
    def layout(self) -> Layout:
        return Layout(self.primary, self.shard, self.columns)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, c.type.spark, True, {"indexed": c.indexed}) for n, c in self.columns.items()])

    @property
    def catalog_source(self) -> str | None:
        """What a database calls the catalog; None if it is files at catalog_path."""
        return self.settings.get("catalog_source")

    def catalog(self, spark: SparkSession, connection: Connection | None = None, bounds: tuple = (None, None, None)) -> DataFrame:
        """The catalog's rows; bounds (earliest, latest, shard hashes) are part of the query where it is in a database."""
        if self.catalog_source:
            if connection is None:
                raise TableError(f"the catalog of {self.name} is in a database: a connection is required")
            style = {k: self.settings[f"catalog_{k}"] for k in ("time", "names") if f"catalog_{k}" in self.settings}
            return from_database(connection.query(spark, catalog_sql(self.catalog_source, *bounds, **style)))
        return spark.read.option("recursiveFileLookup", "true").parquet(self.catalog_path)

    def storage_of(self, storage_id: str | None) -> Storage | None:
        """A file's own storage, or the default, or the first; None if the table has none (paths are whole then)."""
        if storage_id and storage_id in self.storages:
            return self.storages[storage_id]
        if self.default_storage:
            return self.storages[self.default_storage]
        return next((s for s in self.storages.values() if s.default), next(iter(self.storages.values()), None))

    def resolve(self, path: str, storage_id: str | None = None, prefix: str | None = None) -> str:
        """A file's whole path: paths without a scheme are below their storage.

        A path that begins with its storage's id is below the storage's data_path, without the id; others come after the prefix.
        """
        if "://" in path or path.startswith(("/", "file:")):
            return path
        storage = self.storage_of(storage_id)
        if storage is None:
            raise TableError(f"no storage for {path!r}")
        if storage_id and path.startswith(f"{storage_id}/"):
            below = (storage.data_path, path.removeprefix(f"{storage_id}/"))
        else:
            below = (self.prefix if prefix is None else prefix, path)
        return "/".join(p.strip("/") if n else p.rstrip("/") for n, p in enumerate(x for x in (storage.root, *below) if x))

    def to_json(self) -> str:
        own = {k: v for k, v in asdict(self).items() if k not in ("columns", "storages")}
        own["columns"] = {n: {"type": c.type.decl, "storage": _storage_type(c.storage), "indexed": c.indexed, "nullable": c.nullable} for n, c in self.columns.items()}
        own["storages"] = {k: asdict(s) for k, s in self.storages.items()}
        return json.dumps(own)

    @classmethod
    def from_json(cls, text: str) -> Table:
        own = json.loads(text)
        own["columns"] = {n: ColumnInfo(V.parse_type(c["type"]), _read_storage_type(c["storage"]), c["indexed"], c["nullable"]) for n, c in own["columns"].items()}
        own["storages"] = {k: Storage(**s) for k, s in own["storages"].items()}
        return cls(**own | {"sort": tuple(own["sort"])})


def _storage_type(s: V.StorageType) -> dict:
    return {"type": s.type, "elements": [_storage_type(e) for e in s.elements], "index": s.index, "primary": s.primary}


def _read_storage_type(s: dict) -> V.StorageType:
    return V.StorageType(s["type"], tuple(_read_storage_type(e) for e in s["elements"]), s["index"], s["primary"])


def columns_of(schema: T.StructType, not_indexed: tuple[str, ...] = ()) -> dict[str, ColumnInfo]:
    """Column information for a Spark schema. indexed is 2, or 0 for the columns named."""
    known = {T.BooleanType(): V.BOOLEAN, T.StringType(): V.STRING, T.ByteType(): V.INT8, T.ShortType(): V.INT16, T.IntegerType(): V.INT32, T.LongType(): V.INT64, T.FloatType(): V.FLOAT32, T.DoubleType(): V.FLOAT64, T.TimestampNTZType(): V.MICROS}
    out = {}
    for f in schema.fields:
        value = known.get(f.dataType)
        if value is None:
            raise TableError(f"column {f.name!r} has the type {f.dataType.simpleString()}, which no value type is for")
        storage = V.StorageType("datetime64", primary=False) if value == V.MICROS else V.to_storage(value)
        out[f.name] = ColumnInfo(value, storage, 0 if f.name in not_indexed else 2, f.nullable)
    return out


def primary_of(columns: dict[str, ColumnInfo]) -> str:
    """The one primary timestamp among a view's columns."""
    found = [n for n, c in columns.items() if c.storage.primary and isinstance(c.type, V.Timestamp)]
    if len(found) != 1:
        raise TableError(f"a view needs exactly one primary timestamp, not {len(found)}")
    return found[0]


@dataclass(frozen=True)
class View:
    """Columns of a table under a name. The default view is the table's schema."""

    name: str
    columns: tuple[str, ...]
    default: bool = False


class Catalog:
    """Names of databases, tables, their views and transforms, and storages.

    Saved and opened as JSON rows through Spark, so any store will do. What was opened is read again after `ttl` seconds,
    or on `refresh`; a name that is not there gives an empty list, or an error where one thing is asked for.
    """

    VERSION = "1"

    def __init__(self, spark: SparkSession, ttl: float = 3600.0, clock: Callable[[], float] = time.monotonic):
        self.spark, self.ttl, self.clock = spark, ttl, clock
        self._path: str | None = None
        self._read_at = clock()
        self._clear()

    def _clear(self) -> None:
        self._tables: dict[tuple[str, str], Table] = {}
        self._views: dict[tuple[str, str], dict[str, View]] = {}
        self._transforms: dict[tuple[str, str], dict[str, dict]] = {}
        self._storages: dict[str, Storage] = {}

    def _fresh(self) -> Catalog:
        if self._path is not None and self.clock() - self._read_at >= self.ttl:
            self.refresh()
        return self

    def register(self, table: Table, views: tuple[View, ...] = ()) -> Table:
        """A table of this name that exists is used again, if it is the same. Without views, all columns are the default one."""
        key = table.database, table.name
        if self._tables.setdefault(key, table) != table:
            raise TableError(f"{table.database}.{table.name} exists and is not the same")
        if views or key not in self._views:
            own = views or (View("all", tuple(table.columns), True),)
            for v in own:
                unknown = [c for c in v.columns if c not in table.columns]
                if unknown:
                    raise TableError(f"view {v.name}: no column {unknown[0]!r}")
            self._views[key] = {v.name: v for v in own}
        return table

    def add_transform(self, database: str, name: str, transform: str, settings: dict) -> None:
        """settings: those of ingest.Transform, by name."""
        self.load(database, name)
        self._transforms.setdefault((database, name), {})[transform] = dict(settings)

    def add_storage(self, key: str, storage: Storage) -> None:
        self._storages[key] = storage

    def list_databases(self) -> list[str]:
        return sorted({d for d, _ in self._fresh()._tables})

    def list_tables(self, database: str) -> list[str]:
        return sorted(t for d, t in self._fresh()._tables if d == database)

    def load(self, database: str, name: str) -> Table:
        if (database, name) not in self._fresh()._tables:
            raise TableError(f"no table {database}.{name}")
        return self._tables[database, name]

    def storages(self) -> dict[str, Storage]:
        return dict(self._fresh()._storages)

    def transforms(self, database: str, name: str) -> dict[str, dict]:
        return dict(self._fresh()._transforms.get((database, name), {}))

    def views(self, database: str, name: str) -> list[View]:
        return list(self._fresh()._views.get((database, name), {}).values())

    def default_view(self, database: str, name: str) -> View:
        self.load(database, name)
        found = [v for v in self.views(database, name) if v.default]
        if len(found) != 1:
            raise TableError(f"{database}.{name} needs exactly one default view, not {len(found)}")
        return found[0]

    def primary(self, database: str, name: str) -> str:
        """The primary timestamp, which must be among the default view's columns."""
        table, view = self.load(database, name), self.default_view(database, name)
        if table.primary not in view.columns:
            raise TableError(f"{database}.{name}: the default view lacks the primary timestamp {table.primary!r}")
        return table.primary

    def schema(self, database: str, name: str) -> T.StructType:
        whole, view = self.load(database, name).schema, self.default_view(database, name)
        return T.StructType([whole[c] for c in view.columns])

    def version(self) -> str:
        return self.VERSION

    def save(self, path: str) -> None:
        rows = [("version", "", "", self.VERSION)]
        for (d, n), t in self._tables.items():
            rows.append(("table", d, n, t.to_json()))
            rows.append(("views", d, n, json.dumps([asdict(v) for v in self._views[d, n].values()])))
            rows.append(("transforms", d, n, json.dumps(self._transforms.get((d, n), {}))))
        rows.append(("storages", "", "", json.dumps({k: asdict(s) for k, s in self._storages.items()})))
        self.spark.createDataFrame(rows, "kind string, database string, name string, value string").coalesce(1).write.mode("overwrite").json(path)

    @classmethod
    def open(cls, spark: SparkSession, path: str, ttl: float = 3600.0, clock: Callable[[], float] = time.monotonic) -> Catalog:
        out = cls(spark, ttl, clock)
        out._path = path
        out.refresh()
        return out

    def refresh(self) -> None:
        """Read again what was saved. A few rows for each table reach the driver."""
        if self._path is None:
            return
        rows = self.spark.read.schema("kind string, database string, name string, value string").json(self._path).collect()
        self._clear()
        self._read_at = self.clock()
        of = lambda kind: [r for r in rows if r.kind == kind]
        if any(r.value != self.VERSION for r in of("version")):
            raise TableError("this catalog of names was written by another version")
        views = {(r.database, r.name): tuple(View(**v | {"columns": tuple(v["columns"])}) for v in json.loads(r.value)) for r in of("views")}
        path, self._path = self._path, None
        for r in of("table"):
            self.register(Table.from_json(r.value), views.get((r.database, r.name), ()))
        for r in of("transforms"):
            self._transforms[r.database, r.name] = json.loads(r.value)
        for r in of("storages"):
            self._storages = {k: Storage(**s) for k, s in json.loads(r.value).items()}
        self._path = path
