"""Files of rows into tables: CSV and JSON formats, new tables, and appended data."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec
from tidemark.functions import valuetypes as V
from tidemark.sources import parts
from tidemark.session import exists
from tidemark.sources.tables import Catalog, Table, TableError, columns_of

#: Compressions that a format may name, with the file endings by which Spark knows those it reads.
COMPRESSIONS = {"none": "", "gzip": ".gz", "bzip2": ".bz2", "deflate": ".deflate", "zip": ".zip"}


@dataclass(frozen=True)
class Flattening:
    """Columns for values inside nested objects (depth levels deep), named by the keys on the way.

    A key of an object is written between `left` and `right` after what holds it, and a place in an array (from 0) between
    slice_left and slice_right, if those are given: with the defaults, a.b[0] is the first value of b in the object a.
    """

    depth: int = 1
    left: str = "."
    right: str = ""
    slice_left: str | None = "["
    slice_right: str = "]"

    def path(self, name: str) -> list[str | int] | None:
        """The keys and places that a column's name stands for; None if it is no nested name, or too deep a one."""
        marks = [re.escape(m) for m in (self.left, self.slice_left) if m]
        ahead = rf"(?={'|'.join(marks)}|\Z)"
        key = rf"{re.escape(self.left)}(?P<key>.+?){re.escape(self.right)}{ahead}"
        place = rf"{re.escape(self.slice_left)}(?P<place>[0-9]+){re.escape(self.slice_right)}{ahead}" if self.slice_left else r"(?P<place>(?!))"
        step, first = re.compile(f"{place}|{key}"), re.compile(f"(.+?){ahead}").match(name)
        if not first or first.end() == len(name):
            return None
        out: list[str | int] = [first[1]]
        at = first.end()
        while at < len(name):
            m = step.match(name, at)
            if not m:
                return None
            out.append(m["key"] if m["place"] is None else int(m["place"]))
            at = m.end()
        return out if len(out) <= self.depth + 1 else None


@dataclass(frozen=True)
class Transform:
    """How files of rows are written."""

    type: str = "json"
    compression: str = "none"
    delimiter: str = ","
    escape: str = "\\"
    quote: str = '"'
    comment: str | None = None
    skip_head: bool = False
    null_values: tuple[str, ...] = ()
    flattening: Flattening | None = None
    settings: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.type not in ("csv", "json"):
            raise TableError(f"no format {self.type!r}")
        if self.compression not in COMPRESSIONS:
            raise TableError(f"no compression {self.compression!r}")


def read_rows(spark: SparkSession, path: str, row: V.Struct, transform: Transform | None = None) -> DataFrame:
    """Rows of the type's columns. Values that do not fit their column are null, as are columns that a row lacks."""
    transform = transform or Transform()
    if transform.compression == "zip":
        raise TableError("zip archives can't be read in parts; use gzip, bzip2 or deflate")
    if transform.type == "json":
        lines = spark.read.text(path).where(F.trim("value") != "")
        return decoded(lines, F.col("value"), row, transform)
    options = {"sep": transform.delimiter, "escape": transform.escape, "quote": transform.quote, "header": str(transform.skip_head).lower(), "enforceSchema": "true"}
    if transform.comment:
        options["comment"] = transform.comment
    nulls = lambda c: F.when(~c.isin(list(transform.null_values)), c) if transform.null_values else c
    texts = spark.read.options(**options).schema(", ".join(f"`{n}` string" for n, _ in row.fields)).csv(path)
    return texts.select(*[codec.from_text(nulls(F.col(f"`{n}`")), t).alias(n) for n, t in row.fields])


def decoded(lines: DataFrame, text: Column, row: V.Struct, transform: Transform) -> DataFrame:
    """JSON objects as rows. A flattened column's own key, if an object has it, comes before the nested value."""
    out = lines.select(text.alias("text"), codec.decode_json(text, row).alias("r"))
    columns = []
    for name, t in row.fields:
        value = F.col("r").getField(name)
        path = transform.flattening.path(name) if transform.flattening else None
        if path:
            steps = "".join(f"[{p}]" if isinstance(p, int) else f"['{p}']" for p in path)
            value = F.coalesce(value, codec.from_text(F.get_json_object("text", "$" + steps), t))
        columns.append(value.alias(name))
    return out.select(*columns)


def append(spark: SparkSession, table: Table, rows: DataFrame, data_path: str, period: str = "day", name: str | None = None) -> None:
    """More files, each append in a folder of its own, and their rows in the catalog. Readers see them when the catalog has them.

    name: an append that is made again under a name takes the place of what it wrote before.
    """
    again = name is not None
    name = name or uuid.uuid4().hex
    folder = f"{data_path.rstrip('/')}/{name}"
    parts.write_layout(rows.select(*table.columns), folder, table.primary, table.shard, period, list(table.sort), mode="overwrite" if again else "error")
    data = spark.read.schema(table.schema).parquet(folder)
    parts.build_catalog(spark, data, table.primary, table.shard).write.mode("overwrite").parquet(f"{table.catalog_path}/append-{name}")


def create_table(names: Catalog, database: str, name: str, rows: DataFrame, home: str, primary: str, shard: str | None = None, sort: tuple[str, ...] = (), period: str = "day") -> Table:
    """A table of these rows below `home`. One that exists by this name, and is the same, is used again as it is, without the rows."""
    table = names.register(Table(database, name, columns_of(rows.schema), primary, shard, sort, f"{home.rstrip('/')}/catalog"))
    if not exists(names.spark, f"{table.catalog_path}/append-created/_SUCCESS"):
        # Under a name: a creation that failed half way is made again in its own place.
        append(names.spark, table, rows, f"{home.rstrip('/')}/data", period, name="created")
    return table


def columnar_json(rows: DataFrame, order: str) -> DataFrame:
    """One row per column: its name and a JSON array of its values in order. For small results that a person or a tool looks at."""
    values = [F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(f"`{c}`").alias("v")))), lambda x: x["v"])).alias(c) for c in rows.columns]
    one = rows.agg(*values)
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in rows.columns]), F.array(*[F.col(f"`{c}`") for c in rows.columns]))).alias("column", "values"))
