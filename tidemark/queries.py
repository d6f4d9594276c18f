"""The registered queries over the log table `events`, each with the SQL that says what it must return.

`events` is laid out once per application and input by day and event_type; queries then read it through its catalog.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec, datagen
from tidemark.functions import valuetypes as V
from tidemark.functions.wyhash import wyhash_column
from tidemark.operators import scan as S
from tidemark.plans import expr as E
from tidemark.plans import pushdown as P
from tidemark.session import Scratch, shared_folder
from tidemark.sources import datasource, ingest, parts
from tidemark.sources.tables import Catalog, Storage, Table, View, catalog_sql, columns_of, storage_conf
from tidemark.streaming import ingest as stream

_tables: dict[tuple[str, str], Table] = {}

_T1, _T2, _T3 = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 7, 12, 30), dt.datetime(2024, 1, 20, 6)
_EXACT = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
TS, KIND = E.Field("ts", V.MICROS), E.Field("event_type", V.STRING)
USER, VALUE, PROPS = E.Field("user_id", V.INT64), E.Field("value", V.FLOAT64), E.Field("props", V.STRING)
#: A column with nulls, which events itself has not: the value of all events but errors.
SCORE = E.Field("score", V.FLOAT64)
_SCORE_SQL = "CASE WHEN event_type <> 'error' THEN value END"


def events_table(spark: SparkSession, sf_dir: str) -> Table:
    """The layout and catalog of events, written to the shared folder when first asked for."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _tables:
        source = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("score", F.when(F.col("event_type") != "error", F.col("value")))
        home = Scratch(spark, f"layout-{uuid.uuid4().hex[:8]}").base
        assert home.startswith(shared_folder(spark))
        parts.write_layout(source, f"{home}/data", "ts", "event_type", sort=["event_id"])
        table = Table("main", "events", columns_of(source.schema, not_indexed=("value",)), "ts", "event_type", ("event_id",), f"{home}/catalog")
        data = spark.read.schema(table.schema).parquet(f"{home}/data")
        parts.build_catalog(spark, data, "ts", "event_type").sort("min_ts").write.parquet(table.catalog_path)
        _tables[key] = table
    return _tables[key]


def _lit(t: dt.datetime) -> E.Lit:
    return E.Lit(t)


def _list(field: E.Field, *values: object) -> E.In:
    return E.In(field, E.ArrayLit(values, V.Array(field.type)))


def _scan(predicate: E.Expr | None, columns: list[str] | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return S.scan(spark, events_table(spark, sf_dir), predicate, columns or ["event_id", "ts"])

    return query


def _sql(where: str, columns: str = "event_id, ts") -> str:
    return f"SELECT {columns} FROM events WHERE {where}"


_S1, _S2, _S3 = (f"TIMESTAMP '{t}'" for t in (_T1, _T2, _T3))
_SEXACT = f"TIMESTAMP '{_EXACT}'"
_REDUNDANT = E.And(E.Or(E.FALSE, E.Not(E.Not(E.ge(TS, _lit(_T1))))), E.And(E.TRUE, E.Not(E.eq(KIND, E.Lit("click")))))

_SCANS: dict[str, tuple[E.Expr | None, str, str]] = {
    "scan_full": (None, "true", "event_id, ts, user_id, event_type, value, props"),
    "scan_time_range": (E.And(E.ge(TS, _lit(_T1)), E.lt(TS, _lit(_T2))), f"ts >= {_S1} AND ts < {_S2}", ""),
    "scan_time_eq": (E.eq(TS, _lit(_EXACT)), f"ts = {_SEXACT}", ""),
    "scan_time_ne": (E.ne(TS, _lit(_EXACT)), f"ts <> {_SEXACT}", ""),
    "scan_time_lt": (E.lt(TS, _lit(_T1)), f"ts < {_S1}", ""),
    "scan_time_le": (E.le(TS, _lit(_EXACT)), f"ts <= {_SEXACT}", ""),
    "scan_time_gt": (E.gt(TS, _lit(_T3)), f"ts > {_S3}", ""),
    "scan_time_ge": (E.ge(TS, _lit(_T3)), f"ts >= {_S3}", ""),
    "scan_time_between": (E.between(TS, _lit(_T1), _lit(_T2)), f"ts BETWEEN {_S1} AND {_S2}", ""),
    "scan_time_in": (_list(TS, _EXACT, _T1), f"ts IN ({_SEXACT}, {_S1})", ""),
    "scan_time_or": (E.Or(E.lt(TS, _lit(_T1)), E.ge(TS, _lit(_T3))), f"ts < {_S1} OR ts >= {_S3}", ""),
    "scan_not": (E.Not(E.lt(TS, _lit(_T3))), f"NOT (ts < {_S3})", ""),
    "scan_literal_left": (E.lt(_lit(_T3), TS), f"{_S3} < ts", ""),
    "scan_shard_eq": (E.eq(KIND, E.Lit("click")), "event_type = 'click'", "event_id, event_type"),
    "scan_shard_ne": (E.ne(KIND, E.Lit("click")), "event_type <> 'click'", "event_id, event_type"),
    "scan_shard_in": (_list(KIND, "click", "error"), "event_type IN ('click', 'error')", "event_id, event_type"),
    "scan_shard_and_time": (E.And(E.eq(KIND, E.Lit("click")), E.And(E.ge(TS, _lit(_T1)), E.lt(TS, _lit(_T2)))), f"event_type = 'click' AND ts >= {_S1} AND ts < {_S2}", "event_id, ts, event_type"),
    "scan_string_other": (E.eq(PROPS, E.Lit('{"k": 69}')), "props = '{\"k\": 69}'", "event_id, props"),
    "scan_nonstring": (E.eq(USER, E.Lit(7, V.INT64)), "user_id = 7", "event_id, user_id"),
    "scan_empty": (E.lt(TS, _lit(dt.datetime(2023, 1, 1))), "ts < TIMESTAMP '2023-01-01'", ""),
    "scan_is_null": (E.IsNull(VALUE), "value IS NULL", "event_id, value"),
    "scan_now": (E.And(E.ge(TS, _lit(_T3)), E.lt(TS, E.Now())), f"ts >= {_S3} AND ts < now()::TIMESTAMP", ""),
    "scan_or_not_prunable": (E.Or(E.eq(USER, E.Lit(7, V.INT64)), E.lt(TS, _lit(_T1))), f"user_id = 7 OR ts < {_S1}", "event_id, ts, user_id"),
    "simplify_equiv": (_REDUNDANT, f"ts >= {_S1} AND event_type <> 'click'", "event_id, ts"),
}

_COUNT, _MIN, _MAX = E.Aggregate(E.AggregateOp.COUNT_STAR), E.Aggregate(E.AggregateOp.MIN, TS), E.Aggregate(E.AggregateOp.MAX, TS)


def _named(df: DataFrame, *names: str) -> DataFrame:
    return df.toDF(*names)


def meta_count_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(S.aggregate(spark, events_table(spark, sf_dir), [_COUNT, _MIN, _MAX]), "n", "first_ts", "last_ts")


def agg_filtered_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(S.aggregate(spark, events_table(spark, sf_dir), [_COUNT, _MIN, _MAX], E.lt(TS, _lit(_T1))), "n", "first_ts", "last_ts")


def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(S.aggregate(spark, events_table(spark, sf_dir), [E.Aggregate(E.AggregateOp.COUNT_DISTINCT, USER)]), "users")


def agg_sum_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = [E.Aggregate(E.AggregateOp.SUM, USER), E.Aggregate(E.AggregateOp.MIN, VALUE), E.Aggregate(E.AggregateOp.MAX, VALUE)]
    return _named(S.aggregate(spark, events_table(spark, sf_dir), aggs), "sum_user", "min_value", "max_value")


def agg_count_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(S.aggregate(spark, events_table(spark, sf_dir), [E.Aggregate(E.AggregateOp.COUNT, VALUE)]), "n_values")


def agg_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(S.aggregate(spark, events_table(spark, sf_dir), [_COUNT, _MAX], E.ge(TS, _lit(_T3)), ["event_type"]), "event_type", "n", "last_ts")


def parts_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = events_table(spark, sf_dir).catalog(spark)
    days = catalog.groupBy(F.date_trunc("day", "min_ts").cast("timestamp_ntz").alias("day"), "shard_key")
    return days.agg(F.sum("rows").alias("rows"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))


def parts_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicate = E.And(E.eq(KIND, E.Lit("click")), E.between(TS, _lit(_T1), _lit(_T2)))
    return S.chosen_parts(spark, events_table(spark, sf_dir), predicate).select("min_ts", "max_ts", "rows")


def parts_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = parts.select_parts(events_table(spark, sf_dir).catalog(spark), _T1, _T2)
    return catalog.agg(F.sum("rows").alias("rows"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))


def json_row_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = V.Struct({"k": V.INT64, "missing": V.STRING})
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", codec.decode_json(F.col("props"), kind)["k"].alias("k"))


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = V.Struct({"id": V.INT64, "kind": V.STRING, "at": V.MICROS, "tags": V.Array(V.STRING, True)})
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    own = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("ts").alias("at"), F.array("event_type", F.lit(None)).alias("tags"))
    back = events.select(codec.decode_json(codec.encode_json(own, row), row).alias("r"))
    return back.select(F.col("r.id").alias("event_id"), F.col("r.kind").alias("event_type"), F.col("r.at").alias("ts"), F.size("r.tags").cast("long").alias("n_tags"))


def epoch_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    micros = codec.instant_to_micros(F.col("ts"))
    return events.select("event_id", micros.alias("micros"), codec.micros_to_instant(micros).alias("ts"))


def types_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.select(
        "l_orderkey", "l_linenumber",
        F.coalesce(codec.checked(F.col("l_partkey"), V.INT8).cast("int"), F.lit(-1)).alias("part_int8"),
        F.coalesce(codec.checked(F.col("l_partkey"), V.UINT8).cast("int"), F.lit(-1)).alias("part_uint8"),
        F.coalesce(codec.checked(F.col("l_orderkey"), V.UINT16).cast("int"), F.lit(-1)).alias("order_uint16"),
    )


def shard_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count()
    return kinds.select("event_type", wyhash_column(F.col("event_type")).alias("shard_key"), F.col("count").alias("n"))


def scan_null_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scan(spark, events_table(spark, sf_dir), E.IsNull(SCORE), ["event_id", "score"])


def scan_not_high_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under a NOT, rows of a null score are no more true than before."""
    return S.scan(spark, events_table(spark, sf_dir), E.Not(E.gt(SCORE, E.Lit(50.0))), ["event_id", "score"])


def map_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = V.Map(V.STRING, V.INT64, True)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", codec.decode_json(F.col("props"), kind).alias("m"))
    back = codec.decode_json(codec.encode_json(F.col("m"), kind), kind)
    return events.select("event_id", F.try_element_at("m", F.lit("k")).alias("k"), F.size(back).cast("long").alias("n"), F.try_element_at(back, F.lit("k")).alias("again"))


def map_row_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = V.Struct({"k": V.INT32, "missing": V.STRING})
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", codec.decode_json(F.col("props"), V.Map(V.STRING, V.INT64, True)).alias("m"))
    events = events.withColumn("r", codec.map_to_row(F.col("m"), row))
    again = codec.row_to_map(F.col("r"), row, V.STRING)
    return events.select("event_id", F.col("r.k").alias("k"), F.col("r.missing").alias("missing"), again["k"].alias("text"), F.array_join(F.array_sort(F.map_keys(again)), ",").alias("names"))


def widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.select(
        "l_orderkey", "l_linenumber", codec.as_long(F.col("l_shipdate"), V.MICROS).alias("ship_micros"), codec.as_long(F.col("l_linenumber"), V.INT32).alias("line_long"),
        codec.as_double(F.col("l_linenumber"), V.INT32).alias("line_double"), codec.as_double(F.col("l_quantity"), V.FLOAT64).alias("quantity"),
    )


def struct_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = E.StructLit((7, "x", None), V.Struct({"n": V.INT32, "s": V.STRING, "d": V.FLOAT64}))
    regions = spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", one.to_column().alias("v"))
    return regions.select("r_regionkey", "v.n", "v.s", "v.d")


def storage_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = ["Int8", "UInt8", "int16", "uint16", "int32", "UInt32", "int64", "uint64", "float32", "float64", "String", "datetime", "DateTime('UTC')", "datetime64(3)", "nullable(uint8)", "array(nullable(int16))", "map(string, uint64) encoding=zstd"]
    rows = []
    for d in declared:
        value, storage, nullable = V.decode_storage_type(d)
        rows.append((d, value.decl, storage.type, nullable, V.from_storage(storage).decl))
    return spark.createDataFrame(rows, "declared string, decl string, storage string, nullable boolean, read string")


def catalog_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query that a catalog in a database gets."""
    cases = [("all", (None, None, None)), ("from", (_T1, None, None)), ("to", (None, _T2, None)), ("both", (_T1, _T2, ["42bc986dc5eec4d3"])), ("shards", (None, None, ["0a", "0b"]))]
    return spark.createDataFrame([(name, catalog_sql("db.parts", *bounds)) for name, bounds in cases], "bounds string, query string")


def names_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables, views, transforms and storages, saved and opened again."""
    home = Scratch(spark, "names").base
    names = Catalog(spark)
    table = names.register(events_table(spark, sf_dir), (View("all", ("event_id", "ts", "event_type")), View("short", ("ts", "value"), True)))
    names.add_transform("main", "events", "lines", {"type": "json"})
    names.add_storage("s", Storage("s", "aws", "bucket", "/p", "r"))
    names.save(f"{home}/names")
    again = Catalog.open(spark, f"{home}/names")
    assert again.load("main", "events") == table
    rows = []
    for d in again.list_databases():
        for n in again.list_tables(d):
            rows.append((d, n, again.default_view(d, n).name, again.primary(d, n), ",".join(again.schema(d, n).names), len(again.views(d, n)), ",".join(again.transforms(d, n)), again.storages()["s"].root, again.version()))
    return spark.createDataFrame(rows, "database string, name string, view string, primary_key string, columns string, views int, transforms string, root string, version string")


def _summed(spark: SparkSession, table: Table) -> DataFrame:
    return S.scan(spark, table).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.max("ts").alias("last_ts"))


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made of events, made again to no effect, and appended to a day later."""
    home = Scratch(spark, f"append-{uuid.uuid4().hex[:8]}").base
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type")
    for _ in range(2):
        table = ingest.create_table(Catalog(spark), "main", "copied", rows, home, "ts", "event_type")
    ingest.append(spark, table, rows.withColumn("ts", F.col("ts") + F.expr("interval 1 day")), f"{home}/data")
    return _summed(spark, table)


def _written(spark: SparkSession, sf_dir: str, columns: list[str]) -> tuple[str, DataFrame]:
    return Scratch(spark, f"rows-{uuid.uuid4().hex[:8]}").base, spark.read.parquet(f"{sf_dir}/events.parquet").select(columns)


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, streamed into a table."""
    home, rows = _written(spark, sf_dir, ["event_id", "ts", "event_type"])
    row = V.Struct({"event_id": V.INT64, "ts": V.MICROS, "event_type": V.STRING})
    rows.select(codec.encode_json(F.struct(*rows.columns), row).alias("value")).write.text(f"{home}/lines")
    table = Table("main", "streamed", columns_of(rows.schema), "ts", "event_type", (), f"{home}/catalog")
    query = stream.append_stream(stream.stream_rows(spark, f"{home}/lines", row), table, f"{home}/data", f"{home}/checkpoint", available_now=True)
    query.awaitTermination()
    return _summed(spark, table)


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, rows = _written(spark, sf_dir, ["event_id", "event_type", "value", "ts"])
    rows.write.option("sep", ";").option("quote", "'").option("header", "true").option("compression", "gzip").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(f"{home}/rows")
    row = V.Struct({"event_id": V.INT64, "event_type": V.STRING, "value": V.FLOAT64, "ts": V.MICROS})
    return ingest.read_rows(spark, f"{home}/rows", row, ingest.Transform("csv", "gzip", ";", quote="'", skip_head=True, null_values=("view",)))


def flattened_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """props is an object inside each row's object; its values get columns of their own."""
    home, rows = _written(spark, sf_dir, ["event_id", "props"])
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"props":'), F.col("props"), F.lit(',"list":[1,"b"]}'))
    rows.select(line.alias("value")).write.text(f"{home}/lines")
    row = V.Struct({"event_id": V.INT64, "props.k": V.INT64, "list[1]": V.STRING, "props.none": V.STRING})
    got = ingest.read_rows(spark, f"{home}/lines", row, ingest.Transform(flattening=ingest.Flattening()))
    return got.toDF("event_id", "k", "second", "none")


def render_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = events_table(spark, sf_dir).layout
    rows = [(name, P.render(p, layout) if p is not None else None, P.classify(p, layout) if p is not None else 1) for name, (p, _, _) in _SCANS.items()]
    return spark.createDataFrame(rows, "query string, filter string, code int")


def type_decl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(name, t.decl, V.parse_type(t.decl).spark.simpleString()) for name, (t, _) in datagen.scalar_schema().items()]
    return spark.createDataFrame(rows, "column string, decl string, spark_type string")


def storage_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    storages = [Storage("a", "aws", "b", "p", "r", "http://s:9000"), Storage("g", "gcp", "b", "p", "r"), Storage("z", "azure", "b", "p", "r")]
    rows = [(s.cloud, k, v) for s in storages for k, v in sorted(storage_conf(s, "key", "secret").items())]
    return spark.createDataFrame(rows, "cloud string, name string, value string")


def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = events_table(spark, sf_dir)
    rows = []
    for name in ("scan_full", "scan_time_range", "scan_shard_eq", "scan_shard_and_time", "scan_time_or", "scan_nonstring", "scan_empty"):
        plan = S.plan_partitions(spark, table, _SCANS[name][0])
        rows.append((name, plan.total, len(plan.paths), len(plan.pushed), len(plan.residual), plan.filter_text))
    return spark.createDataFrame(rows, "query string, files int, opened int, pushed int, residual int, filter string")


def generated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datagen.generate(spark, datagen.scalar_schema(), 100, seed=42)


def source_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the data source: a fresh load, so that pruning follows this query's filters."""
    df = datasource.load(spark, events_table(spark, sf_dir))
    return df.where((F.col("ts") >= F.lit(str(_T1)).cast("timestamp_ntz")) & (F.col("event_type") == "click")).select("event_id", "ts")


_OTHER: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "meta_count_min_max": (meta_count_min_max, "SELECT COUNT(*) AS n, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events"),
    "agg_filtered_fallback": (agg_filtered_fallback, f"SELECT COUNT(*) AS n, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events WHERE ts < {_S1}"),
    "agg_count_distinct": (agg_count_distinct, "SELECT COUNT(DISTINCT user_id) AS users FROM events"),
    "agg_sum_min_max": (agg_sum_min_max, "SELECT CAST(SUM(user_id) AS BIGINT) AS sum_user, MIN(value) AS min_value, MAX(value) AS max_value FROM events"),
    "agg_count_col": (agg_count_col, "SELECT COUNT(value) AS n_values FROM events"),
    "agg_grouped": (agg_grouped, f"SELECT event_type, COUNT(*) AS n, MAX(ts) AS last_ts FROM events WHERE ts >= {_S3} GROUP BY event_type"),
    "parts_catalog": (
        parts_catalog,
        """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
           CASE event_type WHEN 'click' THEN '6fcd615ad5cb59e7' WHEN 'error' THEN '9d6eb035d58380ad' WHEN 'purchase' THEN '664f0666cb25efac'
                WHEN 'signup' THEN '50d3a894cf2baf54' WHEN 'view' THEN '6609d84c7845f085' END AS shard_key,
           COUNT(*) AS rows, MIN(ts) AS min_ts, MAX(ts) AS max_ts FROM events GROUP BY 1, 2""",
    ),
    "parts_selected": (
        parts_selected,
        f"""SELECT MIN(ts) AS min_ts, MAX(ts) AS max_ts, COUNT(*) AS rows FROM events WHERE event_type = 'click'
            GROUP BY date_trunc('day', ts) HAVING MAX(ts) >= {_S1} AND MIN(ts) <= {_S2}""",
    ),
    "parts_aggs": (
        parts_aggs,
        f"""SELECT CAST(SUM(n) AS BIGINT) AS rows, MIN(a) AS min_ts, MAX(z) AS max_ts FROM
            (SELECT COUNT(*) AS n, MIN(ts) AS a, MAX(ts) AS z FROM events GROUP BY date_trunc('day', ts), event_type HAVING MAX(ts) >= {_S1} AND MIN(ts) <= {_S2})""",
    ),
    "json_row_decode": (json_row_decode, "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"),
    "json_round_trip": (json_round_trip, "SELECT event_id, event_type, ts, CAST(2 AS BIGINT) AS n_tags FROM events"),
    "epoch_micros": (epoch_micros, "SELECT event_id, epoch_us(ts) AS micros, ts FROM events"),
    "types_cast": (
        types_cast,
        """SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_partkey BETWEEN -128 AND 127 THEN l_partkey ELSE -1 END AS INTEGER) AS part_int8,
           CAST(CASE WHEN l_partkey BETWEEN 0 AND 255 THEN l_partkey ELSE -1 END AS INTEGER) AS part_uint8,
           CAST(CASE WHEN l_orderkey BETWEEN 0 AND 65535 THEN l_orderkey ELSE -1 END AS INTEGER) AS order_uint16 FROM lineitem""",
    ),
    "shard_hash": (
        shard_hash,
        """SELECT event_type, CASE event_type WHEN 'click' THEN '6fcd615ad5cb59e7' WHEN 'error' THEN '9d6eb035d58380ad' WHEN 'purchase' THEN '664f0666cb25efac'
           WHEN 'signup' THEN '50d3a894cf2baf54' WHEN 'view' THEN '6609d84c7845f085' END AS shard_key, COUNT(*) AS n FROM events GROUP BY event_type""",
    ),
    "source_time_range": (source_time_range, f"SELECT event_id, ts FROM events WHERE ts >= {_S1} AND event_type = 'click'"),
    "scan_null_score": (scan_null_score, f"SELECT event_id, {_SCORE_SQL} AS score FROM events WHERE ({_SCORE_SQL}) IS NULL"),
    "scan_not_high_score": (scan_not_high_score, f"SELECT event_id, {_SCORE_SQL} AS score FROM events WHERE NOT (({_SCORE_SQL}) > 50.0)"),
    "map_codec": (
        map_codec,
        """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(len(json_keys(props)) AS BIGINT) AS n, CAST(json_extract(props, '$.k') AS BIGINT) AS again FROM events""",
    ),
    "map_row_map": (
        map_row_map,
        """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing, CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS text,
           'k,missing' AS names FROM events""",
    ),
    "widened": (
        widened,
        """SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate) AS ship_micros, CAST(l_linenumber AS BIGINT) AS line_long, CAST(l_linenumber AS DOUBLE) AS line_double,
           l_quantity AS quantity FROM lineitem""",
    ),
    "struct_literals": (struct_literals, "SELECT r_regionkey, CAST(7 AS INTEGER) AS n, 'x' AS s, CAST(NULL AS DOUBLE) AS d FROM region"),
    "storage_types": (
        storage_types,
        """SELECT * FROM (VALUES
           ('Int8', 'int8', 'int8', false, 'int8'), ('UInt8', 'uint8', 'uint8', false, 'uint8'), ('int16', 'int16', 'int32', false, 'int32'), ('uint16', 'uint16', 'uint32', false, 'uint32'),
           ('int32', 'int32', 'int32', false, 'int32'), ('UInt32', 'uint32', 'uint32', false, 'uint32'), ('int64', 'int64', 'int64', false, 'int64'), ('uint64', 'uint64', 'uint64', false, 'uint64'),
           ('float32', 'float32', 'double', false, 'float64'), ('float64', 'float64', 'double', false, 'float64'), ('String', 'string', 'string', false, 'string'),
           ('datetime', 'timestamp(0)', 'datetime64', false, 'timestamp(3)'), ('DateTime(''UTC'')', 'timestamp(0)', 'datetime', false, 'timestamp(0)'),
           ('datetime64(3)', 'timestamp(3)', 'datetime64', false, 'timestamp(3)'), ('nullable(uint8)', 'uint8', 'uint8', true, 'uint8'),
           ('array(nullable(int16))', 'array<int16,true>', 'array', false, 'array<int32,false>'), ('map(string, uint64) encoding=zstd', 'map<string,uint64,false>', 'map', false, 'map<string,uint64,false>')
           ) t(declared, decl, storage, nullable, read)""",
    ),
    "catalog_query": (
        catalog_query,
        """SELECT * FROM (VALUES ('all', 'SELECT * FROM db.parts'),
           ('from', 'SELECT * FROM db.parts WHERE (max_timestamp IS NULL OR max_timestamp >= {ts ''2024-01-05 00:00:00.000000''})'),
           ('to', 'SELECT * FROM db.parts WHERE (min_timestamp IS NULL OR min_timestamp <= {ts ''2024-01-07 12:30:00.000000''})'),
           ('both', 'SELECT * FROM db.parts WHERE (max_timestamp IS NULL OR max_timestamp >= {ts ''2024-01-05 00:00:00.000000''}) AND (min_timestamp IS NULL OR min_timestamp <= {ts ''2024-01-07 12:30:00.000000''}) AND (shard_key IS NULL OR shard_key IN (''42bc986dc5eec4d3''))'),
           ('shards', 'SELECT * FROM db.parts WHERE (shard_key IS NULL OR shard_key IN (''0a'', ''0b''))')) t(bounds, query)""",
    ),
    "names_saved": (
        names_saved,
        """SELECT 'main' AS "database", 'events' AS name, 'short' AS "view", 'ts' AS primary_key, 'ts,value' AS columns, CAST(2 AS INTEGER) AS views, 'lines' AS transforms,
           's3a://bucket/p' AS root, '1' AS version""",
    ),
    "table_append": (
        table_append,
        "SELECT event_type, CAST(2 * COUNT(*) AS BIGINT) AS n, CAST(2 * SUM(event_id) AS BIGINT) AS ids, MAX(ts) + INTERVAL 1 DAY AS last_ts FROM events GROUP BY event_type",
    ),
    "stream_append": (stream_append, "SELECT event_type, COUNT(*) AS n, CAST(SUM(event_id) AS BIGINT) AS ids, MAX(ts) AS last_ts FROM events GROUP BY event_type"),
    "csv_rows": (csv_rows, "SELECT event_id, NULLIF(event_type, 'view') AS event_type, value, ts FROM events"),
    "flattened_rows": (flattened_rows, """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'b' AS second, CAST(NULL AS VARCHAR) AS "none" FROM events"""),
    "render_filter": (
        render_filter,
        """SELECT query, filter, CAST(code AS INTEGER) AS code FROM (VALUES
           ('scan_full', NULL, 1), ('scan_time_range', NULL, 2), ('scan_time_eq', NULL, 2), ('scan_time_ne', NULL, 2), ('scan_time_lt', NULL, 2), ('scan_time_le', NULL, 2),
           ('scan_time_gt', NULL, 2), ('scan_time_ge', NULL, 2), ('scan_time_between', NULL, 2), ('scan_time_in', NULL, 2), ('scan_time_or', NULL, 2), ('scan_not', NULL, 2),
           ('scan_literal_left', NULL, 2), ('scan_shard_eq', '"event_type" = ''click''', 2), ('scan_shard_ne', '"event_type" != ''click''', 2), ('scan_shard_in', NULL, 2),
           ('scan_shard_and_time', '"event_type" = ''click''', 2), ('scan_string_other', '"props" = ''{"k": 69}''', 2), ('scan_nonstring', NULL, 3), ('scan_empty', NULL, 2),
           ('scan_is_null', NULL, 3), ('scan_now', NULL, 3), ('scan_or_not_prunable', NULL, 3), ('simplify_equiv', '"event_type" != ''click''', 2)) t(query, filter, code)""",
    ),
    "type_decl": (
        type_decl,
        """WITH t(name, decl, spark) AS (VALUES ('boolean', 'boolean', 'boolean'), ('double', 'float64', 'double'), ('int8', 'int8', 'tinyint'), ('int32', 'int32', 'int'), ('int64', 'int64', 'bigint'),
           ('string', 'string', 'string'), ('uint8', 'uint8', 'smallint'), ('uint32', 'uint32', 'bigint'), ('uint64', 'uint64', 'decimal(20,0)'), ('datetime', 'timestamp(3)', 'timestamp_ntz'),
           ('epoch', 'timestamp(3)', 'timestamp_ntz'))
           SELECT name AS "column", decl, spark AS spark_type FROM t
           UNION ALL SELECT name || '[]', 'array<' || decl || ',true>', 'array<' || spark || '>' FROM t
           UNION ALL SELECT name || '{}', 'map<string,' || decl || ',true>', 'map<string,' || spark || '>' FROM t
           UNION ALL SELECT name || '[][]', 'array<array<' || decl || ',true>,false>', 'array<array<' || spark || '>>' FROM t""",
    ),
    "storage_settings": (
        storage_settings,
        """SELECT * FROM (VALUES ('aws', 'fs.s3a.access.key', 'key'), ('aws', 'fs.s3a.secret.key', 'secret'), ('aws', 'fs.s3a.endpoint.region', 'r'), ('aws', 'fs.s3a.endpoint', 'http://s:9000'),
           ('aws', 'fs.s3a.path.style.access', 'true'), ('aws', 'fs.s3a.connection.ssl.enabled', 'false'), ('gcp', 'fs.gs.auth.type', 'SERVICE_ACCOUNT_JSON_KEYFILE'),
           ('gcp', 'fs.gs.auth.service.account.json.keyfile', 'key'), ('azure', 'fs.azure.account.key.key.blob.core.windows.net', 'secret')) t(cloud, name, value)""",
    ),
    "plan_summary": (
        plan_summary,
        f"""WITH parts AS (SELECT event_type, MIN(ts) AS a, MAX(ts) AS z FROM events GROUP BY date_trunc('day', ts), event_type),
           opened(query, opened, pushed, residual, filter) AS (
           SELECT 'scan_full', COUNT(*), 0, 0, NULL FROM parts
           UNION ALL SELECT 'scan_time_range', COUNT(*) FILTER (z >= {_S1} AND a < {_S2}), 2, 2, NULL FROM parts
           UNION ALL SELECT 'scan_shard_eq', COUNT(*) FILTER (event_type = 'click'), 1, 1, '"event_type" = ''click''' FROM parts
           UNION ALL SELECT 'scan_shard_and_time', COUNT(*) FILTER (event_type = 'click' AND z >= {_S1} AND a < {_S2}), 3, 3, '"event_type" = ''click''' FROM parts
           UNION ALL SELECT 'scan_time_or', COUNT(*) FILTER (a < {_S1} OR z >= {_S3}), 1, 1, NULL FROM parts
           UNION ALL SELECT 'scan_nonstring', COUNT(*), 0, 1, NULL FROM parts
           UNION ALL SELECT 'scan_empty', COUNT(*) FILTER (a < TIMESTAMP '2023-01-01'), 1, 1, NULL FROM parts)
           SELECT query, CAST((SELECT COUNT(*) FROM parts) AS INTEGER) AS files, CAST(opened AS INTEGER) AS opened, CAST(pushed AS INTEGER) AS pushed, CAST(residual AS INTEGER) AS residual, filter FROM opened""",
    ),
    "generated_rows": (generated_rows, None),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _scan(p, columns.split(", ") if columns else None) for name, (p, _, columns) in _SCANS.items()},
    **{name: fn for name, (fn, _) in _OTHER.items()},
}
ORACLE_SQL: dict[str, str] = {
    **{name: _sql(where, columns or "event_id, ts") for name, (_, where, columns) in _SCANS.items()},
    **{name: sql for name, (_, sql) in _OTHER.items() if sql},
}
