from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark import queries as Q
from tidemark.functions import valuetypes as V
from tidemark.operators import scan as S
from tidemark.plans import expr as E
from tidemark.sources import datasource, parts
from tidemark.session import scratch_scope, shared_folder
from tidemark.sources.tables import Catalog, Connection, Storage, Table, TableError, View, columns_of, primary_of, storage_conf


@pytest.fixture(scope="module")
def table(spark, sf):
    return Q.events_table(spark, sf)


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_against_sql(spark, sf, same, name):
    same(Q.QUERIES[name](spark, sf), Q.ORACLE_SQL[name], sf)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE_SQL)))
def test_query_runs(spark, sf, name):
    assert Q.QUERIES[name](spark, sf).count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_opens_few_files_and_few_columns(spark, table):
    predicate = E.And(E.eq(Q.KIND, E.Lit("click")), E.And(E.ge(Q.TS, E.Lit(dt.datetime(2024, 1, 5))), E.lt(Q.TS, E.Lit(dt.datetime(2024, 1, 6)))))
    plan = S.plan_partitions(spark, table, predicate)
    assert 0 < len(plan.paths) <= 2 < plan.total and plan.filter_text == "\"event_type\" = 'click'"
    df = S.scan(spark, table, predicate, ["event_id"])
    assert len(df.inputFiles()) == len(plan.paths)
    text = _plan(df)
    assert "PushedFilters: [" in text and "EqualTo(event_type,click)" in text
    read = text.split("ReadSchema: ")[1]
    assert "value" not in read.split(">")[0] and "props" not in read.split(">")[0]


def test_metadata_aggregates_read_no_data(spark, table):
    df = S.aggregate(spark, table, [E.Aggregate(E.AggregateOp.COUNT_STAR), E.Aggregate(E.AggregateOp.MAX, Q.TS)])
    assert all("catalog" in f for f in df.inputFiles())
    with pytest.raises(ValueError):
        S.catalog_aggs(spark, table, [E.Aggregate(E.AggregateOp.SUM, Q.USER)])


def test_no_file_is_no_row(spark, table):
    df = S.scan(spark, table, E.lt(Q.TS, E.Lit(dt.datetime(1999, 1, 1))), ["ts", "event_id"])
    assert df.columns == ["ts", "event_id"] and df.count() == 0
    with pytest.raises(KeyError):
        S.scan(spark, table, None, ["nothing"])


def test_data_source(spark, table):
    fresh = datasource.load(spark, table)
    assert fresh.count() == spark.read.parquet(table.catalog_path).agg(F.sum("rows")).first()[0]
    datasource.guarded_view(spark, table, "guarded_events")
    total = spark.sql("SELECT count(*) FROM guarded_events").first()[0]
    late = spark.sql("SELECT count(*) FROM guarded_events WHERE ts >= TIMESTAMP_NTZ '2024-01-20'").first()[0]
    # A query without a filter of its own after one that pruned still sees everything.
    assert spark.sql("SELECT count(*) FROM guarded_events").first()[0] == total == fresh.count()
    assert spark.sql("SELECT count(*) FROM guarded_events WHERE ts < TIMESTAMP_NTZ '2024-01-20' OR event_type = 'click'").first()[0] >= total - late
    with pytest.raises(Exception, match="(?i)writ|append|support"):
        fresh.write.format("tidemark").option("table", table.to_json()).mode("append").save()


def test_layout_with_nulls_and_large_periods(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1, n % 3), None if n % 5 == 0 else f"k{n % 2}", n) for n in range(200)] + [(None, "k0", 999)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, kind string, n int")
    parts.write_layout(df, f"{tmp_path}/data", "ts", "kind", rows_per_file=20)
    data = spark.read.schema(df.schema).parquet(f"{tmp_path}/data")
    parts.build_catalog(spark, data, "ts", "kind").write.parquet(f"{tmp_path}/catalog")
    own = Table("d", "t", columns_of(df.schema), "ts", "kind", (), f"{tmp_path}/catalog")
    catalog = own.catalog(spark)
    assert catalog.agg(F.sum("rows"), F.max("rows")).first()[:] == (201, 20)
    kind, ts = E.Field("kind", V.STRING), E.Field("ts", V.MICROS)
    for p in (E.eq(kind, E.Lit("k1")), E.IsNull(kind), E.IsNull(ts), E.ge(ts, E.Lit(dt.datetime(2024, 1, 1, 2))), E.Not(E.eq(kind, E.Lit("k1")))):
        assert sorted(S.scan(spark, own, p, ["n"]).collect()) == sorted(df.where(p.to_column()).select("n").collect())
    assert parts.from_seconds(catalog).where("max_ts > timestamp_ntz'2024-01-01 02:00:00'").count() > 0


def test_catalog_of_names(spark, table, tmp_path):
    names = Catalog(spark)
    names.register(table)
    names.register(table)
    assert names.list_databases() == ["main"] and names.list_tables("main") == ["events"] and names.list_tables("x") == []
    assert names.schema("main", "events") == table.schema and names.schema("main", "events")["value"].metadata == {"indexed": 0}
    names.save(f"{tmp_path}/names")
    assert Catalog.open(spark, f"{tmp_path}/names").load("main", "events") == table
    assert names.default_view("main", "events").name == "all" and names.views("main", "x") == [] and names.transforms("x", "y") == {}
    now = [0.0]
    cached = Catalog.open(spark, f"{tmp_path}/names", ttl=10, clock=lambda: now[0])
    more = Catalog(spark)
    more.register(table, (View("v", ("event_id",), True),))
    more.add_storage("s", Storage("s", "gcs", "b"))
    more.save(f"{tmp_path}/names")
    assert cached.storages() == {}
    now[0] = 11.0
    assert cached.storages()["s"].root == "gs://b" and cached.default_view("main", "events").columns == ("event_id",)
    with pytest.raises(TableError):
        cached.primary("main", "events")
    for views in ((View("a", ("ts",), True), View("b", ("ts",), True)), (View("a", ("ts",)),)):
        more.register(table, views)
        with pytest.raises(TableError):
            more.default_view("main", "events")
    with pytest.raises(TableError):
        more.register(table, (View("a", ("nothing",)),))
    loaded = Connection.from_options({"project_name": "main", "table_name": "events", "partition_prefix": "p", "query_mode": "force_row"}).load(names)
    assert loaded.prefix == "p" and loaded.query_mode == "force_row" and loaded.columns == table.columns
    with pytest.raises(TableError):
        names.load("main", "nothing")


def test_options():
    c = Connection.from_options({"jdbc_url": "x", "username": "u", "password": "p", "query_mode": "FORCE_ROW"})
    assert c.required("jdbc_url") == "x" and c.optional("api_url") is None and c.as_map()["query_mode"] == "force_row"
    for bad in ({"query_mode": "fast"}, {"nothing": "x"}, {"jdbc_url": "x"}, {"table_name": "t"}, {"cloud_cred_2": "x"}):
        with pytest.raises(TableError):
            Connection.from_options(bad)
    with pytest.raises(TableError):
        c.required("api_url")
    with pytest.raises(TableError):
        Connection.from_options({"storage_cloud": "aws"}).storages({})
    given = {"storage_bucket_name": "b", "storage_bucket_path": "/p", "storage_region": "r", "storage_cloud": "aws", "storage_endpoint_uri": "http://h:1"}
    assert Connection.from_options(given).storages({})["default"].root == "s3a://b/p"
    assert Connection.from_env({"TIDEMARK_JDBC_URL": "j", "TIDEMARK_USERNAME": "u", "TIDEMARK_PASSWORD": "p"}).required("jdbc_url") == "j"


def test_storages():
    aws = storage_conf(Storage("a", "aws", "b", "p", "r", "http://h:9000"), "k", "s")
    assert aws["fs.s3a.endpoint"] == "http://h:9000" and aws["fs.s3a.connection.ssl.enabled"] == "false" and aws["fs.s3a.access.key"] == "k"
    assert storage_conf(Storage("a", "aws", "b", "p", "r"), "k", "s")["fs.s3a.connection.ssl.enabled"] == "true"
    assert storage_conf(Storage("g", "gcs", "b"), "file.json")["fs.gs.auth.service.account.json.keyfile"] == "file.json"
    assert storage_conf(Storage("z", "azure", "b"), "acct", "s") == {"fs.azure.account.key.acct.blob.core.windows.net": "s"}
    assert storage_conf(Storage("u", "unknown")) == {}
    with pytest.raises(TableError):
        storage_conf(Storage("a", "aws"), "k")


def test_paths_and_primary(table):
    stores = {"one": Storage("one", "gcp", "b1", "/x/"), "two": Storage("two", "aws", "b2")}
    own = Table("d", "t", table.columns, "ts", storages=stores, default_storage="one")
    assert own.resolve("2024/f", "two", "pre/fix") == "s3a://b2/pre/fix/2024/f" and own.resolve("f") == "gs://b1/x/f"
    assert own.resolve("file:/a/b") == "file:/a/b"
    # The id of its storage is no part of a file's path there; elsewhere the table's prefix comes first.
    assert own.resolve("two/2024/f", "two", "pre") == "s3a://b2/2024/f"
    within = replace(own, storages={"two": replace(stores["two"], data_path="db/files")})
    assert within.resolve("two/2024/f", "two", "pre") == "s3a://b2/db/files/2024/f"
    prefixed = replace(own, prefix="pre", default_storage=None)
    assert prefixed.resolve("f") == "gs://b1/x/pre/f" and replace(prefixed, storages=stores | {"three": Storage("three", "aws", "b3", default=True)}).resolve("f") == "s3a://b3/pre/f"
    with pytest.raises(TableError):
        Table("d", "t", table.columns, "ts").resolve("f")
    with pytest.raises(TableError):
        Table("d", "t", table.columns, "value")
    with pytest.raises(TableError):
        primary_of(table.columns)


def test_query_mode_is_the_tables_own(spark, table):
    setting = "spark.sql.parquet.enableVectorizedReader"
    before = spark.conf.get(setting)
    rows = S.scan(spark, replace(table, query_mode="force_row"), None, ["event_id"])
    columns = S.scan(spark, replace(table, query_mode="force_columnar"), None, ["event_id"])
    assert "Batched: false" in rows._jdf.queryExecution().executedPlan().treeString() or "ColumnarToRow" not in _plan(rows)
    assert "ColumnarToRow" in _plan(columns) and spark.conf.get(setting) == before
    assert rows.count() == columns.count() == S.scan(spark, table).count()


def test_credentials_are_the_reads_own(spark, table):
    """Options of the reader, not of the session; they reach the file system that reads."""
    stores = {"one": Storage("one", "aws", "b", "p", "r", "http://h:1")}
    c = Connection.from_options({"cloud_cred_1": "k", "cloud_cred_2": "s"})
    assert c.reader_options(stores)["fs.s3a.access.key"] == "k" and Connection.from_options({}).reader_options(stores) == {}
    assert S.scan(spark, replace(table, storages=stores), None, ["event_id"], c).count() == S.scan(spark, table).count()
    assert spark.sparkContext._jsc.hadoopConfiguration().get("fs.s3a.access.key") is None


def test_catalog_in_a_database(spark, table, tmp_path):
    """Over JDBC, with bounds cut to seconds, against the same catalog as files."""
    url = f"jdbc:derby:{tmp_path}/names;create=true"
    kept = table.catalog(spark).select(
        F.col("path").alias("partition"), F.date_trunc("second", "min_ts").cast("timestamp").alias("min_timestamp"), F.date_trunc("second", "max_ts").cast("timestamp").alias("max_timestamp"),
        "rows", "data_size", "shard_key", "storage_id",
    )
    kept.write.format("jdbc").options(url=url, dbtable="parts", user="u", password="p", createTableColumnTypes="shard_key VARCHAR(64)").save()
    connection = Connection.from_options({"jdbc_url": url, "username": "u", "password": "p"})
    remote = replace(table, catalog_path="", settings={"catalog_source": "parts", "catalog_names": '"{}"'})
    click = E.And(E.eq(Q.KIND, E.Lit("click")), E.And(E.ge(Q.TS, E.Lit(dt.datetime(2024, 1, 5, 0, 0, 0, 5))), E.lt(Q.TS, E.Lit(dt.datetime(2024, 1, 6)))))
    for predicate in (None, click, E.eq(Q.KIND, E.Lit("view"))):
        got = S.scan(spark, remote, predicate, ["event_id"], connection)
        assert sorted(got.collect()) == sorted(S.scan(spark, table, predicate, ["event_id"]).collect())
    low, high, hashes = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6), None
    assert 0 < remote.catalog(spark, connection, (low, high, hashes)).count() < S.plan_partitions(spark, remote, None, connection).total
    assert 0 < len(S.plan_partitions(spark, remote, click, connection).paths) <= 3
    count = S.aggregate(spark, remote, [E.Aggregate(E.AggregateOp.COUNT_STAR)], connection=connection)
    assert count.first()[0] == S.scan(spark, table).count()
    last = [E.Aggregate(E.AggregateOp.MAX, Q.TS)]
    assert S.aggregate(spark, remote, last, connection=connection).first() == S.aggregate(spark, table, last).first()
    with pytest.raises(TableError):
        S.scan(spark, remote)


def test_scratch_scope(spark):
    from tidemark.session import Scratch, exists

    with scratch_scope():
        inner = Scratch(spark, "inner")
        saved = inner.save(spark.range(3))
        dealt = inner.save_dealt(spark.range(10).withColumn("k", F.col("id") % 3), "k", 4)
        assert saved.count() == 3 and "Exchange" not in _plan(dealt.groupBy("k").count())
    assert not exists(spark, inner.base) and not any(t.name.startswith("tidemark_") for t in spark.catalog.listTables())
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_data_source_paths():
    from pyarrow import fs

    for path in ("/a/b", "file:/a/b", "file:///a/b"):
        store, inner = datasource.opened(path)
        assert isinstance(store, fs.LocalFileSystem) and inner == "/a/b"
