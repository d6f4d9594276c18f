from __future__ import annotations

import bz2
import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import helpers
from tidemark.functions import valuetypes as V
from tidemark.operators import scan as S
from tidemark.plans import expr as E
from tidemark.sources import ingest
from tidemark.sources.tables import Catalog, Table, TableError, columns_of
from tidemark.streaming import ingest as stream

ROW = V.Struct({"ts": V.MILLIS, "kind": V.STRING, "n": V.INT32, "tags": V.Array(V.STRING, True)})
LINES = [{"ts": "2024-01-01T00:00:00Z", "kind": "a", "n": 1, "tags": ["x", None]}, {"ts": 1704153600000, "kind": "b", "n": "bad"}, {"ts": "2024-01-03T00:00:00Z", "kind": None, "n": 3.7, "tags": "one"}]


def test_json_rows(spark, tmp_path):
    with gzip.open(tmp_path / "rows.json.gz", "wt") as f:
        f.write("\n".join(map(json.dumps, LINES)) + "\n\n")
    rows = sorted(ingest.read_rows(spark, str(tmp_path), ROW, ingest.Transform(compression="gzip")).collect())
    assert [(r.ts.day, r.kind, r.n, r.tags) for r in rows] == [(1, "a", 1, ["x", None]), (2, "b", None, None), (3, None, 3, ["one"])]


def test_csv_rows(spark, tmp_path):
    text = "ts;kind;n;tags\n# not this\n2024-01-01T00:00:00Z;'a;b';1;[\"x\"]\n1704153600000;b;bad;\n"
    with bz2.open(tmp_path / "rows.csv.bz2", "wt") as f:
        f.write(text)
    rows = ingest.read_rows(spark, str(tmp_path), ROW, ingest.Transform("csv", "bzip2", ";", quote="'", comment="#", skip_head=True)).collect()
    assert [(r.ts.day, r.kind, r.n, r.tags) for r in rows] == [(1, "a;b", 1, ["x"]), (2, "b", None, None)]
    for bad in ({"type": "xml"}, {"compression": "rar"}):
        with pytest.raises(TableError):
            ingest.Transform(**bad)
    with pytest.raises(TableError):
        ingest.read_rows(spark, str(tmp_path), ROW, ingest.Transform(compression="zip"))


def test_create_append_and_stream(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d), "a" if d % 2 else "b", d) for d in range(1, 6)], "ts timestamp_ntz, kind string, n int")
    names = Catalog(spark)
    table = ingest.create_table(names, "d", "t", rows, str(tmp_path / "t"), "ts", "kind")
    ingest.append(spark, table, rows.withColumn("n", F.col("n") + 100), str(tmp_path / "t/data"))
    kind = E.Field("kind", V.STRING)
    assert S.scan(spark, table, E.eq(kind, E.Lit("a"))).count() == 6
    assert S.plan_partitions(spark, table).total == 10
    assert ingest.create_table(Catalog(spark), "d", "t", rows, str(tmp_path / "t"), "ts", "kind") == table and S.scan(spark, table).count() == 10
    for n in (3, 2):  # an append made again under its name takes the first one's place
        ingest.append(spark, table, rows.limit(n).withColumn("n", F.lit(1000)), str(tmp_path / "t/data"), name="again")
        assert S.scan(spark, table, E.eq(E.Field("n", V.INT32), E.Lit(1000))).count() == n
    # Whole appends are read as folders, single files by name; a garbage folder that the catalog does not name is not read.
    rows.write.parquet(str(tmp_path / "t/data/half"))
    paths = S.scan_paths(spark, table)
    assert len(paths) == 3 and not any(p.endswith(".parquet") for p in paths) and S.scan(spark, table).count() == 12
    some = S.scan_paths(spark, table, E.eq(kind, E.Lit("a")))
    assert all(p.endswith(".parquet") for p in some) and len(some) < S.plan_partitions(spark, table).total
    monkeypatch.setattr(S, "NAMED", 1)  # as for more files than are looked at one by one
    assert sorted(S.scan_paths(spark, table)) == sorted(paths) and sorted(S.scan_paths(spark, table, E.eq(kind, E.Lit("a")))) == sorted(some)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.json").write_text(json.dumps({"ts": "2024-01-09T00:00:00Z", "kind": "c", "n": 9}) + "\n")
    row = V.Struct({"ts": V.MICROS, "kind": V.STRING, "n": V.INT32})
    query = stream.append_stream(stream.stream_rows(spark, str(tmp_path / "in"), row), table, str(tmp_path / "t/data"), str(tmp_path / "ck"), available_now=True)
    assert query.awaitTermination(120)
    late = S.scan(spark, table, E.gt(E.Field("ts", V.MICROS), E.Lit(dt.datetime(2024, 1, 8)))).collect()
    assert [(r.kind, r.n) for r in late] == [("c", 9)]
    column = {r["column"]: json.loads(r["values"]) for r in ingest.columnar_json(rows, "n").collect()}
    assert column["n"] == [1, 2, 3, 4, 5] and column["kind"] == ["a", "b", "a", "b", "a"]


def test_stream_batch_run_again(spark, tmp_path):
    """A batch whose commit was lost is run again under its number: its rows are there once."""
    import shutil

    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.json").write_text("".join(json.dumps({"ts": f"2024-01-0{d}T00:00:00Z", "kind": "c", "n": d}) + "\n" for d in range(1, 6)))
    row = V.Struct({"ts": V.MICROS, "kind": V.STRING, "n": V.INT32})
    schema = spark.createDataFrame([], "ts timestamp_ntz, kind string, n int").schema
    table = Table("d", "s", columns_of(schema), "ts", "kind", (), str(tmp_path / "t/catalog"))
    for _ in range(2):
        query = stream.append_stream(stream.stream_rows(spark, str(tmp_path / "in"), row), table, str(tmp_path / "t/data"), str(tmp_path / "ck"), available_now=True)
        assert query.awaitTermination(120)
        assert S.scan(spark, table).count() == 5
        shutil.rmtree(tmp_path / "ck/commits")


def test_flattening(spark, tmp_path):
    paths = [ingest.Flattening(2).path(n) for n in ("a", "a.b", "a.b.c", "a.b.c.d", "a[3].b", ".x", "a[x]")]
    assert paths == [None, ["a", "b"], ["a", "b", "c"], None, ["a", 3, "b"], None, None]
    assert ingest.Flattening(1, "<", ">", None).path("a<b>") == ["a", "b"] and ingest.Flattening(1, "_", "", None).path("a_b") == ["a", "b"]
    lines = [{"a": {"b": {"c": 1}, "t": "{not json"}, "l": [{"k": 2}, 3]}, {"a.t": "own", "a": {"t": "other"}}, {"a": 5, "l": None}]
    (tmp_path / "rows.json").write_text("\n".join(map(json.dumps, lines)))
    row = V.Struct({"a.b.c": V.INT32, "a.t": V.STRING, "l[0].k": V.INT8, "l[1]": V.FLOAT64, "a.b.c.d": V.STRING})
    got = ingest.read_rows(spark, str(tmp_path), row, ingest.Transform(flattening=ingest.Flattening(2))).collect()
    assert [tuple(r) for r in got] == [(1, "{not json", 2, 3.0, None), (None, "own", None, None, None), (None, None, None, None, None)]


def test_helpers():
    assert helpers.find_single([1, 2, 3], lambda x: x == 2) == 2 and helpers.find_single([], bool) is None
    with pytest.raises(ValueError):
        helpers.find_single([1, 1], bool)
    with pytest.raises(ValueError):
        helpers.find_exactly_one([], bool)
    assert helpers.split([1, 2, 3], lambda x: str(x) if x > 1 else None) == (["2", "3"], [1])
    assert helpers.none_if_empty("") is None
