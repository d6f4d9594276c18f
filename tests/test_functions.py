from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import codec, datagen
from tidemark.functions import valuetypes as V
from tidemark.functions.wyhash import UNSHARDED, wyhash_hex

#: Fixed values of the hash.
VECTORS = {
    "New Jersey": "01e4006cfe326967",
    "Staten Island": "0b69743766a6ff32",
    "Manhattan": "1e56f55b0cbbe386",
    "": "42bc986dc5eec4d3",
    "Japanese (日本語)	こんにちは / ｺﾝﾆﾁﾊ": "4e89b38aacedbff8",
    "Chinese (中文,普通话,汉语)	你好": "4dca661b6a74dc9e",
    "Cantonese (粵語,廣東話)	早晨, 你好": "37123e82ec1580c1",
    "Korean (한글)	안녕하세요 / 안녕하십니까": "61eb7f47b6fb47bb",
    "Bronx": "4d053535cc2bfe5e",
    "Mongolian (монгол хэл)	Сайн байна уу?": "a9ee6f34c21f17df",
    "Brooklyn": "8b585f55db485a90",
    "Queens": "cb3af1db72e86e3c",
    "Alex": "12188ee9e05b0549",
    "Bob": "310cff710d780648",
    "ASDLFjasdlfkjasDFLKAJsdflasdjfowieuoajoizjodijaf039qj fef;li j2q3p[092 3pq fj; asldkj f;al sdjf a;slkdf": "b36e922dc4901cc8",
}


def test_wyhash_vectors():
    assert {s: wyhash_hex(s) for s in VECTORS} == VECTORS
    assert UNSHARDED == VECTORS[""]


DECLS = [
    "int8", "uint64", "float32", "string", "boolean", "decimal(20,3)", "timestamp(6)", "array<int32,true>", "array<array<string,true>,false>",
    "map<string,float64,false>", 'struct<"a":int32,"b \\"q\\"":map<string,array<int8,true>,true>>', "<any>",
]


@pytest.mark.parametrize("decl", DECLS)
def test_type_text_round_trip(decl):
    assert V.parse_type(decl).decl == decl


@pytest.mark.parametrize("bad", ["", "int7", "int8 ", "array<int8>", "struct<>", "map<int8,<any>,true>", "timestamp(10)", "decimal( 3,1)"])
def test_bad_type_text(bad):
    with pytest.raises(ValueError):
        V.parse_type(bad)


def test_blanks_only_around_commas():
    assert V.parse_type("map<string , int8 ,  true>") == V.Map(V.STRING, V.INT8, True)


def test_casts():
    assert V.castable(V.SECONDS, V.MICROS) and V.castable(V.INT8, V.ANY)
    assert not V.castable(V.INT8, V.INT16)


def test_storage_types():
    assert V.decode_storage_type("Nullable(UInt8)") == (V.UINT8, V.StorageType("uint8", index=True), True)
    assert V.decode_storage_type("datetime")[1].type == "datetime64"
    assert V.decode_storage_type("DateTime('UTC')") == (V.SECONDS, V.StorageType("datetime", index=True), False)
    value, storage, _ = V.decode_storage_type("array(nullable(int16))")
    assert value == V.Array(V.INT16, True) and storage.type == "array" and storage.elements[0].type == "int32"
    value, storage, _ = V.decode_storage_type("map(string, array(uint64)) encoding=zstd")
    assert value == V.Map(V.STRING, V.Array(V.UINT64)) and [e.type for e in storage.elements] == ["string", "array"]
    with pytest.raises(ValueError):
        V.decode_storage_type("decimal(3,2)")
    for t in (V.INT8, V.INT64, V.UINT64, V.STRING, V.BOOLEAN, V.SECONDS, V.MILLIS, V.Array(V.INT32), V.Map(V.STRING, V.FLOAT64)):
        assert V.from_storage(V.to_storage(t)) == t
    assert V.to_storage(V.UINT8).type == "uint32" and V.to_storage(V.FLOAT32).type == "double"
    with pytest.raises(ValueError):
        V.to_storage(V.MICROS)


ROW = V.Struct(
    {
        "seen": V.SECONDS, "sent": V.MILLIS, "kept": V.MICROS, "on": V.BOOLEAN, "level": V.INT8, "port_low": V.UINT8, "delta": V.INT16, "port": V.UINT16, "count": V.INT32, "bytes": V.UINT32,
        "offset": V.INT64, "total": V.UINT64, "ratio": V.FLOAT64, "host": V.STRING, "price": V.Decimal(12, 2), "codes": V.Array(V.INT32, True), "grid": V.Array(V.Array(V.STRING, True)),
        "marks": V.Map(V.STRING, V.INT8, True), "place": V.Struct({"row": V.INT32, "name": V.STRING}),
    }
)
TEXT = (
    '{"seen":"2021-03-04T05:06:07Z","sent":1500,"kept":2500001,"on":false,"level":-7,"port_low":200,"delta":-1234,"port":54321,"count":-987654,"bytes":3000000001,"offset":-5000000000,'
    '"total":18000000000000000000,"ratio":-0.125,"host":"edge-7","price":19.999,"codes":[4,null,-6],"grid":[[null,"q"],[]],"marks":{"low":-1,"none":null},"place":{"row":12,"name":"Ems"}}'
)


def _decode(spark, text: str, t: V.ValueType):
    return spark.createDataFrame([(text,)], "text string").select(codec.decode_json(F.col("text"), t).alias("v")).first().v


def test_decode_all_types(spark):
    row = _decode(spark, TEXT, ROW)
    epoch = dt.datetime(1970, 1, 1)
    assert (row.seen, row.sent, row.kept) == (dt.datetime(2021, 3, 4, 5, 6, 7), epoch + dt.timedelta(milliseconds=1500), epoch + dt.timedelta(microseconds=2500001))
    assert (row.on, row.level, row.port_low, row.delta, row.port, row["count"], row.bytes, row.offset) == (False, -7, 200, -1234, 54321, -987654, 3000000001, -5000000000)
    assert (row.total, row.ratio, row.host, row.price) == (Decimal(18 * 10**18), -0.125, "edge-7", Decimal("20.00"))
    assert row.codes == [4, None, -6] and row.grid == [[None, "q"], []] and row.marks == {"low": -1, "none": None} and (row.place.row, row.place.name) == (12, "Ems")


def test_round_trip(spark):
    df = spark.createDataFrame([(TEXT,)], "text string").select(codec.decode_json(F.col("text"), ROW).alias("v"))
    again = df.select("v", codec.decode_json(codec.encode_json(F.col("v"), ROW), ROW).alias("w")).first()
    assert again.v == again.w


@pytest.mark.parametrize(
    ("text", "t", "value"),
    [
        ('"true"', V.BOOLEAN, True), ("2", V.BOOLEAN, True), ("0", V.BOOLEAN, False), ("true", V.STRING, "true"), ("5", V.Array(V.INT8), [5]), ("1.9", V.INT32, 1),
        ("-1.9", V.INT32, -1), ('"1970-01-01T01:00:00+01:00"', V.SECONDS, dt.datetime(1970, 1, 1)), ("1999", V.Timestamp(9), dt.datetime(1970, 1, 1, 0, 0, 0, 1)), ("null", V.INT8, None),
    ],
)
def test_lenient(spark, text, t, value):
    assert _decode(spark, text, t) == value


OUT = [
    (V.INT8, -129), (V.INT8, 128), (V.INT16, -32769), (V.INT16, 32768), (V.INT32, -(1 << 31) - 1), (V.INT32, 1 << 31), (V.INT64, -(1 << 63) - 1), (V.INT64, 1 << 63),
    (V.UINT8, -1), (V.UINT8, 256), (V.UINT16, -1), (V.UINT16, 65536), (V.UINT32, -1), (V.UINT32, 1 << 32), (V.UINT64, -1), (V.UINT64, 1 << 64),
]


def test_out_of_range_is_null(spark):
    for t, n in OUT:
        low, high = t.bounds
        df = spark.createDataFrame([(str(n), str(low), str(high))], "n string, low string, high string")
        got = df.select(*[codec.decode_json(F.col(c), t).alias(c) for c in df.columns]).first()
        assert (got.n, got.low, got.high) == (None, low, high), t.decl


def test_instants(spark):
    micros = [0, 1, -1, 1_700_000_000_123_456, -62_135_596_800_000_000]
    df = spark.createDataFrame([(m,) for m in micros], "m long").select("m", codec.micros_to_instant(F.col("m")).alias("t"))
    rows = df.select("m", "t", codec.instant_to_micros(F.col("t")).alias("back"), codec.nanos_to_instant(codec.instant_to_nanos(F.col("t"))).alias("again")).where("m > -9000000000000000").collect()
    assert all(r.back == r.m and r.again == r.t and r.t == dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=r.m) for r in rows)


def test_generator(spark):
    schema = datagen.scalar_schema()
    assert len(schema) == 44 and len(datagen.scalar_schema(maps=False)) == 33
    one, two, other = (datagen.generate(spark, schema, 60, seed).collect() for seed in (1, 1, 2))
    assert one == two and one != other
    nulls = sum(r["int32"] is None for r in datagen.generate(spark, schema, 2000, 3).select("int32").collect())
    assert 120 < nulls < 280
    assert all(len(r["string[]"]) <= 7 and r["datetime"] is not None for r in one)


def test_maps_rows_and_widening(spark):
    t = V.Struct({"a": V.INT8, "b": V.STRING})
    df = spark.createDataFrame([({"a": "5", "c": "x"},), ({"a": "500"},), (None,)], "m map<string,string>")
    row = df.select(codec.map_to_row(F.col("m"), t).alias("r"))
    got = row.select("r", codec.row_to_map(F.col("r"), t, V.STRING).alias("back")).collect()
    assert [(g.r and tuple(g.r), g.back) for g in got] == [((5, None), {"a": "5", "b": None}), ((None, None), {"a": None, "b": None}), (None, None)]
    one = spark.sql("SELECT timestamp_ntz'1970-01-01 00:00:01.000002' AS t, CAST(3 AS TINYINT) AS n, 1.5f AS f")
    assert one.select(codec.as_long(F.col("t"), V.MICROS), codec.as_long(F.col("n"), V.INT8), codec.as_double(F.col("f"), V.FLOAT32)).first()[:] == (1_000_002, 3, 1.5)
    for bad in (lambda: codec.as_long(F.col("f"), V.FLOAT32), lambda: codec.as_long(F.col("f"), V.UINT64), lambda: codec.as_double(F.col("t"), V.STRING)):
        with pytest.raises(ValueError):
            bad()
