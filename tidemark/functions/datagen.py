"""Random rows that are the same each time: every value is derived from the row's number, the column's name and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import valuetypes as V

#: One in so many values of a nullable column is null.
NULLS = 10
MOST_ELEMENTS = 7
MOST_BYTES = 63


def _bits(*of: Column | str | int) -> Column:
    return F.xxhash64(*[F.lit(x) if isinstance(x, str | int) else x for x in of])


def _value(t: V.ValueType, seed: Column) -> Column:
    bits = _bits(seed, t.name)
    if isinstance(t, V.Array):
        n = F.pmod(bits, F.lit(MOST_ELEMENTS + 1)).cast("int")
        some = F.slice(F.sequence(F.lit(1), F.lit(MOST_ELEMENTS)), F.lit(1), n)
        return F.transform(some, lambda i: _nullable(t.element, _bits(seed, i), t.nullable))
    if isinstance(t, V.Map):
        n = F.pmod(bits, F.lit(MOST_ELEMENTS + 1)).cast("int")
        some = F.slice(F.sequence(F.lit(1), F.lit(MOST_ELEMENTS)), F.lit(1), n)
        entries = F.transform(some, lambda i: F.struct(_value(t.key, _bits(seed, i, "key")).alias("key"), _nullable(t.value, _bits(seed, i, "value"), t.nullable).alias("value")))
        # Keys are random but few kinds have many values: of equal keys the first stays.
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.map_from_entries(F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), 1)))
    if isinstance(t, V.Struct):
        return F.struct(*[_value(f, _bits(seed, n)).alias(n) for n, f in t.fields])
    if isinstance(t, V.Timestamp):
        unit = {0: 1_000_000, 3: 1_000}.get(t.precision, 1)
        # 1970 to 2037, in whole units.
        micros = F.pmod(bits, F.lit(2_145_916_800_000_000)) / unit
        seconds = (F.floor(micros) * unit / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
        return F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    if t == V.STRING:
        n = F.pmod(bits, F.lit(MOST_BYTES + 1)).cast("int")
        letters = F.concat(*[F.hex(_bits(seed, k)) for k in range(8)])
        return F.base64(F.unhex(F.substring(F.lpad(letters, 128, "0"), F.lit(1), n * 2)))
    if t == V.BOOLEAN:
        return F.pmod(bits, F.lit(2)) == 1
    if t.bounds:
        low, high = t.bounds
        unsigned = bits.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
        return ((unsigned % F.lit(str(high - low + 1)).cast("decimal(20,0)")) + F.lit(str(low)).cast("decimal(20,0)")).cast(t.spark)
    if isinstance(t, V.Decimal):
        return (F.pmod(bits, F.lit(10 ** min(18, t.precision))).cast(f"decimal({min(18, t.precision)},0)") / F.lit(str(10**t.scale)).cast("decimal(38,0)")).cast(t.spark)
    return (F.pmod(bits, F.lit(1 << 53)) / float(1 << 53)).cast(t.spark)


def _nullable(t: V.ValueType, seed: Column, nullable: bool) -> Column:
    value = _value(t, seed)
    return F.when(F.pmod(_bits(seed, "null"), F.lit(NULLS)) != 0, value) if nullable else value


def generate(spark: SparkSession, schema: dict[str, tuple[V.ValueType, bool]], n: int, seed: int = 0) -> DataFrame:
    """n rows of columns name: (type, nullable)."""
    ids = spark.range(n)
    return ids.select(*[_nullable(t, _bits(F.col("id"), seed, name), nullable).alias(name) for name, (t, nullable) in schema.items()])


def scalar_schema(nested: bool = True, maps: bool = True, nullable: bool = True) -> dict[str, tuple[V.ValueType, bool]]:
    """A column of each storage scalar x, and with nested x[] (array), x{} (map of text to x) and x[][] (array of arrays)."""
    scalars = {
        "boolean": V.BOOLEAN, "double": V.FLOAT64, "int8": V.INT8, "int32": V.INT32, "int64": V.INT64, "string": V.STRING, "uint8": V.UINT8, "uint32": V.UINT32,
        "uint64": V.UINT64, "datetime": V.MILLIS, "epoch": V.MILLIS,
    }
    out: dict[str, tuple[V.ValueType, bool]] = {}
    for name, t in scalars.items():
        out[name] = (t, nullable and name != "datetime")
        if nested:
            out[name + "[]"] = (V.Array(t, nullable), False)
            if maps:
                out[name + "{}"] = (V.Map(V.STRING, t, nullable), False)
            out[name + "[][]"] = (V.Array(V.Array(t, nullable), False), False)
    return out
