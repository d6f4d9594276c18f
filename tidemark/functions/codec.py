"""JSON to typed columns and back, as Spark expressions.

Decoding is lenient: "true" and numbers are booleans, booleans are text, a bare value is an array of one, numbers are
instants in the unit of the type's precision, ISO text is an instant. from_json alone takes none of these, so it is
only used to split a level of JSON into text, which is then converted. What does not fit, such as a number out of the
type's range, is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import valuetypes as V


def _epoch() -> Column:
    return F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def micros_to_instant(micros: Column) -> Column:
    """A timestamp without a zone, of microseconds since 1970."""
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return _epoch() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def instant_to_micros(instant: Column) -> Column:
    """Microseconds since 1970 of a timestamp without a zone."""
    since = instant - _epoch()
    return (
        F.extract(F.lit("DAY"), since).cast("long") * 86_400_000_000
        + F.extract(F.lit("HOUR"), since).cast("long") * 3_600_000_000
        + F.extract(F.lit("MINUTE"), since).cast("long") * 60_000_000
        + (F.extract(F.lit("SECOND"), since) * 1_000_000).cast("long")
    )


def instant_to_nanos(instant: Column) -> Column:
    return instant_to_micros(instant) * 1000


def nanos_to_instant(nanos: Column) -> Column:
    return micros_to_instant(F.floor(nanos / 1000))


def _number(text: Column) -> Column:
    return text.try_cast("decimal(38,9)")


def _scalar(text: Column, t: V.ValueType) -> Column:
    if t == V.STRING:
        return text
    if t == V.BOOLEAN:
        return F.when(F.lower(text) == "true", True).when(_number(text).isNotNull(), _number(text) != 0).when(text.isNotNull(), False)
    if isinstance(t, V.Timestamp):
        # Microseconds in one unit of the precision: 9 is finer than Spark's microseconds and is cut.
        scale = {0: 1_000_000, 3: 1_000, 6: 1}.get(t.precision)
        n = _number(text)
        micros = F.floor(n / 1000) if t.precision == 9 else F.floor(n * scale) if scale else F.lit(None)
        iso = F.try_to_timestamp(text).cast("timestamp_ntz")
        zoned = text.rlike(r"(?i)(Z|[+-]\d\d:?\d\d)$")
        as_utc = F.to_utc_timestamp(F.try_to_timestamp(text), F.current_timezone()).cast("timestamp_ntz")
        return F.when(n.isNotNull(), micros_to_instant(micros.cast("long"))).when(zoned, as_utc).otherwise(iso)
    if t.bounds:
        low, high = (F.lit(str(b)).cast("decimal(38,9)") for b in t.bounds)
        n = _number(text)
        whole = F.when(n < 0, F.ceil(n)).otherwise(F.floor(n))
        return F.when(n.between(low, high), whole).cast(t.spark)
    return text.try_cast(t.spark)


def _text(text: Column, t: V.ValueType) -> Column:
    """A value's JSON text, with strings bare, as the type."""
    if isinstance(t, V.Array):
        items = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>")).when(text.isNotNull(), F.array(text))
        return F.transform(items, lambda x: _text(x, t.element))
    if isinstance(t, V.Map):
        pairs = F.from_json(text, "map<string,string>")
        return F.transform_values(F.transform_keys(pairs, lambda k, _: _text(k, t.key)), lambda _, v: _text(v, t.value))
    if isinstance(t, V.Struct):
        own = F.from_json(text, "struct<" + ",".join(f"`{n.replace('`', '``')}`:string" for n, _ in t.fields) + ">")
        # As a lambda's variable the parsed object is made once, where each use of the expression would parse anew.
        return F.element_at(F.transform(F.array(own), lambda r: F.when(r.isNotNull(), F.struct(*[_text(r.getField(n), f).alias(n) for n, f in t.fields]))), 1)
    if t == V.ANY:
        return F.try_parse_json(text)
    return _scalar(text, t)


def from_text(text: Column, t: V.ValueType) -> Column:
    """Bare text, such as a CSV field, as the type; arrays, maps and structs are JSON in it."""
    return _text(text, t)


def decode_json(text: Column, t: V.ValueType) -> Column:
    """JSON text as the type."""
    if isinstance(t, V.Struct | V.Map) or t == V.ANY:
        return _text(text, t)
    # One value, as the only member of an object, so that from_json takes the quotes off.
    bare = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "struct<v:string>").getField("v")
    return _text(bare, t)


def _plain(c: Column, t: V.ValueType) -> Column:
    """Instants as ISO text or numbers are left to to_json; only precisions below its own are cut."""
    if isinstance(t, V.Timestamp):
        unit = {0: "SECOND", 3: "MILLISECOND"}.get(t.precision)
        cut = F.date_trunc(unit, c).cast("timestamp_ntz") if unit else c
        return F.concat(F.date_format(cut, "yyyy-MM-dd'T'HH:mm:ss"), {0: F.lit(""), 3: F.date_format(cut, ".SSS")}.get(t.precision, F.date_format(cut, ".SSSSSS")), F.lit("Z"))
    if isinstance(t, V.Array):
        return F.transform(c, lambda x: _plain(x, t.element))
    if isinstance(t, V.Map):
        return F.transform_values(c, lambda _, v: _plain(v, t.value))
    if isinstance(t, V.Struct):
        return F.when(c.isNotNull(), F.struct(*[_plain(c.getField(n), f).alias(n) for n, f in t.fields]))
    return c


def encode_json(c: Column, t: V.ValueType) -> Column:
    """JSON text of a column of the type. Null is JSON's null; map keys must be text."""
    if isinstance(t, V.Map) and t.key != V.STRING:
        raise ValueError(f"only text keys can be written, not {t.key.decl}")
    whole = F.to_json(F.struct(_plain(c, t).alias("v")), {"ignoreNullFields": "false"})
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def checked(c: Column, t: V.ValueType) -> Column:
    """A number as the type, null if it is out of the type's range."""
    if not t.bounds:
        return c.try_cast(t.spark)
    low, high = (F.lit(str(b)).cast("decimal(38,0)") for b in t.bounds)
    n = c.try_cast("decimal(38,0)")
    return F.when(n.between(low, high), n).try_cast(t.spark)


def map_to_row(values: Column, t: V.Struct) -> Column:
    """A map's values as a row of the type: a field that the map lacks is null, keys that are no field are left out."""
    return F.when(values.isNotNull(), F.struct(*[F.try_element_at(values, F.lit(n)).try_cast(f.spark).alias(n) for n, f in t.fields]))


def row_to_map(row: Column, t: V.Struct, value: V.ValueType) -> Column:
    """A row as a map from its fields' names; null values are kept."""
    pairs = F.array(*[F.struct(F.lit(n).alias("k"), row.getField(n).try_cast(value.spark).alias("v")) for n, _ in t.fields])
    return F.when(row.isNotNull(), F.map_from_entries(pairs))


def as_long(c: Column, t: V.ValueType) -> Column:
    """Whole numbers, widened; microseconds since 1970 of instants. Other types have no long."""
    if isinstance(t, V.Timestamp):
        return instant_to_micros(c)
    if not t.bounds or t.bounds[1] > 2**63 - 1:
        raise ValueError(f"{t.decl} is no long")
    return c.cast("long")


def as_double(c: Column, t: V.ValueType) -> Column:
    """Numbers of any kind, widened."""
    if not t.bounds and t not in (V.FLOAT32, V.FLOAT64) and not isinstance(t, V.Decimal):
        raise ValueError(f"{t.decl} is no double")
    return c.cast("double")
