"""Value types: their text form, their Spark types, and their relation to storage types.

Unsigned integers have no Spark type: they are held in the next wider signed one, with a range check where values come
in. Timestamps are microseconds in Spark, so precision 9 is cut. Text form grammar: `int8`, `decimal(20,3)`,
`timestamp(6)`, `array<T,nullable>`, `map<K,V,nullable>`, `struct<"name":T,...>`, `<any>`; blanks only around commas.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ValueType:
    """A scalar by its name. Other types are subclasses."""

    name: str

    @property
    def decl(self) -> str:
        return self.name

    @property
    def spark(self) -> T.DataType:
        return _SPARK[self.name]

    @property
    def bounds(self) -> tuple[int, int] | None:
        """Least and greatest value of integers."""
        m = re.fullmatch(r"(u?)int(\d+)", self.name)
        if not m:
            return None
        bits = int(m[2])
        return (0, (1 << bits) - 1) if m[1] else (-(1 << bits - 1), (1 << bits - 1) - 1)


_SPARK = {
    "boolean": T.BooleanType(), "string": T.StringType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
    "uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(), "uint64": T.DecimalType(20, 0), "float32": T.FloatType(), "float64": T.DoubleType(),
    "<any>": T.VariantType(),
}

BOOLEAN, STRING, ANY = ValueType("boolean"), ValueType("string"), ValueType("<any>")
INT8, INT16, INT32, INT64 = (ValueType(f"int{n}") for n in (8, 16, 32, 64))
UINT8, UINT16, UINT32, UINT64 = (ValueType(f"uint{n}") for n in (8, 16, 32, 64))
FLOAT32, FLOAT64 = ValueType("float32"), ValueType("float64")
SCALARS = {t.name: t for t in (BOOLEAN, STRING, INT8, INT16, INT32, INT64, UINT8, UINT16, UINT32, UINT64, FLOAT32, FLOAT64)}


@dataclass(frozen=True)
class Decimal(ValueType):
    precision: int = 38
    scale: int = 0

    def __init__(self, precision: int, scale: int):
        for k, v in (("name", "decimal"), ("precision", precision), ("scale", scale)):
            object.__setattr__(self, k, v)

    @property
    def decl(self) -> str:
        return f"decimal({self.precision},{self.scale})"

    @property
    def spark(self) -> T.DataType:
        return T.DecimalType(self.precision, self.scale)


@dataclass(frozen=True)
class Timestamp(ValueType):
    precision: int = 6

    def __init__(self, precision: int):
        if not 0 <= precision <= 9:
            raise ValueError(f"timestamp precision {precision} is not in 0..9")
        object.__setattr__(self, "name", "timestamp")
        object.__setattr__(self, "precision", precision)

    @property
    def decl(self) -> str:
        return f"timestamp({self.precision})"

    @property
    def spark(self) -> T.DataType:
        return T.TimestampNTZType()


SECONDS, MILLIS, MICROS = Timestamp(0), Timestamp(3), Timestamp(6)


@dataclass(frozen=True)
class Array(ValueType):
    element: ValueType = STRING
    nullable: bool = False

    def __init__(self, element: ValueType, nullable: bool = False):
        for k, v in (("name", "array"), ("element", element), ("nullable", nullable)):
            object.__setattr__(self, k, v)

    @property
    def decl(self) -> str:
        return f"array<{self.element.decl},{str(self.nullable).lower()}>"

    @property
    def spark(self) -> T.DataType:
        return T.ArrayType(self.element.spark, self.nullable)


@dataclass(frozen=True)
class Map(ValueType):
    key: ValueType = STRING
    value: ValueType = STRING
    nullable: bool = False

    def __init__(self, key: ValueType, value: ValueType, nullable: bool = False):
        for k, v in (("name", "map"), ("key", key), ("value", value), ("nullable", nullable)):
            object.__setattr__(self, k, v)

    @property
    def decl(self) -> str:
        return f"map<{self.key.decl},{self.value.decl},{str(self.nullable).lower()}>"

    @property
    def spark(self) -> T.DataType:
        return T.MapType(self.key.spark, self.value.spark, self.nullable)


@dataclass(frozen=True)
class Struct(ValueType):
    fields: tuple[tuple[str, ValueType], ...] = ()

    def __init__(self, fields: dict[str, ValueType] | tuple[tuple[str, ValueType], ...]):
        object.__setattr__(self, "name", "struct")
        object.__setattr__(self, "fields", tuple(fields.items()) if isinstance(fields, dict) else tuple(fields))

    @property
    def decl(self) -> str:
        quoted = (n.replace('"', '\\"') for n, _ in self.fields)
        return "struct<" + ",".join(f'"{n}":{t.decl}' for n, (_, t) in zip(quoted, self.fields, strict=True)) + ">"

    @property
    def spark(self) -> T.DataType:
        return T.StructType([T.StructField(n, t.spark, True) for n, t in self.fields])


class _Reader:
    def __init__(self, text: str):
        self.text, self.at = text, 0

    def take(self, pattern: str) -> re.Match | None:
        m = re.compile(pattern).match(self.text, self.at)
        if m:
            self.at = m.end()
        return m

    def need(self, pattern: str) -> re.Match:
        m = self.take(pattern)
        if not m:
            raise ValueError(f"no value type: {self.text!r} at {self.at}")
        return m

    def type(self, top: bool = False) -> ValueType:
        if top and self.take("<any>"):
            return ANY
        if m := self.take(r"decimal\((\d+) *, *(\d+)\)"):
            return Decimal(int(m[1]), int(m[2]))
        if m := self.take(r"timestamp\((\d+)\)"):
            return Timestamp(int(m[1]))
        if self.take("array<"):
            element = self.type()
            return Array(element, self.flag())
        if self.take("map<"):
            key = self.type()
            self.need(" *, *")
            value = self.type()
            return Map(key, value, self.flag())
        if self.take("struct<"):
            fields = []
            while True:
                name = self.need(r'"((?:\\"|[^"])*)":')[1].replace('\\"', '"')
                fields.append((name, self.type()))
                if not self.take(" *, *"):
                    break
            self.need(">")
            return Struct(tuple(fields))
        return SCALARS[self.need("|".join(sorted(SCALARS, key=len, reverse=True)))[0]]

    def flag(self) -> bool:
        return self.need(" *, *(?i:(true|false))>")[1].lower() == "true"


def parse_type(text: str) -> ValueType:
    """The inverse of decl. Text after a type is an error."""
    reader = _Reader(text)
    out = reader.type(top=True)
    reader.need(r"\Z")
    return out


def castable(have: ValueType, want: ValueType) -> bool:
    """A type casts to itself, to <any>, and timestamps to each other's precision."""
    return want == ANY or have == want or (isinstance(have, Timestamp) and isinstance(want, Timestamp))


@dataclass(frozen=True)
class StorageType:
    """How storage holds a column: a type name, and the types of elements (or key and value)."""

    type: str
    elements: tuple[StorageType, ...] = ()
    index: bool = False
    primary: bool = False


#: Declared type name to value type and storage type.
_DECLARED = {
    "int8": (INT8, "int8"), "uint8": (UINT8, "uint8"), "int16": (INT16, "int32"), "uint16": (UINT16, "uint32"), "int32": (INT32, "int32"), "uint32": (UINT32, "uint32"),
    "int64": (INT64, "int64"), "uint64": (UINT64, "uint64"), "float32": (FLOAT32, "double"), "float64": (FLOAT64, "double"), "string": (STRING, "string"),
    "datetime64": (MILLIS, "datetime64"), "datetime": (SECONDS, "datetime64"),
}


def _arguments(text: str) -> list[str]:
    """The parts between commas that are in no bracket."""
    out, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def decode_storage_type(declared: str) -> tuple[ValueType, StorageType, bool]:
    """(value type, storage type, nullable) of a declared column type such as nullable(uint8) or map(string, int64)."""
    text = declared.strip().lower()
    if m := re.fullmatch(r"(.*?)\s*encoding=\S*", text):
        text = m[1]
    if text in _DECLARED:
        value, storage = _DECLARED[text]
        return value, StorageType(storage, index=True), False
    m = re.fullmatch(r"(\w+)\((.*)\)", text)
    if not m:
        raise ValueError(f"unknown column type {declared!r}")
    name, inner = m[1], m[2]
    if name == "datetime64":
        return MILLIS, StorageType("datetime64", index=True), False
    if name == "datetime":
        return SECONDS, StorageType("datetime", index=True), False
    if name == "nullable":
        value, storage, _ = decode_storage_type(inner)
        return value, storage, True
    if name == "array":
        value, storage, nullable = decode_storage_type(inner)
        return Array(value, nullable), StorageType("array", (storage,), index=True), False
    if name == "map":
        key, value = (decode_storage_type(x) for x in _arguments(inner))
        return Map(key[0], value[0], value[2]), StorageType("map", (key[1], value[1]), index=True), False
    raise ValueError(f"unknown column type {declared!r}")


#: Storage type to value type, and back.
_FROM_STORAGE = {
    "int8": INT8, "uint8": UINT8, "int32": INT32, "uint32": UINT32, "int64": INT64, "uint64": UINT64, "double": FLOAT64, "string": STRING, "boolean": BOOLEAN,
    "datetime64": MILLIS, "datetime": SECONDS, "epoch": MILLIS,
}
_TO_STORAGE = {
    INT8: "int8", UINT8: "uint32", INT16: "int32", UINT16: "uint32", INT32: "int32", UINT32: "uint32", INT64: "int64", UINT64: "uint64", FLOAT32: "double", FLOAT64: "double",
    BOOLEAN: "boolean", STRING: "string", SECONDS: "datetime", MILLIS: "datetime64",
}


def from_storage(storage: StorageType) -> ValueType:
    if storage.type == "array":
        return Array(from_storage(storage.elements[0]))
    if storage.type == "map":
        return Map(*map(from_storage, storage.elements))
    if storage.type not in _FROM_STORAGE:
        raise ValueError(f"no value type for storage type {storage.type!r}")
    return _FROM_STORAGE[storage.type]


def to_storage(value: ValueType) -> StorageType:
    if isinstance(value, Array):
        return StorageType("array", (to_storage(value.element),))
    if isinstance(value, Map):
        return StorageType("map", (to_storage(value.key), to_storage(value.value)))
    if value not in _TO_STORAGE:
        raise ValueError(f"no storage type for {value.decl}")
    return StorageType(_TO_STORAGE[value])
