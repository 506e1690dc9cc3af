"""Table types: the compact type grammar of table definitions, its Spark types, and physical type strings."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

#: Types without parameters, their physical strings and Spark types.
PLAIN = {
    "boolean": ("boolean", T.BooleanType()),
    "tinyint": ("tinyint", T.ByteType()),
    "smallint": ("short", T.ShortType()),
    "int": ("int", T.IntegerType()),
    "bigint": ("bigint", T.LongType()),
    "float": ("float", T.FloatType()),
    "double": ("double", T.DoubleType()),
    "date": ("date", T.DateType()),
}
#: Types with a length, and those with a precision of fractional seconds (default 6, at most 6 here).
SIZED = {"char": ("string", T.StringType()), "varchar": ("string", T.StringType()), "binary": ("binary", T.BinaryType()), "varbinary": ("binary", T.BinaryType())}
TIMED = {"time": ("timestamp", T.IntegerType()), "timestamp": ("timestamp-millis", T.TimestampNTZType()), "localzonedtimestamp": ("timestamp-millis", T.TimestampType())}

#: Physical type strings that are no Spark DDL, or mean something else there.
PHYSICAL = {
    "tinyint": T.ByteType(), "byte": T.ByteType(), "short": T.ShortType(), "smallint": T.ShortType(), "bigint": T.LongType(),
    "boolean": T.BooleanType(), "int": T.IntegerType(), "float": T.FloatType(), "double": T.DoubleType(), "binary": T.BinaryType(),
    "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp-micros": T.TimestampType(),
    "timestamp-millis": T.TimestampType(),
}


@dataclass(frozen=True)
class LogicalType:
    """A declared type. args: length, precision or precision and scale; children: element, key and value, or fields."""

    name: str
    nullable: bool = False
    args: tuple[int, ...] = ()
    children: tuple[tuple[str, LogicalType], ...] = ()

    def spark(self) -> T.DataType:
        """CHAR and VARCHAR are strings without padding; TIME is milliseconds of the day."""
        if self.name in PLAIN:
            return PLAIN[self.name][1]
        if self.name in SIZED:
            return SIZED[self.name][1]
        if self.name in TIMED:
            return TIMED[self.name][1]
        if self.name == "decimal":
            return T.DecimalType(*self.args)
        inner = [c for _, c in self.children]
        if self.name == "array":
            return T.ArrayType(inner[0].spark(), inner[0].nullable)
        if self.name == "map":
            return T.MapType(inner[0].spark(), inner[1].spark(), inner[1].nullable)
        return T.StructType([T.StructField(n, c.spark(), c.nullable) for n, c in self.children])

    def physical(self) -> str:
        """The physical type string that readers use."""
        for group in (PLAIN, SIZED, TIMED):
            if self.name in group:
                return group[self.name][0]
        if self.name == "decimal":
            return f"decimal({self.args[0]},{self.args[1]})"
        inner = ",".join(f"{n}:{c.physical()}" if self.name == "row" else c.physical() for n, c in self.children)
        return f"{'struct' if self.name == 'row' else self.name}<{inner}>"

    def __str__(self) -> str:
        """As shown by a table's description."""
        text = self.name.upper() if self.name != "localzonedtimestamp" else "TIMESTAMP"
        if self.args:
            text += f"({', '.join(map(str, self.args))})"
        if self.name == "localzonedtimestamp":
            text += " WITH LOCAL TIME ZONE"
        if self.children:
            text += "<" + ", ".join(f"`{n}` {c}" if self.name == "row" else str(c) for n, c in self.children) + ">"
        return text + ("" if self.nullable else " NOT NULL")

    def field(self, name: str) -> T.StructField:
        return T.StructField(name, self.spark(), self.nullable, {"declared_type": str(self)})


def _pieces(text: str) -> list[str]:
    """What stands between the commas that no bracket encloses."""
    out, depth = [""], 0
    for c in text:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def parse_ddl(text: str) -> LogicalType:
    """The type that a table definition declares: `nullable(T)`, else NOT NULL; capitals and blanks don't matter.

    boolean tinyint smallint int bigint float double date, time, timestamp and localzonedtimestamp with or without (p),
    char varchar binary varbinary with (n), decimal(p,s), array<T>, map<K,V>, row<name|T,...>. Field names of rows are
    lower-cased. ValueError for anything else, and for more than six fractional digits.
    """
    return _parse(re.sub(r"\s", "", text.lower()))


def _parse(text: str) -> LogicalType:
    if m := re.fullmatch(r"nullable\((.*)\)", text):
        return replace(_parse(m[1]), nullable=True)
    if text in PLAIN:
        return LogicalType(text)
    m = re.fullmatch(r"(\w+)(?:\((\d+)(?:,(\d+))?\))?", text)
    if m and m[1] in TIMED and not m[3]:
        precision = int(m[2] or (0 if m[1] == "time" else 6))
        if precision > 6:
            raise ValueError(f"more than microseconds are not supported: {text}")
        return LogicalType(m[1], args=(precision,))
    if m and m[1] in SIZED and m[2] and not m[3] and int(m[2]) > 0:
        return LogicalType(m[1], args=(int(m[2]),))
    if m and m[1] == "decimal" and m[3] and 0 < int(m[2]) <= 38 and int(m[3]) <= int(m[2]):
        return LogicalType("decimal", args=(int(m[2]), int(m[3])))
    if m := re.fullmatch(r"(array|map|row)<(.*)>", text):
        parts = _pieces(m[2])
        if m[1] == "row":
            named = [p.split("|", 1) for p in parts]
            if all(len(n) == 2 and n[0] for n in named):
                return LogicalType("row", children=tuple((n, _parse(t)) for n, t in named))
        elif len(parts) == {"array": 1, "map": 2}[m[1]]:
            return LogicalType(m[1], children=tuple((str(i), _parse(p)) for i, p in enumerate(parts)))
    raise ValueError(f"unsupported type: {text}")


def parse_physical(text: str) -> T.DataType:
    """The Spark type of a physical type string; string, varchar(n) and char(n) are strings, a bare decimal is rejected."""
    if text in PHYSICAL:
        return PHYSICAL[text]
    if re.fullmatch(r"(var)?char\(\d+\)", text):
        return T.StringType()
    if m := re.fullmatch(r"decimal\((\d+),(\d+)\)", text):
        return T.DecimalType(int(m[1]), int(m[2]))
    if m := re.fullmatch(r"(array|map|struct)<(.*)>", text):
        parts = _pieces(m[2])
        if m[1] == "array" and len(parts) == 1:
            return T.ArrayType(parse_physical(parts[0]))
        if m[1] == "map" and len(parts) == 2:
            return T.MapType(parse_physical(parts[0]), parse_physical(parts[1]))
        if m[1] == "struct" and all(":" in p for p in parts):
            return T.StructType([T.StructField(n, parse_physical(t)) for n, t in (p.split(":", 1) for p in parts)])
    raise ValueError(f"unsupported physical type: {text}")


def physical_of(kind: T.DataType) -> str:
    """The physical type string of a Spark type."""
    if isinstance(kind, T.ArrayType):
        return f"array<{physical_of(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{physical_of(kind.keyType)},{physical_of(kind.valueType)}>"
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"{f.name}:{physical_of(f.dataType)}" for f in kind) + ">"
    return {"smallint": "short", "timestamp_ntz": "timestamp-micros"}.get(kind.simpleString(), kind.simpleString())
