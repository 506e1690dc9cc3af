"""Filters given in prefix notation: @function(name,argc), @identifier(column), @literal(value).

A filter is translated straight to a Column, so Catalyst pushes it to the scan like any other.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conversions import DATE_PATTERNS, TIMESTAMP_PATTERNS, parse_date, parse_timestamp

COMPARISONS = {
    "equals": lambda a, b: a == b, "notEquals": lambda a, b: a != b, "less": lambda a, b: a < b,
    "lessOrEquals": lambda a, b: a <= b, "greater": lambda a, b: a > b, "greaterOrEquals": lambda a, b: a >= b,
}
#: Prefixes of typed literals.
WHOLE = ("UInt64_", "UInt128_", "UInt256_", "Int64_", "Int128_", "Int256_")
DECIMAL = ("Decimal32_", "Decimal64_", "Decimal128_", "Decimal256_")
FLOAT = ("Float64_",)
TEXTUAL = ("UUID_", "IPv4_", "IPv6_")
TOKEN = re.compile(r"""@(function|identifier|literal)\(((?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|\([^()]*\)|[^()'"])*)\)""", re.S)


class Untranslatable(ValueError):
    """The filter, or a part of it, can't be expressed."""


@dataclass(frozen=True)
class Filter:
    """condition: None if nothing could be translated. dropped: why each conjunct of the outermost `and` was left out."""

    condition: Column | None
    dropped: list[str] = field(default_factory=list)


def _tree(text: str) -> tuple:
    """Nested (kind, value, children) of the whole text."""
    tokens, at = [], 0
    for m in TOKEN.finditer(text):
        if m.start() != at:
            break
        tokens.append((m[1], m[2].strip() if m[1] != "literal" else m[2]))
        at = m.end()
    if at != len(text) or not tokens:
        raise Untranslatable(f"can't be read from place {at}: {text[at : at + 40]!r}")
    rest = iter(tokens)

    def read() -> tuple:
        kind, value = next(rest, (None, None))
        if kind is None:
            raise Untranslatable("it ends too early")
        if kind != "function":
            return kind, value, []
        name, _, count = value.partition(",")
        if not count.strip().isdigit():
            raise Untranslatable(f"no number of arguments: {value}")
        return kind, name.strip(), [read() for _ in range(int(count))]

    tree = read()
    if next(rest, None):
        raise Untranslatable("it goes on after its end")
    return tree


def _unquoted(text: str) -> str:
    if len(text) >= 2 and text[0] == text[-1] and text[0] in "'\"":
        return re.sub(r"\\(.)", r"\1", text[1:-1])
    return text


#: Of each group of prefixes, how its numbers look.
SHAPES = {WHOLE: r"[+-]?\d+", FLOAT: r"(?i)[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d{1,9})?|[+-]?inf|nan", DECIMAL: r"[+-]?\d*\.?\d+"}
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType)
BITS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _number(text: str) -> Decimal | None:
    """What a literal of a numeric prefix stands for, exactly; None for other literals."""
    if text in ("-Inf", "+Inf"):
        return Decimal(text)
    for prefixes, shape in SHAPES.items():
        for prefix in prefixes:
            if text.startswith(prefix):
                number = _unquoted(text[len(prefix) :])
                if not re.fullmatch(shape, number):
                    raise Untranslatable(f"not a number of its kind: {text}")
                return Decimal(repr(float(number)) if prefixes is FLOAT else number)
    return None


def _stored(number: Decimal, kind: T.DataType) -> Column | None:
    """The number as a value of a numeric type; None if the type doesn't hold it."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.lit(float(number)).cast(kind)
    least, most, scale = _range(kind)
    if not number.is_finite() or number.adjusted() > 40:
        return None
    ticks = Fraction(number) * 10**scale
    return _ticks(int(ticks), kind) if ticks.denominator == 1 and least <= ticks <= most else None


def _range(kind: T.DataType) -> tuple[int, int, int]:
    """The least and the greatest value of an exact type, in its smallest unit, and the decimal places of that."""
    if isinstance(kind, T.DecimalType):
        return 1 - 10**kind.precision, 10**kind.precision - 1, kind.scale
    return -(1 << BITS[type(kind)]), (1 << BITS[type(kind)]) - 1, 0


def _ticks(n: int, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return F.lit(Decimal((int(n < 0), tuple(map(int, str(abs(n)))), -kind.scale))).cast(kind)
    return F.lit(n).cast(kind)


def _compared(name: str, column: Column, kind: T.DataType, number: Decimal) -> Column:
    """A comparison by value: nothing is rounded to the column's type, and nothing overflows when it runs.

    Where the type doesn't hold the number, the comparison is with the next value that it holds (x < 2.5 is x <= 2), or is
    settled: false, or true for all that is not null. Either way the column stands alone, so the scan can use it.
    """
    value = _stored(number, kind)
    if value is not None:
        return COMPARISONS[name](column, value)
    if name in ("equals", "notEquals"):
        return F.lit(False) if name == "equals" else column.isNotNull()
    least, most, scale = _range(kind)
    if number.is_finite() and number.adjusted() <= 40:
        below = math.floor(Fraction(number) * 10**scale)  # the greatest value under the number
    else:
        below = least - 1 if number < 0 else most  # NaN is greater than all numbers
    if name in ("less", "lessOrEquals"):
        return F.lit(False) if below < least else column.isNotNull() if below >= most else column <= _ticks(below, kind)
    return column.isNotNull() if below < least else F.lit(False) if below >= most else column >= _ticks(below + 1, kind)


def _literal(text: str, kind: T.DataType, precision: int) -> Column | Decimal:
    """A literal: a number for numeric columns, else a value of the column's type, by which text is read."""
    if text == "NULL":
        return F.lit(None).cast(kind)
    number = _number(text)
    if number is not None:
        if isinstance(kind, NUMBERS):
            return number
        if isinstance(kind, T.BooleanType) and text.startswith(WHOLE):
            return F.lit(number != 0)
        if isinstance(kind, T.StringType):
            return F.lit(_unquoted(text.partition("_")[2] or text))
        raise Untranslatable(f"a number can't be compared with {kind.simpleString()}: {text}")
    for prefix in TEXTUAL:
        if text.startswith(prefix):
            return F.lit(_unquoted(text[len(prefix) :]))
    value = _unquoted(text)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(value).cast(kind)
    if isinstance(kind, T.DateType):
        if not re.fullmatch(r"\d{4}-\d\d-\d\d|\d{8}", value) or not _exists(value[:4], *re.findall(r"\d\d", value[4:])):
            raise Untranslatable(f"a date must look like one of {DATE_PATTERNS}: {value}")
        return parse_date(F.lit(value))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        shape = TIMESTAMP_PATTERNS[precision]
        if not re.fullmatch(re.sub(r"[a-zA-Z]", r"\\d", shape.replace(".", r"\.")), value) or not _exists(*re.findall(r"\d+", value)[:6]):
            raise Untranslatable(f"a timestamp must look like {shape}: {value}")
        return parse_timestamp(F.lit(value), precision).cast(kind)
    raise Untranslatable(f"text can't be compared with {kind.simpleString()}")


def _exists(*parts: str) -> bool:
    try:
        return bool(dt.datetime(*map(int, parts)))
    except ValueError:
        return False


def _cast(value: str, to: str) -> Column:
    """A number as a date (days), a date and time (seconds) or one with fractions (ms, or decimal seconds)."""
    number, to = _unquoted(re.sub(r"^[A-Za-z]+\d+_", "", value)), re.sub(r"\(\d+\)", "", _unquoted(to))
    if not re.fullmatch(r"[+-]?\d{1,18}(\.\d+)?", number) or "." in number and not (to == "DateTime64" and value.startswith(DECIMAL)):
        raise Untranslatable(f"cast of {value} to {to}")
    # Spark's dates and times end in the year 9999; what lies beyond is refused here, not when it runs.
    days = Decimal(number) / {"Date": 1, "Date32": 1, "DateTime": 86_400}.get(to, 86_400 if value.startswith(DECIMAL) else 86_400_000)
    if not -719_162 <= days < 2_932_897:
        raise Untranslatable(f"no date: cast of {value} to {to}")
    if to in ("Date", "Date32"):
        return F.date_from_unix_date(F.lit(int(number)))
    if to == "DateTime":
        return F.timestamp_seconds(F.lit(int(number))).cast("timestamp_ntz")
    if to == "DateTime64":
        if value.startswith(DECIMAL):
            whole, _, fraction = number.partition(".")
            micros = int(fraction.ljust(6, "0")[:6]) * (-1 if number.startswith("-") else 1)
            return F.timestamp_micros(F.lit(int(whole) * 1_000_000 + micros)).cast("timestamp_ntz")
        return F.timestamp_millis(F.lit(int(number))).cast("timestamp_ntz")
    raise Untranslatable(f"cast to {to}")


class _Translation:
    def __init__(self, schema: T.StructType) -> None:
        self.fields = {f.name: f for f in schema}

    def column(self, node: tuple) -> tuple[Column, T.StructField]:
        if node[0] != "identifier" or node[1] not in self.fields:
            raise Untranslatable(f"no column: {node[1]}")
        return F.col(f"`{node[1]}`"), self.fields[node[1]]

    def value(self, node: tuple, of: T.StructField) -> Column | Decimal:
        declared = re.search(r"TIMESTAMP\((\d)\)", of.metadata.get("declared_type", ""))
        if node[0] == "literal":
            return _literal(node[1], of.dataType, int(declared[1]) if declared else 6)
        if node[0] == "function" and node[1] == "cast" and [c[0] for c in node[2]] == ["literal"] * 2:
            return _cast(node[2][0][1], node[2][1][1])
        raise Untranslatable(f"a literal must stand on the right, not {node[1]}")

    def condition(self, node: tuple) -> Column:
        kind, name, args = node
        if kind != "function":
            raise Untranslatable(f"no condition: {name}")
        if name in ("and", "or") and args:
            return reduce(lambda a, b: a & b if name == "and" else a | b, map(self.condition, args))
        if name in COMPARISONS and len(args) == 2:
            column, of = self.column(args[0])
            value = self.value(args[1], of)
            return _compared(name, column, of.dataType, value) if isinstance(value, Decimal) else COMPARISONS[name](column, value)
        if name in ("in", "notIn") and len(args) == 2:
            column, of = self.column(args[0])
            if args[1][:2] != ("function", "tuple"):
                raise Untranslatable(f"{name} needs a tuple")
            if not args[1][2]:
                return F.lit(name == "notIn")
            values = [self.value(a, of) for a in args[1][2]]
            held = [_stored(v, of.dataType) if isinstance(v, Decimal) else v for v in values]
            held = [v for v in held if v is not None]  # a number that the type doesn't hold equals nothing
            if not held:
                return F.lit(False) if name == "in" else column.isNotNull()
            return column.isin(*held) if name == "in" else ~column.isin(*held)
        if name in ("isNull", "isNotNull") and len(args) == 1:
            column, _ = self.column(args[0])
            return column.isNull() if name == "isNull" else column.isNotNull()
        if name == "like" and len(args) == 2 and args[1][0] == "literal":
            column, of = self.column(args[0])
            pattern = _unquoted(args[1][1])
            if not isinstance(of.dataType, T.StringType) or not re.fullmatch(r"[^%_\\]+%", pattern):
                raise Untranslatable(f"only prefixes can be pushed: {pattern}")
            return column.startswith(pattern[:-1])
        raise Untranslatable(f"{name} with {len(args)} arguments")


def parse(text: str, schema: T.StructType, strict: bool = False) -> Filter:
    """The filter for rows of the schema.

    The outermost `and` is lenient: conjuncts that can't be translated are left out and told in `dropped`, so the filter
    keeps at least the rows that are asked for; anything else that fails leaves no filter. strict raises Untranslatable
    instead. Numbers are compared by their exact value, whatever the column's type holds (an INT column may be less than
    2.5, or equal to nothing); for FLOAT and DOUBLE columns they are rounded to that type first. Text takes the column's
    type. Comparisons are column on the left, literal on the right; comparisons with null keep no rows. `like` takes a
    prefix and one % at its end. Whatever can't be told from the text alone is refused here: no filter fails when it runs.
    """
    translation = _Translation(schema)
    try:
        tree = _tree(text)
    except Untranslatable as e:
        if strict:
            raise
        return Filter(None, [str(e)])
    kept, dropped = [], []
    for part in tree[2] if tree[:2] == ("function", "and") else [tree]:
        try:
            kept.append(translation.condition(part))
        except Untranslatable as e:
            if strict:
                raise
            dropped.append(str(e))
    return Filter(reduce(lambda a, b: a & b, kept) if kept else None, dropped)
