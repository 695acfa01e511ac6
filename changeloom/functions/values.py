"""PostgreSQL values: text to Spark types, column by column, with the values that Spark's types can't hold told apart from errors.

Of each value there are three outcomes: a value; *unsupported* (infinite dates, NaN as decimal, BC dates): null, and a warning; *malformed*: an error that fails the query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type numbers of PostgreSQL's catalog; fixed values.
BOOL, BYTEA, CHAR, NAME, INT8, INT2, INT4, TEXT = 16, 17, 18, 19, 20, 21, 23, 25
JSON, FLOAT4, FLOAT8, BPCHAR, VARCHAR, DATE, TIME = 114, 700, 701, 1042, 1043, 1082, 1083
TIMESTAMP, TIMESTAMPTZ, NUMERIC, UUID, JSONB = 1114, 1184, 1700, 2950, 3802

PG_EPOCH_MICROS = 946684800000000
DATE_FORM = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_FORM = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,9})?$"
TIMESTAMPTZ_FORM = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,9})?([+-]\d{2}(:\d{2}(:\d{2})?)?|Z)$"
TIME_FORM = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,9})?$"


def typmod_precision(typmod: Column) -> Column:
    """Precision that a numeric's type modifier packs; null without one."""
    return F.when(typmod >= 4, F.shiftright(typmod - 4, 16).bitwiseAND(F.lit(65535)))


def typmod_scale(typmod: Column) -> Column:
    """Scale: the low 11 bits, signed."""
    return F.when(typmod >= 4, (typmod - 4).bitwiseAND(F.lit(2047)).bitwiseXOR(F.lit(1024)) - 1024)


def numeric_type(typmod: int, unconstrained: str = "string") -> T.DataType:
    """The Spark type of a numeric column: decimal where it fits; a negative scale widens the precision; text where Spark has no such decimal."""
    if typmod < 4:
        return T.DecimalType(38, 10) if unconstrained == "decimal" else T.StringType()
    packed = typmod - 4
    precision, scale = packed >> 16 & 0xFFFF, ((packed & 0x7FF) ^ 1024) - 1024
    if scale < 0:
        precision, scale = precision - scale, 0
    return T.DecimalType(precision, scale) if scale <= precision <= 38 else T.StringType()


def spark_type(oid: int, typmod: int = -1, unconstrained: str = "string") -> T.DataType:
    if oid == NUMERIC:
        return numeric_type(typmod, unconstrained)
    plain = {
        BOOL: T.BooleanType(), INT2: T.IntegerType(), INT4: T.IntegerType(), INT8: T.LongType(), FLOAT4: T.FloatType(), FLOAT8: T.DoubleType(),
        DATE: T.DateType(), TIMESTAMP: T.TimestampNTZType(), TIMESTAMPTZ: T.TimestampType(), BYTEA: T.BinaryType(),
    }
    return plain.get(oid, T.StringType())


def _number(text: Column, kind: str) -> Column:
    """Malformed integers fail the query."""
    value = text.try_cast(kind)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)).otherwise(value)


def _finite(text: Column, kind: str) -> Column:
    value = text.try_cast(kind)
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def typed(text: Column, oid: int, typmod: int = -1, unconstrained: str = "string") -> Column:
    """The value of one column from its text; null where it is unsupported."""
    kind = spark_type(oid, typmod, unconstrained)
    if oid == BOOL:
        return text == "t"
    if oid in (INT2, INT4, INT8):
        return _number(text, kind.simpleString())
    if oid in (FLOAT4, FLOAT8):
        return _finite(text, kind.simpleString())
    if oid == NUMERIC:
        usable = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text)
        return usable.try_cast(kind) if isinstance(kind, T.DecimalType) else usable
    if oid == DATE:
        return F.when(text.rlike(DATE_FORM), text).try_cast("date")
    if oid == TIME:
        return F.when(text.rlike(TIME_FORM), F.concat(F.substring(text, 1, 8), F.lit("."), F.rpad(F.substring(text, 10, 3), 3, "0")))
    if oid == TIMESTAMP:
        return F.when(text.rlike(TIMESTAMP_FORM), text).try_cast("timestamp_ntz")
    if oid == TIMESTAMPTZ:
        return F.when(text.rlike(TIMESTAMPTZ_FORM), text).try_cast("timestamp")
    if oid == UUID:
        return F.lower(text)
    if oid == BYTEA:
        return bytea(text)
    return text


def unsupported(text: Column, oid: int, typmod: int = -1, unconstrained: str = "string") -> Column:
    """Whether a value is there but has no Spark value."""
    return text.isNotNull() & typed(text, oid, typmod, unconstrained).isNull()


def bytea(text: Column) -> Column:
    r"""Hex form \x..; escape form: \\ and \ooo, all else as it stands. Malformed text fails the query."""
    hexed = F.when(text.rlike(r"^\\x([0-9A-Fa-f]{2})*$"), F.unhex(F.substr(text, F.lit(3))))
    part = r"(\\\\|\\[0-3][0-7]{2}|[^\\])"
    parts = F.regexp_extract_all(text, F.lit(part), F.lit(0))
    code = lambda x: F.conv(F.substr(x, F.lit(2)), 8, 16)
    as_hex = F.transform(parts, lambda x: F.when(x.startswith("\\\\"), F.lit("5C")).when(x.startswith("\\"), F.lpad(code(x), 2, "0")).otherwise(F.hex(x)))
    escaped = F.when(text.rlike(rf"^(?s:{part})*$"), F.unhex(F.array_join(as_hex, "")))
    value = F.when(text.startswith("\\x"), hexed).otherwise(escaped)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit("malformed bytea: "), text)).cast("binary")).otherwise(value)


def hex_fallback(raw: Column) -> Column:
    """Binary values of types without a mapping: \\x and lower-case hex."""
    return F.concat(F.lit("\\x"), F.lower(F.hex(raw)))


def pg_micros(micros: Column) -> Column:
    """Microseconds since 2000-01-01 -> timestamp."""
    return F.timestamp_micros(micros + F.lit(PG_EPOCH_MICROS))


def holds_text(oid: Column, typmod: Column, unconstrained: str = "string") -> Column:
    """Whether spark_type has text for a column of this type: the columns that may hold a placeholder."""
    p, scale = typmod_precision(typmod), typmod_scale(typmod)
    wide = F.when(scale < 0, p - scale).otherwise(p)
    as_decimal = F.when(typmod < 4, F.lit(unconstrained == "decimal")).otherwise((F.greatest(scale, F.lit(0)) <= wide) & (wide <= 38))
    return F.when(oid == NUMERIC, ~as_decimal).otherwise(~oid.isin(BOOL, INT2, INT4, INT8, FLOAT4, FLOAT8, DATE, TIMESTAMP, TIMESTAMPTZ, BYTEA))


def toast(kind: Column, text: Column, oid: Column | int, strategy: str = "null", placeholder: str = "__unchanged_toast_value__", typmod: Column | int = -1, unconstrained: str = "string") -> Column:
    """The text of a cell of kind n, t or u (unchanged, not sent): null or, for columns that are strings here, the placeholder. ``omit`` is null too: the key is left out by whoever builds the row."""
    if strategy not in ("null", "placeholder", "omit"):
        raise ValueError(f"unknown strategy {strategy}")
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    fill = F.when(holds_text(column(oid), column(typmod), unconstrained), F.lit(placeholder)) if strategy == "placeholder" else F.lit(None).cast("string")
    return F.when(kind == "u", fill).when(kind == "t", text)
