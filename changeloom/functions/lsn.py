"""Log positions: 64-bit numbers, written as two hex halves X/Y."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lsn_parse(text: Column) -> Column:
    """'X/Y' -> decimal(20,0); null where the text isn't of that form."""
    ok = text.rlike(r"^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")
    half = lambda k: F.conv(F.split_part(text, F.lit("/"), F.lit(k)), 16, 10).cast("decimal(20,0)")
    return F.when(ok, (half(1) * F.lit(4294967296).cast("decimal(20,0)") + half(2)).cast("decimal(20,0)"))


def lsn_format(number: Column) -> Column:
    """A bigint, taken as unsigned, -> 'X/Y' in upper-case hex without padding."""
    return F.concat(F.hex(F.shiftrightunsigned(number, 32)), F.lit("/"), F.hex(number.bitwiseAND(F.lit(4294967295))))


def lsn_diff(a: Column, b: Column) -> Column:
    """Bytes of log from b to a."""
    return a - b


def whole_mb(n: Column) -> Column:
    """Bytes as whole MB, towards zero, as warnings show them."""
    return ((n - n % F.lit(1048576)) / F.lit(1048576)).cast("long")


def unsigned32(n: Column) -> Column:
    """Ids that arrive as signed 32-bit numbers."""
    return n.cast("long").bitwiseAND(F.lit(4294967295))
