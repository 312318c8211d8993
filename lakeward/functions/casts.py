"""Casts of text keys with the reference's (non-ANSI) reading, on an ANSI session.

On Spark 4 a plain ``cast`` of bad text raises and ``try_cast`` turns ``'1.0'`` into NULL; the
reference's runtime read integer ids leniently. ``to_int`` reproduces that reading with built-in
expressions only (no UDF), so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT_MIN, _INT_MAX = -(2 ** 31), 2 ** 31 - 1


def text_to_int(col: Column) -> Column:
    """Integer from text: optional sign, digits, optional ``.fraction`` that is dropped
    (``'1.0'`` -> 1, ``'-7.9'`` -> -7, ``'.'`` -> 0); blanks around are ignored; anything else,
    an empty text, a lone sign, or a value outside the int range gives NULL."""
    s = F.trim(col.cast("string"))
    well_formed = s.rlike(r"^[+-]?[0-9]*(\.[0-9]*)?$") & ~s.rlike(r"^[+-]?$")
    digits = F.regexp_extract(s, r"^[+-]?([0-9]*)", 1)
    magnitude = F.when(digits == F.lit(""), F.lit(0).cast("decimal(38,0)")).otherwise(
        digits.try_cast("decimal(38,0)"))
    signed = F.when(s.startswith("-"), -magnitude).otherwise(magnitude)
    return F.when(well_formed & signed.between(_INT_MIN, _INT_MAX), signed.cast("int"))


def to_int(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as int: lenient text reading for strings, ``try_cast`` otherwise."""
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, T.IntegerType):
        return c
    if isinstance(dtype, T.StringType):
        return text_to_int(c)
    return c.try_cast("int")
