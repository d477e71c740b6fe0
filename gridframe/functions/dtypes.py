"""Value types: NumPy-style type strings and their NumPy, Arrow and Spark types.

Spark has no unsigned integers, so those are widened; unsigned 64-bit values are
decimals of 20 digits. Half-precision values become floats.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

#: Type names of format 3, without byte order.
V3_NAMES = {
    "bool": "b1", "int8": "i1", "int16": "i2", "int32": "i4", "int64": "i8", "uint8": "u1", "uint16": "u2",
    "uint32": "u4", "uint64": "u8", "float16": "f2", "float32": "f4", "float64": "f8",
}
#: Arrow and Spark types of the values by kind and width.
_TYPES = {
    "b1": (pa.bool_(), T.BooleanType()), "i1": (pa.int8(), T.ByteType()), "i2": (pa.int16(), T.ShortType()),
    "i4": (pa.int32(), T.IntegerType()), "i8": (pa.int64(), T.LongType()), "u1": (pa.int16(), T.ShortType()),
    "u2": (pa.int32(), T.IntegerType()), "u4": (pa.int64(), T.LongType()), "u8": (pa.decimal128(20, 0), T.DecimalType(20, 0)),
    "f2": (pa.float32(), T.FloatType()), "f4": (pa.float32(), T.FloatType()), "f8": (pa.float64(), T.DoubleType()),
}
_KINDS = {"i": "signed integer", "u": "unsigned integer", "b": "boolean", "f": "floating-point"}


@dataclass(frozen=True)
class ValueType:
    """`text` as stored, and what its values become."""

    text: str
    stored: np.dtype
    arrow: pa.DataType
    spark: T.DataType

    @property
    def kind(self) -> str:
        return self.stored.kind

    def to_arrow(self, values: np.ndarray) -> pa.Array:
        """Stored values (a flat array) as an Arrow array."""
        if self.kind == "b":
            return pa.array(values.view(np.uint8) != 0, pa.bool_())
        if self.text[1:] == "u8":
            return pa.array(values.astype("u8"), pa.uint64()).cast(pa.decimal128(20, 0))
        return pa.array(values.astype(self.arrow.to_pandas_dtype(), copy=False), self.arrow)


def parse(text: str) -> ValueType:
    """The type of a string like `<f8`; raises ValueError for others."""
    if len(text) < 3 or not text[2:].isdigit() or int(text[2:]) <= 0:
        raise ValueError(f"values of type {text!r} can't be read")
    mark, kind, width = text[0], text[1], int(text[2:])
    if mark not in "<>=|":
        raise ValueError(f"type {text!r} begins with none of the byte orders < > = |")
    if mark == "|" and width != 1:
        raise ValueError(f"type {text!r} has several bytes and no byte order")
    if kind not in _KINDS:
        raise ValueError(f"values of type {text!r} can't be read")
    if f"{kind}{width}" not in _TYPES:
        raise ValueError(f"{_KINDS[kind]} values of type {text!r} can't be read")
    return ValueType(text, np.dtype(text if kind != "b" else "u1"), *_TYPES[f"{kind}{width}"])


def v3_text(name: str, little: bool) -> str | None:
    """The type string of a format 3 name, or None."""
    short = V3_NAMES.get(name)
    return short and ("|" if short[1:] == "1" else "<" if little else ">") + short


def fill_of(value: object, kind: ValueType, array: str) -> np.ndarray:
    """A JSON fill value as one stored value; raises ValueError if the type can't hold it."""
    whole = isinstance(value, int) and not isinstance(value, bool)
    if kind.text[1] == "b":
        if not isinstance(value, bool) and not whole:
            raise ValueError(f"array {array} has booleans, but fill_value {value!r}")
        return np.array(bool(value), "u1")
    if kind.kind == "f":
        named = {"NaN": math.nan, "Infinity": math.inf, "-Infinity": -math.inf}
        if isinstance(value, str) and value in named:
            value = named[value]
        elif not whole and not isinstance(value, float):
            raise ValueError(f"array {array} has floating-point values, but fill_value {value!r}")
        return np.array(value, kind.stored)
    sign = "signed" if kind.kind == "i" else "unsigned"
    if not whole:
        raise ValueError(f"array {array} has {sign} integers, but fill_value {value!r}")
    if kind.kind == "u" and value < 0:
        raise ValueError(f"array {array} has unsigned integers, but fill_value {value}")
    limits = np.iinfo(kind.stored)
    if not limits.min <= value <= limits.max:
        raise ValueError(f"fill_value {value} of array {array} is beyond its {sign} integers")
    return np.array(value, kind.stored)


def literal(value: object) -> object:
    """A filter's literal as a number that compares with coordinates."""
    return int(value) if isinstance(value, Decimal) and value == value.to_integral_value() else value
