"""Value dictionaries of any size as one constant of the plan.

The entries travel as one text that is parsed once, when the plan is optimised: lists of entries by
a hash of the key.  A row hashes its value, takes the list and compares the few keys in it, so the
cost per row does not grow with the dictionary, and there is no join and no shuffle.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    FractionalType,
    IntegralType,
    NumericType,
    StringType,
)

from layerworks.config import ConfigError

#: Entries of a list, about.
PER_LIST = 4


def _plain_text(entry: Any) -> str:
    return str(entry).lower() if isinstance(entry, bool) else str(entry)


def _fraction(entry: Any) -> str:
    number = float(entry)
    if math.isnan(number):
        return '"NaN"'
    return repr(number) if math.isfinite(number) else f'"{"" if number > 0 else "-"}Infinity"'


def _as_json(entry: Any, kind: DataType, column: str) -> str:
    """A key or value as the column's type, in JSON; what does not fit is a ``ConfigError``."""
    if entry is None:
        return "null"
    try:
        if isinstance(kind, NumericType):
            if isinstance(entry, bool):
                raise ValueError
            if isinstance(kind, IntegralType):
                number = Decimal(str(entry))
                if number != number.to_integral_value():
                    raise ValueError
                return str(int(number))
            if isinstance(kind, DecimalType):
                return format(Decimal(str(entry)), "f")
            return _fraction(entry)
        if isinstance(kind, BooleanType):
            if not isinstance(entry, bool):
                raise ValueError
            return _plain_text(entry)
    except (ArithmeticError, TypeError, ValueError):
        raise ConfigError(f"mapping of {column}: {entry!r} is no {kind.simpleString()}") from None
    return json.dumps(_plain_text(entry))


def _place(key: str, kind: DataType, lists: int) -> int:
    """The list of a key given in JSON; the same as ``_place_of`` of the value."""
    value = json.loads(key)
    if isinstance(kind, NumericType):
        number = float(value) if isinstance(kind, FractionalType) else value
        whole = int(number) if math.isfinite(number) else 0
        return whole % lists if -(2**63) <= whole < 2**63 else 0
    return zlib.crc32(_plain_text(value).encode()) % lists


def _place_of(value: Column, kind: DataType, lists: int) -> Column:
    if isinstance(kind, NumericType):
        return F.coalesce(F.pmod(value.try_cast("long"), F.lit(lists)), F.lit(0)).cast("int")
    return F.pmod(F.crc32(value.cast("string").cast("binary")), F.lit(lists)).cast("int")


def replaced(value: Column, entries: Mapping[Any, Any], kind: DataType, column: str) -> Column:
    """The value by the dictionary; others, and null, stay.

    Keys and values take the type of the column, ``kind``.  A null key matches nothing and a null
    value leaves the value as it is.  Two keys that are equal as that type are a ``ConfigError``.
    """
    pairs = {}
    for key, item in entries.items():
        name = _as_json(key, kind, column)
        if name in pairs:
            raise ConfigError(f"mapping of {column}: {key!r} is given twice")
        pairs[name] = _as_json(item, kind, column)
    pairs.pop("null", None)
    if not pairs:
        return value
    # Other types are rare and their text form may differ, so they have one list.
    lists = max(1, len(pairs) // PER_LIST) if isinstance(kind, (NumericType, StringType, BooleanType, DateType)) else 1
    table: list[list[str]] = [[] for _ in range(lists)]
    for key, item in pairs.items():
        table[_place(key, kind, lists)].append(f'{{"k":{key},"v":{item}}}')
    text = "[" + ",".join(f"[{','.join(row)}]" for row in table) + "]"
    name = kind.simpleString()
    parsed = F.from_json(F.lit(text), f"array<array<struct<k:{name},v:{name}>>>")
    found = F.filter(F.get(parsed, _place_of(value, kind, lists)), lambda entry: entry["k"] == value)
    return F.coalesce(F.get(found, F.lit(0))["v"], value)
