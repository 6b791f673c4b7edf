"""Schema comparison. Field order never matters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .spec import RESERVED_COLS


def relaxed(dtype: T.DataType) -> T.DataType:
    """The type with every nested part nullable, as Parquet reads it."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(relaxed(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(relaxed(dtype.keyType), relaxed(dtype.valueType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, relaxed(f.dataType)) for f in dtype.fields])
    return dtype


def schema_differences(incoming: T.StructType, stored: T.StructType) -> list[str]:
    """What differs between two schemas, one line per field; empty when they agree."""
    new = {f.name: f.dataType for f in relaxed(incoming).fields}
    old = {f.name: f.dataType for f in relaxed(stored).fields}
    found = []
    for name in sorted(new.keys() | old.keys()):
        if name not in old:
            found.append(f"{name}: not in the table")
        elif name not in new:
            found.append(f"{name}: missing from the input")
        elif new[name] != old[name]:
            found.append(
                f"{name}: {new[name].simpleString()} in the input, "
                f"{old[name].simpleString()} in the table"
            )
    return found


def check_schema(df: DataFrame, stored: T.StructType) -> None:
    """Fail unless ``df`` has exactly the stored columns and types."""
    found = schema_differences(df.schema, stored)
    if found:
        raise ValueError("input does not fit the table: " + "; ".join(found))


def evolved_schema(incoming: T.StructType, stored: T.StructType | None) -> T.StructType:
    """The stored schema grown by new columns; a changed type is an error."""
    incoming = relaxed(incoming)
    reserved = [f.name for f in incoming.fields if f.name in RESERVED_COLS]
    if reserved:
        raise ValueError(f"reserved column names in the input (see drop_meta): {reserved}")
    if stored is None:
        return incoming
    old = {f.name: f.dataType for f in stored.fields}
    lower = {name.lower(): name for name in old}
    fields = list(stored.fields)
    for f in incoming.fields:
        if f.name not in old:
            if f.name.lower() in lower:
                raise ValueError(f"{f.name} differs from {lower[f.name.lower()]} only in case")
            fields.append(f)
        elif old[f.name] != f.dataType:
            raise ValueError(
                f"column {f.name} is {old[f.name].simpleString()} in the table "
                f"and {f.dataType.simpleString()} in the input"
            )
    return T.StructType(fields)
