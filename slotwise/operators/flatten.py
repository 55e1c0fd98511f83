"""Recursive flatten of nested documents.

Rounds repeat until no struct or array column is left. In each round every struct
column is replaced by its children (named ``parent_child``), appended at the end in
the order the structs appear, and every array column is exploded in place with
``explode_outer`` (a NULL or empty array keeps its row, with NULL). Several arrays in
one document therefore multiply: 2 members x 3 answers give 6 rows.

Everything is decided from the schema on the driver; the data are touched only by
the resulting projections and generators, which run per row inside the scan's tasks
(no shuffle). Maps are left as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions import quoted


class FlattenNameCollision(ValueError):
    pass


def _is_complex(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StructType, T.ArrayType))


def flatten_round(df: DataFrame, sep: str = "_") -> DataFrame:
    fields = df.schema.fields
    structs = [f for f in fields if isinstance(f.dataType, T.StructType)]
    arrays = [f.name for f in fields if isinstance(f.dataType, T.ArrayType)]
    if structs:
        kept = [f.name for f in fields if not isinstance(f.dataType, T.StructType)]
        names = set(kept)
        expanded = []
        for f in structs:
            for child in f.dataType.fieldNames():
                new = f"{f.name}{sep}{child}"
                if new in names:
                    raise FlattenNameCollision(f"flattened name {new!r} is produced twice")
                names.add(new)
                expanded.append(quoted(f.name, child).alias(new))
        df = df.select(*[quoted(n) for n in kept], *expanded)
    for name in arrays:
        # Spark allows one generator per projection: one select per array.
        df = df.withColumn(name, F.explode_outer(quoted(name)))
    return df


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Flatten ``df`` to a fixpoint (``df.transform(flatten)``); a schema is finite, so
    the rounds end."""
    while any(_is_complex(f.dataType) for f in df.schema.fields):
        df = flatten_round(df, sep)
    return df


def flattened_names(schema: T.StructType, sep: str = "_") -> list[str]:
    """The column names ``flatten`` produces for ``schema``, without touching data."""
    out: list[str] = []

    def walk(prefix: str, dt: T.DataType) -> None:
        while isinstance(dt, T.ArrayType):
            dt = dt.elementType
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(f"{prefix}{sep}{f.name}", f.dataType)
        else:
            out.append(prefix)

    for f in schema.fields:
        walk(f.name, f.dataType)
    return out
