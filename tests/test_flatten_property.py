"""Property test: flatten on random nested schemas and data.

Expected row count per input row, by recursion on the value:
leaf -> 1; struct -> product over its fields (a NULL struct -> 1);
array -> sum over its elements (NULL or empty -> 1, the row explode_outer keeps).
"""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from slotwise.operators.flatten import flatten, flattened_names

_counter = iter(range(10**9))


def _name() -> str:
    return f"f{next(_counter)}"


def schemas(depth: int = 0) -> st.SearchStrategy[T.DataType]:
    leaf = st.just(T.LongType())
    if depth >= 2:
        return leaf
    child = st.deferred(lambda: schemas(depth + 1))
    struct = st.lists(child, min_size=1, max_size=3).map(
        lambda ts: T.StructType([T.StructField(_name(), t) for t in ts]))
    array = st.one_of(leaf, struct).map(T.ArrayType)
    return st.one_of(leaf, struct, array)


def values(dt: T.DataType) -> st.SearchStrategy:
    if isinstance(dt, T.StructType):
        inner = st.tuples(*[values(f.dataType) for f in dt.fields])
        return st.one_of(st.none(), inner)
    if isinstance(dt, T.ArrayType):
        return st.one_of(st.none(), st.lists(values(dt.elementType), max_size=2))
    return st.one_of(st.none(), st.integers(-5, 5))


def expected_rows(value, dt: T.DataType) -> int:
    if isinstance(dt, T.StructType):
        if value is None:
            return 1
        return math.prod(expected_rows(v, f.dataType) for v, f in zip(value, dt.fields))
    if isinstance(dt, T.ArrayType):
        if not value:
            return 1
        return sum(expected_rows(v, dt.elementType) for v in value)
    return 1


@st.composite
def tables(draw):
    top = draw(st.lists(schemas(), min_size=1, max_size=3))
    schema = T.StructType([T.StructField(f"c{i}", t) for i, t in enumerate(top)])
    rows = draw(st.lists(st.tuples(*[values(t) for t in top]), min_size=1, max_size=4))
    return schema, rows


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture,
                                                                 HealthCheck.too_slow])
@given(tables())
def test_flatten_row_count_and_names(spark, table):
    schema, rows = table
    flat = flatten(spark.createDataFrame(rows, schema))
    assert not any(isinstance(f.dataType, (T.StructType, T.ArrayType)) for f in flat.schema.fields)
    assert sorted(flat.columns) == sorted(flattened_names(schema))
    want = sum(math.prod(expected_rows(v, f.dataType) for v, f in zip(row, schema.fields)) for row in rows)
    assert flat.count() == want
