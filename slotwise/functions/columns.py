"""Column expressions shared by the operators. All are built-in Spark functions, so
they stay inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas as S


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(*path: str) -> Column:
    """Address a nested field by path; back-quotes keep dots inside names literal."""
    return F.col(".".join(f"`{p.replace('`', '``')}`" for p in path))


def channel_of(event_type_uri: str | Column,
               mapping: Mapping[str, str] = S.CHANNEL_URIS,
               default: str = "others") -> Column:
    """Map an event-type URI to its channel; unmapped and NULL URIs become ``default``."""
    uri = col_of(event_type_uri)
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    expr = F.when(uri == items[0][0], F.lit(items[0][1]))
    for key, channel in items[1:]:
        expr = expr.when(uri == key, F.lit(channel))
    return expr.otherwise(F.lit(default))


def as_timestamp(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """A timestamp from a typed timestamp or from ISO text.

    Text that does not parse gives NULL instead of failing the job (ANSI mode makes a
    plain cast raise).
    """
    column = col_of(c)
    if dtype is None or isinstance(dtype, T.StringType):
        return F.try_to_timestamp(column)
    return column


def employee_id(user_uri: str | Column) -> Column:
    """Group 1 of ``users/<id>``: no match gives '', NULL stays NULL."""
    return F.regexp_extract(col_of(user_uri), S.USER_ID_PATTERN, 1)


def invitee_id_of(invitee_uri: str | Column) -> Column:
    return F.regexp_extract(col_of(invitee_uri), S.INVITEE_ID_PATTERN, 1)


def day_name(day_number: str | Column) -> Column:
    """1 = Sunday ... 7 = Saturday; any other number gives NULL."""
    pairs = []
    for i, name in enumerate(S.DAY_NAMES, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.try_element_at(F.create_map(*pairs), col_of(day_number).cast("int"))


def guarded_ratio(numerator: str | Column, denominator: str | Column,
                  zero_value: float | None = 0.0) -> Column:
    """numerator / denominator, with ``zero_value`` when the denominator is 0."""
    num, den = col_of(numerator), col_of(denominator)
    fallback = F.lit(zero_value).cast("double") if zero_value is not None else F.lit(None).cast("double")
    return F.when(den == 0, fallback).otherwise(num.cast("double") / den.cast("double"))


def category_position(c: str | Column, order: Sequence[str]) -> Column:
    """1-based position in ``order``; values outside it give NULL (sort them last)."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in order]), col_of(c)),
                    F.lit(0)).cast("int")


def exact_sum(c: str | Column, scale: int = 10) -> Column:
    """Sum money through DECIMAL so the total does not depend on row order. Ten decimal
    places keep amounts far below a cent; 18 digits stand before the point."""
    return F.sum(col_of(c).cast(T.DecimalType(18 + scale, scale))).cast("double")


def iso_utc_text(ts: str | Column) -> Column:
    """ISO-8601 text with microseconds and a Z suffix (as webhook payloads carry)."""
    return F.date_format(col_of(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_local_text(ts: str | Column) -> Column:
    return F.date_format(col_of(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
