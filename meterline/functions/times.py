"""Timestamps of every accepted source type in the write precision, with the reason for refusal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.dialect import Dialect, Rejected
from meterline.settings import PRECISIONS

INVALID, NAIVE = "invalid_time", "naive_datetime"


def floor_div(x: Column, d: int) -> Column:
    """Floor division of longs (``div`` truncates toward zero)."""
    return x if d == 1 else F.call_function("div", x - F.pmod(x, F.lit(d).cast("long")), F.lit(d).cast("long"))


def unit_range(dialect: Dialect, precision: str) -> tuple[int, int]:
    d = PRECISIONS[precision]
    low, high = dialect.time_range
    return -(-low // d), high // d


def write_time(col: Column, kind: T.DataType, dialect: Dialect, precision: str, naive: str) -> tuple[Column, Column]:
    """(time in units of ``precision``, reject code); null times give null for both."""
    d = PRECISIONS[precision]
    low, high = dialect.time_range
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(kind, T.TimestampNTZType):
            if naive != "utc":
                raise Rejected(NAIVE, "a time column without a zone needs naive_datetime = 'utc'")
            # wall time read as UTC whatever the session's zone is
            micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
        else:
            micros = F.unix_micros(col)
        ns = F.try_multiply(micros, F.lit(1000).cast("long"))
        good = ns.between(low, high)
        return F.when(good, floor_div(ns, d)), F.when(col.isNotNull() & ~F.coalesce(good, F.lit(False)), F.lit(INVALID))
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        lo, hi = unit_range(dialect, precision)
        v = col.cast("long")
        return F.when(v.between(lo, hi), v), F.when(v.isNotNull() & ~v.between(lo, hi), F.lit(INVALID))
    if isinstance(kind, T.DecimalType) and kind.scale == 0:
        lo, hi = unit_range(dialect, precision)
        good = (col >= F.lit(lo).cast("decimal(20,0)")) & (col <= F.lit(hi).cast("decimal(20,0)"))
        return F.when(good, col.cast("long")), F.when(col.isNotNull() & ~good, F.lit(INVALID))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        ns = F.rint(col.cast("double") * 1e9)
        good = ~F.isnan(ns) & (ns > -(2.0**63)) & (ns < 2.0**63)
        long = F.when(good, ns.cast("long"))
        good = good & F.coalesce(long.between(low, high), F.lit(False))
        return F.when(good, floor_div(long, d)), F.when(col.isNotNull() & ~good, F.lit(INVALID))
    if isinstance(kind, T.StringType):
        return _iso(F.trim(col), col, dialect, d, naive)
    raise Rejected(INVALID, f"a column of type {kind.simpleString()} is no time")


def _iso(text: Column, raw: Column, dialect: Dialect, d: int, naive: str) -> tuple[Column, Column]:
    """ISO 8601: up to nine digits of a second after a point or comma, offset required unless by policy."""
    shape = r"^(\d{4}-?\d{2}-?\d{2})(?:[T ](\d{2}(?::?\d{2}(?::?\d{2})?)?)(?:[.,](\d+))?)?(Z|z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?$"
    at = [F.regexp_extract(text, shape, i) for i in range(5)]
    clock = F.rpad(F.regexp_replace(at[2], ":", ""), 6, "0")
    day = F.regexp_replace(at[1], "-", "")
    stamp = F.try_to_timestamp(F.concat(day, F.lit(" "), clock, F.lit(" +0000")), F.lit("yyyyMMdd HHmmss Z"))
    sign = F.when(F.startswith(at[4], F.lit("-")), -1).otherwise(1)
    digits = F.rpad(F.regexp_replace(at[4], "[^0-9]", ""), 6, "0")
    num = lambda c: F.coalesce(c.try_cast("long"), F.lit(0).cast("long"))
    offset = sign * (num(digits.substr(1, 2)) * 3600 + num(digits.substr(3, 2)) * 60 + num(digits.substr(5, 2)))
    seconds = F.unix_seconds(stamp) - offset
    nanos = num(F.rpad(at[3].substr(1, 9), 9, "0"))
    ns = F.try_add(F.try_multiply(seconds, F.lit(10**9).cast("long")), nanos)
    low, high = dialect.time_range
    good = (at[0] != "") & stamp.isNotNull() & F.coalesce(ns.between(low, high), F.lit(False))
    bare = (at[0] != "") & stamp.isNotNull() & (at[4] == "")
    code = F.when(raw.isNull(), None)
    if naive != "utc":
        code = code.when(bare, F.lit(NAIVE))
        good = good & ~bare
    code = code.when(~F.coalesce(good, F.lit(False)), F.lit(INVALID))
    return F.when(good, floor_div(ns, d)), code
