"""The coercion matrix: (source kind, value, target type) to text and reject code, as columns.

Every bound is compared before a cast: Spark's own casts from double to long and from long to
double change values silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.dialect import EXACT, Rejected
from meterline.functions.text import float_text, quoted
from meterline.settings import Settings

CONFLICT, RANGE = "type_conflict", "out_of_range"


def natural(kind: T.DataType, settings: Settings, name: str = "") -> str:
    """Field type of a column's values; other columns refuse the whole call."""
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(kind, T.DecimalType) and (kind.precision, kind.scale) == (20, 0):
        return "uinteger"
    if isinstance(kind, (T.FloatType, T.DoubleType)) or isinstance(kind, T.DecimalType) and settings.coerce:
        return "float"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    raise Rejected("unsupported_type", f"column {name!r} of type {kind.simpleString()} is no field value", name)


def locked_type(kind: str, settings: Settings) -> str:
    """Type that a first value of ``kind`` locks."""
    return "float" if settings.int_as_float and kind == "integer" else kind


def encode_value(kind: str, v: Column, target: str | None, settings: Settings) -> tuple[Column, Column]:
    """(text, reject code): null text without a code means the field is left out."""
    goal = target or locked_type(kind, settings)
    null = F.lit(None).cast("string")
    forced = target in (None, "float") and settings.int_as_float and kind == "integer"
    if goal != kind and not settings.coerce and not forced:
        return null, F.when(v.isNotNull(), F.lit(CONFLICT))
    ok: Column = F.lit(True)
    code: Column = null
    if kind == "float":
        v = v.cast("double")
        finite = ~F.isnan(v) & (F.abs(v) != float("inf"))
        off = F.when(v.isNotNull() & ~finite, F.lit("non_finite")) if settings.non_finite == "error" else null
        if goal == "float":
            return F.when(finite, float_text(v)), off
        if goal in ("integer", "uinteger"):
            low, high = (-(2.0**63), 2.0**63) if goal == "integer" else (0.0, 2.0**64)
            whole = v == F.rint(v)
            fits = (v >= low) & (v < high)
            text = F.when(finite & whole & fits, v.cast("decimal(38,0)").cast("decimal(20,0)").cast("string"))
            bad = F.when(v.isNull(), None).when(~finite, off).when(~whole, F.lit(CONFLICT)).when(~fits, F.lit(RANGE))
            return F.concat(text, F.lit("i" if goal == "integer" else "u")), bad
        return null, F.when(v.isNull(), None).when(~finite, off).otherwise(F.lit(CONFLICT))
    if kind in ("integer", "uinteger"):
        if goal == "float":
            exact = F.abs(v.cast("decimal(38,0)")) <= F.lit(EXACT).cast("decimal(38,0)")
            code = F.when(v.isNotNull() & ~exact, F.lit(RANGE if forced else CONFLICT))
            return F.when(exact, float_text(v.cast("double"))), code
        if goal not in ("integer", "uinteger"):
            return null, F.when(v.isNotNull(), F.lit(CONFLICT))
        if kind == "integer" and goal == "uinteger":
            ok = v >= 0
        elif kind == "uinteger":
            top = "9223372036854775807" if goal == "integer" else "18446744073709551615"
            ok = (v >= 0) & (v <= F.lit(top).cast("decimal(20,0)"))
        text = F.concat(v.cast("string"), F.lit("i" if goal == "integer" else "u"))
        return F.when(ok, text), F.when(v.isNotNull() & ~ok, F.lit(RANGE))
    if goal != kind:
        return null, F.when(v.isNotNull(), F.lit(CONFLICT))
    if kind == "string":
        fits = F.octet_length(v) <= settings.max_string_bytes
        return F.when(fits, quoted(v)), F.when(v.isNotNull() & ~fits, F.lit("string_too_long"))
    return F.when(v, F.lit("true")).when(~v, F.lit("false")), code
