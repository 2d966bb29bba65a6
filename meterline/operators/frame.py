"""Typed DataFrames to lines: one measurement, columns in roles, all checks as columns of one plan."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions import coerce, text, times
from meterline.functions.dialect import DIALECTS, Rejected
from meterline.operators import rules
from meterline.settings import PRECISIONS, MeasurementSchema, Settings

REJECT = "struct<code:string,key:string,message:string>"
HEAD, BODY = "meterline head", "meterline body"


def roles(df: DataFrame, tags: str | Sequence[str], fields: str | Sequence[str] | None, time_column: str | None) -> tuple[list[str], list[str], str | None]:
    """(tag, field, time) columns: time is ``time`` or a datetime ``timestamp``, fields are the rest."""
    tags = [tags] if isinstance(tags, str) else list(tags)
    kinds = dict(df.dtypes)
    if time_column is None:
        time_column = "time" if "time" in kinds else "timestamp" if kinds.get("timestamp", "").startswith("timestamp") else None
    chosen = [fields] if isinstance(fields, str) else list(fields) if fields is not None else [c for c in df.columns if c not in tags and c != time_column]
    named = [*tags, *chosen, *([time_column] if time_column else [])]
    if missing := [c for c in named if c not in kinds]:
        raise ValueError(f"no such column: {', '.join(missing)}")
    if len(set(named)) < len(named):
        raise ValueError("a column has one role")
    if not chosen:
        raise ValueError("no field columns")
    return tags, chosen, time_column


def _first(checks: list[tuple[Column, Column | str, str | None]]) -> Column:
    """The first failing check as a struct, else null."""
    out = F.lit(None).cast(REJECT)
    made = [F.when(F.coalesce(bad, F.lit(False)), F.struct((F.lit(code) if isinstance(code, str) else code).alias("code"), F.lit(key).alias("key"), F.concat(F.lit(f"{key or 'record'}: "), F.lit(code) if isinstance(code, str) else code).alias("message")).cast(REJECT)) for bad, code, key in checks]
    return F.coalesce(*made, out) if made else out


def encode(
    df: DataFrame,
    measurement: str,
    tag_columns: str | Sequence[str] = (),
    field_columns: str | Sequence[str] | None = None,
    time_column: str | None = None,
    settings: Settings | None = None,
    types: dict[str, str] | None = None,
    tags: dict | None = None,
    now_ns: int | None = None,
    keep: Sequence[str] = (),
    enrichers: Sequence[tuple[Callable, tuple[str, ...]]] = (),
    with_series: bool = False,
) -> DataFrame:
    """``keep`` columns, ``line`` (null where rejected) and ``reject`` (null where accepted).

    ``types`` are types already locked for the measurement; declared ones win over them.
    Problems of a column raise :class:`Rejected` for the call, problems of values reject rows.
    Nothing here shuffles, and no step but enrichers leaves the JVM.
    """
    s = settings or Settings()
    d = DIALECTS[s.dialect]
    schema = s.measurements.get(measurement)
    if problem := d.name_problem(measurement, True):
        raise Rejected("invalid_name", f"measurement {measurement!r} {problem}", None, measurement)
    if schema is None and s.unknown_measurements == "reject":
        raise Rejected("unknown_measurement", f"measurement {measurement!r} is not declared", None, measurement)
    schema = schema or MeasurementSchema()
    tag_names, field_names, time_name = roles(df, tag_columns, field_columns, time_column)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    field_names = [c for c in field_names if not isinstance(kinds[c], T.NullType)]
    tag_names = [c for c in tag_names if not isinstance(kinds[c], T.NullType)]
    natural = {c: coerce.natural(kinds[c], s, c) for c in field_names}
    col = lambda c: F.col(f"`{c.replace('`', '``')}`")
    values = {c: (col(c).cast("double") if natural[c] == "float" else col(c), natural[c]) for c in field_names}

    checks: list[tuple[Column, Column | str, str | None]] = []
    made: dict[str, Column] = {}
    bad_tags: list[tuple[Column, Column | str, str | None]] = []
    bools = frozenset(c for c in tag_names if isinstance(kinds[c], T.BooleanType))
    for c in tag_names:
        made[c], bad = rules.tag_column(col(c), coerce.natural(kinds[c], s, c))
        if bad is not None:
            bad_tags.append((bad, "invalid_tag_value", c))
    made, clashes = rules.inject(made, values, measurement, s.base_tags(), rules.context_tags() | (tags or {}), s.rules, s.conflict, bools)
    for fn, adds in enrichers:
        made = rules.enriched(fn, measurement, made, values, adds)
    for k in made:
        if problem := d.name_problem(k):
            raise Rejected("invalid_name", f"tag {k!r} {problem}", k, measurement)
        if k in d.reserved_tags:
            raise Rejected("reserved_name", f"tag {k!r} is reserved", k, measurement)
        if d.exclusive_keys and k in natural:
            raise Rejected("tag_field_conflict", f"{k!r} is a tag and a field", k, measurement)
        if k not in tag_names:
            bad_tags.append((made[k].rlike("[\\x00-\\x1f\\x7f]") | F.endswith(made[k], F.lit("\\")), "invalid_tag_value", k))
    checks += [(bad, "tag_conflict", k) for bad, k in clashes]
    checks += bad_tags
    if schema.tags is not None:
        checks += [(made[k].isNotNull(), "unexpected_tag", k) for k in sorted(made) if k not in schema.tags]
    checks += [(made[k].isNull() if k in made else F.lit(True), "missing_tag", k) for k in schema.required_tags]

    texts: dict[str, Column] = {}
    for c in field_names:
        if problem := d.name_problem(c):
            raise Rejected("invalid_name", f"field {c!r} {problem}", c, measurement)
        if c in d.reserved_fields:
            raise Rejected("reserved_name", f"field {c!r} is reserved", c, measurement)
        if schema.extra_fields == "forbid" and c not in schema.fields:
            raise Rejected("unexpected_field", f"field {c!r} is not declared", c, measurement)
        target = schema.fields.get(c) or ((types or {}).get(c) if s.type_lock else None)
        texts[c], code = coerce.encode_value(natural[c], values[c][0], target, s)
        checks.append((code.isNotNull(), code, c))
    checks.append((F.col(BODY) == "", "no_fields", None))
    checks += [(texts[k].isNull() if k in texts else F.lit(True), "missing_field", k) for k in schema.required_fields]

    stamp: Column | None = None
    if time_name is not None:
        stamp, code = times.write_time(col(time_name), kinds[time_name], d, s.precision, s.naive_datetime)
        checks.append((code.isNotNull(), code, time_name))
    if s.auto_timestamp:
        now = (time.time_ns() if now_ns is None else now_ns) // PRECISIONS[s.precision]
        stamp = F.coalesce(stamp, F.lit(now).cast("long")) if stamp is not None else F.lit(now).cast("long")

    parts = [F.concat(F.lit("," + d.escape(k, d.key_escapes) + "="), text.escape_key(made[k], d)) for k in sorted(made)]
    head = F.concat_ws("", F.lit(d.escape(measurement, d.measurement_escapes)), *parts)
    body = F.concat_ws(",", *(F.concat(F.lit(d.escape(c, d.key_escapes) + "="), texts[c]) for c in field_names))
    line = F.concat_ws(" ", F.col(HEAD), F.col(BODY), *([stamp.cast("string")] if stamp is not None else []))
    if d.version == 2 and any("\\" in k for k in (measurement, *made, *field_names)):
        checks.append((text.runs_on(line), "invalid_name", None))
    reject = _first(checks)
    # both texts stand below the checks that use them, so they are made once a row
    made_once = df.select("*", head.alias(HEAD), body.alias(BODY))
    out = made_once.select(*(col(c) for c in keep), line.alias("line"), reject.alias("reject"), *([F.col(HEAD).alias("series")] if with_series else []))
    return out.withColumn("line", F.when(F.col("reject").isNull(), F.col("line")))


def locks_of(df: DataFrame, field_columns: Sequence[str], settings: Settings | None = None) -> dict[str, str]:
    """Types that a frame's columns lock once one of its rows is accepted."""
    s = settings or Settings()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return {c: coerce.locked_type(coerce.natural(kinds[c], s, c), s) for c in field_columns if not isinstance(kinds[c], T.NullType)}


def accepted(encoded: DataFrame) -> DataFrame:
    return encoded.where("reject is null")


def rejected_counts(encoded: DataFrame, measurement: str) -> DataFrame:
    """Rejected rows by code and key."""
    return encoded.where("reject is not null").groupBy(F.col("reject.code").alias("code"), F.lit(measurement).alias("measurement"), F.col("reject.key").alias("key")).agg(F.count("*").alias("n"))


def rejected_sample(encoded: DataFrame, order: Sequence[str], most: int = 1000) -> DataFrame:
    """The first ``most`` rejected rows by position (a distributed top-k)."""
    return encoded.where("reject is not null").orderBy(*order).limit(most)


def first_rejected(encoded: DataFrame, seq: str = "seq"):
    """The rejected row with the lowest position, or None."""
    row = encoded.where("reject is not null").agg(F.min_by(F.struct(F.col(seq), "reject"), F.col(seq)).alias("r")).first()
    return row["r"] if row else None
