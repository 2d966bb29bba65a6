"""Tag injection compiled to columns: base tags, rules, enrichers."""

from __future__ import annotations

import contextlib
import contextvars
import re
import string
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.functions.text import float_text
from meterline.settings import Predicate, TagRule

_context: contextvars.ContextVar[dict] = contextvars.ContextVar("meterline_tags", default={})


@contextlib.contextmanager
def tag_context(**tags) -> Iterator[dict]:
    """Tags for every write inside the block; inner blocks add to and override outer ones."""
    token = _context.set(_context.get() | tags)
    try:
        yield _context.get()
    finally:
        _context.reset(token)


def context_tags() -> dict:
    return dict(_context.get())


def tag_text(value) -> str:
    """Text of a tag given as a Python value; empty for None and NaN."""
    if value is None or value != value:
        return ""
    value = getattr(value, "value", value)
    return ("true" if value else "false") if isinstance(value, bool) else repr(value) if isinstance(value, float) else str(value)


def tag_column(col: Column, kind: str) -> tuple[Column, Column | None]:
    """(text or null where omitted, mask of invalid values) of a typed tag column."""
    if kind == "float":
        v = col.cast("double")
        return float_text(F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)), F.abs(v) == float("inf")
    text = col.cast("string")
    text = F.when(text != "", text)
    bad = text.rlike("[\\x00-\\x1f\\x7f]") | F.endswith(text, F.lit("\\")) if kind == "string" else None
    return text, bad


def java_regex(pattern: str) -> tuple[str, dict[str, int]]:
    """A Python pattern for Java, and its named groups' positions (names are dropped)."""
    groups = dict(re.compile(pattern).groupindex)
    plain = re.sub(r"\(\?P<\w+>", "(", pattern)
    plain = re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\{groups[m[1]]}", plain)
    return "(?U)" + plain, groups


def holds(value: Column, kind: str, p: Predicate) -> Column:
    """A predicate on one typed field value; null values fail it."""
    parts: list[Column] = []
    number = kind in ("float", "integer", "uinteger")
    for name, op in (("gt", "__gt__"), ("ge", "__ge__"), ("lt", "__lt__"), ("le", "__le__")):
        if (x := getattr(p, name)) is not None:
            parts.append(getattr(value, op)(x) & (~F.isnan(value) if kind == "float" else F.lit(True)) if number else F.lit(False))

    def equal(x) -> Column:
        if isinstance(x, str):
            return value == x if kind == "string" else F.lit(False)
        if kind == "string":
            return F.lit(False)
        return (value.cast("int") if kind == "boolean" else value) == (int(x) if isinstance(x, bool) else x)

    if p.eq is not None:
        parts.append(equal(p.eq))
    if p.ne is not None:
        parts.append(~F.coalesce(equal(p.ne), F.lit(False)) & value.isNotNull())
    if p.in_ is not None:
        parts.append(F.coalesce(*(F.when(equal(x), True) for x in p.in_), F.lit(False)) if p.in_ else F.lit(False))
    if p.regex is not None:
        parts.append(value.rlike(java_regex(p.regex)[0]) if kind == "string" else F.lit(False))
    out = F.lit(True)
    for c in parts:
        out = out & F.coalesce(c, F.lit(False))
    return out


def _formatted(template: str, names: list[str]):
    @F.pandas_udf("string")
    def run(values: pd.DataFrame) -> pd.Series:
        def one(row):
            try:
                groups = {n[1:]: v for n, v in zip(names, row, strict=True) if n[0] == "g" and v is not None}
                tags = {n[1:]: v for n, v in zip(names, row, strict=True) if n[0] == "t" and v is not None}
                fields = {n[1:]: v for n, v in zip(names, row, strict=True) if n[0] == "f" and v is not None}
                return template.format(tags=tags, fields=fields, **groups)
            except (KeyError, IndexError, ValueError, AttributeError):
                return None

        return pd.Series([one(r) for r in values.itertuples(index=False, name=None)], dtype=object)

    return run


def template(text: str, groups: dict[str, Column], measurement: str, tags: dict[str, Column], fields: dict[str, tuple[Column, str]]) -> Column:
    """Text of a template; null where something that it names is missing."""
    parts: list[Column] = []
    for literal, name, spec, conversion in string.Formatter().parse(text):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if spec or conversion or "." in name:
            known = {"gmeasurement": F.lit(measurement)} | {f"g{k}": v for k, v in groups.items()} | {f"t{k}": v for k, v in tags.items()} | {f"f{k}": v for k, (v, _) in fields.items()}
            return _formatted(text, list(known))(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(known.values()))))
        if m := re.fullmatch(r"(tags|fields)\[([^\]]+)\]", name):
            if m[1] == "tags":
                parts.append(tags.get(m[2], F.lit(None).cast("string")))
            else:
                value, kind = fields.get(m[2], (F.lit(None).cast("string"), "string"))
                parts.append(float_text(value.cast("double")) if kind == "float" else F.initcap(value.cast("string")) if kind == "boolean" else value.cast("string"))
        elif name == "measurement":
            parts.append(F.lit(measurement))
        else:
            parts.append(groups.get(name, F.lit(None).cast("string")))
    return F.concat(*parts) if parts else F.lit("")


def merge(have: Column | None, new: Column, policy: str) -> tuple[Column, Column | None]:
    """(merged value, mask of conflicts): a null or empty value never blocks."""
    new = F.when(new != "", new)
    if have is None:
        return new, None
    if policy == "overwrite":
        return F.coalesce(new, have), None
    return F.coalesce(have, new), (have != new) if policy == "error" else None


def inject(tags: dict[str, Column], fields: dict[str, tuple[Column, str]], measurement: str, base: dict, context: dict, rules: tuple[TagRule, ...], conflict: str, bools: frozenset[str] = frozenset()) -> tuple[dict[str, Column], list[tuple[Column, str]]]:
    """Tags after base, context and rules in order, and the conflict masks with their keys."""
    tags, clashes = dict(tags), []
    for k, v in (base | context).items():
        text = tag_text(v)
        if text:
            tags[k], bad = merge(tags.get(k), F.lit(text), conflict)
            if bad is not None:
                clashes.append((bad, k))
    for rule in rules:
        groups: dict[str, Column] = {}
        when = F.lit(True)
        if rule.measurement is not None:
            m = re.search(rule.measurement, measurement)
            if not m:
                continue
            groups |= {k: F.lit(v) for k, v in m.groupdict().items() if v is not None}
        none = F.lit(None).cast("string")
        for k in rule.has_tags:
            when = when & tags.get(k, none).isNotNull()
        for k in rule.missing_tags:
            when = when & tags.get(k, none).isNull()
        for k in rule.has_fields:
            when = when & fields[k][0].isNotNull() if k in fields else F.lit(False)
        for k, p in rule.fields.items():
            when = when & holds(*fields[k], p) if k in fields else F.lit(False)
        for k, pattern in rule.tags.items():
            java, names = java_regex(pattern)
            value = tags.get(k, none)
            if k in bools:  # a boolean tag is matched as Python shows it
                value = F.initcap(value)
            when = when & F.coalesce(value.rlike(java), F.lit(False))
            for g, i in names.items():
                got = F.regexp_extract(value, java, i)
                groups[g] = F.coalesce(F.when(got != "", got), groups[g]) if g in groups else F.when(got != "", got)
        for k, text in rule.set.items():
            value = F.when(when, template(text, groups, measurement, tags, fields))
            tags[k], bad = merge(tags.get(k), value, rule.conflict)
            if bad is not None:
                clashes.append((bad, k))
    return tags, clashes


def enriched(fn: Callable[[str, dict, dict], dict | None], measurement: str, tags: dict[str, Column], fields: dict[str, tuple[Column, str]], adds: tuple[str, ...]) -> dict[str, Column]:
    """Tags that a Python callable returns (keys named in ``adds``), through an Arrow batch."""
    names, keys = list(tags), list(fields)

    @F.pandas_udf("map<string,string>")
    def run(values: pd.DataFrame) -> pd.Series:
        rows = values.itertuples(index=False, name=None)
        split = ((dict(zip(names, r, strict=False)), dict(zip(keys, r[len(names) :], strict=False))) for r in rows)
        got = (fn(measurement, {k: v for k, v in t.items() if v is not None}, f) or {} for t, f in split)
        return pd.Series([{k: tag_text(v) for k, v in g.items()} for g in got], dtype=object)

    cols = [c.alias(f"t{i}") for i, c in enumerate(tags.values())] + [c.alias(f"f{i}") for i, (c, _) in enumerate(fields.values())]
    got = run(F.struct(*cols))
    return tags | {k: F.coalesce(F.nullif(F.element_at(got, k), F.lit("")), tags.get(k, F.lit(None).cast("string"))) for k in adds}
