"""Text of values as Spark columns: escapes, floats, assembled lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.functions.dialect import Dialect


def lit(text: str) -> Column:
    return F.lit(text)


def escape(col: Column, chars: str) -> Column:
    """A backslash before each of ``chars``: nested literal replaces, backslash first."""
    for c in sorted(chars, key=lambda c: c != "\\"):
        col = F.replace(col, lit(c), lit("\\" + c))
    return col


def escape_measurement(col: Column, dialect: Dialect) -> Column:
    return escape(col, dialect.measurement_escapes)


def escape_key(col: Column, dialect: Dialect) -> Column:
    return escape(col, dialect.key_escapes)


def quoted(col: Column) -> Column:
    return F.concat(lit('"'), escape(col, '\\"'), lit('"'))


def _let(name: str, value: str, use: str) -> str:
    """SQL of ``use`` with ``value`` computed once under ``name``."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def _rare_float_text() -> str:
    """SQL lambda: Python's text of a positive finite double whose cast has the form ``d.ddddE[-]x``.

    The cast's digits may be too many, or not the nearest of two; where a double is a whole
    number (1e16 to 1e37), its exact digits are taken instead.  Of each shorter rounding, the
    nearest that reads back as the same double wins.  Then the digits are laid out anew.
    """
    point = "named_struct('d', replace(substring_index(t, 'E', 1), '.', ''), 'e', cast(substring_index(t, 'E', -1) as int))"
    high = f"cast(floor(z / {2.0**60!r}D) as decimal(19,0))"
    whole = f"cast({high} * {1 << 60} + cast(z - floor(z / {2.0**60!r}D) * {2.0**60!r}D as bigint) as string)"
    exact = _let("t", whole, "named_struct('d', substring(t, 1, 18), 'e', length(t) - 1)")
    parts = f"CASE WHEN z >= 1e16D AND z < 1e37D THEN {exact} ELSE {_let('t', 'cast(z as string)', point)} END"
    number = _let("x", parts, "named_struct('n', cast(x.d as bigint), 'e', x.e + 1 - length(x.d))")
    shorter = ""
    for k in (3, 2, 1):  # the value is n * 10 ** e, n of 18 digits at most
        near = f"((x.n + {5 * 10 ** (k - 1)}) div {10**k})"
        other = f"(CASE WHEN x.n div {10**k} = {near} THEN {near} + 1 ELSE {near} - 1 END)"
        for m in (near, other):
            shorter += f" WHEN x.n >= {10**k} AND cast({m} || 'E' || (x.e + {k}) as double) = z THEN named_struct('n', {m}, 'e', x.e + {k})"
    short = _let("x", number, f"CASE{shorter} ELSE x END")
    # digits without closing zeros, exponent of the first one
    first = _let("x", short, "named_struct('d', rtrim('0', cast(x.n as string)), 'e', x.e + length(cast(x.n as string)) - 1)")
    laid = "CASE WHEN x.e BETWEEN 0 AND 15 THEN rpad(x.d, x.e + 1, '0') || '.' || CASE WHEN length(x.d) > x.e + 1 THEN substring(x.d, x.e + 2) ELSE '0' END"
    laid += " WHEN x.e BETWEEN -4 AND -1 THEN '0.' || repeat('0', -x.e - 1) || x.d"
    laid += " ELSE left(x.d, 1) || CASE WHEN length(x.d) > 1 THEN '.' || substring(x.d, 2) ELSE '' END || CASE WHEN x.e < 0 THEN 'e-' ELSE 'e+' END || lpad(abs(x.e), greatest(2, length(cast(abs(x.e) as string))), '0') END"
    return f"z -> {_let('x', first, laid)}"


_RARE = _rare_float_text()


def float_text(col: Column) -> Column:
    """Shortest text that reads back as the same double, in Python's form; all in the JVM.

    Within 1e-3 <= |v| < 1e7 (and for zeros) the cast gives that text; other values are
    rebuilt from their cast's digits.
    """
    common = (F.abs(col) >= 1e-3) & (F.abs(col) < 1e7) | (col == 0)
    odd = F.isnan(col) | (F.abs(col) == float("inf"))
    rare = F.get(F.call_function("transform", F.array(F.abs(col)), F.expr(_RARE)), F.lit(0))
    signed = F.concat(F.when(col < 0, lit("-")).otherwise(lit("")), rare)
    return F.when(common, col.cast("string")).when(odd, F.lower(F.regexp_replace(col.cast("string"), "inity", ""))).otherwise(signed)


def line_bytes(line: Column) -> Column:
    """UTF-8 bytes of a line with its newline."""
    return (F.octet_length(line) + 1).cast("long")


def runs_on(line: Column) -> Column:
    """``dialect.runs_on`` as a column: the pieces between quotes are folded in the JVM."""
    surplus = "(length(replace({0}, ',', '')) - length(replace({0}, '=', '')))"
    step = "(a, p) -> named_struct('i', NOT a.i AND a.n > 0, 'n', a.n + CASE WHEN NOT a.i AND a.n > 0 THEN 0 ELSE " + surplus.format("p") + " END, 'bad', a.bad OR NOT (NOT a.i AND a.n > 0) AND contains(p, '\n'))"
    start = "named_struct('i', false, 'n', " + surplus.format("x.p[0]") + ", 'bad', contains(x.p[0], '\n'))"
    fold = f"aggregate(slice(x.p, 2, size(x.p)), {start}, {step}, a -> a.bad OR a.i)"
    bare = F.regexp_replace(line, r"(?s)\\.", "")
    head = F.substring_index(bare, " ", 1)
    body = F.substring(bare, F.length(head) + 2, F.length(bare))
    pieces = F.struct(F.split(body, '"', -1).alias("p"))
    return F.endswith(bare, lit("\\")) | F.contains(head, lit("\n")) | F.get(F.call_function("transform", F.array(pieces), F.expr(f"x -> {fold}")), F.lit(0))
