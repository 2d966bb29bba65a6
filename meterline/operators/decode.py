"""Raw text to lines and lines to points, as columns where possible and Arrow batches where not."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.dialect import DIALECTS, LineError
from meterline.functions.text import runs_on
from meterline.plans.cluster import ship

FIELD = "struct<key:string,t:string,f:double,i:decimal(20,0),s:string,b:boolean>"
POINT = f"struct<measurement:string,tags:map<string,string>,fields:array<{FIELD}>,time:bigint,error:string>"


def split_lines(text: Column, dialect: int = 3) -> Column:
    """Array of a text's lines: quoted newlines stay, comments and blank lines go."""
    pattern = f"(?s)(#[^\\n]*+|{DIALECTS[dialect].line_regex})(?:\\n|\\z)"
    lines = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: F.regexp_replace(x, r"\r\z", ""))
    return F.filter(lines, lambda x: (x != "") & ~F.startswith(x, F.lit("#")))


def valid_utf8(data: Column) -> Column:
    return F.is_valid_utf8(data.cast("string"))


def explode_lines(df: DataFrame, text: str = "value", dialect: int = 3) -> DataFrame:
    """A row for each line: the frame's other columns, ``n`` (place in its text) and ``line``."""
    return df.select("*", F.posexplode(split_lines(F.col(text), dialect)).alias("n", "line")).drop(text)


def stamp_untimed(line: Column, now: int) -> Column:
    """Appends the time to lines without one; a backslash-escaped last space is kept."""
    body = F.regexp_replace(line, r"(?<!\\)[ \t]+$", "")
    return F.when(body.rlike(r"(^| )-?[0-9]+$"), line).otherwise(F.concat(body, F.lit(f" {now}")))


def run_on(line: Column) -> Column:
    """Whether a line would run on into the next; only lines with quotes or backslashes are looked through."""
    return F.when(line.contains('"') | line.contains("\\"), runs_on(line)).otherwise(F.coalesce(line.contains("\n"), F.lit(False)))


def parse_lines(df: DataFrame, line: str = "line", dialect: int = 3) -> DataFrame:
    """Adds ``point``: measurement, tags, ordered typed fields, time, or the reason why a line is none."""
    ship(df.sparkSession)

    @F.pandas_udf(POINT)
    def parse(v: pd.Series) -> pd.DataFrame:
        d, rows = DIALECTS[dialect], []
        for x in v:
            try:
                if x is None:
                    raise LineError("no line")
                name, tags, fields, at = d.parse(x)
                if at is not None and not -(2**63) <= at < 2**63:
                    raise LineError("timestamp out of range")
                made = []
                for k, value in fields:
                    kind = value[0] if isinstance(value, tuple) else {bool: "boolean", float: "float", str: "string"}[type(value)]
                    kind = {"i": "integer", "u": "uinteger"}.get(kind, kind)
                    n = value[1] if isinstance(value, tuple) else None
                    made.append({"key": k, "t": kind, "f": value if kind == "float" else None, "i": _decimal(n), "s": value if kind == "string" else None, "b": value if kind == "boolean" else None})
                rows.append((name, tags, made, at, None))
            except (LineError, ArithmeticError) as e:
                rows.append((None, None, None, None, str(e)))
        return pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype="Int64" if c == "time" else object) for i, c in enumerate(("measurement", "tags", "fields", "time", "error"))})

    return df.withColumn("point", parse(F.col(line)))


def _decimal(n: int | None):
    from decimal import Decimal

    if n is None:
        return None
    if not -(10**20) < n < 10**20:
        raise LineError("an integer is out of range")
    return Decimal(n)


def field(point: Column, key: str, kind: str) -> Column:
    """Value of one field of a parsed point (null if absent or of another type)."""
    member = {"float": "f", "integer": "i", "uinteger": "i", "string": "s", "boolean": "b"}[kind]
    got = F.element_at(F.filter(point["fields"], lambda x: (x["key"] == key) & (x["t"] == kind)), 1)[member]
    return F.when(F.size(F.filter(point["fields"], lambda x: (x["key"] == key) & (x["t"] == kind))) > 0, got)
