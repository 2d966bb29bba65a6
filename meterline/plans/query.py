"""Query front ends: SQL with ``$name`` parameters, an InfluxQL subset and a Flux subset, all as DataFrames."""

from __future__ import annotations

import re
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from datetime import UTC, datetime, timedelta
from functools import singledispatch
from typing import Any

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class QueryError(Exception):
    """A query that failed; ``kind`` is syntax, not_found, invalid, timeout or failed."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


class Result:
    """Rows of a query with the usual conversions; a thin wrapper over the DataFrame."""

    def __init__(self, df: DataFrame):
        self.df = df

    def arrow(self):
        return self.df.toArrow()

    def pandas(self):
        return self.df.toPandas()

    def dicts(self) -> list[dict]:
        return [r.asDict(recursive=True) for r in self.df.collect()]

    def __iter__(self) -> Iterator[dict]:
        return (r.asDict(recursive=True) for r in self.df.toLocalIterator(prefetchPartitions=True))

    def chunks(self, rows: int = 10_000) -> Iterator[list[dict]]:
        """Lists of at most ``rows`` rows, a partition at a time."""
        part: list[dict] = []
        for r in self:
            part.append(r)
            if len(part) == rows:
                yield part
                part = []
        if part:
            yield part


_SQL_TOKEN = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|\$([A-Za-z_]\w*)", re.S)


def bind_sql(text: str, params: Mapping[str, Any]) -> tuple[str, dict[str, Any]]:
    """Spark text and arguments: ``$name`` becomes ``:name`` and "name" a quoted identifier, outside of literals."""
    used: dict[str, Any] = {}

    def swap(m: re.Match) -> str:
        if m[1]:
            if m[1] not in params:
                raise QueryError("invalid", f"parameter ${m[1]} has no value")
            value = params[m[1]]
            if isinstance(value, datetime) and value.tzinfo is None:
                raise QueryError("invalid", f"parameter ${m[1]} needs a time zone")
            used[m[1]] = value.astimezone(UTC) if isinstance(value, datetime) else value
            return f":{m[1]}"
        if m[0][0] == '"':
            return "`" + m[0][1:-1].replace('""', '"').replace("`", "``") + "`"
        return m[0]

    return _SQL_TOKEN.sub(swap, text), used


# Characters that Flux strings escape.
_FLUX_ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"}


@singledispatch
def flux_literal(value) -> str:
    """A Python value as Flux source; values never become code."""
    raise ValueError(f"no Flux literal for {type(value).__name__}")


@flux_literal.register
def _(value: str) -> str:
    inside = "".join(_FLUX_ESCAPES.get(c, c) for c in value)
    return '"' + re.sub(r"\$(?=\{)", r"\\$", inside) + '"'


flux_literal.register(bool, lambda value: "true" if value else "false")
flux_literal.register(int, lambda value: f"{value:d}")
flux_literal.register(list, lambda value: f"[{', '.join(flux_literal(v) for v in value)}]")
flux_literal.register(tuple, lambda value: flux_literal(list(value)))
flux_literal.register(timedelta, lambda value: f"{value.days * 86_400_000_000 + value.seconds * 1_000_000 + value.microseconds}us")


@flux_literal.register
def _(value: float) -> str:
    if value - value != 0:
        raise ValueError("not a finite number")
    return f'float(v: "{value!r}")'


@flux_literal.register
def _(value: datetime) -> str:
    if value.utcoffset() is None:
        raise ValueError("a time parameter needs a zone")
    day = value.astimezone(UTC).replace(tzinfo=None).isoformat(timespec="microseconds")[:26]
    return f"{day}{getattr(value, 'nanosecond', 0):03d}Z"


@flux_literal.register
def _(value: Mapping) -> str:
    for k in value:
        if not (isinstance(k, str) and k.isascii() and k.isidentifier()):
            raise ValueError(f"not an identifier: {k!r}")
    return "{" + ", ".join(f"{k}: {flux_literal(v)}" for k, v in value.items()) + "}"


def bind_flux(text: str, params: Mapping[str, Any]) -> str:
    """``text`` with ``option params = {...}`` after its package clause and imports."""
    option = f"option params = {flux_literal(dict(params))}\n"
    lead = re.match(r'(?:(?:\s|//[^\n]*(?:\n|\Z))*(?:package\s+\w+|import\s+(?:\w+\s+)?"(?:[^"\\]|\\.)*"))*', text)
    end = lead.end() if lead else 0
    return f"{text[:end]}\n{option}{text[end:]}" if end else option + text


# Flux ------------------------------------------------------------------------------------------
_FLUX_TOKEN = re.compile(r'\s+|//[^\n]*|(?P<time>\d{4}-\d\d-\d\d(?:T[\d:.]+(?:Z|[+-]\d\d:\d\d))?)|(?P<dur>-?(?:\d+(?:ns|us|ms|mo|s|m|h|d|w|y))+)|(?P<num>-?\d+(?:\.\d+)?)|(?P<str>"(?:[^"\\]|\\.)*")|(?P<re>/(?:[^/\\\n]|\\.)+/)|(?P<id>[A-Za-z_]\w*)|(?P<op>\|>|=>|==|!=|>=|<=|=~|!~|[-+*/<>(){}\[\],:.=])')


class _Flux:
    """Recursive-descent evaluator of pipelines over an unpivoted source."""

    def __init__(self, text: str, source: Callable[[str], DataFrame], params: Mapping[str, Any], now: datetime, buckets: list[str]):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while at < len(text):
            m = _FLUX_TOKEN.match(text, at)
            if not m or m.end() == at:
                raise QueryError("syntax", f"cannot read Flux at {text[at : at + 20]!r}")
            if m.lastgroup == "re" and self.tokens and self.tokens[-1][1] not in ("=~", "!~"):
                raise QueryError("syntax", "a regular expression stands alone")
            if m.lastgroup:
                self.tokens.append((m.lastgroup, m[0]))
            at = m.end()
        self.at, self.source, self.params, self.now, self.buckets = 0, source, dict(params), now, buckets
        self.group: list[str] | None = None
        self.order: list[tuple[str, bool]] = []

    def peek(self, text: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][1] == text

    def take(self, text: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or text is not None and self.tokens[self.at][1] != text:
            raise QueryError("syntax", f"expected {text or 'more'} near {' '.join(t for _, t in self.tokens[max(0, self.at - 3) : self.at + 3])!r}")
        self.at += 1
        return self.tokens[self.at - 1]

    def run(self) -> DataFrame:
        while self.peek("import") or self.peek("package"):
            self.take()
            self.take()
        if self.peek("option"):
            for _ in range(3):
                self.take()
            self.params = self.value() | self.params
        name = self.take()[1]
        args = self.args()
        if name == "buckets":
            spark = SparkSession.active()
            df = spark.createDataFrame([(b,) for b in self.buckets], "name string")
        elif name == "from":
            df = self.source(args["bucket"])
        else:
            raise QueryError("invalid", f"no source {name}")
        while self.at < len(self.tokens):
            self.take("|>")
            df = self.step(df, self.take()[1])
        return df

    def args(self) -> dict:
        out: dict = {}
        self.take("(")
        while not self.peek(")"):
            key = self.take()[1]
            self.take(":")
            out[key] = self.value()
            if self.peek(","):
                self.take()
        self.take(")")
        return out

    def value(self):
        if self.peek("("):
            return self.function()
        if self.peek("["):
            self.take()
            out = []
            while not self.peek("]"):
                out.append(self.value())
                if self.peek(","):
                    self.take()
            self.take("]")
            return out
        if self.peek("{"):
            self.take()
            got = {}
            while not self.peek("}"):
                k = self.take()[1]
                self.take(":")
                got[k] = self.value()
                if self.peek(","):
                    self.take()
            self.take("}")
            return got
        kind, text = self.take()
        if kind == "str":
            return re.sub(r"\\(.)", lambda m: {"n": "\n", "r": "\r", "t": "\t"}.get(m[1], m[1]), text[1:-1])
        if kind == "num":
            return float(text) if "." in text else int(text)
        if kind == "dur":
            return _span(text)
        if kind == "time":
            t = datetime.fromisoformat(re.sub(r"(\.\d{6})\d+", r"\1", text.replace("Z", "+00:00")))
            return t if t.tzinfo else t.replace(tzinfo=UTC)
        if kind == "id":
            if text in ("true", "false"):
                return text == "true"
            if text == "now":
                self.take("(")
                self.take(")")
                return self.now
            if text == "params" and self.peek("."):
                self.take()
                name = self.take()[1]
                if name not in self.params:
                    raise QueryError("invalid", f"no parameter {name}")
                return self.params[name]
            if text in ("float", "int", "string", "time", "duration") and self.peek("("):
                v = self.args()["v"]
                return {"float": float, "int": int, "string": str}.get(text, lambda x: x)(v)
        raise QueryError("syntax", f"unexpected {text!r}")

    def function(self):
        self.take("(")
        self.take()
        self.take(")")
        self.take("=>")
        if self.peek("("):
            start = self.at
            self.take("(")
            if self.peek("{"):
                self.at = start + 1
                return self.record()
            self.at = start
        return self.condition()

    def record(self) -> dict:
        self.take("{")
        self.take()
        self.take()  # "r with"
        out = {}
        while not self.peek("}"):
            k = self.take()[1]
            self.take(":")
            out[k] = self.term()
            if self.peek(","):
                self.take()
        self.take("}")
        self.take(")")
        return out

    def condition(self):
        left = self.both()
        while self.peek("or"):
            self.take()
            left = left | self.both()
        return left

    def both(self):
        left = self.test()
        while self.peek("and"):
            self.take()
            left = left & self.test()
        return left

    def test(self):
        if self.peek("not"):
            self.take()
            return ~self.test()
        if self.peek("exists"):
            self.take()
            return self.term().isNotNull()
        if self.peek("("):
            self.take()
            got = self.condition()
            self.take(")")
            return got
        left, op = self.term(), self.take()[1]
        if op in ("=~", "!~"):
            hit = left.rlike(self.take()[1][1:-1].replace("\\/", "/"))
            return hit if op == "=~" else ~hit
        right = self.term()
        return {"==": left == right, "!=": left != right, ">": left > right, ">=": left >= right, "<": left < right, "<=": left <= right}[op]

    def term(self):
        if self.peek("r"):
            self.take()
            if self.peek("["):
                self.take()
                name = self.value()
                self.take("]")
            else:
                self.take(".")
                name = self.take()[1]
            return F.col(f"`{name}`")
        if self.peek("strings"):
            self.take()
            self.take(".")
            fn = self.take()[1]
            self.take("(")
            self.take("v")
            self.take(":")
            v = self.term()
            self.take(")")
            return {"toLower": F.lower, "toUpper": F.upper, "trimSpace": F.trim, "strlen": F.length}[fn](v)
        return F.lit(self.value())

    def _ordered(self, df: DataFrame) -> list:
        """The tables' last sort, as far as its columns are still there."""
        return [F.desc(c) if down else F.asc(c) for c, down in self.order if c in df.columns]

    def step(self, df: DataFrame, name: str) -> DataFrame:
        a = self.args()
        series = [c for c in df.columns if c not in ("_time", "_time_ns", "_value", "_start", "_stop")]
        keys = self.group if self.group is not None else series
        if name == "range":
            start, stop = self._moment(a["start"]), self._moment(a.get("stop", self.now))
            return df.where((F.col("_time_ns") >= start) & (F.col("_time_ns") < stop))
        if name == "filter":
            return df.where(a["fn"])
        if name == "map":
            return df.withColumns(a["fn"])
        if name == "pivot":
            rows = a["rowKey"]
            value, key = a["valueColumn"], a["columnKey"][0]
            own = [c for c in df.columns if c not in (key, value, "_time_ns", "_start", "_stop") or c in rows]
            names = [r[0] for r in df.select(key).distinct().orderBy(key).collect()]
            self.group = [c for c in own if c not in rows]
            return df.groupBy(*own).pivot(key, names).agg(F.first(value, ignorenulls=True))
        if name == "group":
            self.group = a.get("columns", [])
            return df
        if name in ("count", "sum", "mean", "min", "max", "first", "last"):
            c = F.col(f"`{a.get('column', '_value')}`")
            column = a.get("column", "_value")
            if name in ("first", "last"):
                pick = F.min_by if name == "first" else F.max_by
                extra = [x for x in ("_time",) if x in df.columns]
                return df.groupBy(*keys).agg(pick(c, F.col("_time_ns")).alias(column), *((F.min if name == "first" else F.max)(x).alias(x) for x in extra))
            return df.groupBy(*keys).agg({"count": F.count, "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}[name](c).alias(column))
        if name == "sort":
            cols = a.get("columns", ["_value"])
            self.order = [(c, bool(a.get("desc"))) for c in cols]
            return df.orderBy(*keys, *self._ordered(df))
        if name == "keep":
            self.group = [c for c in keys if c in a["columns"]]
            return df.select(*(c for c in df.columns if c in a["columns"]))
        if name == "drop":
            self.group = [c for c in keys if c not in a["columns"]]
            return df.drop(*a["columns"])
        if name == "rename":
            return df.withColumnsRenamed(a["columns"])
        if name == "limit":
            if not keys:
                return df.limit(a["n"])
            from pyspark.sql import Window

            w = Window.partitionBy(*keys).orderBy(*(self._ordered(df) or [c for c in ("_time_ns", "_time") if c in df.columns][:1] or [F.lit(1)]))
            return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= a["n"]).drop("_rank")
        if name == "distinct":
            return df.select(*keys, a.get("column", "_value")).distinct()
        if name == "yield":
            return df
        raise QueryError("invalid", f"no function {name}")

    def _moment(self, v) -> int:
        if isinstance(v, timedelta):
            v = self.now + v
        if isinstance(v, datetime):
            d = v - datetime(1970, 1, 1, tzinfo=UTC)
            return (d.days * 86400 + d.seconds) * 10**9 + d.microseconds * 1000
        return int(v) * 10**9


def _span(text: str) -> timedelta:
    unit = {"ns": 1e-9, "us": 1e-6, "ms": 1e-3, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800, "mo": 2592000, "y": 31536000}
    total = sum(float(n) * unit[u] for n, u in re.findall(r"(\d+)(ns|us|ms|mo|s|m|h|d|w|y)", text))
    return timedelta(seconds=-total if text.startswith("-") else total)


def unpivot(df: DataFrame, measurement: str, tags: list[str], fields: list[str], time_ns: str = "time_ns") -> DataFrame:
    """Wide points as Flux rows: _measurement, tags, _field, _value (common type), _time, _time_ns."""
    kinds = {c: k for c, k in df.dtypes if c in fields}
    common = next(iter(set(kinds.values()))) if len(set(kinds.values())) == 1 else "double" if all(k in ("double", "float", "int", "bigint", "decimal(20,0)") for k in kinds.values()) else "string"
    pairs = ", ".join(f"'{c}', cast(`{c}` as {common})" for c in fields)
    ns = F.col(time_ns)
    return df.select(F.lit(measurement).alias("_measurement"), *tags, ns.alias("_time_ns"), F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000))).alias("_time"), F.expr(f"stack({len(fields)}, {pairs}) as (_field, _value)")).where("_value is not null")


def flux(text: str, source: Callable[[str], DataFrame], params: Mapping[str, Any] | None = None, now: datetime | None = None, buckets: list[str] | None = None) -> DataFrame:
    """Runs a pipeline; ``source`` maps a bucket to its unpivoted points."""
    return _Flux(text, source, params or {}, now or datetime.now(UTC), buckets or []).run()


# InfluxQL --------------------------------------------------------------------------------------
def influxql_text(text: str) -> str:
    """The SQL of an InfluxQL SELECT: same clauses; a projection gains the leading time column, durations become intervals."""
    t = text.strip().rstrip(";")
    if re.match(r"(?i)show\s+measurements", t):
        return "SHOW TABLES"
    m = re.match(r"(?is)select\s+(.*?)\s+from\s+(.*)", t)
    if not m:
        raise QueryError("syntax", "only SELECT and SHOW MEASUREMENTS are understood")
    columns, rest = m[1], m[2]
    aggregate = re.search(r"(?i)\b(count|mean|sum|min|max|first|last|stddev|median)\s*\(", columns)
    columns = re.sub(r"(?i)\bmean\s*\(", "avg(", columns)
    columns = re.sub(r"(?i)\b(first|last)\s*\(([^)]*)\)", lambda g: f"{'min_by' if g[1].lower() == 'first' else 'max_by'}({g[2]}, time)", columns)
    if not aggregate and columns.strip() != "*" and not re.search(r"(?i)\btime\b", columns):
        columns = "time, " + columns
    units = {"u": "microsecond", "ms": "millisecond", "s": "second", "m": "minute", "h": "hour", "d": "day", "w": "week"}
    rest = re.sub(r"(?i)now\(\)\s*([-+])\s*(\d+)(ms|u|s|m|h|d|w)\b", lambda g: f"now() {g[1]} interval {g[2]} {units[g[3].lower()]}", rest)
    rest = re.sub(r"(?i)group by\s+time\((\d+)(s|m|h|d|w)\)", lambda g: f"group by window(time, '{g[1]} {units[g[2].lower()]}')", rest)
    rest = re.sub(r"=~\s*/((?:[^/\\]|\\.)*)/", lambda g: "rlike r'" + g[1] + "'", rest)
    return f"SELECT {columns} FROM {rest}"


# Dispatch --------------------------------------------------------------------------------------
def query(spark: SparkSession, text: str, language: str = "sql", params: Mapping[str, Any] | None = None, timeout: float | None = None, dialect: int = 3, source: Callable[[str], DataFrame] | None = None, now: datetime | None = None) -> Result:
    """Plans a query; with ``timeout`` it also runs it and cancels its jobs when time is up."""
    if (language == "flux") != (dialect == 2):
        hint = "Flux runs on dialect 2, SQL and InfluxQL on dialect 3"
        raise QueryError("invalid", f"{language} is not available: {hint}")
    try:
        if language == "flux":
            if source is None:
                raise QueryError("invalid", "Flux needs a source of buckets")
            df = flux(text, source, params, now)
        elif language in ("sql", "influxql"):
            if re.match(r"\s*(from|import)\b.*\|>", text, re.S):
                raise QueryError("syntax", "this looks like Flux; use language='flux' on dialect 2")
            body, args = bind_sql(influxql_text(text) if language == "influxql" else text, params or {})
            body = re.sub(r"(?i)\binformation_schema\.columns\b", "information_schema_columns", body)
            df = spark.sql(body, args=args)
        else:
            raise QueryError("invalid", f"no language {language!r}")
        if timeout is not None:
            df = _within(spark, df, timeout)
        return Result(df)
    except ParseException as e:
        raise QueryError("syntax", str(e)) from e
    except AnalysisException as e:
        kind = "not_found" if "NOT_FOUND" in str(e) or "UNRESOLVED" in str(e) else "invalid"
        raise QueryError(kind, str(e)) from e
    except PySparkException as e:
        raise QueryError("failed", str(e)) from e


def _within(spark: SparkSession, df: DataFrame, seconds: float) -> DataFrame:
    tag, late = f"meterline-{time.monotonic_ns()}", threading.Event()

    def stop():
        late.set()
        spark.interruptTag(tag)

    timer = threading.Timer(seconds, stop)
    spark.addTag(tag)
    timer.start()
    try:
        return spark.createDataFrame(df.toArrow())
    except Exception as e:
        raise QueryError("timeout", f"the query took more than {seconds} s") if late.is_set() else e
    finally:
        timer.cancel()
        spark.removeTag(tag)
