"""The facade: write records, raw lines or DataFrames, query them back, all on Spark."""

from __future__ import annotations

import asyncio
import re
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.dialect import Rejected
from meterline.operators import frame
from meterline.operators import records as rec
from meterline.operators.rules import tag_context
from meterline.plans import query as q
from meterline.plans.store import PointStore
from meterline.settings import ALIASES, Settings

# How the servers word a conflict of field types (v2, v3).
CONFLICTS = (
    re.compile(r'input field "(?P<f>[^"]+)" on measurement "(?P<m>[^"]+)" is type \w+, already exists as type (?P<t>\w+)'),
    re.compile(r"invalid column type for column '(?P<f>[^']+)', expected iox::column_type::field::(?P<t>\w+)"),
)

__all__ = ["AsyncClient", "Client", "WriteResult", "tag_context"]


@dataclass
class WriteResult:
    points: int = 0
    dropped: int = 0
    bytes: int = 0
    seconds: float = 0.0
    rejected: list[dict] = field(default_factory=list)
    codes: dict[str, int] = field(default_factory=dict)


class Client:
    """``sink(lines)`` gets a DataFrame of accepted lines; the default counts them only."""

    def __init__(self, spark: SparkSession, settings: Settings | None = None, store: PointStore | None = None, sink=None):
        self.spark, self.settings, self.store = spark, settings or Settings(), store
        self.sink = sink or (lambda df: df.write.format("noop").mode("overwrite").save())
        self.types: dict[tuple[str, str], str] = {}
        #: names known as "tag" or "field" from accepted records
        self.keys: dict[tuple[str, str], str] = {}
        self.totals = {"written": 0, "dropped": 0, "bytes": 0, "writes": 0}

    def encode(self, data, measurement: str | None = None, tag_columns: Sequence[str] = (), field_columns=None, time_column=None, tags: dict | None = None) -> DataFrame:
        """seq, line, code, key, message of any input; locks nothing (``write`` does)."""
        if isinstance(data, DataFrame) or type(data).__module__.partition(".")[0] == "pandas":
            df = data if isinstance(data, DataFrame) else self._pandas(data)
            types = {k: v for (m, k), v in self.types.items() if m == measurement}
            df = df.withColumn("__seq", F.monotonically_increasing_id())
            names = [c for c in df.columns if c != "__seq"]
            chosen = frame.roles(df.select(*names), tag_columns, field_columns, time_column)
            out = frame.encode(df, measurement, *chosen, settings=self.settings, types=types, tags=tags, keep=("__seq",))
            self._roles = (df, chosen)
            return out.select(F.col("__seq").alias("seq"), F.lit(measurement).alias("measurement"), "line", "reject.code", "reject.key", "reject.message")
        with tag_context(**(tags or {})):
            return rec.encode_records(rec.records(self.spark, data), self.settings, self.types, keys=self.keys)

    def _pandas(self, pdf) -> DataFrame:
        if pdf.index.name is not None or pdf.index.dtype.kind == "M":
            pdf = pdf.reset_index(names=pdf.index.name or "time")
        return self.spark.createDataFrame(pdf)

    def write(self, data, measurement: str | None = None, **options) -> WriteResult:
        """Atomic for each call: with on_invalid = raise nothing is sent if a record is refused."""
        start = time.monotonic()
        out = self.encode(data, measurement, **options).persist()
        try:
            good = out.where("code is null and line is not null")
            got = good.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("line") + 1), F.lit(0))).first()
            bad = out.where("code is not null")
            codes = {r["code"]: r["n"] for r in bad.groupBy("code").agg(F.count("*").alias("n")).collect()}
            if codes and self.settings.on_invalid == "raise":
                r = bad.orderBy("seq").first()
                raise Rejected(r["code"], f"record {r['seq']}: {r['message']}", r["key"], r["measurement"])
            sample = [r.asDict() for r in bad.orderBy("seq").limit(1000).collect()] if codes else []
            self.sink(good.select("line"))
            if got[0]:
                self._lock(out, measurement)
            result = WriteResult(got[0], sum(codes.values()), got[1], time.monotonic() - start, sample, codes)
        finally:
            out.unpersist()
        for k, v in (("written", result.points), ("dropped", result.dropped), ("bytes", result.bytes), ("writes", 1)):
            self.totals[k] += v
        return result

    def _lock(self, out: DataFrame, measurement: str | None) -> None:
        """Keeps what accepted rows wrote: one row a name is collected."""
        if measurement is not None:
            df, (tags, names, _) = self._roles
            found = {(measurement, k): v for k, v in frame.locks_of(df, names, self.settings).items()} | {(measurement, k): "tag" for k in tags}
        else:
            rows = out.where("locks is not null").select(F.explode("locks").alias("x")).select("x.*").distinct().collect()
            found = {(r["measurement"], r["key"]): r["kind"] for r in rows}
        declared = {(m, k) for m, s in self.settings.measurements.items() for k in s.fields}
        for k, v in found.items():
            self.keys.setdefault(k, "tag" if v == "tag" else "field")
            if self.settings.type_lock and v not in ("tag", "field") and k not in declared:
                self.types.setdefault(k, v)

    def sync_schema(self) -> int:
        """Locks the types of the store's fields where nothing is locked yet; how many were new."""
        names = {"double": "float", "bigint": "integer", "decimal(20,0)": "uinteger", "string": "string", "boolean": "boolean"}
        new = {(m, k): names[t] for m, (_, fields) in (self.store.measurements() if self.store else {}).items() for k, t in fields.items()}
        fresh = {k: v for k, v in new.items() if k not in self.types}
        self.types |= fresh
        return len(fresh)

    def relock(self, measurement: str, key: str, kind: str) -> None:
        """A server's word on a field's type overrides a lock, never a declaration."""
        schema = self.settings.measurements.get(measurement)
        if not schema or key not in schema.fields:
            self.types[measurement, key] = kind

    def learn(self, messages: Iterable[str], measurement: str | None = None) -> None:
        """Relocks from a server's type-conflict messages; those of v3 name the field only, so the refused line's ``measurement`` is needed."""
        for text in messages:
            for pattern in CONFLICTS:
                m = pattern.search(text)
                name = m and (m.groupdict().get("m") or measurement)
                if name and m["t"] in ALIASES:
                    self.relock(name, m["f"], ALIASES[m["t"]])

    def locked_types(self) -> dict[tuple[str, str], str]:
        return dict(self.types)

    def query(self, text: str, language: str = "sql", params: dict[str, Any] | None = None, timeout: float | None = None) -> q.Result:
        if self.store:
            self.store.register()
        return q.query(self.spark, text, language, params, timeout, self.settings.dialect, self._bucket)

    def query_stream(self, text: str, language: str = "sql", params: dict[str, Any] | None = None, rows: int = 10_000):
        return self.query(text, language, params).chunks(rows)

    def _bucket(self, _: str) -> DataFrame:
        out = None
        for name, (tags, fields) in self.store.measurements().items():
            df = q.unpivot(self.store.read(name), name, tags, list(fields))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        if out is None:
            raise q.QueryError("not_found", "the bucket is empty")
        return out


class AsyncClient:
    """The same calls for asyncio: each runs in a worker thread."""

    def __init__(self, client: Client):
        self.client = client

    async def write(self, *a, **k) -> WriteResult:
        return await asyncio.to_thread(self.client.write, *a, **k)

    async def query(self, *a, **k) -> q.Result:
        return await asyncio.to_thread(self.client.query, *a, **k)
