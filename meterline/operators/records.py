"""Heterogeneous records (dicts, points, typed models, raw lines) to lines, with type locks.

Records carry their position; a record is judged against locks made by accepted records
before it.  Measurements whose fields all come with one natural type (nearly all) need no
order: one distributed pass finds those types.  For the others, parallel rounds find the few
records at which their locks grow.  Every record is then encoded in parallel, by the locks
that stood before it.
"""

from __future__ import annotations

import decimal
import enum
import itertools
import math
import pickle
import re
import time
from bisect import bisect_left
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, is_dataclass
from datetime import UTC, date, datetime, timedelta
from typing import Annotated, Any, get_args, get_origin, get_type_hints

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.dialect import DIALECTS, EXACT, INT64, UINT64, LineError, Rejected, runs_on, stamped
from meterline.operators.rules import context_tags, tag_text
from meterline.plans.cluster import Scratch, ship
from meterline.settings import PRECISIONS, MeasurementSchema, Predicate, Settings, field_type


class UInt(int):
    """An integer written as unsigned."""


class Point:
    """A measurement with tags, fields and an optional time; compares by value."""

    __hash__ = None  # type: ignore[assignment]

    def __init__(self, measurement: str, tags: Mapping | None = None, fields: Mapping | None = None, time: Any = None):
        self.measurement, self.tags, self.fields, self.time = measurement, dict(tags or {}), dict(fields or {}), time

    def tag(self, key: str, value) -> Point:
        self.tags[key] = value
        return self

    def field(self, key: str, value) -> Point:
        self.fields[key] = value
        return self

    def at(self, time) -> Point:
        self.time = time
        return self

    def as_dict(self) -> dict:
        return {"measurement": self.measurement, "tags": self.tags, "fields": self.fields, "time": self.time}

    def __eq__(self, other) -> bool:
        return isinstance(other, Point) and self.as_dict() == other.as_dict()

    def __repr__(self) -> str:
        return f"Point({self.measurement!r}, {self.tags!r}, {self.fields!r}, {self.time!r})"


@dataclass(frozen=True)
class Tag:
    name: str | None = None


@dataclass(frozen=True)
class Field:
    name: str | None = None
    type: str | None = None


@dataclass(frozen=True)
class Timestamp:
    pass


def measurement(name: str, tags: Iterable[str] = (), timestamp: str | None = None):
    """Class decorator: declares which attributes are tags, fields and the time.

    Annotations may say the same: ``Annotated[str, Tag()]``, ``Annotated[int, Field("n", "uint")]``.
    """
    python = {float: "float", int: "integer", str: "string", bool: "boolean", UInt: "uinteger"}

    def mark(cls):
        if not is_dataclass(cls) and not hasattr(cls, "model_fields"):
            cls = dataclass(cls)
        spec: dict[str, tuple[str, str]] = {}
        types: dict[str, str] = {}
        for attr, hint in get_type_hints(cls, include_extras=True).items():
            marks: tuple = ()
            if get_origin(hint) is Annotated:
                hint, *rest = get_args(hint)
                marks = tuple(m() if isinstance(m, type) else m for m in rest)
            inner = [a for a in get_args(hint) if a is not type(None)]
            hint = inner[0] if inner and get_origin(hint) is not None and len(inner) == 1 else hint
            role = next((m for m in marks if isinstance(m, (Tag, Field, Timestamp))), None)
            if isinstance(role, Timestamp) or attr == timestamp:
                spec[attr] = "time", attr
            elif isinstance(role, Tag) or attr in tags:
                spec[attr] = "tag", (role.name if role and role.name else attr)
            else:
                key = role.name if isinstance(role, Field) and role.name else attr
                spec[attr] = "field", key
                kind = role.type if isinstance(role, Field) and role.type else python.get(hint)
                if kind:
                    types[key] = field_type(kind)
        cls.__meterline__ = name, spec, types
        return cls

    return mark


def _of_model(obj) -> dict:
    name, spec, types = type(obj).__meterline__
    out: dict = {"measurement": name, "tags": {}, "fields": {}, "time": None}
    for attr, (role, key) in spec.items():
        value = getattr(obj, attr)
        if role == "time":
            out["time"] = value
            continue
        if role == "field" and type(value) is int:  # a declared type comes before the value's own
            value = UInt(value) if types.get(key) == "uinteger" else float(value) if types.get(key) == "float" and abs(value) <= EXACT else value
        out[role + "s"][key] = value
    return out


class Encoder:
    """Row semantics of one settings object: unpack, tag, check, type and write one record at a time."""

    def __init__(self, settings: Settings, now_ns: int, types: dict[tuple[str, str], str] | None = None, tags: Mapping | None = None, keys: dict[tuple[str, str], str] | None = None):
        self.s, self.d, self.now = settings, DIALECTS[settings.dialect], now_ns
        self.unit = PRECISIONS[settings.precision]
        self.types = dict(types or {})
        self.keys: dict[tuple[str, str], str] = dict(keys or {})
        #: (key, role or type) of what the last accepted record wrote
        self.wrote: dict[tuple[str, str], str] = {}
        self.base = {k: v for k, v in (settings.base_tags() | dict(tags or {})).items() if tag_text(v)}

    # unpack ---------------------------------------------------------------------------------
    def unpack(self, r) -> tuple[Any, dict, dict, Any]:
        if isinstance(r, Point):
            r = r.as_dict()
        elif hasattr(type(r), "__meterline__"):
            r = _of_model(r)
        elif not isinstance(r, Mapping):
            raise Rejected("unsupported_record", f"a record of type {type(r).__name__}")
        if set(r) - {"measurement", "tags", "fields", "time"} or not {"measurement", "fields"} <= set(r):
            raise Rejected("malformed_record", "a record has measurement, tags, fields and time")
        tags, fields = r.get("tags"), r["fields"]
        if not isinstance(fields, Mapping) or not (tags is None or isinstance(tags, Mapping)):
            raise Rejected("malformed_record", "tags and fields are mappings")
        name = r["measurement"]
        return name.value if isinstance(name, enum.Enum) else name, dict(tags or {}), dict(fields), r.get("time")

    # values ---------------------------------------------------------------------------------
    def tag(self, key: str, value) -> str:
        if isinstance(value, enum.Enum):
            value = value.value
        if not isinstance(value, (str, bool, int, float)) and value is not None:
            item = getattr(value, "item", None)
            if not callable(item) or isinstance(value, (Mapping, list, tuple, bytes)):
                raise Rejected("invalid_tag_value", f"a tag of type {type(value).__name__}", key)
            value = item()
        if isinstance(value, float) and math.isinf(value):
            raise Rejected("invalid_tag_value", "a tag is not finite", key)
        text = tag_text(value)
        if text and self.d.name_problem(text):
            raise Rejected("invalid_tag_value", f"tag value {text!r} {self.d.name_problem(text)}", key)
        return text

    def natural(self, key: str, value) -> tuple[str, Any]:
        if isinstance(value, enum.Enum) and not isinstance(value, (int, str)):
            value = value.value
        if isinstance(value, bool):
            return "boolean", value
        if isinstance(value, UInt):
            return "uinteger", int(value)
        if isinstance(value, int):
            return "integer", int(value)
        if isinstance(value, float):
            return "float", float(value)
        if isinstance(value, str):
            return "string", str(value.value if isinstance(value, enum.Enum) else value)
        if isinstance(value, decimal.Decimal):
            if not self.s.coerce:
                raise Rejected("unsupported_type", "decimals need coerce", key)
            return "float", float(value)
        item = getattr(value, "item", None)
        if callable(item) and not isinstance(value, (Mapping, list, tuple, bytes)):
            return self.natural(key, item())
        raise Rejected("unsupported_type", f"a field of type {type(value).__name__}", key)

    def text(self, key: str, kind: str, value, target: str | None) -> str | None:
        s = self.s
        if kind == "float" and not math.isfinite(value):
            if s.non_finite == "error":
                raise Rejected("non_finite", "a field is not finite", key)
            return None
        forced = target in (None, "float") and s.int_as_float and kind == "integer"
        goal = target or ("float" if forced else kind)
        clash = Rejected("type_conflict", f"{kind} written to {goal}", key)
        if goal != kind:
            numbers = ("float", "integer", "uinteger")
            if kind not in numbers or goal not in numbers or not (s.coerce or forced):
                raise clash
            if kind == "float":
                if value != int(value):
                    raise clash
                value = int(value)
            elif goal == "float":
                if abs(value) > EXACT:
                    raise Rejected("out_of_range", "an integer is not exact as a float", key) if forced else clash
                value = float(value)
        if goal in ("integer", "uinteger"):
            low, high = INT64 if goal == "integer" else UINT64
            if not low <= value <= high:
                raise Rejected("out_of_range", f"{value} is no {goal}", key)
            return f"{value}{'i' if goal == 'integer' else 'u'}"
        if goal == "float":
            return repr(value)
        if goal == "boolean":
            return "true" if value else "false"
        try:
            long = len(value.encode()) > s.max_string_bytes
        except UnicodeEncodeError:
            raise Rejected("invalid_encoding", "a string is not valid Unicode", key) from None
        if long:
            raise Rejected("string_too_long", "a string is too long", key)
        return '"' + value.replace("\\", "\\\\").replace('"', '\\"') + '"'

    def time(self, value) -> int | None:
        if value is None:
            return self.now // self.unit if self.s.auto_timestamp else None
        low, high = self.d.time_range
        if isinstance(value, bool):
            raise Rejected("invalid_time", "a boolean is no time")
        if hasattr(value, "asm8") or type(value).__name__ == "datetime64":
            ts = pd.Timestamp(value)
            if ts is pd.NaT:
                raise Rejected("invalid_time", "not a time")
            ts = ts.tz_localize("UTC") if ts.tzinfo is None and (type(value).__name__ == "datetime64" or self.s.naive_datetime == "utc") else ts
            if ts.tzinfo is None:
                raise Rejected("naive_datetime", "a time without a zone")
            ns = ts.as_unit("ns").value
        elif isinstance(value, float):
            if not math.isfinite(value):
                raise Rejected("invalid_time", "a time is not finite")
            ns = round(value * 1e9)
        elif isinstance(value, int) or hasattr(value, "__index__"):
            n = int(value)
            if not -(-low // self.unit) <= n <= high // self.unit:
                raise Rejected("invalid_time", "a time is out of range")
            return n
        elif isinstance(value, datetime):
            ns = self._moment(value, 0)
        elif isinstance(value, str):
            ns = self._iso(value.strip())
        else:
            raise Rejected("invalid_time", f"a {'date' if isinstance(value, date) else type(value).__name__} is no time")
        if not low <= ns <= high:
            raise Rejected("invalid_time", "a time is out of range")
        return ns // self.unit

    def _iso(self, text: str) -> int:
        """ISO 8601 text; digits of a second beyond the ninth are cut off."""
        whole, mark, rest = text.replace(",", ".").partition(".")
        zone = rest.lstrip("0123456789")
        digits = rest[: len(rest) - len(zone)]
        try:
            if mark and not digits:
                raise ValueError
            moment = datetime.fromisoformat(whole + zone)
        except ValueError:
            raise Rejected("invalid_time", f"{text!r} is no ISO 8601 time") from None
        return self._moment(moment, int(f"{digits:0<9.9}"))

    def _moment(self, value: datetime, nanoseconds: int) -> int:
        if value.tzinfo is None and self.s.naive_datetime != "utc":
            raise Rejected("naive_datetime", "a time without a zone")
        since = (value if value.tzinfo else value.replace(tzinfo=UTC)) - EPOCH
        return since // timedelta(microseconds=1) * 1000 + nanoseconds

    # tags -----------------------------------------------------------------------------------
    def injected(self, name: str, tags: dict, fields: dict) -> dict:
        def put(key, value, policy):
            have = tags.get(key)
            if policy == "overwrite" or have is None or have == "":
                tags[key] = value
            elif policy == "error" and tag_text(have) != tag_text(value):
                raise Rejected("tag_conflict", f"tag {key!r} is set twice", key)

        for k, v in self.base.items():
            put(k, v, self.s.conflict)
        for rule in self.s.rules:
            groups: dict[str, str] = {}
            if rule.measurement is not None:
                m = re.search(rule.measurement, name)
                if not m:
                    continue
                groups |= {k: v for k, v in m.groupdict().items() if v is not None}
            if not all(k in tags for k in rule.has_tags) or any(k in tags for k in rule.missing_tags) or not all(k in fields for k in rule.has_fields):
                continue
            if not all(k in fields and _passes(fields[k], p) for k, p in rule.fields.items()):
                continue
            found = {k: re.search(p, str(tags[k])) if tags.get(k) is not None else None for k, p in rule.tags.items()}
            if not all(found.values()):
                continue
            for m in found.values():
                groups |= {k: v for k, v in m.groupdict().items() if v is not None}
            for k, text in rule.set.items():
                try:
                    put(k, text.format(measurement=name, tags=tags, fields=fields, **groups), rule.conflict)
                except (KeyError, IndexError, AttributeError, ValueError):
                    continue
        return tags

    # one record -----------------------------------------------------------------------------
    def record(self, r) -> tuple[str, str]:
        """(measurement, line) of one record; commits its locks only if it is accepted."""
        name, tags, fields, at = self.unpack(r)
        return name, self.line(name, tags, fields, at)

    def line(self, name, tags: dict, fields: dict, at) -> str:
        d, s = self.d, self.s
        if problem := d.name_problem(name, True):
            raise Rejected("invalid_name", f"measurement {name!r} {problem}")
        schema = s.measurements.get(name)
        if schema is None and s.unknown_measurements == "reject":
            raise Rejected("unknown_measurement", f"measurement {name!r} is not declared")
        schema = schema or MeasurementSchema()
        journal: dict[tuple[str, str], str] = {}
        keys: dict[tuple[str, str], str] = {}
        out = []
        for k, v in sorted(self.injected(name, tags, fields).items(), key=lambda kv: str(kv[0])):
            if problem := d.name_problem(k):
                raise Rejected("invalid_name", f"tag {k!r} {problem}", str(k))
            if k in d.reserved_tags:
                raise Rejected("reserved_name", f"tag {k!r} is reserved", k)
            text = self.tag(k, v)
            if not text:
                continue
            if d.exclusive_keys and self.keys.get((name, k)) == "field":
                raise Rejected("tag_field_conflict", f"{k!r} is a field", k)
            keys[name, k] = "tag"
            out.append((k, text))
        written = {k for k, _ in out}
        if schema.tags is not None and (extra := sorted(written - set(schema.tags))):
            raise Rejected("unexpected_tag", f"tag {extra[0]!r} is not declared", extra[0])
        if missing := [k for k in schema.required_tags if k not in written]:
            raise Rejected("missing_tag", f"tag {missing[0]!r} is required", missing[0])
        parts = []
        for k, v in fields.items():
            if problem := d.name_problem(k):
                raise Rejected("invalid_name", f"field {k!r} {problem}", str(k))
            if k in d.reserved_fields:
                raise Rejected("reserved_name", f"field {k!r} is reserved", k)
            if schema.extra_fields == "forbid" and k not in schema.fields:
                raise Rejected("unexpected_field", f"field {k!r} is not declared", k)
            if v is None:
                continue
            if d.exclusive_keys and (k in written or self.keys.get((name, k)) == "tag"):
                raise Rejected("tag_field_conflict", f"{k!r} is a tag", k)
            kind, v = self.natural(k, v)
            target = schema.fields.get(k) or (self.types.get((name, k)) if s.type_lock else None)
            text = self.text(k, kind, v, target)
            if text is None:
                continue
            if target is None and s.type_lock:
                journal[name, k] = "float" if s.int_as_float and kind == "integer" else kind
            keys[name, k] = "field"
            parts.append((k, text))
        if not parts:
            raise Rejected("no_fields", "nothing to write")
        got = {k for k, _ in parts}
        if missing := [k for k in schema.required_fields if k not in got]:
            raise Rejected("missing_field", f"field {missing[0]!r} is required", missing[0])
        stamp = self.time(at)
        head = d.escape(name, d.measurement_escapes) + "".join(f",{d.escape(k, d.key_escapes)}={d.escape(v, d.key_escapes)}" for k, v in out)
        line = head + " " + ",".join(f"{d.escape(k, d.key_escapes)}={t}" for k, t in parts) + (f" {stamp}" if stamp is not None else "")
        if d.version == 2 and runs_on(line):
            raise Rejected("invalid_name", "the line would run on")
        self.types |= journal
        self.keys |= keys
        self.wrote = {mk: self.types.get(mk, "field") if role == "field" else role for mk, role in keys.items()}
        return line

    def raw(self, data: str | bytes) -> list[str]:
        """Lines of raw text: as they are (stamped if untimed), or parsed and encoded anew."""
        try:
            text = data.decode() if isinstance(data, bytes) else data
            text.encode()
        except UnicodeError:
            raise Rejected("invalid_encoding", "lines are not valid UTF-8") from None
        lines = self.d.split(text)
        if self.s.raw_lines == "passthrough":
            for x in lines:
                if ('"' in x or "\\" in x) and runs_on(x):
                    raise Rejected("invalid_line", f"the line runs on: {x[:100]!r}")
            return [stamped(x, self.now // self.unit) for x in lines] if self.s.auto_timestamp else lines
        out, wrote = [], {}
        for x in lines:
            if not x.strip():
                continue
            try:
                name, tags, fields, at = self.d.parse(x)
            except LineError as e:
                raise Rejected("invalid_line", str(e)) from None
            out.append(self.line(name, tags, {k: v if not isinstance(v, tuple) else v[1] if v[0] == "i" else UInt(v[1]) for k, v in fields}, at))
            wrote |= self.wrote
        self.wrote = wrote
        return out


def _passes(v, p: Predicate) -> bool:
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    for bound, op in ((p.gt, "__gt__"), (p.ge, "__ge__"), (p.lt, "__lt__"), (p.le, "__le__")):
        if bound is not None and not (number and getattr(float(v) if isinstance(v, float) else v, op)(bound) is True):
            return False
    if p.eq is not None and v != p.eq or p.ne is not None and v == p.ne or p.in_ is not None and v not in p.in_:
        return False
    return p.regex is None or isinstance(v, str) and re.search(p.regex, v) is not None


def _packed(seq: int, r) -> tuple[int, str | None, bytes]:
    """A record's position, measurement (null for raw lines and what is no record) and pickled body."""
    if hasattr(type(r), "__meterline__"):
        r = _of_model(r)
    name = r.measurement if isinstance(r, Point) else r.get("measurement") if isinstance(r, Mapping) else None
    body = dict(r) if isinstance(r, Mapping) else r
    return seq, str(getattr(name, "value", name)) if name is not None else None, pickle.dumps(body)


def records(spark: SparkSession, data: Iterable, chunk: int = 25_000) -> DataFrame:
    """Python records as rows (seq, measurement, body): chunked, positions counted over all chunks."""
    ship(spark)
    if isinstance(data, (str, bytes, Mapping, Point)) or hasattr(type(data), "__meterline__"):
        data = [data]
    numbered = enumerate(data)
    make = lambda: spark.createDataFrame([_packed(i, r) for i, r in itertools.islice(numbered, chunk)], ROWS)
    first = make()
    following = next(numbered, None)
    if following is None:
        return first
    # more than one chunk: each is written and let go, so neither driver nor plan grows with the input
    path = f"{Scratch(spark, 'records').root}/rows"
    first.write.parquet(path)
    while following is not None:
        numbered = itertools.chain([following], numbered)
        make().write.mode("append").parquet(path)
        following = next(numbered, None)
    return spark.read.schema(ROWS).parquet(path)


def record_rows(df: DataFrame, make: Callable[[dict], Any], seq: str) -> DataFrame:
    """Rows of a DataFrame as records: ``make`` turns a row's dict into a record on the executors; ``seq`` orders them."""
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            rows = [_packed(r[seq], make(r)) for r in batch.to_pylist()]
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["seq", "measurement", "body"])

    return df.mapInArrow(run, ROWS)


def _kinds(settings: Settings):
    """Natural types of every undeclared field, tag keys included, as seen by each record on its own."""

    def run(frames):
        for pdf in frames:
            enc, seen = Encoder(settings, 0), set()
            for body in pdf["body"]:
                r = pickle.loads(body)
                try:
                    if isinstance(r, (str, bytes)):
                        text = r.decode() if isinstance(r, bytes) else r
                        if settings.raw_lines == "passthrough":
                            continue
                        items = [(n, t, {k: (v[0] if isinstance(v, tuple) else v) for k, v in f}, {k: v[0] for k, v in f if isinstance(v, tuple)}) for n, t, f, _ in map(enc.d.parse, enc.d.split(text))]
                    else:
                        name, tags, fields, _ = enc.unpack(r)
                        items = [(name, enc.injected(str(name), tags, fields), fields, {})]
                    for name, tags, fields, forced in items:
                        seen |= {(str(name), str(k), "tag") for k, v in tags.items() if tag_text(v)}
                        for k, v in fields.items():
                            if v is not None and k in forced:
                                seen.add((str(name), str(k), "integer" if forced[k] == "i" else "uinteger"))
                            elif v is not None:
                                kind, x = enc.natural(str(k), v)
                                if kind != "float" or math.isfinite(x):
                                    seen.add((str(name), str(k), "float" if settings.int_as_float and kind == "integer" else kind))
                except (Rejected, LineError, UnicodeError):
                    continue
            yield pd.DataFrame(sorted(seen), columns=["measurement", "key", "kind"])

    return run


ROWS = "seq long, measurement string, body binary"
LOCKS = "array<struct<measurement:string,key:string,kind:string>>"
OUT = f"seq long, measurement string, n int, line string, code string, key string, message string, locks {LOCKS}"
NAMES = ["seq", "measurement", "n", "line", "code", "key", "message", "locks"]
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def _encoded(encoder: Encoder, seq: int, body: bytes, told: set) -> list[tuple]:
    """Rows of one record; ``locks`` has what an accepted one wrote, as far as not ``told`` before."""
    r = pickle.loads(body)
    try:
        if isinstance(r, (str, bytes)):
            encoder.wrote = {}
            lines = [(seq, None, i, x, None, None, None) for i, x in enumerate(encoder.raw(r))]
        else:
            name, line = encoder.record(r)
            lines = [(seq, str(name), 0, line, None, None, None)]
    except Rejected as e:
        return [(seq, e.measurement, 0, None, e.code, e.key, str(e), None)]
    new = [x for x in ((str(m), k, kind) for (m, k), kind in encoder.wrote.items()) if x not in told]
    told.update(new)
    locks = [{"measurement": m, "key": k, "kind": kind} for m, k, kind in new] or None
    return [(*x, locks if i == 0 else None) for i, x in enumerate(lines)]


class _Locks:
    """Locks of one measurement's contested keys as they grow: ``states[i]`` judges records up to ``at[i]``."""

    def __init__(self, contested: set[str]):
        self.contested, self.at, self.states = contested, [], [({}, {})]

    def before(self, seq: int) -> tuple[dict, dict]:
        return self.states[bisect_left(self.at, seq)]


def _grow(df: DataFrame, make: Callable[[], Encoder], locks: dict[str, _Locks]) -> None:
    """Finds, in order, the accepted records that lock a contested key of their measurement.

    Between two such records the locks stand still, so every round looks for the next one of
    all measurements at once, in parallel; there are at most as many rounds as contested keys
    of one measurement, and a round returns one row a measurement.
    """
    active = set(locks)
    while active:

        def run(frames, active=frozenset(active)):
            enc = make()
            fixed, known, found = enc.types, enc.keys, {}
            for pdf in frames:
                for seq, name, body in zip(pdf["seq"], pdf["measurement"], pdf["body"], strict=True):
                    if name not in active:
                        continue
                    own = locks[name]
                    if (own.at and seq <= own.at[-1]) or (name in found and seq >= found[name][0]):
                        continue
                    types, keys = own.states[-1]
                    enc.types, enc.keys = fixed | types, known | keys
                    try:
                        enc.record(pickle.loads(body))
                    except Rejected:
                        continue
                    new = [{mk: v for mk, v in x.items() if mk[0] == name and mk[1] in own.contested} for x in (enc.types, enc.keys)]
                    new[1] = {mk: v for mk, v in new[1].items() if known.get(mk) != v}
                    if new != [types, keys]:
                        found[name] = seq, pickle.dumps(tuple(new))
            yield pd.DataFrame([(n, *x) for n, x in found.items()], columns=["measurement", "seq", "state"])

        nearest = df.where(F.col("measurement").isin(sorted(active))).mapInPandas(run, "measurement string, seq long, state binary")
        nearest = nearest.groupBy("measurement").agg(F.min("seq").alias("seq"), F.min_by("state", "seq").alias("state")).collect()
        for r in nearest:
            own = locks[r["measurement"]]
            own.at.append(r["seq"])
            own.states.append(pickle.loads(r["state"]))
        active = {r["measurement"] for r in nearest}


def encode_records(df: DataFrame, settings: Settings | None = None, types: dict[tuple[str, str], str] | None = None, now_ns: int | None = None, keys: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """Lines and rejections of ``records``: seq, measurement, n (line of the record), line, code, key, message, locks.

    ``types`` and ``keys`` (names known as "tag" or "field") hold from the first record on.
    Records that share a ``seq`` are judged by the same locks.  ``locks`` lists the names that
    accepted records wrote, each once a task at least: "tag", the type a field is locked to,
    or "field" where types are not locked.
    """
    s, now = settings or Settings(), time.time_ns() if now_ns is None else now_ns
    types, known, tags = dict(types or {}), dict(keys or {}), context_tags()
    declared = {(m, k) for m, schema in s.measurements.items() for k in schema.fields} | set(types)
    found = df.mapInPandas(_kinds(s), "measurement string, key string, kind string").distinct().collect() if s.type_lock or s.dialect == 3 else []
    seen: dict[tuple[str, str], set[str]] = {}
    for r in found:
        seen.setdefault((r["measurement"], r["key"]), set()).add(r["kind"])
    # more than one type, or tag and field at once: order decides
    contested: dict[str, set[str]] = {}
    for (m, k), kinds in seen.items():
        if ("tag" in kinds and len(kinds) > 1) or ((m, k) not in declared and len(kinds - {"tag"}) > 1):
            contested.setdefault(m, set()).add(k)
    fixed = types | {mk: next(iter(kinds)) for mk, kinds in seen.items() if "tag" not in kinds and len(kinds) == 1 and mk not in declared}

    def make() -> Encoder:
        return Encoder(s, now, fixed, tags, known)

    locks = {m: _Locks(keys) for m, keys in contested.items()}
    # a declared type or one handed in is known before the first record
    for m, own in locks.items():
        own.states[0] = {mk: v for mk, v in types.items() if mk[0] == m and mk[1] in own.contested}, {}
    _grow(df, make, locks)

    def run(frames):
        for pdf in frames:
            plain, ordered, out, told = make(), make(), [], set()
            for seq, name, body in zip(pdf["seq"], pdf["measurement"], pdf["body"], strict=True):
                if name in locks:
                    grown, keys = locks[name].before(seq)
                    ordered.types, ordered.keys = fixed | grown, known | keys
                out += _encoded(ordered if name in locks else plain, seq, body, told)
            yield pd.DataFrame(out, columns=NAMES)

    return df.mapInPandas(run, OUT)


def locked_types(df: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Natural types that the records' fields come with: measurement, key, kinds (one entry: a uniform lock)."""
    kinds = df.mapInPandas(_kinds(settings or Settings()), "measurement string, key string, kind string").where("kind <> 'tag'")
    return kinds.groupBy("measurement", "key").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
