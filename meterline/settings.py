"""Settings of the point pipeline: validation policies, measurement schemas and tag rules."""

from __future__ import annotations

import os
import re
import tomllib
from dataclasses import dataclass, field, fields
from typing import Any

TYPES = ("float", "integer", "uinteger", "string", "boolean")
# Accepted spellings of the field types.
ALIASES = {
    "float": "float", "double": "float", "f64": "float", "float64": "float",
    "integer": "integer", "int": "integer", "i64": "integer", "int64": "integer",
    "uinteger": "uinteger", "uint": "uinteger", "u64": "uinteger", "uint64": "uinteger", "unsigned": "uinteger",
    "string": "string", "str": "string", "text": "string",
    "boolean": "boolean", "bool": "boolean",
}
PRECISIONS = {"ns": 1, "us": 1_000, "ms": 1_000_000, "s": 1_000_000_000}
_UNIT_S = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}
_UNIT_B = {"": 1, "b": 1, "k": 1000, "kb": 1000, "m": 10**6, "mb": 10**6, "g": 10**9, "gb": 10**9, "kib": 1 << 10, "mib": 1 << 20, "gib": 1 << 30}


class ConfigError(ValueError):
    """A setting or declaration that contradicts itself."""


def duration(text: str | float) -> float:
    """Seconds of ``500ms``, ``1h30m`` or a plain number."""
    if isinstance(text, (int, float)) and not isinstance(text, bool):
        return float(text)
    found = re.findall(r"(\d+(?:\.\d+)?)\s*(ns|us|µs|ms|s|m|h|d|w)", str(text).strip())
    if not found or "".join(a + b for a, b in found) != re.sub(r"\s", "", str(text)):
        raise ConfigError(f"not a duration: {text!r}")
    return sum(float(a) * _UNIT_S[b] for a, b in found)


def size(text: str | int) -> int:
    """Bytes of ``8MiB``, ``64 kB`` or a plain number."""
    if isinstance(text, int) and not isinstance(text, bool):
        return text
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([A-Za-z]*)\s*", str(text))
    if not m or m[2].lower() not in _UNIT_B:
        raise ConfigError(f"not a size: {text!r}")
    return int(float(m[1]) * _UNIT_B[m[2].lower()])


def field_type(name: str) -> str:
    if name.lower() not in ALIASES:
        raise ConfigError(f"unknown field type {name!r}")
    return ALIASES[name.lower()]


@dataclass(frozen=True)
class MeasurementSchema:
    """Declared field types, a closed tag set if ``tags`` is given, required keys, undeclared fields."""

    fields: dict[str, str] = field(default_factory=dict)
    tags: tuple[str, ...] | None = None
    required_tags: tuple[str, ...] = ()
    required_fields: tuple[str, ...] = ()
    extra_fields: str = "allow"

    def __post_init__(self):
        object.__setattr__(self, "fields", {k: field_type(v) for k, v in self.fields.items()})
        if self.extra_fields not in ("allow", "forbid"):
            raise ConfigError("extra_fields is allow or forbid")
        if self.tags is not None and set(self.required_tags) - set(self.tags):
            raise ConfigError("required_tags must be declared tags")
        if self.extra_fields == "forbid" and set(self.required_fields) - set(self.fields):
            raise ConfigError("required_fields must be declared where other fields are forbidden")
        if set(self.fields) & set(self.tags or ()):
            raise ConfigError("a key cannot be both tag and field")


@dataclass(frozen=True)
class Predicate:
    """Conditions on one field value; all must hold."""

    gt: Any = None
    ge: Any = None
    lt: Any = None
    le: Any = None
    eq: Any = None
    ne: Any = None
    in_: tuple | None = None
    regex: str | None = None


@dataclass(frozen=True)
class TagRule:
    """When everything given holds, ``set`` adds tags; templates name groups, measurement, tags[k], fields[k]."""

    set: dict[str, str]
    measurement: str | None = None
    tags: dict[str, str] = field(default_factory=dict)
    has_tags: tuple[str, ...] = ()
    missing_tags: tuple[str, ...] = ()
    has_fields: tuple[str, ...] = ()
    fields: dict[str, Predicate] = field(default_factory=dict)
    conflict: str = "keep"

    def __post_init__(self):
        if not self.set:
            raise ConfigError("a rule sets at least one tag")
        if self.conflict not in ("keep", "overwrite", "error"):
            raise ConfigError("conflict is keep, overwrite or error")


@dataclass(frozen=True)
class Settings:
    """Defaults follow the strict side: reject by raising, lock types, refuse naive times."""

    on_invalid: str = "raise"
    type_lock: bool = True
    unknown_measurements: str = "allow"
    coerce: bool = True
    int_as_float: bool = False
    non_finite: str = "skip"
    naive_datetime: str = "error"
    max_string_bytes: int = 1 << 20
    raw_lines: str = "passthrough"
    auto_timestamp: bool = True
    precision: str = "ns"
    dialect: int = 3
    measurements: dict[str, MeasurementSchema] = field(default_factory=dict)
    static_tags: dict[str, Any] = field(default_factory=dict)
    env_tags: dict[str, str | dict] = field(default_factory=dict)
    conflict: str = "keep"
    rules: tuple[TagRule, ...] = ()

    def __post_init__(self):
        allowed = {"on_invalid": ("raise", "drop"), "unknown_measurements": ("allow", "reject"), "non_finite": ("skip", "error"), "naive_datetime": ("error", "utc"), "raw_lines": ("passthrough", "validate"), "conflict": ("keep", "overwrite", "error"), "precision": tuple(PRECISIONS), "dialect": (2, 3)}
        for k, values in allowed.items():
            if getattr(self, k) not in values:
                raise ConfigError(f"{k} is one of {', '.join(map(str, values))}")

    def base_tags(self, extra: dict[str, Any] | None = None) -> dict[str, Any]:
        """Static tags, then environment tags, then ``extra``; later ones win, empty ones are omitted."""
        out = dict(self.static_tags)
        for name, spec in self.env_tags.items():
            var, default = (spec, None) if isinstance(spec, str) else (spec["var"], spec.get("default", ""))
            value = os.environ.get(var, default)
            if value is None:
                raise ConfigError(f"environment variable {var} for tag {name!r} is not set")
            if value:
                out[name] = value
        return out | (extra or {})


def load(path: str | None = None, env: dict[str, str] | None = None, **overrides) -> Settings:
    """Settings from defaults, then a TOML file, then ``METERLINE_*`` variables, then overrides."""
    got: dict[str, Any] = {}
    if path:
        with open(path, "rb") as f:
            raw = tomllib.load(f)
        got |= raw.get("validation", {})
        got["measurements"] = {k: MeasurementSchema(**{a: tuple(b) if isinstance(b, list) else b for a, b in v.items()}) for k, v in raw.get("measurements", {}).items()}
        tags = raw.get("tags", {})
        got |= {a: tags[b] for a, b in (("static_tags", "static"), ("env_tags", "env"), ("conflict", "conflict")) if b in tags}
        got["rules"] = tuple(_rule(r) for r in tags.get("rules", ()))
    known = {f.name: f.type for f in fields(Settings)}
    for k, v in (os.environ if env is None else env).items():
        name = k.removeprefix("METERLINE_").lower()
        if k.startswith("METERLINE_") and name in known:
            kind = known[name]
            got[name] = v.lower() in ("1", "true", "yes") if kind == "bool" else size(v) if kind == "int" else v
    got |= overrides
    if bad := set(got) - set(known):
        raise ConfigError(f"unknown settings: {', '.join(sorted(bad))}")
    return Settings(**got)


def _rule(raw: dict) -> TagRule:
    raw = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()}
    raw["fields"] = {k: Predicate(**{("in_" if a == "in" else a): tuple(b) if isinstance(b, list) else b for a, b in v.items()}) for k, v in raw.get("fields", {}).items()}
    return TagRule(**raw)
