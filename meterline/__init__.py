"""Meterline: a time-series point pipeline, point store and query layer as Spark plans."""

from importlib import import_module

__version__ = "0.1.0"

_WHERE = {
    "AsyncClient": "client", "Client": "client", "WriteResult": "client", "LineError": "functions.dialect", "Rejected": "functions.dialect",
    "Field": "operators.records", "Point": "operators.records", "Tag": "operators.records", "Timestamp": "operators.records", "UInt": "operators.records", "measurement": "operators.records",
    "tag_context": "operators.rules", "QueryError": "plans.query", "Result": "plans.query", "PointStore": "plans.store",
    "ConfigError": "settings", "MeasurementSchema": "settings", "Predicate": "settings", "Settings": "settings", "TagRule": "settings", "load": "settings",
}
__all__ = sorted(_WHERE)


def __getattr__(name: str):
    """Public names are imported on first use, so that executors load only what they run."""
    if name not in _WHERE:
        raise AttributeError(name)
    return getattr(import_module(f"meterline.{_WHERE[name]}"), name)
