"""Streaming ingest: the batch operators on every micro-batch, the store as sink."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterline.operators import frame
from meterline.plans.store import PointStore
from meterline.settings import Settings


def to_store(stream: DataFrame, store: PointStore, measurement: str, tags: list[str], fields: list[str], time_ns: str, checkpoint: str, seq: str | None = None, **trigger) -> StreamingQuery:
    """Appends each micro-batch under the stream's name and its id, so a replayed batch replaces itself and nothing else.

    The stream's name is its checkpoint's: a stream that starts anew with another one adds to the store.
    """
    writer = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint.rstrip("/")).hex

    def write(df: DataFrame, batch: int) -> None:
        store.append(df, measurement, tags, fields, time_ns, seq, batch=batch, writer=writer)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def encode_stream(stream: DataFrame, measurement: str, sink: Callable[[DataFrame, DataFrame, int], None], checkpoint: str, settings: Settings | None = None, **options) -> StreamingQuery:
    """Encodes each micro-batch; ``sink`` gets accepted lines, rejected rows and the batch id."""

    def write(df: DataFrame, batch: int) -> None:
        out = frame.encode(df, measurement, settings=settings, **options).persist()
        try:
            sink(out.where("reject is null"), out.where("reject is not null"), batch)
        finally:
            out.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(stream: DataFrame, time: str, width: str, late: str, keys: list[str], value: str, slide: str | None = None) -> DataFrame:
    """Windowed count and mean with a watermark: late rows beyond ``late`` are left out."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w, *keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
