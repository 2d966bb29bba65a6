"""Point store: append-only Parquet logs, one a measurement, read with last-write-wins merging.

A point is its series (all tags), its time and each field on its own: a later write of the
same point replaces the fields it names and leaves the others.  Reading merges with one
grouped aggregation (map-side combined), compaction writes the merged rows back.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The type names a schema reader sees.
SERVER_TYPES = {"double": "Float64", "bigint": "Int64", "decimal(20,0)": "UInt64", "string": "Utf8", "boolean": "Boolean"}


def last_write(df: DataFrame, identity: list[str], values: list[str], order) -> DataFrame:
    """One row for each identity (null-safe): per value the last non-null write by ``order``."""
    return df.groupBy(*identity).agg(*(F.max_by(F.col(v), F.when(F.col(v).isNotNull(), order)).alias(v) for v in values))


def series_cardinality(df: DataFrame, tags: list[str], exact: bool = False) -> DataFrame:
    series = F.struct(*tags)
    return df.agg((F.countDistinct(series) if exact else F.approx_count_distinct(series)).alias("series"))


def untimed_overwrites(df: DataFrame, tags: list[str], fields: list[str]) -> DataFrame:
    """Of untimed rows, how many writes of each field replace another of the same series in this call."""
    long = df.select(*tags, F.explode(F.array(*(F.when(F.col(c).isNotNull(), F.lit(c)) for c in fields))).alias("field")).where("field is not null")
    return long.groupBy(*tags, "field").agg(F.count("*").alias("n")).where("n > 1").groupBy("field").agg(F.count("*").alias("series"), F.sum(F.col("n") - 1).alias("overwritten"))


def checksum(df: DataFrame, col: str) -> DataFrame:
    """Order-independent checksum of a text column."""
    return df.agg(F.count(col).alias("lines"), F.sum(F.xxhash64(col).cast("decimal(38,0)")).alias("checksum"))


class PointStore:
    """Measurements under ``root`` (a path that Spark can reach)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _meta(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("name string, tags string, fields string, at string").json(f"{self.root}/_catalog")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def measurements(self) -> dict[str, tuple[list[str], dict[str, str]]]:
        """Tag keys and field types of every measurement."""
        out: dict[str, tuple[list[str], dict[str, str]]] = {}
        meta = self._meta()
        for r in meta.collect() if meta is not None else []:
            tags, fields = out.setdefault(r["name"], ([], {}))
            tags += [t for t in json.loads(r["tags"]) if t not in tags]
            fields |= json.loads(r["fields"])
        return out

    def append(self, df: DataFrame, measurement: str, tags: list[str], fields: list[str], time_ns: str = "time_ns", seq: str | None = None, batch: int | None = None, writer: str = "append") -> None:
        """Adds points; ``seq`` orders writes within the batch, batches are ordered by when they began.

        A ``writer`` that numbers its batches (a stream) may write one again: it keeps its
        place and replaces itself.  Without a number every call is a batch of its own.
        """
        known_tags, known = self.measurements().get(measurement, ([], {}))
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        stored = {c: ("bigint" if kinds[c] in ("int", "smallint", "tinyint") else "double" if kinds[c] == "float" else kinds[c]) for c in fields}
        if bad := [c for c in fields if c in known and known[c] != stored[c]]:
            raise ValueError(f"type of field {bad[0]!r} is {known[bad[0]]}, not {stored[bad[0]]}")
        if bad := [c for c in fields if c in known_tags] + [c for c in tags if c in known]:
            raise ValueError(f"{bad[0]!r} cannot be both tag and field")
        place = self._place(measurement, None if batch is None else f"{writer}.{batch}")
        order = F.struct(F.lit(place).cast("long").alias("batch"), (F.col(seq).cast("long") if seq else F.lit(0).cast("long")).alias("seq"))
        out = df.select(*(F.col(c).cast("string").alias(c) for c in tags), *(F.col(c).cast(stored[c]).alias(c) for c in fields), F.col(time_ns).cast("long").alias("time_ns"), order.alias("write_seq"))
        out.write.mode("overwrite").parquet(f"{self.root}/{measurement}/batch={place}")
        if set(tags) - set(known_tags) or set(fields) - set(known):
            row = [(measurement, json.dumps(tags), json.dumps(stored), uuid.uuid4().hex)]
            self.spark.createDataFrame(row, "name string, tags string, fields string, at string").coalesce(1).write.mode("append").json(f"{self.root}/_catalog")

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _create(self, path: str, text: str) -> bool:
        """Creates a small file; False if it is there already."""
        p, fs = self._path(path)
        try:
            stream = fs.create(p, False)
        except Exception:
            if fs.exists(p):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def _place(self, measurement: str, name: str | None) -> int:
        """The batch's place in the order of writes: taken by creating a file that no other writer can create too."""
        order, named = f"{self.root}/_order/{measurement}", f"{self.root}/_names/{measurement}/{name}"
        p, fs = self._path(named)
        if name is not None and fs.exists(p):
            stream = fs.open(p)
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            if text:
                return int(text)
            fs.delete(p, False)  # its writer was lost before the place was written down
        p, fs = self._path(order)
        taken = [int(s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
        place = max(taken, default=-1) + 1
        while not self._create(f"{order}/{place}", name or ""):
            place += 1
        if name is not None:
            self._create(named, str(place))
        return place

    def _batches(self, measurement: str) -> list[int]:
        """Places of the batches that are there."""
        p, fs = self._path(f"{self.root}/{measurement}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))

    def log(self, measurement: str, paths: list[str] | None = None) -> DataFrame:
        tags, fields = self.measurements()[measurement]
        columns = [(t, "string") for t in tags] + list(fields.items()) + [("time_ns", "bigint"), ("write_seq", "struct<batch:bigint,seq:bigint>")]
        schema = ", ".join(f"`{k}` {v}" for k, v in columns)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{measurement}").parquet(*(paths or [f"{self.root}/{measurement}"])).drop("batch")

    def read(self, measurement: str) -> DataFrame:
        """Merged points: tags, fields, ``time_ns`` and the derived ``time``."""
        tags, fields = self.measurements()[measurement]
        merged = last_write(self.log(measurement), [*tags, "time_ns"], list(fields), F.col("write_seq"))
        return merged.withColumn("time", F.timestamp_micros(F.expr("(time_ns - pmod(time_ns, 1000)) div 1000")))

    def compact(self, measurement: str) -> None:
        """Writes the merged points as the next batch and removes those it merged; a later replay of one changes nothing."""
        tags, fields = self.measurements()[measurement]
        old = self._batches(measurement)
        paths = [f"{self.root}/{measurement}/batch={i}" for i in old]
        merged = last_write(self.log(measurement, paths), [*tags, "time_ns"], list(fields), F.col("write_seq"))
        self.append(merged, measurement, tags, list(fields))
        for path in paths:
            p, fs = self._path(path)
            fs.delete(p, True)

    def register(self) -> None:
        """Temporary views of all measurements and of the column catalog."""
        for name in self.measurements():
            self.read(name).createOrReplaceTempView(f"`{name}`")
        self.columns().createOrReplaceTempView("information_schema_columns")

    def columns(self) -> DataFrame:
        """``information_schema.columns`` as a schema reader expects it."""
        rows = []
        for name, (tags, fields) in self.measurements().items():
            rows += [(name, t, "Dictionary(Int32, Utf8)") for t in tags] + [(name, k, SERVER_TYPES[v]) for k, v in fields.items()] + [(name, "time", "Timestamp(Nanosecond, None)")]
        return self.spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
