"""Line-protocol files and servers as Spark data sources.

``format("lp")`` reads and writes text files of lines (batch and stream), ``format("lp_http")``
writes to a server and leaves refused lines in a dead-letter folder.  Reading by a path that
only Spark can open goes through Spark's own text reader (:func:`read_lines`).
"""

from __future__ import annotations

import glob
import json
import os
import uuid
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage

from meterline.functions.dialect import DIALECTS
from meterline.operators import decode
from meterline.sources.http import Delivery, HttpOptions

LINES = "file string, n int, line string"


def read_lines(spark: SparkSession, path: str, dialect: int = 3) -> DataFrame:
    """file, n, line of whole files: quoted newlines are kept, gzip is read by its extension."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return decode.explode_lines(files, "value", dialect)


def read_points(spark: SparkSession, path: str, dialect: int = 3) -> DataFrame:
    return decode.parse_lines(read_lines(spark, path, dialect), "line", dialect)


def write_lines(df: DataFrame, path: str, compression: str | None = "gzip", column: str = "line") -> None:
    """One line a row as text files; partitions stay as they are."""
    df.where(F.col(column).isNotNull()).select(column).write.mode("overwrite").text(path, compression=compression)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 64, dialect: int = 3) -> DataFrame:
    """A stream over files that appear in ``path``; the file limit is the backpressure."""
    src = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).load(path)
    return decode.explode_lines(src, "value", dialect)


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.dialect = options["path"], int(options.get("dialect", 3))

    def partitions(self):
        found = sorted(glob.glob(os.path.join(self.path, "**", "*.lp*"), recursive=True)) if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        return [_File(p) for p in found]

    def read(self, partition):
        import gzip

        with (gzip.open if partition.path.endswith(".gz") else open)(partition.path, "rt", encoding="utf-8", newline="") as f:
            for n, line in enumerate(DIALECTS[self.dialect].split(f.read())):
                yield partition.path, n, line


class _StreamReader(DataSourceStreamReader):
    """Files in the order of their last change, then name; every file is read by a task of its own.

    A micro-batch takes all files that are there; one that is put in place later counts as new
    if its time or, at the same time, its name comes after those taken.
    """

    def __init__(self, options):
        self.inner = _Reader(options)

    def _places(self):
        for p in self.inner.partitions():
            yield [os.stat(p.path).st_mtime_ns, p.path], p

    def initialOffset(self):
        return {"after": [0, ""]}

    def latestOffset(self, *_):
        return {"after": max((place for place, _ in self._places()), default=[0, ""])}

    def partitions(self, start, end):
        return [p for place, p in self._places() if start["after"] < place <= end["after"]]

    def read(self, partition):
        return self.inner.read(partition)

    def commit(self, end):
        pass


@dataclass
class _Written(WriterCommitMessage):
    lines: int
    refused: int
    path: str


class _Writer(DataSourceWriter, DataSourceStreamWriter):
    """A file a task, renamed into place when the job commits."""

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        os.makedirs(self.path, exist_ok=True)
        name, n = os.path.join(self.path, f".{uuid.uuid4().hex}.lp"), 0
        with open(name, "w", encoding="utf-8", newline="") as f:
            for row in iterator:
                if row["line"] is not None:
                    f.write(row["line"] + "\n")
                    n += 1
        return _Written(n, 0, name)

    def commit(self, messages, batch_id=0):
        for m in messages:
            if m:
                os.replace(m.path, os.path.join(os.path.dirname(m.path), os.path.basename(m.path)[1:]))

    def abort(self, messages, batch_id=0):
        for m in messages:
            if m and os.path.exists(m.path):
                os.remove(m.path)


class LinesSource(DataSource):
    """``spark.read.format("lp").load(path)`` and the matching writers (folders that every node sees)."""

    @classmethod
    def name(cls):
        return "lp"

    def schema(self):
        return LINES

    def reader(self, schema):
        return _Reader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options)

    def streamWriter(self, schema, overwrite):
        return _Writer(self.options)


class _HttpWriter(DataSourceWriter, DataSourceStreamWriter):
    def __init__(self, options):
        kinds = {f.name: f.type for f in fields(HttpOptions)}
        low = {f.replace("_", ""): f for f in kinds}
        given = {low[k.replace("_", "").lower()]: v for k, v in options.items() if k.replace("_", "").lower() in low}
        cast = {"int": int, "float": float, "bool": lambda v: str(v).lower() == "true"}
        self.o = HttpOptions(**{k: cast.get(kinds[k], str)(v) for k, v in given.items()})
        self.dead = options.get("deadletters")
        # refused lines go to the dead letters; where there are none, the job fails
        self.strict = str(options.get("failonreject", not self.dead)).lower() == "true"

    def write(self, iterator):
        out = Delivery(self.o).run(r["line"] for r in iterator if r["line"] is not None)
        refused = sum(max(1, len(f.lines)) for f in out.failures)
        path = ""
        if out.failures and self.dead:
            os.makedirs(self.dead, exist_ok=True)
            path = os.path.join(self.dead, f".{uuid.uuid4().hex}.json")
            with open(path, "w", encoding="utf-8") as f:
                for x in out.failures:
                    for line in x.lines or [None]:
                        f.write(json.dumps({"database": self.o.database, "precision": self.o.precision, "line": line, "code": x.code, "message": x.message, "retryable": x.retryable}) + "\n")
        if out.failures and self.strict:
            raise RuntimeError(out.failures[0].message)
        return _Written(out.written, refused, path)

    def commit(self, messages, batch_id=0):
        for m in messages:
            if m and m.path:
                os.replace(m.path, os.path.join(os.path.dirname(m.path), os.path.basename(m.path)[1:]))

    def abort(self, messages, batch_id=0):
        for m in messages:
            if m and m.path and os.path.exists(m.path):
                os.remove(m.path)


class HttpSource(DataSource):
    """``df.write.format("lp_http").options(url=..., database=...)``; ``deadLetters`` is a shared folder.

    Without one, a line that the server refuses fails the job (``failOnReject`` false lets it go).
    """

    @classmethod
    def name(cls):
        return "lp_http"

    def schema(self):
        return "line string"

    def writer(self, schema, overwrite):
        return _HttpWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return _HttpWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LinesSource)
    spark.dataSource.register(HttpSource)
