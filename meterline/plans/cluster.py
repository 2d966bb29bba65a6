"""What any plan needs from the cluster: a shared scratch folder, shipped code, checked broadcasts."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows times the stated row width stay under this.
BROADCAST_BYTES = 32 << 20
#: While a scratch table is written: its shuffle files go when it is done, and Arrow batches stay small.
WHILE_KEEPING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}
_shipped: dict[str, str] = {}
_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; in local mode alone a temporary one where unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _roots:
            _roots[app] = "file://" + tempfile.mkdtemp(prefix="meterline-")
        found = _roots[app]
        spark.sparkContext.setCheckpointDir(found)
    return found


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once a session, for workers that do not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="meterline-ship-"), "meterline_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(target)
    _shipped[app] = target


class Scratch:
    """Tables written to the shared folder to cut lineage; ``drop`` removes those no longer needed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/meterline-{name}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._delete, self.root)

    def _delete(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session may be gone at exit
            return

    def keep(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        """Writes ``df`` and returns it as a table scan; the shuffle files it took are removed once it is written."""
        path = f"{self.root}/{name}"
        was = {k: self.spark.conf.get(k, None) for k in WHILE_KEEPING}
        try:
            for k, v in WHILE_KEEPING.items():
                self.spark.conf.set(k, v)
            df.write.mode("overwrite").option("compression", codec).parquet(path)
        finally:
            for k, v in was.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for n in names:
            self._delete(f"{self.root}/{n}")


def checked_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """``broadcast(df)`` if its counted size fits, else ``df`` as it is (Spark then shuffles)."""
    most = BROADCAST_BYTES // max(1, row_bytes)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
