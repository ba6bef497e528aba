"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed values. Adaptive execution sizes the reduce side, turns small joins into broadcasts by their
# measured shuffle size, and splits the partition of a hot join key over many tasks.
ADAPTIVE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the adaptive settings the operators count on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Text in gzip files of so many lines at most, since a packed file is read by one task; and tables for scratch.
PACKED_TEXT = {"compression": "gzip", "zlib.compress.level": "DEFAULT_COMPRESSION", "maxRecordsPerFile": "200000"}
PACKED_TABLE = {"compression": "zstd"}

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, an execution's shuffle files go when it ends, not only when the driver collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Deletes folders that are not read any more; those that are not there are left out."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


_local_scratch: dict[str, str] = {}


def ensure_scratch(spark: SparkSession) -> None:
    """Gives a local session without ``spark.checkpoint.dir`` one temporary folder; for tests and the catalog only."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and context.master.startswith("local"):
        if not context.master.startswith("local-cluster") and context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="seatgrid-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder the cluster shares through ``spark.checkpoint.dir``; an error without that."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _local_scratch.get(spark.sparkContext.applicationId)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/seatgrid/{name}-{uuid.uuid4().hex}"
