"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# What the jobs are tuned for. A cluster passes its own sizes on submit; the
# settings here only make sure that plans are re-planned and split at run time.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "churnspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword settings win over them.

    Spark names hold dots, so pass them as ``**{"spark.sql.shuffle.partitions": "8"}``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process: ``local``, ``local[4]``, ``local[*]``."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session.

    ``spark.checkpoint.dir`` decides. Where neither it nor a checkpoint directory is set, a
    temporary folder is made if driver and executors are one process; on a cluster each
    executor would write to a disk of its own, so there it is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not _one_machine(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="churnspark-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


# The lists of paths that open ``intermediates`` blocks collect, the innermost last.
_OWNERS: ContextVar[tuple[list[str], ...]] = ContextVar("owners", default=())


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder; it belongs to the innermost ``intermediates`` block."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    owners = _OWNERS.get()
    if owners:
        owners[-1].append(path)
    return path


def materialize(df: DataFrame, label: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several branches need the same intermediate table: it is computed
    once, later branches read only their columns, Catalyst sees its true size
    (so broadcasts are decided on a known number) and a lost executor costs no
    recomputation of what came before.

    The table stays until the ``intermediates`` block ends in which it was made; without
    one it stays for good. A ``path`` from ``new_path`` keeps the owner it was made for. A
    ``compression`` other than the session's takes its place.
    """
    spark = df.sparkSession
    path = path or new_path(spark, label)
    if not _may_be_private(spark, path):
        df.write.parquet(path, compression=compression)
        return spark.read.schema(df.schema).parquet(path)
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(path, compression=compression)
    stored = spark.read.schema(df.schema).parquet(path)
    check_rows(path, written.get["rows"], stored.count())
    return stored


def _may_be_private(spark: SparkSession, path: str) -> bool:
    """Whether executors of a cluster could each see another folder under this path."""
    return not _one_machine(spark) and urlparse(path).scheme in ("", "file")


def check_rows(path: str, written: int, visible: int) -> None:
    """Fail if the driver does not see all rows that the executors have written."""
    if written != visible:
        raise RuntimeError(f"{path} is not shared: {written} rows were written, the driver sees {visible}")


def drop_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete stored tables; returns how many there were."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        stored = jvm.org.apache.hadoop.fs.Path(path)
        stored.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(stored, True)
    return len(paths)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Own the tables stored inside the block and delete them at its end.

    Write or collect results before the block ends: they may read these tables. Tables of
    other blocks, before or around this one, are left alone.
    """
    own: list[str] = []
    token = _OWNERS.set((*_OWNERS.get(), own))
    try:
        yield own
    finally:
        _OWNERS.reset(token)
        drop_paths(spark, own)
