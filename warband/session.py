"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

#: Spark's setting for the bytes of a batch that goes to a Python worker, and the value taken where the caller sets none. Whole
#: texts and shingle sets pass through Arrow; at Spark's 64 MB and 10,000 rows a task holds batches of tens of MB, several times
#: over, in the executor's native memory and in its worker. Rows are never dropped or cut: more batches follow.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "warband",
              extra: dict | None = None) -> SparkSession:
    """A session with the settings the jobs are written for (UTC, AQE on)."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` is used as is where it is set (a cluster names a shared folder
    there). Where it is unset, a fresh folder under the warehouse location is taken; on a
    cluster that location must be shared storage too, so a plain local path raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        if not local and (":" not in warehouse.split("/")[0] or warehouse.startswith("file:")):
            raise ValueError("set spark.checkpoint.dir to a shared folder: neither it nor the warehouse is shared")
        if local:
            path = tempfile.mkdtemp(prefix="warband-ckpt-")
        else:
            path = f"{warehouse.rstrip('/')}/_scratch-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a parquet table in the checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the plan once (a reliable RDD
    checkpoint recomputes it to write), and later reads are column-pruned scans. The
    folder is shared storage on a cluster, so a lost executor costs only a re-read.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_WRITTEN: list[str] = []
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_scope():
    """The paths of the tables that this thread materializes inside the block, as a list."""
    token = _SCOPE.set([])
    try:
        yield _SCOPE.get()
    finally:
        _SCOPE.reset(token)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables that no DataFrame in use reads any more."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if p in _WRITTEN:
            _WRITTEN.remove(p)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote, once no result that reads them is needed; their number."""
    jvm, n = spark.sparkContext._jvm, 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return n


def materialize_observed(df: DataFrame, label: str, **metrics) -> tuple[DataFrame, dict]:
    """``materialize`` that also returns aggregate ``metrics`` (name → Column) of the rows
    written, collected by the same job (``DataFrame.observe``) instead of a second pass."""
    obs = Observation(label)
    out = materialize(df.observe(obs, *[c.alias(k) for k, c in metrics.items()]), label)
    return out, obs.get


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``warband`` importable in the Python workers of this SparkContext.

    The Arrow kernels (MinHash, DBSCAN blocks, indel similarity) are imported by the workers.
    When the package is not installed on the executors, a zip of it is added once per context
    with ``addPyFile``, which Spark copies to every executor. Batches sent to the workers are bounded by ``BATCH_BYTES``
    unless the session has a value of its own.
    """
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)
    sc = spark.sparkContext
    key = (id(sc), sc.applicationId)
    if key in _SHIPPED:
        return
    import os
    import zipfile
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="warband-pkg-"), "warband.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(key)
