"""Session helpers shared by every job."""

from __future__ import annotations

import atexit
import dataclasses
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of materialised tables are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "tidemark",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # the operators compare event times and scoring dates in UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event-time jobs cast ``timestamp_ntz`` to ``timestamp`` and cut windows from the
    epoch; both are read in the session zone, which these jobs fix to UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the SparkContext with it.

    The cluster names it in ``spark.checkpoint.dir``; that value always wins.  Only a
    local session (tests, laptops) without the setting gets a private folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A folder below the shared checkpoint location, for intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tidemark", *parts)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this application, unless the session has already ended."""
    jvm = spark.sparkContext._jvm
    if jvm is None or spark.sparkContext._jsc.sc().isStopped():
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@dataclasses.dataclass
class Stored:
    """A table written below the shared folder."""

    path: str
    schema: T.StructType

    def read(self, spark: SparkSession) -> DataFrame:
        back = spark.read.schema(self.schema).parquet(self.path)
        return back.select(*[F.col("`" + c.replace("`", "``") + "`") for c in self.schema.names])


def store(df: DataFrame, partition_by: str | None = None) -> Stored:
    """Write ``df`` as Parquet below the shared checkpoint folder (it survives executor
    loss).  The folder is removed when the application ends."""
    spark = df.sparkSession
    path = shared_path(spark, "tables", uuid.uuid4().hex)
    w = df.write.partitionBy(partition_by) if partition_by else df.write
    w.parquet(path)
    atexit.register(remove_path, spark, path)
    return Stored(path, df.schema)


def materialize(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage of a table that several later jobs read: it is stored once, and
    later passes scan that copy with column pruning and, given ``partition_by``, partition
    pruning."""
    return store(df, partition_by).read(df.sparkSession)


_STAGES: dict[tuple, Stored] = {}


def stage(spark: SparkSession, name: str, inputs: list[str], build) -> DataFrame:
    """The stored output of a pipeline stage, built again only when an input has changed.

    Inputs are table paths; the names, sizes and modification times of their files decide,
    as asked of the file system that holds them.  The output lives as long as the
    application."""
    key = (spark.sparkContext.applicationId, name, *[_files(spark, p) for p in inputs])
    if key not in _STAGES:
        _STAGES[key] = store(build())
    return _STAGES[key].read(spark)


def _files(spark: SparkSession, path: str) -> tuple:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    todo, found = [root], []
    while todo:
        for s in fs.listStatus(todo.pop()):
            if s.isDirectory():
                todo.append(s.getPath())
            else:
                found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return path, tuple(sorted(found))


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    The proof is a ``limit(max_rows + 1).count()`` job, which stops early.  Larger inputs
    are returned unchanged so the planner keeps a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def checked_collect(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a small result, failing loudly instead of pulling an unbounded one."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows; refusing to bring them to the driver")
    return rows
