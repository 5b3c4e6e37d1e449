"""Intermediate tables of the operators, kept in the shared folder of the session."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import checkpoint_dir, shared_path


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None or spark.sparkContext._jsc.sc().isStopped():
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of the upstream plan, and
    later readers prune columns.  The folder is removed when the application ends.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
