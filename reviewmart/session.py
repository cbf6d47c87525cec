"""Session defaults and the shared staging folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Paths staged so far in each open ``staged_until_done`` block.
_open: list[list[str]] = []


def build_session(app_name: str = "reviewmart", **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Master, memory and shuffle width belong to the cluster and come from
    ``spark-submit`` or ``conf``; AQE then coalesces or splits partitions at run time.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines hold no copy there, ship it with ``--py-files`` instead.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def staging_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the shared one named by ``spark.checkpoint.dir``.

    Only a local master, where every task shares this machine, may leave it unset; it then is
    the checkpoint folder below the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoint"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging folder."""
    app = spark.sparkContext.applicationId
    return f"{staging_root(spark)}/reviewmart/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    for open_paths in _open:
        open_paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of written tables, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder.getFileSystem(conf).delete(folder, True)


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block, also of a failed one, what was staged inside it."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open.pop()
        for path in paths:
            remove(spark, path)
