"""Session settings, and tables written once to the shared folder and read back.

A written table cuts lineage: later steps read it instead of repeating the work before it, and
lost executors cost only the tasks they were running.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark deletes the shuffle files of a query when it ends, and not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_roots: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def build_session(app: str = "velotrace", master: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's, or in local mode a fresh one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _roots:
        _roots[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _roots[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def _held(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def written(df: DataFrame, label: str, conf: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``df``, read back from a compressed Parquet table in the shared folder.

    Later steps read the table, so the shuffle files that led to it go as soon as it is there.
    Settings in ``conf`` hold while it is written.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    with _held(spark, {_CLEANUP: "true"} | (conf or {})):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``written(make(), label)``, after which the tables that ``make`` wrote are deleted.

    Nothing else may read those: ``make`` must not hand them out but in its result.
    """
    before = {app: len(paths) for app, paths in _written.items()}
    df = written(make(), label)
    spark = df.sparkSession
    paths = _written[spark.sparkContext.applicationId]
    first = before.get(spark.sparkContext.applicationId, 0)
    _delete(spark, paths[first:-1])
    del paths[first:-1]
    return df


def _delete(spark: SparkSession, paths: list[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def drop_written(spark: SparkSession) -> None:
    """Delete the intermediate tables this session wrote; results built on them end here."""
    _delete(spark, _written.pop(spark.sparkContext.applicationId, []))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the intermediate tables that were written inside."""
    paths = _written.setdefault(spark.sparkContext.applicationId, [])
    before = len(paths)
    try:
        yield
    finally:
        _delete(spark, paths[before:])
        del paths[before:]
