"""Working folders that all executors see."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the session's checkpoint folder.

    A temporary folder is taken only where the session names none and all runs
    on one machine (master local); elsewhere that raises.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tarn-", dir="/tmp")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a working folder and read again, which cuts its lineage."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Threads inside ``listed_by_tasks``, and the session's own settings, which the last one out puts back.
_LISTING, _LOCK = {"threads": 0, "before": {}}, threading.Lock()


@contextmanager
def listed_by_tasks(spark: SparkSession) -> Iterator[None]:
    """Spark's readers made inside list many folders by one job with few tasks, each of which goes down its folders.

    By default each level of more than 32 folders below a folder is a job of its own with a task a folder.
    """
    own = "spark.sql.sources.parallelPartitionDiscovery"
    now = {"threshold": 4, "parallelism": 4 * spark.sparkContext.defaultParallelism}
    with _LOCK:
        if not _LISTING["threads"]:
            _LISTING["before"] = {n: spark.conf.get(f"{own}.{n}") for n in now}
            for n, value in now.items():
                spark.conf.set(f"{own}.{n}", value)
        _LISTING["threads"] += 1
    try:
        yield
    finally:
        with _LOCK:
            _LISTING["threads"] -= 1
            if not _LISTING["threads"]:
                for n, value in _LISTING["before"].items():
                    spark.conf.set(f"{own}.{n}", value)


def plain_path(path: Column, encoded: bool = False) -> Column:
    """A path as one text however Spark lists it: no ``file:`` in front; ``encoded`` for URIs, whose %20 are blanks.

    It is made for each line that a stream reads, so only paths with a % are decoded, and none meets a regular expression.
    """
    if encoded:
        path = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.when(F.startswith(path, F.lit("file:/")), F.concat(F.lit("/"), F.ltrim(F.substr(path, F.lit(6)), F.lit("/")))).otherwise(path)


def _store(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a path, whatever its store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if it doesn't exist."""
    store, where = _store(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(where) if f.isDirectory()) if store.exists(where) else []


def moved(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder; the folders above the new name are made. The new name must be free."""
    store, where = _store(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    store.mkdirs(to.getParent())
    if store.exists(to) or not store.rename(where, to):
        raise OSError(f"can't move {source} to {target}")


def removed(spark: SparkSession, path: str) -> None:
    store, where = _store(spark, path)
    store.delete(where, True)


def without_globs(path: str) -> str:
    """A path for Spark's readers, whose glob characters stand for themselves."""
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in path)
