"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    A temporary folder is set only where the session names none and all runs
    on one machine (master local, as in tests); elsewhere that raises.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tarn-", dir="/tmp"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: it cuts the lineage and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """``df`` as an eager checkpoint in the shared folder; order and partitions stay."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name starting with ``name`` that ``df`` doesn't have (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def n_words(text: Column) -> Column:
    """The number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``df`` with a gapless rank from 0 in ``order`` as column ``name``.

    Range partitions are sorted and checkpointed, so no task holds all rows;
    only the row count of each partition (one number a partition) goes
    through the driver. ``order`` should end in a unique column, which also
    lets equal keys spread over partitions.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part, place = fresh(df, "_part"), fresh(df, "_place")
    rows = kept(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    rows = rows.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    counts = {r[0]: r[1] for r in rows.groupBy(part).count().collect()}
    bases, total = [], 0
    for p in sorted(counts):
        bases.append((p, total))
        total += counts[p]
    starts = df.sparkSession.createDataFrame(bases, f"{part} int, _base long")
    return rows.join(F.broadcast(starts), part, "left").withColumn(name, F.col("_base") + F.col(place)).drop(part, place, "_base")


_caches: dict = {}


def remembers(name: str, forget) -> None:
    """Registers how what a worker process remembers for an operator is dropped."""
    _caches[name] = forget


def let_go(name: str) -> None:
    """Drops what this process remembers for operators other than ``name``: workers outlive the stage that they were started for."""
    for other, forget in _caches.items():
        if other != name:
            forget()


def give_back() -> None:
    """Returns free memory of Arrow and of the C library to the system, which would stay with an idle worker otherwise."""
    import ctypes

    pa.default_memory_pool().release_unused()
    if hasattr(library := ctypes.CDLL(None), "malloc_trim"):
        library.malloc_trim(0)


def tidy(name: str, work):
    """A function over batches as ``work``, in a worker that first lets go of other operators' memory and gives back its own at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(name)
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def pieces_of(batch: pa.RecordBatch, column: str, at_once: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``at_once`` bytes of a binary or text column."""
    piece = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(column))), 0).to_numpy().astype(np.int64)) // at_once
    cuts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1], [True]])) if len(piece) else []
    return (batch.slice(i, j - i) for i, j in zip(cuts[:-1], cuts[1:]))  # noqa: B905
