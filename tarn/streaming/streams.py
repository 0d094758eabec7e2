"""Continuous packing with Structured Streaming's file source."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import threading

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from tarn.operators import pack
from tarn.sources import ndjson
from tarn.sources.folders import plain_path

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def lines_of(spark: SparkSession, source: str, files_per_batch: int | None = None, clean: str | None = None, archive: str | None = None) -> DataFrame:
    """New files' lines as a stream: value, path, size. ``clean`` deletes or archives files once their batch is committed."""
    reader = spark.readStream.format("text").schema("value string").option("recursiveFileLookup", True)
    options = {"maxFilesPerTrigger": files_per_batch, "cleanSource": clean, "sourceArchiveDir": archive}
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, value)
    return reader.load(source).select("value", plain_path(F.col("_metadata.file_path"), encoded=True).alias("path"), F.col("_metadata.file_size").alias("size"))


def run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], interval: str | None = None):
    """Starts a query that hands every batch to ``each``: on an interval, or over all that is there, and then ends."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def lanes(each_lane: dict[str, tuple[DataFrame, str, Callable[[DataFrame, int], None], str]]) -> dict:
    """Starts a query for each lane (stream, checkpoint, sink, interval), which run side by side, each in a scheduler pool of its name.

    A lane's batches wait for its own interval and its own batches only.
    Under ``spark.scheduler.mode`` FAIR pools share the executors, so a lane
    of small datasets isn't held up by the tasks of a large one; give it a
    weight or a minimum share in ``spark.scheduler.allocation.file``.
    """
    context, running = None, {}
    for name, (stream, checkpoint, each, interval) in each_lane.items():
        context = stream.sparkSession.sparkContext
        before = context.getLocalProperty("spark.scheduler.pool")
        context.setLocalProperty("spark.scheduler.pool", name)  # the query's thread takes it over
        try:
            running[name] = run(stream, checkpoint, each, interval)
        finally:
            context.setLocalProperty("spark.scheduler.pool", before)
    return running


def pack_sink(lake: str, tenant: str, dataset: str, **options) -> Callable[[DataFrame, int], None]:
    """Packs every batch of lines (value, path, size) into a lake as ``pack`` does; see ``pack_lines``.

    A batch is known by its files, not by the stream's number for it: streams
    over different sources may feed one lake, a stream whose checkpoint is lost
    starts anew and packs nothing twice, and what a stream packed no later
    ``pack`` of its source takes again.
    """
    how = pack.Options(**options)

    def each(batch: DataFrame, number: int) -> None:
        pack.pack_lines(batch, lake, tenant, dataset, how)

    return each


class Progress(StreamingQueryListener):
    """Adds up what streaming queries report: batches, rows, and their observed metrics by name."""

    def __init__(self):
        self.batches, self.rows, self.metrics, self.ended = 0, 0, {}, threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.batches, self.rows = self.batches + 1, self.rows + event.progress.numInputRows
        for name, row in event.progress.observedMetrics.items():
            for metric, value in row.asDict().items():
                self.metrics[name, metric] = self.metrics.get((name, metric), 0) + (value or 0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.set()


def split_sink(good: str, bad: str) -> Callable[[DataFrame, int], None]:
    """Writes records and quarantined lines of a batch, each batch to its own folder, so a batch that runs again replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        lines = ndjson.classified(ndjson.dealt(batch)).persist()
        try:
            lines.where("status = 'valid'").select("value", "path").write.mode("overwrite").parquet(f"{good}/batch={number}")
            lines.where("status in ('not json', 'not an object')").select("value", "path", F.col("status").alias("reason")).write.mode("overwrite").parquet(f"{bad}/batch={number}")
        finally:
            lines.unpersist()

    return each


def refreshed_sink(registry: Callable[[SparkSession], DataFrame], on: list[str], out: str) -> Callable[[DataFrame, int], None]:
    """Joins each batch with the registry as it is when the batch runs."""

    def each(batch: DataFrame, number: int) -> None:
        batch.join(registry(batch.sparkSession), on, "left").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return each


class Accumulator(StatefulProcessor):
    """Gathers bytes and files of a dataset, flushes at the threshold and starts anew; flushes are counted.

    A timer flushes what has waited for ``seconds`` (processing time).
    """

    def __init__(self, threshold: int, seconds: int | None = None):
        self.threshold, self.seconds = threshold, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("gathered", "bytes long, files long, flushes long, timer long")

    def _now(self, key, add_bytes: int, add_files: int, now: int, expired: bool = False) -> pd.DataFrame:
        """Adds to the state, and flushes it if it is large or its timer has run out; a flush takes the timer with it."""
        size, files, flushes, timer = self.state.get() if self.state.exists() else (0, 0, 0, 0)
        size, files, timer = size + add_bytes, files + add_files, 0 if expired else timer
        reason = "size" if size >= self.threshold else "time" if expired and files else None
        row = pd.DataFrame({"dataset": [key[0]], "bytes": [size], "files": [files], "flush_count": [flushes + bool(reason)], "reason": [reason]})
        if reason and timer:
            self.handle.deleteTimer(timer)
        if reason:
            timer = 0
        elif self.seconds is not None and files and not timer:  # from the first file that waits
            timer = now + self.seconds * 1000
            self.handle.registerTimer(timer)
        self.state.update((0, 0, flushes + 1, timer) if reason else (size, files, flushes, timer))
        return row

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        frames = list(rows)
        now = 0 if self.seconds is None else timerValues.getCurrentProcessingTimeInMs()
        yield self._now(key, int(sum(f["size"].sum() for f in frames)), int(sum(f["files"].sum() for f in frames)), now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._now(key, 0, 0, timerValues.getCurrentProcessingTimeInMs(), expired=True)

    def close(self) -> None:
        pass


class Holder(StatefulProcessor):
    """Holds the files of a dataset until they are large enough together or the first has waited long enough, and lets all go at once.

    The files wait in list state, beside their sum and the timer in value state.
    Nothing is let go twice: what leaves goes from the state in the same step.
    """

    def __init__(self, threshold: int, seconds: int | None = None):
        self.threshold, self.seconds = threshold, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "path string, length long")
        self.sum = handle.getValueState("sum", "bytes long, flushes long, timer long")

    def _flushed(self, key, reason: str) -> pd.DataFrame:
        _, flushes, timer = self.sum.get()
        rows = list(self.waiting.get())
        self.waiting.clear()
        if timer and reason == "size":
            self.handle.deleteTimer(timer)
        self.sum.update((0, flushes + 1, 0))
        return pd.DataFrame({"dataset": [key[0]] * len(rows), "path": [r[0] for r in rows], "length": [r[1] for r in rows], "flush": [flushes + 1] * len(rows), "reason": [reason] * len(rows)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        size, flushes, timer = self.sum.get() if self.sum.exists() else (0, 0, 0)
        for frame in rows:
            new = [(str(p), int(n)) for p, n in zip(frame["path"], frame["length"])]  # noqa: B905
            self.waiting.appendList(new)
            size += sum(n for _, n in new)
        if self.seconds is not None and not timer:  # from the first file that waits
            timer = timerValues.getCurrentProcessingTimeInMs() + self.seconds * 1000
            self.handle.registerTimer(timer)
        self.sum.update((size, flushes, timer))
        if size >= self.threshold:
            yield self._flushed(key, "size")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.waiting.exists():
            yield self._flushed(key, "time")

    def close(self) -> None:
        pass


FLUSHED = "dataset string, path string, length long, flush long, reason string"


def files_of(spark: SparkSession, source: str, dataset: Column, files_per_batch: int | None = None) -> DataFrame:
    """New files as a stream: dataset (an expression over ``path``), path and length; contents aren't read."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(source).select(dataset.alias("dataset"), plain_path(F.col("path")).alias("path"), "length")


def flushed(files: DataFrame, threshold: int, seconds: int | None = None) -> DataFrame:
    """The files of a stream (dataset, path, length) that are let go, with the number of the flush and its reason; needs the RocksDB state store."""
    mode = "None" if seconds is None else "ProcessingTime"
    return files.groupBy("dataset").transformWithStateInPandas(Holder(threshold, seconds), outputStructType=FLUSHED, outputMode="Update", timeMode=mode)


def flush_sink(lake: str, tenant: str, **options) -> Callable[[DataFrame, int], None]:
    """Packs the files that a batch lets go, each flush of a dataset as one batch of its lake; a batch that runs again packs nothing twice."""
    how = pack.Options(**options)

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            for r in batch.select("dataset", "flush").distinct().orderBy("dataset", "flush").collect():  # a row a dataset that flushes just now
                mine = batch.where(F.col("dataset").eqNullSafe(F.lit(r.dataset)) & (F.col("flush") == r.flush))
                pack.pack_files(mine.select("path", "length"), lake, tenant, r.dataset, how)
        finally:
            batch.unpersist()

    return each


GATHERED = "dataset string, bytes long, files long, flush_count long, reason string"


def accumulated(files: DataFrame, threshold: int, seconds: int | None = None) -> DataFrame:
    """A stream of (dataset, size, files) rows as one state row for each dataset and batch; needs the RocksDB state store."""
    mode = "None" if seconds is None else "ProcessingTime"
    return files.groupBy("dataset").transformWithStateInPandas(Accumulator(threshold, seconds), outputStructType=GATHERED, outputMode="Update", timeMode=mode)
