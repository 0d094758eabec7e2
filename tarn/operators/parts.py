"""A sink of many small Parquet files, for parts of some thousand bytes.

Spark's own writer takes longer to open such a file than to write it: its
local store starts ``chmod`` for the file, its checksums and its folder. Here
tasks write their files with Arrow. Each attempt at a task has a folder of its
own below ``_temporary``; at the end of the job the files of the attempts that
Spark has taken are moved to their places, so a task that failed, or ran twice,
leaves nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tarn.operators.catalog import open_store

#: Where attempts write, below the target; readers skip it.
TEMPORARY = "_temporary"
#: Files that are moved at once.
MOVES = 16
#: Characters that Spark writes as %XX in the folders of values, beside control characters.
_ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f")


@dataclass
class Written(WriterCommitMessage):
    """An attempt's folder and the paths of its files in it."""

    attempt: str
    files: list[str]


class PartFiles(DataSource):
    """Rows that are sorted by the columns ``by``, as a file for each of their values, in folders named key=value; ``path``, ``by`` (JSON) and ``codec`` are options."""

    @classmethod
    def name(cls) -> str:
        return "tarn_parts"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("parts are appended only")
        return _Writer(self.options["path"].rstrip("/"), json.loads(self.options["by"]), self.options["codec"], schema)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, by: list[str], codec: str, schema: StructType):
        self.path, self.by, self.codec = path, by, "none" if codec == "uncompressed" else codec
        self.columns = [f.name for f in schema if f.name not in by]
        row = StructType([f for f in schema if f.name not in by]).json()
        self.about = {"org.apache.spark.sql.parquet.row.metadata": row}  # so that types that only Spark has are read again
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        store, base = open_store(self.path)
        attempt, files = f"{TEMPORARY}/{self.job}/{uuid.uuid4().hex}", []
        task = TaskContext.get()
        own = f"part-{task.partitionId() if task else 0:05d}-{uuid.uuid4()}"  # as Spark names them

        def end(folder: str, slices: list[pa.RecordBatch]) -> None:
            name = f"{own}.c{len(files):03d}.{self.codec}.parquet"  # null and an empty text share a folder
            table = pa.Table.from_batches(slices).select(self.columns)
            store.create_dir(f"{base}/{attempt}/{folder}")
            with store.open_output_stream(f"{base}/{attempt}/{folder}/{name}") as out:
                with pq.ParquetWriter(out, table.schema, compression=self.codec, store_schema=False) as file:
                    file.write_table(table)
                    file.add_key_value_metadata(self.about)
            files.append(f"{folder}/{name}")

        now, slices = None, []
        for batch in map(_filled, iterator):
            for folder, rows in _runs(batch, self.by):
                if folder != now:
                    if slices:
                        end(now, slices)
                    now, slices = folder, []
                slices.append(rows)
        if slices:
            end(now, slices)
        return Written(attempt, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = open_store(self.path)
        files = [(m.attempt, f) for m in messages if m is not None for f in m.files]
        for folder in {base, *(f"{base}/{f.rpartition('/')[0]}" for _, f in files)}:
            store.create_dir(folder)
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda x: store.move(f"{base}/{x[0]}/{x[1]}", f"{base}/{x[1]}"), files))
        self._end(store, base)

    def abort(self, messages: list[Written | None]) -> None:
        self._end(*open_store(self.path))

    def _end(self, store, base: str) -> None:
        """Removes the job's attempts, and the folder of all jobs' unless another one writes there."""
        from pyarrow import fs

        for folder, left in ((f"{TEMPORARY}/{self.job}", True), (TEMPORARY, False)):
            where = f"{base}/{folder}"
            if store.get_file_info(where).type != fs.FileType.NotFound and (left or not store.get_file_info(fs.FileSelector(where))):
                store.delete_dir(where)


def _filled(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A batch whose null VARIANTs have parts that are empty, as Arrow writes no null below a null where a part is required."""
    for k, f in enumerate(batch.schema):
        if pa.types.is_struct(f.type) and not all(f.type.field(n).nullable for n in range(f.type.num_fields)):
            column, own = batch.column(k), [f.type.field(n) for n in range(f.type.num_fields)]
            filled = [column.field(n) if x.nullable else column.field(n).fill_null(pa.scalar(b"", x.type)) for n, x in enumerate(own)]
            batch = batch.set_column(k, f, pa.StructArray.from_arrays(filled, fields=own, mask=column.is_null()))
    return batch


def _runs(batch: pa.RecordBatch, by: list[str]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The slices of a batch in which the columns ``by`` don't change, each with its folder."""
    if not batch.num_rows:
        return
    keys = [batch.column(batch.schema.get_field_index(c)).dictionary_encode("encode") for c in by]
    codes = [k.indices.to_numpy(zero_copy_only=False) for k in keys]
    changed = np.zeros(batch.num_rows, bool)
    for code in codes:
        changed[1:] |= code[1:] != code[:-1]
    starts = [0, *np.flatnonzero(changed).tolist()]
    names = [[f"{c}={_folder(v)}" for v in k.dictionary.to_pylist()] for c, k in zip(by, keys, strict=True)]
    for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield "/".join(n[code[start]] for n, code in zip(names, codes, strict=True)), batch.slice(start, end - start)


def _folder(value) -> str:
    """A value as Spark writes it in a folder's name."""
    text = "" if value is None else str(value)
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in text) or "__HIVE_DEFAULT_PARTITION__"


def written(rows: DataFrame, path: str, by: list[str], codec: str) -> None:
    """Writes rows, dealt and sorted by the columns ``by`` (texts and numbers), to a folder that is new or has none of these files."""
    rows.sparkSession.dataSource.register(PartFiles)
    rows.write.format(PartFiles.name()).mode("append").option("by", json.dumps(by)).option("codec", codec).save(path)
