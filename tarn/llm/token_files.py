"""Token ids of documents in flat binary files.

Range partitions in ascending id order each write three files: ``tokens``
(little-endian unsigned integers, 16 bits wide if the vocabulary allows, else
32), ``offsets`` (64-bit places of the documents in it, and its length) and
``ids`` (64-bit document ids). A partition's base, the number of ids before
it, is the prefix sum of the partitions' token counts: one number each goes
through the driver. ``index`` lists parts and bases. Readers map the files
into memory, or read pieces of them where the store isn't a local one.

A task writes under a name of its own and renames at the end, so a lost
executor leaves no half file in place.

Defined cases: a null text is empty and has the end id alone; a null id is
kept as the smallest 64-bit integer and read back as null, first in order.
Repeated rows are written one after the other. An empty table gives an empty
result. Columns other than the two that are named aren't read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder
from .encoding import encoder, tokenizer_path

NO_ID = np.iinfo(np.int64).min
PARTS = "part int, n_docs long, n_tokens long"


def _writer(folder: str, path: str, keeps_spaces: bool, end_id: int, dtype: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), uuid.uuid4().hex
        store, root = fs.FileSystem.from_uri(folder)
        encode, n_docs, n_tokens = encoder(path, keeps_spaces), 0, 0
        names = {k: (f"{root}/.{k}-{part:05d}-{own}", f"{root}/{k}-{part:05d}.bin") for k in ("tokens", "offsets", "ids")}
        out = {k: store.open_output_stream(own_name) for k, (own_name, _) in names.items()}
        for batch in batches:
            out["ids"].write(batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            for ids, counts in encode(batch.column(1).to_pylist()):
                ends = np.cumsum(counts)
                with_end = np.insert(ids, ends, end_id)
                out["tokens"].write(with_end.astype(dtype).tobytes())
                out["offsets"].write((n_tokens + np.concatenate([[0], (ends + np.arange(1, len(ends) + 1))[:-1]])).astype("<i8").tobytes())
                n_tokens += len(with_end)
                n_docs += len(counts)
        out["offsets"].write(np.array([n_tokens], "<i8").tobytes())
        for k, (own_name, name) in names.items():
            out[k].close()
            store.move(own_name, name)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_docs": [n_docs], "n_tokens": [n_tokens]})

    return write


def write_token_files(df: DataFrame, folder: str, tokenizer: str, keeps_spaces: bool, end_id: int, vocabulary: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files below ``folder`` (a URI that all executors see) and returns their parts: part, n_docs, n_tokens, base."""
    spark = df.sparkSession
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange(n, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))
    parts = sorted(map(tuple, rows.mapInArrow(_writer(folder, tokenizer, keeps_spaces, end_id, dtype), PARTS).collect()))
    bases, base = [], 0
    for part, n_docs, n_tokens in parts:
        bases.append((part, n_docs, n_tokens, base))
        base += n_tokens
    with store.open_output_stream(f"{root}/index.json") as f:
        f.write(json.dumps({"dtype": dtype, "end_id": end_id, "parts": bases}).encode())
    return spark.createDataFrame(bases, f"{PARTS}, base long")


def opened(folder: str, name: str, dtype: str) -> np.ndarray:
    """The numbers of a file: a memory map where the store is local, else read."""
    store, root = fs.FileSystem.from_uri(folder)
    if not store.get_file_info(f"{root}/{name}").size:
        return np.zeros(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(f"{root}/{name}", dtype, "r")
    with store.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read(), dtype)


def _reader(folder: str, dtype: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):  # noqa: B905
                tokens = opened(folder, f"tokens-{part:05d}.bin", dtype)
                offsets = opened(folder, f"offsets-{part:05d}.bin", "<i8")
                ids = opened(folder, f"ids-{part:05d}.bin", "<i8")
                for k in range(0, len(ids), 4096):
                    at = np.array(offsets[k : k + 4097])
                    crc = [zlib.crc32(tokens[i:j].astype("<u4").tobytes()) for i, j in zip(at, at[1:])]  # noqa: B905
                    own = np.array(ids[k : k + 4096])
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(own, mask=own == NO_ID), "start": base + at[:-1], "n_tokens": np.diff(at), "ids_crc32": pa.array(crc, pa.int64())})

    return read


def read_token_files(spark: SparkSession, folder: str, parts: DataFrame, dtype: str = "<u2") -> DataFrame:
    """One row a document from the files: doc_id, start, n_tokens and ids_crc32 (of its ids as 32-bit integers)."""
    n = max(1, parts.count())
    return parts.select("part", "base").repartitionByRange(n, "part").mapInArrow(_reader(folder, dtype), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(df: DataFrame) -> DataFrame:
    """Writes ``df`` as byte-level ids, each document ended by id 2, and reads the files back."""
    folder = new_folder(df.sparkSession, "tokens")
    parts = write_token_files(df, folder, tokenizer_path("byte_bpe_50k.json"), True, 2, 50257)
    return read_token_files(df.sparkSession, folder, parts)
