"""The file catalogue: what a lake holds, rolled up, hashed and compared with what exists."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarn.sources.folders import listed_by_tasks

FOOTER = "path string, size long, modified timestamp, n_rows long, n_row_groups int, fields array<struct<name: string, type: string, nullable: boolean>>, stats array<struct<name: string, min_value: string, max_value: string, null_count: long>>"

#: Files whose footers a task holds at once.
FOOTERS = 256

# Physical Parquet types by their catalogue names.
TYPE_NAMES = {
    "BOOLEAN": "boolean", "INT32": "int32", "INT64": "int64", "INT96": "timestamp", "FLOAT": "float",
    "DOUBLE": "double", "BYTE_ARRAY": "string", "FIXED_LEN_BYTE_ARRAY": "fixed_len_byte_array",
}


def type_name(physical: Column) -> Column:
    """The catalogue's name of a physical type; ``unknown`` for others."""
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.upper(physical)), F.lit("unknown"))


def list_parquet(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files below ``root``: path, length, modificationTime. Summary files aren't listed."""
    with listed_by_tasks(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.select("path", "length", "modificationTime")
    return files.where(F.lower("path").endswith(".parquet") & ~F.substring_index("path", "/", -1).isin("_metadata", "_common_metadata"))


def open_store(path: str):
    """Arrow's file system and path of a listed path: local, hdfs, s3 (s3a and s3n are its names in Hadoop), gs and abfs, as far as Arrow has them."""
    from pyarrow import fs

    if path.startswith(("/", "file:/")):  # listed paths are names, not URIs, and may have blanks or %
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    scheme, mark, rest = path.partition("://")
    return fs.FileSystem.from_uri(f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else path)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in (whole.slice(k, FOOTERS) for whole in batches for k in range(0, whole.num_rows, FOOTERS)):
        rows = []
        for r in batch.to_pylist():
            store, path = open_store(r["path"])
            with store.open_input_file(path) as f:
                meta = pq.ParquetFile(f).metadata
            leaves = [meta.schema.column(k) for k in range(len(meta.schema))]
            fields = [{"name": c.name, "type": TYPE_NAMES.get(c.physical_type, "unknown"), "nullable": c.max_definition_level > 0} for c in leaves]
            stats = [_column_stats(meta, k) for k in range(len(leaves))]
            rows.append({"stats": stats, "path": r["path"], "size": r["length"], "modified": r["modificationTime"], "n_rows": meta.num_rows, "n_row_groups": meta.num_row_groups, "fields": fields})
        yield pa.RecordBatch.from_pylist(rows, schema=_schema(batch.schema.field("modificationTime").type))


def _column_stats(meta, k: int) -> dict:
    """Minimum, maximum (as text) and nulls of a leaf over a file's row groups, as far as its footer tells them."""
    chunks = [meta.row_group(g).column(k).statistics for g in range(meta.num_row_groups)]
    bounds = [c for c in chunks if c is not None and c.has_min_max]
    nulls = [c.null_count for c in chunks if c is not None and c.has_null_count]
    text = lambda x: x.decode("utf-8", "replace") if isinstance(x, bytes) else str(x)
    low, high = (text(min(c.min for c in bounds)), text(max(c.max for c in bounds))) if bounds else (None, None)
    return {"name": meta.schema.column(k).path, "min_value": low, "max_value": high, "null_count": sum(nulls) if len(nulls) == len(chunks) else None}


def _schema(time: pa.DataType) -> pa.Schema:
    stat = pa.struct([("name", pa.string()), ("min_value", pa.string()), ("max_value", pa.string()), ("null_count", pa.int64())])
    field = pa.struct([("name", pa.string()), ("type", pa.string()), ("nullable", pa.bool_())])
    return pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", time), ("n_rows", pa.int64()), ("n_row_groups", pa.int32()), ("fields", pa.list_(field)), ("stats", pa.list_(stat))])


def scan_footers(files: DataFrame, partitions: int = 0) -> DataFrame:
    """Rows, size and fields of listed files from their footers alone; no data page is read.

    Spark lists some 30 small files a task, for which starting it takes longer
    than reading footers; so there are some tasks a core at most.
    """
    files = files.select("path", "length", "modificationTime")
    dealt = files.repartition(partitions, "path") if partitions else files.coalesce(3 * files.sparkSession.sparkContext.defaultParallelism)
    return dealt.mapInArrow(_footers, FOOTER)


def scanned(spark: SparkSession, root: str, time: str) -> DataFrame:
    """Rows and time range of each file of a lake, by scanning one column."""
    rows = spark.read.parquet(root).select(F.col("_metadata.file_path").alias("path"), F.col(time).alias("_t"))
    return rows.groupBy("path").agg(F.count("*").alias("n_rows"), F.min("_t").alias("min_ts"), F.max("_t").alias("max_ts"))


def time_ranges(rows: DataFrame, by: list[str], time: str) -> DataFrame:
    """Rows and time range of each group, and whether any row has a time."""
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.min(time).alias("min_ts"), F.max(time).alias("max_ts"), F.max(F.col(time).isNotNull()).alias("has_time"))


SUMMARY = {
    "file_count": F.count, "total_rows": F.sum, "total_bytes": F.sum, "first_created": F.min, "last_modified": F.max,
}


def _summary(rows: str = "n_rows", size: str = "size", created: str = "created", modified: str = "modified") -> list[Column]:
    of = {"file_count": "*", "total_rows": rows, "total_bytes": size, "first_created": created, "last_modified": modified}
    return [f(of[name]).alias(name) for name, f in SUMMARY.items()]


def partition_summary(files: DataFrame) -> DataFrame:
    return files.groupBy("tenant", "dataset", "partition").agg(*_summary())


def roll_up(files: DataFrame) -> DataFrame:
    """Summaries of partitions (level leaf) and of whole datasets (level root), in one pass."""
    sets = files.groupingSets([["tenant", "dataset", "partition"], ["tenant", "dataset"]], "tenant", "dataset", "partition")
    return sets.agg(F.when(F.grouping("partition") == 1, "root").otherwise("leaf").alias("level"), *_summary())


def summary_documents(files: DataFrame, by: list[str], with_stats: bool = True, schema_too: bool = False) -> DataFrame:
    """One JSON document for each group: version, row, size and file counts, and the files.

    ``with_stats`` adds size and rows to each file; ``schema_too`` adds the
    fields and column statistics that the catalogue has of each file.
    """
    entry = ["path", *(["size", "n_rows"] if with_stats else []), *(["fields", "stats"] if schema_too else [])]
    rows = files.groupBy(*by).agg(F.sum("n_rows").alias("num_rows"), F.sum("size").alias("total_size_bytes"), F.count("*").alias("file_count"), F.sort_array(F.collect_list(F.struct(*entry))).alias("files"))
    return rows.select(*by, F.to_json(F.struct(F.lit(1).alias("version"), "num_rows", "total_size_bytes", "file_count", "files")).alias("document"))


def schema_documents(files: DataFrame, by: list[str]) -> DataFrame:
    """One JSON document for each group with its schema alone: version, and each field's name, type, nullability and number of files.

    The type is that of the newest file that has the field (by ``modified``, then path).
    """
    rows = files.select(*by, "modified", "path", F.inline("fields"))
    newest = F.max(F.struct("modified", "path", "type"))["type"]
    each = rows.groupBy(*by, "name").agg(newest.alias("type"), F.max("nullable").alias("nullable"), F.count_distinct("path").alias("n_files"))
    listed = F.sort_array(F.collect_list(F.struct("name", "type", "nullable", "n_files"))).alias("fields")
    return each.groupBy(*by).agg(listed).select(*by, F.to_json(F.struct(F.lit(1).alias("version"), "fields")).alias("document"))


def completeness(listing: DataFrame, path: str = "path") -> DataFrame:
    """For each folder: has it a summary, a schema-only summary, and how many data files."""
    name = F.substring_index(path, "/", -1)
    return listing.groupBy(F.regexp_replace(path, "/[^/]*$", "").alias("folder")).agg(
        F.max(name == "_metadata").alias("has_summary"), F.max(name == "_common_metadata").alias("has_schema"), F.count_if(F.lower(name).endswith(".parquet")).alias("n_files")
    )


def column_statistics(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """One row a column: min, max, nulls and distinct values, as text where types differ; one pass over the data."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    parts = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(dict(df.dtypes)[c]).alias("data_type"), F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value"),
            F.count_if(F.col(c).isNull()).alias("null_count"), distinct(c).alias("distinct_count"),
        )
        for c in columns
    ]
    return df.agg(F.array(*parts).alias("all")).select(F.inline("all"))


def batch_hash(files: DataFrame, by: list[str], key: str = "path", size: str = "size") -> DataFrame:
    """One hash for each group of input files, whatever the order of the listing: SHA-256 over key:size: in key order."""
    text = F.concat(F.col(key), F.lit(":"), F.col(size).cast("string"), F.lit(":"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), text.alias("x"))))
    return files.groupBy(*by).agg(F.sha2(F.array_join(F.transform(entries, lambda e: e["x"]), ""), 256).alias("batch_hash"))


def tree_hash(files: DataFrame, by: list[str], key: str = "path", size: str = "size") -> DataFrame:
    """One hash for each group of input files, whatever the order of the listing, from hashes of ranges.

    Files are dealt to 4096 ranges by the hash of their keys; a range's hash is
    that of its keys and sizes in key order, a group's that of its ranges'
    hashes in order. So no array holds more than a group's 4096th part, or
    4096 hashes.
    """
    name = F.left(F.sha2(F.col(key), 256), F.lit(3))
    entries = F.sort_array(F.collect_list(F.concat(F.col(key), F.lit(":"), F.col(size).cast("string"))))
    ranges = files.groupBy(*by, name.alias("_range")).agg(F.sha2(F.array_join(entries, ","), 256).alias("_hash"))
    whole = F.sort_array(F.collect_list(F.concat(F.col("_range"), F.lit(":"), F.col("_hash"))))
    return ranges.groupBy(*by).agg(F.sha2(F.array_join(whole, ","), 256).alias("tree_hash"))


def unprocessed(batches: DataFrame, catalogue: DataFrame, on: str = "batch_hash") -> DataFrame:
    """Batches that the catalogue doesn't have yet."""
    return batches.join(catalogue.select(on).distinct(), on, "left_anti")


def orphans(catalogue: DataFrame, listing: DataFrame, key: str = "path") -> DataFrame:
    """Catalogue rows whose file is gone."""
    return catalogue.join(listing.select(key), key, "left_anti")


def without_keys(table: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return table.join(keys.select(*on).distinct(), on, "left_anti")


def upserted(table: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The latest row of each key, with its version: how many rows it has had."""
    newest = F.row_number().over(W.partitionBy(*key).orderBy(*order))  # the filter is applied before the shuffle as well
    rows = table.withColumn("_place", newest).where("_place = 1").drop("_place")
    return beside(rows, table.groupBy(*key).agg(F.count("*").alias("version")), key)


def with_status(wanted: DataFrame, status: DataFrame, on: list[str]) -> DataFrame:
    """Wanted partitions with their summaries; those without one need to be made."""
    rows = wanted.join(status, on, "left")
    return rows.select(*on, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("file_count", "total_rows", "total_bytes")], F.col("file_count").isNull().alias("needs_regeneration"))


def expired(table: DataFrame, now: Column, until: str = "expires_at") -> DataFrame:
    return table.where(F.col(until) < now)


def beside(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the other columns of ``table``, which has one row for each of their keys; keys may be null."""
    own = table.select(*[F.col(k).alias(f"_key{n}") for n, k in enumerate(keys)], *[c for c in table.columns if c not in keys])
    return rows.join(own, [rows[k].eqNullSafe(own[f"_key{n}"]) for n, k in enumerate(keys)]).drop(*[f"_key{n}" for n in range(len(keys))])


def numbered_parts(rows: DataFrame, by: list[str], order: list[str], size: Column, limit: int, bucket: Column | None = None, tasks: int | None = None) -> DataFrame:
    """``rows`` with a part number from 1: by running size in order, a new part starts once the limit is reached.

    ``bucket`` follows the order (such as its minute): sums of buckets are
    added up first, so that no window holds more than one bucket's rows.
    ``tasks`` deals the buckets to so many tasks, else to the session's number.
    """
    if bucket is None:
        bucket = F.lit(0)
    rows = rows.withColumn("_bucket", bucket).withColumn("_size", F.coalesce(size, F.lit(0)))
    sums = rows.groupBy(*by, "_bucket").agg(F.sum("_size").alias("_sum"))
    sums = sums.withColumn("_base", F.sum("_sum").over(W.partitionBy(*by).orderBy("_bucket")) - F.col("_sum")).drop("_sum")
    inside = F.sum("_size").over(W.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col("_size")
    rows = rows if tasks is None else rows.repartition(tasks, *by, "_bucket")
    rows = beside(rows.withColumn("_inside", inside), sums, [*by, "_bucket"])
    part = (F.floor((F.col("_base") + F.col("_inside")) / limit) + 1).cast("long")
    return rows.withColumn("part", part).drop("_bucket", "_size", "_inside", "_base")
