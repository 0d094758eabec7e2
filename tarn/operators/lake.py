"""What a packed lake is made of, and how it is read.

Below a lake's root lie ``data/_batch=../_try=..`` (each attempt at a batch
has a folder of its own) and the tables of ``_catalog``: ``consumed`` (an
intent: the files of a batch), ``batches`` (a row ends a batch and names its
attempt), ``files``, ``fields``, ``quarantine``, ``summaries`` (documents of at
most ``DOCUMENT`` files, those of a batch never written again), ``partitions``
(totals in ``BUCKETS`` folders by the hash of the partition, of which a batch rewrites only those it touched) and
``field_log`` (every field with its type now, when it was first and last seen
and how often its type has changed, merged batch by batch).

``read`` gives the rows of ended batches only, so a reader never meets half a
batch or an attempt that was given up. A stored column has one type for good:
when a field's type widens, its values go to another one (``a``, then
``a_v2``) from then on. ``read`` gives each field as one column of the type
that it has now, whatever its batches stored. Bounds on event times and numbers become a list of
files by the catalogue's minima and maxima before Spark opens any.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions import layout
from tarn.operators import catalog, sketches
from tarn.sources.folders import exists, folders_in, listed_by_tasks, plain_path, removed

CONSUMED = "path string, length long, _batch string"
FIELDS = "field string, path string, column string, type string, kinds array<string>, names array<string>, _batch string"
BATCHES = "tenant string, dataset string, n_files long, n_lines long, valid long, rejected long, lost long, seq long, attempt string, layout string, _batch string"
TOTALS = "tenant string, dataset string, file_count long, total_rows long, total_bytes long, first_created timestamp, last_modified timestamp, seq long, partition string, _bucket int"
LOG = "field string, path string, column string, type string, kinds array<string>, names array<string>, n_changes long, first_seq long, last_seq long, _seq long"
FILES = f"tenant string, dataset string, {catalog.FOOTER.replace('modified timestamp', 'partition string, created timestamp, modified timestamp')}, min_ts timestamp_ntz, max_ts timestamp_ntz, checksum string, _batch string"
#: Files in a summary document, and paths that a reader names one by one, at most.
DOCUMENT, PATHS = 1000, 100_000
#: Folders that the totals of partitions are dealt to, however many partitions there are.
BUCKETS = 64

# The Spark type of a kind of field.
TYPES = {"bigint": "bigint", "double": "double", "boolean": "boolean", "timestamp": "timestamp_ntz", "string": "string", "array": "array<string>", "array<bigint>": "array<bigint>", "array<double>": "array<double>", "array<boolean>": "array<boolean>"}


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A table, or an empty one if nothing has been written there yet."""
    return spark.read.schema(ddl).parquet(path) if exists(spark, path) else spark.createDataFrame([], ddl)


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Some rows as a table that needs no Python workers."""
    kind = T._parse_datatype_string(ddl)
    to_arrow = {"string": pa.string(), "bigint": pa.int64(), "array<string>": pa.list_(pa.string())}
    columns = {f.name: pa.array([r[k] for r in rows], to_arrow[f.dataType.simpleString()]) for k, f in enumerate(kind)}
    return spark.createDataFrame(pa.table(columns)) if rows else spark.createDataFrame([], ddl)


def ended(spark: SparkSession, root: str) -> DataFrame:
    """The batches that have ended, one row each."""
    return read_or_empty(spark, f"{root}/_catalog/batches", BATCHES)


def consumed(spark: SparkSession, root: str) -> DataFrame:
    """The files of ended batches: path (plain) and length."""
    rows = read_or_empty(spark, f"{root}/_catalog/consumed", CONSUMED).join(ended(spark, root).select("_batch"), "_batch", "left_semi")
    return rows.select(plain_path(F.col("path")).alias("path"), "length")


def files(spark: SparkSession, root: str) -> DataFrame:
    """The catalogue's rows of the data files of ended batches."""
    return read_or_empty(spark, f"{root}/_catalog/files", FILES).join(ended(spark, root).select("_batch", "seq"), "_batch")


# ---- fields


def _log_seq(spark: SparkSession, root: str) -> int:
    """The number of the last batch that summaries and the field log have; 0 for none."""
    path = f"{root}/_catalog/field_log"
    done = [int(n.removeprefix("_seq=")) for n in folders_in(spark, path) if n.startswith("_seq=") and exists(spark, f"{path}/{n}/_SUCCESS")]
    return max(done, default=0)


def field_log(spark: SparkSession, root: str) -> DataFrame:
    """One row for each field: type now, kinds seen, n_changes (of its type), first_seq, last_seq, and gone (the last batch with records lacked it)."""
    log = read_or_empty(spark, f"{root}/_catalog/field_log", LOG).where(F.col("_seq") == _log_seq(spark, root)).drop("_seq")
    last = ended(spark, root).where("valid > 0").agg(F.max("seq").alias("_last"))
    return log.join(F.broadcast(last)).withColumn("gone", F.col("last_seq") < F.col("_last")).drop("_last")


def known(spark: SparkSession, root: str) -> dict[str, T.Row]:
    """The rows of the field log by path; one a field of the lake."""
    log = read_or_empty(spark, f"{root}/_catalog/field_log", LOG).where(F.col("_seq") == _log_seq(spark, root))
    return {r.path: r for r in log.collect()}


def _logged(log: DataFrame, sightings: DataFrame) -> DataFrame:
    """The field log after the sightings (rows of ``fields`` with seq) of one batch."""
    new = sightings.select("path", F.col("field").alias("_f"), F.col("column").alias("_c"), F.col("type").alias("_t"), F.col("kinds").alias("_k"), F.col("names").alias("_n"), F.col("seq").alias("_s"))
    both = log.join(new, "path", "full_outer")
    other = F.col("type").isNotNull() & F.col("_t").isNotNull() & (F.col("type") != F.col("_t"))
    return both.select(
        F.coalesce("field", "_f").alias("field"), "path", F.coalesce("column", "_c").alias("column"), F.coalesce("_t", "type").alias("type"), F.coalesce("_k", "kinds").alias("kinds"), F.coalesce("_n", "names").alias("names"),
        (F.coalesce("n_changes", F.lit(0)) + other.cast("long")).cast("long").alias("n_changes"), F.coalesce("first_seq", "_s").alias("first_seq"), F.coalesce("_s", "last_seq").alias("last_seq"),
    )


# ---- summaries


def summarised(spark: SparkSession, root: str, level: str) -> None:
    """Brings summaries and the field log up to the last ended batch: documents of new files, totals of touched partitions, fields seen.

    A run that stopped on the way is gone over again: a partition's totals
    tell the last batch that they have, and documents are named by batch. The
    field log is written last and marks the end.
    """
    done = _log_seq(spark, root)
    open_ = ended(spark, root).where(F.col("seq") > done).orderBy("seq").select("_batch", "seq").collect()
    for r in open_:
        _summarised(spark, root, level, r._batch, r.seq)


def _summarised(spark: SparkSession, root: str, level: str, batch: str, seq: int) -> None:
    base, before = f"{root}/_catalog", _log_seq(spark, root)
    rows = spark.read.schema(FILES).parquet(f"{base}/files/_batch={batch}") if exists(spark, f"{base}/files/_batch={batch}") else spark.createDataFrame([], FILES)
    rows = rows.withColumn("partition", F.col("partition") if level == "leaf" else F.lit("")).persist()
    try:
        keys = ["tenant", "dataset", "partition"]
        delta = rows.groupBy(*keys).agg(*catalog._summary())
        if rows.count() > DOCUMENT:
            numbered = catalog.beside(rows, delta.select(*keys, "file_count"), keys)
            numbered = numbered.withColumn("document_part", F.pmod(F.xxhash64("path"), F.floor((F.col("file_count") + DOCUMENT - 1) / DOCUMENT))).drop("file_count")
        else:  # each partition has one document
            numbered = rows.withColumn("document_part", F.lit(0).cast("long"))
        documents = catalog.summary_documents(numbered, [*keys, "document_part"], schema_too=True)
        documents.write.mode("overwrite").parquet(f"{base}/summaries/_batch={batch}")
        fresh = delta.withColumn("seq", F.lit(seq).cast("long")).withColumn("_bucket", F.pmod(F.xxhash64("partition"), F.lit(BUCKETS)).cast("int"))
        totals = read_or_empty(spark, f"{base}/partitions", TOTALS)
        touched = totals.join(F.broadcast(fresh.select("_bucket").distinct()), "_bucket", "left_semi")
        if before:  # totals of a stopped run that have this batch
            fresh = fresh.join(totals.where(F.col("seq") >= seq).select("partition"), "partition", "left_anti")
        both = fresh if not before else touched.unionByName(fresh).groupBy(*keys, "_bucket").agg(F.sum("file_count").alias("file_count"), F.sum("total_rows").alias("total_rows"), F.sum("total_bytes").alias("total_bytes"), F.min("first_created").alias("first_created"), F.max("last_modified").alias("last_modified"), F.max("seq").alias("seq"))
        both.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(f"{base}/partitions")
    finally:
        rows.unpersist()
    seen = read_or_empty(spark, f"{base}/fields/_batch={batch}", FIELDS).withColumn("seq", F.lit(seq).cast("long"))
    log = read_or_empty(spark, f"{base}/field_log", LOG).where(F.col("_seq") == before)
    _logged(log, seen).coalesce(1).write.mode("overwrite").parquet(f"{base}/field_log/_seq={seq}")
    for name in folders_in(spark, f"{base}/field_log"):
        if name.startswith("_seq=") and int(name.removeprefix("_seq=")) < before:  # the last two stay, for those who read just now
            removed(spark, f"{base}/field_log/{name}")


# ---- reading


def _as(value: Column, own: str, now: str) -> Column:
    """A value of one kind as a wider one."""
    if own == now:
        return value
    if now == "string" and (own.startswith("array")):
        return F.to_json(value)
    if now == "string" and own == "timestamp":
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return value.cast(TYPES[now])


def layout_of(columns: Mapping[str, tuple[str, str]], keys: list[str], folders: bool) -> str:
    """How a batch was written, as text: its columns (the names they are stored by, with column and kind), its key=value folders, and whether it has other folders."""
    return json.dumps({"columns": dict(columns), "keys": keys, "folders": folders}, sort_keys=False)


def _where(rows: DataFrame, since, until, between: Mapping[str, tuple]) -> DataFrame:
    for bound, name in ((since, ">="), (until, "<")):
        if bound is not None:
            at = F.lit(bound).cast("timestamp_ntz")
            rows = rows.where(F.col("_event_ts") >= at if name == ">=" else F.col("_event_ts") < at)
    for column, (low, high) in between.items():
        rows = rows.where(F.col(f"`{column}`").between(low, high))
    return rows


def _stat(names: list[str]) -> Column:
    """A file's statistics of the column that is stored by one of some names."""
    return F.get(F.filter("stats", lambda x: x["name"].isin(names)), F.lit(0))


def matching_files(spark: SparkSession, root: str, since=None, until=None, between: Mapping[str, tuple] | None = None) -> DataFrame:
    """Data files that may hold rows within the bounds, by their catalogue's rows; files whose bounds aren't known stay."""
    rows = files(spark, root)
    if since is not None:
        rows = rows.where(F.coalesce(F.col("max_ts") >= F.lit(since).cast("timestamp_ntz"), F.lit(True)))
    if until is not None:
        rows = rows.where(F.coalesce(F.col("min_ts") < F.lit(until).cast("timestamp_ntz"), F.lit(True)))
    stored = {r.column: r.names for r in known(spark, root).values()} if between else {}
    for column, (low, high) in (between or {}).items():
        stat = _stat(stored.get(column, [column]))
        rows = rows.where(F.coalesce((stat["max_value"].try_cast("double") >= low) & (stat["min_value"].try_cast("double") <= high), F.lit(True)))
    return rows


def read(spark: SparkSession, root: str, since=None, until=None, between: Mapping[str, tuple] | None = None) -> DataFrame:
    """The rows of all ended batches: a column for each field, ``_rest``, and packing's own columns.

    ``since`` and ``until`` (which isn't included) bound event times,
    ``between`` maps columns of numbers to bounds, both included.
    """
    between = between or {}
    own = T._parse_datatype_string("_event_ts timestamp_ntz, _bytes long, _rest variant").fields
    now = {r.column: r.type for r in known(spark, root).values()}
    batches = ended(spark, root).where("valid > 0")
    narrowed: dict[str, list[str]] | None = None
    if since is not None or until is not None or between:
        some = matching_files(spark, root, since, until, between).select("_batch", "path").limit(PATHS + 1).collect()
        if len(some) <= PATHS:
            narrowed = {}
            for r in some:
                narrowed.setdefault(r._batch, []).append(r.path)
    paths: dict[str, list[str]] = {}
    for r in batches.select("_batch", "attempt", "layout").collect():
        mine = [f"{root}/data/_batch={r._batch}/_try={r.attempt}"] if narrowed is None else narrowed.get(r._batch, [])
        paths.setdefault(r.layout, []).extend(mine)
    found = None
    for text, some in paths.items():
        if not some:
            continue
        how = json.loads(text)
        kinds = [T.StructField(c, T._parse_datatype_string(TYPES[k])) for c, (_, k) in how["columns"].items()]
        with listed_by_tasks(spark):
            rows = spark.read.schema(T.StructType([*kinds, *own])).option("recursiveFileLookup", True).parquet(*some)
        at = F.col("_metadata.file_path")
        inner = F.substring_index(at, "/_try=", -1)  # keys are taken from paths, as Spark's search for partitions grows with the square of their number
        key = lambda k, kind: F.substring_index(F.substring_index(inner, f"/{k}=", -1), "/", 1).try_cast(kind).alias(k)  # noqa: B023, E731
        place = [*([] if how["folders"] else [key(k, "int") for k in how["keys"]]), key("_part", "long"), F.regexp_extract(at, "_batch=([^/]+)", 1).alias("_batch")]
        rows = rows.select(*[_as(F.col(f"`{stored}`"), k, now.get(c, k)).alias(c) for stored, (c, k) in how["columns"].items()], *[f.name for f in own], *place)
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    if found is None:
        kinds = [T.StructField(c, T._parse_datatype_string(TYPES[k])) for c, k in now.items()]
        found = spark.createDataFrame([], T.StructType([*kinds, *own, T.StructField("_part", T.LongType()), T.StructField("_batch", T.StringType())]))
    return _where(found, since, until, between)


def partition_totals(spark: SparkSession, root: str) -> DataFrame:
    """Files, rows and bytes of each partition (of the whole dataset at level root)."""
    return read_or_empty(spark, f"{root}/_catalog/partitions", TOTALS).drop("_bucket")


def column_figures(spark: SparkSession, root: str, by: list[str] | None = None) -> DataFrame:
    """Distinct values and quantiles of the lake's stored columns, united from the sketches of its files (``sketches`` of ``pack.Options``).

    ``by`` are columns of ``files``, such as ``partition``.
    """
    kept = spark.read.parquet(f"{root}/_catalog/sketches").drop("_batch")
    rows = kept.join(files(spark, root).select("path", *(by or [])), "path")
    return sketches.estimated(sketches.united(rows, by or []))


def folder_path(scheme: str, template: str | None, tenant: str, dataset: str, time: Column) -> Column:
    """The folder of a time for layouts without keys: the ``date`` scheme's, or a template's; ``undated`` where there is no time."""
    path = layout.custom_path(template, F.lit(tenant), F.lit(dataset), time) if template else layout.partition_path(scheme, time)
    return F.coalesce(F.nullif(path, F.lit("")), F.lit("undated"))
