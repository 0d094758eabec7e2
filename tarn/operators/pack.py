"""Packing: JSON lines of a dataset to a partitioned Parquet lake, once, in parts of bounded size.

A run lists what no ended batch has read, reads it, sets aside what is no
record, infers one schema over all records and the kinds that the lake has
seen, casts, takes event times, numbers parts by running size in time order,
writes, and appends to the catalogue (see ``lake`` for its tables).

A batch is known by the hash of its input files, however they came (a run, a
stream, another stream). Before anything else it writes down its files (an
intent), and last of all its row in ``batches``. Each attempt at a batch writes
to a folder of its own, which its row names; readers take ended batches only.
A run first finishes the batches that have an intent and no row, with those
files of the intent that no ended batch has. So wherever a run stops, the next
one leaves every record in the lake once. One run or stream at a time should
pack the same source; runs over different sources may share a lake in turn.

Every value of a record is kept. A field whose kind differs from before gets
the wider type (numbers double, others text) from this batch on, and ``read``
joins what older batches stored. What a column can't hold (a field without an address, as
its name has both kinds of quotes; a number of more digits than a double has)
is in the VARIANT ``_rest`` by field, and counted in ``batches``. Columns that
packing adds start with an underscore; the folders of a scheme (year, month,
day, hour) don't. A field whose name is taken, by those or by another that
differs in case only, gets underscores at its end; ``_catalog/fields`` tells
each field's column.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import layout
from tarn.functions.timestamps import event_time, first_time_value, value_time
from tarn.operators import catalog, lake, parts, schema, sketches
from tarn.operators.lake import BATCHES, CONSUMED, read_or_empty, summarised
from tarn.sources import ndjson
from tarn.sources.folders import exists, folders_in, listed_by_tasks, moved, plain_path, removed, without_globs

CODECS = ("zstd", "snappy", "uncompressed")
LEVELS = ("leaf", "root")
#: Columns of the lake that packing adds, and the folders of its schemes.
OWN = ("_event_ts", "_bytes", "_rest", "_part", "_batch", "_try", "_folder", "year", "month", "day", "hour")


#: Bytes of rows without a time that are numbered together.
SPREAD = 4 << 20
#: Bytes of lines for a task, and how many bytes of lines a byte of a compressed file is taken for.
SHARE, PACKED = 4 * SPREAD, 8
#: Parts below so many bytes are written as ``parts`` does.
SMALL = 1 << 20


@dataclass
class Packed:
    """What a run did: its batches (also those it finished for an earlier run) and lines by kind; lost counts values in ``_rest``."""

    batches: list[str]
    lines: int = 0
    valid: int = 0
    rejected: int = 0
    lost: int = 0

    @property
    def fresh(self) -> bool:
        return bool(self.batches)


@dataclass
class Published:
    """An attempt at a batch that has been written, and how."""

    lines: int
    valid: int
    rejected: int
    lost: int
    attempt: str
    layout: str


@dataclass
class Options:
    """How a lake is written; ``flatten`` is the delimiter of nested names, None keeps objects as JSON text.

    ``template`` is a layout of its own, such as ``{year}-{month}/{day}``,
    and goes before ``scheme``. ``sketches`` keeps sketches of each file's
    columns (``lake.column_figures``), which takes one more scan of a batch.
    """

    scheme: str = "hive"
    codec: str = "zstd"
    limit: int | None = 64 << 20
    keep_raw: bool = False
    flatten: str | None = None
    metadata_level: str = "leaf"
    template: str | None = None
    sketches: bool = False

    def __post_init__(self):
        layout.partition_path(self.scheme, F.lit(None))
        for value, known, name in ((self.codec, CODECS, "codec"), (self.metadata_level, LEVELS, "metadata level")):
            if value not in known:
                raise ValueError(f"unknown {name} {value!r}; one of {', '.join(known)}")

    @property
    def keyless(self) -> bool:
        return self.template is not None or self.scheme == "date"


def write_parts(rows: DataFrame, path: str, by: list[str], time: str, codec: str = "zstd", limit: int | None = None, size: str | None = None, mode: str = "append", total: int | None = None) -> None:
    """Writes rows in folders by the columns ``by``, sorted by time within files, each of about ``limit`` bytes of ``size`` at most.

    One shuffle deals (partition, part) pairs to tasks; Spark's committer
    publishes all files of the job at its end. Where ``total`` (bytes of all
    rows) is below the limit, no part number but 1 can come out.
    """
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}; one of {', '.join(CODECS)}")
    if limit is None:
        dealt = rows.repartition(*by) if by else rows
    elif total is not None and total < limit:
        dealt = (rows.repartition(*by) if by else rows.coalesce(1)).withColumn("_part", F.lit(1).cast("long"))
    else:
        columns = [F.col(f"`{c}`") for c in rows.columns if c not in (*by, time, size)]
        plain = [F.col(f"`{c}`") for c, kind in rows.dtypes if c not in (*by, time) and kind != "variant"]
        spread = 64 if total is None else total // SPREAD + 1  # rows without a time have no order, so any dealing of them will do
        dealt_by = F.when(F.col(time).isNull(), F.pmod(F.xxhash64(*plain), F.lit(spread))).otherwise(0)
        bucket = F.struct(F.coalesce(F.date_trunc("MINUTE", time), F.lit("9999-12-31").cast("timestamp")), dealt_by)
        rows = rows.select(*by, time, size, F.struct(*columns).alias("_row"), bucket.alias("_minute"))  # so that no name meets those of numbering
        tasks = many_tasks(rows.sparkSession, total)
        many = {} if tasks is None else {"tasks": tasks}
        rows = catalog.numbered_parts(rows, by, [time], F.col(size), limit, F.col("_minute"), **many).drop("_minute").withColumnRenamed("part", "_part")
        dealt = (rows.repartition(*by, "_part") if tasks is None else rows.repartition(tasks, *by, "_part")).select("_row.*", time, size, *by, "_part")
    keys = [*by, *(["_part"] if limit is not None else [])]
    dealt = dealt.sortWithinPartitions(*keys, F.asc_nulls_last(time))
    if limit is not None and limit < SMALL:
        if mode == "overwrite":
            removed(rows.sparkSession, path)
        parts.written(dealt, path, keys, codec)
    else:
        dealt.write.mode(mode).option("compression", codec).partitionBy(*keys).parquet(path)


def many_tasks(spark: SparkSession, total: int | None) -> int | None:
    """Tasks of a ``SHARE`` each for so many bytes, where that is more than the session's number; None elsewhere."""
    tasks = 0 if total is None else total // SHARE + 1
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def scan_tasks(files: list[tuple[str, int]], least: int) -> int:
    """Tasks for the lines of files (path, length): a ``SHARE`` each by their lengths, and no fewer than files or ``least``."""
    size = sum(length * (1 if path.lower().endswith((".ndjson", ".json", ".jsonl", ".txt")) else PACKED) for path, length in files)
    return max(len(files), least, size // SHARE + 1)


def timed(lines: DataFrame) -> DataFrame:
    """Classified lines with their event times: a column to be kept with them, as numbering, dealing and writing each ask for it.

    The first time field of a line is parsed as a column, which Spark compiles;
    the lambdas of ``event_time``, which it doesn't, see only lines where that one doesn't parse.
    """
    record, first = F.col("record"), F.col("_time")
    rows = lines.withColumn("_time", first_time_value(record)).withColumn("_time_as", F.schema_of_variant("_time"))  # columns, so that a value is looked up once
    return rows.withColumn("_event_ts", F.when(first.isNotNull(), F.coalesce(value_time(first, F.col("_time_as")), event_time(record)))).drop("_time", "_time_as")


def unconsumed(files: DataFrame, consumed: DataFrame) -> DataFrame:
    """Files that no ended batch has read; a file that changed since counts as new."""
    return files.join(consumed.select("path", "length"), ["path", "length"], "left_anti")


def columns_of(fields: dict[str, str], taken: list[str]) -> dict[str, str]:
    """A column for each path of a field (path: name): the name, with underscores at its end where it is taken (Spark compares without case)."""
    used, out = {c.lower() for c in taken}, {}
    for path, name in sorted(fields.items(), key=lambda x: (x[1], x[0])):
        column = name or "_"
        while column.lower() in used:
            column += "_"
        used.add(column.lower())
        out[path] = column
    return out


def _merged(found: list[tuple[str, str | None, list[str]]], known: dict) -> list[tuple[str, str, str, str, list[str], list[str]]]:
    """(field, path, column, type, kinds, names) of each field of a batch that has a path, with what the lake knows of it.

    The last of ``names`` is the stored column now; a field whose type has
    changed gets a new one.
    """
    fields = {path: (field, kinds) for field, path, kinds in found if path is not None}
    taken = [*OWN, *(n for r in known.values() for n in r.names)]
    columns = columns_of({path: f for path, (f, _) in fields.items() if path not in known}, taken)
    used = {c.lower() for c in (*taken, *columns.values())}
    out = []
    for path, (field, kinds) in fields.items():
        every = sorted({*kinds, *(known[path].kinds if path in known else [])} - {"null"})
        kind = schema.common_kind(every)
        names = list(known[path].names) if path in known else [columns[path]]
        if path in known and known[path].type != kind:
            name = f"{names[0]}_v{len(names) + 1}"
            while name.lower() in used:
                name += "_"
            used.add(name.lower())
            names.append(name)
        out.append((field, path, names[0], kind, every, names))
    return out


def publish(lines: DataFrame, batch: str, root: str, tenant: str, dataset: str, options: Options, n_files: int = 0, observed: list | None = None) -> Published:
    """Writes an attempt at a batch of lines (value, path) to a lake and its catalogue.

    ``observed`` are the (field, path, kinds) of lines that are classified,
    ``timed`` and cached already.
    """
    spark, attempt = lines.sparkSession, uuid.uuid4().hex[:8]
    lines = timed(ndjson.classified(lines)).persist() if observed is None else lines
    own = lambda table: f"{root}/_catalog/{table}/_batch={batch}"
    data = f"{root}/data/_batch={batch}/_try={attempt}"
    try:
        found = lines.groupBy("status").agg(F.count("*"), F.sum(F.octet_length("value"))).collect()
        counts, size = {r[0]: r[1] for r in found}, sum(r[2] or 0 for r in found)
        valid, rejected = counts.get("valid", 0), counts.get("not json", 0) + counts.get("not an object", 0)
        records = lines.where("status = 'valid'")
        if observed is not None or not valid:
            found = observed or []
        elif options.flatten is None:
            found = [(r.field, schema.json_path_or_none(r.field), r.kinds) for r in schema.observed(records).collect()]
        else:
            found = [(r.field, r.path, r.kinds) for r in schema.observed_leaves(records, options.flatten).collect()]
        known = lake.known(spark, root)
        fields = _merged(found, known)
        absent = [(r.field, r.path, r.column, r.type, r.kinds, r.names) for path, r in known.items() if path not in {f[1] for f in fields}]
        columns = {names[-1]: (column, kind) for _, _, column, kind, _, names in [*fields, *absent]}
        record = F.col("record")
        values = [(F.col(f"_v{n}"), F.col(f"_as{n}")) for n in range(len(fields))]  # columns, so that a value is looked up once for its cast and ``_rest``
        casts = [schema.cast_value(*v, kind).alias(names[-1]) for v, (_, _, _, kind, _, names) in zip(values, fields, strict=True)]
        casts += [F.lit(None).cast(lake.TYPES[kind]).alias(names[-1]) for _, _, _, kind, _, names in absent]
        rest = schema.misfits(record, [(field, *v, kind) for v, (field, _, _, kind, *_) in zip(values, fields, strict=True)], [field for field, path, _ in found if path is None])
        times = records.withColumn("_bytes", F.octet_length("value").cast("long"))
        keys = {"_folder": lake.folder_path(options.scheme, options.template, tenant, dataset, F.col("_event_ts"))} if options.keyless else layout.partition_columns(options.scheme, F.col("_event_ts"))
        if valid:
            rows = times.withColumns({f"_v{n}": F.try_variant_get("record", f[1], "variant") for n, f in enumerate(fields)})
            rows = rows.withColumns({f"_as{n}": F.schema_of_variant(f"_v{n}") for n in range(len(fields))}).select(*casts, rest.alias("_rest"), "_event_ts", "_bytes", *[c.alias(n) for n, c in keys.items()])
            write_parts(rows, data, list(keys), "_event_ts", options.codec, options.limit, "_bytes", mode="overwrite", total=size)
        if options.keep_raw:
            raw, tasks = times.select("value", *[c.alias(n) for n, c in keys.items()]), many_tasks(spark, size)
            if tasks is not None:  # else each of many tasks has a file in each folder
                raw = raw.repartition(tasks, *keys, F.pmod(F.xxhash64("value"), F.lit(tasks // 32 + 1)))
            raw.write.mode("overwrite").option("compression", "gzip").partitionBy(*keys).text(f"{root}/raw/_batch={batch}")
        if rejected:
            lines.where("status in ('not json', 'not an object')").select("value", "path", F.col("status").alias("reason")).write.mode("overwrite").parquet(own("quarantine"))
    finally:
        if observed is None:
            lines.unpersist()
    if options.keyless and valid:
        without_keys(spark, data)
    lake.small_table(spark, fields, lake.FIELDS.rpartition(",")[0]).coalesce(1).write.mode("overwrite").parquet(own("fields"))
    if valid:
        catalogued(spark, root, batch, tenant, dataset, attempt).write.mode("overwrite").parquet(own("files"))
    if valid and options.sketches:
        stored = spark.read.option("recursiveFileLookup", True).parquet(data)
        plain = [c for c, kind in stored.dtypes if c in columns and not kind.startswith("array")]
        own_path = plain_path(F.col("_metadata.file_path"), encoded=True).alias("path")
        if plain:
            sketches.column_sketches(stored.select(own_path, *[f"`{c}`" for c in plain]), ["path"], plain).write.mode("overwrite").parquet(own("sketches"))
    lost = 0
    if valid and spark.read.schema(lake.FILES.rpartition(",")[0]).parquet(own("files")).where(~F.coalesce(empty_rest(), F.lit(False))).head(1):
        with listed_by_tasks(spark):
            kept = spark.read.schema("_rest variant").option("recursiveFileLookup", True).parquet(data)
        kept = kept.where("_rest is not null")
        lost = kept.agg(F.sum(F.size(F.try_variant_get("_rest", "$", "map<string, variant>")))).first()[0] or 0
    return Published(sum(counts.values()), valid, rejected, lost, attempt, lake.layout_of(columns, [] if options.keyless else list(keys), options.keyless))


def empty_rest() -> Column:
    """Whether a file's footer tells that none of its rows has a value in ``_rest``; null if it doesn't tell."""
    stat = F.get(F.filter("stats", lambda x: x["name"] == "_rest.metadata"), F.lit(0))
    return stat["null_count"] == F.col("n_rows")


def without_keys(spark: SparkSession, data: str) -> None:
    """Moves the folders ``_folder=a%2Fb`` of an attempt to ``a/b``: one rename a partition."""
    for name in folders_in(spark, data):
        if name.startswith("_folder="):
            moved(spark, f"{data}/{name}", f"{data}/{unquote(name.removeprefix('_folder='))}")


def catalogued(spark: SparkSession, root: str, batch: str, tenant: str, dataset: str, attempt: str) -> DataFrame:
    """The catalogue's row of each data file of a batch: footers with bounds of event times, partition and checksum."""
    files = catalog.scan_footers(catalog.list_parquet(spark, f"{root}/data/_batch={batch}/_try={attempt}")).withColumn("path", plain_path(F.col("path")))
    times = F.get(F.filter("stats", lambda x: x["name"] == "_event_ts"), F.lit(0))
    inner = F.regexp_replace("path", ".*/_try=[^/]*/?", "")
    folder = F.regexp_replace(inner, "/?[^/]*$", "")
    rows = files.withColumns({
        "tenant": F.lit(tenant), "dataset": F.lit(dataset), "partition": folder, "checksum": layout.checksum(F.col("path"), F.col("size"), F.col("modified")),
        "min_ts": times["min_value"].try_cast("timestamp_ntz"), "max_ts": times["max_value"].try_cast("timestamp_ntz"),
    })
    return rows.select("tenant", "dataset", "path", "partition", "size", "n_rows", "n_row_groups", F.col("modified").alias("created"), "modified", "min_ts", "max_ts", "fields", "stats", "checksum")


def committed(spark: SparkSession, root: str, batch: str) -> bool:
    return exists(spark, f"{root}/_catalog/batches/_batch={batch}/_SUCCESS")


def commit(spark: SparkSession, root: str, batch: str, tenant: str, dataset: str, n_files: int, done: Published) -> None:
    """Ends a batch: its row in ``batches``. Other attempts at it go."""
    seq = (lake.ended(spark, root).agg(F.max("seq")).first()[0] or 0) + 1
    row = [(tenant, dataset, n_files, done.lines, done.valid, done.rejected, done.lost, seq, done.attempt, done.layout)]
    lake.small_table(spark, row, BATCHES.rpartition(",")[0]).coalesce(1).write.mode("overwrite").parquet(f"{root}/_catalog/batches/_batch={batch}")
    for name in folders_in(spark, f"{root}/data/_batch={batch}"):
        if name != f"_try={done.attempt}":
            removed(spark, f"{root}/data/_batch={batch}/{name}")


def intend(files: DataFrame, root: str) -> str | None:
    """Writes down the files (path, length) of a new batch and gives its name, the hash of them; None if there are none."""
    files = files.select("path", "length").persist()
    try:
        found = catalog.tree_hash(files.withColumn("all", F.lit(1)), ["all"], size="length").first()
        if found is None:
            return None
        batch = f"b-{found.tree_hash[:32]}"
        path = f"{root}/_catalog/consumed/_batch={batch}"
        if not exists(files.sparkSession, f"{path}/_SUCCESS"):  # else the same files were written down before
            files.coalesce(1).write.mode("overwrite").parquet(path)
        return batch
    finally:
        files.unpersist()


def _open(spark: SparkSession, root: str) -> list[str]:
    """Batches with an intent and no end."""
    return [n.removeprefix("_batch=") for n in sorted({*folders_in(spark, f"{root}/_catalog/consumed")} - {*folders_in(spark, f"{root}/_catalog/batches")}) if n.startswith("_batch=")] + [
        n.removeprefix("_batch=") for n in folders_in(spark, f"{root}/_catalog/batches") if n.startswith("_batch=") and not committed(spark, root, n.removeprefix("_batch="))
    ]


def _finish(spark: SparkSession, root: str, batch: str, tenant: str, dataset: str, how: Options) -> Published:
    """Packs the files of an intent, but for those that an ended batch has."""
    mine = spark.read.schema("path string, length long").parquet(f"{root}/_catalog/consumed/_batch={batch}").withColumn("path", plain_path(F.col("path")))
    files = [(r.path, r.length) for r in unconsumed(mine, lake.consumed(spark, root)).select("path", "length").collect()]
    names = [path for path, _ in files]
    lines = ndjson.scan(spark, [without_globs(n) for n in names], scan_tasks(files, spark.sparkContext.defaultParallelism)) if names else spark.createDataFrame([], "value string, path string")
    done = publish(lines, batch, root, tenant, dataset, how)
    commit(spark, root, batch, tenant, dataset, len(names), done)
    summarised(spark, root, how.metadata_level)
    return done


def recovered(spark: SparkSession, root: str, tenant: str, dataset: str, how: Options) -> dict[str, Published]:
    """Finishes what an earlier run left: summaries of ended batches, and batches with an intent and no end, whose files must still be there."""
    lake.summarised(spark, root, how.metadata_level)
    return {batch: _finish(spark, root, batch, tenant, dataset, how) for batch in _open(spark, root)}


def pack(
    spark: SparkSession, source: str, lake_: str, tenant: str, dataset: str, ending: str = ndjson.DATA_FILE, files_per_batch: int = 100_000, **options
) -> Packed:
    """Packs what is new below ``source`` into the lake's tenant/dataset; see the module's head and ``Options``.

    New files go in batches of ``files_per_batch``, oldest first, until none is
    left; the source is listed once, and the names of one batch's files are
    what the driver holds.
    """
    how, root, done = Options(**options), f"{lake_.rstrip('/')}/{tenant}/{dataset}", Packed([])

    def add(batch: str, new: Published) -> Packed:
        return replace(done, batches=[*done.batches, batch], lines=done.lines + new.lines, valid=done.valid + new.valid, rejected=done.rejected + new.rejected, lost=done.lost + new.lost)

    for batch, new in recovered(spark, root, tenant, dataset, how).items():
        done = add(batch, new)
    listed = ndjson.list_files(spark, source, ending).withColumn("path", plain_path(F.col("path"))).persist()
    try:
        while batch := intend(unconsumed(listed, lake.consumed(spark, root)).orderBy("modificationTime", "path").limit(files_per_batch), root):
            done = add(batch, _finish(spark, root, batch, tenant, dataset, how))
    finally:
        listed.unpersist()
    return done


def pack_files(files: DataFrame, lake_: str, tenant: str, dataset: str, how: Options) -> str | None:
    """Packs some files (path, length) as one batch, but for those that an ended batch has; gives its name, None if nothing is left."""
    spark, root = files.sparkSession, f"{lake_.rstrip('/')}/{tenant}/{dataset}"
    lake.summarised(spark, root, how.metadata_level)
    batch = intend(unconsumed(files, lake.consumed(spark, root)), root)
    if batch is not None:
        _finish(spark, root, batch, tenant, dataset, how)
    return batch


def pack_lines(lines: DataFrame, lake_: str, tenant: str, dataset: str, how: Options) -> str | None:
    """Packs lines (value, path, size) of whole files, such as a stream's batch; files that an ended batch has are left out.

    The batch is known by its files, so a batch that runs again, another
    stream over the same files, or a stream that lost its place packs nothing
    twice, and streams over different sources share the lake.
    """
    spark, root = lines.sparkSession, f"{lake_.rstrip('/')}/{tenant}/{dataset}"
    lake.summarised(spark, root, how.metadata_level)
    lines = ndjson.dealt(lines).persist()
    try:
        batch = intend(unconsumed(lines.select("path", F.col("size").alias("length")).distinct(), lake.consumed(spark, root)), root)
        if batch is None:
            return None
        files = spark.read.schema("path string, length long").parquet(f"{root}/_catalog/consumed/_batch={batch}")
        mine = lines.withColumnRenamed("size", "length").join(files, ["path", "length"], "left_semi")
        done = publish(mine, batch, root, tenant, dataset, how)
        commit(spark, root, batch, tenant, dataset, files.count(), done)
    finally:
        lines.unpersist()
    summarised(spark, root, how.metadata_level)
    return batch


def pack_many(spark: SparkSession, source: str, lake_: str, ending: str = ndjson.DATA_FILE, at_once: int = 8, **options) -> dict[tuple[str, str], Packed]:
    """Packs all datasets below ``source``/tenant/dataset in one go: one listing, one scan, one inference, then one write a dataset.

    A dataset that an earlier run left unfinished is finished first. Datasets
    are written some ``at_once`` by threads of the driver, whose jobs share the
    session's executors; a fault in one leaves the others packed and is raised
    at the end. Equal to ``pack`` of each dataset's folder.
    """
    how, base = Options(**options), lake_.rstrip("/")
    above = plain_path(F.lit(source.rstrip("/")))
    inner = F.split(F.substring(F.col("path"), F.length(above) + 2, F.length("path")), "/")
    place = {"tenant": F.get(inner, F.lit(0)), "dataset": F.get(inner, F.lit(1))}
    listed = ndjson.list_files(spark, source, ending).withColumn("path", plain_path(F.col("path"))).withColumns(place).where(F.size(inner) > 2).persist()
    done: dict[tuple[str, str], Packed] = {}
    intents: dict[tuple[str, str], str] = {}
    lines = None
    try:
        found = [(r.tenant, r.dataset) for r in listed.select("tenant", "dataset").distinct().collect()]  # a row a dataset

        def begin(key: tuple[str, str]) -> tuple[tuple[str, str], Packed, str | None]:
            root = f"{base}/{key[0]}/{key[1]}"
            left = recovered(spark, root, *key, how)
            mine = listed.where((F.col("tenant") == key[0]) & (F.col("dataset") == key[1])).select("path", "length")
            packed = Packed([*left], *(sum(getattr(p, n) for p in left.values()) for n in ("lines", "valid", "rejected", "lost")))
            return key, packed, intend(unconsumed(mine, lake.consumed(spark, root)), root)

        with ThreadPoolExecutor(at_once) as pool:
            for key, packed, batch in pool.map(begin, found):
                done[key] = packed
                if batch is not None:
                    intents[key] = batch
        if not intents:
            return done
        files = None
        for (tenant, dataset), batch in intents.items():
            mine = spark.read.schema("path string, length long").parquet(f"{base}/{tenant}/{dataset}/_catalog/consumed/_batch={batch}").withColumns({"tenant": F.lit(tenant), "dataset": F.lit(dataset)})
            files = mine if files is None else files.unionAll(mine)
        counts = {(r.tenant, r.dataset): r.n for r in files.groupBy("tenant", "dataset").agg(F.count("*").alias("n")).collect()}
        names = [without_globs(r.path) for r in files.select("path").collect()]
        lines = timed(ndjson.classified(ndjson.scan(spark, names).withColumn("path", plain_path(F.col("path"), encoded=True)).withColumns(place).repartition("path"))).persist()
        kinds: dict[tuple[str, str], list] = {key: [] for key in intents}
        for r in schema.observed(lines.where("status = 'valid'"), by=["tenant", "dataset"]).collect() if how.flatten is None else schema.observed_leaves(lines.where("status = 'valid'"), how.flatten, by=["tenant", "dataset"]).collect():
            kinds[r.tenant, r.dataset].append((r.field, schema.json_path_or_none(r.field) if how.flatten is None else r.path, r.kinds))

        def end(key: tuple[str, str]) -> Published:
            root, batch = f"{base}/{key[0]}/{key[1]}", intents[key]
            mine = lines.where((F.col("tenant") == key[0]) & (F.col("dataset") == key[1])).drop("tenant", "dataset")
            new = publish(mine, batch, root, *key, how, observed=kinds[key])
            commit(spark, root, batch, *key, counts[key], new)
            summarised(spark, root, how.metadata_level)
            return new

        with ThreadPoolExecutor(at_once) as pool:
            jobs = {key: pool.submit(end, key) for key in intents}
        for key, job in jobs.items():
            new, old = job.result(), done[key]
            done[key] = Packed([*old.batches, intents[key]], old.lines + new.lines, old.valid + new.valid, old.rejected + new.rejected, old.lost + new.lost)
        return done
    finally:
        listed.unpersist()
        if lines is not None:
            lines.unpersist()


def compacted(spark: SparkSession, source: str, target: str, by: list[str], time: str, limit: int) -> None:
    """Rewrites a lake of many small files in parts of about ``limit`` bytes of row text."""
    rows = spark.read.parquet(source).drop("_part")
    sized = rows.withColumn("_bytes", F.octet_length(F.to_json(F.struct(*rows.columns))).cast("long"))
    write_parts(sized, target, by, time, limit=limit, size="_bytes", mode="overwrite")
