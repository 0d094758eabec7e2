"""Queries that write a lake and read it again, in batch and as streams; the lake is made from the given tables."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.operators import catalog, lake, pack
from tarn.sources import ndjson
from tarn.sources.folders import work_folder
from tarn.streaming import streams

from .queries import ORACLES, QUERIES, STATUS
from .views import view, with_views

#: Files that the raw lines of a table are dealt to, in its first run.
FILES = 6


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return register


def _named(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A source folder, with a file a deal, and an empty lake.

    Each deal is a write of its own, whose task takes lines as they come; one
    write in folders of ``deal`` would sort all lines of a file first.
    """
    base = work_folder(spark, "lake")
    lines = view(spark, sf_dir, "raw_lines").select("value", (F.col("event_id") % FILES).alias("deal"))

    def write(deal: int) -> None:
        lines.where(F.col("deal") == deal).select("value").repartition(1).write.option("compression", "gzip").text(f"{base}/stage/deal={deal}")

    with ThreadPoolExecutor(FILES) as pool:
        list(pool.map(write, range(FILES)))
    return f"{base}/stage", f"{base}/out"


def _staged(rows: DataFrame, path: str, *fields) -> None:
    """Rows as compressed JSON lines, in more files the more rows there are.

    A given table is one task to read, and a compressed file is one to write
    and one to read again; rows are dealt by their id, as dealing in turns
    would sort them all first.
    """
    lines = rows.hint("rebalance", "event_id").select(F.to_json(F.struct(*fields)).alias("value"))
    lines.write.option("compression", "gzip").text(path)


def _packed(spark: SparkSession, sf_dir: str, **options) -> tuple[str, pack.Packed, pack.Packed]:
    source, out = _named(spark, sf_dir)
    first, second = (pack.pack(spark, source, out, "t1", "events", ending=r"\.gz$", **options) for _ in range(2))
    return f"{out}/t1/events", first, second


_VALID = f"(select * from raw_lines where {STATUS} = 'valid')"
_COUNTS = f"select count(*) as valid, (select count(*) from raw_lines where {STATUS} in ('not json', 'not an object')) as rejected from {_VALID} v"


@query(f"select cast(event_id as bigint) as event_id, value ->> '$.event_type' as event_type from {_VALID} v")
def pack_roundtrip(spark, sf_dir):
    root, _, _ = _packed(spark, sf_dir, limit=20_000)
    return lake.read(spark, root).select("event_id", "event_type")


@query(_COUNTS.replace("as rejected", "as rejected, 0 as again"))
def consume_once(spark, sf_dir):
    """A second run over the same files packs nothing."""
    root, first, second = _packed(spark, sf_dir)
    again = int(second.fresh)
    return spark.read.parquet(f"{root}/_catalog/batches").select("valid", "rejected", F.lit(again).alias("again"))


@query(f"select value from {_VALID} v")
def raw_lineage(spark, sf_dir):
    root, _, _ = _packed(spark, sf_dir, keep_raw=True)
    return spark.read.text(f"{root}/raw").select("value")


@query(f"select true as sorted, true as bounded, count(*) as n_rows from {_VALID} v")
def sorted_parts(spark, sf_dir):
    """Each file is sorted by event time and no part is larger than the limit and one row."""
    root, _, _ = _packed(spark, sf_dir, limit=20_000)
    rows = lake.read(spark, root).select("year", "month", "day", F.col("_part").alias("part"), F.col("_bytes").alias("size"), F.col("_event_ts").alias("event_ts"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("k"))
    from pyspark.sql import Window

    before = F.lag("event_ts").over(Window.partitionBy("path").orderBy("k"))
    rows = rows.withColumn("ok", F.coalesce(before <= F.col("event_ts"), F.lit(True)))
    parts = rows.groupBy("year", "month", "day", "part").agg(F.min("ok").alias("ok"), (F.sum("size") < 20_000 + F.max("size")).alias("bounded"), F.count("*").alias("n"))
    return parts.agg(F.min("ok").alias("sorted"), F.min("bounded").alias("bounded"), F.sum("n").alias("n_rows"))


@query(f"select count(*) as n_rows, true as has_files, true as same from {_VALID} v")
def catalog_scan(spark, sf_dir):
    """Footers and a scan agree on the rows of the lake's files."""
    root, _, _ = _packed(spark, sf_dir)
    listed = catalog.list_parquet(spark, f"{root}/data")
    footers = catalog.scan_footers(listed).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "n_rows")
    scanned = catalog.scanned(spark, f"{root}/data", "_event_ts").select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.col("n_rows").alias("own"))
    rows = footers.join(scanned, "path", "full_outer")
    return rows.agg(F.sum("n_rows").alias("n_rows"), (F.count("*") > 0).alias("has_files"), F.min(F.col("n_rows").eqNullSafe(F.col("own"))).alias("same"))


@query(f"select cast(event_id as bigint) as event_id, value ->> '$.event_type' as event_type from {_VALID} v")
def pack_after_crash(spark, sf_dir):
    """A run that stopped after its data and before its end leaves nothing twice, though new files came since."""
    source, out = _named(spark, sf_dir)
    root = f"{out}/t1/events"
    _attempted(spark, source, root)
    pack.pack(spark, source, out, "t1", "events", ending=r"\.gz$")
    return spark.read.parquet(f"{root}/data").select("event_id", "event_type")


def _attempted(spark: SparkSession, source: str, root: str) -> None:
    """What a run leaves that stopped before the end of a batch of half the files."""
    some = ndjson.list_files(spark, source, r"\.gz$").orderBy("path").limit(FILES // 2).select("path", "length")
    some.coalesce(1).write.parquet(f"{root}/_catalog/consumed/_batch=b-0")
    pack.publish(ndjson.scan(spark, [r.path for r in some.select("path").collect()], spark.sparkContext.defaultParallelism), "b-0", root, "t1", "events", pack.Options())


@query(f"select 0 as before, count(*) as after from {_VALID} v")
def lake_snapshot(spark, sf_dir):
    """A reader sees nothing of a batch that hasn't ended, and each record once when it has."""
    source, out = _named(spark, sf_dir)
    root = f"{out}/t1/events"
    _attempted(spark, source, root)
    before = lake.read(spark, root).agg(F.count("*").cast("int").alias("before"))
    before = pack.read_or_empty(spark, f"{root}/_catalog/none", "n int").agg(F.lit(before.first()[0]).alias("before"))
    pack.pack(spark, source, out, "t1", "events", ending=r"\.gz$")
    return before.crossJoin(lake.read(spark, root).agg(F.count("*").alias("after")))


def _lines(spark: SparkSession, sf_dir: str, base: str, *batches: list) -> str:
    """Packs events as records of given fields, the batches (a condition and its fields) one after the other; the lake's root."""
    events = view(spark, sf_dir, "events")
    for k, (condition, *fields) in enumerate(batches):
        _staged(events.where(condition), f"{base}/in/{k}", *fields)
        pack.pack(spark, f"{base}/in", f"{base}/out", "t1", "events", ending=r"\.gz$")
    return f"{base}/out/t1/events"


#: Fields of the records below.
_WHOLE, _HALF = "event_id % 1000 as {}", "event_id % 1000 + 0.5 as {}"


@query("""select event_id, case event_id % 3 when 0 then cast(event_id % 1000 as varchar) when 1 then cast(event_id % 1000 as varchar) || '.5' else event_type end as a,
                 case when event_id % 3 = 0 then cast(event_id as double) when event_id % 3 = 1 then event_id + 0.5 end as b,
                 case when event_id % 3 = 2 then cast(event_id as bigint) + 9007199254740993 end as exact from events""")
def pack_widening(spark, sf_dir):
    """A field that is whole, then fractional, then text; every value comes back, also whole numbers that no double holds."""
    root = _lines(
        spark, sf_dir, work_folder(spark, "wide"),
        ("event_id % 3 = 0", "event_id", F.expr(_WHOLE.format("a")), F.col("event_id").alias("b")),
        ("event_id % 3 = 1", "event_id", F.expr(_HALF.format("a")), (F.col("event_id") + 0.5).alias("b")),
        ("event_id % 3 = 2", "event_id", F.col("event_type").alias("a"), (F.col("event_id") + 9007199254740993).alias("b")),
    )
    exact = F.try_variant_get("_rest", "$.b", "long")
    return lake.read(spark, root).select("event_id", "a", F.when(exact.isNull(), F.col("b")).alias("b"), exact.alias("exact"))


@query("select event_id, event_type as odd, cast(event_id % 7 as bigint) as plain, true as counted from events")
def pack_odd_keys(spark, sf_dir):
    """A key with both kinds of quotes can't be addressed: its values are in ``_rest``, they are counted, and later batches go on."""
    base, name = work_folder(spark, "odd"), "o'd\"d"
    both = ["event_id", (F.col("event_id") % 7).alias("plain")]
    root = _lines(spark, sf_dir, base, ("event_id % 2 = 0", *both, F.col("event_type").alias(name)), ("event_id % 2 = 1", *both, F.col("event_type").alias(name)))
    counted = lake.ended(spark, root).agg((F.sum("lost") == F.sum("valid")).alias("counted"))
    odd = F.try_variant_get("_rest", "$", "map<string, string>")[name]
    return lake.read(spark, root).select("event_id", odd.alias("odd"), "plain").crossJoin(F.broadcast(counted))


def _foldered(spark: SparkSession, sf_dir: str, **layout) -> DataFrame:
    """Rows of a lake without key=value folders, by the folder that the catalogue has and by what a reader gives."""
    base = work_folder(spark, "folders")
    _staged(view(spark, sf_dir, "events"), f"{base}/in", "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    pack.pack(spark, f"{base}/in", f"{base}/out", "t1", "events", ending=r"\.gz$", limit=50_000, **layout)
    root = f"{base}/out/t1/events"
    kept = lake.files(spark, root).groupBy(F.regexp_replace("partition", "/_part=.*", "").alias("folder")).agg(F.sum("n_rows").alias("n_stored"))
    pattern = "yyyy/MM/dd" if "scheme" in layout else "'t1/'yyyy-MM"
    return lake.read(spark, root).groupBy(F.date_format("_event_ts", pattern).alias("folder")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).join(kept, "folder", "full_outer")


@query("select strftime(ts, '%Y/%m/%d') as folder, count(*) as n, cast(sum(event_id) as bigint) as ids, count(*) as n_stored from events group by 1")
def pack_date_layout(spark, sf_dir):
    return _foldered(spark, sf_dir, scheme="date")


@query("select 't1/' || strftime(ts, '%Y-%m') as folder, count(*) as n, cast(sum(event_id) as bigint) as ids, count(*) as n_stored from events group by 1")
def pack_template(spark, sf_dir):
    return _foldered(spark, sf_dir, template="{tenant}/{year}-{month}")


@query("""select count(*) as n, true as fewer, (select count(*) from events where event_id between 100 and 120) as n_between, true as fewer_between
          from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-07'""")
def lake_skipping(spark, sf_dir):
    """Bounds on event times and numbers open only the files whose catalogue rows may match."""
    base = work_folder(spark, "skip")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    root = _lines(spark, sf_dir, base, ("event_id <= 500", "event_id", stamp), ("event_id > 500", "event_id", stamp))
    every = len(lake.read(spark, root).inputFiles())
    times, numbers = lake.read(spark, root, since="2024-01-05", until="2024-01-07"), lake.read(spark, root, between={"event_id": (100, 120)})
    facts = [rows.agg(F.count("*").alias(n)).withColumn(f, F.lit(len(rows.inputFiles()) < every)) for rows, n, f in ((times, "n", "fewer"), (numbers, "n_between", "fewer_between"))]
    return facts[0].crossJoin(facts[1])


@query("""select field, type, n_changes, gone, n from (values ('event_id', 'bigint', 0::bigint, false, (select count(*) from events)),
            ('x', 'double', 1::bigint, true, (select count(*) from events where event_id % 3 < 2)), ('y', 'string', 0::bigint, false, (select count(*) from events where event_id % 3 > 0))) t(field, type, n_changes, gone, n)""")
def lake_field_log(spark, sf_dir):
    """The log that packing keeps of fields that come, change their type and go, with how many values each has."""
    y = F.col("event_type").alias("y")
    root = _lines(spark, sf_dir, work_folder(spark, "log"), ("event_id % 3 = 0", "event_id", F.expr(_WHOLE.format("x"))), ("event_id % 3 = 1", "event_id", F.expr(_HALF.format("x")), y), ("event_id % 3 = 2", "event_id", y))
    rows = lake.read(spark, root)
    counts = rows.agg(*[F.count(c).alias(c) for c in ("event_id", "x", "y")]).unpivot([], ["event_id", "x", "y"], "field", "n")
    return lake.field_log(spark, root).select("field", "type", "n_changes", "gone").join(counts, "field")


@query("select event_id, event_type as size, user_id as day, event_id % 3 as upper, case when event_id % 2 = 0 then 'x' end as lower from events")
def pack_field_names(spark, sf_dir):
    """Fields that are named like packing's own columns and folders, or differ in case only, are all kept."""
    base = work_folder(spark, "names")
    fields = ("event_id", F.col("event_type").alias("_bytes"), F.col("user_id").alias("day"), (F.col("event_id") % 3).alias("K"), F.when(F.col("event_id") % 2 == 0, "x").alias("k"))
    _staged(view(spark, sf_dir, "events"), f"{base}/in", *fields)
    pack.pack(spark, f"{base}/in", f"{base}/out", "t1", "events", ending=r"\.gz$")
    rows = spark.read.parquet(f"{base}/out/t1/events/data")
    return rows.select("event_id", F.col("_bytes_").alias("size"), F.col("day_").alias("day"), F.col("K").alias("upper"), F.col("k_").alias("lower"))


@query(f"""select cast(strftime(cast(d as timestamp), '%Y') as int) as year, count(*) as n_rows, true as has_sizes, true as has_fields, true as has_checksum, true as has_times, cast(min(event_id) as varchar) as least, cast(max(event_id) as varchar) as most
           from (select event_id, cast(timezone('UTC', cast(case when regexp_matches(value ->> '$.timestamp', '(Z|[+-][0-9:]+)$') then value ->> '$.timestamp' else (value ->> '$.timestamp') || 'Z' end as timestamptz)) as timestamp) as d from {_VALID} v) v group by 1""")
def catalog_rows(spark, sf_dir):
    """What the catalogue has of the files that packing wrote, by year."""
    root, _, _ = _packed(spark, sf_dir)
    files = spark.read.parquet(f"{root}/_catalog/files")
    ids = F.filter("stats", lambda x: x["name"] == "event_id")[0]
    rows = files.select(F.regexp_extract("partition", "year=([0-9]+)", 1).cast("int").alias("year"), "n_rows", (F.col("size") > 0).alias("sized"), (F.size("fields") > 0).alias("typed"), (F.length("checksum") == 64).alias("summed"), F.col("min_ts").isNotNull().alias("timed"), ids["min_value"].cast("long").alias("low"), ids["max_value"].cast("long").alias("high"))
    return rows.groupBy("year").agg(
        F.sum("n_rows").alias("n_rows"), F.min("sized").alias("has_sizes"), F.min("typed").alias("has_fields"), F.min("summed").alias("has_checksum"), F.min("timed").alias("has_times"),
        F.min("low").cast("string").alias("least"), F.max("high").cast("string").alias("most"),
    )


@query("select * from (values ('event_id', 'int64', true), ('event_type', 'string', true), ('ts', 'int64', true), ('user_id', 'int64', true), ('value', 'double', true), ('props', 'string', true)) t(name, type, nullable)")
def footer_fields(spark, sf_dir):
    """Names and types of the fields in the footers of a written table."""
    path = f"{work_folder(spark, 'lake')}/events"
    view(spark, sf_dir, "events").write.parquet(path)
    return catalog.scan_footers(catalog.list_parquet(spark, path)).select(F.explode("fields").alias("x")).select("x.*").distinct()


@query(f"""select cast(event_id as bigint) as event_id, cast(event_id % 3 as bigint) as k, list_value(cast(event_id % 3 as bigint), cast(event_id as bigint)) as ids, event_type as deep from events""")
def flatten_pack(spark, sf_dir):
    """Packing with flattened names: a column for each leaf, array places among them; typed arrays stay arrays without flattening."""
    base = work_folder(spark, "flat")
    number = F.col("event_id") % 3
    fields = ("event_id", F.struct(number.alias("k"), F.struct("event_type").alias("x")).alias("o"), F.array(number, "event_id").alias("ids"))
    _staged(view(spark, sf_dir, "events"), f"{base}/in", *fields)
    for name, delimiter in (("flat", "."), ("whole", None)):
        pack.pack(spark, f"{base}/in", f"{base}/{name}", "t1", "events", ending=r"\.gz$", flatten=delimiter)
    flat, whole = (spark.read.parquet(f"{base}/{name}/t1/events/data") for name in ("flat", "whole"))
    flat = flat.where("`ids.1` = event_id and `ids.0` = `o.k`").select("event_id", F.col("`o.k`").alias("k"), F.col("`o.x.event_type`").alias("deep"))
    return flat.join(whole.select("event_id", "ids"), "event_id")


@query(f"select {FILES} as n_files, true as sized")
def source_listing(spark, sf_dir):
    source, _ = _named(spark, sf_dir)
    files = ndjson.list_files(spark, source, r"\.gz$")
    return files.agg(F.count("*").cast("int").alias("n_files"), (F.min("length") > 0).alias("sized"))


@query("select event_type as dataset, count(*) as n, count(*) filter (event_id % 2 = 0) as with_size from events group by 1")
def merge_files(spark, sf_dir):
    """Inputs with different columns become one table."""
    events = view(spark, sf_dir, "events")
    odd = events.where("event_id % 2 = 1").select(F.col("event_type").alias("dataset"))
    even = events.where("event_id % 2 = 0").select(F.length("props").alias("size"), F.col("event_type").alias("dataset"))
    return ndjson.merged(even, odd).groupBy("dataset").agg(F.count("*").alias("n"), F.count("size").alias("with_size"))


@query("select strftime(ts, '%Y-%m') as month, count(*) as n from events where ts >= timestamp '2024-01-10' group by 1")
def lake_pruning(spark, sf_dir):
    """A predicate on partition columns reads the folders it names only."""
    path = f"{work_folder(spark, 'lake')}/events"
    events = view(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    pack.write_parts(events, path, ["day"], "ts")
    return spark.read.parquet(path).where("day >= '2024-01-10'").groupBy(F.date_format("ts", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("select event_type, count(*) as n, cast(sum(length(props)) as bigint) as bytes from events group by 1")
def compaction(spark, sf_dir):
    base = work_folder(spark, "lake")
    view(spark, sf_dir, "events").repartition(12).write.partitionBy("event_type").parquet(f"{base}/small")
    pack.compacted(spark, f"{base}/small", f"{base}/large", ["event_type"], "ts", 1 << 20)
    return spark.read.parquet(f"{base}/large").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.length("props")).alias("bytes"))


# ---- streams


@query(_COUNTS)
def stream_dead_letters(spark, sf_dir):
    source, out = _named(spark, sf_dir)
    streams.run(streams.lines_of(spark, source), f"{out}/check", streams.split_sink(f"{out}/good", f"{out}/bad")).awaitTermination()
    good, bad = (spark.read.parquet(f"{out}/{x}").agg(F.count("*").alias(n)) for x, n in (("good", "valid"), ("bad", "rejected")))
    return good.crossJoin(bad)


@query(f"select cast(event_id as bigint) as event_id, value ->> '$.event_type' as event_type from {_VALID} v")
def stream_pack(spark, sf_dir):
    """Packing batch by batch gives the rows of packing at once; batches that run again change nothing."""
    source, out = _named(spark, sf_dir)
    for check in ("check", "again"):  # the second query starts anew, with the numbers of the first
        sink = streams.pack_sink(f"{out}/lake", "t1", "events", limit=20_000)
        streams.run(streams.lines_of(spark, source, files_per_batch=2), f"{out}/{check}", sink).awaitTermination()
    return lake.read(spark, f"{out}/lake/t1/events").select("event_id", "event_type")


@query(f"select cast(event_id as bigint) as event_id, value ->> '$.event_type' as event_type from {_VALID} v")
def stream_two_sources(spark, sf_dir):
    """Two streams and a run feed one lake; a stream that lost its checkpoint and takes other batches, and a run over what it packed, add nothing."""
    source, out = _named(spark, sf_dir)
    ways = ((f"{source}/deal=[012]", "first", 2), (f"{source}/deal=[345]", "second", 3), (f"{source}/deal=[012]", "lost", 1))
    for path, check, files in ways:
        sink = streams.pack_sink(f"{out}/lake", "t1", "events")
        streams.run(streams.lines_of(spark, path, files_per_batch=files), f"{out}/{check}", sink).awaitTermination()
    pack.pack(spark, source, f"{out}/lake", "t1", "events", ending=r"\.gz$")
    return lake.read(spark, f"{out}/lake/t1/events").select("event_id", "event_type")


@query(f"select {FILES} as n_batches, (select count(*) from raw_lines) as n_lines")
def stream_bounded(spark, sf_dir):
    source, out = _named(spark, sf_dir)
    streams.run(streams.lines_of(spark, source, files_per_batch=1), f"{out}/check", lambda b, k: b.write.mode("overwrite").parquet(f"{out}/data/batch={k}")).awaitTermination()
    return spark.read.parquet(f"{out}/data").agg(F.count_distinct("batch").cast("int").alias("n_batches"), F.count("*").alias("n_lines"))


@query("select count(*) as n_lines, count(*) as seen from raw_lines")
def stream_progress(spark, sf_dir):
    """The lines that the query's progress reports are those that were written."""
    source, out = _named(spark, sf_dir)
    stream = streams.lines_of(spark, source, files_per_batch=3).observe("lines", F.count("*").alias("seen"))
    progress = streams.Progress()
    spark.streams.addListener(progress)
    try:
        streams.run(stream, f"{out}/check", lambda b, k: b.write.mode("overwrite").parquet(f"{out}/data/batch={k}")).awaitTermination()
        progress.ended.wait(60)
    finally:
        spark.streams.removeListener(progress)
    seen = progress.metrics.get(("lines", "seen"), 0)
    return spark.read.parquet(f"{out}/data").agg(F.count("*").alias("n_lines")).withColumn("seen", F.lit(seen).cast("long"))


@query("select event_type as dataset, case when event_type = 'purchase' then 'fast' else 'normal' end as lane, count(*) as n from events group by 1, 2")
def stream_fast_lane(spark, sf_dir):
    """Testing datasets run in a query of their own, with a shorter trigger in production."""
    base = work_folder(spark, "lanes")
    view(spark, sf_dir, "events").select(F.col("event_type").alias("dataset")).repartition(4).write.parquet(f"{base}/in")
    rows = spark.readStream.schema("dataset string").parquet(f"{base}/in")
    fast = F.col("dataset") == "purchase"
    both = [
        streams.run(part, f"{base}/check-{lane}", lambda b, k, lane=lane: b.write.mode("overwrite").parquet(f"{base}/out/lane={lane}/batch={k}"))
        for lane, part in (("fast", rows.where(fast)), ("normal", rows.where(~fast)))
    ]
    for running in both:  # side by side
        running.awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("dataset", "lane").agg(F.count("*").alias("n"))


@query("select event_type as dataset, case when event_type = 'purchase' then 'fast' else 'slow' end as lane, count(*) as n, true as fast_first from events group by 1, 2")
def stream_lanes(spark, sf_dir):
    """Two lanes with triggers of their own: the fast one ends a batch while a batch of the slow one runs."""
    base, ended = work_folder(spark, "lanes"), threading.Event()
    view(spark, sf_dir, "events").select(F.col("event_type").alias("dataset")).repartition(4).write.parquet(f"{base}/in")
    rows = spark.readStream.schema("dataset string").parquet(f"{base}/in")
    fast, first = F.col("dataset") == "purchase", []

    def sink(lane: str):
        def each(batch: DataFrame, number: int) -> None:
            if lane == "slow" and not first:
                first.append(ended.wait(120))  # a batch that runs for as long as the fast lane takes
            batch.write.mode("overwrite").parquet(f"{base}/out/lane={lane}/batch={number}")
            if lane == "fast":
                ended.set()

        return each

    running = streams.lanes({"slow": (rows.where(~fast), f"{base}/slow", sink("slow"), "5 seconds"), "fast": (rows.where(fast), f"{base}/fast", sink("fast"), "1 second")})
    for lane in running.values():
        lane.processAllAvailable()
        lane.stop()
    return spark.read.parquet(f"{base}/out").groupBy("dataset", "lane").agg(F.count("*").alias("n"), F.lit(first == [True]).alias("fast_first"))


@query("select 't' || (user_id % 2) as tenant, event_type as dataset, count(*) as n, cast(sum(event_id) as bigint) as ids, cast(sum(event_id % 3) as bigint) as own, 1::bigint as n_batches from events group by 1, 2")
def pack_many_datasets(spark, sf_dir):
    """All datasets of all tenants in one run: one listing, scan and inference; a field of each dataset has its name. Packing again adds nothing."""
    base = work_folder(spark, "many")
    events = view(spark, sf_dir, "events").select("event_id", "event_type", F.concat(F.lit("t"), (F.col("user_id") % 2).cast("string")).alias("tenant"))
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"'), F.col("event_type"), F.lit('":'), (F.col("event_id") % 3).cast("string"), F.lit("}"))
    events.select("tenant", F.col("event_type").alias("dataset"), line.alias("value")).write.partitionBy("tenant", "dataset").option("compression", "gzip").text(f"{base}/in")
    for _ in range(2):
        done = pack.pack_many(spark, f"{base}/in", f"{base}/out", ending=r"\.gz$")
    found = None
    for tenant, dataset in done:
        root, name = f"{base}/out/{tenant}/{dataset}", dataset.removeprefix("dataset=")
        rows = lake.read(spark, root).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.sum(F.col(f"`{name}`")).alias("own"))
        rows = rows.select(F.lit(tenant.removeprefix("tenant=")).alias("tenant"), F.lit(name).alias("dataset"), "*").crossJoin(lake.ended(spark, root).agg(F.count("*").alias("n_batches")))
        found = rows if found is None else found.unionAll(rows)
    return found


@query("select event_type as dataset, count(*) filter (event_id % 2 = 0) as first_version, count(*) filter (event_id % 2 = 1) as second_version from events group by 1")
def stream_config_refresh(spark, sf_dir):
    """A running query sees a change of the registry in its next batch."""
    base = work_folder(spark, "registry")
    events = view(spark, sf_dir, "events")

    def newest(session: SparkSession) -> DataFrame:
        rows = session.read.parquet(f"{base}/registry")
        return rows.join(F.broadcast(rows.agg(F.max("version").alias("version"))), "version")

    running = None
    for k in (0, 1):
        events.select(F.col("event_type").alias("dataset")).distinct().write.mode("append").parquet(f"{base}/registry/version={k}")
        events.where(F.col("event_id") % 2 == k).select(F.col("event_type").alias("dataset")).write.mode("append").parquet(f"{base}/in")
        if running is None:
            rows = spark.readStream.schema("dataset string").parquet(f"{base}/in")
            running = streams.run(rows, f"{base}/check", streams.refreshed_sink(newest, ["dataset"], f"{base}/out"), interval="1 second")
        running.processAllAvailable()
    running.stop()
    rows = spark.read.parquet(f"{base}/out").groupBy("dataset")
    return rows.agg(F.count_if(F.col("version") == 0).alias("first_version"), F.count_if(F.col("version") == 1).alias("second_version"))


@query("select event_type as dataset, cast(sum(length(props)) as bigint) as flushed_or_waiting, count(*) as files from events group by 1")
def stream_flush_state(spark, sf_dir):
    """Bytes flushed at the threshold and those still waiting add up to all; the state lives across batches."""
    base = work_folder(spark, "state")
    view(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), F.length("props").cast("long").alias("size"), F.lit(1).cast("long").alias("files")).repartition(3).write.parquet(f"{base}/in")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKS)
    try:
        rows = spark.readStream.schema("dataset string, size long, files long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        state = streams.accumulated(rows, 600)
        query_ = state.writeStream.outputMode("update").option("checkpointLocation", f"{base}/check").foreachBatch(lambda b, k: b.withColumn("k", F.lit(k)).write.mode("overwrite").parquet(f"{base}/out/batch={k}"))
        query_.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    out = spark.read.parquet(f"{base}/out")
    last = out.groupBy("dataset").agg(F.max("k").alias("k"))
    counted = out.join(last.withColumnRenamed("k", "end"), "dataset").where("reason is not null or k = end")
    return counted.groupBy("dataset").agg(F.sum("bytes").alias("flushed_or_waiting"), F.sum("files").alias("files"))


@query("select event_type as dataset, count(*) as n, cast(sum(event_id) as bigint) as ids, true as exact from events group by 1")
def stream_flush_pack(spark, sf_dir):
    """Files wait in state until a dataset has enough; the lake then holds exactly the flushed files, and those that wait are the rest."""
    base = work_folder(spark, "flush")
    deals = 5
    lines = view(spark, sf_dir, "events").select(F.to_json(F.struct("event_id", "event_type")).alias("value"), F.col("event_type").alias("dataset"), (F.col("event_id") % deals).alias("deal"))
    lines.repartition(deals, "deal").write.partitionBy("deal", "dataset").option("compression", "gzip").text(f"{base}/in")
    name = F.regexp_extract("path", "dataset=([^/]+)", 1)
    listed = ndjson.list_files(spark, f"{base}/in", r"\.gz$").select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", name.alias("dataset"))
    threshold = listed.agg(F.max("length") * 3).first()[0]  # three files or more a flush
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKS)
    try:
        let_go = streams.flushed(streams.files_of(spark, f"{base}/in", name, files_per_batch=10), threshold)
        sink = streams.flush_sink(f"{base}/lake", "t1")

        def each(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{base}/log/batch={number}")
            sink(batch, number)

        state = let_go.writeStream.outputMode("update").option("checkpointLocation", f"{base}/check").foreachBatch(each)
        state.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    log = spark.read.schema(f"{streams.FLUSHED}, batch int").parquet(f"{base}/log")
    packed = None
    for dataset in [r.dataset for r in log.select("dataset").distinct().collect()]:
        root = f"{base}/lake/t1/{dataset}"
        same = lake.consumed(spark, root).join(log.where(F.col("dataset") == dataset).select("path", "length"), ["path", "length"], "full_outer").count() == log.where(F.col("dataset") == dataset).count()
        rows = lake.read(spark, root).select("event_id", F.col("event_type").alias("dataset"), F.lit(same).alias("exact"))
        packed = rows if packed is None else packed.unionAll(rows)
    waiting = listed.join(log, "path", "left_anti")
    rest = spark.read.text(f"{base}/in").select(F.from_json("value", "event_id long, event_type string").alias("x"), F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("path")).join(waiting, "path")
    rest = rest.select("x.event_id", F.col("x.event_type").alias("dataset"), F.lit(True).alias("exact"))
    every = rest if packed is None else packed.unionAll(rest)
    return every.groupBy("dataset").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.min("exact").alias("exact"))


@query("select 0 as left_over, (select count(*) from raw_lines) as n_lines")
def stream_source_clean(spark, sf_dir):
    """Files leave the source once a later batch has been committed."""
    source, out = _named(spark, sf_dir)
    for _ in range(2):
        stream = streams.lines_of(spark, source, clean="delete")
        streams.run(stream, f"{out}/check", lambda b, k: b.write.mode("overwrite").parquet(f"{out}/data/batch={k}")).awaitTermination()
        view(spark, sf_dir, "raw_lines").limit(0).select("value").coalesce(1).write.mode("append").text(source)
    left = ndjson.list_files(spark, source, r"\.gz$").agg(F.count("*").cast("int").alias("left_over"))
    return left.crossJoin(spark.read.parquet(f"{out}/data").agg(F.count("*").alias("n_lines")))
