"""The queries of the lake operators and, for each, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import layout, rules, timestamps
from tarn.operators import analytics, catalog, evolution, registry, schema, sketches
from tarn.sources import ndjson

from .views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NOW = "timestamp '1997-01-01 00:00:00'"


def now() -> Column:
    return F.expr(f"cast({NOW} as timestamp_ntz)")


def query(tables: str, sql: str | None = None, name: str = ""):
    """Registers a function of the named views (DataFrames) as a query, with its SQL."""

    def register(f):
        own = name or f.__name__
        QUERIES[own] = lambda spark, sf_dir: f(*[view(spark, sf_dir, t) for t in tables.split()])
        if sql:
            ORACLES[own] = with_views(sql)
        return f

    return register


# ---- records: parsing, inference, casts, flattening

STATUS = """case when trim(value) = '' then 'blank' when not json_valid(value) then 'not json'
            when json_type(value) = 'OBJECT' then 'valid' else 'not an object' end"""


@query("raw_lines", f"select {STATUS} as status, count(*) as n from raw_lines group by 1")
def parse_valid_invalid_blank(lines):
    return ndjson.classified(lines).groupBy("status").agg(F.count("*").alias("n"))


@query("raw_lines", f"select event_id, {STATUS} as reason from raw_lines where {STATUS} in ('not json', 'not an object')")
def quarantine_lines(lines):
    return ndjson.quarantined(lines).select("event_id", "reason")


_EACH = f"""(select l.event_id, j.key as field, j.value as v, j.type as t from (select * from raw_lines where {STATUS} = 'valid') l, json_each(l.value) j)"""
_KIND = """case when t in ('BIGINT', 'UBIGINT') then 'bigint' when t = 'DOUBLE' then 'double' when t = 'BOOLEAN' then 'boolean' when t = 'NULL' then 'null'
           when t = 'ARRAY' then 'array' when t = 'OBJECT' then 'string' when regexp_matches(v ->> '$', '^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})?$') then 'timestamp' else 'string' end"""


@query("raw_lines", f"""
    with kinds as (select field, {_KIND} as kind, count(*) as n from {_EACH} group by 1, 2),
         known as (select field, count(*) filter (kind <> 'null') as k, count(*) filter (kind not in ('null', 'bigint', 'double')) as other, max(kind) filter (kind <> 'null') as one, sum(n) as n,
                          coalesce(sum(n) filter (kind = 'null'), 0) as nulls from kinds group by 1)
    select field, case when k = 1 then one when k > 1 and other = 0 then 'double' else 'string' end as type, cast(n as bigint) as n, cast(nulls as bigint) as nulls from known""")
def infer_schema(lines):
    return schema.inferred(ndjson.records(lines))


@query("raw_lines", f"""
    with e as {_EACH}
    select l.event_id,
           max(case when field = 'user_id' and t in ('BIGINT', 'UBIGINT') then cast(v as bigint) end) as user_id,
           max(case when field = 'user_id' then v ->> '$' end) as user_text,
           max(case when field = 'flag' and t = 'BOOLEAN' then case when cast(v as varchar) = 'true' then 1 else 0 end end) as flag,
           max(case when field = 'cents' and t in ('BIGINT', 'UBIGINT') then cast(v as bigint) end) as cents,
           max(case when field = 'props' then cast(v as varchar) end) as props, cast(null as bigint) as absent
    from (select event_id from raw_lines where {STATUS} = 'valid') l join e using (event_id) group by 1""")
def cast_null_on_mismatch(lines):
    records = ndjson.records(lines)
    record = F.col("record")
    names = [("user_id", "bigint"), ("flag", "boolean"), ("cents", "bigint"), ("props", "string"), ("absent", "bigint")]
    rows = schema.projected(records.withColumn("user_text", schema.cast_field(record, "user_id", "string")), names, keep=("event_id", "user_text"))
    return rows.withColumn("flag", F.col("flag").cast("int"))


_DECLARED = [("event_id", "bigint"), ("user_id", "bigint"), ("cents", "bigint"), ("flag", "boolean"), ("event_type", "boolean")]
_FITS = {"bigint": "in ('UBIGINT', 'BIGINT')", "boolean": "= 'BOOLEAN'"}


@query("raw_lines", " union all ".join(
    f"select '{name}' as field, '{kind}' as type, count(*) filter (t <> 'NULL') as n, count(*) filter (t <> 'NULL' and not t {_FITS[kind]}) as lost from (select json_type(value -> '$.{name}') as t from raw_lines where {STATUS} = 'valid') as v"
    for name, kind in _DECLARED))
def cast_losses(lines):
    """Values that a declared schema turns to null, by field."""
    return schema.cast_losses(ndjson.records(lines), _DECLARED)


@query("raw_lines", f"""select event_id, concat('{{"cents":', value -> '$.cents', ',"flag":', value -> '$.flag', ',"props":', replace(value -> '$.props', ' ', ''), '}}') as rest from raw_lines where {STATUS} = 'valid'""")
def rest_fields(lines):
    """What a declared schema has no column for, as JSON."""
    return ndjson.records(lines).select("event_id", schema.rest(F.col("record"), ["event_id", "timestamp", "user_id", "event_type", "tags"]).alias("rest"))


@query("raw_lines", f"""
    select t.event_id, replace(replace(replace(substr(t.fullkey, 3), '"', ''), '[', '.'), ']', '') as path, coalesce(t.atom ->> '$', 'null') as value
    from (select l.event_id, j.fullkey, j.atom, j.type from (select * from raw_lines where {STATUS} = 'valid') l, json_tree(l.value) j) t
    where t.type not in ('OBJECT', 'ARRAY')""")
def flatten_keys(lines):
    return schema.flattened(ndjson.records(lines), "event_id")


@query("raw_lines", f"""
    select event_id, cast(date_trunc('millisecond', cast(timezone('UTC', cast(case when regexp_matches(x, '(Z|[+-][0-9:]+)$') then x else x || 'Z' end as timestamptz)) as timestamp)) as timestamp) as event_ts
    from (select event_id, value ->> '$.timestamp' as x from raw_lines where {STATUS} = 'valid') r""")
def event_time_extract(lines):
    return ndjson.records(lines).select("event_id", timestamps.event_time(F.col("record")).alias("event_ts"))


@query("raw_lines", f"select event_id, cast(json_array_length(value, '$.tags') as int) as n_tags, value ->> '$.tags[0]' as first_tag from raw_lines where {STATUS} = 'valid'")
def array_facts(lines):
    """How many elements an array field has, and the first of them."""
    size, first = schema.array_facts(F.col("record"), "tags")
    return ndjson.records(lines).select("event_id", size.alias("n_tags"), first.alias("first_tag"))


@query("events", """
    select field, type, n from (values ('ids', 'array<bigint>'), ('mixed', 'array'), ('numbers', 'array<double>'), ('flags', 'array<boolean>'), ('none', 'array')) t(field, type), (select count(*) as n from events) c""")
def array_types(events):
    """Types of arrays over all records: elements of one type, of numbers, of none, and mixed."""
    k = F.col("event_id")
    fields = F.struct(F.array(k, k + 1).alias("ids"), F.array(F.when(k % 2 == 0, "x").otherwise("1"), F.lit("y")).alias("mixed"), F.when(k % 2 == 0, F.array(k + 0.5)).otherwise(F.array(k.cast("double") + 0.25)).alias("numbers"), F.array(k % 2 == 0).alias("flags"), F.expr("cast(array() as array<int>)").alias("none"))
    return schema.inferred(ndjson.records(ndjson.to_lines(events, fields.alias("x")).select(F.get_json_object("value", "$.x").alias("value")))).select("field", "type", "n")


@query("events", """
    with s as (select event_id, ts, case event_id % 8 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S.500Z') when 2 then strftime(ts, '%Y-%m-%d %H:%M:%S')
                      when 3 then strftime(ts, '%Y-%m-%dT%H:%M:%S') when 4 then strftime(ts, '%Y-%m-%d') when 5 then strftime(ts, '%Y') when 6 then strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') else 'no time' end as x from events)
    select event_id, event_id % 8 in (0, 1, 2, 3, 6) as is_timestamp,
           case event_id % 8 when 4 then date_trunc('day', ts) when 5 then null when 7 then null when 1 then date_trunc('second', ts) + interval 500 millisecond when 6 then date_trunc('second', ts) - interval 2 hour else date_trunc('second', ts) end as wide_ts,
           strftime(case event_id % 8 when 4 then date_trunc('day', ts) when 5 then null when 7 then null when 6 then date_trunc('second', ts) - interval 2 hour else date_trunc('second', ts) end, '%Y-%m-%dT%H:%M:%SZ') as text,
           case when event_id % 2 = 0 then to_timestamp(event_id)::timestamp else make_timestamp((1000000000001 + event_id) * 1000) end as epoch_ts
    from s""".replace("to_timestamp(event_id)::timestamp", "make_timestamp(event_id * 1000000)"))
def ts_layouts(events):
    iso, kind = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("event_id") % 8
    forms = {0: F.concat(iso, F.lit("Z")), 1: F.concat(iso, F.lit(".500Z")), 2: F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), 3: iso, 4: F.date_format("ts", "yyyy-MM-dd"), 5: F.date_format("ts", "yyyy"), 6: F.concat(iso, F.lit("+02:00"))}
    text = F.lit("no time")
    for k, form in forms.items():
        text = F.when(kind == k, form).otherwise(text)
    rows = events.select("event_id", text.alias("x"))
    number = F.when(F.col("event_id") % 2 == 0, F.col("event_id")).otherwise(F.lit(1000000000001) + F.col("event_id"))
    return rows.select("event_id", timestamps.looks_like_timestamp(F.col("x")).alias("is_timestamp"), timestamps.wide(F.col("x")).alias("wide_ts"), timestamps.rfc3339(timestamps.wide(F.col("x"))).alias("text"), timestamps.from_epoch(number).alias("epoch_ts"))


@query("raw_lines", f"select event_id from (select event_id, row_number() over (partition by event_id % 6 order by event_id) as k from raw_lines where {STATUS} = 'valid') r where k <= 100")
def first_records(lines):
    """The bounded sample of records of each file that inference may be limited to."""
    rows = ndjson.records(lines).withColumn("path", F.col("event_id") % 6)
    return schema.sampled(rows, 100, order="event_id").select("event_id")


# ---- names and paths


@query("events", """
    select event_id, strftime(ts, 'year=%Y/month=%m/day=%d') as hive, strftime(ts, '%Y/%m/%d') as by_date, strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') as by_hour, '' as flat from events""")
def partition_paths(events):
    schemes = (("hive", "hive"), ("by_date", "date"), ("by_hour", "date_hour"), ("flat", "none"))
    return events.select("event_id", *[layout.partition_path(s, F.col("ts")).alias(n) for n, s in schemes])


SAFE = r"""coalesce(nullif(left(regexp_replace({0}, '[/\\:*?"<>| ~#%]|\.\.', '_', 'g'), 50), ''), 'unknown')"""


@query("customer", f"select c_custkey, {SAFE.format('n')} as safe from (select c_custkey, case c_custkey % 4 when 0 then c_name || '/../x' when 1 then '' when 2 then repeat(c_mktsegment || ' ', 9) else c_name || '#~%:*' end as n from customer) s")
def sanitise(customer):
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.concat("c_name", F.lit("/../x"))).when(k == 1, "").when(k == 2, F.repeat(F.concat("c_mktsegment", F.lit(" ")), 9)).otherwise(F.concat("c_name", F.lit("#~%:*")))
    return customer.select("c_custkey", layout.safe_name(name).alias("safe"))


@query("events", f"""
    select event_id, trim(concat('/', {SAFE.format("concat('t ', user_id)")}, '/x/', {SAFE.format('event_type')}, '/', strftime(ts, '%Y-%m-%d-%H'), '/'), '/') as path from events""")
def custom_paths(events):
    tenant = F.concat(F.lit("t "), F.col("user_id").cast("string"))
    return events.select("event_id", layout.custom_path("/{tenant}/x/{dataset}/{year}-{month}-{day}-{hour}/", tenant, F.col("event_type"), F.col("ts")).alias("path"))


@query("files", """
    select path, concat(tenant, '_', dataset, '_', strftime(created, '%Y%m%d_%H%M%S'), '_', left(sha256(path), 12)) as name,
           concat(tenant, '_', dataset, '_', strftime(created, '%Y%m%dT%H%M%S'), '_', strftime(modified, '%Y%m%dT%H%M%S'), '_', n_rows, '_', left(sha256(path), 12)) as ranged from files""")
def file_names(files):
    names = (F.col("tenant"), F.col("dataset"))
    digest = F.sha2("path", 256)
    return files.select("path", layout.file_name(*names, F.col("created"), digest).alias("name"), layout.ranged_file_name(*names, F.col("created"), F.col("modified"), F.col("n_rows"), digest).alias("ranged"))


@query("files", """
    select path, concat('lake/', tenant, '/', dataset, '/data/parquet/', partition, '/f.parquet') as key, concat(tenant, '/', dataset, '/data/raw/f.gz') as bare from files""")
def object_keys(files):
    names = (F.col("tenant"), F.col("dataset"))
    return files.select("path", layout.object_key(F.lit("lake/"), *names, "parquet", F.col("partition"), F.lit("f.parquet")).alias("key"), layout.object_key(F.lit(""), *names, "raw", F.lit(""), F.lit("f.gz")).alias("bare"))


@query("files", """
    select path, partition as found, regexp_replace(path, '/[^/]*$', '') as folder, regexp_extract(path, '[^/]*$') as base, concat(partition, '/') as slashed from files""")
def extract_partition(files):
    p = F.col("path")
    return files.select("path", layout.partition_of(p).alias("found"), layout.folder_of(p).alias("folder"), layout.base_of(p).alias("base"), layout.with_slash(F.concat("partition", F.lit("//"))).alias("slashed"))


@query("files", "select path, case when n_rows <= 1 then path else concat(regexp_replace(path, '[.]parquet$', ''), '_part', lpad(cast(n_rows as varchar), cast(greatest(3, length(cast(n_rows as varchar))) as int), '0'), '.parquet') end as key from files")
def part_keys(files):
    return files.select("path", layout.part_key(F.col("path"), F.col("n_rows")).alias("key"))


@query("files", "select path, sha256(concat(path, '|', size, '|', @secs(modified))) as checksum, concat(tenant, '_', dataset, '_', n_rows) as job_id from files")
def checksum(files):
    return files.select("path", layout.checksum(F.col("path"), F.col("size"), F.col("modified")).alias("checksum"), layout.job_id(F.col("tenant"), F.col("dataset"), F.col("n_rows").cast("string")).alias("job_id"))


@query("files", r"""
    select path, concat_ws(',', case when contains(p, '..') then 'path traversal' end, case when not contains(p, tenant) then 'tenant folder missing' end,
           case when not contains(p, dataset) then 'dataset folder missing' end, case when strlen(p) > 1024 then 'path too long' end) as reasons
    from (select *, case n_rows % 4 when 0 then path when 1 then 'x/../y' when 2 then concat(path, repeat('z', 1100)) else dataset end as p from files) f""")
def path_safety(files):
    k, p = F.col("n_rows") % 4, F.col("path")
    odd = F.when(k == 0, p).when(k == 1, "x/../y").when(k == 2, F.concat(p, F.repeat(F.lit("z"), 1100))).otherwise(F.col("dataset"))
    return files.select("path", F.array_join(layout.unsafe_reasons(odd, F.col("tenant"), F.col("dataset")), ",").alias("reasons"))


@query("files", "select path, tenant, case when n_rows % 2 = 0 then dataset end as dataset, case when n_rows % 2 = 0 then partition end as stamp from files")
def name_convention(files):
    name = F.when(F.col("n_rows") % 2 == 0, F.concat_ws("--", "tenant", "dataset", "partition", F.lit("ndjson.gz"))).otherwise(F.col("tenant"))
    return files.select("path", layout.convention_parts(name).alias("x")).select("path", "x.*")


# ---- the catalogue


@query("events", "select event_type as dataset, count(*) as n_rows, min(ts) as min_ts, max(ts) as max_ts, true as has_time from events group by 1")
def file_ranges(events):
    return catalog.time_ranges(events.withColumnRenamed("event_type", "dataset"), ["dataset"], "ts")


@query("files", "select tenant, cast(sum(n_rows) as bigint) as records, cast(sum(size) as bigint) as input_bytes, count(*) as n_files from files group by 1")
def conversion_totals(files):
    return files.groupBy("tenant").agg(F.sum("n_rows").alias("records"), F.sum("size").alias("input_bytes"), F.count("*").alias("n_files"))


_SUMMARY = "count(*) as file_count, cast(sum(n_rows) as bigint) as total_rows, cast(sum(size) as bigint) as total_bytes, min(created) as first_created, max(modified) as last_modified"


@query("files", f"select tenant, dataset, partition, {_SUMMARY} from files group by 1, 2, 3")
def partition_summary(files):
    return catalog.partition_summary(files)


@query("files", f"select tenant, dataset, partition, case when grouping(partition) = 1 then 'root' else 'leaf' end as level, {_SUMMARY} from files group by grouping sets ((tenant, dataset, partition), (tenant, dataset))")
def leaf_root_rollup(files):
    return catalog.roll_up(files)


@query("files", """
    select tenant, dataset, concat('{"version":1,"num_rows":', sum(n_rows), ',"total_size_bytes":', sum(size), ',"file_count":', count(*), ',"files":[',
           string_agg(concat('{"path":"', path, '","size":', size, ',"n_rows":', n_rows, '}'), ',' order by path), ']}') as document from files group by 1, 2""")
def summary_documents(files):
    return catalog.summary_documents(files, ["tenant", "dataset"])


@query("files", "select tenant, dataset, concat('{\"version\":1,\"num_rows\":', sum(n_rows), ',\"total_size_bytes\":', sum(size), ',\"file_count\":', count(*), ',\"files\":[', string_agg(concat('{\"path\":\"', path, '\"}'), ',' order by path), ']}') as document from files group by 1, 2")
def plain_summaries(files):
    """Summary documents that name the files alone."""
    return catalog.summary_documents(files, ["tenant", "dataset"], with_stats=False)


@query("files", """
    with l as (select path from files union all select distinct concat(tenant, '/', dataset, '/', partition, '/_metadata') from files where n_rows % 3 = 0
               union all select distinct concat(tenant, '/', dataset, '/', partition, '/_common_metadata') from files where n_rows % 2 = 0)
    select regexp_replace(path, '/[^/]*$', '') as folder, bool_or(path like '%/\\_metadata' escape '\\') as has_summary, bool_or(path like '%/\\_common\\_metadata' escape '\\') as has_schema, count(*) filter (path like '%.parquet') as n_files from l group by 1""")
def catalog_report(files):
    for part, name in ((3, "_metadata"), (2, "_common_metadata")):
        marks = files.where(F.col("n_rows").isNotNull() & (F.col("n_rows") % part == 0)).select(F.concat_ws("/", "tenant", "dataset", "partition", F.lit(name)).alias("path")).distinct()
        listing = files.select("path").unionAll(marks) if name == "_metadata" else listing.unionAll(marks)
    return catalog.completeness(listing)


@query("fields", """
    with e as (select name, arg_max(type, concat(file, type)) as type, bool_or(pos > 1) as nullable, count(distinct file) as n from fields group by 1)
    select 'd' as dataset, concat('{"version":1,"fields":[', string_agg(concat('{"name":"', name, '","type":"', type, '","nullable":', nullable, ',"n_files":', n, '}'), ',' order by name), ']}') as document from e""")
def schema_summaries(fields):
    """Documents with the schema alone, of the files of all days."""
    listed = F.collect_list(F.struct("name", "type", (F.col("pos") > 1).alias("nullable")))
    files = fields.groupBy(F.col("file").alias("path")).agg(listed.alias("fields")).select(F.lit("d").alias("dataset"), "path", F.lit(0).alias("modified"), "fields")
    return catalog.schema_documents(files, ["dataset"])


@query("lineitem", " union all ".join(
    f"select '{c}' as column_name, cast(min({c}) as varchar) as min_value, cast(max({c}) as varchar) as max_value, count(*) - count({c}) as null_count, count(distinct {c}) as distinct_count, '{t}' as data_type from lineitem"
    for c, t in (("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_returnflag", "string"), ("l_linestatus", "string"))))
def column_stats(lineitem):
    return catalog.column_statistics(lineitem, ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])


_SKETCHED = ("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")


@query("lineitem", "select name, (select count(*) from lineitem) as n, true as distinct_within, case when name <> 'l_returnflag' then true end as quantiles_within from (values " + ", ".join(f"('{c}')" for c in _SKETCHED) + ") t(name)")
def sketch_statistics(lineitem):
    """Sketches by file, united: distinct counts are within 5% (three standard errors) of the exact ones, ranks of quantiles within 0.02."""
    by_file = sketches.column_sketches(lineitem.withColumn("file", F.col("l_suppkey") % 20), ["file"], list(_SKETCHED))
    figures = sketches.estimated(sketches.united(by_file, []))
    exact = catalog.column_statistics(lineitem, list(_SKETCHED)).select(F.col("column_name").alias("name"), F.col("distinct_count").alias("exact"))
    rows = figures.join(F.broadcast(exact), F.col("column_name") == F.col("name"))  # a row a column
    values = lineitem.unpivot([], [F.col(c).cast("double").alias(c) for c in _SKETCHED if c != "l_returnflag"], "name", "v")
    ranked = values.join(F.broadcast(rows.select("name", "q50", "q95", "q99")), "name").groupBy("name").agg(*[F.avg((F.col("v") <= F.col(q)).cast("double")).alias(f"at{q}") for q in ("q50", "q95", "q99")], *[F.avg((F.col("v") < F.col(q)).cast("double")).alias(f"below{q}") for q in ("q50", "q95", "q99")])
    near = [(F.col(f"at{q}") >= p - 0.02) & (F.col(f"below{q}") <= p + 0.02) for q, p in (("q50", 0.5), ("q95", 0.95), ("q99", 0.99))]
    rows = rows.join(ranked.select("name", (near[0] & near[1] & near[2]).alias("quantiles_within")), "name", "left")
    return rows.select("name", "n", (F.abs(F.col("distinct_count") - F.col("exact")) <= 0.05 * F.col("exact")).alias("distinct_within"), "quantiles_within")


_HASHES = "select tenant, dataset, sha256(string_agg(concat(path, ':', size, ':'), '' order by path)) as batch_hash from files group by 1, 2"


@query("files", _HASHES)
def batch_hash(files):
    return catalog.batch_hash(files, ["tenant", "dataset"])


@query("files", """
    with r as (select tenant, dataset, left(sha256(path), 3) as range, sha256(string_agg(concat(path, ':', size), ',' order by concat(path, ':', size))) as h from files group by 1, 2, 3)
    select tenant, dataset, sha256(string_agg(concat(range, ':', h), ',' order by range)) as tree_hash from r group by 1, 2""")
def batch_tree_hash(files):
    """The hash of a batch from hashes of ranges, so that no array holds a whole group."""
    return catalog.tree_hash(files, ["tenant", "dataset"])


@query("files", f"with h as ({_HASHES}) select * from h where batch_hash not in (select batch_hash from h where tenant in ('t1', 't3'))")
def already_processed(files):
    hashes = catalog.batch_hash(files, ["tenant", "dataset"])
    return catalog.unprocessed(hashes, hashes.where(F.col("tenant").isin("t1", "t3")))


@query("files", "select path, tenant from files where n_rows % 5 = 0")
def orphans(files):
    return catalog.orphans(files, files.where("n_rows % 5 <> 0")).select("path", "tenant")


@query("files", "select path, size from files where not (tenant = 't2' and dataset in (select dataset from files where tenant = 't2' and n_rows % 4 = 1))")
def delete_keys(files):
    return catalog.without_keys(files, files.where("tenant = 't2' and n_rows % 4 = 1"), ["tenant", "dataset"]).select("path", "size")


@query("files", f"""
    with s as (select tenant, dataset, partition, {_SUMMARY} from files where n_rows % 2 = 0 group by 1, 2, 3), w as (select distinct tenant, dataset, partition from files)
    select w.tenant, w.dataset, w.partition, coalesce(file_count, 0) as file_count, coalesce(total_rows, 0) as total_rows, coalesce(total_bytes, 0) as total_bytes, file_count is null as needs_regeneration
    from w left join s on w.tenant = s.tenant and w.dataset = s.dataset and w.partition = s.partition""")
def partition_lookup(files):
    keys = ["tenant", "dataset", "partition"]
    return catalog.with_status(files.select(*keys).distinct(), catalog.partition_summary(files.where("n_rows % 2 = 0")), keys)


@query("files", "select tenant, dataset, path, size, version from (select *, count(*) over (partition by tenant, dataset) as version, row_number() over (partition by tenant, dataset order by modified desc, path) as k from files) f where k = 1")
def upsert_latest(files):
    return catalog.upserted(files, ["tenant", "dataset"], [F.desc("modified"), F.asc("path")]).select("tenant", "dataset", "path", "size", "version")


@query("events", """
    select event_id, 1 + coalesce(sum(length(props) + 20) over (partition by event_type order by ts, event_id rows between unbounded preceding and 1 preceding), 0) // 4096 as part from events""".replace("1 + coalesce", "cast(1 + coalesce").replace("// 4096", "// 4096 as bigint)"))
def part_assignment(events):
    return catalog.numbered_parts(events, ["event_type"], ["ts", "event_id"], F.length("props") + 20, 4096, F.date_trunc("HOUR", "ts")).select("event_id", "part")


# ---- schema evolution

_NORM = "regexp_replace(replace(lower(name), '-', '_'), '(_[12])+$', '')"


@query("fields", f"select file, name, type from (select *, row_number() over (partition by file, {_NORM} order by pos, name, type) as k from fields) f where k = 1")
def dedupe_fields(fields):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("file").orderBy("pos", "name", "type"))
    return evolution.without_repeats(fields.withColumn("pos", place)).select("file", "name", "type")


@query("fields", f"""
    select norm, name, type, n_sources from (select {_NORM} as norm, name, type, row_number() over (partition by {_NORM} order by file, pos, name, type) as k from fields) a
    join (select {_NORM} as norm, count(distinct file) as n_sources from fields group by 1) b using (norm) where k = 1""")
def schema_union(fields):
    return evolution.united(fields)


@query("fields", "select file, sha256(string_agg(concat(name, ':', type), ',' order by concat(name, ':', type))) as schema_hash, count(*) as n_fields from fields group by 1")
def schema_hash(fields):
    return evolution.schema_hash(fields, ["file"])


_ONE = "(select file, name, min(type) as type from fields group by 1, 2)"


@query("fields", f"""
    with o as {_ONE}, base as (select name, type from o where file = (select min(file) from o)), w as (select * from (select distinct file from o) f cross join base)
    select coalesce(w.file, o.file) as file, coalesce(w.name, o.name) as name, case when w.type is null then 'added' when o.type is null then 'removed' else 'changed' end as difference
    from w full outer join o on w.file = o.file and w.name = o.name where w.type is null or o.type is null or w.type <> o.type""")
def schema_compat(fields):
    own = fields.groupBy("file", "name").agg(F.min("type").alias("type"))
    first = own.agg(F.min("file").alias("file"))
    return evolution.incompatible(own, own.join(F.broadcast(first), "file").select("name", "type"))  # one row


@query("fields", """
    with o as (select file, name, type, row_number() over (partition by file order by pos, name, type) as k, count(*) over (partition by file) as n from fields),
    b as (select * from o where file = (select min(file) from o)),
    d as (select o.file, o.n, any_value(o.n) <> (select count(*) from b) as many, min(o.k) filter (o.name is distinct from b.name) - 1 as place, count(*) filter (o.name = b.name and o.type <> b.type) as n_types from o left join b using (k) group by o.file, o.n)
    select file, cast(n as int) as n_fields, not many and place is null as compatible, case when many then 'fields' when place is not null then 'name' end as reason, case when not many then place end as place, n_types from d""")
def schema_verdicts(fields):
    """Is each day's schema compatible with the first day's, place by place, and why not."""
    first = fields.agg(F.min("file").alias("file"))
    return evolution.compatibility(fields, fields.join(F.broadcast(first), "file"))  # one row


@query("fields", f"""
    with o as {_ONE}, c as (select *, coalesce(lag(type) over (partition by name order by file) <> type, false) as changed from o)
    select 'd' as dataset, name as field, min(file) as first_seen, max(file) as last_seen, arg_max(type, file) as type, count(*) filter (changed) as n_changes, max(file) < (select max(file) from o) as gone from c group by name""")
def field_log(fields):
    own = fields.groupBy("file", "name").agg(F.min("type").alias("type"))
    return evolution.field_log(own.select(F.lit("d").alias("dataset"), F.col("name").alias("field"), "type", F.col("file").alias("seen_at")), ["dataset"], bucket=F.left("seen_at", F.lit(8)))


@query("fields", """
    with h as (select file, sha256(string_agg(concat(name, ':', type), ',' order by concat(name, ':', type))) as n from fields group by 1), c as (select *, case when lag(n) over (order by file) <> n then 1 else 0 end as changed from h)
    select 'd' as dataset, file, cast(1 + sum(changed) over (order by file) as bigint) as schema_version from c""")
def schema_versions(fields):
    hashes = evolution.schema_hash(fields, ["file"]).withColumn("dataset", F.lit("d"))
    return evolution.versions(hashes, ["dataset"], "file", bucket=F.left("file", F.lit(8))).select("dataset", "file", "schema_version")


@query("lineitem", "select case l_linenumber when 1 then 'int32' when 2 then 'timestamp' when 3 then 'string' else 'unknown' end as name, count(*) as n from lineitem group by 1")
def type_names(lineitem):
    physical = F.element_at(F.array(*map(F.lit, ("INT32", "INT96", "BYTE_ARRAY", "none", "none", "none", "none"))), F.col("l_linenumber"))
    return lineitem.groupBy(catalog.type_name(physical).alias("name")).agg(F.count("*").alias("n"))


# ---- registry and jobs


@query("jobs registry", """
    with t as (select tenant, row_number() over (order by tenant) - 1 as k from (select distinct tenant from registry) x)
    select j.job_id, t.tenant as registered, t.tenant is not null as found from jobs j left join t on j.tenant = concat('t', t.k)""")
def config_lookup(jobs, reg):
    from pyspark.sql import Window

    numbered = reg.select("tenant").distinct().withColumn("k", F.row_number().over(Window.orderBy("tenant")) - 1)
    numbered = numbered.select(F.concat(F.lit("t"), F.col("k").cast("string")).alias("tenant"), F.col("tenant").alias("registered"))
    return registry.looked_up(jobs, numbered, ["tenant"]).select("job_id", "registered", "found")


@query("region nation registry", """
    select r_name as account, n_name as tenant, coalesce(string_agg(dataset, ',' order by dataset), '') as datasets, count(dataset) as n_datasets
    from region join nation on n_regionkey = r_regionkey left join registry d on d.tenant = n_name group by 1, 2""")
def registry_tree(region, nation, reg):
    accounts = region.select(F.col("r_name").alias("account"), F.col("r_regionkey").alias("k"))
    tenants = nation.join(accounts, F.col("n_regionkey") == F.col("k")).select("account", F.col("n_name").alias("tenant"))
    rows = registry.assembled(accounts.select("account"), tenants, reg.select("tenant", "dataset"))
    return rows.withColumn("datasets", F.array_join("datasets", ","))


@query("registry", "select account, tenant, dataset, case when members % 3 = 0 then 's3' else 'MinIO' end as destination_type from registry where members % 7 <> 0 and members % 5 <> 0 and members % 3 <> 1 and members % 2 = 0")
def eligible_datasets(reg):
    n = F.col("members")
    kind = F.when(n % 3 == 0, "s3").when(n % 3 == 1, "ftp").otherwise("MinIO")
    rows = reg.withColumns({"account_active": n % 7 != 0, "tenant_active": F.lit(True), "dataset_active": n % 5 != 0, "deployment": F.lit("on"), "destination": F.col("dataset"), "destination_type": kind, "destination_active": n % 2 == 0})
    return registry.deliverable(registry.eligible(rows, "on")).select("account", "tenant", "dataset", "destination_type")


@query("registry", "select case when testing then 'fast' else 'normal' end as lane, count(*) as n from registry group by 1")
def lanes(reg):
    fast, normal = registry.lanes(reg)
    return fast.withColumn("lane", F.lit("fast")).unionAll(normal.withColumn("lane", F.lit("normal"))).groupBy("lane").agg(F.count("*").alias("n"))


@query("jobs", """
    select job_id, concat_ws(',', case when asked_tenant = 'string' then 'literal string' end, case when kind = '' then 'type empty' end) as broken,
           case when asked_tenant not in (select tenant from jobs) then 'tenant not found' when concat(asked_tenant, '/', dataset) not in (select concat(tenant, '/', dataset) from jobs) then 'dataset not found' end as reason
    from jobs""")
def validate_refs(jobs):
    known = jobs.select("tenant", "dataset").distinct()
    asked = jobs.select("job_id", F.col("asked_tenant").alias("tenant"), "dataset", "kind")
    rows = registry.referenced(asked, known)
    return rows.select("job_id", F.array_join(registry.violations(F.col("tenant"), F.col("dataset"), F.col("kind")), ",").alias("broken"), "reason")


@query("jobs", "select distinct asked_tenant as tenant, dataset, kind from jobs j where not exists (select 1 from jobs q where q.state in ('queue', 'retry') and q.tenant = j.asked_tenant and q.dataset = j.dataset)")
def inflight_dedupe(jobs):
    """What is asked for and not in flight: tenants that have no job, unknown ones among them."""
    asked = jobs.select(F.col("asked_tenant").alias("tenant"), "dataset", "kind").distinct()
    return registry.not_in_flight(asked, jobs, ["tenant", "dataset"])


@query("jobs", "select job_id, coalesce(nullif(priority, 0), 1) as priority from jobs where job_id % 9 <> 0")
def request_defaults(jobs):
    rows = jobs.withColumn("dataset", F.when(F.col("job_id") % 9 != 0, F.col("dataset")))
    return registry.completed_requests(rows).select("job_id", "priority")


@query("jobs", f"select job_id, kind from jobs where case kind when 'upload' then epoch({NOW}) - epoch(created) > 20000 * 3600 when 'convert' then epoch({NOW}) - epoch(created) > 9000 * 3600 else false end")
def retention_sweep(jobs):
    return registry.overaged(jobs, {"upload": 20000, "convert": 9000}, now()).select("job_id", "kind")


@query("jobs", f"select count(*) filter (created < {NOW}) as files, count(*) filter (created < {NOW} and state = 'dlq') as status from jobs")
def ttl_expired(jobs):
    return catalog.expired(jobs, now(), "created").agg(F.count("*").alias("files"), F.count_if(F.col("state") == "dlq").alias("status"))


@query("jobs", f"select job_id, priority, created from jobs where state = 'retry' and created < {NOW}")
def ready_retries(jobs):
    return registry.due(jobs.withColumn("retry_after", F.col("created")), now()).orderBy(F.desc("priority"), "retry_after").select("job_id", "priority", "created")


@query("jobs", "select tenant, job_id, place from (select *, row_number() over (partition by tenant order by priority desc nulls last, created, job_id) as place from jobs where state = 'queue') j")
def queue_order(jobs):
    return analytics.ranked_queue(jobs, ["tenant"]).select("tenant", "job_id", F.col("place").cast("long").alias("place"))


@query("jobs", "select job_id, tenant from jobs where state = 'queue' order by priority desc nulls last, created, job_id limit 1")
def next_job(jobs):
    return jobs.where("state = 'queue'").orderBy(F.desc_nulls_last("priority"), "created", "job_id").limit(1).select("job_id", "tenant")


@query("jobs", "select job_id from jobs where state = 'queue' order by created, job_id limit 50")
def queue_cap(jobs):
    return jobs.where("state = 'queue'").orderBy("created", "job_id").limit(50).select("job_id")


@query("jobs", """
    with q as (select tenant, dataset, count(*) filter (state = 'queue') as queued from jobs group by 1, 2),
    r as (select *, row_number() over (partition by tenant, dataset order by created, job_id) as place from jobs where state = 'retry')
    select r.job_id, r.tenant, r.dataset from r join q on q.tenant = r.tenant and q.dataset = r.dataset where place <= 50 - queued""")
def queue_room(jobs):
    """Jobs to be tried again that find room beside what is queued."""
    waiting, queued = jobs.where("state = 'retry'"), jobs.where("state = 'queue'")
    return registry.admitted(waiting, queued, ["tenant", "dataset"], ["created", "job_id"], 50).select("job_id", "tenant", "dataset")


_STATES = f"count(*) filter (state = 'queue') as queue, count(*) filter (state = 'retry') as retry, count(*) filter (state = 'dlq') as dlq, count(*) filter (state = 'retry' and created < {NOW}) as ready_retries"


@query("jobs", f"select tenant, {_STATES} from jobs group by 1")
def queue_stats(jobs):
    return analytics.queue_statistics(jobs.withColumn("retry_after", F.col("created")), ["tenant"], now())


@query("jobs", f"select tenant, case when dlq > 500 then 'unhealthy' when dlq > 100 then 'warning' else 'healthy' end as health, retry > 100 as retry_alert, dlq > 50 as dead_alert, queue > 0 or ready_retries > 0 as queue_active from (select tenant, {_STATES} from jobs group by 1) s")
def health_ladder(jobs):
    rows = analytics.queue_statistics(jobs.withColumn("retry_after", F.col("created")), ["tenant"], now())
    return rows.select("tenant", rules.health(F.col("dlq")).alias("health"), (F.col("retry") > 100).alias("retry_alert"), (F.col("dlq") > 50).alias("dead_alert"), ((F.col("queue") > 0) | (F.col("ready_retries") > 0)).alias("queue_active"))


@query("jobs", "select job_id, cast(least(30 * power(2, attempts), 1800) as bigint) as requeue, 10 * attempts * attempts as upload, cast(least(2 * power(2, attempts), 30) as bigint) as startup, case when attempts >= 10 then 'CRITICAL' when attempts >= 5 then 'HIGH' else 'MEDIUM' end as severity from jobs")
def backoff(jobs):
    a = F.col("attempts")
    return jobs.select("job_id", rules.requeue_delay(a).alias("requeue"), rules.upload_delay(a).alias("upload"), rules.startup_delay(a).alias("startup"), rules.severity(a).alias("severity"))


@query("uploads", """
    select order_key, line, case kind when 'R' then case when attempts >= 10 then 'CRITICAL' when attempts >= 5 then 'HIGH' else 'MEDIUM' end
                                      when 'A' then case when attempts > 3 then 'CRITICAL' else 'MEDIUM' end else 'HIGH' end as severity
    from uploads""")
def alert_severity(uploads):
    kind = F.when(F.col("kind") == "R", "registry update").when(F.col("kind") != "A", "processing").when(F.col("attempts") > 3, "upload given up").otherwise("upload retry")
    return uploads.select("order_key", "line", rules.alert_severity(kind, F.col("attempts")).alias("severity"))


@query("jobs", "select job_id % 4 = 1 as lock_conflict, count(*) as n from jobs group by 1")
def classify_errors(jobs):
    k = F.col("job_id") % 4
    message = F.when(k == 1, "Failed to Acquire Lock on x").when(k == 2, "disk full").when(k == 3, "blocked")
    return jobs.groupBy(rules.is_lock_conflict(message).alias("lock_conflict")).agg(F.count("*").alias("n"))


@query("customer", "select c_custkey, case when s = '' then '' when length(s) <= 8 then '***' else concat(left(s, 4), '***', right(s, 4)) end as masked from (select c_custkey, case when c_custkey % 5 = 0 then '' when c_custkey % 5 = 1 then 'short' else c_name end as s from customer) c")
def mask_values(customer):
    k = F.col("c_custkey") % 5
    return customer.select("c_custkey", rules.masked(F.when(k == 0, "").when(k == 1, "short").otherwise(F.col("c_name"))).alias("masked"))


@query("files", """
    select path, concat('tenant=', case when n_rows % 2 = 0 then dataset else tenant end, ';by=lake', case when n_rows % 2 = 0 then ';own=1' else '' end) as tags from files""")
def merge_tags(files):
    first = F.create_map(F.lit("tenant"), F.col("tenant"), F.lit("by"), F.lit("lake"))
    second = F.when(F.col("n_rows") % 2 == 0, F.create_map(F.lit("tenant"), F.col("dataset"), F.lit("own"), F.lit("1")))
    tags = rules.merged_tags(first, second)
    order = F.filter(F.array(F.lit("tenant"), F.lit("by"), F.lit("own")), lambda k: F.map_contains_key(tags, k))
    return files.select("path", F.array_join(F.transform(order, lambda k: F.concat(k, F.lit("="), F.element_at(tags, k))), ";").alias("tags"))


@query("registry", "select account, tenant, dataset, case when members % 2 = 0 then 'root' else 'leaf' end as level, case when members % 2 = 0 then cast(members as varchar) end as bucket from registry")
def config_defaults(reg):
    text = F.when(F.col("members") % 2 == 0, F.concat(F.lit('{"parquet":{"metadata_level":"root"},"destination":{"connection":{"bucket":"'), F.col("members").cast("string"), F.lit('"}}}'))).otherwise("{}")
    config = F.try_parse_json(text)
    return reg.select("account", "tenant", "dataset", rules.setting(config, "$.parquet.metadata_level", default="leaf").alias("level"), rules.setting(config, "$.destination.connection.bucket").alias("bucket"))


# ---- pipeline analytics


@query("files", f"""
    select *, reason <> 'waiting' as should_flush, least(100.0, bytes * 100.0 / 20000)::double as progress from (select tenant, dataset, cast(sum(size) as bigint) as bytes, count(*) as n_files, case when bool_or(dataset = 'view') then 'testing' when sum(size) >= 20000 then 'size' when epoch(timestamp '2024-01-20 00:00:00') - epoch(min(modified)) >= 86400 then 'time' else 'waiting' end as reason
    from files group by 1, 2) f""")
def flush_decision(files):
    at = F.expr("cast(timestamp '2024-01-20 00:00:00' as timestamp_ntz)")
    rows = analytics.flush_decision(files.withColumn("testing", F.col("dataset") == "view"), ["tenant", "dataset"], at, 20000, 86400, "testing")
    return rows.select("tenant", "dataset", "bytes", "n_files", "reason", "should_flush", "progress")


@query("uploads", "select destination, kind, grouping(destination) as all_destination, grouping(kind) as all_kind, count(*) as n, count(*) filter (not success) as failures, cast(sum(bytes) as bigint) as bytes from uploads group by cube (destination, kind)")
def pipeline_counters(uploads):
    rows = analytics.counters(uploads, ["destination", "kind"])
    return rows.withColumns({c: F.col(c).cast("long") for c in ("all_destination", "all_kind")})


@query("uploads", "select destination, quantile_cont(millis, 0.5) as p50, round(quantile_cont(millis, 0.95), 3) as p95, round(quantile_cont(millis, 0.99), 3) as p99, count(*) as n from uploads group by 1")
def duration_percentiles(uploads):
    spread, _ = analytics.durations(uploads, ["destination"], "millis", 10, 0, 100000)
    return spread.withColumns({c: F.round(c, 3) for c in ("p95", "p99")})


@query("uploads", "select destination, cast(least(greatest(millis // 10000 + 1, 0), 11) as bigint) as bucket, count(*) as n from uploads group by 1, 2")
def duration_histogram(uploads):
    _, histogram = analytics.durations(uploads, ["destination"], "millis", 10, 0, 100000)
    return histogram


@query("events", "select count(distinct user_id) as active_tenants, count(distinct event_type) as active_datasets, max(case when value > 0 then 1 else 0 end) as healthy from events")
def gauges(events):
    return events.agg(F.count_distinct("user_id").alias("active_tenants"), F.count_distinct("event_type").alias("active_datasets"), F.max((F.col("value") > 0).cast("int")).alias("healthy"))


@query("uploads", """
    select destination, cast(sum(bytes) as bigint) as input_bytes, cast(sum(millis) as bigint) as output_bytes, count(*) as lines, count(*) filter (not success) as errors, round(sum(millis) / sum(bytes), 6) as ratio, round(sum(millis) / sum(bytes) * 1048576, 2) as estimated_output from uploads group by 1""")
def throughput_ratio(uploads):
    rows = uploads.select("destination", F.col("bytes").alias("input_bytes"), F.col("millis").alias("output_bytes"), F.lit(1).alias("lines"), (~F.col("success")).cast("int").alias("errors"))
    return analytics.throughput(rows, ["destination"], 1 << 20).withColumns({"ratio": F.round("ratio", 6), "estimated_output": F.round("estimated_output", 2)})


@query("uploads", "select destination, count(*) as total, count(*) filter (success) as succeeded, count(*) filter (not success) as failed, count(*) filter (attempts > 1) as retried, cast(sum(case when success then bytes else 0 end) as bigint) as bytes from uploads group by 1")
def upload_stats(uploads):
    return analytics.upload_statistics(uploads, ["destination"])


@query("uploads", """
    select order_key, case when arg_max(case when success then 1 else 0 end, row(line, millis, success)) = 1 then 'done' else 'failed' end as status, cast(max(line) as bigint) as current, 7 as total, count(*) filter (not success) as errors, round(max(line) * 100.0 / 7, 4) as percent from uploads group by 1""")
def operation_progress(uploads):
    """Of updates with the same line and time, one that succeeded is the latest."""
    rows = uploads.select("order_key", "line", "millis", "success", F.when(F.col("success"), "done").otherwise("failed").alias("status"), F.col("line").cast("long").alias("current"), F.lit(7).alias("total"), (~F.col("success")).cast("int").alias("errors"))
    return analytics.progress(rows, "order_key", ["line", "millis", "success"]).withColumn("percent", F.round("percent", 4))


@query("uploads", """
    select destination, coalesce(severity, 'error') as severity, count(*) as n, arg_max(error, row(happened, order_key, line)) as sample from uploads where not success group by 1, 2""")
def error_rollup(uploads):
    rows = uploads.where("not success").withColumn("message", F.col("error"))
    return analytics.error_roll_up(rows, ["destination"], ["happened", "order_key", "line"])


@query("uploads", "select destination, kind, count(*) filter (success) as processed, count(*) filter (bytes > 40000) as skipped, count(*) filter (not success) as failed, cast(sum(bytes) as bigint) as bytes from uploads group by rollup (destination, kind)")
def result_totals(uploads):
    rows = uploads.withColumns({"processed": F.col("success"), "skipped": F.col("bytes") > 40000, "failed": ~F.col("success")})
    return analytics.totals(rows, ["destination", "kind"])


_STREAK = """
    with i as (select *, coalesce(sum(case when success then 1 else 0 end) over (partition by destination order by happened, order_key, line rows between unbounded preceding and 1 preceding), 0) as island from uploads),
         s as (select *, case when success then 0 else cast(sum(case when success then 0 else 1 end) over (partition by destination, island order by happened, order_key, line) as bigint) end as streak from i)"""
_ORDER = ["happened", "order_key", "line"]
#: The same where uploads may be alike in time, order and line: those that failed come first, and count together.
_STREAK_OF_TIES, _ORDER_OF_TIES = _STREAK.replace("order by happened, order_key, line", "order by happened, order_key, line, success"), [*_ORDER, "success"]


def _day() -> Column:
    return F.date_trunc("DAY", "happened")



@query("uploads", _STREAK_OF_TIES + " select destination, order_key, line, streak from s")
def failure_streak(uploads):
    return analytics.streaks(uploads, ["destination"], _ORDER_OF_TIES, bucket=_day()).select("destination", "order_key", "line", "streak")


@query("uploads", _STREAK + " select destination, arg_max(streak, row(happened, order_key, line)) as failures, arg_max(error, row(happened, order_key, line)) filter (not success) as last_error, arg_max(streak, row(happened, order_key, line)) < 3 as active from s group by 1")
def circuit_breaker(uploads):
    return analytics.circuits(uploads, ["destination"], _ORDER, bucket=_day())


@query("uploads", _STREAK_OF_TIES + " select destination, order_key, line, streak from s where streak >= 3 and streak % 3 = 0")
def every_third_alert(uploads):
    return analytics.alerts(uploads, ["destination"], _ORDER_OF_TIES, bucket=_day()).select("destination", "order_key", "line", "streak")


@query("uploads", "select order_key, round(list_reduce(list(cast(millis as double) order by line, millis), lambda a, x: (a + x) / 2), 6) as average, count(*) as n from uploads group by 1")
def ewma(uploads):
    return analytics.smoothed(uploads, ["order_key"], ["line", "millis"], "millis").withColumn("average", F.round("average", 6))


@query("uploads", "select destination, order_key, line from (select *, row_number() over (partition by destination order by happened desc, order_key, line) as k from uploads where not success) u where k <= 1000")
def recent_history(uploads):
    return analytics.recent(uploads.where("not success"), ["destination"], [F.desc("happened"), F.asc("order_key"), F.asc("line")], 1000).select("destination", "order_key", "line")


@query("events", """
    select event_id, place from (select event_id, row_number() over w as place, epoch(ts) - epoch(lag(ts) over w) as gap from events window w as (partition by event_type order by ts, event_id)) e where place % 100 = 0 or floor(gap) > 30""".replace("epoch(ts) - epoch(lag(ts) over w)", "floor(epoch(ts)) - floor(epoch(lag(ts) over w))").replace("floor(gap)", "gap"))
def throttle_reports(events):
    return analytics.throttled(events, ["event_type"], ["ts", "event_id"], 100, 30, "ts", F.date_trunc("HOUR", "ts")).select("event_id", F.col("place").cast("long").alias("place"))


# ---- consumers


@query("events", "select event_type as dataset, count(*) as n from events group by 1")
def dataset_counts(events):
    return events.groupBy(F.col("event_type").alias("dataset")).agg(F.count("*").alias("n"))


@query("events", "select event_type as dataset, cast(ts as date) as day, count(*) as n_rows, cast(sum(length(props)) as bigint) as bytes from events group by 1, 2")
def daily_counts(events):
    """The shortest way through the lake: rows to JSON lines, parsed, typed, with their event time, and counted by day."""
    names = [("event_type", "string"), ("props", "string")]
    lines = ndjson.to_lines(events, "event_type", "props", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("timestamp"))
    records = ndjson.records(lines).withColumn("event_ts", timestamps.event_time(F.col("record")))
    rows = schema.projected(records, names, keep=("event_ts",))
    return rows.groupBy(F.col("event_type").alias("dataset"), F.col("event_ts").cast("date").alias("day")).agg(F.count("*").alias("n_rows"), F.sum(F.length("props")).alias("bytes"))


from . import lake_queries  # noqa: E402, F401  registers the queries that write and stream
