"""Names and paths of a lake: tenant, dataset, partition and file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Partition schemes, and what is unsafe in names.
SCHEMES = ("hive", "date", "date_hour", "tenant_dataset", "none")
UNSAFE = r'[/\\:*?"<>| ~#%]|\.\.'
LONGEST_NAME = 50
LONGEST_PATH = 1024


def partition_path(scheme: str, time: Column) -> Column:
    """The partition folder of a time under a scheme; unknown schemes raise."""
    formats = {
        "hive": "'year='yyyy'/month='MM'/day='dd",
        "date": "yyyy/MM/dd",
        "date_hour": "'year='yyyy'/month='MM'/day='dd'/hour='HH",
    }
    if scheme not in SCHEMES:
        raise ValueError(f"unknown partition scheme {scheme!r}; one of {', '.join(SCHEMES)}")
    return F.date_format(time, formats[scheme]) if scheme in formats else F.lit("")


def partition_columns(scheme: str, time: Column) -> dict[str, Column]:
    """The key=value folders of a scheme as columns to partition by; a time that lacks gives null, Spark's default folder.

    The ``date`` scheme has no keys, so Spark can't write its folders; its
    paths come from ``partition_path`` and are read through a catalogue.
    """
    if scheme == "date" or scheme not in SCHEMES:
        raise ValueError(f"scheme {scheme!r} has no key=value folders")
    depth = {"hive": 3, "date_hour": 4}.get(scheme, 0)
    keys = (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))[:depth]
    return {k: F.date_format(time, p) for k, p in keys}


def safe_name(name: Column) -> Column:
    """A name that is safe in a path: unsafe characters become underscores, 50 characters at most, never empty."""
    return F.coalesce(F.nullif(F.left(F.regexp_replace(name, UNSAFE, "_"), F.lit(LONGEST_NAME)), F.lit("")), F.lit("unknown"))


def custom_path(template: str, tenant: Column, dataset: Column, time: Column) -> Column:
    """A template's path: {tenant}, {dataset}, {year}, {month}, {day} and {hour} filled in, outer slashes gone."""
    path = F.lit(template)
    values = {"{tenant}": safe_name(tenant), "{dataset}": safe_name(dataset)}
    values |= {f"{{{k}}}": F.date_format(time, p) for k, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))}
    for mark, value in values.items():
        path = F.replace(path, F.lit(mark), value)
    return F.btrim(path, F.lit("/"))


def file_name(tenant: Column, dataset: Column, time: Column, batch_hash: Column) -> Column:
    """tenant_dataset_yyyyMMdd_HHmmss_hash, equal for equal input batches."""
    return F.concat_ws("_", safe_name(tenant), safe_name(dataset), F.date_format(time, "yyyyMMdd_HHmmss"), F.left(batch_hash, F.lit(12)))


def ranged_file_name(tenant: Column, dataset: Column, first: Column, last: Column, rows: Column, batch_hash: Column) -> Column:
    """tenant_dataset_first_last_rows_hash: what is in a file, in its name."""
    times = [F.date_format(t, "yyyyMMdd'T'HHmmss") for t in (first, last)]
    return F.concat_ws("_", safe_name(tenant), safe_name(dataset), *times, rows.cast("string"), F.left(batch_hash, F.lit(12)))


def object_key(prefix: Column, tenant: Column, dataset: Column, kind: str, partition: Column, file: Column) -> Column:
    """prefix/tenant/dataset/data/kind/partition/file without empty parts."""
    parts = [prefix, safe_name(tenant), safe_name(dataset), F.lit("data"), F.lit(kind), partition, file]
    return F.concat_ws("/", *[F.nullif(F.btrim(p, F.lit("/")), F.lit("")) for p in parts])


def partition_of(path: Column) -> Column:
    """The key=value parts of a path."""
    return F.array_join(F.filter(F.split(path, "/"), lambda x: x.rlike(r"\w+=\w+")), "/")


def part_key(key: Column, part: Column) -> Column:
    """The key of a part of a file: unchanged for the first, ``_part002`` and so on before the suffix for others."""
    stem, number = F.regexp_replace(key, r"\.parquet$", ""), part.cast("string")
    return F.when(part <= 1, key).otherwise(F.concat(stem, F.lit("_part"), F.lpad(number, F.greatest(F.lit(3), F.length(number)), "0"), F.lit(".parquet")))


def checksum(path: Column, size: Column, modified: Column) -> Column:
    """SHA-256 of path|size|modification second."""
    return F.sha2(F.concat_ws("|", path, size.cast("string"), F.unix_seconds(modified.cast("timestamp")).cast("string")), 256)


def unsafe_reasons(path: Column, tenant: Column, dataset: Column) -> Column:
    """The safety rules that a path breaks, as an array of names."""
    rules = {
        "path traversal": path.contains(".."),
        "tenant folder missing": ~path.contains(safe_name(tenant)),
        "dataset folder missing": ~path.contains(safe_name(dataset)),
        "path too long": F.octet_length(path) > LONGEST_PATH,
    }
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def convention_parts(name: Column) -> Column:
    """Struct of tenant, dataset and stamp of a name like tenant--dataset--stamp--ndjson.gz; nulls where parts lack."""
    parts = F.split(name, "--")
    return F.struct(*[F.try_element_at(parts, F.lit(k)).alias(n) for k, n in enumerate(("tenant", "dataset", "stamp"), 1)])


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def base_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def with_slash(path: Column) -> Column:
    """A path with exactly one slash at its end; an empty one stays empty."""
    return F.when(path == "", path).otherwise(F.concat(F.rtrim(path, F.lit("/")), F.lit("/")))


def job_id(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)
