"""How schemas change: comparison, union, hashes, versions and a log of fields.

A schema is a table of rows: its number or name (``file``), position, name and type of each field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarn.operators.catalog import beside


def schema_rows(df: DataFrame, file: str) -> DataFrame:
    """The schema of a DataFrame as rows: file, pos, name, type, nullable."""
    rows = [(file, k, f.name, f.dataType.simpleString(), f.nullable) for k, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "file string, pos int, name string, type string, nullable boolean")


def normalised(name: Column) -> Column:
    """A field name in lower case, with underscores for dashes, without _1 and _2 at its end."""
    return F.regexp_replace(F.replace(F.lower(name), F.lit("-"), F.lit("_")), "(_[12])+$", "")


def without_repeats(fields: DataFrame) -> DataFrame:
    """Each schema's fields without those whose normalised name it had before."""
    place = F.row_number().over(W.partitionBy("file", normalised(F.col("name"))).orderBy("pos"))
    return fields.withColumn("_place", place).where("_place = 1").drop("_place")


def united(fields: DataFrame, order: str = "file") -> DataFrame:
    """One schema from many: the first occurrence of each normalised name gives name and type; n_sources counts schemas."""
    first = F.min(F.struct(F.col(order).alias("o"), "pos", "name", "type")).alias("x")
    rows = fields.withColumn("norm", normalised(F.col("name"))).groupBy("norm").agg(first, F.count_distinct("file").alias("n_sources"))
    return rows.select("norm", "x.name", "x.type", "n_sources")


def incompatible(fields: DataFrame, base: DataFrame) -> DataFrame:
    """Differences of schemas from a base (name, type), by name: added, removed or changed fields.

    A schema is one row of arrays beside the base's, so that nothing is
    joined; the shuffle carries each field once.
    """
    mark = "\0"  # types have none
    pair = F.concat("name", F.lit(mark), F.coalesce("type", F.lit("")))
    lists = [F.collect_list("name").alias("_names"), F.collect_list(pair).alias("_pairs")]
    wanted = base.agg(F.struct(*lists)).scalar()
    rows = fields.groupBy("file").agg(*lists).withColumn("_base", wanted)
    added, removed = F.array_except("_names", "_base._names"), F.array_except("_base._names", "_names")
    other = F.transform(F.array_except("_pairs", "_base._pairs"), lambda x: F.regexp_replace(x, f"{mark}[^{mark}]*$", ""))

    def named(names: Column, why: str) -> Column:
        return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(why).alias("difference")))

    return rows.select("file", F.inline(F.concat(named(added, "added"), named(removed, "removed"), named(F.array_except(other, added), "changed"))))


def compatibility(fields: DataFrame, base: DataFrame) -> DataFrame:
    """One row a schema: is it compatible with a base (pos, name, type), and if not, the first reason.

    Fields are compared place by place. Another number of fields (``fields``)
    or another name (``name``, with its place from 0) make it incompatible; types that differ are
    counted only, as readers may cast them.
    """
    listed = F.sort_array(F.collect_list(F.struct("pos", "name", "type")))
    rows = fields.groupBy("file").agg(listed.alias("_own")).withColumn("_base", base.agg(listed).scalar())
    pairs = F.arrays_zip(F.col("_own").alias("own"), F.col("_base").alias("base"))
    renamed = F.transform(pairs, lambda x: ~x["own"]["name"].eqNullSafe(x["base"]["name"]))
    retyped = F.filter(pairs, lambda x: (x["own"]["name"] == x["base"]["name"]) & ~x["own"]["type"].eqNullSafe(x["base"]["type"]))
    many, place = F.size("_own") != F.size("_base"), F.nullif(F.array_position(renamed, F.lit(True)), F.lit(0)) - 1
    reason = F.when(many, "fields").when(place.isNotNull(), "name")
    return rows.select("file", F.size("_own").alias("n_fields"), reason.isNull().alias("compatible"), reason.alias("reason"), F.when(~many, place).alias("place"), F.size(retyped).cast("long").alias("n_types"))


def schema_hash(fields: DataFrame, by: list[str]) -> DataFrame:
    """SHA-256 over name:type in name order, and the number of fields."""
    entries = F.array_sort(F.collect_list(F.concat_ws(":", "name", "type")))
    return fields.groupBy(*by).agg(F.sha2(F.array_join(entries, ","), 256).alias("schema_hash"), F.count("*").alias("n_fields"))


def counted_changes(rows: DataFrame, by: list[str], time: str, value: str, bucket: Column | None = None) -> DataFrame:
    """``rows`` with ``_changes``: how often the value has differed from the one before, up to each row of a group in order of time.

    ``bucket`` follows the order (such as a month): changes are counted within
    buckets and carried from one to the next, so that no window holds more
    than one bucket's rows.
    """
    rows = rows.withColumn("_bucket", F.lit(0) if bucket is None else bucket)
    inside, over = W.partitionBy(*by, "_bucket").orderBy(time), W.partitionBy(*by).orderBy("_bucket")
    differs = lambda before, now: F.coalesce((before != now).cast("long"), F.lit(0).cast("long"))
    rows = rows.withColumn("_step", differs(F.lag(value).over(inside), F.col(value))).withColumn("_inside", F.sum("_step").over(inside))
    sums = rows.groupBy(*by, "_bucket").agg(F.min_by(value, time).alias("_first"), F.max_by(value, time).alias("_last"), F.sum("_step").alias("_sum"))
    sums = sums.withColumn("_edge", differs(F.lag("_last").over(over), F.col("_first"))).withColumn("_base", F.sum(F.col("_sum") + F.col("_edge")).over(over) - F.col("_sum"))
    rows = beside(rows, sums.select(*by, "_bucket", "_base"), [*by, "_bucket"])
    return rows.withColumn("_changes", F.col("_base") + F.col("_inside")).drop("_bucket", "_step", "_inside", "_base")


def field_log(sightings: DataFrame, by: list[str], time: str = "seen_at", bucket: Column | None = None) -> DataFrame:
    """Each field of each dataset: first and last seen, latest type, how often its type changed, whether it is gone."""
    rows = counted_changes(sightings, [*by, "field"], time, "type", bucket)
    log = rows.groupBy(*by, "field").agg(F.min(time).alias("first_seen"), F.max(time).alias("last_seen"), F.max_by("type", time).alias("type"), F.max("_changes").alias("n_changes"))
    log = beside(log, log.groupBy(*by).agg(F.max("last_seen").alias("_latest")), by)
    return log.withColumn("gone", F.col("last_seen") < F.col("_latest")).drop("_latest")


def versions(hashes: DataFrame, by: list[str], time: str, value: str = "schema_hash", bucket: Column | None = None) -> DataFrame:
    """Schema versions counted from 1: one more whenever the hash differs from the one before."""
    return counted_changes(hashes, by, time, value, bucket).withColumn("schema_version", F.col("_changes") + 1).drop("_changes")
