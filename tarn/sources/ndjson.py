"""Line-delimited JSON: listing, scanning, and telling records from what isn't one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: What the names of data files end with, in lower case: name.ndjson.gz, or tenant--dataset--stamp--ndjson.gz.
DATA_FILE = r"(\.|--)ndjson\.gz$"


def list_files(spark: SparkSession, root: str, ending: str = DATA_FILE) -> DataFrame:
    """Data files below ``root``: path, length and modificationTime. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", "modificationTime").where(F.lower("path").rlike(ending))


def scan(spark: SparkSession, paths: str | list[str], partitions: int | None = None) -> DataFrame:
    """Lines of files that may be compressed: value, path, size, modified.

    A gzip file is one task; ``partitions`` deals the lines out after the scan.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    meta = F.col("_metadata")
    lines = lines.select("value", meta.file_path.alias("path"), meta.file_size.alias("size"), meta.file_modification_time.alias("modified"))
    return lines.repartition(partitions) if partitions else lines


def dealt(lines: DataFrame) -> DataFrame:
    """``lines`` dealt to some tasks a core, or as many as they come in: a compressed file is one task until then.

    They are dealt by their places, as dealing in turns would sort all lines of a file first.
    """
    tasks = max(lines.rdd.getNumPartitions(), 3 * lines.sparkSession.sparkContext.defaultParallelism)
    return lines.withColumn("_place", F.monotonically_increasing_id()).repartition(tasks, "_place").drop("_place")


def classified(lines: DataFrame, value: str = "value") -> DataFrame:
    """``lines`` with record (VARIANT, null unless valid) and status: blank, not json, not an object, or valid."""
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # of equal keys the last holds
    lines = lines.withColumn("_parsed", F.try_parse_json(value)).withColumn("_as", F.schema_of_variant("_parsed"))  # columns, so that a line is parsed once
    parsed, is_object = F.col("_parsed"), F.col("_as").startswith("OBJECT")
    status = F.when(F.trim(F.col(value)) == "", "blank").when(parsed.isNull(), "not json").when(is_object, "valid").otherwise("not an object")
    return lines.withColumn("status", F.when(F.col(value).isNull(), "blank").otherwise(status)).withColumn("record", F.when(is_object, parsed)).drop("_parsed", "_as")


def records(lines: DataFrame, value: str = "value") -> DataFrame:
    return classified(lines, value).where("status = 'valid'")


def quarantined(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that hold no record, with the reason; blank lines aren't kept."""
    return classified(lines, value).where("status in ('not json', 'not an object')").drop("record").withColumnRenamed("status", "reason")


def to_lines(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Rows as JSON lines."""
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def merged(*inputs: DataFrame) -> DataFrame:
    """Several inputs as one, by column names; what an input lacks is null."""
    first, *rest = inputs
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
