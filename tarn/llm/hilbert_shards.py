"""Sharding along a Hilbert curve.

Several metadata dimensions (language, source, size) are quantised to the
cells of a cube, rows are sorted by the place of their cell on the Hilbert
curve through the cube, and the order is cut into runs whose row counts are
at most one apart (law ``rows``). Neighbours on the curve are neighbours in
every dimension, so each shard covers a narrow range of each and readers can
skip files by their minimum and maximum values. A value's cell is where the
middle of its rows lies among all rows in the dimension's order, so that
frequent values are far apart on the cube's side, and rare ones share cells.
The curve is a table of the cube's 32,768 cells, which is broadcast.

Equal texts form a group that takes the place of its member with the smallest
id, so a group is divided only where a cut falls into it. Ranks come from
range partitions and their row counts; no task and no broadcast grows with a
hot source or group.

Defined cases: a null text has size 1 and no checksum (null), and groups with
other null texts; null sources, languages and ids sort last and are values
like others. Repeated rows get places one after the other. With fewer rows
than shards some shards stay empty; empty tables give empty results. Texts of
any length are fine, as sizes are quantised by rows too. Columns other than
the four that are named aren't read by ``shards``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, kept, ranked, written

SHARDS = 16
#: Bits of a dimension: the cube has 32 cells a side.
BITS = 5


def curve_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of points (rows of ``cells``), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), top
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    place = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | x[i] >> b & 1
    return place


def curve_table(spark: SparkSession) -> DataFrame:
    """(a, b, c, curve) for each cell of the cube: 32,768 rows, whatever the data are."""
    side = np.arange(1 << BITS)
    cells = np.array(np.meshgrid(side, side, side, indexing="ij")).reshape(3, -1).T
    return spark.createDataFrame(pa.table({"a": cells[:, 0], "b": cells[:, 1], "c": cells[:, 2], "curve": curve_index(cells)}))


def _cells(groups: DataFrame, column: str) -> DataFrame:
    """The values of a column with their cells (``column``_cell), from groups of ``n`` rows.

    Values lie in range partitions; only the row count of each partition goes
    through the driver.
    """
    parts = max(1, int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    values = groups.groupBy(column).agg(F.sum("n").alias("n")).repartitionByRange(parts, F.asc_nulls_last(column))
    values = kept(values.withColumn("part", F.spark_partition_id()))
    bases, total = [], 0
    for part, n in sorted(map(tuple, values.groupBy("part").agg(F.sum("n")).collect())):
        bases.append((part, total))
        total += n
    values = values.join(F.broadcast(groups.sparkSession.createDataFrame(bases, "part int, base long")), "part")
    twice = 2 * (F.col("base") + F.sum("n").over(W.partitionBy("part").orderBy(F.asc_nulls_last(column)))) - F.col("n")
    cell = F.floor(twice * (1 << BITS) / F.lit(2 * total or 1)).cast("long")
    return written(values.select(F.col(column).alias("value"), cell.alias(f"{column}_cell")), column)


def shards(df: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """One row for each row of ``df``: doc_id, size, text_crc32, law, shard, slot, grown_shard (null) and curve."""
    text = F.col(text_col)
    rows = written(
        df.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("same"),
        ),
        "rows",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "source", "lang")).alias("x")
    groups = kept(rows.groupBy("same").agg(first, F.min("size").alias("size"), F.count("*").alias("n")).select("same", "x.lang", "x.source", "size", "n"))
    cells = groups
    for column in ("lang", "source", "size"):
        of = _cells(groups, column)
        cells = cells.join(of, cells[column].eqNullSafe(of["value"])).drop("value")
    on = [F.col("lang_cell") == F.col("a"), F.col("source_cell") == F.col("b"), F.col("size_cell") == F.col("c")]
    cells = cells.join(F.broadcast(curve_table(df.sparkSession)), on).select("same", "curve")
    rows = rows.select("doc_id", "size", "text_crc32", "same").join(cells, "same")
    rows = ranked(rows, ["curve", "same", F.asc_nulls_last("doc_id")], "rank")
    total = F.lit(df.count()).cast("long")
    rows = rows.withColumn("shard", F.expr(f"rank * {n_shards}").cast("long")).withColumn("_n", total).withColumn("shard", F.expr("shard div _n").cast("int"))
    slot = F.expr(f"rank - (shard * _n + {n_shards - 1}) div {n_shards}")
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(df: DataFrame, path: str, n_shards: int = SHARDS, id_col: str = "doc_id", **columns: str) -> None:
    """Writes ``df`` with shard and slot below ``path``, a folder a shard, sorted by slot; ids must be unique."""
    places = shards(df, n_shards, id_col, **columns)
    key, shard, slot = fresh(df, "_key"), fresh(df, "shard"), fresh(df, "slot")
    places = places.select(F.col("doc_id").alias(key), F.col("shard").alias(shard), F.col("slot").alias(slot))
    rows = df.join(places, df[id_col].eqNullSafe(F.col(key))).drop(key)
    rows.repartitionByRange(n_shards, shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
