"""Statistics that can be united: distinct values and quantiles kept as sketches, by file, partition or day.

A sketch of a file is made once and never again: those of many files unite to
the sketch of all their rows, by Spark's own aggregates, so the figures of a
dataset cost a few kilobytes a file and column instead of a scan. Distinct
counts (HyperLogLog, 2^12 registers) have a relative standard error of some
1.6%, ranks of quantiles (KLL, k = 200) are off by some 1.7% at most with 99%
confidence. ``catalog.column_statistics`` and ``analytics.durations`` give the
exact figures.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REGISTERS, WIDTH = 12, 200
NUMBERS = "^(tinyint|smallint|int|bigint|float|double|decimal.*)$"
SKETCHES = ("distinct_sketch", "quantile_sketch")


def column_sketches(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """One row for each group and column: n, null_count, min_value, max_value (text), distinct_sketch, and quantile_sketch of numbers.

    All columns are sketched in one pass; the shuffle carries sketches.
    """
    kinds = dict(rows.dtypes)
    parts = []
    for c in columns:
        numeric = re.match(NUMBERS, kinds[c])
        value = F.col(f"`{c}`")
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("data_type"), F.count("*").alias("n"), F.count_if(value.isNull()).alias("null_count"), F.min(value).cast("string").alias("min_value"), F.max(value).cast("string").alias("max_value"),
                F.hll_sketch_agg(value.cast("string"), REGISTERS).alias("distinct_sketch"),
                (F.kll_sketch_agg_double(value.cast("double"), F.lit(WIDTH)) if numeric else F.lit(None).cast("binary")).alias("quantile_sketch"),
            )
        )
    return rows.groupBy(*by).agg(F.array(*parts).alias("_all")).select(*by, F.inline("_all"))


def united(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of many groups as those of fewer: n and null_count added, sketches merged, by ``by`` and column."""
    return sketches.groupBy(*by, "column_name", "data_type").agg(
        F.sum("n").alias("n"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def estimated(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Sketches as figures: distinct_count, and a column ``q50`` and so on for each quantile (null for what is no number)."""
    names = {q: f"q{q * 100:g}".replace(".", "_") for q in quantiles}
    some = F.col("data_type").rlike(NUMBERS) & (F.col("n") > F.col("null_count"))  # other sketches are empty
    figures = [F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q))).alias(n) for q, n in names.items()]
    return sketches.select(*[c for c in sketches.columns if c not in SKETCHES], F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"), *figures)
