"""Order-dependent building blocks that don't put a whole stream into one task.

A log is cut into ranges of its order column; what has to be carried from range to range is one row each.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = 1 << 20
#: Cells that the quantiles of an order column make.
CELLS = 256


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the folder that driver and executors share (spark.checkpoint.dir) and read again, which cuts the lineage. Where the session names none, as in tests, a local one is taken."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else tempfile.mkdtemp(prefix="spark-")
    path = f"{folder.rstrip('/')}/changeloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _celled(df: DataFrame, order: str) -> DataFrame:
    """df with _range, cut at quantiles of a number: about as many rows in each, however the numbers are spread."""
    cuts = df.agg(F.array_distinct(F.percentile_approx(order, [k / CELLS for k in range(1, CELLS)], 10 * CELLS))).first()[0]  # CELLS numbers at most
    if not cuts:
        return df.withColumn("_range", F.lit(0))
    # how many cuts lie below; without a lambda, as the optimizer may not carry what one refers to over a join
    below = F.array_position(F.sort_array(F.array_append(F.lit(cuts).cast("array<long>"), F.col(order).cast("long"))), F.col(order).cast("long")) - 1
    return df.withColumn("_range", below)


def placed(df: DataFrame, by: list[str], order: list[str], **totals: Column) -> DataFrame:
    """df with ``place``, from 1 in the order of the columns (the first one a number) within ``by``, and running totals: sums of numbers up to each row, or, of a name that begins with top_, the largest so far.

    Cells of the first column are added up on their own, and what is handed from cell to cell is one row each.
    """
    ranged = _celled(df.withColumns({f"_{k}": v for k, v in totals.items()}), order[0])
    total = lambda k, of: F.max(of) if k.startswith("top_") else F.sum(of)
    both = lambda k, a, b: F.greatest(a, b) if k.startswith("top_") else F.coalesce(a, F.lit(0)) + b
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cells = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_n"), *[total(k, f"_{k}").alias(f"_in_{k}") for k in totals])
    cells = cells.select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"), *[total(k, f"_in_{k}").over(before).alias(f"_to_{k}") for k in totals])
    numbers = Window.partitionBy(*by, "_range").orderBy(*order)
    inside = numbers.rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(cells, [*by, "_range"]).withColumn("place", F.col("_first") + F.row_number().over(numbers))
    joined = joined.withColumns({k: both(k, F.col(f"_to_{k}"), total(k, f"_{k}").over(inside)) for k in totals})
    return joined.drop("_range", "_first", *[f"{x}{k}" for k in totals for x in ("_", "_to_")])


def at_or_after(asked: DataFrame, marks: DataFrame, by: list[str], at: str, value: str, name: str) -> DataFrame:
    """asked with ``name``: the ``value`` of the first mark whose ``at`` is no less than the row's own, within ``by``; null where there is none. Marks with one ``at`` count as their smallest value."""
    least = marks.groupBy(*by, at).agg(F.min(value).alias("_mark"))
    cells = [F.col(c) for c in asked.columns if c not in by]
    left = asked.select(*by, (1 - 2 * F.col(at)).alias("_o"), F.struct(*cells).alias("_asked"), F.lit(None).cast(least.schema["_mark"].dataType).alias("_mark"))
    right = least.select(*by, (-2 * F.col(at)).alias("_o"), F.lit(None).cast(left.schema["_asked"].dataType).alias("_asked"), "_mark")
    filled = forward_fill(left.unionByName(right), by, "_o", F.col("_mark"), "_found", width=None).where(F.col("_asked").isNotNull())
    return filled.select(*by, "_asked.*", F.col("_found").alias(name))


def _ranged(df: DataFrame, order: str, width: int | None) -> DataFrame:
    return _celled(df, order) if width is None else df.withColumn("_range", F.floor(F.col(order) / width))


def forward_fill(df: DataFrame, by: list[str], order: str, value: Column, name: str, width: int | None = RANGE) -> DataFrame:
    """df with ``name``: the last non-null ``value`` at or before each row, in the order of a number, within ``by``.

    value is a struct or scalar column. Ranges of ``width`` of the order column (None: between its quantiles) are filled on their own; the first rows of a range take
    what the last marker of the ranges before it left.
    """
    ranged = _ranged(df.withColumn("_v", value), order, width)
    carried = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # every range, so that those without a marker hand on what they got
    marks = ranged.groupBy(*by, "_range").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(order))).alias("_last"))
    ends = marks.withColumn("_before", F.last("_last", True).over(carried)).drop("_last")
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(ends, [*by, "_range"]).withColumn(name, F.coalesce(F.last("_v", True).over(inside), F.col("_before"))).drop("_v", "_range", "_before")


def running_count(df: DataFrame, by: list[str], order: str, what: Column, name: str, width: int = RANGE) -> DataFrame:
    """df with ``name``: how many rows at or before each one satisfy ``what``, within ``by``."""
    ranged = _ranged(df.withColumn("_c", F.when(what, 1).otherwise(0)), order, width)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*by, "_range").agg(F.sum("_c").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(sums, [*by, "_range"]).withColumn(name, F.col("_before") + F.sum("_c").over(inside)).drop("_c", "_range", "_before")
