"""Mixing sources to target weights by systematic sampling.

Every source gets a target of words by water filling; its rate is target / size, the expected copies of each of its documents.
Within a source the documents are ordered by (size, doc_id) and their expected copies are summed along that order; a document is
emitted once for each integer boundary that its stretch [before + u, after + u) crosses, u being one offset per source, drawn from a
digest of seed and source, so that reruns agree. Ordering by size spreads the copies over all sizes evenly, which keeps the words taken near the target.

The prefix sum needs only a row's position within its source, and that is the sum of three bounded parts: rows of smaller sizes, rows of
the same size in lower ranges of doc_id, and the row number within (source, size, range). So a source with a third of all rows is split by size, and a
size with a third of them by ranges of doc_id, which end at quantiles of all doc_ids, however they are spread; no task holds a source.
Since copies rise along the order of sizes, the words taken from a source differ from its target by less than the size of its largest document.

Cases: null text has size 0; a null source is a source of its own, last in order; null doc_ids come before all others of their
size; rows alike in source, size and doc_id share the copies of their places in any order, which gives the same rows; a source whose size is 0 gets target 0;
an empty table gives an empty result; other columns don't take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.llm.common import WORD, stored, table

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: Ranges of doc_id, cut at their approximate quantiles.
RANGES = 512


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> source, source_size, weight, target.

    The smallest level L with sum(min(most * size, L * weight)) = all sizes, found along the order of most * size / weight: the first k sources are at their
    cap when the level that the others would get is above the k-th ratio and not above the next. This is what sharing by weight and resharing every excess ends in.
    """
    order = Window.orderBy(F.col("source").isNull(), F.hex(F.col("source").cast("binary")))
    # one row per source, so these windows hold no more rows than there are sources
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1).cast("long")).withColumn("cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source"))
    below, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0))).cast("double") / F.sum("weight").over(onward)
    return (
        ranked.withColumn("level", level)
        # the first source in this order that its level does not lift above its cap sets the level for itself and all after it
        .withColumn("held", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")).alias("x"))).over(everything))
        .withColumn("held", F.col("held.level"))
        .select("source", "source_size", "weight", F.when(F.col("held").isNull() | (F.col("held") * F.col("weight") > F.col("cap")), F.col("cap").cast("double")).otherwise(F.col("held") * F.col("weight")).alias("target"))
    )


def offset(source: Column, seed: str = SEED) -> Column:
    """In [0, 1): the first 8 hex digits of md5(seed:source)."""
    return F.conv(F.substr(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("\x00null"))).cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("double") / float(2**32)


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """docs with doc_id, source and size -> the same rows with source_size, target and copies; columns of these three names are replaced, all others, whatever their names, are kept."""
    kept = [c for c in docs.columns if c not in ("source_size", "target", "copies")]
    cuts = docs.agg(F.array_distinct(F.percentile_approx("doc_id", [k / RANGES for k in range(1, RANGES)], 10 * RANGES)).alias("cuts")).scalar()
    # all that belongs to the rows travels in one column, so that no name of theirs meets one of these
    ranged = docs.select("doc_id", "source", "size", cuts.alias("cuts"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("kept"))
    lower = F.when(F.col("doc_id").isNotNull(), F.size(F.filter("cuts", lambda c: c < F.col("doc_id"))))
    ranged = ranged.select("doc_id", "source", "size", lower.alias("range"), "kept")
    cells = ranged.groupBy("source", "size", "range").agg(F.count("*").alias("n"))
    within = Window.partitionBy("source", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("lower", F.coalesce(F.sum("n").over(within), F.lit(0)))
    per_size = cells.groupBy("source", "size").agg(F.sum("n").alias("rows"))
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    per_size = per_size.withColumn("smaller", F.coalesce(F.sum("rows").over(smaller), F.lit(0)))
    share = targets(per_size.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights, most)
    place = (
        cells.alias("c")
        .join(per_size.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")) & (F.col("c.size") == F.col("s.size")))
        .join(share.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
        .select(F.col("c.source").alias("p_source"), F.col("c.size").alias("p_size"), F.col("c.range").alias("p_range"), (F.col("smaller") + F.col("lower")).alias("before"), "source_size", "target")
    )
    numbered = ranged.withColumn("row", F.row_number().over(Window.partitionBy("source", "size", "range").orderBy("doc_id")))
    placed = numbered.join(place, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")) & F.col("range").eqNullSafe(F.col("p_range")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("before") + F.col("row")
    u = offset(F.col("source"), seed)
    return placed.select("kept.*", "source_size", "target", (F.floor(at * rate + u) - F.floor((at - 1) * rate + u)).alias("copies"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sizes are used for the totals and for the places: stored, so that the texts are read once
    docs = stored(table(spark, sf_dir, "documents").select("doc_id", "source", words(F.col("text")).alias("size")), "op2-sizes")
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE) AS level FROM w),
h AS (SELECT *, (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, level LIMIT 1) AS held FROM l),
t AS (SELECT source, source_size, CASE WHEN held IS NULL OR held * weight > cap THEN cap::DOUBLE ELSE held * weight END AS target FROM h),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS place FROM d),
r AS (SELECT n.doc_id, n.size, t.source_size, t.target, place, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        ('0x' || left(md5('mix-1:' || coalesce(n.source, chr(0) || 'null')), 8))::BIGINT::DOUBLE / 4294967296 AS u
      FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(place * rate + u) - floor((place - 1) * rate + u)))::BIGINT AS taken FROM r
"""
