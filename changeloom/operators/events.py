"""Change events from resolved changes: the envelope, filters, images of rows, truncates, warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.functions.lsn import lsn_format, unsigned32

OPERATIONS = {"I": "insert", "U": "update", "D": "delete", "T": "truncate", "s": "snapshot"}


def operation_of(kind: Column) -> Column:
    """Message kind -> operation."""
    out = F.lit(None).cast("string")
    for k, name in OPERATIONS.items():
        out = F.when(kind == k, F.lit(name)).otherwise(out)
    return out


def full_match(text: Column, pattern: str | None) -> Column:
    """Whether the whole text fits the pattern; a blank pattern lets all through."""
    if pattern is None or not pattern.strip():
        return F.lit(True)
    return text.rlike(rf"\A(?:{pattern})\z")


def captured(changes: DataFrame, schema_pattern: str | None = None, table_pattern: str | None = None) -> DataFrame:
    """Changes of the schemas and tables that both patterns fit. Positions must be taken from the unfiltered log, as what is skipped advances them too."""
    return changes.where(full_match(F.col("schema"), schema_pattern) & full_match(F.col("table"), table_pattern))


def envelope(changes: DataFrame) -> DataFrame:
    """changes (kind, schema, table, lsn_num, xid, commit_ts, before, after) -> change events. Inserts and snapshot rows have no before, deletes and truncates no after."""
    kind = F.col("kind")
    return changes.select(
        operation_of(kind).alias("operation"), "schema", "table", lsn_format(F.col("lsn_num")).alias("lsn"), unsigned32(F.col("xid")).alias("xid"), F.col("commit_ts").alias("commit_timestamp"),
        F.when(kind.isin("U", "D"), F.col("before")).alias("before"), F.when(kind.isin("I", "U", "s"), F.col("after")).alias("after"),
    )


def row_image(columns: Column, cells: Column, omit_unchanged: bool = False) -> Column:
    """Names and cells (kind, text), by place, -> map of name to text. Different lengths fail the query; unchanged cells may be left out."""
    pairs = F.zip_with(columns, cells, lambda c, v: F.struct(c["name"].alias("name"), v["kind"].alias("kind"), v["text"].alias("text")))
    if omit_unchanged:
        pairs = F.filter(pairs, lambda p: p["kind"] != "u")
    image = F.map_from_arrays(F.transform(pairs, lambda p: p["name"]), F.transform(pairs, lambda p: F.when(p["kind"] == "t", p["text"])))
    return F.when(cells.isNull(), None).when(F.size(columns) != F.size(cells), F.raise_error(F.lit("a tuple and its table differ in their number of columns")).cast("map<string,string>")).otherwise(image)


def truncate_fanout(truncates: DataFrame) -> DataFrame:
    """One row per truncated table, in the message's order: relation_ids -> ord (from 0), relation_id."""
    others = [c for c in truncates.columns if c != "relation_ids"]
    return truncates.select(*others, F.posexplode("relation_ids").alias("ord", "relation_id"))


def warn_once(values: DataFrame) -> DataFrame:
    """values (schema, table, column, seq, text: unsupported ones) -> the first of each column: one warning a column."""
    return values.groupBy("schema", "table", "column").agg(F.min("seq").alias("seq"), F.min_by("text", "seq").alias("text")).withColumn("column", F.concat_ws(".", "schema", "table", "column")).select("column", "seq", "text")


def relation_asof(changes: DataFrame, relations: DataFrame, strict: bool = True) -> DataFrame:
    """changes (source_id, relation_id, seq, ...) with ``relation``, the latest definition of their table before them.

    relations: source_id, relation_id, seq, relation. With ``strict`` a change without one fails the query, else it is left out. One table's changes are what a window partition holds; ranges of seq split them.
    """
    from changeloom.operators.ordered import forward_fill

    cells = [F.col(c) for c in changes.columns if c not in ("source_id", "relation_id", "seq")]
    left = changes.select("source_id", "relation_id", "seq", F.struct(*cells).alias("_change"), F.lit(None).cast(relations.schema["relation"].dataType).alias("_relation"))
    right = relations.select("source_id", "relation_id", "seq", F.lit(None).cast(left.schema["_change"].dataType).alias("_change"), F.col("relation").alias("_relation"))
    filled = forward_fill(left.unionByName(right), ["source_id", "relation_id"], "seq", F.col("_relation"), "relation").where(F.col("_change").isNotNull())
    if strict:
        filled = filled.withColumn("relation", F.when(F.col("relation").isNull(), F.raise_error(F.concat(F.lit("no definition of table "), F.col("relation_id").cast("string"))).cast(relations.schema["relation"].dataType)).otherwise(F.col("relation")))
    else:
        filled = filled.where(F.col("relation").isNotNull())
    return filled.select("source_id", "relation_id", "seq", "_change.*", "relation")


def relation_valid(changes: DataFrame, relations: DataFrame, strict: bool = True, bins: int = 1024) -> DataFrame:
    """As relation_asof, of definitions that mostly repeat one another: changes of any width meet, in an equi-join, the stretch of the log in which a definition holds, and are never sorted.

    An equal definition sent again changes nothing, so definitions become stretches of one value; each is listed in all of up to ``bins`` parts of the log's span that it reaches into. A table with a third of all changes
    is thus many keys, and few stretches are broadcast by Spark's own measure of their size.
    """
    by = ["source_id", "relation_id"]
    low, high = changes.agg(F.min("seq"), F.max("seq")).first()
    low, high = low or 0, high or 0
    width = (high - low) // bins + 1
    bin_of = lambda seq: F.floor((F.least(F.greatest(seq, F.lit(low)), F.lit(high)) - low) / width)
    order = Window.partitionBy(*by).orderBy("seq")
    again = lambda order: F.lag("relation").over(order).eqNullSafe(F.col("relation")) & (F.row_number().over(order) > 1)
    # within each part of the log first, so that of a table's definitions one a part is left, and those that differ
    stretches = relations.select(*by, "seq", "relation")
    for within in (Window.partitionBy(*by, bin_of(F.col("seq"))).orderBy("seq"), order):
        stretches = stretches.withColumn("again", again(within)).where("NOT again").drop("again")
    stretches = stretches.withColumn("until", F.lead("seq").over(order))
    reach = F.sequence(bin_of(F.col("seq")), bin_of(F.coalesce(F.col("until") - 1, F.lit(high))))
    listed = stretches.select(*[F.col(c).alias(f"of_{c}") for c in by], F.col("seq").alias("since"), "until", "relation", F.explode(reach).alias("bin")).alias("s")
    others = [c for c in changes.columns if c not in (*by, "seq")]
    met = changes.alias("c").join(
        listed,
        (F.col("c.source_id") == F.col("s.of_source_id")) & (F.col("c.relation_id") == F.col("s.of_relation_id")) & (bin_of(F.col("c.seq")) == F.col("s.bin"))
        & (F.col("c.seq") >= F.col("s.since")) & (F.col("s.until").isNull() | (F.col("c.seq") < F.col("s.until"))),
        "left" if strict else "inner",
    )
    relation = F.col("s.relation")
    if strict:
        relation = F.when(F.col("s.since").isNull(), F.raise_error(F.concat(F.lit("no definition of table "), F.col("c.relation_id").cast("string"))).cast(relations.schema["relation"].dataType)).otherwise(relation)
    return met.select(*[F.col(f"c.{c}") for c in (*by, "seq", *others)], relation.alias("relation"))


def chunked(rows: DataFrame, by: list[str], order: list[str], size: int) -> DataFrame:
    """Snapshot rows with chunk: every ``size`` rows of a table, in order; a chunk never spans tables.

    Numbers come from counts of ranges, so a table isn't one task: range partitions are counted, then numbered inside.
    """
    ranged = rows.withColumn("_cell", F.floor(F.col(order[0]) / 4096))
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*by, "_cell").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*by, "_cell").orderBy(*order)
    return ranged.join(starts, [*by, "_cell"]).withColumn("chunk", F.floor((F.col("_start") + F.row_number().over(inside) - 1) / size)).drop("_cell", "_start")
