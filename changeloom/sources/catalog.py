"""What a publication holds, from rows of the server's catalog: tables in order, published columns, key columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def publication_tables(publication: DataFrame, namespaces: DataFrame, classes: DataFrame) -> DataFrame:
    """publication (schemaname, tablename, attnames, rowfilter), namespaces (oid, nspname), classes (oid, relname, relnamespace, relreplident) -> tables by schema and name."""
    return (
        publication.join(namespaces.select(F.col("oid").alias("n_oid"), F.col("nspname").alias("schemaname")), "schemaname")
        .join(classes.select(F.col("oid").alias("relation_id"), F.col("relname").alias("tablename"), F.col("relnamespace").alias("n_oid"), "relreplident"), ["tablename", "n_oid"])
        .select("relation_id", F.col("schemaname").alias("schema"), F.col("tablename").alias("table"), F.col("relreplident").alias("replica_identity"), "attnames", "rowfilter")
        .orderBy("schema", "table")
    )


def published_columns(tables: DataFrame, attributes: DataFrame) -> DataFrame:
    """Live columns of each table in the order of attnum: those of its column list or, without one, all that aren't generated."""
    live = attributes.where((F.col("attnum") > 0) & ~F.col("attisdropped"))
    joined = tables.select("relation_id", "schema", "table", "replica_identity", "attnames").join(live.withColumnRenamed("attrelid", "relation_id"), "relation_id")
    return joined.where(F.when(F.col("attnames").isNull(), F.col("attgenerated") == "").otherwise(F.array_contains("attnames", F.col("attname")))).orderBy("schema", "table", "attnum")


def with_key_flag(columns: DataFrame, indexes: DataFrame) -> DataFrame:
    """columns with ``key``: all with identity full; the primary key's with default, the replica identity index's with index; none else."""
    parts = indexes.where("indisprimary OR indisreplident").select(F.col("indrelid").alias("relation_id"), F.explode("indkey").alias("attnum"), "indisprimary", "indisreplident")
    parts = parts.groupBy("relation_id", "attnum").agg(F.max("indisprimary").alias("in_primary"), F.max("indisreplident").alias("in_replident"))
    identity = F.col("replica_identity")
    key = (identity == "f") | ((identity == "d") & F.coalesce("in_primary", F.lit(False))) | ((identity == "i") & F.coalesce("in_replident", F.lit(False)))
    return columns.join(parts, ["relation_id", "attnum"], "left").withColumn("key", key).drop("in_primary", "in_replident")


def quoted(name: str) -> str:
    """An identifier as SQL writes it."""
    return '"' + name.replace('"', '""') + '"'


def quoted_column(name: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def snapshot_query(schema: str, table: str, columns: list[str], row_filter: str | None = None) -> str:
    """What the server runs for a table's snapshot; values come as text, the row filter is the publication's own."""
    names = ", ".join(f"{quoted(c)}::text" for c in columns)
    return f"SELECT {names} FROM {quoted(schema)}.{quoted(table)}" + (f" WHERE {row_filter}" if row_filter else "")
