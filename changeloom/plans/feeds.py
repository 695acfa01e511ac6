"""Two feeds over the given tables, in Spark and as SQL for DuckDB.

Feed L: an order is a transaction, its line items are row changes. Positions are unique and rise with the order date: seconds * 2^26 + key * 64, each
change one further. Table by return flag, operation by line number, slot by order key.

Feed E: events in the order of event_id are a log of messages. signup defines the table of its user; view, click and purchase are changes; error is a marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 8
LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds_of(ts: Column) -> Column:
    """Seconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_id, xid, commit_ts, base: the position of the begin, o_orderkey."""
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("slot"), (F.col("o_orderkey") % SLOTS).cast("string")).alias("source_id"), (F.col("o_orderkey") + 1).alias("xid"), F.col("o_orderdate").alias("commit_ts"),
        (seconds_of(F.col("o_orderdate")) * 67108864 + F.col("o_orderkey") * 64).alias("base"), "o_orderkey", "o_custkey",
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed L's row changes: source_id, xid, commit_ts, commit_lsn (of the transaction), ord, lsn_num, kind, schema, table, before, after and the line's columns."""
    lines = read(spark, sf_dir, "lineitem").withColumn("ord", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE)).cast("long"))
    joined = lines.join(transactions(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    image = F.to_json(F.create_map(F.lit("l_partkey"), F.col("l_partkey").cast("string"), F.lit("l_suppkey"), F.col("l_suppkey").cast("string")))
    key = F.to_json(F.create_map(F.lit("l_partkey"), F.col("l_partkey").cast("string")))
    kind = F.element_at(F.array(F.lit("T"), F.lit("I"), F.lit("U"), F.lit("D")), (F.col("l_linenumber") % 4 + 1).cast("int"))
    return joined.select(
        "source_id", "xid", "commit_ts", (F.col("base") + 63).alias("commit_lsn"), "ord", (F.col("base") + F.col("ord")).alias("lsn_num"), kind.alias("kind"), F.lit("shop").alias("schema"),
        F.concat(F.lit("lineitem_"), F.lower("l_returnflag")).alias("table"), key.alias("before"), image.alias("after"), *LINE, "l_orderkey", "o_custkey",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed E: source_id, seq, kind, xid, value, props, relation_id."""
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("slot"), (F.col("user_id") % SLOTS).cast("string")).alias("source_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("kind"), F.col("user_id").alias("xid"), "value", "props", F.col("user_id").alias("relation_id"), "ts"
    )


SQL_L = """
txn AS (SELECT 'slot' || (o_orderkey % 8) AS source_id, o_orderkey + 1 AS xid, o_orderdate AS commit_ts, epoch(o_orderdate)::BIGINT * 67108864 + o_orderkey * 64 AS base, o_orderkey, o_custkey FROM orders),
chg AS (SELECT t.source_id, t.xid, t.commit_ts, t.base + 63 AS commit_lsn, l.ord, t.base + l.ord AS lsn_num,
          CASE l_linenumber % 4 WHEN 0 THEN 'T' WHEN 1 THEN 'I' WHEN 2 THEN 'U' ELSE 'D' END AS kind, 'shop' AS schema, 'lineitem_' || lower(l_returnflag) AS "table",
          '{"l_partkey":"' || l_partkey || '"}' AS before, '{"l_partkey":"' || l_partkey || '","l_suppkey":"' || l_suppkey || '"}' AS after, l.*, t.o_custkey
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS ord FROM lineitem) l
        JOIN txn t ON l.l_orderkey = t.o_orderkey)
"""
SQL_E = """
msg AS (SELECT 'slot' || (user_id % 8) AS source_id, event_id AS seq, event_type AS kind, user_id AS xid, value, props, user_id AS relation_id, ts FROM events)
"""
