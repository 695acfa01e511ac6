"""Queries over logs: envelope, filters, joins in time, transactions, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.functions import lsn as L
from changeloom.operators import batches as B
from changeloom.operators import events as E
from changeloom.operators import transactions as X
from changeloom.plans.feeds import SQL_E, SQL_L, changes, messages, read, seconds_of, transactions

QUERIES: dict = {}
ORACLES: dict = {}
LSN = "printf('%X/%X', lsn_num >> 32, lsn_num & 4294967295)"
OPERATION = "CASE kind WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' WHEN 'D' THEN 'delete' WHEN 'T' THEN 'truncate' END"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"""WITH {SQL_L} SELECT {OPERATION} AS operation, schema, "table", {LSN} AS lsn, xid, commit_ts AS commit_timestamp,
  CASE WHEN kind IN ('U', 'D') THEN before END AS before, CASE WHEN kind IN ('I', 'U') THEN after END AS after FROM chg""")
def change_envelope(spark: SparkSession, d: str) -> DataFrame:
    return E.envelope(changes(spark, d))


@query(f"""WITH {SQL_L} SELECT "table", count(*) AS n, max(lsn_num) AS last_lsn, (SELECT max(base + 63) FROM txn) AS position FROM chg
  WHERE regexp_full_match(schema, 'sh.p') AND regexp_full_match("table", 'lineitem_(a|n)') GROUP BY "table" """)
def schema_table_filter(spark: SparkSession, d: str) -> DataFrame:
    position = transactions(spark, d).agg(F.max(F.col("base") + 63).alias("position"))
    kept = E.captured(changes(spark, d), "sh.p", "lineitem_(a|n)")
    return kept.groupBy("table").agg(F.count("*").alias("n"), F.max("lsn_num").alias("last_lsn")).withColumn("position", position.scalar())


@query(f"""WITH {SQL_E} SELECT c.seq, c.relation_id, c.kind, r.seq AS relation_seq, r.props AS relation
  FROM (SELECT * FROM msg WHERE kind IN ('view', 'click', 'purchase')) c ASOF JOIN (SELECT * FROM msg WHERE kind = 'signup') r ON c.relation_id = r.relation_id AND c.seq >= r.seq""")
def relation_asof(spark: SparkSession, d: str) -> DataFrame:
    log = messages(spark, d)
    relations = log.where("kind = 'signup'").select("source_id", "relation_id", "seq", F.struct(F.col("seq").alias("seq"), "props").alias("relation"))
    found = E.relation_asof(log.where("kind IN ('view', 'click', 'purchase')").select("source_id", "relation_id", "seq", "kind"), relations, strict=False)
    return found.select("seq", "relation_id", "kind", F.col("relation.seq").alias("relation_seq"), F.col("relation.props").alias("relation"))


@query(f"""WITH {SQL_L}, log AS (SELECT source_id, base AS seq, 'B' AS kind, xid, commit_ts FROM txn UNION ALL SELECT source_id, lsn_num, kind, NULL, NULL FROM chg),
  f AS (SELECT *, last_value(xid IGNORE NULLS) OVER w AS txn_xid, last_value(commit_ts IGNORE NULLS) OVER w AS txn_commit FROM log WINDOW w AS (PARTITION BY source_id ORDER BY seq ROWS UNBOUNDED PRECEDING))
  SELECT source_id, seq, kind, txn_xid, txn_commit FROM f WHERE kind <> 'B'""")
def transaction_context(spark: SparkSession, d: str) -> DataFrame:
    begins = transactions(spark, d).select("source_id", F.col("base").alias("seq"), F.lit("B").alias("kind"), "xid", "commit_ts")
    rows = changes(spark, d).select("source_id", F.col("lsn_num").alias("seq"), "kind", F.lit(None).cast("long").alias("xid"), F.lit(None).cast(begins.schema["commit_ts"].dataType).alias("commit_ts"))
    log = begins.unionByName(rows)
    # a range of positions holds a million seconds' worth of no one source's rows; positions are wide, so ranges are too
    filled = X.transaction_context(log, F.col("kind") == "B", F.struct("xid", "commit_ts"), width=1 << 47)
    return filled.where("kind <> 'B'").select("source_id", "seq", "kind", F.col("txn.xid").alias("txn_xid"), F.col("txn.commit_ts").alias("txn_commit"))


@query(f"""WITH {SQL_E}, f AS (SELECT *, last_value(CASE kind WHEN 'signup' THEN xid WHEN 'error' THEN -1 END IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS m FROM msg)
  SELECT source_id, seq, kind, coalesce(m >= 0, false) AS in_stream, CASE WHEN m >= 0 THEN m END AS stream_xid FROM f""")
def segment_membership(spark: SparkSession, d: str) -> DataFrame:
    found = X.segment_membership(messages(spark, d), F.col("kind") == "signup", F.col("kind") == "error", F.col("xid"))
    return found.select("source_id", "seq", "kind", "in_stream", "stream_xid")


@query(f"""WITH {SQL_E}, i AS (SELECT *, count(*) FILTER (kind = 'signup') OVER (PARTITION BY source_id, xid ORDER BY seq ROWS UNBOUNDED PRECEDING) AS incarnation FROM msg),
  n AS (SELECT *, first_value(CASE kind WHEN 'purchase' THEN seq WHEN 'error' THEN -seq - 1 END IGNORE NULLS) OVER (PARTITION BY source_id, xid, incarnation ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS e FROM i)
  SELECT source_id, xid, incarnation, seq, kind, e AS commit_seq FROM n WHERE kind IN ('view', 'click') AND e >= 0""")
def committed_only(spark: SparkSession, d: str) -> DataFrame:
    log = X.incarnations(messages(spark, d), F.col("kind") == "signup")
    kept = X.committed_only(log, F.col("kind").isin("view", "click"), F.col("kind") == "purchase", F.col("kind") == "error")
    return kept.select("source_id", "xid", "incarnation", "seq", "kind", "commit_seq")


@query(f"""WITH {SQL_E}, s AS (SELECT source_id, seq, xid % 97 AS top, xid AS sub, kind FROM msg), a AS (SELECT source_id, top, max(seq) AS at, arg_max(sub, seq) AS sub FROM s WHERE kind = 'error' GROUP BY source_id, top),
  r AS (SELECT a.source_id, a.top, min(s.seq) AS from_seq, a.at AS to_seq FROM a JOIN s ON s.source_id = a.source_id AND s.top = a.top AND s.sub = a.sub AND s.kind <> 'error' AND s.seq < a.at GROUP BY a.source_id, a.top, a.at)
  SELECT s.source_id, s.seq, s.top AS xid, s.sub AS sub_xid FROM s LEFT JOIN r ON s.source_id = r.source_id AND s.top = r.top AND s.seq BETWEEN r.from_seq AND r.to_seq WHERE s.kind <> 'error' AND r.top IS NULL""")
def subxact_abort(spark: SparkSession, d: str) -> DataFrame:
    """Eight sources use the same 97 transaction ids; each has its own aborts."""
    log = messages(spark, d).select("source_id", "seq", (F.col("xid") % 97).alias("xid"), F.col("xid").alias("sub_xid"), "kind")
    last = log.where("kind = 'error'").groupBy("source_id", "xid").agg(F.max("seq").alias("seq")).withColumn("is_abort", F.lit(True))
    rows = log.where("kind <> 'error'")
    marked = rows.select("source_id", "xid", "sub_xid", "seq").withColumn("is_abort", F.lit(False)).unionByName(log.join(last, ["source_id", "xid", "seq"]).select("source_id", "xid", "sub_xid", "seq", "is_abort"))
    return X.without_aborted(rows, X.aborted_ranges(marked)).select("source_id", "seq", "xid", "sub_xid")


@query(f"""WITH {SQL_L} SELECT source_id, xid, lsn_num, row_number() OVER (PARTITION BY source_id ORDER BY commit_lsn, xid, ord) AS replay_pos FROM chg""")
def replay_order(spark: SparkSession, d: str) -> DataFrame:
    return X.replay_position(changes(spark, d)).select("source_id", "xid", "lsn_num", "replay_pos")


def _per_transaction(spark: SparkSession, d: str) -> DataFrame:
    """A change has its order's key, so changes are counted by it before they meet their transactions."""
    counts = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_events"))
    return transactions(spark, d).join(counts, "o_orderkey", "left").select("source_id", (F.col("base") + 63).alias("commit_lsn"), "xid", F.coalesce("n_events", F.lit(0)).alias("n_events"), (seconds_of(F.col("commit_ts")) * 1000000).alias("clock_micros"))


CUT = """WITH RECURSIVE {feed}, n AS (SELECT t.source_id, t.base + 63 AS commit_lsn, t.xid, count(c.xid) AS n_events, epoch_us(any_value(t.commit_ts)) AS clock, row_number() OVER (PARTITION BY t.source_id ORDER BY t.base, t.xid) AS i
    FROM txn t LEFT JOIN chg c ON c.xid = t.xid GROUP BY t.source_id, t.base, t.xid),
  w AS (SELECT source_id, i, 0::BIGINT AS batch_id, n_events AS run, CASE WHEN n_events > 0 THEN clock END AS began, clock FROM n WHERE i = 1
    UNION ALL SELECT n.source_id, n.i, CASE WHEN {full} THEN w.batch_id + 1 ELSE w.batch_id END, CASE WHEN {full} THEN 0 ELSE w.run END + n.n_events,
      CASE WHEN {full} OR w.began IS NULL THEN CASE WHEN n.n_events > 0 THEN n.clock END ELSE w.began END, n.clock
    FROM w JOIN n ON n.source_id = w.source_id AND n.i = w.i + 1),
  b AS (SELECT n.*, w.batch_id FROM n JOIN w USING (source_id, i))
  SELECT source_id, batch_id, count(*) AS n_transactions, sum(n_events)::BIGINT AS n_events, max(commit_lsn) AS end_lsn, arg_max(xid, commit_lsn) AS last_xid FROM b GROUP BY source_id, batch_id"""


@query(CUT.format(feed=SQL_L, full="w.run >= 100"))
def batch_cut_max_events(spark: SparkSession, d: str) -> DataFrame:
    return B.batch_totals(B.cut_batches(_per_transaction(spark, d), 100))


@query(CUT.format(feed=SQL_L, full="w.run >= 1"))
def batch_cut_one_txn(spark: SparkSession, d: str) -> DataFrame:
    return B.batch_totals(B.cut_batches(_per_transaction(spark, d), 1))


@query(CUT.format(feed=SQL_L, full="w.run > 0 AND (w.run >= 100 OR w.clock >= w.began + 864000000000)"))
def batch_cut_deadline(spark: SparkSession, d: str) -> DataFrame:
    return B.batch_totals(B.cut_batches(_per_transaction(spark, d), 100, 10 * 86400 * 1000000))


@query(f"""WITH {SQL_E}, v AS (SELECT source_id, seq, relation_id % 5 AS relation_id, floor(value)::BIGINT % 2 AS v FROM msg WHERE kind = 'signup'),
  c AS (SELECT *, lag(v) OVER w AS p, row_number() OVER w AS i FROM v WINDOW w AS (PARTITION BY source_id, relation_id ORDER BY seq))
  SELECT source_id, seq, relation_id, sum(CASE WHEN i = 1 OR v IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY source_id, relation_id ORDER BY seq)::BIGINT AS schema_version FROM c""")
def schema_version_islands(spark: SparkSession, d: str) -> DataFrame:
    """Eight sources define the same five tables."""
    defined = messages(spark, d).where("kind = 'signup'").select("source_id", "seq", (F.col("relation_id") % 5).alias("relation_id"), "value")
    return B.schema_islands(defined, F.floor("value") % 2).select("source_id", "seq", "relation_id", "schema_version")


@query(f"""WITH {SQL_L}, r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY commit_lsn, xid, ord) AS replay_pos FROM chg),
  b AS (SELECT *, source_id || '-' || ((replay_pos - 1) // 500) AS batch_id, CASE WHEN l_linenumber > 4 THEN 2 ELSE 1 END AS schema_version FROM r),
  f AS (SELECT batch_id, schema, "table", schema_version, count(*) AS event_count, arg_max(lsn_num, replay_pos) AS lsn_num, arg_max(xid, replay_pos) AS xid, min(replay_pos) AS first_pos FROM b GROUP BY ALL),
  c AS (SELECT *, lead(first_pos) OVER (PARTITION BY batch_id, schema, "table" ORDER BY first_pos) AS closed FROM f)
  SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY closed IS NULL, coalesce(closed, first_pos)) - 1 AS file_ord, schema, "table", schema_version, event_count, event_count AS record_count, {LSN} AS lsn, xid FROM c""")
def file_manifest(spark: SparkSession, d: str) -> DataFrame:
    placed = X.replay_position(changes(spark, d)).withColumn("batch_id", F.concat_ws("-", "source_id", F.floor((F.col("replay_pos") - 1) / 500)))
    return B.manifest(placed.withColumn("schema_version", F.when(F.col("l_linenumber") > 4, 2).otherwise(1)).withColumn("lsn", L.lsn_format(F.col("lsn_num"))))


@query(f"""WITH {SQL_L}, r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY commit_lsn, xid, ord) AS replay_pos FROM chg),
  b AS (SELECT *, source_id || '-' || ((replay_pos - 1) // 500) AS batch_id, CASE WHEN l_linenumber > 4 THEN 2 ELSE 1 END AS schema_version FROM r),
  f AS (SELECT batch_id, schema, "table", schema_version, count(*) AS event_count, arg_max(lsn_num, replay_pos) AS lsn_num, arg_max(xid, replay_pos) AS xid, min(replay_pos) * 2 AS first_pos FROM b GROUP BY ALL),
  d AS (SELECT batch_id, schema, "table", 3 AS schema_version, min(replay_pos) * 2 - 1 AS opened FROM b WHERE l_linenumber = 7 GROUP BY ALL),
  o AS (SELECT batch_id, schema, "table", schema_version, first_pos AS opened FROM f UNION ALL SELECT * FROM d),
  c AS (SELECT o.*, lead(opened) OVER (PARTITION BY batch_id, schema, "table" ORDER BY opened) AS closed FROM o)
  SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY closed IS NULL, coalesce(closed, first_pos)) - 1 AS file_ord, schema, "table", schema_version, event_count, event_count AS record_count, {LSN} AS lsn, xid
  FROM c JOIN f USING (batch_id, schema, "table", schema_version)""")
def file_manifest_by_definition(spark: SparkSession, d: str) -> DataFrame:
    """Each table is defined anew right before the first seventh line of a batch; no row has that version, but it closes the files that are open."""
    placed = X.replay_position(changes(spark, d)).withColumn("batch_id", F.concat_ws("-", "source_id", F.floor((F.col("replay_pos") - 1) / 500))).withColumn("replay_pos", F.col("replay_pos") * 2)
    made = placed.where("l_linenumber = 7").select("batch_id", "schema", "table", F.lit(3).alias("schema_version"), (F.col("replay_pos") - 1).alias("replay_pos"))
    return B.manifest(placed.withColumn("schema_version", F.when(F.col("l_linenumber") > 4, 2).otherwise(1)).withColumn("lsn", L.lsn_format(F.col("lsn_num"))), made)


@query(f"""WITH {SQL_L}, t AS (SELECT xid, base AS lsn_num, [o_custkey % 5, o_custkey % 7 + 5, 12] AS ids FROM txn), x AS (SELECT xid, lsn_num, unnest(ids) AS relation_id, generate_subscripts(ids, 1) - 1 AS ord FROM t)
  SELECT xid, {LSN} AS lsn, ord, relation_id FROM x WHERE regexp_full_match('table' || relation_id, 'table[0-9]')""")
def truncate_fanout(spark: SparkSession, d: str) -> DataFrame:
    t = transactions(spark, d).select("xid", F.col("base").alias("lsn_num"), F.array(F.col("o_custkey") % 5, F.col("o_custkey") % 7 + 5, F.lit(12).cast("long")).alias("relation_ids"))
    return E.truncate_fanout(t).where(E.full_match(F.concat(F.lit("table"), F.col("relation_id").cast("string")), "table[0-9]")).select("xid", L.lsn_format(F.col("lsn_num")).alias("lsn"), "ord", "relation_id")


@query(f"""WITH {SQL_L} SELECT source_id, count(*) AS n_messages, sum(12 + length(after))::BIGINT AS spool_bytes, count(DISTINCT xid) AS in_progress, sum(12 + length(after)) > 1000000 AS over_limit FROM chg GROUP BY source_id""")
def spool_stats(spark: SparkSession, d: str) -> DataFrame:
    """A message takes its bytes and a header of 12. Distinct xids are counted over one row per transaction."""
    per_txn = changes(spark, d).groupBy("source_id", "xid").agg(F.count("*").alias("n"), F.sum(12 + F.octet_length("after")).alias("bytes"))
    return per_txn.groupBy("source_id").agg(F.sum("n").alias("n_messages"), F.sum("bytes").alias("spool_bytes"), F.count("*").alias("in_progress")).withColumn("over_limit", F.col("spool_bytes") > 1000000)


@query(f"""WITH {SQL_L} SELECT source_id, max(base + 63) - min(base) AS retained_bytes, ((max(base + 63) - min(base)) // 1048576)::BIGINT AS retained_mb, (max(base + 63) - min(base)) > 1000000000 AS warn FROM txn GROUP BY source_id""")
def wal_retention(spark: SparkSession, d: str) -> DataFrame:
    per = transactions(spark, d).groupBy("source_id").agg(F.max(F.col("base") + 63).alias("now"), F.min("base").alias("kept"))
    retained = L.lsn_diff(F.col("now"), F.col("kept"))
    return per.select("source_id", retained.alias("retained_bytes"), L.whole_mb(retained).alias("retained_mb"), (retained > 1000000000).alias("warn"))


@query(f"""WITH {SQL_L} SELECT {LSN} AS lsn, xid, dense_rank() OVER (PARTITION BY source_id ORDER BY lsn_num) AS place FROM chg""")
def events_by_lsn(spark: SparkSession, d: str) -> DataFrame:
    """In the order of positions as numbers, not as text; equal positions share a place."""
    placed = X.replay_position(changes(spark, d).withColumn("commit_lsn", F.col("lsn_num")).withColumn("ord", F.row_number().over(Window.partitionBy("source_id", "lsn_num", "xid").orderBy("xid")).cast("long")))
    return placed.orderBy("lsn_num").select(L.lsn_format(F.col("lsn_num")).alias("lsn"), "xid", F.col("replay_pos").alias("place"))


@query(f"""WITH {SQL_E} SELECT source_id, count(*) AS n, max(seq) AS received, max(CASE WHEN kind = 'purchase' THEN seq END) AS last_commit, greatest(max(seq), max(CASE WHEN kind = 'purchase' THEN seq END)) AS confirmed FROM msg GROUP BY source_id""")
def idle_progress(spark: SparkSession, d: str) -> DataFrame:
    """The position to confirm when nothing is pending: the larger of the last commit and the last message received."""
    per = messages(spark, d).groupBy("source_id").agg(F.count("*").alias("n"), F.max("seq").alias("received"), F.max(F.when(F.col("kind") == "purchase", F.col("seq"))).alias("last_commit"))
    return per.withColumn("confirmed", F.greatest("received", "last_commit"))
