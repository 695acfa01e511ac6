"""Transactions from a log of messages: context, streamed segments, commits and aborts, replay order.

A log has source_id, seq (its total order within the source) and kind. xid incarnations: a first segment of a known xid starts it anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.operators.ordered import RANGE, forward_fill, running_count


def transaction_context(log: DataFrame, begin: Column, payload: Column, commit: Column | None = None, width: int = RANGE) -> DataFrame:
    """log with ``txn``, the payload of the latest begin at or before each row; null outside, where ``commit`` rows end it."""
    placed = log.withColumn("_at", F.col("seq") * 2).withColumn("_m", F.when(begin, F.struct(payload.alias("txn"))))
    if commit is not None:
        # what ends a transaction takes effect right after its row: a mark of its own between that row and the next
        none = F.struct(F.lit(None).cast(placed.schema["_m"].dataType["txn"].dataType).alias("txn"))
        ends = log.where(commit).select("source_id", (F.col("seq") * 2 + 1).alias("_at"), none.alias("_m"))
        placed = placed.unionByName(ends, allowMissingColumns=True)
    filled = forward_fill(placed, ["source_id"], "_at", F.col("_m"), "_t", width).where(F.col("_at") % 2 == 0)
    return filled.withColumn("txn", F.col("_t.txn")).drop("_t", "_m", "_at")


def segment_membership(log: DataFrame, start: Column, stop: Column, xid: Column) -> DataFrame:
    """log with in_stream and stream_xid: whether a row lies between a segment's start and stop, and whose segment it is."""
    marker = F.when(start, F.struct(F.lit(True).alias("on"), xid.alias("xid"))).when(stop, F.struct(F.lit(False).alias("on"), F.lit(None).cast("long").alias("xid")))
    filled = forward_fill(log, ["source_id"], "seq", marker, "_s")
    return filled.withColumn("in_stream", F.coalesce(F.col("_s.on"), F.lit(False))).withColumn("stream_xid", F.col("_s.xid")).drop("_s")


def incarnations(log: DataFrame, first: Column) -> DataFrame:
    """log (with xid) and ``incarnation``: how many first segments its xid has had so far."""
    return running_count(log, ["source_id", "xid"], "seq", first, "incarnation")


def committed_only(log: DataFrame, change: Column, commit: Column, abort: Column) -> DataFrame:
    """The changes whose next commit or abort, in their incarnation of the xid, is a commit; with ``commit_seq``.

    log: source_id, xid, incarnation, seq. Ends are numbered within a transaction, and a change meets the one after those that it has behind it; counting goes by ranges, so no transaction is one task.
    """
    of = ["source_id", "xid", "incarnation"]
    ends = log.where(commit | abort).select(*of, F.col("seq").alias("_at"), commit.alias("_ok"))
    ends = ends.withColumn("_n", F.row_number().over(Window.partitionBy(*of).orderBy("_at")) - 1)  # one narrow row an end
    behind = running_count(log.where(change | commit | abort), of, "seq", commit | abort, "_n").where(change)
    return behind.join(ends.where("_ok"), [*of, "_n"]).withColumn("commit_seq", F.col("_at")).drop("_n", "_at", "_ok")


def aborted_ranges(log: DataFrame) -> DataFrame:
    """source_id, xid, incarnation (where log has it), from_seq, to_seq: stretches of a streamed transaction that aborts of subtransactions undo.

    log: source_id, xid, sub_xid, seq, is_abort. An abort of a subtransaction drops everything of its xid from that subtransaction's first message that still stands, and forgets the
    subtransactions that began there or later. Between two aborts only each subtransaction's first message matters, so messages are reduced to those; a pass in order over what is left
    keeps one number per subtransaction that stands.
    """
    of = ["source_id", "xid", *(["incarnation"] if "incarnation" in log.columns else [])]
    numbered = running_count(log.select(*of, "sub_xid", "seq", "is_abort"), of, "seq", F.col("is_abort"), "_n")
    firsts = numbered.where("NOT is_abort").groupBy(*of, "sub_xid", "_n").agg(F.min("seq").alias("seq")).withColumn("is_abort", F.lit(False)).drop("_n")
    narrow = firsts.unionByName(numbered.where("is_abort").drop("_n")).select(*of, "sub_xid", "seq", "is_abort")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whose, first = None, {}
        for batch in batches:
            out = []
            for *key, sub, seq, is_abort in batch.itertuples(index=False):
                if key != whose:
                    whose, first = key, {}
                if not is_abort:
                    first.setdefault(sub, seq)
                elif sub in first:
                    mark = first[sub]
                    out.append((*key, mark, seq))
                    first = {s: at for s, at in first.items() if at < mark}
            yield pd.DataFrame(out, columns=[*of, "from_seq", "to_seq"])

    types = ", ".join(f"{c} {narrow.schema[c].dataType.simpleString()}" for c in of)
    return narrow.repartition(*of).sortWithinPartitions(*of, "seq").mapInPandas(fold, f"{types}, from_seq long, to_seq long")


def without_aborted(changes: DataFrame, ranges: DataFrame, width: int = RANGE) -> DataFrame:
    """changes (source_id, xid, seq, ...) outside all aborted ranges of their xid, in the same source and incarnation.

    Ranges are listed in all stretches of ``width`` of the log that they reach into, so a transaction with a third of all changes is as many keys as it has stretches.
    """
    of = [c for c in ranges.columns if c not in ("from_seq", "to_seq")]
    cell = lambda seq: F.floor(seq / width)
    listed = ranges.select("*", F.explode(F.sequence(cell(F.col("from_seq")), cell(F.col("to_seq")))).alias("_cell")).alias("r")
    inside = (F.col("c.seq") >= F.col("r.from_seq")) & (F.col("c.seq") <= F.col("r.to_seq")) & (cell(F.col("c.seq")) == F.col("r._cell"))
    for c in of:
        inside = inside & (F.col(f"c.{c}") == F.col(f"r.{c}"))
    return changes.alias("c").join(listed, inside, "left_anti")


def replay_position(changes: DataFrame) -> DataFrame:
    """changes (source_id, commit_lsn, xid, ord: from 1 within the transaction) with replay_pos: all in commit order, from 1.

    The numbers of earlier transactions' rows are summed over one row per transaction.
    """
    per_txn = changes.groupBy("source_id", "commit_lsn", "xid").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_id").orderBy("commit_lsn", "xid").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_txn.withColumn("_start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    return changes.join(starts, ["source_id", "commit_lsn", "xid"]).withColumn("replay_pos", F.col("_start") + F.col("ord")).drop("_start")
