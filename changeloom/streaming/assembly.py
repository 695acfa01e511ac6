"""Whole transactions out of landed messages, with what is in progress in Spark's state.

Messages are grouped by source and transaction. Of a streamed transaction the state store has the messages so far (a list, in the order of the log), each subtransaction's first message that still stands (a map), the
stretches that aborts of subtransactions have cut off (a list), and the bytes held; so it goes on over any number of batches, moves with Spark's checkpoint, and lives in RocksDB rather than in a process. A first
segment begins a transaction anew, an abort of the transaction forgets it, a commit hands it over: its messages come out in the form of the source that gives whole transactions (RAW), in the order of the log,
numbered in front of the commit, so that sorting by seq is the order of replay. Plain transactions lie within one range and pass through without touching the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from changeloom.operators.decode import ProtocolError
from changeloom.sources.capture import RAW

#: A transaction's messages are numbered commit * PLACES + place; so many rows of output at once.
PLACES, CHUNK = 1 << 31, 10_000
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Assembly(StatefulProcessor):
    def __init__(self, max_streamed_bytes: int = 1 << 30):
        self.limit = max_streamed_bytes

    def init(self, handle) -> None:
        self.messages = handle.getListState("messages", "seq long, recv_lsn long, data binary")
        self.firsts = handle.getMapState("firsts", "sub long", "seq long")
        self.cuts = handle.getListState("cuts", "low long, high long")
        self.size = handle.getValueState("size", "bytes long")

    def close(self) -> None:
        pass

    def _forget(self) -> None:
        for state in (self.messages, self.firsts, self.cuts, self.size):
            state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        source, txn = key
        batch = pd.concat(list(rows)).sort_values("seq")  # a batch's part of one transaction
        pending: list[tuple] = []  # not in the state yet
        plain: list[tuple] = []  # of a transaction without segments
        for seq, lsn, sub, data in batch[["seq", "recv_lsn", "sub", "data"]].itertuples(index=False):
            data = bytes(data)
            kind = data[:1]
            if kind == b"S":
                if data[5:6] != b"\0":
                    self._forget()
                    pending = []
                    self.size.update((0,))
                elif not self.size.exists():
                    raise ProtocolError(f"{source}, message {seq}: the first segment of transaction {txn} is missing")
            elif kind in (b"E", b"O"):
                continue
            elif kind == b"A":
                if not self.size.exists():
                    continue  # aborted before anything of it was sent
                if sub == txn:
                    self._forget()
                    pending = []
                else:
                    self._cut(int(sub), seq)
            elif kind == b"c":
                if not self.size.exists():
                    raise ProtocolError(f"{source}, message {seq}: transaction {txn} commits, but it isn't known")
                yield from self._handed_over(source, seq, self._standing(pending), (lsn, data))
                self._forget()
                pending = []
            elif pd.isna(sub):
                plain.append((lsn, data))
                if kind == b"C" or pd.isna(txn):
                    yield from self._handed_over(source, seq, iter(plain[:-1]), plain[-1])
                    plain = []
            else:
                if not self.firsts.containsKey((int(sub),)):
                    self.firsts.updateValue((int(sub),), (seq,))
                held = self.size.get()[0] + len(data)
                if held > self.limit:
                    raise ValueError(f"{source}, message {seq}: a streamed transaction is larger than max_streamed_bytes")
                self.size.update((held,))
                pending.append((seq, lsn, data))
        if pending:
            self.messages.appendList(pending)

    def _cut(self, sub: int, seq: int) -> None:
        """All from the subtransaction's first message on goes, with the subtransactions that began there or later."""
        if not self.firsts.containsKey((sub,)):
            return
        low = self.firsts.getValue((sub,))[0]
        self.cuts.appendValue((low, seq))
        for (other,), (first,) in list(self.firsts.iterator()):
            if first >= low:
                self.firsts.removeKey((other,))

    def _standing(self, pending: list[tuple]) -> Iterator[tuple]:
        cuts = sorted(tuple(c) for c in self.cuts.get()) if self.cuts.exists() else []
        held = self.messages.get() if self.messages.exists() else iter(())
        for seq, lsn, data in (x for part in (held, pending) for x in part):
            if not any(low <= seq <= high for low, high in cuts):
                yield lsn, bytes(data)

    def _handed_over(self, source: str, end: int, messages: Iterator[tuple], last: tuple) -> Iterator[pd.DataFrame]:
        out, place = [], 0
        for lsn, data in messages:
            out.append((source, (end - 1) * PLACES + place, lsn, data))
            place += 1
            if len(out) == CHUNK:
                yield pd.DataFrame(out, columns=["source_id", "seq", "recv_lsn", "data"])
                out = []
        out.append((source, end * PLACES - 1, *last))
        yield pd.DataFrame(out, columns=["source_id", "seq", "recv_lsn", "data"])


def assembled(landed: DataFrame, max_streamed_bytes: int = 1 << 30) -> DataFrame:
    """A stream of landed messages (sources/landing.py) -> RAW messages of whole transactions, those of a batch being the ones that end in it. The session's state store must be RocksDB (STORE)."""
    return landed.groupBy("source_id", F.col("txn")).transformWithStateInPandas(Assembly(max_streamed_bytes), outputStructType=RAW, outputMode="Append", timeMode="None")
