"""A source of raw messages whose tasks read the slots' logs themselves: a partition is a slot and a range of its log.

The driver holds positions only. A range begins and ends where no transaction and no segment is open, so each task can tell by itself which transaction a message belongs to, and lands it with
that transaction's id (``txn``) and, inside a segment, with its subtransaction's (``sub``), whose four bytes in front of the message are taken off. Nothing is put in order or held back here: transactions
that go on over several ranges are assembled in Spark's state (streaming/assembly.py).

A client (option client: "module:factory", importable where Spark's Python processes run; the factory gets the options) has, for a slot,
  upto(slot, after, most): the furthest position at most ``most`` messages after ``after`` at which nothing is open; else, behind a longer transaction, the first one; ``after`` itself if there is none yet;
  cuts(slot, start, end, parts): positions in between at which nothing is open, rising, fewer than ``parts``;
  read(slot, start, end): (position, lsn, message) of the positions in (start, end], in order;
  confirm(slot, position): everything up to it has been stored.
A log that is a list of messages gets the first two from `safe_positions`.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from changeloom.operators.decode import TRANSACTIONAL, ProtocolError
from changeloom.sources.capture import client_of

LANDED = "source_id string, seq long, recv_lsn long, txn long, sub long, data binary"


class Place:
    """What is open after some messages of a log: a transaction, a segment, or nothing (None)."""

    def __init__(self):
        self.txn: int | None = None
        self.segment = False

    def take(self, data: bytes) -> tuple[int | None, int | None, bytes]:
        """One message -> the transaction that it belongs to, the subtransaction, and its bytes as in any transaction. Raises where the protocol doesn't allow it."""
        kind = data[:1].decode("latin-1")
        number = lambda at: _number(data, at)
        if self.segment:
            if kind == "E":
                found, self.txn, self.segment = self.txn, None, False
                return found, None, data
            if kind == "O":
                return self.txn, None, data
            if kind not in TRANSACTIONAL:
                raise ProtocolError(f"a message of kind {kind} inside a segment")
            return self.txn, number(1), data[:1] + data[5:]
        if kind in "BScE" and self.txn is not None:
            raise ProtocolError(f"a message of kind {kind} inside a transaction")
        if kind == "B":
            self.txn = number(17)
        elif kind == "S":
            self.txn, self.segment = number(1), True
        elif kind == "E":
            raise ProtocolError("a segment stops outside one")
        elif kind in "cA":
            return number(1), number(5) if kind == "A" else None, data
        elif self.txn is None and kind not in "RYO":
            raise ProtocolError(f"a message of kind {kind} outside a transaction")
        found = self.txn
        if kind == "C":
            self.txn = None
        return found, None, data

    @property
    def open(self) -> bool:
        return self.txn is not None


def _number(data: bytes, at: int) -> int:
    if len(data) < at + 4:
        raise ProtocolError("the message ends too early")
    return struct.unpack_from(">I", data, at)[0]


def safe_positions(messages: Iterable[tuple[int, bytes]]) -> Iterator[int]:
    """Positions of (position, message) after which nothing is open."""
    place = Place()
    for position, data in messages:
        place.take(data)
        if not place.open:
            yield position


@dataclass
class Range(InputPartition):
    """(start, end] of a slot's log."""

    slot: str
    start: int
    end: int


class LandingSource(DataSource):
    """spark.readStream.format("pg_landing").options(client=..., slots="a,b"): LANDED.

    Options: client; slots; max_messages, of a slot in a batch (100000); parts, the most ranges of a slot in a batch (1); start, a JSON object of slots and positions to begin after ({}).
    """

    @classmethod
    def name(cls) -> str:
        return "pg_landing"

    def schema(self) -> str:
        return LANDED

    def streamReader(self, schema) -> "LandingReader":
        return LandingReader(self.options)


class LandingReader(DataSourceStreamReader):
    def __init__(self, options):
        self.options = dict(options)
        self.slots = [s.strip() for s in self.options["slots"].split(",") if s.strip()]
        self.most, self.parts = int(self.options.get("max_messages", 100_000)), int(self.options.get("parts", 1))
        if not self.slots or self.most < 1 or self.parts < 1:
            raise ValueError("slots: one at least; max_messages, parts: at least 1")
        self.reached: dict[str, int] = {}

    def initialOffset(self) -> dict:
        begin = json.loads(self.options.get("start", "{}"))
        return {slot: int(begin.get(slot, 0)) for slot in self.slots}

    def latestOffset(self) -> dict:
        """Each slot goes on from where its last batch ended; after a restart that is what was confirmed, until Spark has asked for the batch of its checkpoint again."""
        client = client_of(self.options)
        at = self.initialOffset() | self.reached
        self.reached = {slot: client.upto(slot, at[slot], self.most) for slot in self.slots}
        return dict(self.reached)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        client, out = client_of(self.options), []
        for slot in self.slots:
            a, b = int(start.get(slot, 0)), int(end.get(slot, 0))
            self.reached[slot] = max(self.reached.get(slot, 0), b)
            if a < b:
                ends = [a, *(client.cuts(slot, a, b, self.parts) if self.parts > 1 else []), b]
                out += [Range(slot, x, y) for x, y in zip(ends, ends[1:])]
        return out

    def read(self, part: Range) -> Iterator[tuple]:
        place = Place()
        for position, lsn, data in client_of(self.options).read(part.slot, part.start, part.end):
            try:
                txn, sub, message = place.take(data)
            except ProtocolError as e:
                raise ProtocolError(f"{part.slot}, message {position}: {e}") from e
            yield part.slot, position, lsn, txn, sub, message
        if place.open:
            raise ProtocolError(f"{part.slot}: the range up to {part.end} ends inside a transaction")

    def commit(self, end: dict) -> None:
        client = client_of(self.options)
        for slot, position in end.items():
            client.confirm(slot, int(position))
