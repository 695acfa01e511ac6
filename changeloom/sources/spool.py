"""Streamed transactions in progress: what they have sent is kept on disk until they commit, subtransactions that abort are cut off."""

from __future__ import annotations

import struct
import tempfile
from collections.abc import Iterator

HEADER = 12  # position and length in front of each message


class Spool:
    """One transaction's messages in a nameless file of a folder, which the process that reads the stream has to itself; a lost process starts again at a confirmed position, with new files."""

    def __init__(self, limit: int, folder: str | None = None):
        self.file, self.limit = tempfile.TemporaryFile(dir=folder), limit
        self.size, self.messages = 0, 0
        #: Where each subtransaction's first message that still stands begins, and how many messages come before it.
        self.marks: dict[int, tuple[int, int]] = {}

    def append(self, xid: int, lsn: int, data: bytes) -> None:
        if self.size + HEADER + len(data) > self.limit:
            raise ValueError("a streamed transaction is larger than max_streamed_bytes")
        self.marks.setdefault(xid, (self.size, self.messages))
        self.file.seek(self.size)
        self.file.write(struct.pack(">qI", lsn, len(data)) + data)
        self.size, self.messages = self.size + HEADER + len(data), self.messages + 1

    def cut(self, xid: int) -> None:
        if xid in self.marks:
            self.size, self.messages = self.marks[xid]
            self.file.truncate(self.size)
            self.marks = {x: m for x, m in self.marks.items() if m[0] < self.size}

    def read(self):
        self.file.seek(0)
        at = 0
        while at < self.size:
            lsn, n = struct.unpack(">qI", self.file.read(HEADER))
            yield lsn, self.file.read(n)
            at += HEADER + n


class Spools:
    """By the id of the top transaction."""

    def __init__(self, limit: int = 1 << 30, folder: str | None = None):
        self.limit, self.folder, self.of = limit, folder, {}

    def __len__(self) -> int:
        return len(self.of)

    def start(self, xid: int, first: bool) -> None:
        if first:
            self.of[xid] = Spool(self.limit, self.folder)  # one that is known already is begun anew
        elif xid not in self.of:
            raise ValueError(f"the first segment of transaction {xid} is missing")

    def append(self, xid: int, sub: int, lsn: int, data: bytes) -> None:
        self.of[xid].append(sub, lsn, data)

    def commit(self, xid: int) -> Iterator[tuple[int, bytes]]:
        """The transaction's messages, read from its file as they are asked for."""
        if xid not in self.of:
            raise ValueError(f"transaction {xid} commits, but it isn't known")
        return self.of.pop(xid).read()

    def abort(self, xid: int, sub: int) -> None:
        if xid == sub:
            self.of.pop(xid, None)
        elif xid in self.of:
            self.of[xid].cut(sub)

    @property
    def bytes(self) -> int:
        return sum(s.size for s in self.of.values())
