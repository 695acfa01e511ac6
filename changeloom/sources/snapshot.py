"""The initial snapshot as batches of raw messages: a table's rows as of the slot's consistent point, kind s, between a begin and a commit of transaction 0.

Rows come as text through the client: query(sql) answers from the catalog, rows(query, snapshot, fetch_size) iterates over a query's rows in the exported snapshot.

The live source reads tables one after the other (`Snapshot`). SnapshotSource reads them in many tasks: a task is a table's range of pages, on a connection of its own that takes over the same exported
snapshot, so all tasks see the tables as of one point. Whoever exported the snapshot must keep that connection open until the tasks have begun.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from changeloom.sources.catalog import snapshot_query
from changeloom.sources.control import Options, literal


@dataclass(frozen=True)
class Table:
    """columns: name, whether key, type's number, its modifier."""

    relation_id: int
    schema: str
    name: str
    identity: str
    columns: tuple[tuple[str, bool, int, int], ...]
    row_filter: str | None = None


#: Column lists and row filters of publications came with this version.
LISTS = 150000


def published(client, publication: str) -> list[Table]:
    """Tables of the publication by schema and name, with the columns that it publishes, in their order: the listed ones or, without a list, all that aren't generated."""
    version = int(client.query("SHOW server_version_num")[0][0])
    listed = "CASE WHEN t.attnames IS NULL THEN a.attgenerated = '' ELSE a.attname = ANY (t.attnames) END" if version >= LISTS else "a.attgenerated = ''"
    found: dict[int, list] = {}
    rows = client.query(
        f"SELECT c.oid, t.schemaname, t.tablename, c.relreplident, {'t.rowfilter' if version >= LISTS else 'NULL'}, a.attname, a.atttypid, a.atttypmod,"
        " c.relreplident = 'f' OR EXISTS (SELECT 1 FROM pg_index i WHERE i.indrelid = c.oid AND a.attnum = ANY (i.indkey)"
        " AND (c.relreplident = 'd' AND i.indisprimary OR c.relreplident = 'i' AND i.indisreplident))"
        " FROM pg_publication_tables t JOIN pg_namespace n ON n.nspname = t.schemaname JOIN pg_class c ON c.relnamespace = n.oid AND c.relname = t.tablename"
        f" JOIN pg_attribute a ON a.attrelid = c.oid AND a.attnum > 0 AND NOT a.attisdropped AND {listed}"
        f" WHERE t.pubname = {literal(publication)} ORDER BY t.schemaname, t.tablename, a.attnum"
    )
    for oid, schema, name, identity, row_filter, column, type_oid, typmod, key in rows:
        found.setdefault(oid, [schema, name, identity, row_filter, []])[-1].append((column, bool(key), int(type_oid), int(typmod)))
    return [Table(oid, schema, name, identity, tuple(columns), row_filter) for oid, (schema, name, identity, row_filter, columns) in found.items()]


def _string(text: str) -> bytes:
    return text.encode() + b"\0"


def _relation(t: Table) -> bytes:
    columns = b"".join(struct.pack(">B", key) + _string(name) + struct.pack(">Ii", oid, typmod) for name, key, oid, typmod in t.columns)
    return b"R" + struct.pack(">I", t.relation_id) + _string(t.schema) + _string(t.name) + t.identity.encode() + struct.pack(">H", len(t.columns)) + columns


def _row(t: Table, values: list[str | None]) -> bytes:
    cells = b"".join(b"n" if v is None else b"t" + struct.pack(">i", len(raw := v.encode())) + raw for v in values)
    return b"s" + struct.pack(">I", t.relation_id) + b"N" + struct.pack(">H", len(values)) + cells


@dataclass
class Snapshot:
    """Batches of at most ``most`` rows, each of one table; tables without rows are passed over. ``rows`` and ``tables`` count what has been read."""

    client: object
    options: Options
    name: str
    point: int
    micros: int
    most: int
    rows: int = 0
    tables: int = 0
    left: list[Table] = field(init=False)
    current: tuple[Table, Iterator] | None = None

    def __post_init__(self):
        # tables that the patterns don't fit are never read
        self.left = [t for t in published(self.client, self.options.publication) if self.options.captures(t.schema, t.name)]

    def batch(self) -> tuple[list[bytes], bool]:
        """The next batch's messages, and whether it was the last. The last may be empty."""
        while self.current or self.left:
            if self.current is None:
                table = self.left.pop(0)
                query = snapshot_query(table.schema, table.name, [c[0] for c in table.columns], table.row_filter)
                self.current, self.tables = (table, iter(self.client.rows(query, self.name, self.options.snapshot_fetch_size))), self.tables + 1
            table, rows = self.current
            out: list[bytes] = []
            while len(out) < self.most and (row := next(rows, None)) is not None:
                out.append(_row(table, list(row)))
            self.rows += len(out)
            if len(out) == self.most:
                return self._framed(table, out), False  # there may be more; they go to the next batch
            self.current = None
            if out:
                return self._framed(table, out), not self.left
        return [], True

    def _framed(self, table: Table, rows: list[bytes]) -> list[bytes]:
        begin = b"B" + struct.pack(">qqI", self.point, self.micros, 0)
        return [begin, _relation(table), *rows, b"C\0" + struct.pack(">qqq", self.point, self.point, self.micros)]


#: A table's messages are numbered from its number * TABLE on, a range's from its number * PART on within the table.
TABLE, PART = 1 << 48, 1 << 32
RAW = "source_id string, seq long, recv_lsn long, data binary"


@dataclass
class Pages(InputPartition):
    """Pages from low up to, not including, high (None: to the end) of a table; the first range brings the begin and the definition, the last one the commit."""

    number: int
    table: Table
    part: int
    low: int
    high: int | None


class SnapshotSource(DataSource):
    """spark.read.format("pg_snapshot").options(client=..., publication=..., slot=..., snapshot=..., point=..., micros=...): RAW messages, a transaction a table, rows of kind s.

    Options: client ("module:factory", importable where Spark's Python runs), those of control.Options by name, snapshot (the exported snapshot's name), point (the position that it shows), micros (the commit time,
    microseconds since 2000; 0), pages (of a task; 16384, which is 128 MB).
    """

    @classmethod
    def name(cls) -> str:
        return "pg_snapshot"

    def schema(self) -> str:
        return RAW

    def reader(self, schema) -> "SnapshotReader":
        return SnapshotReader(self.options)


class SnapshotReader(DataSourceReader):
    def __init__(self, options):
        from changeloom.sources.capture import client_of

        self.client_of, self.given, self.options = client_of, dict(options), Options.of(options)
        self.name, self.point, self.micros, self.pages = self.given["snapshot"], int(self.given["point"]), int(self.given.get("micros", 0)), int(self.given.get("pages", 16384))
        if self.pages < 1:
            raise ValueError("pages: at least 1")

    def partitions(self) -> list[Pages]:
        """Ranges by the tables' sizes now; rows that come later than the snapshot aren't seen in it, and a table's last range has no end."""
        client, out = self.client_of(self.given), []
        tables = [t for t in published(client, self.options.publication) if self.options.captures(t.schema, t.name)]
        for number, table in enumerate(tables):
            size = int(client.query(f"SELECT pg_relation_size({table.relation_id}) / current_setting('block_size')::bigint")[0][0])
            lows = range(0, max(size, 1), self.pages)
            if len(lows) >= TABLE // PART:
                raise ValueError(f"{table.schema}.{table.name} has too many ranges of {self.pages} pages")
            out += [Pages(number, table, k, low, low + self.pages if k + 1 < len(lows) else None) for k, low in enumerate(lows)]
        return out

    def read(self, part: Pages) -> Iterator[tuple]:
        t, first = part.table, part.number * TABLE
        bounds = [f"ctid >= '({part.low},0)'::tid"] * (part.low > 0) + [f"ctid < '({part.high},0)'::tid"] * (part.high is not None)
        wanted = " AND ".join([f"({t.row_filter})"] * bool(t.row_filter) + bounds) or None
        row = lambda at, data: (self.options.slot, first + at, self.point, data)
        if part.part == 0:
            yield row(0, b"B" + struct.pack(">qqI", self.point, self.micros, 0))
            yield row(1, _relation(t))
        at = part.part * PART + 2
        for values in self.client_of(self.given).rows(snapshot_query(t.schema, t.name, [c[0] for c in t.columns], wanted), self.name, self.options.snapshot_fetch_size):
            yield row(at, _row(t, list(values)))
            at += 1
        if part.high is None:
            yield row(TABLE - 1, b"C\0" + struct.pack(">qqq", self.point, self.point, self.micros))
