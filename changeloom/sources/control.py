"""What happens before a stream runs: options, checks of the server, the slot, where to start, and the initial snapshot's phase.

All of it goes through a client with query(sql) -> list of rows, execute(sql) -> first row or None, so it runs against any connection and against fakes.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field, fields

from changeloom.sources.catalog import quoted

SSL_MODES = ("disabled", "prefer", "require", "verify-ca", "verify-full")
NEEDS = 140000  # the server's version from which the protocol is as here
PLUGIN = "pgoutput"


@dataclass(frozen=True)
class Options:
    """One capture. Where a limit is a time it is in seconds."""

    host: str = ""
    database: str = ""
    user: str = ""
    publication: str = ""
    slot: str = "slot"
    port: int = 5432
    password: str | None = None
    connect_timeout: int = 30
    ssl_mode: str = "disabled"
    ssl_root_cert: str | None = None
    ssl_cert: str | None = None
    ssl_key: str | None = None
    create_slot: bool = True
    initial_snapshot: bool = False
    snapshot_fetch_size: int = 10_000
    binary: bool = False
    streaming: bool = False
    max_streamed_bytes: int = 1 << 30
    schema_pattern: str | None = None
    table_pattern: str | None = None
    batch_strategy: str = "max_events"
    max_events: int = 1000
    max_wait: float = 10.0
    toast_strategy: str = "null"
    toast_placeholder: str = "__unchanged_toast_value__"
    wal_warn_bytes: int | None = None

    @classmethod
    def of(cls, options) -> "Options":
        """From text options by the names of the fields, as Spark's sources get them; others are left aside. Raises with all that is wrong."""
        read = {"bool": _truth, "int": int, "float": float, "int | None": int}
        given = cls(**{f.name: read.get(f.type, str)(options[f.name]) for f in fields(cls) if options.get(f.name) is not None})
        if problems := given.problems():
            raise ValueError("; ".join(problems))
        return given

    def captures(self, schema: str, table: str) -> bool:
        """Whether both whole names fit their patterns; a blank pattern lets all through."""
        fits = lambda pattern, name: not (pattern or "").strip() or re.fullmatch(pattern, name) is not None
        return fits(self.schema_pattern, schema) and fits(self.table_pattern, table)

    def problems(self) -> list[str]:
        """What is wrong with these options, alone and together."""
        out = []
        if not re.fullmatch(r"[a-z0-9_]{1,63}", self.slot):
            out.append("slot: lower-case letters, digits and underscores, 63 at most")
        if self.ssl_mode not in SSL_MODES:
            out.append(f"ssl_mode: one of {', '.join(SSL_MODES)}")
        if self.ssl_mode.startswith("verify") and not self.ssl_root_cert:
            out.append(f"ssl_mode {self.ssl_mode} needs ssl_root_cert")
        if self.batch_strategy not in ("max_events", "one_transaction"):
            out.append("batch_strategy: max_events or one_transaction")
        if self.toast_strategy not in ("null", "placeholder", "omit"):
            out.append("toast_strategy: null, placeholder or omit")
        for name in ("schema_pattern", "table_pattern"):
            try:
                re.compile(getattr(self, name) or "")
            except re.error:
                out.append(f"{name}: not a pattern")
        out += [f"{n}: at least 1" for n in ("port", "max_events", "snapshot_fetch_size", "connect_timeout", "max_streamed_bytes") if getattr(self, n) < 1]
        return out

    def stream_options(self) -> dict[str, str]:
        """What START_REPLICATION gets."""
        out = {"proto_version": "2" if self.streaming else "1", "publication_names": quoted(self.publication)}
        return out | ({"binary": "true"} if self.binary else {}) | ({"streaming": "on"} if self.streaming else {})

    def properties(self, purpose: str) -> dict[str, str]:
        """Connection properties for ``replication``, ``snapshot`` (values as text) or ``plain``."""
        out = {"user": self.user, "connectTimeout": str(self.connect_timeout), "sslmode": "disable" if self.ssl_mode == "disabled" else self.ssl_mode}
        out |= {k: v for k, v in (("password", self.password), ("sslrootcert", self.ssl_root_cert), ("sslcert", self.ssl_cert), ("sslkey", self.ssl_key)) if v}
        if purpose == "replication":
            out |= {"replication": "database", "assumeMinServerVersion": "14", "preferQueryMode": "simple"}
        elif purpose == "snapshot":
            out |= {"binaryTransfer": "false"}
        elif purpose != "plain":
            raise ValueError(f"unknown purpose {purpose}")
        return out

    @property
    def events_per_batch(self) -> int:
        return 1 if self.batch_strategy == "one_transaction" else self.max_events

    @property
    def wait_micros(self) -> int | None:
        return None if self.batch_strategy == "one_transaction" else int(self.max_wait * 1_000_000)


def _truth(word) -> bool:
    if str(word).strip().lower() not in ("true", "false"):
        raise ValueError(f"true or false, not {word}")
    return str(word).strip().lower() == "true"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def check_server(client, publication: str) -> None:
    """Raises with the reason when this server can't be captured from."""
    one = lambda sql: client.query(sql)[0][0]
    if int(one("SHOW server_version_num")) < NEEDS:
        raise ValueError("the server is older than version 14")
    if one("SHOW wal_level") != "logical":
        raise ValueError("wal_level isn't logical")
    if not one("SELECT rolreplication OR rolsuper FROM pg_roles WHERE rolname = current_user"):
        raise ValueError("the user may not replicate")
    if not client.query(f"SELECT 1 FROM pg_publication WHERE pubname = {literal(publication)}"):
        raise ValueError(f"there is no publication {publication}")


@dataclass
class Slot:
    name: str
    plugin: str
    database: str
    active: bool
    confirmed_lsn: int


def find_slot(client, name: str) -> Slot | None:
    rows = client.query(f"SELECT slot_name, plugin, database, active, confirmed_flush_lsn - '0/0' FROM pg_replication_slots WHERE slot_name = {literal(name)}")
    return Slot(rows[0][0], rows[0][1], rows[0][2], bool(rows[0][3]), int(rows[0][4] or 0)) if rows else None


def check_slot(slot: Slot, database: str) -> None:
    if slot.plugin != PLUGIN:
        raise ValueError(f"slot {slot.name} belongs to plugin {slot.plugin}")
    if slot.database != database:
        raise ValueError(f"slot {slot.name} belongs to database {slot.database}")
    if slot.active:
        raise ValueError(f"slot {slot.name} is in use")


def drop_slot(client, name: str) -> None:
    client.execute(f"SELECT pg_drop_replication_slot({literal(name)})")


def create_slot(client, name: str) -> tuple[int, str | None]:
    """The point from which the slot is consistent, and the name of the snapshot that shows the tables as of it."""
    row = client.execute(f"CREATE_REPLICATION_SLOT {quoted(name)} LOGICAL {PLUGIN} EXPORT_SNAPSHOT")
    high, low = row[1].split("/")
    return (int(high, 16) << 32) + int(low, 16), row[2]


@dataclass
class Start:
    """lsn: where the stream starts. snapshot: the exported snapshot to read first, if one is due. state: what to store."""

    lsn: int
    snapshot: str | None = None
    state: dict = field(default_factory=dict)


def prepare(client, options: Options, state: dict, save) -> Start:
    """Find or make the slot and say where to start.

    state is what was stored: lsn, or snapshot_pending (an initial snapshot was begun and isn't over). save(state) stores at once. A pending snapshot can't be resumed, as its exported
    snapshot is gone: our slot is dropped and all begins anew, or, if snapshots are no longer wanted, the mark is taken away. The mark is stored before the slot exists, so that a crash in between leaves it.
    """
    slot = find_slot(client, options.slot)
    state = dict(state)
    if state.get("snapshot_pending"):
        if options.initial_snapshot and slot is not None:
            check_slot(slot, options.database)
            drop_slot(client, options.slot)
            slot = None
        elif not options.initial_snapshot:
            state.pop("snapshot_pending")
            save(state)
    if slot is not None:
        check_slot(slot, options.database)
        return Start(max(int(state.get("lsn", 0)), slot.confirmed_lsn), None, state)
    if not options.create_slot:
        raise ValueError(f"there is no slot {options.slot}, and it may not be created")
    if options.initial_snapshot:
        save({"snapshot_pending": True})
    point, snapshot = create_slot(client, options.slot)
    # what an earlier slot had confirmed means nothing for a new one
    state = {"snapshot_pending": True} if options.initial_snapshot else {}
    save(state)
    return Start(point, snapshot if options.initial_snapshot else None, state)


def snapshot_done(start: Start, save) -> dict:
    """After the last snapshot batch: the consistent point takes the place of the mark."""
    state = {"lsn": start.lsn}
    save(state)
    return state


class Throttle:
    """Says whether a repeated message is due: the first at once, then one in ``every`` seconds; success begins anew."""

    def __init__(self, every: float = 60, clock=time.monotonic):
        self.every, self.clock, self.last, self.failed = every, clock, None, False

    def failure(self) -> str:
        """error for the first of a row, warn when one is due again, debug else."""
        now, first = self.clock(), not self.failed
        self.failed = True
        if first or now - self.last >= self.every:
            self.last = now
            return "error" if first else "warn"
        return "debug"

    def success(self) -> None:
        self.failed = False

    def due(self) -> bool:
        now = self.clock()
        if self.last is None or now - self.last >= self.every:
            self.last = now
            return True
        return False


def retained_bytes(client, slot: str) -> int:
    """Log that the server keeps for the slot; asked on a connection of its own."""
    rows = client.query(f"SELECT pg_wal_lsn_diff(pg_current_wal_lsn(), restart_lsn) FROM pg_replication_slots WHERE slot_name = {literal(slot)}")
    return int(rows[0][0] or 0) if rows else 0


def retention_warning(client, options: Options, throttle: Throttle) -> str | None:
    """A warning when the slot holds back more log than allowed, once in a while."""
    if options.wal_warn_bytes is None:
        return None
    held = retained_bytes(client, options.slot)
    if held > options.wal_warn_bytes and throttle.due():
        return f"slot {options.slot} keeps {held // 1048576} MB of log, more than {options.wal_warn_bytes // 1048576} MB"
    return None
