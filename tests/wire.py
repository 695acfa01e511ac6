"""Messages of the protocol, built by hand."""

import re
import struct


def begin(xid, lsn=100, micros=1000):
    return b"B" + struct.pack(">qqI", lsn, micros, xid)


def commit(lsn=100, end=110, micros=1000):
    return b"C\0" + struct.pack(">qqq", lsn, end, micros)


def relation(oid, name="t", columns=(("id", 1, 23, -1), ("note", 0, 25, -1)), identity=b"d", namespace="lab", xid=None):
    prefix = b"" if xid is None else struct.pack(">I", xid)
    cols = b"".join(struct.pack(">B", k) + n.encode() + b"\0" + struct.pack(">Ii", t, m) for n, k, t, m in columns)
    return b"R" + prefix + struct.pack(">I", oid) + namespace.encode() + b"\0" + name.encode() + b"\0" + identity + struct.pack(">H", len(columns)) + cols


def cell(v):
    if v is None:
        return b"n"
    if v is Ellipsis:
        return b"u"
    if isinstance(v, bytes):
        return b"b" + struct.pack(">i", len(v)) + v
    return b"t" + struct.pack(">i", len(v.encode())) + v.encode()


def row(*values):
    return struct.pack(">H", len(values)) + b"".join(map(cell, values))


def insert(oid, *values, xid=None):
    return b"I" + (b"" if xid is None else struct.pack(">I", xid)) + struct.pack(">I", oid) + b"N" + row(*values)


def update(oid, *values, old=None, kind=b"O"):
    return b"U" + struct.pack(">I", oid) + (b"" if old is None else kind + row(*old)) + b"N" + row(*values)


def delete(oid, *values, kind=b"K"):
    return b"D" + struct.pack(">I", oid) + kind + row(*values)


def truncate(*oids, flags=0):
    return b"T" + struct.pack(">IB", len(oids), flags) + struct.pack(f">{len(oids)}I", *oids)


def start(xid, first=1):
    return b"S" + struct.pack(">IB", xid, first)


STOP = b"E"


def stream_commit(xid, lsn=200, end=210, micros=2000):
    return b"c" + struct.pack(">IBqqq", xid, 0, lsn, end, micros)


def abort(xid, sub):
    return b"A" + struct.pack(">II", xid, sub)


class FileClient:
    """Plays a capture file back; confirmed positions go to a file beside it."""

    def __init__(self, options):
        self.path = options["path"]
        with open(self.path) as f:
            self.log = [(16 * i, bytes.fromhex(x)) for i, x in enumerate(f.read().split(), 1)]

    def messages(self, after):
        return iter([x for x in self.log if x[0] > after])

    def confirm(self, lsn):
        with open(self.path + ".confirmed", "a") as f:
            f.write(f"{lsn}\n")


class SlotLogs:
    """Logs of several slots as files of hex lines, <path>/<slot>; positions are line numbers. Each read and confirmation is noted in <path>/notes."""

    def __init__(self, options):
        self.path = options["path"]

    def _log(self, slot):
        try:
            with open(f"{self.path}/{slot}") as f:
                return [(i, bytes.fromhex(x)) for i, x in enumerate(f.read().split(), 1)]
        except FileNotFoundError:
            return []

    def _safe(self, slot):
        from changeloom.sources.landing import safe_positions

        return safe_positions(self._log(slot))

    def upto(self, slot, after, most):
        later = [p for p in self._safe(slot) if p > after]
        return max([p for p in later if p <= after + most], default=later[0] if later else after)

    def cuts(self, slot, start, end, parts):
        inside = [p for p in self._safe(slot) if start < p < end]
        return sorted({inside[len(inside) * k // parts] for k in range(1, parts)}) if inside else []

    def read(self, slot, start, end):
        self._note(f"read {slot} {start} {end}")
        return ((p, 16 * p, d) for p, d in self._log(slot) if start < p <= end)

    def confirm(self, slot, position):
        self._note(f"confirm {slot} {position}")

    def _note(self, text):
        with open(f"{self.path}/notes", "a") as f:
            f.write(text + "\n")


class PagedTables:
    """Three tables whose rows lie on pages; what is asked for is noted in <path>/asked."""

    tables = {"customers": [[("1", "Ada"), ("2", None)], [], [("3", "Cy")], [("4", "Di"), ("5", "Ed")], [("6", "Flo")]], "none": [], "toasts": [[("9", "x")]]}

    def __init__(self, options):
        self.path = options["path"]

    def query(self, sql):
        if "pg_publication_tables" in sql:
            return [(100 + i, "lab", t, "d", "id < 10" if t == "toasts" else None, c, oid, -1, c == "id") for i, t in enumerate(self.tables) for c, oid in (("id", 23), ("name", 25))]
        if "pg_relation_size" in sql:
            return [(len(list(self.tables.values())[int(re.search(r"size\((\d+)", sql)[1]) - 100]),)]
        return [(160000,)]

    def rows(self, query, snapshot, fetch_size):
        with open(f"{self.path}/asked", "a") as f:
            f.write(f"{snapshot} {fetch_size}: {query}\n")
        low = re.search(r"ctid >= '\((\d+),0", query)
        high = re.search(r"ctid < '\((\d+),0", query)
        pages = self.tables[re.search(r'"\."(\w+)"', query)[1]]
        return iter([r for page in pages[int(low[1]) if low else 0 : int(high[1]) if high else None] for r in page])
