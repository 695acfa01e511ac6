"""pgoutput messages: bytes to columns and back.

decode() runs the codec over Arrow batches of (source_id, seq, recv_lsn, data) and makes their columns one by one: those of changes for all messages at once (tuples.py), others message by message, repeated ones once. Kinds that nobody asked for are dropped by their first byte, before anything
else. Whether a message lies in a streamed segment (and so carries a transaction id in front) is found from the markers S and E, with a forward fill that leaves no source in one task.
What a join or filter needs of a message is read off its bytes by built-in functions (message_kind, peek_*), so changes meet their definitions as bytes, and decode_rows() decodes each once.
A malformed message fails the query.

encode_*() build the same bytes from columns with built-in functions, for tests and round trips.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from decimal import MAX_EMAX, MIN_EMIN, Context, Decimal
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from changeloom.functions import values as V
from changeloom.operators import tuples
from changeloom.operators.transactions import segment_membership

CELL = "struct<kind:string,text:string,bin:binary>"
RELATION = "struct<relation_id:long,namespace:string,name:string,replica_identity:string,columns:array<struct<name:string,key:boolean,type_oid:long,typmod:int>>>"
MESSAGE = (
    "source_id string, seq long, recv_lsn long, kind string, in_stream boolean, stream_xid long, xid long, sub_xid long, first_segment boolean, final_lsn long, commit_lsn long, end_lsn long, "
    f"origin_lsn long, commit_micros long, origin_name string, relation_id long, relation {RELATION}, type struct<type_oid:long,namespace:string,name:string>, old_kind string, old array<{CELL}>, new array<{CELL}>, "
    "truncate struct<cascade:boolean,restart_identity:boolean,relation_ids:array<long>>"
)
TRANSACTIONAL = set("RYIUDT")
IDENTITIES = {"d": "default", "n": "nothing", "f": "full", "i": "index"}


class ProtocolError(ValueError):
    """A message that isn't as the protocol says."""


class Reader:
    """Big-endian fields of one message, one after the other."""

    def __init__(self, data: bytes):
        self.data, self.at = bytes(data), 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise ProtocolError("the message ends too early")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self, n: int, signed: bool = False) -> int:
        return int.from_bytes(self.take(n), "big", signed=signed)

    def letter(self) -> str:
        return self.take(1).decode("latin-1")

    def string(self) -> str:
        end = self.data.find(b"\0", self.at)
        if end < 0:
            raise ProtocolError("a string has no end")
        text = self.data[self.at : end].decode(errors="replace")
        self.at = end + 1
        return text

    def cells(self) -> list[dict]:
        out, data, at = [], self.data, self.at + 2
        for _ in range(self.number(2)):
            kind = data[at : at + 1]
            if kind == b"t" or kind == b"b":
                start = at + 5
                end = start + int.from_bytes(data[at + 1 : start], "big", signed=True)
                if end < start or end > len(data):
                    raise ProtocolError("the message ends too early")
                value = data[start:end]
                out.append({"kind": "t", "text": value.decode(errors="replace"), "bin": None} if kind == b"t" else {"kind": "b", "text": None, "bin": value})
                at = end
            elif kind == b"n" or kind == b"u":
                out.append({"kind": kind.decode(), "text": None, "bin": None})
                at += 1
            else:
                raise ProtocolError(f"unknown kind of cell {kind!r}")
        self.at = at
        return out

    def expect(self, allowed: str) -> str:
        kind = self.letter()
        if kind not in allowed:
            raise ProtocolError(f"unknown kind of tuple {kind!r}")
        return kind


def _relation(r: Reader) -> dict:
    oid, namespace, name, identity = r.number(4), r.string(), r.string(), r.letter()
    if identity not in IDENTITIES:
        raise ProtocolError(f"unknown replica identity {identity!r}")
    columns = [{"key": bool(r.number(1) & 1), "name": r.string(), "type_oid": r.number(4), "typmod": r.number(4, signed=True)} for _ in range(r.number(2))]
    return {"relation_id": oid, "relation": {"relation_id": oid, "namespace": namespace, "name": name, "replica_identity": IDENTITIES[identity], "columns": columns}}


def _truncate(r: Reader) -> dict:
    n, flags = r.number(4), r.number(1)
    return {"truncate": {"cascade": bool(flags & 1), "restart_identity": bool(flags & 2), "relation_ids": [r.number(4) for _ in range(n)]}}


def _row(r: Reader, kind: str) -> dict:
    out: dict = {"relation_id": r.number(4)}
    if kind in "UD":
        tuple_kind = r.expect("KON" if kind == "U" else "KO")
        if tuple_kind != "N":
            out |= {"old_kind": tuple_kind, "old": r.cells()}
        if kind == "D":
            return out
        if tuple_kind == "N":
            return out | {"new": r.cells()}
    r.expect("N")
    return out | {"new": r.cells()}


def decode_message(data: bytes, in_stream: bool) -> dict:
    """One message -> the fields that it has."""
    r = Reader(data)
    kind = r.letter()
    out: dict = {"kind": kind, "in_stream": in_stream}
    if in_stream and kind in TRANSACTIONAL:
        out["stream_xid"] = r.number(4)
    if kind == "B":
        out |= {"final_lsn": r.number(8, True), "commit_micros": r.number(8, True), "xid": r.number(4)}
    elif kind == "C":
        r.take(1)
        out |= {"commit_lsn": r.number(8, True), "end_lsn": r.number(8, True), "commit_micros": r.number(8, True)}
    elif kind == "O":
        out |= {"origin_lsn": r.number(8, True), "origin_name": r.string()}
    elif kind == "R":
        out |= _relation(r)
    elif kind == "Y":
        out["type"] = {"type_oid": r.number(4), "namespace": r.string(), "name": r.string()}
    elif kind in "IUDs":  # s: a row of a snapshot, which sources write like an insert
        out |= _row(r, kind)
    elif kind == "T":
        out |= _truncate(r)
    elif kind == "S":
        out |= {"xid": r.number(4), "first_segment": r.number(1) != 0}
    elif kind == "c":
        xid = r.number(4)
        r.take(1)
        out |= {"xid": xid, "commit_lsn": r.number(8, True), "end_lsn": r.number(8, True), "commit_micros": r.number(8, True)}
    elif kind == "A":
        out |= {"xid": r.number(4), "sub_xid": r.number(4)}
    elif kind != "E":
        raise ProtocolError(f"unknown kind of message {kind!r}")
    if r.at != len(r.data):
        raise ProtocolError(f"{len(r.data) - r.at} bytes follow a message of kind {kind}")
    return out


def decode(raw: DataFrame, streaming: bool = False, kinds: str | None = None) -> DataFrame:
    """raw (source_id, seq, recv_lsn, data) -> messages. ``streaming`` says whether segments of large transactions may occur; of ``kinds``, where given, and of no others."""
    kind = message_kind(F.col("data"))
    wanted = F.lit(True) if kinds is None else kind.isin(*kinds)
    if streaming:
        marked = segment_membership(raw.where(wanted | kind.isin("S", "E")).withColumn("k", kind), F.col("k") == "S", F.col("k") == "E", F.lit(0).cast("long")).where(wanted)
    else:
        marked = raw.where(wanted).withColumn("in_stream", F.lit(False))

    shape = arrow_schema(MESSAGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = tuples.messages_of(batch.column(3), batch.column(4), shape)
            if made is None:
                made = _once_each(batch, shape)
            made |= {name: batch.column(i) for i, name in enumerate(("source_id", "seq", "recv_lsn"))}
            yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(batch.num_rows, f.type) for f in shape], schema=shape)

    return marked.select("source_id", "seq", "recv_lsn", "data", "in_stream").mapInArrow(run, MESSAGE)


def _once_each(batch: pa.RecordBatch, shape: pa.Schema) -> dict[str, pa.Array]:
    """Columns of a batch's messages, message by message; where most repeat others, as definitions do, each of them once."""
    which = None
    if batch.column(3).null_count == 0 and len(pc.unique(batch.column(4))) == 1:
        found = pc.dictionary_encode(batch.column(3))
        if 2 * len(found.dictionary) <= len(found):
            which = found.indices
            batch = batch.take(pa.array(np.unique(which.to_numpy(), return_index=True)[1]))
    rows = _messages(batch, batch.column(4).to_pylist())
    made = {f.name: _column(rows, f) for f in shape if f.name not in ("source_id", "seq", "recv_lsn")}
    return made if which is None else {n: c.take(which) for n, c in made.items()}


def _messages(batch: pa.RecordBatch, in_stream: list[bool]) -> list[dict]:
    """The messages of a batch (source_id, seq, recv_lsn, data, ...)."""
    rows = []
    for i, (data, inside) in enumerate(zip(batch.column(3).to_pylist(), in_stream, strict=True)):
        try:
            rows.append(decode_message(data, inside))
        except ValueError as e:
            raise ProtocolError(f"{batch.column(0)[i]}, message {batch.column(1)[i]}: {e}") from e
    return rows


def _column(rows: list[dict], field: pa.Field) -> pa.Array:
    """One field of the messages; null where a message doesn't have it."""
    values = [r.get(field.name) for r in rows]
    if all(v is None for v in values):
        return pa.nulls(len(rows), field.type)
    return _cell_column(values, field.type) if field.name in ("old", "new") else pa.array(values, field.type)


def _cell_column(rows: list[list[dict] | None], kind: pa.DataType) -> pa.Array:
    """Tuples of cells, made flat."""
    flat = [cell for cells in rows if cells is not None for cell in cells]
    fields = kind.value_type
    parts = pa.StructArray.from_arrays([pa.array([c[f.name] for c in flat], f.type) for f in fields], fields=list(fields))
    ends = list(accumulate((len(cells) if cells is not None else 0 for cells in rows), initial=0))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts, type=kind, mask=pa.array([cells is None for cells in rows]))


def decode_rows(changes: DataFrame) -> DataFrame:
    """changes (source_id, seq, recv_lsn, data: an I, U, D or T outside a segment, relation, ...) with old_kind, old and new instead of data: cells as text.

    A batch's tuples are read all at once (tuples.py), message by message where anything in it is unusual. Binary values are turned into text in the same pass. ``bin`` stays with cells that came in binary and have no value here (kind n) or no mapping (their text is hex).
    """
    others = [c for c in changes.columns if c not in ("source_id", "seq", "recv_lsn", "data")]
    of = others.index("relation") + 4
    added = f"old_kind string, old array<{CELL}>, new array<{CELL}>"
    source = changes.select("source_id", "seq", "recv_lsn", "data", *others)
    schema = StructType([f for f in source.schema if f.name != "data"] + list(StructType.fromDDL(added)))
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = pc.struct_field(batch.column(of), "columns")
            others_of = [batch.column(i) for i in range(len(others) + 4) if i != 3]
            at_once = tuples.rows_of(batch.column(3), columns, list(shape)[-3:], binary_text, MAPPED)
            if at_once is not None:
                yield pa.RecordBatch.from_arrays([*others_of, *at_once], schema=shape)
                continue
            rows = _messages(batch, [False] * batch.num_rows)
            if any(c["kind"] == "b" for r in rows for side in ("old", "new") for c in r.get(side) or ()):
                for i, (r, oids) in enumerate(zip(rows, _type_oids(columns), strict=True)):
                    for side in ("old", "new"):
                        if side in r:
                            try:
                                r[side] = [_as_text(cell, oid) for cell, oid in zip(r[side], oids, strict=True)]
                            except ValueError as e:
                                raise ProtocolError(f"{batch.column(0)[i]}, message {batch.column(1)[i]}: {e}") from e
            yield pa.RecordBatch.from_arrays([*others_of, *(_column(rows, f) for f in list(shape)[-3:])], schema=shape)

    return source.mapInArrow(run, schema)


def _type_oids(columns: pa.ListArray) -> list[list[int]]:
    """Types of the columns of each row's table."""
    oids, ends = columns.values.field("type_oid").to_pylist(), columns.offsets.to_pylist()
    return [oids[a:b] for a, b in zip(ends, ends[1:])]


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def message_kind(data: Column) -> Column:
    """Kind of a message without decoding it."""
    return F.decode(F.substring(data, 1, 1), "ISO-8859-1")


def is_transactional(data: Column) -> Column:
    return message_kind(data).isin(*TRANSACTIONAL)


def peek_xid(data: Column) -> Column:
    """The transaction id in front of a message of a segment."""
    return F.conv(F.hex(F.substring(data, 2, 4)), 16, 10).cast("long")


def peek_relation(data: Column) -> Column:
    """The table's number of an I, U, D or R outside a segment."""
    return F.conv(F.hex(F.substring(data, 2, 4)), 16, 10).cast("long")


def peek_truncated(data: Column) -> Column:
    """The tables' numbers of a T outside a segment."""
    n = F.conv(F.hex(F.substring(data, 2, 4)), 16, 10).cast("int")
    number = lambda i: F.conv(F.hex(F.substr(data, 7 + 4 * i, F.lit(4))), 16, 10).cast("long")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), number)).otherwise(F.array().cast("array<long>"))


def big_endian(number: Column, n_bytes: int) -> Column:
    """A number's lowest bytes, highest first."""
    return F.unhex(F.right(F.lpad(F.hex(number.cast("long")), 16, "0"), F.lit(2 * n_bytes)))


def c_string(text: Column) -> Column:
    return F.concat(F.encode(text, "UTF-8"), F.unhex(F.lit("00")))


def letter(text: str) -> Column:
    return F.encode(F.lit(text), "UTF-8")


def encode_cell(text: Column) -> Column:
    """A text cell, or null."""
    raw = F.encode(text, "UTF-8")
    return F.when(text.isNull(), letter("n")).otherwise(F.concat(letter("t"), big_endian(F.octet_length(raw), 4), raw))


def encode_binary_cell(raw: Column) -> Column:
    return F.when(raw.isNull(), letter("n")).otherwise(F.concat(letter("b"), big_endian(F.octet_length(raw), 4), raw))


def encode_tuple(cells: list[Column]) -> Column:
    return F.concat(big_endian(F.lit(len(cells)), 2), *cells)


def encode_begin(lsn: Column, micros: Column, xid: Column) -> Column:
    return F.concat(letter("B"), big_endian(lsn, 8), big_endian(micros, 8), big_endian(xid, 4))


def encode_commit(lsn: Column, end_lsn: Column, micros: Column) -> Column:
    return F.concat(letter("C"), F.unhex(F.lit("00")), big_endian(lsn, 8), big_endian(end_lsn, 8), big_endian(micros, 8))


def encode_relation(oid: Column, namespace: str, name: Column, identity: str, columns: list[tuple[str, bool, int, int]], stream_xid: Column | None = None) -> Column:
    prefix = [] if stream_xid is None else [big_endian(stream_xid, 4)]
    described = [F.concat(F.unhex(F.lit("01" if key else "00")), c_string(F.lit(n)), big_endian(F.lit(oid_), 4), big_endian(F.lit(typmod), 4)) for n, key, oid_, typmod in columns]
    return F.concat(letter("R"), *prefix, big_endian(oid, 4), c_string(F.lit(namespace)), c_string(name), letter(identity), big_endian(F.lit(len(columns)), 2), *described)


def encode_insert(oid: Column, cells: list[Column], stream_xid: Column | None = None) -> Column:
    prefix = [] if stream_xid is None else [big_endian(stream_xid, 4)]
    return F.concat(letter("I"), *prefix, big_endian(oid, 4), letter("N"), encode_tuple(cells))


def encode_update(oid: Column, old: list[Column] | None, new: list[Column], old_kind: str = "O") -> Column:
    before = [] if old is None else [letter(old_kind), encode_tuple(old)]
    return F.concat(letter("U"), big_endian(oid, 4), *before, letter("N"), encode_tuple(new))


def encode_delete(oid: Column, old: list[Column], old_kind: str = "K") -> Column:
    return F.concat(letter("D"), big_endian(oid, 4), letter(old_kind), encode_tuple(old))


def encode_truncate(oids: list[Column], flags: Column) -> Column:
    return F.concat(letter("T"), big_endian(F.lit(len(oids)), 4), big_endian(flags, 1), *[big_endian(x, 4) for x in oids])


def encode_origin(lsn: Column, name: Column) -> Column:
    return F.concat(letter("O"), big_endian(lsn, 8), c_string(name))


def encode_type(oid: Column, namespace: Column, name: Column) -> Column:
    return F.concat(letter("Y"), big_endian(oid, 4), c_string(namespace), c_string(name))


def encode_abort(xid: Column, sub_xid: Column) -> Column:
    return F.concat(letter("A"), big_endian(xid, 4), big_endian(sub_xid, 4))


def unchanged_cell() -> Column:
    return letter("u")


# -- binary values -------------------------------------------------------------------------------------------------------------------------


def _fixed(raw: bytes, n: int) -> bytes:
    if len(raw) != n:
        raise ProtocolError(f"a value has {len(raw)} bytes, not {n}")
    return raw


def binary_numeric(raw: bytes) -> Decimal | None:
    """Digits in base 10,000 with weight, sign and display scale; None for NaN and infinities."""
    if len(raw) < 8:
        raise ProtocolError("a numeric is too short")
    n, weight, sign, scale = struct.unpack(">HhHH", raw[:8])
    if len(raw) == 8 + 2 * n and sign in (0xC000, 0xD000, 0xF000):
        return None
    if sign not in (0, 0x4000) or len(raw) != 8 + 2 * n:
        raise ProtocolError("a numeric has an unknown sign or the wrong length")
    groups = struct.unpack(f">{n}H", raw[8:])
    if any(g > 9999 for g in groups):
        raise ProtocolError("a numeric has a digit above 9999")
    digits = "".join(f"{g:04d}" for g in groups) or "0"
    exponent = 4 * (weight - n + 1) if n else 0
    # as many digits as the value has, however many
    exact = Context(prec=len(digits) + abs(exponent) + scale + 1, Emax=MAX_EMAX, Emin=MIN_EMIN)
    value = Decimal(("-" if sign else "") + digits).scaleb(exponent, exact)
    return value.quantize(Decimal(1).scaleb(-scale, exact), "ROUND_HALF_UP", exact)


def binary_text(raw: bytes | None, oid: int) -> str | None:
    """A binary value as the text that its type has here; None for what Spark has no value for. Types without a mapping give \\x and hex."""
    if raw is None:
        return None
    if oid == V.BOOL:
        return "t" if _fixed(raw, 1)[0] else "f"
    if oid in (V.INT2, V.INT4, V.INT8):
        return str(int.from_bytes(_fixed(raw, {V.INT2: 2, V.INT4: 4, V.INT8: 8}[oid]), "big", signed=True))
    if oid in (V.FLOAT4, V.FLOAT8):
        value = np.frombuffer(_fixed(raw, 4), ">f4")[0] if oid == V.FLOAT4 else struct.unpack(">d", _fixed(raw, 8))[0]
        return str(value) if np.isfinite(value) else None  # the shortest digits that give this value in its own width
    if oid == V.NUMERIC:
        value = binary_numeric(raw)
        return None if value is None else format(value, "f")
    if oid == V.DATE:
        days = int.from_bytes(_fixed(raw, 4), "big", signed=True)
        return None if abs(days) >= 2**31 - 1 else _date(days)
    if oid == V.TIME:
        micros = int.from_bytes(_fixed(raw, 8), "big", signed=True)
        return _clock(micros) if 0 <= micros < 86400000000 else None
    if oid in (V.TIMESTAMP, V.TIMESTAMPTZ):
        micros = int.from_bytes(_fixed(raw, 8), "big", signed=True)
        days, rest = divmod(micros, 86400000000)
        day = None if abs(micros) >= 2**63 - 1 else _date(days)
        return None if day is None else f"{day} {_clock(rest)}" + ("+00" if oid == V.TIMESTAMPTZ else "")
    if oid == V.UUID:
        h = _fixed(raw, 16).hex()
        return "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:]))
    if oid == V.JSONB:
        if raw[:1] != b"\x01":
            raise ProtocolError("unknown version of jsonb")
        return raw[1:].decode(errors="replace")
    if oid in (V.TEXT, V.VARCHAR, V.BPCHAR, V.NAME, V.JSON):
        return raw.decode(errors="replace")
    return "\\x" + raw.hex()


def _date(days: int) -> str | None:
    """Days since 2000-01-01, proleptic; None before year 1."""
    import datetime

    ordinal = datetime.date(2000, 1, 1).toordinal() + days
    return datetime.date.fromordinal(ordinal).isoformat() if 1 <= ordinal <= datetime.date.max.toordinal() else None


def _clock(micros: int) -> str:
    s, us = divmod(micros, 1000000)
    return f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}.{us:06d}"


#: Types whose binary form is read here.
MAPPED = {V.BOOL, V.INT2, V.INT4, V.INT8, V.FLOAT4, V.FLOAT8, V.NUMERIC, V.DATE, V.TIME, V.TIMESTAMP, V.TIMESTAMPTZ, V.UUID, V.JSONB, V.TEXT, V.VARCHAR, V.BPCHAR, V.NAME, V.JSON, V.BYTEA}


def _as_text(cell: dict, oid: int) -> dict:
    if cell["kind"] != "b":
        return cell
    text = binary_text(cell["bin"], oid)
    return {"kind": "n" if text is None else "t", "text": text, "bin": None if text is not None and oid in MAPPED else cell["bin"]}
