"""Tuples of a whole batch of messages at once: where each cell lies is found column by column for all messages, values are cut out of the batch's one buffer and turned into text by type.

What isn't as expected (a message that ends too early, an unknown kind, text that isn't UTF-8, a tuple with another number of columns than its table) gives None; decoding message by message then
says which message it is, or deals with it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from changeloom.functions import values as V

WIDTH = {V.INT2: 2, V.INT4: 4, V.INT8: 8}
TEXTS = {V.TEXT, V.VARCHAR, V.BPCHAR, V.NAME, V.JSON}
KINDS = np.full(256, -1, np.int8)
KINDS[[ord(c) for c in "bntu"]] = range(4)
B, N, T, U = range(4)


class Unusual(Exception):
    """To be decoded message by message."""


def _need(ok) -> None:
    if not np.all(ok):
        raise Unusual


class Cells:
    """Cells of some tuples, one tuple after the other: kinds, where values start and how long they are, and where each tuple's begin."""

    def __init__(self, buf: np.ndarray, at: np.ndarray, end: np.ndarray):
        _need(at + 2 <= end)
        n = (buf[at].astype(np.int64) << 8) | buf[at + 1]
        at = at + 2
        most = int(n.max(initial=0))
        kind, start, size = np.zeros((len(n), most), np.int8), np.zeros((len(n), most), np.int64), np.zeros((len(n), most), np.int64)
        for k in range(most):
            rows = np.flatnonzero(k < n)
            p = at[rows]
            _need(p < end[rows])
            code = KINDS[buf[p]]
            _need(code >= 0)
            kind[rows, k] = code
            valued = (code == T) | (code == B)
            rows_v, p_v = rows[valued], p[valued]
            _need(p_v + 5 <= end[rows_v])
            length = sum(buf[p_v + 1 + i].astype(np.int64) << (24 - 8 * i) for i in range(4))
            _need(p_v + 5 + length <= end[rows_v])  # a negative length reads as a very large one
            start[rows_v, k], size[rows_v, k] = p_v + 5, length
            at[rows] = p + 1
            at[rows_v] = p_v + 5 + length
        there = np.arange(most) < n[:, None]
        self.kind, self.start, self.size = kind[there], start[there], size[there]
        self.ends, self.after = np.concatenate(([0], np.cumsum(n))), at


def _cut(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values' bytes, one after the other, and where each begins (one more than values)."""
    to = np.concatenate(([0], np.cumsum(size)))
    return buf[np.repeat(start - to[:-1], size) + np.arange(to[-1])], to


def _strings(data: np.ndarray, to: np.ndarray, kind=pa.string()) -> pa.Array:
    out = pa.Array.from_buffers(kind, len(to) - 1, [None, pa.py_buffer(to.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])
    try:
        out.validate(full=True)
    except pa.ArrowInvalid as e:
        raise Unusual from e
    return out


def _texts(buf: np.ndarray, cells: Cells, oids: np.ndarray | None, text_of: Callable, mapped: set[int]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """kind, text and bin of the cells."""
    place = np.full(len(cells.kind), -1, np.int64)  # in the pool of texts
    pool, filled = [], 0

    def add(which: np.ndarray, texts: pa.Array) -> None:
        nonlocal filled
        place[which] = filled + np.arange(len(which))
        pool.append(texts)
        filled += len(which)

    text = np.flatnonzero(cells.kind == T)
    add(text, _strings(*_cut(buf, cells.start[text], cells.size[text])))
    kept: dict[int, bytes] = {}
    binary = np.flatnonzero(cells.kind == B)
    for oid in np.unique(oids[binary]).tolist() if len(binary) else ():
        which = binary[oids[binary] == oid]
        data, to = _cut(buf, cells.start[which], cells.size[which])
        if oid in WIDTH:
            _need(np.diff(to) == WIDTH[oid])
            add(which, pa.array(data.view(f">i{WIDTH[oid]}").astype(np.int64)).cast(pa.string()))
        elif oid in TEXTS:
            add(which, _strings(data, to))
        else:
            raw = [data[a:b].tobytes() for a, b in zip(to, to[1:])]
            try:
                texts = [text_of(x, oid) for x in raw]
            except ValueError as e:
                raise Unusual from e
            add(which, pa.array(texts, pa.string()))
            kept |= {int(c): x for c, x, t in zip(which, raw, texts) if t is None or oid not in mapped}
    texts = pa.concat_arrays(pool).take(pa.array(place, mask=place < 0))
    shown = np.where((cells.kind == B) & texts.is_valid().to_numpy(zero_copy_only=False), T, np.where(cells.kind == B, N, cells.kind))
    kinds = pa.array(["b", "n", "t", "u"]).take(pa.array(shown))
    if not kept:
        return kinds, texts, pa.nulls(len(place), pa.binary())
    which = np.full(len(place), -1, np.int64)
    which[list(kept)] = np.arange(len(kept))
    return kinds, texts, pa.array(list(kept.values()), pa.binary()).take(pa.array(which, mask=which < 0))


def _raw(buf: np.ndarray, cells: Cells) -> tuple[pa.Array, pa.Array, pa.Array]:
    """kind, text and bin of the cells as they came."""
    out = [pa.array(list("bntu")).take(pa.array(cells.kind))]
    for code, kind in ((T, pa.string()), (B, pa.binary())):
        which = np.flatnonzero(cells.kind == code)
        place = np.full(len(cells.kind), -1, np.int64)
        place[which] = np.arange(len(which))
        out.append(_strings(*_cut(buf, cells.start[which], cells.size[which]), kind).take(pa.array(place, mask=place < 0)))
    return tuple(out)


def rows_of(data: pa.Array, columns: pa.ListArray, shape: list[pa.Field], text_of: Callable, mapped: set[int]) -> list[pa.Array] | None:
    """Messages of kinds I, U, D, T and s outside segments -> the columns old_kind, old and new (shape: their fields), or None."""
    try:
        return _rows_of(data, columns, shape, text_of, mapped)
    except Unusual:
        return None


def messages_of(data: pa.Array, in_stream: pa.Array, shape: pa.Schema) -> dict[str, pa.Array] | None:
    """Messages of kinds I, U, D, T and s, in segments or not -> the columns (of shape) that they have, cells as they came, or None."""
    try:
        buf, start, end = _bytes(data)
        inside = in_stream.to_numpy(zero_copy_only=False).astype(bool) & (buf[start] != ord("s"))
        body = start + 4 * inside  # a transaction's id lies before it
        _need(end - body >= 6)
        kind = buf[start]
        old_kind, old, new = _rows_of(data, None, [shape.field(n) for n in ("old_kind", "old", "new")], None, set(), 4 * inside)
        truncates = kind == ord("T")
        made = {
            "kind": pa.array([chr(i) for i in range(128)]).take(pa.array(kind)), "in_stream": in_stream, "stream_xid": pa.array(_number(buf, start + 1), mask=~inside),
            "relation_id": pa.array(_number(buf, body + 1), mask=truncates), "old_kind": old_kind, "old": old, "new": new,
        }
        if truncates.any():
            made["truncate"] = _truncates(buf, body, truncates, shape.field("truncate").type)
        return made
    except Unusual:
        return None


def _truncates(buf: np.ndarray, body: np.ndarray, truncates: np.ndarray, kind: pa.StructType) -> pa.Array:
    at = body[truncates]
    n, flags = _number(buf, at + 1), buf[at + 5]
    to = np.concatenate(([0], np.cumsum(n)))
    ids = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(_number(buf, np.repeat(at + 6 - 4 * to[:-1], n) + 4 * np.arange(to[-1]))))
    parts = [pa.array((flags & 1) != 0), pa.array((flags & 2) != 0), ids]
    whole = pa.StructArray.from_arrays([p.cast(f.type) for p, f in zip(parts, kind)], fields=list(kind))
    place = np.cumsum(truncates) - 1
    return whole.take(pa.array(place, mask=~truncates))


def _number(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The four-byte numbers at these places."""
    return sum((buf[at + i].astype(np.int64) << (24 - 8 * i) for i in range(4)), np.zeros(len(at), np.int64))


def _bytes(data: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The batch's buffer, and where each message begins and ends."""
    n = len(data)
    _need(n > 0 and data.null_count == 0)
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + n + 1].astype(np.int64)
    _need(np.diff(offsets) >= 6)
    return np.frombuffer(data.buffers()[2], np.uint8), offsets[:-1], offsets[1:]


def _rows_of(data: pa.Array, columns: pa.ListArray | None, shape: list[pa.Field], text_of: Callable | None, mapped: set[int], skipped: np.ndarray | int = 0) -> list[pa.Array]:
    """skipped: bytes between a message's kind and what follows it; without columns, cells stay as they came."""
    n = len(data)
    buf, start, end = _bytes(data)
    kind, start = buf[start], start + skipped
    second = buf[start + 5]
    is_a = lambda codes, letters: np.isin(codes, [ord(c) for c in letters])
    truncates = kind == ord("T")
    _need(is_a(kind, "IUDTs") & (truncates | np.where(is_a(kind, "Is"), second == ord("N"), np.where(kind == ord("D"), is_a(second, "KO"), is_a(second, "KON")))))
    with_old = ~truncates & is_a(second, "KO") & is_a(kind, "UD")
    with_new = ~truncates & (kind != ord("D"))
    ids = sum(buf[start[truncates] + 1 + i].astype(np.int64) << (24 - 8 * i) for i in range(4))
    _need(end[truncates] - start[truncates] == 6 + 4 * ids)
    at = start + 6
    sides = {}
    if with_old.any():
        rows = np.flatnonzero(with_old)
        sides["old"] = (rows, cells := Cells(buf, at[rows], end[rows]))
        at[rows] = cells.after
        both = rows[with_new[rows]]
        _need(at[both] < end[both])
        _need(buf[at[both]] == ord("N"))
        at[both] += 1
    if with_new.any():
        rows = np.flatnonzero(with_new)
        sides["new"] = (rows, cells := Cells(buf, at[rows], end[rows]))
        at[rows] = cells.after
    _need(truncates | (at == end))

    if columns is not None:
        first, held = columns.offsets.to_numpy().astype(np.int64), np.diff(columns.offsets.to_numpy())
        types = columns.values.field("type_oid").to_numpy(zero_copy_only=False)

    def column(field: pa.Field) -> pa.Array:
        if field.name not in sides:
            return pa.nulls(n, field.type)
        rows, cells = sides[field.name]
        oids, sizes = None, np.diff(cells.ends)
        if columns is not None and (cells.kind == B).any():
            _need(sizes == held[rows])
            oids = types[np.repeat(first[rows] - cells.ends[:-1], sizes) + np.arange(cells.ends[-1])].astype(np.int64)
        parts = _texts(buf, cells, oids, text_of, mapped) if columns is not None else _raw(buf, cells)
        whole = pa.StructArray.from_arrays([p.cast(f.type) for p, f in zip(parts, field.type.value_type)], fields=list(field.type.value_type))
        per_row = np.zeros(n, np.int64)
        per_row[rows] = sizes
        absent = np.ones(n, bool)
        absent[rows] = False
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per_row))), pa.int32()), whole, type=field.type, mask=pa.array(absent))

    old_kind = pa.array([chr(c) if o else None for c, o in zip(second.tolist(), with_old.tolist())], pa.string()) if with_old.any() else pa.nulls(n, pa.string())
    return [old_kind.cast(shape[0].type), column(shape[1]), column(shape[2])]
