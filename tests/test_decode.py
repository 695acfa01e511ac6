"""The codec, message by message, and what it refuses."""

import struct
from decimal import Decimal

import pytest
from wire import STOP, abort, begin, commit, delete, insert, relation, row, start, stream_commit, truncate, update

from changeloom.functions import values as V
from changeloom.operators.decode import ProtocolError, binary_numeric, binary_text, decode, decode_message, decode_rows


def test_begin_and_commit():
    assert decode_message(begin(7, 5, -3), False) == {"kind": "B", "in_stream": False, "final_lsn": 5, "commit_micros": -3, "xid": 7}
    assert decode_message(commit(5, 6, 9), False)["end_lsn"] == 6


def test_unsigned_ids():
    assert decode_message(begin(4294967295), False)["xid"] == 4294967295


def test_relation():
    m = decode_message(relation(9, identity=b"f"), False)
    assert m["relation"]["replica_identity"] == "full" and [c["name"] for c in m["relation"]["columns"]] == ["id", "note"] and m["relation"]["columns"][0]["key"]


def test_rows():
    assert [c["kind"] for c in decode_message(insert(9, "1", None), False)["new"]] == ["t", "n"]
    m = decode_message(update(9, "1", ..., old=["1", "x"]), False)
    assert m["old_kind"] == "O" and m["new"][1]["kind"] == "u" and m["old"][1]["text"] == "x"
    assert "old" not in decode_message(update(9, "1", "y"), False)
    assert decode_message(delete(9, "1", None), False)["old_kind"] == "K"
    assert decode_message(truncate(1, 2, flags=3), False)["truncate"] == {"cascade": True, "restart_identity": True, "relation_ids": [1, 2]}


def test_streamed():
    assert decode_message(insert(9, "1", "x", xid=8), True)["stream_xid"] == 8
    assert decode_message(start(8), False)["first_segment"] is True
    assert decode_message(stream_commit(8), False)["xid"] == 8
    assert decode_message(abort(8, 9), False)["sub_xid"] == 9


@pytest.mark.parametrize("data", [b"", b"Z", begin(1)[:-1], begin(1) + b"\0", b"I" + struct.pack(">I", 1) + b"X" + row("1"), b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 1) + b"q",
                                  relation(1, identity=b"z"), b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 1) + b"t" + struct.pack(">i", -1), b"D" + struct.pack(">I", 1) + b"N" + row("1"), b"O" + struct.pack(">q", 1) + b"abc"])
def test_malformed(data):
    with pytest.raises(ValueError):
        decode_message(data, False)


def numeric(n, weight, sign, scale, *digits):
    return struct.pack(f">hhHh{len(digits)}H", n, weight, sign, scale, *digits)


@pytest.mark.parametrize("raw, value", [(numeric(2, 1, 0, 3, 1, 2345), "12345.000"), (numeric(1, 0, 0x4000, 2, 5), "-5.00"), (numeric(0, 0, 0, 2), "0.00"), (numeric(1, -1, 0, 4, 1234), "0.1234"), (numeric(0, 0, 0xC000, 0), None)])
def test_binary_numeric(raw, value):
    assert binary_numeric(raw) == (None if value is None else Decimal(value))


@pytest.mark.parametrize("digits", [28, 29, 38, 40, 1000, 5000])
def test_numerics_of_many_digits(digits):
    """Whole, with a point in the middle, and far behind it; digits above 9999 are refused."""
    groups = [(7919 * i + 1234) % 10000 for i in range(digits // 4)]
    text = "".join(f"{g:04d}" for g in groups)
    n = len(groups)
    assert format(binary_numeric(numeric(n, n - 1, 0, 0, *groups)), "f") == text.lstrip("0")
    assert format(binary_numeric(numeric(n, n // 2 - 1, 0x4000, 4 * (n - n // 2), *groups)), "f") == "-" + text[: n // 2 * 4].lstrip("0") + "." + text[n // 2 * 4 :]
    assert format(binary_numeric(numeric(n, -3, 0, 4 * n + 8, *groups)), "f") == "0." + "0" * 8 + text
    with pytest.raises(ProtocolError, match="above 9999"):
        binary_numeric(numeric(n, 0, 0, 0, *groups[:-1], 10000))


def test_a_bad_digit_names_its_message(spark):
    defined = decode(spark.createDataFrame([("s", 1, 1, relation(9, columns=(("id", 1, 1700, -1),)))], "source_id string, seq long, recv_lsn long, data binary")).select("relation")
    rows = spark.createDataFrame([("slot1", 77, 1, insert(9, numeric(1, 0, 0, 0, 10000)))], "source_id string, seq long, recv_lsn long, data binary").crossJoin(defined)
    with pytest.raises(Exception, match="slot1, message 77: a numeric has a digit"):
        decode_rows(rows).collect()


def test_binary_values():
    assert binary_text(b"\1", V.BOOL) == "t" and binary_text(struct.pack(">h", -32768), V.INT2) == "-32768"
    assert binary_text(struct.pack(">d", float("inf")), V.FLOAT8) is None
    assert binary_text(struct.pack(">i", -1), V.DATE) == "1999-12-31" and binary_text(struct.pack(">i", 2**31 - 1), V.DATE) is None
    assert binary_text(struct.pack(">q", 86400000000), V.TIME) is None
    assert binary_text(struct.pack(">q", -1), V.TIMESTAMP) == "1999-12-31 23:59:59.999999"
    assert binary_text(bytes(range(16)), V.UUID) == "00010203-0405-0607-0809-0a0b0c0d0e0f"
    assert binary_text(b"\1{}", V.JSONB) == "{}" and binary_text(b"ab", 1186) == "\\x6162"
    assert binary_text(struct.pack(">f", 0.1), V.FLOAT4) == "0.1" and binary_text(struct.pack(">d", 0.1), V.FLOAT8) == "0.1" and binary_text(struct.pack(">f", float("nan")), V.FLOAT4) is None
    for raw, oid in ((b"\2{}", V.JSONB), (b"12", V.INT4), (numeric(1, 0, 0x1234, 0, 1), V.NUMERIC)):
        with pytest.raises(ProtocolError):
            binary_text(raw, oid)


def test_decode_finds_segments(spark):
    log = [start(8), insert(9, "1", "x", xid=8), STOP, begin(3), insert(9, "2", "y"), commit(), stream_commit(8)]
    raw = spark.createDataFrame([("s", i, i * 16, d) for i, d in enumerate(log, 1)], "source_id string, seq long, recv_lsn long, data binary")
    got = {r.seq: r for r in decode(raw, streaming=True).collect()}
    assert got[2].stream_xid == 8 and got[5].stream_xid is None and got[5].new[1].text == "y" and got[7].xid == 8


def test_only_kinds_that_are_asked_for_are_decoded(spark):
    log = [start(8), insert(9, "1", "x", xid=8), STOP, b"Q", begin(3), insert(9, "2", None), commit()]  # Q is no message
    raw = spark.createDataFrame([("s", i, i * 16, d) for i, d in enumerate(log, 1)], "source_id string, seq long, recv_lsn long, data binary")
    assert [(r.seq, r.stream_xid, [c.text for c in r.new]) for r in decode(raw, streaming=True, kinds="I").orderBy("seq").collect()] == [(2, 8, ["1", "x"]), (6, None, ["2", None])]
    assert decode(raw, kinds="BC").count() == 2


def test_rows_with_their_definition(spark):
    columns = (("id", 1, 23, -1), ("at", 0, 1186, -1), ("f", 0, 700, -1))
    log = [(insert(9, struct.pack(">i", 5), b"\1\2", struct.pack(">f", float("inf")))), update(9, "7", ..., None, old=["6", None, "1.5"]), truncate(9)]
    made = spark.createDataFrame([("s", 1, 1, relation(9, columns=columns))], "source_id string, seq long, recv_lsn long, data binary")
    defined = decode(made).select("relation")
    rows = spark.createDataFrame([("s", i, i, d) for i, d in enumerate(log, 1)], "source_id string, seq long, recv_lsn long, data binary").crossJoin(defined)
    a, b, c = decode_rows(rows).orderBy("seq").collect()
    assert [tuple(x) for x in a.new] == [("t", "5", None), ("t", "\\x0102", b"\1\2"), ("n", None, struct.pack(">f", float("inf")))] and a.old is None
    assert b.old_kind == "O" and [x.text for x in b.old] == ["6", None, "1.5"] and [x.kind for x in b.new] == ["t", "u", "n"] and c.new is None and c.old is None


def test_lenient_where_the_protocol_is(spark):
    assert decode_message(start(8, 2), False)["first_segment"] is True  # any number but 0
    assert decode_message(insert(9, "x")[:-1] + b"\xff", False)["new"][0]["text"] == "\ufffd"


def test_decode_fails_on_bad_bytes(spark):
    raw = spark.createDataFrame([("s", 1, 16, b"Q")], "source_id string, seq long, recv_lsn long, data binary")
    with pytest.raises(Exception, match="unknown kind"):
        decode(raw).collect()


def test_tuples_of_a_batch_at_once(spark, monkeypatch):
    """The same rows as message by message: all kinds of messages and cells, types with and without a mapping, text that isn't UTF-8, tables of many widths."""
    import random

    from changeloom.operators import tuples

    rng, kinds = random.Random(9), {23: lambda: struct.pack(">i", rng.randrange(-9, 9)), 20: lambda: struct.pack(">q", rng.randrange(-(2**60), 2**60)), 21: lambda: struct.pack(">h", -7), 25: lambda: "ü€ text".encode(), 16: lambda: b"\1", 701: lambda: struct.pack(">d", rng.choice([0.5, float("nan")])), 1700: lambda: numeric(1, 0, 0, 2, 7), 1186: lambda: b"\1\2", 17: lambda: b"\xff\0", 1082: lambda: struct.pack(">i", 2**31 - 1)}
    rows, made, whole = [], [], 0
    for table in range(6):
        oids = [rng.choice(list(kinds)) for _ in range(rng.randrange(0, 7))]
        made.append(relation(table, columns=tuple((f"c{i}", 0, o, -1) for i, o in enumerate(oids))))
        value = lambda o: rng.choice([None, ..., "text", "", "é", kinds[o]()])  # noqa: B023, E731
        row_ = lambda: [value(o) for o in oids]  # noqa: B023, E731
        for _ in range(25):
            rows.append((table, rng.choice([lambda: insert(table, *row_()), lambda: update(table, *row_()), lambda: update(table, *row_(), old=row_()), lambda: delete(table, *row_()), lambda: truncate(table, table), lambda: b"s" + insert(table, *row_())[1:]])()))  # noqa: B023
    rows.append((0, rows[0][1]))
    known = {i: r.relation for i, r in enumerate(decode(spark.createDataFrame([("s", i, i, d) for i, d in enumerate(made)], "source_id string, seq long, recv_lsn long, data binary")).orderBy("seq").collect())}
    from changeloom.operators.decode import RELATION

    df = spark.createDataFrame([("s", i, i, d, known[t]) for i, (t, d) in enumerate(rows)], f"source_id string, seq long, recv_lsn long, data binary, relation {RELATION}").coalesce(1)
    shown = lambda: [tuple(r) for r in decode_rows(df).orderBy("seq").collect()]
    fast = shown()
    monkeypatch.setattr(tuples, "rows_of", lambda *_: None)
    assert fast == shown() and len(fast) == len(rows)


def test_unusual_batches_are_left_to_single_messages(spark):
    import pyarrow as pa

    from changeloom.operators import tuples
    from changeloom.operators.decode import MAPPED, arrow_schema

    shape = list(arrow_schema("old_kind string, old array<struct<kind:string,text:string,bin:binary>>, new array<struct<kind:string,text:string,bin:binary>>"))
    columns = pa.array([[{"type_oid": 23}, {"type_oid": 25}]], pa.list_(pa.struct([("type_oid", pa.int64())])))
    run = lambda d: tuples.rows_of(pa.array([d], pa.binary()), columns, shape, binary_text, MAPPED)
    good = insert(9, struct.pack(">i", 5), "x")
    assert [x.to_pylist() for x in run(good)] == [[None], [None], [[{"kind": "t", "text": "5", "bin": None}, {"kind": "t", "text": "x", "bin": None}]]]
    bad = [good[:-1], good + b"\0", b"Q" + good[1:], good[:5] + b"K" + good[6:], insert(9, b"\0", "x"), insert(9, struct.pack(">i", 5)), insert(9, "1", "x")[:-1] + b"\xff", good[:8] + b"q" + good[9:], b"I", update(9, "1", "2", old=["1", "2"])[:-14], b"T" + struct.pack(">IB", 2, 0) + b"\0" * 4, good[:9] + b"\xff" + good[10:]]
    assert [run(d) for d in bad] == [None] * len(bad)


def test_batches_at_once_as_message_by_message():
    """Changes in segments and outside, with each kind of cell, and truncates; definitions that repeat are read once."""
    import random
    from unittest import mock

    import pyarrow as pa

    from changeloom.operators import decode as D
    from changeloom.operators import tuples

    rng, four = random.Random(3), lambda n: n.to_bytes(4, "big")
    cell = lambda: rng.choice([b"n", b"u", b"t" + four(3) + "aé".encode(), b"t" + four(0), b"b" + four(2) + b"\x00\xff"])
    row = lambda: b"\x00\x03" + cell() + cell() + cell()
    bodies = [lambda: b"I" + four(70000) + b"N" + row(), lambda: b"U" + four(7) + b"K" + row() + b"N" + row(), lambda: b"U" + four(7) + b"N" + row(), lambda: b"D" + four(2**31) + b"O" + row(), lambda: b"T" + four(2) + b"\x03" + four(5) + four(2**32 - 1), lambda: b"T" + four(0) + b"\x01"]
    inside = [rng.random() < 0.5 for _ in range(300)]
    data = [(m[:1] + four(99) + m[1:] if i else m) for i in inside for m in [rng.choice(bodies)()]]
    shape = D.arrow_schema(D.MESSAGE)
    got = tuples.messages_of(pa.array(data), pa.array(inside), shape)
    for field in shape:
        expected = D._column([D.decode_message(m, i) for m, i in zip(data, inside)], field)
        assert field.name in ("source_id", "seq", "recv_lsn") or (got[field.name].to_pylist() if field.name in got else [None] * 300) == expected.to_pylist(), field.name
    assert tuples.messages_of(pa.array([data[0][:-1]]), pa.array(inside[:1]), shape) is None or data[0][:1] == b"T"
    assert tuples.messages_of(pa.array([b"C" + b"\x00" * 25]), pa.array([False]), shape) is None

    made = b"R" + four(5) + b"s\0t\0d\x00\x01\x01c\0" + four(20) + four(2**32 - 1)
    batch = pa.record_batch([pa.array(["s"] * 9), pa.array(range(9)), pa.array(range(9)), pa.array([made] * 9), pa.array([False] * 9)], names=["source_id", "seq", "recv_lsn", "data", "in_stream"])
    with mock.patch.object(D, "decode_message", wraps=D.decode_message) as once:
        assert [r["name"] for r in D._once_each(batch, shape)["relation"].to_pylist()] == ["t"] * 9
    assert once.call_count == 1
