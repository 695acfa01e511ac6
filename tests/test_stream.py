"""The source, assembly of transactions, and files written by batches, with a client that plays messages back."""

import json
import os

import pytest
from wire import STOP, abort, begin, commit, delete, insert, relation, start, stream_commit, truncate, update

from changeloom.sources import capture
from changeloom.sources.capture import RAW, Assembler, ReplicationReader
from changeloom.sources.spool import Spools
from changeloom.streaming.apply import BatchWriter, change_events, resolved_changes, typed_rows, warnings_of


class Player:
    """Messages at positions 16, 32, ...; confirmed holds what was stored."""

    def __init__(self, log):
        self.log, self.confirmed = [(16 * i, d) for i, d in enumerate(log, 1)], []

    def messages(self, after):
        return iter([x for x in self.log if x[0] > after])

    def confirm(self, lsn):
        self.confirmed.append(lsn)


def assembled(log, **kw):
    a, out = Assembler(**kw), []
    for i, d in enumerate(log, 1):
        if done := a.add(16 * i, d):
            out.append(done)
    return out


def test_interleaved_streamed_transaction():
    log = [start(8), relation(9, xid=8), insert(9, "1", "a", xid=8), STOP, begin(3), insert(9, "2", "b"), commit(end=100), start(8, 0), insert(9, "3", "c", xid=8), STOP, stream_commit(8, end=200)]
    done = assembled(log, streaming=True)
    assert [end for _, end in done] == [100, 200] and [d[:1] for _, d in done[1][0]] == [b"R", b"I", b"I", b"c"]


def test_aborts():
    log = [start(8), insert(9, "1", "a", xid=8), insert(9, "2", "b", xid=88), STOP, abort(8, 88), start(7), insert(9, "5", "x", xid=7), STOP, abort(7, 7), stream_commit(8)]
    done = assembled(log, streaming=True)
    assert len(done) == 1 and len(done[0][0]) == 2


def test_spool_marks():
    s = Spools()
    s.start(1, True)
    for n, sub in enumerate((1, 2, 3, 2), 1):
        s.append(1, sub, n, b"%d" % n)
    s.abort(1, 2)
    s.append(1, 1, 5, b"5")
    s.append(1, 3, 6, b"6")
    s.abort(1, 3)
    assert [d for _, d in s.commit(1)] == [b"1", b"5"]


def test_first_segment_again_begins_anew():
    s = Spools()
    s.start(1, True)
    s.append(1, 1, 1, b"old")
    s.start(1, True)
    s.append(1, 1, 2, b"new")
    assert [d for _, d in s.commit(1)] == [b"new"]


@pytest.mark.parametrize("log, streaming", [
    ([begin(1), begin(2)], False), ([commit()], False), ([insert(9, "1", "x")], False), ([start(1)], False), ([begin(1), start(1)], True), ([STOP], True), ([start(1, 0)], True),
    ([start(1), begin(2)], True), ([start(1), start(2)], True), ([stream_commit(5)], True), ([begin(1), stream_commit(5)], True),
])
def test_protocol_errors(log, streaming):
    with pytest.raises(ValueError):
        assembled(log, streaming=streaming)


def test_limit():
    with pytest.raises(ValueError, match="max_streamed_bytes"):
        assembled([start(1), insert(9, "1", "x" * 100, xid=1)], streaming=True, limit=50)


def test_reader_gives_whole_transactions():
    capture.CLIENTS["p"] = p = Player([begin(1), relation(9), insert(9, "1", "a"), commit(end=64), begin(2), insert(9, "2", "b"), commit(end=112), begin(3), insert(9, "3", "c")])
    r = ReplicationReader({"client": "p", "max_events": "1"})
    rows, end = r.read(r.initialOffset())
    assert end["lsn"] == 64 and len(list(rows)) == 4
    rows, end2 = r.read(end)
    rows = list(rows)
    assert end2["lsn"] == 112 and [x[1] for x in rows] == [5, 6, 7] and list(r.readBetweenOffsets(end, end2)) == rows
    assert r.read(end2)[1]["lsn"] == 112
    r.commit(end2)
    assert p.confirmed == [112]
    with pytest.raises(ValueError):
        ReplicationReader({"client": "p", "slot": "No!"})
    with pytest.raises(ValueError, match="true or false"):
        ReplicationReader({"client": "p", "initial_snapshot": "yes"})


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now


def live(client, clock=None, **options):
    capture.CLIENTS["live"] = client
    return ReplicationReader({"client": "live"} | {k: str(v) for k, v in options.items()}, *([clock] if clock else []))


def transaction(xid, end, n=1):
    return [begin(xid), *[insert(9, f"{xid}.{i}", "x") for i in range(n)], commit(end=end)]


def test_a_batch_waits_for_changes_or_time():
    clock = Clock()

    class Slow(Player):
        """Nothing comes for a second after each transaction."""

        def messages(self, after):
            for lsn, d in super().messages(after):
                yield lsn, d
                if d[:1] == b"C":
                    clock.now += 1
                    yield None

        def keep_alive(self, lsn):
            told.append((clock.now, lsn))

    told = []
    log = [m for x in range(1, 31) for m in transaction(x, x * 48)]
    sizes = lambda **options: [len([r for r in rows if r[3][:1] == b"I"]) for rows in batches(live(Slow(log), clock, **options))]

    def batches(r):
        at, out = {"lsn": 0, "seq": 0}, []
        for _ in range(70):
            rows, at = r.read(at)
            out += [x] if (x := list(rows)) else []  # without an answer a batch may be empty
        return out

    assert sizes(max_events=7, max_wait=1000) == [7, 7, 7, 7, 2]
    assert sizes(max_events=1000, max_wait=4) == [4] * 7 + [2]
    assert sizes(batch_strategy="one_transaction") == [1] * 30
    assert len(told) >= 8 and all(b - a >= capture.ALIVE for (a, _), (b, _) in zip(told, told[1:]) if b > a)


def test_an_open_transaction_is_spooled_once(tmp_path):
    """Between batches the reader goes on where it is; nothing of what it holds is asked for again."""
    asked = []

    class Counting(Player):
        def messages(self, after):
            """Asked again, a server sends all of the transactions that end later: here the streamed one."""
            asked.append(after)
            return iter([x for x in self.log if after == 0 or x[0] in whole])

    segments = [x for k in range(3) for x in (start(8, k == 0), *[insert(9, f"{k}.{i}", "x", xid=8) for i in range(50)], STOP, *transaction(20 + k, 1000 * (k + 1)))]
    parts = [*segments, stream_commit(8, end=9000)]
    inside, whole = False, {16 * len(parts)}
    for i, d in enumerate(parts, 1):
        inside = inside or d[:1] == b"S"
        whole |= {16 * i} if inside else set()
        inside = inside and d != STOP
    r = live(Counting(parts), streaming="true", spool_dir=tmp_path, max_events=1)
    at, seen = {"lsn": 0, "seq": 0}, []
    for _ in range(4):
        before = at
        rows, at = r.read(at)
        seen.append((before, at, rows := list(rows)))
    assert [len(rows) for *_, rows in seen] == [3, 3, 3, 151] and at["lsn"] == 9000 and asked == [0]
    assert list(r.readBetweenOffsets(*seen[3][:2])) == seen[3][2] and asked == [0, 3000]
    with pytest.raises(ValueError, match="spool_dir"):
        live(Player([]), streaming="true")


def test_large_streamed_transactions(spark, tmp_path):
    """One file each: 20,000 rows of a plain transaction, 20,000 of a streamed one of which a subtransaction's go; a rolled back one gives none."""
    n = 20_000
    streamed = [x for k in range(4) for x in (start(8, k == 0), *([relation(9, xid=8)] if k == 0 else []), *[insert(9, str(k * n + i), "x", xid=8 if i < n // 4 - 100 else 80 + k) for i in range(n // 4)], STOP)]
    gone = [start(7), *[insert(9, str(i), "y", xid=7) for i in range(1000)], STOP, abort(7, 7)]
    log = [begin(3), relation(9), *[insert(9, str(i), "z") for i in range(n)], commit(end=100), *gone, *streamed, abort(8, 83), stream_commit(8, end=200)]
    r = live(Player(log), streaming="true", spool_dir=tmp_path, batch_strategy="one_transaction")
    at = {"lsn": 0, "seq": 0}
    writer = BatchWriter(str(tmp_path / "out"))
    for batch in range(2):
        rows, at = r.read(at)
        writer(spark.createDataFrame(list(rows), RAW), batch)
    m = spark.read.parquet(str(tmp_path / "out/manifest")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.xid, r.event_count) for r in m] == [(0, 3, n), (1, 8, n - 100)] and list(r.read(at)[0]) == []


class Database(Player):
    """A server with a slot, a publication of three tables, their rows, and what happens after the snapshot."""

    def __init__(self, log, slot=None):
        super().__init__(log)
        self.slot, self.log_of_sql, self.exported = slot, [], 0
        self.tables = {"customers": [("1", "Ada"), ("2", None), ("3", "Cy")], "orders": [], "toasts": [("9", "x")]}

    def query(self, sql):
        self.log_of_sql.append(sql)
        if "pg_wal_lsn_diff" in sql:
            return [(0,)]
        if "pg_replication_slots" in sql:
            return [self.slot] if self.slot else []
        if "pg_publication_tables" in sql:
            return [(100 + i, "lab", t, "d", "id < 10" if t == "toasts" else None, c, oid, -1, c == "id") for i, t in enumerate(self.tables) for c, oid in (("id", 23), ("name", 25))]
        return {"SHOW server_version_num": [(160000,)], "SHOW wal_level": [("logical",)]}.get(sql, [(True,)])

    def execute(self, sql):
        self.log_of_sql.append(sql)
        if "drop" in sql:
            self.slot = None
            return None
        self.slot, self.exported = ("s", "pgoutput", "db", False, 0x2000), self.exported + 1
        return ("s", "0/2000", f"snap-{self.exported}", "pgoutput")

    def rows(self, query, snapshot, fetch_size):
        self.log_of_sql.append(f"{snapshot}: {query}")
        return iter(self.tables[query.split('"."')[1].split('"')[0]])

    def messages(self, after):
        return iter([(0x2000 + lsn, d) for lsn, d in self.log if 0x2000 + lsn > after])


WANTED = {"database": "db", "publication": "p", "slot": "s", "initial_snapshot": "true", "max_events": 2}


def all_batches(r, at, n):
    out = []
    for _ in range(n):
        rows, at = r.read(at)
        out.append((list(rows), at))
        r.commit(at)
    return out


def test_initial_snapshot_then_the_stream(spark, tmp_path):
    db = Database([begin(5), relation(100, "customers", (("id", 1, 23, -1), ("name", 0, 25, -1))), insert(100, "4", "Di"), commit(end=0x3000)])
    r = live(db, state=tmp_path / "state", **WANTED)
    first = r.initialOffset()
    assert first["snapshot"] == "snap-1" and json.loads((tmp_path / "state").read_text()) == {"snapshot_pending": True}
    found = all_batches(r, first, 4)
    assert [[m[3][:1] for m in rows] for rows, _ in found] == [[b"B", b"R", b"s", b"s", b"C"], [b"B", b"R", b"s", b"C"], [b"B", b"R", b"s", b"C"], [b"B", b"R", b"I", b"C"]]
    assert found[1][1] == {"lsn": 0x2000, "seq": 9, "snapshot": "snap-1", "table": 1, "row": 3} and found[2][1] == {"lsn": 0x2000, "seq": 13}  # counters; empty tables are passed over
    assert json.loads((tmp_path / "state").read_text()) == {"lsn": 0x2000} and db.confirmed == [0x2000, 0x3000]
    assert any(x == 'snap-1: SELECT "id"::text, "name"::text FROM "lab"."toasts" WHERE id < 10' for x in db.log_of_sql)
    writer = BatchWriter(str(tmp_path / "out"))
    for batch, (rows, _) in enumerate(found):
        writer(spark.createDataFrame(rows, RAW), batch)
    m = spark.read.parquet(str(tmp_path / "out/manifest")).orderBy("batch_id").collect()
    assert [(x.table, x.event_count, x.lsn if x.batch_id < 3 else None, x.xid) for x in m] == [("customers", 2, "0/2000", 0), ("customers", 1, "0/2000", 0), ("toasts", 1, "0/2000", 0), ("customers", 1, None, 5)]
    lines = [json.loads(x) for f in (tmp_path / "out/batch=0").rglob("*.json") for x in f.read_text().splitlines()]
    assert {(x["operation"], x["after"]["id"], x["after"]["name"], x["before"]) for x in lines} == {("snapshot", "1", "Ada", None), ("snapshot", "2", None, None)} and all(x["commit_timestamp"] for x in lines)


def test_snapshot_of_tables_that_fit():
    db = Database([])
    r = live(db, **WANTED, table_pattern="cust.*")
    rows = [x for rows, _ in all_batches(r, r.initialOffset(), 3) for x in rows]
    assert sum(d[:1] == b"s" for *_, d in rows) == 3 and not any("toasts" in x for x in db.log_of_sql if x.startswith("snap"))


def test_interrupted_snapshot_begins_anew():
    db = Database([])
    r = live(db, **WANTED)
    (_, at), = all_batches(r, r.initialOffset(), 1)
    again = live(db, **WANTED)  # another process: the exported snapshot is gone
    assert list(again.readBetweenOffsets({"snapshot": "snap-1", "lsn": 0x2000, "seq": 0}, at)) == []
    rows, end = again.read(at)
    assert end["snapshot"] == "snap-2" and [m[3][:1] for m in rows] == [b"B", b"R", b"s", b"s", b"C"] and any("drop" in x for x in db.log_of_sql)
    with pytest.raises(ValueError, match="last batch"):
        again.readBetweenOffsets(end, {"lsn": 0x2000, "seq": 20})


def test_no_snapshot_where_the_slot_is_there_and_refusals():
    r = live(Database([], ("s", "pgoutput", "db", False, 0x1500)), **WANTED)
    assert r.initialOffset() == {"lsn": 0x1500, "seq": 0}
    with pytest.raises(ValueError, match="in use"):
        live(Database([], ("s", "pgoutput", "db", True, 0)), **WANTED).initialOffset()
    with pytest.raises(ValueError, match="max_events"):
        live(Database([]), **(WANTED | {"max_events": 0}))


def test_lost_connections_are_tried_again(caplog):
    class Broken(Player):
        down = True

        def messages(self, after):
            if self.down:
                raise ConnectionError("gone")
            return super().messages(after)

    client = Broken(transaction(1, 48))
    r = live(client, max_wait=0)
    at = {"lsn": 0, "seq": 0}
    for _ in range(3):
        rows, same = r.read(at)
        assert list(rows) == [] and same == at
    assert [x.levelname for x in caplog.records if "failed" in x.message] == ["ERROR"]  # the first; then only once a minute
    client.down = False
    assert len(list(r.read(at)[0])) == 3


LOG = [
    begin(1), relation(9, "a", (("id", 1, 23, -1), ("note", 0, 25, -1), ("day", 0, 1082, -1))), relation(10, "b"), insert(9, "1", "x", "2026-01-02"), insert(10, "5", None), update(9, "1", ..., "infinity"), truncate(9, 10), commit(end=200, micros=5),
    begin(2), relation(9, "a", (("id", 1, 23, -1), ("more", 0, 25, -1))), insert(9, "2", "y"), delete(9, "2", None), commit(end=300, micros=6),
]


def raw(spark, log=LOG):
    return spark.createDataFrame([("s", i, 16 * i, d) for i, d in enumerate(log, 1)], RAW)


def test_changes_and_events(spark):
    found = change_events(resolved_changes(raw(spark))).orderBy("seq", "ord").collect()
    assert [r.operation for r in found] == ["insert", "insert", "update", "truncate", "truncate", "insert", "delete"]
    assert [r.table for r in found] == ["a", "b", "a", "a", "b", "a", "a"] and [r.xid for r in found] == [1] * 5 + [2] * 2
    assert [r.schema_version for r in found if r.table == "a"] == [1, 1, 1, 2, 2] and found[2].after["note"] is None and found[6].before == {"id": "2", "more": None} and found[6].after is None
    assert found[0].lsn == "0/40"


def test_toast_and_filters(spark):
    changes = resolved_changes(raw(spark))
    held = {r.seq: r for r in change_events(changes, toast="placeholder", table_pattern="a").collect()}
    assert held[6].after["note"] == "__unchanged_toast_value__" and all(r.table == "a" for r in held.values())
    assert "note" not in {r.seq: r for r in change_events(changes, toast="omit").collect()}[6].after


def test_typed_rows_and_warnings(spark):
    a = change_events(resolved_changes(raw(spark))).where("table = 'a' AND schema_version = 1")
    columns = [{"name": "id", "type_oid": 23, "typmod": -1}, {"name": "note", "type_oid": 25, "typmod": -1}, {"name": "day", "type_oid": 1082, "typmod": -1}]
    rows = typed_rows(a, columns).collect()
    assert rows[0].after.id == 1 and str(rows[0].after.day) == "2026-01-02" and rows[1].after.day is None
    assert [(r.column, r.text, r.reason) for r in warnings_of(a).collect()] == [("lab.a.day", "infinity", "no value")]


def test_streaming_to_files(spark, tmp_path):
    writer = BatchWriter(str(tmp_path / "out"))
    first, second = LOG[:8], LOG[8:9] + LOG[10:]  # the second batch relies on the first one's definition, which has three columns
    second = [begin(2), insert(9, "2", "y", None), commit(end=300)]
    writer(raw(spark, first), 0)
    later = spark.createDataFrame([("s", 100 + i, 16 * i, d) for i, d in enumerate(second, 1)], RAW)
    writer(later, 1)
    writer(later, 1)  # again: the same files, once
    m = spark.read.parquet(str(tmp_path / "out/manifest")).orderBy("batch_id", "file_ord").collect()
    assert [(r.batch_id, r.table, r.event_count) for r in m] == [(0, "a", 3), (0, "b", 2), (1, "a", 1)] and m[0].mime_type == "application/json"
    lines = [json.loads(x) for f in sorted((tmp_path / "out/batch=1/source=s/of=lab.a/v=1").glob("*.json")) for x in f.read_text().splitlines()]
    assert len(lines) == 1 and lines[0]["after"] == {"id": "2", "note": "y", "day": None} and lines[0]["before"] is None


def test_definitions_and_warnings_go_on_from_batch_to_batch(spark, tmp_path):
    """Versions count on over batches, an equal definition sent again is no new one, and a column is warned of once."""
    writer = BatchWriter(str(tmp_path / "out"))
    plain, more = relation(9, "a", (("id", 1, 23, -1), ("day", 0, 1082, -1))), relation(9, "a", (("id", 1, 23, -1), ("day", 0, 1082, -1), ("x", 0, 1186, -1)))
    bad = insert(9, "1", "infinity")
    binary = insert(9, b"\0\0\0\7", b"\x7f\xff\xff\xff", b"\1")
    batches = [[begin(1), plain, bad, commit()], [begin(2), plain, bad, commit()], [begin(3), more, binary, commit()], [begin(4), binary, commit()], [begin(5), plain, bad, commit()]]
    for n, log in enumerate(batches):
        writer(spark.createDataFrame([("s", 100 * n + i, i, d) for i, d in enumerate(log, 1)], RAW), n)
    m = spark.read.parquet(str(tmp_path / "out/manifest")).orderBy("batch_id").collect()
    assert [r.schema_version for r in m] == [1, 1, 2, 2, 3] and [r.xid for r in m] == [1, 2, 3, 4, 5]
    warned = spark.read.json(str(tmp_path / "out/warnings")).orderBy("batch").collect()
    assert [(r.batch, r.column, r.text, r.reason) for r in warned] == [(0, "lab.a.day", "infinity", "no value"), (2, "lab.a.x", "\\x01", "no binary mapping")]
    assert len(list((tmp_path / "out/relations").iterdir())) <= 4  # old states go


@pytest.mark.parametrize("typed", [False, True])
def test_two_sources_with_a_table_of_one_name(spark, tmp_path, typed):
    """Each source's rows have its own columns, in its own folder, and nothing is lost."""
    a = [begin(1), relation(9, "t", (("x", 1, 23, -1), ("y", 0, 25, -1))), insert(9, "1", "one"), insert(9, "2", None), commit(end=64)]
    b = [begin(1), relation(9, "t", (("p", 1, 23, -1),)), insert(9, "9"), commit(end=64)]
    rows = [(source, i, 16 * i, d) for source, log in (("a", a), ("b", b)) for i, d in enumerate(log, 1)]
    BatchWriter(str(tmp_path / "out"), typed=typed)(spark.createDataFrame(rows, RAW), 0)
    m = spark.read.parquet(str(tmp_path / "out/manifest")).orderBy("source_id").collect()
    assert [(r.source_id, r.table, r.event_count, r.schema_version) for r in m] == [("a", "t", 2, 1), ("b", "t", 1, 1)]
    read = lambda source: [json.loads(x)["after"] for f in sorted((tmp_path / f"out/batch=0/source={source}/of=lab.t/v=1").glob("*.json")) for x in f.read_text().splitlines()]
    n = (lambda x: x) if typed else str
    assert read("a") == [{"x": n(1), "y": "one"}, {"x": n(2), "y": None}] and read("b") == [{"p": n(9)}]


def test_many_tables_are_one_job(spark, tmp_path):
    """Files of 60 tables in one job, each in the order of the log; files close when a definition arrives, with no row behind it too."""
    tables = [relation(100 + i, f"t{i}") for i in range(60)]
    log = [begin(1), *tables, *[insert(100 + i % 60, str(i), "x") for i in range(300)], relation(101, "t1", (("id", 1, 23, -1), ("z", 0, 25, -1))), relation(100, "t0", (("id", 1, 23, -1), ("z", 0, 25, -1))), commit()]
    writer, jobs = BatchWriter(str(tmp_path / "out")), []
    keep = writer._write
    writer._write = lambda rows, folder, *by: (jobs.append(by), keep(rows, folder, *by))
    writer(raw(spark, log), 0)
    m = spark.read.parquet(str(tmp_path / "out/manifest")).orderBy("file_ord").collect()
    assert [r.table for r in m] == ["t1", "t0", *[f"t{i}" for i in range(2, 60)]] and {r.event_count for r in m} == {5} and jobs == [("source", "of", "v")]
    for i in (0, 7, 59):
        ids = [json.loads(x)["after"]["id"] for f in sorted((tmp_path / f"out/batch=0/source=s/of=lab.t{i}/v=1").glob("*.json")) for x in f.read_text().splitlines()]
        assert ids == [str(i + 60 * k) for k in range(5)]


def test_a_failed_batch_leaves_nothing_listed(spark, tmp_path):
    """A row that can't be decoded fails a task of the job: no file is listed, and the batch run again is there once."""
    good = [begin(1), relation(9, "t"), *[insert(9, str(i), "x") for i in range(50)], commit()]
    writer = BatchWriter(str(tmp_path / "out"))
    with pytest.raises(Exception, match="s, message 20"):
        writer(raw(spark, [*good[:19], good[19][:-2], *good[20:]]), 0)
    assert not (tmp_path / "out/manifest").exists()
    writer(raw(spark, good), 0)
    writer(raw(spark, good), 0)
    assert [(r.event_count, r.table) for r in spark.read.parquet(str(tmp_path / "out/manifest")).collect()] == [(50, "t")] and spark.read.json(str(tmp_path / "out/batch=0")).count() == 50


def test_a_connection_that_ends_inside_a_transaction():
    """The server sends it again from its beginning; so does one that ends inside a segment."""
    class Ending(Player):
        cut = 5

        def messages(self, after):
            yield from (x for x in self.log[: self.cut] if x[0] > after)

    client = Ending([*transaction(1, 48), *transaction(2, 96)])
    r = live(client, max_events=1)
    rows, at = r.read({"lsn": 0, "seq": 0})
    assert len(list(rows)) == 3 and at["lsn"] == 48
    rows, at = r.read(at)
    assert list(rows) == [] and at["lsn"] == 48
    client.cut = 6
    rows, at = r.read(at)
    assert [x[3][:1] for x in rows] == [b"B", b"I", b"C"] and at["lsn"] == 96
    assert list(r.read(at)[0]) == []


def test_typed_files(spark, tmp_path):
    BatchWriter(str(tmp_path / "out"), "parquet", typed=True)(raw(spark), 0)
    a = spark.read.parquet(str(tmp_path / "out/batch=0/source=s/of=lab.a/v=1"))
    assert dict(a.select("after.*").dtypes) == {"id": "int", "note": "string", "day": "date"} and a.count() == 3
    assert spark.read.parquet(str(tmp_path / "out/batch=0/source=s/of=lab.a/v=2")).count() == 2


def test_capture_files(spark, tmp_path):
    (tmp_path / "x.hex").write_text("\n".join([begin(1).hex(), "", insert(9, "1", "a").hex() + "  ", commit().hex()]) + "\n")
    rows = capture.read_capture(spark, str(tmp_path / "x.hex")).orderBy("seq").collect()
    assert [bytes(r.data)[:1] for r in rows] == [b"B", b"I", b"C"] and [r.recv_lsn for r in rows] == [16, 32, 48]
    assert os.path.basename(rows[0].source_id) == "x.hex"


def test_query_from_stream_to_files(spark, tmp_path):
    log = [begin(1), relation(9), insert(9, "1", "a"), commit(end=64), start(8), insert(9, "2", "b", xid=8), STOP, stream_commit(8, end=128)]
    (tmp_path / "log").write_text("\n".join(d.hex() for d in log))
    spark.dataSource.register(capture.ReplicationSource)
    stream = spark.readStream.format("pg_replication").options(client="wire:FileClient", path=str(tmp_path / "log"), slot="s", streaming="true", spool_dir=str(tmp_path), max_events="1", max_wait="0").load()
    run = stream.writeStream.foreachBatch(BatchWriter(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    m = spark.read.parquet(str(tmp_path / "out/manifest"))
    assert m.groupBy().sum("event_count").first()[0] == 2 and {r.xid for r in m.collect()} <= {1, 8}
