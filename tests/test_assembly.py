"""Slots landed by tasks of their own, and transactions assembled in Spark's state, over several batches and restarts."""

import random
from collections import Counter

import pytest
from wire import STOP, abort, begin, commit, insert, relation, start, stream_commit

from changeloom.operators.decode import ProtocolError
from changeloom.sources.capture import Assembler
from changeloom.sources.landing import LandingReader, LandingSource, Place, safe_positions
from changeloom.streaming.apply import BatchWriter
from changeloom.streaming.assembly import STORE, assembled


@pytest.fixture
def stateful(spark):
    held = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    spark.dataSource.register(LandingSource)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", held)


def put(folder, slot, log):
    with open(folder / slot, "a") as f:
        f.writelines(d.hex() + "\n" for d in log)


def run(spark, folder, sink, **options):
    """All that is there, in batches, then stop."""
    landed = spark.readStream.format("pg_landing").options(client="wire:SlotLogs", path=str(folder), **{k: str(v) for k, v in options.items()}).load()
    query = assembled(landed).writeStream.foreachBatch(sink).option("checkpointLocation", str(folder / "checkpoint")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def plain(log):
    """Whole transactions in the order of their commits."""
    made, out = Assembler(streaming=True), []
    for i, d in enumerate(log, 1):
        if done := made.add(16 * i, d):
            out.append([data for _, data in done[0]])
    return out


def random_log(seed, n=12):
    """Interleaved segments, aborts of subtransactions and transactions, first segments again, plain transactions in between."""
    rng, log, known = random.Random(seed), [], {}
    for step in range(n):
        xid = rng.choice([*known, 100 + step])
        what = rng.random()
        if what < 0.2:
            log += [begin(5000 + step), *[insert(9, f"p{step}.{i}", "x") for i in range(rng.randrange(3))], commit(end=step)]
        elif xid not in known or what < 0.7:
            first = xid not in known or rng.random() < 0.1
            known[xid] = {xid} if first else known[xid]
            subs = [rng.choice([xid, xid * 10, xid * 10 + 1, xid * 10 + 2]) for _ in range(rng.randrange(1, 5))]
            known[xid] |= set(subs)
            log += [start(xid, int(first)), *[insert(9, f"{step}.{i}", "y", xid=s) for i, s in enumerate(subs)], STOP]
        elif what < 0.85:
            sub = rng.choice(sorted(known[xid]))
            log.append(abort(xid, sub))
            if sub == xid:
                del known[xid]
        else:
            log.append(stream_commit(xid, end=step))
            del known[xid]
    return log + [stream_commit(x) for x in known]


def test_places():
    log = [begin(1), insert(9, "1", "a"), commit(), start(8), insert(9, "2", "b", xid=80), STOP, relation(9), stream_commit(8), abort(7, 7)]
    place = Place()
    assert [place.take(d) for d in log] == [(1, None, log[0]), (1, None, log[1]), (1, None, log[2]), (8, None, log[3]), (8, 80, insert(9, "2", "b")), (8, None, STOP), (None, None, log[6]), (8, None, log[7]), (7, 7, log[8])]
    assert list(safe_positions(enumerate(log, 1))) == [3, 6, 7, 8, 9]


@pytest.mark.parametrize("log", [[begin(1), begin(2)], [commit()], [insert(9, "1", "x")], [begin(1), start(1)], [STOP], [start(1), begin(2)], [start(1), start(2)], [begin(1), stream_commit(5)], [b"S\0"]])
def test_places_refuse(log):
    place = Place()
    with pytest.raises(ProtocolError):
        for d in log:
            place.take(d)


def test_ranges(tmp_path):
    """Positions only: batches of limited size, ranges that end where nothing is open, empty slots without a task."""
    put(tmp_path, "a", [x for k in range(10) for x in (begin(k + 1), insert(9, str(k), "x"), commit())])
    reader = LandingReader({"client": "wire:SlotLogs", "path": str(tmp_path), "slots": "a, b", "max_messages": "20", "parts": "3"})
    first = reader.initialOffset()
    end = reader.latestOffset()
    assert first == {"a": 0, "b": 0} and end == {"a": 18, "b": 0} and reader.latestOffset() == {"a": 30, "b": 0}
    parts = reader.partitions(first, end)
    assert [p.slot for p in parts] == ["a"] * 3 and parts[0].start == 0 and parts[-1].end == 18 and all(a.end == b.start and a.end % 3 == 0 for a, b in zip(parts, parts[1:]))
    assert [x[1] for p in parts for x in reader.read(p)] == list(range(1, 19))
    assert LandingReader({"client": "wire:SlotLogs", "path": str(tmp_path), "slots": "a", "max_messages": "2"}).latestOffset() == {"a": 3}  # a transaction that is longer than a batch is one
    with pytest.raises(ValueError):
        LandingReader({"client": "wire:SlotLogs", "slots": " ", "path": "x"})


@pytest.mark.parametrize("parts", [1, 3])
def test_two_slots_over_several_batches(stateful, tmp_path, parts):
    """Two slots are read by tasks of their own; what comes out is what one process would assemble, whatever the batches; the second half comes after a restart."""
    logs = {slot: random_log(seed, 24) for slot, seed in (("a", 1), ("b", 2))}
    got, seen = {"a": [], "b": []}, []

    def sink(df, batch_id):
        rows = sorted(df.collect(), key=lambda r: (r.source_id, r.seq))
        seen.append(batch_id)
        for r in rows:
            got[r.source_id].append(bytes(r.data))

    half = {slot: max(p for p in safe_positions(enumerate(log, 1)) if p <= len(log) // 2) for slot, log in logs.items()}
    for slot, log in logs.items():
        put(tmp_path, slot, log[: half[slot]])
    run(stateful, tmp_path, sink, slots="a,b", max_messages=25, parts=parts)
    for slot, log in logs.items():
        put(tmp_path, slot, log[half[slot] :])
    run(stateful, tmp_path, sink, slots="a,b", max_messages=25, parts=parts)
    for slot, log in logs.items():
        assert got[slot] == [d for t in plain(log) for d in t]
    assert len(set(seen)) >= 3
    notes = (tmp_path / "notes").read_text().split("\n")
    ranges = Counter(x for x in notes if x.startswith("read"))
    assert {x.split()[1] for x in ranges} == {"a", "b"} and all(int(x.split()[3]) - int(x.split()[2]) <= 25 for x in ranges)


def test_from_slots_to_files(stateful, tmp_path):
    log = [begin(1), relation(9), insert(9, "1", "a"), commit(end=64), start(8), insert(9, "2", "b", xid=8), insert(9, "3", "c", xid=80), STOP, begin(2), insert(9, "4", "d"), commit(), abort(8, 80), stream_commit(8, end=128)]
    put(tmp_path, "s", log)
    put(tmp_path, "t", [begin(3), relation(9, columns=(("p", 1, 23, -1),)), insert(9, "9"), commit()])
    run(stateful, tmp_path, BatchWriter(str(tmp_path / "out")), slots="s,t", max_messages=8)
    m = stateful.read.parquet(str(tmp_path / "out/manifest")).groupBy("source_id").sum("event_count").collect()
    assert {tuple(r) for r in m} == {("s", 3), ("t", 1)}
    rows = stateful.read.json(f"{tmp_path}/out/batch=*/source=s/of=lab.t/*/*.json")
    assert {(r.after.id, r.xid) for r in rows.select("after", "xid").collect()} == {("1", 1), ("2", 8), ("4", 2)}


@pytest.mark.parametrize("log, said", [([start(8, 0), insert(9, "1", "x", xid=8), STOP], "first segment"), ([stream_commit(5)], "isn't known"), ([start(1), insert(9, "1", "x" * 2000, xid=1), STOP], "max_streamed_bytes")])
def test_errors_name_their_message(stateful, tmp_path, log, said):
    put(tmp_path, "s", log)
    landed = stateful.readStream.format("pg_landing").options(client="wire:SlotLogs", path=str(tmp_path), slots="s").load()
    query = assembled(landed, 1000).writeStream.foreachBatch(lambda df, n: df.count()).option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    with pytest.raises(Exception, match=said):
        query.processAllAvailable()
    query.stop()


def test_snapshot_by_ranges_of_pages(spark, tmp_path):
    """A table's rows come from several tasks, each in the one exported snapshot, and are those of one scan; what follows reads them as the snapshot's events."""
    from pyspark.sql import functions as F

    from changeloom.sources.snapshot import SnapshotReader, SnapshotSource
    from changeloom.streaming.apply import change_events, resolved_changes

    spark.dataSource.register(SnapshotSource)
    read = lambda **options: spark.read.format("pg_snapshot").options(client="wire:PagedTables", path=str(tmp_path), publication="p", slot="s", snapshot="snap-1", point="8192", **options).load()
    rows = read(pages="2")
    assert rows.rdd.getNumPartitions() == 5
    found = change_events(resolved_changes(rows)).orderBy("seq").collect()
    assert [(r.table, r.operation, r.after["id"], r.after["name"], r.xid, r.lsn_num) for r in found] == [("customers", "snapshot", i, n, 0, 8192) for i, n in (("1", "Ada"), ("2", None), ("3", "Cy"), ("4", "Di"), ("5", "Ed"), ("6", "Flo"))] + [("toasts", "snapshot", "9", "x", 0, 8192)]
    asked = set((tmp_path / "asked").read_text().splitlines())
    assert {x.split()[0] for x in asked} == {"snap-1"} and sum("customers" in x for x in asked) == 3
    assert any(x.endswith("""FROM "lab"."customers" WHERE ctid >= '(2,0)'::tid AND ctid < '(4,0)'::tid""") for x in asked) and any(x.endswith('FROM "lab"."toasts" WHERE (id < 10)') for x in asked)
    whole = lambda df: sorted(bytes(r.data) for r in df.where(F.substring("data", 1, 1) == b"s").collect())
    assert whole(read(pages="1")) == whole(read(pages="1000")) == whole(rows)
    assert {r.seq for r in read(table_pattern="toasts").collect()} == {0, 1, 2, (1 << 48) - 1}
    with pytest.raises(ValueError, match="pages"):
        SnapshotReader({"client": "x", "snapshot": "s", "point": "1", "pages": "0"})


def test_counters_and_warnings_of_a_running_query(stateful, tmp_path, caplog):
    """What was read reaches the listener, added up over batches; more retained log than allowed is warned of once a minute, and a failed query is counted."""
    import time

    from changeloom.sources.control import Options
    from changeloom.streaming.monitor import Monitor, watched

    class Server:
        def query(self, sql):
            return [(50 << 20,)]

    monitor = Monitor(Server(), Options(slot="s", wal_warn_bytes=1 << 20))
    stateful.streams.addListener(monitor)
    log = [x for k in range(6) for x in (begin(k + 1), *([relation(9)] if k == 0 else []), insert(9, str(k), "x"), commit())]
    put(tmp_path, "s", log)

    def play():
        landed = stateful.readStream.format("pg_landing").options(client="wire:SlotLogs", path=str(tmp_path), slots="s", max_messages="10").load()
        query = assembled(watched(landed)).writeStream.foreachBatch(lambda df, n: df.count()).option("checkpointLocation", str(tmp_path / "checkpoint")).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return query

    def arrives(key, value, query):
        for _ in range(100):
            if monitor.counters.get(str(query.id), {}).get(key) == value:
                return True
            time.sleep(0.2)
        return False

    try:
        query = play()
        assert arrives("messages", len(log), query), monitor.counters
        held = monitor.counters[str(query.id)]
        assert (held["changes"], held["commits"], held["definitions"], held["last_lsn"]) == (6, 6, 1, 16 * len(log)) and held["batches"] >= 2 and held["bytes"] == sum(map(len, log))
        assert sum("keeps 50 MB" in r.message for r in caplog.records) == 1
        put(tmp_path, "s", [stream_commit(77)])
        with pytest.raises(Exception, match="isn't known"):
            play()
        assert arrives("failures", 1, query)
    finally:
        stateful.streams.removeListener(monitor)
