"""Start-up against a server that is played."""

import pytest

from changeloom.sources import control as C


class Server:
    def __init__(self, slot=None, **answers):
        self.slot, self.log = slot, []
        self.answers = {"server_version_num": 140005, "wal_level": "logical", "rolreplication": True, "pg_publication": [(1,)], "pg_wal_lsn_diff": 0} | answers

    def query(self, sql):
        self.log.append(sql)
        if "pg_wal_lsn_diff" in sql:
            return [(self.answers["pg_wal_lsn_diff"],)]
        if "pg_replication_slots" in sql:
            return [self.slot] if self.slot else []
        for k, v in self.answers.items():
            if k in sql:
                return v if isinstance(v, list) else [(v,)]
        raise AssertionError(sql)

    def execute(self, sql):
        self.log.append(sql)
        if "drop" in sql:
            self.slot = None
            return None
        self.slot = ("s", "pgoutput", "db", False, 0)
        return ("s", "1/20", "snap-1", "pgoutput")


def options(**kw):
    return C.Options(host="h", database="db", user="u", publication="p", slot="s", **kw)


def prepared(server, opts, state=None):
    saved = []
    return C.prepare(server, opts, state or {}, saved.append), saved


def test_options():
    assert options().problems() == [] and options().stream_options() == {"proto_version": "1", "publication_names": '"p"'}
    assert options(streaming=True, binary=True).stream_options()["proto_version"] == "2"
    assert len(options(ssl_mode="verify-full", toast_strategy="x", table_pattern="(", max_events=0).problems()) == 4
    assert C.Options("h", "d", "u", "p", "Bad-Name").problems()
    assert options().properties("replication")["replication"] == "database" and options().properties("snapshot")["binaryTransfer"] == "false"
    assert options(batch_strategy="one_transaction").events_per_batch == 1 and options(batch_strategy="one_transaction").wait_micros is None


@pytest.mark.parametrize("answers", [{"server_version_num": 130000}, {"wal_level": "replica"}, {"rolreplication": False}, {"pg_publication": []}])
def test_servers_that_do_not_fit(answers):
    C.check_server(Server(), "p")
    with pytest.raises(ValueError):
        C.check_server(Server(**answers), "p")


@pytest.mark.parametrize("slot", [("s", "test_decoding", "db", False, 0), ("s", "pgoutput", "other", False, 0), ("s", "pgoutput", "db", True, 0)])
def test_slots_that_do_not_fit(slot):
    with pytest.raises(ValueError):
        prepared(Server(slot), options())


def test_start_from_what_is_known():
    s = Server(("s", "pgoutput", "db", False, 50))
    assert prepared(s, options(), {"lsn": 80})[0].lsn == 80 and prepared(s, options())[0].lsn == 50
    with pytest.raises(ValueError, match="no slot"):
        prepared(Server(), options(create_slot=False))


def test_new_slot_forgets_old_state():
    start, saved = prepared(Server(), options(), {"lsn": 10**15})
    assert start.lsn == (1 << 32) + 0x20 and start.snapshot is None and saved[-1] == {}


def test_snapshot_phase():
    start, saved = prepared(Server(), options(initial_snapshot=True))
    assert start.snapshot == "snap-1" and saved[0] == {"snapshot_pending": True}  # before the slot is there
    assert C.snapshot_done(start, saved.append) == {"lsn": start.lsn} == saved[-1]


def test_interrupted_snapshot():
    s = Server(("s", "pgoutput", "db", False, 50))
    start, _ = prepared(s, options(initial_snapshot=True), {"snapshot_pending": True})
    assert start.snapshot == "snap-1" and any("drop" in x for x in s.log)
    start, saved = prepared(Server(("s", "pgoutput", "db", False, 50)), options(), {"snapshot_pending": True})
    assert start.snapshot is None and saved == [{}] and start.lsn == 50


def test_throttle_and_retention():
    now = [0.0]
    t = C.Throttle(60, lambda: now[0])
    assert [t.failure(), t.failure()] == ["error", "debug"]
    now[0] = 61
    assert t.failure() == "warn"
    t.success()
    assert t.failure() == "error"
    w = C.Throttle(60, lambda: now[0])
    s = Server(("s", "pgoutput", "db", False, 0), pg_wal_lsn_diff=5 << 20)
    assert "5 MB" in C.retention_warning(s, options(wal_warn_bytes=1 << 20), w) and C.retention_warning(s, options(wal_warn_bytes=1 << 20), w) is None
    assert C.retention_warning(s, options(), w) is None
