"""Operators on cases that the tables don't hold."""

import pytest
from pyspark.sql import functions as F

from changeloom.functions import lsn as L
from changeloom.functions import values as V
from changeloom.operators import events as E
from changeloom.operators.batches import cut_batches, schema_islands
from changeloom.operators.ordered import forward_fill, running_count
from changeloom.operators.transactions import aborted_ranges, committed_only, transaction_context, without_aborted


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_lsn_extremes(spark):
    assert one(spark, L.lsn_format(F.lit(-1).cast("long"))) == "FFFFFFFF/FFFFFFFF"
    assert one(spark, L.lsn_parse(F.lit("FFFFFFFF/FFFFFFFF"))) == 2**64 - 1
    assert one(spark, L.lsn_parse(F.lit("nonsense"))) is None
    assert one(spark, L.unsigned32(F.lit(-1))) == 4294967295


@pytest.mark.parametrize("text, oid, typmod, value", [
    ("t", V.BOOL, -1, True), ("true", V.BOOL, -1, False), ("7", V.INT4, -1, 7), ("Infinity", V.FLOAT8, -1, None), ("NaN", V.NUMERIC, (10 << 16 | 3) + 4, None), ("0.1234567890123456789", V.NUMERIC, -1, "0.1234567890123456789"),
    ("0044-03-15 BC", V.DATE, -1, None), ("23:59:59.999999", V.TIME, -1, "23:59:59.999"), ("24:00:00", V.TIME, -1, None), ("ab   ", V.BPCHAR, -1, "ab   "), ("\\x00ff10", V.BYTEA, -1, bytes([0, 255, 16])), ("a\\\\b\\001", V.BYTEA, -1, b"a\\b\x01"), ("{1,2}", 1007, -1, "{1,2}"),
])
def test_typed(spark, text, oid, typmod, value):
    assert one(spark, V.typed(F.lit(text), oid, typmod)) == value


@pytest.mark.parametrize("text, oid", [("x1", V.INT4), ("\\xzz", V.BYTEA), ("a\\9", V.BYTEA)])
def test_malformed_values_fail(spark, text, oid):
    with pytest.raises(Exception):
        spark.createDataFrame([(text,)], "t string").select(V.typed(F.col("t"), oid)).collect()


def test_one_rule_for_placeholders(spark):
    """Placeholders go where spark_type has text, whichever way the type is known."""
    kinds = [(oid, typmod) for oid in (V.BOOL, V.INT4, V.FLOAT8, V.DATE, V.TIME, V.TIMESTAMP, V.UUID, V.BYTEA, V.TEXT, V.JSONB, 1007) for typmod in (-1,)]
    kinds += [(V.NUMERIC, t) for t in (-1, (12 << 16 | 2) + 4, (5 << 16 | (-2 & 0x7FF)) + 4, (50 << 16 | 2) + 4, (3 << 16 | 9) + 4, (37 << 16 | (-2 & 0x7FF)) + 4)]
    df = spark.createDataFrame(kinds, "oid int, typmod int")
    for unconstrained in ("string", "decimal"):
        got = {(r.oid, r.typmod): r.x for r in df.select("oid", "typmod", V.holds_text(F.col("oid"), F.col("typmod"), unconstrained).alias("x")).collect()}
        assert got == {(o, t): V.spark_type(o, t, unconstrained).simpleString() == "string" for o, t in kinds}


def test_whole_mb(spark):
    assert [one(spark, L.whole_mb(F.lit(n).cast("long"))) for n in (-3 * 4096, -1048576, 1048575, 5 << 20)] == [0, -1, 0, 5]


def test_numeric_types():
    assert V.numeric_type((12 << 16 | 2) + 4).simpleString() == "decimal(12,2)"
    assert V.numeric_type((5 << 16 | (-2 & 0x7FF)) + 4).simpleString() == "decimal(7,0)"
    assert V.numeric_type((50 << 16 | 2) + 4).simpleString() == "string"
    assert V.numeric_type(-1, "decimal").simpleString() == "decimal(38,10)"


def test_forward_fill_across_ranges(spark):
    rows = [("a", i, i if i in (3, 17) else None) for i in range(1, 40)] + [("b", 5, None)]
    got = {(r.s, r.n): r.f for r in forward_fill(spark.createDataFrame(rows, "s string, n long, v long"), ["s"], "n", F.col("v"), "f", width=4).collect()}
    assert got["a", 2] is None and got["a", 16] == 3 and got["a", 39] == 17 and got["b", 5] is None


def test_running_count_across_ranges(spark):
    df = spark.createDataFrame([("a", i) for i in range(20)], "s string, n long")
    assert [r.c for r in running_count(df, ["s"], "n", F.col("n") % 3 == 0, "c", width=4).orderBy("n").collect()] == [i // 3 + 1 for i in range(20)]


def aborts(spark, steps):
    rows = [("s", 1, sub, seq, gone) for seq, (sub, gone) in enumerate(steps, 1)]
    log = spark.createDataFrame(rows, "source_id string, xid long, sub_xid long, seq long, is_abort boolean")
    return sorted(r.seq for r in without_aborted(log.where("NOT is_abort"), aborted_ranges(log)).collect())


def test_subtransactions_that_reappear(spark):
    # 10 top, 11 sub, 12 other; an abort of 11 cuts back to 2, and what 12 began after that is forgotten
    assert aborts(spark, [(10, False), (11, False), (12, False), (11, False), (11, True), (10, False), (12, False), (12, True)]) == [1, 6]


def test_unknown_subtransaction_changes_nothing(spark):
    assert aborts(spark, [(10, False), (99, True), (10, False)]) == [1, 3]


def test_aborts_of_other_sources_and_incarnations(spark):
    rows = [("s1", 8, 1, 10, 1, False), ("s2", 8, 1, 10, 2, False), ("s2", 8, 1, 10, 3, True), ("s1", 8, 2, 10, 4, False), ("s1", 8, 2, 10, 5, True), ("s1", 8, 3, 10, 6, False)]
    log = spark.createDataFrame(rows, "source_id string, xid long, incarnation long, sub_xid long, seq long, is_abort boolean")
    assert sorted(r.seq for r in without_aborted(log.where("NOT is_abort"), aborted_ranges(log)).collect()) == [1, 6]
    of_all = aborted_ranges(log.drop("incarnation"))  # one transaction in s1: its second abort goes back to its first message
    assert {(r.source_id, r.from_seq, r.to_seq) for r in of_all.collect()} == {("s1", 1, 5), ("s2", 2, 3)}


def test_islands(spark):
    rows = [("s", 1, i, v) for i, v in enumerate("AABBA")] + [("t", 1, 2, "C"), ("t", 1, 4, "C")]
    df = spark.createDataFrame(rows, "source_id string, relation_id long, seq long, v string")
    got = schema_islands(df, F.col("v")).orderBy("source_id", "seq").collect()
    assert [r.schema_version for r in got] == [1, 1, 2, 2, 3, 1, 1]


def test_transaction_context_ends_at_commits(spark):
    rows = [("s", 1, "B", 7), ("s", 2, "I", None), ("s", 3, "C", None), ("s", 4, "R", None), ("s", 5, "B", 8), ("s", 6, "I", None), ("t", 3, "I", None)]
    log = spark.createDataFrame(rows, "source_id string, seq long, kind string, xid long")
    got = {(r.source_id, r.seq): r.txn for r in transaction_context(log, F.col("kind") == "B", F.col("xid"), F.col("kind") == "C", width=4).collect()}
    assert got == {("s", 1): 7, ("s", 2): 7, ("s", 3): 7, ("s", 4): None, ("s", 5): 8, ("s", 6): 8, ("t", 3): None}


def test_committed_only(spark):
    rows = [("s", 1, 1, i, k) for i, k in enumerate("IIACIIC")] + [("t", 1, 1, 0, "I"), ("s", 1, 2, 9, "I"), ("t", 1, 1, 20, "C")]
    log = spark.createDataFrame(rows, "source_id string, xid long, incarnation long, seq long, kind string")
    kept = committed_only(log, F.col("kind") == "I", F.col("kind") == "C", F.col("kind") == "A").collect()
    assert {(r.source_id, r.seq, r.commit_seq) for r in kept} == {("s", 4, 6), ("s", 5, 6), ("t", 0, 20)}


def test_cut_starts_anew(spark):
    rows = [("s", i, i, n, i * 10) for i, n in enumerate([0, 2, 1, 0, 5, 1])]
    df = spark.createDataFrame(rows, "source_id string, commit_lsn long, xid long, n_events long, clock_micros long")
    assert [r.batch_id for r in cut_batches(df, 3).orderBy("xid").collect()] == [0, 0, 0, 1, 1, 2]
    assert [r.batch_id for r in cut_batches(df, 100, 20).orderBy("xid").collect()] == [0, 0, 0, 0, 1, 1]


def test_patterns_match_whole_names(spark):
    df = spark.createDataFrame([("lab", "orders"), ("lab", "orders_old"), ("other", "orders")], "schema string, table string")
    assert E.captured(df, "lab", "orders").count() == 1 and E.captured(df, " ", None).count() == 3


def test_missing_definition_fails(spark):
    changes = spark.createDataFrame([("s", 1, 5, "I")], "source_id string, relation_id long, seq long, kind string")
    relations = spark.createDataFrame([("s", 1, 9, "r")], "source_id string, relation_id long, seq long, relation string")
    with pytest.raises(Exception, match="no definition"):
        E.relation_asof(changes, relations).collect()


def test_row_image_checks_lengths(spark):
    df = spark.sql("SELECT array(named_struct('name', 'a')) AS c, array(named_struct('kind', 't', 'text', 'x'), named_struct('kind', 'n', 'text', CAST(NULL AS STRING))) AS v")
    with pytest.raises(Exception, match="differ"):
        df.select(E.row_image(F.col("c"), F.col("v"))).collect()


def plain_cuts(rows, most, wait):
    """One pass in order; rows: source, lsn, xid, events, clock."""
    out, state = [], {}
    for source, lsn, xid, n, clock in sorted(rows):
        number, events, began, now = state.get(source, (0, 0, None, None))
        now = clock if now is None else max(now, clock)
        began = now if n and began is None else began
        events += n
        out.append((source, lsn, xid, n, number))
        if events and (events >= most or (wait is not None and now >= began + wait)):
            number, events, began = number + 1, 0, None
        state[source] = (number, events, began, now)
    return sorted(out)


@pytest.mark.parametrize("seed, most, wait", [(1, 5, None), (2, 1, None), (3, 7, 20), (4, 1000, 3), (5, 4, 0)])
def test_cuts_against_a_pass_in_order(spark, seed, most, wait):
    """Empty transactions, equal positions, clocks that stand still or go back; no Python in the plan."""
    import random

    rng, rows = random.Random(seed), []
    for source in "abc":
        clock = 1000
        for i in range(rng.randrange(1, 120)):
            clock += rng.choice([0, 0, 1, 2, 9, -1])
            rows.append((source, i // 2 * 1000, i, rng.choice([0, 0, 1, 2, 3, 12]), clock))
    df = spark.createDataFrame(rows, "source_id string, commit_lsn long, xid long, n_events long, clock_micros long")
    got = cut_batches(df, most, wait)
    assert sorted(map(tuple, got.collect())) == plain_cuts(rows, most, wait)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed, most, wait", [(1, 5, None), (2, 1, None), (3, 7, 20), (4, 1000, 3), (5, 4, 0), (6, 30, 400)])
@pytest.mark.parametrize("cell", [1, 8])
def test_cuts_over_many_cells(spark, seed, most, wait, cell):
    """Batches longer than cells, cells without events or beginnings."""
    import random

    rng, rows = random.Random(seed), []
    for source in "abc":
        clock, quiet = 1000, False
        for i in range(rng.randrange(1, 120)):
            clock += rng.choice([0, 0, 1, 2, 9, -1])
            quiet = quiet != (rng.random() < 0.1)
            rows.append((source, i // 2 * 1000, i, 0 if quiet else rng.choice([0, 0, 1, 2, 3, 12]), clock))
    df = spark.createDataFrame(rows, "source_id string, commit_lsn long, xid long, n_events long, clock_micros long")
    got = cut_batches(df, most, wait, cell)
    assert sorted(map(tuple, got.collect())) == plain_cuts(rows, most, wait)


def test_cuts_write_few_rows(spark):
    """Pointer doubling goes over the cells' open batches, not over transactions: what is written grows with the log, not with the log times its rounds."""
    import pathlib

    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "changeloom"
    there = set(folder.glob("*"))
    n = 20000
    df = spark.range(n).selectExpr("'s' AS source_id", "id * 64 AS commit_lsn", "id AS xid", "1L AS n_events", "id AS clock_micros")
    assert cut_batches(df, 10).agg(F.max("batch_id")).first()[0] == n // 10 - 1
    assert sum(spark.read.parquet(str(p)).count() for p in set(folder.glob("*")) - there) < 3 * n



@pytest.mark.parametrize("bins", [1, 3, 1000])
def test_definitions_by_stretches(spark, bins):
    """As the as-of join, for definitions that repeat, change and change back, and tables without one; changes aren't sorted."""
    import random

    from pyspark.errors import PySparkException

    rng = random.Random(bins)
    made = spark.createDataFrame([(s, t, i * 3, (rng.choice("AAAB"),)) for s in "ab" for t in (1, 2) for i in range(40)], "source_id string, relation_id long, seq long, relation struct<v:string>")
    changes = spark.createDataFrame([(s, rng.choice([1, 2, 3]), i + 0, f"p{i}") for s in "abc" for i in range(150)], "source_id string, relation_id long, seq long, payload string")
    shown = lambda df: sorted((r.source_id, r.relation_id, r.seq, r.payload, r.relation.v) for r in df.collect())
    got = E.relation_valid(changes, made, strict=False, bins=bins)
    assert shown(got) == shown(E.relation_asof(changes, made, strict=False)) != []
    with pytest.raises(PySparkException, match="no definition of table"):
        E.relation_valid(changes, made, bins=bins).collect()
    assert E.relation_valid(changes.limit(0), made).count() == 0


@pytest.mark.parametrize("width", [1, 7, 1 << 20])
def test_aborted_stretches_of_one_large_transaction(spark, width):
    changes = spark.createDataFrame([("s", 1, i) for i in range(100)] + [("s", 2, i) for i in range(100)] + [("t", 1, 5)], "source_id string, xid long, seq long")
    ranges = spark.createDataFrame([("s", 1, 10, 19), ("s", 1, 15, 40), ("s", 1, 90, 200), ("s", 2, 3, 3)], "source_id string, xid long, from_seq long, to_seq long")
    got = without_aborted(changes, ranges, width)
    assert got.columns == ["source_id", "xid", "seq"]
    assert sorted(map(tuple, got.collect())) == sorted([("s", 1, i) for i in range(100) if not (10 <= i <= 40 or i >= 90)] + [("s", 2, i) for i in range(100) if i != 3] + [("t", 1, 5)])
