"""Batches of whole transactions, and one file per batch, table and schema version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.operators.ordered import at_or_after, placed, settled

#: Transactions of a source in a cell: a power of two.
CELL = 1 << 10
#: Later than any clock, more than any count of events.
NEVER = 1 << 60


def cut_batches(transactions: DataFrame, max_events: int = 1000, max_wait_micros: int | None = None, cell: int = CELL) -> DataFrame:
    """transactions (source_id, commit_lsn, xid, n_events, clock_micros) -> the same with batch_id, from 0 within the source.

    A batch ends at the first commit where it has max_events or more, or where the clock has reached the time of the batch's first events plus the wait; a clock that goes back stands still.
    A source's log is put into cells of ``cell`` transactions, a row each with arrays of sums and clocks, in which lookups are binary searches. Whichever transaction a cell's first batch begins at, only few batches can be open at the
    cell's end (as many as a batch has transactions, at most): these are nodes. Each asks the cell in which its batch ends for the node there that it leads to. The nodes that are met are those that lead from the first beginning on,
    found by pointer doubling over nodes, not over transactions; then each cell knows where its first batch begins and lists the others. No source is one task.
    """
    by, of = ["source_id"], ["source_id", "cell"]
    # sums and places read them several times
    rows = settled(transactions.select("source_id", "commit_lsn", "xid", F.col("n_events").cast("long").alias("n_events"), F.col("clock_micros").alias("clock")), "cuts-rows")
    log = placed(rows, by, ["commit_lsn", "xid"], total=F.col("n_events"), top_clock=F.col("clock")).drop("clock")
    log = settled(log.withColumn("cell", F.floor((F.col("place") - 1) / cell)), "cuts-log")
    cells = settled(_cells(log, of, min(max(max_events, 1), NEVER), max_wait_micros, cell), "cuts-cells")
    ends = cells.select(*of, F.element_at("totals", -1).alias("total"), F.element_at("clocks", -1).alias("due"))

    nodes = settled(cells.select(*of, F.explode("open").alias("open")).select(*of, "open.*"), "cuts-nodes")
    asked = at_or_after(nodes.where("fresh IS NULL").drop("cell"), ends, by, "total", "cell", "cell")
    if max_wait_micros is not None:
        asked = at_or_after(settled(asked.withColumnRenamed("cell", "full"), "cuts-asked"), ends, by, "due", "cell", "late").withColumn("cell", F.least("full", "late"))
    # where nothing has happened yet, a batch is as if it began in the next cell; and a source's first batch begins in its first
    others = nodes.where("fresh IS NOT NULL").withColumn("cell", F.col("cell") + 1).unionByName(ends.where("cell = 0").selectExpr(*of, "1L AS node", "1 AS fresh", "0L AS total", "0L AS due"))
    questions = asked.where(F.col("cell").isNotNull()).select(*others.columns).unionByName(others)
    lots = questions.groupBy(*of, F.floor(F.col("node") / (32 * cell)).alias("lot")).agg(F.collect_list(F.struct("node", "fresh", "total", "due")).alias("asking"))
    leads = cells.join(lots, of).select(*of, F.explode(F.transform("asking", lambda q: _answer(q, cell))).alias("a")).select(*of, "a.*")
    leads = settled(leads, "cuts-leads")

    met = _reached(leads, ends.where("cell = 0").selectExpr("source_id", "1L AS place"))
    earlier = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a row a cell
    entered = leads.join(met, ["source_id", "place"]).select(*of, "entry", "fresh", "begun")
    numbered = cells.select(*of, "nexts", "most").join(entered, of, "left").withColumn("base", F.coalesce(F.sum("begun").over(earlier), F.lit(0)))
    marks = numbered.select(*of, F.explode(_marks(cell)).alias("m")).select(*of, "m.*", F.lit(None).cast(log.schema["xid"].dataType).alias("xid"))
    upto = Window.partitionBy(*of).orderBy("place", F.col("batch_id").isNull(), "batch_id").rowsBetween(Window.unboundedPreceding, 0)
    both = log.select(*of, "place", "xid", "commit_lsn", "n_events", F.lit(True).alias("row"), F.lit(None).cast("long").alias("batch_id")).unionByName(marks, allowMissingColumns=True)
    return both.withColumn("batch_id", F.last("batch_id", True).over(upto)).where("row").select("source_id", "commit_lsn", "xid", "n_events", "batch_id")


def _below(values: Column, x: Column, cell: int) -> Column:
    """How many numbers of a sorted array of up to ``cell`` are less than x."""
    steps = F.array(*[F.lit(cell >> i) for i in range(cell.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda k, s: F.when((k + s <= F.size(values)) & (F.get(values, k + s - 1) < x), k + s).otherwise(k))


def _with(value: Column, f) -> Column:
    """f of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _cells(log: DataFrame, of: list[str], most: int, wait: int | None, cell: int) -> DataFrame:
    """A row a cell: totals and clocks in order (both rise, so sorting puts them in the order of places), the total before; nexts: of a batch that begins at each row (from 0) where the next one does, which is
    the number of rows where it ends with the cell and one more where it is open at the cell's end; most: the batches of the longest chain, the first row's; and the cell's nodes."""
    clock = F.coalesce("top_clock", F.lit(-NEVER))
    rows = log.groupBy(*of).agg(F.sort_array(F.collect_list("total")).alias("totals"), F.sort_array(F.collect_list(clock)).alias("clocks"), F.min(F.col("total") - F.col("n_events")).alias("prior"), F.count("*").cast("int").alias("n"))
    totals, clocks, n = F.col("totals"), F.col("clocks"), F.col("n")
    before = lambda k: F.when(k == 0, F.col("prior")).otherwise(F.get(totals, k - 1))
    # the first transaction with events, whose time counts
    met = lambda k: _below(totals, before(k) + 1, cell)
    began = lambda at: F.get(clocks, at)
    due_of = lambda at: F.when(began(at) > -NEVER, began(at) + min(wait, NEVER >> 1)).otherwise(F.lit(NEVER))  # noqa: E731  none, where no time is known

    def following(k: Column) -> Column:
        full = _with(before(k) + most, lambda x: _below(totals, x, cell))
        if wait is None:
            return full + 1
        return F.least(full, _with(met(k), lambda at: F.greatest(at, _with(due_of(at), lambda x: _below(clocks, x, cell))))) + 1

    node = lambda k, fresh, total, due: F.struct((2 * (F.col("cell") * cell + 1 + k) + (k == n).cast("long")).alias("node"), fresh.cast("int").alias("fresh"), total.alias("total"), due.alias("due"))
    silent = lambda k: before(k) == F.element_at(totals, -1)
    due = lambda k: F.lit(NEVER) if wait is None else due_of(met(k))
    rows = rows.withColumn("nexts", F.transform(F.sequence(F.lit(0), n - 1), following))
    going_on = F.filter(F.sequence(F.lit(0), n - 1), lambda k: F.get("nexts", k) > n)
    ended = node(n, F.lit(1), F.lit(0).cast("long"), F.lit(0).cast("long"))
    opened = F.transform(going_on, lambda k: node(k, F.when(silent(k), 0), before(k) + most, due(k)))
    longest = F.aggregate(F.sequence(F.lit(1), n), F.struct(F.lit(0).alias("k"), F.lit(0).alias("begun")), _step(lambda a: F.struct(F.get("nexts", a["k"]).alias("k"), (a["begun"] + 1).alias("begun"))), lambda a: a["begun"])
    return rows.select(*of, "totals", "clocks", "n", "nexts", longest.alias("most"), F.array_append(opened, ended).alias("open"))


def _step(f):
    """A step of a walk from beginning to beginning, up to the end of the cell."""
    return lambda a, _: F.when(a["k"] < F.col("n"), f(a)).otherwise(a)


def _answer(q: Column, cell: int) -> Column:
    """For an open batch that ends in this cell (fresh: in the row before it): the node that it leads to, the row where the first batch begins, and how many do."""
    n = F.col("n")
    # fresh: 1 where a batch begins with the cell, 0 where one that has no events yet goes on, as if it began here; a sum of events or a time otherwise
    entry = F.when(q["fresh"].isNotNull(), F.lit(0)).otherwise(F.least(_below(F.col("totals"), q["total"], cell), _below(F.col("clocks"), q["due"], cell)) + 1)
    first = lambda at: F.struct(at.alias("k"), n.alias("last"), F.lit(0).alias("begun"))
    on = _step(lambda a: F.struct(F.get("nexts", a["k"]).alias("k"), a["k"].alias("last"), (a["begun"] + 1).alias("begun")))
    found = lambda at: F.aggregate(F.sequence(F.lit(1), F.col("most")), first(at), on)
    last = lambda a: F.when(a["k"] == n, n).otherwise(a["last"])

    def shown(at: Column) -> Column:
        return _with(found(at), lambda a: F.struct(
            q["node"].alias("place"), (2 * (F.col("cell") * cell + 1 + last(a)) + (last(a) == n).cast("long")).alias("next"), at.alias("entry"), q["fresh"].alias("fresh"),
            (a["begun"] - F.when(q["fresh"] == 0, 1).otherwise(0)).alias("begun"),
        ))

    return _with(entry, shown)


def _marks(cell: int) -> Column:
    """What batches a cell's rows are in: the one before, from its first place on, and each that begins, from its own; places (entry: the first beginning's row, null where there is none) with batch_id."""
    size = F.size("nexts")
    grown = lambda a, _: F.when(F.get("nexts", F.element_at(a, -1)) < size, F.array_append(a, F.get("nexts", F.element_at(a, -1)))).otherwise(a)
    begins = F.when(F.col("entry") < size, F.aggregate(F.sequence(F.lit(1), F.col("most")), F.array("entry"), grown)).otherwise(F.array().cast("array<int>"))
    going_on = (F.col("fresh") == 0).cast("int")  # its first row is no beginning, but in the batch before
    own = F.transform(F.when(going_on == 1, F.slice(begins, 2, size)).otherwise(begins), lambda k, i: F.struct((F.col("cell") * cell + 1 + k).alias("place"), (F.col("base") + i).alias("batch_id")))
    return F.concat(F.array(F.struct((F.col("cell") * cell + 1).alias("place"), (F.col("base") - 1).alias("batch_id"))), F.coalesce(own, F.array().cast("array<struct<place:bigint,batch_id:bigint>>")))


def _reached(leads: DataFrame, begins: DataFrame) -> DataFrame:
    """begins (source_id, place) and all that leads (source_id, place, next) lead to from there.

    Pointer doubling, twice a round: each round's steps are four times as long as the last one's, so the rounds are log4 of the longest way, and from the first all others are reached by up to three steps of each length.
    """
    leads = leads.select("source_id", "place", "next")
    rounds = []
    while not leads.isEmpty():
        # one, two, three and four steps on; where there is none, a key that meets nothing, and not all the same one
        hops = leads.withColumnRenamed("next", "n1")
        for k in (1, 2, 3):
            step = leads.select("source_id", F.col("place").alias("_at"), F.col("next").alias(f"n{k + 1}"))
            hops = hops.withColumn("_at", F.coalesce(f"n{k}", -F.col("place"))).join(step, ["source_id", "_at"], "left").drop("_at")
        rounds.append(settled(hops, "cuts-hops"))
        leads = rounds[-1].where("n4 IS NOT NULL").select("source_id", "place", F.col("n4").alias("next"))
    for hops in reversed(rounds):  # the longest steps first, while there are few to take them
        begins = begins.join(hops, ["source_id", "place"], "left").select("source_id", F.explode(F.array_compact(F.array("place", "n1", "n2", "n3"))).alias("place"))
    return begins


def batch_totals(cut: DataFrame) -> DataFrame:
    """Per batch: transactions, events, the position that a reader may confirm after it, the last xid."""
    return cut.groupBy("source_id", "batch_id").agg(
        F.count("*").alias("n_transactions"), F.sum("n_events").alias("n_events"), F.max("commit_lsn").alias("end_lsn"), F.max_by("xid", F.struct("commit_lsn", "xid")).alias("last_xid")
    )


def schema_islands(relations: DataFrame, value: Column, name: str = "schema_version") -> DataFrame:
    """relations (source_id, relation_id, seq) with a number that rises whenever the definition differs from the one before in its source: A B A are three, an equal one sent again is the same."""
    by = Window.partitionBy("source_id", "relation_id").orderBy("seq")
    valued = relations.withColumn("_v", value)
    changed = F.when(F.lag("_v").over(by).isNull() | ~F.col("_v").eqNullSafe(F.lag("_v").over(by)), 1).otherwise(0)
    return valued.withColumn("_c", changed).withColumn(name, F.sum("_c").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_v", "_c")


def manifest(changes: DataFrame, definitions: DataFrame | None = None, sources: bool = False) -> DataFrame:
    """changes (batch_id, schema, table, schema_version, replay_pos, lsn, xid) -> one row per file.

    A file is closed when a newer version of its table arrives: with the newer definition (definitions: batch_id, schema, table, schema_version, replay_pos), whether a row follows it or not, or, where none is given,
    with the first row of another version. Closed files come first, by when they were closed; then those open at the end, by their first row. With ``sources`` tables of one name are apart by source_id.
    """
    of = ["batch_id", *(["source_id"] if sources else []), "schema", "table"]
    files = changes.groupBy(*of, "schema_version").agg(
        F.count("*").alias("event_count"), F.max_by(F.struct("lsn", "xid"), "replay_pos").alias("last"), F.min("replay_pos").alias("first_pos")
    )
    opened = files.withColumn("_opened", F.col("first_pos"))
    if definitions is not None:
        made = definitions.groupBy(*of, "schema_version").agg(F.min("replay_pos").alias("_defined"))
        opened = files.join(made, [*of, "schema_version"], "full").withColumn("_opened", F.least("first_pos", "_defined"))
    of_table = Window.partitionBy(*of).orderBy("_opened")  # a row per version
    ordered = opened.withColumn("_closed", F.lead("_opened").over(of_table)).where(F.col("event_count").isNotNull())
    place = Window.partitionBy("batch_id").orderBy(F.col("_closed").isNull(), F.coalesce("_closed", "first_pos"))
    return ordered.select(
        "batch_id", (F.row_number().over(place) - 1).alias("file_ord"), *of[1:], "schema_version", "event_count", F.col("event_count").alias("record_count"), F.col("last.lsn").alias("lsn"), F.col("last.xid").alias("xid")
    )
