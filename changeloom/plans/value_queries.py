"""Queries over values, positions as text, snapshots and catalogs, and round trips through the wire format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions import lsn as L
from changeloom.functions import values as V
from changeloom.operators import decode as D
from changeloom.operators import events as E
from changeloom.plans.feeds import SQL_L, read, seconds_of, transactions
from changeloom.plans.stream_queries import LSN
from changeloom.sources import catalog as C

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# -- positions ---------------------------------------------------------------------------------------------------------


@query(f"""WITH {SQL_L}, x AS (SELECT xid, base AS lsn_num FROM txn) SELECT xid, {LSN} AS lsn, lsn_num::DECIMAL(20, 0) AS parsed FROM x""")
def lsn_parse_format(spark: SparkSession, d: str) -> DataFrame:
    t = transactions(spark, d).withColumn("lsn", L.lsn_format(F.col("base")))
    return t.select("xid", "lsn", L.lsn_parse(F.col("lsn")).alias("parsed"))


@query("""SELECT event_id, event_id * 7919 - 3 AS diff, trunc((event_id * 7919 - 3) * 4096 / 1048576)::BIGINT AS mb FROM events""")
def lsn_diff(spark: SparkSession, d: str) -> DataFrame:
    """The one event with number 0 has a negative difference."""
    e = read(spark, d, "events")
    diff = L.lsn_diff(F.col("event_id") * 7920, F.col("event_id") + 3)
    return e.select("event_id", diff.alias("diff"), L.whole_mb(diff * 4096).alias("mb"))


@query("""WITH t AS (SELECT p_partkey, ((p_size % 38 + 1) << 16 | (p_partkey % 12)) + 4 AS typmod FROM part)
  SELECT p_partkey, typmod, ((typmod - 4) >> 16) & 65535 AS p, xor((typmod - 4) & 2047, 1024) - 1024 AS s FROM t""")
def typmod_unpack(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "part").withColumn("typmod", F.shiftleft(F.col("p_size") % 38 + 1, 16).cast("long").bitwiseOR(F.col("p_partkey") % 12) + 4)
    return t.select("p_partkey", "typmod", V.typmod_precision(F.col("typmod")).alias("p"), V.typmod_scale(F.col("typmod")).alias("s"))


# -- values ------------------------------------------------------------------------------------------------------------

#: A text of each kind from an event, now and then one that has no value here.
TEXTS = {
    "t_bool": ("CASE event_id % 2 WHEN 0 THEN 't' ELSE 'f' END", V.BOOL, -1),
    "t_long": ("CAST(event_id * 1000003 AS {text})", V.INT8, -1),
    "t_double": ("CASE event_id % 11 WHEN 0 THEN 'NaN' WHEN 1 THEN '-Infinity' ELSE concat(CAST(event_id AS {text}), '.25') END", V.FLOAT8, -1),
    "t_numeric": ("CASE event_id % 13 WHEN 0 THEN 'NaN' ELSE concat(CAST(event_id AS {text}), '.125') END", V.NUMERIC, (12 << 16 | 3) + 4),
    "t_date": ("CASE event_id % 7 WHEN 0 THEN 'infinity' WHEN 1 THEN '0044-03-15 BC' WHEN 2 THEN '10000-01-01' ELSE concat('20', lpad(CAST(event_id % 90 + 10 AS {text}), 2, '0'), '-03-15') END", V.DATE, -1),
    "t_time": ("CASE event_id % 5 WHEN 0 THEN '24:00:00' WHEN 1 THEN '23:59:59.999999' ELSE concat('06:17:', lpad(CAST(event_id % 60 AS {text}), 2, '0')) END", V.TIME, -1),
    "t_timestamp": ("CASE event_id % 6 WHEN 0 THEN '-infinity' ELSE concat('2031-04-05 06:07:', lpad(CAST(event_id % 60 AS {text}), 2, '0'), '.5') END", V.TIMESTAMP, -1),
    "t_uuid": ("concat('0A1B2C3D-4E5F-4A6B-8C7D-', lpad(CAST(event_id AS {text}), 12, '0'))", V.UUID, -1),
}


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", *[F.expr(sql.format(text="string")).alias(name) for name, (sql, _, _) in TEXTS.items()])


DUCK = "SELECT event_id, " + ", ".join(f"{sql.format(text='varchar')} AS {name}" for name, (sql, _, _) in TEXTS.items()) + " FROM events"
DATE_OK = r"regexp_full_match(t_date, '\d{4}-\d{2}-\d{2}')"
TIMESTAMP_OK = r"regexp_full_match(t_timestamp, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,9})?')"
TIME_OK = r"regexp_full_match(t_time, '([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,9})?')"
TYPED = f"""t_bool = 't' AS v_bool, try_cast(t_long AS BIGINT) AS v_long, CASE WHEN isfinite(try_cast(t_double AS DOUBLE)) THEN try_cast(t_double AS DOUBLE) END AS v_double,
  try_cast(CASE WHEN t_numeric <> 'NaN' THEN t_numeric END AS DECIMAL(12, 3)) AS v_numeric, CASE WHEN {DATE_OK} THEN try_cast(t_date AS DATE) END AS v_date,
  CASE WHEN {TIME_OK} THEN left(t_time, 8) || '.' || rpad(substr(t_time, 10, 3), 3, '0') END AS v_time, CASE WHEN {TIMESTAMP_OK} THEN try_cast(t_timestamp AS TIMESTAMP) END AS v_timestamp, lower(t_uuid) AS v_uuid"""


@query(f"WITH x AS ({DUCK}) SELECT event_id, {TYPED} FROM x")
def text_to_typed(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("event_id", *[V.typed(F.col(n), oid, typmod).alias("v" + n[1:]) for n, (_, oid, typmod) in TEXTS.items()])


@query(f"""WITH x AS ({DUCK}), y AS (SELECT x.*, {TYPED} FROM x)
  SELECT event_id, v_double IS NULL AS no_double, v_numeric IS NULL AS no_numeric, v_date IS NULL AS no_date, v_time IS NULL AS no_time, v_timestamp IS NULL AS no_timestamp FROM y""")
def unsupported_to_null(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("event_id", *[V.unsupported(F.col(f"t_{n}"), TEXTS[f"t_{n}"][1], TEXTS[f"t_{n}"][2]).alias(f"no_{n}") for n in ("double", "numeric", "date", "time", "timestamp")])


@query(f"""WITH x AS ({DUCK}), y AS (SELECT x.*, {TYPED} FROM x),
  w AS (SELECT 'double' AS c, event_id, t_double AS t FROM y WHERE v_double IS NULL UNION ALL SELECT 'numeric', event_id, t_numeric FROM y WHERE v_numeric IS NULL
        UNION ALL SELECT 'date', event_id, t_date FROM y WHERE v_date IS NULL UNION ALL SELECT 'time', event_id, t_time FROM y WHERE v_time IS NULL UNION ALL SELECT 'timestamp', event_id, t_timestamp FROM y WHERE v_timestamp IS NULL)
  SELECT 'lab.samples.' || c AS "column", min(event_id) AS seq, arg_min(t, event_id) AS text FROM w GROUP BY c""")
def warn_once_per_column(spark: SparkSession, d: str) -> DataFrame:
    names = ("double", "numeric", "date", "time", "timestamp")
    bad = F.array(*[F.when(V.unsupported(F.col(f"t_{n}"), TEXTS[f"t_{n}"][1], TEXTS[f"t_{n}"][2]), F.struct(F.lit(n).alias("column"), F.col(f"t_{n}").alias("text"))) for n in names])
    rows = _texts(spark, d).select(F.col("event_id").alias("seq"), F.explode(F.array_compact(bad)).alias("x"))
    return E.warn_once(rows.select(F.lit("lab").alias("schema"), F.lit("samples").alias("table"), "x.column", "seq", "x.text"))


@query(r"""SELECT event_id, lower(hex(encode(event_type || event_id))) AS plain, lower(hex(encode(event_type || chr(92) || event_id))) AS escaped FROM events""")
def bytea_hex(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.col("event_type"), F.col("event_id").cast("string"))
    hexed = F.concat(F.lit("\\x"), F.lower(F.hex(F.encode(raw, "UTF-8"))))
    # in the escape form a backslash is written twice, and a first letter by its octal code
    octal = F.concat(F.lit("\\"), F.lpad(F.conv(F.ascii("event_type").cast("string"), 10, 8), 3, "0"))
    escaped = F.concat(octal, F.substr("event_type", F.lit(2)), F.lit("\\\\"), F.col("event_id").cast("string"))
    show = lambda c: F.lower(F.hex(c))
    return read(spark, d, "events").select("event_id", show(V.bytea(hexed)).alias("plain"), show(V.bytea(escaped)).alias("escaped"))


@query(r"""SELECT event_id, '\x' || lower(hex(encode(event_type))) AS shown FROM events""")
def hex_fallback(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", V.hex_fallback(F.encode("event_type", "UTF-8")).alias("shown"))


KIND = "CASE event_id % 3 WHEN 0 THEN 'u' WHEN 1 THEN 't' ELSE 'n' END"


def _toast(spark: SparkSession, d: str, strategy: str) -> DataFrame:
    kind = F.expr(KIND)
    return read(spark, d, "events").select("event_id", V.toast(kind, F.col("event_type"), V.TEXT, strategy).alias("payload"), V.toast(kind, F.col("event_id").cast("string"), V.INT4, strategy).alias("number"))


@query(f"SELECT event_id, CASE {KIND} WHEN 't' THEN event_type END AS payload, CASE {KIND} WHEN 't' THEN event_id::VARCHAR END AS number FROM events")
def toast_null(spark: SparkSession, d: str) -> DataFrame:
    return _toast(spark, d, "null")


@query(f"SELECT event_id, CASE {KIND} WHEN 't' THEN event_type WHEN 'u' THEN '__unchanged_toast_value__' END AS payload, CASE {KIND} WHEN 't' THEN event_id::VARCHAR END AS number FROM events")
def toast_placeholder(spark: SparkSession, d: str) -> DataFrame:
    return _toast(spark, d, "placeholder")


@query(f"""SELECT event_id, '{{"id":"' || event_id || '"' || CASE {KIND} WHEN 't' THEN ',"payload":"' || event_type || '"' WHEN 'n' THEN ',"payload":null' ELSE '' END || '}}' AS row FROM events""")
def toast_omit(spark: SparkSession, d: str) -> DataFrame:
    """The key of an unchanged value is left out, while null stays null."""
    columns = F.array(F.struct(F.lit("id").alias("name")), F.struct(F.lit("payload").alias("name")))
    cells = F.array(F.struct(F.lit("t").alias("kind"), F.col("event_id").cast("string").alias("text")), F.struct(F.expr(KIND).alias("kind"), F.col("event_type").alias("text")))
    return read(spark, d, "events").select("event_id", F.to_json(E.row_image(columns, cells, omit_unchanged=True), {"ignoreNullFields": "false"}).alias("row"))


# -- snapshots ---------------------------------------------------------------------------------------------------------


@query("""SELECT 'snapshot' AS operation, 'shop' AS schema, 'customer' AS "table", '0/2000' AS lsn, 0::BIGINT AS xid, c_custkey, c_name AS after FROM customer""")
def snapshot_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "customer").select(F.lit("s").alias("kind"), "c_custkey", "c_name")
    return rows.select(E.operation_of(F.col("kind")).alias("operation"), F.lit("shop").alias("schema"), F.lit("customer").alias("table"), L.lsn_format(F.lit(0x2000).cast("long")).alias("lsn"), F.lit(0).cast("long").alias("xid"), "c_custkey", F.col("c_name").alias("after"))


@query("""SELECT c_nationkey, c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 10 AS chunk FROM customer""")
def snapshot_chunks(spark: SparkSession, d: str) -> DataFrame:
    return E.chunked(read(spark, d, "customer").select("c_nationkey", "c_custkey"), ["c_nationkey"], ["c_custkey"], 10)


@query(f"""WITH {SQL_L}, x AS (SELECT 0 AS phase, 'snapshot' AS operation, 8192::BIGINT AS lsn_num, 0::BIGINT AS xid, o_custkey AS id FROM orders UNION ALL
  SELECT 1, CASE kind WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' WHEN 'D' THEN 'delete' ELSE 'truncate' END, lsn_num, xid, l_orderkey FROM chg WHERE lsn_num > 8192) SELECT phase, operation, {LSN} AS lsn, xid, id FROM x""")
def snapshot_union_stream(spark: SparkSession, d: str) -> DataFrame:
    """All snapshot rows at the consistent point, then the changes after it."""
    from changeloom.plans.feeds import changes

    point = 8192
    first = read(spark, d, "orders").select(F.lit(0).alias("phase"), F.lit("s").alias("kind"), F.lit(point).cast("long").alias("lsn_num"), F.lit(0).cast("long").alias("xid"), F.col("o_custkey").alias("id"))
    then = changes(spark, d).where(F.col("lsn_num") > point).select(F.lit(1).alias("phase"), "kind", "lsn_num", "xid", F.col("l_orderkey").alias("id"))
    return first.unionByName(then).select("phase", E.operation_of(F.col("kind")).alias("operation"), L.lsn_format(F.col("lsn_num")).alias("lsn"), "xid", "id")


# -- catalogs: regions are schemas, nations tables, customers columns, suppliers indexes -------------------------------


def _catalog(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    nation = read(spark, d, "nation")
    namespaces = read(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("oid"), F.col("r_name").alias("nspname"))
    classes = nation.select(F.col("n_nationkey").cast("long").alias("oid"), F.col("n_name").alias("relname"), F.col("n_regionkey").cast("long").alias("relnamespace"), F.element_at(F.array(*map(F.lit, "dfin")), F.col("n_nationkey") % 4 + 1).alias("relreplident"))
    # every third table publishes a list of columns, generated ones among them
    listed = read(spark, d, "customer").where("c_custkey % 2 = 0").groupBy(F.col("c_nationkey").cast("long").alias("c_oid")).agg(F.collect_set("c_name").alias("names"))
    publication = classes.where("oid % 5 <> 0").join(listed, F.col("oid") == F.col("c_oid"), "left").join(namespaces.withColumnRenamed("oid", "n_oid"), F.col("relnamespace") == F.col("n_oid")).select(F.col("nspname").alias("schemaname"), F.col("relname").alias("tablename"), F.when(F.col("oid") % 3 == 0, F.col("names")).alias("attnames"), F.lit(None).cast("string").alias("rowfilter"))
    return C.publication_tables(publication, namespaces, classes), read(spark, d, "customer")


def _columns(spark: SparkSession, d: str) -> DataFrame:
    tables, customer = _catalog(spark, d)
    attributes = customer.select(F.col("c_nationkey").cast("long").alias("attrelid"), (F.col("c_custkey") - 3).alias("attnum"), F.col("c_name").alias("attname"), (F.col("c_custkey") % 17 == 0).alias("attisdropped"), F.when(F.col("c_custkey") % 13 == 0, "s").otherwise("").alias("attgenerated"))
    return C.published_columns(tables, attributes)


TABLES = """t AS (SELECT n_nationkey::BIGINT AS relation_id, r_name AS schema, n_name AS "table", ['d', 'f', 'i', 'n'][n_nationkey % 4 + 1] AS replica_identity FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 0)"""
COLUMNS = """c AS (SELECT t.*, c_custkey - 3 AS attnum, c_name AS attname FROM customer JOIN t ON c_nationkey = relation_id WHERE c_custkey > 3 AND c_custkey % 17 <> 0 AND CASE WHEN relation_id % 3 = 0 AND relation_id IN (SELECT c_nationkey FROM customer WHERE c_custkey % 2 = 0) THEN c_custkey % 2 = 0 ELSE c_custkey % 13 <> 0 END)"""


@query(f"WITH {TABLES} SELECT * FROM t")
def publication_tables(spark: SparkSession, d: str) -> DataFrame:
    return _catalog(spark, d)[0].drop("attnames", "rowfilter")


@query(f"WITH {TABLES}, {COLUMNS} SELECT relation_id, schema, \"table\", attnum, attname FROM c")
def published_columns(spark: SparkSession, d: str) -> DataFrame:
    return _columns(spark, d).select("relation_id", "schema", "table", "attnum", "attname")


@query(f"""WITH {TABLES}, {COLUMNS}, i AS (SELECT s_nationkey::BIGINT AS relation_id, unnest([s_suppkey * 3, s_suppkey * 5]) AS attnum, s_suppkey % 2 = 0 AS pri, s_suppkey % 3 = 0 AS rep FROM supplier),
  k AS (SELECT relation_id, attnum, bool_or(pri) AS pri, bool_or(rep) AS rep FROM i WHERE pri OR rep GROUP BY ALL)
  SELECT c.relation_id, c.attnum, c.attname, CASE replica_identity WHEN 'f' THEN true WHEN 'd' THEN coalesce(pri, false) WHEN 'i' THEN coalesce(rep, false) ELSE false END AS key FROM c LEFT JOIN k ON k.relation_id = c.relation_id AND k.attnum = c.attnum""")
def key_columns(spark: SparkSession, d: str) -> DataFrame:
    indexes = read(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("indrelid"), F.array(F.col("s_suppkey") * 3, F.col("s_suppkey") * 5).alias("indkey"), (F.col("s_suppkey") % 2 == 0).alias("indisprimary"), (F.col("s_suppkey") % 3 == 0).alias("indisreplident"))
    return C.with_key_flag(_columns(spark, d), indexes).select("relation_id", "attnum", "attname", "key")


# -- the wire format: encode rows as messages, decode them, get the rows back ------------------------------------------

ORDERS = [("o_orderkey", True, V.INT8, -1), ("o_custkey", False, V.INT8, -1), ("o_orderstatus", False, V.TEXT, -1), ("o_orderpriority", False, V.TEXT, -1)]


def _orders(spark: SparkSession, d: str) -> DataFrame:
    """The given table is one row group, thus one task; its rows are dealt out before they are written as messages."""
    return read(spark, d, "orders").repartition("o_orderkey")


def _log(spark: SparkSession, d: str, cells: list[Column], streamed: bool = False) -> DataFrame:
    """One slot's messages a source: per order begin, its table, an insert and a commit, or a segment of a streamed transaction."""
    o = _orders(spark, d)
    xid, oid, at = F.col("o_orderkey") + 1, F.lit(16388), F.col("o_orderkey") * 16
    micros = seconds_of(F.col("o_orderdate")) * 1000000 - V.PG_EPOCH_MICROS
    inner = xid if streamed else None
    table, row = D.encode_relation(oid, "shop", F.lit("orders"), "d", ORDERS, inner), D.encode_insert(oid, cells, inner)
    if streamed:
        start = F.concat(D.letter("S"), D.big_endian(xid, 4), F.unhex(F.lit("01")))
        done = F.concat(D.letter("c"), D.big_endian(xid, 4), F.unhex(F.lit("00")), D.big_endian(at, 8), D.big_endian(at + 15, 8), D.big_endian(micros, 8))
        log = [start, table, row, D.letter("E"), done]
    else:
        log = [D.encode_begin(at, micros, xid), table, row, D.encode_commit(at, at + 15, micros)]
    source = F.concat(F.lit("slot"), (F.col("o_orderkey") % 8).cast("string"))
    return o.select(source.alias("source_id"), at.alias("at"), F.posexplode(F.array(*log))).select("source_id", (F.col("at") + F.col("pos")).alias("seq"), (F.col("at") + F.col("pos")).alias("recv_lsn"), F.col("col").alias("data"))


def _rows(messages: DataFrame) -> DataFrame:
    text = lambda i: F.col("new")[i]["text"]
    return messages.where("kind = 'I'").select(text(0).cast("long").alias("o_orderkey"), text(1).cast("long").alias("o_custkey"), text(2).alias("o_orderstatus"), text(3).alias("o_orderpriority"))


BACK = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"


@query(BACK)
def decode_capture(spark: SparkSession, d: str) -> DataFrame:
    return _rows(D.decode(_log(spark, d, [D.encode_cell(F.col(n).cast("string")) for n, *_ in ORDERS]), kinds="I"))


@query(BACK)
def decode_capture_binary(spark: SparkSession, d: str) -> DataFrame:
    cells = [D.encode_binary_cell(D.big_endian(F.col(n), 8) if oid == V.INT8 else F.encode(F.col(n), "UTF-8")) for n, _, oid, _ in ORDERS]
    log = _log(spark, d, cells)
    kind = D.message_kind(F.col("data"))
    relation = D.decode(log, kinds="R").select("source_id", "relation_id", "seq", "relation")
    changes = log.where(kind == "I").select("source_id", D.peek_relation(F.col("data")).alias("relation_id"), "seq", "recv_lsn", kind.alias("kind"), "data")
    return _rows(D.decode_rows(E.relation_valid(changes, relation)))


@query(BACK + " WHERE true")
def decode_capture_stream(spark: SparkSession, d: str) -> DataFrame:
    return _rows(D.decode(_log(spark, d, [D.encode_cell(F.col(n).cast("string")) for n, *_ in ORDERS], streamed=True), streaming=True, kinds="I"))


GROUPS = 10


@query(f"""WITH g AS (SELECT o_orderkey, list_transform(range(1, {GROUPS}), lambda i: lpad(((o_orderkey * 7919 * i + i) % 10000)::VARCHAR, 4, '0')) AS parts FROM orders)
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE '' END || (o_orderkey % 90 + 10) || array_to_string(parts[1:6], '') || '.' || array_to_string(parts[7:9], '') AS amount FROM g""")
def decode_numerics(spark: SparkSession, d: str) -> DataFrame:
    """Numerics of 38 digits in binary form: ten groups of four digits, of which the first has two, and twelve places after the point."""
    key = F.col("o_orderkey")
    groups = [key % 90 + 10, *[(key * 7919 * i + i) % 10000 for i in range(1, GROUPS)]]
    head = [F.lit(GROUPS), F.lit(GROUPS - 4), F.when(key % 3 == 0, 0x4000).otherwise(0), F.lit(12)]
    amount = F.concat(*[D.big_endian(x, 2) for x in (*head, *groups)])
    defined = F.from_json(F.lit('{"relation_id": 1, "namespace": "shop", "name": "sums", "columns": [{"name": "o_orderkey", "key": true, "type_oid": 20, "typmod": -1}, {"name": "amount", "type_oid": 1700, "typmod": -1}]}'), D.RELATION)
    rows = _orders(spark, d).select(F.lit("slot").alias("source_id"), key.alias("seq"), key.alias("recv_lsn"), D.encode_insert(F.lit(1), [D.encode_binary_cell(D.big_endian(key, 8)), D.encode_binary_cell(amount)]).alias("data"), defined.alias("relation"))
    return D.decode_rows(rows).select(F.col("new")[0]["text"].cast("long").alias("o_orderkey"), F.col("new")[1]["text"].alias("amount"))


@query("""SELECT 'slot' || (o_orderkey % 8) AS source_id, o_orderkey + 1 AS xid, o_orderkey * 16 AS commit_lsn, o_orderkey * 16 + 15 AS end_lsn, epoch_us(o_orderdate) AS commit_micros FROM orders""")
def decode_commits(spark: SparkSession, d: str) -> DataFrame:
    log = D.decode(_log(spark, d, [D.encode_cell(F.col("o_orderkey").cast("string"))] * 4, streamed=True), kinds="c")
    return log.select("source_id", "xid", "commit_lsn", "end_lsn", (F.col("commit_micros") + V.PG_EPOCH_MICROS).alias("commit_micros"))


@query("""SELECT kind, count(*) AS n, count(*) FILTER (kind IN ('R', 'I')) AS transactional, max(CASE WHEN kind <> 'E' THEN o_orderkey + 1 END) AS last_xid FROM orders, (VALUES ('S'), ('R'), ('I'), ('E'), ('c')) k(kind) GROUP BY kind""")
def peek_messages(spark: SparkSession, d: str) -> DataFrame:
    """Kinds and ids read off the first bytes, without decoding."""
    log = _log(spark, d, [D.encode_cell(F.col("o_orderkey").cast("string"))] * 4, streamed=True)
    kind = D.message_kind(F.col("data"))
    return log.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_if(D.is_transactional(F.col("data"))).alias("transactional"), F.max(F.when(kind != "E", D.peek_xid(F.col("data")))).alias("last_xid"))


def _all_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Per order: begin, origin, a type, the table, an update (with the old row, the old key or nothing), a delete, a truncate of two tables, commit, and the abort of a subtransaction."""
    o = _orders(spark, d)
    text = lambda n: D.encode_cell(F.col(n).cast("string"))
    oid, at, xid = F.lit(16388), F.col("o_orderkey") * 16, F.col("o_orderkey") + 1
    old, new = [text(n) for n, *_ in ORDERS], [text("o_orderkey"), D.encode_cell((F.col("o_custkey") + 1).cast("string")), D.unchanged_cell(), D.encode_cell(F.lit(None).cast("string"))]
    which = F.col("o_orderkey") % 3
    update = F.when(which == 0, D.encode_update(oid, old, new)).when(which == 1, D.encode_update(oid, old, new, "K")).otherwise(D.encode_update(oid, None, new))
    log = [
        D.encode_begin(at, at, xid), D.encode_origin(at + 7, F.concat(F.lit("node "), F.col("o_orderstatus"))), D.encode_type(F.col("o_custkey"), F.lit("shop"), F.lower("o_orderpriority")), D.encode_relation(oid, "shop", F.lit("orders"), "f", ORDERS),
        update, D.encode_delete(oid, old, "O"), D.encode_truncate([F.col("o_custkey"), F.col("o_custkey") + 5], F.col("o_orderkey") % 4), D.encode_commit(at, at + 15, at), D.encode_abort(xid, xid + 100000000),
    ]
    source = F.concat(F.lit("slot"), (F.col("o_orderkey") % 8).cast("string"))
    return o.select(source.alias("source_id"), at.alias("at"), F.posexplode(F.array(*log))).select("source_id", (F.col("at") + F.col("pos")).alias("seq"), (F.col("at") + F.col("pos")).alias("recv_lsn"), F.col("col").alias("data"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'K' END AS old_kind, CASE WHEN o_orderkey % 3 < 2 THEN o_custkey::VARCHAR END AS was, (o_custkey + 1)::VARCHAR AS "is", 'u' AS status_kind, 'n' AS priority_kind FROM orders""")
def decode_updates(spark: SparkSession, d: str) -> DataFrame:
    m = D.decode(_all_kinds(spark, d), kinds="U")
    return m.select(F.col("new")[0]["text"].cast("long").alias("o_orderkey"), "old_kind", F.col("old")[1]["text"].alias("was"), F.col("new")[1]["text"].alias("is"), F.col("new")[2]["kind"].alias("status_kind"), F.col("new")[3]["kind"].alias("priority_kind"))


@query("SELECT o_orderkey * 16 + 5 AS seq, 16388::BIGINT AS relation_id, 'O' AS old_kind, o_orderkey, o_orderstatus, true AS no_new FROM orders")
def decode_deletes(spark: SparkSession, d: str) -> DataFrame:
    m = D.decode(_all_kinds(spark, d), kinds="D")
    return m.select("seq", "relation_id", "old_kind", F.col("old")[0]["text"].cast("long").alias("o_orderkey"), F.col("old")[2]["text"].alias("o_orderstatus"), F.col("new").isNull().alias("no_new"))


@query("""SELECT o_orderkey * 16 + 6 AS seq, o_orderkey % 2 = 1 AS cascade, o_orderkey % 4 >= 2 AS restart_identity, ord, o_custkey + 5 * ord AS relation_id FROM orders, (VALUES (0), (1)) x(ord)""")
def decode_truncates(spark: SparkSession, d: str) -> DataFrame:
    """Decoded, and once more read off the bytes, which must be the same tables."""
    log = _all_kinds(spark, d)
    peeked = log.where(D.message_kind(F.col("data")) == "T").select("source_id", "seq", D.peek_truncated(F.col("data")).alias("peeked"))
    m = D.decode(log, kinds="T").join(peeked, ["source_id", "seq"])
    ids = F.when(F.col("peeked") == F.col("truncate.relation_ids"), F.col("peeked"))
    return m.select("seq", "truncate.cascade", "truncate.restart_identity", F.posexplode(ids).alias("ord", "relation_id"))


@query("SELECT o_custkey AS type_oid, 'shop' AS namespace, lower(o_orderpriority) AS name, count(*) AS n FROM orders GROUP BY ALL")
def decode_types(spark: SparkSession, d: str) -> DataFrame:
    return D.decode(_all_kinds(spark, d), kinds="Y").groupBy("type.type_oid", "type.namespace", "type.name").agg(F.count("*").alias("n"))


@query("SELECT 'node ' || o_orderstatus AS origin_name, count(*) AS n, min(o_orderkey * 16 + 7) AS first_lsn FROM orders GROUP BY ALL")
def decode_origins(spark: SparkSession, d: str) -> DataFrame:
    return D.decode(_all_kinds(spark, d), kinds="O").groupBy("origin_name").agg(F.count("*").alias("n"), F.min("origin_lsn").alias("first_lsn"))


@query("SELECT 'slot' || (o_orderkey % 8) AS source_id, o_orderkey + 1 AS xid, o_orderkey + 100000001 AS sub_xid FROM orders")
def decode_aborts(spark: SparkSession, d: str) -> DataFrame:
    return D.decode(_all_kinds(spark, d), kinds="A").select("source_id", "xid", "sub_xid")


@query(r"""SELECT c_custkey, '"' || replace(c_name || '"x', '"', '""') || '"' AS quoted FROM customer""")
def quoted_names(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select("c_custkey", C.quoted_column(F.concat("c_name", F.lit('"x'))).alias("quoted"))
