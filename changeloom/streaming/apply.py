"""From raw messages to committed files: the stages as DataFrame transformations, and foreachBatch to write them.

Each micro-batch holds whole transactions only (the source sees to it), so every stage works within the batch but for table definitions, which
are kept as a table beside the output and joined as the past of the next batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.functions import values as V
from changeloom.functions.lsn import lsn_format, unsigned32
from changeloom.operators import batches, events
from changeloom.operators.decode import MAPPED, RELATION, decode, decode_rows, message_kind, peek_relation, peek_truncated
from changeloom.operators.ordered import running_count

KNOWN = f"source_id string, relation_id long, seq long, relation {RELATION}, schema_version long"


def transactions_of(raw: DataFrame) -> DataFrame:
    """source_id, _n, xid, commit_micros of the transactions of raw, numbered by their ends. A streamed one's messages come without S and E: what ends it is c, which has its id."""
    bounds = decode(raw, kinds="BCc").select("source_id", "seq", "kind", "xid", "commit_micros")
    numbered = running_count(bounds, ["source_id"], "seq", F.col("kind") != "B", "_n")
    begins = numbered.where("kind = 'B'").select("source_id", "_n", F.col("xid").alias("begin_xid"))
    ends = numbered.where("kind <> 'B'").select("source_id", (F.col("_n") - 1).alias("_n"), "xid", "commit_micros")
    return ends.join(begins, ["source_id", "_n"], "left").select("source_id", "_n", F.coalesce("xid", "begin_xid").alias("xid"), "commit_micros")


def definitions(raw: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """source_id, relation_id, seq, relation, schema_version of all definitions in raw, and of known (earlier ones, KNOWN) in front of them; versions go on from known's."""
    own = decode(raw, kinds="R").select("source_id", "relation_id", "seq", "relation", F.lit(None).cast("long").alias("was"))
    rows = own if known is None else own.unionByName(known.withColumnRenamed("schema_version", "was").select("source_id", "relation_id", "seq", "relation", "was"))
    numbered = batches.schema_islands(rows, F.to_json("relation"))
    before = F.coalesce(F.max("was").over(Window.partitionBy("source_id", "relation_id")) - 1, F.lit(0))
    return numbered.withColumn("schema_version", F.col("schema_version") + before).drop("was")


def resolved_changes(raw: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """raw messages of whole transactions in replay order -> changes with their table's definition, version and transaction, rows still as ``data``.

    known: definitions of earlier batches (KNOWN). What is joined here is read off the bytes, so no change is decoded yet. Columns: source_id, relation_id, seq, ord, kind, recv_lsn, data, relation, schema_version, xid, commit_micros.
    """
    kind = message_kind(F.col("data"))
    logged = raw.select("source_id", "seq", "recv_lsn", "data", kind.alias("kind")).where(kind.isin(*"IUDTsCc"))
    placed = running_count(logged, ["source_id"], "seq", F.col("kind").isin("C", "c"), "_n").where(F.col("kind").isin(*"IUDTs"))
    of = F.when(F.col("kind") == "T", peek_truncated(F.col("data"))).otherwise(F.array(peek_relation(F.col("data"))))
    wanted = placed.join(transactions_of(raw), ["source_id", "_n"], "left").drop("_n").select("*", F.posexplode(of).alias("ord", "relation_id"))
    versions = definitions(raw, known).select("source_id", "relation_id", "seq", F.struct("relation", "schema_version").alias("relation"))
    found = events.relation_valid(wanted, versions)
    return found.select("source_id", "relation_id", "seq", "ord", "kind", "recv_lsn", "data", F.col("relation.relation").alias("relation"), F.col("relation.schema_version").alias("schema_version"), "xid", "commit_micros")


def change_events(changes: DataFrame, schema_pattern: str | None = None, table_pattern: str | None = None, toast: str = "null", placeholder: str = "__unchanged_toast_value__", unconstrained: str = "string") -> DataFrame:
    """Changes -> events of all tables in one form, before and after as maps of text; filtered before any row is decoded. ``binary`` has the columns whose binary values have no value (or no mapping) here."""
    named = changes.withColumn("schema", F.col("relation.namespace")).withColumn("table", F.col("relation.name"))
    texts = decode_rows(events.captured(named, schema_pattern, table_pattern))
    columns = F.col("relation.columns")

    def image(cells: str):
        if toast == "placeholder":
            fill = F.struct(F.lit("t").alias("kind"), F.lit(placeholder).alias("text"), F.lit(None).cast("binary").alias("bin"))
            filled = F.zip_with(columns, F.col(cells), lambda c, v: F.when((v["kind"] == "u") & V.holds_text(c["type_oid"], c["typmod"], unconstrained), fill).otherwise(v))
            return events.row_image(columns, F.when(F.col(cells).isNotNull(), filled))
        return events.row_image(columns, F.col(cells), omit_unchanged=toast == "omit")

    def binary(cells: str):
        shown = lambda c, v: F.struct(c["name"].alias("column"), F.when(c["type_oid"].isin(*MAPPED), "no value").otherwise("no binary mapping").alias("reason"), V.hex_fallback(v["bin"]).alias("text"))
        return F.coalesce(F.array_compact(F.zip_with(columns, F.col(cells), lambda c, v: F.when(v["bin"].isNotNull(), shown(c, v)))), F.array().cast("array<struct<column:string,reason:string,text:string>>"))

    return texts.select(
        "source_id", "seq", "ord", "schema_version", "relation", events.operation_of(F.col("kind")).alias("operation"), "schema", "table", lsn_format(F.col("recv_lsn")).alias("lsn"), F.col("recv_lsn").alias("lsn_num"),
        unsigned32(F.col("xid")).alias("xid"), V.pg_micros(F.col("commit_micros")).alias("commit_timestamp"), image("old").alias("before"), image("new").alias("after"), F.concat(binary("old"), binary("new")).alias("binary"),
    )


def typed_rows(table_events: DataFrame, columns: list[dict], unconstrained: str = "string") -> DataFrame:
    """Events of one table and version, in order, with before and after as structs of the table's types."""
    table_events = table_events.orderBy("source_id", "seq", "ord")
    fields = lambda side: F.struct(*[V.typed(F.col(side)[c["name"]], c["type_oid"], c["typmod"], unconstrained).alias(c["name"]) for c in columns])
    side = lambda name: F.when(F.col(name).isNotNull(), fields(name)).alias(name)
    return table_events.select("operation", "schema", "table", "lsn", "xid", "commit_timestamp", side("before"), side("after"))


def warnings_of(changes: DataFrame, unconstrained: str = "string") -> DataFrame:
    """column (with schema and table), seq, text, reason: of each column the first value that has no Spark value, or no binary mapping. Events of all tables at once; the driver gets the types that occur."""
    kinds = changes.select(F.explode("relation.columns").alias("c")).select("c.type_oid", "c.typmod").distinct().collect()
    bad = F.lit(False)
    for k in kinds:
        bad = F.when((F.col("x.type_oid") == k.type_oid) & (F.col("x.typmod") == k.typmod), V.unsupported(F.col("x.text"), k.type_oid, k.typmod, unconstrained)).otherwise(bad)
    values = lambda side: F.transform("relation.columns", lambda c: F.struct(c["name"].alias("column"), c["type_oid"].alias("type_oid"), c["typmod"].alias("typmod"), F.col(side)[c["name"]].alias("text")))
    both = F.filter(F.concat(*[F.coalesce(F.when(F.col(side).isNotNull(), values(side)), F.array().cast(_VALUES)) for side in ("before", "after")]), lambda v: v["text"].isNotNull())
    of = ["schema", "table", "seq"]
    found = changes.select(*of, F.explode(both).alias("x")).where(bad).select(*of, "x.column", "x.text", F.lit("no value").alias("reason"))
    if "binary" in changes.columns:
        found = found.unionByName(changes.select(*of, F.explode("binary").alias("x")).select(*of, "x.column", "x.text", "x.reason"))
    named = found.withColumn("column", F.concat_ws(".", "schema", "table", "column"))
    return named.groupBy("column").agg(F.min_by(F.struct("seq", "text", "reason"), "seq").alias("x")).select("column", "x.*")


_VALUES = "array<struct<column:string,type_oid:long,typmod:int,text:string>>"


class BatchWriter:
    """foreachBatch function: one folder per source, table and schema version under path/batch=<id>, then one row per file in path/manifest.

    Events of all tables are in one form, before and after as maps of text, and one job writes them: ranges of (source, table, version, place in the log) are what its tasks get, so small tables share a task and a large
    one is many, whose files are in the order of the log by name. With ``typed`` before and after have the table's own types instead; then each table and version has a schema, and a job, of its own.
    Spark's committer shows a job's files only when all of its tasks have ended well, and the manifest comes last: a reader goes by the manifest, so of a batch that fails nothing is there, and one that is run again
    overwrites its own. path/relations has the definitions that hold after a batch, one a table of a source, which the next batch starts from; path/warnings the first unsupported value of each column, once for all batches.
    """

    MIME = {"json": "application/json", "csv": "text/csv", "parquet": "application/vnd.apache.parquet", "orc": "application/vnd.apache.orc", "avro": "application/avro-binary"}
    FILE = ["source_id", "schema", "table", "schema_version"]

    def __init__(self, path: str, fmt: str = "json", typed: bool = False, unconstrained: str = "string", **event_options):
        self.path, self.format, self.options = path.rstrip("/"), fmt, {"unconstrained": unconstrained} | event_options
        self.typed, self.unconstrained = typed, unconstrained

    def __call__(self, raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        raw = raw.persist()
        found = None
        try:
            known = self._known(spark, batch_id)
            found = change_events(resolved_changes(raw, known), **self.options).persist()
            placed = found.withColumn("batch_id", F.lit(batch_id)).withColumn("replay_pos", F.struct("source_id", "seq", "ord"))
            defined = definitions(raw, known).join(raw.select("source_id", "seq"), ["source_id", "seq"], "left_semi")  # those that this batch brings
            defined = defined.select(F.lit(batch_id).alias("batch_id"), "source_id", F.col("relation.namespace").alias("schema"), F.col("relation.name").alias("table"), "schema_version", F.struct("source_id", "seq", F.lit(-1).alias("ord")).alias("replay_pos"))
            files = batches.manifest(placed, defined, sources=True).withColumn("mime_type", F.lit(self.MIME.get(self.format, "application/octet-stream")))
            folder = f"{self.path}/batch={batch_id}"
            if self.typed:
                shapes = found.groupBy(*self.FILE).agg(F.first("relation.columns").alias("columns"))  # a table's version has one definition
                for f in shapes.collect():  # a row per table and version
                    one = found.where((F.col("source_id") == f.source_id) & (F.col("schema") == f.schema) & (F.col("table") == f.table) & (F.col("schema_version") == f.schema_version))
                    rows = self._shaped(typed_rows(one, [c.asDict() for c in f["columns"]], self.unconstrained))
                    self._write(rows, f"{folder}/source={f.source_id}/of={f.schema}.{f.table}/v={f.schema_version}")
            else:
                by = [F.col("source_id").alias("source"), F.concat_ws(".", "schema", "table").alias("of"), F.col("schema_version").alias("v")]
                ranged = found.select("*", *by).repartitionByRange("source", "of", "v", "seq", "ord").sortWithinPartitions("source", "of", "v", "seq", "ord")
                self._write(self._shaped(ranged, "source", "of", "v"), folder, "source", "of", "v")
            self._warn(spark, warnings_of(found, self.unconstrained), batch_id)
            latest = definitions(raw, known).groupBy("source_id", "relation_id").agg(F.max_by(F.struct("seq", "relation", "schema_version"), "seq").alias("x")).select("source_id", "relation_id", "x.*")
            latest.write.mode("overwrite").json(f"{self.path}/relations/batch={batch_id}")
            files.write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}")  # last: what isn't listed isn't there
        finally:
            raw.unpersist()
            if found is not None:
                found.unpersist()

    def _shaped(self, rows: DataFrame, *more: str) -> DataFrame:
        if self.format in ("csv",):
            rows = rows.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in ("before", "after")})
        return rows.select("operation", "schema", "table", "lsn", "xid", "commit_timestamp", "before", "after", *more)

    def _write(self, rows: DataFrame, folder: str, *by: str) -> None:
        writer = rows.write.mode("overwrite").option("ignoreNullFields", "false").format(self.format)
        (writer.partitionBy(*by) if by else writer).save(folder)

    def _warn(self, spark, rows: DataFrame, batch_id: int) -> None:
        """Warnings of columns that no earlier batch has warned of."""
        if self._batches(spark, "warnings"):
            earlier = spark.read.schema("column string, batch int").json(f"{self.path}/warnings").where(F.col("batch") < batch_id)
            rows = rows.join(earlier.select("column").distinct(), "column", "left_anti")
        rows.write.mode("overwrite").json(f"{self.path}/warnings/batch={batch_id}")

    def _known(self, spark, batch_id: int) -> DataFrame | None:
        """The definitions that held after the batch before; older folders but one are removed, since only the last batch is ever run again."""
        earlier = sorted(n for n in self._batches(spark, "relations") if n < batch_id)
        for n in earlier[:-2]:
            self._folder(spark, f"relations/batch={n}", delete=True)
        return spark.read.schema(KNOWN).json(f"{self.path}/relations/batch={earlier[-1]}") if earlier else None

    def _folder(self, spark, name: str, delete: bool = False):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if delete:
            return system.delete(path, True)
        return system.listStatus(path) if system.exists(path) else []

    def _batches(self, spark, name: str) -> list[int]:
        """Numbers of the batches that have a folder under name."""
        return [int(f.getPath().getName().removeprefix("batch=")) for f in self._folder(spark, name) if f.getPath().getName().startswith("batch=")]
