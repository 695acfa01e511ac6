"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of a document is addressed by the SHA-256 of its text (a blob). A blob is scanned once per rule version: pairs of blob and rule version that
the ledger holds are left out by an anti join, so an unchanged corpus costs digests only. Findings are kept per blob and joined back to all
documents (paths) with that content.

Positions are code points. A rule's matches are leftmost and non-overlapping: splitting the text at the rule's pattern gives the gaps
before each match, and the running sum of gaps and matches gives each start. The running sum is a window over one
blob's matches of one rule, linear in them.

Cases: null text is the empty text; the empty text has no findings; repeated rows and equal texts share a blob and get equal results; null doc_ids are kept; an empty
table gives an empty result; columns besides doc_id and text, whatever their names, don't take part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.llm.common import shared_folder, spread_join, table, text_or_empty


@dataclass(frozen=True)
class Rule:
    """least: the fewest characters of the value (``value`` is the group that holds it) or the match is dropped."""

    kind: str
    version: int
    pattern: str
    least: int
    value: int = 0
    #: A string without which the pattern can't match; spares most texts the scan.
    needs: tuple[str, ...] = ()


#: In the order of kinds. A maximal run of hex digits with 24 or more is what [0-9a-f]+ finds and keeps, likewise AKIA with 16 or more after it.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, (":", "=")),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 20, 0, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 24),
)


def blob_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _pieces(text: Column, number: int, rule: Rule) -> Column:
    """An array with, per match, its number, the length of the gap before, of the match, and of its value."""
    wanted = text.rlike(rule.pattern)
    if rule.needs:
        has = F.lit(False)
        for x in rule.needs:
            has = has | text.contains(x)
        wanted = has & wanted
    pairs = F.zip_with(
        F.split(text, rule.pattern, -1),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("match"), F.length(F.regexp_extract(match, rule.pattern, rule.value)).alias("value")),
    )
    numbered = F.transform(pairs, lambda x, i: F.struct(F.lit(number).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["match"].alias("match"), x["value"].alias("value")))
    return F.when(wanted, F.filter(numbered, lambda x: x["match"].isNotNull()))


def unseen(blobs: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """blobs with ``due``, the numbers of the rules that the ledger (blob, kind, version) doesn't hold for them; blobs with none are left out."""
    if ledger is None:
        return blobs.withColumn("due", F.array(*[F.lit(k) for k in range(len(rules))]))
    number = F.coalesce(*[F.when((F.col("kind") == r.kind) & (F.col("version") == r.version), F.lit(k)) for k, r in enumerate(rules)])
    seen = ledger.select("blob", number.alias("k")).where(F.col("k").isNotNull()).groupBy("blob").agg(F.collect_set("k").alias("seen"))
    left = blobs.join(seen, "blob", "left").withColumn("due", F.array_except(F.array(*[F.lit(k) for k in range(len(rules))]), F.coalesce("seen", F.array().cast("array<int>"))))
    return left.where(F.size("due") > 0).drop("seen")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None, text: str = "text") -> DataFrame:
    """Findings of the blobs that are due: blob, kind (number of the rule), start, end; one row per finding."""
    content = text_or_empty(text)
    blobs = docs.select(blob_of(content).alias("blob"), content.alias("text")).dropDuplicates(["blob"])
    due = unseen(blobs, rules, ledger)
    arrays = [F.coalesce(F.when(F.array_contains("due", k), _pieces(F.col("text"), k, r)), F.array().cast("array<struct<kind:int,i:int,gap:int,match:int,value:int>>")) for k, r in enumerate(rules)]
    pieces = due.select("blob", F.explode(F.concat(*arrays)).alias("x")).select("blob", "x.*")
    so_far = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("kind") + 1)
    return pieces.withColumn("end", F.sum(F.col("gap") + F.col("match")).over(so_far)).where(F.col("value") >= least).select("blob", "kind", (F.col("end") - F.col("match")).alias("start"), "end")


def ledger_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """What to append to the ledger after a scan: every blob with every rule version."""
    held = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    return docs.select(blob_of(text_or_empty(text)).alias("blob")).distinct().select("blob", F.explode(held).alias("x")).select("blob", "x.*")


def per_blob(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, a count per kind (n_<kind>), and spans: kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return (
        findings.groupBy("blob")
        .agg(*[F.count_if(F.col("kind") == k).alias(f"n_{r.kind}") for k, r in enumerate(rules)], F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
        .withColumn("spans", F.array_join(F.transform("found", lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ","))
    )


def annotate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """docs with blob, n_<kind>, found and spans: the findings joined back to every document with that content. Columns of these names are replaced."""
    docs = docs.drop(*{"blob", "found", "spans", *(f"n_{r.kind}" for r in rules)} - {text})
    found = per_blob(scan(docs, rules, text=text), rules)
    counts = {f"n_{r.kind}": F.coalesce(F.col(f"n_{r.kind}"), F.lit(0)).cast("long") for r in rules}
    return spread_join(docs.withColumn("blob", blob_of(text_or_empty(text))), found, "blob").withColumns(counts | {"spans": F.coalesce("spans", F.lit(""))})


def incremental(states: Iterable[DataFrame], folder: str, rules: tuple[Rule, ...] = RULES, text: str = "text", first: int = 0) -> DataFrame:
    """Findings of all blobs of the states of a corpus, one after the other, ``first`` being the number of the first one given: each scans what the ledger lacks.

    A state's findings and then its ledger rows, the sign that it is done, are written under its number in folder. A run that stopped in between writes the same numbers again and skips what is done, so
    nothing is listed twice; a later run goes on with further numbers.
    """
    parts = lambda name, upto: [f"{folder}/{name}/state={n}" for n in range(upto)]
    schemas = {"findings": "blob string, kind int, start long, end long", "ledger": "blob string, kind string, version int"}
    for number, docs in enumerate(states, first):
        spark = docs.sparkSession
        ledger = spark.read.schema(schemas["ledger"]).parquet(*parts("ledger", number)) if number else None
        here = {name: f"{folder}/{name}/state={number}" for name in schemas}
        if _done(spark, here["ledger"]):
            continue
        found, rows = scan(docs, rules, ledger, text), ledger_rows(docs, rules, text)
        if ledger is not None:
            rows = rows.join(ledger, ["blob", "kind", "version"], "left_anti")
        found.select("blob", "kind", F.col("start").cast("long"), F.col("end").cast("long")).write.mode("overwrite").parquet(here["findings"])
        rows.write.mode("overwrite").parquet(here["ledger"])
    return spark.read.schema(schemas["findings"]).parquet(*parts("findings", number + 1))


def _done(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def states_of(docs: DataFrame) -> list[DataFrame]:
    """Two states of a corpus that grows: about half of the documents, by a hash of doc_id, and all of them."""
    return [docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), docs]


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = per_blob(incremental(states_of(docs), f"{shared_folder(spark)}/changeloom/secrets-{uuid.uuid4().hex}"))
    paths = docs.select("doc_id", blob_of(text_or_empty()).alias("blob"))
    spans = F.coalesce("spans", F.lit(""))
    return spread_join(paths, found, "blob").select("doc_id", *[F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in RULES], F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
rules(kind, k, pattern, least, g) AS (VALUES
  ('assign', 0, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6, 2),
  ('access', 1, 'AKIA[A-Z0-9]+', 20, 0), ('hex', 2, '[0-9a-f]+', 24, 0)),
z AS (SELECT rid, kind, k, least, pattern, g, list_zip(regexp_split_to_array(text, pattern), regexp_extract_all(text, pattern)) AS pieces FROM d, rules),
u AS (SELECT rid, kind, k, least, pattern, g, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM z),
s AS (SELECT rid, kind, k, least, pattern, g, piece[2] AS m, sum(length(piece[1]) + coalesce(length(piece[2]), 0)) OVER (PARTITION BY rid, k ORDER BY i) AS stop FROM u),
f AS (SELECT rid, kind, k, (stop - length(m))::BIGINT AS start, stop::BIGINT AS stop FROM s
      WHERE m IS NOT NULL AND length(CASE WHEN g = 2 THEN regexp_extract(m, '^(?:[a-zA-Z_]+)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) ELSE m END) >= least),
a AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)
"""
