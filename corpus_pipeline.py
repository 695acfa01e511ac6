"""From raw documents to encoded training text: STAGES in order, each (spark, docs, sf_dir) -> DataFrame.

Every stage works on all that the one before kept. All but the last return the columns of documents, and only these: others, whatever their names, are left out first.

Cases: empty and null texts, null doc_ids and sources pass every stage unless the classifier rejects them; repeated rows are one document after the second stage, and of documents with one doc_id and
different texts each is its own; of near copies the smallest doc_id stays, of equal doc_ids the smaller SHA-256 of the text; texts are worked on whole however long they are; an empty table gives an empty
result (the classifier then has no rows and no rejects).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import jaccard_join, mixing, pieces, quality, secrets
from changeloom.llm.common import discard, spread_join, stored, table, text_or_empty

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WIDTH, THRESHOLD, SPARE = 5, (80, 100), 0.2
MASK = "[secret]"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on the labels of training folds, as in op1."""
    model = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality.scored(docs.select(*COLUMNS), model).where(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that chains of near copies join (five-word shingles, Jaccard 0.8) the one with the smallest doc_id stays."""
    digest = F.sha2(text_or_empty().cast("binary"), 256)
    keyed = docs.select(*COLUMNS, F.struct("doc_id", digest.alias("digest")).alias("row_key"))
    groups = jaccard_join.join(keyed.select("row_key", "text"), WIDTH, THRESHOLD, key="row_key", spare_share=SPARE, with_links=False)
    stays = groups.where(F.col("row_key") == F.col("component_id")).select("row_key").distinct().withColumn("stays", F.lit(True))
    # a row that repeats is dealt to many tasks, and dropped in each before the last shuffle
    return spread_join(keyed, stays, "row_key").where("stays").dropDuplicates(["row_key"]).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by MASK, and n_chars follows."""
    found = secrets.per_blob(secrets.scan(docs.select("text"))).select("blob", "found")
    marked = docs.select(*COLUMNS, secrets.blob_of(text_or_empty()).alias("blob"))
    marked = spread_join(marked, found, "blob")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = lambda acc, x: F.struct(  # noqa: E731  spans are sorted by start; what overlaps an earlier one only lengthens it
        F.greatest(acc["at"], x["end"]).alias("at"),
        F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.substr(F.col("text"), (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")), F.lit(MASK))).alias("out"),
    )
    masked = F.aggregate("found", start, step, lambda acc: F.concat(acc["out"], F.substr(F.col("text"), (acc["at"] + 1).cast("int"))))
    text = F.when(F.col("found").isNull(), F.col("text")).otherwise(masked)
    return marked.withColumn("n_chars", F.when(F.col("found").isNull(), F.col("n_chars")).otherwise(F.length(masked).cast("long"))).withColumn("text", text).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as systematic sampling to the sources' targets takes it (up to 3 times, maybe never)."""
    sized = docs.select("doc_id", "source", mixing.words(F.col("text")).alias("size"), F.struct(*COLUMNS).alias("doc"))
    taken = mixing.copies(sized).where("copies > 0").withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs)


STAGES = [("quality classifier", keep_quality), ("n-gram Jaccard join", one_of_each_group), ("secret scans", mask_secrets), ("mixing sources", mix_sources), ("SentencePiece", encode)]

#: A fitted model and a tokenizer are not expressible in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        before, docs = docs, stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"stage-{number}")
            if number > 1:
                discard(spark, before)  # the stage before last has been read
    return docs
