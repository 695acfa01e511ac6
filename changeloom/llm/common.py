"""What the operators of this package share: reading tables, cutting lineage, word patterns."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Hot keys of spread_join.
SPREAD_FROM, SPREAD_MOST, SALTS = 1000, 1000, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the one that setCheckpointDir was given. Without either, stored tables have no place that all can see, so it fails."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not held.isDefined():
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = held.get()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage, survives the loss of executors, and is columnar, thus smaller than checkpoint()."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/changeloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more. The driver's JVM is asked to collect plans that are done with, since their shuffle files stay on disk until it does."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.System.gc()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unused(name: str, *tables: DataFrame) -> str:
    """A column's name that none of the tables has, in whatever case."""
    taken = {c.lower() for df in tables for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _hashable(df: DataFrame) -> list[Column]:
    """All columns but those whose types Spark has no hash for."""
    return [F.col(f"`{f.name}`") for f in df.schema if not re.search("map<|variant", f.dataType.simpleString())]


def spread_join(left: DataFrame, right: DataFrame, on: str, counted: DataFrame | None = None) -> DataFrame:
    """left with the columns of right (at most one row a key) where there is one, else nulls: a left join that hot keys and nulls don't put into one task.

    Keys with SPREAD_FROM rows or more, the SPREAD_MOST largest, are dealt to SALTS tasks each by a hash of left's rows and the partitions that they come from (so repeated rows are dealt too), and right's
    rows of these keys are copied as often; what is not among them has less than 1/SPREAD_MOST of the rows. Rows whose key is null meet nothing and are dealt likewise. Columns of left that right has too are
    replaced; all others, whatever their names, are kept. counted: rows with the same keys to count instead of left's, where those are costly to compute.
    """
    left = left.drop(*[c for c in left.columns if c.lower() in {r.lower() for r in right.columns} - {on.lower()}])
    n, hot, salt = (unused(x, left, right) for x in ("n", "hot", "salt"))
    keys = (left if counted is None else counted).select(on).where(F.col(on).isNotNull())
    counts = keys.groupBy(on).agg(F.count("*").alias(n)).where(F.col(n) >= SPREAD_FROM)
    most = counts.orderBy(F.desc(n), on).limit(SPREAD_MOST).select(on).collect()
    kept = [F.col(f"`{c}`") for c in (*left.columns, *[c for c in right.columns if c != on])]
    dealt = F.pmod(F.xxhash64(*_hashable(left), F.spark_partition_id()), F.lit(SALTS)).cast("int")
    if not most:
        salted = left.withColumn(salt, F.when(F.col(on).isNull(), dealt).otherwise(0))
        return salted.join(right.withColumn(salt, F.lit(0)), [on, salt], "left").select(*kept)
    marks = F.broadcast(left.sparkSession.createDataFrame(most, left.select(on).schema).withColumn(hot, F.lit(True)))  # SPREAD_MOST keys at most
    salted = left.join(marks, on, "left").withColumn(salt, F.when(F.col(hot) | F.col(on).isNull(), dealt).otherwise(0)).drop(hot)
    copied = right.join(marks, on, "left").withColumn(salt, F.explode(F.when(F.col(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop(hot)
    return salted.join(copied, [on, salt], "left").select(*kept)
