"""Token ids as Parquet list columns, laid out for selective reads.

A folder of token files holds the documents in ascending order of doc_id, by ranges: file after file, row after row (null doc_ids first; rows that share a doc_id in the order of a digest of their
text). Each row has doc_id, n_tokens and ids. Spark's own writer makes the files: ids are dictionary-encoded per row group and fall back to delta encoding (writer version 2) where the dictionary would
outgrow ``dictionary_bytes``; row groups and pages are small enough (``group_bytes``, ``page_bytes``) for their statistics and page indexes to pay: since doc_id is sorted, a read of some documents
opens a few pages, and a read of counts never touches the ids. A place in the whole stream of ids is a file's offset (`offsets`: one row a file) plus the counts before it in its file.

Ids are the tokenizers library's for each whole text, special strings as its default, without added tokens, and an end id after each document. White space separates what it encodes, so texts are divided into chunks
at ASCII white space and each distinct chunk of some texts is looked up once, in a bounded memo that has chunks without the symbols at their ends; those that are new go through the library together, divided by a
control character that has an id of its own.

Cases: a null text is empty and gives the end id alone; null doc_ids and repeated rows are rows like any others; texts are encoded whole, however long; an empty table gives files without rows;
other columns, whatever their names, don't take part.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.llm.common import shared_folder, table, text_or_empty
from changeloom.llm.shingles import portions

END = 2
DIVIDER = "\x01"
#: Letters that stay letters in lower case.
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+")
#: What lower() of a text may treat otherwise than the tokenizer does: characters beyond the first letters.
UNPLAIN = re.compile("[\u0130-\U0010ffff]")
#: Symbols that are a piece of their own at a chunk's end, if a letter is before them.
STOPS = ".,;:!?#$%&*"
#: Entries of each half of the memo, and the longest chunk that it keeps.
MEMO, KEPT = 400_000, 40
#: Bytes of text that Python holds at once, whose distinct chunks are looked up; one longer text is taken alone.
BYTES = 2 << 20


class Encoder:
    """Texts -> ids as packed 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Chunks' ids: what has been met lately, and before; a half that is full takes the older one's place.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Whether a token ends a piece.
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.tokenizer.get_vocab_size())])
        own = self._ids(DIVIDER)
        self.divider = own[0] if len(own) == 1 else None

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Chunks' ids, through the library. Words of plain letters are pieces of one end each; others need a divider."""
        words = [c for c in chunks if LETTERS.fullmatch(c)]
        out = self._divided(words, " ", lambda ids: (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist(), 0) if words else {}
        if self.divider is not None:
            others = [c for c in chunks if c not in out and DIVIDER not in c]
            if others:
                out |= self._divided(others, f" {DIVIDER} ", lambda ids: [*(4 * np.flatnonzero(ids == self.divider)).tolist(), 4 * len(ids)], 4)
        return out | {c: np.array(self._ids(c), np.int32).tobytes() for c in chunks if c not in out}

    def _divided(self, chunks: list[str], divider: str, ends_of, skipped: int) -> dict[str, bytes]:
        ids = np.array(self._ids(divider.join(chunks)), np.int32)
        packed, ends = ids.tobytes(), ends_of(ids)
        starts = [0, *(e + skipped for e in ends[:-1])]
        return {c: packed[a:b] for c, a, b in zip(chunks, starts, ends, strict=True)}

    def encode(self, texts: list[str]) -> list[bytes]:
        lists = self.lists(texts)
        ids, ends = lists.values.to_numpy(), lists.offsets.to_pylist()
        return [ids[a:b].tobytes() for a, b in pairwise(ends)]

    def lists(self, texts: list[str], end: int | None = None) -> pa.ListArray:
        """The texts' ids, with the end id behind each, if there is one."""
        chunks = pc.ascii_split_whitespace(pa.array([self._lowered(t) for t in texts], pa.string()))
        words = chunks.flatten().dictionary_encode()
        # after a letter, symbols at a chunk's end are a piece of their own (not so after the one letter that ends in a mark in lower case): each word is a core and what follows it, mostly nothing
        whole = words.dictionary
        core = pc.ascii_rtrim(whole, STOPS)
        core = pc.if_else(pc.match_substring_regex(core, "[^\\P{L}\u0130]$"), core, whole)
        follows = (pc.binary_length(whole).to_numpy() - pc.binary_length(core).to_numpy()).tolist()
        stops = pa.array([w[-n:] if n else "" for w, n in zip(_strings(whole), follows, strict=True)], pa.string()).dictionary_encode()
        core = core.dictionary_encode()
        last = b"" if end is None else np.array([end], np.int32).tobytes()
        packed = [*self._met(_strings(core.dictionary)), *self._met(_strings(stops.dictionary)), last]
        # of each chunk the core and what follows, and the end behind each text
        of, ends = words.indices.to_numpy(), chunks.offsets.to_numpy()[1:].astype(np.int64)
        order = np.empty((len(of), 2), np.int32)
        order[:, 0], order[:, 1] = core.indices.to_numpy()[of], stops.indices.to_numpy()[of] + np.int32(len(core.dictionary))
        order = np.insert(order.reshape(-1), 2 * ends, len(packed) - 1)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        each = pa.ListArray.from_arrays(_offsets(sizes), pa.array(np.frombuffer(b"".join(packed), np.int32)))
        offsets = _offsets(sizes[order]).take(pa.array(np.append(0, 2 * ends + np.arange(1, len(texts) + 1))))
        return pa.ListArray.from_arrays(offsets, each.take(pa.array(order)).flatten())

    @staticmethod
    def _lowered(text: str) -> str:
        """Plain text in lower case, which the tokenizer makes of it too, so that the memo has each word once."""
        try:
            text.encode("latin-1")  # takes less time than a search
        except UnicodeEncodeError:
            if UNPLAIN.search(text):
                return text
        return text if "<|" in text else text.lower()

    def _met(self, words: list[str]) -> list[bytes]:
        """Ids of different chunks: from the memo, whose younger half then has them, or through the library."""
        found = list(map(self.memo.get, words))
        lacking = [k for k, i in enumerate(found) if i is None]
        older = {w: i for k in lacking if (i := self.older.get(w := words[k])) is not None}
        learnt = self._learn([w for k in lacking if (w := words[k]) not in older])
        for k in lacking:
            w = words[k]
            i = older.get(w)
            found[k] = i = learnt[w] if i is None else i
            if len(w) <= KEPT:
                self.memo[w] = i
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
        return found


def _strings(x: pa.StringArray) -> list[str]:
    return x.to_numpy(zero_copy_only=False).tolist()


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, sizes.cumsum()).astype(np.int32))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END, files: int | None = None, group_bytes: int = 16 << 20, page_bytes: int = 64 << 10, dictionary_bytes: int = 1 << 20) -> None:
    """docs (doc_id, text) as token files under folder. files: how many ranges of doc_id (the session's number of shuffle partitions); vocabulary: path of the file, None finds word_bpe_49k.json."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    text = text_or_empty()
    # rows of one doc_id may be a third of all: the digest of the text, and where a row comes from, split them
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64(text), F.spark_partition_id()]
    ranged = docs.select("doc_id", "text").repartitionByRange(*([files] if files else []), *keys).select("doc_id", text.alias("text"), F.xxhash64(text).alias("digest")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "digest")
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("n_tokens long, ids array<int>")])
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        made = encoder(vocabulary or public_tokenizers.path("word_bpe_49k.json"))
        for batch in batches:
            for low, high in portions(pc.binary_length(batch.column(1)).to_pylist(), BYTES):
                part = batch.slice(low, high - low)
                ids = made.lists(part.column(1).to_pylist(), end)
                sizes = pc.list_value_length(ids).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, ids.cast(shape.field("ids").type)], schema=shape)

    encoded = ranged.select("doc_id", "text").mapInArrow(run, schema)
    options = {
        "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": group_bytes, "parquet.page.size": page_bytes, "parquet.dictionary.page.size": dictionary_bytes,
        "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false", "parquet.page.write-checksum.enabled": "true", "compression": "snappy",
    }
    encoded.write.options(**options).parquet(folder)


def read(spark: SparkSession, folder: str, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids"), low=None, high=None) -> DataFrame:
    """Some columns of token files, of documents with ids from low to high where these are given: the filter reaches row groups and pages, and columns that aren't asked for aren't read."""
    rows = spark.read.parquet(folder)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows.select(*columns)


FILE = "CAST(regexp_extract(_metadata.file_name, '^part-([0-9]+)', 1) AS INT)"


def offsets(spark: SparkSession, folder: str) -> DataFrame:
    """file, start, n_tokens, low, high: one row a file that has rows, from the counts alone."""
    per_file = spark.read.parquet(folder).selectExpr(f"{FILE} AS file", "doc_id", "n_tokens").groupBy("file").agg(F.sum("n_tokens").alias("n_tokens"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return per_file.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"), "n_tokens", "low", "high")


def placed(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, file, row (within the file), start, n_tokens of all documents, from the counts alone."""
    rows = spark.read.parquet(folder).selectExpr("doc_id", "n_tokens", f"{FILE} AS file", "_metadata.row_index AS row")
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    starts = offsets(spark, folder).select("file", F.col("start").alias("file_start"))
    return rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(starts, "file").select("doc_id", "file", "row", (F.col("file_start") + F.col("inside")).alias("start"), "n_tokens")


def tokens_between(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """doc_id, start, ids: the stretch [start, stop) of the whole stream, by document; only files that it meets are read for their ids."""
    met = placed(spark, folder).where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    ids = spark.read.parquet(folder).selectExpr(f"{FILE} AS file", "_metadata.row_index AS row", "ids")
    wanted = met.join(ids, ["file", "row"])
    skipped = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    taken = F.least(F.lit(stop), F.col("start") + F.col("n_tokens")) - F.col("start") - skipped
    return wanted.select("doc_id", (F.col("start") + skipped).alias("start"), F.slice("ids", (skipped + 1).cast("int"), taken.cast("int")).alias("ids"))


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents, read back from the files."""
    rows = spark.read.parquet(folder).selectExpr("doc_id", "ids", f"{FILE} AS file", "_metadata.row_index AS row")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            ends, values = ids.offsets.to_numpy(), np.ascontiguousarray(ids.values.to_numpy(), "<u4")
            sums = [zlib.crc32(values[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())], names=["doc_id", "file", "row", "n_tokens", "ids_crc32"])

    read_back = rows.mapInArrow(run, f"doc_id {kind}, file int, row long, n_tokens long, ids_crc32 long")
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    starts = offsets(spark, folder).select("file", F.col("start").alias("file_start"))
    return read_back.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(starts, "file").select("doc_id", (F.col("file_start") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/changeloom/tokens-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), folder)
    return checksums(spark, folder)
