"""Token-id files: Parquet list columns in ascending doc_id order.

File format. A dataset of Parquet files, one for each range of doc_ids, named
in range order. One row for each document: ``shard`` (the file's place),
``doc_id``, ``row_hash`` (order of rows that share a doc_id), ``n_tokens``,
``ids`` (list of int32, the end id last). Ids are dictionary-encoded (delta
where a dictionary gets too large), zstd-compressed, in row groups of
``ROW_GROUP`` bytes and pages of ``PAGE_ROWS`` rows at most, with page indexes:
a reader of metadata touches no ids, a reader of some documents only their
pages (:func:`read_tokens`).

Encoding. The byte-level tokenizer splits text before its merges. A batch of
texts is cut where a split always falls, each distinct chunk is encoded once
and the ids are joined back by position (``chunks.ChunkTable``); a text that
holds the string of a special token goes to the library whole. Both ways give
the library's own ids. A task holds a batch of texts (16 MB, or one longer
text), the ids of 8 MB of text and a table of 40 MB, and gives them back at its end.

Defined results: a null or empty text is the end id alone; rows that share a
doc_id are kept apart, ordered by the hash of their text; null doc_ids come
first; an empty table gives an empty dataset.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm import chunks
from stationflow.llm.common import text_hash, thrifty, utf8
from stationflow.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
ROW_GROUP, PAGE_ROWS = 16 << 20, 256
TEXT_BYTES = 8 << 20  # text that is encoded at a time, in whole texts

SCHEMA = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("row_hash", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
])


class Encoder:
    """One tokenizer with the chunks that it has met."""

    def __init__(self, name: str = TOKENIZER):
        self.library = chunks.byte_level(name, plain_specials=False)
        self.special = "|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values())
        self.table = chunks.byte_level_table(self.library)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        ids, off = self._ids(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in pairwise(off.tolist())]

    def encode_column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, ``end_id`` behind each text, and where each text's ids begin (n + 1 places)."""
        ids, off = self._ids(pc.fill_null(texts, ""))
        return np.insert(ids, off[1:], end_id), off + np.arange(len(off))

    def _ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, self.special) if self.special else pa.array(np.zeros(len(texts), bool))
        buf, at = utf8(pc.if_else(odd, "", texts))
        starts = chunks.split_starts(buf, at)
        ids, upto = self.table.ids(buf, starts)
        off = upto[np.searchsorted(starts, at)]
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(whole):
            own = [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(texts.take(pa.array(whole)).to_pylist(), add_special_tokens=False)]
            size = np.zeros(len(off), np.int64)
            size[whole + 1] = [len(x) for x in own]
            ids = np.insert(ids, np.repeat(off[whole], size[whole + 1]), np.concatenate(own))
            off = off + np.cumsum(size)
        return ids, off


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Encode every document and write the dataset to ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            for a, b in chunks.slices(batch.column(3), TEXT_BYTES):
                part = batch.slice(a, b - a)
                ids, off = encoder.encode_column(part.column(3), end_id)
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.diff(off)), lists], names=[f.name for f in SCHEMA])
        del encoder

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("row_hash"), "text")
    ordered = rows.repartitionByRange("doc_id", "row_hash").sortWithinPartitions("doc_id", "row_hash")
    ordered = ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "row_hash", "text")
    (
        ordered.mapInArrow(thrifty(run), SCHEMA).write.mode("overwrite")
        .option("compression", "zstd").option("parquet.block.size", ROW_GROUP).option("parquet.enable.dictionary", "true")
        .option("parquet.writer.version", "PARQUET_2_0").option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def starts(index: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rows with ``start``: how many ids stand before each document.

    Sums for each file first (from two columns of the files), then inside a file.
    """
    files = tokens.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = files.select(F.col("shard").alias("file"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("doc_id", "row_hash")
    upto = F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return index.join(files, F.col("shard") == F.col("file")).withColumn("start", F.col("base") + upto).drop("file", "base")


def checksums(tokens: DataFrame) -> DataFrame:
    """The metadata of each document with the crc32 of its ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(4)
            flat, off = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4"), ids.offsets.to_numpy()
            view = memoryview(flat).cast("B")
            crc = [zlib.crc32(view[4 * i : 4 * j]) for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(crc, pa.int64())], names=["shard", "doc_id", "row_hash", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(thrifty(run), "shard int, doc_id bigint, row_hash bigint, n_tokens bigint, ids_crc32 bigint")


def encode_documents(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write the documents' ids, read the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    write_tokens(docs, path, tokenizer, end_id)
    tokens = read_tokens(spark, path)
    return starts(checksums(tokens), tokens).select("doc_id", "start", "n_tokens", "ids_crc32")
