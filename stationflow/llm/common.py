"""Helpers shared by the corpus operators: table access, whitespace words, Arrow text columns.

Every operator first projects its input to the columns it names, so extra
columns (also ones that clash with internal names) never reach a join.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words of the contracts are runs of bytes outside 0x20 and 0x09-0x0D. ``bytes.split()``
# splits on exactly these six bytes, and no byte of a multi-byte UTF-8 character is one of them.
ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(ASCII_SPACE)] = True


PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


ARROW_BATCH = 16 << 20


def ship(spark: SparkSession) -> None:
    """Prepare a session: bound the batches of texts, and send this package's sources to the executors.

    Python workers import the sources, which go out once for each application.
    """
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size) == "67108864b":  # Spark's default; a size that the user has set stays
        spark.conf.set(size, f"{ARROW_BATCH}b")
    sc = spark.sparkContext
    if getattr(sc, "_stationflow_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="stationflow-src-"), "stationflow_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(PACKAGE):
            for n in sorted(x for x in names if x.endswith(".py")):
                at = os.path.join(folder, n)
                z.write(at, os.path.relpath(at, os.path.dirname(PACKAGE)))
    sc.addPyFile(target)
    sc._stationflow_shipped = True


def give_back() -> None:
    """Return memory that a task no longer uses to the system: its worker lives on, next to others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a system without that call
        return


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A task's function that gives memory back when its batches end."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def text_hash(col: str = "text") -> Column:
    """XXH64 of a text, null as its own value: tells rows that share a doc_id apart."""
    return F.xxhash64(F.col(col), F.col(col).isNull())


def carried(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, int]:
    """The kept columns as k0, k1, ... and the place of the text among them (last, as t, if it is not kept)."""
    columns = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    if "text" in keep:
        return docs.select(*columns), keep.index("text")
    return docs.select(*columns, F.col("text").alias("t")), len(keep)


def fresh(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that no column has."""
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name


def held_out(doc_id: str, mod: int, rest: int) -> Column:
    """True where crc32(doc_id as text) mod ``mod`` is ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == rest, F.lit(False))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of an Arrow string or binary column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    if column.null_count:
        column = column.cast(kind).fill_null(b"")
    _, offsets, data = column.buffers()
    dtype = np.int64 if kind == pa.large_binary() else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, dtype)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    return buf, off - off[0]


def raw_texts(column: pa.Array) -> list[bytes]:
    """The column as a list of UTF-8 byte strings; a null is empty."""
    buf, off = utf8(column)
    data = buf.tobytes()
    return [data[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def count_words(column: pa.Array) -> np.ndarray:
    """Whitespace words of each text, by counting word starts (no strings are made)."""
    buf, off = utf8(column)
    n = len(off) - 1
    if not len(buf):
        return np.zeros(n, np.int64)
    word = ~IS_SPACE[buf]
    start = word.copy()
    start[1:] &= ~word[:-1]
    inner = off[:-1][(off[:-1] < off[1:]) & (off[:-1] > 0)]
    start[inner] = word[inner]  # the first byte of a text starts a word whatever text comes before
    seen = np.concatenate(([0], np.cumsum(start, dtype=np.int64)))
    return seen[off[1:]] - seen[off[:-1]]


def numbered(docs: DataFrame, also: list[str] = []) -> tuple[DataFrame, list[str]]:  # noqa: B006
    """The rows with key columns that together name one row, and the keys' names.

    The keys: whether doc_id is null, doc_id (0 if null), the text's hash, for
    each column of ``also`` whether it is null and its value ('' if null), and a
    number from 1 among rows that agree in these. The number follows the other
    columns' values, so it does not depend on the rows' order in the input. The
    rows end up dealt by the first keys, so a join on them moves the texts no further.
    """
    keys: list[str] = []
    for k in ("no_id", "id", "hash", *(f"{n}_{c}" for c in also for n in ("no", "in")), "copy"):
        keys.append(fresh(f"_{k}", [*docs.columns, *keys]))
    made = [F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), text_hash()]
    for c in also:
        made += [F.col(f"`{c}`").isNull(), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))]
    rows = docs.withColumns(dict(zip(keys[:-1], made, strict=True)))
    others = [F.col(f"`{c}`").cast("string") for c in docs.columns if c not in ("doc_id", "text", *also)]
    same = Window.partitionBy(*keys[:-1]).orderBy(*([F.to_json(F.struct(*others))] if others else [F.lit(1)]))
    return rows.withColumn(keys[-1], F.row_number().over(same)), keys
