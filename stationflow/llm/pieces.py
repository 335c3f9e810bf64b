"""SentencePiece encoding and decoding through a distinct-chunk table.

No piece of the model has a white space marker behind another character
(checked when the model is read), so a marked word, which is a run of markers
with what follows up to the next one, is segmented alike wherever it stands.
Each task cuts its texts into marked words, segments each distinct one once
with the library and joins the ids back by position (``chunks.ChunkTable``).

Decoding looks up what each id stands for and joins these strings; the first
marker of a text is dropped. Lists that the table cannot stand for (an unknown
id, a first piece without a marker, bytes that are no UTF-8) go to the library.

Memory: a task holds a batch of texts (16 MB, or one longer text), the ids of
4 MB of text and a table of 40 MB. No shuffle, nothing on the driver.

Defined results: a null or empty text has the end id alone and decodes to an
empty text; U+2581 in a text is a space to the library and decodes to one;
strings of control pieces in a text are ordinary text; a text of any length is
encoded whole (a word without spaces is one chunk and not kept in the table);
repeated rows, ties and null ids are rows like any other; an empty table gives
an empty result; of the input only the kept columns and ``text`` are read, and
the new columns take other names where these clash (``_ids``, ``_text``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm import chunks
from stationflow.llm.common import carried, fresh, thrifty

MODEL = "piece_bpe_32k.model"
END_ID = 2


def _ids(column: pa.Array, table: chunks.ChunkTable, end_id: int) -> pa.ListArray:
    """Ids of each text, ``end_id`` last."""
    buf, off = chunks.spaced(pc.replace_substring(column, "▁", " "))
    starts = chunks.marked_starts(buf, off)
    ids, upto = table.ids(buf, starts)
    ends = upto[np.searchsorted(starts, off)]
    ids = np.insert(ids, ends[1:], end_id)
    return pa.ListArray.from_arrays(pa.array((ends + np.arange(len(ends))).astype(np.int32)), pa.array(ids, pa.int32()))


def encode_documents(docs: DataFrame, keep: list[str], model: str = MODEL, end_id: int = END_ID, out: str = "ids") -> DataFrame:
    """The kept columns and the ids of each whole text with ``end_id`` last, as the library gives them."""
    out = fresh(out, keep)
    rows, at = carried(docs, keep)
    fields = [T.StructField(out, T.ArrayType(T.IntegerType(), False))]
    schema = T.StructType([T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunks.piece_table(chunks.piece_model(model))
        for batch in batches:
            for a, b in chunks.slices(batch.column(at)):
                part = batch.slice(a, b - a)
                ids = _ids(part.column(at), table, end_id)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], ids], names=schema.names)

    return rows.mapInArrow(thrifty(run), schema).toDF(*keep, out)


class Decoder:
    """Decodes lists of ids; ``texts`` gives the bytes of all texts in a row and their n + 1 places."""

    def __init__(self, model):
        self.model = model
        strings = chunks.piece_bytes(model)
        self.joiner = chunks.Joiner(strings)
        self.opens = np.array([s.startswith(b" ") and model.id_to_piece(i)[0] == "▁" for i, s in enumerate(strings)])
        self.control = np.array([model.is_control(i) for i in range(len(strings))])
        self.byte = np.array([model.is_byte(i) for i in range(len(strings))])
        self.unknown = model.unk_id()

    def texts(self, ids: np.ndarray, off: np.ndarray) -> list[memoryview | bytes]:
        buf, places = self.joiner.join(ids), self.joiner.places(ids)
        data, at = memoryview(np.ascontiguousarray(buf)), places[off].tolist()
        full = np.flatnonzero(off[:-1] < off[1:])
        first = ids[off[full]]
        drop, other = np.zeros(len(off) - 1, np.int64), np.zeros(len(off) - 1, bool)
        drop[full] = self.opens[first]
        # a list of the end id alone is empty; another beginning is left to the library
        other[full] = ~self.opens[first] & ~(self.control[first] & (off[full + 1] - off[full] == 1))
        rows = np.repeat(np.arange(len(off) - 1), np.diff(off))
        other[rows[ids == self.unknown]] = True
        out: list[memoryview | bytes] = [data[a + d : b] for a, b, d in zip(at[:-1], at[1:], drop.tolist(), strict=True)]
        for i in np.unique(rows[self.byte[ids]]).tolist():
            try:
                str(out[i], "utf-8")
            except UnicodeDecodeError:
                other[i] = True
        for i in np.flatnonzero(other).tolist():
            out[i] = self.model.decode(ids[off[i] : off[i + 1]].tolist()).encode()
        return out


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids and offsets of a list column; a null list is empty."""
    column = column.fill_null([]) if column.null_count else column
    off = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]], off - off[0]


def _parts(batch: pa.RecordBatch, at: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Row ranges of about ``most`` ids; a longer list is alone."""
    _, off = _lists(batch.column(at))
    a = 0
    while a < len(batch):
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def decode_documents(rows: DataFrame, keep: list[str], model: str = MODEL, ids: str = "ids", out: str = "text") -> DataFrame:
    """The kept columns and the text of each list of ids."""
    out = fresh(out, keep)
    schema = T.StructType([T.StructField(f"k{i}", rows.schema[c].dataType) for i, c in enumerate(keep)] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(chunks.piece_model(model))
        for batch in batches:
            for part in _parts(batch, len(keep)):
                texts = pa.array([bytes(t) for t in decoder.texts(*_lists(part.column(len(keep))))], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], texts], names=schema.names)

    columns = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    return rows.select(*columns, F.col(f"`{ids}`").alias("i")).mapInArrow(run, schema).toDF(*keep, out)


def digests(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents: their ids' decimal digits and their decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = chunks.piece_model(model)
        decoder, digits = Decoder(sp), chunks.Joiner([b"%d " % i for i in range(sp.get_piece_size())])
        for batch in batches:
            for part in _parts(batch, 1):
                ids, off = _lists(part.column(1))
                text = memoryview(np.ascontiguousarray(digits.join(ids)))
                at = digits.places(ids)[off].tolist()
                shown = [hashlib.sha256(text[a : max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
                back = [hashlib.sha256(t).hexdigest() for t in decoder.texts(ids, off)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(off)), pa.array(shown, pa.string()), pa.array(back, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, schema)
