"""SentencePiece encoding and decoding against the library itself."""

from __future__ import annotations

import hashlib
import random

import pytest

from stationflow.llm import chunks, pieces
from stationflow.llm.common import ship

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

PARTS = [" ", "  ", "\n", "▁", "a", "the", "été", "日本", "\x00", "\t", "<s>", "</s>", "<0x41>", "😀", "x" * 300, "1", "é́", " ", "　", "�", "."]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    made = [(10 + i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 30)))) for i in range(600)]
    # null, empty, markers alone, repeated rows, a shared id, a null id, a long word, a long text
    return [(1, None), (2, ""), (3, " "), (4, "▁"), (5, "a b"), (5, "a b"), (5, "c"), (None, "  a "), (6, "word" * 50_000), (7, "many words here " * 20_000), *made]


def test_ids_are_the_librarys(spark, rows, library):
    ship(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pieces.encode_documents(df, ["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert list(r.ids) == [*library.encode(r.text or ""), 2]


def test_decoding_any_ids_is_the_librarys(spark, library):
    ship(spark)
    rnd = random.Random(4)
    some = [0, 1, 2, 3, 13, 195, 200, 230, 259, 264, 28705, 28725, 29137]
    lists = [(i, [rnd.choice([*some, rnd.randrange(32000)]) for _ in range(rnd.randint(0, 12))]) for i in range(1500)] + [(-1, None)]
    df = spark.createDataFrame(lists, "doc_id long, ids array<int>")
    for r in pieces.decode_documents(df, ["doc_id", "ids"]).collect():
        assert r.text == library.decode(list(r.ids or []))


def test_query_columns(spark, rows, library):
    from stationflow.llm.queries import encoded_and_decoded

    got = encoded_and_decoded(spark.createDataFrame(rows, "doc_id long, text string")).collect()

    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = []
    for d, t in rows:
        ids = [*library.encode(t or ""), 2]
        want.append((d, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table_and_clashing_columns(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "a b", "x", 7)], "doc_id long, text string, ids string, k0 int")
    enc = pieces.encode_documents(df, ["doc_id", "ids", "k0", "text"])
    assert enc.columns == ["doc_id", "ids", "k0", "text", "_ids"]
    assert [r[:4] for r in enc.collect()] == [(1, "x", 7, "a b")]
    assert pieces.digests(pieces.encode_documents(df.limit(0), ["doc_id"])).count() == 0
    back = pieces.decode_documents(enc, ["text", "k0"], ids="_ids")
    assert [tuple(r) for r in back.collect()] == [("a b", 7, "a b")] and back.columns == ["text", "k0", "_text"]


def test_table_keeps_two_generations_and_no_long_chunk(library, monkeypatch):
    asked = []
    table = chunks.ChunkTable(lambda c: asked.extend(c) or [b"\x01\x00\x00\x00"] * len(c))
    table._found([b" a", b" a" * 200])
    table._found([b" a", b" a" * 200])
    assert asked == [b" a", b" a" * 200, b" a" * 200]
    # what was met since the last generation is kept, what was not is asked for again
    monkeypatch.setattr(chunks, "KEPT_BYTES", 160)  # a little more than one chunk
    table._found([b" b"])
    table._found([b" b"])  # from the older generation now
    table._found([b" a"])
    assert asked[3:] == [b" b"]
    table._found([b" c"])
    table._found([b" d"])
    table._found([b" b"])  # not met for two generations
    assert asked[4:] == [b" c", b" d", b" b"]


def test_a_model_whose_pieces_cross_markers_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path(pieces.MODEL), "rb") as f:
        proto.ParseFromString(f.read())
    proto.pieces[300].piece = "a▁b"
    path = tmp_path / "crossing.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="cross"):
        chunks.piece_model(str(path))
