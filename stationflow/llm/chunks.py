"""Distinct-chunk tables: segment each distinct chunk of a column of texts once, and join its ids back by position.

A chunk is a stretch of text at whose ends no token of the tokenizer can
cross. A column is cut into chunks on its bytes, Arrow numbers the distinct
ones, a bounded table (:class:`ChunkTable`, one for each task) holds the ids of
those met before, only the others go to the library, and a gather by position
puts the ids of all chunks in a row.

The table lives in the task, not in a shuffle: sending each occurrence of a
chunk to a table dealt by chunk and its ids back would move the corpus twice.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate, chain, compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stationflow.llm.common import utf8

SLICE_BYTES = 4 << 20  # text that is cut and encoded at a time, in whole texts
KEPT_BYTES = 20 << 20  # chunks and ids of a table's younger generation; the older one has as many
LONGEST = 256  # bytes of a chunk that is kept
SPACE = 32

# fixed values: UTF-8 of the white space above ASCII, as numbers of the last two and three bytes
_WHITE2 = np.array([0xC285, 0xC2A0])
_WHITE3 = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


class ChunkTable:
    """Ids of distinct chunks. ``encode`` gives, for a list of chunks, the ids of each as little-endian 32-bit integers."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        self.encode = encode
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the generation before; what is met again moves to the younger one
        self.held = 0

    def _found(self, values: list[bytes]) -> list[bytes]:
        if self.held > KEPT_BYTES:
            self.kept, self.older, self.held = {}, self.kept, 0
        found = list(map(self.kept.get, values))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            asked = [values[i] for i in new]
            given = list(map(self.older.get, asked))
            unmet = [i for i, ids in enumerate(given) if ids is None]
            for i, ids in zip(unmet, self.encode([asked[i] for i in unmet]), strict=True):
                given[i] = ids
            for i, ids in zip(new, given, strict=True):
                found[i] = ids
            short = [len(c) <= LONGEST for c in asked]
            kept = dict(zip(compress(asked, short), compress(given, short), strict=True))
            self.kept.update(kept)
            self.held += sum(map(len, kept)) + sum(map(len, kept.values())) + 150 * len(kept)
        return found

    def ids(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks that begin at ``starts`` (the first at 0), and how many stand before each chunk and at the end."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        off = np.append(starts, len(buf)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(buf)]).dictionary_encode()
        found = self._found(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy()
        size = np.fromiter(map(len, found), np.int32, len(found)) >> 2
        many = size[codes]
        upto = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(many, out=upto[1:])
        begin = np.cumsum(size, dtype=np.int32) - size
        take = np.repeat(begin[codes] - upto[:-1].astype(np.int32), many)
        take += np.arange(upto[-1], dtype=np.int32)
        return np.frombuffer(b"".join(found), "<i4")[take], upto


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (from, to) of about ``most`` bytes of text each; a longer text is alone."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(size)
    a = 0
    while a < len(size):
        b = int(np.searchsorted(upto, upto[a] - size[a] + most, "right"))
        yield a, max(b, a + 1)
        a = max(b, a + 1)


def spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts with one space before each; a null or empty text stays without."""
    texts = pc.fill_null(column, "")
    return utf8(pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, "")))


def marked_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where chunks of white space markers and what follows them begin: a space at a text's begin or behind another character."""
    space = buf == SPACE
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[off[:-1][off[:-1] < off[1:]]] = True
    return np.flatnonzero(start)


# for byte-level splits: ASCII letters and bytes of U+00C0 to U+00FF, digits, punctuation marks, apostrophe
_LETTER, _DIGIT, _MARK, _QUOTE = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _MARK
_KIND[39] = _QUOTE
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_CUTS = np.zeros((8, 8), bool)  # kinds between which a byte-level split always falls
_CUTS[_LETTER, [_DIGIT, _MARK, _QUOTE]] = _CUTS[_DIGIT, [_LETTER, _MARK, _QUOTE]] = _CUTS[_MARK, [_LETTER, _DIGIT]] = True


def split_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where chunks begin that no byte-level split crosses.

    Spaces as in :func:`marked_starts`, but not behind other white space, and
    changes between letters, digits and marks. An apostrophe may be split with
    the letters behind it, so no chunk begins there.
    """
    space = buf == SPACE
    white = space | ((buf >= 9) & (buf <= 13))
    start = space.copy()
    start[1:] &= ~white[:-1]
    at = np.flatnonzero(start)
    first = off[:-1][off[:-1] < off[1:]]
    high = at[(at > 2) & (buf[at - 1] >= 0x80)]
    if len(high):
        last = (buf[high - 2].astype(np.int64) << 8) | buf[high - 1]
        is_white = np.isin(last, _WHITE2) | np.isin((buf[high - 3].astype(np.int64) << 16) | last, _WHITE3)
        start[high[is_white]] = False
    kind = _KIND[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    lead = lead[(buf[lead + 1] | 0x20) != 0xB7]  # U+00D7 and U+00F7 are no letters
    kind[lead] = kind[lead + 1] = _LETTER
    start[1:] |= _CUTS[kind[:-1], kind[1:]]
    start[first] = True
    return np.flatnonzero(start)


def _packed(lists: list[list[int]]) -> list[bytes]:
    """Each list of ids as bytes."""
    raw = np.fromiter(chain.from_iterable(lists), "<i4", sum(map(len, lists))).tobytes()
    return [raw[a:b] for a, b in pairwise(accumulate((4 * len(x) for x in lists), initial=0))]


@cache
def byte_level(name: str, plain_specials: bool = True):
    """The byte-level tokenizer of a file; with ``plain_specials`` the strings of its special tokens in a text are ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
    library.encode_special_tokens = plain_specials
    if hasattr(library.model, "_resize_cache"):
        library.model._resize_cache(0)  # chunk tables hold what is met again
    return library


# fixed values: the byte-level alphabet. Printable bytes stand for themselves, the others for code points from 256 on
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_SELF))}
SPACE_SIGN = chr(BYTE_ALPHABET[SPACE])
# one split: letters, digits or marks with a space before them at most
_ONE_SPLIT = re.compile(rb" ?(?:(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+|[0-9]+|[!-&(-/:-@[-`{-~]+)")


def byte_level_table(library) -> ChunkTable:
    """Chunks of one split go to the library's merges at once (the byte alphabet is mapped here), others through the whole library."""
    merge = library.model.tokenize

    def encode(chunks: list[bytes]) -> list[bytes]:
        single = [_ONE_SPLIT.fullmatch(c) is not None for c in chunks]
        flat: list[int] = []
        ends = [0]
        for c in compress(chunks, single):
            signs = c.decode().replace(" ", SPACE_SIGN) if c.isascii() else c.decode("latin-1").translate(BYTE_ALPHABET)
            flat += [t.id for t in merge(signs)]
            ends.append(4 * len(flat))
        raw = np.array(flat, "<i4").tobytes()
        done = (raw[a:b] for a, b in pairwise(ends))
        others = [c.decode() for c, s in zip(chunks, single, strict=True) if not s]
        rest = iter(_packed([e.ids for e in library.encode_batch_fast(others, add_special_tokens=False)]) if others else ())
        return [next(done) if s else next(rest) for s in single]

    return ChunkTable(encode)


@cache
def piece_model(name: str):
    """The SentencePiece model of a file, if its chunks are independent: checked on its pieces and its normalizer."""
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    path = name if os.path.isabs(name) else public_tokenizers.path(name)
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    rule = proto.normalizer_spec
    plain = rule.name == "identity" and rule.add_dummy_prefix and not rule.remove_extra_whitespaces and rule.escape_whitespaces
    crossing = any(a != "▁" and b == "▁" for p in proto.pieces for a, b in zip(p.piece, p.piece[1:], strict=False))
    if not plain or crossing or proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == 4 for p in proto.pieces):
        raise ValueError(f"{path}: pieces may cross white space markers, or texts are rewritten before they are segmented")
    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_table(model) -> ChunkTable:
    alone = np.array([model.piece_to_id("▁")], "<i4").tobytes()  # the library gives no ids for an empty text

    def encode(chunks: list[bytes]) -> list[bytes]:
        # the library sets the first marker itself
        return [ids or alone for ids in _packed(model.encode([c[1:].decode() for c in chunks], num_threads=1))]

    return ChunkTable(encode)


def piece_bytes(model) -> list[bytes]:
    """What each id stands for: a piece in UTF-8 with markers as spaces, a byte piece's byte, nothing for control ids."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i):
            out.append(b"")
        elif model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


class Joiner:
    """Joins strings of a table by code, for many rows at once."""

    def __init__(self, strings: list[bytes]):
        self.strings = pa.array(strings, pa.binary())
        self.size = np.array([len(s) for s in strings], np.int64)

    def join(self, codes: np.ndarray) -> np.ndarray:
        """The strings of the codes in a row."""
        return utf8(self.strings.take(pa.array(codes)))[0]

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Where each code's string begins in that row, and the row's length."""
        return np.concatenate(([0], np.cumsum(self.size[codes])))
