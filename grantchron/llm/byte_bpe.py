"""Byte-level BPE encoding and decoding (2) by a file of ranks.

The tokenizers library works on characters, one for each byte; `byte_characters` is that
mapping. Each match of public_tokenizers.PATTERN is encoded on its own, and workers keep the
ids of pre-tokens they have met.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType
from tokenizers import Tokenizer, models, pre_tokenizers

from grantchron.llm.pretokens import PieceCache, slices, split


@cache
def byte_characters() -> list[str]:
    """For each byte the character that stands for it: itself if printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}


@cache
def rank_tokenizer(path: str) -> Tokenizer:
    """The library's tokenizer that merges, as ranks do, the pair whose bytes rank lowest.

    A token may come from several pairs, so each of them is a merge, next to each other in
    order. Of two overlapping pairs with one result, x+y and y+z, the ranks take the left one;
    so does listing longer left parts first.
    """
    ranks, names = read_ranks(path), byte_characters()
    named = {word: "".join([names[b] for b in word]) for word in ranks}
    merges = [
        (named[word[:cut]], named[word[cut:]])
        for word in sorted(ranks, key=ranks.get)
        for cut in range(len(word) - 1, 0, -1)
        if word[:cut] in ranks and word[cut:] in ranks
    ]
    tokenizer = Tokenizer(models.BPE({named[w]: r for w, r in ranks.items()}, merges))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


#: Pre-tokens that the library encodes in one call.
_TOGETHER = 64


@cache
def _ids(path: str) -> PieceCache:
    """For each pre-token its ids as the bytes of 32-bit numbers."""
    tokenizer = rank_tokenizer(path)

    def encode_pieces(pieces: list[str]) -> Iterator[bytes]:
        groups = [pieces[i : i + _TOGETHER] for i in range(0, len(pieces), _TOGETHER)]
        encoded = tokenizer.encode_batch(groups, is_pretokenized=True, add_special_tokens=False)
        for group, e in zip(groups, encoded, strict=True):
            ids, start = np.array(e.ids, np.int32).tobytes(), 0
            for end in (np.cumsum(np.bincount(e.word_ids, minlength=len(group))) * 4).tolist():
                yield ids[start:end]
                start = end

    return PieceCache(encode_pieces)


@cache
def _ids_and_spans(path: str) -> PieceCache:
    tokenizer = rank_tokenizer(path)
    return PieceCache(
        lambda pieces: [
            (e.ids, e.offsets) for e in tokenizer.encode_batch(pieces, add_special_tokens=False)
        ]
    )


def _lists(values: list[list[int]]) -> pa.Array:
    ends = [0, *accumulate(map(len, values))]
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(list(chain.from_iterable(values)), pa.int32())
    )


def _encoded(
    batches: Iterator[pa.RecordBatch], path: str, offsets: bool = False
) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
    """For parts of batches of (id, text): the ids of rows, and what `encode` adds to them."""
    pieces = (_ids_and_spans if offsets else _ids)(path)
    for part, texts in slices(batches, 1):
        cut = [split(t) for t in texts]
        lookup = pieces.take_in(cut)
        if not offsets:
            rows = [b"".join(map(lookup, c)) for c in cut]
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype(np.int32)
            ids = np.frombuffer(b"".join(rows), np.int32)
            yield part.column(0), [pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))]
            continue
        found = [[lookup(piece) for piece in c] for c in cut]
        at = [[0, *accumulate(map(len, c))] for c in cut]
        pairs = [list(zip(a, f, strict=False)) for a, f in zip(at, found, strict=True)]
        yield part.column(0), [
            _lists([[i for _, (ids, _) in row for i in ids] for row in pairs]),
            _lists([[a + s for a, (_, spans) in row for s, _ in spans] for row in pairs]),
            _lists([[a + e for a, (_, spans) in row for _, e in spans] for row in pairs]),
        ]


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    offsets: bool = False,
) -> DataFrame:
    """Rows (id_col, ids array<int>) of whole texts; other columns of docs are left out.

    With offsets also `starts` and `ends`: the code points of the text that each token covers
    or shares (tokens that split a character all have its place). A null or empty text has no
    tokens; rows with repeated or null ids are each encoded.
    """
    numbers = ArrayType(IntegerType(), containsNull=False)
    fields = [docs.schema[id_col], StructField("ids", numbers)]
    if offsets:
        fields += [StructField("starts", numbers), StructField("ends", numbers)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, columns in _encoded(batches, path, offsets):
            yield pa.RecordBatch.from_arrays([ids, *columns], names=[f.name for f in fields])

    return docs.select(id_col, text_col).mapInArrow(run, StructType(fields))


@cache
def _words(path: str) -> list[bytes | None]:
    """For each id its bytes, by the reverse of the byte table; None for numbers that are no id."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    named = rank_tokenizer(path).get_vocab()
    words: list[bytes | None] = [None] * (max(named.values(), default=-1) + 1)
    for name, i in named.items():
        words[i] = bytes([byte_of[c] for c in name])
    return words


def _joined(column: pa.Array, path: str) -> Iterator[bytes | None]:
    """The bytes of each row of ids; numbers become Python's a row at a time."""
    words, ids = _words(path).__getitem__, column.values.to_numpy()
    edges, there = column.offsets.to_numpy(), column.is_valid().to_pylist()
    for low, high, valid in zip(edges[:-1], edges[1:], there, strict=True):
        yield b"".join(map(words, ids[low:high].tolist())) if valid else None


def decode(ids: str | Column, path: str) -> Column:
    """The bytes of a column of ids; null where the ids are. An unknown id is an error."""

    @F.arrow_udf(BinaryType())
    def run(column: pa.Array) -> pa.Array:
        return pa.array(list(_joined(column, path)), pa.binary())

    return run(ids)


def decode_text(ids: str | Column, path: str) -> Column:
    """The text of a column of ids; a character of which tokens are missing becomes U+FFFD."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        whole = _joined(column, path)
        return pa.array([None if b is None else b.decode("utf-8", "replace") for b in whole], pa.string())

    return run(ids)


def decode_pieces(ids: list[int], path: str) -> list[str]:
    """The text that each id completes: a character split over tokens comes with its last one."""
    words, texts, open_bytes = _words(path), [], b""
    for i in ids:
        open_bytes += words[i]
        whole = open_bytes
        for cut in range(min(4, len(open_bytes) + 1)):
            whole = open_bytes[: len(open_bytes) - cut]
            try:
                texts.append(whole.decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            texts.append(whole.decode("utf-8", "replace"))
        open_bytes = open_bytes[len(whole) :]
    return texts


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode, then decode, in one pass: (id_col, ids, decoded binary)."""
    schema = StructType(
        [
            docs.schema[id_col],
            StructField("ids", ArrayType(IntegerType(), containsNull=False)),
            StructField("decoded", BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, (ids,) in _encoded(batches, path):
            decoded = pa.array(list(_joined(ids, path)), pa.binary())
            yield pa.RecordBatch.from_arrays([rows, ids, decoded], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
