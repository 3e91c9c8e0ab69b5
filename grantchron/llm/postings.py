"""Packed places in documents, (id, tie, position) with or without a hash, dealt out by bucket.

A bucket's places travel as a few binary rows instead of a row each: ids and positions as
compressed differences, hashes as plain bytes. `tie` tells rows that share an id apart.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from grantchron.llm.hashing import U64, mix

NO_ID = np.iinfo(np.int64).max  # stands for a null id: last in order
ROWS = "bucket int, settled boolean, blob binary"


class Places(NamedTuple):
    """ids, ties: for each document; doc: of each place; hashes: one column for each 8 bytes."""

    ids: np.ndarray
    ties: np.ndarray
    doc: np.ndarray
    pos: np.ndarray
    hashes: tuple[np.ndarray, ...] = ()

    def pick(self, which: np.ndarray, hashes: bool = True) -> Places:
        kept = tuple(h[which] for h in self.hashes) if hashes else ()
        return Places(self.ids, self.ties, self.doc[which], self.pos[which], kept)


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(data: memoryview, dtype: type, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8, n * size).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def pack(places: Places, widths: tuple[int, ...] = ()) -> bytes:
    """Places in order of document and position; `widths` low bytes are kept of each hash."""
    changes = np.flatnonzero(np.diff(places.doc, prepend=-1))
    docs = places.doc[changes]
    counts = np.diff(changes, append=len(places.doc)).astype(np.uint32)
    steps = np.diff(places.pos, prepend=0)
    steps[changes] = places.pos[changes]
    inner = b"".join(
        (
            _planes(np.diff(places.ids[docs].astype(np.int64), prepend=np.int64(0))),
            places.ties[docs].astype(np.int32).tobytes(),
            _planes(counts),
            _planes(steps.astype(np.uint32)),
        )
    )
    small = zstandard.ZstdCompressor(level=1).compress(inner)
    low = b"".join(
        h.view(np.uint8).reshape(-1, 8)[:, :w].tobytes()
        for h, w in zip(places.hashes, widths, strict=True)
    )
    return struct.pack("<III", len(docs), len(places.pos), len(small)) + small + low


def unpack(blob: bytes, widths: tuple[int, ...] = ()) -> Places:
    n_docs, n, size = struct.unpack_from("<III", blob)
    inner = memoryview(zstandard.ZstdDecompressor().decompress(blob[12 : 12 + size]))
    ids = np.cumsum(_from_planes(inner, np.int64, n_docs))
    ties = np.frombuffer(inner, np.int32, n_docs, n_docs * 8)
    counts = _from_planes(inner[n_docs * 12 :], np.uint32, n_docs).astype(np.int64)
    steps = _from_planes(inner[n_docs * 16 :], np.uint32, n).astype(np.int64)
    doc = np.repeat(np.arange(n_docs), counts)
    total = np.cumsum(steps)
    first = np.cumsum(counts) - counts
    pos = total - (total[first] - steps[first])[doc]
    hashes, at = [], 12 + size
    for w in widths:
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :w] = np.frombuffer(blob, np.uint8, n * w, at).reshape(n, w)
        hashes.append(whole.view(U64).reshape(-1))
        at += n * w
    return Places(ids, ties, doc, pos, tuple(hashes))


def joined(found: list[Places]) -> Places:
    if not found:
        none = np.empty(0, np.int64)
        return Places(none, none.astype(np.int32), none, none)
    shift = np.cumsum([0, *(len(p.ids) for p in found[:-1])])
    return Places(
        np.concatenate([p.ids for p in found]),
        np.concatenate([p.ties for p in found]),
        np.concatenate([p.doc + s for p, s in zip(found, shift, strict=True)]),
        np.concatenate([p.pos for p in found]),
        tuple(np.concatenate(h) for h in zip(*(p.hashes for p in found), strict=True)),
    )


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the high bits, as the low ones are kept in the postings."""
    return ((keys >> U64(40)) % U64(buckets)).astype(np.int32)


def bucket_of_documents(ids: np.ndarray, ties: np.ndarray, buckets: int) -> np.ndarray:
    """By id and tie, so that documents with one id, or none, are spread."""
    own = mix(ids.astype(np.int64).view(U64))
    return bucket_of(mix(own + ties.astype(np.int64).view(U64)), buckets)


def dealt(places: Places, bucket: np.ndarray, settled: bool, widths: tuple[int, ...] = ()) -> Iterator[tuple]:
    """Rows (bucket, settled, blob); places must be in order of document and position."""
    order = np.argsort(bucket.astype(np.uint16 if bucket.max(initial=0) < 1 << 16 else np.int32), kind="stable")
    sorted_buckets = bucket[order]
    edges = np.flatnonzero(np.diff(sorted_buckets, prepend=-1, append=-1))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        yield int(sorted_buckets[low]), settled, pack(places.pick(order[low:high], bool(widths)), widths)


def by_document(places: Places, buckets: int) -> Iterator[tuple]:
    """Settled places as rows for the buckets of their documents, in order and without repeats."""
    if not len(places.pos):
        return
    order = np.lexsort((places.pos, places.ties[places.doc], places.ids[places.doc]))
    # One number for each (id, tie), in that order.
    ids, ties, pos = places.ids[places.doc][order], places.ties[places.doc][order], places.pos[order]
    new = (np.diff(ids, prepend=-1) != 0) | (np.diff(ties, prepend=0) != 0)
    new[0] = True
    doc = np.cumsum(new) - 1
    fresh = new | (np.diff(pos, prepend=-1) != 0)
    first = np.flatnonzero(new)
    unique = Places(ids[first], ties[first], doc[fresh], pos[fresh])
    yield from dealt(unique, bucket_of_documents(unique.ids, unique.ties, buckets)[unique.doc], True)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.binary())],
        names=["bucket", "settled", "blob"],
    )


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id long, tie int, text): null ids as NO_ID; rows that agree in id and text are one document."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("id"),
        (F.xxhash64(text_col) % (2**31 - 1)).cast("int").alias("tie"),
        F.col(text_col).alias("text"),
    )


def texts_by_bucket(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, id, tie, packed text) of `keyed` documents; a null text as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            ids, ties = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            packed = [compress((t or "").encode()) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_of_documents(ids, ties, buckets)), b.column(0), b.column(1), pa.array(packed, pa.binary())],
                names=["bucket", "id", "tie", "packed"],
            )

    return docs.mapInArrow(run, "bucket int, id long, tie int, packed binary")


class Documents:
    """The documents of a bucket, in order of (id, tie), with the places that were found in them."""

    def __init__(self, table: pa.Table, replies: pa.Table, widths: tuple[int, ...] = ()):
        ids = table["id"].to_numpy()
        ties = table["tie"].to_numpy()
        self.order = np.lexsort((ties, ids))
        self.ids, self.ties = ids[self.order], ties[self.order]
        self._packed = table["packed"].combine_chunks()
        self._inflate = zstandard.ZstdDecompressor()
        found = joined([unpack(b.as_py(), widths) for b in replies["blob"]])
        self._found: dict[tuple[int, int], list[tuple[np.ndarray, ...]]] = {}
        if len(found.pos):
            edges = np.flatnonzero(np.diff(found.doc, prepend=-1, append=-1))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                d = found.doc[low]
                key = int(found.ids[d]), int(found.ties[d])
                columns = found.pos[low:high], *(h[low:high] for h in found.hashes)
                self._found.setdefault(key, []).append(columns)

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, i: int) -> bytes:
        return self._inflate.decompress(self._packed[int(self.order[i])].as_py())

    def found(self, i: int) -> np.ndarray | None:
        """The positions found in document i, sorted, or None."""
        places = self.found_with(i)
        return None if places is None else np.unique(places[0])

    def found_with(self, i: int) -> tuple[np.ndarray, ...] | None:
        """The positions found in document i, and what came with each, or None."""
        places = self._found.get((int(self.ids[i]), int(self.ties[i])))
        return None if places is None else tuple(map(np.concatenate, zip(*places, strict=True)))

    def repeats_last(self, i: int) -> bool:
        return i > 0 and self.ids[i] == self.ids[i - 1] and self.ties[i] == self.ties[i - 1]


def covered(length: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of `length` entries lie in one of the runs of `width` from `starts`."""
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def edges_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true entries."""
    change = np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def buckets_for(docs: DataFrame, text_col: str = "text", least: int = 64, megabytes: int = 26) -> int:
    """So many that one holds about `megabytes` of text, by a count of them; only the plan depends on it."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return min(max(least, size // (megabytes << 20)), 1 << 20)


def part_bytes(buckets: int) -> int:
    """Text that a task deals out at once: more for more buckets, so that rows stay large."""
    return min(max(2_000_000, buckets * 16_000), 32_000_000)
