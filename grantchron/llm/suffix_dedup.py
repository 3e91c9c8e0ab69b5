"""Removing repeated byte strings (10) with suffix arrays built by linear grouping.

1. Each window of WINDOW bytes has an anchor: of the GRAM-byte strings in it, the leftmost of
   least hash. Equal windows have equal anchors, so windows can only repeat where an anchor does;
   anchors meet by hash. Consecutive windows share anchors, so there is one for some 40 bytes.
2. The stretches of windows around repeated anchors travel to the bucket of their anchor. Equal
   stretches settle at once: all but the earliest are repeats. Of the rest, stretches are cut to
   windows whose hash another one shares, and equal ones settle again. What is left (variants
   that overlap in part) goes into a suffix array, where the suffixes that agree in WINDOW bytes
   stand together; all but the earliest of them are repeats.
3. Overlapping repeats join to maximal ones, whose bytes are removed.

Each step first settles what one task can tell alone, so that a passage shared by a third of all
documents costs one posting per task. Suffix arrays are built for batches of anchors.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from grantchron.llm import postings as P
from grantchron.llm.hashing import U64, mix, parts
from grantchron.llm.suffix_array import suffix_array

WINDOW, GRAM = 100, 24
_SPREAD = WINDOW - GRAM + 1  # places of a gram in a window
_PROBE = (6,)
_RANGE = (4,)  # bytes of the number of windows in a settled stretch
_STEP = 4_000_000  # windows looked at together; below 1 << 24
_BATCH = 100_000  # bytes for one suffix array, or more if one anchor has more
_MULTIPLIERS = [U64(0x9E3779B97F4A7C15 + 2 * 0x1234567 * i) for i in range(8)]


def _doubled(hashes: np.ndarray, times: int) -> np.ndarray:
    """From hashes of strings of one length to those of strings 2**times as long."""
    for i in range(times):
        step = 1 << i
        hashes = hashes[:-step] * _MULTIPLIERS[i] + hashes[step:]
    return hashes


_LETTERS = mix(np.arange(1, 257, dtype=U64))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h8 = _doubled(_LETTERS[data], 3)
    h16 = h8[:-8] * _MULTIPLIERS[3] + h8[8:]
    return mix(h16[:-8] * _MULTIPLIERS[6] + h8[16:])


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each WINDOW consecutive bytes."""
    h4 = _doubled(_LETTERS[data], 2)
    h32 = h4
    for i in (2, 3, 4):
        h32 = h32[: -(1 << i)] * _MULTIPLIERS[i] + h32[1 << i :]
    h64 = h32[:-32] * _MULTIPLIERS[5] + h32[32:]
    n = len(data) - WINDOW + 1
    return mix((h64[:n] * _MULTIPLIERS[6] + h32[64 : 64 + n]) * _MULTIPLIERS[7] + h4[96 : 96 + n])


def stretches(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows with one anchor: first window, number of windows, anchor's hash.

    Windows lie within a row. Which anchor a window has depends on its bytes alone, and a run goes
    on from one step to the next: which runs a row has does not depend on what stands beside it.
    """
    found = []
    low_bits = U64((1 << 24) - 1)
    for start in range(0, len(data) - WINDOW + 1, _STEP):
        piece = data[start : start + _STEP + WINDOW - 1]
        grams = _gram_hashes(piece)
        least = (grams & ~low_bits) | np.arange(len(grams), dtype=U64)
        for step in (1, 2, 4, 8, 16, 32):
            least = np.minimum(least[:-step], least[step:])
        rest = _SPREAD - 64
        least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & low_bits).astype(np.int64)
        windows = np.arange(start, start + len(anchor))
        row = np.searchsorted(offsets, windows, "right") - 1
        inside = np.flatnonzero(offsets[row + 1] >= windows + WINDOW)
        if len(inside):
            a = anchor[inside]
            new = np.ones(len(a), bool)
            new[1:] = (np.diff(a) != 0) | (np.diff(inside) != 1)
            first = np.flatnonzero(new)
            found.append(
                (windows[inside[first]], np.diff(first, append=len(a)), grams[a[first]], start + a[first])
            )
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none.view(U64)
    begin, count, hashes, anchor = (np.concatenate(x) for x in zip(*found, strict=True))
    new = np.ones(len(begin), bool)
    new[1:] = (np.diff(anchor) != 0) | (begin[1:] != begin[:-1] + count[:-1])
    first = np.flatnonzero(new)
    return begin[first], np.add.reduceat(count, first), hashes[first]


def _anchors(buckets: int):
    """The anchor of each stretch, known by its document and first window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in parts(batches, 2, P.part_bytes(buckets)):
            first, _, hashes = stretches(data, offsets)
            row = np.searchsorted(offsets, first, "right") - 1
            places = P.Places(
                rows.column(0).to_numpy(), rows.column(1).to_numpy(), row, first - offsets[row], (hashes,)
            )
            yield P.batch(list(_settle_anchors(places, buckets, _PROBE, True)))

    return run


def _settle_anchors(
    places: P.Places, buckets: int, widths: tuple[int, ...], send: bool
) -> Iterator[tuple]:
    """Stretches whose anchor occurs elsewhere too; with send, one of each anchor goes on."""
    if not len(places.pos):
        return
    keys = places.hashes[0]
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = np.diff(keys[order]) != 0
    edges = np.flatnonzero(new)
    several = np.repeat(np.diff(edges, append=len(keys)) > 1, np.diff(edges, append=len(keys)))
    yield from P.by_document(places.pick(np.sort(order[several]), False), buckets)
    if send:
        one = places.pick(np.sort(order[edges]))
        yield from P.dealt(one, P.bucket_of(one.hashes[0], buckets), False, widths)


def _answer(widths: tuple[int, ...], read, settle):
    """Settled postings pass; the others of a bucket are settled together."""

    def run(table: pa.Table) -> pa.Table:
        settled, blobs = table["settled"].to_pylist(), table["blob"]
        found = [read(b.as_py()) for s, b in zip(settled, blobs, strict=True) if not s]
        bucket = table["bucket"][0].as_py()
        rows = [(bucket, True, b.as_py()) for s, b in zip(settled, blobs, strict=True) if s]
        if found:
            rows += settle(found)
        return pa.Table.from_batches([P.batch(rows)])

    return run


def _hits(buckets: int):
    return _answer(
        _PROBE,
        lambda blob: P.unpack(blob, _PROBE),
        lambda found: _settle_anchors(P.joined(found), buckets, (), False),
    )


def _pack_stretches(places: P.Places, texts: list[bytes]) -> bytes:
    head = P.pack(places, (8, 4))
    return struct.pack("<I", len(head)) + head + zstandard.ZstdCompressor(level=1).compress(b"".join(texts))


def _unpack_stretches(blob: bytes) -> tuple[P.Places, bytes]:
    (size,) = struct.unpack_from("<I", blob)
    places = P.unpack(blob[4 : 4 + size], (8, 4))
    return places, zstandard.ZstdDecompressor().decompress(blob[4 + size :])


def _send_stretches(buckets: int):
    """Per bucket of documents: stretches around repeated anchors, the first of equal ones."""

    def run(texts: pa.Table, hits: pa.Table) -> pa.Table:
        docs = P.Documents(texts, hits)
        seen: set[bytes] = set()
        fresh: list[tuple] = []
        known: list[tuple] = []
        cut: list[bytes] = []
        for i in range(len(docs)):
            at = docs.found(i)
            if at is None or docs.repeats_last(i):
                continue
            text = docs.text(i)
            data = np.frombuffer(text, np.uint8)
            first, count, hashes = stretches(data, np.array([0, len(data)]))
            chosen = np.flatnonzero(np.isin(first, at))
            for s, n, h in zip(
                first[chosen].tolist(), count[chosen].tolist(), hashes[chosen].tolist(), strict=True
            ):
                piece = text[s : s + n + WINDOW - 1]
                if piece in seen:
                    known.append((i, s, n))
                else:
                    seen.add(piece)
                    fresh.append((i, s, n, h))
                    cut.append(piece)
        rows = list(_ranges(docs.ids, docs.ties, known, buckets))
        if fresh:
            doc, pos, count, hashes = (np.array(x) for x in zip(*fresh, strict=True))
            hashes = np.array([f[3] for f in fresh], U64)
            places = P.Places(docs.ids, docs.ties, doc, pos, (hashes, count.astype(U64)))
            bucket = P.bucket_of(hashes, buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                which = order[low:high]
                blob = _pack_stretches(places.pick(which), [cut[j] for j in which])
                rows.append((int(bucket[which[0]]), False, blob))
        return pa.Table.from_batches([P.batch(rows)])

    return run


def _ranges(ids: np.ndarray, ties: np.ndarray, known: list[tuple], buckets: int) -> Iterator[tuple]:
    """Rows for the buckets of documents: (document, first window, windows) that are repeats."""
    if known:
        doc, pos, count = (np.array(x) for x in zip(*known, strict=True))
        order = np.lexsort((pos, doc))
        places = P.Places(ids, ties, doc[order], pos[order], (count[order].astype(U64),))
        yield from P.dealt(places, P.bucket_of_documents(ids, ties, buckets)[places.doc], True, _RANGE)


def _first_of_equal(pieces: list[bytes]) -> tuple[list[int], list[int]]:
    """Numbers of the pieces seen first, in order, and of the others."""
    seen: set[bytes] = set()
    first, others = [], []
    for i, piece in enumerate(pieces):
        if piece in seen:
            others.append(i)
        else:
            seen.add(piece)
            first.append(i)
    return first, others


def _shared(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For all windows of the pieces, one piece after another: piece, and whether a hash is met twice."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    counts = np.array([len(p) - WINDOW + 1 for p in pieces])
    piece = np.repeat(np.arange(len(pieces)), counts)
    at = np.arange(len(piece)) + piece * (WINDOW - 1)
    hashes = _window_hashes(data)[at]
    _, number, times = np.unique(hashes, return_inverse=True, return_counts=True)
    return piece, times[number] > 1


def repeats_among(pieces: list[bytes], anchors: np.ndarray) -> list[tuple[int, int, int]]:
    """Windows of the pieces that also start earlier: (piece, first window, number of windows).

    Pieces come in order, earliest first, each with the anchor that all of its windows share.
    """
    first, others = _first_of_equal(pieces)
    found = [(i, 0, len(pieces[i]) - WINDOW + 1) for i in others]
    if len(first) < 2:
        return found
    piece, shared = _shared([pieces[i] for i in first])
    starts = np.searchsorted(piece, np.arange(len(first)))
    regions: list[tuple[int, int, int]] = []
    low, high = P.edges_of(shared)
    for s, e in zip(low.tolist(), high.tolist(), strict=True):
        while s < e:  # a run of shared windows may go on into the next piece
            p = int(piece[s])
            stop = min(e, int(starts[p + 1]) if p + 1 < len(first) else len(piece))
            regions.append((first[p], s - int(starts[p]), stop - s))
            s = stop
    cut = [pieces[i][s : s + n + WINDOW - 1] for i, s, n in regions]
    alone, same = _first_of_equal(cut)
    found += [regions[j] for j in same]
    if len(alone) < 2:
        return found
    piece, shared = _shared([cut[j] for j in alone])
    mixed = np.unique(piece[shared])
    left = sorted((alone[j] for j in mixed), key=lambda j: (anchors[regions[j][0]], j))
    batch: list[int] = []
    for at, j in enumerate(left):
        batch.append(j)
        last = at + 1 == len(left) or anchors[regions[left[at + 1]][0]] != anchors[regions[j][0]]
        if last and (at + 1 == len(left) or sum(len(cut[k]) for k in batch) >= _BATCH):
            batch.sort()
            for k, s, n in _by_suffix_array([cut[k] for k in batch]):
                i, low_window, _ = regions[batch[k]]
                found.append((i, low_window + s, n))
            batch = []
    return found


def _by_suffix_array(pieces: list[bytes]) -> list[tuple[int, int, int]]:
    """As repeats_among, by the order of all suffixes of the pieces."""
    data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    ends = np.cumsum([len(p) for p in pieces])
    text = np.insert(data, ends, 0)  # a symbol below all others after each piece
    order = np.array(suffix_array(text.tolist()))
    begin = np.concatenate(([0], ends[:-1])) + np.arange(len(pieces))
    piece = np.searchsorted(begin, order, "right") - 1
    inside = order + WINDOW <= begin[piece] + np.array([len(p) for p in pieces])[piece]
    order, piece = order[inside], piece[inside]
    views = np.lib.stride_tricks.sliding_window_view(text, WINDOW)
    equal = np.zeros(len(order), bool)
    for s in range(1, len(order), 20_000):
        e = min(s + 20_000, len(order))
        equal[s:e] = (views[order[s:e]] == views[order[s - 1 : e - 1]]).all(axis=1)
    group = np.cumsum(~equal)
    by_place = np.lexsort((order, group))  # pieces stand in the text as they come
    later = np.zeros(len(order), bool)
    later[by_place[1:]] = np.diff(group[by_place]) == 0
    starts = np.sort(order[later])
    if not len(starts):
        return []
    owner = np.searchsorted(begin, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (np.diff(owner) != 0)
    at = np.flatnonzero(new)
    return list(
        zip(
            owner[at].tolist(),
            (starts[at] - begin[owner[at]]).tolist(),
            np.diff(at, append=len(starts)).tolist(),
            strict=True,
        )
    )


def _settle_stretches(buckets: int):
    def settle(found: list[tuple[P.Places, bytes]]) -> Iterator[tuple]:
        places = P.joined([p for p, _ in found])
        pieces: list[bytes] = []
        for p, text in found:
            ends = np.cumsum(p.hashes[1].astype(np.int64) + WINDOW - 1)
            pieces += [
                text[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)
            ]
        order = np.lexsort((places.pos, places.ties[places.doc], places.ids[places.doc]))
        doc, pos = places.doc[order], places.pos[order]
        known = [
            (int(doc[i]), int(pos[i]) + s, n)
            for i, s, n in repeats_among([pieces[j] for j in order], places.hashes[0][order])
        ]
        # Documents of several senders may be the same one: number them by (id, tie).
        return _ranges(places.ids, places.ties, known, buckets)

    return _answer((), _unpack_stretches, settle)


_RESULT = (
    "id long, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept binary"
)


def _kept(texts: pa.Table, repeats: pa.Table) -> pa.Table:
    docs = P.Documents(texts, repeats, _RANGE)
    columns: tuple[list, ...] = ([], [], [], [], [])
    for i in range(len(docs)):
        text, at = docs.text(i), docs.found_with(i)
        spans, removed, kept = [], 0, text
        if at is not None:
            change = np.zeros(len(text) + 1, np.int64)
            np.add.at(change, at[0], 1)
            np.add.at(change, at[0] + at[1].astype(np.int64) + WINDOW - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            removed = int(gone.sum())
            spans = [{"start": s, "end": e} for s, e in zip(*map(list, P.edges_of(gone)), strict=True)]
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        row = int(docs.ids[i]), len(text), removed, spans, kept
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = pa.int64(), pa.int64(), pa.int64(), span, pa.binary()
    return pa.table(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
        names=["id", "n_bytes", "n_removed", "removed", "kept"],
    )


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """Rows (id_col, n_bytes, n_removed, removed, kept), one for each row of docs.

    Texts count as their UTF-8 bytes. `removed` has the maximal runs of bytes (start, end) that
    lie in strings of WINDOW bytes which also start earlier, in a document with a smaller id or
    before in the same one (they may overlap); `kept` is the other bytes, which need not be
    whole characters. Ids are integers; a null id comes last. Documents that share an id come in
    order of a hash of their text; rows that agree in both are one document, and each gets its
    result. Null or empty texts have no bytes; other columns of docs are left out.
    """
    n = buckets or P.buckets_for(docs, text_col)
    rows = P.keyed(docs, id_col, text_col)
    texts = P.texts_by_bucket(rows, n)
    hits = rows.mapInArrow(_anchors(n), P.ROWS).groupBy("bucket").applyInArrow(_hits(n), P.ROWS)
    repeats = (
        texts.groupBy("bucket")
        .cogroup(hits.groupBy("bucket"))
        .applyInArrow(_send_stretches(n), P.ROWS)
        .groupBy("bucket")
        .applyInArrow(_settle_stretches(n), P.ROWS)
    )
    kept = texts.groupBy("bucket").cogroup(repeats.groupBy("bucket")).applyInArrow(_kept, _RESULT)
    own_id = F.when(F.col("id") != int(P.NO_ID), F.col("id")).cast(docs.schema[id_col].dataType)
    return kept.select(own_id.alias(id_col), "n_bytes", "n_removed", "removed", "kept")
