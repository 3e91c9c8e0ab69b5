"""Substring deduplication (8) by words: fixed blocks as anchors, windows grown around their hits.

1. Reference blocks of BLOCK words stand at every BLOCK-th word of each document. A window of
   WINDOW words holds two of them, BLOCK apart. The rolling blocks that start in the first half
   of each 2 * BLOCK words probe the reference blocks: of the two places in an equal window
   where the two reference blocks lie, one is such a start, so each rolling window that occurs
   twice is found, whatever the alignment. Blocks meet by hash.
2. Windows that hold a hit are extended: equal windows meet by a 96-bit hash of their words, and
   all but the earliest are repeats.
3. Overlapping repeats join to maximal ones, whose words are removed.

Each step first settles what one task can tell alone, so a passage that a third of all
documents share costs one posting per task, not one per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from grantchron.llm import postings as P
from grantchron.llm.hashing import parts, place_in_row, runs, word_hashes, words

WINDOW, BLOCK = 20, 7
_PROBE = (5,)  # bytes kept of a block's hash, besides its bucket: a miss only costs work
_EXACT = (6, 6)


def _blocks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in parts(batches, 2, P.part_bytes(buckets)):
            starts, stops, before = words(data, offsets)
            row, pos = place_in_row(before, len(starts))
            hashes = runs(word_hashes(data, starts, stops), BLOCK)
            row, at = row[: len(hashes)], pos[: len(hashes)]
            size = np.diff(before)[row]
            chosen = np.flatnonzero(
                (at + BLOCK <= size)
                & (size >= WINDOW)
                & ((at % (2 * BLOCK) < BLOCK) | (at % BLOCK == 0))
            )
            places = P.Places(
                rows.column(0).to_numpy(),
                rows.column(1).to_numpy(),
                row[chosen],
                at[chosen],
                (hashes[chosen],),
            )
            yield P.batch(list(_settle_hits(places, buckets, _PROBE, True)))

    return run


def _settle_hits(
    places: P.Places, buckets: int, widths: tuple[int, ...], send: bool
) -> Iterator[tuple]:
    """Places whose block also occurs elsewhere, if one of them is a reference block.

    With send, each other block and one reference block of each hit go on to meet others.
    """
    if not len(places.pos):
        return
    keys = places.hashes[0]
    order = np.argsort(keys, kind="stable")
    edges = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[0]]) != 0)
    count = np.diff(edges, append=len(keys))
    group = np.repeat(np.arange(len(edges)), count)
    reference = places.pos[order] % BLOCK == 0
    # The first reference block of each group, or none.
    at = np.where(reference, np.arange(len(keys)), len(keys))
    first = np.minimum.reduceat(at, edges)
    hit = ((count > 1) & (first < len(keys)))[group]
    settled = np.sort(order[hit])
    yield from P.by_document(places.pick(settled, False), buckets)
    if send:
        stays = ~hit
        stays[first[(count > 1) & (first < len(keys))]] = True
        open_places = places.pick(np.sort(order[stays]))
        yield from P.dealt(open_places, P.bucket_of(open_places.hashes[0], buckets), False, widths)


def _hits(buckets: int):
    """Per bucket of hashes: rows for the buckets of the documents."""

    def run(table: pa.Table) -> pa.Table:
        return _answer(table, _PROBE, lambda p: _settle_hits(p, buckets, (), False))

    return run


def _answer(table: pa.Table, widths: tuple[int, ...], settle) -> pa.Table:
    """Settled postings pass; the others are settled together."""
    settled, blobs = table["settled"].to_pylist(), table["blob"]
    found = [P.unpack(b.as_py(), widths) for s, b in zip(settled, blobs, strict=True) if not s]
    bucket = table["bucket"][0].as_py()
    rows = [(bucket, True, b.as_py()) for s, b in zip(settled, blobs, strict=True) if s]
    if found:
        rows += settle(P.joined(found))
    return pa.Table.from_batches([P.batch(rows)])


def _windows(buckets: int):
    """Per bucket of documents: the windows around hits, by hash; the first of each in the bucket."""

    def run(texts: pa.Table, hits: pa.Table) -> pa.Table:
        docs = P.Documents(texts, hits)
        found, size = [], 0
        rows: list[tuple] = []
        for i in range(len(docs)):
            at = docs.found(i)
            if at is None or docs.repeats_last(i):
                continue
            text = docs.text(i)
            data = np.frombuffer(text, np.uint8)
            starts, stops, _ = words(data, np.array([0, len(data)]))
            n = len(starts) - WINDOW + 1
            reach = WINDOW - BLOCK + 1
            # A window at s holds the blocks at s .. s + WINDOW - BLOCK.
            low = np.maximum(at - reach + 1, 0)
            change = np.zeros(n + 1, np.int64)
            np.add.at(change, np.minimum(low, n), 1)
            np.add.at(change, np.minimum(at + 1, n), -1)
            chosen = np.flatnonzero(np.cumsum(change[:-1]) > 0)
            hashes = tuple(
                runs(word_hashes(data, starts, stops, w), WINDOW)[chosen] for w in (0, 1)
            )
            found.append(
                P.Places(
                    docs.ids[i : i + 1],
                    docs.ties[i : i + 1],
                    np.zeros(len(chosen), np.int64),
                    chosen,
                    hashes,
                )
            )
        if found:
            rows += _settle_repeats(P.joined(found), buckets, _EXACT, True)
        return pa.Table.from_batches([P.batch(rows)])

    return run


def _settle_repeats(
    places: P.Places, buckets: int, widths: tuple[int, ...], send: bool
) -> Iterator[tuple]:
    """Windows that also start earlier; with send, the earliest of each go on to meet others."""
    if not len(places.pos):
        return
    a, b = places.hashes
    order = np.lexsort((places.pos, places.ties[places.doc], places.ids[places.doc], b, a))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    yield from P.by_document(places.pick(order[~new], False), buckets)
    if send:
        first = places.pick(np.sort(order[new]))
        yield from P.dealt(first, P.bucket_of(first.hashes[0], buckets), False, widths)


def _repeats(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        return _answer(table, _EXACT, lambda p: _settle_repeats(p, buckets, (), False))

    return run


_RESULT = (
    "id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept string"
)


def _kept(texts: pa.Table, repeats: pa.Table) -> pa.Table:
    docs = P.Documents(texts, repeats)
    columns: tuple[list, ...] = ([], [], [], [], [])
    for i in range(len(docs)):
        found, at = docs.text(i).split(), docs.found(i)  # at the six bytes of space
        removed, spans, kept = 0, [], found
        if at is not None:
            gone = P.covered(len(found), at, WINDOW)
            removed = int(gone.sum())
            spans = [{"start": s, "end": e} for s, e in zip(*map(list, P.edges_of(gone)), strict=True)]
            kept = [found[j] for j in np.flatnonzero(~gone)]
        for column, value in zip(
            columns,
            (int(docs.ids[i]), len(found), removed, spans, b" ".join(kept).decode()),
            strict=True,
        ):
            column.append(value)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table(
        [
            pa.array(column, kind)
            for column, kind in zip(
                columns, (pa.int64(), pa.int64(), pa.int64(), span, pa.string()), strict=True
            )
        ],
        names=["id", "n_words", "n_removed", "removed", "kept"],
    )


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """Rows (id_col, n_words, n_removed, removed, kept), one for each row of docs.

    Words are runs of characters other than space, tab and line ends. `removed` has the maximal
    runs of words (start, end) that lie in windows of WINDOW words which also start earlier, in
    a document with a smaller id or before in the same one; `kept` is the other words with one
    space between. Ids are integers; a null id comes last. Documents that share an id come in
    order of a hash of their text; rows that agree in both are one document, and each gets its
    result. Null or empty texts have no words; other columns of docs are left out.
    """
    n = buckets or P.buckets_for(docs, text_col)
    rows = P.keyed(docs, id_col, text_col)
    texts = P.texts_by_bucket(rows, n)
    hits = (
        rows.mapInArrow(_blocks(n), P.ROWS).groupBy("bucket").applyInArrow(_hits(n), P.ROWS)
    )
    repeats = (
        texts.groupBy("bucket")
        .cogroup(hits.groupBy("bucket"))
        .applyInArrow(_windows(n), P.ROWS)
        .groupBy("bucket")
        .applyInArrow(_repeats(n), P.ROWS)
    )
    kept = texts.groupBy("bucket").cogroup(repeats.groupBy("bucket")).applyInArrow(_kept, _RESULT)
    own_id = F.when(F.col("id") != int(P.NO_ID), F.col("id")).cast(docs.schema[id_col].dataType)
    return kept.select(own_id.alias(id_col), "n_words", "n_removed", "removed", "kept")
