"""Counts of word sequences in a HAT-trie that spills sorted runs, with numpy around it.

A sequence is a path (first, second, third) of word numbers; 0 stands for no word. Rare first
words share a hash container of whole paths; others have one of (second, third) each, which, if
it grows beyond `burst` entries, bursts into a node with a container of third words for each
second one. When the trie holds `most`
entries, its largest subtrees leave it whole, each a sorted run, cut where prefix partitions begin.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

BITS = 21  # of a word number: words are numbered anew after WORDS of them
WORDS = 1 << 20
PACKED_BITS = 63  # of a number that holds a path
_SUFFIX = (1 << 2 * BITS) - 1
_WORD = (1 << BITS) - 1

#: A place in the order of all paths: group and words as bytes, none as empty.
Splitter = tuple[bytes, bytes, bytes, bytes]


class Burst(dict):
    """A container for each second word, instead of one container."""


class Runs(NamedTuple):
    """Paths of one group in order, as places in `words` from 1 on (0: no word), and counts."""

    words: list[bytes]
    paths: np.ndarray  # three rows
    counts: np.ndarray


class _Root:
    """What one group's paths begin with: words with a subtree of their own, and all others."""

    def __init__(self) -> None:
        self.own: dict[int, Counter | Burst] = {}
        self.mixed: Counter[int] = Counter()  # whole paths


def _cut(sorted_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal entries starts and ends."""
    edges = np.flatnonzero(np.diff(sorted_codes)) + 1
    return np.concatenate([[0], edges]), np.concatenate([edges, [len(sorted_codes)]])


class Trie:
    def __init__(self, burst: int = 1 << 14, most: int = 1_000_000, own: int = 32):
        """own: paths added at once from which a first word has a subtree and is not among others."""
        self.burst, self.most, self.own = burst, most, own
        self.roots: dict[str, _Root] = {}
        self.size = 0

    def add(self, group: str, codes: np.ndarray) -> None:
        """codes: paths in order, packed as pack() does, each as often as it occurs."""
        if not len(codes):
            return
        root = self.roots.setdefault(group, _Root())
        first = codes >> (2 * BITS)
        lows, highs = _cut(first)
        words = first[lows].tolist()
        large = (highs - lows >= self.own) | np.array(list(map(root.own.__contains__, words)), bool)
        before = len(root.mixed)
        root.mixed.update(codes[np.repeat(~large, highs - lows)].tolist())
        self.size += len(root.mixed) - before
        suffixes = codes & _SUFFIX
        for i in np.flatnonzero(large).tolist():
            word, mine = words[i], suffixes[lows[i] : highs[i]]
            node = root.own.get(word)
            if type(node) is Burst:
                seconds = mine >> BITS
                for low, high in zip(*(x.tolist() for x in _cut(seconds)), strict=True):
                    container = node.setdefault(int(seconds[low]), Counter())
                    before = len(container)
                    container.update((mine[low:high] & _WORD).tolist())
                    self.size += len(container) - before
                continue
            if node is None:
                node = root.own[word] = Counter()
            before = len(node)
            node.update(mine.tolist())
            self.size += len(node) - before
            if len(node) > self.burst:
                root.own[word] = _burst(node)

    def full(self) -> bool:
        return self.size > self.most

    def spill(self, words: list[bytes], share: float = 1.0) -> Iterator[tuple[str, Runs]]:
        """Take the largest subtrees, until this share of the entries is out: a run of each group."""
        leaves = []
        for group, root in self.roots.items():
            leaves.append((len(root.mixed), group, 0, 0))
            for first, node in root.own.items():
                if type(node) is Burst:
                    leaves += [(len(c), group, first, second) for second, c in node.items()]
                else:
                    leaves.append((len(node), group, first, 0))
        leaves.sort(key=lambda leaf: -leaf[0])
        left = self.size * (1 - share)
        taken: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for n, group, first, second in leaves:
            if self.size <= left:
                break
            root = self.roots[group]
            if not first:
                container, root.mixed = root.mixed, Counter()
            elif type(node := root.own[first]) is Burst:
                container = node.pop(second)
                if not node:
                    del root.own[first]
            else:
                container = root.own.pop(first)
            codes = np.fromiter(container.keys(), np.int64, n) + (first << 2 * BITS | second << BITS)
            taken.setdefault(group, []).append((codes, np.fromiter(container.values(), np.int64, n)))
            self.size -= n
        for group, parts in taken.items():
            codes = np.concatenate([c for c, _ in parts])
            paths = np.stack([codes >> 2 * BITS, codes >> BITS & _WORD, codes & _WORD])
            yield group, in_order(words, paths, np.concatenate([n for _, n in parts]))


def _burst(container: Counter[int]) -> Burst:
    node = Burst()
    for suffix, n in container.items():
        node.setdefault(suffix >> BITS, Counter())[suffix & _WORD] = n
    return node


def pack(paths: np.ndarray) -> np.ndarray:
    return (paths[0] << (2 * BITS)) | (paths[1] << BITS) | paths[2]


def _renumbered(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers that occur, and the paths in places among them from 1 on."""
    used, places = np.unique(paths, return_inverse=True)
    some = int(used[0] == 0) if len(used) else 0
    return used[some:], places.reshape(paths.shape) + (1 - some)


def in_order(words: list[bytes], paths: np.ndarray, counts: np.ndarray) -> Runs:
    """words: by number, from 1 on. The paths sorted by the bytes of their words."""
    used, places = _renumbered(paths)
    mine = [words[i - 1] for i in used.tolist()]
    order = np.array(sorted(range(len(mine)), key=mine.__getitem__), np.int64)
    rank = np.zeros(len(mine) + 1, np.int64)
    rank[order + 1] = np.arange(1, len(mine) + 1)
    ranked = rank[places]
    by = np.argsort(pack(ranked))
    return Runs([mine[i] for i in order.tolist()], ranked[:, by], counts[by])


def _threshold(words: list[bytes], splitter: Splitter) -> int:
    """The least packed path that is not before a splitter of the same group."""
    code = 0
    for level, word in enumerate(splitter[1:]):
        shift = (2 - level) * BITS
        if not word:
            continue
        at = bisect_left(words, word)
        code += (at + 1) << shift
        if at == len(words) or words[at] != word:
            break
    return code


def by_partition(group: str, runs: Runs, splitters: list[Splitter]) -> Iterator[tuple[int, Runs]]:
    """The parts of a run between splitters; partition i begins at splitter i - 1."""
    name = group.encode()
    low = bisect_left(splitters, (name, b"", b"", b""))
    high = bisect_left(splitters, (name + b"\0", b"", b"", b""))
    codes = pack(runs.paths)
    at = np.searchsorted(codes, [_threshold(runs.words, s) for s in splitters[low:high]], "left")
    edges = [0, *at.tolist(), len(codes)]
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            yield low + i, Runs(runs.words, runs.paths[:, a:b], runs.counts[a:b])


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(data: memoryview, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8, n * size).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def dump(runs: Runs) -> bytes:
    used, places = _renumbered(runs.paths)
    words = [runs.words[i - 1] for i in used.tolist()]
    first, second, third = places.astype(np.uint32)
    parts = (
        struct.pack("<II", len(words), len(first)),
        _planes(np.array([len(w) for w in words], np.uint32)),
        _planes(np.diff(first, prepend=np.uint32(0))),
        _planes(second),
        _planes(third),
        _planes(runs.counts.astype(np.int64)),
        b"".join(words),
    )
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def load(blob: bytes) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Words, paths as places among them from 1 on, counts; nothing of it holds on to the whole run."""
    data = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    n_words, n = struct.unpack_from("<II", data)
    at = 8
    lengths = _from_planes(data[at:], np.uint32, n_words)
    at += 4 * n_words
    paths = np.empty((3, n), np.uint32)
    for i in range(3):
        paths[i] = _from_planes(data[at + 4 * n * i :], np.uint32, n)
    np.cumsum(paths[0], out=paths[0])
    at += 12 * n
    counts = _from_planes(data[at:], np.int64, n)
    at += 8 * n
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), n_words, [None, pa.py_buffer(offsets), pa.py_buffer(bytes(data[at:]))])
    return words, paths, counts


def _in_one_order(loaded: list[pa.BinaryArray]) -> tuple[pa.BinaryArray, list[np.ndarray]]:
    """The words of all runs in order, and for each run the places of its own words, 0 in front."""
    every = pa.concat_arrays(loaded).dictionary_encode()
    order = pc.sort_indices(every.dictionary)
    rank = np.empty(len(order), np.uint32)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1, dtype=np.uint32)
    numbers = rank[np.asarray(every.indices)]
    edges = np.cumsum([0, *map(len, loaded)])
    places = [np.concatenate([[0], numbers[a:b]]).astype(np.uint32) for a, b in zip(edges, edges[1:], strict=False)]
    return every.dictionary.take(order), places


def merged(blobs: list[bytes]) -> Runs:
    """Sorted runs of one group as one, with the counts of equal paths added up; takes the blobs out of the list.

    Beside the runs, with 20 bytes a path, there is one number a path, and its place in the order.
    """
    words, paths, counts = [], [], []
    while blobs:
        for kind, part in zip((words, paths, counts), load(blobs.pop()), strict=True):
            kind.append(part)
    names, places = _in_one_order(words)
    words.clear()
    counts = np.concatenate(counts)
    bits = len(names).bit_length()
    if 3 * bits > PACKED_BITS:
        return _merged_wide(names, paths, places, counts)
    codes, at = np.empty(len(counts), np.int64), 0
    for i, own in enumerate(places):
        first, second, third = own[paths[i]].astype(np.int64)
        codes[at : at + len(first)] = first << 2 * bits | second << bits | third
        at += len(first)
        paths[i] = None
    by = np.argsort(codes)
    codes, counts = codes[by], counts[by]
    del by
    starts, sums = _added_up(codes[1:] != codes[:-1], counts)
    codes, low = codes[starts], (1 << bits) - 1
    return Runs(names.to_pylist(), np.stack([codes >> 2 * bits, codes >> bits & low, codes & low]), sums)


def _added_up(unlike: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where entries begin that are unlike the one before, and the sums of their counts."""
    new = np.ones(len(counts), bool)
    new[1:] = unlike
    starts = np.flatnonzero(new)
    return starts, np.add.reduceat(counts, starts) if len(starts) else counts


def _merged_wide(
    names: pa.BinaryArray, paths: list[np.ndarray], places: list[np.ndarray], counts: np.ndarray
) -> Runs:
    """As merged(), if there are so many words that three of their places are more than one number."""
    whole = np.concatenate([own[path] for own, path in zip(places, paths, strict=True)], axis=1).astype(np.int64)
    by = np.lexsort(whole[::-1])
    whole = whole[:, by]
    starts, sums = _added_up((whole[:, 1:] != whole[:, :-1]).any(axis=0), counts[by])
    return Runs(names.to_pylist(), whole[:, starts], sums)
