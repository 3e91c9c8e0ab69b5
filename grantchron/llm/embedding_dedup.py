"""Near-duplicate embeddings (3) by a subspace pigeonhole join.

Unit vectors with cosine >= c are within squared distance 2 - 2c. After a fixed random rotation,
which spreads differences evenly, coordinates are split into blocks; one block at least of such a
pair holds no more than its share, by dimensions, of the squared distance. Each block is joined
by that range over boxes, which median splits of a sample give, as many as the rows need. A vector
is at home in one box and visits others that its range reaches, of any two boxes the rows of one
the other, so that each pair of a block meets once; boxes with many rows are compared in chunks.

A task has whole vectors. It checks cosines, counts a pair in the first block whose range it
keeps, and returns counts and links to the least of those joined, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from grantchron.llm.components import components
from grantchron.llm.hashing import give_back_memory
from grantchron.llm.ngram_join import _least_joined

THRESHOLD = 0.95
BLOCK_DIMS = 11  # dimensions of a block, at most
CELL_ROWS = 8192  # vectors that boxes are made for; a task has 2 * as many at home, 4 * visiting
TILE, ACROSS = 256, 8192  # vectors compared at once
SAMPLE = 16_384  # vectors that splits are chosen by
LENGTHS = 16  # lengths of vectors, the most common ones, that have boxes; others are one box
_MOST_NEAR = 0.9  # no split that more of the sample's ranges cross
_SLACK = 1e-5  # more than coordinates lose as 32-bit numbers; candidates are checked anyway
_CLOSE = 1e-9  # sums nearer to a limit are made again, in the order of the components
_EDGES = 200_000

_CELLS = (
    "dims int, block int, cell int, left int, right int, own boolean, facts binary, vectors binary"
)
_COUNTS = "dims int, block int, cell int, home long, visiting long"
_LINKS = "key long, first long, n long, least long"


class Boxes(NamedTuple):
    """Of one block: lower (met) and upper (not met) bounds, a row for each box."""

    low: np.ndarray
    high: np.ndarray


@cache
def _rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int, most: int = BLOCK_DIMS) -> list[tuple[int, int]]:
    edges = np.linspace(0, dims, -(-dims // most) + 1).round().astype(int).tolist()
    return list(zip(edges[:-1], edges[1:], strict=True))


def _budget(threshold: float, dims: int, own: int) -> float:
    return (2 - 2 * threshold) * own / dims + _SLACK


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / largest  # so that no square overflows or vanishes
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _split(own: np.ndarray, reach: float, depth: int) -> Boxes:
    """Boxes by medians, up to 2**depth, each split where the fewest ranges cross it."""
    low, high = [], []
    todo = [(own, np.full(own.shape[1], -np.inf), np.full(own.shape[1], np.inf), depth)]
    while todo:
        rows, least, most, left = todo.pop()
        if left and len(rows) >= 16:
            middle = np.median(rows, axis=0)
            near = (np.abs(rows - middle) <= reach).mean(axis=0)
            c = int(np.argmin(near))
            below = rows[:, c] < middle[c]
            if near[c] <= _MOST_NEAR and below.any():
                ends, begins = most.copy(), least.copy()
                ends[c] = begins[c] = middle[c]
                todo += [(rows[~below], begins, most, left - 1), (rows[below], least, ends, left - 1)]
                continue
        low.append(least)
        high.append(most)
    return Boxes(np.array(low), np.array(high))


def _boxes(
    classes: DataFrame, threshold: float, block_dims: int, cell_rows: int
) -> dict[int, list[Boxes]]:
    """For lengths with more than cell_rows vectors the boxes of each block."""
    lengths = (
        classes.groupBy(F.size("vec").alias("dims"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > cell_rows)
        .orderBy(F.desc("n"), "dims")
        .limit(LENGTHS)
        .collect()
    )
    found = {}
    for dims, n in lengths:
        some = F.pmod("key", F.lit(max(1, n // SAMPLE))) == 0
        sample = classes.filter(some & (F.size("vec") == dims)).select("vec").limit(2 * SAMPLE)
        flat = sample.toArrow()["vec"].combine_chunks().flatten().to_numpy().astype(np.float64)
        turned = _unit(flat.reshape(-1, dims)) @ _rotation(dims)
        depth = int(np.ceil(np.log2(n / cell_rows)))
        found[dims] = [
            _split(turned[:, a:b], np.sqrt(_budget(threshold, dims, b - a)), depth)
            for a, b in blocks(dims, block_dims)
        ]
    return found


def _places(own: np.ndarray, boxes: Boxes, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The home of each row, and (row, box) of its visits to others."""
    shape = len(own), len(boxes.low)
    squared, inside = np.zeros(shape), np.ones(shape, bool)
    for c in range(own.shape[1]):
        x, low, high = own[:, c, None], boxes.low[None, :, c], boxes.high[None, :, c]
        squared += np.maximum(np.maximum(low - x, x - high), 0) ** 2
        inside &= (x >= low) & (x < high)
    home = inside.argmax(axis=1)
    other, own_box = np.arange(shape[1])[None, :], home[:, None]
    # Of two boxes the rows of one visit the other, which one alternates.
    goes = (other < own_box) == ((other + own_box) % 2 == 0)
    row, box = np.nonzero((squared <= budget + _SLACK) & goes)
    return home, row, box


def _placed(
    batch: pa.RecordBatch, boxes: dict[int, list[Boxes]], threshold: float, block_dims: int
) -> Iterator[tuple]:
    """For each length and block: which rows of the batch, their vectors, and _places."""
    column = batch.column("vec")
    sizes = column.value_lengths().to_numpy()
    for dims in np.unique(sizes).tolist():
        which = np.flatnonzero(sizes == dims)
        vectors = column.take(pa.array(which)).flatten().to_numpy().reshape(len(which), dims)
        turned = _unit(vectors.astype(np.float64)) @ _rotation(dims)
        for k, (a, b) in enumerate(blocks(dims, block_dims)):
            whole = Boxes(np.full((1, b - a), -np.inf), np.full((1, b - a), np.inf))
            own = boxes[dims][k] if dims in boxes else whole
            yield dims, k, which, vectors, _places(turned[:, a:b], own, _budget(threshold, dims, b - a))


def _count(boxes: dict[int, list[Boxes]], threshold: float, block_dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for dims, k, _, _, (home, _, box) in _placed(batch, boxes, threshold, block_dims):
                n = int(max(home.max(initial=0), box.max(initial=0))) + 1
                counts = np.bincount(home, minlength=n), np.bincount(box, minlength=n)
                rows += [(dims, k, c, int(counts[0][c]), int(counts[1][c])) for c in range(n)]
            yield _batch(rows, [pa.int32()] * 3 + [pa.int64()] * 2, _COUNTS)

    return run


def _batch(rows: list[tuple], kinds: list[pa.DataType], schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
        names=[field.split()[0] for field in schema.split(", ")],
    )


def tasks(
    keys: np.ndarray, home: bool, chunks: tuple[int, int]
) -> Iterator[tuple[int, int, bool, np.ndarray]]:
    """Which tasks (left, right) of a box get which of some rows, and whether as their own.

    A box has chunks of rows at home, and then of visitors; each of the first is compared with
    itself and all after it. What fits one task is one.
    """
    at_home, visiting = chunks
    if at_home == 1 and visiting <= 1:
        yield 0, 0, home, np.arange(len(keys))
        return
    chunk = (keys.view(np.uint64) % np.uint64(at_home if home else visiting)).astype(np.int64)
    for c in np.unique(chunk).tolist():
        rows = np.flatnonzero(chunk == c)
        if home:
            for right in range(c, at_home + visiting):
                yield c, right, True, rows
        for left in range(c if home else at_home):
            yield left, c if home else at_home + c, False, rows


def _to_tasks(
    boxes: dict[int, list[Boxes]],
    chunks: dict[tuple[int, int, int], tuple[int, int]],
    threshold: float,
    block_dims: int,
):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = np.stack([batch.column(c).to_numpy() for c in ("key", "first", "class_size")], 1)
            rows: list[tuple] = []
            for dims, k, which, vectors, (home, row, box) in _placed(
                batch, boxes, threshold, block_dims
            ):
                for at_home, entries, cells in ((True, np.arange(len(home)), home), (False, row, box)):
                    order = np.argsort(cells, kind="stable")
                    edges = np.flatnonzero(np.diff(cells[order], prepend=-1, append=-1))
                    for low, high in zip(edges[:-1], edges[1:], strict=True):
                        some = entries[order[low:high]]
                        cell = int(cells[order[low]])
                        keys = np.ascontiguousarray(facts[which[some], 0])
                        number = chunks.get((dims, k, cell), (1, 1))
                        for left, right, own, part in tasks(keys, at_home, number):
                            sent = some[part]
                            packed = facts[which[sent]].tobytes(), vectors[sent].tobytes()
                            rows.append((dims, k, cell, left, right, own, *packed))
            kinds = [pa.int32()] * 5 + [pa.bool_(), pa.binary(), pa.binary()]
            yield _batch(rows, kinds, _CELLS)
        give_back_memory()

    return run


def _tiles(own: np.ndarray) -> list[np.ndarray]:
    """Rows that are near each other, at most TILE together."""
    found, todo = [], [np.arange(len(own))]
    while todo:
        rows = todo.pop()
        if len(rows) <= TILE:
            found.append(rows)
            continue
        c = int(np.argmax(own[rows].std(axis=0)))
        rows = rows[np.argpartition(own[rows, c], len(rows) // 2)]
        todo += [rows[: len(rows) // 2], rows[len(rows) // 2 :]]
    return found


def _in_order(products: np.ndarray) -> np.ndarray:
    """Sums along the second axis, from the first on: the same whatever else is summed."""
    return np.cumsum(products, axis=1)[:, -1]


def _linked_exactly(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    norms = np.sqrt(_in_order(a * a)) * np.sqrt(_in_order(b * b))
    return _in_order(a * b) / norms >= threshold


def _range_exactly(a: np.ndarray, b: np.ndarray, low: int, high: int) -> np.ndarray:
    """Squared distances in a block."""
    turned = []
    for x in (a, b):
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.sqrt(_in_order(x * x))[:, None]
        turned.append(_in_order(x[:, :, None] * _rotation(x.shape[1])[None, :, low:high]))
    return _in_order((turned[0] - turned[1]) ** 2)


def _again(close: np.ndarray, decided: np.ndarray, decide) -> None:
    p, q = np.nonzero(close)
    for i in range(0, len(p), ACROSS):
        decided[p[i : i + ACROSS], q[i : i + ACROSS]] = decide(p[i : i + ACROSS], q[i : i + ACROSS])


def _links(threshold: float, block_dims: int, kind: str):
    """For a task of a box: how many rows its vectors are linked with, and the least joined."""

    def run(table: pa.Table) -> pa.Table:
        dims, block = table["dims"][0].as_py(), table["block"][0].as_py()
        alike = table["left"][0].as_py() == table["right"][0].as_py()
        bounds = blocks(dims, block_dims)
        low, high = bounds[block]
        budget = _budget(threshold, dims, high - low)
        facts = np.frombuffer(b"".join(table["facts"].to_pylist()), np.int64).reshape(-1, 3)
        raw = np.frombuffer(b"".join(table["vectors"].to_pylist()), kind).reshape(-1, dims)
        packed = [len(f.as_py()) // 24 for f in table["facts"]]
        mine = np.repeat(table["own"].to_numpy(), packed).astype(bool)

        def turn(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            unit = _unit(raw[rows].astype(np.float64))
            return unit, unit @ _rotation(dims)[:, : bounds[block][1]]

        coordinates = np.empty((len(raw), high - low), np.float32)
        for i in range(0, len(raw), ACROSS):
            coordinates[i : i + ACROSS] = turn(np.arange(i, min(i + ACROSS, len(raw))))[1][:, low:high]
        own = np.flatnonzero(mine)
        tiles = [own[t] for t in _tiles(coordinates[own])] if len(own) else []
        order = np.concatenate([*tiles, np.flatnonzero(~mine)]) if tiles else own
        spread = coordinates[order]
        sizes = facts[order, 2].astype(np.float64)
        links = np.zeros(len(order))
        by_id = np.empty(len(order), np.int64)  # numbers in order of the id
        by_id[np.lexsort((facts[order, 0], facts[order, 1]))] = np.arange(len(order))
        edges: list[np.ndarray] = []
        n_edges, start = 0, 0
        for tile in tiles:
            here = np.arange(start, start + len(tile))
            begin = start if alike else len(own)
            start += len(tile)
            a = spread[here]
            gap = np.zeros(len(order) - begin, np.float32)
            for c in range(high - low):
                x = spread[begin:, c]
                gap += np.maximum(np.maximum(a[:, c].min() - x, x - a[:, c].max()), 0) ** 2
            near = np.flatnonzero(gap <= budget + _SLACK) + begin
            for i in range(0, len(near), ACROSS):
                there = near[i : i + ACROSS]
                b = spread[there]
                squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
                met = squared <= budget + _SLACK
                if there[0] < start:
                    met &= there[None, :] > here[:, None]
                p, q = np.flatnonzero(met.any(axis=1)), np.flatnonzero(met.any(axis=0))
                if not len(p):
                    continue
                met, left, right = met[np.ix_(p, q)], here[p], there[q]
                (unit_a, turned_a), (unit_b, turned_b) = turn(order[left]), turn(order[right])

                def vectors(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                    return tuple(raw[order[x]].astype(np.float64) for x in (left[p], right[q]))

                cosine = unit_a @ unit_b.T
                linked = cosine >= threshold
                _again(
                    met & (np.abs(cosine - threshold) < _CLOSE),
                    linked,
                    lambda p, q: _linked_exactly(*vectors(p, q), threshold),
                )
                linked &= met
                # The pair counts in the first block whose range it keeps.
                for k, (x, y) in enumerate(bounds[: block + 1]):
                    if not linked.any():
                        break
                    u, v = turned_a[:, x:y], turned_b[:, x:y]
                    squared = (u * u).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * (u @ v.T)
                    limit = _budget(threshold, dims, y - x)
                    kept = squared <= limit
                    _again(
                        linked & (np.abs(squared - limit) < _CLOSE),
                        kept,
                        lambda p, q: _range_exactly(*vectors(p, q), x, y) <= limit,
                    )
                    linked &= kept if k == block else ~kept
                if not linked.any():
                    continue
                links[left] += linked @ sizes[right]
                links[right] += sizes[left] @ linked
                # Each entry of the right joins its first of the left, which then join one another.
                joined = np.flatnonzero(linked.any(axis=0))
                first = linked[:, joined].argmax(axis=0)
                edges.append(np.stack((left[first], right[joined]), 1))
                for r in np.flatnonzero(linked.any(axis=1)):
                    others = np.unique(first[linked[r, joined]])
                    edges.append(np.stack((np.full(len(others), left[r]), left[others]), 1))
                n_edges += len(edges[-1]) + len(joined)
                if n_edges > _EDGES:
                    edges = [_forest(len(order), by_id, edges)]
                    n_edges = 0
        met = np.flatnonzero(links)
        least = np.arange(len(order))
        if edges:
            nodes, roots = _forest(len(order), by_id, edges).T
            least[nodes] = roots
        columns = facts[order[met], 0], facts[order[met], 1], links[met], facts[order[least[met]], 1]
        give_back_memory()
        return pa.table(
            [pa.array(c.astype(np.int64)) for c in columns], names=["key", "first", "n", "least"]
        )

    return run


def _forest(n: int, by_id: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Each entry of the edges with the one of least id that they join it with."""
    pairs = np.unique(by_id[np.concatenate(edges)], axis=0)
    at = np.empty(n, np.int64)
    at[by_id] = np.arange(n)
    root = _least_joined(n, pairs)
    nodes = np.unique(pairs)
    return np.stack((at[nodes], at[root[nodes]]), 1)


def embedding_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = THRESHOLD,
    block_dims: int = BLOCK_DIMS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Rows (id_col, n_links, component_id, kept), one for each row of vectors.

    Two vectors are linked if their cosine, in double precision, is `threshold` or more (which
    is to be above 0). `n_links` counts the other rows linked directly, `component_id` is the
    least id that links reach, `kept` says that it is the row's own. Equal vectors are one class
    and only one of them is compared; their number counts in the links of others.

    Vectors that are null, empty, zero, or hold null or non-finite components, and rows with a
    null id, are linked with nothing. Vectors of different lengths are not linked. Rows that
    share an id are linked as their vectors are, but have one component. Ids are integers;
    other columns are left out.
    """
    whole = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    single = vectors.schema[vec_col].dataType.elementType.typeName() == "float"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"),
        F.coalesce(
            F.col(id_col).isNotNull() & whole & F.exists(vec_col, lambda x: x != 0), F.lit(False)
        ).alias("fit"),
    )
    fit = rows.filter("fit").drop("fit")
    classes = (
        fit.groupBy("vec")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("class_size"))
        .withColumn("key", F.xxhash64("vec", "first"))
        .checkpoint()
    )
    boxes = _boxes(classes, threshold, block_dims, cell_rows)
    counted = (
        classes.mapInArrow(_count(boxes, threshold, block_dims), _COUNTS)
        .groupBy("dims", "block", "cell")
        .agg(F.sum("home").alias("home"), F.sum("visiting").alias("visiting"))
        .filter((F.col("home") > 2 * cell_rows) | (F.col("visiting") > 4 * cell_rows))
    )
    chunks = {
        (r.dims, r.block, r.cell): (-(-r.home // (2 * cell_rows)) or 1, -(-r.visiting // (4 * cell_rows)))
        for r in counted.collect()  # at most one for each cell_rows vectors and block
    }
    kind = "<f4" if single else "<f8"
    links = (
        classes.mapInArrow(_to_tasks(boxes, chunks, threshold, block_dims), _CELLS)
        .groupBy("dims", "block", "cell", "left", "right")
        .applyInArrow(_links(threshold, block_dims, kind), _LINKS)
        .checkpoint()
    )
    counts = links.groupBy("key").agg(F.sum("n").alias("others"))
    parts = components(links, "first", "least")
    found = (
        fit.join(
            classes.join(counts, "key", "left").join(
                parts.withColumnRenamed("node", "first"), "first", "left"
            ),
            "vec",
        )
    ).select(
        "id",
        (F.col("class_size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "first").alias("component_id"),
    )
    alone = rows.filter("not fit").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return found.unionByName(alone).select(
        F.col("id").cast(vectors.schema[id_col].dataType).alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
