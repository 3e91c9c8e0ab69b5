"""Quality classifier (4) by co-training on a text view and a metadata view.

Two logistic models see different things of a document: one its text (hashed byte trigrams and
style), one what is known about it (columns such as language, source, length). They are fitted
on labelled documents; then, for some rounds, each scores all documents and labels those that it
is surest of for the other. On labelled documents set aside, each view is calibrated and the two are
combined; the combination scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from grantchron.llm.hashing import U64, mix, parts, place_in_row, word_hashes, words
from grantchron.session import materialize

LABELLED = 6_000  # labelled documents to fit on, by least hash of the id; all if there are fewer
SET_ASIDE = 0.3  # share of the labelled ones for calibration
ROUNDS = 4
EACH_ROUND = 200  # most labels that a view gives in a round
SURE = 0.95
REJECT_BELOW = 0.5  # combined probability of good quality

AT_ONCE = 1_000_000  # bytes of text whose features a worker makes at once
CATEGORIES, NUMBERS = ("lang", "source"), ("n_chars",)  # what is known about a document
_TRIGRAMS, _CATEGORY = 256, 32
_RIDGE = 1.0


def text_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for each text; zeros for an empty one but for its constant."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    counts = np.zeros((n, _TRIGRAMS))
    if len(data) > 2:
        d = data.astype(np.uint32)
        code = ((d[:-2] * 0x9E3779B1 + d[1:-1] * 0x85EBCA77 + d[2:] * 0xC2B2AE3D) >> 15) % _TRIGRAMS
        inside = row[:-2] == row[2:]
        key = row[:-2][inside] * _TRIGRAMS + code[inside]
        counts = np.bincount(key, minlength=n * _TRIGRAMS).reshape(n, _TRIGRAMS).astype(float)
    shares = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)) * 4

    kind = np.full(256, 5)
    for k, (low, high) in enumerate(((65, 91), (97, 123), (48, 58), (9, 14), (128, 256))):
        kind[low:high] = k
    kind[32] = 3
    kinds = np.bincount(row * 6 + kind[data], minlength=n * 6).reshape(n, 6)
    kinds = kinds / np.maximum(size, 1)[:, None]

    starts, stops, before = words(data, offsets)
    hashes = word_hashes(data, starts, stops)
    owner, _ = place_in_row(before, len(starts))
    number = np.diff(before)
    many = np.maximum(number, 1)
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(owner[order]) != 0) | (np.diff(hashes[order]) != 0)
    different = np.bincount(owner[order][new], minlength=n) / many
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    repeated = np.bincount(owner[again], minlength=n) / many
    length = np.bincount(owner, stops - starts, minlength=n) / many
    style = np.column_stack(
        (kinds * 4, different * 2, repeated * 4, length / 8, np.log1p(number) / 8, np.ones(n))
    )
    return np.hstack((shares, style)).astype(np.float32)


def known_view(batch: pa.RecordBatch, categories: int, numbers: int) -> np.ndarray:
    """A row of features from the columns after the text: hashes of categories, then numbers."""
    n = batch.num_rows
    columns = [np.ones((n, 1))]
    for i in range(categories):
        one_hot = np.zeros((n, _CATEGORY))
        code = mix(batch.column(2 + i).to_numpy(zero_copy_only=False).view(U64)) % U64(_CATEGORY)
        one_hot[np.arange(n), code.astype(int)] = 1
        columns.append(one_hot)
    for i in range(numbers):
        value = batch.column(2 + categories + i).to_numpy(zero_copy_only=False).astype(float)
        missing = ~np.isfinite(value)
        value = np.where(missing, 0, value)
        columns.append(np.column_stack((np.sign(value) * np.log1p(np.abs(value)) / 8, missing)))
    return np.hstack(columns).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = _RIDGE) -> np.ndarray:
    """Weights of a logistic model with a ridge penalty, by Newton steps."""
    x = x.astype(float)
    weights = np.zeros(x.shape[1])
    for _ in range(12):
        p = _sigmoid(x @ weights)
        slope = x.T @ (p - y) + ridge * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-4:
            break
    return weights


class Model(NamedTuple):
    text: np.ndarray
    known: np.ndarray
    text_scale: np.ndarray  # calibrated logit = scale[0] * logit + scale[1]
    known_scale: np.ndarray
    combined: np.ndarray  # of the two calibrated logits and a constant

    def scores(self, text: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
        """Probabilities of good quality: by the text, by what is known, by both."""
        a = (text @ self.text) * self.text_scale[0] + self.text_scale[1]
        b = (known @ self.known) * self.known_scale[0] + self.known_scale[1]
        c = self.combined
        return _sigmoid(a), _sigmoid(b), _sigmoid(c[0] * a + c[1] * b + c[2])


def _taught(views: tuple, y: np.ndarray, taught: tuple) -> list[np.ndarray]:
    """The weights of both views, on the labelled rows and those that the other view has taught."""
    weights = []
    for view, (rows, labels) in zip(views, taught, strict=True):
        weights.append(logistic(np.vstack((view, rows)), np.append(y, labels)))
    return weights


def _set_aside(y: np.ndarray) -> np.ndarray | None:
    """Which of the labelled rows calibrate; None unless both labels occur in each part."""
    aside = np.arange(len(y)) < SET_ASIDE * len(y)
    return aside if len(set(y[aside])) == len(set(y[~aside])) == 2 else None


def _calibrated(views: tuple, y: np.ndarray, aside: np.ndarray, weights: list[np.ndarray]) -> Model:
    scales, logits = [], []
    for view, w in zip(views, weights, strict=True):
        z = view[aside] @ w
        scales.append(logistic(np.column_stack((z, np.ones(len(z)))), y[aside], 0.01))
        logits.append(z * scales[-1][0] + scales[-1][1])
    both = np.column_stack((*logits, np.ones(len(logits[0]))))
    return Model(*weights, *scales, logistic(both, y[aside], 0.01))


def _fitted(table: pa.Table) -> pa.Table:
    """The model, as five lists of numbers, of rows (pupil, order, label, text, known); or no row.

    pupil is -1 for labelled rows, and the view that a row with a label from the other one teaches.
    """
    table = table.sort_by([("order", "ascending"), ("pupil", "ascending")])
    pupil, label = table["pupil"].to_numpy(), table["label"].to_numpy()
    both = tuple(np.array(table[c].to_pylist(), np.float32).reshape(len(pupil), -1) for c in ("text", "known"))
    own = pupil < 0
    y, aside = label[own], _set_aside(label[own])
    names = list(Model._fields)
    if aside is None:
        return pa.table([pa.array([], pa.list_(pa.float64()))] * len(names), names=names)
    views = tuple(v[own] for v in both)
    taught = tuple((both[i][pupil == i], label[pupil == i]) for i in (0, 1))
    weights = _taught(tuple(v[~aside] for v in views), y[~aside], taught)
    model = _calibrated(views, y, aside, weights)
    return pa.table([pa.array([m.tolist()], pa.list_(pa.float64())) for m in model], names=names)


def _in_one_task(rows: DataFrame) -> Model | None:
    """Fitted by an executor: the driver gets some thousand numbers."""
    schema = ", ".join(f"{name} array<double>" for name in Model._fields)
    found = rows.groupBy().applyInArrow(_fitted, schema).collect()
    return Model(*(np.array(m) for m in found[0])) if found else None


def _views(docs: DataFrame, id_col: str, text_col: str, categories: tuple, numbers: tuple) -> list:
    """Columns that the views are made of, the id and the text first."""
    return [
        F.col(id_col),
        F.coalesce(text_col, F.lit("")),
        *(F.xxhash64(c) for c in categories),
        *(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numbers),
    ]


_FEATURES = "id string, order long, label double, text array<float>, known array<float>"


def _featured(rows: DataFrame, categories: int, numbers: int) -> DataFrame:
    """Rows of _FEATURES, of rows (id, text, *views, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in parts(batches, 1, AT_ONCE):
            ids = part.column(0).cast(pa.string())
            order = [xxhash.xxh3_64_intdigest(i) >> 1 for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(order, pa.int64()),
                    part.column(part.num_columns - 1),
                    pa.array(list(text_view(data, offsets)), pa.list_(pa.float32())),
                    pa.array(list(known_view(part, categories, numbers)), pa.list_(pa.float32())),
                ],
                names=["id", "order", "label", "text", "known"],
            )

    return rows.mapInArrow(run, _FEATURES)


def _surest(
    model: Model, known: tuple[set, set], categories: int, numbers: int, shares: tuple[float, float], most: int
):
    """Of a task's documents those that a view is surest of: (pupil, label, sure, digest, id).

    known: for each pupil the ids that it has a label of; equal texts count once.
    """

    def best(found: list[tuple]) -> list[tuple]:
        kept, seen = [], {}
        for row in sorted(found, key=lambda r: (-r[2], r[3], r[4])):
            pupil, label, _, digest, _ = row
            at = seen.setdefault((pupil, label), set())
            if digest not in at and len(at) < int(most * shares[int(label)]):
                at.add(digest)
                kept.append(row)
        return kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for part, data, offsets in parts(batches, 1, AT_ONCE):
            views = text_view(data, offsets), known_view(part, categories, numbers)
            ids = part.column(0).cast(pa.string()).to_pylist()
            for teacher, weights in ((0, model.text), (1, model.known)):
                p = _sigmoid(views[teacher] @ weights)
                for label, sure in ((1.0, p), (0.0, 1 - p)):
                    able = np.flatnonzero(sure >= SURE)
                    able = able[np.argsort(-sure[able], kind="stable")][: 4 * most]
                    for i in able.tolist():
                        if ids[i] is not None and ids[i] not in known[1 - teacher]:
                            digest = xxhash.xxh3_64_intdigest(data[offsets[i] : offsets[i + 1]].tobytes()) >> 1
                            found.append((1 - teacher, label, round(float(sure[i]), 9), digest, ids[i]))
            if len(found) > 40 * most:
                found = best(found)
        columns = list(zip(*best(found), strict=True)) or [()] * 5
        kinds = [pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["pupil", "label", "sure", "digest", "id"],
        )

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: tuple = CATEGORIES,
    numbers: tuple = NUMBERS,
    label_col: str = "quality",
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
    each_round: int = EACH_ROUND,
) -> Model | None:
    """A model from at most `labelled` labelled documents, drawn by hash of the id, and all others.

    In each of `rounds` rounds both views score every document, and each teaches the other the
    `each_round` different texts, in proportion to the labels, that it is surest of. Documents
    drawn, or taught before, are not taught; nor are those without an id. Models are fitted in
    one executor task, on the rows drawn and taught. A document with several labels has the
    lowest; labels other than 0 and 1, and of unknown documents, are left out; of documents that
    share an id one is taken, by a hash of its columns. None if the labels do not have both values.
    """
    known = (
        labels.filter(F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).cast("double").alias("label"))
    )
    ids = docs.select(F.col(id_col).alias("id")).filter("id is not null").distinct()
    order = F.xxhash64(F.lit("quality"), "id")
    drawn = known.join(ids, "id", "left_semi").orderBy(order, "id").limit(labelled)
    columns = _views(docs, id_col, text_col, categories, numbers)
    named = docs.select(*(c.alias(f"c{i}") for i, c in enumerate(columns)))
    place = [f"c{i}" for i in range(len(columns))]
    sizes = len(categories), len(numbers)

    def rows_of(chosen: DataFrame) -> DataFrame:
        """The features of a bounded number of documents, one row for each id and pupil."""
        whole = F.struct(*place)
        rows = named.join(F.broadcast(chosen), F.col("c0").cast("string") == F.col("id"))
        one = rows.groupBy("id", "pupil", "label").agg(F.min_by(whole, F.xxhash64(*place)).alias("row"))
        featured = one.select("row.*", "label", "pupil")
        return reduce(
            DataFrame.unionByName,
            [
                _featured(featured.filter(F.col("pupil") == p).select(*place, "label"), *sizes).withColumn(
                    "pupil", F.lit(p)
                )
                for p in ((-1,) if chosen is first else (0, 1))
            ],
        )

    first = drawn.select(F.col("id").cast("string").alias("id"), "label", F.lit(-1).alias("pupil"))
    seen = materialize(rows_of(first), "quality-labelled")
    counts = dict(seen.groupBy("label").count().collect())  # two rows
    if len(counts) < 2:
        return None
    good = counts[1.0] / sum(counts.values())
    own = {r["id"] for r in seen.select("id").collect()}  # at most `labelled`
    had = own.copy(), own.copy()
    for _ in range(rounds):
        model = _in_one_task(seen)
        if model is None:
            return None
        finder = _surest(model, had, *sizes, (1 - good, good), each_round)
        found = named.select(*place).mapInArrow(
            finder, "pupil int, label double, sure double, digest long, id string"
        )
        different = found.groupBy("pupil", "label", "digest").agg(F.max("sure").alias("sure"), F.min("id").alias("id"))
        surest = [F.desc("sure"), F.asc("digest")]
        most = F.when(F.col("label") == 1, int(each_round * good)).otherwise(int(each_round * (1 - good)))
        salted = Window.partitionBy("pupil", "label", F.pmod("digest", F.lit(64))).orderBy(*surest)
        whole = Window.partitionBy("pupil", "label").orderBy(*surest)
        some = different.withColumn("n", F.row_number().over(salted)).filter(F.col("n") <= most)
        chosen = some.withColumn("n", F.row_number().over(whole)).filter(F.col("n") <= most)
        taught = chosen.select("id", "label", "pupil").collect()  # at most 2 * each_round
        if not taught:
            break
        for r in taught:
            had[r["pupil"]].add(r["id"])
        frame = docs.sparkSession.createDataFrame(taught, "id string, label double, pupil int")
        seen = materialize(seen.unionByName(rows_of(frame)), "quality-taught")
    return _in_one_task(seen)


def score(
    docs: DataFrame,
    model: Model | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: tuple = CATEGORIES,
    numbers: tuple = NUMBERS,
    keep: list[str] | None = None,
) -> DataFrame:
    """All columns of docs, or those to keep, but any of these names; p_text, p_known, score, keep.

    Every row is scored by its whole text; null is empty text, and null or missing numbers and
    categories are values of their own. Without a model all probabilities are 1. `keep` is score
    >= REJECT_BELOW.
    """
    made = ["p_text", "p_known", "score"]
    own = [c for c in (keep or docs.columns) if c not in (*made, "keep")]
    if model is None:
        return docs.select(*own, *(F.lit(1.0).alias(c) for c in made), F.lit(True).alias("keep"))
    schema = StructType(
        [StructField(f"o{i}", docs.schema[c].dataType) for i, c in enumerate(own)]
        + [StructField(c, DoubleType(), False) for c in made]
    )
    # The text travels once, as the second column; what else is kept follows the views.
    views = _views(docs, id_col, text_col, categories, numbers)
    others = [c for c in own if c != text_col]
    place = {c: len(views) + i for i, c in enumerate(others)} | {text_col: 1}
    order, names = [place[c] for c in own], schema.names
    sent = [F.lit(0), F.col(text_col), *views[2:], *(F.col(c) for c in others)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in parts(batches, 1, AT_ONCE):
            probabilities = model.scores(
                text_view(data, offsets), known_view(part, len(categories), len(numbers))
            )
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in order), *(pa.array(p.astype(float)) for p in probabilities)],
                names=names,
            )

    scored = docs.select(*(c.alias(f"c{i}") for i, c in enumerate(sent))).mapInArrow(run, schema)
    return scored.select(
        *(F.col(f"o{i}").alias(c) for i, c in enumerate(own)),
        *made,
        (F.col("score") >= REJECT_BELOW).alias("keep"),
    )
