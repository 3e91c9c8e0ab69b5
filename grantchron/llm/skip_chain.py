"""A conditional random field over tokens: chains of neighbours, and groups of similar tokens.

A graph has tokens with features, links between tokens that stand side by side, and groups of
tokens that are alike wherever they stand. A group shares a potential: a node of its own that
all its tokens would rather agree with, so a group of any size costs a link for each token.
Weights are fitted by pseudo-likelihood, labels are found by loopy message passing.
"""

from __future__ import annotations

import io
from typing import NamedTuple

import numpy as np

FEATURES = 1 << 10  # weights that hashed features share
ROUNDS = 12  # of messages; the same for all, so that a document's result is its own
_STEPS, _RATE, _RIDGE = 250, 0.1, 2e-3
_GIVEN = 30.0  # log-potential of a label that is given


class Graph(NamedTuple):
    """Tokens of any number of documents; `given` is a label or -1."""

    features: np.ndarray  # int, (tokens, slots); -1 where there is none
    given: np.ndarray
    links: np.ndarray  # (n, 2): a token and the next one
    member: np.ndarray  # (n, 2): a token and its group
    groups: int


class Field(NamedTuple):
    emit: np.ndarray  # (FEATURES, labels)
    follow: np.ndarray  # (labels, labels): of a token and the next one
    agree: float

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, emit=self.emit, follow=self.follow, agree=self.agree)
        return out.getvalue()

    @staticmethod
    def load(blob: bytes) -> Field:
        with np.load(io.BytesIO(blob)) as found:
            return Field(found["emit"], found["follow"], float(found["agree"]))


def joined(graphs: list[Graph], slots: int) -> Graph:
    if not graphs:
        none = np.empty((0, 2), np.int64)
        return Graph(np.empty((0, slots), np.int64), np.empty(0, np.int64), none, none, 0)
    tokens = np.cumsum([0, *(len(g.given) for g in graphs)])
    groups = np.cumsum([0, *(g.groups for g in graphs)])
    return Graph(
        np.concatenate([g.features for g in graphs]),
        np.concatenate([g.given for g in graphs]),
        np.concatenate([g.links + t for g, t in zip(graphs, tokens, strict=False)]),
        np.concatenate([g.member + (t, s) for g, t, s in zip(graphs, tokens, groups, strict=False)]),
        int(groups[-1]),
    )


def _emitted(features: np.ndarray, emit: np.ndarray) -> np.ndarray:
    rows = np.vstack((emit, np.zeros(emit.shape[1])))  # -1 is the last row
    return rows[features].sum(1)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(graph: Graph, labels: int) -> Field:
    """Weights that make each token's label likely, given its features and the labels around it.

    Label 0 is that of other tokens. One of those in a group with another label is left out: what
    it is, is not known. A group's label is the one but 0 that most of the others in it have.
    Tokens in groups count once more with all features but the first hidden, so that the weight of
    a group is not what their own features leave to explain.
    """
    y, n = graph.given, len(graph.given)
    has = np.zeros((graph.groups, labels))
    np.add.at(has, (graph.member[:, 1], y[graph.member[:, 0]]), 1)
    others = has[graph.member[:, 1]].copy()  # of each membership, without the token itself
    others[np.arange(len(others)), y[graph.member[:, 0]]] -= 1
    some = others.sum(1) > 0
    named = others[:, 1:].sum(1) > 0
    wanted = np.where(named, others[:, 1:].argmax(1) + 1, 0)
    token, wanted, named = graph.member[some, 0], wanted[some], named[some]
    unknown = np.zeros(n, bool)
    unknown[token[named & (y[token] == 0)]] = True
    again = np.unique(token)
    hidden = np.full((len(again), graph.features.shape[1]), -1)
    hidden[:, :1] = graph.features[again, :1]
    features = np.concatenate([graph.features, hidden])
    token = np.concatenate([token, n + np.searchsorted(again, token)])
    wanted = np.concatenate([wanted, wanted])
    y = np.concatenate([y, y[again]])
    weight = np.where(np.concatenate([unknown, unknown[again]]), 0.0, 1.0)
    total = max(weight.sum(), 1.0)

    emit, follow, agree = np.zeros((FEATURES, labels)), np.zeros((labels, labels)), 0.0
    moments = [[np.zeros_like(emit)] * 2, [np.zeros_like(follow)] * 2, [0.0, 0.0]]
    left, right = graph.links[:, 0], graph.links[:, 1]
    slots = features.shape[1]
    real = (features >= 0).ravel()
    places = features.ravel()[real]
    target = np.eye(labels)[y] if n else np.empty((0, labels))
    for step in range(1, _STEPS + 1):
        score = _emitted(features, emit)
        np.add.at(score, right, follow[y[left]])
        np.add.at(score, left, follow[:, y[right]].T)
        np.add.at(score, (token, wanted), agree)
        p = np.exp(score - _log_sum(score, 1)[:, None]) if n else score
        off = (p - target) * weight[:, None] / total
        slope_emit = np.empty_like(emit)
        spread = np.repeat(off, slots, 0)[real]
        for label in range(labels):
            slope_emit[:, label] = np.bincount(places, spread[:, label], FEATURES)
        slope_follow = np.zeros_like(follow)
        np.add.at(slope_follow, y[left], off[right])
        np.add.at(slope_follow.T, y[right], off[left])
        slopes = (
            slope_emit + _RIDGE / 10 * emit,
            slope_follow + _RIDGE * follow,
            off[token, wanted].sum() + _RIDGE * agree,
        )
        values = []
        for i, (value, slope) in enumerate(zip((emit, follow, agree), slopes, strict=True)):
            first = moments[i][0] = 0.9 * moments[i][0] + 0.1 * slope
            second = moments[i][1] = 0.99 * moments[i][1] + 0.01 * slope * slope
            change = (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            values.append(value - _RATE * change)
        emit, follow, agree = values
    return Field(emit, follow, max(float(agree), 0.0))


def infer(graph: Graph, field: Field) -> np.ndarray:
    """For each token the probabilities of its labels, by sum-product messages over all links."""
    n, labels = len(graph.given), field.follow.shape[0]
    if not n:
        return np.empty((0, labels))
    own = np.zeros((n + graph.groups, labels))
    own[:n] = _emitted(graph.features, field.emit)
    given = np.flatnonzero(graph.given > 0)
    own[given, graph.given[given]] += _GIVEN
    ends = np.concatenate([graph.links, graph.member + (0, n)])
    potential = np.empty((len(ends), labels, labels))
    potential[: len(graph.links)] = field.follow
    potential[len(graph.links) :] = np.eye(labels) * field.agree
    sources = np.concatenate([ends[:, 0], ends[:, 1]])
    targets = np.concatenate([ends[:, 1], ends[:, 0]])
    both = np.concatenate([potential, potential.transpose(0, 2, 1)])
    half = len(ends)
    messages = np.zeros((2 * half, labels))

    def belief() -> np.ndarray:
        return own + np.column_stack(
            [np.bincount(targets, messages[:, label], n + graph.groups) for label in range(labels)]
        )

    for _ in range(ROUNDS if half else 0):
        back = np.concatenate([messages[half:], messages[:half]])  # what came the other way
        sent = belief()[sources] - back
        new = _log_sum(sent[:, :, None] + both, 1)
        messages = 0.5 * messages + 0.5 * (new - _log_sum(new, 1)[:, None])
    total = belief()[:n]
    return np.exp(total - _log_sum(total, 1)[:, None])
