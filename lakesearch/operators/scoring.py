"""Scores of documents for a whole batch of queries: small matrix products inside the tasks.

A slice of documents is a matrix of shares by term, a batch of queries one of weights by term. Their product
has all scores of the slice, so a posting is one cell however many queries ask for its term, and
no row for a posting and a query is ever made. Each task keeps its own k best per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Scores are compared at this precision: terms summed in another order must tie.
SCORE_DIGITS = 9
# Cells of one matrix in a task.
CELLS = 1_000_000
# Tokens that are counted at once.
TOKENS = 250_000

BEST = "n int, doc bigint, score double"


@dataclass
class Weights:
    """Weights of one measured batch of queries, sorted by query; `terms` of their numbers `t`."""

    terms: list[str]
    q: np.ndarray
    t: np.ndarray
    w: np.ndarray

    def groups(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(queries, terms) whose matrix has CELLS cells at most, or is that of one query."""
        out, queries, terms = [], [], set()
        for n, first, last in zip(*_runs(self.q)):
            own = terms.union(self.t[first:last].tolist())
            if queries and len(own) * (len(queries) + 1) > CELLS:
                out.append((np.array(queries), np.array(sorted(terms))))
                queries, own = [], set(self.t[first:last].tolist())
            queries.append(n)
            terms = own
        return [*out, (np.array(queries), np.array(sorted(terms)))] if queries else []

    def matrix(self, queries: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Weights by term and query; a query's rows follow one another."""
        first, last = np.searchsorted(self.q, queries[0], "left"), np.searchsorted(self.q, queries[-1], "right")
        out = np.zeros((len(terms), len(queries)))
        out[np.searchsorted(terms, self.t[first:last]), np.searchsorted(queries, self.q[first:last])] = self.w[first:last]
        return out


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value, first and end of each run of equal values."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, int)
    return values[first], first, np.r_[first[1:], len(values)] if len(values) else first


def kept(best: tuple[np.ndarray, ...], more: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query of both lists of (query, doc, score)."""
    q, doc, score = (np.concatenate(x) for x in zip(best, more))
    order = np.lexsort((doc, -np.round(score, SCORE_DIGITS), q))
    first = np.searchsorted(q[order], q[order], "left")
    order = order[np.arange(len(order)) - first < k]
    return q[order], doc[order], score[order]


class _Best:
    """A task's k best documents of each query so far."""

    def __init__(self, weights: Weights, k: int):
        self.weights, self.k, self.groups = weights, k, weights.groups()
        self.signed = bool((weights.w <= 0).any())
        self.best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        self.bar = np.full(int(weights.q.max()) + 1 if len(weights.q) else 0, -np.inf)
        self.held = self.weights.matrix(*self.groups[0]) if len(self.groups) == 1 else None

    def add(self, docs: np.ndarray, row: np.ndarray, t: np.ndarray, share: np.ndarray) -> None:
        """`row` (rising) and `t`: places of `share` in the matrix of documents and terms."""
        for queries, terms in self.groups:
            w = self.weights.matrix(queries, terms) if self.held is None else self.held
            at = np.minimum(np.searchsorted(terms, t), len(terms) - 1)
            own = terms[at] == t
            r, c, x = row[own], at[own], share[own]
            step = max(1, CELLS // max(w.shape))
            for s in range(0, len(docs), step):
                a, b = np.searchsorted(r, [s, s + step])
                if a < b:
                    self._slice(docs[s : s + step], queries, w, r[a:b] - s, c[a:b], x[a:b])

    def _slice(self, docs: np.ndarray, queries: np.ndarray, w: np.ndarray, r: np.ndarray, c: np.ndarray, x: np.ndarray) -> None:
        shape = (len(docs), w.shape[0])
        shares = np.bincount(r * shape[1] + c, weights=x, minlength=shape[0] * shape[1]).reshape(shape)
        scores = shares @ w
        # Shares are positive: without a weight of zero or below, a score of zero is no hit at all.
        hit = (shares > 0).astype(np.float32) @ self._asked(queries).astype(np.float32) > 0 if self.signed else scores > 0
        ranked = np.where(hit, np.round(scores, SCORE_DIGITS), -np.inf)
        bar = self.bar[queries]
        if len(docs) > self.k:
            bar = np.maximum(bar, np.partition(ranked, len(docs) - self.k, axis=0)[len(docs) - self.k])
        d, q = np.nonzero(hit & (ranked >= bar))
        if not len(d):
            return
        self.best = kept(self.best, (queries[q], docs[d], scores[d, q]), self.k)
        n, first, end = _runs(self.best[0])
        full = end - first >= self.k
        self.bar[n[full]] = np.round(self.best[2][end[full] - 1], SCORE_DIGITS)

    def _asked(self, queries: np.ndarray) -> np.ndarray:
        """1 where a query has a term, whatever its weight."""
        terms = next(t for q, t in self.groups if q[0] == queries[0])
        return Weights(self.weights.terms, self.weights.q, self.weights.t, np.ones(len(self.weights.w))).matrix(queries, terms)

    def batch(self) -> pa.RecordBatch:
        q, doc, score = self.best
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.float64())], names=["n", "doc", "score"])


def token_counts(tokens: pa.ListArray) -> Iterator[tuple[int, int, pa.Array]]:
    """(first row, end, flat tokens) of slices of rows with about TOKENS tokens."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths) // TOKENS
    _, first, end = _runs(group)
    for a, b in zip(first, end):
        yield int(a), int(b), tokens.slice(a, b - a).flatten()


def best_of_texts(weights, k: int, k1: float, b: float):
    """Arrow-batch function: (doc, tokens, mean) in, the task's k best of each query out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = weights.value
        best, wanted = _Best(shared, k), pa.array(shared.terms, pa.string())
        for batch in batches:
            docs, tokens = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            if not len(docs):
                continue
            mean = batch.column(2)[0].as_py()
            lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
            for first, end, flat in token_counts(tokens):
                t = pc.index_in(flat, value_set=wanted).fill_null(-1).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(end - first), lengths[first:end])
                cell, tf = np.unique((row * len(wanted) + t)[t >= 0], return_counts=True)
                row, t = np.divmod(cell, max(1, len(wanted)))
                dl = lengths[first:end][row]
                share = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / mean)) if len(row) else np.empty(0)
                best.add(docs[first:end], row, t, share)
        yield best.batch()

    return run


def best_of_postings(weights, k: int):
    """Arrow-batch function: (doc, t, share) rows, those of a document one after another, in; the task's k best of each query out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, left = _Best(weights.value, k), None
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            rows = rows if left is None else [np.concatenate(x) for x in zip(left, rows)]
            docs, first, _ = _runs(rows[0])
            if len(docs):
                cut = first[-1]  # the last document may go on in the next batch
                left = [x[cut:] for x in rows]
                if cut:
                    best.add(docs[:-1], np.searchsorted(first, np.arange(cut), "right") - 1, rows[1][:cut], rows[2][:cut])
        if left is not None:
            best.add(left[0][:1], np.zeros(len(left[0]), np.int64), left[1], left[2])
        yield best.batch()

    return run


def postings_of_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tokens) in, (doc, dl, term, tf) of each document and distinct term out, counted inside the row."""
    for batch in batches:
        docs, tokens = batch.column(0), batch.column(1)
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        for first, end, flat in token_counts(tokens):
            if not len(flat):
                continue
            coded = flat.dictionary_encode()
            row = np.repeat(np.arange(first, end), lengths[first:end])
            cell, tf = np.unique(row * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            row, t = np.divmod(cell, len(coded.dictionary))
            columns = [docs.take(pa.array(row)), pa.array(lengths[row], pa.int64()), coded.dictionary.take(pa.array(t)), pa.array(tf, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "dl", "term", "tf"])
