"""Incidence matrices in compressed sparse rows, and their products. Runs inside Python workers, on NumPy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Csr:
    """Row ``i`` has entries in the columns ``indices[indptr[i]:indptr[i + 1]]``; ``values`` are the entries, or all are 1."""

    indptr: np.ndarray
    indices: np.ndarray
    width: int
    values: np.ndarray | None = None

    @property
    def height(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.width)
        indptr = np.concatenate([[0], np.cumsum(counts)])
        values = None if self.values is None else self.values[order]
        return Csr(indptr, self.rows()[order], self.height, values)


def intervals(ends: np.ndarray) -> Csr:
    """Rows that cover adjoining ranges of columns, each up to its end."""
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(total), total)


def membership(groups: np.ndarray, count: int) -> Csr:
    """A row for each member, with an entry in the column of its group."""
    return Csr(np.arange(len(groups) + 1), groups, count)


def product_sizes(one: Csr, other: Csr) -> np.ndarray:
    """How many products Gustavson's method forms in each row of ``one @ other``, without forming them."""
    formed = np.concatenate([[0], np.cumsum(np.diff(other.indptr)[one.indices])])
    return formed[one.indptr[1:]] - formed[one.indptr[:-1]]


def product(one: Csr, other: Csr) -> Csr:
    """``one @ other`` by Gustavson's method: every entry of a row of ``one`` adds the row of ``other`` that its column
    names to the row's accumulator."""
    lengths = np.diff(other.indptr)[one.indices]
    rows = np.repeat(one.rows(), lengths)
    first = np.repeat(other.indptr[:-1][one.indices], lengths)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    columns = other.indices[first + within]
    terms = np.ones(len(rows), np.int64)
    if one.values is not None:
        terms = terms * np.repeat(one.values, lengths)
    if other.values is not None:
        terms = terms * other.values[first + within]
    # The accumulators of all rows at once: equal places lie together once they are in order.
    places = rows * max(1, other.width) + columns
    if len(places) > 1 and (places[1:] < places[:-1]).any():
        order = np.argsort(places, kind="stable")
        places, rows, columns, terms = places[order], rows[order], columns[order], terms[order]
    starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]])[: len(places)])
    sums = np.add.reduceat(terms, starts) if len(starts) else terms
    counts = np.bincount(rows[starts], minlength=one.height)
    return Csr(np.concatenate([[0], np.cumsum(counts)]), columns[starts], other.width, sums)
