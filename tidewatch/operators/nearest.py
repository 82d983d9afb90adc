"""Nearest rows in space: cells of neighbouring rows, and only pairs of cells that can hold a nearest row are compared."""

from __future__ import annotations

import numpy as np

#: Rows and queries of a cell, cells of queries that are bounded together, and pairs of cells that are compared at once.
ROW_CELL, QUERY_CELL, GROUP, PAIRS = 64, 16, 16, 1024
#: Components from here on have squares that bounds cannot be taken of; such rows are compared one by one.
FAR = 1e9
#: Distances that are held at once.
BLOCK_CELLS = 1 << 20


def rounded_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, `similarity.euclidean` rounded to six digits, with the additions in the same order."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total = total + (a[:, i] - b[:, i]) * (a[:, i] - b[:, i])
    steps = np.floor(np.sqrt(total) * 1e6 + 0.5)
    return np.where(np.isnan(steps), 0.0, np.clip(steps, -(2.0**63), 2.0**63)) / 1e6


def distinct(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct rows in order of a mix of their components, equal rows side by side, and where a new row begins.

    Different rows of the same mix may come between equal ones, which then count as different.
    """
    mix = np.zeros(len(z))
    for i in range(z.shape[1]):
        mix = mix + z[:, i] * (i + 0.6180339887)
    order = np.argsort(mix, kind="stable")
    ahead = z[order]
    begins = np.ones(len(z), bool)
    begins[1:] = (ahead[1:] != ahead[:-1]).any(axis=1)
    return order, begins


def _cell_order(z: np.ndarray, size: int) -> np.ndarray:
    """Places of the rows in the order of a k-d tree whose leaves are runs of `size` rows."""
    order, todo = np.arange(len(z)), [(0, len(z))]
    while todo:
        start, end = todo.pop()
        if end - start <= size:
            continue
        own = z[order[start:end]]
        widest = np.argmax(own.max(axis=0) - own.min(axis=0))
        middle = -(-(end - start) // (2 * size)) * size
        order[start:end] = order[start:end][np.argpartition(own[:, widest], middle)]
        todo += [(start, start + middle), (start + middle, end)]
    return order


def _in_cells(z: np.ndarray, size: int) -> np.ndarray:
    """The rows as (cell, row, component), the last row repeated to fill its cell."""
    return np.concatenate([z, np.repeat(z[-1:], -len(z) % size, axis=0)]).reshape(-1, size, z.shape[1])


class Cells:
    """Rows in cells of neighbours, each with its box."""

    def __init__(self, z: np.ndarray):
        self.z, self.place = z, _cell_order(z, ROW_CELL)
        cells = _in_cells(z[self.place], ROW_CELL)
        self.low, self.high = cells.min(axis=1), cells.max(axis=1)
        # A product with (q, 1) is the squared distance less that of the query, from below: rounding is far under 1e-12 of the lengths.
        lengths = (cells * cells).sum(axis=2) * (1 - 1e-12) - 1e-12
        self.planes = np.ascontiguousarray(np.concatenate([-2 * cells, lengths[:, :, None]], axis=2).transpose(0, 2, 1))

    def nearest(self, q: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance, place) of the k nearest rows per query, ties by place, of those at `limit` or nearer.

        Where there are fewer, the place is the number of rows. Distances are exact and taken only of rows that may be
        among the k nearest, as boxes and then a matrix product tell.
        """
        distances, places = np.empty((len(q), k)), np.empty((len(q), k), int)
        order = _cell_order(q, QUERY_CELL)
        cells = _in_cells(q[order], QUERY_CELL)
        for first in range(0, len(cells), GROUP):
            at = order[first * QUERY_CELL : (first + GROUP) * QUERY_CELL]
            distances[at], places[at] = self._group(q[at], cells[first : first + GROUP], k, limit[at])
        return distances, places

    def _gaps(self, some: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Squared distances, from below, of the boxes (low, high) to those of some cells of rows."""
        gap = np.maximum(self.low[some] - high[:, None], low[:, None] - self.high[some])
        np.maximum(gap, 0, out=gap)
        return np.einsum("cij,cij->ci", gap, gap) * (1 - 1e-12)

    def _group(self, q: np.ndarray, cells: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, every = len(q), np.arange(len(self.low))
        low, high = cells.min(axis=1), cells.max(axis=1)
        lengths = (cells * cells).sum(axis=2) * (1 - 1e-12)
        asks = np.concatenate([cells, np.ones((*cells.shape[:2], 1))], axis=2)
        least = self._gaps(every, low.min(axis=0)[None], high.max(axis=0)[None])[0]
        if np.isinf(limit).any():
            limit = np.minimum(limit, self._first_limit(q, k, least))
        # The limits stand in as rows that come after all others.
        found = np.repeat(limit[:, None], k, axis=1), np.full((n, k), len(self.z))

        def reach() -> np.ndarray:
            """Squares of the distances up to which a row can matter, per query; those that fill the last cell want none."""
            squares = np.full(cells.shape[:2], -np.inf)
            squares.reshape(-1)[:n] = (found[0][:, -1] + 1e-6) ** 2 * (1 + 1e-12)
            return squares

        def meet(mine: np.ndarray, theirs: np.ndarray) -> None:
            nonlocal found
            about = np.matmul(asks[mine], self.planes[theirs])
            hits = np.flatnonzero(about <= (reach() - lengths)[mine][:, :, None])
            asker, j = np.divmod(hits, ROW_CELL)
            pair, i = np.divmod(asker, QUERY_CELL)
            query, row = mine[pair] * QUERY_CELL + i, theirs[pair] * ROW_CELL + j
            real = row < len(self.z)
            query, row = query[real], self.place[row[real]]
            every_query = np.concatenate([np.repeat(np.arange(n), k), query])
            distance = np.concatenate([found[0].ravel(), rounded_distance(self.z[row], q[query])])
            place = np.concatenate([found[1].ravel(), row])
            order = np.lexsort((place, distance, every_query))
            kept = order[np.searchsorted(every_query[order], np.arange(n))[:, None] + np.arange(k)]
            found = distance[kept], place[kept]

        some = np.flatnonzero(least <= reach().max())
        gaps = self._gaps(some, low, high)
        # The nearest cells first, as they bring the limits down.
        near = np.argsort(gaps, axis=1)[:, :8]
        mine, theirs = np.repeat(np.arange(len(cells)), near.shape[1]), near.ravel()
        can = gaps[mine, theirs] <= reach().max(axis=1)[mine]
        meet(mine[can], some[theirs[can]])
        gaps[np.arange(len(cells))[:, None], near] = np.inf
        mine, theirs = np.nonzero((gaps <= reach().max(axis=1)[:, None]) & np.isfinite(gaps))
        for start in range(0, len(mine), PAIRS):
            meet(mine[start : start + PAIRS], some[theirs[start : start + PAIRS]])
        return found

    def _first_limit(self, q: np.ndarray, k: int, least: np.ndarray) -> np.ndarray:
        """A distance within which k rows are, per query, from the cells nearest to all of them."""
        count = 3 + -(-k // ROW_CELL)
        near = np.argpartition(least, count)[:count] if len(least) > count else np.arange(len(least))
        row = (near[:, None] * ROW_CELL + np.arange(ROW_CELL)).ravel()
        row = self.place[row[row < len(self.z)]]
        if len(row) < k:
            return np.full(len(q), np.inf)
        z = self.z[row]
        about = (z * z).sum(axis=1) - 2 * (q @ z.T)
        at = row[np.argpartition(about, k - 1, axis=1)[:, :k]]
        return rounded_distance(self.z[at.ravel()], np.repeat(q, k, axis=0)).reshape(-1, k).max(axis=1)


def _one_by_one(z: np.ndarray, q: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `Cells.nearest`, by the distances of all pairs."""
    found = np.repeat(limit[:, None], k, axis=1), np.full((len(q), k), len(z))
    step = max(1, BLOCK_CELLS // max(1, len(z)))
    for i in range(0, len(q), step):
        some = q[i : i + step]
        all_pairs = rounded_distance(np.tile(z, (len(some), 1)), np.repeat(some, len(z), axis=0)).reshape(len(some), -1)
        distance = np.concatenate([all_pairs, found[0][i : i + step]], axis=1)
        order = np.argsort(distance, axis=1, kind="stable")[:, :k]
        found[0][i : i + step] = np.take_along_axis(distance, order, axis=1)
        found[1][i : i + step] = np.minimum(order, len(z))
    return found


class Nearest:
    """The search of one set of rows, whatever their values. Of equal rows the first k alone can be among the k nearest."""

    def __init__(self, z: np.ndarray, k: int):
        order, begins = distinct(z)
        at = np.arange(len(z))
        place = np.sort(order[at - np.maximum.accumulate(np.where(begins, at, 0)) < k])
        plain = (np.abs(z[place]) < FAR).all(axis=1)
        self.k, self.n, self.plain, self.odd, self.odd_z = k, len(z), place[plain], place[~plain], z[place[~plain]]
        self.all_z, self.place = z[place], place
        self.cells = Cells(z[self.plain]) if len(self.plain) else None

    def _of_odd(self, q: np.ndarray, limit: np.ndarray, near: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        distance, at = _one_by_one(self.odd_z, q, self.k, limit)
        both = np.concatenate([near[0], distance], axis=1), np.concatenate([near[1], np.append(self.odd, self.n)[at]], axis=1)
        order = np.lexsort((both[1], both[0]), axis=1)[:, : self.k]
        return np.take_along_axis(both[0], order, axis=1), np.take_along_axis(both[1], order, axis=1)

    def search(self, q: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance, place) of the k nearest rows per query, ties by place, of those at `limit` or nearer; the place is the number of rows where there are fewer."""
        distances, places = np.repeat(limit[:, None], self.k, axis=1), np.full((len(q), self.k), self.n)
        plain = (np.abs(q) < FAR).all(axis=1)
        if self.cells is not None and plain.any():
            distance, at = self.cells.nearest(q[plain], self.k, limit[plain])
            places[plain], distances[plain] = np.append(self.plain, self.n)[at], distance
        if len(self.odd) and plain.any():
            distances[plain], places[plain] = self._of_odd(q[plain], limit[plain], (distances[plain], places[plain]))
        if not plain.all():
            distance, at = _one_by_one(self.all_z, q[~plain], self.k, limit[~plain])
            distances[~plain], places[~plain] = distance, np.append(self.place, self.n)[at]
        return distances, places
