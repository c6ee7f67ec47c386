"""Product quantisation: coarse centroids, residual codes, table-lookup distances. Only numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CODES = 256
STEPS = 8


def kmeans(rows: np.ndarray, k: int, steps: int, seed: int) -> np.ndarray:
    """At most ``k`` centroids; fewer if there are fewer distinct rows."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(rows, axis=0)
    centroids = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(steps):
        own = nearest(rows, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        count = np.bincount(own, minlength=len(centroids))
        filled = count > 0
        centroids[filled] = sums[filled] / count[filled, None]
    return centroids


def squared_distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    d = (rows**2).sum(1)[:, None] + (centroids**2).sum(1)[None, :] - 2 * rows @ centroids.T
    return np.maximum(d, 0)


def nearest(rows: np.ndarray, centroids: np.ndarray, block: int = 8192) -> np.ndarray:
    parts = [squared_distances(rows[i : i + block], centroids).argmin(1) for i in range(0, len(rows), block)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


@dataclass
class Index:
    """Coarse centroids (lists, width) and codebooks (subspaces, codes, sub-width) for residuals."""

    centroids: np.ndarray
    codebooks: np.ndarray

    @classmethod
    def fit(cls, rows: np.ndarray, lists: int, subspaces: int, seed: int = 7) -> Index:
        centroids = kmeans(rows, lists, STEPS, seed)
        residual = rows - centroids[nearest(rows, centroids)]
        parts = np.split(residual, subspaces, axis=1)
        books = [kmeans(p, CODES, STEPS, seed + 1 + i) for i, p in enumerate(parts)]
        return cls(centroids, np.stack([np.pad(b, ((0, CODES - len(b)), (0, 0)), mode="edge") for b in books]))

    def probes(self, rows: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Home list of each row, and a mask of the lists that can hold a point within ``radius`` of it.

        A point of list c is at least as near to c as to the row's home h, so
        it lies beyond the plane half way between them; a row farther than
        the radius from that plane has no neighbour in c.
        """
        d = squared_distances(rows, self.centroids)
        home = d.argmin(1)
        apart = np.sqrt(squared_distances(self.centroids, self.centroids))[home]
        plane = (d - d[np.arange(len(rows)), home][:, None]) / np.maximum(2 * apart, 1e-12)
        reach = plane <= radius + 1e-6
        reach[np.arange(len(rows)), home] = True
        return home, reach

    def encode(self, rows: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (uint8) of the rows' residuals, and how far each row is from what its codes decode to."""
        residual = rows - self.centroids[home]
        parts = np.split(residual, len(self.codebooks), axis=1)
        codes = np.stack([nearest(p, b) for p, b in zip(parts, self.codebooks, strict=True)], axis=1)
        decoded = np.concatenate([b[c] for b, c in zip(self.codebooks, codes.T, strict=True)], axis=1)
        return codes.astype(np.uint8), np.linalg.norm(residual - decoded, axis=1)

    def table_distances(self, queries: np.ndarray, which: np.ndarray | int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances (queries, coded rows) by lookup: queries exact, rows as the codes of their list ``which`` decode.

        |q - c - d|^2 is |q|^2 + |c + d|^2 - 2 (q c + q d): one table a query of
        its products with every code serves the rows of all lists.
        """
        which = np.broadcast_to(which, len(codes))
        lists, place = np.unique(which, return_inverse=True)
        dots = (self.centroids[lists] @ queries.T)[place]
        parts = np.split(queries, len(self.codebooks), axis=1)
        for part, book, code in zip(parts, self.codebooks, codes.T, strict=True):
            dots += (book @ part.T)[code]
        decoded = self.centroids[which] + np.concatenate([b[c] for b, c in zip(self.codebooks, codes.T, strict=True)], axis=1)
        squared = (queries**2).sum(1)[None, :] + (decoded**2).sum(1)[:, None] - 2 * dots
        return np.sqrt(np.maximum(squared, 0)).T
