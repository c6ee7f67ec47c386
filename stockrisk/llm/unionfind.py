"""Connected components of a block of links inside one task."""

from __future__ import annotations

import numpy as np


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indices over the links (left, right)."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        open_ = a != b
        if not open_.any():
            break
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
    return root
