"""Symmetric eigenvectors by spectral divide and conquer over polar decompositions (QDWH).

The orthogonal factor U of A - shift * I has eigenvalues +1 and -1, so (I + U) / 2 projects on the
invariant subspace of the eigenvalues above the shift. Its range and complement split A into two
smaller problems, down to single components. Matrices here are as wide as an embedding, never as
long as a table.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def polar(a: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix, by the dynamically weighted Halley iteration.

    `low` is a lower bound of the least singular value of the scaled matrix; it sets the weights and rises to 1.
    While it is small, a QR factorisation keeps the step stable; afterwards a Cholesky-sized solve does.
    Directions whose singular value is below the bound end between -1 and 1.
    """
    size = len(a)
    scale = np.linalg.norm(a)
    if scale == 0:
        return np.zeros_like(a)
    x, low, eye = a / scale, _EPS, np.eye(size)
    for _ in range(rounds):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square)) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        first = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0))
        second = (first - 1) ** 2 / 4
        third = first + second - 1
        if third > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(third) * x, eye]))
            moved = (second / third) * x + (first - second / third) / np.sqrt(third) * q[:size] @ q[size:].T
        else:
            moved = (second / third) * x + (first - second / third) * np.linalg.solve(eye + third * x.T @ x, x.T).T
        moved = (moved + moved.T) / 2
        low = min(1.0, low * (first + second * square) / (1 + third * square))
        change = np.linalg.norm(moved - x)
        x = moved
        if low > 1 - 10 * _EPS and change < np.cbrt(_EPS):
            break
    return x


def _split(a: np.ndarray, shift: float, random: np.random.Generator, size_of_whole: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below `shift`; None where the shift parts nothing cleanly."""
    size = len(a)
    projector = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
    rank = int(round(np.trace(projector)))
    if not 0 < rank < size:
        return None
    above = random.standard_normal((size, rank))
    for _ in range(2):  # subspace iteration; the projector's eigenvalues are 0 and 1, so once is nearly enough
        above, _ = np.linalg.qr(projector @ above)
    whole, _ = np.linalg.qr(np.hstack([above, random.standard_normal((size, size - rank))]))
    above, below = whole[:, :rank], whole[:, rank:]
    if np.linalg.norm(below.T @ a @ above) > 100 * size * _EPS * size_of_whole:
        return None
    return above, below


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of a symmetric matrix.

    A block whose eigenvalues agree to rounding is not split: any basis of it will do.
    """
    random = np.random.default_rng(13)
    whole = np.linalg.norm(matrix)
    found: list[tuple[float, np.ndarray]] = []
    open_ = [((matrix + matrix.T) / 2, np.eye(len(matrix)))]
    while open_:
        a, basis = open_.pop()
        size = len(a)
        centre = np.trace(a) / max(size, 1)
        spread = np.linalg.norm(a - centre * np.eye(size))
        if size <= 1 or spread <= 4 * size * _EPS * whole:
            found += [(a[k, k], basis[:, k]) for k in range(size)]
            continue
        # The mean parts any block that has a spread; the median of the diagonal parts it into even halves more often.
        # Shifts beside them stand in where one of them hits an eigenvalue.
        shifts = [np.median(np.diag(a)), centre, *(centre + spread / np.sqrt(size) * random.uniform(-0.5, 0.5) for _ in range(60))]
        parts = next(filter(None, (_split(a, shift, random, whole) for shift in shifts)), None)
        if parts is None:
            raise ArithmeticError("no shift splits the matrix")
        for part in parts:
            inner = part.T @ a @ part
            open_.append(((inner + inner.T) / 2, basis @ part))
    found.sort(key=lambda pair: -pair[0])
    values = np.array([value for value, _ in found])
    return values, np.column_stack([vector for _, vector in found]) if found else np.zeros((0, 0))
