"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The signs of D in the factorisation P(A - sI)Pᵀ = LDLᵀ are those of the eigenvalues of A - sI (Sylvester), so each
factorisation counts the eigenvalues above s. Bisection by these counts isolates each wanted eigenvalue, Rayleigh quotient
iteration from inside its interval converges to it cubically, and the counts say which number it has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: From this ratio of the largest diagonal to the largest other entry on a pivot is one entry (Bunch and Parlett).
PIVOT_RATIO = (1 + 17 ** 0.5) / 8
#: Eigenvalues closer than this part of the largest bound count as one cluster; any basis of its space serves.
CLUSTER = 2.0 ** -46
_STEPS = 60


class NotConverged(ArithmeticError):
    """An iteration left its interval at every width, or its counts disagree."""


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above `shift`: positive ones of D, whose blocks have one or two rows."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal().copy()
        np.fill_diagonal(size, 0)
        p, largest = int(diagonal.argmax()), size.max()
        if diagonal[p] == 0 and largest == 0:
            break
        if diagonal[p] >= PIVOT_RATIO * largest:
            above += a[p, p] > 0
            rest = np.arange(len(a)) != p
            side = a[rest, p]
            a = a[np.ix_(rest, rest)] - np.outer(side, side / a[p, p])
        else:  # two rows whose block has a negative determinant: one eigenvalue of each sign
            pair = list(divmod(int(size.argmax()), len(a)))
            above += 1
            rest = np.ones(len(a), dtype=bool)
            rest[pair] = False
            side = a[np.ix_(rest, pair)]
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pair, pair)], side.T)
    return above


@dataclass
class Slice:
    """An interval: eigenvalues numbered `first` to `last` by falling size lie in (low, high]."""
    low: float
    high: float
    first: int
    last: int


def _halves(matrix: np.ndarray, part: Slice) -> list[Slice]:
    middle = (part.low + part.high) / 2
    above = count_above(matrix, middle)
    if not part.first - 1 <= above <= part.last:
        raise NotConverged(f"{above} eigenvalues above {middle}, in a slice from {part.first} to {part.last}")
    halves = [Slice(middle, part.high, part.first, above), Slice(part.low, middle, above + 1, part.last)]
    return [h for h in halves if h.first <= h.last]


def _orthogonal(vector: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in found:
            vector = vector - (other @ vector) * other
    return vector / np.linalg.norm(vector)


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    for nudge in (0.0, 1.0, 4.0):
        try:
            found = np.linalg.solve(matrix - (shift + nudge * scale * 2.0 ** -52) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found / np.linalg.norm(found)
    raise NotConverged(f"no solution at {shift}")


def _iterate(matrix: np.ndarray, part: Slice, found: list[np.ndarray], scale: float) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration from the middle of a slice, orthogonal to what was found; None if it leaves the slice."""
    slack = CLUSTER * scale
    vector = _orthogonal(np.random.default_rng(part.first).standard_normal(len(matrix)), found)
    value, before = (part.low + part.high) / 2, np.inf
    for step in range(_STEPS):
        vector = _orthogonal(_solved(matrix, value, vector, scale), found)
        if step < 2:  # a fixed shift first, so that the nearest eigenvalue prevails
            continue
        value = float(vector @ matrix @ vector)
        if not part.low - slack <= value <= part.high + slack:
            return None
        off = float(np.linalg.norm(matrix @ vector - value * vector))
        if off <= 2.0 ** -50 * scale or off >= before / 2 and off <= 2.0 ** -44 * scale:
            return value, vector
        before = off
    return None


def leading(matrix: np.ndarray, most: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the `most` largest eigenvalues above `least`, by falling size."""
    if not len(matrix) or not matrix.any():
        return np.empty(0), np.empty((len(matrix), 0))
    scale = float(np.abs(matrix).sum(axis=1).max())
    wanted = min(most, count_above(matrix, least))
    open_parts, closed = [Slice(least, scale * (1 + 2.0 ** -40), 1, count_above(matrix, least))], []
    while open_parts:
        part = open_parts.pop()
        if part.first > wanted:
            continue
        if part.first == part.last or part.high - part.low <= CLUSTER * scale:
            closed.append(part)
        else:
            open_parts += _halves(matrix, part)
    values, vectors = [], []
    for part in sorted(closed, key=lambda p: p.first):
        for _ in range(part.first, part.last + 1):
            while (pair := _iterate(matrix, part, vectors, scale)) is None:
                if part.high - part.low <= CLUSTER * scale:
                    raise NotConverged(f"eigenvalue {part.first} near {part.low}")
                part = _halves(matrix, part)[0]
            values.append(pair[0])
            vectors.append(pair[1])
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    values = np.array(values)[order]
    for number, value in enumerate(values, 1):  # the counts certify the numbering
        slack = 4 * CLUSTER * scale
        if not count_above(matrix, value + slack) < number <= count_above(matrix, value - slack):
            raise NotConverged(f"{value} isn't eigenvalue {number}")
    return values, np.array(vectors)[order].T.reshape(len(matrix), len(values))
