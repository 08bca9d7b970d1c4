"""The spectrum of a covariance, kept up to date row by row.

A ``Spectrum`` holds the eigenvalues and eigenvectors of the scatter (sum of outer products of
centred rows) of the rows seen so far. A further row, and every direction of another spectrum, is
a rank-one update: its eigenvalues are the roots of a secular equation, found for all intervals at
once, and eigenvectors follow from a closed form. Directions that an update does not touch, and
equal eigenvalues, are set apart first (deflation).
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
_MOST_STEPS = 60


def _roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(roots of 1 + sum(weights / (poles - x)), poles minus roots as a matrix [pole, root]).

    The poles ascend strictly and the weights are positive, so one root follows every pole. A root
    is sought as a distance from the nearer one of the poles around it, which keeps its digits.
    """
    size = len(poles)
    reach = weights.sum()
    upper = np.append(poles[1:], poles[-1] + reach)
    gap = upper - poles
    middle = poles + gap / 2
    at_middle = 1 + (weights[:, None] / (poles[:, None] - middle[None, :])).sum(axis=0)
    # At the last interval's end no pole stands: there the root always counts from the last pole.
    left = at_middle >= 0
    left[-1] = True
    origin = np.where(left, poles, upper)
    delta = poles[:, None] - origin[None, :]
    half = (at_middle >= 0) | (np.arange(size) < size - 1)
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, np.where(half, gap / 2, gap), 0.0)
    low[-1] = 0.0 if at_middle[-1] >= 0 else gap[-1] / 2
    high[-1] = gap[-1] / 2 if at_middle[-1] >= 0 else gap[-1]
    before = np.arange(size)[:, None] <= np.arange(size)[None, :]
    own = np.arange(size)
    next_ = np.minimum(own + 1, size - 1)
    step = low + (high - low) / 2
    for _ in range(_MOST_STEPS):
        apart = delta - step[None, :]
        terms = weights[:, None] / apart
        slopes = terms / apart
        value = 1 + terms.sum(axis=0)
        slope = slopes.sum(axis=0)
        lower_slope = (slopes * before).sum(axis=0)
        done = np.abs(value) <= 4 * _EPS * size * (1 + np.abs(terms).sum(axis=0))
        if done.all():
            break
        high = np.where(value >= 0, step, high)
        low = np.where(value < 0, step, low)
        # Two poles around the root, with the slopes that each side has here.
        near, far = apart[own, own], apart[next_, own]
        c = value - near * lower_slope - far * (slope - lower_slope)
        a = (near + far) * value - near * far * slope
        b = near * far * value
        with np.errstate(all="ignore"):
            rest = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            change = np.where(a <= 0, (a - rest) / (2 * c), 2 * b / (a + rest))
            change[-1] = near[-1] + near[-1] ** 2 * lower_slope[-1] / c[-1]
            new = step + change
        inside = (new >= low) & (new <= high) & (new != 0)
        step = np.where(done, step, np.where(inside, new, low + (high - low) / 2))
    return origin + step, delta - step[None, :]


def rank_one(values: np.ndarray, vectors: np.ndarray, row: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``V diag(values) V' + weight * row row'``; weight > 0."""
    part = vectors.T @ row
    length = float(np.sqrt(part @ part))
    if length == 0 or weight <= 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    small = 8 * _EPS * max(abs(values[-1]), abs(values[0]), weight * length * length)
    # Equal eigenvalues: a reflection puts what the row has in their space on the last of them.
    first = 0
    while first < len(values):
        last = int(np.searchsorted(values, values[first] + small, side="right"))
        if last - first > 1:
            piece = part[first:last]
            size = float(np.sqrt(piece @ piece))
            mirror = piece.copy()
            mirror[-1] += size if mirror[-1] >= 0 else -size
            square = float(mirror @ mirror)
            if square > 0:
                block = vectors[:, first:last]
                vectors[:, first:last] = block - np.outer(block @ mirror, mirror) * (2 / square)
                sign = -1.0 if piece[-1] >= 0 else 1.0
                part[first:last] = 0.0
                part[last - 1] = sign * size
        first = max(last, first + 1)
    used = np.flatnonzero(weight * np.abs(part) * length > small)
    if len(used) == 0:
        return values, vectors
    poles, shares = values[used], part[used]
    roots, apart = _roots(poles, weight * shares * shares)
    # The row for which these roots are exact: its eigenvectors are orthogonal.
    between = poles[:, None] - poles[None, :]
    np.fill_diagonal(between, 1.0)
    ratio = apart / between
    np.fill_diagonal(ratio, -np.diagonal(apart))
    exact = np.sqrt(np.abs(ratio.prod(axis=1))) * np.where(shares < 0, -1.0, 1.0)
    turned = exact[:, None] / apart
    turned /= np.sqrt((turned * turned).sum(axis=0))
    vectors[:, used] = vectors[:, used] @ turned
    values[used] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Number, mean and scatter (as eigenvalues and eigenvectors) of rows of one dimension."""

    def __init__(self, size: int) -> None:
        self.n = 0
        self.mean = np.zeros(size)
        self.values = np.zeros(size)
        self.vectors = np.eye(size)

    def add(self, row: np.ndarray) -> None:
        off = row - self.mean
        self.n += 1
        self.mean = self.mean + off / self.n
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, (self.n - 1) / self.n)

    def merge(self, other: Spectrum) -> None:
        """Take in another spectrum: its directions one by one, then the distance of the means."""
        if other.n == 0:
            return
        total = self.n + other.n
        off = other.mean - self.mean
        for value, direction in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, direction, float(value))
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / total)
        self.mean = self.mean + off * (other.n / total)
        self.n = total

    def to_bytes(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, size: int) -> Spectrum:
        numbers = np.frombuffer(data, np.float64)
        found = cls(size)
        found.n = int(numbers[0])
        found.mean = numbers[1 : size + 1].copy()
        found.values = numbers[size + 1 : 2 * size + 1].copy()
        found.vectors = numbers[2 * size + 1 :].reshape(size, size).copy()
        return found
