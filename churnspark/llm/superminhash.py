"""SuperMinHash signatures of many sets at once, in numpy.

For every element the algorithm draws a random permutation of the slots step by step
(Fisher-Yates): at step j the element proposes ``j + r`` with a fresh fraction r to the slot
that comes j-th in its permutation; a slot keeps its least proposal. A proposal of a later
step never beats one of an earlier step, so all elements of a set take step j together and a
set stops as soon as each of its slots holds a value. Ranks of one element are correlated
(each slot gets another step), which lowers the variance against independent slots.
"""

from __future__ import annotations

import numpy as np

from churnspark.llm.textbytes import mix

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0xA24BAED4963EE407)


def _draws(values: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit draws of each element for one step."""
    first, second = ((2 * step + i) * int(_STEP) % (1 << 64) for i in (1, 2))
    return mix(values + np.uint64(first)), mix(values + np.uint64(second))


def signatures(values: np.ndarray, rows: np.ndarray, count: int, slots: int) -> np.ndarray:
    """``count`` rows of ``slots`` values: step in the top byte, fraction in the other 56 bits.

    ``values`` are the distinct elements, ``rows`` their sets in ascending order. A set without
    elements keeps ``EMPTY`` in all slots. At most 256 slots.
    """
    found = np.full((count, slots), EMPTY, np.uint64)
    if len(values) == 0:
        return found
    flat = found.reshape(-1)
    sizes = np.bincount(rows, minlength=count)
    active_rows = sizes > 0
    order: np.ndarray | None = None
    for step in range(slots):
        if step:
            unfilled = (found == EMPTY).any(axis=1) & active_rows
            if not unfilled.any():
                break
            keep = unfilled[rows]
            values, rows = values[keep], rows[keep]
            if step == 1:
                # The first step needs no order: slot k is still at place k. Replay its swap.
                _, place = _draws(values, 0)
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(values), 1))
                _swap(order, 0, _choose(place, 0, slots))
            else:
                order = order[keep]
            active_rows = unfilled
        fraction, place = _draws(values, step)
        chosen = _choose(place, step, slots)
        if step:
            _swap(order, step, chosen)
            chosen = order[:, step].astype(np.int64)
        proposal = (fraction >> np.uint64(8)) | (np.uint64(step) << np.uint64(56))
        np.minimum.at(flat, rows * slots + chosen, proposal)
    return found


def _choose(place: np.ndarray, step: int, slots: int) -> np.ndarray:
    """A uniform place from ``step`` to the last slot."""
    return step + (((place >> np.uint64(32)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)


def _swap(order: np.ndarray, step: int, chosen: np.ndarray) -> None:
    each = np.arange(len(order))
    held = order[each, chosen]
    order[each, chosen] = order[:, step]
    order[:, step] = held


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per row and band of neighbouring slots; equal only for equal slots, up to hashing."""
    rows, slots = signature.shape
    width = slots // bands
    parts = signature[:, : bands * width].reshape(rows, bands, width)
    keys = np.repeat((np.arange(bands, dtype=np.uint64) * _STEP)[None, :], rows, axis=0)
    for i in range(width):
        keys = mix(keys ^ mix(parts[:, :, i]))
    return keys
