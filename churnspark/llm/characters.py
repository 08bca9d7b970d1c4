"""Code points of text slices and their classes."""

from __future__ import annotations

import unicodedata

import numpy as np

OTHER, LETTER, NUMBER, SPACE = range(4)
# Characters with the Unicode property White_Space.
_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_HELD: dict[str, np.ndarray] = {}


def classes() -> np.ndarray:
    """Class of every code point, by Unicode category and White_Space."""
    if "classes" not in _HELD:
        kinds = {"L": LETTER, "N": NUMBER}
        found = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        found[_SPACES] = SPACE
        _HELD["classes"] = found
    return _HELD["classes"]


def folded_letters() -> np.ndarray:
    """Lower-case code point of every letter (itself where that is longer), 0 for all else."""
    if "folded" not in _HELD:
        found = np.zeros(0x110000, np.uint32)
        for point in np.flatnonzero(classes() == LETTER).tolist():
            lowered = chr(point).lower()
            found[point] = ord(lowered) if len(lowered) == 1 else point
        _HELD["folded"] = found
    return _HELD["folded"]


def decoded(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, code points, byte position of each and the end, offsets in code points).

    Bytes that are not UTF-8 become U+FFFD, which may change bytes and offsets.
    """
    raw = data.tobytes()
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        fixed = [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1], offsets[1:])]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in fixed])]).astype(np.int64)
        raw = b"".join(fixed)
        text, data = raw.decode("utf-8"), np.frombuffer(raw, np.uint8)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return raw, offsets, points, lead, np.searchsorted(lead, offsets)
