"""Token ids of whole text columns by a byte-level BPE vocabulary of the ``tokenizers`` library.

The merges of such a vocabulary never cross the pieces into which its pattern cuts a text. The
pieces are found for a slice of texts at once from character classes, every distinct piece is
encoded once by the library and kept, and the ids of a text are gathered from those of its pieces.
Strings of special tokens inside a text are those tokens, or ordinary text where asked for.

A vocabulary of the ``sentencepiece`` library is used in the same way: none of its pieces has a
blank after another character, so what a run of blanks and the characters up to the next blank
become does not depend on the rest of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from churnspark.llm.characters import SPACE, classes, decoded
from churnspark.llm.textbytes import slices, span_hashes, utf8

# Distinct pieces kept by a worker before it starts anew.
CACHE_PIECES = 300_000
# Pieces that go to the library at once: its results are large.
ENCODE_PIECES = 1 << 13
SLICE_BYTES = 3 << 20


def piece_starts(points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where a piece starts, as flags per code point; ``offsets``: texts in code points.

    The pattern: 's 't 're 've 'm 'll 'd, a run of letters, of numbers or of other characters, each
    with one blank before it, a run of white space without its last character if text follows.
    """
    size = len(points)
    kind = kinds[points]
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    first = first[:-1]
    starts = first.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    after_space = np.flatnonzero(starts & ~first & (kind != SPACE))
    after_space = after_space[kind[after_space - 1] == SPACE]
    starts[after_space - 1] = True
    starts[after_space[points[after_space - 1] == 0x20]] = False

    quotes = np.flatnonzero((points == 0x27) & starts)
    if len(quotes):
        text_end = offsets[np.searchsorted(offsets, quotes, side="right")]

        def at(step: int) -> np.ndarray:
            inside = quotes + step < text_end
            return np.where(inside, points[np.minimum(quotes + step, size - 1)], 0)

        one, two = at(1), at(2)
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ~single & (
            (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        )
        for chosen, length in ((single, 2), (double, 3)):
            begin = quotes[chosen]
            starts[begin + 1] = False
            if length == 3:
                starts[begin + 2] = False
            following = begin + length
            starts[following[following < text_end[chosen]]] = True
    return starts


class PieceCache:
    """Ids of texts from those of their distinct pieces; one per Python worker and vocabulary."""

    def __init__(self) -> None:
        self._reset()

    def _pieces(self, raw: bytes, points: np.ndarray, lead: np.ndarray, point_offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin, in code points; every text that is not empty begins with one."""
        raise NotImplementedError

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _reset(self) -> None:
        self.known: dict[int, int] = {}
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0

    def _add(self, hashes: list[int], pieces: list[str]) -> None:
        counts, parts = [], []
        for i in range(0, len(pieces), ENCODE_PIECES):
            found = self._encoded(pieces[i : i + ENCODE_PIECES])
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            parts.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        lengths, ids = np.concatenate(counts), np.concatenate(parts)
        begin, have = len(self.known), self.used
        while begin + len(lengths) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while have + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[have : have + len(ids)] = ids
        self.start[begin : begin + len(lengths)] = have + np.cumsum(lengths) - lengths
        self.length[begin : begin + len(lengths)] = lengths
        self.known.update(zip(hashes, range(begin, begin + len(lengths)), strict=True))
        self.used += len(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts in UTF-8 ``data``; bytes that are not UTF-8 become U+FFFD."""
        raw, offsets, points, lead, point_offsets = decoded(data, offsets)
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        data = np.frombuffer(raw, np.uint8)
        begin = self._pieces(raw, points, lead, point_offsets)
        owner = np.searchsorted(begin, point_offsets)
        begin, end = lead[begin], np.append(lead[begin[1:]], len(data))
        hashes, where, inverse = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
        if len(self.known) > CACHE_PIECES:
            self._reset()
        keys = hashes.tolist()
        missing = [i for i, h in enumerate(keys) if h not in self.known]
        if missing:
            places = where[missing]
            spans = zip(begin[places].tolist(), end[places].tolist(), strict=True)
            self._add([keys[i] for i in missing], [raw[a:b].decode("utf-8") for a, b in spans])
        slots = np.fromiter((self.known[h] for h in keys), np.int64, len(keys))[inverse]
        lengths = self.length[slots]
        totals = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.arange(totals[-1]) + np.repeat(self.start[slots] - totals[:-1], lengths)]
        return ids, totals[owner]


class Encoder(PieceCache):
    """A byte-level BPE vocabulary of the ``tokenizers`` library.

    With ``special`` the strings of its special tokens inside a text become those tokens, as by the
    library's defaults; without, they are ordinary text.
    """

    def __init__(self, path: str, special: bool = True) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.classes = classes()
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        # The longest first: the library takes the longest of those that begin at one place.
        strings = b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))
        self.special = re.compile(strings) if added else None

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _special_spans(self, raw: bytes, lead: np.ndarray, point_offsets: np.ndarray) -> list[tuple[int, int]]:
        """(first, after the last) code point of every special token's string that lies within one text."""
        found = []
        at = 0
        while self.special is not None and (match := self.special.search(raw, at)):
            first, last = np.searchsorted(lead, match.span()).tolist()
            border = np.searchsorted(point_offsets, first, side="right")
            if last <= point_offsets[border]:
                found.append((first, last))
                at = match.end()
            else:
                at = int(lead[point_offsets[border]])
        return found

    def _pieces(self, raw: bytes, points: np.ndarray, lead: np.ndarray, point_offsets: np.ndarray) -> np.ndarray:
        spans = self._special_spans(raw, lead, point_offsets)
        if not spans:
            return np.flatnonzero(piece_starts(points, point_offsets, self.classes))
        # What stands between special tokens is cut as if it were a text of its own.
        starts = piece_starts(points, np.union1d(point_offsets, np.array(spans).ravel()), self.classes)
        for first, last in spans:
            starts[first + 1 : last] = False
        return np.flatnonzero(starts)


class SentenceEncoder(PieceCache):
    """A vocabulary of the ``sentencepiece`` library, for texts that begin with the blank it adds."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        super().__init__()
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.blank = self.processor.piece_to_id("\u2581")

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        # A piece begins with a blank, and the library adds one; alone it would give nothing.
        found = self.processor.encode([p[1:] for p in pieces], num_threads=1)
        return [ids if ids else [self.blank] for ids in found]

    def _pieces(self, raw: bytes, points: np.ndarray, lead: np.ndarray, point_offsets: np.ndarray) -> np.ndarray:
        blank = points == 0x20
        starts = blank.copy()
        starts[1:] &= ~blank[:-1]
        first = point_offsets[:-1][point_offsets[:-1] < point_offsets[1:]]
        starts[first] = True
        return np.flatnonzero(starts)


_ENCODERS: dict[tuple, PieceCache] = {}


def encoder(path: str, kind: type[PieceCache] = Encoder, **options) -> PieceCache:
    key = (path, kind, *sorted(options.items()))
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(path, **options)
    return _ENCODERS[key]


def token_ids(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, ids, offsets) per slice of a text column; a null is empty."""
    data, offsets = utf8(column)
    own = encoder(path)
    for first, last in slices(offsets, SLICE_BYTES):
        a, b = offsets[first], offsets[last]
        yield first, last, *own.encode(data[a:b], offsets[first : last + 1] - a)
