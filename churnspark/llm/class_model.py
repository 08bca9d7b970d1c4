"""Scoring texts with a Brown class-based bigram model (operator 8).

Every training word that occurs more than once gets one of ``CLASSES`` classes by exchange. Words
start in the class that fits their neighbours best among classes begun by the most frequent words.
In every round words may then move to the class that makes their neighbours most likely. The
likelihood of the class bigrams is summed after a round: a round that raises it is kept, another one
is taken back and tried with a smaller, hash-chosen share of the words, and the exchange ends when
the likelihood no longer grows, or with the given number of rounds.

All pairs of neighbouring words of the training text are counted once, as lists of neighbours per
word. A round is one pass over these lists, which sums the table of classes by classes as it is and
finds the next moves, by the table of the round before. The classes of
the ``HOT_WORDS`` most frequent words are held by each task; those of rarer neighbours, where there
are any, come by a join in every round. A text's probability is the product of class
transitions, smoothed by class frequencies, and of the words' shares in their classes. Words seen
once form a class of their own, which also stands for unseen words; its share for those follows
from how many words occur once and twice.

Words are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm import textbytes
from churnspark.llm.blocks import answered, located, rows_of, to_blocks
from churnspark.llm.textbytes import utf8
from churnspark.runtime import intermediates, materialize, new_path

CLASSES, CONTEXTS, ROUNDS = 64, 128, 10
# The most words that each task knows (a hash, a count and a class each); more than this many do not
# fit an entry of a list. Results do not depend on it.
HOT_WORDS = 1 << 22
# About the most neighbours of a word in one list on each side.
LIST_ENTRIES = 1 << 16
# Tokens whose pairs are counted together, and pairs that are packed together.
MERGE_TOKENS = 3 << 19
PACKED_PAIRS = 1 << 18
ROWS_AT_ONCE = 4096
# The least share of words that a round may move, as a power of two, and the least growth that counts.
LEAST_SHARE, LEAST_GROWTH = 3, 1e-5
# Tokens whose classes are scored together.
SLICE_TOKENS = 1 << 19
_END = np.uint64(0x5851F42D4C957F2D)
# An entry of a list: the neighbour's code above 8 bits of its count.
_COUNT_BITS, _MOST = 8, 255


def _tokens(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): lower-cased words of each text, then one end."""
    parts, sizes = [], []
    for first, last, data, offsets in textbytes.texts(column):
        lowered = textbytes.LOWER[data]
        start, end, rows = textbytes.word_bounds(lowered, offsets)
        counts = np.bincount(rows, minlength=last - first)
        out = np.full(len(rows) + last - first, _END, np.uint64)
        out[np.arange(len(rows)) + rows] = textbytes.span_hashes(lowered, start, end)
        parts.append(out)
        sizes.append(counts + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def _training(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    table = rows_of(payload)
    return _tokens(table.filter(table.column("train")).column("text"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch.column(1).to_pylist():
            words, counts = np.unique(_training(payload)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])


def _pairs(tokens: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(distinct words, place of each token among them, places of the neighbours or -1, side).

    First the word after each (side 0), then the one before (side 1); -1 is the beginning of a text.
    The last token of a text has no word after it and is left out there.
    """
    words, own = np.unique(tokens, return_inverse=True)
    inner = np.ones(len(tokens), bool)
    inner[offsets[:-1]] = False
    yield words, own[:-1][inner[1:]], own[1:][inner[1:]], 0
    yield words, own, np.where(inner, np.concatenate([own[:1], own[:-1]]), -1), 1


# --- lists of neighbours ------------------------------------------------------------------------------


def _pair_keys(tokens: np.ndarray, offsets: np.ndarray, hot: np.ndarray, everything: bool) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words, ascending keys of all pairs): key = place of the word x codes + code of the neighbour.

    A neighbour's code is its place among the sorted ``hot`` words, then one for all others and one
    for the beginning of a text; the preceding word's code follows after those. Without
    ``everything`` only pairs of hot words are there.
    """
    width = len(hot) + 2
    words = np.unique(tokens)
    own = np.searchsorted(words, tokens).astype(np.int32)
    place, there = located(words, hot)
    codes = np.where(there, place, len(hot)).astype(np.int32)[own]
    wanted = np.ones(len(tokens), bool) if everything else there[own]
    # The word after each, if its text goes on, and the word before, or the beginning.
    inner = np.ones(len(tokens), bool)
    inner[offsets[:-1]] = False
    follows = np.append(inner[1:], False) & wanted
    after = own[follows].astype(np.int64) * (2 * width) + codes[1:][follows[:-1]]
    before = np.concatenate([codes[:1], codes[:-1]])
    before[~inner] = len(hot) + 1
    keys = np.concatenate([after, own[wanted].astype(np.int64) * (2 * width) + width + before[wanted]])
    keys.sort()
    return words, keys


def _packed_lists(words: np.ndarray, keys: np.ndarray, hot: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (word, own, part, split, entries): neighbours of each word on both sides, from ``_pair_keys``.

    ``own`` is the place of the word among the hot ones or -1, ``parts`` says into how many lists its
    neighbours go.
    """
    width = len(hot) + 2
    place, there = located(words, hot)
    lists = np.where(there, parts[place], 1) if len(hot) else np.ones(len(words), np.int64)
    place = np.where(there, place, -1).astype(np.int32)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    first = 0
    while first < len(starts):
        # Up to the end of a word.
        last = min(first + PACKED_PAIRS, len(starts))
        if last < len(starts):
            word = keys[starts[last - 1]] // (2 * width)
            last = int(np.searchsorted(keys[starts], (word + 1) * (2 * width), side="left"))
        counts = np.diff(np.append(starts[first:last], starts[last] if last < len(starts) else len(keys)))
        at, codes = np.divmod(keys[starts[first:last]], 2 * width)
        # Larger counts take several entries.
        repeats = -(-counts // _MOST)
        n = np.full(int(repeats.sum()), _MOST)
        n[np.cumsum(repeats) - 1] = counts - (repeats - 1) * _MOST
        at, codes = np.repeat(at, repeats), np.repeat(codes, repeats)
        part = codes % lists[at]
        if part.max(initial=0) > 0:
            order = np.lexsort((part, at))
            at, codes, part, n = at[order], codes[order], part[order], n[order]
        begin = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (part[1:] != part[:-1])]))
        entries = (codes << _COUNT_BITS | n).astype("<u4")
        ends = np.append(begin, len(at)).astype(np.int64) * 4
        owner = at[begin]
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(entries)]
        )
        rows = pa.RecordBatch.from_arrays(
            [
                pa.array(words[owner].view(np.int64)), pa.array(place[owner]), pa.array(part[begin].astype(np.int32)),
                pa.array(lists[owner] > 1), packed.cast(pa.binary()),
            ],
            names=["word", "own", "part", "split", "entries"],
        )
        for i in range(0, rows.num_rows, 1 << 14):
            yield rows.slice(i, 1 << 14)
        first = last


def _neighbours(shared: Broadcast, everything: bool):
    """Lists of the training texts, pairs of several blocks counted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, parts = shared.value
        held, size = [], 0

        def counted() -> Iterator[pa.RecordBatch]:
            tokens = np.concatenate([t for t, _ in held])
            starts = np.cumsum([0, *(len(t) for t, _ in held)])
            offsets = np.concatenate([[0], *(o[1:] + s for (_, o), s in zip(held, starts))])
            held.clear()
            words, keys = _pair_keys(tokens, offsets, hot, everything)
            del tokens
            yield from _packed_lists(words, keys, hot, parts)
            del words, keys
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for payload in batch.column(1).to_pylist():
                tokens, offsets = _training(payload)
                if len(tokens) == 0:
                    continue
                if held and size + len(tokens) > MERGE_TOKENS:
                    yield from counted()
                    size = 0
                held.append((tokens, offsets))
                size += len(tokens)
        if held:
            yield from counted()

    return run


def _other_neighbours(shared: Broadcast):
    """Rows (word, near, side, n) of all neighbours that are not among the hot words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, _ = shared.value
        for batch in batches:
            for payload in batch.column(1).to_pylist():
                tokens, offsets = _training(payload)
                if len(tokens) == 0:
                    continue
                for words, own, near, side in _pairs(tokens, offsets):
                    other = np.append(~located(words, hot)[1], False)[near]
                    keys, counts = np.unique(own[other] * len(words) + near[other], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(words[keys // len(words)].view(np.int64)),
                            pa.array(words[keys % len(words)].view(np.int64)),
                            pa.array(np.full(len(keys), side, np.int32)), pa.array(counts),
                        ],
                        names=["word", "near", "side", "n"],
                    )

    return run


# --- profiles: neighbours by class --------------------------------------------------------------------


def _list_sums(lists: pa.Array, group: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row after the last, sums per row and class on both sides) of a column of lists of packed entries."""
    data, offsets = utf8(lists.flatten())
    entries = np.ascontiguousarray(data).view("<u4")
    ends = offsets[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])] // 4
    both = np.concatenate([group, group.astype(np.int64) + width]).astype(np.uint16)
    for a in range(0, len(lists), ROWS_AT_ONCE):
        b = min(a + ROWS_AT_ONCE, len(lists))
        own = entries[ends[a] : ends[b]]
        rows = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
        keys = rows * (2 * width) + both[own >> _COUNT_BITS]
        sums = np.bincount(keys, weights=own & _MOST, minlength=(b - a) * 2 * width)
        yield a, b, sums.reshape(b - a, 2 * width)


def _profile_sums(lists: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """As ``_list_sums``, of lists of (code, n) whose codes are classes."""
    flat = lists.flatten()
    code = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
    n = flat.field(1).to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    for a in range(0, len(lists), ROWS_AT_ONCE):
        b = min(a + ROWS_AT_ONCE, len(lists))
        rows = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
        keys = rows * (2 * width) + code[ends[a] : ends[b]]
        sums = np.bincount(keys, weights=n[ends[a] : ends[b]], minlength=(b - a) * 2 * width)
        yield a, b, sums.reshape(b - a, 2 * width)


def _profiles(shared: Broadcast, width: int):
    """Rows (word, own, class, neighbours): the entries of each list by the classes that hot words have now.

    The class is that of the word itself, or -1 if it is not hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        for batch in batches:
            own = batch.column(1).to_numpy()
            now = np.where(own >= 0, group[own].astype(np.int32), -1).astype(np.int32)
            for a, b, sums in _list_sums(batch.column(2), group, width):
                row, code = np.nonzero(sums)
                entries = pa.StructArray.from_arrays(
                    [pa.array(code.astype(np.int32)), pa.array(sums[row, code].astype(np.int64))], names=["code", "n"]
                )
                cuts = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(own[a:b]), pa.array(now[a:b]), pa.ListArray.from_arrays(cuts, entries)],
                    names=["word", "own", "class", "neighbours"],
                )

    return run


def _added(total: np.ndarray, own: np.ndarray, sums: np.ndarray) -> None:
    """Add rows of sums to the rows of their classes; words without a class yet are left out."""
    member = own[:, None] == np.arange(len(total))[None, :]
    total += member.T.astype(np.float64) @ sums


def _sum_rows(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at].astype(np.int64))], names=["at", "n"])


def _class_sums_of_profiles(classes: int, width: int):
    """Sums per class of the word and class of the neighbour, over (class, neighbours)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, 2 * width))
        for batch in batches:
            own = batch.column(0).to_numpy()
            for a, b, sums in _profile_sums(batch.column(1), width):
                _added(total, own[a:b], sums)
        yield _sum_rows(total)

    return run


# --- moves --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Round:
    """What decides the moves of a round: logs per code and class, the share of words, what tells rounds apart."""

    logs: np.ndarray
    share: int
    number: int

    def moved(self, words: np.ndarray, now: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which words move, the class that makes the neighbours of each most likely)."""
        # Rounded, so that equal classes are equal whatever rows are computed together.
        scores = np.round(sums @ self.logs, 9)
        best = scores.argmax(axis=1)
        classes = self.logs.shape[1]
        rows = np.arange(len(now))
        before = np.where(now < classes, scores[rows, np.minimum(now, classes - 1)], -np.inf)
        chance = textbytes.mix(words.view(np.uint64) + np.uint64(self.number * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        chosen = (chance >> np.uint64(64 - LEAST_SHARE)) < np.uint64(1 << (LEAST_SHARE - self.share))
        return (now >= classes) | (chosen & (scores[rows, best] > before)), best.astype(np.int32)


def _passed_lists(shared: Broadcast, round_: _Round | None, classes: int, width: int):
    """Rows (at, own, class, n) over (word, own, split, lists): the words that move have own and class, sums at and n.

    Split lists only add to the sums; without a round nothing moves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, total = shared.value, np.zeros((classes, 2 * width))

        def rows(at: np.ndarray, own: np.ndarray, found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(v.astype(np.int32)) for v in (at, own, found)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(n.astype(np.int64))], names=["at", "own", "class", "n"])

        for batch in batches:
            words, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            whole = ~batch.column(2).to_numpy(zero_copy_only=False)
            now = group[own]
            for a, b, sums in _list_sums(batch.column(3), group, width):
                _added(total, now[a:b], sums)
                if round_ is not None:
                    moves, best = round_.moved(words[a:b], now[a:b], sums)
                    moves &= whole[a:b]
                    nothing = np.zeros(int(moves.sum()), np.int64)
                    yield rows(nothing - 1, own[a:b][moves], best[moves], nothing)
        at = np.flatnonzero(total)
        yield rows(at, np.full(len(at), -1), np.full(len(at), -1), total.ravel()[at])

    return run


def _moves_of_profiles(round_: _Round, width: int):
    """Rows (word, own, class), moved or not, over (word, own, class, neighbours)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, now = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for a, b, sums in _profile_sums(batch.column(3), width):
                moves, best = round_.moved(words[a:b], now[a:b], sums)
                found = pa.array(np.where(moves, best, now[a:b]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), found], names=["word", "own", "class"]
                )

    return run


_MOVE = "word bigint, own int, class int"


def _likelihoods(sums: np.ndarray, width: int) -> np.ndarray:
    """Logs per code and class from sums (class x code)."""
    logs = np.zeros((2 * width, len(sums)))
    for side in (0, 1):
        part = sums[:, side * width : (side + 1) * width]
        smooth = (part + 0.1) / (part.sum(axis=1, keepdims=True) + 0.1 * width)
        logs[side * width : (side + 1) * width] = np.log(smooth).T
    return logs


def log_likelihood(sums: np.ndarray, width: int) -> float:
    """Class bigram log-likelihood of the training text, less what no move of a word between classes changes."""
    classes = len(sums)
    right, left = sums[:, :width], sums[:, width:]

    def total(n: np.ndarray) -> float:
        return float((n * np.log(np.maximum(n, 1))).sum())

    # Pairs of two classes, of a class and a word seen once, and of a text's beginning and a class.
    pairs = total(right[:, : classes + 1]) + total(left[:, classes : classes + 2])
    return pairs - total(right.sum(axis=1)) - total(left.sum(axis=1))


# --- the model ----------------------------------------------------------------------------------------


@dataclass
class ClassModel:
    """Numbers of the training text: tokens, distinct words, words seen once and twice, tokens per class.

    ``history`` has the log-likelihood after the start and after every round that was kept.
    """

    classes: int
    tokens: int
    words: int
    once: int
    twice: int
    class_tokens: np.ndarray
    history: list[float] = field(default_factory=list)

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.words + 1)))

    def shares(self) -> tuple[float, float]:
        """(share of the rare class that unseen words have, share of one word seen once)."""
        known = 2 * (self.twice + 0.5) if self.once else 0.0
        unseen = (self.once + 0.5) / (self.once + 0.5 + known)
        return unseen, (1 - unseen) / max(self.once, 1)


@dataclass
class Lexicon:
    """Words with count and class: the hot ones as arrays in order of their hashes, the others as a table.

    ``once_only`` says that all others were seen once.
    """

    hot: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    rest: DataFrame
    once_only: bool

    def table(self) -> DataFrame:
        """One row per word: word, n, class."""
        arrays = [self.hot.view(np.int64), self.counts, self.classes.astype(np.int32)]
        known = pa.table(dict(zip(["word", "n", "class"], arrays, strict=True)))
        return self.rest.sparkSession.createDataFrame(known).unionByName(self.rest)


def _hot(counted: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashes, counts, least count) of the most frequent words, in order of hashes: at most ``limit``,
    words of one count all or none, none seen once."""
    sizes = counted.where("n > 1").groupBy("n").count().toArrow()
    values, many = (sizes.column(i).to_numpy() for i in (0, 1))
    order = np.argsort(-values)
    fitting = order[np.cumsum(many[order]) <= limit]
    least = int(values[fitting].min()) if len(fitting) else np.iinfo(np.int64).max
    found = counted.where(F.col("n") >= least).toArrow()
    words = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], found.column("n").to_numpy()[order], least


class _Exchange:
    """The lists of neighbours, and passes over them; classes of hot words are an array, of others a table."""

    def __init__(self, blocks: DataFrame, counted: DataFrame, classes: int, hot_words: int) -> None:
        self.spark, self.classes = blocks.sparkSession, classes
        # Neighbours by class, words seen once, the beginning, words without a class yet.
        self.once, self.beginning, self.unplaced, self.width = classes, classes + 1, classes + 2, classes + 3
        self.counted = counted
        self.hot, self.counts, self.least = _hot(counted, min(hot_words, HOT_WORDS))
        cool = counted.where((F.col("n") > 1) & (F.col("n") < self.least)).select("word")
        self.all_hot = cool.isEmpty()
        # A word has no more neighbours than occurrences: this bounds a list.
        shared = self.spark.sparkContext.broadcast((self.hot, 1 + self.counts // LIST_ENTRIES))
        kind = "word bigint, own int, part int, split boolean, entries binary"
        lists = blocks.mapInArrow(_neighbours(shared, not self.all_hot), kind)
        lists = lists.groupBy("word", "own", "part", "split").agg(F.collect_list("entries").alias("lists"))
        self.lists = materialize(lists, "neighbours", compression="zstd")
        if not self.all_hot:
            # Neighbours seen more than once that are not hot; the others that are not hot were seen once.
            found = blocks.mapInArrow(_other_neighbours(shared), "word bigint, near bigint, side int, n bigint")
            found = found.join(cool.withColumnRenamed("word", "near"), "near")
            self.tail = materialize(found.groupBy("word", "near", "side").agg(F.sum("n").alias("n")), "tail")
        shared.unpersist()

    def start(self, contexts: int) -> tuple[np.ndarray, DataFrame | None]:
        """The most frequent words start the classes, in turn."""
        frequent = [r["word"] for r in self.counted.orderBy(F.desc("n"), "word").limit(contexts).collect()]
        group = np.full(len(self.hot) + 2, self.unplaced, np.uint8)
        place, there = located(np.array(frequent, np.int64).view(np.uint64), self.hot)
        group[place[there]] = (np.arange(len(frequent)) % self.classes)[there]
        group[-2:] = self.once, self.beginning
        if self.all_hot:
            return group, None
        first = self.spark.createDataFrame([(w, i % self.classes) for i, w in enumerate(frequent)], "word bigint, class int")
        cool = self.counted.where((F.col("n") > 1) & (F.col("n") < self.least)).select("word")
        placed = cool.join(F.broadcast(first), "word", "left")
        return group, placed.select("word", F.coalesce("class", F.lit(self.unplaced)).alias("class"))

    def _profiled(self, shared: Broadcast, rows: DataFrame, cool: DataFrame | None) -> DataFrame:
        """(word, own, class, neighbours) per word of the lists in ``rows``."""
        kind = "word bigint, own int, class int, neighbours array<struct<code: int, n: bigint>>"
        found = rows.select("word", "own", "lists").mapInArrow(_profiles(shared, self.width), kind)
        if cool is not None:
            placed = self.tail.join(cool.withColumnRenamed("word", "near"), "near")
            # A list has these neighbours among those seen once: they leave there and come here.
            moved = [(F.col("class"), F.col("n")), (F.lit(self.once), -F.col("n"))]
            codes = [F.struct((F.col("side") * self.width + c).alias("code"), n.alias("n")) for c, n in moved]
            placed = placed.select("word", F.explode(F.array(*codes)).alias("e")).select("word", "e.*")
            placed = placed.groupBy("word", "code").agg(F.sum("n").alias("n"))
            placed = placed.groupBy("word").agg(F.collect_list(F.struct("code", "n")).alias("neighbours"))
            found = found.unionByName(placed.select("word", F.lit(-1).alias("own"), F.lit(-1).alias("class"), "neighbours"))
        whole = found.groupBy("word").agg(
            F.max("own").alias("own"), F.max("class").alias("class"),
            F.flatten(F.collect_list("neighbours")).alias("neighbours"),
        )
        if cool is None:
            return whole
        joined = whole.join(cool.withColumnRenamed("class", "other"), "word", "left")
        joined = joined.withColumn("class", F.when(F.col("class") >= 0, F.col("class")).otherwise(F.col("other")))
        return joined.where("class is not null").select("word", "own", "class", "neighbours")

    def passed(
        self, group: np.ndarray, cool: DataFrame | None, round_: _Round | None
    ) -> tuple[np.ndarray, tuple[np.ndarray, DataFrame | None]]:
        """(sums of the neighbours' classes on both sides per class, the classes after the round's moves)."""
        shared = self.spark.sparkContext.broadcast(group)
        if cool is None:
            work = _passed_lists(shared, round_, self.classes, self.width)
            source = self.lists.select("word", "own", "split", "lists")
            stored = materialize(source.mapInArrow(work, "at int, own int, class int, n bigint"), "round")
            sums = self._summed(stored.where("own < 0").select("at", "n"))
            moves = [stored.where("own >= 0").select("own", "class")]
            if round_ is not None and self.counts.max(initial=0) >= LIST_ENTRIES:
                split = self._profiled(shared, self.lists.where("split"), None)
                moves.append(split.mapInArrow(_moves_of_profiles(round_, self.width), _MOVE).select("own", "class"))
        else:
            profiles = materialize(self._profiled(shared, self.lists, cool), "profiles")
            sums = profiles.select("class", "neighbours").mapInArrow(
                _class_sums_of_profiles(self.classes, self.width), "at bigint, n bigint"
            )
            sums, moves = self._summed(sums), []
            if round_ is not None:
                found = materialize(profiles.mapInArrow(_moves_of_profiles(round_, self.width), _MOVE), "classes")
                moves = [found.where("own >= 0").select("own", "class")]
                cool = found.where("own < 0").select("word", "class")
        group = group.copy()
        for found in moves:
            # As many rows as there are hot words, at most.
            table = found.toArrow()
            group[table.column("own").to_numpy()] = table.column("class").to_numpy()
        shared.unpersist()
        return sums, (group, cool)

    def _summed(self, found: DataFrame) -> np.ndarray:
        sums = np.zeros(self.classes * 2 * self.width)
        for row in found.groupBy("at").agg(F.sum("n").alias("n")).collect():  # classes x classes
            sums[row["at"]] = row["n"]
        return sums.reshape(self.classes, 2 * self.width)

    def run(self, contexts: int, rounds: int) -> tuple[np.ndarray, DataFrame | None, list[float]]:
        """(classes of hot words, of others, likelihoods of the rounds that were kept)."""
        state = self.start(contexts)
        if self.all_hot and len(self.hot) == 0:
            return *state, []
        sums, _ = self.passed(*state, None)
        _, state = self.passed(*state, _Round(_likelihoods(sums, self.width), 0, 0))
        sums, _ = self.passed(*state, None)
        history, share, known = [log_likelihood(sums, self.width)], 0, True
        best, logs = state, _likelihoods(sums, self.width)
        for number in range(1, rounds + 1):
            sums, following = self.passed(*state, _Round(logs, share, number))
            if not known:
                likelihood = log_likelihood(sums, self.width)
                growth = (likelihood - history[-1]) / max(abs(history[-1]), 1.0)
                if growth <= 0:
                    share += 1
                    if share > LEAST_SHARE:
                        break
                    state, known = best, True
                    continue
                history.append(likelihood)
                best, logs = state, _likelihoods(sums, self.width)
                if growth < LEAST_GROWTH:
                    break
            state, known = following, False
        return *best, history


def learn(
    blocks: DataFrame, classes: int = CLASSES, contexts: int = CONTEXTS, rounds: int = ROUNDS, hot_words: int = HOT_WORDS
) -> tuple[Lexicon, ClassModel]:
    """Count words and neighbours of the training texts in ``blocks`` and exchange words between classes.

    The ``contexts`` most frequent words start the classes. ``hot_words`` decides only where the class
    of a neighbour is looked up, not what is counted. Words seen once have the class after the last.
    """
    spark = blocks.sparkSession
    counted = blocks.mapInArrow(_counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "words")
    total = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("words"),
        F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
    ).first()
    # The class of rare words of earlier rounds is dropped with the block; the last one's is stored outside.
    last = new_path(spark, "lexicon")
    with intermediates(spark):
        exchange = _Exchange(blocks, counted, classes, hot_words)
        group, cool, history = exchange.run(contexts, rounds)
        rest = counted.where("n = 1").select("word", "n", F.lit(classes).alias("class"))
        if cool is not None:
            rest = materialize(rest.unionByName(counted.join(cool, "word").select("word", "n", "class")), "lexicon", last)
    held = np.bincount(group[:-2], exchange.counts, classes + 1)[: classes + 1]
    if cool is None:
        held[classes] = total["once"]
    else:
        for row in rest.groupBy("class").agg(F.sum("n").alias("n")).collect():
            held[row["class"]] += row["n"]
    lexicon = Lexicon(exchange.hot, exchange.counts, group[:-2], rest, cool is None)
    return lexicon, ClassModel(classes, total["tokens"], total["words"], total["once"], total["twice"], held, history)


def cluster(
    blocks: DataFrame, classes: int = CLASSES, contexts: int = CONTEXTS, rounds: int = ROUNDS, hot_words: int = HOT_WORDS
) -> tuple[DataFrame, ClassModel]:
    """``learn`` with the words as a table: word, n, class."""
    lexicon, model = learn(blocks, classes, contexts, rounds, hot_words)
    return lexicon.table(), model


# --- scoring ------------------------------------------------------------------------------------------


def _asked(shared: Broadcast):
    """Rows (block, word): words of a block that are not hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value[0]
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = np.unique(_tokens(rows_of(payload).column("text"))[0])
                words = words[~located(words, hot)[1]].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), block)), pa.array(words)], names=["block", "word"])

    return run


def _emissions(model: ClassModel, shared: Broadcast) -> Callable:
    rare, held = model.classes, np.maximum(model.class_tokens, 1)
    unseen, once = model.shares()

    def work(rows: pa.Table, answers: pa.Table | None) -> pa.Table:
        hot, hot_counts, hot_classes = shared.value
        tokens, offsets = _tokens(rows.column("text"))
        words = np.unique(tokens)
        own = np.searchsorted(words, tokens).astype(np.int32)
        del tokens
        place, there = located(words, hot)
        counts, group = np.zeros(len(words), np.int64), np.full(len(words), rare)
        counts[there], group[there] = hot_counts[place[there]], hot_classes[place[there]]
        if answers is None:
            # Training texts where all words that are not hot were seen once.
            counts[~there] = 1
        else:
            keys = answers.column("word").to_numpy().view(np.uint64)
            order = np.argsort(keys)
            place, told = located(words, keys[order])
            counts[told] = answers.column("n").to_numpy()[order][place[told]]
            group[told] = answers.column("class").to_numpy()[order][place[told]]
        share = np.where(counts == 0, unseen, np.where(group == rare, once, counts / held[group]))
        a, b = offsets[:-1], offsets[1:]

        def summed(values: np.ndarray) -> np.ndarray:
            running = np.concatenate([[0], np.cumsum(values[own])])
            return running[b] - running[a]

        sequence = group.astype(np.uint8)[own]
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(rows), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(sequence)]
        ).cast(pa.binary())
        return pa.table(
            {
                "id": rows.column("id"), "train": rows.column("train"), "n_tokens": b - a, "n_known": summed(counts > 0),
                "base_score": summed(model.base_log(counts)), "emission": summed(np.log10(share)), "classes": packed,
            }
        )

    return work


def _emitted(work: Callable):
    """``work`` on every block, without answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(1).to_pylist():
                yield from work(rows_of(payload), None).to_batches()
                pa.default_memory_pool().release_unused()

    return run


def _previous(column: pa.Array, beginning: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, classes, the class before each, offsets) per slice of a column."""
    data, offsets = textbytes.utf8(column)
    for first, last in textbytes.slices(offsets, SLICE_TOKENS):
        own = data[offsets[first] : offsets[last]]
        places = offsets[first : last + 1] - offsets[first]
        before = np.concatenate([own[:1], own[:-1]])
        before[places[:-1][places[:-1] < places[1:]]] = beginning
        yield first, last, own, before, places


def _transitions(classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = classes + 1
        sums = np.zeros((size + 1) * size, np.int64)
        for batch in batches:
            for _, _, own, before, _ in _previous(batch.column(0), size):
                sums += np.bincount(before.astype(np.int64) * size + own, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    return run


def _scored(logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("classes")
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            for first, last, own, before, places in _previous(batch.column(at), logs.shape[1]):
                sums = np.concatenate([[0.0], np.cumsum(logs[before, own])])
                part = batch.slice(first, last - first)
                columns = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sums[places[1:]] - sums[places[:-1]])], names=[*names, "transition"]
                )

    return run


def score_texts(
    docs: DataFrame,
    train: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: int = CLASSES,
    contexts: int = CONTEXTS,
    rounds: int = ROUNDS,
    smoothing: float = 5.0,
    hot_words: int = HOT_WORDS,
) -> DataFrame:
    """One row per document: id, train, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    ``train`` names a boolean column that marks the rows to learn from (null: no). Tokens are the
    lower-cased (A-Z) words and one end per text. ``base_score`` is the log10 probability under
    word frequencies with half a count added, ``score`` that under the class model. A null or
    empty text has its end only. Repeated rows stay and count as often. With no training rows
    every word is unseen; an empty table gives an empty result. Other columns are not read.
    """
    plain = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(train), F.lit(False)).alias("train")
    )
    seen, unseen = to_blocks(plain.where("train")), to_blocks(plain.where("not train"))
    lexicon, model = learn(seen, classes, contexts, rounds, hot_words)
    shared = plain.sparkSession.sparkContext.broadcast((lexicon.hot, lexicon.counts, lexicon.classes))
    id_type = plain.schema["id"].dataType
    fields = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType())]
    head = [T.StructField("id", id_type), T.StructField("train", T.BooleanType()), *[T.StructField(*f) for f in fields]]
    schema = T.StructType([*head, T.StructField("emission", T.DoubleType()), T.StructField("classes", T.BinaryType())])
    work = _emissions(model, shared)

    def looked_up(blocks: DataFrame) -> DataFrame:
        asked = blocks.mapInArrow(_asked(shared), "block bigint, word bigint")
        return answered(blocks, asked, lexicon.rest, "word", work, schema)

    trained = seen.mapInArrow(_emitted(work), schema) if lexicon.once_only else looked_up(seen)
    found = materialize(trained.unionByName(looked_up(unseen)), "classes", compression="zstd")

    size = classes + 1
    counts = np.zeros((size + 1) * size)
    pairs = found.where("train").select("classes").mapInArrow(_transitions(classes), "at bigint, n bigint")
    for row in pairs.groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[row["at"]] = row["n"]
    counts = counts.reshape(size + 1, size)
    frequency = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * size)
    logs = np.log10((counts + smoothing * frequency) / (counts.sum(axis=1, keepdims=True) + smoothing))
    out = T.StructType([*head, T.StructField("emission", T.DoubleType()), T.StructField("transition", T.DoubleType())])
    score = F.col("emission") + F.col("transition")
    return found.mapInArrow(_scored(logs), out).select(
        F.col("id").alias(id_col), "train", "n_tokens", "n_known", F.lit(int(model.tokens)).alias("train_tokens"),
        "base_score", score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
