"""Best-fit packing of documents into sequences of bounded length (operator 7).

Texts become token ids in one pass; only id, piece and length go on to packing. Pieces are dealt
to packing tasks of about ``TASK_PIECES`` pieces by a hash, each task packs its share online: an
open sequence is kept under its free space, a bitset marks the free spaces that occur, and the
least one that is large enough (the best fit) is found by shifting the bitset. A fixed number of
sequences is open at a time; when another one is needed the fullest is closed. Each task wastes at
most what its last open sequences leave free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm.tokens import token_ids
from churnspark.runtime import materialize

CAPACITY = 1024
OPEN_SEQUENCES = 4096
TASK_PIECES = 200_000
# Pieces of a task arrive in runs of about so many, the longest of a run first: its sequences then
# nearly all fit among the open ones, and the short pieces at its end fill them up.
RUN_PIECES = 4_000


def _cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, piece, start, length) of the pieces of texts with these lengths; the first is the shorter one."""
    counts = np.maximum(-(-lengths // capacity), 1)
    row = np.repeat(np.arange(len(lengths)), counts)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    head = lengths - (counts - 1) * capacity
    start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
    return row, piece, start, np.where(piece == 0, head[row], capacity)


def _tokenize(path: str, end_id: int, capacity: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, ids, offsets in token_ids(batch.column(1), path):
                lengths = np.diff(offsets)
                out = np.full(len(ids) + len(lengths), end_id, "<u4")
                out[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)] = ids
                row, piece, start, length = _cut(lengths + 1, capacity)
                ends = np.concatenate([[0], np.cumsum(length)]) * 4
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(row), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(out)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first).take(pa.array(row)),
                        pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), packed.cast(pa.binary()),
                    ],
                    names=names,
                )

    return run


def token_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids (unsigned 32-bit little-endian, as bytes).

    A document's ids are those of its whole text and ``end_id``. Only a document with more than
    ``capacity`` ids is cut, into pieces of that many; the first takes the rest. A null or empty
    text is one piece with ``end_id``. Rows stay apart even if they repeat an id; a null id stays
    null; an empty table gives an empty result; other columns are not read.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "piece", "start", "length", "ids"]
    types = [plain.schema["id"].dataType, T.IntegerType(), T.LongType(), T.LongType(), T.BinaryType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types, strict=True)])
    return plain.mapInArrow(_tokenize(path, end_id, capacity, names), schema).withColumnRenamed("id", id_col)


class OpenBins:
    """Open sequences by free space; ``place`` returns (sequence, offset) of a piece."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.spaces, self.count, self.opened = 0, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        held = self.by_space[space]
        found = held.pop()
        if not held:
            self.spaces &= ~(1 << space)
        self.count -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(space)
        else:
            space, sequence = self.capacity, self.opened
            self.opened += 1
        left = space - length
        if left:
            if self.count >= self.limit:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # close the fullest
            self.by_space[left].append(sequence)
            self.spaces |= 1 << left
            self.count += 1
        return sequence, self.capacity - space


def _pack(capacity: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, bins = None, None
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            sequences, offsets = [], []
            rows = zip(batch.column(at["__share"]).to_pylist(), batch.column(at["length"]).to_pylist(), strict=True)
            for own, length in rows:
                if own != share:
                    share, bins = own, OpenBins(capacity, limit)
                sequence, offset = bins.place(length)
                sequences.append((own << 32) + sequence)
                offsets.append(offset)
            kept = [i for n, i in at.items() if not n.startswith("__")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*[batch.schema.names[i] for i in kept], "sequence_id", "offset"],
            )

    return run


def pack_pieces(
    pieces: DataFrame,
    keys: tuple[str, ...] = ("doc_id", "piece"),
    capacity: int = CAPACITY,
    open_sequences: int = OPEN_SEQUENCES,
    task_pieces: int = TASK_PIECES,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``length`` from 1 to ``capacity``.

    Sequences are filled without gaps from offset 0. ``keys`` deal and order the pieces, so that
    runs agree; rows that repeat a key are packed apart. All other columns pass, so drop the ids
    first if they are not wanted. An empty table gives an empty result.
    """
    count = pieces.count()
    shares = max(1, -(-count // task_pieces))
    # Null keys are spread over the shares by the other columns.
    others = [c for c in pieces.columns if c not in keys]
    dealt = pieces.withColumn("__order", F.xxhash64(*keys, *others))
    dealt = dealt.withColumn("__share", F.pmod("__order", F.lit(shares)))
    runs = max(1, task_pieces // RUN_PIECES) if shares > 1 else max(1, -(-count // RUN_PIECES))
    dealt = dealt.withColumn("__run", F.pmod(F.shiftright("__order", 24), F.lit(runs)))
    sorted_rows = dealt.repartition(shares, "__share").sortWithinPartitions(
        "__share", "__run", F.desc("length"), "__order", *keys
    )
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return sorted_rows.mapInArrow(_pack(capacity, open_sequences), schema)


def pack_documents(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(stored pieces with ids, their places: id, piece, start, length, ids_crc32, sequence_id, offset)."""
    pieces = materialize(token_pieces(docs, path, end_id, capacity, id_col, text_col), "pieces")
    slim = pieces.select(id_col, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pieces, pack_pieces(materialize(slim, "slim-pieces"), (id_col, "piece"), capacity)
