"""Blocks of documents, for looking up in a large table whatever their texts contain.

Looking up every word of every document by a join moves each word once per document. Here texts
are first gathered into blocks of bounded size, as they are read. A block asks for each of its
distinct keys once, the keys meet the table in an ordinary join, and the answers of a block are
brought together with its texts. The table may have any size and is never broadcast; a key that
all documents contain is asked for once per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnspark.llm.textbytes import slices, utf8
from churnspark.runtime import materialize

BLOCK_BYTES = 8 << 20

SCHEMA = T.StructType([T.StructField("block", T.LongType()), T.StructField("payload", T.BinaryType())])


def _packed(rows: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, rows[0].schema, options=options) as writer:
        for row in rows:
            writer.write_batch(row)
    return sink.getvalue().to_pybytes()


def rows_of(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _gather(at: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([_packed(held)], pa.binary())], names=["block", "payload"]
            )

        for batch in batches:
            _, offsets = utf8(batch.column(at))
            for first, last in slices(offsets, limit):
                bytes_now = int(offsets[last] - offsets[first])
                if held and size + bytes_now > limit:
                    yield done()
                    block, held, size = block + 1, [], 0
                held.append(batch.slice(first, last - first))
                size += bytes_now
        if held:
            yield done()

    return run


def to_blocks(docs: DataFrame, text_col: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """Stored rows (block, payload): all rows and columns of ``docs``, about ``limit`` text bytes a block.

    A longer text is a block of its own. The table is written, so numbers and contents of blocks
    stay what they are when a task runs again.
    """
    return materialize(docs.mapInArrow(_gather(docs.columns.index(text_col), limit), SCHEMA), "blocks")


def answered(
    blocks: DataFrame, asked: DataFrame, table: DataFrame, key: str, work: Callable, schema: T.StructType | str
) -> DataFrame:
    """``work(payload rows, answers)`` per block: ``asked`` has block and key, ``table`` a row per key."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [work(rows_of(p), right) for p in left.column("payload").to_pylist()]
        return pa.concat_tables(parts)

    answers = asked.join(table, key)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def located(wanted: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the ascending ``keys``, whether it is there) of every wanted key."""
    if len(keys) == 0:
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted
