"""Near-duplicate groups: SuperMinHash, banding, exact verification, components (operator 6).

1. One pass over the texts gives each document the size and a 128-bit digest of its set of
   word shingles and the band keys of its SuperMinHash signature.
2. Documents with equal sets share the least id; only that document goes on.
3. Documents that share a band key are candidates. The components of "shares a band key" are
   found by stars around the least document of each bucket, without listing pairs.
4. Each such group is compared in blocks of bounded size. Pairs whose signatures differ too much
   are skipped, the rest are decided on the full sets; a union-find per block returns only links
   that connect something new. A group of any size is covered by all pairs of its blocks.
5. Components of the verified links give the result.

A pair with similarity 0.8 shares none of 40 bands of 5 slots with a chance of 1e-7, and the
signature test drops it with a chance below 1e-7 (more than five standard deviations).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm import textbytes
from churnspark.llm.components import connected_components
from churnspark.llm.superminhash import band_keys, signatures
from churnspark.runtime import materialize

SLOTS, BANDS = 200, 40
# A block of a candidate group: so many documents and shingles at most, as far as one text allows.
BLOCK_DOCUMENTS, BLOCK_SHINGLES = 1024, 2_000_000
# Rows of (id, group, block count) that may be broadcast; beyond, the texts are shuffled by id.
BROADCAST_ROWS = 1_000_000
# How far a signature may fall below the wanted similarity before a pair is skipped.
MARGIN = 0.16


def _shingles(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, distinct shingle hashes, their rows) per slice of a text column."""
    for first, last, data, offsets in textbytes.texts(column):
        lowered = textbytes.LOWER[data]
        start, end, rows = textbytes.word_bounds(lowered, offsets)
        hashes = textbytes.span_hashes(lowered, start, end)
        yield first, last, *textbytes.distinct_per_row(*textbytes.window_hashes(hashes, rows, width))


def _sums(values: np.ndarray, rows: np.ndarray, count: int, salt: int) -> np.ndarray:
    """Per row a 64-bit sum over its hashed values: a digest of the set."""
    totals = np.zeros(count, np.uint64)
    np.add.at(totals, rows, textbytes.mix(values ^ np.uint64(salt)))
    return totals.view(np.int64)


def _marks(width: int, slots: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, values, rows in _shingles(batch.column(1), width):
                count = last - first
                keys = band_keys(signatures(values, rows, count, slots), bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, count),
                        pa.array(np.bincount(rows, minlength=count).astype(np.int64)),
                        pa.array(_sums(values, rows, count, 0x1B873593CC9E2D51)),
                        pa.array(_sums(values, rows, count, 0x38B34AE5A1E38B93)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, (count + 1) * bands, bands, dtype=np.int32)),
                            pa.array(keys.reshape(-1).view(np.int64)),
                        ),
                    ],
                    names=["id", "n_shingles", "set_a", "set_b", "bands"],
                )

    return run


def _full_sets(width: int):
    """Replace the text by the sorted shingle hashes, as bytes; other columns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for first, last, values, rows in _shingles(batch.column(at), width):
                cuts = np.searchsorted(rows, np.arange(last - first + 1)) * 8
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(),
                    last - first,
                    [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())],
                ).cast(pa.binary())
                columns = [c.slice(first, last - first) for c in batch.columns]
                columns[at] = packed
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:at], "shingles"])

    return run


class _Forest:
    def __init__(self, size: int) -> None:
        self.parent = list(range(size))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.parent[self.root(y)] = self.root(x)


def linked_pairs(sets: list[np.ndarray], part: np.ndarray, percent: int, slots: int = SLOTS) -> list[tuple[int, int]]:
    """Places of verified pairs that span the links among ``sets`` (sorted, distinct hashes).

    If ``part`` has two values, only pairs across are compared, else all.
    """
    sizes = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(len(sets)), sizes)
    found = signatures(np.concatenate(sets), rows, len(sets), slots)
    short = (textbytes.mix(found) & np.uint64(0xFFFF)).astype(np.uint16)
    across = len(np.unique(part)) > 1
    forest, links = _Forest(len(sets)), []
    for i in range(len(sets) - 1):
        likeness = (short[i + 1 :] == short[i]).sum(axis=1)
        wanted = likeness >= (percent / 100 - MARGIN) * slots
        wanted &= 100 * np.minimum(sizes[i + 1 :], sizes[i]) >= percent * np.maximum(sizes[i + 1 :], sizes[i])
        if across:
            wanted &= part[i + 1 :] != part[i]
        near = np.flatnonzero(wanted)
        for j in near[np.argsort(-likeness[near], kind="stable")] + i + 1:
            if forest.root(i) == forest.root(int(j)):
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                forest.join(i, int(j))
                links.append((i, int(j)))
    return links


def _compare(percent: int, slots: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").combine_chunks()
        data = table.column("shingles").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in data]
        links = linked_pairs(sets, table.column("block").to_numpy(), percent, slots)
        left, right = ([x[k] for x in links] for k in (0, 1))
        return pa.table({"left": ids.take(pa.array(left, pa.int64())), "right": ids.take(pa.array(right, pa.int64()))})

    return run


def _grouped_rows(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Texts of the grouped documents, with group and number of blocks."""
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    return docs.join(groups, "id")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    slots: int = SLOTS,
    bands: int = BANDS,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Words are runs of characters other than space and 0x09-0x0D, with A-Z lower-cased. Two
    documents are linked if ``100 * intersection >= percent * union`` of their sets of ``width``
    words; a text with fewer words is one shingle. ``component_id`` is the least id reachable and
    ``kept`` marks that document.

    A null or empty text, or one without words, has an empty set and links with nothing. Copies
    and repeated rows share a component; rows that repeat an id are one document. A row without id
    is kept unless its text equals that of a row with one (component_id is then that row's). An
    empty table gives an empty result; other columns of ``docs``, whatever their names, are not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema["id"].dataType
    mark_type = T.StructType(
        [
            T.StructField("id", id_type), T.StructField("n_shingles", T.LongType()),
            T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    marks = materialize(docs.mapInArrow(_marks(width, slots, bands), mark_type), "marks")
    set_key = ["n_shingles", "set_a", "set_b"]
    least = marks.where("n_shingles > 0").groupBy(*set_key).agg(F.min("id").alias("first_id"))
    members = marks.join(materialize(least, "sets"), set_key, "left").select(
        "id", "n_shingles", "first_id", F.when(F.col("id") == F.col("first_id"), F.col("bands")).alias("bands")
    )
    members = materialize(members, "members")

    banded = members.where("bands is not null").select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    buckets = materialize(buckets.where("least < most").select("key", "least"), "buckets")
    groups = materialize(connected_components(banded.join(buckets, "key"), "id", "least"), "groups")

    sized = members.where("bands is not null").select("id", "n_shingles").distinct()
    sized = sized.join(groups.withColumnRenamed("node", "id"), "id")
    weights = sized.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCUMENTS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    weights = materialize(weights.select("component", blocks.alias("blocks")), "weights")
    grouped = materialize(sized.select("id", "component").join(weights, "component"), "grouped")

    picked = _grouped_rows(docs, grouped)
    picked = picked.select("id", "component", "blocks", "text")
    full_type = T.StructType([*picked.schema.fields[:-1], T.StructField("shingles", T.BinaryType())])
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    tiles = picked.mapInArrow(_full_sets(width), full_type).withColumn("block", own)
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select(
        "id", "component", "block", "shingles",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    link_type = T.StructType([T.StructField("left", id_type), T.StructField("right", id_type)])
    links = tiles.groupBy("component", "low", "high").applyInArrow(_compare(percent, slots), link_type)
    final = materialize(connected_components(links, "left", "right"), "components")

    joined = members.select("id", "n_shingles", "first_id").join(
        final.select(F.col("node").alias("first_id"), "component"), "first_id", "left"
    )
    component = F.coalesce("component", "first_id", "id")
    return joined.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )
