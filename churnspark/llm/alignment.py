"""Alignment of two tokenizers over the same text (operator 12).

Both tokenizers cut the bytes of a text; where tokens of both end at one byte, a group ends, and
every stretch between two neighbouring ends is a link: one occurrence of a token pair. Pairs are
kept in inverted form. A block of documents has, for every pair, a compressed bitmap of the
documents that hold it, and one bitmap per binary digit of how often it occurs there beyond once.
Bitmaps of one pair from different blocks never share a document, so their union is their list by
block: document counts are sums of population counts, link counts add the digits' planes. Every
block then asks for the counts of its own pairs, and its bitmaps hand them to its documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm.blocks import located, rows_of
from churnspark.llm.textbytes import slices, utf8
from churnspark.llm.tokens import Encoder, SentenceEncoder, encoder
from churnspark.runtime import materialize

# A block of documents holds about so many bytes of text (at least one whole text) ...
BLOCK_BYTES = 8 << 20
# ... and at most so many documents: a place inside a block fits 16 bits.
BLOCK_DOCS = 1 << 16
SLICE_BYTES = 1 << 20

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# --- vocabularies -------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _byte_level_entries(path: str) -> list[bytes]:
    from tokenizers import Tokenizer

    letters = _byte_letters()
    vocabulary = Tokenizer.from_file(path).get_vocab()
    entries = [b""] * (max(vocabulary.values()) + 1)
    for entry, number in vocabulary.items():
        entries[number] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
    return entries


def _piece_entries(path: str) -> list[bytes]:
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        found.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(number) else piece.replace("▁", " ").encode())
    return found


@lru_cache(maxsize=4)
def _entries(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all tokens in a row, start, length) of a vocabulary file."""
    entries = _piece_entries(path) if path.endswith(".model") else _byte_level_entries(path)
    length = np.array([len(e) for e in entries], np.int64)
    return np.frombuffer(b"".join(entries), np.uint8), np.cumsum(length) - length, length


def _tokenizer(path: str):
    return encoder(path, SentenceEncoder) if path.endswith(".model") else encoder(path, Encoder, special=False)


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The spans (start, length) of ``flat``, one after the other."""
    ends = np.cumsum(length)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)]


# --- one slice of texts -------------------------------------------------------------------------------


@dataclass
class Tokens:
    """Ids of texts, and the bytes each id stands for."""

    ids: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray

    def only(self, good: np.ndarray) -> Tokens:
        """Texts that are not good have no tokens."""
        counts = np.where(good, np.diff(self.offsets), 0)
        kept = np.repeat(good, np.diff(self.offsets))
        return Tokens(self.ids[kept], np.concatenate([[0], np.cumsum(counts)]), self.lengths[kept])


def _tokens(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[Tokens, np.ndarray]:
    """Tokens of the texts, and whether the bytes of a text's tokens are the text."""
    ids, token_offsets = _tokenizer(path).encode(data, offsets)
    ids = ids.astype(np.int64)
    flat, start, length = _entries(path)
    lengths = length[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])[token_offsets]
    same = np.diff(ends) == np.diff(offsets)
    if same.all() and np.array_equal(_gathered(flat, start[ids], lengths), data):
        return Tokens(ids, token_offsets, lengths), same
    for i in np.flatnonzero(same):
        own = ids[token_offsets[i] : token_offsets[i + 1]]
        same[i] = np.array_equal(_gathered(flat, start[own], length[own]), data[offsets[i] : offsets[i + 1]])
    return Tokens(ids, token_offsets, lengths), same


def _decimals(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digits at the left of rows of equal width with room for one more, number of digits)."""
    width = len(str(int(ids.max(initial=0))))
    size = np.ones(len(ids), np.int64)
    for i in range(1, width):
        size += ids >= 10**i
    digits = np.zeros((len(ids), width + 1), np.uint8)
    for i in range(width):
        power = 10 ** np.maximum(size - 1 - i, 0)
        digits[:, i] = 48 + ids // power % 10
    return digits, size


@lru_cache(maxsize=2)
def _decimal_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _decimals(np.arange(size))


@dataclass
class Slice:
    """What the texts of a slice hold: counts per text, (pair, text) per link, group strings per text."""

    counts: dict[str, np.ndarray]
    a: np.ndarray
    b: np.ndarray
    row: np.ndarray
    groups: list[bytes]


def align_slice(data: np.ndarray, offsets: np.ndarray, a_path: str, b_path: str) -> Slice:
    """Groups and links of texts given as UTF-8 bytes; an empty text has none."""
    (a, good_a), (b, good_b) = _tokens(a_path, data, offsets), _tokens(b_path, data, offsets)
    good = good_a & good_b & (np.diff(offsets) > 0)
    if not good.all():
        a, b = a.only(good), b.only(good)
    # All good texts in a row: the tokens of both end at the end of every text.
    end_a, end_b = np.cumsum(a.lengths), np.cumsum(b.lengths)
    at_b = np.minimum(np.searchsorted(end_b, end_a), max(len(end_b) - 1, 0))
    both_a = end_b[at_b] == end_a if len(end_b) else np.zeros(0, bool)
    both_b = np.zeros(len(end_b), bool)
    both_b[at_b[both_a]] = True
    last_a, last_b = np.flatnonzero(both_a), np.flatnonzero(both_b)
    before = np.concatenate([[0], np.cumsum(both_a)])[a.offsets]
    n_a, n_b, n_groups = np.diff(a.offsets), np.diff(b.offsets), np.diff(before)
    n_links = n_a + n_b - n_groups

    ends = np.sort(np.concatenate([end_a, end_b[~both_b]]), kind="stable")
    # Kept until the block is full, so in small numbers.
    pair_a = a.ids[np.searchsorted(end_a, ends)].astype(np.int32)
    pair_b = b.ids[np.searchsorted(end_b, ends)].astype(np.int32)
    row = np.repeat(np.arange(len(n_links), dtype=np.int32), n_links)

    # Tokens in the order of their groups, those of A first.
    group_a = np.cumsum(both_a) - both_a
    group_b = np.cumsum(both_b) - both_b
    first_b = np.concatenate([[0], last_b[:-1] + 1]) if len(last_b) else last_b
    place_a = np.arange(len(end_a)) + first_b[group_a]
    place_b = np.arange(len(end_b)) + last_a[group_b] + 1
    ids = np.empty(len(end_a) + len(end_b), np.int64)
    ids[place_a], ids[place_b] = a.ids, b.ids
    table, sizes = _decimal_table(max(len(_entries(a_path)[2]), len(_entries(b_path)[2])))
    letters, size = table[ids], sizes[ids]
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[place_a[last_a]] = ord("|")
    mark[place_b[last_b]] = ord(";")
    letters[np.arange(len(ids)), size] = mark
    text = letters[np.arange(letters.shape[1])[None, :] <= size[:, None]].tobytes()
    cuts = np.concatenate([[0], np.cumsum(size + 1)])[a.offsets + b.offsets].tolist()
    groups = [text[x : y - 1] if y > x else b"" for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    counts = dict(zip(_COUNTS, (n_a, n_b, n_groups, n_links), strict=True))
    return Slice(counts, pair_a, pair_b, row, groups)


# --- bitmaps ------------------------------------------------------------------------------------------


def _lists(values: np.ndarray, sizes: np.ndarray, documents: int) -> pa.Array:
    """A bitmap per run of ``sizes`` ascending places: places of 16 bits, or bits where that is no longer."""
    width = -(-documents // 8)
    dense = sizes * 2 >= width
    owner = np.repeat(np.arange(len(sizes)), sizes)
    lengths = np.where(dense, width, sizes * 2)
    ends = np.cumsum(lengths)
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    start = ends - lengths
    sparse = ~dense[owner]
    first = np.cumsum(sizes) - sizes
    at = start[owner[sparse]] + 2 * (np.flatnonzero(sparse) - first[owner[sparse]])
    flat[at], flat[at + 1] = values[sparse] & 255, values[sparse] >> 8
    at = start[owner[~sparse]] + (values[~sparse] >> 3)
    np.bitwise_or.at(flat, at, (1 << (values[~sparse] & 7)).astype(np.uint8))
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat)]
    )


def _places(bitmaps: pa.Array, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the bitmap, place) of every document in the bitmaps."""
    data, offsets = utf8(bitmaps)
    lengths = np.diff(offsets)
    width = -(-documents // 8)
    dense = lengths == width
    sparse = np.flatnonzero(~dense)
    pairs = _gathered(data, offsets[sparse], lengths[sparse]).astype(np.int64)
    own, place = [np.repeat(sparse, lengths[sparse] // 2)], [pairs[0::2] | pairs[1::2] << 8]
    which = np.flatnonzero(dense)
    # Some bitmaps at a time: their bits take eight times their bytes.
    step = max(1, (1 << 25) // max(documents, 1))
    for i in range(0, len(which), step):
        now = which[i : i + step]
        bits = np.unpackbits(_gathered(data, offsets[now], lengths[now]).reshape(len(now), width), axis=1, bitorder="little")
        at, found = np.nonzero(bits)
        own.append(now[at])
        place.append(found)
    return np.concatenate(own), np.concatenate(place)


def _cardinalities(bitmaps: pa.Array, documents: int) -> np.ndarray:
    """The population count of every bitmap."""
    data, offsets = utf8(bitmaps)
    lengths = np.diff(offsets)
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(data), dtype=np.int64)])
    return np.where(lengths == -(-documents // 8), ones[offsets[1:]] - ones[offsets[:-1]], lengths // 2)


def postings(a: np.ndarray, b: np.ndarray, row: np.ndarray, documents: int) -> pa.Table:
    """(a, b, plane, bitmap) of links (a, b, row): plane 0 has the documents that hold the pair, plane k + 1
    those where binary digit k of the further occurrences is set. Rows ascend by plane, a, b."""
    span = int(b.max(initial=0)) + 1
    links = (a.astype(np.int64) * span + b) << 16 | row
    links.sort()
    first = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]])) if len(links) else np.zeros(0, np.int64)
    further = np.diff(np.append(first, len(links))) - 1
    keys = links[first]
    del links
    pair, place = keys >> 16, keys & 0xFFFF
    parts = []
    for plane in range(int(further.max(initial=0)).bit_length() + 1):
        chosen = slice(None) if plane == 0 else (further >> (plane - 1) & 1).astype(bool)
        own, held = pair[chosen], place[chosen]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(own)))
        parts.append(
            pa.table(
                {
                    "a": (own[first] // span).astype(np.int32), "b": (own[first] % span).astype(np.int32),
                    "plane": np.full(len(first), plane, np.int8), "bitmap": _lists(held, sizes, documents),
                }
            )
        )
    return pa.concat_tables(parts)


def _pair_keys(table: pa.Table) -> np.ndarray:
    return table.column("a").to_numpy().astype(np.int64) << 32 | table.column("b").to_numpy()


def pair_sums(table: pa.Table, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair keys, documents, links) of the postings of one block."""
    keys, plane = _pair_keys(table), table.column("plane").to_numpy()
    ones = _cardinalities(table.column("bitmap").combine_chunks(), documents)
    pairs = keys[plane == 0]
    links = np.zeros(len(pairs), np.int64)
    np.add.at(links, np.searchsorted(pairs, keys), ones << np.maximum(plane.astype(np.int64) - 1, 0))
    return pairs, ones[plane == 0], links


# --- blocks of documents ------------------------------------------------------------------------------


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class _Block:
    """Documents and links gathered for one block."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.slices: list[Slice] = []
        self.documents, self.bytes = 0, 0

    def add(self, ids: pa.Array, found: Slice, size: int) -> None:
        found.row += self.documents
        self.ids.append(ids)
        self.slices.append(found)
        self.documents += len(ids)
        self.bytes += size

    def payload(self, texts: bool) -> tuple[bytes, bytes]:
        groups = [g for s in self.slices for g in s.groups]
        columns = {"id": pa.chunked_array(self.ids)}
        columns |= {n: np.concatenate([s.counts[n] for s in self.slices]) for n in _COUNTS}
        columns["groups_sha256"] = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
        columns["groups"] = pa.array([g.decode() if texts else None for g in groups], pa.string())
        a, b, row = (np.concatenate([getattr(s, n) for s in self.slices]) for n in ("a", "b", "row"))
        return _stream(pa.table(columns)), _stream(postings(a, b, row, self.documents))


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a blank before each that is not empty."""
    lengths = np.diff(offsets)
    wide = np.where(lengths > 0, lengths + 1, 0)
    ends = np.concatenate([[0], np.cumsum(wide)])
    out = np.full(ends[-1], 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(ends[:-1] + 1 - offsets[:-1], lengths)] = data
    return out, ends


def _aligned(a_path: str, b_path: str, texts: bool, block_bytes: int, block_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, _Block()

        def done() -> pa.RecordBatch:
            docs, bitmaps = held.payload(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([docs], pa.binary()), pa.array([bitmaps], pa.binary())],
                names=["block", "docs", "postings"],
            )

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in slices(offsets, min(SLICE_BYTES, block_bytes)):
                for begin in range(first, last, block_docs):
                    end = min(begin + block_docs, last)
                    size = int(offsets[end] - offsets[begin])
                    if held.documents and (held.bytes + size > block_bytes or held.documents + end - begin > block_docs):
                        yield done()
                        number, held = number + 1, _Block()
                    spaced = _spaced(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin])
                    held.add(batch.column(0).slice(begin, end - begin), align_slice(*spaced, a_path, b_path), size)
        if held.documents:
            yield done()

    return run


def aligned_blocks(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: bool = False,
    block_bytes: int = BLOCK_BYTES,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """Stored rows (block, docs, postings): rows and counts of a block's documents, and its bitmaps by pair.

    ``a_path`` and ``b_path`` are vocabulary files of the ``tokenizers`` (byte-level BPE) or, if
    their names end in ``.model``, of the ``sentencepiece`` library. Texts are read with a blank
    before them. With ``texts`` the group strings are kept, not only their digests.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    work = _aligned(a_path, b_path, texts, block_bytes, min(block_docs, BLOCK_DOCS))
    return materialize(plain.mapInArrow(work, "block bigint, docs binary, postings binary"), "aligned")


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, docs, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            keys, documents, links = pair_sums(rows_of(held), rows_of(docs).num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), block)), pa.array((keys >> 32).astype(np.int32)),
                    pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(documents), pa.array(links),
                ],
                names=["block", "a", "b", "n_docs", "n_links"],
            )


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, a, b, n_docs, n_links) by population counts of the stored bitmaps."""
    return blocks.mapInArrow(_block_pairs, "block bigint, a int, b int, n_docs bigint, n_links bigint")


def pair_table(blocks: DataFrame) -> DataFrame:
    """Corpus-wide pairs, stored: a, b, n_docs, n_links, and whether no other A token has more links with b.

    The best counts have one row per B token, so the vocabulary bounds what is broadcast.
    """
    summed = block_pairs(blocks).groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    summed = materialize(summed, "pairs")
    best = summed.groupBy("b").agg(F.max("n_links").alias("most"))
    return summed.join(F.broadcast(best), "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def _scored(names: list[str]) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        keys = right.column("a").to_numpy().astype(np.int64) << 32 | right.column("b").to_numpy()
        order = np.argsort(keys)
        keys, links = keys[order], right.column("n_links").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order]
        for docs, held in zip(left.column("docs").to_pylist(), left.column("postings").to_pylist(), strict=True):
            rows, table = rows_of(docs), rows_of(held)
            place, _ = located(_pair_keys(table), keys)
            times = np.int64(1) << np.maximum(table.column("plane").to_numpy().astype(np.int64) - 1, 0)
            total, hits = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
            if len(keys):
                own, at = _places(table.column("bitmap").combine_chunks(), rows.num_rows)
                np.add.at(total, at, (links[place] * times)[own])
                np.add.at(hits, at, (best[place] * times)[own])
            rows = rows.append_column("n_best", pa.array(hits)).append_column("count_sum", pa.array(total))
            parts.append(rows.select(names))
        return pa.concat_tables(parts)

    return run


def scored_documents(
    blocks: DataFrame, pairs: DataFrame, id_type: T.DataType, id_col: str = "doc_id", texts: bool = False
) -> DataFrame:
    """One row per document: id, counts, n_best, count_sum, groups_sha256 (and groups)."""
    fields = [("id", id_type), *[(n, T.LongType()) for n in (*_COUNTS, "n_best", "count_sum")], ("groups_sha256", T.StringType())]
    fields += [("groups", T.StringType())] if texts else []
    answers = block_pairs(blocks).select("block", "a", "b").join(pairs.select("a", "b", "n_links", "best"), ["a", "b"])
    grouped = blocks.groupBy("block").cogroup(answers.groupBy("block"))
    schema = T.StructType([T.StructField(*f) for f in fields])
    return grouped.applyInArrow(_scored([n for n, _ in fields]), schema).withColumnRenamed("id", id_col)


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: bool = False,
    block_bytes: int = BLOCK_BYTES,
    block_docs: int = BLOCK_DOCS,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of two tokenizers over all texts.

    Documents: id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the most links of its
    B token, ties included), count_sum (links of the pairs, summed over the links), groups_sha256.
    A null or empty text, and one that the tokens of either tokenizer do not spell byte by byte,
    has no tokens: zeros and an empty digest. Strings of special tokens are ordinary text. Repeated
    rows stay and count as often; null ids stay; an empty table gives empty results; other
    columns are not read. Pairs: see ``pair_table``.
    """
    blocks = aligned_blocks(docs, a_path, b_path, id_col, text_col, texts, block_bytes, block_docs)
    pairs = pair_table(blocks)
    return scored_documents(blocks, pairs, docs.schema[id_col].dataType, id_col, texts), pairs
