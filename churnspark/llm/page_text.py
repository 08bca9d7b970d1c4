"""Main text of web pages by differencing pages with near addresses (operator 11).

Pages of one host are put in the order of their paths. Every page is aligned with the one before and
the one after it by a longest common subsequence of their lines, and lines that it shares with
either go: they belong to the host's frame. Two things keep this from losing or leaving text. A pair
that also shares the longest line of either page are copies of one article, and says nothing. And
the markup corrects the alignment where it can: what stands in navigation, footers, notices and so on
goes although no neighbour has it, and what stands in an article (or, without one, in the main
element) stays although a neighbour has it too.

Only line hashes take part in ordering and alignment; a page is known by a digest of its address and
content, so rows that repeat both are one page. The order of all pages is a range sort, and groups
of consecutive pages are aligned together, so a host may hold any share of all pages. Pages
travel once, compressed, to meet what was found about them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm.markup import FRAME, OUTSIDE, page_lines
from churnspark.runtime import materialize

# Pages that are aligned in one group; each group also gets the page after its last.
GROUP_PAGES = 64
# Cells of an alignment that are kept as bits at once; beyond, it is halved first.
_MOST_BITS = 1 << 28
_BATCH_ROWS = 256
# What the markup says of a line: it goes, the alignment decides, it stays.
GOES, OPEN, STAYS = -1, 0, 1


def place_of(url: str | None) -> tuple[str | None, str]:
    """(host, path and query) of an address; a host that cannot be read is null."""
    try:
        parts = urlsplit(url or "")
        host = parts.netloc.rsplit("@", 1)[-1].lower()
    except ValueError:
        return None, url or ""
    return host or None, parts.path + ("?" + parts.query if parts.query else "")


def _line_hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def verdicts(regions: list[int]) -> list[int]:
    """What the markup says of each line of a page, from the regions of its lines."""
    best = max(regions, default=OUTSIDE)
    if best <= OUTSIDE:
        return [GOES if region == FRAME else OPEN for region in regions]
    return [STAYS if region == best else GOES for region in regions]


def _key(url: str | None, page: str | None) -> bytes:
    digest = hashlib.blake2b(digest_size=16)
    for part in (url, page):
        digest.update(b"\0" if part is None else b"\1" + part.encode("utf-8", "replace") + b"\0")
    return digest.digest()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, url, host, path, hashes, longest) of (url, html)."""
    for batch in batches:
        for first in range(0, batch.num_rows, _BATCH_ROWS):
            part = batch.slice(first, _BATCH_ROWS)
            keys, hosts, paths, hashes, longest = [], [], [], [], []
            for url, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                host, path = place_of(url)
                found = page_lines(page or "")
                sizes = [len(line) for line, _ in found]
                keys.append(_key(url, page))
                hosts.append(host)
                paths.append(path)
                hashes.append([_line_hash(line) for line, _ in found])
                longest.append(sizes.index(max(sizes)) if sizes else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()), part.column(0), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                    pa.array(hashes, pa.list_(pa.int64())), pa.array(longest, pa.int32()),
                ],
                names=["key", "url", "host", "path", "hashes", "longest"],
            )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, url, key, page) of (id, url, html): the page compressed."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for first in range(0, batch.num_rows, _BATCH_ROWS):
            part = batch.slice(first, _BATCH_ROWS)
            rows = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True))
            keys = [_key(url, page) for url, page in rows]
            pages = [pack.compress((page or "").encode("utf-8", "replace")) for _, page in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(keys, pa.binary()), pa.array(pages, pa.binary())],
                names=["id", "url", "key", "page"],
            )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, url, text, n_lines, n_shared, n_deleted) of (id, url, page, shared)."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for first in range(0, batch.num_rows, _BATCH_ROWS):
            part = batch.slice(first, _BATCH_ROWS)
            texts, counts = [], []
            for page, shared in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                lines = page_lines(unpack.decompress(page).decode())
                shared = shared or [False] * len(lines)
                said = verdicts([region for _, region in lines])
                stays = [v == STAYS or (v == OPEN and not s) for v, s in zip(said, shared, strict=True)]
                texts.append("\n".join(line for (line, _), keep in zip(lines, stays, strict=True) if keep))
                counts.append((len(lines), sum(shared), len(lines) - sum(stays)))
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), *numbers],
                names=["id", "url", "text", "n_lines", "n_shared", "n_deleted"],
            )


# --- alignment ----------------------------------------------------------------------------------------


def _rows_of_lengths(left: list[int], right: list[int]) -> list[int]:
    """A bit row per prefix of ``left``: bit j is 0 where the common length with right[: j + 1] grows."""
    places: dict[int, int] = {}
    for j, value in enumerate(right):
        places[value] = places.get(value, 0) | 1 << j
    full = (1 << len(right)) - 1
    row, rows = full, []
    for value in left:
        match = row & places.get(value, 0)
        row = ((row + match) | (row - match)) & full
        rows.append(row)
    return rows


def _prefix_lengths(left: list[int], right: list[int]) -> np.ndarray:
    """Common lengths of ``left`` with every prefix of ``right``, the empty one included."""
    if not left or not right:
        return np.zeros(len(right) + 1, np.int64)
    last = _rows_of_lengths(left, right)[-1] if len(left) * len(right) <= _MOST_BITS else _last_row(left, right)
    packed = np.frombuffer(last.to_bytes(-(-len(right) // 8), "little"), np.uint8)
    bits = np.unpackbits(packed, bitorder="little")[: len(right)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _last_row(left: list[int], right: list[int]) -> int:
    places: dict[int, int] = {}
    for j, value in enumerate(right):
        places[value] = places.get(value, 0) | 1 << j
    full = (1 << len(right)) - 1
    row = full
    for value in left:
        match = row & places.get(value, 0)
        row = ((row + match) | (row - match)) & full
    return row


def common_lines(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Places (i, j) of one longest common subsequence, ascending."""
    first = 0
    while first < min(len(left), len(right)) and left[first] == right[first]:
        first += 1
    end_l, end_r = len(left), len(right)
    while end_l > first and end_r > first and left[end_l - 1] == right[end_r - 1]:
        end_l, end_r = end_l - 1, end_r - 1
    head = [(i, i) for i in range(first)]
    tail = [(end_l + k, end_r + k) for k in range(len(left) - end_l)]
    inner = _common(left[first:end_l], right[first:end_r])
    return [*head, *((i + first, j + first) for i, j in inner), *tail]


def _common(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    if not left or not right:
        return []
    if len(left) * len(right) > _MOST_BITS and len(left) > 1:
        # Halve the left side, and cut the right one where both halves together are longest.
        half = len(left) // 2
        before = _prefix_lengths(left[:half], right)
        after = _prefix_lengths(left[half:][::-1], right[::-1])[::-1]
        cut = int(np.argmax(before + after))
        return [
            *_common(left[:half], right[:cut]),
            *((i + half, j + cut) for i, j in _common(left[half:], right[cut:])),
        ]
    rows = _rows_of_lengths(left, right)
    found, i, j = [], len(left) - 1, len(right) - 1
    while i >= 0 and j >= 0:
        above = rows[i - 1] if i else (1 << len(right)) - 1
        if above >> j & 1 == 0 and rows[i] >> j & 1 == 0 and _grown(above, j) == _grown(rows[i], j):
            i -= 1
        elif rows[i] >> j & 1:
            j -= 1
        elif left[i] == right[j]:
            found.append((i, j))
            i, j = i - 1, j - 1
        else:
            i -= 1
    return found[::-1]


def _grown(row: int, j: int) -> int:
    """The common length up to column j: the number of 0 bits there."""
    return j + 1 - (row & ((1 << (j + 1)) - 1)).bit_count()


def _shared(names: list[str]):
    """Rows (key, shared) for the pairs of consecutive pages of one host in a group of places."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["place", "key", "host", "hashes", "longest"]).to_pylist(), key=lambda r: r["place"])
        keys, marks = [], []
        for one, two in zip(rows[:-1], rows[1:], strict=True):
            if one["host"] is None or one["host"] != two["host"] or one["place"] + 1 != two["place"]:
                continue
            pairs = common_lines(one["hashes"], two["hashes"])
            left, right = ({p[side] for p in pairs} for side in (0, 1))
            if not pairs or one["longest"] in left or two["longest"] in right:
                continue
            for row, places in ((one, left), (two, right)):
                keys.append(row["key"])
                marks.append([i in places for i in range(len(row["hashes"]))])
        return pa.table({"key": pa.array(keys, pa.binary()), "shared": pa.array(marks, pa.list_(pa.bool_()))}).select(names)

    return run


def _with_places(pages: DataFrame) -> DataFrame:
    """Pages with their place in the order of host and path: one number per range of the sort is looked at together."""
    ordered = pages.orderBy("host", "path", "url", "key").withColumn("row", F.monotonically_increasing_id())
    ordered = materialize(ordered, "page-order")
    ends = ordered.groupBy(F.shiftright("row", 33).alias("part")).agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    ends = ends.select("part", (before - F.col("first")).alias("shift"))
    return ordered.join(ends, F.shiftright("row", 33) == F.col("part")).withColumn("place", F.col("row") + F.col("shift"))


def shared_lines(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """(key, shared) of pages (key, url, host, path, hashes, longest): which lines a page shares with its neighbours."""
    placed = _with_places(pages)
    group = F.floor(F.col("place") / group_pages)
    # The first page of a group also goes to the group before, to meet its last one there.
    groups = F.when(F.col("place") % group_pages == 0, F.array(group, group - 1)).otherwise(F.array(group))
    spread = placed.select("place", "key", "host", "hashes", "longest", F.explode(groups).alias("group"))
    marks = spread.groupBy("group").applyInArrow(_shared(["key", "shared"]), "key binary, shared array<boolean>")
    either = F.aggregate(
        F.slice("all", 2, 2), F.element_at("all", 1), lambda a, b: F.zip_with(a, b, lambda x, y: x | y)
    )
    # A page is in two pairs at most.
    return marks.groupBy("key").agg(F.collect_list("shared").alias("all")).select("key", either.alias("shared"))


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group_pages: int = GROUP_PAGES
) -> DataFrame:
    """One row per page: id, url, text (its lines, joined by line feeds), n_lines, n_shared, n_deleted.

    ``n_lines`` counts the lines that the page shows, ``n_shared`` those shared with a neighbour,
    ``n_deleted`` those left out. In a page with articles (else: with a main element) their lines
    stay and all others go; in a page without, the lines of framing elements go (see ``markup``),
    and of the others those that a neighbour shares. A null or empty page has no lines and the text ``''``. A page without
    a readable host has no neighbours. Of pages with one address the order follows their content; rows
    that repeat address and content are one page for all others. Repeated rows and null ids stay; an empty table gives an empty result; other
    columns are not read.
    """
    plain = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = "key binary, url string, host string, path string, hashes array<bigint>, longest int"
    parsed = plain.select("url", "html").mapInArrow(_parsed, kind).where("host is not null").dropDuplicates(["key"])
    shared = shared_lines(parsed, group_pages)
    head = [T.StructField("id", plain.schema["id"].dataType), T.StructField("url", T.StringType())]
    packed = plain.mapInArrow(
        _packed, T.StructType([*head, T.StructField("key", T.BinaryType()), T.StructField("page", T.BinaryType())])
    )
    counts = [T.StructField(n, T.LongType()) for n in ("n_lines", "n_shared", "n_deleted")]
    joined = packed.join(shared, "key", "left").select("id", "url", "page", "shared")
    found = joined.mapInArrow(_texts, T.StructType([*head, T.StructField("text", T.StringType()), *counts]))
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_lines", "n_shared", "n_deleted")
