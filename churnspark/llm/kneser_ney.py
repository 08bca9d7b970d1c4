"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model (operator 3).

The model runs over bytes (upper case, digits and blanks each folded into one symbol), which needs
no word list and works for all languages. Training is joins of count tables: n-grams of the
trusted texts are counted per slice and summed, continuation counts of each lower order follow by
grouping, and the probabilities of an order join its counts with its contexts and with the order
below, all sharded by gram. The documents' distinct n-grams then meet the table: a table of up to
``BROADCAST_ROWS`` rows is broadcast, a larger one is joined per block of documents.

A document is kept if its perplexity is at most a quantile for its language, taken over trusted
documents that the model has not seen: one in ``CHECK_SHARE`` is left out of training.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm import textbytes
from churnspark.llm.blocks import answered, located, rows_of, to_blocks
from churnspark.runtime import materialize

ORDER = 5
SYMBOLS = 256
# 24 bytes a row.
BROADCAST_ROWS = 4_000_000
CHECK_SHARE = 5
_SLICE = 1 << 22
_END = 3


def _folded() -> np.ndarray:
    symbols = np.arange(256, dtype=np.uint8)
    symbols[:9] = 1
    symbols[textbytes.IS_BLANK] = 32
    symbols[10] = 10
    symbols[65:91] = 65
    symbols[48:58] = 48
    return symbols


_FOLDED = _folded()


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram that ends at each symbol, offsets); a text gets a run of zeros before and an end after."""
    count = len(offsets) - 1
    lengths = np.diff(offsets)
    pad = ORDER  # ORDER - 1 zeros before a text and its end
    stretched = np.zeros(len(data) + count * pad, np.uint64)
    rows = np.repeat(np.arange(count), lengths)
    stretched[np.arange(len(data)) + rows * pad + ORDER - 1] = _FOLDED[data]
    ends = offsets[1:] + np.arange(1, count + 1) * pad - 1
    stretched[ends] = _END
    grams = np.zeros(len(stretched), np.uint64)
    for i in range(ORDER):
        shifted = stretched if i == 0 else np.concatenate([np.zeros(i, np.uint64), stretched[:-i]])
        grams |= shifted << np.uint64(8 * i)
    own = np.ones(len(stretched), bool)
    heads = offsets[:-1] + np.arange(count) * pad
    for i in range(ORDER - 1):
        own[heads + i] = False
    return grams[own], offsets + np.arange(count + 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in textbytes.texts(batch.column(0), _SLICE):
            grams, counts = np.unique(_grams(data, offsets)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts)], names=["gram", "c"])


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more, from how many grams have each count."""
    row = counts.agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5)]).first()
    n = [row[f"n{i}"] for i in range(1, 5)]
    share = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = []
    for i in range(3):
        value = i + 1 - (i + 2) * share * n[i + 1] / n[i] if n[i] else (i + 1) / 2
        found.append(min(max(value, 0.05), i + 0.95))
    return found


def _tagged(gram: Column, length: int) -> Column:
    return gram.bitwiseOR(F.lit(length << 56))


def train(trusted: DataFrame, text_col: str = "text") -> DataFrame:
    """Stored table (key, p, back): probability of a gram's last symbol, and what its longer grams leave over.

    ``key`` is the gram with its length in the top byte. No trusted text gives an empty table.
    """
    counted = trusted.select(F.col(text_col)).mapInArrow(_counted, "gram bigint, c bigint")
    counts = {ORDER: materialize(counted.groupBy("gram").agg(F.sum("c").alias("c")), "grams")}
    for length in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << 8 * length) - 1)
        lower = counts[length + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("c"))
        counts[length] = materialize(lower, "grams")
    parts: list[DataFrame] = []
    below: DataFrame | None = None
    for length in range(1, ORDER + 1):
        discounts = _discounts(counts[length])
        taken = F.when(F.col("c") == 1, discounts[0]).when(F.col("c") == 2, discounts[1]).otherwise(discounts[2])
        rows = counts[length].select("gram", (F.col("c") - taken).alias("own"), "c", taken.alias("d"))
        rows = rows.withColumn("context", F.shiftright("gram", 8))
        contexts = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("left"))
        contexts = materialize(contexts.withColumn("back", F.col("left") / F.col("total")), "contexts")
        joined = rows.join(contexts, "context").withColumn("suffix", F.col("gram").bitwiseAND((1 << 8 * (length - 1)) - 1))
        if below is None:
            lower_p = F.lit(1.0 / SYMBOLS)
        else:
            joined = joined.join(below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix")
            lower_p = F.col("lower")
        p = F.col("own") / F.col("total") + F.col("back") * lower_p
        below = materialize(joined.select("gram", p.alias("p")), "order")
        nothing = F.lit(None).cast("double")
        parts.append(below.select(_tagged(F.col("gram"), length).alias("key"), "p", nothing.alias("back")))
        parts.append(contexts.select(_tagged(F.col("context"), length - 1).alias("key"), nothing.alias("p"), "back"))
    table = reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.max("p").alias("p"), F.max("back").alias("back"))
    return materialize(table, "model")


class _Table:
    """Rows of the model in ascending order of their key."""

    def __init__(self, table: pa.Table) -> None:
        keys = table.column("key").to_numpy().astype(np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.p, self.back = (
            table.column(n).to_numpy(zero_copy_only=False).astype(np.float64)[order] for n in ("p", "back")
        )

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 probability of the last symbol of each gram."""
        p = np.full(len(grams), 1.0 / SYMBOLS)
        for length in range(1, ORDER + 1):
            keys, contexts = _keys(grams, length)
            at, there = located(keys, self.keys)
            own = np.where(there, self.p[at], np.nan) if len(self.keys) else np.full(len(grams), np.nan)
            at, there = located(contexts, self.keys)
            back = np.where(there, self.back[at], np.nan) if len(self.keys) else np.full(len(grams), np.nan)
            p = np.where(np.isnan(own), np.where(np.isnan(back), 1.0, back) * p, own)
        return np.log2(p)


def _keys(grams: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    own = grams & np.uint64((1 << 8 * length) - 1)
    return (
        (own | np.uint64(length << 56)).view(np.int64),
        ((own >> np.uint64(8)) | np.uint64((length - 1) << 56)).view(np.int64),
    )


def _perplexities(column: pa.Array | pa.ChunkedArray, table: _Table) -> Iterator[tuple[int, int, np.ndarray]]:
    for first, last, data, offsets in textbytes.texts(column, _SLICE):
        grams, places = _grams(data, offsets)
        distinct, own = np.unique(grams, return_inverse=True)
        sums = np.concatenate([[0.0], np.cumsum(table.log2(distinct)[own])])
        yield first, last, np.exp2(-(sums[places[1:]] - sums[places[:-1]]) / np.diff(places))


def _by_broadcast(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found in _perplexities(batch.column(at), shared.value):
                part = batch.slice(first, last - first)
                columns = [c for i, c in enumerate(part.columns) if i != at]
                names = [n for i, n in enumerate(batch.schema.names) if i != at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*names, "perplexity"])

    return run


def _asked(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = [
                    np.unique(_grams(data, offsets)[0])
                    for _, _, data, offsets in textbytes.texts(rows_of(payload).column(at), _SLICE)
                ]
                grams = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
                keys = np.unique(np.concatenate([k for n in range(1, ORDER + 1) for k in _keys(grams, n)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), block, np.int64)), pa.array(keys)], names=["block", "key"]
                )

    return run


def _by_block(at: int):
    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        table = _Table(answers)
        found = [f for _, _, f in _perplexities(rows.column(at), table)]
        kept = rows.remove_column(at)
        return kept.append_column("perplexity", pa.array(np.concatenate(found) if found else np.zeros(0)))

    return work


def perplexities(
    docs: DataFrame, model: DataFrame, text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``docs`` without its text, with ``perplexity`` per symbol (its end included).

    A null or empty text has its end only. All rows and other columns stay; a column named
    ``perplexity`` is replaced.
    """
    docs = docs.drop("perplexity")
    at = docs.columns.index(text_col)
    fields = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*fields, T.StructField("perplexity", T.DoubleType())])
    if model.count() <= broadcast_rows:
        shared = docs.sparkSession.sparkContext.broadcast(_Table(model.toArrow()))
        return docs.mapInArrow(_by_broadcast(shared, at), schema)
    blocks = to_blocks(docs, text_col)
    asked = blocks.mapInArrow(_asked(at), "block bigint, key bigint")
    return answered(blocks, asked, model, "key", _by_block(at), schema)


def classify(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = 0.995,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document: id, lang, trusted, perplexity, threshold, kept.

    ``trusted_ids`` lists the documents whose text is trusted. The threshold of a language is the
    given quantile of the perplexities of its held-out trusted documents, or of all those held out
    if it has none; a null language is one of its own. If none at all is held out, all trusted
    documents take their place. Without trusted documents nothing is rejected.
    Repeated rows stay, a repeated trusted id counts once; other columns are not read; an empty
    table gives an empty result.
    """
    known = trusted_ids.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    held_out = F.pmod(F.xxhash64("id"), F.lit(CHECK_SHARE)) == 0
    known = materialize(known.select("id", held_out.alias("held_out")), "trusted")
    if known.count() <= broadcast_rows:
        known = F.broadcast(known)
    plain = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    model = train(plain.join(known.where("not held_out"), "id", "left_semi"))
    scored = perplexities(plain, model, "text", broadcast_rows)
    scored = scored.join(known.withColumn("trusted", F.lit(True)), "id", "left")
    scored = materialize(scored.fillna(False, ["trusted", "held_out"]), "scored")
    own = scored.where("held_out")
    if own.isEmpty():
        own = scored.where("trusted")
    cut = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    overall = own.agg(cut.alias("t")).first()["t"]
    cuts = materialize(own.groupBy(F.col("lang").alias("__lang")).agg(cut.alias("threshold")), "cuts")
    joined = scored.join(cuts, F.col("lang").eqNullSafe(F.col("__lang")), "left")
    threshold = F.coalesce("threshold", F.lit(overall).cast("double"))
    return joined.select(
        F.col("id").alias(id_col), F.col("lang").alias(lang_col), "trusted", "perplexity", threshold.alias("threshold"),
        F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept"),
    )
