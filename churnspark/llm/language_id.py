"""Language identification: averaged hashed subword embeddings and a linear softmax (operator 2).

A text becomes the mean of the embeddings of its hashed subwords: all runs of 2 to 4 characters of
its lower-cased words, with everything that is no letter as one word border. A linear softmax
reads that mean. Both layers are trained by stochastic gradient descent in numpy, on a bounded
sample of labelled documents. Mean and softmax are linear up to the last step, so for prediction
the two layers are multiplied once and every subword adds one row of numbers.

Scores are calibrated on a part of the sample that training did not see: a temperature is fitted,
and texts are rejected by two signals, the score and how familiar a text's subwords are: their mean
log frequency in the language found, against what is usual for that language and number of subwords.
The threshold of each lies where it best parts rightly predicted rows from rows to refuse: those of
languages left out of training in turn, and (for familiarity) random subwords.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm.characters import decoded, folded_letters
from churnspark.llm.textbytes import mix, slices, utf8

UNKNOWN = "und"
BUCKETS, DIMENSIONS, LENGTHS = 1 << 16, 16, (2, 3, 4)
# The most labelled documents that training reads, over all languages together (as expected
# number: documents are drawn by a hash of their id, each language with its own rate).
SAMPLE_ROWS = 3000
# Into how many groups languages are dealt that calibration leaves out in turn.
LEFT_OUT_FOLDS = 4
# Text bytes looked at together: a byte takes about 200 bytes of arrays.
SLICE_BYTES = 1 << 19
_SEED = 17


def _subwords(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of all subwords, and whether each row has a letter."""
    count = len(offsets) - 1
    folded = folded_letters()[points]
    rows = np.repeat(np.arange(count), np.diff(offsets))
    has_letter = np.bincount(rows[folded != 0], minlength=count) > 0
    # A border between rows and one for each run of other characters.
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0) | (folded[:-1] != 0) | (rows[1:] != rows[:-1])
    folded, rows = folded[keep].astype(np.uint64), rows[keep]
    found, owners = [], []
    for length in LENGTHS:
        size = len(folded) - length + 1
        if size <= 0:
            continue
        key = np.full(size, length, np.uint64)
        letters = np.zeros(size, bool)
        for i in range(length):
            part = folded[i : i + size]
            key = key * np.uint64(0x100000001B3) + part
            letters |= part != 0
        inner = rows[:size] == rows[length - 1 :]
        for i in range(1, length - 1):  # a border only at the ends
            inner &= folded[i : i + size] != 0
        inner &= letters
        found.append((mix(key[inner]) & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(rows[:size][inner])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has_letter
    return np.concatenate(found), np.concatenate(owners), has_letter


@dataclass
class LanguageModel:
    """``table``: a row of language logits per bucket; an empty list of languages rejects all."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    frequency: np.ndarray | None = None
    usual: np.ndarray | None = None
    least_familiar: float = -np.inf

    def familiarity(self, sums: np.ndarray, sizes: np.ndarray, best: np.ndarray) -> np.ndarray:
        """How far the summed log frequencies of ``sizes`` subwords are from the mean of their language,
        in standard deviations; subwords of one place share letters and count once."""
        mean, among_texts, within = self.usual[best].T
        sizes = np.maximum(sizes, 1)
        return (sums / sizes - mean) / np.sqrt(among_texts + within * len(LENGTHS) / sizes)

    def logits(self, buckets: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
        sums = np.zeros((count, len(self.languages)))
        for i in range(len(self.languages)):
            sums[:, i] = np.bincount(rows, weights=self.table[buckets, i], minlength=count)
        sizes = np.maximum(np.bincount(rows, minlength=count), 1)
        return sums / sizes[:, None] + self.bias

    def predict(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the language or -1, score, whether it is rejected) per row."""
        buckets, rows, has_letter = _subwords(points, offsets)
        count = len(offsets) - 1
        if not self.languages:
            return np.full(count, -1), np.zeros(count), np.ones(count, bool)
        chance = _softmax(self.logits(buckets, rows, count) / self.temperature)
        best = chance.argmax(axis=1)
        score = chance[np.arange(count), best]
        rejected = ~has_letter | (score < self.threshold)
        if self.frequency is not None:
            sums = np.bincount(rows, weights=self.frequency[buckets, best[rows]], minlength=count)
            rejected |= self.familiarity(sums, np.bincount(rows, minlength=count), best) < self.least_familiar
        return np.where(has_letter, best, -1), np.where(has_letter, score, 0.0), rejected


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Language, then the distinct subword buckets of the text and how often each occurs, as bytes."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for first, last in slices(offsets, SLICE_BYTES):
            _, _, points, _, places = decoded(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            buckets, rows, _ = _subwords(points, places)
            keys, counts = np.unique(rows * BUCKETS + buckets, return_counts=True)
            cuts = np.searchsorted(keys, np.arange(last - first + 1) * BUCKETS)
            parts = [
                ((keys[a:b] % BUCKETS).astype(np.uint32).tobytes(), counts[a:b].astype(np.float32).tobytes())
                for a, b in zip(cuts[:-1], cuts[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary()),
                ],
                names=["lang", "buckets", "counts"],
            )


def _excerpt(random: np.random.Generator, row: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A short text made of a few subwords of a longer one."""
    buckets, share = row
    drawn = random.choice(len(buckets), size=int(random.integers(4, 40)), p=share / share.sum())
    own, counts = np.unique(drawn, return_counts=True)
    return buckets[own], (counts / counts.sum()).astype(np.float32)


def _descend(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: int, epochs: int, rate: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stochastic gradient descent, one document at a time, with a rate that falls to zero.

    Every other step sees a short excerpt instead, so that short texts are told apart as well.
    """
    random = np.random.default_rng(_SEED)
    embed = random.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, languages), np.float32)
    bias = np.zeros(languages, np.float32)
    # Each language weighs the same, however many documents it has.
    balance = len(labels) / (languages * np.bincount(labels, minlength=languages))
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            buckets, share = rows[i] if step % 2 else _excerpt(random, rows[i])
            now = rate * (1 - step / steps)
            step += 1
            mean = share @ embed[buckets]
            error = _softmax(mean @ weights + bias)
            error[labels[i]] -= 1
            error *= balance[labels[i]]
            back = weights @ error
            weights -= now * np.outer(mean, error)
            bias -= now * 0.1 * error
            # Shares of rare subwords are tiny: scale them up, as for an average over a few.
            embed[buckets] -= (now * np.minimum(share * len(buckets), 4.0))[:, None] * back
    return embed, weights, bias


def _parting(right: np.ndarray, wrong: np.ndarray, false_rejections: float, of: int) -> float:
    """The threshold that parts ``right`` from ``wrong`` values best; minus infinity if none does.

    Values between two neighbouring ones part alike: the middle is taken. No more of the right ones
    than the given share are refused; ``of`` is how many wrong ones there are in all.
    """
    if not len(right) or not len(wrong):
        return -np.inf
    right, wrong = np.sort(right), np.sort(wrong)
    cuts = np.unique(np.concatenate([right, wrong]))
    lost = np.searchsorted(right, cuts) / len(right)
    refused = np.searchsorted(wrong, cuts) / of
    gain = np.where(lost <= false_rejections, refused, 0.0)
    at = int(gain.argmax())
    if gain[at] <= 0:
        return -np.inf
    return float((cuts[at] + cuts[at - 1]) / 2)


def _frequencies(rows: list, labels: np.ndarray, languages: int) -> np.ndarray:
    """Log share of each bucket among the subwords of a language; each text weighs the same."""
    sums = np.zeros((BUCKETS, languages))
    for (buckets, share), label in zip(rows, labels, strict=True):
        sums[buckets, label] += share
    sums += 0.05 * sums.sum(axis=0) / BUCKETS
    return np.log(sums / sums.sum(axis=0)).astype(np.float32)


def _scores(model: LanguageModel, rows: list) -> np.ndarray:
    logits = np.array([share @ model.table[buckets] + model.bias for buckets, share, _ in rows])
    return _softmax(logits.reshape(len(rows), len(model.languages)) / model.temperature)


def _familiar(model: LanguageModel, rows: list, best: np.ndarray) -> np.ndarray:
    means = np.array([share @ model.frequency[buckets, c] for (buckets, share, _), c in zip(rows, best, strict=True)])
    sizes = np.array([size for *_, size in rows])
    return model.familiarity(means * sizes, sizes, best)


def _with_excerpts(rows: list, sizes: list) -> list:
    """(buckets, share, subwords) of whole texts, then of an excerpt of each."""
    random = np.random.default_rng(_SEED)
    out = [(*row, size) for row, size in zip(rows, sizes, strict=True)]
    for row in rows:
        size = int(random.integers(4, 40))
        drawn = random.choice(row[0], size=size, p=row[1] / row[1].sum())
        own, counts = np.unique(drawn, return_counts=True)
        out.append((own, (counts / size).astype(np.float32), size))
    return out


def _set_usual(model: LanguageModel, rows: list, labels: np.ndarray) -> None:
    """Per language: mean familiarity, its variance among texts and among the subwords of a text."""
    found = np.array([
        (m := share @ model.frequency[buckets, c], share @ (model.frequency[buckets, c] - m) ** 2)
        for (buckets, share), c in zip(rows, labels, strict=True)
    ])
    model.usual = np.zeros((len(model.languages), 3))
    for c in range(len(model.languages)):
        own = found[labels == c] if (labels == c).any() else found
        middle = np.median(own[:, 0])
        # By quantiles, so that odd but right texts count and a few in another language do not.
        away = np.abs(own[:, 0] - middle)
        spread = max(1.4826 * np.median(away), np.quantile(away, 0.98) / 2.33)
        model.usual[c] = middle, max(spread, 0.05) ** 2, max(np.median(own[:, 1]), 1e-3)


def _fitted(languages: list[str], rows: list, labels: np.ndarray, epochs: int, rate: float) -> LanguageModel:
    embed, weights, bias = _descend(rows, labels, len(languages), epochs, rate)
    model = LanguageModel(languages, embed @ weights, bias)
    model.frequency = _frequencies(rows, labels, len(languages))
    return model


def _calibrate(
    model: LanguageModel, rows: list, sizes: list, labels: np.ndarray, false_rejections: float, left_out: list[LanguageModel]
) -> None:
    """``left_out``: models of some of the languages; rows of the others are to be refused by them."""
    _set_usual(model, rows, labels)
    both = _with_excerpts(rows, sizes)
    twice = np.concatenate([labels, labels])
    logits = np.array([share @ model.table[buckets] + model.bias for buckets, share, _ in both])
    grid = np.geomspace(0.2, 20, 60)
    places = np.arange(len(twice))
    losses = [-np.log(_softmax(logits / t)[places, twice] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])
    chance = _scores(model, both)
    best = chance.argmax(axis=1)
    right = best == twice
    scores = chance.max(axis=1)[right]
    familiar = _familiar(model, both, best)[right]
    wrong_scores, wrong_familiar = [], []
    for part in left_out:
        known = np.isin(np.array(model.languages)[labels], part.languages)
        own = np.searchsorted(part.languages, np.array(model.languages)[labels[known]])
        _set_usual(part, [r for r, k in zip(rows, known, strict=True) if k], own) if known.any() else None
        strange = [r for r, k in zip(both, np.concatenate([known, known]), strict=True) if not k]
        if part.usual is None or not strange:
            continue
        part.temperature = model.temperature
        chance = _scores(part, strange)
        wrong_scores.append(chance.max(axis=1))
        wrong_familiar.append(_familiar(part, strange, chance.argmax(axis=1)))
    random = np.random.default_rng(_SEED)
    noise = [
        (*np.unique(random.integers(0, BUCKETS, size), return_counts=True), size)
        for size in random.integers(4, 400, 200).tolist()
    ]
    noise = [(buckets, (counts / size).astype(np.float32), size) for buckets, counts, size in noise]
    wrong_familiar.append(_familiar(model, noise, _scores(model, noise).argmax(axis=1)))
    strange = np.concatenate(wrong_familiar)
    model.least_familiar = _parting(familiar, strange, false_rejections, len(strange))
    if wrong_scores:
        # The score has to refuse only what is familiar.
        strange = np.concatenate(wrong_scores)
        left = strange[np.concatenate(wrong_familiar[:-1]) >= model.least_familiar]
        scores = scores[familiar >= model.least_familiar]
        model.threshold = max(_parting(scores, left, false_rejections, len(strange)), 0.0)


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
    epochs: int = 6,
    rate: float = 0.5,
    false_rejections: float = 0.002,
) -> LanguageModel:
    """Fit a model on about ``sample_rows`` documents at most; rows without language are left out.

    Whole texts are used; they are reduced to subword counts where they are read. Rows are drawn
    by a hash of id and text, so the fit does not depend on partitions. Texts without letters
    teach nothing. Without labelled rows the model knows no language.
    """
    known = labelled.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("drawn"),
    ).where("lang is not null")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    quota = sample_rows / len(languages)
    rate_of = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, quota / counts[lang]))])
    drawn = F.pmod("drawn", F.lit(1 << 20)) < F.element_at(rate_of, F.col("lang")) * (1 << 20)
    schema = "lang string, buckets binary, counts binary"
    table = known.where(drawn).select("lang", "text").mapInArrow(_features, schema).toArrow()
    place = {lang: i for i, lang in enumerate(languages)}
    examples = []
    for lang, buckets, found in zip(*[table.column(i).to_pylist() for i in range(3)], strict=True):
        share = np.frombuffer(found, np.float32)
        examples.append((buckets, place[lang], share / max(share.sum(), 1), int(share.sum())))
    examples.sort(key=lambda e: (e[0], e[1], e[3]))
    random = np.random.default_rng(_SEED)
    held = random.random(len(examples)) < 0.2
    sides = {}
    for name, wanted in (("fit", ~held), ("check", held)):
        chosen = [e for e, w in zip(examples, wanted, strict=True) if w and len(e[0])]
        sides[name] = (
            [(np.frombuffer(e[0], np.uint32).astype(np.int64), e[2]) for e in chosen],
            np.array([e[1] for e in chosen], np.int64),
            [e[3] for e in chosen],
        )
    rows, labels, sizes = sides["fit"] if len(sides["fit"][0]) else sides["check"]
    if not len(rows):
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    seen = np.unique(labels)
    languages = [languages[i] for i in seen]
    labels = np.searchsorted(seen, labels)
    model = _fitted(languages, rows, labels, epochs, rate)
    check_rows, check_labels, check_sizes = sides["check"] if len(sides["check"][0]) else (rows, seen[labels], sizes)
    usable = np.flatnonzero(np.isin(check_labels, seen))
    if len(usable):
        left_out = []
        folds = min(len(languages), LEFT_OUT_FOLDS) if len(languages) > 1 else 0
        for fold in range(folds):
            kept = np.flatnonzero(np.arange(len(languages)) % folds != fold)
            own = np.flatnonzero(np.isin(labels, kept))
            part = [rows[i] for i in own], np.searchsorted(kept, labels[own])
            left_out.append(_fitted([languages[i] for i in kept], *part, max(epochs // 3, 1), rate))
        kept_rows, kept_sizes = [check_rows[i] for i in usable], [check_sizes[i] for i in usable]
        _calibrate(model, kept_rows, kept_sizes, np.searchsorted(seen, check_labels[usable]), false_rejections, left_out)
    return model


def _predict(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: LanguageModel = shared.value
        names = pa.array([*model.languages, UNKNOWN])
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for first, last in slices(offsets, SLICE_BYTES):
                own = offsets[first : last + 1] - offsets[first]
                _, _, points, _, places = decoded(data[offsets[first] : offsets[last]], own)
                best, score, rejected = model.predict(points, places)
                best = np.where(best < 0, len(model.languages), best)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, names.take(pa.array(best)), pa.array(score), pa.array(rejected)],
                    names=[*batch.schema.names, "lang_pred", "lang_score", "lang_rejected"],
                )

    return run


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_rejected``.

    A null text, or one without a letter, is ``und`` with score 0 and rejected; so is every text
    if the model knows no language. Columns of ``docs`` with these three names are replaced, all
    others pass. Very long texts are read whole. The model (at most 131072 numbers per language)
    is broadcast.
    """
    added = ["lang_pred", "lang_score", "lang_rejected"]
    docs = docs.drop(*added)
    schema = T.StructType(
        [
            *docs.schema.fields, T.StructField(added[0], T.StringType()),
            T.StructField(added[1], T.DoubleType()), T.StructField(added[2], T.BooleanType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(shared, docs.columns.index(text_col)), schema)
