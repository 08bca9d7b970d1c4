"""Quality rules as a learned decision list over text statistics (operator 10).

Statistics are counted in one pass over whole texts. The list is learned by sequential covering:
a rule starts empty and grows by the threshold condition with the best information gain on one
part of the labelled rows, is pruned from its end on another part, and is accepted if it is
precise enough there; the rows that it covers are taken out and the next rule follows. The list
becomes one ordered conditional expression of Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm import textbytes

# The most labelled rows that learning reads (as expected number, drawn by a hash of the id).
SAMPLE_ROWS = 20_000
_SEED = 5

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_digits",
    "n_marks",
)
# The characters counted as symbols, and as marks of shouting.
_SYMBOLS, _MARKS = b"#*$%&|<>", b"!?"

# What rules test: a statistic, or the ratio of two (0 where the second is 0).
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "duplicate_lines_per_word": ("n_dup_lines", "n_words"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}


def _flags(characters: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(characters))


_IS_SYMBOL, _IS_MARK = _flags(_SYMBOLS), _flags(_MARKS)
_IS_UPPER, _IS_DIGIT = _flags(bytes(range(65, 91))), _flags(bytes(range(48, 58)))


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All statistics of the texts in one slice."""
    count = len(offsets) - 1
    start, end, rows = textbytes.word_bounds(data, offsets)
    words = textbytes.span_hashes(data, start, end)

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    def per_row(owners: np.ndarray) -> np.ndarray:
        return np.bincount(owners, minlength=count)

    leads = (data & 0xC0) != 0x80
    blank = textbytes.IS_BLANK[data]
    found = {
        "n_words": per_row(rows),
        "word_chars": within(leads & ~blank),
        "n_symbols": within(_IS_SYMBOL[data]),
        "n_upper": within(_IS_UPPER[data]),
        "n_digits": within(_IS_DIGIT[data]),
        "n_marks": within(_IS_MARK[data]),
        "n_distinct_words": per_row(textbytes.distinct_per_row(words, rows)[1]),
    }
    # Lines that hold a word: total less distinct.
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.minimum(
        np.append(breaks, len(data))[np.searchsorted(breaks, line_start)],
        offsets[np.searchsorted(offsets, line_start, side="right")],
    )
    solid = np.concatenate([[0], np.cumsum(~blank)])
    with_word = solid[line_end] > solid[line_start]
    line_start, line_end = line_start[with_word], line_end[with_word]
    line_rows = np.searchsorted(offsets, line_start, side="right") - 1
    lines = textbytes.span_hashes(data, line_start, line_end)
    found["n_dup_lines"] = per_row(line_rows) - per_row(textbytes.distinct_per_row(lines, line_rows)[1])

    covered = np.zeros(len(words), bool)
    if len(words) >= 3:
        same = rows[:-2] == rows[2:]
        at = np.flatnonzero(same)
        key = textbytes.mix(textbytes.mix(textbytes.mix(words[at]) + words[at + 1]) + words[at + 2])
        order = np.lexsort((key, rows[at]))
        k, r = key[order], rows[at][order]
        equal = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        for i in range(3):
            covered[at[twice] + i] = True
    found["n_repeat_words"] = per_row(rows[covered])
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in textbytes.texts(batch.column(1)):
            found = text_statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), *[pa.array(found[n].astype(np.int64)) for n in STATISTICS]],
                names=["id", *STATISTICS],
            )


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and the statistics of its whole text.

    Words are runs of characters other than space and 0x09-0x0D; a null or empty text has zeros.
    ``n_dup_lines``: lines with a word that equal an earlier line. ``n_repeat_words``: words in a
    window of three words that occurs twice or more in the text. Repeated rows stay, other columns
    are not read, an empty table gives an empty result.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {plain.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} bigint" for n in STATISTICS)
    return plain.mapInArrow(_count, schema).withColumnRenamed("id", id_col)


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of the words repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def feature(name: str) -> Column:
    upper, lower = FEATURES[name]
    if lower is None:
        return F.col(upper).cast("double")
    return F.when(F.col(lower) > 0, F.col(upper) / F.col(lower)).otherwise(0.0)


@dataclass
class Rule:
    """Conditions (feature, above, threshold) that all hold; ``above``: >= threshold, else <."""

    conditions: list[tuple[str, bool, float]] = field(default_factory=list)
    precision: float = 0.0
    covered: int = 0

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        result = np.ones(len(next(iter(values.values()))), bool)
        for name, above, threshold in self.conditions:
            result &= (values[name] >= threshold) if above else (values[name] < threshold)
        return result

    def column(self) -> Column:
        result = F.lit(True)
        for name, above, threshold in self.conditions:
            result &= (feature(name) >= threshold) if above else (feature(name) < threshold)
        return result

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if a else '<'} {t:.6g}" for n, a, t in self.conditions)


def _information(good: float, bad: float) -> float:
    return float(np.log2((bad + 1e-9) / (good + bad + 1e-9)))


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    rule, inside = Rule(), np.ones(len(bad), bool)
    while len(rule.conditions) < most and (~bad & inside).any():
        before = _information((~bad & inside).sum(), (bad & inside).sum())
        best, gain = None, 1e-6
        for name, column in values.items():
            for threshold in np.unique(np.quantile(column[inside], np.linspace(0, 1, 33))):
                over = column >= threshold
                for above, chosen in ((True, over & inside), (False, ~over & inside)):
                    hits = (bad & chosen).sum()
                    if hits and not chosen.all():
                        now = hits * (_information((~bad & chosen).sum(), hits) - before)
                        if now > gain:
                            best, gain = (name, above, float(threshold)), now
        if best is None:
            break
        rule.conditions.append(best)
        inside &= Rule([best]).holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The beginning of the rule with the best balance of right and wrong rows."""
    best, worth = Rule(), -2.0
    for size in range(1, len(rule.conditions) + 1):
        part = Rule(rule.conditions[:size])
        inside = part.holds(values)
        right, total = int((bad & inside).sum()), int(inside.sum())
        value = (2 * right - total) / total if total else -1.0
        if value > worth:
            best, worth = Rule(part.conditions, right / total if total else 0.0, total), value
    return best


def learn_rules(
    values: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.85, most_rules: int = 12, most_conditions: int = 3
) -> list[Rule]:
    """A decision list for the bad rows; empty without bad or without good rows.

    A rule's precision on the pruning rows is estimated as (right + 1/2) / (covered + 1), so that
    a rule seen on one or two rows is not trusted.
    """
    random = np.random.default_rng(_SEED)
    left = np.arange(len(bad))
    rules: list[Rule] = []
    while len(rules) < most_rules and bad[left].any() and (~bad[left]).any():
        to_prune = random.random(len(left)) < 1 / 3
        grown, checked = left[~to_prune], left[to_prune]
        rule = _grow({n: v[grown] for n, v in values.items()}, bad[grown], most_conditions)
        if not rule.conditions:
            break
        rule = _prune(rule, {n: v[checked] for n, v in values.items()}, bad[checked])
        if (rule.precision * rule.covered + 0.5) / (rule.covered + 1) < min_precision:
            break
        rules.append(rule)
        left = left[~rule.holds({n: v[left] for n, v in values.items()})]
    return rules


def train_rules(
    statistics: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """Learn from labelled documents (label 1: good, 0: bad) that pass the base rules.

    About ``sample_rows`` labelled rows at most are read; rows without label are left out, a
    repeated label counts once for each repetition. Without labels the list is empty.
    """
    labelled = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label")).where("__label is not null")
    total = labelled.count()
    if total > sample_rows:
        share = int((1 << 30) * sample_rows / total)
        labelled = labelled.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < share)
    joined = statistics.where(~base_failed()).join(labelled, F.col(id_col) == F.col("__id"))
    table = joined.select(F.col("__label").cast("int").alias("label"), *[feature(n).alias(n) for n in FEATURES]).toArrow()
    order = np.lexsort([table.column(n).to_numpy() for n in ("label", *FEATURES)])
    values = {n: table.column(n).to_numpy()[order] for n in FEATURES}
    return learn_rules(values, table.column("label").to_numpy()[order] == 0)


def verdict(rules: list[Rule]) -> Column:
    """True unless a rule holds; the rules are tried in order."""
    if not rules:
        return F.lit(True)
    result = F.when(rules[0].column(), False)
    for rule in rules[1:]:
        result = result.when(rule.column(), False)
    return result.otherwise(True)


def judge(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """``statistics`` with ``base_failed`` and ``kept``."""
    judged = statistics.withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules))
