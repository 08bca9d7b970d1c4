"""Each operator against a brute-force version, on rows with nulls, copies, ties and long texts."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnspark.llm import (
    chat_format, class_model, fingerprints, kneser_ney, language_id, line_dedup, mixing, packing, quality_rules, tokens,
)
from churnspark.llm.blocks import to_blocks
from churnspark.llm.components import connected_components
from churnspark.llm.near_dedup import linked_pairs, near_duplicates
from churnspark.llm.queries import tokenizer_path
from churnspark.llm.superminhash import signatures

from .conftest import EDGES, lowered, sentence, words

BLANKS = " \t\n\x0b\x0c\r"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# --- lines ------------------------------------------------------------------------------------------


def brute_lines(documents):
    holders = defaultdict(set)
    for i, text in documents:
        for line in (text or "").split("\n"):
            key = lowered(line.strip(BLANKS))
            if len(key) >= 20:
                holders[key].add(-1 if i is None else i)
    found = []
    for i, text in documents:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            own = holders.get(lowered(line.strip(BLANKS)), ())
            if len(own) < 3 or max(own) == (-1 if i is None else i):
                kept.append(line)
        found.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("share_rows", [500_000, 2])
def test_lines_match_brute_force(edges, share_rows):
    marked = line_dedup.with_bitmaps(edges, line_dedup.line_keep_bitmaps(edges, share_rows=share_rows))
    got = rows(
        marked, "doc_id", line_dedup.line_count(F.col("text")), "__n_dropped",
        line_dedup.kept_text(F.col("text"), F.col("__keep")),
    )
    assert sorted(got, key=repr) == brute_lines([(i, t) for i, t, _, _ in EDGES])


def test_many_lines_cross_bitmap_blocks(spark):
    shared = [f"this is the shared line number {i}" for i in range(300)]
    texts = [(1, "\n".join(shared)), (2, "\n".join(shared[::3])), (3, "\n".join(shared[::2] + ["own"]))]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    got = dict(rows(line_dedup.dedup_lines(df), "doc_id", "text"))
    assert {i: t for i, _, _, t in brute_lines(texts)} == got


def test_lines_keep_columns_and_empty_tables(edges, nothing):
    assert line_dedup.dedup_lines(edges).columns == edges.columns
    assert line_dedup.dedup_lines(edges).count() == len(EDGES)
    assert line_dedup.dedup_lines(nothing).count() == 0


# --- near duplicates ----------------------------------------------------------------------------------


def brute_components(documents, width, percent):
    sets = {}
    for i, text in documents:
        w = words(lowered(text))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def near_family():
    """A base text and copies with more and more changed words, chains and a group of exact copies."""
    base = sentence(1, 120).split()
    texts = []
    for i in range(60):
        own = list(base)
        for k in range(i % 12):
            own[(i * 37 + k * 11) % 120] = f"x{i}y{k}"
        texts.append(" ".join(own))
    texts += [sentence(2, 30)] * 20 + [sentence(i, 40) for i in range(3, 30)] + ["one two", "one two", "One TWO", "", None]
    return [(100 - i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_match_brute_force(spark, width, monkeypatch):
    from churnspark.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK_DOCUMENTS", 16)  # several blocks for one group
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", 10)  # texts joined by a shuffle
    documents = near_family()
    df = spark.createDataFrame(documents, "doc_id bigint, text string")
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(df, width=width).collect()}
    assert got == brute_components(documents, width, 80)


def test_near_duplicates_on_edges(edges, nothing):
    got = rows(near_duplicates(edges), "doc_id", "component_id", "kept")
    assert len(got) == len(EDGES)
    by_id = {i: (c, k) for i, c, k in got if i is not None}
    assert by_id[9] == (8, False) and by_id[10] == (8, False) and by_id[4] == (4, True) and by_id[5] == (5, True)
    assert all(k for i, _, k in got if i is None)
    assert near_duplicates(nothing).count() == 0


def test_signatures_estimate_likeness():
    random_ = np.random.default_rng(3)
    for size in (1, 5, 60, 900):
        left = np.unique(random_.integers(0, 1 << 62, size).astype(np.uint64))
        right = np.unique(np.concatenate([left[: size * 9 // 10], random_.integers(0, 1 << 62, size // 10 + 1).astype(np.uint64)]))
        both = signatures(np.concatenate([left, right]), np.repeat([0, 1], [len(left), len(right)]), 2, 200)
        true = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
        assert abs((both[0] == both[1]).mean() - true) < 0.12
        assert (signatures(left, np.zeros(len(left), int), 1, 200)[0] == both[0]).all()
    assert linked_pairs([left, left[::1], right], np.zeros(3), 80)[0] == (0, 1)


def test_components_of_chain_star_and_loop(spark):
    edges_ = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = dict(rows(connected_components(spark.createDataFrame(edges_, "l int, r int"), "l", "r"), "node", "component"))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "l int, r int"), "l", "r").count() == 0


# --- fingerprints -------------------------------------------------------------------------------------


def test_edited_texts_and_likeness(edges):
    # Equal ids follow by text, a null text counts as empty, rows without id come last.
    ordered = sorted(((i, t or "") for i, t, _, _ in EDGES), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = []
    for place, (i, text) in enumerate(ordered):
        following = ordered[(place + 1) % len(ordered)][1]
        half = len(text) // 2
        want.append((i, len(text), text[: len(text) - half] + following[:half]))
    got = fingerprints.edited_pairs(edges).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["near_edited"] == pytest.approx(_jaccard(r["sketch"], r["edited_sketch"]))
    sketches = {r["doc_id"]: r["sketch"] for r in got}
    assert sketches[8] == sketches[9] and sketches[4] == [] and len(sketches[12]) == 1
    assert 0.09 < len(sketches[7]) / 6000 < 0.16


def _jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


@pytest.mark.parametrize("blocks", [1, 3, 50])
def test_successors_across_ranges(spark, blocks):
    docs = spark.createDataFrame([(i * i, f"t{i}") for i in range(40)], "id bigint, text string").repartition(5)
    got = dict(rows(fingerprints.with_next_text(docs, blocks).where("not extra"), "text", "next_text"))
    assert got == {f"t{i}": f"t{(i + 1) % 40}" for i in range(40)}


def test_sketches_merge_and_contain(spark):
    a, b = sentence(1, 400), sentence(2, 50)
    df = spark.createDataFrame([(a, b, f"{b} {a}")], "a string, b string, both string")
    s = [fingerprints.sketch(F.col(c)) for c in ("a", "b", "both")]
    merged = fingerprints.merged(s[0], s[1])
    inside, across = df.select(fingerprints.containment(s[1], s[2]), fingerprints.resemblance(merged, s[2])).first()
    assert inside > 0.8 and across > 0.8


def test_fingerprints_of_an_empty_table(nothing):
    assert fingerprints.edited_pairs(nothing).count() == 0


# --- chats --------------------------------------------------------------------------------------------


def test_chats_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "<turn user>", "\\s\\l\\g <image 1> >", "", None, "\\", "a\nb</turn>"]
    messages = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate(zip(["user", "assistant", "ro>le"] * 3, nasty))]
    messages += [(5, None, None, "no turn"), (5, 1, "assistant", "same"), (5, 1, "assistant", "same"), (5, 1, "assistant", "also")]
    df = spark.createDataFrame(messages, "conv_id int, turn int, role string, text string").repartition(3)
    chats = chat_format.format_chats(df.withColumn("parts", chat_format.text_parts(F.col("text"))))
    read = chats.select(
        "conv_id", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "attachments", "n_tokens",
    ).collect()
    assert len(read) == 3
    for conversation, turns, loss, attachments, n_tokens in read:
        own = sorted((m[1:] for m in messages if m[0] == conversation), key=lambda m: (m[0] is not None, m[0] or 0, m[1] or "", m[2] or ""))
        assert [tuple(t) for t in turns] == [(r or "", x or "") for _, r, x in own]
        assert loss == "".join(x or "" for _, r, x in own if r == "assistant")
        assert attachments == [] and n_tokens == sum(len(words(x)) for _, _, x in own)


def test_typed_parts_become_numbered_placeholders(spark):
    parts = [("text", "see <this>", None, None), ("image", None, "s3://a.png", 4), ("audio", None, "b.wav", None), None]
    later = [("document", "ignored", "c.pdf", 2), ("text", "and that", None, None), ("odd", "kept", "z", 9)]
    df = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", later), (2, 0, "user", None)],
        f"conv_id int, turn int, role string, parts array<{chat_format.PART}>",
    )
    got = {r["conv_id"]: r for r in chat_format.format_chats(df).collect()}
    assert got[1]["formatted"] == (
        "<turn user>see \\lthis\\g<image 1><audio 2></turn><turn assistant><document 3>and thatkept</turn>"
    )
    assert [tuple(a) for a in got[1]["attachments"]] == [
        (1, "image", "s3://a.png", 1024), (2, "audio", "b.wav", 25), (3, "document", "c.pdf", 1024),
    ]
    assert got[1]["n_tokens"] == 2 + 1024 + 25 + 1024 + 3
    assert got[2]["formatted"] == "<turn user></turn>"
    assert chat_format.format_chats(df.where("false")).count() == 0


# --- packing ------------------------------------------------------------------------------------------


def test_ids_equal_the_library(edges):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    texts = [t for _, t, _, _ in EDGES] + ["it's 'tis we'll  don't\n\n  x ''s 'S <|endoftext|>", "a  b c", "\x1c\x1d 1½²"]
    texts += ["abc <|endoftext|> def", "<|endoftext|><|endoftext|>'s", "<|endof", "text|> é<|endoftext|>é", " <|endoftext|", ">"]
    assert library.encode(texts[-6], add_special_tokens=False).ids == [39305, 220, 50256, 825]
    found = [ids[o[i] : o[i + 1]].tolist() for a, b, ids, o in tokens.token_ids(pa.array(texts), tokenizer_path()) for i in range(b - a)]
    assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_pieces_and_sequences(edges, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    pieces, places = packing.pack_documents(edges, tokenizer_path(), end_id=2, capacity=64)
    got = places.collect()
    whole = sorted((library.encode(t or "", add_special_tokens=False).ids + [2] for _, t, _, _ in EDGES), key=len)
    assert sum(r["length"] for r in got) == sum(map(len, whole))
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in held.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end <= 64
    assert len(held) <= math.ceil(sum(map(len, whole)) / 64) + 2
    for r in pieces.where("doc_id = 7").collect():
        ids = whole[-1][r["start"] : r["start"] + r["length"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["length"] == 64 or r["piece"] == 0
    crc = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in got}
    first = whole[-1][: len(whole[-1]) % 64 or 64]
    assert crc[(7, 0)] == zlib.crc32(np.array(first, "<u4").tobytes())
    assert packing.pack_documents(nothing, tokenizer_path(), 2)[1].count() == 0


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_open_bins_are_best_fit(limit):
    random_ = np.random.default_rng(limit)
    bins, free, open_ = packing.OpenBins(100, limit), {}, set()
    for length in random_.integers(1, 101, 600).tolist():
        fitting = [s for s in open_ if free[s] >= length]
        best = min((free[s] for s in fitting), default=None)
        sequence, offset = bins.place(length)
        if best is None:
            assert offset == 0 and sequence not in free
            free[sequence] = 100
        else:
            assert sequence in fitting and free[sequence] == best
        assert offset == 100 - free[sequence]
        open_.discard(sequence)
        free[sequence] -= length
        if free[sequence]:
            if len(open_) >= limit:
                fullest = min(free[s] for s in open_)
                still = {s for held in bins.by_space for s in held}
                closed = open_ - still
                assert len(closed) == 1 and free[closed.pop()] == fullest
                open_ &= still
            open_.add(sequence)


# --- mixing -------------------------------------------------------------------------------------------


def brute_mix(documents):
    size = {k: len(words(t)) for k, (_, t, _) in enumerate(documents)}
    sources = sorted({s for _, _, s in documents}, key=lambda s: (s is None, s or ""))
    total, weight, own = sum(size.values()), {}, defaultdict(int)
    for k, (_, _, s) in enumerate(documents):
        own[s] += size[k]
    for place, s in enumerate(sources):
        weight[s] = (5, 2, 1)[place % 3]
    full, target = set(), {}
    while True:
        left = 1.5 * total - sum(2 * own[s] for s in full)
        rest = [s for s in sources if s not in full]
        for s in rest:
            target[s] = left * weight[s] / sum(weight[r] for r in rest)
        above = {s for s in rest if target[s] > 2 * own[s]}
        if not above:
            break
        full |= above
        target.update({s: 2.0 * own[s] for s in above})
    return size, own, target


def test_mixture_reaches_its_targets(spark, edges, nothing):
    documents = [(i, sentence(i, 5 + i % 50), f"s{i % 7}" if i % 11 else None) for i in range(400)]
    documents += [(1000 + i, sentence(i, 30), "s1") for i in range(600)]  # a hot source
    df = spark.createDataFrame(documents, "doc_id bigint, text string, source string").repartition(7)
    size, own, target = brute_mix(documents)
    got = mixing.mixture(df).collect()
    taken = defaultdict(int)
    for r in got:
        k = r["doc_id"] if r["doc_id"] < 1000 else r["doc_id"] - 600
        assert (r["size"], r["source_size"]) == (size[k], own[r["source"]])
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - target[s]) <= 60
    again = mixing.mixture(df.repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    on_edges = mixing.mixture(edges).collect()
    assert len(on_edges) == len(EDGES) and all(r["taken"] <= 2 * r["size"] for r in on_edges)
    assert mixing.mixture(nothing).count() == 0


def test_thresholds_are_nested_and_exact(spark):
    random_ = np.random.default_rng(4)
    data = [("a", int(h), int(s)) for h, s in zip(random_.integers(0, 1 << 60, 300), random_.integers(0, 9, 300))]
    sized = spark.createDataFrame(data, "source string, hash bigint, size bigint")
    before = -1
    for budget in (0.0, 10.0, 200.5, 5000.0):
        cut = mixing.thresholds(sized, spark.createDataFrame([("a", budget)], "source string, budget double")).first()["below"]
        assert cut >= before
        before = cut
        inside = sum(s for _, h, s in data if h < cut)
        assert abs(inside - min(budget, sum(s for _, _, s in data))) <= 4.5


# --- quality rules ------------------------------------------------------------------------------------


def test_statistics_match_brute_force(edges, nothing):
    def brute(text):
        w = words(text)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        seen, repeated = set(), 0
        for line in (text or "").split("\n"):
            if words(line):
                repeated += line in seen
                seen.add(line)
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered), len(set(w))

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words")
    got = rows(quality_rules.with_statistics(edges), "doc_id", *names)
    assert sorted(got, key=repr) == sorted(((i, *brute(t)) for i, t, _, _ in EDGES), key=repr)
    assert quality_rules.with_statistics(nothing).count() == 0


def test_repeated_windows_and_lines(spark):
    text = "a b c a b c d\nx\nx\n \n \na b c"
    got = quality_rules.with_statistics(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert (got["n_repeat_words"], got["n_dup_lines"], got["n_words"]) == (9, 1, 12)


def test_rules_learn_and_become_columns(spark):
    random_ = np.random.default_rng(6)
    n = 2000
    values = {name: random_.random(n) for name in quality_rules.FEATURES}
    bad = (values["symbols_per_word"] >= 0.9) | ((values["upper_share"] >= 0.8) & (values["word_length"] < 0.3))
    rules = quality_rules.learn_rules(values, bad)
    caught = np.zeros(n, bool)
    for rule in rules:
        caught |= rule.holds(values)
    assert (caught & bad).sum() / bad.sum() > 0.9 and (caught & ~bad).sum() / n < 0.02
    assert quality_rules.learn_rules(values, np.zeros(n, bool)) == []
    table = spark.createDataFrame([(100, 10)], "n_words long, n_symbols long")
    rule = quality_rules.Rule([("symbols_per_word", True, 0.1)])
    assert table.select(quality_rules.verdict([rule]), quality_rules.verdict([])).first() == (False, True)


def test_rules_without_labels(edges):
    counted = quality_rules.with_statistics(edges)
    none = edges.select("doc_id", F.lit(None).cast("int").alias("quality"))
    assert quality_rules.train_rules(counted, none) == []
    assert quality_rules.judge(counted, []).where("kept").count() == 5  # those with 50 words


# --- language -----------------------------------------------------------------------------------------


def test_languages_are_told_apart(spark, edges, nothing):
    alphabets = {"aa": "abcdefg ", "bb": "hijklmn ", "cc": "αβγδεζ "}
    random_ = np.random.default_rng(1)
    texts = [
        (i, "".join(random_.choice(list(letters), 80)), lang)
        for lang, letters in alphabets.items() for i in range(60)
    ]
    df = spark.createDataFrame(texts, "doc_id int, text string, lang string").repartition(3)
    model = language_id.train(df)
    found = language_id.identify(df, model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) == 1.0
    assert np.mean([r["lang_rejected"] for r in found]) < 0.02
    assert (language_id.train(df.repartition(5)).table == model.table).all()

    got = language_id.identify(edges, model)
    assert got.columns[: len(edges.columns)] == edges.columns and got.count() == len(EDGES)
    for r in got.collect():
        assert 0 <= r["lang_score"] <= 1
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["lang_score"], r["lang_rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in alphabets
    empty = language_id.train(nothing)
    assert {r["lang_pred"] for r in language_id.identify(edges, empty).collect()} == {"und"}
    assert language_id.identify(nothing, model).count() == 0


@pytest.mark.parametrize("known", [["aa"], ["aa", "bb"], ["aa", "bb", "cc"]])
def test_unlearned_languages_are_rejected(spark, known):
    syllables = {"aa": "ka to mi re su la", "bb": "pol dren vis gort hap lum", "cc": "αβ γδ εζ ηθ ικ λμ", "dd": "wx qu yj zz xo jy", "ee": "жы ща рю ло ти на"}
    random_ = np.random.default_rng(4)

    def text(lang):
        return " ".join("".join(random_.choice(syllables[lang].split(), random_.integers(1, 4))) for _ in range(random_.integers(15, 60)))

    learned = [(i, text(lang), lang) for lang in known for i in range(80)]
    model = language_id.train(spark.createDataFrame(learned, "doc_id int, text string, lang string"))
    asked = [(i, text(lang), lang) for lang in [*known, "dd", "ee"] for i in range(60)]
    found = language_id.identify(spark.createDataFrame(asked, "doc_id int, text string, lang string"), model).collect()
    strange = [r["lang_rejected"] for r in found if r["lang"] in ("dd", "ee")]
    clean = [r["lang_rejected"] for r in found if r["lang"] in known]
    assert np.mean(strange) > 0.98 and np.mean(clean) < 0.02


# --- language models ----------------------------------------------------------------------------------


def test_class_model_base_and_mass(spark, edges, nothing):
    documents = [(i, t, lang) for i, t, lang, _ in EDGES]
    marked = edges.withColumn("train", F.coalesce(F.col("doc_id") % 3 != 1, F.lit(True)))
    got = class_model.score_texts(marked, "train", classes=4, contexts=8, rounds=2).collect()
    tokens_of = [(i, [*words(lowered(t)), "\n"], i is None or i % 3 != 1) for i, t, _ in documents]
    counts = Counter(w for _, ws, train in tokens_of if train for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, ws, train in tokens_of:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        want.append((i, train, len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 6)))
    assert sorted(((*r[:5], round(r[5], 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["score"] < 0 for r in got)
    assert class_model.score_texts(nothing.withColumn("train", F.lit(True)), "train").count() == 0
    untrained = class_model.score_texts(edges.withColumn("train", F.lit(None).cast("boolean")), "train")
    assert untrained.agg(F.sum("n_known"), F.count("*")).first() == (0, len(EDGES))


def test_class_model_beats_word_frequencies(spark):
    random_ = np.random.default_rng(2)
    texts = []
    for i in range(300):
        vocabulary = [f"{'pq'[i % 2]}{k}" for k in range(40)]  # two kinds of text with words of their own
        texts.append((i, " ".join(random_.choice(vocabulary, 60)), i % 5 != 1))
    df = spark.createDataFrame(texts, "doc_id int, text string, train boolean")
    held = class_model.score_texts(df, "train", classes=8, contexts=16).where("not train").collect()
    assert all(r["score"] > r["base_score"] + 10 for r in held)


def test_classes_follow_the_real_neighbours(spark):
    # Frequent words stand on both sides of no kind word: only rare neighbours tell the kinds apart.
    random_ = np.random.default_rng(3)
    texts = []
    for i in range(1200):
        kind = "pq"[i % 2]
        inner = [f"{kind}{side}{random_.integers(100)}" for _ in range(8) for side in "lr"]
        texts.append((i, " ".join(["the"] * 3 + inner + ["of"] * 3), True))
    df = spark.createDataFrame(texts, "doc_id int, text string, train boolean").repartition(3)
    blocks = to_blocks(df.select("text", "train"))
    found = []
    for hot_words in (1 << 20, 200, 0):  # all looked up, about half, all by the join
        lexicon, _ = class_model.cluster(blocks, 8, 16, 6, hot_words)
        found.append({r["word"]: r["class"] for r in lexicon.where("n > 1").collect()})
    assert found[0] == found[1] == found[2]
    vocabulary = " ".join(f"{kind}{side}{k}" for kind in "pq" for side in "lr" for k in range(100))
    hashes = class_model._tokens(pa.array([vocabulary]))[0][:400].view(np.int64).tolist()
    kinds = Counter((found[0][word], at // 200) for at, word in enumerate(hashes) if word in found[0])
    assert sum(max(kinds[c, 0], kinds[c, 1]) for c in range(8)) > 0.9 * sum(kinds.values())


def brute_class_scores(lexicon, documents, classes, smoothing=5.0):
    """Scores of a class bigram model with the given classes, by its definition."""
    counts = Counter(w for _, ws, train in documents if train for w in ws)
    once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
    held = Counter()
    for w, n in counts.items():
        held[lexicon.get(w, classes)] += n
    unseen = (once + 0.5) / (once + 0.5 + (2 * (twice + 0.5) if once else 0.0))
    rare_word = (1 - unseen) / max(once, 1)

    def group(w):
        return lexicon[w] if counts[w] > 1 else classes

    pairs = Counter()
    for _, ws, train in documents:
        if train:
            pairs.update(zip([classes + 1, *map(group, ws[:-1])], map(group, ws)))
    size = classes + 1
    after = [sum(n for (_, c), n in pairs.items() if c == k) for k in range(size)]
    total = sum(after)
    share = [(n + 0.5) / (total + 0.5 * size) for n in after]
    found = []
    for i, ws, _ in documents:
        score, before = 0.0, classes + 1
        for w in ws:
            c = group(w)
            row = sum(n for (b, _), n in pairs.items() if b == before)
            score += math.log10((pairs[before, c] + smoothing * share[c]) / (row + smoothing))
            score += math.log10(unseen if not counts[w] else rare_word if counts[w] == 1 else counts[w] / held[c])
            before = c
        found.append((i, round(score, 6)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("hot_words", [1 << 20, 6, 0])
def test_class_scores_match_brute_force(spark, edges, hot_words):
    documents = [(i, t, i is None or i % 3 != 1) for i, t, _, _ in EDGES]
    # Words that the texts share, so that there is something to exchange.
    documents += [(100 + i, " ".join(f"{'ab'[i % 2]}{(i * k) % 5}" for k in range(1, 9)), i % 4 > 0) for i in range(30)]
    df = spark.createDataFrame(documents, "doc_id int, text string, train boolean").repartition(3)
    got = class_model.score_texts(df, "train", classes=4, contexts=6, rounds=2, hot_words=hot_words).collect()
    blocks = to_blocks(df.select("text", "train"))
    table, model = class_model.cluster(blocks, 4, 6, 2, hot_words)
    assert all(b > a for a, b in zip(model.history, model.history[1:]))
    by_hash = {r["word"]: r["class"] for r in table.where("n > 1").collect()}
    split = [(i, [*words(lowered(t)), "\n"], train) for i, t, train in documents]
    names = sorted({w for _, ws, _ in split for w in ws} - {"\n"})
    hashes = class_model._tokens(pa.array(names))[0][::2].view(np.int64).tolist()
    lexicon = {w: by_hash[h] for w, h in zip(names, hashes) if h in by_hash}
    lexicon["\n"] = by_hash[int(np.array([class_model._END]).view(np.int64)[0])]
    want = brute_class_scores(lexicon, split, 4)
    assert sorted(((r["doc_id"], round(r["score"], 6)) for r in got), key=repr) == want


def test_likelihood_is_that_of_the_class_bigrams(spark):
    random_ = np.random.default_rng(4)
    texts = [(" ".join(f"w{random_.zipf(1.4) % 60}" for _ in range(80)), True) for _ in range(60)]
    blocks = to_blocks(spark.createDataFrame(texts, "text string, train boolean").repartition(3))
    table, model = class_model.cluster(blocks, 6, 12, 8)
    assert len(model.history) >= 3 and all(b > a for a, b in zip(model.history, model.history[1:]))
    by_hash = {r["word"]: r["class"] if r["n"] > 1 else 6 for r in table.collect()}
    pairs, left, right = Counter(), Counter(), Counter()
    for text, _ in texts:
        hashes = class_model._tokens(pa.array([text]))[0].view(np.int64).tolist()
        groups = [7, *(by_hash[h] for h in hashes)]
        for a, b in zip(groups, groups[1:]):
            pairs[a, b] += 1
    # What no move changes: pairs of two words seen once or at the beginning, and the numbers of those.
    for (a, b), n in pairs.items():
        left[a] += n
        right[b] += n
    moving = sum(n * math.log(n) for (a, b), n in pairs.items() if a < 6 or b < 6)
    fixed = sum(n * math.log(n) for side in (left, right) for k, n in side.items() if k < 6)
    assert model.history[-1] == pytest.approx(moving - fixed, rel=1e-9)


def test_hot_words_have_split_lists(spark, monkeypatch):
    texts = [(" ".join(f"the w{(i * k) % 37}" for k in range(30)), True) for i in range(60)]
    blocks = to_blocks(spark.createDataFrame(texts, "text string, train boolean").repartition(3))
    whole = {r["word"]: r["class"] for r in class_model.cluster(blocks, 4, 8, 3)[0].collect()}
    monkeypatch.setattr(class_model, "LIST_ENTRIES", 50)
    assert {r["word"]: r["class"] for r in class_model.cluster(blocks, 4, 8, 3)[0].collect()} == whole


def test_kneser_ney_is_a_distribution_and_paths_agree(edges, nothing):
    model = kneser_ney.train(edges)
    table = kneser_ney._Table(model.toArrow())
    for context in (b"\0\0\0\0", b"the ", b"zzzz", b"ine\n"):
        grams = np.array([int.from_bytes(context, "big") << 8 | s for s in range(256)], np.uint64)
        assert np.exp2(table.log2(grams)).sum() == pytest.approx(1.0)
    narrow = edges.select("doc_id", "text")
    one = rows(kneser_ney.perplexities(narrow, model), "doc_id", "perplexity")
    two = rows(kneser_ney.perplexities(narrow, model, broadcast_rows=0), "doc_id", "perplexity")
    assert sorted(one, key=repr) == sorted(two, key=repr) and len(one) == len(EDGES)
    assert kneser_ney.perplexities(nothing.select("doc_id", "text"), model).count() == 0


def test_quality_classifier_rejects_junk(spark, edges, nothing):
    good = [(i, sentence(i, 80), "en", 1) for i in range(200)]
    junk = [(1000 + i, sentence(i, 40).upper().replace(" ", "!! "), "en", 0) for i in range(20)]
    df = spark.createDataFrame(good + junk, "doc_id int, text string, lang string, quality int")
    trusted = df.where("quality = 1 and doc_id % 2 = 0")
    kept = {r["doc_id"]: r["kept"] for r in kneser_ney.classify(df, trusted).collect()}
    assert np.mean([kept[i] for i, *_ in good]) > 0.95 and not any(kept[i] for i, *_ in junk)
    assert kneser_ney.classify(edges, nothing).where("kept").count() == len(EDGES)
    assert kneser_ney.classify(nothing, edges).count() == 0


def test_queries_cover_all_operators():
    from churnspark.llm.queries import oracle_sql, queries

    names = queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert set(oracle_sql()) <= set(names)
