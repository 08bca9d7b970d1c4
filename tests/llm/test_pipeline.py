"""Every stage of the pipeline against a brute-force version, on what the stage before has kept."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from churnspark.llm.queries import tokenizer_path
from churnspark.runtime import materialize

from .conftest import SHARED, TABLE, sentence
from .test_text_operators import brute_components, brute_lines, brute_mix

COLUMNS = ["doc_id", "text", "lang", "source"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Two languages with letters of their own, copies, near copies, shared lines, junk, nulls."""
    greek = str.maketrans("abcdefghinorstu", "αβγδεζηθικλμνξο")
    rows = []
    for i in range(120):
        text = sentence(i, 30 + i % 40)
        rows.append((i, text.translate(greek) if i % 3 == 0 else text, "gr" if i % 3 == 0 else "en", f"s{i % 4}"))
    rows += [(200 + i, sentence(1, 31), "en", "hot") for i in range(40)]
    rows += [(300 + i, sentence(2, 60) + f" tail{i}", "en", "hot") for i in range(10)]
    rows += [(400 + i, f"{sentence(40 + i, 20)}\n{SHARED}\n{SHARED.upper()}", "en", None) for i in range(5)]
    rows += [(500, None, None, "s1"), (501, "", "en", "s1"), (502, "1234 !!! 99", "en", "s2"), (503, sentence(9, 3000), None, "s2")]
    full = [(i, t, lang, s, len(t or ""), "k", 0, "c") for i, t, lang, s in rows]
    return spark.createDataFrame(full, TABLE).repartition(4)


def plain(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_stages_match_brute_force(spark, corpus):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    kept = {}
    docs = corpus
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, ""), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == before.columns

    # Language: what has no letter goes, clean documents stay.
    language = plain(kept["language_id"])
    have = {i for i, t, _, _ in plain(corpus) if any(c.isalpha() for c in t or "")}
    assert {i for i, *_ in language} == have

    lines = {i: text for i, _, _, text in brute_lines([(i, t) for i, t, _, _ in language])}
    got = plain(kept["line_dedup"])
    assert {i: t for i, t, _, _ in got} == lines
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"].collect())

    components = brute_components([(i, t) for i, t, _, _ in got], 5, 80)
    single = plain(kept["near_dedup"])
    assert sorted(i for i, *_ in single) == sorted(i for i, (_, _, keep) in components.items() if keep)
    assert set(single) <= set(got)

    size, own, target = brute_mix([(i, t, s) for i, t, _, s in single])
    mixed = Counter(plain(kept["mixing"]))
    assert set(mixed) <= set(single) and max(mixed.values()) <= 2
    place = {i: k for k, (i, *_) in enumerate(single)}
    for source in own:
        taken = sum(n * size[place[r[0]]] for r, n in mixed.items() if r[3] == source)
        assert abs(taken - target[source]) <= max(s for r, s in zip(single, size.values()) if r[3] == source)

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    tokens = sum(n * (len(library.encode(r[1], add_special_tokens=False).ids) + 1) for r, n in mixed.items())
    packed = kept["packing"].collect()
    assert sum(r["length"] for r in packed) == tokens
    spans = Counter()
    for r in packed:
        spans[r["sequence_id"]] += r["length"]
    assert max(spans.values()) <= 1024 and len(spans) <= tokens // 1024 + 3


def test_pipeline_runs_over_files(spark, corpus, tmp_path):
    corpus.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(result.columns)
    assert result.count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_rows_are_reduced_whatever_their_ids(spark):
    """Repeated ids with different texts are two documents; rows without id are copies like others."""
    one, two, three = sentence(1, 60), sentence(2, 60), sentence(3, 60)
    rows = [
        (1, one, "en", "a"), (1, two, "en", "a"), (1, one, "en", "b"), (2, one + " more", "fr", "a"), (None, one, "en", "a"),
        (None, one, "en", "a"), (None, three, "en", "a"), (None, three + " tail", "en", None), (3, None, None, None),
        (3, None, None, None), (None, "", "en", "a"), (None, "", "en", "a"), (7, three, "en", "a"),
    ]
    full = [(i, t, lang, s, len(t or ""), "k", 0, "c") for i, t, lang, s in rows]
    docs = spark.createDataFrame(full, TABLE).repartition(4)
    kept = plain(corpus_pipeline.near_duplicate_stage(spark, docs, ""))
    assert Counter(r[:2] for r in kept) == {(1, one): 1, (1, two): 1, (7, three): 1, (3, None): 2, (None, ""): 2}
    alone = plain(corpus_pipeline.near_duplicate_stage(spark, docs.where("doc_id is null"), ""))
    assert Counter(r[:2] for r in alone) == {(None, one): 1, (None, min(three, three + " tail", key=_sha)): 1, (None, ""): 2}


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_stages_take_an_empty_table(spark, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), name)
        assert docs.count() == 0
