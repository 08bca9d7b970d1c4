"""Alignment of two tokenizers against a brute-force version with the libraries."""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from churnspark.llm import alignment, queries, tokens
from churnspark.llm.queries import tokenizer_path

from .conftest import EDGES, TABLE, sentence

ODD = [
    (901, "abc <|endoftext|> def", "en", "a"),
    (902, " ", "en", "a"),
    (903, "a▁b", "en", "a"),
    (904, "  two  spaces \n\n nl\t<s> </s> ", "en", "a"),
    (905, "Ümläute 😀 \x00 ｱ ﬁ", "en", "a"),
    (906, "x" * 3000, "en", "a"),
    (906, "x" * 3000, "en", "a"),
    (907, "the the the the " * 40, "en", "a"),
    (908, "1,2;3|4", "en", "a"),
]


def byte_entries(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in seen}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in seen)}
    return {n: bytes(letters.get(c, 63) for c in t) for t, n in tokenizer.get_vocab().items()}


@pytest.fixture(scope="module")
def brute():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    bytes_a = byte_entries(tokenizer_path())

    def piece(i):
        return bytes([i - 3]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()

    def one(text):
        if not text:
            return None
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        spelled = [[bytes_a[i] for i in a], [piece(i) for i in b]]
        if any(b"".join(s) != (" " + text).encode() for s in spelled):
            return None
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        borders = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in borders]
        for side, ids in ((0, a), (1, b)):
            for number, end in zip(ids, ends[side]):
                groups[bisect.bisect_left(borders, end)][side].append(str(number))
        links, i, j = [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            here = ends[0][i], ends[1][j]
            i, j = i + (here[0] <= here[1]), j + (here[1] <= here[0])
        return len(a), len(b), links, ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)

    def run(rows):
        parts = [(i, one(text)) for i, text in rows]
        links = Counter(p for _, x in parts if x for p in x[2])
        docs = Counter(p for _, x in parts if x for p in set(x[2]))
        best = Counter()
        for (a, b), n in links.items():
            best[b] = max(best[b], n)
        found = []
        for i, x in parts:
            if x is None:
                found.append((i, 0, 0, 0, 0, 0, 0, "", ""))
                continue
            hits = sum(links[p] == best[p[1]] for p in x[2])
            digest = hashlib.sha256(x[3].encode()).hexdigest()
            groups = x[3].count("|")
            found.append((i, x[0], x[1], groups, len(x[2]), hits, sum(links[p] for p in x[2]), digest, x[3]))
        return sorted(found, key=repr), {p: (docs[p], n, n == best[p[1]]) for p, n in links.items()}

    return run


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize(("block_bytes", "block_docs"), [(8 << 20, 1 << 16), (2000, 1 << 16), (8 << 20, 2)])
def test_documents_and_pairs_match_brute_force(spark, brute, block_bytes, block_docs):
    rows = [(i, t, lang, s, len(t or ""), "x", 1, None) for i, t, lang, s in EDGES + ODD]
    table = spark.createDataFrame(rows, TABLE).repartition(3)
    docs, pairs = alignment.align(
        table, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), texts=True, block_bytes=block_bytes, block_docs=block_docs
    )
    want_docs, want_pairs = brute([r[:2] for r in rows])
    assert sorted((tuple(r[n] for n in NAMES) for r in docs.collect()), key=repr) == want_docs
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"], r["best"]) for r in pairs.collect()} == want_pairs


def test_empty_tables_and_texts_without_tokens(spark, nothing):
    docs, pairs = alignment.align(nothing, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    assert docs.count() == 0 and pairs.count() == 0 and docs.columns == NAMES[:-1]
    blank = spark.createDataFrame([(1, None), (None, "")], "doc_id int, text string")
    docs, pairs = alignment.align(blank, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    assert pairs.count() == 0
    assert sorted((str(r["doc_id"]), r["n_a"], r["count_sum"], r["groups_sha256"]) for r in docs.collect()) == [
        ("1", 0, 0, ""), ("None", 0, 0, "")
    ]


def test_bitmaps_hold_their_places():
    random_ = np.random.default_rng(3)
    for documents in (1, 9, 1000, 1 << 16):
        sets = [np.unique(random_.integers(0, documents, n)) for n in (1, 5, 200, 30_000)]
        sizes = np.array([len(s) for s in sets])
        held = alignment._lists(np.concatenate(sets), sizes, documents)
        own, place = alignment._places(held, documents)
        for i, s in enumerate(sets):
            assert np.array_equal(np.sort(place[own == i]), s)
        assert np.array_equal(alignment._cardinalities(held, documents), sizes)


def test_planes_add_up_to_occurrences():
    random_ = np.random.default_rng(4)
    a, b, row = random_.integers(0, 3, 5000), random_.integers(0, 2, 5000), random_.integers(0, 40, 5000)
    found = alignment.postings(a, b, row, 40)
    keys, documents, links = alignment.pair_sums(found, 40)
    counted = Counter(zip(a.tolist(), b.tolist()))
    assert {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(n) for k, n in zip(keys, links)} == counted
    assert documents.tolist() == [40] * 6


def test_piece_ids_equal_the_library():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for _, t, _, _ in EDGES + ODD if t] + ["a  b   c ", "   ", " x", sentence(5, 400), "▁▁a ▁"]
    column = pa.array([" " + t for t in texts])
    own = tokens.encoder(path, tokens.SentenceEncoder)
    data, offsets = tokens.utf8(column)
    ids, cuts = own.encode(data, offsets)
    for i, text in enumerate(texts):
        if "▁" not in text:
            assert ids[cuts[i] : cuts[i + 1]].tolist() == library.encode(text)


def test_query_over_the_table(spark, brute):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = queries.op12_alignment(spark, "/root/testdata/sf0.001").collect()
    want, _ = brute(rows)
    assert sorted((tuple(r[n] for n in NAMES[:-1]) for r in got), key=repr) == [w[:-1] for w in want]
