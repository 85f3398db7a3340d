"""Alignment of two vocabularies against a plain walk over both lists of tokens."""

from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as files
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from __spark_entry__ import queries
from tallyhouse.llm import alignment

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def vocabularies():
    first = alignment.Vocabulary(files.path("byte_bpe_50k.json"), " ")
    return first, alignment.Vocabulary(files.path("piece_bpe_32k.model"))


def walked(text, first, second, one, two):
    """(A ids, B ids, links, groups) of a text, token by token."""
    a, b = (one([text])[0], two([text])[0]) if text else ([], [])
    said = b" " + (text or "").encode()
    if b"".join(first.tokens[x] for x in a) != said or b"".join(second.tokens[x] for x in b) != said:
        return [], [], [], []
    links, groups, open_a, open_b = [], [], [], []
    i = j = end_a = end_b = 0
    while i < len(a):
        links.append((a[i], b[j]))
        over_a, over_b = end_a + len(first.tokens[a[i]]), end_b + len(second.tokens[b[j]])
        if over_a <= over_b:
            open_a.append(a[i])
            i, end_a = i + 1, over_a
        if over_b <= over_a:
            open_b.append(b[j])
            j, end_b = j + 1, over_b
        if over_a == over_b:
            groups.append(",".join(map(str, open_a)) + "|" + ",".join(map(str, open_b)))
            open_a, open_b = [], []
    return a, b, links, groups


def expected(texts, vocabularies):
    first, second = vocabularies
    one, two = first.encoder(), second.encoder()
    every = {k: walked(x, first, second, one, two) for k, x in texts.items()}
    counts = Counter(link for _, _, links, _ in every.values() for link in links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return {
        k: (
            len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        )
        for k, (a, b, links, groups) in every.items()
    }


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_is_the_plain_walk(spark, vocabularies):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = queries()["op13_alignment"](spark, FOLDER).collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(rows) == len(docs)
    assert got == expected({r["doc_id"]: r["text"] for r in docs}, vocabularies)


@pytest.mark.parametrize("heavy", [1, 300, 1 << 20])
def test_pieces_and_rare_pairs_change_nothing(spark, vocabularies, heavy):
    texts = {
        1: None, 2: "", 3: " ", 4: "a", 5: "two words", 6: "two words", 7: "naïve \U0001f600 日本語 ½ \t\n x",
        8: "long " + "prose of many words, again and again 12345 " * 400, 9: "x" * 5000, 10: "<|endoftext|></s> <s>",
        11: "a b ﬁ", 12: "\0 and \x7f",
    }
    rows = [(k, x, "clash", 1, 2.0) for k, x in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc string, row int, n_a double")
    first, second = vocabularies
    found = alignment.align(docs, first, second, steps=97, heavy=heavy).collect()
    got = {r["doc"]["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found}
    assert got == expected(texts, vocabularies)
    assert all(r["doc"]["doc"] == "clash" for r in found)
    assert got[1] == got[2] == (0, 0, 0, 0, 0, 0, "")


def test_empty_table_and_nulls_only(spark, vocabularies):
    schema = "doc_id long, text string"
    assert alignment.align(spark.createDataFrame([], schema), *vocabularies).collect() == []
    rows = alignment.align(spark.createDataFrame([(None, None), (None, None)], schema), *vocabularies).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_rank_file_is_the_same_vocabulary(vocabularies):
    ranks = alignment.Vocabulary(files.path("byte_bpe_50k.tiktoken"), " ", files.PATTERN)
    assert ranks.tokens == vocabularies[0].tokens[: len(ranks.tokens)]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}!" for c in [*range(0x3000), 0xFFFD, 0x1F600, 0x2028, 0x10FFFF]]
    assert ranks.encoder()(texts) == vocabularies[0].encoder()(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.lists(st.integers(1, 4), max_size=60), st.integers(1, 20))
def test_cuts_are_those_of_the_whole_merge(first, second, steps):
    a, b = np.cumsum(first), np.cumsum(second)
    order = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    sides = np.cumsum([1 - side for _, side in order]) if order else np.zeros(0, int)
    found = alignment.cuts(a, b, steps)
    assert found[0] == (0, 0) and found[-1] == (len(a), len(b))
    for i, j in found[1:-1]:
        assert i == sides[i + j - 1] and (i + j) % steps == 0
