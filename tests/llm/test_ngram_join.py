"""The n-gram join against all pairs of small tables, and its parts against plain versions."""

from __future__ import annotations

import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from __spark_entry__ import oracle_sql, queries
from tallyhouse.llm import ngram_join
from tallyhouse.llm.ngram_join import NgramJoin, component_ids, least_difference, pack, shingle_sets, unpack

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, doc string, sig int, n string, node int"


def plain_set(text, size):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def plain_links(sets, percent):
    keys = sorted(sets)
    return [
        (a, b)
        for i, a in enumerate(keys)
        for b in keys[i + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]


def plain_components(sets, percent):
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in plain_links(sets, percent):
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {k: find(k) for k in sets}


def mutated(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies at every distance, chains, a shared line, and texts of their own."""
    rng = random.Random(5)
    own = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, found = own(12), []
    for length in (1, 2, 3, 8, 30, 120, 400):
        for _ in range(4):
            base = own(length)
            found += [base, base, mutated(rng, base, 1), mutated(rng, base, 2), base + own(1), base[: length - length // 10]]
            chain = base
            for _ in range(5):
                chain = mutated(rng, chain, max(1, length // 60))
                found.append(chain)
    for _ in range(60):
        found.append(line + own(rng.randrange(30)))
    hub = own(200)
    found += [mutated(rng, hub, k % 5) for k in range(80)]
    said = [" ".join(words) for words in found]
    said += [None, None, "", " \t\n", "A b C", "a B c", "É é", "x" * 70_000, "x" * 70_000 + "y", "a  b c\x85d e"]
    rng.shuffle(said)
    return dict(enumerate(said))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, x, "clash", 1, "y", 2) for k, x in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 50)])
def test_components_are_those_of_all_pairs(docs, texts, size, percent):
    sets = {k: plain_set(x, size) for k, x in texts.items()}
    rows = component_ids(docs, size=size, percent=percent).collect()
    assert len(rows) == len(texts)
    assert {r["doc"]["doc_id"]: r["n"] for r in rows} == {k: len(s) for k, s in sets.items()}
    assert {r["doc"]["doc_id"]: r["component_id"] for r in rows} == plain_components(sets, percent)
    assert {r["doc"]["doc"] for r in rows} == {"clash"}


def test_small_packs_and_ranges_change_nothing(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "PACK", 200)
    monkeypatch.setattr(ngram_join, "RANGE", 1 << 10)
    sets = {k: plain_set(x, 3) for k, x in texts.items()}
    rows = component_ids(docs, size=3, percent=90).collect()
    assert {r["doc"]["doc_id"]: r["component_id"] for r in rows} == plain_components(sets, 90)


@pytest.mark.parametrize("percent", [90, 80])
def test_every_link_once_with_its_overlap(docs, texts, percent):
    join = NgramJoin(docs, size=3, percent=percent)
    sig = {r["doc"]["doc_id"]: bytes(r["sig"]) for r in join.rows.collect()}
    node = {bytes(r["sig"]): r["node"] for r in join.classes.collect()}
    one = {}
    for k in sorted(texts):
        one.setdefault(sig[k], k)
    sets = {k: plain_set(texts[k], 3) for k in one.values()}
    wanted = sorted(
        (*sorted((node[sig[a]], node[sig[b]])), len(sets[a] & sets[b])) for a, b in plain_links(sets, percent)
    )
    assert sorted(tuple(r) for r in join.links().collect()) == wanted


def test_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string"
    assert component_ids(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, None), (None, None)]
    rows += [(None, "only here and without a name")] * 2
    got = component_ids(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc"]["doc_id"] or 0, r["n"], r["component_id"] or 0) for r in got) == [
        (0, 0, 0), (0, 2, 0), (0, 2, 0), (0, 2, 7), (0, 2, 7), (3, 0, 3), (7, 2, 7), (7, 2, 7),
    ]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_same_rows_as_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS FROM '{FOLDER}/documents.parquet'")
    rows = queries()["op11_ngram_join"](spark, FOLDER).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, rows)) == sorted(duck.sql(oracle_sql()["op11_ngram_join"]).fetchall())


def test_hashes_follow_words_and_not_their_place():
    texts = ["a b c", "x a b c", None, "", "A  B\tC", "a b", "b a", "a", "é", "É", "ab c", "a bc", "z" * 200_000 + " q r"]
    sets = [s.tolist() for s in shingle_sets(pa.array(texts), 3)]
    assert sets[0] == sets[4] and set(sets[0]) < set(sets[1])
    assert sets[2] == sets[3] == []
    assert len({tuple(s) for s in sets}) == len(texts) - 2
    sliced = [s.tolist() for s in shingle_sets(pa.array(texts).slice(1, 5), 3)]
    assert sliced == sets[1:6]
    words = sorted({f"{a}{b}{c}{d}" for a in "abéxyz09" for b in "tion" for c in "ab," for d in ("", "ing", "tionsing,")})
    assert len({s[0] for s in (x.tolist() for x in shingle_sets(pa.array(words), 1))}) == len(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), unique=True), st.integers(0, 40))
def test_packed_cells_come_back(numbers, shift):
    cells = np.array(sorted({x >> shift for x in numbers}), np.uint64)
    assert unpack(*pack(cells)).tolist() == cells.tolist()


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)), st.integers(0, 60))
def test_suffix_bound_is_never_too_high(one, two, most):
    x, y = np.array(sorted(one), np.int64), np.array(sorted(two), np.int64)
    found = least_difference(x, y, most)
    assert found <= len(one ^ two) or (found > most and len(one ^ two) > most)
