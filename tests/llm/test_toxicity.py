"""Restoration and learning against plain versions: every lattice path, unpruned scores, edge texts."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import toxicity
from tallyhouse.llm.toxicity import BEGINNINGS, Restorer, decode, features, features_among, single, starts_of

LETTERS = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(7)
    counts = rng.gamma(0.3, size=(27, 27, 27))
    return np.log(counts / counts.sum(2, keepdims=True) + 1e-6)


def weight(path, token, model):
    """Log probability of one choice of options, letter by letter."""
    score, a, b, said = 0.0, 0, 0, ""
    for letter, cost in path:
        score += cost
        if letter < 0:
            if not b:
                return -math.inf, ""
            score, a, b, said = score + model[a][b][0], b, 0, said + " "
        elif letter:
            score, a, b, said = score + model[a][b][letter], b, letter, said + chr(96 + letter)
    return score + model[a][b][0], said


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("abio01!$@" + toxicity._GAP + toxicity._JOINT)), min_size=1, max_size=7))
def test_viterbi_finds_the_best_of_all_paths(model, token):
    lists = model.tolist()
    paths = itertools.product(*toxicity._options(token))
    best = max(weight(path, token, lists)[0] for path in paths)
    found = decode(token, lists)
    reached = [weight(p, token, lists) for p in itertools.product(*toxicity._options(token))]
    assert max(score for score, said in reached if said == found) == pytest.approx(best)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("abcll")), min_size=1, max_size=14))
def test_pairs_in_closed_form_are_viterbi_s(model, word):
    if toxicity._LONGER.search(word):
        return
    assert single(word, model.tolist()) == decode(word, model.tolist())


def test_pruned_words_hold_no_feature(model):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdelost") for _ in range(rng.randrange(1, 8))) for _ in range(4000)]
    signs = {"a": "@4", "e": "3", "o": "0", "s": "$5", "l": "|1", "t": "7+"}
    noisy = ["".join(rng.choice(signs[c]) if c in signs and rng.random() < 0.2 else c * rng.choice((1, 1, 1, 2, 3, 5)) for c in w) for w in words]
    text = " ".join(w + rng.choice(("", "", ",", ".", "!", "?", "é")) for w in words + noisy + [w.upper() for w in words[:500]])
    restored = Restorer(model, features)
    every = sorted({f for token in set(restored.tokens(text)) for f in restored.token(token)})
    for size in (1, 5, 60, 400):
        bounds = {f: 0.9 for f in rng.sample(every, size)}
        plain = toxicity._held(Restorer(model, features_among(bounds)), text)
        assert plain == set(bounds)
        assert toxicity._held(Restorer(model, features_among(bounds)), text, starts_of(bounds)) == plain


def test_starts_are_all_letters_that_lead_to_a_head():
    bounds = {"abba": 0.9, "lo": 0.9, "cab*": 0.9, "idio*": 0.9}
    starts = starts_of(bounds)
    for word in map("".join, itertools.product("abl", repeat=4)):
        runs = [(c, len(list(g))) for c, g in itertools.groupby(word)]
        reach = {"".join(c * k for (c, _), k in zip(runs, ks, strict=True)) for ks in itertools.product(*(range(1, n + 1) for _, n in runs))}
        leads = any("abba"[: len(x)] == x for x in reach)
        assert not leads or word in starts
    assert {"lo", "llo", "loo", "lloo", "looo", "lllo", "idio", "iidi"} <= starts and min(BEGINNINGS) == 4


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    own = lambda: " ".join("".join(rng.choice("rnaeitsd") for _ in range(5)) for _ in range(12))
    docs = [(k, own() + (f" you {rng.choice(('clown', 'scum', 'clown and scum', 'c1own'))}" if k % 5 == 0 else " nice day and you")) for k in range(600)]
    labels = [(k, 1, int(k % 5 == 0)) for k in range(600)]
    schema = "doc_id long, text string"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_insults_that_come_together_are_all_learnt(spark, tables):
    fitted = toxicity.learn(*tables)
    assert {"clown", "scum"} <= set(fitted.bounds)
    edges = [(1, "clown"), (2, "such scum!"), (3, "CLOWN."), (4, "a nice day for you"), (5, None), (6, ""), (7, " \t\n"),
             (8, "prose " * 200_000), (9, "prose " * 200_000 + "cloown"), (10, "c l o w n"), (11, "s.c.u.m"), (11, "s.c.u.m"),
             (None, "clown")]
    frame = spark.createDataFrame([(k, x, "clash") for k, x in edges], "doc_id long, text string, score string")
    got = frame.select("doc_id", fitted.score(F.col("text")).alias("p")).collect()
    toxic = {r["doc_id"] for r in got if r["p"] >= toxicity.THRESHOLD}
    assert toxic == {1, 2, 3, 9, 10, 11, None}
    empty = {r["p"] for r in got if r["doc_id"] in (4, 5, 6, 7, 8)}
    assert len(empty) == 1 and empty.pop() == pytest.approx(fitted.base) and len(got) == len(edges)


def test_scores_follow_from_the_features_of_the_restored_text(spark, tables):
    docs, labels = tables
    fitted = toxicity.learn(docs, labels)
    restore = Restorer(fitted.model)
    for row in docs.select("text", fitted.score(F.col("text")).alias("p")).limit(200).collect():
        held = {f for token in set(restore.tokens(row["text"])) for f in features(restore.token(token)) if f in fitted.bounds}
        left = 1 - fitted.base
        for f in sorted(held):
            left *= 1 - fitted.bounds[f]
        assert row["p"] == pytest.approx(1 - left)


def test_tables_without_labels_or_rows(spark, tables):
    docs, labels = tables
    none = toxicity.learn(docs, labels.where("toxic > 5"))
    assert docs.select(none.score(F.col("text")).alias("p")).agg(F.max("p")).first()[0] == 0
    empty = docs.where("doc_id < 0")
    assert toxicity.drop_toxic(empty, labels).collect() == []
    assert toxicity.learn(empty, labels).bounds == {}
