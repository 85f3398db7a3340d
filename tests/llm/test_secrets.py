"""Secrets on a planted corpus: keys are reported, look-alikes are not, and spans follow from the measure."""

from __future__ import annotations

import base64
import random
import uuid

import pytest

from tallyhouse.llm import secret_scan
from tallyhouse.llm.secret_scan import NOVEL, NOVELTY, Novelty, base_spans, near_candidates, novel_spans

DICTIONARY = "\n".join(f"{a}_{b}" for a in ("user", "config", "client", "session") for b in ("name", "path", "value", "handler")).encode()


@pytest.fixture(scope="module")
def novelty():
    return Novelty(DICTIONARY)


def keys(rng, n):
    token = lambda size: base64.b64encode(rng.randbytes(size)).decode().rstrip("=")
    forms = (
        lambda: f"credential: {token(24)}", lambda: f"private_key={token(30)}", lambda: f'{{"auth": "{token(24)}"}}',
        lambda: f"Authorization: Bearer {token(33)}", lambda: f"?signature={token(27)}", lambda: f"db_pwd = {token(18)}",
        lambda: "credential: " + "".join(rng.choice("0123456789") for _ in range(24)), lambda: f"export OAUTH {token(24)}",
        lambda: f"access-key {uuid.UUID(int=rng.getrandbits(128))}",
    )
    return [forms[k % len(forms)]() for k in range(n)]


def lookalikes(rng, n):
    name = lambda: rng.choice(("user", "config", "client", "session")) + "_" + rng.choice(("name", "path", "value", "handler"))
    blob = lambda: base64.b64encode(rng.randbytes(60)).decode()
    one = lambda: uuid.UUID(int=rng.getrandbits(128))
    forms = (
        lambda: f"the author wrote {one()} in the catalogue", lambda: f'{{"author": "A", "img": "data:image/png;base64,{blob()}"}}',
        lambda: f"authors: {one()}", lambda: f"the token handler {name()}_{name()} is called", lambda: f"secret/{name()}/{name()}/{name()}",
        lambda: f"an authentic {one()}", lambda: f"auth {name()}-{name()}", lambda: f'"token_id": 7, "img": "data:font/woff;base64,{blob()}"',
    )
    return [forms[k % len(forms)]() for k in range(n)]


def test_planted_keys_are_found_and_lookalikes_are_not(novelty):
    rng = random.Random(4)
    said = lambda x: f"some prose before it\n{x}\nand some after it"
    found = [bool(base_spans(t) or novel_spans(t, base_spans(t), novelty)) for t in map(said, keys(rng, 900))]
    false = [bool(novel_spans(t, base_spans(t), novelty)) for t in map(said, lookalikes(rng, 800))]
    assert all(found)
    assert sum(false) <= 0.04 * len(false)  # all of them identifiers in snake case


def test_novel_spans_are_all_candidates_that_cost_enough(novelty):
    rng = random.Random(6)
    parts = keys(rng, 60) + lookalikes(rng, 60)
    for _ in range(60):
        text = "\n".join(rng.sample(parts, 6))
        base = base_spans(text)
        free = [(a, b) for a, b in near_candidates(text) if not any(x < b and a < y for _, x, y in base)]
        plain = len(novelty.compressor.compress(b""))
        assert plain >= 0
        wanted = []
        for a, b in free:
            before = text[max(0, a - secret_scan.CONTEXT) : a].encode()
            more = len(novelty.compressor.compress(before + text[a:b].encode())) - len(novelty.compressor.compress(before))
            if more / len(text[a:b].encode()) >= NOVELTY:
                wanted.append((NOVEL, a, b))
        assert novel_spans(text, base, novelty) == wanted


def test_tables_of_any_kind(spark):
    schema = "doc_id long, text string, spans string, doc int"
    long = "prose and words " * 60_000 + "credential: 84T/hgYQ2a9dPzvXkL0mWcRb " + "more " * 1000
    rows = [(1, long, "x", 1), (2, None, None, None), (3, "", "x", 1), (None, "db_pwd = Zx81kq03PVnm4Lr7Tt", "x", 1)] + [(4, "plain", "y", 2)] * 2
    frame = spark.createDataFrame(rows, schema)
    got = {(r["doc"]["doc_id"], r["doc"]["spans"]): len(r["spans"]) for r in secret_scan.scan(frame).collect()}
    assert got == {(1, "x"): 1, (2, None): 0, (3, "x"): 0, (None, "x"): 1, (4, "y"): 0}
    assert secret_scan.scan(frame).count() == len(rows)
    assert secret_scan.scan(spark.createDataFrame([], schema)).collect() == []
