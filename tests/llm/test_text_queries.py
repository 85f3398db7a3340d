"""The registered text queries against DuckDB or plain Python, on the smallest tables."""

from __future__ import annotations

import hashlib
import html
import os
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from __spark_entry__ import oracle_sql, queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())


def found(spark, name):
    return [row.asDict() for row in queries()[name](spark, FOLDER).collect()]


@pytest.mark.parametrize("name", ["op1_mix", "op5_preferences", "op8_decontaminate", "op9_naming"])
def test_same_rows_as_sql(spark, duck, name):
    expected = duck.sql(oracle_sql()[name])
    columns = expected.columns
    ours = sorted(tuple(row[c] for c in columns) for row in found(spark, name))
    assert ours == sorted(expected.fetchall())


def test_mix_comes_near_its_targets(spark):
    rows = found(spark, "op1_mix")
    total = sum(r["size"] for r in rows)
    by_source: dict = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert sum(rs[0]["target"] for rs in by_source.values()) == pytest.approx(1.5 * total)
    for rs in by_source.values():
        assert rs[0]["target"] <= 2 * rs[0]["source_size"]
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= max(r["size"] for r in rs)


def test_secrets_against_plain_patterns(spark, documents):
    either = "".join
    word = "|".join(
        either(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
        for w in ("password", "passwd", "secret", "token", "api_?key")
    )
    plain = {
        "assign": (re.compile(rf"({word})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 8),
        "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16),
        "hex": (re.compile("[0-9a-f]+"), 0, 32),
    }
    for row in found(spark, "op3_secrets"):
        text, spans = documents[row["doc_id"]] or "", []
        for order, (kind, (pattern, group, least)) in enumerate(plain.items()):
            hits = [m.span() for m in pattern.finditer(text) if len(m[group]) >= least]
            assert row[f"n_{kind}"] == len(hits)
            spans += [(a, order, f"{kind}:{a}:{b}") for a, b in hits]
        said = [s for _, _, s in sorted(spans)]
        assert row["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(row["spans"].split(","))


def test_main_text_against_the_article(spark, duck):
    pages = dict(duck.sql("SELECT page_id, html FROM pages").fetchall())
    rows = found(spark, "op4_main_text")
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        lines = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1)>", "\0", article.replace("<br>", " "))).split("\0")
        lines = [" ".join(html.unescape(x).split()) for x in lines]
        assert row["text"] == "\n".join(x for x in lines if x)
        assert row["n_chars"] == len(row["text"])


def test_token_counts_are_the_library_s(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = found(spark, "op6_tokens")
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    for row in rows:
        text = documents[row["doc_id"]] or ""
        assert row["n_tokens"] == len(model.encode(text, add_special_tokens=False).ids)
        assert row["n_bytes"] == len(text.encode())
        assert row["over_limit"] == (row["n_tokens"] > 512)


def test_shards_are_near_equal_and_gapless(spark, documents):
    rows = found(spark, "op7_shards")
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    sums, slots = np.zeros(24), {}
    for row in rows:
        data = (documents[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        sums[row["shard"]] += row["size"]
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert np.abs(sums.cumsum() - sums.sum() * np.arange(1, 25) / 24).max() <= max(r["size"] for r in rows)


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    if not words:
        return 0
    said = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in said]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_by_brute_force(spark, documents):
    prints = {k: plain_fingerprint(t) for k, t in documents.items()}
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = found(spark, "op10_simhash")
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        k: (f"{prints[k]:016x}", find(k)) for k in ids
    }


def test_toxicity_is_learnt(spark, duck):
    rows = {r["doc_id"]: r for r in found(spark, "op2_toxicity")}
    labels = dict(duck.sql("SELECT doc_id, toxic FROM labels").fetchall())
    for key, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3)
    clean = [k for k, toxic in labels.items() if not toxic]
    assert sum(rows[k]["predicted"] for k in clean) <= 0.02 * len(clean)


@pytest.mark.skipif(not os.path.isdir(FOLDER.replace("0.001", "0.1")), reason="no larger tables")
def test_toxicity_of_held_out_rows(spark):
    folder = FOLDER.replace("0.001", "0.1")
    scored = queries()["op2_toxicity"](spark, folder).where("held_out")
    rows = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    above = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / len(toxic) / len(clean)
    assert above >= 0.8
    assert sum(s >= 0.3 for s in clean) <= 0.02 * len(clean)
