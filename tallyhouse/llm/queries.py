"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    alignment,
    decontaminate,
    mixing,
    naming,
    ngram_join,
    pages,
    preferences,
    secret_scan,
    sharding,
    simhash,
    tokens,
    toxicity,
    whitening,
)
from tallyhouse.llm.store import new_folder, table


def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document: weights 5, 2, 1, 150 % of all words, at most 2 passes."""
    docs = table(spark, folder, "documents")
    return mixing.mix(docs, keep=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "source", "size", "source_size", "target", "taken"
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside the held-out fold."""
    docs = table(spark, folder, "documents")
    fitted = toxicity.learn(docs, table(spark, folder, "labels"))
    return docs.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        fitted.score(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: spans of the patterns, and of novel strings near a sensitive word."""
    found = secret_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.NOVEL)
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page, by the path that its host's pages agree on."""
    found = pages.main_text(table(spark, folder, "pages"))
    return found.select(
        F.col("doc.page_id").alias("page_id"),
        F.col("doc.url").alias("url"),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )


def op5_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of neighbouring conversations: of two numbers 2n and 2n + 1 the first is the chosen."""
    turns = table(spark, folder, "conversations")
    pair, chosen = F.shiftright("conv_id", 1), F.col("conv_id").bitwiseAND(1) == 0
    mask = lambda name: F.array_join(
        F.transform(name, lambda s: F.concat_ws(":", s["start"], s["end"])), ","
    ).alias(name)
    return preferences.format_pairs(turns, pair, chosen).select(
        F.col("pair").alias("pair_id"),
        F.col("shared").cast("long").alias("n_shared"),
        "prompt",
        "chosen",
        "rejected",
        mask("chosen_mask"),
        mask("rejected_mask"),
        "complete",
    )


def op6_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by byte-level BPE, through a cache that starts empty."""
    import public_tokenizers as files

    docs = table(spark, folder, "documents")
    file, cache = files.path("byte_bpe_50k.json"), new_folder(spark, "token-cache")
    ranks = tokens.Ranks(files.path("byte_bpe_50k.tiktoken"), file, files.PATTERN)
    return tokens.count_tokens(docs, file, cache, keep=["doc_id"], ranks=ranks).select(
        F.col("doc.doc_id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit")
    )


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 24 shards of near equal bytes, with its slot."""
    docs = table(spark, folder, "documents")
    return sharding.shard(docs, 24, keep=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie inside an occurrence of a benchmark window of 10 words.

    `n_near` counts items of which a window's words lie in any order within 2 words more.
    """
    found = decontaminate.contaminated_documents(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10, slop=2
    )
    named = F.concat_ws(",", F.array_sort("items"))
    return found.select(
        F.col("id").cast("long").alias("doc_id"),
        F.col("words").cast("long").alias("n_words"),
        decontaminate.words_hit().cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near"),
    )


def op9_naming(spark: SparkSession, folder: str) -> DataFrame:
    """The group of equal texts of every document; the largest doc_id stays."""
    docs = table(spark, folder, "documents")
    return naming.exact_duplicates(docs, keep=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document: word shingles of 3, links at 3 differing bits."""
    docs = table(spark, folder, "documents")
    rows = simhash.near_duplicates(docs, "text", keep=["doc_id"], shingle=3, max_bits=3)
    return simhash.component_ids(rows).select(
        F.col("doc.doc_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under links of sets of 3-word shingles at 0.9 and more."""
    docs = table(spark, folder, "documents")
    found = ngram_join.component_ids(docs, keep=["doc_id"], size=3, percent=90)
    return found.select(F.col("doc.doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable embedding along its first 8 principal components, whitened."""
    found = whitening.whiten(table(spark, folder, "embeddings"), keep=["vec_id"], most=8)
    return found.select(
        F.col("doc.vec_id").alias("vec_id"),
        "component",
        "n",
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How byte-level and piece tokens of every document lie over each other, and how usual their pairs are."""
    import public_tokenizers as files

    # the rank file is the vocabulary of byte_bpe_50k.json, encoded several times faster
    first = alignment.Vocabulary(files.path("byte_bpe_50k.tiktoken"), before=" ", pattern=files.PATTERN)
    second = alignment.Vocabulary(files.path("piece_bpe_32k.model"))
    found = alignment.align(table(spark, folder, "documents"), first, second, keep=["doc_id"])
    return found.select(F.col("doc.doc_id").alias("doc_id"), *found.columns[2:])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_toxicity": op2_toxicity,
    "op3_secrets": op3_secrets,
    "op4_main_text": op4_main_text,
    "op5_preferences": op5_preferences,
    "op6_tokens": op6_tokens,
    "op7_shards": op7_shards,
    "op8_decontaminate": op8_decontaminate,
    "op9_naming": op9_naming,
    "op10_simhash": op10_simhash,
    "op11_ngram_join": op11_ngram_join,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}

#: Expected results as DuckDB SQL, where SQL can express them.
ORACLES: dict[str, str] = {
    "op1_mix": r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')), 1, 15))::BIGINT AS hash
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), p AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place,
        [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
        2 * source_size AS room
    FROM s
), l AS (
    SELECT *, room::DOUBLE / weight AS ratio,
        (1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM s)
            - coalesce(sum(room) OVER (ORDER BY room::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(weight) OVER (ORDER BY room::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
    FROM p
), t AS (
    SELECT source, source_size, least(weight::DOUBLE * (SELECT arg_min(level, (ratio, place)) FROM l WHERE level <= ratio), room::DOUBLE) AS target
    FROM l
), r AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 1 END AS whole FROM t
), c AS (
    SELECT d.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
        sum(size) OVER (PARTITION BY d.source ORDER BY hash) AS upto,
        sum(size) OVER (PARTITION BY d.source, hash) AS own
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
), b AS (
    SELECT source, arg_min(hash + CASE WHEN upto - rest <= rest - (upto - own) THEN 1 ELSE 0 END, hash) AS below
    FROM c WHERE rest > 0 AND upto >= rest GROUP BY source
)
SELECT doc_id, c.source, size, source_size, target,
    (size * (whole + CASE WHEN hash < coalesce(below, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c LEFT JOIN b ON c.source IS NOT DISTINCT FROM b.source
""",
    "op5_preferences": r"""
WITH t AS (
    SELECT conv_id >> 1 AS pair_id, conv_id & 1 AS side, role, text, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), b AS (
    SELECT pair_id, pos, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS o,
        count(DISTINCT (role IS NULL, r, text IS NULL, x)) AS kinds
    FROM t GROUP BY pair_id, pos
), s AS (
    SELECT pair_id, coalesce(min(pos) FILTER (a = 0 OR o = 0 OR kinds > 1) - 1, max(pos)) AS n_shared FROM b GROUP BY pair_id
), u AS (
    SELECT t.*, n_shared, pos <= n_shared AS common, '<|' || r || '|>' || chr(10) AS head, x || chr(10) || '<|end|>' || chr(10) AS tail
    FROM t JOIN s USING (pair_id)
), m AS (
    SELECT *, coalesce(sum(length(head) + length(tail)) OVER (PARTITION BY pair_id, side, common ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS beg
    FROM u
)
SELECT pair_id, any_value(n_shared)::BIGINT AS n_shared,
    coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (common AND side = 0), '') AS prompt,
    coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (NOT common AND side = 0), '') AS chosen,
    coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (NOT common AND side = 1), '') AS rejected,
    coalesce(string_agg(beg || ':' || (beg + length(tail)), ',' ORDER BY pos) FILTER (NOT common AND side = 0 AND role = 'assistant'), '') AS chosen_mask,
    coalesce(string_agg(beg || ':' || (beg + length(tail)), ',' ORDER BY pos) FILTER (NOT common AND side = 1 AND role = 'assistant'), '') AS rejected_mask,
    count(*) FILTER (NOT common AND side = 0 AND role = 'assistant') > 0 AND count(*) FILTER (NOT common AND side = 1 AND role = 'assistant') > 0 AS complete
FROM m GROUP BY pair_id
""",
    "op8_decontaminate": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), i AS (
    SELECT item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), w AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[p : p + least(len(words), 10) - 1], ' ') AS said
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS p FROM i WHERE len(words) > 0)
), h AS (
    SELECT r, p, n, array_to_string(words[p : p + n - 1], ' ') AS said
    FROM (SELECT d.*, l.n, unnest(range(1, greatest(len(words) - l.n, -1) + 2)) AS p FROM d, (SELECT DISTINCT n FROM w) l)
), m AS (
    SELECT r, h.p, h.n, item_id FROM h JOIN w USING (n, said)
), hit AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS q FROM m) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(coalesce(item_id::VARCHAR, 'null'), ',' ORDER BY coalesce(item_id::VARCHAR, 'null')) AS ids
    FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r
), v AS (
    SELECT DISTINCT unnest(words) AS word FROM i
), f AS (
    SELECT r, list(CASE WHEN v.word IS NULL THEN 0 ELSE 1 END ORDER BY q) AS flags
    FROM (SELECT r, words[q] AS word, q FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS q FROM d)) x LEFT JOIN v USING (word)
    GROUP BY r
), e AS (
    SELECT r, n, p, words[p : p + n + 1] AS said
    FROM (SELECT d.*, l.n, unnest(range(1, greatest(len(words) - l.n, -1) + 2)) AS p FROM d, (SELECT DISTINCT n FROM w) l) JOIN f USING (r)
    WHERE list_sum(flags[p : p + n + 1]) >= n
), z AS (
    SELECT *, unnest(range(CASE WHEN len(said) > n THEN 1 ELSE 0 END, CASE WHEN len(said) > n THEN len(said) + 1 ELSE 1 END)) AS a FROM e
), y AS (
    SELECT *, unnest(range(CASE WHEN len(said) > n + 1 THEN a + 1 ELSE 0 END, CASE WHEN len(said) > n + 1 THEN len(said) + 1 ELSE 1 END)) AS b FROM z
), k AS (
    SELECT DISTINCT r, n, p, len(said) AS wide, array_to_string(list_sort([x FOR x, j IN said IF j <> a AND j <> b]), ' ') AS bag FROM y
), g AS (
    SELECT *, array_to_string(list_sort(string_split(said, ' ')), ' ') AS bag FROM w
), c AS (
    SELECT DISTINCT k.r, g.item_id FROM k JOIN g USING (n, bag)
    WHERE NOT EXISTS (FROM h WHERE h.r = k.r AND h.n = k.n AND h.said = g.said AND h.p BETWEEN k.p AND k.p + k.wide - k.n)
), near AS (
    SELECT r, count(*) AS n_near FROM c GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN near USING (r)
""",
    "op9_naming": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op11_ngram_join": r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), s AS (
    SELECT DISTINCT r, array_to_string(words[p : p + 2], ' ') AS said
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS p FROM d WHERE len(words) > 0)
), g AS (
    SELECT r, count(*) AS n, md5(string_agg(said, chr(10) ORDER BY said)) AS class FROM s GROUP BY r
), c AS (
    SELECT class, min(r) AS r, min(n) AS n FROM g GROUP BY class
), k AS (
    SELECT c.class, c.n, s.said FROM c JOIN s USING (r)
), l AS (
    SELECT x.class AS a, y.class AS b
    FROM k x JOIN k y ON x.said = y.said AND x.class <> y.class AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
    GROUP BY x.class, y.class, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach AS (
    SELECT class AS a, class AS b FROM c
    UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
), root AS (
    SELECT a AS class, min(b) AS root FROM reach GROUP BY a
), least_id AS (
    SELECT root, min(doc_id) AS component_id FROM d JOIN g USING (r) JOIN root USING (class) GROUP BY root
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM d LEFT JOIN g USING (r) LEFT JOIN root USING (class) LEFT JOIN least_id USING (root)
""",
}
