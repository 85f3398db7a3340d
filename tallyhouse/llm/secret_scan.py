"""Secrets in texts: fixed patterns, and strings that a primed compressor cannot explain.

Beside the patterns, every long string near a sensitive word is a candidate: the word stands before it or
after it in its line or its braces, is the name it is assigned to, or heads the key block or the run of such
lines that it is part of. Its novelty is what it adds to the compressed size of the text before it, by zstandard primed with a dictionary of the corpus's
most frequent identifiers, per byte of the candidate. Words, paths and repeated names compress away; keys do
not, and are reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.store import Spool

# The patterns, in the order in which kinds are listed, and the least length of a group.
PATTERNS = {
    "assign": (
        re.compile(
            r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
        ),
        2,
        8,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
NOVEL = "novel"
_ORDER = {kind: i for i, kind in enumerate([*PATTERNS, NOVEL])}

LEAST = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: Parts of a candidate between equals signs; signs at its end are padding.
_PART = re.compile(r"[A-Za-z0-9+/_-]+(?:=+\Z)?")
_SENSITIVE = re.compile(
    r"(?ai)passw|passwd|pwd|secret|token|api.?key|access.?key|private.?key|credential|bearer|signature"
    # not in "author" or "authentic"
    r"|(?<![a-z])o?auth(?![a-z])|authori[sz]ation"
)
#: A key block; its lines are candidates of any length.
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(.*?)(?:-----END|\Z)", re.S)
_KEY_LINE = re.compile(r"(?m)^[ \t]*([A-Za-z0-9+/]+=*)[ \t\r]*$")
#: What may stand between a sensitive word and the candidate that it names.
_LEADS = re.compile(r"[^A-Za-z0-9\n]{0,8}(?=[A-Za-z0-9+/_=-]{16})")
#: Content of a data address, and identifiers, which are reported only where a sensitive word names them.
_EMBEDDED = re.compile(r"(?i);base64,\Z")
_IDENTITY = re.compile(r"(?ai)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
#: Characters before a candidate that count as its surroundings, also for braces on both sides, and those that
#: may hold a sensitive word of an earlier line.
CONTEXT, NEAR = 512, 48
#: Compressed bytes a byte of a candidate must add. Random base64 adds 0.75, random hex 0.5.
NOVELTY = 0.6
#: Identifiers of the dictionary and its bytes, at most.
IDENTIFIERS, DICTIONARY_BYTES = 8_000, 1 << 16
#: Of letters alone: a leaked key that many copies hold must not explain itself.
_IDENTIFIER = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z_]{4,40}(?![A-Za-z0-9_])")
#: The words of a candidate, which are all that it gives to the dictionary, for the same reason.
_SUBWORD = re.compile(r"(?<![a-z])[A-Z]?[a-z]{3,14}(?![a-z])|(?<![A-Z])[A-Z]{4,15}(?![A-Za-z])")


def _parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """What may be a key in a run of candidate characters: the values of an assignment, or all of it."""
    parts = [(start + m.start(), start + m.end()) for m in _PART.finditer(text[start:end])]
    if not parts or parts[-1][1] - parts[-1][0] < LEAST:
        return [(start, end)]
    named = [p for p in parts[:-1] if p[1] - p[0] >= LEAST and not _SENSITIVE.search(text, *p)]
    return [*named, parts[-1]]


def near_candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidates near a sensitive word, in order."""
    runs = list(_CANDIDATE.finditer(text))
    words = [m.span() for m in _SENSITIVE.finditer(text)] if runs or "-----BEGIN" in text else []
    if not words:
        return []
    begins, ends = [a for a, _ in words], [b for _, b in words]
    block_lines = [
        (line.start(1), line.end(1))
        for block in _KEY_BLOCK.finditer(text)
        for line in _KEY_LINE.finditer(text, *block.span(1))
    ]
    in_block, found = set(block_lines), list(block_lines)
    line_from, line_to, carried = 0, -1, -1
    for run in runs:
        for start, end in _parts(text, *run.span()):
            if (start, end) in in_block or _EMBEDDED.search(text, max(0, start - 8), start):
                continue
            if _IDENTITY.fullmatch(text, start, end):
                last = bisect_right(ends, start) - 1
                if last < 0 or start - ends[last] > 8 or any(c.isalnum() for c in text[ends[last] : start]):
                    continue
            if start > line_to:
                line_from, line_to = text.rfind("\n", 0, start) + 1, text.find("\n", start)
                line_to = len(text) if line_to < 0 else line_to
            low, high = min(line_from, max(0, start - NEAR)), line_to
            opened = text.rfind("{", max(0, start - CONTEXT), start)
            closed = text.find("}", end, end + CONTEXT)
            if opened >= 0 and closed >= 0 and "}" not in text[opened:start] and "{" not in text[end:closed]:
                low, high = min(low, opened), max(high, closed)
            # the first word from `low` on, if it ends before the candidate, or one behind it that names no other
            first = bisect_left(begins, low)
            near = first < len(words) and ends[first] <= start
            for k in range(bisect_left(begins, end), bisect_right(ends, high)):
                if near:
                    break
                near = not _LEADS.match(text, ends[k])
            if not near and 0 <= carried and start - carried <= NEAR:
                gap = text[carried:start]
                near = gap.count("\n") == 1 and not any(c.isalnum() for c in gap + text[end:line_to])
            if near:
                found.append((start, end))
                carried = end
    return sorted(found)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: Counter = Counter()
        for text in batch["text"]:
            rest, at = [], 0
            for start, end in near_candidates(text or ""):
                found.update(_SUBWORD.findall(text, start, end))
                rest.append(text[at:start])
                at = end
            found.update(_IDENTIFIER.findall(" ".join([*rest, text[at:]]) if at else text or ""))
        if found:
            yield pd.DataFrame({"word": list(found), "n": list(found.values())})


def identifier_dictionary(docs: DataFrame, text: str = "text") -> bytes:
    """The most frequent identifiers over all texts, the most frequent last, where zstandard looks first.

    How many words have how many binary digits in their count says from which count on they can be among
    the most frequent; only those are sorted, so tasks send few words to the driver.
    """
    spool = Spool(docs.sparkSession, "identifiers")
    counts = spool.write(
        docs.select(F.col(text).alias("text"))
        .mapInPandas(_counted, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    words, least = 0, 1
    digits = counts.groupBy(F.length(F.bin("n")).alias("digits")).agg(F.count("*").alias("words"))
    for row in sorted(digits.collect(), reverse=True):
        words, least = words + row["words"], 1 << (row["digits"] - 1)
        if words >= IDENTIFIERS:
            break
    top = (
        counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(IDENTIFIERS).collect()
    )
    spool.drop(counts)
    return "\n".join(r["word"] for r in reversed(top)).encode()[-DICTIONARY_BYTES:]


class Novelty:
    """Marginal compressed bytes of a string after its surroundings, per byte."""

    def __init__(self, dictionary: bytes):
        held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        # without checksums, sizes and dictionary numbers only the content differs
        self.compressor = zstandard.ZstdCompressor(
            level=3, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def __call__(self, before: str, candidate: str) -> float:
        around, said = before.encode("utf-8", "surrogatepass"), candidate.encode("utf-8", "surrogatepass")
        more = len(self.compressor.compress(around + said)) - len(self.compressor.compress(around))
        return more / len(said)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, leftmost and non-overlapping for each kind."""
    found = []
    for kind, (pattern, group, least) in PATTERNS.items():
        for match in pattern.finditer(text):
            if len(match[group]) >= least:
                found.append((kind, *match.span()))
    return found


def novel_spans(text: str, base: list[tuple[str, int, int]], novelty: Novelty) -> list[tuple[str, int, int]]:
    """Candidates near a sensitive word that add too many compressed bytes and touch no base span."""
    found = []
    for start, end in near_candidates(text):
        if any(a < end and start < b for _, a, b in base):
            continue
        if novelty(text[max(0, start - CONTEXT) : start], text[start:end]) >= NOVELTY:
            found.append((NOVEL, start, end))
    return found


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def scan(docs: DataFrame, text: str = "text", dictionary: bytes | None = None) -> DataFrame:
    """`docs` packed as `doc` with `spans`: array of (kind, start, end) in code points, end exclusive.

    Spans are in order of start and then of kind. The identifier dictionary is made from all texts of
    `docs` unless one is given. Null and empty texts have no spans; repeated rows are scanned alike; an empty
    table gives no rows.
    """
    primed = identifier_dictionary(docs, text) if dictionary is None else dictionary

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        novelty = Novelty(primed)
        for texts in batches:
            found = []
            for said in texts:
                base = base_spans(said or "")
                found.append(
                    [
                        {"kind": k, "start": a, "end": b}
                        for k, a, b in in_order(base + novel_spans(said or "", base, novelty))
                    ]
                )
            yield pd.Series(found, dtype=object)

    return docs.select(F.struct(*docs.columns).alias("doc"), spans(F.col(text)).alias("spans"))
