"""Toxicity of texts, scored after a noisy-channel restoration of obfuscated words.

A character trigram model is counted over the whole corpus. Words that look obfuscated (digits or signs
among letters, a letter twice or more, runs of single letters, a separator among letters) span a lattice:
each character may stand for itself, for the letters it is used for, or for nothing, and each separator for
the edge of a word or for nothing. The Viterbi path under the character model is the restored text. The score is learnt and applied on restored texts.

Learning takes, for each word and word beginning, a lower bound of the share of toxic texts among the
labelled texts that hold it. Each toxic text then votes for its most reliable features, and features with
too few votes go: what merely accompanies an insult, such as the rare words of a much copied text, is
seldom among the most reliable ones. Words that are all but certain need no votes, as insults that come
together would hide each other. A text's score is the chance that one of its features is right.

Once the features are known, most words are settled by their first letters: a plain word can only be restored
to a word that begins alike, up to repeated letters, so the lattice is left to the few others.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.store import Spool

#: Labelled rows that are used for learning (by hash of the identifier), at most; they bound the features too.
MAX_LABELLED = 60_000
#: Votes and bound that a feature needs, and how many standard deviations the bound lies below the share.
MIN_VOTES, MIN_BOUND, SIGMAS = 2, 0.6, 1.64
#: The part of the clean labelled rows that is read first, and features whose beginnings are listed.
FIRST_OF, FEW = 8, 5000
#: Whole words with this bound need no votes.
SURE = 0.9
#: Scores from here on are toxic.
THRESHOLD = 0.3
#: Lengths of word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7)
#: Folds by crc32 of the identifier, and the one that is never learnt from.
FOLDS, HELD_OUT = 4, 2

# Letters that signs and digits stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
#: Log probabilities of the channel: a sign that stands for a letter, for nothing, a letter repeated often or
#: once, and a separator inside a word that is not spelled out.
SUBSTITUTED, DROPPED, REPEATED = math.log(0.6), math.log(0.002), math.log(0.3)
DOUBLED, SPLIT = math.log(0.02), math.log(0.05)

_MARKS = re.compile("[\u0300-\u036f]+")
_SIGNS = "".join(re.escape(c) for c in STANDS_FOR)
#: Separators in a token: between spelled letters, and inside a word.
_GAP, _JOINT = "\ue000", "\ue001"
_GAPS = re.compile(r"[ \t._*\-,/]{1,3}")
#: Three or more single characters with separators between them.
_SPELLED = re.compile(
    rf"(?<![^\s\"'“„«(\[])[A-Za-z{_SIGNS}](?:{_GAPS.pattern}[A-Za-z{_SIGNS}](?![^\W_])){{2,}}"
)
_JOINTS = re.compile(r"(?<=[A-Za-z])[._*\-,/](?=[A-Za-z])")
#: In a token: a sign, digit or separator next to a letter, or a letter twice.
_NOISY = re.compile(rf"[a-z][{_SIGNS}{_GAP}{_JOINT}]|[{_SIGNS}{_GAP}][a-z]|([a-z])\1")
_RUN = re.compile(rf"[a-z{_SIGNS}{_GAP}{_JOINT}]+")
_TWICE, _LONGER = re.compile(r"([a-z])\1"), re.compile(r"([a-z])\1\1")
_WORD = re.compile(r"[^\W\d_]+")
_SIZE = 27
_CODES = bytes(c - 96 if 97 <= c <= 122 else 0 for c in range(256))


def fold(text: str | None) -> str:
    """Case-folded, without accents; other scripts stay."""
    text = (text or "").casefold()
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", text))


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(_SIZE**3, np.int64)
    for batch in batches:
        for text in batch["text"]:
            letters = b"\0" + fold(text).encode("ascii", "ignore").translate(_CODES) + b"\0"
            a = np.frombuffer(letters, np.uint8).astype(np.int32)
            counts += np.bincount(a[:-2] * _SIZE**2 + a[1:-1] * _SIZE + a[2:], minlength=_SIZE**3)
    held = np.flatnonzero(counts)
    yield pd.DataFrame({"gram": held, "n": counts[held]})


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probability of a letter after two others, (27, 27, 27) with 0 for a word's edge.

    Counted over every text; at most 27 ** 3 sums come to the driver. A letter that never follows is
    judged by the letter before it, and then by how frequent it is.
    """
    sums = (
        docs.select(F.col(text).alias("text"))
        .mapInPandas(_grams, "gram int, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    three = np.zeros(_SIZE**3)
    for row in sums:
        three[row["gram"]] = row["n"]
    three = three.reshape((_SIZE,) * 3)
    two, one = three.sum(0), three.sum((0, 1))
    single = (one + 1) / (one.sum() + _SIZE)
    pair = (two + 5 * single) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * pair[None]) / (three.sum(2, keepdims=True) + 5))


def _options(token: str) -> list[list[tuple[int, float]]]:
    """For each character of a token the letters it may stand for (0: none, -1: an edge) and their log probability."""
    found, before = [], ""
    for i, c in enumerate(token):
        here = []
        if "a" <= c <= "z":
            here.append((ord(c) - 96, 0.0))
            if c == before:
                long = token[i - 2 : i - 1] == c or token[i + 1 : i + 2] == c
                here.append((0, REPEATED if long else DOUBLED))
        elif c == _GAP or c == _JOINT:
            here += [(-1, 0.0), (0, 0.0 if c == _GAP else SPLIT)]
        else:
            here += [(ord(x) - 96, SUBSTITUTED) for x in STANDS_FOR.get(c, "")]
            here.append((0, DROPPED))
        found.append(here)
        before = c
    return found


def decode(token: str, model: list) -> str:
    """The most probable path through a token's lattice, by Viterbi over the last two letters.

    The model is given as nested lists, which are read faster than an array.
    """
    paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for here in _options(token):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, said) in paths.items():
            for letter, cost in here:
                if letter < 0:
                    if not b:
                        continue
                    state, value, word = (b, 0), score + cost + model[a][b][0], said + " "
                elif letter:
                    state, value = (b, letter), score + cost + model[a][b][letter]
                    word = said + chr(96 + letter)
                else:
                    state, value, word = (a, b), score + cost, said
                if state not in after or value > after[state][0]:
                    after[state] = (value, word)
        paths = after
    return max((score + model[a][b][0], said) for (a, b), (score, said) in paths.items())[1]


def single(word: str, model: list) -> str:
    """`decode` of plain letters of which none stands more than twice in a row.

    Behind a pair the last two letters are the same whether its second letter stands or not, so each pair
    is settled by its own and the following letter.
    """
    kept, start = [], 0
    for pair in _TWICE.finditer(word):
        i, j = pair.span()
        before = ord(word[i - 1]) - 96 if i else 0
        after = ord(word[j]) - 96 if j < len(word) else 0
        letter = ord(word[i]) - 96
        follow = model[before][letter]
        if DOUBLED + follow[after] > follow[letter] + model[letter][letter][after]:
            kept.append(word[start : i + 1])
            start = j
    return "".join(kept) + word[start:] if kept else word


class Restorer:
    """Restores texts token by token; keeps the tokens it has seen, up to a number.

    Half of the number are the latest tokens; when they are full they replace the older half, so a token
    that comes often is never forgotten, however many others come once.
    `derive` says what is kept of a restored token; by default the token itself.
    """

    def __init__(self, model: np.ndarray, derive=lambda token: token, kept: int = 60_000):
        self.model = None if model is None else model.tolist()
        self.derive, self.kept = derive, kept
        self.seen: dict = {}
        self.older: dict = {}

    def _run(self, match: re.Match) -> str:
        # runs of one sign around a word are decoration
        run = re.sub(rf"^([{_SIGNS}])\1+|([{_SIGNS}])\2+$", "", match[0])
        if not _NOISY.search(run):
            return run
        if run.isalpha() and not _LONGER.search(run):
            return single(run, self.model)
        # a run of more than three says no more than three
        return decode(re.sub(r"(.)\1{3,}", r"\1\1\1", run), self.model)

    def token(self, token: str):
        """What is derived of one token, folded and restored."""
        found = self.seen.get(token)
        if found is None:
            found = self.older.get(token)
            if found is None:
                said = fold(token)
                said = _RUN.sub(self._run, said) if _NOISY.search(said) else said
                found = self.derive(said.replace(_GAP, " ").replace(_JOINT, "-"))
            if len(self.seen) >= self.kept // 2:
                self.older, self.seen = self.seen, {}
            self.seen[token] = found
        return found

    def tokens(self, text: str | None) -> list[str]:
        """The tokens of a text between white space; a run of spelled letters is one token."""
        text = _SPELLED.sub(lambda m: _GAPS.sub(_GAP, m[0]), text or "")
        return _JOINTS.sub(_JOINT, text).split()

    def __call__(self, text: str | None) -> str:
        return " ".join(map(self.token, self.tokens(text)))


def _words(restored: str) -> list[str]:
    return [restored] if restored.isalpha() else _WORD.findall(restored)


def features(restored: str) -> tuple[str, ...]:
    """The words of a restored token, and the beginnings of longer ones, marked by a star."""
    words = _words(restored)
    return (*words, *(w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n))


def _heads(bounds: dict[str, float]) -> set[str]:
    """The first letters of all features; all features of a word begin like the word."""
    return {f[: min(BEGINNINGS)] for f in bounds}


def features_among(bounds: dict[str, float]):
    """A function from restored tokens to those of their features that have a bound."""
    length, heads = min(BEGINNINGS), _heads(bounds)

    def among(token: str) -> tuple[str, ...]:
        return tuple(f for w in _words(token) if w[:length] in heads for f in features(w) if f in bounds)

    return among


def starts_of(bounds: dict[str, float]) -> set[str]:
    """The first letters that plain words may have which are restored to a word with a feature.

    Of plain letters nothing is restored but that repeated ones go, so these are the heads of the features
    with any of their letters repeated, as long as a head.
    """
    length, found = min(BEGINNINGS), set()
    for head in _heads(bounds):
        waiting = [("", 0)]
        while waiting:
            said, at = waiting.pop()
            if len(said) == length:
                found.add(said)
                continue
            if at == len(head):
                found.add(said)
            else:
                waiting.append((said + head[at], at + 1))
            if said:
                waiting.append((said + said[-1], at))
    return found


def _held(restore: Restorer, text: str | None, starts: set[str] | None = None) -> set[str]:
    """All that a restorer derives of the tokens of a text; with `starts`, plain words that begin otherwise are passed over."""
    held: set[str] = set()
    length = min(BEGINNINGS)
    for token in set(restore.tokens(text)):
        if starts is not None:
            plain = token.rstrip(".,;:?")
            if plain.isalpha():
                head = plain[:length].lower() if plain.isascii() else fold(plain)
                if head.isascii() and head.isalpha() and head[:length] not in starts:
                    continue
        found = restore.seen.get(token)
        if found is None:
            found = restore.token(token)
        if found:
            held.update(found)
    return held


def _bound(hits: int, total: int) -> float:
    """Lower end of Wilson's interval of a share."""
    z, p = SIGMAS**2, hits / total
    return (p + z / (2 * total) - math.sqrt(z * (p * (1 - p) / total + z / (4 * total**2)))) / (1 + z / total)


def _counted(model: np.ndarray, among: dict[str, int] | None = None):
    """How many texts hold each feature; with `among` only of those."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore = Restorer(model, features if among is None else features_among(among))
        starts = starts_of(among) if among is not None and len(among) <= FEW else None
        for batch in batches:
            for start in range(0, len(batch), 1000):
                sums: Counter = Counter()
                for text in batch["text"].iloc[start : start + 1000]:
                    sums.update(_held(restore, text, starts))
                if sums:
                    yield pd.DataFrame({"feature": list(sums), "n": list(sums.values())})

    return count


def _reliable(rows: DataFrame, model: np.ndarray) -> dict[str, float]:
    """The bound of every feature that toxic rows of `rows(text, toxic)` make likely enough.

    Features of toxic texts are counted first, then what part of the clean texts holds of them: most are
    common words, whose share is too low already, so the other clean texts are read for few features.
    """

    def counted(part: DataFrame, among: dict[str, int] | None, least: int) -> dict[str, int]:
        sums = part.select("text").mapInPandas(_counted(model, among), "feature string, n long").groupBy("feature")
        found = sums.agg(F.sum("n").alias("n")).where(F.col("n") >= least).toArrow()
        return dict(zip(found["feature"].to_pylist(), found["n"].to_pylist(), strict=True))

    hits = counted(rows.where("toxic"), None, MIN_VOTES)
    clean = dict.fromkeys(hits, 0)
    part = F.pmod(F.xxhash64("text"), F.lit(FIRST_OF))
    for chosen in (part == 0, part != 0):
        # a bound lies below the share
        hits = {f: n for f, n in hits.items() if n > MIN_BOUND * (n + clean[f])}
        for f, n in counted(rows.where(~F.col("toxic") & chosen), hits, 1).items():
            clean[f] += n
    bounds = {f: _bound(n, n + clean[f]) for f, n in hits.items()}
    return {f: bound for f, bound in bounds.items() if bound >= MIN_BOUND}


def _voted(model: np.ndarray, bounds: dict[str, float]):
    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore, starts, votes = Restorer(model, features_among(bounds)), starts_of(bounds), Counter()
        for batch in batches:
            for text in batch["text"]:
                held = _held(restore, text, starts)
                best = max(map(bounds.get, held), default=0)
                votes.update(f for f in held if bounds[f] == best)
        if votes:
            yield pd.DataFrame({"feature": list(votes), "votes": list(votes.values())})

    return vote


class Toxicity:
    """A learnt model: the character model, the bound of each feature, and the score without any."""

    def __init__(self, model: np.ndarray, bounds: dict[str, float], base: float):
        self.model, self.bounds, self.base = model, bounds, base

    def score(self, text: Column) -> Column:
        """0 to 1; null and empty texts have the score of a text without features."""
        model, bounds, base = self.model, self.bounds, self.base

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            restore, starts = Restorer(model, features_among(bounds)), starts_of(bounds)
            for texts in batches:
                found = []
                for text in texts:
                    left = 1 - base
                    for f in sorted(_held(restore, text, starts)):
                        left *= 1 - bounds[f]
                    found.append(1 - left)
                yield pd.Series(found, dtype="float64")

        return scored(text)


def held_out(identifier: Column) -> Column:
    fold_ = F.crc32(identifier.cast("string")) % FOLDS
    return F.coalesce(fold_ == HELD_OUT, F.lit(False))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    identifier: str = "doc_id",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> Toxicity:
    """A model from the character statistics of all `docs` and the labelled rows outside the held-out fold.

    Labels without an identifier or a label are left out; of several labels of an identifier the largest
    counts; equal labelled texts count once. More labelled rows than `max_labelled` are thinned to about
    that number by a hash of the identifier. Without toxic rows every score is 0, and an empty table has none.
    The features that come to the driver are words of at least two of its toxic rows.
    """
    spool = Spool(docs.sparkSession, "toxicity")
    model = character_model(docs, text)
    known = (
        labels.select(F.col(identifier).alias("id"), F.col(label).alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    part = min(1.0, max_labelled / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < part * (1 << 20))
    rows = spool.write(
        docs.select(F.col(identifier).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "id")  # about max_labelled rows of two numbers
        .groupBy("text")
        .agg(F.max("toxic").alias("toxic"))
        .select("text", (F.col("toxic") > 0).alias("toxic"))
    )
    bounds = _reliable(rows, model)
    toxic = rows.where("toxic")
    votes = (
        toxic.mapInPandas(_voted(model, bounds), "feature string, votes long")
        .groupBy("feature")
        .agg(F.sum("votes").alias("votes"))
        .where(F.col("votes") >= MIN_VOTES)
        .collect()
    )
    kept = {r["feature"]: bounds[r["feature"]] for r in votes}
    kept |= {f: bound for f, bound in bounds.items() if bound >= SURE and f[-1] != "*"}
    fitted = Toxicity(model, kept, 0.0)
    free = rows.withColumn("score", fitted.score(F.col("text"))).where("score = 0")
    hits, total = free.agg(F.sum(F.col("toxic").cast("long")), F.count("*")).first()
    fitted.base = ((hits or 0) + 0.01) / (total + 1) if kept else 0.0
    spool.drop(rows)
    return fitted


def drop_toxic(
    docs: DataFrame, labels: DataFrame, text: str = "text", identifier: str = "doc_id", threshold: float = THRESHOLD
) -> DataFrame:
    """`docs` without the rows whose score reaches the threshold.

    Null and empty texts score as texts without features, repeated rows alike; an empty table stays empty.
    """
    fitted = learn(docs, labels, text, identifier)
    packed = docs.select(F.struct(*docs.columns).alias("doc"), fitted.score(F.col(text)).alias("score"))
    return packed.where(F.col("score") < threshold).select("doc.*")
