"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model (letters a-z, one symbol for any other letter, the word boundary) is
   counted over the words of every document.
2. A token that looks disguised (digits or signs that imitate letters, also at its edges or without
   any letter, a letter three times or more in a row, or single characters spaced out by any white
   space up to a punctuation mark) becomes a lattice: each character may stand for itself, for a
   letter it imitates, or for nothing; long repetitions for one or two letters; in spaced runs a
   word may end anywhere; what is written like a number may also be one. Viterbi decoding under the
   character model restores the most likely letters.
3. Features of a document are its restored words and their beginnings of 4, 5 and 6 letters. From a
   bounded, documented sample of labelled rows a decision list is learnt: again and again the
   feature that explains the rows not yet covered best, as long as its gain is significant for the
   number of features tried. Copies of a text are one row there, so what a copied text happens to
   contain does not count as evidence many times.
4. A document's score is the smoothed share of toxic rows of the strongest listed feature in its
   whole restored text; without one, the share among rows that no feature covers.

Labels are learnt only from rows whose crc32(doc_id as text) mod 5 is not 0. Labels, lang, source
and doc_id are never inputs of a score.

Defined edge cases: null text counts as empty; empty texts get the share of uncovered rows; null or
repeated doc_ids are scored like any other (held_out is false for a null doc_id); repeated label
rows count once, by the larger label; without labelled rows every score is 0; an empty table gives
an empty result; extra columns are ignored by ``scores`` and carried by ``clean``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Remembered, packed, slices, text_or_empty

#: Labelled rows that the decision list is learnt from, at most (those of smallest hash).
SAMPLE = 10_000
#: Features tried, at most (those in most toxic rows); a bound on the model's size, not on data.
TRIED = 200_000
SIGNIFICANCE = 0.01
#: Tokens of a generation that one worker remembers (bounds memory, changes no result).
REMEMBERED = 50_000

#: Letters that a digit or sign imitates.
IMITATED = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
            "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Costs (negative log probabilities) of the channel.
IMITATION, DROPPED, SEPARATOR, SHORTENED, WORD_END = 1.0, 4.0, 0.2, 0.5, 1.5
#: The same for signs that are mere punctuation: where they usually stand, elsewhere at an edge; a number's digit.
PUNCTUATION, ODD_PUNCTUATION, DIGIT = 2.5, 3.0, math.log(10)

OTHER = "~"
EDGE = re.compile(r"^[^\w@$€£]+|[^\w@$€£]+$")
#: The same without the signs that imitate letters.
OUTER = re.compile(r"^[^\w@$€£!|+(]+|[^\w@$€£!|+(]+$")
PLAIN = re.compile(r"[^\W\d_]+")
REPEATED = re.compile(r"([^\W\d_])\1\1")
#: Single characters between white space; punctuation may stand before the first and after the last.
SPACED = re.compile(r"(?<![^\W_])(?<![^\W_]['’])\S(?:\s+\S){2,}(?![^\W_])")
NUMBER = re.compile(r"\(?[+$€£]?\d+(?:[^\w@$€£!|+(]+\d+)*[$€£+]?!*")


def symbol(c: str) -> str:
    return c if "a" <= c <= "z" else OTHER


SYMBOLS = " abcdefghijklmnopqrstuvwxyz" + OTHER
#: The number of every Latin-1 character's symbol.
SYMBOL_NUMBER = np.array([SYMBOLS.index(symbol(chr(c))) if c != 32 else 0 for c in range(256)], np.int64)


class CharacterModel:
    """Smoothed trigram costs from counts of (two symbols before, symbol)."""

    def __init__(self, counts: dict[str, int]):
        self.counts, self.contexts = counts, Counter()
        for t, n in counts.items():
            self.contexts[t[:2]] += n

    def cost(self, before: str, c: str) -> float:
        return -math.log((self.counts.get(before + c, 0) + 0.05) / (self.contexts.get(before, 0) + 0.05 * 28))


def _options(token: str) -> list[list[tuple[str, float]]]:
    """The lattice: per position the strings it may stand for, with their costs."""
    out: list[list[tuple[str, float]]] = []
    inner = [k for k, c in enumerate(token) if c.isalnum() or c in "_@$€£"] or [len(token)]
    for c, same in groupby(token):
        n, before, after = sum(1 for _ in same), len(out) < inner[0], len(out) > inner[-1]
        if c.isalpha():
            out += [[(c, 0.0), (c * 2, SHORTENED)]] if n >= 3 else [[(c, 0.0)]] * n
        else:
            # a sign that imitates nothing separates letters; a long run of one that does is decoration
            drop = SEPARATOR if c not in IMITATED else DROPPED / n if n >= 3 else DROPPED
            if c in IMITATED and (before or after):  # a run of them at an edge is punctuation as a whole
                drop = (PUNCTUATION if c == "!" and after or c == "(" and before else ODD_PUNCTUATION) / n
            readings = [(x, IMITATION) for x in IMITATED.get(c, "")] + [("", drop)]
            out += [readings] * n
    return out


def decoded(token: str, model: CharacterModel, spaced: bool = False) -> tuple[float, str]:
    """The most likely reading of a token and its cost.

    Viterbi over the last two symbols; a state keeps a link to the one before, so the work and the
    memory are in proportion to the token's length. Of readings of equal cost the first found counts.
    """
    states: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
    for options in _options(token):
        nxt: dict[str, tuple[float, tuple | None]] = {}
        for state, (cost, link) in states.items():
            for reading, extra in options:
                s, k = state, cost + extra
                for c in reading:
                    k += model.cost(s, symbol(c))
                    s = s[1] + symbol(c)
                if s not in nxt or k < nxt[s][0]:
                    nxt[s] = (k, (link, reading) if reading else link)
                if spaced and reading:
                    k += model.cost(s, " ") + WORD_END
                    if "  " not in nxt or k < nxt["  "][0]:
                        nxt["  "] = (k, (link, reading + " "))
        states = nxt
    cost, link = min(((cost + (0 if s[1] == " " else model.cost(s, " ")), link) for s, (cost, link) in states.items()),
                     key=lambda end: end[0])
    parts = []
    while link is not None:
        link, reading = link
        parts.append(reading)
    return cost, "".join(reversed(parts))


def restore(token: str, model: CharacterModel, spaced: bool = False) -> list[str]:
    """The words that a token most likely stands for (one, unless it is a spaced run)."""
    return decoded(token, model, spaced)[1].split()


def words_of_token(token: str, model: CharacterModel) -> list[str]:
    """A lower-cased token without surrounding punctuation, restored if it looks disguised."""
    token = OUTER.sub("", token)
    if not token or (PLAIN.fullmatch(token) and not REPEATED.search(token)):
        return [token] if token else []
    if not any(c.isalpha() for c in token):
        if not any(c in IMITATED for c in token):
            return []
        cost, text = decoded(token, model)
        return [] if NUMBER.fullmatch(token) and DIGIT * sum(map(str.isdigit, token)) <= cost else text.split()
    core = EDGE.sub("", token)
    plain = PLAIN.findall(core)
    disguised = REPEATED.search(core) or any(c in IMITATED for c in core) or \
        (len(plain) > 2 and all(len(p) == 1 for p in plain))
    if disguised:
        return restore(token, model)
    if core != token:  # signs at the edges belong to the first and the last word
        at = token.index(core)
        signs, more = token[:at], token[at + len(core):]
        if len(plain) == 1:
            return restore(signs + plain[0] + more, model)
        if signs:
            plain[:1] = restore(signs + plain[0], model)
        if more:
            plain[-1:] = restore(plain[-1] + more, model)
    return plain


def features_of(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) >= k)]


def spaced_words(text: str, model: CharacterModel) -> Iterator[str]:
    for run in SPACED.findall(text):
        yield from restore("".join(run.split()), model, spaced=True)


def trigram_counts(words: dict[str, int]) -> dict[str, int]:
    """How often each three symbols follow one another in words without signs, given how often each
    word occurs; a word has two blanks before it and one behind."""
    kept = [(w, n) for word, n in words.items() if PLAIN.fullmatch(w := EDGE.sub("", word))]
    if not kept:
        return {}
    text = "".join([f"  {w} " for w, _ in kept])
    at = SYMBOL_NUMBER[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    length = np.array([len(w) + 3 for w, _ in kept])
    times = np.repeat(np.array([n for _, n in kept], float), length)
    ends = np.cumsum(length)
    times[ends - 1] = times[ends - 2] = 0  # three symbols that would reach into the next word
    size = len(SYMBOLS)
    found = np.bincount((at[:-2] * size + at[1:-1]) * size + at[2:], times[:-2], size**3)
    return {SYMBOLS[k // size**2] + SYMBOLS[k // size % size] + SYMBOLS[k % size]: int(found[k])
            for k in np.flatnonzero(found).tolist()}


def _trigrams(docs: DataFrame) -> dict[str, int]:
    """Trigram counts over all words of all documents: at most 28**3 numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words: Counter = Counter()
            for text in batch.column("text").to_pylist():
                words.update(text.lower().split())
            counts = trigram_counts(words)
            yield pa.RecordBatch.from_pydict({"t": pa.array(list(counts), pa.string()),
                                              "n": pa.array(list(counts.values()), pa.int64())})

    counted = docs.select(text_or_empty().alias("text")).mapInArrow(run, "t string, n bigint")
    return {r["t"]: r["n"] for r in counted.groupBy("t").agg(F.sum("n").alias("n")).collect()}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(toxic, text) of at most ``most`` labelled rows that may be learnt from; equal texts once."""
    chosen = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")  # SAMPLE rows
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def _text_features(text: str, model: CharacterModel, known: Remembered) -> set[str]:
    text, found = text.lower(), set()
    known.age()
    for token in set(text.split()):
        got = known.get(token)
        if got is None:
            got = known.now[token] = tuple(f for w in words_of_token(token, model) for f in features_of(w))
        found.update(got)
    for w in spaced_words(text, model):
        found.update(features_of(w))
    return found


def learn(docs: DataFrame, labels: DataFrame, model: CharacterModel, most: int = SAMPLE) -> tuple[dict[str, float], float]:
    """The decision list (feature: share of toxic rows) and the share of the rows it does not cover."""
    rows = _sample(docs, labels, most).select("toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(REMEMBERED)
        for batch in slices(batches, "text"):
            counts: Counter = Counter()
            for text in batch.column("text").to_pylist():
                counts.update(_text_features(text, model, known))
            yield pa.RecordBatch.from_pydict({"f": pa.array(list(counts), pa.string()),
                                              "n": pa.array(list(counts.values()), pa.int64())})

    in_toxic = rows.filter("toxic = 1").select("text").mapInArrow(count, "f string, n bigint")
    tried = [r["f"] for r in in_toxic.groupBy("f").agg(F.sum("n").alias("n")).filter("n >= 4")
             .orderBy(F.desc("n"), "f").limit(TRIED).collect()]
    number = {f: k for k, f in enumerate(tried)}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(REMEMBERED)
        for batch in slices(batches, "text"):
            found = [np.array(sorted(number[f] for f in _text_features(t, model, known) if f in number), "<i4").tobytes()
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "found": pa.array(found, pa.binary())})

    # at most SAMPLE short rows
    got = rows.mapInArrow(numbered, "toxic int, found binary").collect()
    return decision_list(tried, [np.frombuffer(r["found"], "<i4") for r in got],
                         np.array([r["toxic"] == 1 for r in got], bool))


def decision_list(features: list[str], rows: list[np.ndarray], toxic: np.ndarray) -> tuple[dict[str, float], float]:
    chosen: dict[str, float] = {}
    if not len(rows):
        return chosen, 0.0
    # a feature that is mostly in clean rows never gets listed; without those the rows are short
    pos, neg = np.zeros(len(features), np.int64), np.zeros(len(features), np.int64)
    for r, t in zip(rows, toxic, strict=True):
        (pos if t else neg)[r] += 1
    telling = pos >= neg
    rows = [r[telling[r]] for r in rows]
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    item = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64)
    left = np.ones(len(rows), bool)
    needed = math.log(max(1, len(features)) / SIGNIFICANCE)
    while left.any() and len(features):
        base = toxic[left].mean()
        if not 0 < base < 1:
            break
        live = left[owner]
        pos = np.bincount(item[live & toxic[owner]], minlength=len(features)).astype(float)
        neg = np.bincount(item[live & ~toxic[owner]], minlength=len(features)).astype(float)
        p = pos / np.maximum(1, pos + neg)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(pos > 0, pos * np.log(p / base), 0) + np.where(neg > 0, neg * np.log((1 - p) / (1 - base)), 0)
        gain[p < 0.5] = 0
        best = int(np.argmax(gain))
        if gain[best] < needed:
            break
        chosen[features[best]] = float((pos[best] + 0.5) / (pos[best] + neg[best] + 1))
        left[owner[(item == best) & live]] = False
    return chosen, float((toxic[left].sum() + 0.5) / (left.sum() + 1)) if left.any() else 0.5


def fitted(docs: DataFrame, labels: DataFrame):
    """A column function text -> score, learnt from the documents and labels."""
    model = CharacterModel(_trigrams(docs))
    listed, rest = learn(docs, labels, model)
    known = Remembered(2 * REMEMBERED)

    def score(text: str) -> float:
        known.age()
        text, most = text.lower(), rest
        for token in set(text.split()):
            got = known.get(token)
            if got is None:
                got = known.now[token] = max((listed.get(f, rest) for w in words_of_token(token, model)
                                          for f in features_of(w)), default=rest)
            if got > most:
                most = got
        for w in spaced_words(text, model):
            most = max(most, *(listed.get(f, rest) for f in features_of(w)))
        return most

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return texts.map(score).astype("float64")

    return lambda text: scored(text)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from 0.5 on)."""
    score = fitted(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(text_or_empty()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, with their columns."""
    score = fitted(docs, labels)
    return packed(docs, score=score(text_or_empty())).filter("score < 0.5").select("row.*")
