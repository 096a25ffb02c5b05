"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding lower-cases, maps look-alike letters of other scripts to Latin and digits that stand for letters to these letters,
and turns punctuation into spaces. The lexicon holds words and word beginnings that labelled toxic documents use far
more often than others; a term's weight is its log odds. Phrases around a term that occur mostly in harmless documents
are exceptions and cancel the hits inside them. A document's score is a logistic function of its weighted hits and of the
same divided by its length, fitted on labelled rows that the lexicon was not learned from.

The model is learned from at most ``SAMPLE_ROWS`` labelled documents, those with the smallest hash of their id, and holds
all their terms that reach ``MIN_GAIN``; every document is scored over its whole text.

Defined cases: null and empty texts have no hits and get the score of a text without hits; labels that are null, or whose
document is missing, are not used; of several labels of one document the largest counts; repeated rows are scored alike;
without any labelled row of either kind the score is that share, and 0 without labels; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from touchline.session import bound_batches, materialize

SAMPLE_ROWS = 20_000
PREFIXES = (4, 5, 6, 7)
MIN_GAIN = 20.0  # G statistic that a term must reach
EXCEPTION_ROWS, EXCEPTION_SHARE = 5, 0.25

# Letters that look like Latin ones, and digits used in their place.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s",
    "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ⅼ": "l", "ｅ": "e",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
_SYMBOLS = {"$": "s", "@": "a"}
_INVISIBLE = "​‌‍⁠﻿­"
_TABLE = {ord(k): v for k, v in (HOMOGLYPHS | DIGITS).items()}
_TABLE |= {0xFF41 + i: chr(97 + i) for i in range(26)} | {ord(c): None for c in _INVISIBLE}
_TABLE |= {c: " " for c in range(128) if not chr(c).isalnum()}
_SYMBOL = re.compile(r"[$@](?=\w)")


def fold(text: str | None) -> str:
    """The folded words with one space before, between and after them; one space if there are none."""
    low = (text or "").lower()
    if "$" in low or "@" in low:
        low = _SYMBOL.sub(lambda m: _SYMBOLS[m[0]], low)
    words = low.translate(_TABLE).split()
    return f" {' '.join(words)} " if words else " "


def _terms(folded: str) -> set[str]:
    """Words as " word " and word beginnings as " begin"."""
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in PREFIXES if n < len(word))
    return found


@dataclass
class Lexicon:
    """``terms``: pattern to weight; ``exceptions``: phrases; ``coefficients`` of 1, log hits and log density."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, float, float] = (-30.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            machine.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        machine.make_automaton()
        return machine if len(machine) else None

    def hits(self, folded: str, machine) -> dict[int, float]:
        """Where a term begins, with the largest weight there, exceptions left out."""
        found, spared = {}, []
        for end, (length, weight) in machine.iter(folded) if machine else ():
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            else:
                found[start] = max(found.get(start, 0.0), weight)
        starts, reach = [], []  # the exceptions by their start, and how far those so far reach
        for start, end in sorted(spared):
            starts.append(start)
            reach.append(max(end, reach[-1]) if reach else end)
        return {s: w for s, w in found.items() if not (i := bisect_right(starts, s)) or reach[i - 1] <= s}

    def features(self, text: str | None, machine) -> tuple[float, float]:
        folded = fold(text)
        total = sum(self.hits(folded, machine).values())
        return float(np.log1p(total)), float(np.log1p(1000 * total / (folded.count(" ") + 20)))

    def probability(self, features: np.ndarray) -> np.ndarray:
        const, hits, density = self.coefficients
        return 1 / (1 + np.exp(-np.clip(const + hits * features[:, 0] + density * features[:, 1], -30, 30)))


def id_remainder(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids give 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n)), F.lit(0))


def _counted(sample: DataFrame) -> DataFrame:
    """Per term the toxic and other documents of the sample that hold it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, other = Counter(), Counter()
            for text, label in zip(batch.text, batch.toxic):
                (toxic if label else other).update(_terms(fold(text)))
            terms = list(toxic.keys() | other.keys())
            yield pd.DataFrame({"term": terms, "t": [toxic[x] for x in terms], "n": [other[x] for x in terms]})

    return sample.mapInPandas(count, "term string, t long, n long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))


def _gain_and_weight(toxic: int, other: int) -> tuple[Column, Column]:
    """How surely and how strongly a term with counts t and n speaks for toxic text."""
    share = toxic / (toxic + other)
    t, n, rows = F.col("t"), F.col("n"), F.col("t") + F.col("n")
    gain = 2 * (t * F.log(t / (rows * share)) + F.when(n > 0, n * F.log(n / (rows * (1 - share)))).otherwise(0.0))
    return gain, F.log((t + 0.5) / (toxic + 1.0)) - F.log((n + 0.5) / (other + 1.0))


def _candidates(counts: DataFrame, toxic: int, other: int) -> list[str]:
    gain, weight = _gain_and_weight(toxic, other)
    strong = counts.filter((F.col("t") > 0) & (weight > 1.0) & (gain >= MIN_GAIN))
    return [r.term for r in strong.orderBy(gain.desc(), "term").collect()]


def _in_contexts(sample: DataFrame, terms: list[str]) -> DataFrame:
    """Per term the different pairs of neighbouring words that it has in toxic (t) and in other (n) documents. Copies of a
    text repeat their neighbours, so a text that was copied often does not make its words toxic."""

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = Lexicon({t: 1.0 for t in terms}).automaton()
        for batch in batches:
            rows = set()
            for text, label in zip(batch.text, batch.toxic):
                folded = fold(text)
                for last, (length, _) in machine.iter(folded):
                    start = last - length + 1
                    end = folded.index(" ", start + 1)
                    before, after = folded[:start].rpartition(" ")[2] if start < 64 else folded[start - 64 : start].rpartition(" ")[2], folded[end + 1 : end + 64].partition(" ")[0]
                    rows.add((folded[start : last + 1], zlib.crc32(f"{before} {after}".encode()), int(label)))
            yield pd.DataFrame(list(rows), columns=["term", "around", "label"])

    found = sample.mapInPandas(neighbours, "term string, around long, label int").distinct()
    return found.groupBy("term").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("n"))


def _strongest(sample: DataFrame, toxic: int, other: int) -> dict[str, float]:
    terms = _candidates(_counted(sample), toxic, other)
    if not terms:
        return {}
    gain, weight = _gain_and_weight(toxic, other)
    strong = _in_contexts(sample, terms).filter((F.col("t") > 0) & (weight > 1.0) & (gain >= MIN_GAIN))
    rows = strong.select("term", weight.alias("w")).collect()
    kept = {}
    for row in sorted(rows, key=lambda r: (len(r.term), r.term)):
        shorter = [kept[row.term[:i]] for i in range(2, len(row.term)) if row.term[:i] in kept]
        if not any(w >= row.w - 0.7 for w in shorter):  # a shorter beginning says as much
            kept[row.term] = round(float(row.w), 6)
    return kept


def _exceptions(sample: DataFrame, lexicon: Lexicon) -> list[str]:
    """Phrases of a term and the word before or after it that occur mostly in documents that are not toxic."""

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = lexicon.automaton()
        for batch in batches:
            rows = Counter()
            for text, label in zip(batch.text, batch.toxic):
                folded, phrases = fold(text), set()
                for start in lexicon.hits(folded, machine):
                    end = folded.index(" ", start + 1)
                    before, after = folded.rfind(" ", 0, start) if start else -1, folded.find(" ", end + 1)
                    phrases |= {folded[before : end + 1]} if before >= 0 else set()
                    phrases |= {folded[start : after + 1]} if after >= 0 else set()
                rows.update((p, int(label)) for p in phrases)
            yield pd.DataFrame([(p, l, c) for (p, l), c in rows.items()], columns=["phrase", "label", "n"])

    found = sample.mapInPandas(around, "phrase string, label int, n long").groupBy("phrase")
    rows = found.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("t"))
    harmless = rows.filter((F.col("n") >= EXCEPTION_ROWS) & (F.col("t") <= F.col("n") * EXCEPTION_SHARE))
    return [r.phrase for r in harmless.select("phrase").collect()]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Coefficients by Newton steps with a small ridge."""
    design, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - 0.01 * beta
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(3), slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def train(docs: DataFrame, labels: DataFrame, learn: Column, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Learns from documents (doc_id, text) whose labels (doc_id, toxic) satisfy ``learn``; four fifths of them give the
    lexicon, the others the coefficients. ``exceptions`` are phrases that never count."""
    bound_batches(docs.sparkSession)
    chosen = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(learn)
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(11))
    chosen = chosen.withColumn("_order", order).orderBy("_order", "doc_id").limit(SAMPLE_ROWS)
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"), F.pmod("_order", F.lit(5)).alias("fold"))
    # At most SAMPLE_ROWS ids, so the join needs no shuffle of the texts.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "toxic", "fold")
    sample = materialize(sample, "labelled")
    sizes = {r.toxic: r["count"] for r in sample.filter("fold > 0").groupBy("toxic").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = Lexicon(exceptions=[f" {' '.join(fold(p).split())} " for p in exceptions if fold(p).strip()])
    if toxic and other:
        lexicon.terms = _strongest(sample.filter("fold > 0"), toxic, other)
        lexicon.exceptions += _exceptions(sample.filter("fold > 0"), lexicon)
    measured = sample.select("toxic", features(F.col("text"), lexicon).alias("f"), "fold").select("toxic", "f.*", "fold").toPandas()
    held = measured[measured.fold == 0]
    held = held if held.toxic.nunique() > 1 else measured
    if held.toxic.nunique() > 1:
        lexicon.coefficients = _logistic(held[["hits", "density"]].to_numpy(float), held.toxic.to_numpy(float))
    elif len(held):
        share = float(held.toxic.mean())
        lexicon.coefficients = (float(np.log((share + 1e-9) / (1 - share + 1e-9))), 0.0, 0.0)
    return lexicon


def features(text: Column, lexicon: Lexicon) -> Column:
    """``hits`` and ``density`` of a text."""

    @F.pandas_udf("hits double, density double")
    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = lexicon.automaton()
        for batch in texts:
            yield pd.DataFrame([lexicon.features(t, machine) for t in batch], columns=["hits", "density"], dtype=float)

    return measure(text)


def score(text: Column | str, lexicon: Lexicon) -> Column:
    """The probability that a text is toxic."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = lexicon.automaton()
        for batch in texts:
            values = np.array([lexicon.features(t, machine) for t in batch], float).reshape(-1, 2)
            yield pd.Series(lexicon.probability(values))

    return scored(F.col(text) if isinstance(text, str) else text)
