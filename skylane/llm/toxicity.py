"""Toxicity by multiple-instance learning.

A document is a bag of sentences and is toxic when any sentence is: a sentence's
probability is logistic in its words, the document's is one minus the product of the
sentences' complements (noisy-or). Only documents carry labels; the gradient of the
noisy-or hands each label down to the sentences that explain it, which then can be named.

A word counts through itself and through its beginnings of three to seven letters, so that
inflected forms of a stem share what is learned. Words are runs of letters, lower-cased.
Sentences end at ``.``, ``!``, ``?`` or a line break.

The model is fitted on a bounded sample: at most ``per_class`` labelled documents of each
label, chosen by the hash of their id, each of at most ``max_chars`` characters. Scoring
reads every text whole. A null or empty text and one without letters score 0; without
documents of both labels every score is 0. Repeated ids in the labels count once, as toxic
if any of them says so.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane.llm import rows

PER_CLASS = 2000
MAX_CHARS = 20_000
MIN_DOCS = 4
STEMS = (3, 4, 5, 6, 7)
TELLING = 2.0
ROUNDS = 150
L1 = 3e-4
THRESHOLD = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 100_000

SENTENCES = "array<struct<start:int,end:int,score:double>>"


def features(word: str) -> list[str]:
    """The word, marked as whole, and its beginnings."""
    return [word + "$", *(word[:n] for n in STEMS if n <= len(word))]


class Weights(dict):
    """Weight of a word, worked out once and remembered; emptied when it grows too large."""

    def __init__(self, bias: float, learned: dict[str, float]):
        super().__init__()
        self.bias, self.learned = bias, learned

    def __reduce__(self):
        return Weights, (self.bias, self.learned)

    def __missing__(self, word: str) -> float:
        if len(self) >= _REMEMBERED:
            self.clear()
        weight = self[word] = sum(self.learned.get(f, 0.0) for f in features(word))
        return weight

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """Start, end and logit of every sentence with a word that says something.

        The others have probability 0, so that a long clean text gathers no score.
        """
        get = self.__getitem__
        for m in _SENTENCE.finditer(text):
            weight = sum(map(get, set(_WORD.findall(m[0].lower()))))
            if weight:
                yield m.start(), m.end(), self.bias + weight

    def score(self, text: str | None) -> float:
        """Noisy-or of the sentences; exact for small probabilities as well."""
        if not text or not self.learned:
            return 0.0
        clean = sum(log_complement(z) for _, _, z in self.sentences(text))
        return min(1.0, max(0.0, -math.expm1(clean)))


def log_complement(logit: float) -> float:
    """log(1 - sigmoid(logit))."""
    return -(logit + math.log1p(math.exp(-logit))) if logit > 0 else -math.log1p(math.exp(logit))


def fit(texts: list[str], toxic: list[int], rounds: int = ROUNDS, l1: float = L1) -> Weights:
    """Gradient ascent on the noisy-or likelihood, with Adagrad steps and an L1 penalty."""
    if len(set(toxic)) < 2:
        return Weights(0.0, {})
    numbers: dict[str, int] = {}
    bags, seen = [], (Counter(), Counter())
    for text, y in zip(texts, toxic):
        bag = [
            array("i", {numbers.setdefault(w, len(numbers)) for w in found})
            for m in _SENTENCE.finditer(text) if (found := _WORD.findall(m[0].lower()))
        ]
        bags.append(bag)
        seen[y].update(set().union(*bag))
    words = list(numbers)
    in_docs = (Counter(), Counter())
    for y in (0, 1):
        for word, n in seen[y].items():
            for f in features(words[word]):
                in_docs[y][f] += n
    # A beginning is counted once for each word of a document that has it; what matters is
    # that features as frequent in one class as in the other can't tell anything.
    sizes = [max(1, toxic.count(y)) for y in (0, 1)]
    telling = []
    for f in sorted(in_docs[0].keys() | in_docs[1].keys()):
        clean, bad = (in_docs[y][f] for y in (0, 1))
        rate = (bad + 0.5) / sizes[1] / ((clean + 0.5) / sizes[0])
        if clean + bad >= MIN_DOCS and not 1 / TELLING < rate < TELLING:
            telling.append(f)
    index = {f: i for i, f in enumerate(telling)}
    known = {i: found for i, w in enumerate(words) if (found := [index[f] for f in features(w) if f in index])}
    sentence_of, feature_of, bag_of = [], [], []
    for b, bag in enumerate(bags):
        for sentence in bag:
            found = [i for w in sentence if w in known for i in known[w]]
            if not found:
                continue
            feature_of.extend(found)
            sentence_of.extend([len(bag_of)] * len(found))
            bag_of.append(b)
    if not bag_of:
        return Weights(0.0, {})
    sentence_of, feature_of, bag_of = (np.array(x, dtype=np.int32) for x in (sentence_of, feature_of, bag_of))
    y = np.array(toxic, dtype=float)
    # Each class weighs half, so the share of toxic labels in the sample doesn't matter.
    of_class = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w, bias = np.zeros(len(index)), -9.0
    square, square_bias, rate = np.full(len(index), 1e-6), 1e-6, 0.3
    for _ in range(rounds):
        logit = bias + np.bincount(sentence_of, w[feature_of], minlength=len(bag_of))
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        clean = np.bincount(bag_of, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        toxic_p = np.maximum(-np.expm1(clean), 1e-9)
        # d log-likelihood / d logit: up by the sentence's share of a toxic bag, down in a clean one.
        up = (1 - toxic_p) / toxic_p
        g = p * np.where(y[bag_of] == 1, up[bag_of], -1.0) * of_class[bag_of] / len(y)
        gw = np.bincount(feature_of, g[sentence_of], minlength=len(index))
        gb = g.sum()
        square += gw**2
        square_bias += gb**2
        step = rate / np.sqrt(square)
        w += step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1 / len(STEMS), 0)
        bias += rate * gb / math.sqrt(square_bias)
    names = sorted(index, key=index.get)
    return Weights(float(bias), {f: float(x) for f, x in zip(names, w) if x})


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    per_class: int = PER_CLASS,
    max_chars: int = MAX_CHARS,
) -> Weights:
    """Weights from the labelled documents that aren't held out.

    Only the chosen documents' ids, at most twice ``per_class``, are broadcast, and only
    their texts come to the driver.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~rows.held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    short = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where(
        F.length("text").between(1, max_chars)
    )
    known = known.join(short.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    sample = (
        short.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .orderBy("doc_id").collect()
    )
    return fit([r["text"] for r in sample], [int(r["toxic"]) for r in sample])


def scorer(spark: SparkSession, weights: Weights):
    """Column function: a text's probability of being toxic."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in rows.slices(batches):
            yield pa.array([model.score(t.as_py()) for t in batch], pa.float64())

    return score


def locator(spark: SparkSession, weights: Weights, threshold: float = THRESHOLD):
    """Column function: the sentences of a text that reach ``threshold`` by themselves."""
    shared = spark.sparkContext.broadcast(weights)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    @F.arrow_udf(SENTENCES)
    def locate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in rows.slices(batches):
            out = []
            for value in batch:
                text, found = value.as_py() or "", []
                for start, end, logit in model.sentences(text) if model.learned else ():
                    p = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
                    if p >= threshold:
                        found.append({"start": start, "end": end, "score": p})
                out.append(found)
            yield pa.array(out, kind)

    return locate


def score_documents(docs: DataFrame, weights: Weights, text: str = "text") -> Column:
    """Column of scores for the column ``text`` of ``docs``."""
    return scorer(docs.sparkSession, weights)(F.col(f"`{text}`"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    return docs.where(score_documents(docs, train(docs, labels)) < threshold)
