"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has a probability of offending,
a logistic model of its words; the document's is their noisy-or.  Only documents
are labelled; the sentence model is trained through the noisy-or, and afterwards
tells which sentences offend.  Sentences without a known feature contribute
nothing, in training and in scoring, so that length alone is never toxic.

A bounded sample of labelled documents, whole texts, is turned into feature numbers
inside tasks.  Spark counts in how many documents each feature occurs; only the
features that are kept, a few thousand, leave the tasks, and the model is fitted to
them on the driver.
Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duetto.llm.common import cut, fold_of, fresh

#: Bound of the sample: expected number of documents of either label; twice as many
#: rows are drawn at most.
SAMPLE_DOCS = 1500
PREFIXES = (4, 5, 6)        # a word counts as itself and by its beginnings
BUCKETS = 1 << 20
MIN_DOCS = 4                # a feature occurs in so many sampled toxic documents
MIN_LIFT = 3.0              # and so many times oftener among them than among others
MAX_FEATURES = 4000
STEPS, RATE, SHRINK = 150, 0.3, 0.002
NEGLIGIBLE = 0.15           # smaller weights are dropped after the fit
FLOOR = 0.05                # sentences below it contribute nothing to a document's score

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    bias: float
    features: np.ndarray    # sorted
    weights: np.ndarray


#: What is learned without labels of both kinds: nothing offends.
NONE = Model(-30.0, np.zeros(0, np.int64), np.zeros(0))


def word_features(word: str) -> tuple[int, ...]:
    """Feature numbers of a lower-cased word: itself and its beginnings."""
    keys = [f"={word}", *(f"^{word[:k]}" for k in PREFIXES if len(word) >= k)]
    return tuple(zlib.crc32(k.encode("utf-8", "surrogatepass")) % BUCKETS for k in keys)


def sentence_features(sentence: str) -> set[int]:
    return {f for w in set(WORD.findall(sentence.lower())) for f in word_features(w)}


class Bag(NamedTuple):
    """The sentences of a document that have a feature: equal ones are counted."""
    toxic: int
    sentences: list[tuple[np.ndarray, int]]


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]] | None:
    """``doc_id, toxic, text`` of about ``SAMPLE_DOCS`` documents of either label, by
    a hash of the id, and the share that was drawn of either.

    Rows that are held out, or have no valid label, take no part.  Rows that repeat
    id and text are one; of all rows, those with the smallest hash of both stand, up
    to twice ``SAMPLE_DOCS`` of a label, so that an id with many texts is bounded.
    """
    known = (labels.select("doc_id", "toxic").filter("doc_id is not null and toxic in (0, 1)")
             .filter(~fold_of(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    h = F.pmod(F.xxhash64(F.lit("toxicity sample"), "doc_id"), F.lit(1_000_000))
    share = {y: min(1.0, SAMPLE_DOCS / n) for y, n in counts.items()}
    limit = F.when(F.col("toxic") == 1, int(1_000_000 * share[1]) + 1).otherwise(
        int(1_000_000 * share[0]) + 1)
    # A sample of labels, bounded by SAMPLE_DOCS, is the broadcast side.
    picked = F.broadcast(known.filter(h < limit))
    once = (docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("th")).join(picked, "doc_id")
            .groupBy("doc_id", "toxic", "th").agg(F.first("text").alias("text")))
    order = Window.partitionBy("toxic").orderBy("th", "doc_id")
    return cut(once.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= 2 * SAMPLE_DOCS)
               .select("doc_id", "toxic", "text")), share


def kept_features(sample: DataFrame) -> np.ndarray:
    """The features, sorted, that occur in ``MIN_DOCS`` toxic documents of the sample
    and ``MIN_LIFT`` times oftener among them than among others."""
    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"toxic": b["toxic"].astype("int32"), "features": [
                sorted(set().union(*(word_features(w) for w in set(WORD.findall((t or "").lower())))))
                for t in b["text"]]})

    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return np.zeros(0, np.int64)
    counted = (sample.select("toxic", "text").mapInPandas(distinct, "toxic int, features array<int>")
               .select("toxic", F.explode("features").alias("feature")).groupBy("feature")
               .agg(F.sum("toxic").alias("d1"), F.sum(1 - F.col("toxic")).alias("d0")))
    lift = ((F.col("d1") + 0.5) / (n1 + 1)) / ((F.col("d0") + 0.5) / (n0 + 1))
    rows = (counted.withColumn("lift", lift).filter((F.col("d1") >= min(MIN_DOCS, n1)) & (F.col("lift") >= MIN_LIFT))
            .orderBy(F.desc(F.col("lift") * F.col("d1")), "feature").limit(MAX_FEATURES).collect())
    return np.array(sorted(r["feature"] for r in rows), dtype=np.int64)


def training_bags(sample: DataFrame, features: np.ndarray) -> list[Bag]:
    """The sample's bags; features are numbered by their place in ``features``."""
    number = {int(f): i for i, f in enumerate(features)}

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, y, text in zip(b["doc_id"], b["toxic"], b["text"]):
                sets = Counter(tuple(sorted(number[f] for f in sentence_features(s.group()) if f in number))
                               for s in SENTENCE.finditer(text or ""))
                sets.pop((), None)
                rows.append((doc_id, int(y), [list(x) for x in sorted(sets)], [sets[x] for x in sorted(sets)]))
            yield pd.DataFrame(rows, columns=["doc_id", "toxic", "sets", "counts"])

    got = sample.mapInPandas(bags, "doc_id bigint, toxic int, sets array<array<int>>, counts array<int>").collect()
    return [Bag(r["toxic"], [(np.array(x, dtype=np.int64), c) for x, c in zip(r["sets"], r["counts"])])
            for r in sorted(got)]


class Entries(NamedTuple):
    """All bags as flat arrays: for each (sentence, feature) both numbers, for each
    sentence its document and how often it occurs, for each document label and weight."""
    sentence: np.ndarray
    feature: np.ndarray
    document: np.ndarray
    times: np.ndarray
    toxic: np.ndarray
    weight: np.ndarray


def entries(bags: list[Bag], weights: list[float]) -> Entries:
    flat = [(d, x, c) for d, bag in enumerate(bags) for x, c in bag.sentences]
    return Entries(
        np.repeat(np.arange(len(flat)), [len(x) for _, x, _ in flat]).astype(np.int64),
        np.concatenate([np.zeros(0, np.int64), *(x for _, x, _ in flat)]),
        np.array([d for d, _, _ in flat], dtype=np.int64), np.array([c for _, _, c in flat], dtype=float),
        np.array([b.toxic for b in bags], dtype=float), np.array(weights, dtype=float) / sum(weights))


def loss(theta: np.ndarray, e: Entries) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of the labels under the noisy-or, with the penalty on
    the weights, and its gradient; the last of ``theta`` is the bias."""
    k = len(theta) - 1
    z = theta[-1] + np.bincount(e.sentence, weights=theta[e.feature], minlength=len(e.document))
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
    clean = np.bincount(e.document, weights=e.times * np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(e.toxic))
    q = np.exp(clean)                                   # no sentence offends
    each = np.where(e.toxic == 1, -np.log(np.maximum(1 - q, 1e-9)), -clean)
    pull = np.where(e.toxic == 1, -q / np.maximum(1 - q, 1e-9), 1.0) * e.weight
    dz = pull[e.document] * p * e.times
    g = np.append(np.bincount(e.feature, weights=dz[e.sentence], minlength=k), dz.sum())
    g[:-1] += SHRINK * theta[:-1] / k
    return float((each * e.weight).sum() + SHRINK * (theta[:-1] ** 2).sum() / (2 * k)), g


def fit(features: np.ndarray, e: Entries) -> Model:
    """Weights that maximise the likelihood of the labels under the noisy-or."""
    if not len(features):
        return NONE
    theta = np.zeros(len(features) + 1)
    theta[-1] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        _, g = loss(theta, e)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
    kept = np.abs(theta[:-1]) >= NEGLIGIBLE
    return Model(float(theta[-1]), features[kept], theta[:-1][kept])


class Scorer:
    """Sentence and document probabilities of one model, for use inside a task."""

    CACHE = 500_000         # words remembered; then the memory starts anew

    def __init__(self, model: Model):
        self.bias = model.bias
        self.weights = dict(zip(model.features.tolist(), model.weights.tolist()))
        self.words: dict[str, tuple[int, ...]] = {}

    def known(self, word: str) -> tuple[int, ...]:
        """The word's features that have a weight."""
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= self.CACHE:
                self.words.clear()
            got = self.words[word] = tuple(f for f in word_features(word) if f in self.weights)
        return got

    def sentence(self, sentence: str) -> float:
        """The sentence's probability; 0 without a known feature."""
        found = {f for w in set(WORD.findall(sentence.lower())) for f in self.known(w)}
        return self._p(self.bias + sum(self.weights[f] for f in sorted(found))) if found else 0.0

    @staticmethod
    def _p(z: float) -> float:
        return float(1.0 / (1.0 + np.exp(-min(max(z, -30.0), 30.0))))

    def document(self, text: str | None) -> tuple[float, int, int, int]:
        """Probability; number of offending sentences; start and end (code points)
        of the worst sentence, -1 if none has a known feature."""
        text = text or ""
        if not any(self.known(w) for w in set(WORD.findall(text.lower()))):
            return 0.0, 0, -1, -1
        clean, count, worst, span = 1.0, 0, 0.0, (-1, -1)
        for s in SENTENCE.finditer(text):
            p = self.sentence(s.group())
            clean *= 1.0 - p if p >= FLOOR else 1.0
            count += p >= 0.5
            if p > worst:
                worst, span = p, s.span()
        return 1.0 - clean, int(count), *span


def score(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``name``: ``score, n_sentences, worst_start,
    worst_end``; a null or empty text has no sentence and score 0."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("score double, n_sentences int, worst_start int, worst_end int")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(Model(*shared.value))
        for texts in batches:
            yield pd.DataFrame([scorer.document(t) for t in texts.tolist()],
                               columns=["score", "n_sentences", "worst_start", "worst_end"])

    return docs.withColumn(name, judge(F.col("text")))


def offending_sentences(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``doc_id, start, end, p, sentence`` of the sentences whose probability is
    ``least`` or more; offsets are code points, end exclusive.  Null and empty texts
    have none; repeated rows and sentences are each listed; further columns are
    ignored; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("array<struct<start:int,end:int,p:double,sentence:string>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(Model(*shared.value))
        for texts in batches:
            yield pd.Series([[{"start": s.start(), "end": s.end(), "p": p, "sentence": s.group()}
                              for s in SENTENCE.finditer(t or "")
                              if (p := scorer.sentence(s.group())) >= least]
                             for t in texts.tolist()])

    return (docs.select("doc_id", F.explode(find(F.col("text"))).alias("s"))
            .select("doc_id", "s.start", "s.end", "s.p", "s.sentence"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of the labelled documents that are not held out."""
    drawn = labelled_sample(docs, labels)
    if drawn is None:
        return NONE
    sample, share = drawn
    features = kept_features(sample)
    if not len(features):
        return NONE
    bags = training_bags(sample, features)
    # The weights of rows undo the sampling.
    return fit(features, entries(bags, [1.0 / share[b.toxic] for b in bags]))


def judge_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_sentences, worst_start,
    worst_end`` for every row of ``docs`` (``doc_id, text``; further columns are
    ignored).

    Without labels of both kinds every score is 0, as for null and empty texts and
    those without a known feature.  Very long texts are scored whole, sentence by
    sentence; of equally bad sentences the first is the worst.  Repeated rows are each
    returned; an empty table gives an empty result.
    """
    own = score(docs.select("doc_id", "text"), train(docs, labels))
    p = F.col("toxicity.score")
    return own.select("doc_id", fold_of(F.col("doc_id")).alias("held_out"), p.alias("score"),
                      F.when(p >= 0.5, 1).otherwise(0).alias("predicted"),
                      "toxicity.n_sentences", "toxicity.worst_start", "toxicity.worst_end")


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5; all columns stay, whatever their
    names.  Null and empty texts stay; long ones are judged whole; repeated rows stay
    or go together; an empty table stays empty."""
    name = fresh(docs, "toxicity")
    judged = score(docs, train(docs, labels), name)
    return judged.filter(F.col(f"{name}.score") < 0.5).drop(name)
