"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score over its words; a document's score is the noisy-or
of its sentences', so training against document labels alone teaches which sentences offend. The likelihood is
maximised by full-batch gradient steps: every step is a Spark job over the instance table, and one gradient of bounded
length per task comes back. The model is fitted on at most ``max_docs`` labelled documents; scoring covers all texts.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.store import table, written

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class NoisyOrModel:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -30.0  # of a model without labels: no sentence offends


def features(word: str) -> tuple[str, ...]:
    """A word and its beginnings of 4 to 6 letters, which inflected and compound forms share."""
    return (word, *("^" + word[:k] for k in (4, 5, 6) if len(word) >= k))


class Hits(dict):
    """word -> those of its features that are in ``known``; a bounded memory of the words met so far."""

    def __init__(self, known, most: int = 100_000):
        super().__init__()
        self.known, self.most = known, most

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = tuple(x for x in features(word) if x in self.known)
        return found


def sentence_words(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and lower-cased words of each sentence (a run without . ! ? and line ends)."""
    for m in _SENTENCE.finditer(text):
        yield m.start(), m.end(), _WORD.findall(m.group().lower())


def labelled(docs: DataFrame, labels: DataFrame, max_docs: int = 20_000) -> DataFrame:
    """(text, toxic) of at most ``max_docs`` labelled rows outside the held-out fifth, chosen by a hash of doc_id."""
    ids = labels.where("toxic in (0, 1) and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").select("doc_id", "toxic")
    ids = ids.orderBy(F.xxhash64(F.col("doc_id").cast("long")), "doc_id", "toxic").limit(max_docs)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "toxic")  # at most max_docs ids


def choose_words(sample: DataFrame, most: int = 4096, least_docs: int = 3) -> tuple[list[str], np.ndarray, int, int]:
    """At most ``most`` words that tell the labels apart best, their log odds, and the numbers of 1s and 0s.

    Every distinct word of the sample is counted per label (by documents); the order is by the chi-squared statistic.
    """

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for s in range(0, len(f), 500):  # few documents at a time: their words are the memory this takes
                seen: dict[str, list[int]] = {}
                for text, toxic in zip(f["text"].iloc[s:s + 500], f["toxic"].iloc[s:s + 500]):
                    for x in {x for w in set(_WORD.findall((text or "").lower())) for x in features(w)}:
                        of = seen.setdefault(x, [0, 0])
                        of[0] += int(toxic)
                        of[1] += 1
                yield pd.DataFrame({"word": list(seen), "a": [v[0] for v in seen.values()], "n": [v[1] for v in seen.values()]})

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return [], np.empty(0), pos, neg
    counts = sample.mapInPandas(counted, "word string, a long, n long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("n").alias("n")).where(F.col("n") >= least_docs)
    a, n, total = F.col("a").cast("double"), F.col("n").cast("double"), float(pos + neg)
    gap = a * total - n * pos
    chi = gap * gap / (n * (F.lit(total) - n + 1.0))
    rows = counts.orderBy(chi.desc(), "word").limit(most).collect()
    odds = np.array([np.log((r["a"] + 0.5) / (pos + 1)) - np.log((r["n"] - r["a"] + 0.5) / (neg + 1)) for r in rows])
    return [r["word"] for r in rows], odds, pos, neg


def instances(sample: DataFrame, words: list[str]) -> DataFrame:
    """Per labelled document: toxic, number of sentences, and of those with chosen words their ends and word numbers."""
    at = {w: i for i, w in enumerate(words)}
    hits_of = Hits(at)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sizes, ends, numbers = [], [], []
            for text in f["text"]:
                own, stop, n = [], [], 0
                for _, _, found in sentence_words(text or ""):
                    n += 1
                    hits = sorted({at[x] for w in found for x in hits_of[w]})
                    if hits:
                        own += hits
                        stop.append(len(own))
                sizes.append(n)
                ends.append(stop)
                numbers.append(own)
            yield pd.DataFrame({"toxic": f["toxic"].astype("int32"), "sentences": sizes, "ends": ends, "words": numbers})

    return sample.mapInPandas(run, "toxic int, sentences int, ends array<int>, words array<int>")


def _gradients(weights: np.ndarray):
    """A task's summed log likelihood and gradient (bias last) at ``weights``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grad, loss, rows = np.zeros(len(weights)), 0.0, 0
        for f in frames:
            rows += len(f)
            words = np.concatenate([np.asarray(x, np.int64) for x in f["words"]] + [np.empty(0, np.int64)])
            per_doc = f["ends"].map(len).to_numpy()
            ends = [np.asarray(x, np.int64) for x in f["ends"]]
            lengths = np.concatenate([np.diff(x, prepend=0) for x in ends] + [np.empty(0, np.int64)])
            sentence = np.repeat(np.arange(len(lengths)), lengths)
            doc = np.repeat(np.arange(len(f)), per_doc)
            z = np.bincount(sentence, weights[words], len(lengths)) + weights[-1]
            bare = f["sentences"].to_numpy() - per_doc
            # log(1 - p) of a sentence is -softplus(z)
            quiet = -np.bincount(doc, np.logaddexp(0, z), len(f)) - bare * np.logaddexp(0, weights[-1])
            quiet = np.minimum(quiet, -1e-12)
            toxic = f["toxic"].to_numpy() == 1
            loud = np.log(-np.expm1(quiet))
            loss += float(np.where(toxic, loud, quiet).sum())
            pull = np.where(toxic, np.exp(quiet - loud), -1.0)  # d log likelihood / d softplus(z)
            p = 1 / (1 + np.exp(-z))
            back = p * pull[doc]
            grad[:-1] += np.bincount(words, back[sentence], len(weights) - 1)
            grad[-1] += back.sum() + (bare * pull).sum() / (1 + np.exp(-weights[-1]))
        yield pd.DataFrame({"rows": [rows], "loss": [loss], "grad": [grad]})

    return run


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 20_000, most_words: int = 4096, steps: int = 60, rate: float = 0.4, lasso: float = 2e-3) -> NoisyOrModel:
    """Adam steps from the features' log odds, with weights that are kept sparse and never below 0: a word can offend
    but not excuse. Without labels of both kinds the model in which nothing offends."""
    sample = written(labelled(docs, labels, max_docs), "toxicity-sample")
    words, odds, pos, neg = choose_words(sample, most_words)
    if not words:
        return NoisyOrModel()
    table_ = written(instances(sample, words).coalesce(8), "toxicity-instances")
    at = np.append(np.clip(odds, 0, 4), -8.0)
    first, second = np.zeros_like(at), np.zeros_like(at)
    for step in range(1, steps + 1):
        parts = table_.mapInPandas(_gradients(at), "rows long, loss double, grad array<double>").collect()
        grad = np.sum([r["grad"] for r in parts], axis=0) / (pos + neg)
        first = 0.9 * first + 0.1 * grad
        second = 0.98 * second + 0.02 * grad * grad
        speed = rate * min(1.0, 3 * (1 - (step - 1) / steps))
        at = at + speed * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.98**step)) + 1e-6)
        at[:-1] = np.maximum(0.0, at[:-1] - lasso * speed)
    return NoisyOrModel({w: float(x) for w, x in zip(words, at[:-1]) if x > 0}, float(at[-1]))


class Scorer:
    """Scores texts by a model in one task."""

    def __init__(self, weights: dict[str, float], bias: float, threshold: float):
        self.weights, self.bias, self.threshold = weights, bias, threshold
        self.bare, self.hits_of = float(np.logaddexp(0, bias)), Hits(weights)

    def __call__(self, text: str) -> tuple[float, list[dict]]:
        """The score of a text and its offending sentences."""
        quiet, offends = 0.0, []
        for m in _SENTENCE.finditer(text):
            hits = {x for w in _WORD.findall(m.group().lower()) for x in self.hits_of[w]}
            if hits:
                z = self.bias + sum([self.weights[x] for x in sorted(hits)])
                quiet += math.log1p(math.exp(-abs(z))) + max(z, 0.0)
                p = 1 / (1 + math.exp(-z))
                if p >= self.threshold:
                    offends.append({"start": m.start(), "end": m.end(), "score": p})
            else:
                quiet += self.bare
        return -math.expm1(-quiet), offends


def score_documents(docs: DataFrame, model: NoisyOrModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted, and the offending sentences as (start, end, score) with a score of ``threshold`` or more.

    One row per row of ``docs``; only doc_id and text are read, and doc_id is only passed on. Null, empty or wordless
    texts are scored like the bags they are: no sentence, score 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # at most most_words words
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*sent.value, threshold)
        for batch in batches:
            found = [score(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found], pa.float64()), pa.array([int(f[0] >= 0.5) for f in found], pa.int32()), pa.array([f[1] for f in found], span)], ["doc_id", "score", "predicted", "offending"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int, offending array<struct<start:int,end:int,score:double>>")


def keep_clean(docs: DataFrame, model: NoisyOrModel) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # at most most_words words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*sent.value, 2.0)
        for batch in batches:
            yield batch.filter(pa.array([score(text.as_py() or "")[0] < 0.5 for text in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending"))
