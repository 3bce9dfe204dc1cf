"""Toxicity severity by cumulative-link (proportional odds) ordinal regression.

Grades 0 (clean) to 3. For thresholds b_1 < b_2 < b_3 and one weight vector w shared by
all of them, P(grade >= j) = sigmoid(w.x - b_j); the expected severity is the sum of
these probabilities. Features are sparse: a document's words and their prefixes of 4, 5
and 6 letters (so that inflected forms of one stem share a weight); a feature's value is
its number of occurrences per 1000 words, at most ``MAX_VALUE``.

The labels say toxic or not. Grades of toxic training documents follow from dose: the
share of their words that carry a feature of the model, cut at its terciles.

The classifier is fitted on a bounded sample of labelled rows: at most ``TRAIN_ROWS``
documents of each label, those with the smallest hashes of doc_id (equal texts once),
and at most ``MAX_FEATURES`` features: those in most toxic documents (in at least
``MIN_SHARE`` of them and ``MIN_RATIO`` times the share of clean ones, or ``SURE_RATIO``
times if their log odds differ by ``SURE_Z`` standard errors; words of more than 64
characters are no features, their prefixes are). Their weights are held at
0 or more. Scoring reads every whole text.

Defined results: null or empty text has no features and grade 0; a label other than 0
and 1 or without document is ignored, repeated labels of one document count as toxic if
one of them is; if the labels hold only one class nothing is learned and every document
gets severity 0 and is kept. Other columns are carried along.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

GRADES = 4
TRAIN_ROWS = 5_000
MAX_FEATURES = 1_024
MIN_DOCS = 5
MIN_SHARE = 0.02
MIN_RATIO = 8.0
SURE_RATIO = 4.0
SURE_Z = 6.0
MAX_VALUE = 30.0
#: A document counts as toxic from this probability of grade 1 or more.
FLAG = 0.2
PREFIXES = (4, 5, 6)
L2 = 1e-4
STEPS = 600
MAX_CACHED_WORDS = 400_000
_STRIP = re.compile(r"^\W+|\W+$")


def word_features(word: str) -> tuple[str, ...]:
    """Features of one white-space word: itself and its prefixes (a final * marks those)."""
    w = _STRIP.sub("", word)
    if not w:
        return ()
    return (w, *(w[:n] + "*" for n in PREFIXES if len(w) >= n))


@dataclass(frozen=True)
class OrdinalModel:
    features: tuple[str, ...]
    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1 .. GRADES - 1; one row per score."""
        return 1.0 / (1.0 + np.exp(np.clip(self.cuts - score[:, None], -500, 500)))


def feature_counts(text: str | None, known: Callable[[str], tuple[int, ...]]) -> tuple[int, int, Counter]:
    """(words, words with a known feature, occurrences by feature index) of a whole text."""
    words = Counter((text or "").lower().split())
    found: Counter = Counter()
    hits = 0
    for word, n in words.items():
        features = known(word)
        if features:
            hits += n
            for f in features:
                found[f] += n
    return sum(words.values()), hits, found


def values(n_words: int, found: Counter) -> list[tuple[int, float]]:
    return [(f, min(1000.0 * n / n_words, MAX_VALUE) / 10.0) for f, n in sorted(found.items())]


class _Lookup(dict):
    """Word -> indices of its features in the model, remembered up to a bound."""

    def __init__(self, features: tuple[str, ...]):
        super().__init__()
        self.index = {f: i for i, f in enumerate(features)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        found = tuple(self.index[f] for f in word_features(word) if f in self.index)
        if len(word) <= 64:
            self[word] = found
        return found


def _distinct_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, feature) once per document."""
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = set((text.as_py() or "").lower().split())
            features = sorted({f for w in words for f in word_features(w) if len(f) <= 64})
            yield pa.record_batch([pa.array([toxic] * len(features), pa.int32()), pa.array(features, pa.string())],
                                  names=["toxic", "feature"])


def _rows_of(features: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(features)
        for batch in batches:
            out = {"toxic": [], "n_words": [], "hits": [], "ids": [], "counts": []}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, hits, found = feature_counts(text.as_py(), lookup.__getitem__)
                items = sorted(found.items())
                for k, v in zip(out, (toxic, n, hits, [i for i, _ in items], [c for _, c in items])):
                    out[k].append(v)
            yield pa.record_batch([pa.array(out["toxic"], pa.int32()), pa.array(out["n_words"], pa.int64()),
                                   pa.array(out["hits"], pa.int64()), pa.array(out["ids"], pa.list_(pa.int32())),
                                   pa.array(out["counts"], pa.list_(pa.int64()))], names=list(out))

    return run


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(toxic, text) of at most ``rows`` labelled documents per label."""
    one = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
           .where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    parts = [one.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for t in (0, 1)]
    ids = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * rows pairs of numbers
    return docs.select("doc_id", "text").join(ids, "doc_id").select("toxic", "text").distinct()


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, max_features: int = MAX_FEATURES) -> OrdinalModel | None:
    sample = training_sample(docs, labels, rows)
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return None
    counted = (sample.mapInArrow(_distinct_features, "toxic int, feature string").groupBy("feature")
               .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")))
    often = F.col("t") >= max(MIN_DOCS, MIN_SHARE * pos)
    ratio = F.col("t") * neg / (pos * (F.col("c") + 0.5))
    t, c, t0, c0 = F.col("t") + 0.5, F.col("c") + 0.5, F.lit(pos) - F.col("t") + 0.5, F.lit(neg) - F.col("c") + 0.5
    z = (F.log(t / t0) - F.log(c / c0)) / F.sqrt(1 / t + 1 / t0 + 1 / c + 1 / c0)
    leaning = (ratio >= MIN_RATIO) | (ratio >= SURE_RATIO) & (z >= SURE_Z)
    chosen = counted.where(often & leaning).orderBy(F.desc("t"), "feature").limit(max_features).collect()
    features = tuple(r["feature"] for r in chosen)
    # Bounded: at most 2 * rows documents with at most max_features numbers each.
    data = sample.mapInArrow(_rows_of(features), "toxic int, n_words long, hits long, ids array<int>, counts array<long>")
    return train(features, [tuple(r) for r in data.collect()])


def grades(data: list[tuple]) -> np.ndarray:
    """0 for clean; 1 to 3 by the terciles of the dose among the toxic documents."""
    dose = np.array([hits / max(n, 1) for _, n, hits, _, _ in data])
    toxic = np.array([t == 1 for t, *_ in data], bool)
    inner = np.quantile(dose[toxic], [j / (GRADES - 1) for j in range(1, GRADES - 1)])
    return np.where(toxic, 1 + np.searchsorted(inner, dose, side="left"), 0)


def train(features: tuple[str, ...], data: list[tuple]) -> OrdinalModel:
    """Maximum likelihood by gradient steps; rows are (toxic, n_words, hits, ids, counts)."""
    data = sorted(data, key=lambda r: (*r[:3], list(r[3]), list(r[4])))  # the same sums in every run
    y = grades(data)
    row, col, val = [], [], []
    for k, (_, n, _, ids, counts) in enumerate(data):
        for f, v in values(n, Counter(dict(zip(ids, counts)))):
            row.append(k)
            col.append(f)
            val.append(v)
    row, col, val = np.array(row, int), np.array(col, int), np.array(val, float)
    n, k = len(data), GRADES - 1
    # Each class weighs the same, whatever its share in the sample.
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    params = np.zeros(len(features) + k)
    params[len(features):] = [1.0, 0.0, 0.0]  # first threshold, then logs of the steps between thresholds
    m, v = np.zeros_like(params), np.zeros_like(params)
    rows_ = np.arange(n)
    for step in range(1, STEPS + 1):
        w, raw = params[:len(features)], params[len(features):]
        cuts = raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])
        score = np.bincount(row, val * w[col], n) if len(row) else np.zeros(n)
        tail = 1.0 / (1.0 + np.exp(np.clip(cuts - score[:, None], -500, 500)))
        full = np.column_stack([np.ones(n), tail, np.zeros(n)])
        p = np.maximum(full[rows_, y] - full[rows_, y + 1], 1e-12)
        slope = np.column_stack([np.zeros(n), tail * (1 - tail), np.zeros(n)])
        upper, lower = slope[rows_, y] / p, slope[rows_, y + 1] / p
        g_score = -(upper - lower) * share
        g_cut = np.zeros(k)
        for j in range(1, k + 1):
            g_cut[j - 1] = (share * (upper * (y == j) - lower * (y == j - 1))).sum()
        g_w = (np.bincount(col, val * g_score[row], len(features)) if len(row) else np.zeros(len(features))) + L2 * w
        steps = np.exp(raw[1:])
        g_raw = np.concatenate([[g_cut.sum()], [g_cut[j + 1:].sum() * steps[j] for j in range(k - 1)]])
        g = np.concatenate([g_w, g_raw])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        np.maximum(params[:len(features)], 0.0, out=params[:len(features)])  # only toxic-leaning features were chosen
    raw = params[len(features):]
    cuts = raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])
    return OrdinalModel(features, params[:len(features)], cuts)


def score(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``toxicity``: expected_severity, severity, toxic."""
    schema = "expected_severity double, severity int, toxic boolean"
    if model is None:
        none = F.struct(F.lit(0.0).alias("expected_severity"), F.lit(0).alias("severity"), F.lit(False).alias("toxic"))
        return docs.withColumn("toxicity", none)

    @F.pandas_udf(schema)
    def graded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lookup = _Lookup(model.features)
        for texts in batches:
            scores = np.zeros(len(texts))
            for k, text in enumerate(texts):
                n, _, found = feature_counts(text, lookup.__getitem__)
                scores[k] = math.fsum(v * model.weights[f] for f, v in values(n, found))
            tail = model.tails(scores)
            full = np.column_stack([np.ones(len(scores)), tail, np.zeros(len(scores))])
            yield pd.DataFrame({"expected_severity": np.round(tail.sum(axis=1), 6),
                                "severity": (full[:, :-1] - full[:, 1:]).argmax(axis=1).astype("int32"),
                                "toxic": tail[:, 0] >= FLAG})

    return docs.withColumn("toxicity", graded(F.col(f"`{text_col}`").cast("string")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the struct column ``toxicity``; the model is fitted on ``labels``."""
    return score(docs, fit(docs, labels))


# ---------------------------------------------------------------- query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "toxicity.expected_severity", "toxicity.severity", "toxicity.toxic",
                         (~F.col("toxicity.toxic")).alias("kept"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE: dict[str, str] = {}
