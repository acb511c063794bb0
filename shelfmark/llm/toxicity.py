"""Toxic passages as maximum-scoring segments of token log-odds.

Training counts labelled documents that hold a token or its leading letters and weighs these by log-odds under an
informative Dirichlet prior.  A document is then a sequence of token scores; one linear scan finds every maximal
scoring segment.  Segment scores of clean documents follow an extreme-value law (Karlin and Altschul), which turns a
score into an expected number of chance segments; a document's evidence is calibrated to a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import CACHE_WORDS, materialise, rows_of, texts_of

_TOKEN = re.compile(r"[^\W\d_]+")
_LEADS = (4, 5, 6)
_FLUSH = 200_000
_BINS = 400


@dataclass(frozen=True)
class Settings:
    """The prior of a feature is half a document and ``prior_share`` of all that hold it.

    ``training_rows`` bounds the labelled documents that the model is fitted on, ``lexicon`` the model: that many of
    the most significant features are kept and broadcast.  Every document is scored.
    """

    training_rows: int = 20_000
    prior_share: float = 0.02
    least_z: float = 3.8
    least_weight: float = 2.5  # significant but weak features would make every text look toxic by chance
    lexicon: int = 50_000
    passage_rate: float = 0.25
    significance: float = 0.01


@dataclass(frozen=True)
class Model:
    weights: dict
    penalty: float
    decay: float
    scale: float
    slope: float
    offset: float
    significance: float


def features(word: str) -> list[str]:
    """A word and its leading letters; a lead ends in ``*`` so that it differs from the word itself."""
    return [word, *(word[:k] + "*" for k in _LEADS if len(word) >= k)]


class Weights(dict):
    """Score per word, found once: the largest weight among its features, else a penalty."""

    def __init__(self, weights: dict, penalty: float):
        super().__init__()
        self.weights, self.penalty = weights, penalty

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = [self.weights[x] for x in features(word) if x in self.weights]
        self[word] = out = max(found) if found else self.penalty
        return out


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` in one pass (Ruzzo and Tompa)."""
    up = scores > 0
    if not up.any():
        return []
    # Runs of one sign stand for their sums, so the scan is as long as there are runs of positive scores.
    change = np.flatnonzero(np.diff(up)) + 1
    starts = np.concatenate(([0], change))
    ends = np.concatenate((change, [len(scores)]))
    before = np.concatenate(([0.0], np.cumsum(scores)))
    held: list[list] = []  # start, end, total left of it, total up to its end, index of the last one with less on the left
    for start, end in zip(starts[up[starts]].tolist(), ends[up[starts]].tolist()):
        one = [start, end, before[start], before[end], -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= one[2]:
                j = held[j][4]
            if j < 0 or held[j][3] >= one[3]:
                one[4] = j
                held.append(one)
                break
            one = [held[j][0], one[1], held[j][2], one[3], -1]
            del held[j:]
    return [(s, e, float(right - left)) for s, e, left, right, _ in held]


def _counts(labelled: DataFrame) -> DataFrame:
    """``(feature, toxic, clean)``: documents of either label that hold a feature, summed per batch before the shuffle.

    Documents are counted, not occurrences, so that one text that repeats a word carries no more than another.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {0: Counter(), 1: Counter()}

        def emit() -> pd.DataFrame:
            names = list({x: None for side in sums.values() for x in side})
            out = pd.DataFrame({"feature": texts_of(names), "toxic": [sums[1][x] for x in names], "clean": [sums[0][x] for x in names]})
            for side in sums.values():
                side.clear()
            return out

        for rows in rows_of(batches):
            for text, label in zip(rows["text"], rows["label"]):
                words = set(_TOKEN.findall(text.lower()))
                sums[label].update(words)
                for k in _LEADS:
                    sums[label].update({x[:k] + "*" for x in words if len(x) >= k})
            if len(sums[0]) + len(sums[1]) > _FLUSH:
                yield emit()
        yield emit()

    counted = labelled.mapInPandas(count, "feature string, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def evidence(found: list[tuple[int, int, float]], n: int, model: Model) -> float:
    """-log10 of the expected number of chance segments as high as the best one; 0 without a segment."""
    if not found:
        return 0.0
    expected = math.log10(max(model.scale * n, 1e-300)) - model.decay * max(x[2] for x in found) / math.log(10)
    return max(0.0, -expected)


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on ``(text, label)`` rows, all of them; nulls in either column are left out.

    What comes to the driver is bounded: the lexicon and two histograms.  Without rows of both labels no token has
    weight, and every score is the share of toxic rows, smoothed.
    """
    rows = materialise(labelled.where("text is not null and label is not null").select("text", F.col("label").cast("int").alias("label")), "labelled")
    counts = materialise(_counts(rows), "token-counts")
    n_rows = rows.agg(F.count("*"), F.sum("label")).first()
    n_toxic = float(n_rows[1] or 0)
    n_clean = float(n_rows[0]) - n_toxic
    share = (n_toxic + 0.5) / (n_toxic + n_clean + 1.0)
    weights: dict = {}
    if n_toxic and n_clean:
        alpha = 0.5 + settings.prior_share * (F.col("toxic") + F.col("clean"))
        one, two = F.col("toxic") + F.col("alpha"), F.col("clean") + F.col("alpha")
        odds = F.log(one / (F.lit(n_toxic) + one)) - F.log(two / (F.lit(n_clean) + two))
        scored = counts.withColumn("alpha", alpha).withColumn("weight", odds).withColumn("z", odds / F.sqrt(1 / one + 1 / two))
        chosen = scored.where((F.col("z") >= settings.least_z) & (F.col("weight") >= settings.least_weight)).orderBy(F.desc("z"), "feature").limit(settings.lexicon)
        weights = {r["feature"]: float(r["weight"]) for r in chosen.select("feature", "weight").collect()}
    penalty = math.log(1 - settings.passage_rate)
    plain = Model(weights, penalty, 1.0, 1.0, 0.0, math.log(share / (1 - share)), settings.significance)
    if not weights:
        return plain

    # Scores of clean tokens, rounded, give the decay of the extreme-value law; its scale comes from clean segments.
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = Weights(weights, penalty)
        for rows in rows_of(batches):
            out = Counter()
            for text, label in zip(rows["text"], rows["label"]):
                values = np.fromiter(map(score.__getitem__, _TOKEN.findall(text.lower())), np.float64)
                if label == 0:
                    for value, n in zip(*np.unique(np.round(values, 1), return_counts=True)):
                        out["token", float(value)] += int(n)
                    for _, _, height in segments(values):
                        out["segment", round(height, 1)] += 1
            yield pd.DataFrame({"kind": texts_of(k[0] for k in out), "value": [k[1] for k in out], "n": list(out.values())})

    histogram = rows.mapInPandas(sums, "kind string, value double, n long").groupBy("kind", "value").agg(F.sum("n").alias("n")).collect()
    tokens = np.array([(r["value"], r["n"]) for r in histogram if r["kind"] == "token"], float).reshape(-1, 2)
    heights = np.array([(r["value"], r["n"]) for r in histogram if r["kind"] == "segment"], float).reshape(-1, 2)
    decay = _decay(tokens, max(weights.values()))
    seen = max(tokens[:, 1].sum(), 1.0)
    # Chance segments of height x are expected scale * n * exp(-decay * x) times; at the median clean height.
    middle = _median(heights[:, 0], heights[:, 1])
    above = heights[heights[:, 0] >= middle, 1].sum() if len(heights) else 0.0
    scale = (above + 1.0) / seen * math.exp(min(decay * middle, 600.0))
    fitted = Model(weights, penalty, decay, scale, 0.0, 0.0, settings.significance)

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = Weights(weights, penalty)
        for rows in rows_of(batches):
            out = Counter()
            for text, label in zip(rows["text"], rows["label"]):
                values = np.fromiter(map(score.__getitem__, _TOKEN.findall(text.lower())), np.float64)
                out[min(_BINS, int(4 * evidence(segments(values), len(values), fitted))), label] += 1
            yield pd.DataFrame({"bin": [k[0] for k in out], "label": [k[1] for k in out], "n": list(out.values())})

    table = rows.mapInPandas(bins, "bin int, label int, n long").groupBy("bin", "label").agg(F.sum("n").alias("n")).collect()
    slope, offset = _logistic(np.array([(r["bin"] / 4, r["label"], r["n"]) for r in table], float))
    return Model(weights, penalty, decay, scale, slope, offset, settings.significance)


def _median(values: np.ndarray, counts: np.ndarray) -> float:
    """The median of values that occur so many times; 0 of none."""
    if not len(values):
        return 0.0
    order = np.argsort(values)
    sofar = np.cumsum(counts[order])
    low, high = (values[order][np.searchsorted(sofar, rank, side="right")] for rank in ((sofar[-1] - 1) // 2, sofar[-1] // 2))
    return float(low + high) / 2


def _decay(tokens: np.ndarray, top: float) -> float:
    """The positive root of ``sum p(s) exp(x s) = 1``; one unseen token of the highest weight is added."""
    value = np.append(tokens[:, 0], top)
    share = np.append(tokens[:, 1], 1.0)
    share = share / share.sum()
    low, high = 0.0, 1.0
    while (share * np.exp(np.minimum(value * high, 700))).sum() < 1 and high < 1e3:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if (share * np.exp(np.minimum(value * middle, 700))).sum() > 1 else (middle, high)
    return max(low, 1e-3)


def _logistic(table: np.ndarray) -> tuple[float, float]:
    """Slope and offset of weighted logistic regression with a light ridge, by Newton steps."""
    x, y, n = np.sqrt(table[:, 0]), table[:, 1], table[:, 2]
    design, beta, ridge = np.stack([x, np.ones_like(x)], 1), np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + ridge, design.T @ (n * (y - p)) - ridge @ beta)
        size = np.abs(step).max()
        beta += step / max(1.0, size / 2)
        if size < 1e-8:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def assess(text: str | None, weigh: Weights, model: Model) -> tuple[float, int, float, list]:
    """Log-odds of being toxic, number of tokens, evidence and segments of one text."""
    values = np.fromiter(map(weigh.__getitem__, _TOKEN.findall((text or "").lower())), np.float64)
    found = segments(values)
    proof = evidence(found, len(values), model)
    return model.offset + model.slope * math.sqrt(min(proof, _BINS / 4)), len(values), proof, found


def score_documents(docs: DataFrame, model: Model, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``(ident, score, predicted, n_tokens, evidence, passages)`` of every row, over its whole text.

    ``passages`` holds every significant segment as ``(start, end, score)`` in token positions.  Null and empty texts
    have no tokens and get the score of a document without evidence.  Repeated rows and null idents give a row each;
    other columns are not read.
    """
    kind = "score double, predicted int, n_tokens long, evidence double, passages array<struct<start: long, end: long, score: double>>"

    @F.pandas_udf(kind)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weigh = Weights(model.weights, model.penalty)
        for texts in batches:
            out = []
            for value in texts:
                logit, n, proof, found = assess(value, weigh, model)
                least = math.log(max(model.scale * n, 1e-300) / model.significance) / model.decay
                passages = [dict(start=s, end=e, score=h) for s, e, h in found if h >= least]
                out.append((1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))), int(logit >= 0), n, proof, passages))
            yield pd.DataFrame(out, columns=["score", "predicted", "n_tokens", "evidence", "passages"])

    return docs.select(F.col(ident).alias(ident), score(F.col(text)).alias("scored")).select(ident, "scored.*")


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns whose text isn't predicted to be toxic."""

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weigh = Weights(model.weights, model.penalty)
        for texts in batches:
            yield pd.Series([assess(value, weigh, model)[0] < 0 for value in texts], dtype=bool)

    return docs.where(clean(F.col(text)))


def held_out(ident: str = "doc_id") -> Column:
    """Rows whose labels are never learned."""
    return F.coalesce(F.crc32(F.col(ident).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(text, label)`` of at most ``training_rows`` labelled documents outside the held-out fold, chosen by hash.

    Their ids are bounded and broadcast, so that no text is shuffled.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(settings.training_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
