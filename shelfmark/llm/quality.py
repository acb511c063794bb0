"""Document quality by co-training of two views.

One classifier sees the text: its words, and what it is made of.  The other sees only metadata (source, language, length).
Round by round each labels the unlabelled documents that it is surest of, for the other one to learn from.  The views are
then calibrated together on labelled rows that neither has seen.

Labelled rows are a bounded sample on the driver.  All unlabelled rows take part on the executors: which of them are
labelled by whom follows from the models and cuts of the rounds so far, so no state is kept of them, and the fits add up
their gradients and curvatures.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise, rows_of

_SLOTS = 64
_WORD_SLOTS = 4096
_EDGES = np.linspace(-30.0, 30.0, 1201)


@dataclass(frozen=True)
class Settings:
    """``labelled_rows`` bounds the labelled sample that the views are fitted on; the exchange and scoring cover all rows.

    In every round each view labels ``confident_share`` of all unlabelled rows, where it is sure enough of so many.
    """

    labelled_rows: int = 10_000
    rounds: int = 4
    confident_share: float = 0.05
    surely: float = 2.0
    steps: int = 8
    ridge: float = 1.0


def text_view(text: str | None) -> list[float]:
    """What a text is made of, whatever its length; all zeros without words."""
    words = (text or "").split()
    if not words:
        return [0.0] * 16
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256).astype(float)
    share = counts / len(raw)
    seen = Counter(words)
    lines = text.split("\n")
    letters = share[65:91].sum() + share[97:123].sum() + share[128:].sum()
    used = share[share > 0]
    lengths = np.fromiter(map(len, words), float, len(words))
    symbols = 1.0 - letters - share[48:58].sum() - share[32] - share[10]
    return [
        float((lengths <= 2).mean()),
        lengths.mean(),
        lengths.std(),
        len(seen) / len(words),
        max(seen.values()) / len(words),
        sum(n for n in seen.values() if n > 1) / len(words),
        len(set(lines)) / len(lines),
        sum(not line.strip() for line in lines) / len(lines),
        len(words) / len(lines) / 100.0,
        symbols,
        share[[33, 46, 63, 44]].sum(),
        share[48:58].sum(),
        share[65:91].sum(),
        share[128:].sum(),
        float(-(used * np.log(used)).sum()),
        float(text[-1] in ".!?\"'"),
    ]


def word_slots(text: str | None) -> np.ndarray:
    """The different words of a text, hashed to a fixed number of places."""
    return np.unique(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % _WORD_SLOTS for w in set((text or "").lower().split())), np.int64))


def word_weights(slots: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log-odds of the places of words in good and other documents, drawn to zero where there are few."""
    counts = np.full((2, _WORD_SLOTS), 2.0)
    for own, label in zip(slots, y):
        counts[int(label), own] += 1
    sizes = np.array([[np.sum(y == 0)], [np.sum(y == 1)]]) + 4.0
    odds = np.log(counts / sizes)
    return odds[1] - odds[0]


def word_evidence(slots: np.ndarray, weights: np.ndarray) -> float:
    return float(weights[slots].sum() / np.sqrt(len(slots))) if len(slots) else 0.0


def metadata_view(source: str | None, lang: str | None, n_chars: float | None) -> list[float]:
    """Length, whether it is known, and the places that source and language are hashed to."""
    known = n_chars is not None and n_chars == n_chars
    size = float(np.log1p(max(0.0, n_chars))) if known else 0.0
    return [size, float(not known), float(zlib.crc32(f"s:{source}".encode()) % _SLOTS), float(zlib.crc32(f"l:{lang}".encode()) % _SLOTS)]


def metadata_matrix(rows: np.ndarray) -> np.ndarray:
    """Metadata views as columns, one per place."""
    out = np.zeros((len(rows), 3 + 2 * _SLOTS))
    out[:, 0], out[:, 1], out[:, 2] = rows[:, 0], rows[:, 0] ** 2 / 10, rows[:, 1]
    at = np.arange(len(rows))
    out[at, 3 + rows[:, 2].astype(int)] = 1.0
    out[at, 3 + _SLOTS + rows[:, 3].astype(int)] = 1.0
    return out


class Linear:
    """Logistic regression on columns that are standardised as in the rows given."""

    def __init__(self, x: np.ndarray):
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-2)
        self.beta = np.zeros(x.shape[1] + 1)

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.design(x) @ self.beta, -30, 30)

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Curvature and, in the last row, gradient of the rows' log-likelihood."""
        z = self.design(x)
        p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
        return np.vstack([(z * (p * (1 - p) + 1e-9)[:, None]).T @ z, z.T @ (y - p)])

    def step(self, sums: np.ndarray, ridge: float) -> float:
        """One Newton step; its largest part."""
        penalty = np.full(len(self.beta), ridge)
        penalty[-1] = 1e-6
        step = np.linalg.solve(sums[:-1] + np.diag(penalty), sums[-1] - penalty * self.beta)
        self.beta = self.beta + step / max(1.0, np.abs(step).max() / 4)
        return float(np.abs(step).max())


@dataclass(frozen=True)
class Model:
    text: Linear | None
    metadata: Linear | None
    joint: Linear | None
    share: float
    words: np.ndarray | None = None


#: A round: the two models, and for each the logits below and above which it labels.
Round = tuple[list[Linear], list[tuple[float, float]]]


def _labelled_by(views: list[np.ndarray], rounds: list[Round]) -> tuple[np.ndarray, np.ndarray]:
    """For whom each row was labelled (-1: for none yet) and how, in the rounds so far."""
    whom, label = np.full(len(views[0]), -1), np.zeros(len(views[0]))
    for models, cuts in rounds:
        for me in (0, 1):
            logits, (low, high) = models[me].logits(views[me]), cuts[me]
            sure = (whom < 0) & ((logits <= low) | (logits >= high))
            whom[sure], label[sure] = 1 - me, logits[sure] > 0
    return whom, label


def _cut(counts: np.ndarray, wanted: int, surely: float) -> float:
    """The logit from which on as nearly as may be ``wanted`` rows lie; ``counts`` per bin, from the surest on."""
    sofar = np.cumsum(counts)
    edges = _EDGES[::-1][1:]
    return float(max(edges[np.argmin(np.abs(sofar - wanted))], surely))


def co_train(views: list[np.ndarray], y: np.ndarray, settings: Settings, histogram: Callable, remote: Callable) -> list[Linear]:
    """The two classifiers after the exchange of confident pseudo-labels.

    ``histogram(rounds, models)`` counts the unlabelled rows left by view and bin of its logit; ``remote(rounds, models)``
    adds up the terms of the rows that were labelled for each view.
    """
    models = [Linear(v) for v in views]

    def fit(rounds: list[Round]) -> None:
        for _ in range(settings.steps if rounds else 30):
            far = remote(rounds, models) if rounds else [0.0, 0.0]
            steps = [m.step(m.sums(v, y) + f, settings.ridge) for m, v, f in zip(models, views, far)]
            if max(steps) < 1e-3:
                break

    def frozen() -> list[Linear]:
        copies = []
        for m in models:
            copies.append(Linear.__new__(Linear))
            copies[-1].__dict__.update(m.__dict__)
        return copies

    fit([])
    rounds: list[Round] = []
    each = None
    for _ in range(settings.rounds):
        counts = histogram(rounds, frozen())
        left = counts[0].sum()
        each = int(settings.confident_share * left) if each is None else each
        if each == 0 or left < 2 * each:
            break
        # As many of either class as the labelled rows lead to expect, the surest first.
        high = max(1, round(each * y.mean()))
        cuts = [(-_cut(c, max(1, each - high), settings.surely), _cut(c[::-1], high, settings.surely)) for c in counts]
        rounds.append((frozen(), cuts))
        fit(rounds)
    return models


def held_out(ident: str = "doc_id") -> Column:
    """Rows whose labels are never learned."""
    return F.coalesce(F.crc32(F.col(ident).cast("string")) % 5 == 0, F.lit(False))


_FEATURES = "text_view array<double>, metadata_view array<double>"


def _features(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """Both views of every row; the last number of the text view is the evidence of its words."""

    @F.pandas_udf(_FEATURES)
    def both(texts: pd.Series, sources: pd.Series, langs: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        seen = [[*text_view(t), word_evidence(word_slots(t), words)] for t in texts]
        return pd.DataFrame({"text_view": seen, "metadata_view": [metadata_view(s, g, n) for s, g, n in zip(sources, langs, sizes)]})

    return docs.withColumn("f", both("text", "source", "lang", F.col("n_chars").cast("double"))).select("doc_id", "f.*")


def _matrices(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.array(rows["text_view"].tolist(), float).reshape(len(rows), -1), metadata_matrix(np.array(rows["metadata_view"].tolist(), float).reshape(len(rows), 4))]


def _exchange(pool: DataFrame) -> tuple[Callable, Callable]:
    """``histogram`` and ``remote`` of ``co_train`` over a stored table of features."""

    def histogram(rounds: list[Round], models: list[Linear]) -> list[np.ndarray]:
        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((2, len(_EDGES) - 1), np.int64)
            for rows in rows_of(batches, 4096):
                views = _matrices(rows)
                free = _labelled_by(views, rounds)[0] < 0
                for me in (0, 1):
                    total[me] += np.histogram(models[me].logits(views[me][free]), _EDGES)[0]
            view, place = np.nonzero(total)
            yield pd.DataFrame({"view": view, "bin": place, "n": total[view, place]})

        found = pool.mapInPandas(count, "view int, bin int, n long").groupBy("view", "bin").agg(F.sum("n").alias("n")).collect()
        out = np.zeros((2, len(_EDGES) - 1), np.int64)
        for r in found:  # at most a row per view and bin
            out[r["view"], r["bin"]] = r["n"]
        return list(out)

    def remote(rounds: list[Round], models: list[Linear]) -> list[np.ndarray]:
        shapes = [(len(m.beta) + 1, len(m.beta)) for m in models]

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = [np.zeros(shape) for shape in shapes]
            for rows in rows_of(batches, 4096):
                views = _matrices(rows)
                whom, label = _labelled_by(views, rounds)
                for me in (0, 1):
                    mine = whom == me
                    if mine.any():
                        sums[me] += models[me].sums(views[me][mine], label[mine])
            part = int(zlib.crc32(sums[0].tobytes()) % 16)
            yield pd.DataFrame({"view": [0, 1], "part": [part] * 2, "sums": [x.ravel() for x in sums]})

        def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"view": [key[0]], "part": [key[1]], "sums": [np.sum(rows["sums"].tolist(), axis=0)]})

        kind = "view int, part int, sums array<double>"
        found = pool.mapInPandas(add, kind).groupBy("view", "part").applyInPandas(merge, kind).collect()  # 32 rows at most
        return [sum((np.array(r["sums"]).reshape(shapes[me]) for r in found if r["view"] == me), np.zeros(shapes[me])) for me in (0, 1)]

    return histogram, remote


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of labelled rows, chosen by hash, and on all unlabelled rows.

    Held-out rows are never among the labelled ones.  Of several rows with one labelled id, the one of the smallest hash
    counts.  With one class or none, every score is the share of good rows.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    known = materialise(known, "quality-labels")
    picked = known.where(~held_out()).orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(settings.labelled_rows)
    columns = ["text", "source", "lang", F.col("n_chars").cast("double").alias("n_chars")]
    sample = docs.select("doc_id", *columns).join(F.broadcast(picked), "doc_id")  # at most that bound

    @F.pandas_udf("slots array<long>, text_view array<double>, metadata_view array<double>")
    def seen(texts: pd.Series, sources: pd.Series, langs: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        views = [metadata_view(s, g, n) for s, g, n in zip(sources, langs, sizes)]
        return pd.DataFrame({"slots": [word_slots(t) for t in texts], "text_view": [text_view(t) for t in texts], "metadata_view": views})

    numbers = sample.select("doc_id", "y", F.xxhash64("text", "source", "lang", "n_chars").alias("h"), seen("text", "source", "lang", "n_chars").alias("f"))
    rows = numbers.groupBy("doc_id", "y").agg(F.min_by("f", F.struct("h")).alias("f")).orderBy("doc_id").toPandas()
    y = rows["y"].to_numpy(float)
    if len(set(y)) < 2:
        return Model(None, None, None, float((y.sum() + 0.5) / (len(y) + 1)))
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i in rows["doc_id"]])
    learn, calibrate = fold != 1, fold == 1
    if len(set(y[learn])) < 2 or len(set(y[calibrate])) < 2:
        learn = calibrate = np.ones(len(y), bool)
    slots = [np.asarray(f["slots"], np.int64) for f in rows["f"]]
    words = word_weights([s for s, k in zip(slots, learn) if k], y[learn])
    # No row's words are weighed by its own label: half of the rows weigh those of the other half.
    half = np.array([zlib.crc32(f"half {i}".encode()) % 2 for i in rows["doc_id"]])
    crossed = [word_weights([s for s, k in zip(slots, learn & (half != side)) if k], y[learn & (half != side)]) for side in (0, 1)]
    evidence = [word_evidence(s, crossed[side] if k else words) for s, side, k in zip(slots, half, learn)]
    frame = pd.DataFrame({"text_view": [[*f["text_view"], e] for f, e in zip(rows["f"], evidence)], "metadata_view": [f["metadata_view"] for f in rows["f"]]})
    matrices = _matrices(frame)
    free = materialise(_features(docs.where("doc_id is not null"), words), "quality-features").join(known, "doc_id", "left_anti")
    pool = materialise(free.select("text_view", "metadata_view"), "quality-pool")
    views = co_train([m[learn] for m in matrices], y[learn], settings, *_exchange(pool))
    logits = np.stack([v.logits(m[calibrate]) for v, m in zip(views, matrices)], 1)
    joint = Linear(logits)
    for _ in range(30):
        if joint.step(joint.sums(logits, y[calibrate]), settings.ridge) < 1e-6:
            break
    return Model(views[0], views[1], joint, float(y.mean()), words)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, text_score, metadata_score, predicted, kept)`` of every row; 1 is good.

    Null and empty texts have all-zero text features; null metadata are values of their own.  Repeated rows and null
    ids give a row each; an empty table gives none.  Of ``docs`` only doc_id, text, source, lang and n_chars are read.
    """

    @F.pandas_udf("score double, text_score double, metadata_score double")
    def score(texts: pd.Series, sources: pd.Series, langs: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        if model.joint is None or not len(texts):
            out = np.full((len(texts), 3), model.share)
        else:
            seen = [[*text_view(t), word_evidence(word_slots(t), model.words)] for t in texts]
            views = _matrices(pd.DataFrame({"text_view": seen, "metadata_view": [metadata_view(s, g, n) for s, g, n in zip(sources, langs, sizes)]}))
            logits = np.stack([model.text.logits(views[0]), model.metadata.logits(views[1])], 1)
            out = 1 / (1 + np.exp(-np.column_stack([model.joint.logits(logits), logits])))
        return pd.DataFrame(out, columns=["score", "text_score", "metadata_score"])

    scored = docs.select("doc_id", score("text", "source", "lang", F.col("n_chars").cast("double")).alias("s")).select("doc_id", "s.*")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("kept", F.col("score") >= 0.5)
