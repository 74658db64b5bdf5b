"""Quality classifier by Bradley-Terry pairwise ranking.

A good and a bad document form a preference pair.  Scores are linear in features of the text alone;
the weights minimise the logistic loss of feature differences over the pairs (a Bradley-Terry model
whose strengths are the scores).  The decision threshold is a quantile of the training scores, and a
logistic curve puts it at ``decide_at`` between 0 and 1.

Fitting reads at most ``per_class`` labelled documents a class (those of the smallest id hash): the
driver sees their feature vectors, a few numbers each.  Scoring runs over every whole text in the
scan; no shuffle.

Defined results
    null or empty text   features of the empty text, hence a score
    very long text       whole text
    null id or label     never learnt from; still scored
    labels that repeat   the lowest quality counts
    one class or no labels  all raw scores 0: every score is ``decide_at`` and predicted 1
    ties, repeated rows  equal texts have equal scores
    empty table          empty result
    extra columns        only id and text are read; ``keep_predicted`` passes all others through
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from snapflow.llm.common import DOC_ID, narrow

FEATURES = (
    "log_words", "word_length", "upper", "digits", "not_ascii", "bang", "pipe", "symbols", "stops",
    "quotes", "distinct_words", "distinct_pairs", "same_as_before", "log_lines", "closed_lines",
    "distinct_lines", "line_words", "capital_words",
)
_SYMBOLS = b"#*$%&<>"


def features(text: bytes) -> list[float]:
    """The text's features, in the order of ``FEATURES``."""
    words = text.split()
    n = len(words)
    size = max(1, len(text))
    per_word = 1 / max(1, n)
    c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower = int(c[65:91].sum()), int(c[97:123].sum())
    lines = [x for x in (ln.strip() for ln in text.split(b"\n")) if x]
    m = max(1, len(lines))
    return [
        math.log1p(n), sum(map(len, words)) * per_word, upper / max(1, upper + lower), int(c[48:58].sum()) / size,
        int(c[128:].sum()) / size, c[33] * per_word, c[124] * per_word, sum(int(c[b]) for b in _SYMBOLS) * per_word,
        (c[46] + c[44]) * per_word, (c[34] + c[39]) * per_word, len(set(words)) * per_word,
        len(set(zip(words, words[1:]))) / max(1, n - 1), sum(map(eq, words, words[1:])) * per_word,
        math.log1p(len(lines)), sum(ln[-1:] in b".!?\"'" for ln in lines) / m, len(set(lines)) / m, n / m,
        sum(w[:1].isupper() for w in words) * per_word,
    ]


@dataclass(frozen=True)
class PairwiseModel:
    """``cuts`` (features x steps): a feature counts as the share of its cuts that it reaches, one
    weight a cut; ``threshold``, ``scale``: raw score at ``decide_at`` and width of the curve."""

    cuts: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float
    decide_at: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (steps(x, self.cuts) @ self.weights).astype(np.float64)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        shift = math.log(self.decide_at / (1 - self.decide_at))
        z = np.clip((self.raw(x) - self.threshold) / self.scale, -30, 30) + shift
        # the threshold itself must reach ``decide_at`` in spite of rounding
        return np.where(z >= shift, np.maximum(1 / (1 + np.exp(-z)), self.decide_at), 1 / (1 + np.exp(-z)))


def steps(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return (x[:, :, None] >= cuts[None, :, :]).reshape(len(x), -1).astype(np.float32)


def fit(x: np.ndarray, good: np.ndarray, bins: int = 16, rounds: int = 600, batch: int = 4096,
        l2: float = 1e-4, decide_at: float = 0.3, seed: int = 7) -> PairwiseModel:
    """Bradley-Terry weights from random good-over-bad pairs (Adam on the logistic loss), then the
    score quantile that separates the classes best."""
    cuts = np.quantile(x, np.arange(1, bins) / bins, axis=0).T if len(x) else np.zeros((len(FEATURES), bins - 1))
    w = np.zeros(cuts.size, np.float32)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):
        return PairwiseModel(cuts, w, 0.0, 1.0, decide_at)
    f, rng = steps(x, cuts), np.random.default_rng(seed)
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        d = f[rng.choice(up, batch)] - f[rng.choice(down, batch)]
        g = -(d.T @ (1 / (1 + np.exp(d @ w)))) / batch + l2 * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w = w - 0.05 * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8)
    raw = f @ w
    levels = np.quantile(raw, np.linspace(0.0, 1.0, 401))
    right = [(raw[up] >= q).mean() + (raw[down] < q).mean() for q in levels]
    return PairwiseModel(cuts, w, float(levels[int(np.argmax(right))]), float(raw.std()) or 1.0, decide_at)


def held_out(doc_id: Column) -> Column:
    """Fold of a document: crc32 of its id as text, modulo 5, is 0; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 20_000, decide_at: float = 0.3,
          id_col: str = DOC_ID, text_col: str = "text") -> PairwiseModel:
    """Fit on labelled documents outside the held-out fold, at most ``per_class`` of each class."""
    known = (labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__q"))
             .filter("__id is not null and __q in (0, 1)").filter(~held_out(F.col("__id")))
             .groupBy("__id").agg(F.min("__q").alias("__q")))
    rank = F.xxhash64("__id", F.lit(11))
    sample = None
    for q in (0, 1):
        part = known.filter(F.col("__q") == q).orderBy(rank, "__id").limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    d = narrow(docs, id_col, text_col)
    rows = d.join(F.broadcast(sample), d[DOC_ID] == F.col("__id")).select(DOC_ID, "text", F.col("__q").alias("q"))
    # one text a labelled id, so that the bound holds whatever the table repeats
    rows = rows.groupBy(DOC_ID, "q").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"id": pdf[DOC_ID], "q": pdf["q"].astype("int32"),
                                "x": [features(t.encode()) for t in pdf["text"]]})

    seen = rows.mapInPandas(featured, "id long, q int, x array<double>").toPandas().sort_values("id", kind="stable")
    x = np.array(seen["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, (seen["q"] == 1).to_numpy(bool), decide_at=decide_at)


def score_column(model: PairwiseModel, text: Column) -> Column:
    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            x = np.array([features(t.encode()) for t in s], np.float64).reshape(-1, len(FEATURES))
            yield pd.Series(model.scores(x), dtype="float64")
    return scored(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, model: PairwiseModel, id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    d = narrow(docs, id_col, text_col)
    return (d.select(DOC_ID, held_out(F.col(DOC_ID)).alias("held_out"), score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= model.decide_at).cast("int")))


def keep_predicted(docs: DataFrame, model: PairwiseModel, text_col: str = "text") -> DataFrame:
    """The documents at or above the threshold, all columns as they came."""
    return docs.filter(score_column(model, docs[text_col]) >= model.decide_at)
