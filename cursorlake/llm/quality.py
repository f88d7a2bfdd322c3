"""Quality classifier: regularised quadratic discriminant on text statistics.

A document becomes a vector of transformed statistics of its whole text
(:func:`features`). Each class has a mean and a covariance shrunk towards the
diagonal of the pooled one; the score is the logistic of the difference of the
two log densities plus the log prior ratio, divided by the root of the number of
statistics: they depend on each other, and undivided sums would leave few scores
between 0 and 1. The order of documents is that of the difference itself. Means and second moments are sums over
all labelled rows, added up by Spark; the driver sees one number per class and
moment. Cholesky factors are inverted once and travel with the model.

A null text counts as empty. Labels that are null are ignored; a document with
several label rows counts once for each. With no label at all every score is 0.5;
with one class only it is that class's smoothed share. Id, language, source and
labels never enter a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import frames, lean, staged, text_batches

SHRINK = 0.1
THRESHOLD = 0.3
NAMES = ("upper", "digit", "space", "symbol", "mark", "other", "bars", "words", "word_length", "long_words",
         "ended", "distinct", "top_word", "pairs", "lines", "line_words", "same_lines", "marked",
         "doubled")

# classes of bytes: 0 lower, 1 upper, 2 digit, 3 space, 4 sentence marks, 5 symbols, 6 beyond ASCII
_BYTES = np.full(256, 5)
_BYTES[97:123], _BYTES[65:91], _BYTES[48:58], _BYTES[128:] = 0, 1, 2, 6
_BYTES[[9, 10, 13, 32]], _BYTES[[33, 39, 44, 46, 58, 59, 63]] = 3, 4


def features(text: str) -> np.ndarray:
    """Transformed statistics of one text, in the order of NAMES."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    by_byte = np.bincount(raw, minlength=256)
    lower, upper, digit, space, mark, symbol, other = np.bincount(_BYTES, by_byte, 7)
    n = len(raw) + 1.0
    words = text.split()
    count, n_words = Counter(words), len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    marked = sum(k for w, k in count.items() if not w[-1].isalnum() and w[-1] not in ".,")
    ended = sum(k for w, k in count.items() if w[-1] in ".,")
    long_words = sum(k for w, k in count.items() if len(w) > 12)
    w = n_words + 1.0
    return np.array([
        np.sqrt(upper / n), np.sqrt(digit / n), np.sqrt(space / n), np.sqrt(symbol / n), np.sqrt(mark / n),
        np.sqrt(other / n), np.sqrt(by_byte[124] / w), np.log1p(n_words), np.log1p((n - space) / w),
        np.sqrt(long_words / w), np.sqrt(ended / w), np.log(len(count) + 1.0) / np.log(w + 1.0),
        np.sqrt(max(count.values(), default=0) / w), np.sqrt(1 - pairs / max(1, n_words - 1)),
        np.log1p(len(lines)), np.log1p(n_words / max(1, len(lines))),
        np.sqrt(1 - len(set(lines)) / max(1, len(lines))), np.sqrt(marked / w),
        np.sqrt(sum(map(str.__eq__, words, words[1:])) / w)])


def feature_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, f) for every row; staged, as fitting and scoring both read it."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in lean(batches):
            yield from frames({"doc_id": b["doc_id"], "f": [features(t) for t in b["text"]]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return staged(rows.mapInPandas(run, "doc_id long, f array<double>"), "quality-features")


@dataclass
class Discriminant:
    """Two Gaussian classes; ``roots`` are inverted Cholesky factors."""

    means: np.ndarray | None
    roots: np.ndarray | None
    offset: float

    @classmethod
    def from_moments(cls, n: np.ndarray, first: np.ndarray, second: np.ndarray, shrink: float = SHRINK) -> "Discriminant":
        """From counts (2), sums (2, d) and sums of products (2, d, d)."""
        if n.min() < 2:
            return cls(None, None, float(np.log((n[1] + 1) / (n[0] + 1))))
        d = first.shape[1]
        means = first / n[:, None]
        scatter = second - n[:, None, None] * means[:, :, None] * means[:, None, :]
        pooled = np.maximum(np.diagonal(scatter.sum(0)) / n.sum(), 1e-6)
        share = np.maximum(shrink, d / (n + d))[:, None, None]
        cov = (1 - share) * scatter / n[:, None, None] + share * np.diag(pooled)
        lower = np.linalg.cholesky(cov + 1e-9 * np.eye(d))
        roots = np.linalg.inv(lower)
        log_det = np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(1)
        return cls(means, roots, float(np.log(n[1] / n[0]) - log_det[1] + log_det[0]))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability-like score of class 1 for each row of ``x``."""
        if self.means is None:
            return np.full(len(x), 1 / (1 + np.exp(-self.offset)))
        x = np.asarray(x, float)
        far = [np.square((x - m) @ r.T).sum(1) for m, r in zip(self.means, self.roots)]
        z = (self.offset + 0.5 * (far[0] - far[1])) / np.sqrt(x.shape[1])
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(feature_rows: DataFrame, labels: DataFrame, training: Column, shrink: float = SHRINK) -> Discriminant:
    """Fit on the rows where ``training`` (over doc_id) holds and that ``labels``
    (doc_id, quality) marks 0 or 1."""
    d = len(NAMES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x, y = np.stack(b["f"]), b["y"].to_numpy()
            for k in (0, 1):
                v = x[y == k]
                total[k] += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
        yield pd.DataFrame({"y": np.repeat([0, 1], total.shape[1]), "at": np.tile(np.arange(total.shape[1]), 2),
                            "v": total.ravel()})

    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    rows = feature_rows.where(training).join(marked.where("y in (0, 1)"), "doc_id").select("f", "y")
    got = rows.mapInPandas(run, "y int, at int, v double").groupBy("y", "at").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros((2, 1 + d + d * d))
    total[got["y"], got["at"]] = got["v"]
    return Discriminant.from_moments(total[:, 0], total[:, 1: 1 + d], total[:, 1 + d:].reshape(2, d, d), shrink)


def scored(feature_rows: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of feature rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            score = model.score(np.stack(b["f"]))
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": score, "predicted": (score >= threshold).astype("int32")})

    return feature_rows.mapInPandas(run, "doc_id long, score double, predicted int")


def text_score(model: Discriminant, text: Column) -> Column:
    """The score of a text column (null: as empty)."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in lean(batches):
            yield pd.Series(model.score(np.stack([features(t) for t in texts])))

    return score(F.coalesce(text, F.lit("")))


def keep_good(docs: DataFrame, labels: DataFrame, training: Column, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text scores at least ``threshold``."""
    model = fit(feature_rows(docs), labels, training)
    good = docs.withColumn("__quality", text_score(model, F.col("text"))).where(F.col("__quality") >= threshold)
    return good.drop("__quality")
