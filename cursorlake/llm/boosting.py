"""Gradient-boosted trees.

:meth:`BoostedTrees.fit` takes a training matrix that fits the driver, a few numpy
passes. :meth:`BoostedTrees.fit_rows` takes a table of any size: Spark adds up the
gradients by node, feature and bin, one job for each level of each tree, and the
driver sees these sums only. The fitted trees are a few kilobytes and travel to the
tasks that score all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import drop_staged, frames, lean, staged, text_batches, written

BLOCK_ROWS = 8192  # of a table that lie and are added up together
TASK_ROWS = 1 << 16
SUM_TASKS = 4  # that add up the tasks' few sums; the session's number would make each of many jobs slow
ADDED_TREES = 10  # after which the rows keep their sums anew
ONE = float(1 << 30)  # gradients are summed as whole numbers, so in any order


@dataclass
class BoostedTrees:
    """Binary logistic boosting over binned features, trees of equal depth."""

    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    l2: float = 1.0
    base: float = 0.0
    cuts: list = field(default_factory=list)
    grown: list = field(default_factory=list)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        """Fit on rows ``x`` with labels 0/1. No rows or one class only: a
        constant score at the smoothed prior."""
        x, y = np.asarray(x, float), np.asarray(y, float)
        if not self._starts(len(y), y.sum()):
            return self
        self.cuts = [np.unique(np.quantile(x[:, j], self._steps())) for j in range(x.shape[1])]
        b = self._binned(x)
        raw = np.full(len(x), self.base)
        for _ in range(self.trees):
            splits = []
            for _ in range(self.depth):
                g, h = self._sums(b, self._nodes(b, splits), *self._gradients(raw, y), 1 << len(splits))
                splits.append(self._best(g.cumsum(2), h.cumsum(2)))
            node, leaves = self._nodes(b, splits), 1 << self.depth
            g, h = (np.bincount(node, v, leaves) for v in self._gradients(raw, y))
            value = self.rate * g / (h + self.l2)
            raw += value[node]
            self.grown.append((splits, value))
        return self

    def fit_rows(self, rows: DataFrame) -> "BoostedTrees":
        """The same on all rows (x array<double>, y int) of a table, however many."""
        spark, before = rows.sparkSession, written()
        n, positive, width = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0)), F.max(F.size("x"))).first()
        if not self._starts(n, positive):
            return self
        steps = self._steps().tolist()
        cuts = rows.agg(*[F.percentile(F.col("x")[j], steps) for j in range(width)]).first()
        self.cuts = [np.unique(c) for c in cuts]
        blocks = self._blocks(rows, -(-n // TASK_ROWS))
        kept = 0  # trees whose values the rows have in their sums
        while len(self.grown) < self.trees:
            if len(self.grown) - kept == ADDED_TREES:
                blocks, kept = self._added(blocks, kept), len(self.grown)
                drop_staged(spark, before)
            splits = []
            for _ in range(self.depth):
                g, h = self._table_sums(blocks, splits, kept)
                g, h = g.cumsum(2), h.cumsum(2)
                splits.append(self._best(g, h))
            # the leaves' sums are those on both sides of the last splits
            node, (feature, cut) = np.arange(len(g)), splits[-1]
            sides = ([v[node, feature, cut], v[node, feature, -1] - v[node, feature, cut]] for v in (g, h))
            g, h = (np.stack(v, axis=1).ravel() for v in sides)
            self.grown.append((splits, self.rate * g / (h + self.l2)))
        drop_staged(spark, before, keep=0)
        return self

    def _starts(self, n: int, positive: float) -> bool:
        """Set the prior; whether there is anything to tell apart."""
        self.base = float(np.log((positive + 0.5) / (n - positive + 0.5)))
        self.cuts, self.grown = [], []
        return 0 < positive < n

    def _steps(self) -> np.ndarray:
        return np.linspace(0, 1, self.bins + 1)[1:-1]

    @staticmethod
    def _gradients(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return y - p, p * (1 - p)

    @staticmethod
    def _nodes(b: np.ndarray, splits: list) -> np.ndarray:
        """The node that every row reaches by the splits."""
        node, rows = np.zeros(len(b), np.int64), np.arange(len(b))
        for feature, cut in splits:
            node = 2 * node + (b[rows, feature[node]] > cut[node])
        return node

    def _sums(self, b: np.ndarray, node: np.ndarray, grad: np.ndarray, hess: np.ndarray, width: int) -> list[np.ndarray]:
        """Sums of both by node, feature and bin."""
        f = b.shape[1]
        slot = ((node * f * self.bins)[:, None] + np.arange(f) * self.bins + b).ravel()
        return [np.bincount(slot, np.repeat(v, f), width * f * self.bins).reshape(width, f, self.bins) for v in (grad, hess)]

    def _best(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature and bin of the best split of every node, from running sums over the bins."""
        gt, ht = g[:, :, -1:], h[:, :, -1:]
        gain = g**2 / (h + self.l2) + (gt - g)**2 / (ht - h + self.l2) - gt**2 / (ht + self.l2)
        best = gain.reshape(len(g), -1).argmax(1)
        return best // self.bins, best % self.bins

    def _blocks(self, rows: DataFrame, tasks: int) -> DataFrame:
        """Binned rows, labels and sums, BLOCK_ROWS to a row."""
        text_batches(rows.sparkSession, BLOCK_ROWS)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for t in lean(batches):
                if len(t):
                    b = self._binned(np.stack(t["x"])).astype(np.uint8)
                    yield pd.DataFrame({"n": [len(t)], "b": [b.tobytes()], "y": [t["y"].to_numpy(np.uint8).tobytes()],
                                        "raw": [np.full(len(t), self.base).tobytes()]})

        dealt = rows.select("x", "y").repartition(tasks)
        blocks = staged(dealt.mapInPandas(run, "n int, b binary, y binary, raw binary"), "trees-0")
        text_batches(rows.sparkSession, 8)  # blocks that a worker holds at once
        return blocks

    def _read(self, batches: Iterator[pd.DataFrame], kept: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Bins, labels and sums of each block, with the trees after the ``kept`` first."""
        for t in lean(batches):
            for n, b, y, raw in zip(t["n"], t["b"], t["y"], t["raw"]):
                b, raw = np.frombuffer(b, np.uint8).reshape(n, -1), np.frombuffer(raw).copy()
                for splits, value in self.grown[kept:]:
                    raw += value[self._nodes(b, splits)]
                yield b, np.frombuffer(y, np.uint8), raw

    def _added(self, blocks: DataFrame, kept: int) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b, y, raw in self._read(batches, kept):
                yield pd.DataFrame({"n": [len(y)], "b": [b.tobytes()], "y": [y.tobytes()], "raw": [raw.tobytes()]})

        return staged(blocks.mapInPandas(run, blocks.schema), f"trees-{len(self.grown)}")

    def _table_sums(self, blocks: DataFrame, splits: list, kept: int) -> list[np.ndarray]:
        """:meth:`_sums` over all blocks. Each task sends a row per node, feature and bin."""
        shape = 1 << len(splits), len(self.cuts), self.bins

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((2, *shape), np.int64)
            for b, y, raw in self._read(batches, kept):
                grad, hess = (np.rint(v * ONE) for v in self._gradients(raw, y))
                total += np.array(self._sums(b, self._nodes(b, splits), grad, hess, shape[0])).astype(np.int64)
            g, h = total.reshape(2, -1)
            slot = np.flatnonzero(h)
            yield from frames({"slot": slot, "g": g[slot], "h": h[slot]})

        parts = blocks.mapInPandas(run, "slot int, g long, h long").repartition(SUM_TASKS, "slot")
        got = parts.groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
        sums = np.zeros((2, int(np.prod(shape))))
        sums[:, got["slot"].to_numpy(int)] = got[["g", "h"]].to_numpy().T / ONE
        return list(sums.reshape(2, *shape))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        x = np.asarray(x, float)
        raw = np.full(len(x), self.base)
        if self.grown and len(x):
            b = self._binned(x)
            for splits, value in self.grown:
                raw += value[self._nodes(b, splits)]
        return 1 / (1 + np.exp(-raw))
