"""Mixing to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The token weights of the
cells are raked: scaled to the target marginal of each dimension in turn until
all three hold. A document's weight is the ratio of its cell's raked to its
natural tokens; it is kept with a probability in proportion to that weight, the
largest of which is 1, by a hash of its id and text. So the expected tokens kept
meet the targets, and a rerun keeps the same documents.

Topics are learnt from all texts: k-means of hashed word vectors less the mean of
their language (see :class:`Topics`); a text without longer words has none.

Targets are shares per named value, or :class:`Tempered` ones. Values without a target (and nulls) form one
group ``*``. It gets what the named shares leave of 1; if they leave nothing, it
keeps its natural share and they are scaled to the rest. Cells are thus at most the product of the target
counts plus one each, however many sources there are. Values without tokens are
left out. Marginals that contradict each other (empty cells) are met as closely
as MAX_SWEEPS sweeps come; empty documents weigh no tokens and share the fate of
their cell. Rows equal in id and text share one fate. An empty table stays empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import lean, staged, text_batches, unit_hash

TOPICS = 8  # a power of two
TOPIC_LETTERS = 5
DIMS = 64
SCALE = 1000
SWEEPS = 12
MAX_SWEEPS = 500
REST = "*"
DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Tempered:
    """Targets in proportion to a power of the natural token shares, which
    levels large and small values. ``fixed`` shares are taken as they are. Values
    with less than ``least`` of the tokens, and nulls, are one group, so there
    are at most 1 / least groups and one more."""

    power: float
    least: float = 0.001
    fixed: dict[str, float] = field(default_factory=dict)


def resolved(rows: DataFrame, targets: dict) -> dict[str, dict[str, float]]:
    """``targets`` with shares by value in every dimension; rows: source, lang, topic, n_tokens."""
    out = {}
    for d in DIMENSIONS:
        t = targets[d]
        if isinstance(t, Tempered):
            whole = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
            sums = rows.where(F.col(d).isNotNull() & (F.col(d) != REST)).groupBy(d).agg(F.sum("n_tokens").alias("n")) \
                .where((F.col("n") >= t.least * whole) & (F.col("n") > 0)).collect()
            natural = {r[0]: r[1] for r in sums}
            natural[REST] = max(0, whole - sum(natural.values()))
            free = {k: n ** t.power for k, n in natural.items() if k not in t.fixed and n}
            left = max(0.0, 1 - sum(t.fixed.values())) / max(sum(free.values()), 1e-300)
            t = {**t.fixed, REST: 0.0, **{k: n * left for k, n in free.items()}}
        out[d] = t
    return out


def vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(DIMS whole numbers per text, tokens per text). Each distinct word of
    TOPIC_LETTERS letters or more adds the logarithm of its count, with a sign,
    to one place, both from its hash; the sum is scaled to length SCALE. A text
    without such words has zeros."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    flat, size = lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    text = np.repeat(np.arange(len(size)), size)
    filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    tokens = np.bincount(text[filled], minlength=len(size))
    coded = pc.utf8_trim(flat, ".,;:!?()\"'").dictionary_encode()
    words, number = coded.dictionary, coded.indices.to_numpy()
    long = pc.greater_equal(pc.utf8_length(words), TOPIC_LETTERS).to_numpy(zero_copy_only=False)
    hashes = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) if k else 0 for w, k in zip(words.to_pylist(), long)), np.int64, len(words))
    used = long[number]
    pair, count = np.unique(text[used] * max(1, len(words)) + number[used], return_counts=True)
    at, h = pair // max(1, len(words)), hashes[pair % max(1, len(words))]
    weight = np.log1p(count) * np.where(h >> 20 & 1, 1.0, -1.0)
    v = np.bincount(at * DIMS + h % DIMS, weight, len(size) * DIMS).astype(float).reshape(-1, DIMS)
    length = np.sqrt((v * v).sum(1, keepdims=True))
    return np.rint(np.divide(v * SCALE, length, out=np.zeros_like(v), where=length > 0)).astype(np.int64), tokens


def described(text: Column) -> Column:
    """struct(v, n_tokens) of a text: its vector as two-byte numbers, null if all
    are zeros, and its white-space words."""
    @F.pandas_udf("v binary, n_tokens long")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in lean(batches):
            v, tokens = vectors(pa.array(texts, pa.large_string()))
            packed = [x.tobytes() if x.any() else None for x in v.astype("<i2")]
            yield pd.DataFrame({"v": pd.Series(packed, dtype=object), "n_tokens": tokens})

    return describe(F.coalesce(text, F.lit("")))


class Topics:
    """Topics of the corpus: k-means of the texts' vectors less the mean of their
    language, so that a topic is no language. Means and centres are whole
    numbers, so that neither the order of rows nor batches change a topic."""

    def __init__(self, langs: dict[str, np.ndarray], centres: np.ndarray):
        self.langs, self.centres = langs, centres

    def centred(self, v: np.ndarray, lang: list) -> np.ndarray:
        none = np.zeros(DIMS, np.int64)
        means = np.array([self.langs.get(g, none) for g in lang], np.int64).reshape(-1, DIMS)
        return v - means

    def assign(self, v: np.ndarray, lang: list) -> np.ndarray:
        """Nearest centre (ties: the first), -1 for zeros."""
        score = 2 * self.centred(v, lang) @ self.centres.T - (self.centres**2).sum(1)
        return np.where(v.any(1), score.argmax(1), -1)

    def of(self, v: Column, lang: Column) -> Column:
        model = self

        @F.pandas_udf("string")
        def topic(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for vs, langs in lean(batches):
                yield pd.Series([str(k) if k >= 0 else None for k in model.assign(stacked(vs), langs.tolist())], dtype=object)

        return topic(v, lang)

    def of_text(self, text: Column, lang: Column) -> Column:
        """As :meth:`of` of a text's :func:`described` vector, in one call: of several calls
        in one task each holds a Python worker, which stays for the stages that follow.
        For the same reason Spark must not evaluate it again in a filter before a join."""
        model = self

        @F.pandas_udf("string")
        def topic(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for texts, langs in lean(batches):
                v, _ = vectors(pa.array(texts, pa.large_string()))
                yield pd.Series([str(k) if k >= 0 else None for k in model.assign(v, langs.tolist())], dtype=object)

        return topic.asNondeterministic()(F.coalesce(text, F.lit("")), lang)


def stacked(vs: pd.Series) -> np.ndarray:
    """Vectors of a column of packed ones."""
    zeros = bytes(2 * DIMS)
    return np.frombuffer(b"".join([v or zeros for v in vs]), "<i2").astype(np.int64).reshape(-1, DIMS)


def summed(rows: DataFrame, key, value) -> dict:
    """Sums by key over rows (lang, v): ``key`` and ``value`` turn a batch into
    keys and as many rows of whole numbers to add up by them. Tasks add up their
    batches, and Spark the tasks by key and column."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for b in lean(batches):
            v, lang = stacked(b["v"]), b["lang"].tolist()
            keys, x = np.array(key(v, lang), dtype=object), value(v, lang)
            for k in dict.fromkeys(keys.tolist()):
                sums[k] = sums.get(k, 0) + x[keys == k].sum(0)
        for k, total in sums.items():
            yield pd.DataFrame({"k": str(k), "at": np.arange(len(total)), "total": total})

    found: dict = {}
    for k, at, total in rows.mapInPandas(run, "k string, at int, total long").groupBy("k", "at").agg(F.sum("total")).collect():
        found.setdefault(k, {})[at] = total
    return {k: np.array([t[i] for i in range(len(t))]) for k, t in found.items()}


def counted(x: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(x), 1), np.int64), x])


def fit_topics(rows: DataFrame) -> Topics:
    """Learns from all rows (lang, v) that have a vector. First centres: the means of
    the TOPICS parts by the signs along the leading principal directions. Then
    centres and members change in turn, until no part's size does or SWEEPS times."""
    rows = rows.where("v IS NOT NULL")
    topics = Topics({}, np.zeros((TOPICS, DIMS), np.int64))
    langs = summed(rows, lambda v, lang: lang, lambda v, lang: counted(v))
    topics.langs = {g: np.rint(s[1:] / s[0]).astype(np.int64) for g, s in langs.items()}
    if not langs:
        return topics
    upper = np.triu_indices(DIMS)

    def products(v, lang):
        x = topics.centred(v, lang)
        return (x.T @ x)[upper][None, :]

    moments = summed(rows, lambda v, lang: [0], products)["0"]
    square = np.zeros((DIMS, DIMS))
    square[upper] = moments
    leading = np.linalg.eigh(square + np.triu(square, 1).T)[1][:, -(TOPICS.bit_length() - 1):]
    axes = np.rint(leading * 1e6).astype(np.int64)

    def parts(v, lang):
        return (topics.centred(v, lang) @ axes > 0) @ (1 << np.arange(axes.shape[1]))

    sizes = None
    for _ in range(SWEEPS):
        found = summed(rows, parts if sizes is None else topics.assign, lambda v, lang: counted(topics.centred(v, lang)))
        now = {k: int(s[0]) for k, s in found.items()}
        centres = topics.centres.copy()
        for k, s in found.items():
            centres[int(k)] = np.rint(s[1:] / s[0])
        topics = Topics(topics.langs, centres)
        if now == sizes:
            break
        sizes = now
    return topics


def grouped(column: Column, targets: dict[str, float]) -> Column:
    """The value if it has a target of its own, else the group of the rest."""
    return F.when(column.isin([k for k in targets if k != REST]), column).otherwise(REST)


def rake(tokens: np.ndarray, targets: list[np.ndarray], tolerance: float = 1e-10) -> np.ndarray:
    """Weights of the cells of ``tokens`` (one axis per dimension) whose
    marginals meet ``targets`` (shares; values without tokens count as 0)."""
    w = tokens / max(tokens.sum(), 1e-300)
    axes = range(w.ndim)
    goals = []
    for axis, goal in zip(axes, targets):
        goal = np.where(w.sum(tuple(a for a in axes if a != axis)) > 0, goal, 0.0)
        goals.append(goal / max(goal.sum(), 1e-300))
    for _ in range(MAX_SWEEPS):
        worst = 0.0
        for axis, goal in zip(axes, goals):
            now = w.sum(tuple(a for a in axes if a != axis))
            worst = max(worst, float(np.abs(now - goal).max(initial=0)))
            scale = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
            w = w * scale.reshape([-1 if a == axis else 1 for a in axes])
        if worst < tolerance:
            break
    return w


def full_targets(targets: dict[str, float], natural: dict[str, float]) -> dict[str, float]:
    """Shares of all groups, the rest included; they sum to 1."""
    named = {k: v for k, v in targets.items() if k != REST}
    whole = sum(named.values())
    rest = targets.get(REST, 1 - whole if whole < 1 - 1e-9 else natural.get(REST, 0.0))
    return {**{k: v / whole * (1 - rest) if whole else 0.0 for k, v in named.items()}, REST: rest}


def cell_weights(rows: DataFrame, targets: dict[str, dict[str, float]]) -> dict[tuple[str, ...], float]:
    """Raked over natural weight of every cell of rows (source, lang, topic,
    n_tokens), with the groups of ``targets``."""
    keys = [grouped(F.col(d), targets[d]).alias(d) for d in DIMENSIONS]
    got = rows.groupBy(*keys).agg(F.sum("n_tokens").alias("n")).collect()  # one row per cell
    values = [[*(k for k in targets[d] if k != REST), REST] for d in DIMENSIONS]
    place = [{v: i for i, v in enumerate(vs)} for vs in values]
    tokens = np.zeros([len(vs) for vs in values])
    for r in got:
        tokens[tuple(p[r[d]] for p, d in zip(place, DIMENSIONS))] = r["n"]
    goals = []
    for axis, (d, vs) in enumerate(zip(DIMENSIONS, values)):
        share = tokens.sum(tuple(a for a in range(3) if a != axis)) / max(tokens.sum(), 1)
        goal = full_targets(targets[d], dict(zip(vs, share)))
        goals.append(np.array([goal[v] for v in vs]))
    raked = rake(tokens, goals)
    ratio = np.divide(raked * tokens.sum(), tokens, out=np.ones_like(tokens), where=tokens > 0)
    return {key: float(ratio[at]) for key, at in zip(product(*values), product(*(range(len(v)) for v in values)))}


def with_probability(rows: DataFrame, weights: dict[tuple[str, ...], float], targets: dict[str, dict[str, float]]) -> DataFrame:
    """Adds weight and probability, joined with the table of cells. That is made by way
    of Arrow; rows of Python objects would take Python workers of their own."""
    top = max(weights.values(), default=1.0) or 1.0
    keys = [f"cell_{d}" for d in DIMENSIONS]
    columns = [pa.array(c, pa.string()) for c in zip(*weights)] + [pa.array(weights.values(), pa.float64())]
    cells = rows.sparkSession.createDataFrame(pa.table(columns, [*keys, "weight"]))
    for k, d in zip(keys, DIMENSIONS):
        rows = rows.withColumn(k, grouped(F.col(d), targets[d]))
    return rows.join(F.broadcast(cells), keys, "left").drop(*keys).withColumn("probability", F.col("weight") / top)


def _described(docs: DataFrame, targets: dict, *columns: Column) -> DataFrame:
    """source, lang, the language's group, v and n_tokens of every document, and ``columns``."""
    rows = docs.select("source", F.col("lang").alias("own_lang"), grouped(F.col("lang"), language_groups(targets)).alias("lang"),
                       described(F.col("text")).alias("d"), *columns)
    return rows.select("source", "own_lang", "lang", "d.v", "d.n_tokens", *[c for c in rows.columns if c not in ("source", "own_lang", "lang", "d")])


def language_groups(targets: dict) -> dict[str, float]:
    return {} if isinstance(targets["lang"], Tempered) else targets["lang"]


def _topical(rows: DataFrame, topics: Topics) -> DataFrame:
    return rows.withColumn("topic", topics.of(F.col("v"), F.col("lang"))).drop("v", "lang").withColumnRenamed("own_lang", "lang")


def _draw() -> Column:
    return unit_hash(F.col("doc_id").cast("long"), F.col("text")).alias("draw")


def mixed(docs: DataFrame, targets: dict) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, probability, kept) of
    every document."""
    text_batches(docs.sparkSession)
    rows = staged(_described(docs, targets, F.col("doc_id").cast("long").alias("doc_id"), _draw()), "mix-vectors")
    rows = staged(_topical(rows, fit_topics(rows.select("lang", "v"))), "mix-rows")
    goals = resolved(rows, targets)
    found = with_probability(rows, cell_weights(rows, goals), goals).withColumn("kept", F.col("draw") < F.col("probability"))
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept")


def sample(docs: DataFrame, targets: dict) -> DataFrame:
    """The rows of ``docs`` (all columns) that the mixture keeps. Texts are described
    twice: a few numbers a text are written in between, but not the texts."""
    text_batches(docs.sparkSession)
    rows = staged(_described(docs, targets), "mix-vectors")
    topics = fit_topics(rows.select("lang", "v"))
    cells = staged(_topical(rows, topics), "mix-cells")
    goals = resolved(cells, targets)
    weights = cell_weights(cells, goals)
    topic = topics.of_text(F.col("text"), grouped(F.col("lang"), language_groups(targets)))
    held = docs.select("source", "lang", topic.alias("topic"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _draw())
    return with_probability(held, weights, goals).where(F.col("draw") < F.col("probability")).select("row.*")
