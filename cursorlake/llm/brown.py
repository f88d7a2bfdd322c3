"""Class-based bigram language model with Brown's exchange clustering.

    p(w | v) = p(class(w) | class(v)) * p(w | class(w))

Counting, clustering and scoring are Spark jobs over all documents; words are
runs of anything but ASCII white space, A-Z lower-cased, with one end token per
document (which is also the context of its first word).

* Every training word is counted. A word of at least the share HEAD of all tokens
  (at most 1 / HEAD of them) gets a class of its own choice and is known to the
  tasks; texts are staged as numbers of these words.
* The SEEDS most frequent words are clustered on the driver by the exchange
  algorithm, one word after the other, until no move raises the likelihood of their
  bigram table.
* All head words are then exchanged in Spark, as distributed exchange clustering
  does: a sweep counts each word's neighbours by class, in tasks and by a shuffle
  on words (rows are packed, a frequent word is one entry per task), and each word
  moves to the class with the greatest gain while the others stay. Moves of one
  sweep are made at once, so after each the likelihood is counted anew: sweeps go on
  while it rises by more than LEAST_GAIN per token, and the best assignment is kept.
  A move depends on counts only, not on partitions. The driver holds the classes of
  at most 1 / HEAD words and a table of classes by classes.
* The other words, and words never seen, form one class of their own; the end
  token is a class too.
* Occurrences of words below HEAD leave the task as one row per document and word
  and meet the count table in a join; such a word has few rows by definition.

Probabilities are smoothed by ALPHA: emissions over the words of a class (the
class of the rest has one more, the unknown word), transitions over classes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import frames, staged, text_batches

CLASSES = 48
SEEDS = 1000
HEAD = 1e-6  # not below 2 ** -24: words are numbered in three bytes
ALPHA = 0.1
LEAST_GAIN = 0.002
FLUSH_WORDS = 400_000
FLUSH_ENTRIES = 2_000_000
BUCKETS = 64
END = b"\n"  # never a word: white space


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over ``docs`` (text), the end token included."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for b in batches:
            for t in b["text"]:
                held.update(words_of(t))
            held[END] += len(b)
            if len(held) > FLUSH_WORDS:
                yield from frames({"word": list(held), "n": list(held.values())})
                held = Counter()
        yield from frames({"word": list(held), "n": list(held.values())})

    return docs.select("text").mapInPandas(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def pack_numbers(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned 32-bit numbers, one plane per byte."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def unpack_numbers(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = planes[0].astype(np.int64)
    for i in range(1, width):
        out |= planes[i].astype(np.int64) << (8 * i)
    return out


def pairs(ids: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Previous and present word of every token of some documents; word 0 is the
    end token, which closes each document and goes before its first word."""
    now = np.concatenate([unpack_numbers(x, 3) for x in ids])
    return np.concatenate([[0], now[:-1]]), now


def pair_counts(encoded: DataFrame, labels: np.ndarray, m: int) -> np.ndarray:
    """Bigram counts of the words' labels, all below ``m``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(m * m, np.int64)
        for b in batches:
            if len(b):
                before, now = pairs(b["ids"])
                codes, n = np.unique(labels[before].astype(np.int64) * m + labels[now], return_counts=True)
                total[codes] += n
        used = np.flatnonzero(total)
        yield from frames({"code": used, "n": total[used]})

    got = encoded.select("ids").mapInPandas(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(m * m, np.int64)
    out[got["code"].to_numpy(np.int64)] = got["n"]
    return out.reshape(m, m)


def _plogp(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(joint: np.ndarray) -> float:
    """Sum of N(c, d) log N(c, d) less the sums of N(c) log N(c) over both sides:
    the log-likelihood of the words less a constant."""
    joint = joint.astype(float)
    return float(_plogp(joint).sum() - _plogp(joint.sum(0)).sum() - _plogp(joint.sum(1)).sum())


def take_out(joint: np.ndarray, old: int, out_: np.ndarray, in_: np.ndarray, own: float, sign: int = 1) -> None:
    """Take a word's bigrams out of the class table (``sign`` -1: put them in)."""
    joint[old] -= sign * out_
    joint[:, old] -= sign * in_
    joint[old, old] += sign * own


def gains(joint: np.ndarray, out_: np.ndarray, in_: np.ndarray, own: float) -> np.ndarray:
    """Likelihood gained by putting a word, that is in no class, into each class.
    ``out_`` and ``in_`` count the classes after and before it, without itself;
    classes 0 and 1 take no word."""
    after, before = np.flatnonzero(out_), np.flatnonzero(in_)
    a, b, diag = joint[:, after], joint[before], np.diagonal(joint)
    gain = (_plogp(a + out_[after]) - _plogp(a)).sum(1) + (_plogp(b + in_[before, None]) - _plogp(b)).sum(0)
    gain -= _plogp(diag + out_) + _plogp(diag + in_) - _plogp(diag) - _plogp(diag + out_ + in_ + own)
    size_r, size_c = joint.sum(1) + in_, joint.sum(0) + out_  # the other classes' sums, wherever it goes
    add_r, add_c = out_.sum() + own, in_.sum() + own
    gain -= _plogp(size_r + add_r) - _plogp(size_r) + _plogp(size_c + add_c) - _plogp(size_c)
    gain[:2] = -np.inf
    return gain


def exchange(counts: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of every row of ``counts``: class 0 is row 0 (the end token) and
    class 1 the last row (the rest); the other rows move among the others until no
    move helps. A word starts in the class of its frequency rank.
    """
    n = counts.astype(float)
    m = len(n)
    free = np.arange(1, m - 1)
    k = 2 + max(1, min(classes, len(free)))
    of = np.ones(m, int)
    of[0] = 0
    order = free[np.argsort(-n[free].sum(1), kind="stable")]
    of[order] = 2 + np.arange(len(order)) % (k - 2)
    member = np.zeros((m, k))
    member[np.arange(m), of] = 1
    right, left = n @ member, n.T @ member  # counts word -> next class, previous class -> word
    joint = member.T @ right
    moved = True
    while moved:
        moved = False
        for w in order:
            old, out_, in_, own = of[w], right[w].copy(), left[w].copy(), n[w, w]
            take_out(joint, old, out_, in_, own)
            out_[old] -= own
            in_[old] -= own
            gain = gains(joint, out_, in_, own)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-6:
                new = old
            joint[new] += out_
            joint[:, new] += in_
            joint[new, new] += own
            if new != old:
                moved = True
                of[w] = new
                right[:, old] -= n[:, w]
                right[:, new] += n[:, w]
                left[:, old] -= n[w]
                left[:, new] += n[w]
    return of


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat(n, first)


def best_moves(encoded: DataFrame, of: np.ndarray, joint: np.ndarray) -> pd.DataFrame:
    """(word, class) of the head words that another class suits better, each judged
    with all others in their present class ``of`` (last entry: words below HEAD).

    A word has 2 k + 1 counts: next classes, previous classes, itself. Tasks send
    them packed, a row per bucket of words; a bucket's task adds them up in an array
    of its words, at most 1 / HEAD / BUCKETS of them.
    """
    k, none = len(joint), len(of) - 1
    width, words = 2 * k + 1, none // BUCKETS + 1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def place(w):
            return (w % BUCKETS * words + w // BUCKETS) * width

        def rows(code, n):
            bounds = np.searchsorted(code, np.arange(BUCKETS + 1) * words * width)
            parts = [(i, a, b) for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
            return frames({"bucket": [i for i, _, _ in parts],
                           "code": [pack_numbers(np.diff(code[a:b], prepend=i * words * width), 4) for i, a, b in parts],
                           "n": [pack_numbers(n[a:b], 4) for _, a, b in parts]})

        codes, counts, held = [], [], 0
        for b in batches:
            if not len(b):
                continue
            before, now = pairs(b["ids"])
            left, right, same = (now > 0) & (now < none), (before > 0) & (before < none), (now == before) & (now > 0) & (now < none)
            code, n = np.unique(np.concatenate([place(before[right]) + of[now[right]], place(now[left]) + k + of[before[left]],
                                                place(now[same]) + 2 * k]), return_counts=True)
            codes.append(code)
            counts.append(n)
            held += len(code)
            if held > FLUSH_ENTRIES:
                code, n = _merged(codes, counts)
                codes, counts, held = [code], [n], len(code)
                if held > FLUSH_ENTRIES // 2:
                    yield from rows(code, n)
                    codes, counts, held = [], [], 0
        if held:
            yield from rows(*_merged(codes, counts))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for bucket, code, n in zip(b["bucket"], b["code"], b["n"]):
                if bucket not in totals:
                    totals[bucket] = np.zeros(words * width)
                totals[bucket][np.cumsum(unpack_numbers(code, 4))] += unpack_numbers(n, 4)
        table, moves = joint.astype(float), []
        for bucket, total in totals.items():
            total = total.reshape(words, width)
            for at in np.flatnonzero(total.any(1)):
                w = int(at) * BUCKETS + bucket
                old, own = int(of[w]), total[at, 2 * k]
                out_, in_ = total[at, :k].copy(), total[at, k:2 * k].copy()
                whole = out_.copy(), in_.copy()
                take_out(table, old, *whole, own)
                out_[old] -= own
                in_[old] -= own
                gain = gains(table, out_, in_, own)
                take_out(table, old, *whole, own, -1)
                new = int(gain.argmax())
                if gain[new] > gain[old] + 1e-6:
                    moves.append((w, new))
        yield from frames(dict(zip(("word", "class"), zip(*moves))) if moves else {})

    sent = encoded.select("ids").mapInPandas(count, "bucket int, code binary, n binary")
    return sent.repartition(BUCKETS, "bucket").mapInPandas(decide, "word int, class int").toPandas()


def cluster(encoded: DataFrame, n_words: int, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the words 0 (the end token) to ``n_words`` (those below HEAD), and
    the bigram counts of the classes."""
    seeds = min(SEEDS, n_words - 1)
    first = exchange(pair_counts(encoded, np.minimum(np.arange(n_words + 1), seeds + 1), seeds + 2), classes)
    k = max(2, int(first.max()) + 1)
    of = np.ones(n_words + 1, np.int64)
    of[: seeds + 1] = first[:-1]
    joint = pair_counts(encoded, of, k)
    tokens = max(1, int(joint.sum()))
    while k > 2:
        moves = best_moves(encoded, of, joint)
        new = of.copy()
        new[moves["word"].to_numpy(np.int64)] = moves["class"]
        table = pair_counts(encoded, new, k)
        gain = (likelihood(table) - likelihood(joint)) / tokens
        if gain > 0:
            of, joint = new, table
        if gain <= LEAST_GAIN:
            break
    return of, joint


@dataclass
class ClassModel:
    """Head words with their classes ``of``, counts and log10 emissions; log10
    transitions of classes."""

    tokens: int
    vocabulary: int
    words: list[bytes]
    of: np.ndarray
    n: np.ndarray
    emit: np.ndarray
    step: np.ndarray
    rest_size: float

    @property
    def base_size(self) -> float:
        return self.tokens + ALPHA * (self.vocabulary + 1)


def head_words(counts: DataFrame) -> tuple[int, int, list[bytes], np.ndarray]:
    """Number of training tokens and words; the head words by falling count, the end
    token first whatever its count; their counts."""
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, vocabulary = int(whole[0]), int(whole[1])
    rows = counts.where(F.col("n") >= HEAD * tokens).collect()  # at most 1 / HEAD
    n_of = {bytes(r["word"]): int(r["n"]) for r in rows}
    words = [END, *sorted((w for w in n_of if w != END), key=lambda w: (-n_of[w], w))]
    return tokens, vocabulary, words, np.array([n_of.get(w, 0) for w in words], np.int64)


def fit(encoded: DataFrame, tokens: int, vocabulary: int, words: list[bytes], n: np.ndarray,
        classes: int = CLASSES) -> ClassModel:
    """Fit on the encoded training documents (ids) and their head words."""
    of, bigrams = cluster(encoded, len(words), classes)
    k = len(bigrams)
    joint = bigrams + ALPHA
    step = np.log10(joint / joint.sum(1, keepdims=True))
    of = of[:-1]
    size, types = np.bincount(of, n, k), np.bincount(of, minlength=k)
    seen = np.bincount(of, n > 0, k)
    # the rest: head words left in class 1, words below HEAD and the unknown word
    rest_size = tokens - size.sum() + size[1] + ALPHA * (vocabulary - seen.sum() + seen[1] + 1)
    total = size + ALPHA * types
    total[1] = rest_size
    emit = np.log10(n + ALPHA) - np.log10(total[of])
    return ClassModel(tokens, vocabulary, words, of, n, emit, step, rest_size)


def encode(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """Per document: its words as packed numbers, with ``len(words)`` for words
    below HEAD, and those words with their numbers of occurrences. ``key`` names the
    row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {w: i for i, w in enumerate(words)}
        none, row = len(words), TaskContext.get().partitionId() << 33
        for b in batches:
            out = []
            for doc_id, held, t in zip(b["doc_id"], b["held_out"], b["text"]):
                found = words_of(t)
                at = [place.get(w, none) for w in found]
                rare = Counter(w for w, i in zip(found, at) if i == none)
                at.append(0)
                out.append((row, doc_id, held, pack_numbers(np.array(at), 3), list(rare), list(rare.values())))
                row += 1
            yield from frames(dict(zip(("key", "doc_id", "held_out", "ids", "rare", "times"), zip(*out))) if out else {})

    return docs.mapInPandas(run, "key long, doc_id long, held_out boolean, ids binary, rare array<binary>, times array<long>")


def document_parts(encoded: DataFrame, model: ClassModel) -> DataFrame:
    """Per document: sums over transitions and head words."""
    step, log_base = model.step, float(np.log10(model.base_size))
    cls, n, emit = np.append(model.of, 1), np.append(model.n, 0), np.append(model.emit, 0.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = np.append(np.log10(n[:-1] + ALPHA) - log_base, 0.0)
        known = (n > 0).astype(np.int64)
        for b in batches:
            out = []
            for key, doc_id, held, ids in zip(b["key"], b["doc_id"], b["held_out"], b["ids"]):
                at = unpack_numbers(ids, 3)
                c = cls[at]
                moves = step[np.concatenate([cls[:1], c[:-1]]), c].sum()
                out.append((key, doc_id, held, len(at), int(known[at].sum()), float(base[at].sum()), float(moves + emit[at].sum())))
            yield from frames(dict(zip(("key", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"), zip(*out)))
                              if out else {})

    return encoded.select("key", "doc_id", "held_out", "ids").mapInPandas(
        run, "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double")


def score(docs: DataFrame, held_out: Column, classes: int = CLASSES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Scores of all documents by a model of those that are not ``held_out``.

    A null text counts as empty and is scored as its end token. Without training
    documents every word is unknown (train_tokens 0).
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    training = rows.where(~F.col("held_out"))
    counts = staged(word_counts(training), "lm-counts")
    tokens, vocabulary, words, n = head_words(counts)
    encoded = staged(encode(rows, words), "lm-ids")
    model = fit(encoded.where(~F.col("held_out")), tokens, vocabulary, words, n, classes)
    log = F.log10(F.coalesce("n", F.lit(0)) + ALPHA)
    rare = encoded.where(F.size("rare") > 0).select("key", F.explode(F.arrays_zip("rare", "times")).alias("e")) \
        .select("key", F.col("e.rare").alias("word"), F.col("e.times").alias("times")) \
        .join(counts.where(F.col("n") < HEAD * model.tokens), "word", "left") \
        .groupBy("key").agg(F.sum(F.col("times") * log).alias("logs"), F.sum("times").alias("rare_tokens"),
                            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    size, rest = float(np.log10(model.base_size)), float(np.log10(model.rest_size))
    zero = {"logs": 0.0, "rare_tokens": 0, "rare_known": 0}
    return document_parts(encoded, model).join(rare, "key", "left").fillna(zero).select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("logs") - F.col("rare_tokens") * size).alias("base_score"),
        (F.col("score") + F.col("logs") - F.col("rare_tokens") * rest).alias("score"))
