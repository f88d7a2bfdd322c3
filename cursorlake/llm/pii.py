"""Personal data: exact base spans, and boosted trees over candidate spans.

Base spans follow fixed forms (:func:`base_spans`). High-recall generators propose
further, overlapping candidates: addresses with spelt-out signs, numbers in
national or unusual grouping, dotted numbers. Boosted trees score each candidate
by its format and its context; a threshold per kind, calibrated on held-out
examples, decides what is added. Base spans always stay, and an added span never
overlaps another span.

Training needs no labels: base spans of all texts are positive, also in disguises
(spelt-out signs, other separators, a missing plus), each in its own context;
candidates that touch no base span are negative. Different examples count once.
Trees and thresholds come from all of them, by sums in Spark; a caller may ask for
a sample of the texts instead. Every text is scored whole.

Positions are code points, ends exclusive. A null text counts as empty.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .boosting import BoostedTrees
from .common import drop_staged, frames, staged, text_batches, unit_hash, written

KINDS = ("email", "ip", "card", "phone")
SAMPLE_SPANS = 20_000
MAX_FALSE = 0.001
AROUND = 24

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# generators of candidates
_SPELT = re.compile(r"(?<![\w.+-])[\w.+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}) ?[\w-]{1,64}"
                    r"(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z][\w-]{1,30})+", re.I)
_NUMBER = re.compile(r"(?<![\w.+])(?:\([0-9]{2,4}\)[ -]?)?[0-9]{1,19}(?:[ ./-]{1,2}\(?[0-9]{1,19}\)?){0,8}(?!\w)")
_CUES = {"email": ("mail", "contact", "write", "@"), "ip": ("ip", "host", "server", "addr"),
         "card": ("card", "visa", "pay", "iban"), "phone": ("tel", "phone", "call", "fon", "mobil")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted: leftmost, non-overlapping per kind;
    matches that fail their test are dropped without another try."""
    out = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at  # the run of name characters before the sign, as far as it is free
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append((start, 0, host.end()))
            free = host.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of everything that might be personal data
    beyond the base spans; spans may overlap and have several kinds."""
    out = [(m.start(), 0, m.end()) for m in _SPELT.finditer(text)] if "at" in text.lower() and re.search("[([{]at", text, re.I) else []
    for m in _NUMBER.finditer(text):
        size = m.end() - m.start()
        if 7 <= size <= 40:
            n = len(_digits(m[0]))
            if m[0].count(".") == 3:
                out.append((m.start(), 1, m.end()))
            if 12 <= n <= 19:
                out.append((m.start(), 2, m.end()))
            if 7 <= n <= 15:
                out.append((m.start(), 3, m.end()))
    return out


def features(kind: int, span: str, before: str, after: str) -> list[float]:
    """Format of the span and its context (up to AROUND characters each side)."""
    digits, near = _digits(span), before.lower()
    groups = re.findall("[0-9]+", span)
    parts = [int(g[:6]) for g in groups[:4]]
    size = [len(g) for g in groups] or [0]
    prev, post = before[-1:], after[:1]
    return [kind, len(span), len(digits), len(digits) / max(1, len(span)), len(groups), size[0], size[-1], max(size), min(size),
            span.count("."), span.count("-"), span.count(" "), span.count("/"), span.count("("), float(span[:1] == "+"),
            float(luhn(digits)) if digits else 0.0, float(len(parts) == 4 and max(parts) <= 255), float(digits[:1] == "0"),
            len(set(digits)), float(span[:1].isalpha()), float("at" in span.lower()), float(prev.isalnum()),
            float(prev in ("", " ", "\n")), float(post.isalnum()), float(post in ("", " ", "\n", ".", ",")),
            *(float(any(c in near for c in _CUES[k])) for k in KINDS), float(prev in "=:#\"'" and prev != "")]


def _context(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - AROUND): start], text[end: end + AROUND]


def disguises(kind: int, span: str) -> list[str]:
    """Other ways to write a base span of a kind."""
    if kind == 0:
        name, _, host = span.partition("@")
        return [f"{name} (at) {host}", f"{name}[at]{host.replace('.', '[dot]')}"]
    if kind == 2:
        d = _digits(span)
        return [".".join(d[i:i + 4] for i in range(0, len(d), 4)), "/".join(d[i:i + 4] for i in range(0, len(d), 4))]
    if kind == 3:
        local = re.sub(r"^\+[0-9]{1,3}[ .-]+", "", span)
        return [span[1:], local] if len(_digits(local)) >= 7 else [span[1:]]
    return []


def examples(text: str) -> Iterator[tuple[int, int, list[float], int]]:
    """(kind, label, features, fold) for training; folds split by content."""
    base = base_spans(text)
    for start, kind, end in base:
        for shown in (text[start:end], *disguises(kind, text[start:end])):
            yield kind, 1, features(kind, shown, *_context(text, start, end)), zlib.crc32(text[start:end].encode()) % 3
    for start, kind, end in candidates(text):
        if all(end <= s or e <= start for s, _, e in base):
            yield kind, 0, features(kind, text[start:end], *_context(text, start, end)), zlib.crc32(
                text[start:end].encode("utf-8", "replace")) % 3


class PiiModel:
    """Boosted trees and one threshold per kind (above 1: nothing is added)."""

    def __init__(self, trees: BoostedTrees, thresholds: np.ndarray):
        self.trees, self.thresholds = trees, thresholds

    @classmethod
    def fit(cls, kind: np.ndarray, y: np.ndarray, x: np.ndarray, fold: np.ndarray, max_false: float = MAX_FALSE) -> "PiiModel":
        """Trees on folds 1 and 2; fold 0 sets the least threshold per kind at
        which at most ``max_false`` of the negatives pass, and at least 0.9."""
        trees = BoostedTrees(trees=50).fit(x[fold > 0], y[fold > 0])
        thresholds = np.full(len(KINDS), 2.0)
        test = trees.predict(x[fold == 0]) if (fold == 0).any() else np.zeros(0)
        for k in range(len(KINDS)):
            at = kind[fold == 0] == k
            good, bad = test[at & (y[fold == 0] == 1)], np.sort(test[at & (y[fold == 0] == 0)])
            if len(good):
                limit = bad[len(bad) - 1 - int(max_false * len(bad))] if len(bad) else 0.0
                thresholds[k] = max(0.9, np.nextafter(limit, 2))
        return cls(trees, thresholds)

    @classmethod
    def fit_rows(cls, rows: DataFrame, max_false: float = MAX_FALSE) -> "PiiModel":
        """The same from all rows (kind, y, x, fold) of a table, however many."""
        trees = BoostedTrees(trees=50).fit_rows(rows.where("fold > 0"))
        text_batches(rows.sparkSession, 8192)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    score = trees.predict(np.stack(b["x"]))
                    yield pd.DataFrame({"kind": b["kind"], "y": b["y"], "bits": score.view(np.int64)})

        scores = staged(rows.where("fold = 0").mapInPandas(run, "kind int, y int, bits long"), "pii-scores")
        count = {(x.kind, x.y): x.n for x in scores.groupBy("kind", "y").agg(F.count("*").alias("n")).collect()}
        n_bad = {k: count[k, 0] for k in range(len(KINDS)) if (k, 0) in count}
        limits = kth_largest(scores.where("y = 0"), {k: int(max_false * n) for k, n in n_bad.items()})
        thresholds = np.full(len(KINDS), 2.0)
        for k in range(len(KINDS)):
            if (k, 1) in count:
                thresholds[k] = max(0.9, np.nextafter(limits.get(k, 0.0), 2))
        return cls(trees, thresholds)

    def added(self, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        """Accepted candidates per text: best scores first, no overlaps."""
        found = [[c for c in candidates(t) if all(c[2] <= s or e <= c[0] for s, _, e in b)] for t, b in zip(texts, base)]
        rows = [features(k, t[s:e], *_context(t, s, e)) for t, f in zip(texts, found) for s, k, e in f]
        score = iter(self.trees.predict(np.array(rows)).tolist() if rows else ())
        out = []
        for f in found:
            taken: list[tuple[int, int, int]] = []
            for _, c in sorted(((-next(score), c) for c in f)):
                if -_ >= self.thresholds[c[1]] and all(c[2] <= s or e <= c[0] for s, _k, e in taken):
                    taken.append(c)
            out.append(sorted(taken))
        return out


def kth_largest(scores: DataFrame, rank: dict[int, int]) -> dict[int, float]:
    """Per kind the score that ``rank`` rows (kind, bits) lie before, largest first.
    ``bits`` are those of scores from 0 on, which have the order of the scores; each
    job counts the rows by 16 more of them, so none is sorted."""
    rank, found = dict(rank), dict.fromkeys(rank, 0)
    for shift in (48, 32, 16, 0):
        near = F.lit(False)
        for k, prefix in found.items():
            near = near | ((F.col("kind") == k) & (F.shiftright(F.shiftright("bits", shift), 16) == prefix))
        digit = F.shiftright("bits", shift).bitwiseAND(F.lit(0xFFFF).cast("long")).alias("digit")
        counts = scores.where(near).groupBy("kind", digit).agg(F.count("*").alias("n")).orderBy(F.desc("digit")).collect()
        for k in found:
            for x in counts:
                if x.kind == k:
                    if rank[k] < x.n:
                        found[k] = found[k] << 16 | x.digit
                        break
                    rank[k] -= x.n
    return {k: float(np.int64(v).view(np.float64)) for k, v in found.items()}


def fit(docs: DataFrame, text_col: str = "text", sample_texts: int | None = None, sample_spans: int = SAMPLE_SPANS) -> PiiModel:
    """Train on the different examples of all texts; or, if ``sample_texts`` is given,
    on about so many of the different texts, chosen by hash, and at most
    ``sample_spans`` different examples of them."""
    spark, before = docs.sparkSession, written()
    text_batches(spark)
    n = len(features(0, "", "", ""))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [x for t in b["text"] for x in examples(t)]
            yield from frames(dict(zip(("kind", "y", "x", "fold"), zip(*got))) if got else {})

    def different(texts: DataFrame) -> DataFrame:
        return texts.mapInPandas(run, "kind int, y int, x array<double>, fold int").distinct()

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if sample_texts is None:
        model = PiiModel.fit_rows(staged(different(texts), "pii-examples"))
        drop_staged(spark, before, keep=0)
        text_batches(spark)
        return model
    n_texts = texts.select(F.xxhash64("text").alias("h")).distinct().count()
    if n_texts > sample_texts:
        texts = texts.where(unit_hash(F.col("text")) < sample_texts / n_texts)
    got = different(texts.distinct()).orderBy(F.xxhash64("x"), "kind", "y", "fold").limit(sample_spans).toPandas()
    if not len(got):
        return PiiModel(BoostedTrees().fit(np.zeros((0, n)), np.zeros(0)), np.full(len(KINDS), 2.0))
    return PiiModel.fit(got["kind"].to_numpy(), got["y"].to_numpy(), np.stack(got["x"]), got["fold"].to_numpy())


def spans(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added) per row, as arrays of (kind, start, end)."""
    text_batches(docs.sparkSession)

    def named(found):
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            base = [base_spans(t) for t in texts]
            added = model.added(texts, base)
            yield from frames({"doc_id": b["doc_id"], "base": [named(x) for x in base], "added": [named(x) for x in added]})

    kind = "array<struct<kind:string,start:int,end:int>>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"doc_id long, base {kind}, added {kind}")


def redacted(model: PiiModel, text: Column) -> Column:
    """The text with every span replaced by its kind in brackets."""
    @F.pandas_udf("string")
    def hide(texts: pd.Series) -> pd.Series:
        texts = texts.tolist()
        base = [base_spans(t) for t in texts]
        out = []
        for t, b, a in zip(texts, base, model.added(texts, base)):
            at, parts = 0, []
            for s, k, e in sorted(b + a):
                if s >= at:
                    parts += [t[at:s], f"[{KINDS[k]}]"]
                at = max(at, e)
            out.append("".join((*parts, t[at:])))
        return pd.Series(out)

    return hide(F.coalesce(text, F.lit("")))


def joined(found: Column) -> Column:
    """kind:start:end by start, then kind as listed in KINDS, comma-joined."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("at"),
                                                  s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    count = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *count, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"), F.size("added").alias("n_added"))
