"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are equal), of
at least ``EXPONENT`` periods and ``MIN_LENGTH`` words, that no neighbouring word
extends. Scales are tau = 1, 2, 4, ...; scale tau finds the periods in
[tau, 2 tau).

* Every window of tau words has a hash, built from two windows of half its size.
  Windows inside a run already found whose period is at most tau / 4 are highly
  periodic and take no part.
* Position i is in the synchronising set if the smallest hash of the other windows
  that start in [i, i + tau] starts at i or at i + tau. Whether it is depends on
  the words [i, i + 2 tau) alone, its context.
* Two consecutive positions of the set with equal contexts, at a distance d in
  [tau, 2 tau), propose d. The stretch of period d around them is then measured on
  the words themselves, so hashes decide nothing but the proposals.

Why no run is missed: let its smallest period be q, tau <= q < 2 tau. Its positions
whose context lies in the run once more q words later are more than q. Were none of
them in the set, all the windows there would be highly periodic, hence (neighbours
overlap enough) of one period of at most tau / 4, which would be the run's. Of equal
contexts in the run the next one is exactly q words on: were it d < q, the stretch
would have the periods d and q and so a smaller one. The highly periodic regions that
the set leaves out are the runs of the smaller scales, which precede it. Windows are
known by 64-bit hashes; two different ones in a text collide with probability 2^-64.

Texts are independent, so documents are never shuffled: a task works on slices of
bounded size, all texts of a slice at once, a longer text by itself. Null and empty
texts have no words and no runs; repeated rows are separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import mix64
from .near_dup import runs as slices
from .plain_words import PlainWords

EXPONENT = 4
MIN_LENGTH = 6
_OUT = np.uint64(0xFFFFFFFFFFFFFFFF)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    low, have = values, 1
    while 2 * have <= width:
        low, have = np.minimum(low[:-have], low[have:]), 2 * have
    rest = width - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def synchronising_set(window: np.ndarray, tau: int) -> np.ndarray:
    """Positions i for which the least of window[i .. i + tau] lies at an end."""
    low = window_minimum(window, tau + 1)
    n = len(low)
    return np.flatnonzero(((low == window[:n]) | (low == window[tau: tau + n])) & (low != _OUT))


def periodic_windows(found: list[tuple[int, int, int]], tau: int, n: int) -> np.ndarray:
    """Which of n windows of tau words lie in a found run of period <= tau / 4."""
    edge = np.zeros(n + 1, np.int64)
    for start, period, end in found:
        if 4 * period <= tau <= end - start and start < n:
            edge[start] += 1
            edge[min(end - tau + 1, n)] -= 1
    return np.cumsum(edge[:n]) > 0


def stretch(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest [start, end) around ``at`` whose words ``period`` apart are equal."""
    end, step = at, 64
    while True:
        y = words[end + period: end + period + step]
        other = np.flatnonzero(words[end: end + len(y)] != y)
        if len(other) or len(y) < step:
            end += int(other[0]) if len(other) else len(y)
            break
        end, step = end + step, 4 * step
    start, step = at, 64
    while start:
        low = max(0, start - step)
        other = np.flatnonzero(words[low:start] != words[low + period: start + period])
        if len(other):
            start = low + int(other[-1]) + 1
            break
        start, step = low, 4 * step
    return start, end + period


def proposals(positions: np.ndarray, context: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of consecutive equal contexts, by period, then position."""
    key = context[positions]
    order = np.argsort(key, kind="stable")
    key, place = key[order], positions[order]
    gap = place[1:] - place[:-1]
    fits = (key[1:] == key[:-1]) & (gap >= tau) & (gap < 2 * tau)
    place, gap = place[:-1][fits], gap[fits]
    order = np.lexsort((place, gap))
    return place[order], gap[order]


def find_runs(words: np.ndarray, size: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, period, end) of all stretches of at least EXPONENT periods, in the
    concatenated texts ``words`` of ``size`` words each, the largest text first. Each
    text is followed by a word that occurs nowhere else."""
    ends, found = np.cumsum(size + 1), []
    window = mix64(words.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    tau = 1
    while True:
        texts = int(np.searchsorted(-size, -EXPONENT * tau, side="right"))  # those with room for a run
        if not texts:
            return found
        n = int(ends[texts - 1])
        window = window[: n - tau + 1]
        context = mix64(window[:-tau] * np.uint64(0xC2B2AE3D27D4EB4F) + mix64(window[tau:] + np.uint64(tau)))
        free = np.where(periodic_windows(found, tau, len(window)), _OUT, window)
        reach = (0, 0, 0)  # of the last stretch: period, start, end
        new = []
        for at, period in zip(*(x.tolist() for x in proposals(synchronising_set(free, tau), context, tau))):
            if period == reach[0] and at + period + 2 * tau <= reach[2]:
                continue
            start, end = stretch(words, at, period)
            reach = (period, start, end)
            if end - start >= EXPONENT * period:
                new.append((start, period, end))
        found += new
        window, tau = context, 2 * tau


def runs_of(texts: pa.Array) -> tuple[PlainWords, np.ndarray, np.ndarray]:
    """The words of some texts, their runs (text, start, length, period) in order,
    and which words are kept."""
    plain = PlainWords(texts)
    order = np.argsort(-plain.size, kind="stable")
    size, begin = plain.size[order], plain.starts()
    place = np.cumsum(size + 1) - size - 1  # of each text, the largest first
    words = -1 - np.arange(int((size + 1).sum()), dtype=np.int64)  # the words between texts
    at = np.arange(len(plain.number)) + np.repeat(place[np.argsort(order)] - begin[:-1], plain.size)
    words[at] = plain.number
    found = np.array([r for r in find_runs(words, size) if r[2] - r[0] >= MIN_LENGTH], np.int64).reshape(-1, 3)
    which = np.searchsorted(place, found[:, 0], side="right") - 1
    text, start = order[which], found[:, 0] - place[which]
    got = np.stack([text, start, found[:, 2] - found[:, 0], found[:, 1]], 1)
    got = got[np.lexsort((got[:, 3], got[:, 1], got[:, 0]))]
    edge = np.zeros(len(plain.number) + 1, np.int64)
    first = begin[got[:, 0]] + got[:, 1]
    np.add.at(edge, first + got[:, 3], 1)
    np.add.at(edge, first + got[:, 2], -1)
    return plain, got, np.cumsum(edge[:-1]) == 0


def collapsed(plain: PlainWords, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    left = np.concatenate([[0], np.cumsum(keep)])[plain.starts()].astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(left), plain.words.filter(pa.array(keep))), " ")


def periodic_runs(docs: DataFrame, text: Column | str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs``: runs as structs
    (start, length, period), word numbers from 0, by start, then period; collapsed is
    the text without the words of a run after its first period, joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text"):
                plain, got, keep = runs_of(part.column("text"))
                offsets = np.searchsorted(got[:, 0], np.arange(part.num_rows + 1)).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(got[:, k]) for k in (1, 2, 3)], fields=list(RUN))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(plain.size), pa.ListArray.from_arrays(pa.array(offsets), items),
                     collapsed(plain, keep)], ["doc_id", "n_words", "runs", "collapsed"])

    text = F.col(text) if isinstance(text, str) else text
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for one in ten ids a text whose words from a place on repeat."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))), " ")

    words = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return F.coalesce(F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w))), 1), text)


def digests(found: DataFrame) -> DataFrame:
    """Per document its number of runs, the run of the greatest exponent and
    SHA-256 sums of all runs and of the collapsed text."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.reduce("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))
