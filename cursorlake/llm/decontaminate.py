"""Benchmark decontamination by pigeonhole edit matching.

Text and test items are compared as lower-cased words joined by single spaces. A
document holds an item if some part of it is within ``k`` edits of the item,
``k = floor(rate * length)`` characters. An item is cut into k + 1 pieces: of any
k edits at least one piece stays whole, so

1. one Aho-Corasick pass over the document finds all exact piece hits;
2. around every hit, Myers' bit-parallel search finds the smallest edit distance
   of the whole item, with one machine integer holding a column.

Nothing is missed and nothing is reported that is not within k edits. Items go to
the tasks in blocks of bounded size; documents are never shuffled.

Null texts and texts without words hold nothing; items of fewer than
``min_words`` words are no evidence and take no part. Repeated items count once,
repeated documents are separate rows. Items without an id take part like the others:
each text of theirs is an item of its own, reported with a null item_id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import frames, per_worker, text_batches

RATE = 0.07
MIN_WORDS = 5
ITEM_BLOCK = 2000
_WORDS = r"[^\W_]+"


def normalized(text: str | None) -> str:
    return " ".join(re.findall(_WORDS, (text or "").lower()))


def edit_search(pattern: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of ``pattern`` to any part of ``text``, and the end
    of the first such part (Myers' bit-parallel columns)."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = equal.get(c, 0)
        x = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (full & ~(x | up)), up & x
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
            if score < best:
                best, end = score, at
        plus, minus, eq = (plus << 1) & full, (minus << 1) & full, eq | down
        up, down = minus | (full & ~(eq | plus)), plus & eq
    return best, end


class ItemIndex:
    """The pieces of a block of items: find(text) -> {(item_id, name): (distance,
    end)}, name being the item's text if it has no id, else empty."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        import ahocorasick
        self.items = [(key, text, int(rate * len(text))) for key, text in items]
        owners: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, k) in enumerate(self.items):
            cuts = np.linspace(0, len(text), k + 2).astype(int)
            for a, b in zip(cuts, cuts[1:]):
                owners.setdefault(text[a:b], []).append((n, int(a)))
        self.pieces = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.pieces.add_word(piece, (len(piece), places))
        if owners:
            self.pieces.make_automaton()

    def find(self, text: str) -> dict[tuple[int | None, str], tuple[int, int]]:
        starts: dict[int, set[int]] = {}
        if len(self.pieces):
            for last, (size, places) in self.pieces.iter(text):
                for n, at in places:
                    starts.setdefault(n, set()).add(last + 1 - size - at)
        found = {}
        for n, places in starts.items():
            key, item, k = self.items[n]
            best, left = (k + 1, 0), None
            for start in sorted(places) + [None]:
                if left is not None and (start is None or start > right):  # hits no further apart than k share a window
                    a, b = max(0, left - k), right + len(item) + k
                    got, end = edit_search(item, text[a:b])
                    best = min(best, (got, a + end))
                    left = None
                if left is None:
                    left = start
                right = start + k if start is not None else 0
            name = (key, item if key is None else "")
            if best[0] <= k and (name not in found or best < found[name]):
                found[name] = best
        return found


def item_index(part: list[tuple[int, str]], rate: float) -> ItemIndex:
    return per_worker("items", (part, rate), lambda: ItemIndex(part, rate))


def item_blocks(items: DataFrame, id_col: str, text_col: str, min_words: int, block: int) -> list[list[tuple[int, str]]]:
    """The usable items in blocks of about ``block``, each of which one task
    can hold."""
    known = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")) \
        .where("text IS NOT NULL").distinct()
    n = max(1, -(-known.count() // block))
    out = []
    for i in range(n):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text").collect()
        texts = [(r["item_id"], normalized(r["text"])) for r in rows]
        out.append([(key, t) for key, t in texts if t.count(" ") + 1 >= min_words])
    return [b for b in out if b]


def matches(docs: DataFrame, items: DataFrame, rate: float = RATE, min_words: int = MIN_WORDS,
            block: int = ITEM_BLOCK, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, end_word): each item that a document holds,
    with its least distance and the number of words up to its end."""
    spark = docs.sparkSession
    text_batches(spark)
    schema = "doc_id long, item_id long, distance int, end_word long"
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    out = None
    for part in item_blocks(items, item_col, text_col, min_words, block):
        def run(batches: Iterator[pd.DataFrame], part=part) -> Iterator[pd.DataFrame]:
            index = item_index(part, rate)
            for b in batches:
                got = []
                for doc_id, text in zip(b["doc_id"], b["text"]):
                    text = normalized(text)
                    got += [(doc_id, key, d, text[:end].count(" ") + 1) for (key, _), (d, end) in index.find(text).items()]
                columns = dict(zip(("doc_id", "item_id", "distance", "end_word"), zip(*got)))
                yield from frames(columns | {"item_id": pd.array(columns["item_id"], "Int64")} if got else {})

        found = rows.mapInPandas(run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def holds_item(text: Column, part: list[tuple[int, str]], rate: float = RATE) -> Column:
    """Whether a text holds an item of one block."""
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = item_index(part, rate)
        for texts in batches:
            yield texts.map(lambda t: bool(index.find(normalized(t)))).astype(bool)

    return holds(text)


def without_items(docs: DataFrame, items: DataFrame, rate: float = RATE, min_words: int = MIN_WORDS,
                  block: int = ITEM_BLOCK) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no item."""
    text_batches(docs.sparkSession)
    for part in item_blocks(items, "item_id", "text", min_words, block):
        docs = docs.where(~holds_item(F.col("text"), part, rate))
    return docs
