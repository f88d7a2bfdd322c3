"""Alignment of two tokenizers' tokens by coalescing their byte intervals.

Text is encoded twice: a space and the text by a byte-level tokenizer (A), the text
by a sentence-piece model (B), which adds that space itself. Tokens are byte
intervals. All tokens of both sides are sorted by start, the running maximum of
their ends is taken, and a new group begins where a start reaches that maximum.
Within a group each A token meets the B tokens whose interval overlaps its own:
these are the links. Every link counts for its pair of ids, over the whole corpus.

A text that is null or empty, or one whose tokens' bytes are not a space and the
text on either side (a text holding U+2581, for example), has no tokens. Repeated
rows are separate rows and all count.

A task works on chunks of about ``CHUNK_BYTES`` of text (a longer text is a chunk by
itself) and writes one row a chunk: its documents' figures, its distinct id pairs
with their counts, and for every link, packed, the place of its pair among these. Counts of
pairs are summed before any shuffle; a chunk gets back the corpus-wide counts of
its own pairs only, so no group is larger than a chunk's pairs, however common a
pair or a text is.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import per_worker, staged

CHUNK_BYTES = 1 << 19
# fixed values: how a byte-level BPE splits text before merging
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# bytes that a byte-level vocabulary writes as themselves; the others follow from U+0100
AS_THEMSELVES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_of_char() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(AS_THEMSELVES)]
    return {chr(b): b for b in AS_THEMSELVES} | {chr(0x100 + n): b for n, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE tokenizer file: ids of texts, bytes of ids.

    Where the file is what the fast encoder does (ids in the order of the merges, the
    common split, no normalizer), that one encodes; else the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars, vocab = byte_of_char(), spec["model"]["vocab"]
        special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        plain = {bytes(chars[c] for c in token): i for token, i in vocab.items() if i not in special}
        self.bytes = [b""] * (max([*vocab.values(), *special]) + 1)
        for token, i in plain.items():
            self.bytes[i] = token
        for i, token in special.items():
            self.bytes[i] = token
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        step = spec["pre_tokenizer"] or {}
        usual = (spec["normalizer"] is None and step.get("type") == "ByteLevel" and step.get("use_regex", True)
                 and not step.get("add_prefix_space") and all(vocab.get(a + b) == 256 + n for n, (a, b) in enumerate(merges)))
        if usual:
            import tiktoken
            self.encode = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=plain, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer
            other = Tokenizer.from_file(path)
            other.encode_special_tokens = True
            self.encode = lambda text: other.encode(text, add_special_tokens=False).ids


class Pieces:
    """A sentence-piece model: ids of texts, bytes of ids."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = model.id_to_piece(list(range(model.get_piece_size())))
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]
        self.encode = model.encode


def groups(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Number of the group of each interval (any order); groups are numbered by
    start. Intervals of one group overlap, directly or through others."""
    if not len(start):
        return np.zeros(0, np.int64)
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    out = np.empty(len(start), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(start[order][1:] >= reach[:-1])])
    return out


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of all pairs of an A and a B interval that overlap, by i, then
    j. The intervals of one side are in order and do not overlap each other."""
    low = np.searchsorted(b_end, a_start, side="right")
    n = np.maximum(np.searchsorted(b_start, a_end, side="left") - low, 0)
    first = np.cumsum(n) - n
    return np.repeat(np.arange(len(n)), n), np.arange(n.sum()) + np.repeat(low - first, n)


@dataclass
class Aligned:
    """Some texts' tokens, text by text: ids, group numbers and links; a_from and the
    others say where each text's entries begin (one more than there are texts)."""
    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    a_from: np.ndarray
    b_from: np.ndarray
    link_from: np.ndarray


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.left, self.right = ByteLevel(a_path), Pieces(b_path)
        self.size = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.left, self.right)]
        self.names: list[str] = []  # ids with the mark that follows them in the text of the groups
        for side, inner, last in ((self.left, ",", "|"), (self.right, ",", ";")):
            for mark in (inner, last):
                self.names += [f"{i}{mark}" for i in range(len(side.bytes))]

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        if not text:
            return [], []
        whole = (" " + text).encode()
        a, b = self.left.encode(" " + text), self.right.encode(text)
        for side, ids in ((self.left, a), (self.right, b)):
            if b"".join([side.bytes[i] for i in ids]) != whole:
                return [], []
        return a, b

    def __call__(self, texts: list[str | None]) -> Aligned:
        """All texts on one line of bytes, one after the other: no interval crosses
        from text to text."""
        each = [self.tokens(t) for t in texts]
        ids, froms, starts, ends = [], [], [], []
        for s in (0, 1):
            flat = np.array([i for pair in each for i in pair[s]], np.int64)
            size = self.size[s][flat]
            ids.append(flat)
            froms.append(np.concatenate([[0], np.cumsum([len(pair[s]) for pair in each])]).astype(np.int64))
            ends.append(np.cumsum(size))
            starts.append(ends[s] - size)
        group = groups(np.concatenate(starts), np.concatenate(ends))
        i, j = overlaps(starts[0], ends[0], starts[1], ends[1])
        n = len(ids[0])
        return Aligned(*ids, group[:n], group[n:], i, j, *froms, np.searchsorted(i, froms[0]))

    def group_texts(self, x: Aligned) -> list[str]:
        """Per text its groups as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        n_a, n_b = len(self.left.bytes), len(self.right.bytes)
        last_a = np.append(x.a_group[1:] != x.a_group[:-1], True)[: len(x.a)]
        last_b = np.append(x.b_group[1:] != x.b_group[:-1], True)[: len(x.b)]
        name = np.concatenate([x.a + n_a * last_a, x.b + 2 * n_a + n_b * last_b])
        order = np.argsort(np.concatenate([2 * x.a_group, 2 * x.b_group + 1]), kind="stable")
        parts = [self.names[k] for k in name[order].tolist()]
        at = (x.a_from + x.b_from).tolist()
        return ["".join(parts[p:q])[:-1] for p, q in zip(at, at[1:])]


def aligner(paths: tuple[str, str]) -> Aligner:
    return per_worker("aligner", paths, lambda: Aligner(*paths))


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of about CHUNK_BYTES of text, or single longer texts."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        n = max(1, int(np.searchsorted(size, done + CHUNK_BYTES, side="right")) - at)
        yield batch.slice(at, n)
        at += n


def _lists(starts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values, kind))


def _rows(docs: DataFrame, text: Column | str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(text) if isinstance(text, str) else text).alias("text"))


def alignments(docs: DataFrame, a_path: str, b_path: str, text: Column | str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, a, b, a_group, b_group) per row of ``docs``: the token ids of both
    sides and the number of each token's group, from 0 in every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner((a_path, b_path))
        for b in batches:
            for part in chunks(b, "text"):
                x = made(part.column("text").to_pylist())
                first = np.append(x.a_group, 0)[x.a_from[:-1]] if len(x.a) else np.zeros(part.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), _lists(x.a_from, x.a, pa.int32()), _lists(x.b_from, x.b, pa.int32()),
                    _lists(x.a_from, x.a_group - np.repeat(first, np.diff(x.a_from)), pa.int32()),
                    _lists(x.b_from, x.b_group - np.repeat(first, np.diff(x.b_from)), pa.int32())],
                    ["doc_id", "a", "b", "a_group", "b_group"])

    return _rows(docs, text, id_col).mapInArrow(run, "doc_id long, a array<int>, b array<int>, a_group array<int>, b_group array<int>")


CHUNK = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
         "groups_sha256 array<string>, pair array<long>, pair_links array<long>, link binary")


def packed(places: np.ndarray) -> bytes:
    """Places below 2^16 in two bytes each, else in four; compressed."""
    wide = len(places) and places.max() > 0xFFFF
    raw = np.concatenate([[4 if wide else 2], places]).astype("<u4" if wide else "<u2").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<u4" if raw[0] == 4 else "<u2")[1:]


def chunk_rows(docs: DataFrame, a_path: str, b_path: str, text: Column | str, id_col: str) -> DataFrame:
    """One row a chunk (see the module's docstring). A pair is a's id times 2^32 plus
    b's; ``link`` gives each link's place in ``pair``, text by text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, number = aligner((a_path, b_path)), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in chunks(batch, "text"):
                x = made(part.column("text").to_pylist())
                pair, link, n = np.unique((x.a[x.link_a] << 32) + x.b[x.link_b], return_inverse=True, return_counts=True)
                ends = np.append(x.a_group[1:] != x.a_group[:-1], True)[: len(x.a)]  # last A token of each group
                n_groups = np.diff(np.concatenate([[0], np.cumsum(ends)])[x.a_from])
                sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in made.group_texts(x)]
                number += 1
                one = [pa.array([number]), *(pa.array([v.astype(np.int64)]) for v in (np.diff(x.a_from), np.diff(x.b_from), n_groups,
                       np.diff(x.link_from))), pa.array([sha], pa.list_(pa.string())),
                       *(pa.array([v], pa.list_(pa.int64())) for v in (pair, n)), pa.array([packed(link)], pa.binary())]
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("doc_id"))
                yield pa.RecordBatch.from_arrays([one[0], ids, *one[1:]], [f.split()[0] for f in CHUNK.split(", ")])

    return _rows(docs, text, id_col).mapInArrow(run, CHUNK)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, links, best) of every pair of ids that is linked: how many links of the
    corpus hold it, and whether that is the most of its B id (ties included)."""
    each = rows.select(F.inline(F.arrays_zip("pair", "pair_links")))
    counts = each.groupBy("pair").agg(F.sum("pair_links").alias("links"))
    most = F.max("links").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))))
    return counts.select("pair", "links", (F.col("links") == most).alias("best"))


def summaries(docs: DataFrame, a_path: str, b_path: str, text: Column | str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256 (of the groups' text; '' without tokens)."""
    rows = staged(chunk_rows(docs, a_path, b_path, text, id_col), "align-chunks")
    known = rows.select("chunk", F.posexplode("pair").alias("at", "pair")).join(pair_counts(rows), "pair")
    answer = known.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("at", "links", "best"))).alias("got"))
    figures = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].values for c in figures}
                link, got = unpacked(batch.column("link")[k].as_py()), batch.column("got")[k].values
                sums = []
                for name in ("best", "links"):
                    each = got.field(name).to_numpy(zero_copy_only=False).astype(np.int64)[link] if len(link) else np.zeros(0, np.int64)
                    sums.append(np.diff(np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(row["n_links"].to_numpy())])]))
                yield pa.RecordBatch.from_arrays([*(row[c] for c in figures), *(pa.array(s) for s in sums)], [*figures, "n_best", "count_sum"])

    whole = rows.select("chunk", "link", *figures).join(answer, "chunk", "left") \
        .select(*figures, "link", F.coalesce("got", F.array().cast("array<struct<at:int,links:bigint,best:boolean>>")).alias("got"))
    out = whole.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                "n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
