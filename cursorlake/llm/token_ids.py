"""Token-id output: frequency-ranked ids in a byte-aligned variable-length code.

A folder holds ``ranks.u32`` (the token id of every rank, commonest first,
little-endian) and ``part-NNNNN.tid`` files in ascending document order. A part
is a run of blocks; a block holds whole documents:

    b"TIDB" | u32 documents | u64 ids | u64 data bytes
    i64 doc ids | u8 doc-id-is-null | u32 lengths | control bytes | data bytes

Every id is stored as its rank in 1 to 4 little-endian bytes. The lengths are
kept apart, two bits each, four to a control byte, so decoding is a table lookup
by control byte, a running sum and a gather.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import dealt_by_bytes, frames, lean, per_worker, release_memory, staged, text_batches, work_dir
from .files import AtomicFile, store

HEAD = "<4sIQQ"
BLOCK_IDS = 1 << 20
READ_BYTES = 8 << 20  # of blocks that one task reads back
CACHED_WORDS = 600_000
CACHED_CHARS = 64
SPECIAL = "<|"
END_MARKS = r"([a-z])([!-/:-@\[-`{-~]+)([ \n]|$)"
RUN_BYTES = 2 << 20
LOOKUP_BYTES = 8 << 20  # of texts whose words are looked up together
# length of each of the four values of a control byte
LENGTHS = 1 + ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3).astype(np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    ranks = np.asarray(ranks, "<u4")
    size = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    keep = np.arange(4) < size[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[keep].tobytes()
    quads = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    quads[: len(ranks)] = size - 1
    control = (quads.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(1).astype(np.uint8)
    return control.tobytes(), data


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """Inverse of :func:`encode_ranks` for ``n`` values."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    value = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        value[longer] |= raw[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return value


def cut(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Runs of about so many bytes at most, or single texts."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        n = max(1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, side="right")) - at)
        yield texts.slice(at, n)
        at += n


class WordEncoder:
    """Encodes whole texts by their distinct words, remembering frequent ones.

    Valid for tokenizers that lower-case, drop white space, part letters from
    everything else and mark the last piece of a word, as word_bpe_49k does: then
    no piece spans a space or line break, ASCII letters may be lower-cased before,
    and marks at the end of a word may stand apart. Texts that may hold special
    tokens, which are matched as they are written, keep their letters and marks.

    Word number i has the ids flat[start[i]: start[i] + size[i]]; number 0 is the
    empty word and number 1 stands for the end of a document.
    """

    def __init__(self, path: str, end_id: int, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.dtype = Tokenizer.from_file(path), np.dtype(dtype)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.flat, self.used = np.zeros(1 << 16, self.dtype), 0
        self.start, self.size = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)
        self.known = pa.array(["", " "])  # a space is in no word
        self._add(0, np.array([end_id], self.dtype), np.array([0, 1]))

    def _room(self, words: int, ids: int) -> None:
        """Let the tables hold so many words and ids."""
        if words > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * words), np.resize(self.size, 2 * words)
        if ids > len(self.flat):
            self.flat = np.resize(self.flat, 2 * ids)

    def _add(self, number: int, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Keep the ids of words from that number on; the next free number."""
        end = number + len(sizes)
        self._room(end, self.used + len(ids))
        self.start[number:end], self.size[number:end] = self.used + np.cumsum(sizes) - sizes, sizes
        self.flat[self.used: self.used + len(ids)] = ids
        self.used += len(ids)
        return end

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Numbers of distinct new words. Plain ones go in runs of one call each, split
        again at the pieces that end a word; all others one by one."""
        words = new.to_pylist()
        plain = np.fromiter((w.isalpha() and len(w) <= CACHED_CHARS for w in words), bool, len(words))
        places, at = np.flatnonzero(plain), len(self.known)
        order = []
        for a in range(0, len(places), 4096):
            part = places[a: a + 4096]
            text = " ".join([words[i] for i in part])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                at = self._add(at, ids, np.diff(stops, prepend=0))
                order.append(part)
            else:
                plain[part] = False
        places = np.flatnonzero(~plain)
        found = [e.ids for e in self.tokenizer.encode_batch_fast([words[i] for i in places], add_special_tokens=False)]
        self._add(at, np.array(list(chain.from_iterable(found)), self.dtype), np.array([len(x) for x in found], np.int64))
        order = np.concatenate([*order, places])
        number = np.empty(len(words), np.int64)
        number[order] = len(self.known) + np.arange(len(words))
        self.known = pa.concat_arrays([self.known, new.take(pa.array(order))])
        return number

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Word numbers of distinct words; new ones are learnt."""
        number = pc.index_in(words, value_set=self.known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self._learn(words.take(pa.array(new)))
        return number

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of a row of word numbers."""
        size = self.size[numbers]
        shift = self.start[numbers] - (np.cumsum(size, dtype=np.int64) - size)
        at = np.repeat(shift, size)
        at += np.arange(len(at))
        return self.flat[at]

    def _forget(self) -> None:
        """Keep the words seen first, which are the frequent ones."""
        if len(self.known) > CACHED_WORDS or self.used > 8 * CACHED_WORDS:
            n = min(len(self.known), CACHED_WORDS) // 2
            self.known = pa.concat_arrays([self.known.slice(0, n)])
            self.used = int((self.start[:n] + self.size[:n]).max(initial=0))

    def _lists(self, texts: pa.Array) -> pa.Array:
        """The words of every text."""
        if not pc.any(pc.match_substring(texts, SPECIAL)).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), END_MARKS, r"\1 \2\3")
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")

    def runs(self, texts: pa.Array) -> Iterator[pa.Array]:
        """Packed ids of every text, the end id included, in arrays of few bytes. Words
        are told apart and looked up once for several of these."""
        for several in cut(texts, LOOKUP_BYTES):
            self._forget()
            lists = [self._lists(x) for x in cut(several, RUN_BYTES)]
            words = pa.chunked_array([x.flatten() for x in lists]).dictionary_encode().unify_dictionaries()
            numbers = self._numbers(words.chunk(0).dictionary)
            for x, w in zip(lists, words.chunks):
                number, stops = numbers[w.indices.to_numpy()], x.offsets.to_numpy()
                number = np.insert(number, stops[1:] - stops[0], 1)
                out = self._gather(number)
                n_words = np.diff(stops)
                per_doc = np.add.reduceat(self.size[number], np.cumsum(n_words + 1) - n_words - 1, dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(per_doc)]) * self.dtype.itemsize
                yield pa.Array.from_buffers(pa.binary(), len(per_doc),
                                            [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(out)])

    def __call__(self, texts: pa.Array) -> pa.Array:
        """Packed ids of every text, the end id included."""
        return pa.concat_arrays(self.runs(texts)) if len(texts) else pa.array([], pa.binary())


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, dtype: str = "<u4",
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids): the ids of the whole text and ``end_id``, packed as
    ``dtype``. A null text counts as empty and gives the end id only."""
    key = (tokenizer_path, end_id, dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_worker("tokenizer", key, lambda: WordEncoder(*key))
        for b in batches:
            at = 0
            for ids in encode.runs(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(ids)), ids], ["doc_id", "ids"])
                at += len(ids)
            release_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def id_counts(tokens: DataFrame, vocabulary: int, dtype: str) -> np.ndarray:
    """Occurrences of every id over all rows. Each task sends at most one row
    per id of the vocabulary."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(vocabulary, np.int64)
        for b in lean(batches):
            total += np.bincount(np.frombuffer(b"".join(b["ids"]), dtype), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield from frames({"id": used, "n": total[used]})

    got = tokens.select("ids").mapInPandas(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(vocabulary, np.int64)
    counts[got["id"].to_numpy(int)] = got["n"]
    return counts


def write(tokens: DataFrame, folder: str, vocabulary: int, dtype: str) -> DataFrame:
    """Write the files; returns one row (part, block, place, size, n_ids) per block.

    Parts are ranges of doc_id, so the files in name order hold the documents in
    ascending order (nulls first, equal ids by their content).
    """
    counts = id_counts(tokens, vocabulary, dtype)
    by_rank = np.lexsort((np.arange(vocabulary), -counts)).astype("<u4")
    rank_of = np.empty(vocabulary, np.uint32)
    rank_of[by_rank] = np.arange(vocabulary, dtype=np.uint32)
    table = AtomicFile(folder, "ranks.u32")
    table.write(by_rank.tobytes())
    table.close()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        file, rows, held, n = None, [], [], 0

        def flush():
            nonlocal held, n
            ids = np.frombuffer(b"".join(x for _, x in held), dtype)
            control, data = encode_ranks(rank_of[ids])
            keys = [(0 if pd.isna(k) else int(k), pd.isna(k)) for k, _ in held]
            lengths = np.array([len(x) for _, x in held], np.int64) // np.dtype(dtype).itemsize
            block = b"".join((struct.pack(HEAD, b"TIDB", len(held), len(ids), len(data)),
                              np.array([k for k, _ in keys], "<i8").tobytes(),
                              np.array([e for _, e in keys], np.uint8).tobytes(),
                              lengths.astype("<u4").tobytes(), control, data))
            rows.append((part, len(rows), file.write(block), len(block), len(ids)))
            held, n = [], 0

        for b in lean(batches):
            for key, ids in zip(b["doc_id"].astype(object), b["ids"]):
                file = file or AtomicFile(folder, f"part-{part:05d}.tid")
                held.append((key, ids))
                n += len(ids) // np.dtype(dtype).itemsize
                if n >= BLOCK_IDS:
                    flush()
        if held:
            flush()
        if file:
            file.close()
        yield from frames(dict(zip(("part", "block", "place", "size", "n_ids"), zip(*rows))) if rows else {})

    ordered = tokens.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie") \
        .sortWithinPartitions("doc_id", "tie", "ids").select("doc_id", "ids")
    return staged(ordered.mapInPandas(run, "part int, block int, place long, size long, n_ids long"), "tid-index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """Documents of the written files: (doc_id, start, ids as packed u32).

    ``start`` counts the ids of all documents before it: a running sum over the
    few rows of the files, then over the blocks within each file.
    """
    files = index.groupBy("part").agg(F.sum("n_ids").alias("file_ids"))
    files = files.withColumn("file_start", F.sum("file_ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    blocks = index.join(files, "part").withColumn("start", F.coalesce("file_start", F.lit(0)) + F.coalesce(
        F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = store(folder)
        with fs.open_input_stream(f"{root}/ranks.u32") as f:
            by_rank = np.frombuffer(f.read(), "<u4")
        for b in lean(batches):
            for part, place, size, start in zip(b["part"], b["place"], b["size"], b["start"]):
                with fs.open_input_file(f"{root}/part-{part:05d}.tid") as f:
                    raw = f.read_at(int(size), int(place))
                magic, docs, n, data = struct.unpack_from(HEAD, raw)
                assert magic == b"TIDB", "not a block of a token-id file"
                at = struct.calcsize(HEAD)
                keys = np.frombuffer(raw, "<i8", docs, at)
                empty = np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
                lengths = np.frombuffer(raw, "<u4", docs, at + 9 * docs).astype(np.int64)
                at += 13 * docs
                ids = by_rank[decode_ranks(raw[at: len(raw) - data], raw[len(raw) - data:], n)]
                ends = np.cumsum(lengths)
                doc_id = pd.Series(keys).astype("Int64").mask(pd.Series(empty == 1))
                yield from frames({"doc_id": doc_id, "start": int(start) + ends - lengths,
                                   "ids": [ids[e - k: e].tobytes() for e, k in zip(ends, lengths)]})

    rows = dealt_by_bytes(blocks.select("part", "place", "size", "start"), "size", READ_BYTES, "part", "place")
    return rows.mapInPandas(run, "doc_id long, start long, ids binary")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Tokenize, write the files and return their documents, read back, and the
    folder. An empty table writes no part and gives no rows."""
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    text_batches(spark, 4096)
    vocabulary = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1)
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    folder = folder or work_dir(spark, "tid")
    tokens = staged(tokenize(docs, tokenizer_path, end_id, dtype, id_col, text_col), "tid-raw")
    return read(write(tokens, folder, vocabulary, dtype), folder), folder


def digests(documents: DataFrame) -> DataFrame:
    """Per document of :func:`read`: doc_id, start, n_tokens, ids_crc32."""
    return documents.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                            F.crc32("ids").alias("ids_crc32"))


