"""Near-duplicates: consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of five-word shingles (words lower-cased, marks
dropped). A shingle weighs its count in the text times the sum of its words'
inverse document frequencies. Two texts are linked if their weighted Jaccard
similarity is at least 0.8; classes are the connected components of the links.

* Document frequencies are counted over all documents. Only words in at least
  ``COMMON`` of them are sent to the tasks (at most mean distinct words / COMMON
  of them); all rarer words share the weight of that bound. Counting shingles
  themselves would shuffle every shingle of the corpus twice.
* Improved consistent weighted sampling draws 30 samples (shingle, level) per
  text. Two texts agree in a sample with the probability of their weighted
  Jaccard similarity. Ten bands of three samples make the buckets: texts of
  similarity 0.8 meet with probability 0.9992.
* Equal texts are one node of the graph, so copies cost one row each. In a bucket
  of up to ``SMALL`` texts all pairs are compared. In a larger one every text is
  first compared with the leader, the one that shares the most buckets with others
  (the original among its near copies). Then all pairs of different classes in it
  are compared: its texts outside the largest class with all its texts, in blocks
  as large as a task can hold (about ``BLOCK_TEXTS`` texts, ``BLOCK_BYTES`` of text). A
  task holds two blocks and returns only links between classes that it has not joined
  yet, so no row stands for a pair; a bucket costs a row per text and block, and only if
  it is still in several classes.
* Candidate pairs that agree in fewer than half of the samples are put aside (a
  pair of similarity 0.8 does with probability 0.0001); the others are verified on
  their whole texts.

A text of one to four words is a single shingle and so only matches its copies. A
text without words (or null) is a class of its own. Words are known by 64-bit hashes
of their bytes, nodes by 63-bit hashes of their word sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import lean, mix64, release_memory, staged, text_batches
from .graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 10, 3
COMMON = 0.002
SMALL = 8
ESTIMATE = 0.5
BLOCK_TEXTS = 2048
BLOCK_BYTES = 16 << 20
RUN_BYTES = 2 << 20
BLOCK = 1 << 16
NO_WORDS = r"[^\p{L}\p{N}]+"
PLACES = 64


def _tabulation() -> np.ndarray:
    """A fixed random number for each place in a word and byte."""
    at = np.arange(PLACES * 256, dtype=np.uint64) + np.uint64(1)
    return mix64(mix64(at * np.uint64(0x9E3779B97F4A7C15))).reshape(PLACES, 256)


class Words:
    """The words of an array of texts: ``number`` of each occurrence, text by
    text; ``size`` occurrences per text; ``hash`` per number."""

    table = _tabulation()

    def __init__(self, texts: pa.Array):
        plain = pc.replace_substring_regex(pc.utf8_lower(texts), NO_WORDS, " ")
        lists = pc.split_pattern(pc.ascii_trim(plain, " "), " ")
        words = lists.flatten().dictionary_encode()
        number, size = words.indices.to_numpy(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
        length = pc.binary_length(words.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        void = length[number] == 0  # a text without words is split into one empty one
        self.size = size - np.bincount(np.repeat(np.arange(len(size)), size)[void], minlength=len(size))
        self.number = number[~void]
        self.hash = self._hashed(words.dictionary, length)

    def _hashed(self, words: pa.Array, length: np.ndarray) -> np.ndarray:
        """64-bit tabulation hash of each word's bytes."""
        if not len(words):
            return np.zeros(0, np.uint64)
        raw = np.frombuffer(pc.binary_join(pa.array([words.cast(pa.binary()).to_pylist()]), b"")[0].as_py(), np.uint8) \
            if words.offset else np.frombuffer(words.buffers()[2] or b"", np.uint8)[: int(length.sum())]
        start = np.cumsum(length) - length
        place = np.arange(len(raw)) - np.repeat(start, length)
        value = self.table[place % PLACES, raw] * (2 * (place // PLACES) + 1).astype(np.uint64)
        total = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
        return mix64(total[start + length] - total[start] + length.astype(np.uint64))

    def text_of(self) -> np.ndarray:
        """Index of the text of each occurrence."""
        return np.repeat(np.arange(len(self.size)), self.size)


def runs(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with bounded text, or single long texts."""
    size = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(size, (size[at - 1] if at else 0) + RUN_BYTES, side="right")) - at)
        yield batch.slice(at, n)
        at += n


class Weights:
    """Inverse document frequencies: by word hash for the common words, one for
    all others."""

    def __init__(self, common: np.ndarray, idf: np.ndarray, rare: float):
        order = np.argsort(common)
        self.common, self.idf, self.rare = common[order], idf[order], rare

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return np.full(len(hashes), self.rare)
        at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
        return np.where(self.common[at] == hashes, self.idf[at], self.rare)

    def shingles(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, shingle hashes, weights): the distinct shingles of every
        text, sorted; starts has one more entry than there are texts."""
        h, w = words.hash[words.number], self.of(words.hash)[words.number]
        begin = np.concatenate([[0], np.cumsum(words.size)])
        out_h, out_w = [np.zeros(0, np.uint64)], [np.zeros(0)]
        if len(h) >= SHINGLE:
            rolled = mix64(sum(np.roll(h, -j) * np.uint64(0x9E3779B97F4A7C15 ** (j + 1) % (1 << 64)) for j in range(SHINGLE)))
            weight = sum(np.roll(w, -j) for j in range(SHINGLE))
        sizes = []
        for a, n in zip(begin.tolist(), words.size.tolist()):
            if n >= SHINGLE:
                s, first, count = np.unique(rolled[a: a + n - SHINGLE + 1], return_index=True, return_counts=True)
                out_h.append(s)
                out_w.append(weight[a + first] * count)
            elif n:
                few = h[a: a + n] * np.array([0xC2B2AE3D27D4EB4F ** (j + 1) % (1 << 64) for j in range(n)], np.uint64)
                out_h.append(mix64(few.sum(keepdims=True) + np.uint64(n)))
                out_w.append(w[a: a + n].sum(keepdims=True))
            sizes.append(len(out_h[-1]) if n else 0)
        return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), np.concatenate(out_h), np.concatenate(out_w)


def nodes_of(words: Words) -> np.ndarray:
    """A 63-bit hash of each text's word sequence."""
    begin = np.cumsum(words.size) - words.size
    place = np.arange(len(words.number)) - np.repeat(begin, words.size)
    value = mix64(words.hash[words.number] + (place + 1).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    total = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
    return (mix64(total[begin + words.size] - total[begin] + words.size.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)


def _quantiles() -> tuple[np.ndarray, np.ndarray]:
    """65,536 quantiles of the Gamma(2, 1) law, and their logarithms."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.sqrt(2 * p) + p  # 1 - (1 + x) exp(-x) = p, by Newton steps
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-12), 1e-6)
    return x.astype(np.float32), np.log(x).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling: r and c are Gamma(2, 1), beta is
    uniform, all read from one hash of (shingle, sample number)."""

    def __init__(self, samples: int):
        self.samples, (self.gamma, self.log_gamma) = samples, _quantiles()

    def __call__(self, starts: np.ndarray, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One row of sample hashes per non-empty text (starts as in
        Weights.shingles, without empty texts)."""
        out = np.empty((len(starts) - 1, self.samples), np.uint32)
        first = 0
        while first < len(starts) - 1:  # runs of texts that fit the processor's cache
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + BLOCK, side="right")) - 1)
            a, b = starts[first], starts[last]
            at, s, log_w = starts[first:last] - a, shingles[a:b], np.log(weights[a:b]).astype(np.float32)
            size = np.diff(starts[first: last + 1])
            for j in range(self.samples):
                bits = mix64(s + np.uint64(0xD6E8FEB86659FD93 * (j + 1) % (1 << 64)))
                r = self.gamma[bits & np.uint64(0xFFFF)]
                beta = ((bits >> np.uint64(32)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(1 / (1 << 24))
                t = np.floor(log_w / r + beta)
                log_a = self.log_gamma[(bits >> np.uint64(16)) & np.uint64(0xFFFF)] - r * (t - beta + 1)
                low = np.minimum.reduceat(log_a, at)
                hit = np.flatnonzero(log_a == np.repeat(low, size))
                hit = hit[np.searchsorted(hit, at)]  # the first of equal ones
                level = t[hit].astype(np.int64).astype(np.uint64)
                out[first:last, j] = mix64(s[hit] + level * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            first = last
        return out


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key per text and band."""
    parts = samples.reshape(-1, bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0xA0761D6478BD642F) + np.zeros((len(parts), 1), np.uint64)
    for k in range(rows):
        key = mix64(key ^ parts[:, :, k])
    return key.view(np.int64)


def word_weights(docs: DataFrame, text: Column, common: float = COMMON) -> Weights:
    """Inverse document frequencies of the common words, and that of the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in lean(batches):
            for part in runs(b, "text"):
                words = Words(part.column("text"))
                n = len(words.hash)
                seen = np.unique(words.text_of() * n + words.number) % max(n, 1)
                used, count = np.unique(seen, return_counts=True)
                held.append((words.hash[used].view(np.int64), count))
                if len(held) >= 8:
                    held = [_summed(held)]
        if held:
            word, count = _summed(held)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(count)], ["word", "n"])

    n = max(1, docs.count())
    counts = docs.select(text.alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    got = counts.where(F.col("n") >= common * n).toPandas()
    return Weights(got["word"].to_numpy(np.int64).view(np.uint64), np.log(1 + n / got["n"].to_numpy(float)),
                   float(np.log(1 + 1 / common)))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    word, at = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
    return word, np.bincount(at, np.concatenate([n for _, n in parts]), len(word)).astype(np.int64)


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by id and text, so that copies with ids of their own are
    apart; rows equal in both share a key."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")),
                       F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def signatures(docs: DataFrame, id_col: str, text_col: str, weights: Weights) -> DataFrame:
    """(doc_id, key, bytes, node, samples, bands) per row; node, samples and bands are
    null for texts without words."""
    def lists(full: np.ndarray, rows: np.ndarray, kind: pa.DataType) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(full * rows.shape[1])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind), mask=pa.array(~full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * ROWS)
        for b in lean(batches):
            for part in runs(b, "text"):
                words = Words(part.column("text"))
                full = words.size > 0
                starts, shingle, weight = weights.shingles(words)
                got = sampler(np.concatenate([starts[:-1][full], starts[-1:]]), shingle, weight)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pc.binary_length(part.column("text")).cast(pa.int64()),
                     pa.array(nodes_of(words), pa.int64(), mask=~full),
                     lists(full, got.view(np.int32), pa.int32()), lists(full, band_keys(got, BANDS, ROWS), pa.int64())],
                    ["doc_id", "key", "bytes", "node", "samples", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, key string, bytes long, node long, samples array<int>, bands array<long>")


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) whose samples agree often enough."""
    s = nodes.select("node", "samples")
    both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct() \
        .join(s.select(F.col("node").alias("a"), F.col("samples").alias("x")), "a") \
        .join(s.select(F.col("node").alias("b"), F.col("samples").alias("y")), "b")
    same = F.size(F.filter(F.zip_with("x", "y", lambda p, q: p == q), lambda e: e))
    return both.where(same >= ESTIMATE * BANDS * ROWS).select("a", "b")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two sorted (shingles, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - common
    return float(common / whole) if whole else 0.0


def bucket_texts(docs: DataFrame, nodes: DataFrame, buckets: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of every node that shares a bucket, staged: the documents
    are shuffled once, whatever the number of comparisons, and by a key that
    copies do not share."""
    wanted = buckets.select("node").distinct().join(nodes.select("node", "key"), "node")
    texts = docs.select(row_key(id_col, text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return staged(texts.join(wanted, "key").dropDuplicates(["key"]).select("node", "text"), "near-texts")


def verified(pairs: DataFrame, texts: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            for part in runs(b, "y"):
                a, first, of = np.unique(part.column("a").to_numpy(), return_index=True, return_inverse=True)
                left = weights.shingles(Words(part.column("x").take(pa.array(first))))
                right = weights.shingles(Words(part.column("y")))
                keep = [weighted_jaccard(_at(left, i), _at(right, j)) >= threshold for j, i in enumerate(of.tolist())]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b") \
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _at(sets: tuple[np.ndarray, np.ndarray, np.ndarray], i: int) -> tuple[np.ndarray, np.ndarray]:
    starts, shingle, weight = sets
    return shingle[starts[i]: starts[i + 1]], weight[starts[i]: starts[i + 1]]


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(key, node, n, degree) of every bucket of two texts or more; degree is the
    number of texts that the node meets over all its buckets."""
    entries = nodes.select("node", F.explode("bands").alias("key"))
    shared = entries.join(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
    shared = staged(shared, "near-entries")
    return shared.join(shared.groupBy("node").agg(F.sum("n").alias("degree")), "node")


def first_pairs(buckets: DataFrame) -> DataFrame:
    """Pairs of each bucket: all of a small one, else those with its leader."""
    large = buckets.where(F.col("n") > SMALL)
    leader = large.groupBy("key").agg(F.expr("min_by(node, struct(-degree, node))").alias("leader"))
    star = large.join(leader, "key").where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    few = buckets.where(F.col("n") <= SMALL).select("key", "node")
    rest = few.alias("l").join(few.alias("r"), F.expr("l.key = r.key AND l.node < r.node")) \
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    return star.union(rest)


def mixed_blocks(buckets: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, left, right, block, node, root) of the large buckets that hold
    several classes: each pair of blocks (left, right) with its texts. Blocks of
    the largest class come last and do not meet each other."""
    large = buckets.where(F.col("n") > SMALL).select("key", "node").join(roots, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    parts = large.join(sizes.select("node", "bytes"), "node").groupBy("key", "root").agg(
        F.count("*").alias("part"), F.sum("bytes").alias("bytes"))
    some = parts.groupBy("key").agg(F.sum("part").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("classes"),
                                    F.expr("max_by(struct(root, part, bytes), struct(part, -root))").alias("main"))

    def blocks(texts: Column, size: Column) -> Column:
        return F.greatest(F.ceil(texts / BLOCK_TEXTS), F.ceil(size / BLOCK_BYTES)).cast("int")

    some = some.where("classes > 1").select(
        "key", F.col("main.root").alias("main"),
        blocks(F.col("n") - F.col("main.part"), F.col("bytes") - F.col("main.bytes")).alias("few"),
        blocks(F.col("main.part"), F.col("main.bytes")).alias("many"))
    inside, dealt = F.col("root") == F.col("main"), F.xxhash64("node")
    rows = large.join(some, "key").select(
        "key", "node", "root",
        F.when(inside, F.col("few") + F.pmod(dealt, F.col("many"))).otherwise(F.pmod(dealt, F.col("few"))).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.when(inside, F.col("few") - 1).otherwise(F.col("few") + F.col("many") - 1))).alias("other"))
    return rows.select("key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "node", "root")


def _candidates(key: int, cross: bool, side: np.ndarray, root: np.ndarray, samples: np.ndarray, bands: np.ndarray) -> list[np.ndarray]:
    """Per text the later ones of other classes (``cross``: of the other block)
    that agree often enough and whose first common band is this bucket's."""
    out = []
    for i in range(len(root)):
        j = np.arange(i + 1, len(root))
        j = j[(root[j] != root[i]) & ((side[j] != side[i]) | (not cross))]
        j = j[(samples[j] == samples[i]).sum(1) >= ESTIMATE * BANDS * ROWS]
        out.append(j[bands[i][(bands[j] == bands[i]).argmax(1)] == key])
    return out


def block_links(blocks: DataFrame, nodes: DataFrame, texts: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) that join the classes of each pair of blocks: all its pairs of
    different classes are compared, but for those that a link found there has
    already put into one class."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        n, one = rows.num_rows, {c: rows.column(c)[0].as_py() for c in ("key", "left", "right")}
        node, root, side = (rows.column(c).to_numpy() for c in ("node", "root", "block"))
        samples, bands = (pc.list_flatten(rows.column(c)).to_numpy().reshape(n, -1) for c in ("samples", "bands"))
        later = _candidates(one["key"], one["left"] != one["right"], side, root, samples, bands)
        used = np.unique(np.concatenate([*later, [i for i in range(n) if len(later[i])]]).astype(np.int64))
        if not len(used):
            return schema.empty_table()
        starts, shingle, weight = weights.shingles(Words(rows.column("text").take(pa.array(used)).combine_chunks()))
        names, shingle = np.unique(shingle, return_inverse=True)
        whole, held, place = np.add.reduceat(weight, starts[:-1]), np.zeros(len(names)), np.full(n, -1)
        place[used] = np.arange(len(used))
        of = {int(r): int(r) for r in root}

        def find(r: int) -> int:
            while of[r] != r:
                r = of[r]
            return r

        found = []
        for i, js in enumerate(later):
            js = np.array([j for j in js.tolist() if find(int(root[j])) != find(int(root[i]))], np.int64)
            if not len(js):
                continue
            x, y = place[i], place[js]
            mine, size = slice(starts[x], starts[x + 1]), starts[y + 1] - starts[y]
            held[shingle[mine]] = weight[mine]
            first = np.cumsum(size) - size
            at = np.arange(size.sum()) + np.repeat(starts[y] - first, size)
            common = np.add.reduceat(np.minimum(held[shingle[at]], weight[at]), first)
            held[shingle[mine]] = 0
            for j in js[common >= threshold * (whole[x] + whole[y] - common)].tolist():
                p, q = find(int(root[i])), find(int(root[j]))
                if p != q:
                    of[max(p, q)] = min(p, q)
                    found.append((int(node[i]), int(node[j])))
        if rows.nbytes > RUN_BYTES:
            release_memory()
        return pa.Table.from_arrays([pa.array([min(f) for f in found], pa.int64()), pa.array([max(f) for f in found], pa.int64())],
                                    schema=schema)

    rows = blocks.join(nodes.select("node", "samples", "bands"), "node").join(texts, "node")
    return rows.groupBy("key", "left", "right").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, key, class_node) for every row of ``docs``: key is its row_key,
    class_node names the class (null: a text without words)."""
    text_batches(docs.sparkSession, 2048)
    weights = word_weights(docs, F.coalesce(F.col(text_col), F.lit("")))
    rows = staged(signatures(docs, id_col, text_col, weights), "near-rows")
    nodes = staged(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("samples").alias("samples"), F.first("bands").alias("bands"), F.min("key").alias("key"),
        F.max("bytes").alias("bytes")), "near-nodes")
    buckets = staged(shared_buckets(nodes), "near-buckets")
    texts = bucket_texts(docs, nodes, buckets, id_col, text_col)
    text_batches(docs.sparkSession, 256)
    pairs = staged(likely(first_pairs(buckets), nodes), "near-pairs")
    links = staged(verified(pairs, texts, weights, threshold), "near-links")
    roots = components(links)
    blocks = staged(mixed_blocks(buckets, roots, nodes), "near-blocks")
    more = staged(block_links(blocks, nodes, texts, weights, threshold), "near-links")
    if not more.isEmpty():
        roots = components(links.union(more))
    return rows.join(roots, "node", "left").select("doc_id", "key", F.coalesce("root", "node").alias("class_node"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) for every row: class_id is the smallest id of the class
    (a text without words: its own id)."""
    rows = staged(near_duplicates(docs, id_col, text_col, threshold), "near-classes")
    least = rows.where("class_node IS NOT NULL").groupBy("class_node").agg(F.min("doc_id").alias("class_id"))
    return rows.join(least, "class_node", "left").select("doc_id", F.when(
        F.col("class_node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row (all columns) of each class: that of the smallest id, null ids
    last. Of rows equal in id and text one stays; texts without words stay."""
    rows = staged(near_duplicates(docs, threshold=threshold), "near-classes")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("key"))
    best = rows.where("class_node IS NOT NULL").groupBy("class_node").agg(F.min(order).alias("o")).select(F.col("o.key"))
    alone = rows.where("class_node IS NULL").select("key")
    keyed = docs.withColumn("__key", row_key("doc_id", "text"))
    kept = best.union(alone).distinct().withColumnRenamed("key", "__key")
    return keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
