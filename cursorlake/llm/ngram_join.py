"""Exact Jaccard join of documents on their word n-grams, with signature trees.

A document's set holds its distinct four-word shingles (words split at ASCII white
space, A-Z lower-cased); with fewer words the whole sequence is one. Two documents
link if 100 |A and B| >= 85 |A or B|; components are those of the links.

1. Equal sets are one node. Shingles are ordered by a counter, then by hash: every
   shingle of every document is counted into one of ``COUNTERS`` counters (a fixed
   size whatever the corpus), so shared passages come last.
2. Linked sets share a shingle among the first n - ceil(0.92 n) + 1 of the smaller
   and the first n - ceil(0.85 n) + 1 of the larger one. These shingles are the keys
   of blocks, and a key that only one node holds is dropped.
3. In a block the nodes are the leaves of a signature tree. An inner node holds the
   OR of its children's token bitmaps, their range of sizes and the most tokens that
   share bits with others. Two nodes can have in common at most the set bits of both
   bitmaps plus the smaller number of such tokens; a pair of nodes that cannot reach
   the least overlap its sizes ask for, or whose sizes are too far apart, is cut. Both
   trees are walked down at once, level by level.
4. The pairs of leaves that are left are verified on the whole sets.

Many near copies would make as many pairs as their square. So first each bucket of
equal min-hashes is compared with one leader, and pairs within one component are cut
from the trees. A first walk returns, per leaf and foreign component, the likeliest
partner only; after those are verified and merged, a second one returns every pair
left between components. Nothing is lost: a pair is never verified only if its ends
are already connected. Blocks of more than ``TILE`` nodes are dealt into tiles, a
task for each pair of tiles; such a block costs rows in proportion to its nodes times
its tiles, and only where its key is still in several components.

Null and empty texts, and texts without words, have empty sets: linked with nothing,
their own id is their component. Rows without an id count as links; a component's id
is its smallest known one. Shingles are known by 64-bit hashes, sets by 63-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mix64, staged
from .graph import components
from .near_dup import row_key, runs
from .plain_words import PlainWords, windows

SHINGLE = 4
PERCENT = 85
COUNTERS = 1 << 18
BITS = 2048
HASHES, BAND = 24, 4
AGREE = 14
FAN = 4
TILE = 4096
GROUP_ROWS = 20_000
PAIRS_AT_ONCE = 1 << 16


class Sets:
    """The shingle sets of some texts, sorted: ``hash`` text by text; ``start``, one
    entry more than there are texts; ``text`` of each shingle."""

    def __init__(self, texts: pa.Array):
        plain = PlainWords(texts, lower=True)
        words, begin = plain.hash[plain.number], plain.starts()
        rolled, sets = windows(words, SHINGLE), []
        for a, n in zip(begin.tolist(), plain.size.tolist()):
            if n >= SHINGLE:
                sets.append(np.unique(rolled[a: a + n - SHINGLE + 1]))
            else:
                sets.append(mix64(windows(words[a: a + n], n) + np.uint64(n)) if n else words[:0])
        self.size = np.array([len(s) for s in sets], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.hash = np.concatenate([words[:0], *sets])
        self.text = np.repeat(np.arange(len(sets)), self.size)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.hash[self.start[i]: self.start[i + 1]]

    def nodes(self) -> np.ndarray:
        """A 63-bit hash of each set."""
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(self.hash ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)])
        whole = total[self.start[1:]] - total[self.start[:-1]] + self.size.astype(np.uint64)
        return (mix64(whole) >> np.uint64(1)).astype(np.int64)

    def bitmaps(self) -> np.ndarray:
        """One row of BITS bits per text, as bytes."""
        held = np.zeros(len(self.size) * BITS, bool)
        held[self.text * BITS + (self.hash >> np.uint64(17)).astype(np.int64) % BITS] = True
        return np.packbits(held.reshape(-1, BITS), axis=1)

    def min_hashes(self) -> np.ndarray:
        """HASHES least hashes of each non-empty set."""
        full = self.start[:-1][self.size > 0]
        if not len(full):
            return np.zeros((0, HASHES), np.int64)
        return np.stack([np.minimum.reduceat(mix64(self.hash + np.uint64(0xD6E8FEB86659FD93 * (j + 1) % (1 << 64))), full)
                         for j in range(HASHES)], 1).view(np.int64)

    def prefixes(self, counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, shingles) of each set's keys, rarest first."""
        keep = prefix(self.size, PERCENT, 100)
        order = np.lexsort((self.hash, counters[counter_of(self.hash)], self.text))
        place = np.arange(len(order)) - self.start[self.text]
        return keep, self.hash[order][place < keep[self.text]].view(np.int64)


def counter_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(46)).astype(np.int64) % COUNTERS


def prefix(n: np.ndarray, share: int, of: int) -> np.ndarray:
    """n - ceil(n * share / of) + 1, or 0 for an empty set."""
    return np.where(n > 0, n + (-n * share) // of + 1, 0)


def least_overlap(n: np.ndarray) -> np.ndarray:
    """The overlap that two linked sets of n shingles together have at least."""
    return -(-n * PERCENT // (100 + PERCENT))


def shingle_counters(docs: DataFrame) -> np.ndarray:
    """How many documents' shingles fall into each counter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for part in runs(b, "text"):
                total += np.bincount(counter_of(Sets(part.column("text")).hash), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    got = docs.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(COUNTERS, np.int64)
    out[got["at"].to_numpy()] = got["n"].to_numpy()
    return out


def signatures(docs: DataFrame, counters: np.ndarray) -> DataFrame:
    """(doc_id, key, n, node, keys, hashes, bits) per row; those after n are null for
    an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in runs(b, "text"):
                s = Sets(part.column("text"))
                none = pa.array(s.size == 0)
                n_keys, keys = s.prefixes(counters)
                hashes = np.concatenate([[0], np.cumsum(HASHES * (s.size > 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("key"), pa.array(s.size), pa.array(s.nodes(), mask=s.size == 0),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_keys)]).astype(np.int32)), pa.array(keys), mask=none),
                    pa.ListArray.from_arrays(pa.array(hashes), pa.array(s.min_hashes().ravel()), mask=none),
                    pa.array([x.tobytes() for x in s.bitmaps()], pa.binary(), mask=s.size == 0)],
                    ["doc_id", "key", "n", "node", "keys", "hashes", "bits"])

    return docs.mapInArrow(run, "doc_id long, key string, n long, node long, keys array<long>, hashes array<long>, bits binary")


def leader_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): each node of a bucket of equal min-hashes with the bucket's leader, the
    one that meets most nodes in its buckets (the original among its near copies), if
    enough of their min-hashes agree."""
    bands = F.array(*(F.xxhash64(F.lit(j), *(F.get("hashes", F.lit(j * BAND + k)) for k in range(BAND))) for j in range(HASHES // BAND)))
    entries = nodes.select("node", F.explode(bands).alias("bucket"))
    shared = staged(entries.join(entries.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1"), "bucket"), "ngram-buckets")
    met = shared.groupBy("node").agg(F.sum("c").alias("met"))
    lead = shared.join(met, "node").groupBy("bucket").agg(F.expr("min_by(node, struct(-met, node))").alias("lead"))
    pairs = shared.join(lead, "bucket").where("node <> lead") \
        .select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
    side = nodes.select("node", "n", "hashes")
    both = pairs.join(side.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("x")), "a") \
        .join(side.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("y")), "b")
    same = F.size(F.filter(F.zip_with("x", "y", lambda p, q: p == q), lambda e: e))
    return both.where((same >= AGREE) & (100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))).select("a", "b")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, linked) for each pair of nodes, from their whole texts."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "key"), "node")
    texts = staged(docs.select("key", "text").join(wanted, "key").dropDuplicates(["key"]).select("node", "text"), "ngram-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in runs(b, "y"):
                _, first, of = np.unique(part.column("a").to_numpy(), return_index=True, return_inverse=True)
                left, right = Sets(part.column("x").take(pa.array(first))), Sets(part.column("y"))
                linked = []
                for j, i in enumerate(of.tolist()):
                    p, q = left[i], right[j]
                    common = len(np.intersect1d(p, q, assume_unique=True))
                    linked.append(100 * common >= PERCENT * (len(p) + len(q) - common))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b") \
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    return staged(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean"), "ngram-verified")


def with_parts(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with ``part``, the component that each belongs to so far."""
    return nodes.join(components(links), "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root")


def block_entries(nodes: DataFrame) -> DataFrame:
    """(key, node, early, tile, tiles) for the keys that several components hold;
    early: the key is one of the first that count for the smaller of two sets."""
    early = F.expr("n - ceil(n * 2 * {0} / (100 + {0})) + 1".format(PERCENT))
    entries = nodes.select("node", "part", F.posexplode("keys").alias("place", "key"), early.alias("first")) \
        .select("key", "node", "part", (F.col("place") < F.col("first")).alias("early"))
    shared = staged(entries.groupBy("key").agg(F.count("*").alias("c"), F.min("part").alias("low"), F.max("part").alias("high"),
                                               F.max("early").alias("e")).where("low <> high AND e").select("key", "c"), "ngram-keys")
    tiles = F.when(F.col("c") > TILE, F.ceil(F.col("c") / (TILE // 2))).otherwise(1).cast("int")
    return entries.join(shared, "key").select("key", "node", "early", tiles.alias("tiles")) \
        .withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))


def still_open(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """The entries of the keys that several components hold."""
    keys = entries.join(parts.select("node", "part"), "node").groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    return entries.join(keys.where("low <> high").select("key"), "key", "left_semi")


class Tree:
    """Signature trees of several blocks, one tree a block, of the same height: the
    leaves are given sorted by block; every level groups FAN neighbours of a block."""

    def __init__(self, block: np.ndarray, n: np.ndarray, bits: np.ndarray, early: np.ndarray, part: np.ndarray):
        extra = n - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.levels = [dict(bits=bits, low=n, high=n, extra=extra, early=early, part=part)]
        self.first: list[np.ndarray] = [np.zeros(0, np.int64)]  # of each node its first child, and the end
        while len(block) and (block[1:] == block[:-1]).any():
            below, new = self.levels[-1], np.append(True, block[1:] != block[:-1])
            begin = np.flatnonzero(new)
            place = np.arange(len(block)) - np.repeat(begin, np.diff(np.append(begin, len(block))))
            first = np.flatnonzero(place % FAN == 0)
            low, high = np.minimum.reduceat(below["part"], first), np.maximum.reduceat(below["part"], first)
            self.levels.append(dict(
                bits=np.bitwise_or.reduceat(below["bits"], first, axis=0), low=np.minimum.reduceat(below["low"], first),
                high=np.maximum.reduceat(below["high"], first), extra=np.maximum.reduceat(below["extra"], first),
                early=np.logical_or.reduceat(below["early"], first), part=np.where(low == high, low, -1)))
            self.first.append(np.append(first, len(block)))
            block = block[first]
        self.roots = np.arange(len(block))

    def reachable(self, level: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs of nodes may hold a link between components, and the greatest
        overlap that each may have."""
        at = self.levels[level]
        keep = ((at["part"][x] != at["part"][y]) | (at["part"][x] < 0)) & (at["early"][x] | at["early"][y])
        keep &= 100 * np.minimum(at["high"][x], at["high"][y]) >= PERCENT * np.maximum(at["low"][x], at["low"][y])
        most = np.zeros(len(x), np.int64)
        i = np.flatnonzero(keep)
        shared = np.bitwise_count(at["bits"][x[i]] & at["bits"][y[i]]).sum(1).astype(np.int64)
        most[i] = np.minimum(shared + np.minimum(at["extra"][x[i]], at["extra"][y[i]]), np.minimum(at["high"][x[i]], at["high"][y[i]]))
        return keep & (most >= least_overlap(at["low"][x] + at["low"][y])), most

    def children(self, level: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of children of pairs of nodes; of a node with itself each pair once,
        and leaves not with themselves."""
        first = self.first[level]
        step = np.arange(FAN)
        p, q = (np.broadcast_to(v, (len(x), FAN, FAN)) for v in (first[x][:, None, None] + step[None, :, None],
                                                               first[y][:, None, None] + step[None, None, :]))
        keep = (p < first[x + 1][:, None, None]) & (q < first[y + 1][:, None, None])
        keep &= (x != y)[:, None, None] | ((p < q) if level == 1 else (p <= q))
        return p[keep], q[keep]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(x, y, greatest overlap) of the pairs of leaves that no level cut."""
        top = len(self.levels) - 1
        todo = [(top, self.roots, self.roots)] if top else []
        while todo:
            level, x, y = todo.pop()
            if len(x) > PAIRS_AT_ONCE:
                todo += [(level, x[k: k + PAIRS_AT_ONCE], y[k: k + PAIRS_AT_ONCE]) for k in range(0, len(x), PAIRS_AT_ONCE)]
                continue
            keep, most = self.reachable(level, x, y)
            x, y, most = x[keep], y[keep], most[keep]
            if level and len(x):
                todo.append((level - 1, *self.children(level, x, y)))
            elif len(x):
                yield x, y, most


def likeliest(x: np.ndarray, y: np.ndarray, part: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kept, more): which pairs are the best of their end in the smaller component
    with the other component, and whether that end has others there."""
    size = np.bincount(np.unique(part, return_inverse=True)[1])[np.unique(part, return_inverse=True)[1]]
    swap = (size[x] > size[y]) | ((size[x] == size[y]) & (part[x] > part[y]))
    u, v = np.where(swap, y, x), np.where(swap, x, y)
    order = np.lexsort((v, -score, part[v], u))
    begin = np.flatnonzero(np.append(True, (u[order][1:] != u[order][:-1]) | (part[v[order]][1:] != part[v[order]][:-1]))[: len(order)])
    kept, more = np.zeros(len(x), bool), np.zeros(len(x), bool)
    kept[order[begin]] = True
    more[order[begin]] = np.diff(np.append(begin, len(order))) > 1
    return kept, more


def tree_pairs(entries: DataFrame, nodes: DataFrame, every: bool) -> DataFrame:
    """(a, b, more): the pairs of nodes of different components that the trees
    cannot rule out; unless ``every``, the likeliest ones only, and more tells
    whether others were left out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("more", pa.bool_())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        col = {c: rows.column(c).to_numpy() for c in ("key", "left", "right", "tile", "node", "n", "part")}
        order = np.lexsort((col["node"], col["n"], col["part"], col["right"], col["left"], col["key"]))
        col = {c: v[order] for c, v in col.items()}
        bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64).reshape(-1, BITS // 64)[order]
        early = rows.column("early").to_numpy(zero_copy_only=False)[order]
        edge = np.append(False, np.logical_or.reduce([col[c][1:] != col[c][:-1] for c in ("key", "left", "right")]))
        node, n, part, got = col["node"], col["n"], col["part"], [np.zeros((0, 3), np.int64)]
        for x, y, most in Tree(np.cumsum(edge), n, bits, early, part).pairs():
            least = np.where(n[x] < n[y], early[x], np.where(n[x] > n[y], early[y], early[x] & early[y]))
            keep = least & ((col["left"][x] == col["right"][x]) | (col["tile"][x] != col["tile"][y])) & (node[x] != node[y])
            got.append(np.stack([x, y, most], 1)[keep])
        x, y, most = np.concatenate(got).T
        kept, more = np.ones(len(x), bool), np.zeros(len(x), bool)
        if not every:
            whole = np.unique(node, return_inverse=True)[1]  # a node is one leaf in each of its blocks
            of_node = np.zeros(len(node), np.int64)
            of_node[whole] = part
            score = most / np.maximum(n[x] + n[y] - most, 1)
            kept, more = likeliest(whole[x], whole[y], of_node, score)
        a, b = np.minimum(node[x], node[y])[kept], np.maximum(node[x], node[y])[kept]
        return pa.Table.from_arrays([pa.array(a), pa.array(b), pa.array(more[kept])], schema=schema)

    groups = max(1, -(-entries.count() // GROUP_ROWS))
    dealt = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .withColumn("left", F.least("tile", "other")).withColumn("right", F.greatest("tile", "other")) \
        .withColumn("group", F.pmod(F.xxhash64("key", "left", "right"), F.lit(groups)))
    rows = dealt.join(nodes.select("node", "n", "part", "bits"), "node") \
        .select("group", "key", "left", "right", "tile", "node", "early", "n", "part", "bits")
    pairs = rows.groupBy("group").applyInArrow(run, "a long, b long, more boolean")
    return staged(pairs.groupBy("a", "b").agg(F.max("more").alias("more")), "ngram-pairs")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = staged(signatures(texts, shingle_counters(texts)), "ngram-rows")
    nodes = staged(rows.where("n > 0").groupBy("node").agg(
        F.min("key").alias("key"), *(F.first(c).alias(c) for c in ("n", "keys", "hashes", "bits"))), "ngram-nodes")
    known = verified(staged(leader_pairs(nodes), "ngram-leaders"), nodes, texts)
    links = known.where("linked").select("a", "b")
    parts = staged(with_parts(nodes.select("node", "n", "keys", "bits"), links), "ngram-parts")
    entries = staged(block_entries(parts), "ngram-entries")
    for every in (False, True):
        pairs = tree_pairs(entries, parts, every)
        known = known.union(verified(pairs.select("a", "b").join(known, ["a", "b"], "left_anti"), nodes, texts))
        links = known.where("linked").select("a", "b")
        if every or pairs.where("more").isEmpty():
            break
        parts = staged(with_parts(nodes.select("node", "n", "bits"), links), "ngram-parts")
        entries = staged(still_open(entries, parts), "ngram-entries")
    of = rows.select("doc_id", "n", "node").join(components(links), "node", "left") \
        .select("doc_id", "n", F.coalesce("root", "node").alias("root"))
    least = of.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return of.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
