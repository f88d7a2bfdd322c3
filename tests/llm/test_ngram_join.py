"""The n-gram join against all pairs of sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cursorlake.llm import ngram_join
from cursorlake.llm.queries import QUERIES
from tests.conftest import SF_MID
from tests.llm.helpers import docs, odd_rows

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i: i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def by_hand(rows):
    """All pairs, by an inverted list; union-find over rows."""
    sets = [shingles(t) for _, t in rows]
    of, held = list(range(len(rows))), {}

    def find(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in held.setdefault(x, []):
                common[j] = common.get(j, 0) + 1
            held[x].append(i)
        for j, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                p, q = find(i), find(j)
                of[max(p, q)] = min(p, q)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(d, least.get(r, d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def got(spark, rows):
    table = docs(spark, [(d, t, None, None, None, 0.0, "w", 1) for d, t in rows])
    return sorted(map(tuple, ngram_join.jaccard_components(table).collect()), key=str)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        k = r.randrange(len(words) + 1)
        words[k: k + r.choice([0, 1])] = r.choice([[], [f"new{r.randrange(10**6)}"]])
    return words


def near_rows(seed):
    """Chains of edits, copies around 0.85, unrelated texts with one passage, sizes
    one apart and sets that repeat."""
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for family in range(8):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([3, 8, 40, 120, 300]))]
        now = base
        for _ in range(12):
            rows.append(" ".join(edited(r, base, r.randint(0, max(1, len(base) // 30)))))
            now = edited(r, now, max(1, len(base) // 60))
            rows.append((" " if r.random() < 0.3 else "\n").join(now).upper())
    for _ in range(40):
        own = [f"u{r.randrange(10**6)}" for _ in range(r.randint(1, 30))]
        rows.append(" ".join(own + passage + own[:3]))
    r.shuffle(rows)
    return [(r.choice([i, i, i, i + 1]), t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = near_rows(seed)
    assert got(spark, rows) == by_hand(rows)


def test_tiles_and_small_groups(spark, monkeypatch):
    """Blocks in many tiles, a tree a task; without leaders every link comes from the trees."""
    rows = near_rows(3)
    monkeypatch.setattr(ngram_join, "TILE", 4)
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 50)
    monkeypatch.setattr(ngram_join, "AGREE", 99)
    assert got(spark, rows) == by_hand(rows)


def test_query_equals_brute_force(spark):
    texts = [tuple(x) for x in spark.read.parquet(SF_MID + "/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op13_ngram_join"](spark, SF_MID)
    assert sorted(map(tuple, out.select("doc_id", "n_shingles", "component_id").collect()), key=str) == by_hand(texts)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint"] * 3


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(30, "One two"), (29, "one\ttwo "), (31, "one two three"), (None, "ONE two"),
                                                  (None, "only here"), (32, "a b c d"), (33, "a b c d a b c d"), (33, None)]
    assert got(spark, rows) == by_hand(rows)
    assert got(spark, []) == []


def test_tree_keeps_every_pair_that_links():
    """Pairs that the trees cut never link, whatever the blocks."""
    r = random.Random(4)
    for seed in range(5):
        texts = [t for _, t in near_rows(seed)]
        s = ngram_join.Sets(pa.array(texts))
        block = np.sort(np.array([r.randrange(3) for _ in texts]))
        bits = s.bitmaps().view(np.uint64)
        part = np.array([r.randrange(60) for _ in texts])
        tree = ngram_join.Tree(block, s.size, bits, np.ones(len(texts), bool), part)
        kept = {(int(a), int(b)) for x, y, _ in tree.pairs() for a, b in zip(x, y)}
        sets = [shingles(t) for t in texts]
        links = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if block[i] == block[j] and part[i] != part[j]
                 and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
        assert links <= kept and len(kept) < len(texts) ** 2 / 6
        # no subset of the tokens of two sets overlaps more than the bound says
        keep, most = tree.reachable(0, np.zeros(len(texts), int), np.arange(len(texts)))
        assert all(m >= len(sets[0] & sets[i]) for i, (k, m) in enumerate(zip(keep, most)) if k)
