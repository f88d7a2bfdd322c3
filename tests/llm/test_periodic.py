"""Periodic runs against a quadratic search, and the query against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from cursorlake.llm import periodic
from cursorlake.llm.queries import QUERIES
from tests.conftest import SF_MID
from tests.llm.helpers import docs, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(words):
    """All (start, length, period): every period, every maximal stretch."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)  # the smallest period of a stretch comes first
            i = j + 1
    return sorted((s, k, q) for (s, k), q in out.items())


def collapsed_by_hand(words, runs):
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(r):
    kind = r.randrange(4)
    if kind == 0:
        return [r.choice("ab") for _ in range(r.randint(0, 60))]
    if kind == 1:  # powers of powers
        w = ["a"]
        for _ in range(r.randint(1, 4)):
            w = w * r.randint(1, 5) + [r.choice("abc") for _ in range(r.randint(0, 2))]
        return w[:400]
    if kind == 2:
        out = []
        while len(out) < 150:
            piece = [r.choice("abcde") for _ in range(r.randint(1, 30))]
            out += piece * r.randint(1, 6) + piece[: r.randint(0, len(piece))]
        return out
    piece = [r.choice("ab") for _ in range(r.randint(5, 70))]
    return piece * 4 + piece[: r.randint(0, 3)]


def test_runs_equal_brute_force():
    """Many texts in one slice: runs never cross texts, small periods inside large
    ones included."""
    r = random.Random(5)
    for _ in range(60):
        texts = [random_words(r) for _ in range(20)]
        plain, got, keep = periodic.runs_of(pa.array([" ".join(t) for t in texts]))
        joined = periodic.collapsed(plain, keep).to_pylist()
        for i, t in enumerate(texts):
            want = runs_by_hand(t)
            assert [tuple(x[1:]) for x in got.tolist() if x[0] == i] == want, t
            assert joined[i] == collapsed_by_hand(t, want)


def test_long_periods():
    for n, times in ((2500, 4), (1024, 5), (1025, 4), (4096, 4)):
        r = random.Random(n)
        piece = [str(r.randrange(50)) for _ in range(n)]
        words = ["x"] * 7 + piece * times + piece[: n // 3] + ["end"]
        _, got, _ = periodic.runs_of(pa.array([" ".join(words)]))
        assert [tuple(x[1:]) for x in got.tolist()][0] == (0, 7, 1)
        assert (7, times * n + n // 3, n) in [tuple(x[1:]) for x in got.tolist()]


def test_synchronising_set_is_locally_consistent():
    """Equal contexts are both in the set or both out of it."""
    r = np.random.default_rng(3)
    window = r.integers(0, 40, 3000).astype(np.uint64)
    for tau in (1, 2, 4, 16):
        inside = set(periodic.synchronising_set(window, tau).tolist())
        seen = {}
        for i in range(len(window) - tau):
            assert seen.setdefault(window[i: i + tau + 1].tobytes(), i in inside) == (i in inside)
        assert max(np.diff(sorted(inside))) <= tau  # no gap: every stretch of tau positions holds one


def planted_by_hand(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def row_by_hand(doc_id, text):
    words = planted_by_hand(doc_id, text)
    runs = runs_by_hand(words)
    best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if runs else (None, None, None)
    sha = [hashlib.sha256(s.encode()).hexdigest() for s in
           ("".join(f"{s},{k},{q}\n" for s, k, q in runs), collapsed_by_hand(words, runs))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def plain(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)


def test_query_equals_plain_python(spark):
    got = QUERIES["op11_periodic_runs"](spark, SF_MID).collect()
    texts = spark.read.parquet(SF_MID + "/documents.parquet").select("doc_id", "text").collect()
    short = {row_by_hand(*t) for t in texts if len(t.text or "") < 9000}  # the search by hand is quadratic
    assert set(plain(got)) >= short and len(short) > 900
    assert len(got) == len(texts) and sum(r.n_runs for r in got) > 50


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    rows = [] if empty else odd_rows() + [(9, "la " * 30 + "end", "en", "s0", 94, 0.5, "x", 1)] * 2 + [
        (14, prose(7, 5) + " a b c " * 40, None, None, None, None, None, None)]
    found = periodic.periodic_runs(docs(spark, rows))
    got = {(r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in found.collect()}
    want = set()
    for row in rows:
        words = WORD.findall(row[1] or "")
        runs = runs_by_hand(words) if len(words) < 5000 else []
        want.add((row[0], len(words), tuple(runs), collapsed_by_hand(words, runs)))
    assert got == want
    assert found.count() == len(rows)
    out = periodic.digests(found)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint"] * 6 + ["string"] * 2
    assert out.count() == len(rows)
