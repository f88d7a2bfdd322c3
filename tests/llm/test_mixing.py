"""Topics learnt from texts and targets of every source."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cursorlake.llm import mixing
from cursorlake.llm.mixing import Tempered
from cursorlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _planted(n=600):
    """Eight subjects in two languages that share no word."""
    r = np.random.default_rng(1)
    rows = []
    for i in range(n):
        lang, subject = ["en", "de"][r.integers(2)], int(r.integers(8))
        common = [f"{lang}common{k}" for k in r.integers(30, size=40)]
        own = [f"{lang}subject{subject}word{k}" for k in r.integers(12, size=60)]
        rows.append((i, subject, lang, " ".join(r.permutation(common + own))))
    return rows


def _fitted(spark, rows, parts):
    frame = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, lang string, text string").repartition(parts)
    frame = frame.select("doc_id", "lang", mixing.described(F.col("text")).alias("d")).select("doc_id", "lang", "d.v").cache()
    topics = mixing.fit_topics(frame.select("lang", "v"))
    got = {x.doc_id: x.t for x in frame.select("doc_id", topics.of(F.col("v"), F.col("lang")).alias("t")).collect()}
    return topics, got


def test_topics_follow_subjects_not_languages_and_not_the_order_of_rows(spark):
    rows = _planted()
    topics, got = _fitted(spark, rows, 5)
    other, same = _fitted(spark, rows[::-1], 2)
    assert got == same and (topics.centres == other.centres).all()
    for lang in ("en", "de"):
        of = pd.DataFrame([(r[1], got[r[0]]) for r in rows if r[2] == lang], columns=["subject", "topic"])
        table = pd.crosstab(of["subject"], of["topic"])
        assert len(table.columns) >= 6 and table.max(axis=1).sum() / len(of) > 0.8  # a subject keeps together


def test_topics_equal_plain_k_means(spark):
    rows = _planted(200)
    topics, got = _fitted(spark, rows, 3)
    v, _ = mixing.vectors(pa.array([r[3] for r in rows]))
    lang = np.array([r[2] for r in rows])
    x = v.copy()
    for g in ("en", "de"):
        x[lang == g] -= np.rint(v[lang == g].sum(0) / (lang == g).sum()).astype(int)
    axes = np.rint(np.linalg.eigh(x.T.astype(float) @ x)[1][:, -3:] * 1e6).astype(int)
    part, sizes = (x @ axes > 0) @ [1, 2, 4], None
    centres = np.zeros((8, mixing.DIMS), int)
    for _ in range(mixing.SWEEPS):
        for k in set(part):
            centres[k] = np.rint(x[part == k].sum(0) / (part == k).sum())
        now = np.bincount(part, minlength=8).tolist()
        if now == sizes:
            break
        sizes, part = now, np.array([min(range(8), key=lambda k: (((p - centres[k])**2).sum(), k)) for p in x])
    else:
        part = np.array([min(range(8), key=lambda k: (((p - centres[k])**2).sum(), k)) for p in x])
    assert (topics.centres == centres).all()
    want = [min(range(8), key=lambda k: (((p - centres[k])**2).sum(), k)) for p in x]
    assert [got[r[0]] for r in rows] == [str(k) for k in want]


def test_vectors():
    texts = ["", "a bb ccc", "Wordy, wordy! (other)", " ", "wordy wordy other", "x" * 100_000, "퟿ 文字文字文"]
    v, tokens = mixing.vectors(pa.array(texts))
    assert tokens.tolist() == [0, 3, 3, 0, 3, 1, 2]
    assert not v[[0, 1, 3]].any() and (v[2] == v[4]).all() and abs(v[5]).max() == mixing.SCALE
    assert all(abs((v[i].astype(float)**2).sum()**0.5 - mixing.SCALE) < 5 for i in (2, 4, 5, 6))
    assert mixing.vectors(pa.array([], pa.string()))[0].shape == (0, mixing.DIMS)


def test_tempered_targets(spark):
    rows = [("hot", 900_000), ("hot", 100_000), ("b", 10_000), ("c", 10_000), ("rare", 5), (None, 95), ("*", 0), ("none", 0)]
    frame = spark.createDataFrame([(s, "en", "0", n) for s, n in rows], "source string, lang string, topic string, n_tokens long")
    got = mixing.resolved(frame, {"source": Tempered(0.5, fixed={"b": 0.2}), "lang": {"en": 1.0}, "topic": Tempered(1.0)})
    free = {"hot": 1000.0, "c": 100.0, "*": 10.0}
    assert got["source"] == pytest.approx({"b": 0.2, **{k: 0.8 * x / 1110 for k, x in free.items()}})
    assert got["lang"] == {"en": 1.0} and got["topic"] == pytest.approx({"*": 0.0, "0": 1.0})
    empty = mixing.resolved(frame.limit(0), {"source": Tempered(0.5), "lang": Tempered(1), "topic": {}})
    assert empty == {"source": {"*": 0.0}, "lang": {"*": 0.0}, "topic": {}}


def test_every_source_meets_its_target(spark):
    got = QUERIES["op8_mix"](spark, SF).toPandas()
    natural = got.groupby("source")["n_tokens"].sum()
    root = np.sqrt(natural.drop("src0"))
    want = {**(0.9 * root / root.sum()).to_dict(), "src0": 0.1}
    expected = (got["n_tokens"] * got["probability"]).groupby(got["source"]).sum()
    share = (expected / expected.sum()).to_dict()
    assert len(share) == 20 and all(abs(share[s] - x) < 0.005 for s, x in want.items())
    kept = got[got["kept"]].groupby("topic")["n_tokens"].sum()
    assert len(kept) == mixing.TOPICS and (kept / kept.sum()).between(0.05, 0.25).all()
