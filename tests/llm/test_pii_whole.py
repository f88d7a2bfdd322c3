"""The PII trees and thresholds come from all texts."""

import numpy as np

from cursorlake.llm import boosting, pii


def test_every_text_is_learnt_from(spark, monkeypatch):
    """More different texts than the 4,000 that a sample used to take."""
    rows = [(f"call +44 {7000 + i} {i % 10}{i % 7}4{i % 3}12 or item {10_000_000 + 7 * i}",) for i in range(9000)]
    seen = []
    fitted = pii.PiiModel.fit_rows
    monkeypatch.setattr(pii.PiiModel, "fit_rows", staticmethod(lambda x: seen.append(
        sorted((r.kind, r.y, *r.x, r.fold) for r in x.collect())) or pii.PiiModel(boosting.BoostedTrees(), np.full(4, 2.0))))
    pii.fit(spark.createDataFrame(rows, "text string").repartition(3))
    want = {(kind, y, *x, fold) for t, in rows for kind, y, x, fold in pii.examples(t)}
    assert seen[0] == sorted(want) and fitted


def test_trees_of_a_table_equal_those_of_a_matrix(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TASK_ROWS", 700)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 300)
    monkeypatch.setattr(boosting, "ADDED_TREES", 2)
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(3000, 4)) * [1, 9, 0, 3], 1)
    y = ((x[:, 0] + x[:, 1] / 5 + r.normal(size=3000)) > 0).astype(int)
    rows = spark.createDataFrame([(a.tolist(), int(k)) for a, k in zip(x, y)], "x array<double>, y int").repartition(5)
    a, b = boosting.BoostedTrees(trees=5).fit(x, y), boosting.BoostedTrees(trees=5).fit_rows(rows)
    assert len(b.grown) == 5 and a.base == b.base and all(np.allclose(p, q) for p, q in zip(a.cuts, b.cuts))
    assert np.allclose(a.predict(x), b.predict(x), atol=1e-6)
    one = boosting.BoostedTrees().fit_rows(rows.where("y = 1"))
    assert np.allclose(one.predict(x[:2]), (y.sum() + 0.5) / (y.sum() + 1))
    assert boosting.BoostedTrees().fit_rows(rows.where("y = 2")).predict(x[:1]).tolist() == [0.5]


def test_thresholds_are_those_of_all_scores(spark):
    r = np.random.default_rng(4)
    kind, score = r.integers(0, 3, 4000), np.round(r.random(4000) ** 4, 3)
    score[:5] = [1.0, 0.0, 1e-12, np.nextafter(1, 0), 1.0]
    rows = spark.createDataFrame([(int(k), int(v)) for k, v in zip(kind, score.view(np.int64))], "kind int, bits long").repartition(4)
    for at in (0, 1, 7, 1000):
        want = {k: float(np.sort(score[kind == k])[::-1][at]) for k in range(3)}
        assert pii.kth_largest(rows, {k: at for k in range(3)}) == want
    assert pii.kth_largest(rows, {}) == {}
