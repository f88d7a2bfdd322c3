"""The training sample of the PII trees under a hot text."""

import numpy as np

from cursorlake.llm import pii

from .helpers import prose


def test_copies_of_a_text_neither_fill_nor_change_the_sample(spark, monkeypatch):
    texts = [f"{prose(i, 8)} mail user{i}@host{i % 9}.org or 10.0.{i % 200}.7, call +44 20 7946 0{i:03d}" for i in range(300)]
    seen = []
    fitted = pii.PiiModel.fit
    monkeypatch.setattr(pii.PiiModel, "fit", staticmethod(lambda kind, y, x, fold: seen.append((kind, y, x, fold)) or fitted(kind, y, x, fold)))
    for rows in (texts, texts + [texts[k] for k in (0, 1, 2, 3)] * 400):
        pii.fit(spark.createDataFrame([(t,) for t in rows], "text string").repartition(4), sample_texts=100)
    (a, b) = seen
    assert 0 < len(a[0]) and all(np.array_equal(p, q) for p, q in zip(a, b))
    rows = np.column_stack([a[0], a[1], a[2], a[3]])
    assert len(np.unique(rows, axis=0)) == len(rows)
