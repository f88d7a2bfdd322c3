"""URL filter: suffix statistics, verdicts and unseen hosts against plain
versions."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cursorlake.llm import urls
from cursorlake.llm.queries import URL_RULES, url_labels

SF = "/root/testdata/sf0.1/pages.parquet"


def _parts(url):
    rest = url.split("://", 1)[1] if "://" in url else ""
    end = min([i for i, c in enumerate(rest) if c in "?#"], default=len(rest))
    host, _, path = rest[:end].partition("/")
    labels, name = host.lower().split("."), path.split("/")[-1]
    return [".".join(labels[-3:]), ".".join(labels[-2:]), labels[-1], name[name.rindex("."):] if "." in name else ""]


def _rows():
    r = np.random.default_rng(4)
    rows = [("https://www.hot.example.net/a/b.html?x=1.2", 0)] * 150
    for i in range(250):
        bad = i % 3 == 0
        host = f"{'m.' if i % 2 else ''}{'buy-now-' if bad else 'site'}{i % 23}.org"
        rows.append((f"http://{host}/{r.integers(99)}{['', '.html', '.php', '/x#t.y'][i % 4]}", [int(bad), None][i % 7 == 0]))
    return rows + [("", 1), ("no scheme", 0), (None, 1), ("http://ü.org/", None)]


@pytest.mark.parametrize("frequent", [0.001, 0.05, 2.0])
def test_suffix_rates_and_verdicts_equal_plain_python(spark, monkeypatch, frequent):
    """With all, some and no suffixes held by the tasks."""
    monkeypatch.setattr(urls, "FREQUENT", frequent)
    rows = _rows()
    frame = spark.createDataFrame(rows, "url string, y int").repartition(3)
    model = urls.fit(frame)
    n, blocked = Counter(), Counter()
    for url, y in rows:
        if url is not None and y is not None:
            n.update(enumerate(_parts(url)))
            blocked.update(k for k in enumerate(_parts(url)) if y)
    known = sum(v for (kind, _), v in n.items() if kind == 0)
    prior = (sum(v for (kind, _), v in blocked.items() if kind == 0) + 1) / (known + 2)
    rate = {k: (blocked[k] + 20 * prior) / (n[k] + 20) if n[k] >= 5 else prior for k in n}
    others = {(x.kind, x.suffix): x.rate for x in model.rates.others.collect()}
    held = {(kind, s): r for kind, of in enumerate(model.rates.frequent) for s, r in of.items()}
    assert (not others) == (frequent == 0.001) and (not held) == (frequent == 2.0)
    assert all({**others, **held}.get(k, prior) == pytest.approx(r) for k, r in rate.items())

    found = urls.judged(frame, URL_RULES, model).toPandas()
    assert len(found) == len(rows) and set(found["verdict"]) == {"allow", "block"}
    for x in found.itertuples():
        url = x.url or ""
        rates = np.array([[rate.get(k, prior) for k in enumerate(_parts(url))]])
        score = model.trees.predict(urls.features([url], rates))[0]
        assert x.block_score == pytest.approx(score)
        assert x.rule is not None or x.verdict == ("block" if score >= 0.5 else "allow")


def test_hosts_without_labels_are_judged(spark):
    """Names are held out in fifths; the trees have never seen them."""
    pages = spark.read.parquet(SF)
    fold = F.crc32(F.regexp_extract("host", r"[^.]*\.[^.]*\.[^.]*\z", 0).cast("binary")) % 5
    right = caught = total = bad = 0
    for k in range(5):
        model = urls.fit(url_labels(pages, fold != k))
        rows = urls.with_parts(url_labels(pages)).where((fold == k) & F.col("y").isNotNull()).select("url", "y")
        got = model.scored(rows).toPandas()
        block = got["block_score"] >= urls.THRESHOLD
        right, total = right + (block == (got["y"] == 1)).sum(), total + len(got)
        caught, bad = caught + (block & (got["y"] == 1)).sum(), bad + (got["y"] == 1).sum()
    assert right / total > 0.98 and caught / bad > 0.8


def test_labels(spark):
    article = "<article>" + "word " * 120
    rows = [("http://x-casino.org/", article, 1), ("http://casino.example.com/", article, None), ("http://a.com/x", "", 0),
            ("http://a.org/x", article, 0), ("http://a.org/x", "short", None), ("http://a.net/es/x", article, None),
            ("http://casino.net/es/x", None, 1), (None, None, None)]
    got = url_labels(spark.createDataFrame([r[:2] for r in rows], "url string, html string").coalesce(1)).collect()
    assert [tuple(x) for x in got] == [(u, y) for u, _, y in rows]
