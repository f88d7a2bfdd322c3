"""What a Python worker keeps between the tasks of different stages."""

import re
import subprocess
import sys

import pytest

from cursorlake.llm import common, graph, mixing
from cursorlake.llm.queries import MIX_TARGETS

from .helpers import doc, docs, prose

HELD = """
import re
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from cursorlake.llm import common, near_dup

def used():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

def task(batches):
    for b in getattr(common, "lean", iter)(batches):
        for part in near_dup.runs(b, "text"):
            words = near_dup.Words(part.column("text"))
            words = np.unique(words.text_of() * len(words.hash) + words.number)

common.per_worker("tokenizer", 1, lambda: np.ones(10 << 20))
before = used() - 80
text = " ".join(f"w{i}" for i in range(400))
for k in range(3):
    rows = pa.array([f"{k} {i} " + text for i in range(2048)])
    task(iter([pa.RecordBatch.from_arrays([rows], ["text"])]))
    del rows
print(used() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_task_leaves_little_memory_behind():
    """Neither its batches' arrays nor what an earlier stage kept in the worker."""
    out = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True).stdout
    assert int(re.findall(r"-?\d+", out)[-1]) < 50


def test_objects_stay_until_another_stage_runs():
    made = []
    for _ in range(2):
        common.per_worker("kind", 1, lambda: made.append(1))
    assert len(made) == 1
    assert list(common.lean(iter([1, 2]))) == [1, 2]
    common.per_worker("kind", 1, lambda: made.append(1))
    assert len(made) == 2


def test_mixing_takes_one_python_worker_per_task(spark):
    """Each Python step of a task holds a worker, which idles beside the next stage's."""
    rows = docs(spark, [doc(i, prose(i, 30), source=f"src{i % 3}") for i in range(60)])
    plan = mixing.sample(common.staged(rows, "rows"), MIX_TARGETS)._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if re.match(r"[ :+-]*(ArrowEvalPython|Scan ExistingRDD)", line)]
    assert len(steps) == 1 and "ArrowEvalPython" in steps[0]


def test_rounds_of_components_write_files_by_their_links(spark, monkeypatch):
    """Not one for each shuffle partition, even if adaptive execution joins none."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    files = []

    def staged(df, name):
        out = common.staged(df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "staged", staged)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(i, i + 1) for i in range(60) if i != 30] + [(70, 80), (80, 70), (90, 90)], "a long, b long")
        got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 if i <= 30 else 31 for i in range(61)} | {70: 70, 80: 70}
    assert files[0] > 10 and len(files) > 2 and max(files[1:]) == 1
